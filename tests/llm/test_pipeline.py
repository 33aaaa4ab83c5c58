"""The pipeline and the registered queries on the smallest tables against brute force."""

from __future__ import annotations

import hashlib

import corpus_pipeline
import duckdb
import pytest

from cratebook.llm import queries, toxicity
from tests.llm import brute


def test_pipeline_equals_its_stages_by_hand(spark, small):
    import sentencepiece

    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.severity(docs, model).collect() if r.toxic}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic]
    prints = brute.simhash_rows(rows)
    rows = [(i, t) for i, t in rows if prints[i][1] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = brute.contamination(rows, items)
    rows = [(i, t) for i, t in rows if not leaked[i][4]]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary(queries.PIECE_MODEL))
    want = {}
    for i, t in rows:
        out, at = "", 0
        for start, _, kind, end in brute.pii(t):
            if start >= at:
                out += t[at:start] + f"[{kind.upper()}]"
            at = max(at, end)
        ids = library.encode(out + t[at:])
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), brute.sha(library.decode(ids)))
    assert {r[0]: tuple(r[1:]) for r in corpus_pipeline.run(spark, small).collect()} == want


def test_stages_keep_the_columns_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).schema.simpleString() == docs.schema.simpleString()


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(tuple(r) for r in queries.QUERIES[name](spark, small).select(*columns).collect()) == sorted(result.fetchall())
