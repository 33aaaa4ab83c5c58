"""From raw documents to token ids: five stages, each over all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cratebook.llm import decontaminate, pieces, pii, simhash, toxicity
from cratebook.llm.common import load, stored
from cratebook.llm.queries import PIECE_MODEL, vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model rejects go."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: three-word shingles, three bits."""
    return simhash.keep_one_of_each(docs, length=3, max_bits=3)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is masked."""
    return pii.mask_documents(docs, length_col="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to, as digests."""
    return pieces.encode_decode_digests(docs, vocabulary(PIECE_MODEL))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_benchmark_copies),
    ("pii", mask_personal_data),
    ("sentencepiece", tokens),
]
#: SQL has neither the model, the hash nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    docs = load(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, "corpus")
    return docs
