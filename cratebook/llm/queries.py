"""The operators as registered queries over the test tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook.llm import caps, decontaminate, extract, gnat, idfile, merkle, pieces, pii, quality, sharding, simhash, toxicity, urls
from cratebook.llm.common import load

PIECE_MODEL = "piece_bpe_32k.model"
WORD_TOKENIZER = "word_bpe_49k.json"

# The rules of the URL filter.
URL_RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def vocabulary(name: str) -> str:
    """Where the public vocabulary files lie."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_vectors(load(spark, folder, "embeddings"))


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return toxicity.severity(docs, toxicity.fit(docs, load(spark, folder, "labels")))


def op3_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(load(spark, folder, "pages"), URL_RULES).drop("trust", "distrust")


def op4_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    return idfile.encoded_checksums(load(spark, folder, "documents"), vocabulary(WORD_TOKENIZER))


def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(load(spark, folder, "documents")).drop("n_spans")


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(load(spark, folder, "documents"), load(spark, folder, "benchmark"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.shard_rows(load(spark, folder, "documents"))
    return rows.select("*", F.lit("rows").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode_decode_digests(load(spark, folder, "documents"), vocabulary(PIECE_MODEL))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    return quality.scores(docs, quality.fit(docs, load(spark, folder, "labels")))


def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_neardup(load(spark, folder, "documents"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest against texts of which every second id's has lost its line ends."""
    docs = load(spark, folder, "documents")
    cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return merkle.manifest(docs, changed_text=F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))


def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = load(spark, folder, "pages")
    return extract.main_texts(pages, extract.fit(pages))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every seventh vector has the next label, so that its near ones are hard negatives."""
    vectors = load(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.hard_negatives(vectors.withColumn("label", moved))


QUERIES = {
    "op1_embeddings": op1_embeddings,
    "op2_toxicity": op2_toxicity,
    "op3_urls": op3_urls,
    "op4_token_ids": op4_token_ids,
    "op5_pii": op5_pii,
    "op6_decontamination": op6_decontamination,
    "op7_sharding": op7_sharding,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_quality": op9_quality,
    "op10_simhash": op10_simhash,
    "op11_merkle": op11_merkle,
    "op12_main_text": op12_main_text,
    "op13_hard_negatives": op13_hard_negatives,
}
ORACLES: dict[str, str] = {
    "op1_embeddings": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ),
        reach(a, b) AS (
            SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ),
        n AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        c AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
        SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(v.vec_id, c.least) AS component_id,
            v.vec_id = least(v.vec_id, c.least) AS kept
        FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN c ON v.vec_id = c.a""",
    "op3_urls": r"""
        WITH RECURSIVE u AS (
            SELECT page_id, url, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages
        ),
        rules(rule, said) AS (
            VALUES ('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), ('net/es/', 'block'), ('net/fr/', 'block')
        ),
        fits AS (
            SELECT u.*, r.rule, r.said FROM u LEFT JOIN rules r
            ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
                AND starts_with(path, rule[strpos(rule, '/') :])
            QUALIFY row_number() OVER (PARTITION BY page_id, url, html ORDER BY length(rule) DESC NULLS LAST) = 1
        ),
        seeds AS (
            SELECT kind, host, seed, seed / sum(seed) OVER (PARTITION BY kind) AS share FROM (
                SELECT 'trust' AS kind, host, avg(CASE WHEN said = 'allow' THEN 1.0 ELSE 0.0 END)::DOUBLE AS seed FROM fits WHERE host <> '' GROUP BY host
                UNION ALL SELECT 'distrust', host, avg(CASE WHEN said = 'block' THEN 1.0 ELSE 0.0 END)::DOUBLE FROM fits WHERE host <> '' GROUP BY host
            ) WHERE seed > 0
        ),
        edges AS (
            SELECT DISTINCT host AS src, dst FROM (
                SELECT host, translate(unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"''\s>]+)', 1)),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM fits
            ) WHERE host <> dst AND host <> '' AND dst <> ''
        ),
        flows AS (
            SELECT kind, host, other, count(*) OVER (PARTITION BY kind, host) AS degree FROM (
                SELECT 'trust' AS kind, src AS host, dst AS other FROM edges UNION ALL SELECT 'distrust', dst, src FROM edges
            )
        ),
        score(round, kind, host, score) AS (
            SELECT 0, kind, host, seed FROM seeds
            UNION ALL
            SELECT round, kind, host, sum(part) FROM (
                SELECT s.round + 1 AS round, s.kind, f.other AS host, 0.85 * s.score / f.degree AS part
                FROM score s JOIN flows f ON s.kind = f.kind AND s.host = f.host
                UNION ALL
                SELECT t.round + 1, x.kind, x.host, 0.15 * x.seed + 0.85 * x.share * t.stuck
                FROM seeds x JOIN (
                    SELECT s.round, s.kind, coalesce(sum(CASE WHEN f.host IS NULL THEN s.score END), 0) AS stuck
                    FROM score s LEFT JOIN (SELECT DISTINCT kind, host FROM flows) f ON s.kind = f.kind AND s.host = f.host GROUP BY ALL
                ) t ON x.kind = t.kind
            ) WHERE round <= 150 GROUP BY round, kind, host
        ),
        final AS (
            SELECT host, sum(CASE kind WHEN 'trust' THEN score ELSE 0 END) AS trust, sum(CASE kind WHEN 'distrust' THEN score ELSE 0 END) AS distrust
            FROM score WHERE round = 150 GROUP BY host
        )
        SELECT page_id, host, path, rule, coalesce(said, CASE WHEN distrust > trust AND distrust >= 0.001 THEN 'block' ELSE 'allow' END) AS verdict
        FROM fits LEFT JOIN final USING (host)""",
    "op6_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
        ),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
        ),
        windows AS (
            SELECT DISTINCT item_id, w[k : k + 9] AS win
            FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 8))) AS k FROM b WHERE len(w) > 0)
        ),
        sizes AS (SELECT DISTINCT len(win) AS n FROM windows),
        places AS (
            SELECT doc_id, n, k, w[k : k + n - 1] AS win
            FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)
        ),
        found AS (SELECT p.doc_id, p.k, p.n, x.item_id FROM places p JOIN windows x ON p.win = x.win),
        hits AS (
            SELECT doc_id, count(DISTINCT spot) AS n_hit
            FROM (SELECT doc_id, unnest(range(k, k + n)) AS spot FROM found) GROUP BY doc_id
        ),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op11_merkle": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, text, lang, n_chars,
                list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END) AS crc
            FROM documents
        ),
        t AS (
            SELECT doc_id, source, list_concat([doc_id::VARCHAR, source, lang, n_chars::VARCHAR], [text]) AS old,
                list_concat([doc_id::VARCHAR, source, lang, n_chars::VARCHAR],
                    [CASE WHEN xor(crc, 4294967295) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END]) AS new
            FROM d
        ),
        h AS (
            SELECT doc_id, source,
                sha256(list_reduce(list_transform(old, lambda v: coalesce(strlen(v) || ':' || v, '-')), lambda a, b: a || b)) AS leaf,
                sha256(list_reduce(list_transform(new, lambda v: coalesce(strlen(v) || ':' || v, '-')), lambda a, b: a || b)) AS changed
            FROM t
        ),
        leaves AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM h
        ),
        low(tree, lv, pos, digest, n) AS (
            SELECT tree, 0, pos, leaf, count(*) OVER (PARTITION BY tree) FROM leaves
            UNION ALL
            SELECT tree, lv + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM low WHERE n > 1
            GROUP BY tree, lv, pos // 3, n
        ),
        top(lv, pos, digest, n) AS (
            SELECT 0, tree, digest, count(*) OVER () FROM low WHERE n = 1
            UNION ALL
            SELECT lv + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos)), (n + 2) // 3 FROM top WHERE n > 1
            GROUP BY lv, pos // 3, n
        ),
        nodes AS (
            SELECT tree, lv, pos, digest, n FROM low WHERE n > 1 UNION ALL SELECT -1, lv, pos, digest, n FROM top WHERE n > 1
        ),
        ways AS (
            SELECT tree, lv, a.pos, a.n,
                coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
                coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
            FROM nodes a JOIN nodes b USING (tree, lv) WHERE a.pos // 3 = b.pos // 3 GROUP BY ALL
        ),
        subroots AS (SELECT tree, digest FROM low WHERE n = 1),
        inner_climb(doc, tree, lv, pos, proof, folded) AS (
            SELECT leaf || pos, tree, 0, pos, '', changed FROM leaves
            UNION ALL
            SELECT c.doc, tree, lv + 1, c.pos // 3, c.proof || w.l || w.r, sha256(w.l || c.folded || w.r)
            FROM inner_climb c JOIN ways w USING (tree, lv) WHERE c.pos = w.pos
        ),
        outer_climb(doc, tree, lv, pos, proof, folded) AS (
            SELECT doc, -1, 0, tree, proof, folded FROM inner_climb c JOIN low USING (tree, lv) WHERE n = 1
            UNION ALL
            SELECT c.doc, -1, lv + 1, c.pos // 3, c.proof || w.l || w.r, sha256(w.l || c.folded || w.r)
            FROM outer_climb c JOIN ways w USING (tree, lv) WHERE c.pos = w.pos
        ),
        done AS (SELECT doc, proof, folded FROM outer_climb JOIN top USING (lv) WHERE n = 1)
        SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root,
            folded = r.digest AS verified
        FROM leaves l JOIN subroots s USING (tree) JOIN done ON done.doc = l.leaf || l.pos
            JOIN (SELECT digest FROM top WHERE n = 1) r ON true""",
    # What the markup of these pages says: heading and paragraphs of the article element.
    "op12_main_text": r"""
        WITH raw AS (
            SELECT page_id, url, regexp_split_to_array(regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1),
                '</?(?:b|br)>', ' ', 'g'), '</?(?:p|h1)>') AS parts FROM pages
        ),
        decoded AS (
            SELECT page_id, url, list_transform(parts, lambda p: trim(regexp_replace(replace(replace(replace(replace(replace(
                p, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '&#x27;', chr(39)), '\s+', ' ', 'g'))) AS parts FROM raw
        ),
        texts AS (
            SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda p: p <> ''), chr(10) || chr(10)), '') AS text FROM decoded
        )
        SELECT page_id, url, text, length(text) AS n_chars FROM texts""",
    "op13_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        s AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS alike, list_inner_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
        ),
        p AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE alike
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, other AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id)
        WHERE NOT alike AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
        QUALIFY row_number() OVER w <= 5""",
}
