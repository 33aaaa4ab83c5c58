"""Merkle manifest of a table: per source a tree over its rows, and one tree over the sources.

Three children make a node. The levels are built in blocks of 3^6 nodes, which bounds what a
task holds, and are stored as node rows: six levels make a hop, a row names its ancestor at
the next hop as parent and keeps the siblings met on the way there. The top of a source's tree
has the source's entry in the tree of sources as parent, so the rows of all trees are linked.

Proofs come from a recursive query over these rows: every leaf climbs to the root, appending
the siblings of each level to its proof and folding its (possibly changed) digest with them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cratebook.llm.common import col, stored, written
from cratebook.operators.grouping import numbered

#: Children of a node, and levels that one step of the climb passes.
ARITY = 3
HOP = 6
BLOCK = ARITY**HOP
#: Number of the tree over sources.
TOP = -1
#: Powers of the arity, enough for every long.
POWERS = [ARITY**k for k in range(40)]

#: Digests are stored and carried as 32 bytes; they are hashed and returned as hex text.
STEPS = "array<struct<l: binary, r: binary>>"
NODES = f"node string, parent string, steps {STEPS}, subroot binary"
LEAVES = f"id long, leaf binary, changed binary, parent string, steps {STEPS}"
CLIMB = """
WITH RECURSIVE climb AS (
    SELECT id, leaf, parent, CAST(NULL AS BINARY) AS subroot,
        aggregate(steps, X'', (p, s) -> concat(p, s.l, s.r)) AS proof,
        aggregate(steps, changed, (h, s) -> unhex(sha2(lower(hex(concat(s.l, h, s.r))), 256))) AS folded
    FROM leaves
    UNION ALL
    SELECT c.id, c.leaf, n.parent, coalesce(c.subroot, n.subroot),
        aggregate(n.steps, c.proof, (p, s) -> concat(p, s.l, s.r)),
        aggregate(n.steps, c.folded, (h, s) -> unhex(sha2(lower(hex(concat(s.l, h, s.r))), 256)))
    FROM climb c JOIN nodes n ON c.parent = n.node
)
SELECT id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot,
    sha2(lower(hex(proof)), 256) AS proof_sha256, lower(hex(folded)) AS folded
FROM climb WHERE parent IS NULL
"""
#: Node rows of a file, where there are fewer than that in all.
NODES_A_FILE = 200_000


def leaf_text(columns: Sequence[Column]) -> Column:
    """What a leaf's digest is taken of: each value as ``bytes:value``, a null as ``-``."""
    texts = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def _height(size: Column) -> Column:
    """Levels above ``size`` nodes: the number of powers of the arity below it."""
    below = [F.when(F.lit(p) < size, 1).otherwise(0) for p in POWERS if p < 2**63]
    return reduce(Column.__add__, below)


def _joined(digests: Column) -> Column:
    """Up to three digests as one value."""
    return F.concat(*[F.coalesce(F.get(digests, F.lit(k)), F.lit(b"")) for k in range(ARITY)])


def _digest(digests: Column) -> Column:
    return F.unhex(F.sha2(F.lower(F.hex(_joined(digests))), 256))


def _runs(level: Column) -> Column:
    """Digests of the parents of a level's nodes."""
    last = F.floor((F.size(level) - 1) / ARITY).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: _digest(F.slice(level, i * ARITY + 1, F.lit(ARITY))))


def _name(tree: Column, hop: int, position: Column) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(str(hop)), position.cast("string"))


def _hop(items: DataFrame, hop: int) -> tuple[DataFrame, DataFrame]:
    """(node rows of this hop, items above it) of all trees.

    ``items``: tree, position, digest, height (levels above them), own (carried along). A tree
    that ends within the hop has one item above, of no height: its root.
    """
    blocks = items.withColumn("block", F.floor(F.col("position") / BLOCK)).groupBy("tree", "height", "block")
    level = blocks.agg(F.array_sort(F.collect_list(F.struct("position", "digest", "own"))).alias("nodes")).withColumn("l0", F.col("nodes.digest"))
    for k in range(HOP):
        level = level.withColumn(f"l{k + 1}", F.when(F.col("height") > k, _runs(F.col(f"l{k}"))).otherwise(F.col(f"l{k}")))
    held = level.select("tree", "height", "block", "nodes", F.array(*[f"l{k}" for k in range(HOP)]).alias("levels"), F.get(f"l{HOP}", F.lit(0)).alias("digest"))

    def step(j: Column, k: Column) -> Column:
        at = F.floor(j / F.pow(F.lit(float(ARITY)), k)).cast("int")
        first, nodes = at - at % ARITY, F.get("levels", k)
        left, right = F.slice(nodes, first + 1, at - first), F.slice(nodes, at + 2, first + ARITY - 1 - at)
        return F.struct(_joined(left).alias("l"), _joined(right).alias("r"))

    def row(node: Column, j: Column) -> Column:
        climbed = F.filter(F.sequence(F.lit(0), F.lit(HOP - 1)), lambda k: k < F.col("height"))
        return F.struct(node["position"].alias("position"), node["digest"].alias("digest"), node["own"].alias("own"), F.transform(climbed, lambda k: step(j, k)).alias("steps"))

    ended = F.col("height") <= HOP
    entry = F.when(F.col("tree") != TOP, _name(F.lit(TOP), 0, F.col("tree")))
    parent = F.when(ended, entry).otherwise(_name(F.col("tree"), hop + 1, F.col("block")))
    rows = held.select("tree", parent.alias("parent"), F.explode(F.transform("nodes", row)).alias("row"))
    rows = rows.select(_name(F.col("tree"), hop, F.col("row.position")).alias("node"), "parent", "row.digest", "row.own", "row.steps")
    above = held.select("tree", F.col("block").alias("position"), "digest", F.greatest(F.lit(0), F.col("height") - HOP).alias("height"), F.lit(None).cast("string").alias("own"), ended.alias("ended"))
    return rows, above


def _trees(items: DataFrame) -> tuple[list[DataFrame], DataFrame, int]:
    """(node rows of each hop, roots, node rows above the first hop) of all trees. Only the
    greatest height and counts reach the driver."""
    highest = items.agg(F.max("height")).first()[0] or 0
    hops, roots, blocks = [], [], 0
    for hop in range(max(1, -(-highest // HOP))):
        rows, above = _hop(items, hop)
        hops.append(rows)
        above = stored(above, "levels")
        roots.append(above.where("ended").select("tree", "digest"))
        items = above.where("NOT ended")
        blocks += items.count()
    return hops, reduce(DataFrame.unionByName, roots), blocks


def climb(spark: SparkSession, leaves: str, nodes: str) -> DataFrame:
    """(id, leaf, subroot, proof_sha256, folded) of every leaf, by the recursive query.

    ``leaves`` and ``nodes`` are paths of stored rows. The limit of a recursive query's rows is
    a setting of the session, so it is lifted in a session of its own, which writes the result.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    for name in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        own.conf.set(name, spark.conf.get(name))
    own.read.schema(LEAVES).parquet(leaves).createOrReplaceTempView("leaves")
    own.read.schema(NODES).parquet(nodes).createOrReplaceTempView("nodes")
    rows = own.sql(CLIMB)
    return spark.read.schema(rows.schema).parquet(written(rows, "proofs"))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed_text: Column | None = None,
) -> DataFrame:
    """(<id_col>, leaf, subroot, root, proof_sha256, folded_root, verified): one row per row.

    ``columns`` are what a leaf's digest covers, in that order. ``changed_text`` is the text as
    found later (by default the same); ``verified`` tells whether it folds to the root.

    Rows of a source ascend by id, null first, those of one id by their digest. Equal rows are
    leaves of their own. A null source is a source and the first, an empty one the next. An
    empty table gives no rows; in a table of one row the leaf is the root, its proof is empty.
    Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    text = col(text_col).cast("string")
    later = text if changed_text is None else changed_text
    leaf = F.unhex(F.sha2(leaf_text([col(c) for c in columns]), 256))
    again = F.unhex(F.sha2(leaf_text([later if c == text_col else col(c) for c in columns]), 256))
    rows = docs.select(
        col(id_col).cast("long").alias("id"),
        col(source_col).isNotNull().alias("named"),
        F.coalesce(col(source_col).cast("string"), F.lit("")).alias("source"),
        leaf.alias("digest"),
        F.when(later.eqNullSafe(text), leaf).otherwise(again).alias("changed"),
    )
    placed = stored(numbered(rows, ["named", "source"], ["id", "digest"], total="leaves"), "leaves")
    sizes = placed.select("named", "source", "leaves").distinct()
    sources = stored(numbered(sizes, [], ["named", "source"], "tree", "trees"), "sources")
    items = placed.join(sources.select("named", "source", "tree"), ["named", "source"])
    own = F.struct("id", "changed").alias("own")
    hops, roots, blocks = _trees(stored(items.select("tree", "position", "digest", _height(F.col("leaves")).alias("height"), own), "items"))
    leaves = hops[0].select("own.id", F.col("digest").alias("leaf"), "own.changed", "parent", "steps")
    entries = roots.join(sources, "tree").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("position"), "digest", _height(F.col("trees")).alias("height"), F.lit(None).cast("string").alias("own")
    )
    entries = stored(entries, "entries")
    upper, tops, _ = _trees(entries)
    inner = [rows.withColumn("subroot", F.lit(None).cast("binary")) for rows in [*hops[1:], *upper[1:]]]
    nodes = [rows.select("node", "parent", "steps", "subroot") for rows in [*inner, upper[0].withColumn("subroot", F.col("digest"))]]
    top = tops.first()
    linked = reduce(DataFrame.unionByName, nodes)
    linked = linked.coalesce(1 + (blocks + entries.count()) // NODES_A_FILE)
    proofs = climb(spark, written(leaves, "leaves"), written(linked, "nodes"))
    root = F.lit(top.digest.hex() if top else None).cast("string")
    return proofs.select(
        F.col("id").alias(id_col), "leaf", "subroot", root.alias("root"), "proof_sha256", F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified")
    )
