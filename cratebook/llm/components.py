"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import stored


def _nearest(links: DataFrame) -> DataFrame:
    """(node, least): the smallest of a node and its neighbours."""
    return links.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (long columns ``a``, ``b``): root is the
    smallest node that can be reached.

    Each round hangs every larger neighbour below a node's smallest one, then every
    node and its smaller neighbours below the smallest of these; the number of rounds
    grows with the logarithm of the longest path. A round is two keyed joins of the
    links with one row per node, which adaptive execution splits for a hub, and is
    written to the shared folder. Only the number of changed links reaches the driver.
    Null ends and links of a node with itself are left out; an empty table gives none.
    """
    both = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    stars = stored(both.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(), "links")
    while True:
        mirrored = stars.unionByName(stars.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = (
            mirrored.join(_nearest(mirrored), "node")
            .where("other > node")
            .select(F.col("other").alias("node"), F.col("least").alias("other"))
        )
        large = stored(large.distinct(), "links")
        small = large.join(_nearest(large), "node")
        small = small.select(F.col("other").alias("node"), F.col("least").alias("other")).unionByName(
            small.select("node", F.col("least").alias("other"))
        )
        after = stored(small.where("node <> other").distinct(), "links")
        changed = after.join(stars, ["node", "other"], "left_anti").limit(1).count()
        stars = after
        if not changed and not stars.join(stars.select(F.col("node").alias("other")), "other", "left_semi").limit(1).count():
            break
    roots = stars.groupBy("node").agg(F.min("other").alias("root"))
    return roots.unionByName(stars.select(F.col("other").alias("node"), F.col("other").alias("root")).distinct())
