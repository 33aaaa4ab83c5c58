"""URL filter: rules first, link-graph propagation for the rest.

Trust starts at hosts with allowed pages and follows links; distrust starts at hosts with blocked
pages and follows links backwards, to those who link there. A host starts with the share of its
pages that a rule allows, or blocks. Both are personalised PageRank over host edges, in the
same unit: a host all of whose pages are ruled, without links, keeps a score of one. So the
two can be held against each other, however many hosts either starts at. Every other page of a
host is blocked if the host's distrust is at least ``LEAST`` and above its trust. Everything
is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cratebook.llm.common import col, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
DAMPING = 0.85
#: Distrust below this blocks nothing. A sole chain of links passes it on for about 30 hops.
LEAST = 0.001
#: Rounds end when no host's score moves by more in one written step.
TOLERANCE = 1e-7
#: Rounds between two written tables.
WRITE_EVERY = 3

#: (rule, verdict); a rule is a host and a path prefix.
Rule = tuple[str, str]


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host_: Column, path_: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, or null. ``rules`` is a configuration of a few entries."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        on_host = (host_ == name) | host_.endswith("." + name)
        found = F.when(on_host & path_.startswith("/" + rest), F.lit(rule)).otherwise(found)
    return found


def verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules:
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


def host_edges(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(src, dst): distinct links between different hosts. ``pages`` has a column host."""
    targets = F.transform(F.regexp_extract_all(col(html_col).cast("string"), F.lit(_LINK), F.lit(1)), lambda h: F.translate(h, UPPER, LOWER))
    pairs = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(targets)).alias("dst"))
    return pairs.where("src <> dst AND src <> '' AND dst <> ''").distinct()


def propagate(seeds: DataFrame, flows: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind.

    ``seeds`` (kind, host, seed) say where a kind's score starts and comes back to, and how much
    of it there is in all; ``flows`` (kind, host, other) are edges. A host without edges returns
    its score to the seeds. Rounds go on until no score moves by more than ``tolerance``; what
    moves in all falls by the damping factor with every round, so that they end.
    """
    degree = flows.groupBy("kind", "host").agg(F.count(F.lit(1)).alias("degree"))
    weighted = stored(flows.join(degree, ["kind", "host"]), "flows")
    senders = stored(weighted.select("kind", "host").distinct(), "senders")
    mass = seeds.groupBy("kind").agg(F.sum("seed").alias("mass"))
    seeds = stored(seeds.join(mass, "kind").select("kind", "host", "seed", (F.col("seed") / F.col("mass")).alias("share")), "seeds")
    score = stored(seeds.select("kind", "host", F.col("seed").alias("score")), "scores")
    while True:
        before = score
        for _ in range(WRITE_EVERY):
            sent = score.join(weighted, ["kind", "host"]).select("kind", F.col("other").alias("host"), (F.col("score") / F.col("degree")).alias("part"))
            # What is not sent on (no edges) comes back by the seeds: one number per kind.
            stuck = score.join(senders, ["kind", "host"], "left_anti").groupBy("kind").agg(F.sum("score").alias("stuck"))
            back = F.col("seed") * (1 - damping) + F.col("share") * damping * F.coalesce("stuck", F.lit(0.0))
            again = seeds.join(stuck, "kind", "left").select("kind", "host", back.alias("part"))
            spread = sent.select("kind", "host", (F.lit(damping) * F.col("part")).alias("part"))
            score = spread.unionByName(again).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        score = stored(score, "scores")
        old = before.select("kind", "host", (-F.col("score")).alias("score"))
        moved = score.unionByName(old).groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("d")).agg(F.max("d")).first()[0]
        if (moved or 0.0) <= tolerance:
            return score


def judge(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(<id_col>, host, path, rule, verdict, trust, distrust): one row per page.

    A url that is null or without ``://`` has an empty host and path, fits no rule and is
    allowed. Hosts start with the shares of their pages that rules allow and block. Null pages have no links. Repeated rows count as pages of their own; other columns are
    ignored; an empty table gives none.
    """
    own = pages.select(col(id_col).alias("id"), col(url_col).cast("string").alias("url"), col(html_col).cast("string").alias("html"))
    own = own.select("id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html")
    ruled = own.select("id", "host", "path", matching_rule(F.col("host"), F.col("path"), rules).alias("rule"))
    ruled = ruled.withColumn("said", verdict_of(F.col("rule"), rules))
    said = F.coalesce("said", F.lit(""))
    kinds = {"trust": "allow", "distrust": "block"}
    per_host = ruled.where("host <> ''").groupBy("host").agg(*[F.avg((said == word).cast("int")).alias(kind) for kind, word in kinds.items()])
    starts = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("seed")) for kind in kinds]))
    seeds = stored(per_host.select("host", starts.alias("s")).select("s.kind", "host", "s.seed").where("seed > 0"), "seeds")
    edges = stored(host_edges(own), "edges")
    flows = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("other")).unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("other"))
    )
    scores = propagate(seeds, flows)
    hosts = scores.groupBy("host").agg(
        *[F.sum(F.when(F.col("kind") == k, F.col("score")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")]
    )
    judged = ruled.join(hosts, "host", "left").select(
        "id", "host", "path", "rule", "said", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
    by_links = F.when((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= LEAST), F.lit("block")).otherwise("allow")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("said", by_links).alias("verdict"), "trust", "distrust")
