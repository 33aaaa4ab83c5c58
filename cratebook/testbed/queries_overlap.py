"""Set similarity and redundancy over three families of sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from cratebook.functions.numbers import rounded
from cratebook.operators import overlap, redundancy
from cratebook.testbed.queries_library import r6
from cratebook.testbed.registry import entry

NAMES = {
    "order_part": "SELECT o_orderkey AS set_id, 'Order ' || o_orderkey AS name FROM orders",
    "user_hour": "SELECT DISTINCT user_id AS set_id, 'User ' || user_id AS name FROM events",
    "nation_part": "SELECT CAST(n_nationkey AS BIGINT) AS set_id, n_name AS name FROM nation",
    "customer_day": "SELECT c_custkey AS set_id, c_name AS name FROM customer",
}


def pairs_sql(family: str, preference: str = "0", min_size: int = 0) -> str:
    """WITH list: nm (names), g (groups of copies), cp (copy rows), p (pairs of first sets)."""
    return f"""WITH nm AS ({NAMES[family]}),
sig AS (SELECT set_id, list(item_id ORDER BY item_id) AS sig, count(*) AS n FROM {family}
        GROUP BY 1 HAVING count(*) >= {min_size}),
g AS (SELECT set_id, n, name, first_value(set_id) OVER w AS first_id, count(*) OVER (PARTITION BY sig) AS copies
      FROM sig JOIN nm USING (set_id) WINDOW w AS (PARTITION BY sig ORDER BY {preference}, set_id)),
cp AS (SELECT first_id AS set1, set_id AS set2, n FROM g WHERE set_id <> first_id),
f AS (SELECT s.set_id, s.item_id FROM {family} s JOIN g ON s.set_id = g.set_id AND g.set_id = g.first_id),
x AS (SELECT a.set_id AS set1, b.set_id AS set2, count(*) AS overlap
      FROM f a JOIN f b ON a.item_id = b.item_id AND a.set_id < b.set_id GROUP BY 1, 2),
p AS (SELECT set1, set2, g1.n AS n1, g2.n AS n2, overlap, g1.n + g2.n - overlap AS union_size,
        overlap / (g1.n + g2.n - overlap) AS jaccard, overlap / g1.n AS containment1, overlap / g2.n AS containment2,
        g1.copies AS copies1, g2.copies AS copies2, g1.name AS name1, g2.name AS name2
      FROM x JOIN g g1 ON set1 = g1.set_id JOIN g g2 ON set2 = g2.set_id)"""


# Families whose rows are a table as it is stored.
STORED = {"order_part"}


def family_of(v, family):
    return v.overlap_sets(family), v.overlap_names(family)


def _pair_overlap(family: str, bound: float):
    @entry(
        f"pair_overlap_{family}",
        pairs_sql(family)
        + f""" SELECT set1, set2, n1, n2, overlap, union_size, round(jaccard, 6) AS jaccard,
  round(containment1, 6) AS containment1, round(containment2, 6) AS containment2
FROM p WHERE jaccard >= {bound}""",
        (family,),
    )
    def query(v):
        sets = overlap.written_sets(v.overlap_sets(family), "set_id", "item_id", stored=family in STORED)
        firsts = overlap.first_sets(sets, overlap.identical_sets(sets))
        pairs = overlap.pair_overlap(firsts, jaccard=bound).where(F.col("jaccard") >= bound)
        return r6(pairs, "jaccard", "containment1", "containment2")


for _family, _bound in (("order_part", 0.25), ("user_hour", 0.5), ("nation_part", 0.4)):
    _pair_overlap(_family, _bound)


@entry(
    "contained_collections",
    pairs_sql("order_part")
    + """ SELECT set1, set2, n1, n2, overlap FROM p WHERE overlap = least(n1, n2)""",
    ("order_part",),
)
def contained_collections(v):
    sets = overlap.written_sets(v.overlap_sets("order_part"), "set_id", "item_id", stored=True)
    firsts = overlap.first_sets(sets, overlap.identical_sets(sets))
    pairs = overlap.pair_overlap(firsts, subsets=True)
    return pairs.where(F.col("overlap") == F.least("n1", "n2")).select(
        "set1", "set2", "n1", "n2", "overlap"
    )


def _similar(family: str, bound: float):
    @entry(
        f"similar_collections_{family}",
        pairs_sql(family)
        + f""" SELECT set1, set2, name1, name2, round(jaccard, 6) AS similarity,
    copies1 * copies2 AS pairs FROM p WHERE jaccard >= {bound}
UNION ALL SELECT set1, set2, a.name, b.name, 1.0::DOUBLE, 1 FROM cp
  JOIN nm a ON set1 = a.set_id JOIN nm b ON set2 = b.set_id""",
        (family,),
    )
    def query(v):
        return r6(overlap.similar_collections(*family_of(v, family), threshold=bound, stored=family in STORED), "similarity")


_similar("order_part", 0.3)
_similar("nation_part", 0.3)


@entry(
    "neighbours",
    f"""WITH nm AS ({NAMES['customer_day']}), n AS (SELECT set_id, count(*) AS n FROM customer_day GROUP BY 1),
x AS (SELECT b.set_id, count(*) AS overlap FROM customer_day a JOIN customer_day b ON a.item_id = b.item_id AND b.set_id <> 7
      WHERE a.set_id = 7 GROUP BY 1),
s AS (SELECT set_id, name, overlap, n AS n_items, overlap / (n + (SELECT n FROM n WHERE set_id = 7) - overlap) AS similarity
      FROM x JOIN n USING (set_id) JOIN nm USING (set_id))
SELECT set_id, name, overlap, n_items, round(similarity, 6) AS similarity FROM s WHERE similarity >= 0.3""",
    ("customer_day",),
)
def neighbours(v):
    return r6(overlap.neighbours(*family_of(v, "customer_day"), 7, 0.3), "similarity")


def _merge(family: str, size: int):
    @entry(
        f"merge_candidates_{family}",
        pairs_sql(family, min_size=size)
        + """, r AS (SELECT set1, set2, name1, name2, jaccard AS s, overlap, union_size AS unique_tracks, n1 AS size1, n2 AS size2
     FROM p WHERE jaccard >= 0.5
  UNION ALL SELECT set1, set2, a.name, b.name, 1.0, n, n, n, n FROM cp
     JOIN nm a ON set1 = a.set_id JOIN nm b ON set2 = b.set_id)
SELECT set1, set2, name1, name2, round(CAST(s AS DOUBLE), 2) AS similarity, overlap, unique_tracks, size1, size2,
  'Would combine ' || size1 || ' + ' || size2 || ' = ' || unique_tracks || ' unique tracks' AS merge_benefit FROM r""",
        (family,),
    )
    def query(v):
        return overlap.merge_candidates(*family_of(v, family), size_threshold=size)


_merge("user_hour", 20)
_merge("nation_part", 20)


@entry(
    "duplicate_collections",
    """
WITH sig AS (SELECT set_id, 'Order ' || set_id AS name, list(item_id ORDER BY item_id) AS sig, count(*) AS n_items
             FROM order_part GROUP BY 1),
g AS (SELECT set_id, name, n_items, first_value(set_id) OVER (PARTITION BY sig ORDER BY name, set_id) AS kept_id,
        count(*) OVER (PARTITION BY sig) AS copies FROM sig)
SELECT *, set_id = kept_id AS keep FROM g WHERE copies > 1""",
    ("order_part",),
)
def duplicate_collections(v):
    return overlap.duplicate_collections(*family_of(v, "order_part"))


LONGEST = "-length(name)"
BANDS_SQL = """, c AS (SELECT *, CASE WHEN jaccard > 0.7 THEN 'high' WHEN jaccard > 0.5 THEN 'near'
    WHEN jaccard > 0.4 THEN 'similar' END AS band,
  overlap = least(n1, n2) AS is_subset,
  greatest(n1, n2) >= 3 * least(n1, n2) AND overlap / least(n1, n2) > 0.5 AS is_candidate FROM p)"""


def banded(found: redundancy.Redundancy):
    pairs = found.pairs.select(
        "set1", "set2", "n1", "n2", "overlap", rounded("jaccard", 6).alias("jaccard"), "band",
        "is_subset", "is_candidate", "copies1", "copies2",
    )
    n, one = F.col("n_items"), F.lit(1).cast("bigint")
    exact = found.copies.select(
        "set1", "set2", n, n, n, F.lit(1.0), F.lit("exact"), F.lit(False), F.lit(False), one, one
    )
    return pairs.union(exact)


BANDED_SQL = (
    BANDS_SQL
    + """ SELECT set1, set2, n1, n2, overlap, round(jaccard, 6) AS jaccard, band, is_subset, is_candidate, copies1, copies2
FROM c WHERE band IS NOT NULL OR is_subset OR is_candidate
UNION ALL SELECT set1, set2, n, n, n, 1.0::DOUBLE, 'exact', false, false, 1, 1 FROM cp"""
)


def _bands(family: str):
    @entry(f"redundancy_bands_{family}", pairs_sql(family, LONGEST) + BANDED_SQL, (family,))
    def query(v):
        return banded(redundancy.find_redundancy(*family_of(v, family), stored=family in STORED))


for _family in NAMES:
    _bands(_family)


@entry(
    "redundancy_bands_owned",
    pairs_sql("order_part", LONGEST).replace(
        NAMES["order_part"], NAMES["order_part"] + " WHERE o_orderstatus <> 'P'"
    )
    + BANDED_SQL,
    ("order_part",),
)
def redundancy_bands_owned(v):
    """Only owned collections without an automatic name are compared."""
    compared = redundancy.comparable(v.order_playlists())
    names = compared.select(F.col("playlist_id").alias("set_id"), "name")
    return banded(redundancy.find_redundancy(v.overlap_sets("order_part"), names, stored=True))


def suggestions_sql(family: str) -> str:
    """The sequential pass over ordered pairs, one recursion step per pair."""
    return (
        "WITH RECURSIVE "
        + pairs_sql(family, LONGEST)[5:]
        + BANDS_SQL
        + """,
d1 AS (SELECT set2 AS loser, set1 AS keeper, 1 AS phase, 0 AS lost, n AS ln, n AS kn, 1.0 AS jaccard FROM cp),
sub AS (SELECT CASE WHEN n1 < n2 THEN set1 ELSE set2 END AS loser, CASE WHEN n1 < n2 THEN set2 ELSE set1 END AS keeper,
    least(n1, n2) AS ln, greatest(n1, n2) AS kn, jaccard,
    row_number() OVER (PARTITION BY CASE WHEN n1 < n2 THEN set1 ELSE set2 END ORDER BY set1, set2) AS k
  FROM c WHERE is_subset),
d2 AS (SELECT loser, keeper, 2 AS phase, 0 AS lost, ln, kn, jaccard FROM sub WHERE k = 1),
hp AS (SELECT row_number() OVER (ORDER BY md5('42:' || set1 || ':' || set2)) AS i, set1, set2,
    CASE WHEN n1 > n2 THEN set2 ELSE set1 END AS loser, CASE WHEN n1 > n2 THEN set1 ELSE set2 END AS keeper,
    least(n1, n2) - overlap AS lost, least(n1, n2) AS ln, greatest(n1, n2) AS kn, jaccard
  FROM c WHERE band = 'high' AND set1 NOT IN (SELECT loser FROM d2) AND set2 NOT IN (SELECT loser FROM d2)),
walk(i, gone) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL SELECT hp.i, CASE WHEN list_contains(gone, hp.set1) OR list_contains(gone, hp.set2) THEN gone
      ELSE list_append(gone, hp.loser) END FROM walk JOIN hp ON hp.i = walk.i + 1),
d3 AS (SELECT hp.loser, hp.keeper, 3 AS phase, hp.lost, ln, kn, jaccard FROM walk w JOIN hp ON hp.i = w.i + 1
  WHERE NOT list_contains(gone, hp.set1) AND NOT list_contains(gone, hp.set2)),
cand AS (SELECT CASE WHEN n1 < n2 THEN set1 ELSE set2 END AS loser, CASE WHEN n1 < n2 THEN set2 ELSE set1 END AS keeper,
    least(n1, n2) - overlap AS lost, least(n1, n2) AS ln, greatest(n1, n2) AS kn, jaccard, set1, set2 FROM c WHERE is_candidate),
d5 AS (SELECT loser, keeper, 5 AS phase, lost, ln, kn, jaccard FROM (SELECT *, row_number() OVER (PARTITION BY loser ORDER BY set1, set2) AS k
  FROM cand WHERE loser NOT IN (SELECT loser FROM d2) AND loser NOT IN (SELECT loser FROM d3)) WHERE k = 1),
alld AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2 UNION ALL SELECT * FROM d3 UNION ALL SELECT * FROM d5)"""
    )


def suggestions_of(v, family):
    found = redundancy.find_redundancy(*family_of(v, family), stored=family in STORED)
    return found, redundancy.consolidation_suggestions(found)


def _suggestions(family: str):
    @entry(
        f"consolidation_suggestions_{family}",
        suggestions_sql(family)
        + """ SELECT phase, CASE WHEN phase <= 2 THEN 'delete' ELSE 'merge' END AS action, loser AS set_id,
  nm.name, keeper AS target_id, kp.name AS target_name, lost AS tracks_lost,
  keeper IN (SELECT loser FROM alld) AS target_also_removed,
  CASE phase WHEN 1 THEN 'Exact duplicate of ' WHEN 2 THEN 'All ' || ln || ' tracks are in '
    WHEN 3 THEN printf('%.1f', jaccard * 100) || '% similar, ' || printf('%.1f', (ln - lost) / ln * 100) || '% of tracks already in '
    ELSE 'Small playlist (' || ln || ' tracks) with ' || printf('%.1f', (ln - lost) / ln * 100) || '% overlap in larger ' END
    || '"' || kp.name || '"' || CASE WHEN phase IN (2, 5) THEN ' (' || kn || ' tracks)' ELSE '' END AS reason
FROM alld JOIN nm ON loser = nm.set_id JOIN nm kp ON keeper = kp.set_id""",
        (family,),
    )
    def query(v):
        return suggestions_of(v, family)[1]


for _family in NAMES:
    _suggestions(_family)


@entry(
    "consolidation_strategies",
    suggestions_sql("nation_part")
    + """,
s AS (SELECT * FROM c WHERE band = 'similar' AND set1 NOT IN (SELECT loser FROM alld)
        AND set2 NOT IN (SELECT loser FROM alld)),
t AS (SELECT *, CASE WHEN n2 >= 2 * n1 AND containment1 > 0.6 THEN 'second' WHEN n1 >= 2 * n2 AND containment2 > 0.6 THEN 'first'
   WHEN abs(n1 - n2) / greatest(n1, n2) < 0.3 AND jaccard > 0.45 THEN 'combine' ELSE 'review' END AS k FROM s)
SELECT set1, set2, name1, name2, n1, n2, round(jaccard, 6) AS jaccard, n1 - overlap AS missing_1_to_2,
  n2 - overlap AS missing_2_to_1,
  CASE WHEN k IN ('first', 'second') THEN 'merge_into_larger' ELSE k END AS strategy,
  CASE k WHEN 'second' THEN 'Merge ''' || name1 || ''' into ''' || name2 || ''''
    WHEN 'first' THEN 'Merge ''' || name2 || ''' into ''' || name1 || ''''
    WHEN 'combine' THEN 'Create combined playlist with tracks from both ''' || name1 || ''' and ''' || name2 || ''''
    ELSE 'Review for potential consolidation: ''' || name1 || ''' and ''' || name2 || '''' END AS recommended_action,
  CASE k WHEN 'second' THEN n1 - overlap WHEN 'first' THEN n2 - overlap
    WHEN 'combine' THEN n1 + n2 - 2 * overlap ELSE least(n1, n2) - overlap END AS tracks_to_add,
  CASE WHEN k = 'combine' THEN n1 + n2 - overlap END AS unique_combined,
  CASE k WHEN 'second' THEN CASE WHEN containment1 > 0.7 THEN 'High' ELSE 'Medium' END
    WHEN 'first' THEN CASE WHEN containment2 > 0.7 THEN 'High' ELSE 'Medium' END
    WHEN 'combine' THEN 'Medium' ELSE 'Low' END AS confidence FROM t""",
    ("nation_part",),
)
def consolidation_strategies(v):
    found, suggestions = suggestions_of(v, "nation_part")
    return r6(redundancy.consolidation_strategies(found, suggestions), "jaccard")
