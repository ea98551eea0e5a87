"""Registered queries: fuzzy name pairs, review band, greedy clusters, collision resolution.

The names are the canonical candidates a normalisation pass would produce from
the data: the case-folded part names plus the case-folded vocabulary of the
document texts (whole texts), each with its original spellings as synonyms.
The workload therefore grows with the tables. The SQL twins find pairs by deletion
variants alone, at every length (no prefix join, no LCS), and the representatives by
rounds over names whose earlier neighbours are all decided.
"""
from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.operators import fuzzy as FZ
from hirelens.plans.base import persisted
from hirelens.plans.registry import register
from hirelens.sources import fixtures as fx


def _sql_pairs(threshold: int) -> str:
    """CTEs up to ``pairs`` (a < b by id; ids follow the order of names): a common subsequence is a
    variant of both names, and the fewest deletions over the shared ones are the indel distance."""
    t, d = f"{threshold}.0", f"{100 - threshold}.0"
    return f"""
WITH RECURSIVE synonyms AS MATERIALIZED (
  SELECT DISTINCT lower(synonym) AS name, synonym FROM (
    SELECT unnest(regexp_extract_all(text, '\\p{{L}}+')) AS synonym FROM documents
    UNION ALL SELECT p_name FROM part) WHERE synonym IS NOT NULL),
names AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY name) AS id, name,
         array_to_string(list_sort(regexp_split_to_array(trim(name), '\\s+')), ' ') AS key
  FROM (SELECT DISTINCT name FROM synonyms)),
variants AS (
  SELECT id, key AS v, 0 AS k, 1 AS nxt,
         CAST(floor({d} * (length(key) + floor(length(key) * (200.0 - {t}) / {t} + 1e-9)) / 100.0 + 1e-9) AS INTEGER) AS tau
  FROM names
  UNION ALL
  SELECT id, substring(v, 1, i - 1) || substring(v, i + 1), k + 1, i, tau
  FROM (SELECT id, v, k, tau, CAST(unnest(range(nxt, length(v) + 1)) AS INTEGER) AS i FROM variants WHERE k < tau)),
shared AS MATERIALIZED (
  SELECT DISTINCT id, v, k, CAST(floor(2.0 * length(v) * {d} / {t} + 1e-9) AS INTEGER) AS most FROM variants
  WHERE 2.0 * length(v) * {d} / {t} + 1e-9 >= k),
pairs AS MATERIALIZED (
  SELECT a, b, name_a, name_b, round(100.0 * (size - indel) / size, 2) AS score
  FROM (SELECT p.a, p.b, x.name AS name_a, y.name AS name_b, length(x.key) + length(y.key) AS size, p.indel
        FROM (SELECT l.id AS a, r.id AS b, min(l.k + r.k) AS indel
              FROM shared l JOIN shared r ON l.v = r.v AND l.id < r.id AND l.k + r.k <= l.most GROUP BY l.id, r.id) p
        JOIN names x ON x.id = p.a JOIN names y ON y.id = p.b)
  WHERE 100.0 * (size - indel) >= {t} * size - 1e-9)"""


_SQL_CLUSTERS = _sql_pairs(92) + """,
decided AS (
  SELECT 0 AS round, id, 0 AS s FROM (SELECT a AS id FROM pairs UNION SELECT b FROM pairs)
  UNION ALL
  SELECT d.round + 1, d.id, CASE WHEN d.s > 0 THEN d.s WHEN m.rep THEN 2 WHEN coalesce(m.open, 0) = 0 THEN 1 ELSE 0 END
  FROM decided d LEFT JOIN (
    SELECT p.b, bool_or(e.s = 1) AS rep, count(*) FILTER (WHERE e.s = 0) AS open
    FROM pairs p JOIN decided e ON e.id = p.a GROUP BY p.b) m ON m.b = d.id
  WHERE (SELECT count(*) FROM decided WHERE s = 0) > 0),
reps AS (SELECT id FROM decided WHERE s = 1 AND round = (SELECT max(round) FROM decided)),
best AS (SELECT p.b AS id, min(p.a) AS rep FROM pairs p JOIN reps r ON r.id = p.a GROUP BY p.b),
clusters AS MATERIALIZED (
  SELECT n.id, n.name, coalesce(r.id, n.id) AS rep_id, coalesce(r.name, n.name) AS rep, b.rep IS NULL AS is_rep
  FROM names n LEFT JOIN best b ON b.id = n.id LEFT JOIN names r ON r.id = b.rep)"""


def name_synonyms(spark, sf):
    """(name, synonym): case-folded name and each original spelling. Every step of these queries reads
    it, so the texts are cut into words once and the table is persisted in the shared checkpoint folder."""
    words = fx.table(spark, sf, "documents").select(
        F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), 1)).alias("synonym"))
    parts = fx.table(spark, sf, "part").select(F.col("p_name").alias("synonym"))
    # spellings are made distinct before they are folded
    return persisted(spark, sf, "name_synonyms", lambda: words.unionByName(parts).distinct().select(
        F.lower("synonym").alias("name"), "synonym"))


def names(spark, sf):
    """(name, ord), persisted: the pairs, the clusters and their winners read it."""
    return persisted(spark, sf, "names", lambda: name_synonyms(spark, sf).select("name").distinct()).withColumn(
        "ord", F.col("name"))


def _pairs(spark, sf):
    # the pair graph is reused by C2/C3: persisted once in the shared checkpoint folder
    return persisted(spark, sf, "fuzzy_pairs", lambda: FZ.fuzzy_pairs(names(spark, sf)))


@register("fuzzy_pairs", _sql_pairs(92) + " SELECT name_a, name_b, score FROM pairs")
def fuzzy_pairs(spark, sf):
    """Name pairs with token-sort ratio >= 92."""
    return FZ.fuzzy_pairs(names(spark, sf))


@register("fuzzy_band", _sql_pairs(85) + " SELECT name_a, name_b, score FROM pairs WHERE score < 92")
def fuzzy_band(spark, sf):
    """Pairs scoring in [85, 92) for manual review."""
    return FZ.fuzzy_band(names(spark, sf))


@register("fuzzy_clusters", _SQL_CLUSTERS + " SELECT name, rep, is_rep FROM clusters")
def fuzzy_clusters(spark, sf):
    """Greedy (non-transitive) star clusters over the >= 92 pair graph."""
    n = names(spark, sf)
    return FZ.greedy_clusters(n, _pairs(spark, sf))


@register("resolve_collisions", _SQL_CLUSTERS + """,
counted AS (SELECT name, count(*) AS n FROM synonyms GROUP BY name),
winners AS (
  SELECT c.rep_id, c.rep, c.name AS winner, count(*) OVER (PARTITION BY c.rep_id) AS n_members,
         row_number() OVER (PARTITION BY c.rep_id ORDER BY t.n DESC, CAST(c.is_rep AS INTEGER) DESC,
                            coalesce(p.score, 0) DESC, c.id) AS place
  FROM clusters c JOIN counted t ON t.name = c.name LEFT JOIN pairs p ON p.a = c.rep_id AND p.b = c.id),
merged AS (
  SELECT c.rep_id, array_to_string(list_sort(list(DISTINCT s.synonym)), '|') AS synonyms
  FROM clusters c JOIN synonyms s ON s.name = c.name GROUP BY c.rep_id)
SELECT w.rep, w.winner, w.n_members, m.synonyms FROM winners w JOIN merged m ON m.rep_id = w.rep_id
WHERE w.place = 1 AND w.n_members > 1""")
def resolve_collisions(spark, sf):
    """Winner per multi-member cluster and the merged synonym set."""
    n = names(spark, sf)
    p = _pairs(spark, sf)
    cl = FZ.greedy_clusters(n, p)
    out = FZ.resolve_collisions(cl, name_synonyms(spark, sf), p, n.select("name", "ord"), min_members=2)
    return out.select("rep", "winner", "n_members", F.array_join("synonyms", "|").alias("synonyms"))
