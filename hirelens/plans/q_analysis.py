"""Registered queries: analysis operators."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens.operators import taxonomy as TX
from hirelens.plans import analysis as AN
from hirelens.plans.base import clean_postings, clean_with_counts, lookup, r6, skills_long
from hirelens.plans.registry import VIEWS, register, with_views
from hirelens.sources import fixtures as fx

DS = AN.DS
MLE, AIE = "ML Engineer", "AI Engineer"
S0, S1, S2 = fx.SNAPSHOTS
SINGLE = fx.SINGLE_SOURCE
GENAI = "genai"
BIASED = fx._sql_str(fx.BIASED_SOURCE)
ROLES = ["Data Scientist", "ML Engineer", "Applied Scientist", "Analytics Engineer",
         "Data Analyst", "AI Engineer", "Data Engineer", "Research Scientist"]


def _lbl(role, snap):
    return f"{role}@{snap}"


# ---- SQL views for the analysis twins ------------------------------------------------
_GRID = ", ".join(f"count(DISTINCT posting_id) FILTER (WHERE snapshot = {s}) AS n_{i}" for i, s in enumerate(fx.SNAPSHOTS))
_TOTS = ", ".join(f"(SELECT count(*) FROM ds_clean WHERE snapshot = {s}) AS tot_{i}" for i, s in enumerate(fx.SNAPSHOTS))
_PS = ", ".join(f"CASE WHEN tot_{i} > 0 THEN n_{i} / tot_{i} ELSE 0.0 END AS p_{i}" for i in range(3))
VIEWS.update({
    "ds_clean": (["clean"], f"ds_clean AS (SELECT * FROM clean WHERE canonical_title = '{DS}')"),
    "ds_skills": (["skills"], f"ds_skills AS (SELECT * FROM skills WHERE canonical_title = '{DS}')"),
    "ds_grid": (["ds_clean", "ds_skills"], f"""
ds_grid AS (SELECT *, {_PS} FROM (SELECT skill, {_GRID}, {_TOTS} FROM ds_skills GROUP BY skill))"""),
    "ds_working": (["ds_grid"], "ds_working AS (SELECT * FROM ds_grid WHERE greatest(p_0, p_1, p_2) > 0.05)"),
    "ds_trend": (["ds_working"], """
ds_trend AS (SELECT *, CASE WHEN p_0 = p_1 AND p_1 = p_2 THEN 'flat'
                            WHEN p_0 <= p_1 AND p_1 <= p_2 THEN 'increasing'
                            WHEN p_0 >= p_1 AND p_1 >= p_2 THEN 'decreasing'
                            ELSE 'non_monotone' END AS direction FROM ds_working)"""),
    "prof_all": (["clean", "skills"], """
prof_all AS (
  SELECT s.canonical_title || '@' || CAST(s.snapshot AS VARCHAR) AS profile, s.skill,
         count(DISTINCT s.posting_id) / max(t.N) AS p
  FROM skills s JOIN (SELECT canonical_title, snapshot, count(*) AS N FROM clean GROUP BY canonical_title, snapshot) t
    ON s.canonical_title = t.canonical_title AND s.snapshot = t.snapshot
  GROUP BY s.canonical_title, s.snapshot, s.skill)"""),
    "slice_clean": (["clean"], f"slice_clean AS (SELECT * FROM clean WHERE source = '{SINGLE}' AND snapshot = {S2})"),
    "slice_skills": (["skills"], f"slice_skills AS (SELECT * FROM skills WHERE source = '{SINGLE}' AND snapshot = {S2})"),
    "prof_slice": (["slice_clean", "slice_skills"], """
prof_slice AS (
  SELECT s.canonical_title AS profile, s.skill, count(DISTINCT s.posting_id) / max(t.N) AS p
  FROM slice_skills s JOIN (SELECT canonical_title, count(*) AS N FROM slice_clean GROUP BY canonical_title) t
    ON s.canonical_title = t.canonical_title
  GROUP BY s.canonical_title, s.skill)"""),
})


def _cos_sql(prof: str, pairs: list[tuple[str, str]]) -> str:
    vals = ", ".join(f"('{a}', '{b}')" for a, b in pairs)
    return f"""
SELECT pr.a AS profile_a, pr.b AS profile_b,
       round(CASE WHEN na.n * nb.n > 0 THEN coalesce(d.dot, 0) / (na.n * nb.n) END, 6) AS cosine
FROM (VALUES {vals}) pr(a, b)
LEFT JOIN (SELECT x.profile AS a, y.profile AS b, sum(x.p * y.p) AS dot FROM {prof} x JOIN {prof} y ON x.skill = y.skill
           GROUP BY x.profile, y.profile) d ON d.a = pr.a AND d.b = pr.b
LEFT JOIN (SELECT profile, sqrt(sum(p * p)) AS n FROM {prof} GROUP BY profile) na ON na.profile = pr.a
LEFT JOIN (SELECT profile, sqrt(sum(p * p)) AS n FROM {prof} GROUP BY profile) nb ON nb.profile = pr.b"""


# ---- building blocks -------------------------------------------------------------------
def _ds(spark, sf):
    c = clean_postings(spark, sf)
    s = skills_long(spark, sf)
    return c.filter(F.col("canonical_title") == DS), s.filter(F.col("canonical_title") == DS)


def _grid(spark, sf):
    c, s = _ds(spark, sf)
    return AN.snapshot_grid(c, s, fx.SNAPSHOTS)


def _working(spark, sf):
    return AN.working_skills(_grid(spark, sf), 3)


def _slice(spark, sf):
    c = clean_postings(spark, sf).filter((F.col("source") == SINGLE) & (F.col("snapshot") == S2))
    s = skills_long(spark, sf).filter((F.col("source") == SINGLE) & (F.col("snapshot") == S2))
    return c, s


def _profiles_all(spark, sf):
    c = clean_postings(spark, sf)
    s = skills_long(spark, sf)
    lbl = F.concat("canonical_title", F.lit("@"), F.col("snapshot").cast("string"))
    return AN.profiles(c, s, lbl)


# ---- queries ---------------------------------------------------------------------------
@register("role_composition", with_views("clean", body=f"""
SELECT snapshot, canonical_title, n_raw, round(n_raw / sum(n_raw) OVER (PARTITION BY snapshot), 6) AS share_raw,
       n_adjusted,
       round(CASE WHEN sum(n_adjusted) OVER (PARTITION BY snapshot) > 0
                  THEN n_adjusted / sum(n_adjusted) OVER (PARTITION BY snapshot) END, 6) AS share_adjusted,
       round(100 * (n_raw / sum(n_raw) OVER (PARTITION BY snapshot)
             - CASE WHEN sum(n_adjusted) OVER (PARTITION BY snapshot) > 0
                    THEN n_adjusted / sum(n_adjusted) OVER (PARTITION BY snapshot) END), 6) AS gap_pp
FROM (SELECT snapshot, canonical_title, count(*) AS n_raw,
             count(*) FILTER (WHERE source <> {BIASED}) AS n_adjusted
      FROM clean WHERE snapshot IS NOT NULL GROUP BY snapshot, canonical_title)"""))
def role_composition(spark, sf):
    """N-G: role share per snapshot, raw (all sources) and adjusted (biased source excluded), and the gap."""
    return AN.role_composition(clean_postings(spark, sf), biased_source=fx.BIASED_SOURCE)


@register("role_share_change", with_views("clean", body=f"""
SELECT canonical_title, n_first, n_last,
       round(n_first / (SELECT count(*) FROM clean WHERE snapshot = {S0}), 6) AS share_first,
       round(n_last / (SELECT count(*) FROM clean WHERE snapshot = {S2}), 6) AS share_last,
       round(100 * (n_last / (SELECT count(*) FROM clean WHERE snapshot = {S2})
                  - n_first / (SELECT count(*) FROM clean WHERE snapshot = {S0})), 6) AS change_pp
FROM (SELECT canonical_title, count(*) FILTER (WHERE snapshot = {S0}) AS n_first,
             count(*) FILTER (WHERE snapshot = {S2}) AS n_last
      FROM clean WHERE snapshot IN ({S0}, {S2}) GROUP BY canonical_title)"""))
def role_share_change(spark, sf):
    """N-G2: role-share change (pp) between the first and last snapshot."""
    return AN.role_share_change(clean_postings(spark, sf), S0, S2)


@register("snapshot_counts", with_views("clean", body="SELECT snapshot, count(*) AS n FROM clean GROUP BY snapshot"))
def snapshot_counts(spark, sf):
    """Clean postings per snapshot (2000 folds into 2001)."""
    return clean_postings(spark, sf).groupBy("snapshot").agg(F.count(F.lit(1)).alias("n"))


@register("skill_prevalence", with_views("ds_clean", "ds_skills", body="""
SELECT s.snapshot, s.skill, s.n_mentions, t.n_postings, round(s.n_mentions / t.n_postings, 6) AS prevalence
FROM (SELECT snapshot, skill, count(DISTINCT posting_id) AS n_mentions FROM ds_skills GROUP BY snapshot, skill) s
JOIN (SELECT snapshot, count(*) AS n_postings FROM ds_clean GROUP BY snapshot) t ON s.snapshot = t.snapshot"""))
def skill_prevalence(spark, sf):
    """N-A: Data Scientist skill prevalence per snapshot (zero-skill postings in the denominator)."""
    c, s = _ds(spark, sf)
    return AN.prevalence(c, s, ["snapshot"])


@register("prevalence_by_role", with_views("clean", "skills", body="""
SELECT s.canonical_title, s.snapshot, s.skill, s.n_mentions, t.n_postings,
       round(s.n_mentions / t.n_postings, 6) AS prevalence
FROM (SELECT canonical_title, snapshot, skill, count(DISTINCT posting_id) AS n_mentions FROM skills
      GROUP BY canonical_title, snapshot, skill) s
JOIN (SELECT canonical_title, snapshot, count(*) AS n_postings FROM clean GROUP BY canonical_title, snapshot) t
  ON s.canonical_title = t.canonical_title AND s.snapshot = t.snapshot"""))
def prevalence_by_role(spark, sf):
    """N-A2: prevalence per (role, snapshot, skill)."""
    return AN.prevalence(clean_postings(spark, sf), skills_long(spark, sf), ["canonical_title", "snapshot"])


@register("working_skills", with_views("ds_working", body="""
SELECT skill, round(greatest(p_0, p_1, p_2), 6) AS max_prevalence FROM ds_working"""))
def working_skills(spark, sf):
    """DS skills above 5 % in at least one snapshot."""
    return _working(spark, sf).select("skill", r6("max_prevalence").alias("max_prevalence"))


_Z = 1.959963984540054


def _wilson_sql(k, n):
    p = f"({k} * 1.0 / {n})"
    z2 = _Z * _Z
    centre = f"(({p} + {z2} / (2.0 * {n})) / (1.0 + {z2} / {n}))"
    half = f"(({_Z} / (1.0 + {z2} / {n})) * sqrt({p} * (1.0 - {p}) / {n} + {z2} / (4.0 * {n} * {n})))"
    return (f"round(CASE WHEN {n} > 0 THEN {centre} - {half} END, 6)",
            f"round(CASE WHEN {n} > 0 THEN {centre} + {half} END, 6)")


_LO, _HI = _wilson_sql("c.n", "c.tot")


@register("wilson_ci", with_views("ds_grid", body=f"""
SELECT g.skill, c.snapshot, c.n AS n_mentions, c.tot AS n_postings,
       round(CASE WHEN c.tot > 0 THEN c.n / c.tot END, 6) AS prevalence, {_LO} AS ci_low, {_HI} AS ci_high,
       g.n_0 < 15 AS directional_only, g.n_0 < 30 AS footnote, g.p_0 > 0.30 AS confident
FROM ds_grid g, LATERAL (VALUES ({S0}, g.n_0, g.tot_0), ({S1}, g.n_1, g.tot_1), ({S2}, g.n_2, g.tot_2)) c(snapshot, n, tot)"""))
def wilson_ci(spark, sf):
    """N-B: Wilson 95 % interval for every (DS skill, snapshot), zero-filled, with small-n flags."""
    return AN.wilson_long(_grid(spark, sf), fx.SNAPSHOTS)


@register("trend_consistency", with_views("ds_trend", body="""
SELECT skill, round(p_0, 6) AS p_first, round(p_1, 6) AS p_middle, round(p_2, 6) AS p_last, direction,
       direction <> 'non_monotone' AS consistent FROM ds_trend"""))
def trend_consistency(spark, sf):
    """N-C: the middle snapshot as a directional-consistency gate (working skills)."""
    return AN.trend_table(_working(spark, sf))


@register("narratives", with_views("ds_trend", body="""
SELECT skill, narrative, round(100 * (p_2 - p_0), 6) AS change_pp, round(p_0, 6) AS p_first, round(p_2, 6) AS p_last,
       p_0 > 0.10 AND p_2 > 0.10 AS claimable
FROM (
  SELECT *, 'rise' AS narrative FROM ds_trend WHERE p_2 - p_0 >= 0.08 AND p_2 > 0.05 AND direction <> 'non_monotone'
  UNION ALL
  SELECT *, 'core' FROM ds_trend WHERE greatest(p_0, p_1, p_2) - least(p_0, p_1, p_2) < 0.05
     AND least(p_0, p_1, p_2) > 0.20 AND n_0 > 0 AND n_1 > 0 AND n_2 > 0
  UNION ALL
  SELECT *, 'decline' FROM ds_trend WHERE p_2 - p_0 <= -0.08 AND p_0 > 0.05 AND direction <> 'non_monotone'
  UNION ALL
  SELECT *, 'surprising' FROM ds_trend WHERE p_2 - p_0 >= 0.05 AND p_2 - p_0 <= 0.10 AND n_0 >= 15 AND n_2 >= 25)"""))
def narratives(spark, sf):
    """N-D: rise / core / decline / surprising (not exclusive), with the claimable flag."""
    return AN.narratives(_working(spark, sf))


@register("denominator_sensitivity", with_views("ds_clean", "ds_skills", "clean_n", body="""
SELECT s.snapshot, s.skill, s.n_mentions, round(s.n_mentions / t.n_all, 6) AS prevalence_all,
       round(s.n_mentions / t.n_nonzero, 6) AS prevalence_nonzero,
       round(100 * (s.n_mentions / t.n_nonzero - s.n_mentions / t.n_all), 6) AS diff_pp,
       100 * (s.n_mentions / t.n_nonzero - s.n_mentions / t.n_all) > 2.0 AS diverges
FROM (SELECT snapshot, skill, count(DISTINCT posting_id) AS n_mentions FROM ds_skills GROUP BY snapshot, skill) s
JOIN (SELECT snapshot, count(*) AS n_all, count(*) FILTER (WHERE n_skills > 0) AS n_nonzero FROM clean_n
      WHERE canonical_title = 'Data Scientist' GROUP BY snapshot) t ON s.snapshot = t.snapshot"""))
def denominator_sensitivity(spark, sf):
    """M2: DS prevalence with / without zero-skill postings; flag > 2 pp."""
    c = clean_with_counts(spark, sf).filter(F.col("canonical_title") == DS)
    _, s = _ds(spark, sf)
    return AN.denominator_sensitivity(c, s)


@register("category_prevalence", with_views("ds_clean", "ds_skills", "categories", body="""
SELECT s.snapshot, s.category, s.n_with, t.n_postings, round(s.n_with / t.n_postings, 6) AS prevalence
FROM (SELECT k.snapshot, coalesce(c.category, 'unclassified') AS category, count(DISTINCT k.posting_id) AS n_with
      FROM ds_skills k LEFT JOIN categories c ON c.canonical_name = k.skill GROUP BY 1, 2) s
JOIN (SELECT snapshot, count(*) AS n_postings FROM ds_clean GROUP BY snapshot) t ON s.snapshot = t.snapshot"""))
def category_prevalence(spark, sf):
    """N-E: share of DS postings with >= 1 skill of each category, per snapshot."""
    c, s = _ds(spark, sf)
    cs = TX.category_join(s, fx.categories(spark, sf))
    g = cs.groupBy("snapshot", "category").agg(F.count_distinct("posting_id").alias("n_with"))
    t = c.groupBy("snapshot").agg(F.count(F.lit(1)).alias("n_postings"))
    return g.join(t, "snapshot").select("snapshot", "category", "n_with", "n_postings",
                                        r6(F.col("n_with") / F.col("n_postings")).alias("prevalence"))


_EVOLUTION = [(_lbl(DS, S0), _lbl(DS, S2)), (_lbl(DS, S2), _lbl(MLE, S2)), (_lbl(DS, S2), _lbl(AIE, S2))]


@register("profile_evolution", with_views("prof_all", body=_cos_sql("prof_all", _EVOLUTION)))
def profile_evolution(spark, sf):
    """N-F: DS first vs DS last; DS last vs ML / AI Engineer last (cosine of prevalence vectors)."""
    names = sorted({x for p in _EVOLUTION for x in p})
    return AN.cosine_matrix(_profiles_all(spark, sf), names, _EVOLUTION)


_ALL_PAIRS = [(a, b) for a in ROLES for b in ROLES]


@register("role_similarity", with_views("prof_slice", body=_cos_sql("prof_slice", _ALL_PAIRS)))
def role_similarity(spark, sf):
    """N-H: 8 x 8 role cosine matrix, last snapshot, single source."""
    c, s = _slice(spark, sf)
    prof = AN.profiles(c, s, F.col("canonical_title"))
    return AN.cosine_matrix(prof, ROLES, _ALL_PAIRS)


@register("similarity_drivers", with_views("prof_slice", body=f"""
SELECT other, driver_rank, skill, contribution FROM (
  SELECT b.profile AS other, b.skill, round(b.p * a.p / (nb.n * na.n), 6) AS contribution,
         row_number() OVER (PARTITION BY b.profile ORDER BY b.p * a.p / (nb.n * na.n) DESC, b.skill) AS driver_rank
  FROM prof_slice b
  JOIN prof_slice a ON a.skill = b.skill AND a.profile = '{DS}'
  JOIN (SELECT profile, sqrt(sum(p * p)) AS n FROM prof_slice GROUP BY profile) nb ON nb.profile = b.profile
  JOIN (SELECT profile, sqrt(sum(p * p)) AS n FROM prof_slice GROUP BY profile) na ON na.profile = '{DS}'
  WHERE b.profile <> '{DS}') WHERE driver_rank <= 5"""))
def similarity_drivers(spark, sf):
    """N-H drivers: top-5 skills behind DS's cosine with each other role (last snapshot, single source)."""
    c, s = _slice(spark, sf)
    prof = AN.profiles(c, s, F.col("canonical_title"))
    return AN.similarity_drivers(prof, DS, 5).withColumnRenamed("rank", "driver_rank")


@register("category_ownership", with_views("slice_clean", "slice_skills", "categories", body=f"""
SELECT canonical_title, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM slice_clean c WHERE EXISTS (SELECT 1 FROM slice_skills k JOIN categories g ON g.canonical_name = k.skill
                                 WHERE k.posting_id = c.posting_id AND g.category = '{GENAI}')
GROUP BY canonical_title"""))
def category_ownership(spark, sf):
    """N-I: among last-snapshot single-source postings with >= 1 genai skill, share per role."""
    c, s = _slice(spark, sf)
    cs = TX.category_join(s, fx.categories(spark, sf))
    return AN.category_ownership(c, cs, GENAI)


@register("ownership_by_skill", with_views("slice_skills", "categories", body=f"""
SELECT skill, canonical_title, n, round(n / sum(n) OVER (PARTITION BY skill), 6) AS share
FROM (SELECT k.skill, k.canonical_title, count(DISTINCT k.posting_id) AS n
      FROM slice_skills k JOIN categories g ON g.canonical_name = k.skill AND g.category = '{GENAI}'
      GROUP BY k.skill, k.canonical_title)"""))
def ownership_by_skill(spark, sf):
    """N-I: genai skill x role concentration (last snapshot, single source)."""
    _, s = _slice(spark, sf)
    return AN.ownership_by_skill(TX.category_join(s, fx.categories(spark, sf)), GENAI)


@register("emergent_roles", with_views("clean", body=f"""
SELECT canonical_title, count(*) AS n_last FROM clean c WHERE snapshot = {S2}
  AND NOT EXISTS (SELECT 1 FROM clean f WHERE f.snapshot = {S0} AND f.canonical_title = c.canonical_title)
GROUP BY canonical_title"""))
def emergent_roles(spark, sf):
    """N-J: roles present in the last snapshot and absent from the first (anti join)."""
    c = clean_postings(spark, sf)
    first = c.filter(F.col("snapshot") == S0).select("canonical_title").distinct()
    last = c.filter(F.col("snapshot") == S2)
    return (last.join(first, "canonical_title", "left_anti").groupBy("canonical_title")
            .agg(F.count(F.lit(1)).alias("n_last")))


_EMERGENCE = [(_lbl(AIE, S2), _lbl(DS, S0)), (_lbl(AIE, S2), _lbl(DS, S2)), (_lbl(AIE, S2), _lbl(MLE, S2))]


@register("emergence_profile", with_views("prof_all", body=_cos_sql("prof_all", _EMERGENCE)))
def emergence_profile(spark, sf):
    """N-J: AI Engineer (last) vs DS first, DS last, ML Engineer last."""
    names = sorted({x for p in _EMERGENCE for x in p})
    return AN.cosine_matrix(_profiles_all(spark, sf), names, _EMERGENCE)


@register("distinctiveness", with_views("slice_clean", "slice_skills", body=f"""
SELECT skill, round(a, 6) AS anchor_prevalence, round(s / r, 6) AS mean_prevalence, round(a / (s / r), 6) AS ratio,
       CASE WHEN a / (s / r) > 2.0 THEN 'specific' WHEN a / (s / r) < 0.5 THEN 'under_represented' ELSE 'neutral' END AS label
FROM (SELECT m.skill, sum(m.n / t.N) AS s, sum(CASE WHEN m.canonical_title = '{DS}' THEN m.n / t.N ELSE 0.0 END) AS a,
             (SELECT count(DISTINCT canonical_title) FROM slice_clean) AS r
      FROM (SELECT canonical_title, skill, count(DISTINCT posting_id) AS n FROM slice_skills GROUP BY 1, 2) m
      JOIN (SELECT canonical_title, count(*) AS N FROM slice_clean GROUP BY 1) t ON t.canonical_title = m.canonical_title
      GROUP BY m.skill)"""))
def distinctiveness(spark, sf):
    """N-K: DS prevalence / mean prevalence over roles (last snapshot, single source)."""
    c, s = _slice(spark, sf)
    return AN.distinctiveness(c, s, DS)


@register("skill_breadth", with_views("clean_n", body=f"""
SELECT canonical_title, count(*) AS postings, quantile_cont(n_skills, 0.5) AS median_skills,
       round(avg(n_skills), 6) AS mean_skills
FROM clean_n WHERE source = '{SINGLE}' AND snapshot = {S2} GROUP BY canonical_title"""))
def skill_breadth(spark, sf):
    """N-L: median skills per posting by role (last snapshot, single source)."""
    c = clean_with_counts(spark, sf).filter((F.col("source") == SINGLE) & (F.col("snapshot") == S2))
    return AN.skill_breadth(c)


_LO2, _HI2 = _wilson_sql("w.n", "w.tot")


@register("chart_top_skills", with_views("ds_grid", body=f"""
SELECT t.skill, t.top_rank, w.snapshot, round(CASE WHEN w.tot > 0 THEN w.n / w.tot END, 6) AS prevalence,
       {_LO2} AS ci_low, {_HI2} AS ci_high
FROM (SELECT skill, row_number() OVER (ORDER BY greatest(p_0, p_1, p_2) DESC, skill) AS top_rank FROM ds_grid
      ORDER BY greatest(p_0, p_1, p_2) DESC, skill LIMIT 12) t
JOIN ds_grid g ON g.skill = t.skill,
LATERAL (VALUES ({S0}, g.n_0, g.tot_0), ({S1}, g.n_1, g.tot_1), ({S2}, g.n_2, g.tot_2)) w(snapshot, n, tot)"""))
def chart_top_skills(spark, sf, top: int = 12):
    """N-V1: the top skills by maximum prevalence, three snapshots each, with CI."""
    g = _grid(spark, sf).withColumn("_mx", F.greatest("p_0", "p_1", "p_2"))
    top_df = g.orderBy(F.desc("_mx"), "skill").limit(top)
    ranked = top_df.withColumn("top_rank", F.row_number().over(Window.orderBy(F.desc("_mx"), "skill")))
    w = AN.wilson_long(ranked, fx.SNAPSHOTS)
    return w.join(ranked.select("skill", "top_rank"), "skill").select(
        "skill", "top_rank", "snapshot", "prevalence", "ci_low", "ci_high")


_LO3, _HI3 = _wilson_sql("n_2", "tot_2")


@register("chart_movers", with_views("ds_working", body=f"""
SELECT * FROM (
  SELECT 'up' AS direction, row_number() OVER (ORDER BY p_2 - p_0 DESC, skill) AS mover_rank, skill,
         round(100 * (p_2 - p_0), 6) AS change_pp, n_0 AS n_first, n_2 AS n_last, {_LO3} AS ci_low_last,
         {_HI3} AS ci_high_last
  FROM ds_working ORDER BY p_2 - p_0 DESC, skill LIMIT 10)
UNION ALL
SELECT * FROM (
  SELECT 'down', row_number() OVER (ORDER BY p_2 - p_0 ASC, skill), skill, round(100 * (p_2 - p_0), 6), n_0, n_2,
         {_LO3}, {_HI3}
  FROM ds_working ORDER BY p_2 - p_0 ASC, skill LIMIT 10)"""))
def chart_movers(spark, sf, top: int = 10):
    """N-V2: top risers and fallers (first -> last snapshot) with n and CI."""
    from hirelens.functions.stats import wilson_bounds
    wk = _working(spark, sf).withColumn("_chg", F.col("p_2") - F.col("p_0"))
    lo, hi = wilson_bounds("n_2", "tot_2")
    outs = []
    for name, order in (("up", F.desc("_chg")), ("down", F.asc("_chg"))):
        t = wk.orderBy(order, "skill").limit(top)
        t = t.withColumn("mover_rank", F.row_number().over(Window.orderBy(order, "skill")))
        outs.append(t.select(F.lit(name).alias("direction"), "mover_rank", "skill",
                             r6(100 * F.col("_chg")).alias("change_pp"), F.col("n_0").alias("n_first"),
                             F.col("n_2").alias("n_last"), r6(lo).alias("ci_low_last"), r6(hi).alias("ci_high_last")))
    return outs[0].unionByName(outs[1])


@register("chart_quadrant", with_views("ds_trend", "categories", body="""
SELECT t.skill, round(t.p_0, 6) AS x_first, round(100 * (t.p_2 - t.p_0), 6) AS y_change_pp,
       coalesce(c.category, 'unclassified') AS category
FROM ds_trend t LEFT JOIN categories c ON c.canonical_name = t.skill WHERE t.direction <> 'non_monotone'"""))
def chart_quadrant(spark, sf):
    """N-V3: x = first-snapshot prevalence, y = change; gated (consistent) skills only."""
    t = AN.trend(_working(spark, sf)).filter(F.col("direction") != "non_monotone")
    t = TX.category_join(t, fx.categories(spark, sf))
    return t.select("skill", r6("p_0").alias("x_first"), r6(100 * (F.col("p_2") - F.col("p_0"))).alias("y_change_pp"),
                    "category")


@register("category_audit", with_views("extractions", "reverse_lookup", "categories", "clean", body=f"""
SELECT e.term, r.canonical, count(DISTINCT e.posting_id) AS n_postings
FROM extractions e JOIN reverse_lookup r ON r.alias_lower = lower(e.term)
JOIN categories g ON g.canonical_name = r.canonical AND g.category = '{GENAI}'
JOIN clean c ON c.posting_id = e.posting_id AND c.snapshot = {S0}
GROUP BY e.term, r.canonical"""))
def category_audit(spark, sf, category: str = GENAI):
    """N-Q: raw terms of a category seen in first-snapshot postings (suspicious early mentions)."""
    e = fx.extractions(spark, sf)
    lk = lookup(spark, sf)
    cats = fx.categories(spark, sf).filter(F.col("category") == category).select(
        F.col("canonical_name").alias("canonical"))
    first = clean_postings(spark, sf).filter(F.col("snapshot") == S0).select("posting_id")
    j = (e.join(lk, F.lower(e.term) == F.col("alias_lower")).join(cats, "canonical")
         .join(first, "posting_id"))
    return j.groupBy("term", "canonical").agg(F.count_distinct("posting_id").alias("n_postings"))


@register("length_regression", with_views("clean_n", body=f"""
SELECT CAST(sum(n) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS groups, round(sum(sxy) / sum(sxx), 6) AS slope,
       round(sqrt((sum(syy) - sum(sxy) / sum(sxx) * sum(sxy)) / (sum(n) - count(*) - 1) / sum(sxx)), 6) AS std_err,
       round((sum(sxy) / sum(sxx)) / sqrt((sum(syy) - sum(sxy) / sum(sxx) * sum(sxy)) / (sum(n) - count(*) - 1) / sum(sxx)), 6) AS t_stat,
       round(1 - (sum(syy) - sum(sxy) / sum(sxx) * sum(sxy)) / max(tss), 6) AS r_squared
FROM (SELECT source, count(*) AS n, count(*) * var_pop(x) AS sxx, count(*) * covar_pop(x, y) AS sxy,
             count(*) * var_pop(y) AS syy,
             (SELECT count(*) * var_pop(CAST(n_skills AS DOUBLE)) FROM clean_n
              WHERE canonical_title = '{DS}' AND length(description_text) > 0) AS tss
      FROM (SELECT source, ln(length(description_text)) AS x, CAST(n_skills AS DOUBLE) AS y FROM clean_n
            WHERE canonical_title = '{DS}' AND length(description_text) > 0) GROUP BY source)"""))
def length_regression(spark, sf):
    """M1: n_skills ~ log(description length) + C(source) for DS postings (closed-form OLS)."""
    c = clean_with_counts(spark, sf, with_text=True).filter(F.col("canonical_title") == DS)
    c = c.withColumn("desc_len", F.char_length("description_text"))
    return AN.length_regression(c)
