"""Registered queries: cleaning, tagging, filters, dedup and the pre-analysis diagnostics."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens.functions import rules
from hirelens.operators import clean as C
from hirelens.plans.base import clean_postings, final_postings, r6, tagged_postings, unified_postings
from hirelens.schema import FINAL_COLS
from hirelens.plans.registry import _in, register, sql_geo, sql_seniority, sql_title, with_views
from hirelens.sources import fixtures as fx

ROLE_LIST = _in(rules.DS_TITLES)
YEAR_LIST = _in(fx.VALID_YEARS)


def _raw(spark, sf):
    return fx.postings_raw(spark, sf, with_text=False).withColumn(
        "posting_id", F.concat("source", F.lit(":"), F.col("native_id").cast("string")))


@register("title_normalise", with_views("postings_raw", body=f"""
SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, raw_title,
       {sql_title('trim(raw_title)')} AS canonical_title
FROM postings_raw"""))
def title_normalise(spark, sf):
    """T1 over every raw posting."""
    r = _raw(spark, sf)
    return r.select("posting_id", "raw_title", rules.canonical_title(rules.unicode_trim("raw_title")).alias("canonical_title"))


@register("geo_tag", with_views("postings_raw", body=f"""
SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, location, {sql_geo('location')} AS geo
FROM postings_raw"""))
def geo_tag(spark, sf):
    """T2 over every raw posting."""
    r = _raw(spark, sf)
    return r.select("posting_id", "location", rules.geo_tag("location").alias("geo"))


@register("seniority", with_views("postings_raw", body=f"""
SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, raw_title, level_hint,
       {sql_seniority('trim(raw_title)', 'level_hint')} AS seniority
FROM postings_raw"""))
def seniority(spark, sf):
    """T3 over every raw posting (hint branch first)."""
    r = _raw(spark, sf)
    return r.select("posting_id", "raw_title", "level_hint",
                    rules.seniority(rules.unicode_trim("raw_title"), F.col("level_hint")).alias("seniority"))


@register("company_clean", with_views("postings_raw", body="""
SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, trim(split_part(company, chr(10), 1)) AS company
FROM postings_raw"""))
def company_clean(spark, sf):
    """T7 over every raw posting."""
    from hirelens.functions.text import company_clean as cc
    r = _raw(spark, sf)
    return r.select("posting_id", cc("company").alias("company"))


_FINAL_SQL_COLS = ("posting_id, source, date, year, quarter, canonical_title, raw_title, company, geo, seniority, "
                   "CAST(length(description_text) AS BIGINT) AS desc_chars, CAST(0 AS BIGINT) AS n_skills, ")


@register("finalise", with_views("tagged", body=f"""
SELECT {_FINAL_SQL_COLS} false AS is_duplicate FROM tagged"""))
def finalise_q(spark, sf):
    """Every posting in the unified schema (text as its length)."""
    t = tagged_postings(spark, sf, with_text=True)
    return t.select("posting_id", "source", "date", "year", "quarter", "canonical_title", "raw_title",
                    "company", "geo", "seniority", F.char_length("description_text").cast("long").alias("desc_chars"),
                    F.size("skills_present").cast("long").alias("n_skills"), "is_duplicate")


@register("filter_roles", with_views("tagged", body=f"""
SELECT posting_id, source, canonical_title FROM tagged WHERE canonical_title IN ({ROLE_LIST})"""))
def filter_roles(spark, sf):
    """F1."""
    return C.filter_roles(tagged_postings(spark, sf)).select("posting_id", "source", "canonical_title")


@register("filter_years", with_views("tagged", body=f"""
SELECT posting_id, source, year FROM tagged WHERE canonical_title IN ({ROLE_LIST}) AND year IN ({YEAR_LIST})"""))
def filter_years(spark, sf):
    """F1 + F2."""
    return C.filter_years(C.filter_roles(tagged_postings(spark, sf)), fx.VALID_YEARS).select("posting_id", "source", "year")


@register("anomalous_years", with_views("tagged", body=f"""
SELECT source, year, count(*) AS n FROM tagged
WHERE canonical_title IN ({ROLE_LIST}) AND NOT coalesce(year IN ({YEAR_LIST}), false)
GROUP BY source, year"""))
def anomalous_years(spark, sf):
    """rows outside the valid years, by source x year."""
    t = C.filter_roles(tagged_postings(spark, sf))
    return t.filter(C.anomalous_mask(fx.VALID_YEARS)).groupBy("source", "year").agg(F.count(F.lit(1)).alias("n"))


@register("filter_geo", with_views("tagged", body=f"""
SELECT posting_id, source, geo FROM tagged
WHERE canonical_title IN ({ROLE_LIST}) AND year IN ({YEAR_LIST}) AND geo = 'US'"""))
def filter_geo(spark, sf):
    """F1 + F2 + F5."""
    t = C.filter_geo(C.filter_years(C.filter_roles(tagged_postings(spark, sf)), fx.VALID_YEARS))
    return t.select("posting_id", "source", "geo")


@register("union_sources", with_views("postings_raw", body=f"""
SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, source,
       CASE WHEN source = {fx._sql_str(fx.HINT_SOURCE)} THEN {sql_seniority('trim(raw_title)', 'level_hint')}
            ELSE {sql_seniority('trim(raw_title)', None)} END AS seniority
FROM postings_raw WHERE {sql_title('trim(raw_title)')} IN ({ROLE_LIST})"""))
def union_sources(spark, sf):
    """Three per-source pipelines (only the hint-bearing source reads level_hint),
    each role-filtered (F1), unioned by name with duplicates kept."""
    raw = fx.postings_raw(spark, sf, with_text=False)
    frames = []
    for s in fx.SOURCES:
        part = raw.filter(F.col("source") == s)
        if s != fx.HINT_SOURCE:
            part = part.drop("level_hint")
        frames.append(C.filter_roles(C.tag_postings(part)).select("posting_id", "source", "seniority"))
    return C.union_sources(frames)


@register("value_counts", with_views("unified", body="""
SELECT 'canonical_title' AS dimension, canonical_title AS value, count(*) AS n FROM unified GROUP BY canonical_title
UNION ALL SELECT 'geo', geo, count(*) FROM unified GROUP BY geo
UNION ALL SELECT 'source', source, count(*) FROM unified GROUP BY source
UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FROM unified GROUP BY year"""))
def value_counts(spark, sf):
    """A1: counts by title, geo, source and year in ONE pass (explode of
    (dimension, value) pairs, then one partial-aggregated groupBy)."""
    u = unified_postings(spark, sf)
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                      for d in ("canonical_title", "geo", "source", "year")])
    e = u.select(F.inline(pairs))
    return e.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))


_GEOS = ["US", "UK", "EU", "APAC", "Other"]


@register("crosstab", with_views("tagged", body=f"""
SELECT source, {', '.join(f"count(*) FILTER (WHERE geo = '{g}') AS geo_{g}" for g in _GEOS)}
FROM tagged WHERE canonical_title IN ({ROLE_LIST}) AND year IN ({YEAR_LIST}) GROUP BY source"""))
def crosstab(spark, sf):
    """A2: source x geo before the US filter, zero-filled, explicit pivot values (no extra job)."""
    t = C.filter_years(C.filter_roles(tagged_postings(spark, sf)), fx.VALID_YEARS)
    p = t.groupBy("source").pivot("geo", _GEOS).agg(F.count(F.lit(1)))
    return p.select("source", *[F.coalesce(F.col(g), F.lit(0)).cast("long").alias(f"geo_{g}") for g in _GEOS])


_SEN = ["entry", "mid", "senior", "lead", "unclassified"]


@register("crosstab_seniority", with_views("unified", body=f"""
SELECT source, {', '.join(f"count(*) FILTER (WHERE seniority = '{g}') AS sen_{g}" for g in _SEN)}
FROM unified WHERE NOT is_duplicate GROUP BY source"""))
def crosstab_seniority(spark, sf):
    """A2: seniority by source on the non-duplicate rows, zero-filled."""
    u = unified_postings(spark, sf).filter(~F.col("is_duplicate"))
    p = u.groupBy("source").pivot("seniority", _SEN).agg(F.count(F.lit(1)))
    return p.select("source", *[F.coalesce(F.col(g), F.lit(0)).cast("long").alias(f"sen_{g}") for g in _SEN])


@register("crosstab_title_year", with_views("unified", body=f"""
SELECT year, {', '.join(f"count(*) FILTER (WHERE canonical_title = '{t}') AS \"{t}\"" for t in rules.DS_TITLES)}
FROM unified WHERE NOT is_duplicate GROUP BY year"""))
def crosstab_title_year(spark, sf):
    """A2: year x canonical title (post-dedup), zero-filled."""
    u = unified_postings(spark, sf).filter(~F.col("is_duplicate"))
    p = u.groupBy("year").pivot("canonical_title", rules.DS_TITLES).agg(F.count(F.lit(1)))
    return p.select("year", *[F.coalesce(F.col(f"`{t}`"), F.lit(0)).cast("long").alias(t) for t in rules.DS_TITLES])


@register("crosstab_source_year", with_views("tagged", body=f"""
SELECT source, {', '.join(f"count(*) FILTER (WHERE year = {y}) AS y{y}" for y in fx.VALID_YEARS)}
FROM tagged WHERE canonical_title IN ({ROLE_LIST}) GROUP BY source"""))
def crosstab_source_year(spark, sf):
    """A2: source x valid year of the in-scope roles, zero-filled."""
    t = C.filter_roles(tagged_postings(spark, sf))
    p = t.groupBy("source").pivot("year", fx.VALID_YEARS).agg(F.count(F.lit(1)))
    return p.select("source", *[F.coalesce(F.col(str(y)), F.lit(0)).cast("long").alias(f"y{y}") for y in fx.VALID_YEARS])


@register("crosstab_source_title", with_views("unified", body=f"""
SELECT source, {', '.join(f"count(*) FILTER (WHERE canonical_title = '{t}') AS \"{t}\"" for t in rules.DS_TITLES)}
FROM unified WHERE NOT is_duplicate GROUP BY source"""))
def crosstab_source_title(spark, sf):
    """A2: source x canonical title (post-dedup), zero-filled."""
    u = unified_postings(spark, sf).filter(~F.col("is_duplicate"))
    p = u.groupBy("source").pivot("canonical_title", rules.DS_TITLES).agg(F.count(F.lit(1)))
    return p.select("source", *[F.coalesce(F.col(f"`{t}`"), F.lit(0)).cast("long").alias(t) for t in rules.DS_TITLES])


@register("role_share", with_views("unified", body="""
SELECT source, canonical_title, n, round(n / sum(n) OVER (PARTITION BY source), 6) AS share
FROM (SELECT source, canonical_title, count(*) AS n FROM unified GROUP BY source, canonical_title)"""))
def role_share(spark, sf):
    """A3: row share of each title within its source (window over the small aggregate)."""
    u = unified_postings(spark, sf)
    g = u.groupBy("source", "canonical_title").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", r6(F.col("n") / F.sum("n").over(Window.partitionBy("source"))))


@register("dedup_30d", with_views("unified", body="""
SELECT posting_id, company, canonical_title, date, is_duplicate FROM unified"""))
def dedup_30d(spark, sf):
    """The chained 30-day duplicate flag."""
    return unified_postings(spark, sf).select("posting_id", "company", "canonical_title", "date", "is_duplicate")


@register("dedup_stats", with_views("unified", body="""
SELECT source, count(*) AS n, count(*) FILTER (WHERE is_duplicate) AS n_duplicate,
       round(avg(CASE WHEN is_duplicate THEN 1.0 ELSE 0.0 END), 6) AS dup_rate,
       count(*) FILTER (WHERE NOT is_duplicate) AS n_clean
FROM unified GROUP BY source"""))
def dedup_stats(spark, sf):
    """Flagged n and rate, clean n, by source."""
    u = unified_postings(spark, sf)
    d = F.col("is_duplicate")
    return u.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(d).alias("n_duplicate"),
        r6(F.avg(d.cast("double"))).alias("dup_rate"), F.count_if(~d).alias("n_clean"))


@register("dedup_by_title", with_views("unified", body="""
SELECT source, canonical_title, count(*) AS n, count(*) FILTER (WHERE is_duplicate) AS n_duplicate,
       round(avg(CASE WHEN is_duplicate THEN 1.0 ELSE 0.0 END), 6) AS dup_rate
FROM unified GROUP BY source, canonical_title"""))
def dedup_by_title(spark, sf):
    """Dedup rate by (source, title)."""
    u = unified_postings(spark, sf)
    d = F.col("is_duplicate")
    return u.groupBy("source", "canonical_title").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(d).alias("n_duplicate"), r6(F.avg(d.cast("double"))).alias("dup_rate"))


@register("cross_source_dupes", with_views("unified", body="""
SELECT g.year, g.company, g.canonical_title, g.source, g.n
FROM (SELECT year, company, canonical_title, source, count(*) AS n FROM unified
      WHERE company IS NOT NULL GROUP BY year, company, canonical_title, source) g
JOIN (SELECT year, company, canonical_title FROM unified WHERE company IS NOT NULL
      GROUP BY year, company, canonical_title HAVING count(DISTINCT source) > 1) k
  ON g.year = k.year AND g.company = k.company AND g.canonical_title = k.canonical_title
ORDER BY g.year, g.company, g.canonical_title, g.source LIMIT 20"""))
def cross_source_dupes(spark, sf):
    """(year, company, title) present in more than one source; per-source counts,
    top 20 by (year, company). Null company dropped."""
    u = unified_postings(spark, sf).filter(F.col("company").isNotNull())
    g = u.groupBy("year", "company", "canonical_title", "source").agg(F.count(F.lit(1)).alias("n"))
    k = (g.groupBy("year", "company", "canonical_title").agg(F.count_distinct("source").alias("_ns"))
         .filter(F.col("_ns") > 1).drop("_ns"))
    return (g.join(k, ["year", "company", "canonical_title"])
            .orderBy("year", "company", "canonical_title", "source").limit(20))


@register("null_rates", with_views("unified", "mapped", body="""
, u AS (SELECT unified.*, nullif(description_text, '') AS txt, k.posting_id AS skilled
        FROM unified LEFT JOIN (SELECT DISTINCT posting_id FROM mapped) k ON k.posting_id = unified.posting_id)
SELECT column_name, null_pct FROM (
  UNPIVOT (SELECT """ + ", ".join(
    f"round(100.0 * (count(*) - count({ {'description_text': 'txt', 'skills_present': 'skilled'}.get(c, 'u.' + c) })) / count(*), 6) AS {c}"
    for c in FINAL_COLS) +
    """ FROM u) ON COLUMNS(*) INTO NAME column_name VALUE null_pct)
WHERE null_pct > 0"""))
def null_rates(spark, sf):
    """% missing per column of the persisted table (real texts and skills; an empty text or an
    empty skill list counts as missing) in one aggregate pass, unpivoted, only > 0."""
    u = final_postings(spark, sf)
    value = {"description_text": F.nullif("description_text", F.lit("")),
             "skills_present": F.when(F.size("skills_present") > 0, 1)}
    n = F.count(F.lit(1))
    agg = u.agg(*[r6(100.0 * (n - F.count(value.get(c, F.col(c)))) / n).alias(c) for c in FINAL_COLS])
    return agg.unpivot([], FINAL_COLS, "column_name", "null_pct").filter(F.col("null_pct") > 0)


@register("label_coverage", with_views("unified", body="""
SELECT source, count(*) AS n,
       round(avg(CASE WHEN seniority = 'unclassified' THEN 1.0 ELSE 0.0 END), 6) AS unclassified_share,
       avg(CASE WHEN seniority = 'unclassified' THEN 1.0 ELSE 0.0 END) > 0.5 AS unusable
FROM unified WHERE NOT is_duplicate GROUP BY source"""))
def label_coverage(spark, sf, limit: float = 0.5):
    """Share of unclassified seniority per source; flag sources above ``limit``."""
    u = unified_postings(spark, sf).filter(~F.col("is_duplicate"))
    share = F.avg((F.col("seniority") == "unclassified").cast("double"))
    return u.groupBy("source").agg(F.count(F.lit(1)).alias("n"), r6(share).alias("unclassified_share"),
                                   (share > limit).alias("unusable"))


@register("limit_n", with_views("clean", body="""
SELECT posting_id, source FROM clean ORDER BY posting_id LIMIT 25"""))
def limit_n(spark, sf, n: int = 25):
    """F8: the first n clean postings by id (TakeOrderedAndProject, no global sort)."""
    return clean_postings(spark, sf).select("posting_id", "source").orderBy("posting_id").limit(n)


@register("sorted_postings", with_views("unified", body="""
SELECT posting_id, company, canonical_title, date FROM unified
ORDER BY company NULLS LAST, canonical_title, date NULLS LAST, posting_id"""))
def sorted_postings(spark, sf):
    """Stable multi-key sort (range-partitioned global sort)."""
    u = unified_postings(spark, sf)
    return u.select("posting_id", "company", "canonical_title", "date").orderBy(
        F.col("company").asc_nulls_last(), "canonical_title", F.col("date").asc_nulls_last(), "posting_id")


@register("load_clean", with_views("clean", body="""
SELECT posting_id, source, year, snapshot FROM clean"""))
def load_clean(spark, sf):
    """Residual artefacts (F4) and duplicates (F6) removed; snapshot derived."""
    return clean_postings(spark, sf).select("posting_id", "source", "year", "snapshot")
