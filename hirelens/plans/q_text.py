"""Registered queries: text extraction, co-occurrence, HTML, length statistics,
source audits (D1-D7) and date / location helpers (T8-T10)."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from hirelens.functions import dates
from hirelens.functions.text import html_to_text
from hirelens.functions.text import first_location as first_loc
from hirelens.operators import extract as X
from hirelens.plans.base import clean_postings, r6, skills_long, tagged_postings, unified_postings
from hirelens.plans.registry import register, with_views
from hirelens.sources import fixtures as fx

# ---- X1 / X2 ----------------------------------------------------------------------
_MAXN = 2          # words of the longest alias of the fixture


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _tokens_sql(negation: bool) -> str:
    """doc_id, o: the tokens of a text, neg: whether each lies in a negated stretch."""
    if not negation:
        return f"SELECT doc_id, {fx.sql_tokens('text')} AS o, CAST(NULL AS BOOLEAN[]) AS neg FROM documents"
    cue = f"list_filter(range(1, len(t) + 1), lambda i: list_contains({_sql_list(X.NEGATION_WORDS)}, t[i])"
    need = _sql_list(X.NEED_WORDS)
    other = _sql_list(X.NOT_NEGATED + X.NEED_WORDS)
    return f"""
  SELECT doc_id, flatten(list(o ORDER BY c)) AS o, flatten(list(neg ORDER BY c)) AS neg FROM (
    SELECT doc_id, c, o, list_transform(range(1, len(t) + 1), lambda i: coalesce(i > list_min(f), false) OR len(list_filter(bk,
             lambda k: i < k AND i > coalesce(list_max(list_filter(nd, lambda p: p < k)), 0))) > 0) AS neg
    FROM (SELECT *, {cue} AND NOT coalesce(list_contains({other}, t[i + 1]), false)) AS f,
                 {cue} AND coalesce(list_contains({need}, t[i + 1]), false)) AS bk,
                 list_filter(range(1, len(t) + 1), lambda i: list_contains({need}, t[i])) AS nd
          FROM (SELECT doc_id, c, {fx.sql_tokens('clause')} AS o, list_transform({fx.sql_tokens('clause')}, lambda x: lower(x)) AS t
                FROM (SELECT doc_id, unnest(s) AS clause, unnest(range(len(s))) AS c
                      FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '{X.CONTRAST}', chr(10) || '\\1 ', 'gi'),
                                                              '{X.CLAUSE_END}') AS s FROM documents))))) GROUP BY doc_id"""


def _grams_sql() -> str:
    parts = []
    for n in range(1, _MAXN + 1):
        gram = " || ' ' || ".join(f"t[pos + {k}]" for k in range(n))
        parts.append(f"SELECT doc_id, pos, {gram} AS gram, o[pos] AS spelt, coalesce(neg[pos], false) AS neg FROM "
                     f"(SELECT *, unnest(generate_series(1, len(t) - {n - 1})) AS pos FROM toks)")
    return " UNION ALL ".join(parts)


def _extract_sql(negation: bool) -> str:
    return with_views("text_aliases", body=f"""
, toks AS (SELECT doc_id, o, neg, list_transform(o, lambda x: lower(x)) AS t FROM ({_tokens_sql(negation)}))
, grams AS ({_grams_sql()})
SELECT g.doc_id, a.canonical AS skill, min(g.pos) AS first_pos, count(*) AS n_matches
FROM grams g JOIN text_aliases a ON a.key = g.gram
WHERE (NOT regexp_full_match(a.key, '\\p{{L}}{{1,2}}') OR g.spelt IN (upper(a.key), upper(a.key[1]) || a.key[2:])) AND NOT g.neg
GROUP BY g.doc_id, a.canonical""")


@register("extract_skills", _extract_sql(False))
def extract_skills(spark, sf):
    """Dictionary extraction over whole document texts."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return X.extract_skills(docs, fx.text_aliases(spark, sf), strict_short=True)


@register("extract_skills_negation", _extract_sql(True))
def extract_skills_negation(spark, sf):
    """As X1, skipping matches that begin in a negated stretch of their clause."""
    docs = fx.table(spark, sf, "documents").select("doc_id", "text")
    return X.extract_skills(docs, fx.text_aliases(spark, sf), negation=True, strict_short=True)


# ---- X3 ----------------------------------------------------------------------------
@register("skill_cooccurrence", with_views("clean", "skills", body="""
SELECT a.skill AS skill_a, b.skill AS skill_b, count(*) AS n_both,
       round(count(*) / (SELECT count(*) FROM clean), 6) AS support,
       round(count(*) / (na.n + nb.n - count(*)), 6) AS jaccard
FROM skills a JOIN skills b ON a.posting_id = b.posting_id AND a.skill < b.skill
JOIN (SELECT skill, count(DISTINCT posting_id) AS n FROM skills GROUP BY skill) na ON na.skill = a.skill
JOIN (SELECT skill, count(DISTINCT posting_id) AS n FROM skills GROUP BY skill) nb ON nb.skill = b.skill
GROUP BY a.skill, b.skill, na.n, nb.n"""))
def skill_cooccurrence(spark, sf):
    """Skill pairs per clean posting with count, support and Jaccard."""
    total = clean_postings(spark, sf).agg(F.count(F.lit(1))).scalar()
    return X.cooccurrence(skills_long(spark, sf), total)


# ---- T4 ----------------------------------------------------------------------------
# Entities that the pages and the bridge hold, as the oracle's SQL decodes them (&amp; last).
NATIVE_ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", "\u00a0"),
    ("&middot;", "\u00b7"), ("&copy;", "\u00a9"), ("&reg;", "\u00ae"), ("&ndash;", "\u2013"), ("&mdash;", "\u2014"),
    ("&hellip;", "\u2026"), ("&#169;", "\u00a9"), ("&eacute;", "\u00e9"), ("&#xe9;", "\u00e9"),
]


def _sql_decode(x: str) -> str:
    for ent, ch in NATIVE_ENTITIES:
        x = f"replace({x}, '{ent}', '{ch.replace(chr(39), chr(39) * 2)}')"
    return f"replace({x}, '&amp;', '&')"


_BLOCKS_SQL = (r"(?is)<!--.*?-->|<!--.*$|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
               r"|<template\b[^>]*>.*?</template\s*>|<![^>]*>|<\?[^>]*>")
_TAGS_SQL = r"(?s)</?[A-Za-z][^>]*>"


def sql_html_strip(col: str) -> str:
    inner = _sql_decode(col)
    inner = f"regexp_replace({inner}, '{_BLOCKS_SQL}', ' ', 'g')"
    inner = f"regexp_replace({inner}, '{_TAGS_SQL}', ' ', 'g')"
    inner = _sql_decode(inner)
    inner = f"trim(regexp_replace({inner}, '[\\s\\x0B]+', ' ', 'g'))"
    return f"CASE WHEN {col} IS NULL OR trim({col}) = '' THEN '' ELSE {inner} END"


EXTRA_HTML = "<p>&#169; caf&eacute; caf&#xe9; R&D AT&T &quot;q&quot; &amp;lt; a &middot; b</p>"


@register("html_strip", f"SELECT page_id, {sql_html_strip('html')} AS text "
                        f"FROM (SELECT page_id, html || '{EXTRA_HTML}' AS html FROM pages)")
def html_strip(spark, sf):
    """T4: raw web pages -> plain text (native regex chain). The bridge
    adds a paragraph with further entities and bare ampersands to each page."""
    p = fx.table(spark, sf, "pages").withColumn("html", F.concat("html", F.lit(EXTRA_HTML)))
    return p.select("page_id", html_to_text("html").alias("text"))


# ---- A4 / A5 / D1-D7 on documents, events, labels ---------------------------------------
_PCTS = [0.25, 0.5, 0.75, 0.95]


@register("desc_length_stats", """
SELECT source, count(*) AS n, round(avg(length(text)), 6) AS mean, round(stddev_samp(length(text)), 6) AS std,
       min(length(text)) AS min, round(quantile_cont(length(text), 0.25), 6) AS p25,
       round(quantile_cont(length(text), 0.5), 6) AS p50, round(quantile_cont(length(text), 0.75), 6) AS p75,
       round(quantile_cont(length(text), 0.95), 6) AS p95, max(length(text)) AS max
FROM documents GROUP BY source""")
def desc_length_stats(spark, sf):
    """A4 + T15: text-length distribution (code points) by source; exact interpolated percentiles."""
    d = fx.table(spark, sf, "documents").select("source", F.char_length("text").alias("len"))
    pct = F.percentile("len", F.array(*[F.lit(p) for p in _PCTS]))
    g = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("len")).alias("mean"),
                                r6(F.stddev_samp("len")).alias("std"), F.min("len").alias("min"),
                                pct.alias("_p"), F.max("len").alias("max"))
    return g.select("source", "n", "mean", "std", "min",
                    *[r6(F.col("_p")[i]).alias(n) for i, n in enumerate(["p25", "p50", "p75", "p95"])], "max")


@register("length_bias", """
SELECT source, median_len, round(median_len / max(median_len) OVER (), 6) AS ratio_to_max,
       median_len / max(median_len) OVER () < 0.5 AS flagged
FROM (SELECT source, quantile_cont(length(text), 0.5) AS median_len FROM documents GROUP BY source)""")
def length_bias(spark, sf, limit: float = 0.5):
    """A5: each source's median length against the longest-median source; flag below ``limit``."""
    d = fx.table(spark, sf, "documents").select("source", F.char_length("text").alias("len"))
    g = d.groupBy("source").agg(F.median("len").alias("median_len"))
    top = g.agg(F.max("median_len")).scalar()
    return g.select("source", "median_len", r6(F.col("median_len") / top).alias("ratio_to_max"),
                    (F.col("median_len") / top < limit).alias("flagged"))


@register("audit_profile", """
SELECT source, count(*) AS n, round(100.0 * count(*) FILTER (WHERE text IS NULL OR text = '') / count(*), 6) AS empty_pct,
       round(avg(length(text)), 6) AS mean_len, count(*) FILTER (WHERE lang = 'en') AS in_scope,
       round(100.0 * count(*) FILTER (WHERE lang = 'en') / count(*), 6) AS in_scope_pct
FROM documents GROUP BY source""")
def audit_profile(spark, sf, scope_lang: str = "en"):
    """Per-source profile (rows, empty text %, mean length, in-scope rows and %)."""
    d = fx.table(spark, sf, "documents")
    empty = F.col("text").isNull() | (F.col("text") == "")
    scope = F.col("lang") == scope_lang
    n = F.count(F.lit(1))
    return d.groupBy("source").agg(n.alias("n"), r6(100.0 * F.count_if(empty) / n).alias("empty_pct"),
                                   r6(F.avg(F.char_length("text"))).alias("mean_len"),
                                   F.count_if(scope).alias("in_scope"),
                                   r6(100.0 * F.count_if(scope) / n).alias("in_scope_pct"))


@register("audit_month_gaps", """
SELECT CAST(m.month AS DATE) AS month, coalesce(c.n, 0) AS n, coalesce(c.n, 0) = 0 AS missing
FROM (SELECT unnest(generate_series(min(date_trunc('month', ts)), max(date_trunc('month', ts)), INTERVAL 1 MONTH)) AS month
      FROM events) m
LEFT JOIN (SELECT date_trunc('month', ts) AS month, count(*) AS n FROM events GROUP BY 1) c ON c.month = m.month""")
def audit_month_gaps(spark, sf):
    """Events per calendar month over the whole observed range; empty months flagged."""
    ev = fx.table(spark, sf, "events").select(F.trunc(F.to_date("ts"), "month").alias("month"))
    counts = ev.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    cal = ev.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    j = cal.join(counts, "month", "left")
    return j.select("month", F.coalesce("n", F.lit(0)).alias("n"), (F.coalesce("n", F.lit(0)) == 0).alias("missing"))


@register("audit_truncation", """
SELECT source, count(*) AS n, max(length(text)) AS max_len,
       count(*) FILTER (WHERE length(text) = mx) AS n_at_max,
       round(count(*) FILTER (WHERE length(text) = mx) / count(*), 6) AS share_at_max
FROM (SELECT *, max(length(text)) OVER (PARTITION BY source) AS mx FROM documents) GROUP BY source""")
def audit_truncation(spark, sf):
    """D3: share of texts sitting exactly at the source's maximum length (a length cap)."""
    d = fx.table(spark, sf, "documents").select("source", F.char_length("text").alias("len"))
    mx = d.groupBy("source").agg(F.max("len").alias("max_len"))
    j = d.join(mx, "source")
    at = F.col("len") == F.col("max_len")
    return j.groupBy("source", "max_len").agg(F.count(F.lit(1)).alias("n"), F.count_if(at).alias("n_at_max"),
                                             r6(F.count_if(at) / F.count(F.lit(1))).alias("share_at_max")).select(
        "source", "n", "max_len", "n_at_max", "share_at_max")


@register("audit_dup_text", """
SELECT source, count(*) AS n, count(DISTINCT sha256(text)) AS n_distinct,
       round(1 - count(DISTINCT sha256(text)) / count(*), 6) AS dup_share
FROM documents GROUP BY source""")
def audit_dup_text(spark, sf):
    """Duplicate-text share per source (distinct SHA-256 digests; text itself never shuffled)."""
    d = fx.table(spark, sf, "documents").select("source", F.sha2("text", 256).alias("h"))
    g = d.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("h").alias("n_distinct"))
    return g.withColumn("dup_share", r6(1 - F.col("n_distinct") / F.col("n")))


@register("audit_dates", with_views("postings_raw", body="""
SELECT source, count(*) AS n, min(date) AS min_date, max(date) AS max_date, count(*) FILTER (WHERE date IS NULL) AS undated
FROM postings_raw GROUP BY source"""))
def audit_dates(spark, sf):
    """First and last date per source, and rows without one."""
    p = fx.postings_raw(spark, sf, with_text=False)
    return p.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("min_date"),
                                   F.max("date").alias("max_date"), F.count_if(F.col("date").isNull()).alias("undated"))


@register("audit_length_hist", """
SELECT source, CAST(length(text) // 500 * 500 AS INTEGER) AS from_len, count(*) AS n FROM documents GROUP BY ALL""")
def audit_length_hist(spark, sf, width: int = 500):
    """D3: histogram of text lengths per source; a cap shows as a full bucket with little beyond it."""
    d = fx.table(spark, sf, "documents").select("source", F.char_length("text").alias("len"))
    low = (F.floor(F.col("len") / width) * width).cast("int")
    return d.groupBy("source", low.alias("from_len")).agg(F.count(F.lit(1)).alias("n"))


@register("audit_length_cap", """
SELECT source, len AS cap_len, k AS n_at_cap, round(k / n, 6) AS share_at_cap FROM (
  SELECT source, length(text) AS len, count(*) AS k, sum(count(*)) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, length(text) DESC) AS r
  FROM documents GROUP BY source, length(text)) WHERE r = 1""")
def audit_length_cap(spark, sf):
    """D3: the most frequent length per source (the longest of equals), found also if longer outliers exist."""
    d = fx.table(spark, sf, "documents").select("source", F.char_length("text").alias("len"))
    k = d.groupBy("source", "len").agg(F.count(F.lit(1)).alias("k"))
    g = k.groupBy("source").agg(F.max(F.struct("k", "len")).alias("m"), F.sum("k").alias("n"))
    return g.select("source", F.col("m.len").alias("cap_len"), F.col("m.k").alias("n_at_cap"),
                    r6(F.col("m.k") / F.col("n")).alias("share_at_cap"))


@register("audit_dup_months", with_views("unified", body="""
SELECT source, sum(n) AS n_dup, round(sum(n) FILTER (WHERE r <= 3) / sum(n), 6) AS top3_share FROM (
  SELECT source, month, n, row_number() OVER (PARTITION BY source ORDER BY n DESC, month) AS r FROM (
    SELECT source, date_trunc('month', date) AS month, count(*) AS n FROM unified WHERE is_duplicate GROUP BY ALL))
GROUP BY source"""))
def audit_dup_months(spark, sf, top: int = 3):
    """Share of a source's duplicates that fall in its ``top`` months."""
    u = unified_postings(spark, sf).filter("is_duplicate").groupBy("source", F.trunc("date", "month").alias("month"))
    m = u.agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("source").orderBy(F.desc("n"), "month")
    m = m.withColumn("r", F.row_number().over(w))
    g = m.groupBy("source").agg(F.sum("n").alias("n_dup"), F.sum(F.when(F.col("r") <= top, F.col("n"))).alias("t"))
    return g.select("source", "n_dup", r6(F.col("t") / F.col("n_dup")).alias("top3_share"))


_ID_TABLES = [("events", "event_id"), ("documents", "doc_id"), ("orders", "o_orderkey")]


@register("audit_sequential_ids", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n, count(DISTINCT {c}) AS n_distinct, min({c}) AS min_id, "
    f"max({c}) AS max_id, max({c}) - min({c}) + 1 = count(DISTINCT {c}) AS dense FROM {t}" for t, c in _ID_TABLES))
def audit_sequential_ids(spark, sf):
    """Dense sequential ids (max - min + 1 = distinct count) suggest synthetic data."""
    outs = []
    for t, c in _ID_TABLES:
        d = fx.table(spark, sf, t).select(F.col(c).alias("id"))
        outs.append(d.agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("n"),
                          F.count_distinct("id").alias("n_distinct"), F.min("id").alias("min_id"),
                          F.max("id").alias("max_id"),
                          (F.max("id") - F.min("id") + 1 == F.count_distinct("id")).alias("dense")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@register("audit_token_trend", with_views("tagged", "extractions", body="""
SELECT y.year, y.term, y.n_with, t.n_year, round(y.n_with / t.n_year, 6) AS share
FROM (SELECT p.year, lower(e.term) AS term, count(DISTINCT e.posting_id) AS n_with
      FROM extractions e JOIN tagged p ON p.posting_id = e.posting_id GROUP BY p.year, lower(e.term)) y
JOIN (SELECT p.year, count(DISTINCT e.posting_id) AS n_year
      FROM extractions e JOIN tagged p ON p.posting_id = e.posting_id GROUP BY p.year) t ON t.year = y.year"""))
def audit_token_trend(spark, sf):
    """Share of extracted postings per year mentioning each (case-folded) term."""
    p = tagged_postings(spark, sf).select("posting_id", "year")
    e = fx.extractions(spark, sf).select("posting_id", F.lower("term").alias("term")).join(p, "posting_id")
    y = e.groupBy("year", "term").agg(F.count_distinct("posting_id").alias("n_with"))
    t = e.groupBy("year").agg(F.count_distinct("posting_id").alias("n_year"))
    return y.join(t, "year").select("year", "term", "n_with", "n_year",
                                    r6(F.col("n_with") / F.col("n_year")).alias("share"))


@register("audit_flags", """
SELECT 'quality' AS flag, count(quality) AS n, round(avg(quality), 6) AS mean FROM labels
UNION ALL SELECT 'toxic', count(toxic), round(avg(toxic), 6) FROM labels""")
def audit_flags(spark, sf, flags=("quality", "toxic")):
    """Prevalence (mean) of 0/1 flag columns, one aggregate pass, unpivoted."""
    lab = fx.table(spark, sf, "labels")
    agg = lab.agg(*[F.struct(F.count(c).alias("n"), r6(F.avg(c)).alias("mean")).alias(c) for c in flags])
    rows = F.array(*[F.struct(F.lit(c).alias("flag"), F.col(c)["n"].alias("n"), F.col(c)["mean"].alias("mean"))
                     for c in flags])
    return agg.select(F.inline(rows))


# ---- T8 / T9 / T10 --------------------------------------------------------------------
@register("epoch_ms_date", """
SELECT event_id, CAST(ts AS DATE) AS date FROM events""")
def epoch_ms_date(spark, sf):
    """Events.ts rendered as epoch milliseconds (text), parsed back to a UTC date."""
    ev = fx.table(spark, sf, "events").select("event_id", F.unix_millis(dates.utc_instant("ts"))
                                              .cast("string").alias("ms"))
    return ev.select("event_id", dates.epoch_ms_to_date("ms").alias("date"))


@register("iso_ts_date", """
SELECT event_id, date_trunc('second', ts) AS ts_utc FROM events""")
def iso_ts_date(spark, sf):
    """Events.ts rendered as ISO-8601 text with a +02:00 offset, parsed to naive UTC."""
    ev = fx.table(spark, sf, "events")
    local = F.date_format(F.col("ts") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
    iso = F.concat(local, F.lit("+02:00"))
    return ev.select("event_id", dates.iso_to_naive_utc(iso).alias("ts_utc"))


@register("location_resolve", """
SELECT c.c_custkey,
       CASE WHEN c.c_custkey % 11 = 0 THEN '' WHEN c.c_custkey % 7 = 0 THEN '' ELSE n.n_name END AS location
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""")
def location_resolve(spark, sf):
    """A location list per customer ([nation, region]; empty every 7th, null every 11th)
    resolved to its first element ("" when empty or null)."""
    c = fx.table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = fx.table(spark, sf, "nation")
    r = fx.table(spark, sf, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")
    j = c.join(geo, c.c_nationkey == geo.n_nationkey)
    locs = (F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("array<string>"))
            .when(F.col("c_custkey") % 7 == 0, F.array().cast("array<string>"))
            .otherwise(F.array("n_name", "r_name")))
    return j.select("c_custkey", first_loc(locs).alias("location"))
