"""Cleaning pipeline: tag, finalise, scope filters, union, 30-day duplicate flag.

Everything is a lazy DataFrame -> DataFrame function; Catalyst pushes the
filters into the scans and fuses the tagging CASE chains into one codegen stage.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions import rules
from hirelens.functions.text import company_clean, text_or_empty
from hirelens.schema import finalise


def tag_postings(raw: DataFrame, *, use_hint: bool = True, strict_geo: bool = False) -> DataFrame:
    """T1-T3, T7, T12, T14 then finalise (T5, T6, T13) for a raw frame with columns
    native_id, source, raw_title, location, [level_hint], company, date, description_text."""
    # Rules are word-bounded *searches*: surrounding whitespace never changes a
    # match, so they run on the raw text and only the output column is trimmed.
    title = F.col("raw_title")
    hint = F.col("level_hint") if (use_hint and "level_hint" in raw.columns) else None
    tagged = raw.select(
        F.concat(F.col("source"), F.lit(":"), F.col("native_id").cast("string")).alias("posting_id"),
        "source", "date",
        rules.unicode_trim(title).alias("raw_title"),
        rules.canonical_title(title).alias("canonical_title"),
        company_clean("company").alias("company"),
        rules.geo_tag("location", strict=strict_geo).alias("geo"),
        rules.seniority(title, hint).alias("seniority"),
        text_or_empty("description_text").alias("description_text"),
    ).filter(F.col("native_id").isNotNull() if "native_id" in raw.columns else F.lit(True))
    return finalise(tagged)


# ---- filters (F1-F6) ------------------------------------------------------
def filter_roles(df: DataFrame, roles=tuple(rules.DS_TITLES)) -> DataFrame:
    """keep in-scope canonical titles."""
    return df.filter(F.col("canonical_title").isin(list(roles)))


def filter_years(df: DataFrame, years) -> DataFrame:
    """keep valid years; a null year is dropped."""
    return df.filter(F.col("year").isin(list(years)))


def anomalous_mask(years) -> Column:
    """complement of F2 (null year counts as anomalous)."""
    return ~F.coalesce(F.col("year").isin(list(years)), F.lit(False))


def filter_geo(df: DataFrame, geo: str = "US") -> DataFrame:
    """F5."""
    return df.filter(F.col("geo") == geo)


def artefact_mask(source: str, min_year: int) -> Column:
    """F4 condition (null-safe): the residual date artefacts of one source."""
    return F.coalesce((F.col("source") == source) & (F.col("year") < min_year), F.lit(False))


def load_clean(unified: DataFrame, artefacts: tuple[str, int] | None = None) -> DataFrame:
    """Drop duplicates (F6) and, if ``artefacts`` = (source, first good year) is given, the
    residual date artefacts of that source (F4); both predicates push down."""
    out = unified.filter(~F.col("is_duplicate"))
    return out if artefacts is None else out.filter(~artefact_mask(*artefacts))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Union-all by name, duplicates kept."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# ---- W1: 30-day chained duplicate flag ------------------------------------
def flag_duplicates(df: DataFrame, keys=("company", "canonical_title"), date: str = "date",
                    id_col: str = "posting_id", window_days: int = 30) -> DataFrame:
    """Within (company, title) ordered by (date, id), a row is a duplicate when
    it is at most ``window_days`` after the previous row (chained: the previous row
    counts even if itself a duplicate). Null key or null date -> False.

    Skew-safe formulation: the previous row of the first posting of a day is the
    last earlier *day* of the key; every later posting of the same day is a
    duplicate (gap 0). So the window runs over distinct (key, day) pairs - bounded
    by the calendar, not by how many postings a hot company has - and the result
    joins back on (key, day). The day table is built with a map-side partial
    aggregate; AQE splits a skewed (key, day) partition on the join.
    """
    keys = list(keys)
    valid = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) & F.col(date).isNotNull()
    days = (df.filter(valid).groupBy(*keys, date)
            .agg(F.min(id_col).alias("_first_id")))
    w = Window.partitionBy(*keys).orderBy(date)
    days = days.withColumn("_prev_day", F.lag(date).over(w))
    out = df.join(days, on=[*keys, date], how="left")
    flag = (F.when(~valid, F.lit(False))
            .when(F.col(id_col) != F.col("_first_id"), F.lit(True))
            .otherwise(F.coalesce(F.datediff(F.col(date), F.col("_prev_day")) <= window_days, F.lit(False))))
    cols = [F.col(c) for c in df.columns if c != "is_duplicate"]
    out = out.select(*cols, flag.alias("is_duplicate"))
    return out.select(*df.columns) if "is_duplicate" in df.columns else out


def in_scope(raw: DataFrame, years, *, roles=tuple(rules.DS_TITLES),
             geo: str = "US", strict_geo: bool = False) -> DataFrame:
    """First half of ``unify``, row by row: tag -> F1 -> F2 -> F5."""
    t = tag_postings(raw, strict_geo=strict_geo)
    return filter_geo(filter_years(filter_roles(t, roles), years), geo)


def unify(raw: DataFrame, years, *, roles=tuple(rules.DS_TITLES),
          geo: str = "US", strict_geo: bool = False) -> DataFrame:
    """End-to-end cleaning: tag -> F1 -> F2 -> F5 -> W1, 13 unified columns."""
    return flag_duplicates(in_scope(raw, years, roles=roles, geo=geo, strict_geo=strict_geo))
