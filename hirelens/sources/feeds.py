"""Feed adapters: one function per feed type, raw file frame -> raw postings frame.

Every adapter returns native_id, source, raw_title, location, level_hint, company, date,
description_text, ready for ``operators.clean.unify`` (tagging, filters, duplicate flag).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.functions import dates
from hirelens.functions.text import company_clean, first_location, html_to_text, text_or_empty
from hirelens.sources.io import resolve_column, with_row_position

RAW_COLS = ("native_id", "source", "raw_title", "location", "level_hint", "company", "date", "description_text")

# CSV schemas of the two feed types.
UNDATED_CSV = "`Job Title` string, `Job Description` string, `Company Name` string, Location string, Rating double"
EPOCH_CSV = ("job_id long, title string, company_name string, description string, location string, "
             "formatted_experience_level string, listed_time string")
# Column names that the files of one drifting feed use, first choice first.
DRIFT = {
    "native_id": ["id", "job_id", "external_id"],
    "raw_title": ["title", "name", "job_title"],
    "html": ["description_html", "description", "content"],
    "company": ["source_slug", "company", "company_name"],
    "location": ["locations", "location", "office_locations"],
    "posted": ["posted_at", "created_at", "updated_at"],
}


def undated_csv(df: DataFrame, source: str, anchor: str) -> DataFrame:
    """CSV without ids and dates: the row position is the id, every posting gets the period's
    anchor date (T11), the rating behind a line feed leaves the company (T7)."""
    return with_row_position(df, "native_id").select(
        "native_id", F.lit(source).alias("source"), F.col("Job Title").alias("raw_title"),
        F.col("Location").alias("location"), F.lit(None).cast("string").alias("level_hint"),
        company_clean("Company Name").alias("company"), dates.anchor_date(anchor).alias("date"),
        text_or_empty("Job Description").alias("description_text"))


def epoch_csv(df: DataFrame, source: str) -> DataFrame:
    """CSV with epoch milliseconds (T9) and an experience hint that seniority uses."""
    return df.select(
        F.col("job_id").alias("native_id"), F.lit(source).alias("source"), F.col("title").alias("raw_title"),
        "location", F.col("formatted_experience_level").alias("level_hint"), F.col("company_name").alias("company"),
        dates.epoch_ms_to_date("listed_time").alias("date"), text_or_empty("description").alias("description_text"))


def drifting_parquet(df: DataFrame, source: str) -> DataFrame:
    """Tagged union of Parquet files whose column names drift (S4, per row): HTML text (T4), a list
    of locations or one (T8), ISO-8601 time stamps in UTC (T10)."""
    kinds = dict(df.dtypes)
    place = [first_location(c, is_array=kinds[c].startswith("array")) for c in DRIFT["location"] if c in kinds]
    location = F.coalesce(*[F.nullif(p, F.lit("")) for p in place]) if place else F.lit(None).cast("string")
    pick = {k: resolve_column(df, v, k, per_row=True) for k, v in DRIFT.items() if k != "location"}
    d = df.select(pick["native_id"].cast("string"), pick["raw_title"], pick["html"], pick["company"], pick["posted"],
                  location.alias("location"))
    return d.select(
        "native_id", F.lit(source).alias("source"), "raw_title", "location",
        F.lit(None).cast("string").alias("level_hint"), "company",
        F.to_date(dates.iso_to_naive_utc(F.col("posted"))).alias("date"), html_to_text("html").alias("description_text"))
