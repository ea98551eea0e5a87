"""Registered queries over Structured Streaming."""
from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.operators import clean as C
from hirelens.plans.base import tagged_postings
from hirelens.plans.registry import register, with_views
from hirelens.sources import fixtures as fx
from hirelens.sources import io as IO
from hirelens.streaming import ingest as ST

RAW_SCHEMA = ("native_id long, raw_title string, location string, level_hint string, company string, "
              "date date, description_text string, source string")
SCOPED_SCHEMA = "posting_id string, company string, canonical_title string, date date, year int"


@register("ingest_incremental", with_views("tagged", body="SELECT posting_id, source, canonical_title FROM tagged"))
def ingest_incremental(spark, sf):
    """Raw postings arrive in two drops laid out by date and source (the second drop
    re-delivers a slice of the first); each drop is ingested by a streaming run
    that only sees new files and skips ids already in the target."""
    raw = fx.postings_raw(spark, sf, with_text=False)
    feed, target, ckpt = (IO.scratch_path(spark, n) for n in ("feed", "ingested", "ingest_ckpt"))
    first = raw.filter(F.year("date") < 1998)
    second = raw.filter(F.year("date") >= 1997)                  # 1997 re-delivered
    tag = lambda b: C.tag_postings(b).select("posting_id", "source", "canonical_title",
                                             F.trunc("date", "year").alias("date"))
    for drop in (first, second):
        # one folder per year and source: the fixture's days are few rows each
        drop.withColumn("date", F.trunc("date", "year")).repartition("date", "source").write.mode("append") \
            .partitionBy("date", "source").parquet(feed)
        ST.ingest_new(spark, feed, RAW_SCHEMA, target, ckpt, tag)
    return spark.read.parquet(target).select("posting_id", "source", "canonical_title")


@register("dedup_stream", with_views("unified", body="SELECT posting_id, is_duplicate FROM unified"))
def dedup_stream(spark, sf):
    """The 30-day chained flag as a stateful stream; yearly drops arrive in date
    order, state = last posting date per (company, title)."""
    scoped = C.filter_geo(C.filter_years(C.filter_roles(tagged_postings(spark, sf)), fx.VALID_YEARS))
    scoped = scoped.select("posting_id", "company", "canonical_title", "date", "year")
    feed, target, ckpt, state = (IO.scratch_path(spark, n) for n in ("dedup_feed", "dedup_out", "dedup_ckpt", "dedup_state"))
    for y in fx.VALID_YEARS:
        scoped.filter(F.col("year") == y).write.mode("append").partitionBy("year").parquet(feed)
        ST.dedup_stream_run(spark, feed, SCOPED_SCHEMA, target, ckpt, state)
    return spark.read.parquet(target).select("posting_id", "is_duplicate")
