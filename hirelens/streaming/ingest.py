"""Structured Streaming: incremental snapshot ingest (S15) and the streaming
30-day duplicate flag (W6).

Both run as file-source streams with ``trigger(availableNow=True)`` and a
checkpoint in the shared folder, so every run processes only files that
arrived since the last one and a restarted run resumes where it stopped.
"""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WINDOW_DAYS = 30


# ---- S15 -----------------------------------------------------------------------------
def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingest_new(spark: SparkSession, feed_dir: str, schema, target: str, checkpoint: str, transform,
               key: str = "posting_id") -> None:
    """Process every unseen feed file once (feed laid out by ``date`` and ``source``): ``transform``
    the micro-batch, drop rows whose key is already in the target (left anti join - a
    re-delivered posting or a retried epoch is not written twice), append the rest.

    The target has the feed's layout, and a posting keeps its date and source, so only the
    date folders that the micro-batch touches are read for the anti join."""
    stream = spark.readStream.schema(schema).option("basePath", feed_dir).parquet(feed_dir)

    def upsert(batch: DataFrame, epoch_id: int) -> None:
        out = transform(batch).dropDuplicates([key])
        if _exists(batch.sparkSession, target):
            seen = batch.sparkSession.read.parquet(target)
            dates = batch.select("date").distinct()       # dynamic partition pruning on the target's folders
            out = out.join(seen.join(dates, "date", "left_semi").select(key), key, "left_anti")
        out.write.mode("append").partitionBy("date", "source").parquet(target)

    q = (stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


# ---- W6 ------------------------------------------------------------------------------
STATE = "company string, canonical_title string, last_date date"


def last_days(spark: SparkSession, state_dir: str, epoch_id: int, earliest: date | None, window_days: int) -> DataFrame:
    """(company, canonical_title, last_date) of the epochs before ``epoch_id``: the last day of each key that
    has one in the months within reach of rows dated ``earliest`` or later (None: no dated rows, no state)."""
    if earliest is None or not _exists(spark, state_dir):
        return spark.createDataFrame([], STATE)
    reach = (earliest - timedelta(days=window_days)).replace(day=1)
    log = spark.read.schema(f"{STATE}, epoch int, month date").parquet(state_dir)
    log = log.where((F.col("epoch") < epoch_id) & (F.col("month") >= F.lit(reach)))
    return log.groupBy("company", "canonical_title").agg(F.max("last_date").alias("last_date"))


def dedup_stream_run(spark: SparkSession, feed_dir: str, schema, target: str, checkpoint: str,
                     state_dir: str, window_days: int = WINDOW_DAYS) -> None:
    """The 30-day chained flag over newly arrived files.

    The state that later drops need is one date per (company, title): its last day. Each
    micro-batch flags its rows like the batch operator, over the table of distinct days per
    key with the state's day as the one before; a day's first posting is compared with the
    day before, every other one is a duplicate. So no group of rows is gathered anywhere (a hot
    company is as many rows as it has days), and rows without a company never enter a group.

    An epoch appends the last days of the keys it touched, under ``epoch=N/month=YYYY-MM-01``; nothing
    else is rewritten. A later epoch reads only the months from ``window_days`` before its earliest
    row on: an older day neither makes a duplicate nor a late row, so it is out of date. The chain runs
    forward in time: a row dated before the last day that earlier epochs hold for its key is late; it goes
    to ``<target>_late`` (posting_id, date, last_date) instead of being flagged, and leaves the state as it
    is. A repeated epoch reads epochs before its own only and overwrites its own output and state."""
    stream = spark.readStream.schema(schema).option("basePath", feed_dir).parquet(feed_dir)
    keys = ["company", "canonical_title"]

    def flag(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        rows = batch.select("posting_id", *keys, "date")
        valid = F.col("company").isNotNull() & F.col("canonical_title").isNotNull() & F.col("date").isNotNull()
        state = last_days(session, state_dir, epoch_id, rows.filter(valid).agg(F.min("date")).first()[0], window_days)
        days = rows.filter(valid).groupBy(*keys, "date").agg(F.min("posting_id").alias("_first")).join(state, keys, "left")
        passed = F.coalesce(F.col("date") < F.col("last_date"), F.lit(False))
        late = rows.join(days.where(passed).select(*keys, "date", "last_date"), [*keys, "date"])
        late.select("posting_id", "date", "last_date").write.mode("overwrite").parquet(f"{target}_late/epoch={epoch_id}")
        rows = rows.join(days.where(passed).select(*keys, "date"), [*keys, "date"], "left_anti")
        w = Window.partitionBy(*keys).orderBy("date")
        days = days.where(~passed).withColumn("_prev", F.coalesce(F.lag("date").over(w), F.col("last_date")))
        flagged = rows.join(days.select(*keys, "date", "_first", "_prev"), [*keys, "date"], "left")
        dup = (F.when(~valid, F.lit(False)).when(F.col("posting_id") != F.col("_first"), F.lit(True))
               .otherwise(F.coalesce(F.datediff("date", "_prev") <= window_days, F.lit(False))))
        (flagged.select("posting_id", dup.alias("is_duplicate"))
         .write.mode("overwrite").parquet(f"{target}/epoch={epoch_id}"))
        touched = days.groupBy(*keys).agg(F.max("date").alias("last_date"))
        (touched.withColumn("month", F.trunc("last_date", "month")).repartition("month")
         .write.mode("overwrite").partitionBy("month").parquet(f"{state_dir}/epoch={epoch_id}"))

    q = (stream.writeStream.foreachBatch(flag).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
