"""Global ordering, fixed-size batching and batch payloads.

A global consecutive position is computed without a single-partition window:
rows are range-partitioned on the order key and sorted inside each range; each
range's offset comes from a prefix sum over the counts (one row per range).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.session import written


def global_positions(df: DataFrame, order_cols, name: str = "row_id") -> DataFrame:
    """0-based consecutive position of every row in ``order_cols`` order (order must be total).

    Rows are dealt to ranges of the order key, sorted inside each and written once to the
    shared folder with their range and place, so later steps see one fixed numbering. A
    range's offset is the prefix sum over the counts of the ranges (one row per range)."""
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    d = written(df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
                .withColumn("_b", F.spark_partition_id()).withColumn("_i", place), "positions")
    counts = d.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_b", F.coalesce(F.sum("_n").over(
        Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    # one row per range, to every task: the rows themselves stay where they are
    return d.join(F.broadcast(offs), "_b").select((F.col("_off") + F.col("_i")).cast("long").alias(name), *df.columns)


def make_batches(df: DataFrame, order_cols, size: int, name: str = "batch") -> DataFrame:
    """Consecutive groups of ``size`` rows in order."""
    p = global_positions(df, order_cols, "_pos")
    return p.withColumn(name, F.floor(F.col("_pos") / size).cast("long")).drop("_pos")


def batch_payloads(batched: DataFrame, key: str, value: str, batch: str = "batch") -> DataFrame:
    """Per batch, one JSON object ``{key: value}`` (keys sorted); batches are bounded. Of rows that repeat a
    key in a batch the one with the largest value counts; rows without a key are left out (see
    ``payload_rejects``)."""
    # values travel once, to their batch
    rows = batched.where(F.col(key).isNotNull()).select(batch, key, value).repartition(batch)
    g = rows.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v")))).alias("_s"))
    # sorted by key, then value: the last of each key
    last = F.filter("_s", lambda x, i: F.coalesce(F.get("_s", i + 1)["k"] != x["k"], F.lit(True)))
    g = g.select(batch, F.map_from_entries(last).alias("_m"))
    return g.select(batch, F.size("_m").cast("long").alias("n_items"), F.to_json("_m").alias("payload"))


def payload_rejects(batched: DataFrame, key: str, batch: str = "batch") -> DataFrame:
    """Per batch, the rows that are no entry of its payload: without a key, or repeating one."""
    per = batched.groupBy(batch, key).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy(batch).agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("n_without_key"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)), F.lit(0)).alias("n_repeated"))


def pending_batches(batched: DataFrame, done_ids: DataFrame, key: str, batch: str = "batch") -> DataFrame:
    """A batch is pending unless ALL its ids are done."""
    done = done_ids.select(F.col(key)).distinct().withColumn("_done", F.lit(True))
    j = batched.select(batch, key).join(done, key, "left")
    g = j.groupBy(batch).agg(F.count(F.lit(1)).alias("n_ids"),
                             F.count_if(F.coalesce("_done", F.lit(False))).alias("n_done"))
    return g.filter(F.col("n_done") < F.col("n_ids"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A reproducible sample of n rows (MD5 of seed and key; TakeOrdered, no global sort)."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key)).cast("binary")), key).limit(n)
