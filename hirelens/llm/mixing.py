"""Mixing sources to target weights with nested hash-threshold histograms.

Every document has a 60-bit hash. A source whose target is r whole passes over its words
plus a remainder takes each document r times, and once more if its hash lies below the
source's threshold. Thresholds come from histograms: words are summed by source and
hash bucket, the bucket in which the running sum crosses the remainder is found per
source, and only that boundary bucket is split into finer buckets, until a bucket is one
hash value. Documents are filtered by comparing a number; they are never sorted.

Sources in code-point order, null last, weigh ``weights`` repeating. Together they share
the words of the input; a target stops at ``max_repeats`` times its source's words and the
excess is shared anew by weight until no target is above. Since the shares are in
proportion, the sources that stop are those with the least words for their weight; they are
found in one pass over the source totals (one row per source).

Nulls, ties, edges: a null or empty text has size 0; a null source is a source; documents
equal in doc_id and text share a hash and are taken alike; the boundary document is taken
if that brings the source nearer to its target; an empty table gives no row.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import n_words, written

BITS, LEVELS = 15, 4                                   # 60 bits in 4 levels
_TOP = BITS * LEVELS


def doc_hash(seed: str = "mix"):
    """60-bit hash of (doc_id, text) under ``seed``: 0 .. 2**60 - 1."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                   F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def targets(slim: DataFrame, weights=(1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """Per source: source_size, target (double), repeats (whole passes), rest (words beyond them)."""
    s = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    s = s.withColumn("weight", w.cast("decimal(38,0)"))
    size = F.col("source_size").cast("decimal(38,0)")
    s = s.withColumn("cap", size * F.lit(max_repeats).cast("decimal(2,0)"))
    # least room for its weight first: the sources that stop at their cap are a prefix
    order = Window.orderBy(F.col("cap").cast("double") / F.col("weight").cast("double"),
                           F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    s = (s.withColumn("left", F.sum(size).over(everything) - F.coalesce(F.sum("cap").over(before), zero))
         .withColumn("weights", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)))
    d = {c: F.col(c).cast("double") for c in ("left", "weight", "weights", "cap")}
    s = s.withColumn("_stops", d["left"] * d["weight"] > d["cap"] * d["weights"])
    s = s.withColumn("_rank", F.row_number().over(order))
    s = s.withColumn("_first", F.min(F.when(~F.col("_stops"), F.struct("_rank", "left", "weights"))).over(everything))
    share = F.col("_first.left").cast("double") * d["weight"] / F.col("_first.weights").cast("double")
    t = F.when(F.col("_stops") | F.col("_first").isNull(), d["cap"]).otherwise(F.least(share, d["cap"]))
    s = s.withColumn("target", F.when(F.col("source_size") == 0, F.lit(0.0)).otherwise(t))
    reps = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeats)))
    s = s.withColumn("repeats", reps.cast("long"))
    return s.select("source", "source_size", "target", "repeats",
                    (F.col("target") - F.col("repeats") * F.col("source_size")).alias("rest"))


def thresholds(slim: DataFrame, per_source: DataFrame) -> DataFrame:
    """Adds ``below``: a document is taken once more if its hash is < below."""
    state = (per_source.withColumn("prefix", F.lit(0).cast("long")).withColumn("sum", F.lit(0).cast("long")))
    for level in range(1, LEVELS + 1):
        shift = _TOP - BITS * level
        held = state.select(F.col("source").alias("_s"), "rest", F.col("sum").alias("_sum"), "prefix")
        hist = (slim.join(held, slim["source"].eqNullSafe(held["_s"]) &
                          (F.shiftright("hash", shift + BITS) == F.col("prefix")))
                .groupBy("source", F.shiftright("hash", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("_sum").alias("_sum")))
        upto = F.col("_sum") + F.sum("words").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        hist = hist.withColumn("upto", upto)
        # the first bucket that reaches the remainder; what lies before it is taken whole
        at = F.col("upto") >= F.col("rest")
        found = hist.where(at).groupBy("source").agg(F.min(F.struct("bucket", "upto", "words")).alias("f"))
        found = found.select(F.col("source").alias("_s"), F.col("f.bucket").alias("prefix"),
                             (F.col("f.upto") - F.col("f.words")).alias("sum"), F.col("f.words").alias("edge"))
        state = (state.drop("prefix", "sum", "edge")
                 .join(found, state["source"].eqNullSafe(found["_s"]), "left").drop("_s"))
        state = written(state, "mix")
    # the last bucket is one hash value: in, if that is nearer
    over = F.col("sum") + F.col("edge") - F.col("rest")
    take = F.col("rest") - F.col("sum") > over
    below = (F.when(F.col("rest") <= 0, F.lit(0))
             .when(F.col("prefix").isNull(), F.lit(1 << _TOP))
             .otherwise(F.col("prefix") + take.cast("long")))
    return state.withColumn("below", below.cast("long"))


def slim(docs: DataFrame, seed: str = "mix") -> DataFrame:
    return docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), doc_hash(seed).alias("hash"))


def plan(docs: DataFrame, weights=(1, 2, 3), max_repeats: int = 3, seed: str = "mix"):
    """(slim rows: doc_id, source, size, hash; per source: target, repeats, below)."""
    rows = written(slim(docs, seed), "mix-docs")
    per = written(targets(rows, weights, max_repeats), "mix-sources")
    return rows, thresholds(rows, per)


def _times(df: DataFrame, per: DataFrame) -> DataFrame:
    """``df`` with the columns of its source and ``times``, how often it is taken."""
    s = per.select(F.col("source").alias("_s"), "source_size", "target", "repeats", "below")
    return (df.join(s, df["source"].eqNullSafe(F.col("_s")), "left").drop("_s")
            .withColumn("times", F.col("repeats") + (F.col("hash") < F.col("below")).cast("long"))
            .drop("repeats", "below"))


def mix_report(docs: DataFrame, weights=(1, 2, 3), max_repeats: int = 3, seed: str = "mix") -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, times, taken (words, repeats counted)."""
    rows, per = plan(docs, weights, max_repeats, seed)
    out = _times(rows, per).withColumn("taken", F.col("size") * F.col("times"))
    return out.select("doc_id", "source", "size", "source_size", "target", "times", "taken")


def mix(docs: DataFrame, weights=(1, 2, 3), max_repeats: int = 3, seed: str = "mix") -> DataFrame:
    """The mixed documents themselves: each row as often as it is taken, columns unchanged."""
    _, per = plan(docs, weights, max_repeats, seed)
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "source", doc_hash(seed).alias("hash"))
    out = _times(row, per).where("times > 0")
    return (out.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("_row.*"))
