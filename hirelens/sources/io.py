"""Sources and sinks.

Readers take explicit schemas (no inference pass over the data). Sinks write to
paths under a caller-given root; queries that round-trip use a fresh folder in
the shared checkpoint location (``spark.checkpoint.dir``), never a
machine-local temp folder.
"""
from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.functions.text import last_entries, yaml_scalar
from hirelens.session import ensure_checkpoint_dir, shuffles_released

EXTRACTIONS_TYPE = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/out/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


# ---- whole texts in slices ---------------------------------------------------
SLICE_BYTES = 1 << 30     # of text a core, in one slice


def slice_count(spark: SparkSession, n_rows: int, mean_bytes: float) -> int:
    """Slices of ``n_rows`` rows of ``mean_bytes`` each, so that a slice has ``SLICE_BYTES`` a core."""
    return max(1, -(-int(n_rows * mean_bytes) // (SLICE_BYTES * spark.sparkContext.defaultParallelism)))


def key_slices(df: DataFrame, key: str, n: int) -> list:
    """Conditions that deal the rows to at most ``n`` slices of about as many rows, in ascending order of
    ``key`` (nulls first); equal keys stay together."""
    if n == 1:
        return [F.lit(True)]
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0]
    cuts = sorted({*(cuts or [])})
    c = F.col(key)
    if not cuts:
        return [F.lit(True)]
    return [c.isNull() | (c <= cuts[0]), *((c > a) & (c <= b) for a, b in zip(cuts, cuts[1:])), c > cuts[-1]]


@contextmanager
def bucketed(df: DataFrame, key: str, name: str):
    """``df`` dealt to buckets of ``key`` on the shared folder: joins on ``key`` that read it move the other
    side alone. Rows without a key are left out; the table goes at the end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with shuffles_released(spark):
        (df.where(F.col(key).isNotNull()).repartition(n, key).write.bucketBy(n, key)
         .option("compression", "zstd").option("path", path).saveAsTable(table))
    try:
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
        remove_folder(spark, path)


def through_files(spark: SparkSession, slices, write, read, name: str) -> DataFrame:
    """What ``read(path)`` makes of the files that ``write(slice, path)`` makes of each slice, in turn, as one
    narrow table. A slice's files and shuffles go when it has been read, so the disk holds one slice of
    texts at a time. Paths ascend with the slices."""
    files, kept = scratch_path(spark, name), scratch_path(spark, f"{name}_rows")
    for i, part in enumerate(slices):
        with shuffles_released(spark):
            write(part, f"{files}/{i:06d}")
            read(f"{files}/{i:06d}").write.parquet(f"{kept}/slice={i}")
        remove_folder(spark, f"{files}/{i:06d}")
    return spark.read.parquet(kept).drop("slice")


# ---- S1/S2: CSV with multi-line fields ---------------------------------------
def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Header CSV, quoted fields may hold newlines, explicit schema."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').option("quote", '"').csv(path))


# Feeds with whole texts are written as gzip at the fast level: a file that holds line feeds in quotes is read by
# one task anyway, so compression takes no parallelism away.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"').options(**options).csv(path)


def consecutive_ids(df: DataFrame, bucket, order, name: str = "row_id", start: int = 0) -> DataFrame:
    """Consecutive ids in (bucket, order) order without a single-partition window
    (SURVEY §7.4): count rows per bucket, prefix-sum the small per-bucket table,
    number rows inside each bucket (window partitioned by bucket), add the offset.
    ``bucket`` must be a coarse, order-preserving key (file, id range, ...)."""
    bucket = [bucket] if isinstance(bucket, str) else list(bucket)
    order = [order] if isinstance(order, str) else list(order)
    counts = df.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy(*bucket).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rn = F.row_number().over(Window.partitionBy(*bucket).orderBy(*order))
    j = df.withColumn("_rn", rn).join(counts.select(*bucket, "_off"), bucket)
    return j.select((F.col("_off") + F.col("_rn") - 1 + start).cast("long").alias(name), *df.columns)


def row_places(df: DataFrame) -> DataFrame:
    """Each row of a scan with its file and an id that rises by one a row inside the file."""
    return df.withColumn("_file", F.col("_metadata.file_path")).withColumn("_mid", F.monotonically_increasing_id())


def with_row_position(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Consecutive 0-based row position in file order (file path, then line order).
    Multi-line CSV files are not splittable, so one file = one split and the
    monotonically increasing id rises by one a row inside a file: a row's position is the
    rows of the files before (one row per file, which every task gets) and the ids since
    the file's first. The rows themselves do not travel. Rows that have their places already
    (``row_places``, kept in a narrow table) are not looked up in their files again."""
    d = df if "_mid" in df.columns else row_places(df)
    files = d.groupBy("_file").agg(F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (d.join(F.broadcast(files.select("_file", "_first", before.alias("_off"))), "_file")
            .select((F.col("_off") + F.col("_mid") - F.col("_first")).cast("long").alias(name),
                    *(c for c in df.columns if c not in ("_file", "_mid"))))


# ---- S3/S4: tagged multi-file parquet with schema drift ----------------------
def read_tagged_union(spark: SparkSession, paths: dict[str, str], tag_col: str = "_ats") -> DataFrame:
    """S3: read several parquet files, tag each with its name, union by name
    (columns missing in one file become null)."""
    frames = [spark.read.parquet(p).withColumn(tag_col, F.lit(tag)) for tag, p in paths.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def resolve_column(df: DataFrame, candidates: list[str], alias: str, per_row: bool = False):
    """First existing candidate column (plan-time pick); ``per_row=True`` takes the
    first non-null value among the existing candidates (coalesce) instead."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return F.lit(None).cast("string").alias(alias)
    if per_row:
        return F.coalesce(*[F.col(c) for c in present]).alias(alias)
    return F.col(present[0]).alias(alias)


# ---- S5/S6/S7: unified parquet sinks and read-back check ---------------------
def write_unified(df: DataFrame, path: str, partition_cols=("source", "year")) -> None:
    """Partitioned parquet (partition pruning for source / year predicates)."""
    df.hint("rebalance", *partition_cols).write.mode("overwrite").partitionBy(*partition_cols).parquet(path)


def write_clean(df: DataFrame, path: str) -> None:
    """Non-duplicates only."""
    df.filter(~F.col("is_duplicate")).write.mode("overwrite").parquet(path)


def describe_schema(df: DataFrame) -> list[tuple[int, str, str]]:
    return [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]


# ---- S8: raw extractions as JSON objects ---------------------------------------
def write_extractions_json(long_df: DataFrame, path: str, batch_col: str = "batch") -> None:
    """S8 sink: one JSON object ``{posting_id: [terms...]}`` per line per batch
    (JSON Lines of objects, splittable, instead of one file-sized object). Rows without an
    id can have no key and are left out."""
    per_posting = long_df.groupBy(batch_col, "posting_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]).alias("terms"))
    per_batch = per_posting.where(F.col("posting_id").isNotNull()).groupBy(batch_col).agg(
        F.map_from_entries(F.collect_list(F.struct("posting_id", "terms"))).alias("m"))
    per_batch.select(F.to_json("m").alias("value")).write.mode("overwrite").text(path)


def read_extractions_json(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """S8 source: JSON object(s) ``posting_id -> [term]`` to the long table
    ``(posting_id, pos, term)`` with 1-based positions; an empty list keeps the
    posting with a null term; of equal ids in one object the last one counts."""
    txt = spark.read.text(path, wholetext=whole_file)
    m = txt.select(F.from_json("value", EXTRACTIONS_TYPE).alias("m")).filter(F.col("m").isNotNull())
    kv = m.select(F.explode(last_entries("m")).alias("e")).select(F.col("e.key").alias("posting_id"), F.col("e.value").alias("terms"))
    return kv.select("posting_id", F.posexplode_outer("terms").alias("pos", "term")).select(
        "posting_id", (F.col("pos") + 1).cast("int").alias("pos"), "term")


# ---- S9/S10: skill dictionary as YAML text -----------------------------------
def yaml_string(c):
    j = F.to_json(F.array(c))          # ["text"] -> "text" (JSON string = YAML double-quoted scalar)
    return j.substr(F.lit(2), F.length(j) - 2)


def write_dictionary_yaml(dictionary: DataFrame, path: str, header: str = "# skills dictionary") -> None:
    """YAML ``"canonical":`` / ``  - "alias"`` lines sorted case-insensitively by
    canonical, aliases in seq order, header + blank line first. Lines are
    range-partitioned on the canonical sort key, so every canonical's block stays
    in one file and files are written in sort order (no single-task collect)."""
    key = F.concat(F.lower("canonical"), F.lit("\u0000"), F.col("canonical"))
    keys = dictionary.select(key.alias("_k"), "canonical").distinct()
    key_lines = keys.select("_k", F.lit(-1).cast("long").alias("_o"),
                            F.concat(yaml_string(F.col("canonical")), F.lit(":")).alias("value"))
    alias_lines = dictionary.select(key.alias("_k"), F.col("seq").cast("long").alias("_o"),
                                    F.concat(F.lit("  - "), yaml_string(F.col("alias"))).alias("value"))
    head = dictionary.sparkSession.createDataFrame(
        [("", i, ln) for i, ln in enumerate(header.split("\n") + [""])], "_k string, _o long, value string")
    lines = head.unionByName(key_lines).unionByName(alias_lines)
    (lines.repartitionByRange("_k").sortWithinPartitions("_k", "_o").select("value")
     .write.mode("overwrite").text(path))


def read_dictionary_yaml(spark: SparkSession, path: str) -> DataFrame:
    """Skip the header up to the first blank line, carry the running key over
    ``- alias`` lines. Returns ``(canonical, alias, seq)`` with seq = line order."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("_file"), "value")
    lines = files.select("_file", F.posexplode(F.split("value", "\n")).alias("ln", "line"))
    blank = F.min(F.when(F.col("line") == "", F.col("ln"))).over(Window.partitionBy("_file"))
    first_file = F.col("_file") == files.agg(F.min("_file")).scalar()
    lines = lines.withColumn("_hdr_end", F.when(first_file, blank))
    lines = lines.filter(F.col("_hdr_end").isNull() | (F.col("ln") > F.col("_hdr_end")))
    is_key = F.col("line").rlike(r"(?s)^[^\s#].*:\s*$")
    lines = lines.withColumn("_key", F.when(is_key, yaml_scalar(F.regexp_extract("line", r"(?s)^(.*):\s*$", 1))))
    w = Window.partitionBy("_file").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("canonical", F.last("_key", ignorenulls=True).over(w))
    items = lines.filter(F.col("line").rlike(r"^\s+-\s")).select(
        "_file", "ln", "canonical", yaml_scalar(F.regexp_replace("line", r"^\s+-\s+", "")).alias("alias"))
    return consecutive_ids(items, "_file", "ln", "seq", start=1).select("canonical", "alias", "seq")


# ---- S11/S16: category CSV and flat taxonomy CSV -----------------------------
CATEGORY_SCHEMA = "canonical_name string, category string, subcategory string, platform_family string"
TAXONOMY_SCHEMA = "canonical_name string, aliases string, category string, introduced int"


def read_slots(spark: SparkSession, path: str) -> DataFrame:
    """T18 slot table from CSV ``category, slot, pattern``: (seq, category, slot, pattern) with seq =
    order in the files."""
    rows = read_csv(spark, path, "category string, slot string, pattern string")
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    # ids rise along a file; files are ordered by name
    first = rows.groupBy("_file").agg(F.min("_at").alias("_min"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (rows.join(first.select("_file", "_min", before.alias("_off")), "_file")
            .select((F.col("_off") + F.col("_at") - F.col("_min")).alias("seq"), "category", "slot", "pattern"))


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """One row per alias from ``canonical_name, aliases (a|b|c), category, introduced``."""
    t = read_csv(spark, path, TAXONOMY_SCHEMA)
    return t.select("canonical_name", F.explode(F.split("aliases", r"\|")).alias("alias"), "category", "introduced")


# ---- S12: analysis-table sinks ----------------------------------------------------------
def write_analysis_table(df: DataFrame, root: str, name: str) -> str:
    """One header CSV folder per analysis under ``root/tables/<name>``."""
    path = f"{root.rstrip('/')}/tables/{name}"
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
