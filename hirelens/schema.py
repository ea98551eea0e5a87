"""Unified postings schema and ``finalise``."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.functions.dates import quarter_label, to_date_safe

# The columns of the unified table, in order.
FINAL_COLS = [
    "posting_id", "source", "date", "year", "quarter",
    "canonical_title", "raw_title", "company", "geo", "seniority",
    "description_text", "skills_present", "is_duplicate",
]

UNIFIED_SCHEMA = T.StructType([
    T.StructField("posting_id", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("year", T.IntegerType(), True),
    T.StructField("quarter", T.StringType(), True),
    T.StructField("canonical_title", T.StringType(), True),
    T.StructField("raw_title", T.StringType(), True),
    T.StructField("company", T.StringType(), True),
    T.StructField("geo", T.StringType(), True),
    T.StructField("seniority", T.StringType(), True),
    T.StructField("description_text", T.StringType(), True),
    T.StructField("skills_present", T.ArrayType(T.StringType(), False), True),
    T.StructField("is_duplicate", T.BooleanType(), True),
])

_DEFAULTS = {
    "skills_present": lambda: F.array().cast(T.ArrayType(T.StringType(), False)),
    "is_duplicate": lambda: F.lit(False),
}


def finalise(df: DataFrame, source_name: str | None = None) -> DataFrame:
    """Set source, add missing columns (null / [] / false), derive date/year/quarter,
    project to FINAL_COLS in order with the unified types."""
    if source_name is not None:
        df = df.withColumn("source", F.lit(source_name))
    for name in ("skills_present", "is_duplicate"):
        if name not in df.columns:
            df = df.withColumn(name, _DEFAULTS[name]())
    dtype = dict(df.dtypes).get("date")
    if dtype is None:
        date = F.lit(None).cast("date")
    elif dtype == "date":
        date = F.col("date")
    elif dtype.startswith("timestamp"):
        date = F.to_date("date")
    else:
        date = to_date_safe(F.col("date"))
    df = df.withColumn("date", date)
    df = df.withColumn("year", F.year("date").cast("int")).withColumn("quarter", quarter_label("date"))
    cols = []
    for f in UNIFIED_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def check_schema(df: DataFrame) -> bool:
    """Column names and types equal the unified schema (nullability not compared)."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in UNIFIED_SCHEMA.fields]
    return got == want
