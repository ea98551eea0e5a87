"""Helpers shared by the training-data operators."""
from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.graph import components  # noqa: F401
from hirelens.session import ensure_checkpoint_dir, written  # noqa: F401

# Fixed value: what separates words (ASCII white space); words are runs of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under ``spark.checkpoint.dir`` (shared by all executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or absolute path, usable on any executor."""
    return pafs.FileSystem.from_uri(uri)


def n_words(text) -> F.Column:
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
