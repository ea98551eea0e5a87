"""Shared building blocks for the registered queries.

Operator-level queries (dedup, mapping, extraction, ...) compute from the raw
tables every time. The analysis queries read the *persisted* pipeline output,
as an analysis reads a cleaned postings table: the unified postings
with ``skills_present`` filled (J4) are written once per session and scale
factor, without their texts, which the few queries that read them join, as parquet partitioned by (source, year) under the shared checkpoint
folder (``spark.checkpoint.dir``), then read back - lineage is cut, the write
survives executor loss, and F4 / snapshot predicates prune partitions.
"""
from __future__ import annotations

import hashlib
import threading

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions.dates import snapshot_of
from hirelens.operators import clean as C
from hirelens.operators import taxonomy as TX
from hirelens.schema import UNIFIED_SCHEMA
from hirelens.session import ensure_checkpoint_dir
from hirelens.sources import fixtures as fx

_LOCK = threading.RLock()      # a table may be built from another one
_PERSISTED: dict[tuple[str, str, str], str] = {}


def _version(spark, sf_dir: str) -> str:
    """Names, sizes and times of the input files: a changed input is built anew."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(sf_dir)
    it = path.getFileSystem(sc._jsc.hadoopConfiguration()).listFiles(path, True)
    seen = []
    while it.hasNext():
        f = it.next()
        seen.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
    return hashlib.sha1("\n".join(sorted(seen)).encode()).hexdigest()


def persisted(spark, sf_dir: str, name: str, build, partition_cols=(), even: bool = True) -> DataFrame:
    """Write ``build()`` once per (application, sf_dir, name) to the shared
    checkpoint folder and return the read-back table. Without ``even`` the rows are written where they
    are (whole texts do not travel for the sake of the files' sizes)."""
    app = spark.sparkContext.applicationId
    key = (app, _version(spark, sf_dir), name)
    with _LOCK:
        path = _PERSISTED.get(key)
        if path is None:
            tag = hashlib.sha1(repr(key).encode()).hexdigest()[:12]
            path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{tag}"
            df = build()
            if partition_cols:
                # rebalance on the partition columns: AQE coalesces small output
                # partitions and splits skewed ones, so each (source, year) folder
                # gets few, evenly sized files instead of one file per task
                df = df.hint("rebalance", *partition_cols) if even else df
            w = df.write.mode("overwrite")
            if partition_cols:
                w = w.partitionBy(*partition_cols)
            w.parquet(path)
            _PERSISTED[key] = path
    return spark.read.parquet(path)


def unified_postings(spark, sf_dir: str, with_text: bool = False) -> DataFrame:
    """The unified postings table over the fixture raw postings."""
    return C.unify(fx.postings_raw(spark, sf_dir, with_text=with_text), fx.VALID_YEARS)


def tagged_postings(spark, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Tagged + finalised postings before any scope filter."""
    return C.tag_postings(fx.postings_raw(spark, sf_dir, with_text=with_text))


def lookup(spark, sf_dir: str) -> DataFrame:
    return TX.reverse_lookup(fx.dictionary(spark, sf_dir))


def mapped(spark, sf_dir: str) -> DataFrame:
    """(posting_id, skill, first_pos) for every extracted posting (computed)."""
    return TX.mapped_long(fx.extractions(spark, sf_dir), lookup(spark, sf_dir))


def _doc_copies(docs: DataFrame, *cols: str) -> DataFrame:
    """(doc_id, copy, cols): the rows of each document id, numbered from 1 in the order of ``cols``."""
    w = Window.partitionBy("doc_id").orderBy(*(cols or ("doc_id",)))
    return docs.select(F.col("doc_id").alias("_doc"), F.row_number().over(w).alias("_copy"), *cols)


def with_document(spark, sf_dir: str, df: DataFrame) -> DataFrame:
    """Fixture text attach, first half: each posting's document (see ``fx.doc_of``), one row per row
    that carries its id, as (_doc, _copy). No text is read."""
    docs = fx.table(spark, sf_dir, "documents")
    nid = F.element_at(F.split("posting_id", ":"), -1).cast("long")
    return df.withColumn("_doc", fx.doc_of(docs, nid)).join(_doc_copies(docs), "_doc", "left")


def with_description(spark, sf_dir: str, df: DataFrame) -> DataFrame:
    """Fixture text attach, second half: description = text of the posting's document."""
    text = _doc_copies(fx.table(spark, sf_dir, "documents"), "text").withColumnRenamed("text", "description_text")
    out = df.join(text, ["_doc", "_copy"], "left")
    return out.withColumn("description_text", F.coalesce("description_text", F.lit(""))).drop("_doc", "_copy")


def build_skilled_postings(spark, sf_dir: str) -> DataFrame:
    """Unified postings (T*, F1, F2, F5, W1) with skills_present (J3 + J4) and the document, without its text."""
    skills = TX.map_skills(fx.extractions(spark, sf_dir), lookup(spark, sf_dir))
    u = TX.attach_skills(unified_postings(spark, sf_dir), skills)
    return with_document(spark, sf_dir, u.drop("description_text"))


def _skilled_postings(spark, sf_dir: str) -> DataFrame:
    return persisted(spark, sf_dir, "skilled_postings", lambda: build_skilled_postings(spark, sf_dir), ("source", "year"))


def final_postings(spark, sf_dir: str, with_text: bool = True) -> DataFrame:
    """The persisted unified table (13 columns, skills attached); without texts the narrow table that
    it is built from, so that queries which read no text move none."""
    if not with_text:
        return _skilled_postings(spark, sf_dir).drop("_doc", "_copy")

    def build():
        u = with_description(spark, sf_dir, _skilled_postings(spark, sf_dir))
        return u.select(*UNIFIED_SCHEMA.fieldNames())

    return persisted(spark, sf_dir, "unified_postings", build, ("source", "year"), even=False)


def clean_postings(spark, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Analysis base: persisted unified -> F4 + F6 -> snapshot column; texts are joined on reading."""
    c = clean_documents(spark, sf_dir)
    return with_description(spark, sf_dir, c) if with_text else c.drop("_doc", "_copy")


def clean_documents(spark, sf_dir: str) -> DataFrame:
    """Clean postings with their document (_doc, _copy) for ``with_description``."""
    u = _skilled_postings(spark, sf_dir)
    return C.load_clean(u, (fx.ARTEFACT_SOURCE, fx.ARTEFACT_MIN_YEAR)).withColumn("snapshot", snapshot_of("year", fx.SNAPSHOT_MAP))


def skills_long(spark, sf_dir: str) -> DataFrame:
    """(posting_id, source, snapshot, canonical_title, skill) for clean postings."""
    c = clean_postings(spark, sf_dir)
    return c.select("posting_id", "source", "snapshot", "canonical_title",
                    F.explode("skills_present").alias("skill"))


def clean_with_counts(spark, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Clean postings with n_skills (0 when no mapped skill)."""
    c = clean_postings(spark, sf_dir, with_text=with_text)
    return c.withColumn("n_skills", F.size("skills_present").cast("long"))


def r6(c) -> F.Column:
    """Round a double to 6 decimals (oracle hygiene)."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
