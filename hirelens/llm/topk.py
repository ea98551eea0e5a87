"""Exact top-k inner-product search, a block of vectors at a time.

Components become integers floor(scale * x). Rows are clustered by k-means and cut into blocks of
bounded size inside a cluster, so that rows of a block resemble each other. A table holds per
block the largest and smallest value of each dimension, the mean and the radius around it. For a query
two bounds hold for every score in a block, and the smaller one counts: the sum of the larger products
per dimension, and the mean's score plus radius times the query's length.

* Seeds: each query scores the blocks of its highest bounds (``seeds`` of them, more while they
  have no more than k rows). The k-th score found is its floor.
* Rest: only blocks whose bound reaches the floor are scored. Bounds are met on the table of
  summaries, before any vector moves: a block travels to a group of queries only if it may
  hold a result of one of them, and only those queries score it.

Queries of neighbouring clusters form groups of bounded size, so every task group (queries x summaries,
queries x block) is bounded. Vectors without clusters, as noise in many dimensions, leave all bounds above the
floors; then every block is scored. The clusters are fitted on a bounded sample (``sample`` rows by hash,
fewer for wide vectors); it shapes the blocks and moves no result.

Nulls, ties, edges: vectors that are null or hold null or non-finite components take no
part; an empty vector or a shorter one counts as padded with zeros; rows that repeat a vec_id
are all candidates, save for queries of that id, and as queries rank their candidates together;
a null vec_id takes no part; ties go to the smaller vec_id; an empty table gives no row. Scores are exact 64-bit integers; beyond that
range they stop at its ends.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import written

_OUT = "query_id long, vec_id long, score long"
_I64 = np.iinfo(np.int64)
_MARGIN = 1e-9                          # rounding of bounds, relative


def clean_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding as array<double>) of the rows that take part."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return v.where(~bad)


def to_matrix(rows, scale: float, dim: int) -> np.ndarray:
    """Rows of floor(scale * x), padded with zeros; float64, which holds such values exactly."""
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return np.floor(out * scale)


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer products as int64: in doubles while every partial sum fits 53 bits."""
    most = (np.abs(q).max(initial=0) or 1) * (np.abs(v).max(initial=0) or 1) * max(1, q.shape[1])
    if most < 2**53:
        return (q @ v.T).astype(np.int64)
    if most < 2**62:
        return q.astype(np.int64) @ v.astype(np.int64).T
    big = np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in v], object).T
    return np.clip(big, _I64.min, _I64.max).astype(np.int64)


def fit_centres(sample: np.ndarray, n: int, rounds: int = 6) -> np.ndarray:
    """At most ``n`` k-means centres of ``sample``, in the order of their strongest direction."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    top = min(np.abs(sample).max(), np.finfo(float).max) or 1.0
    x = np.nan_to_num(sample / top)
    centres = np.unique(x[:: max(1, len(x) // n)][:n], axis=0)
    for _ in range(rounds):
        near = nearest(x, centres)
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=len(centres))[:, None]
        centres = np.where(count > 0, total / np.maximum(count, 1), centres)
    _, _, axes = np.linalg.svd(centres - centres.mean(axis=0), full_matrices=False)
    return centres[np.argsort(centres @ axes[0], kind="stable")] * top


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (x @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)


def summary(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Largest and smallest value per dimension, mean, and the radius around it."""
    with np.errstate(all="ignore"):
        mean = v.mean(axis=0)
        return v.max(axis=0), v.min(axis=0), mean, float(np.sqrt(((v - mean) ** 2).sum(axis=1).max()))


def bounds(q: np.ndarray, hi: np.ndarray, lo: np.ndarray, mean: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """Queries x blocks: no score in the block is larger. What can't be computed is infinite."""
    with np.errstate(all="ignore"):
        per_dim = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
        ball = q @ mean.T + np.sqrt((q**2).sum(axis=1))[:, None] * radius
        slack = np.abs(q) @ np.maximum(np.abs(hi), np.abs(lo)).T
        out = np.fmin(per_dim, ball) + _MARGIN * slack
    return np.where(np.isnan(out), np.inf, out)


def best_of(q_ids, q, floors, v_ids, v, k: int):
    """The k best rows of a block for each query, none below its floor: query_id, vec_id, score columns."""
    s = _scores(q, v)
    ok = (v_ids[None, :] != q_ids[:, None]) & (s >= floors[:, None])
    if k < len(v_ids):                                  # what is below a query's k-th score goes first
        kth = np.partition(np.where(ok, s, _I64.min), len(v_ids) - k, axis=1)[:, len(v_ids) - k]
        ok &= s >= kth[:, None]
    i, j = np.nonzero(ok)
    order = np.lexsort((v_ids[j], ~s[i, j], i))         # ~s falls as s rises
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    i, j = i[place < k], j[place < k]
    return q_ids[i], v_ids[j], s[i, j]


class Blocks:
    """``vectors`` in blocks with their summaries, and ``queries`` in groups."""

    def __init__(self, queries: DataFrame, vectors: DataFrame, k: int, scale: float, slice_rows: int,
                 query_rows: int, block: int, sample: int, seeds: int):
        self.k, self.scale, self.seeds = k, scale, seeds
        q, v = clean_vectors(queries), clean_vectors(vectors)
        size = v.agg(F.count("*").alias("n"), F.max(F.size("embedding")).alias("dim")).first()
        wide = q.agg(F.max(F.size("embedding"))).first()[0] or 0
        self.dim = max(1, size["dim"] or 0, wide)
        block = max(16, min(block, (8 << 20) // (8 * self.dim)))
        sample = max(64, min(sample, (64 << 20) // (8 * self.dim)))
        some = v.select("embedding").orderBy(F.xxhash64("embedding", "vec_id")).limit(sample).toPandas()
        self.centres = fit_centres(to_matrix(some["embedding"], scale, self.dim), max(1, min(sample // 8, -(-size["n"] // block))))
        v, q = (written(self._in_cells(x), "topk-cells") for x in (v, q))
        # one row per cluster: the sample bounds their number
        own = sorted((r["cell"], r["count"]) for r in v.groupBy("cell").count().collect())
        parts = [-(-n // block) for _, n in own]
        self.n_blocks = sum(parts)
        self.v = written(self._dealt(v, [(c, float(sum(parts[:i])), float(parts[i])) for i, (c, _) in enumerate(own)])
                         .select(F.col("at").alias("blk"), "vec_id", "embedding"), "topk-rows")
        own = sorted((r["cell"], r["count"]) for r in q.groupBy("cell").count().collect())
        n = np.array([0] + [n for _, n in own]) / query_rows
        self.n_groups = max(1, int(np.ceil(n.sum())))
        self.q = written(self._dealt(q, [(c, float(n[: i + 1].sum()), float(n[i + 1])) for i, (c, _) in enumerate(own)])
                         .select(F.col("at").alias("grp"), F.col("vec_id").alias("query_id"), "embedding"), "topk-queries")
        per = max(1, slice_rows // block)
        self.n_slices = max(1, -(-self.n_blocks // per))
        self.summaries = written(self._summaries(), "topk-blocks")

    def _in_cells(self, rows: DataFrame) -> DataFrame:
        """Rows with their cluster and a number in [0, 1) that deals rows of a cluster, copies included."""
        centres, scale, dim = self.centres, self.scale, self.dim

        def assign(batches):
            for b in batches:
                cell = nearest(to_matrix(b.column(1).to_pandas(), scale, dim), centres) if b.num_rows else []
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell, pa.int32())], ["vec_id", "embedding", "u", "cell"])

        u = F.pmod(F.xxhash64("vec_id", "embedding", F.monotonically_increasing_id()), F.lit(1 << 30)) / F.lit(float(1 << 30))
        return rows.select("vec_id", "embedding", u.alias("u")).mapInArrow(
            assign, "vec_id long, embedding array<double>, u double, cell int")

    def _dealt(self, rows: DataFrame, places: list[tuple[int, float, float]]) -> DataFrame:
        """Rows with a place ``at``: of a cluster (cell, first, width) at first + u * width."""
        of = rows.sparkSession.createDataFrame(places, "cell int, first double, width double")
        return rows.join(F.broadcast(of), "cell").withColumn("at", F.floor(F.col("first") + F.col("u") * F.col("width")))

    def _summaries(self) -> DataFrame:
        scale, dim, n_slices = self.scale, self.dim, self.n_slices

        def run(key, pdf):
            hi, lo, mean, radius = summary(to_matrix(pdf["embedding"], scale, dim))
            return pd.DataFrame({"blk": [key[0]], "slice": [key[0] % n_slices], "n": [len(pdf)], "hi": [hi], "lo": [lo],
                                 "mean": [mean], "radius": [radius]})

        return self.v.groupBy("blk").applyInPandas(
            run, "blk long, slice long, n long, hi array<double>, lo array<double>, mean array<double>, radius double")

    def _bounded(self, queries: DataFrame, choose, schema: str) -> DataFrame:
        """``choose(query rows, summaries, bounds)`` for every group of queries and slice of summaries."""
        scale, dim = self.scale, self.dim

        def run(q, b):
            if not len(q) or not len(b):
                return choose(q[:0], b[:0], np.zeros((0, 0)))
            m = [np.stack(b[c].to_list()) for c in ("hi", "lo", "mean")]
            return choose(q, b, bounds(to_matrix(q["embedding"], scale, dim), *m, b["radius"].to_numpy()))

        def numbers(n):
            return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))

        left = queries.withColumn("slice", numbers(self.n_slices)).groupBy("grp", "slice")
        right = self.summaries.withColumn("grp", numbers(self.n_groups)).groupBy("grp", "slice")
        return left.cogroup(right).applyInPandas(run, schema)

    def near(self) -> DataFrame:
        """Seeds (query_id, blk): the blocks of each query's highest bounds."""
        k, seeds = self.k, self.seeds

        def choose(q, b, bound):
            if not len(q):
                return pd.DataFrame({"query_id": [], "blk": [], "n": [], "bound": []})
            turn = np.argsort(-bound, axis=1, kind="stable")
            n = b["n"].to_numpy()[turn]
            i, j = np.nonzero((np.arange(len(b)) < seeds) | (n.cumsum(axis=1) - n <= k))
            at = turn[i, j]
            return pd.DataFrame({"query_id": q["query_id"].to_numpy()[i], "blk": b["blk"].to_numpy()[at],
                                 "n": b["n"].to_numpy()[at], "bound": bound[i, at]})

        found = self._bounded(self.q, choose, "query_id long, blk long, n long, bound double")
        found = found.groupBy("query_id", "blk").agg(F.max("bound").alias("bound"), F.first("n").alias("n"))
        w = Window.partitionBy("query_id").orderBy(F.desc("bound"), "blk")
        before = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return (found.withColumn("r", F.row_number().over(w)).withColumn("before", before)
                .where((F.col("r") <= seeds) | (F.col("before") <= k)).select("query_id", "blk"))

    def reachable(self, floors: DataFrame) -> DataFrame:
        """(query_id, blk) of the blocks that may hold a score at or above the query's floor (query_id, low)."""
        def choose(q, b, bound):
            if not len(q):
                return pd.DataFrame({"query_id": [], "blk": []})
            low = q["low"].to_numpy("float64", na_value=-np.inf)
            i, j = np.nonzero(bound >= (low - _MARGIN * np.where(np.isfinite(low), np.abs(low), 0))[:, None])
            return pd.DataFrame({"query_id": q["query_id"].to_numpy()[i], "blk": b["blk"].to_numpy()[j]})

        return self._bounded(self.q.join(floors, "query_id", "left"), choose, "query_id long, blk long").distinct()

    def scored(self, pairs: DataFrame, floors: DataFrame | None = None) -> DataFrame:
        """Per pair (query_id, blk) the k best rows of the block, none below the query's floor."""
        k, scale, dim = self.k, self.scale, self.dim

        def run(q, b):
            if not len(q) or not len(b):
                return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
            low = np.array([_I64.min if pd.isna(x) else int(x) for x in q["low"]], np.int64)
            x, y, s = best_of(q["query_id"].to_numpy("int64"), to_matrix(q["embedding"], scale, dim), low,
                              b["vec_id"].to_numpy("int64"), to_matrix(b["embedding"], scale, dim), k)
            return pd.DataFrame({"query_id": x, "vec_id": y, "score": s})

        q = (self.q.withColumn("low", F.lit(None).cast("decimal(20,0)")) if floors is None
             else self.q.join(floors.withColumn("low", F.col("low").cast("decimal(20,0)")), "query_id", "left"))
        q = q.join(pairs, "query_id").select("grp", "blk", "query_id", "embedding", "low")
        wanted = q.select(F.col("grp").alias("to"), F.col("blk").alias("of")).distinct()
        v = self.v.join(wanted, self.v["blk"] == wanted["of"]).select("to", "of", "vec_id", "embedding")
        return q.groupBy("grp", "blk").cogroup(v.groupBy("to", "of")).applyInPandas(run, _OUT)


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 10, scale: float = 1024.0, slice_rows: int = 1 << 19,
          query_rows: int = 256, block: int = 512, sample: int = 4096, seeds: int = 2) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest integer inner product for each row of
    ``queries`` (same columns), a query's own vec_id left out: query_id, rank, vec_id, score.

    block: rows of a block at most, some more by the hash that deals them; query_rows: queries of a group;
    slice_rows: rows whose summaries one task bounds; sample: rows that shape the clusters; seeds: blocks
    that give a query its floor.
    """
    blocks = Blocks(queries, vectors, k, scale, slice_rows, query_rows, block, sample, seeds)
    near = written(blocks.near(), "topk-near")
    first = written(ranked(blocks.scored(near), k), "topk-first")
    floors = (first.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
              .where(F.col("n") == k).select("query_id", "low"))
    rest = written(blocks.reachable(floors).join(near, ["query_id", "blk"], "left_anti"), "topk-rest")
    found = first.select("query_id", "vec_id", "score").union(blocks.scored(rest, floors))
    return ranked(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
