"""Hard negatives of anchor vectors, exact, over lists that clustered anchors share.

Components become integers floor(scale * x); a score is the integer inner product. An anchor's
positives are its best rows of the same label; a positive's hard negatives are the best rows
of other labels whose score lies between ``low`` percent and all of the positive's score.

Method. Directions are clustered (spherical k-means over a bounded sample); each row belongs to the nearest
centroid's cell and to a slice of bounded size of it. Anchors of neighbouring cells form groups of
bounded size. For u with an angle of at most r to a centre and a row i at angle t to it,
u.i <= |u| |i| cos(max(0, t - r)). That bound is used twice:

* between cells, on a table of group and slice summaries: a slice travels to a group only
  if a row of it may reach what some anchor of the group still needs;
* inside a task, for each cluster of anchors (those of one cell): the slice's rows are sorted
  once by their bound for the cluster, and all members walk that list, a block at a time,
  until the next bound shows that no further row can enter a member's result.

Three rounds: positives in the slices next to each anchor, which give a first k-th score; positives in all other
slices that may beat it; negatives, whose lower end is then known exactly.

The sample for the centroids (``sample`` rows by hash, fewer for wide vectors) only shapes the
cells; every row is indexed and every result is exact, whatever the cells are.

Nulls, ties, edges: rows with a null vec_id, label or vector, or with a null or non-finite component take
no part; shorter vectors are padded with zeros; ties go to the smaller vec_id; rows that share
an anchor's vec_id are neither its positives nor its negatives; other rows that repeat a vec_id are candidates
of their own; anchors alike in vec_id, label and vector count once, unlike ones that share a
vec_id are anchors of their own; an empty table, or one without anchors, gives no row. Other columns are not
read. Scores are exact 64-bit integers; beyond that range they stop at its ends.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import written
from hirelens.llm.topk import _scores, to_matrix

_I64 = np.iinfo(np.int64)
_EMPTY = _I64.max                      # id of a free place in a result
_SLACK = 1e-6                          # radians, above the error of arccos
_FOUND = "akey long, anchor_id long, vec_id long, score long"
_CANDIDATES = "akey long, anchor_id long, place int, positive_id long, positive_score long, vec_id long, score long"


def unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows scaled to length one (zero rows stay zero), and their lengths."""
    top = np.abs(m).max(axis=1, initial=0)
    safe = np.where(top > 0, top, 1)[:, None]
    n = np.linalg.norm(m / safe, axis=1)
    return m / safe / np.where(n > 0, n, 1)[:, None], n * safe[:, 0]


def angles(units: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ centre, -1, 1))


def fit_cells(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means: at most ``n`` unit centroids."""
    u, length = unit(sample)
    u = np.unique(u[length > 0], axis=0)
    if not len(u):
        return np.zeros((1, sample.shape[1]))
    c = u[np.linspace(0, len(u) - 1, min(n, len(u))).astype(int)]
    for _ in range(rounds):
        own = (u @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, u)
        new, length = unit(sums)
        c = np.where(length[:, None] > 0, new, c)
    return c


def shared_list(members: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``rows`` by the bound that holds for every member (per unit of its length), and the bounds."""
    u, _ = unit(members)
    centre = unit(u.sum(axis=0, keepdims=True))[0][0]
    if not centre.any():
        centre = u[0]
    reach = angles(u, centre).max()
    v, length = unit(rows)
    bound = length * np.cos(np.maximum(0, angles(v, centre) - reach - _SLACK))
    order = np.lexsort((ids, -bound))
    return order, bound[order]


def _above(length: np.ndarray, bound: float) -> np.ndarray:
    """Bounds on the scores of members, rounded up."""
    b = length * bound
    return b + 1e-9 * np.abs(b) + 1e-6


def _merge(s, i, more_s, more_i, k):
    s, i = np.concatenate([s, more_s], axis=1), np.concatenate([i, more_i], axis=1)
    best = np.lexsort((i, ~s), axis=1)[:, :k]                     # ~s falls as s rises
    return np.take_along_axis(s, best, 1), np.take_along_axis(i, best, 1)


def walk_best(members, ids, floor, rows, row_ids, k: int, step: int = 256):
    """The ``k`` best rows per member, those with its own id left out, as (scores, ids), and the
    number of products made. ``floor``: a score that k rows elsewhere are known to reach."""
    s = np.full((len(members), k), _I64.min)
    i = np.full((len(members), k), _EMPTY)
    order, bound = shared_list(members, rows, row_ids)
    length = unit(members)[1]
    live, made = np.arange(len(members)), 0
    for lo in range(0, len(order), step):
        kth = np.where(i[live, -1] == _EMPTY, _I64.min, s[live, -1])
        # a tie with the k-th score can still win by its smaller id
        live = live[_above(length[live], bound[lo]) >= np.maximum(kth, floor[live])]
        if not len(live):
            break
        at = order[lo:lo + step]
        got = _scores(members[live], rows[at])
        made += got.size
        bad = (row_ids[at][None, :] == ids[live][:, None]) | (got < floor[live][:, None])
        s[live], i[live] = _merge(s[live], i[live], np.where(bad, _I64.min, got),
                                  np.where(bad, _EMPTY, row_ids[at][None, :]), k)
    return s, i, made


def walk_windows(members, ids, labels, tops, lows, rows, row_ids, row_labels, k: int, step: int = 256):
    """For each member and each window lows[m, p] <= score <= tops[m, p] (empty where lows > tops), the
    ``k`` best rows of other labels, as (scores, ids) of shape (members, windows, k), and the number
    of products made."""
    n, windows = tops.shape
    s = np.full((n, windows, k), _I64.min)
    i = np.full((n, windows, k), _EMPTY)
    order, bound = shared_list(members, rows, row_ids)
    length = unit(members)[1]
    live, made = np.arange(n), 0
    for lo in range(0, len(order), step):
        full = np.where(i[live, :, -1] == _EMPTY, lows[live], np.maximum(lows[live], s[live, :, -1]))
        reach = _above(length[live], bound[lo])[:, None]
        live = live[((reach >= full) & (lows[live] <= tops[live])).any(axis=1)]
        if not len(live):
            break
        at = order[lo:lo + step]
        got = _scores(members[live], rows[at])
        made += got.size
        fit = (row_labels[at][None, :] != labels[live][:, None]) & (row_ids[at][None, :] != ids[live][:, None])
        for p in range(windows):
            ok = fit & (got <= tops[live, p][:, None]) & (got >= lows[live, p][:, None])
            hit = ok.any(axis=1)
            to = live[hit]
            if len(to):
                s[to, p], i[to, p] = _merge(s[to, p], i[to, p], np.where(ok, got, _I64.min)[hit],
                                            np.where(ok, row_ids[at][None, :], _EMPTY)[hit], k)
    return s, i, made


class Cells:
    """Rows and anchors dealt to cells, slices and groups of bounded size; written once."""

    def __init__(self, vectors: DataFrame, anchors: Column, scale: float, slice_rows: int, group_rows: int,
                 sample: int, most_cells: int):
        e = F.col("embedding")
        bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e,
                           F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
        v = v.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & e.isNotNull()).where(~bad)
        n, dim = v.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
        self.scale, self.dim = scale, max(1, dim or 0)
        sample = max(1, min(sample, (1 << 22) // self.dim))                   # at most 32 MB on the driver
        cells = max(1, min(most_cells, -(-n // slice_rows), (1 << 20) // self.dim))
        some = v.orderBy(F.xxhash64("vec_id", "embedding"), "vec_id").select("embedding").limit(sample).collect()
        self.centroids = fit_cells(to_matrix([r[0] for r in some], scale, self.dim), cells)
        self.rows = written(self._assigned(v), "negatives-rows")
        self._deal(slice_rows, group_rows)

    def _assigned(self, v: DataFrame) -> DataFrame:
        centroids, scale, dim = self.centroids, self.scale, self.dim

        def assign(batches):
            for pdf in batches:
                if len(pdf):
                    u, length = unit(to_matrix(pdf["embedding"], scale, dim))
                    cos = u @ centroids.T
                    cell = cos.argmax(axis=1)
                    own = np.clip(cos[np.arange(len(cell)), cell], -1, 1)
                    # a zero vector has length 0, which bounds its scores at any angle
                    yield pdf.assign(cell=cell.astype("int32"), angle=np.where(length > 0, np.arccos(own), 0), length=length)

        return v.mapInPandas(assign, v.schema.simpleString()[7:-1] + ", cell int, angle double, length double")

    def _deal(self, slice_rows: int, group_rows: int) -> None:
        """Numbers of slices and groups from the counts per cell (at most as many rows as cells)."""
        n = len(self.centroids)
        rows, anchors = [0] * n, [0] * n
        for c, r, a in self.rows.groupBy("cell").agg(F.count(F.lit(1)), F.count_if("is_anchor")).collect():
            rows[c], anchors[c] = r, a
        parts = [max(1, -(-r // slice_rows)) for r in rows]
        first = np.concatenate([[0], np.cumsum(parts)])
        self.n_slices = int(first[-1])
        # small cells that lie near each other share a group
        flat = self.centroids - self.centroids.mean(axis=0)
        turn = np.argsort(flat @ np.linalg.svd(flat, full_matrices=False)[2][0], kind="stable")
        begin, split, group, held = [0] * n, [1] * n, 0, 0
        for c in turn:
            if held and held + anchors[c] > group_rows:
                group, held = group + 1, 0
            begin[c], split[c] = group, max(1, -(-anchors[c] // group_rows))
            held += anchors[c]
            if split[c] > 1:
                group, held = group + split[c], 0

        def pick(values) -> Column:
            return F.element_at(F.array(*[F.lit(int(x)) for x in values]), F.col("cell") + 1)

        mix = F.xxhash64("vec_id", "label", "embedding")
        self.rows = self.rows.withColumn("slice", (pick(first[:-1]) + F.pmod(mix, pick(parts))).cast("int"))
        self.anchors = (self.rows.where("is_anchor").dropDuplicates(["vec_id", "label", "embedding"])
                        .withColumn("akey", mix).withColumn("grp", (pick(begin) + F.pmod(mix, pick(split))).cast("int"))
                        .withColumnRenamed("vec_id", "anchor_id").drop("slice", "is_anchor"))
        self.slices = self.rows.groupBy("slice", F.col("cell").alias("s_cell")).agg(
            F.max("angle").alias("s_angle"), F.max("length").alias("s_length"))
        self.nearest = [int(x) for x in first[:-1]]               # the first slice of each cell

    def near(self) -> DataFrame:
        """(grp, slice): each group with the first slice of the cells of its anchors."""
        own = F.element_at(F.array(*[F.lit(x) for x in self.nearest]), F.col("cell") + 1)
        return self.anchors.select("grp", own.alias("slice")).distinct()

    def reachable(self, need: DataFrame) -> DataFrame:
        """(grp, slice) where a row of the slice may reach ``need`` (akey, need) of an anchor of the group."""
        spark = need.sparkSession
        theta = np.arccos(np.clip(self.centroids @ self.centroids.T, -1, 1))
        cos = spark.createDataFrame([(a, b, float(theta[a, b])) for a in range(len(theta)) for b in range(len(theta))],
                                    "cell int, s_cell int, theta double")
        per = F.when(F.col("length") > 0, F.col("need") / F.col("length")).when(F.col("need") <= 0, float("-inf")).otherwise(float("inf"))
        groups = self.anchors.join(need, "akey").groupBy("grp", "cell").agg(
            F.max("angle").alias("g_angle"), F.min(per).alias("need"))
        gap = F.greatest(F.lit(0.0), F.col("theta") - F.col("g_angle") - F.col("s_angle") - _SLACK)
        bound = F.col("s_length") * F.greatest(F.cos(gap), F.lit(0.0)) * (1 + 1e-9) + 1e-6
        return (groups.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(self.n_slices - 1))))
                .join(self.slices, "slice").join(cos, ["cell", "s_cell"]).where(bound >= F.col("need"))
                .select("grp", "slice").distinct())

    def meet(self, pairs: DataFrame, anchors: DataFrame, run, schema: str) -> DataFrame:
        """``run(anchors, rows)`` for every pair of a group and a slice: one bounded task group each."""
        a = pairs.join(anchors, "grp")
        rows = self.rows.select(F.col("slice").alias("s"), "vec_id", "label", "embedding")
        b = pairs.select(F.col("grp").alias("g"), F.col("slice").alias("s")).join(rows, "s")
        return a.groupBy("grp", "slice").cogroup(b.groupBy("g", "s")).applyInPandas(
            lambda left, right: run(left, right), schema)


class _Task:
    """What the tasks need of Cells (no DataFrame in a closure)."""

    def __init__(self, cells: Cells, k: int, step: int):
        self.scale, self.dim, self.k, self.step = cells.scale, cells.dim, k, step

    def matrix(self, column) -> np.ndarray:
        return to_matrix(column, self.scale, self.dim)

    def positives(self, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.zeros(0, "int64") for c in ("akey", "anchor_id", "vec_id", "score")})]
        by_label = dict(tuple(b.groupby("label"))) if len(a) and len(b) else {}
        for (_, label), m in a.groupby(["cell", "label"]):
            if label in by_label:
                rows = by_label[label]
                ids = m["anchor_id"].to_numpy("int64")
                s, i, _ = walk_best(self.matrix(m["embedding"]), ids, m["floor"].to_numpy("int64"),
                                    self.matrix(rows["embedding"]), rows["vec_id"].to_numpy("int64"), self.k, self.step)
                at, p = np.nonzero(i != _EMPTY)
                out.append(pd.DataFrame({"akey": m["akey"].to_numpy("int64")[at], "anchor_id": ids[at],
                                         "vec_id": i[at, p], "score": s[at, p]}))
        return pd.concat(out)

    def negatives(self, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        cols = ("akey", "anchor_id", "place", "positive_id", "positive_score", "vec_id", "score")
        out = [pd.DataFrame({c: np.zeros(0, "int64") for c in cols})]
        if len(a) and len(b):
            rows, row_ids = self.matrix(b["embedding"]), b["vec_id"].to_numpy("int64")
            row_labels = b["label"].to_numpy("int64")
            for _, m in a.groupby("cell"):
                most = int(m["scores"].map(len).max())
                tops, lows = np.full((len(m), most), -1), np.full((len(m), most), _I64.max)
                for x, (t, w) in enumerate(zip(m["scores"], m["lows"])):
                    tops[x, :len(t)], lows[x, :len(w)] = t, w
                ids = m["anchor_id"].to_numpy("int64")
                s, i, _ = walk_windows(self.matrix(m["embedding"]), ids, m["label"].to_numpy("int64"), tops, lows,
                                       rows, row_ids, row_labels, self.k, self.step)
                at, p, r = np.nonzero(i != _EMPTY)
                pos = m["ids"].to_list()
                out.append(pd.DataFrame({
                    "akey": m["akey"].to_numpy("int64")[at], "anchor_id": ids[at], "place": p,
                    "positive_id": [pos[x][y] for x, y in zip(at, p)], "positive_score": tops[at, p],
                    "vec_id": i[at, p, r], "score": s[at, p, r]}))
        return pd.concat(out)[list(cols)]


def mine(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
         scale: float = 256.0, slice_rows: int = 8192, group_rows: int = 512, step: int = 256,
         sample: int = 4096, most_cells: int = 256) -> DataFrame:
    """Up to ``n_negatives`` hard negatives for each of up to ``n_positives`` positives of each anchor
    (rows of ``vectors``: vec_id, embedding, label, for which ``anchors`` holds): anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score. A positive with a score below 0 has none,
    as its window is empty.
    """
    cells = Cells(vectors, anchors, scale, slice_rows, group_rows, sample, most_cells)
    best = Window.partitionBy("akey").orderBy(F.desc("score"), "vec_id")
    task = _Task(cells, n_positives, step)
    near = cells.near()
    no_floor = cells.anchors.withColumn("floor", F.lit(_I64.min).cast("long"))
    first = written(cells.meet(near, no_floor, task.positives, _FOUND), "negatives-near")
    kth = first.withColumn("r", F.row_number().over(best)).where(F.col("r") == n_positives).select("akey", F.col("score").alias("kth"))
    known = cells.anchors.join(kth, "akey", "left").withColumn("floor", F.coalesce("kth", F.lit(_I64.min)).cast("long")).drop("kth")
    need = known.select("akey", F.when(F.col("floor") == _I64.min, float("-inf")).otherwise(F.col("floor").cast("double")).alias("need"))
    rest = cells.reachable(need).join(near, ["grp", "slice"], "left_anti")
    positives = first.unionByName(cells.meet(rest, known, task.positives, _FOUND))
    positives = written(positives.withColumn("r", F.row_number().over(best)).where(F.col("r") <= n_positives), "negatives-positives")

    # decimals: the lower end of a window is exact for any 64-bit score
    lowest = F.ceil(F.col("score").cast("decimal(20,0)") * low / 100).cast("long")
    wanted = positives.where(F.col("score") >= 0).groupBy("akey").agg(
        F.array_sort(F.collect_list(F.struct("r", "vec_id", "score", lowest.alias("low")))).alias("p"))
    wanted = cells.anchors.join(wanted, "akey").withColumns(
        {"ids": F.col("p.vec_id"), "scores": F.col("p.score"), "lows": F.col("p.low")}).drop("p")
    pairs = cells.reachable(wanted.select("akey", F.array_min("lows").cast("double").alias("need")))
    task = _Task(cells, n_negatives, step)
    found = cells.meet(pairs, wanted, task.negatives, _CANDIDATES)
    order = Window.partitionBy("akey", "place").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
