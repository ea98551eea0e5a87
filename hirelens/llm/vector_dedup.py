"""Near-duplicate vectors: a flat graph with robust pruning, built in overlapping shards.

Vectors of one label are dealt to the ``overlap`` nearest of that label's pivots, so a
shard holds some ``shard_rows`` vectors and neighbours meet in at least one shard. Each
shard builds a graph (nearest candidates, robust pruning, both directions); the adjacency
lists of a vector are united over its shards. A search starts at a shard's medoid, walks
greedily with a beam and, once at its goal, expands every vector in range. Each link found
is verified by its cosine in double precision. A bounded sample of vectors is compared with
all rows to audit the recall, by vector and by group of near copies, whatever the number of
links or copies; below ``min_recall`` the overlap doubles, and at last every block of a label
is compared with every other exactly, which needs no audit.

Equal vectors of a label are one class, searched once. A shard that is too large (many near
copies) is dealt to blocks, and every pair of blocks is one task group of bounded size. A
pair that meets in several shards counts in the first only and is compared exactly there, so
that no later search finds what the first one missed; thus a task returns one row per vector
(number of links, a root it is connected to), never the pairs.

Bounds: at most ``MAX_PIVOTS`` pivots and ``AUDIT`` audit vectors are sampled by hash and
broadcast. Nulls, ties, edges: a null label, or a vector that is null, empty, zero or holds
null or non-finite components, links with nothing; a shorter vector counts as padded with
zeros; rows that repeat a vector link with each other; a null vec_id keeps its row without
links; an empty table gives no row. Other columns are not read.
"""
from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.common import components, written

MAX_PIVOTS, AUDIT = 16_384, 512
DEGREE, POOL, BEAM, ALPHA = 24, 64, 24, 1.2
_log = logging.getLogger(__name__)


def unit_rows(vectors, dim: int | None = None) -> np.ndarray:
    """Rows of length one, padded with zeros; scaled first, so that squares stay finite."""
    dim = dim or max(map(len, vectors))
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def robust_prune(x: np.ndarray, rows: slice, pool: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Neighbours kept for some rows of x from their pools (rows of x by falling similarity): the
    nearest stays and removes those that are nearer to it, by the factor alpha, than to the row."""
    own_x = x[rows]
    n = len(own_x)
    near = x[pool]
    own = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,ncd->nc", own_x, near)))
    alive = pool >= 0
    kept = np.full((n, degree), -1, np.int64)
    at = np.arange(n)
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        star = pool[at, first]
        kept[some, k] = star[some]
        d = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,ncd->nc", x[star], near)))
        alive &= alpha * d > own
        alive[at, first] = False
    return kept


def build_graph(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA) -> list[np.ndarray]:
    """Adjacency lists of one block: robustly pruned nearest candidates, edges both ways,
    pruned again where a list grew beyond twice the degree."""
    n = len(x)
    if n == 1:
        return [np.zeros(0, np.int64)]
    pool = min(pool, n - 1)
    near = np.empty((n, pool), np.int64)
    for lo in range(0, n, 512):
        s = x[lo:lo + 512] @ x.T
        s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        top = np.argpartition(-s, pool - 1, axis=1)[:, :pool]
        near[lo:lo + 512] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1), 1)
    kept = np.concatenate([robust_prune(x, slice(lo, lo + 256), near[lo:lo + 256], degree, alpha)
                           for lo in range(0, n, 256)])
    a, b = np.repeat(np.arange(n), kept.shape[1]), kept.ravel()
    a, b = a[b >= 0], b[b >= 0]
    edges = np.unique(np.concatenate([a * n + b, b * n + a]))
    a, b = edges // n, edges % n
    lists = np.split(b, np.searchsorted(a, np.arange(1, n)))
    for i in [i for i, w in enumerate(lists) if len(w) > 2 * degree]:
        w = lists[i][np.argsort(-(x[lists[i]] @ x[i]))]
        w = robust_prune(x, slice(i, i + 1), w[None, :], 2 * degree, alpha)[0]
        lists[i] = w[w >= 0]
    return lists


def search_range(q: np.ndarray, x: np.ndarray, adj: np.ndarray, limit: float, beam: int = BEAM) -> np.ndarray:
    """Which rows of ``x`` have similarity >= limit to each query, as found by a greedy walk
    from the medoid and the expansion of all rows in range. adj: neighbours, -1 for none."""
    m, n = len(q), len(x)
    medoid = int((x @ x.mean(axis=0)).argmax())
    seen, found = np.zeros((m, n), bool), np.zeros((m, n), bool)
    done = np.zeros((m, n), bool)                       # rows whose neighbours were visited
    ids = np.full((m, beam), -1)
    sim = np.full((m, beam), -np.inf)
    ids[:, 0], sim[:, 0] = medoid, q @ x[medoid]
    seen[:, medoid] = True
    found[:, medoid] = sim[:, 0] >= limit
    live = np.arange(m)
    while len(live):
        open_ = (ids[live] >= 0) & ~done[live[:, None], ids[live]]
        live, open_ = live[open_.any(axis=1)], open_[open_.any(axis=1)]
        if not len(live):
            break
        at = np.where(open_, sim[live], -np.inf).argmax(axis=1)
        node = ids[live, at]
        done[live, node] = True
        nb = adj[node]
        fresh = (nb >= 0) & ~seen[live[:, None], nb]
        r, c = np.nonzero(fresh)
        s = np.full(nb.shape, -np.inf)
        s[r, c] = np.einsum("kd,kd->k", q[live[r]], x[nb[r, c]])
        seen[live[r], nb[r, c]] = True
        found[live[r], nb[r, c]] = s[r, c] >= limit
        ids_all, sim_all = np.concatenate([ids[live], np.where(fresh, nb, -1)], 1), np.concatenate([sim[live], s], 1)
        top = np.argpartition(-sim_all, beam - 1, axis=1)[:, :beam]
        ids[live], sim[live] = np.take_along_axis(ids_all, top, 1), np.take_along_axis(sim_all, top, 1)
    # range expansion: every row in range passes on its neighbours, until none is new
    r, node = np.nonzero(found & ~done)
    while len(r):
        done[r, node] = True
        more = []
        for lo in range(0, len(r), 4096):
            rr = np.repeat(r[lo:lo + 4096], adj.shape[1])
            nb = adj[node[lo:lo + 4096]].ravel()
            ok = nb >= 0
            rr, nb = rr[ok], nb[ok]
            ok = ~seen[rr, nb]
            pair = np.unique(rr[ok] * n + nb[ok])
            rr, nb = pair // n, pair % n
            seen[rr, nb] = True
            hit = np.einsum("kd,kd->k", q[rr], x[nb]) >= limit
            found[rr[hit], nb[hit]] = True
            more.append(pair[hit])
        pair = np.concatenate(more) if more else np.zeros(0, np.int64)
        r, node = pair // n, pair % n
    return found


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest row of each row's connected component under links a - b."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def classes(vectors: DataFrame) -> DataFrame:
    """(id, label, e, w): equal vectors of a label, their smallest vec_id and their number."""
    e = F.col("embedding").cast("array<double>")
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", e.alias("e")).where(
        "vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL")
    v = v.where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) &
                F.exists("e", lambda x: x != 0))
    return v.groupBy("label", "e").agg(F.min("vec_id").alias("id"), F.count("*").alias("w"))


def pivots(cls: DataFrame, overlap: int, shard_rows: int) -> dict:
    """label -> matrix of pivots, for labels that need more than one shard: classes with the
    smallest hashes. At most ``MAX_PIVOTS`` in all."""
    count = cls.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") * overlap > 2 * shard_rows)
    total = cls.count()
    k = F.least(F.ceil(F.col("n") * overlap / shard_rows), F.floor(F.lit(MAX_PIVOTS) * F.col("n") / total))
    count = count.select(F.col("label").alias("_l"), "n", k.alias("k")).where("k > 1")
    h = F.xxhash64(F.lit("pivot"), "id")
    near = cls.join(count, cls["label"] == count["_l"]).withColumn("h", h).where(
        (F.col("h") + 2.0**63) / 2.0**64 < (2.0 * F.col("k") + 40) / F.col("n"))
    out: dict = {}
    for r in sorted(near.select("label", "e", "h", "k").collect(), key=lambda r: r["h"]):
        if len(out.setdefault(r["label"], [])) < r["k"]:
            out[r["label"]].append(list(r["e"]))
    dim = {k: max(map(len, v)) for k, v in out.items()}
    return {k: unit_rows(v, dim[k]) for k, v in out.items()}


def assign(cls: DataFrame, pivot: dict, overlap: int) -> DataFrame:
    """Adds ``shards``: the nearest pivots of the row's label, ascending."""
    shared = cls.sparkSession.sparkContext.broadcast(pivot)
    schema = T.StructType([*cls.schema.fields, T.StructField("shards", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for b in batches:
            shards = [[0]] * b.num_rows
            label = np.array(b.column("label").to_pylist())
            e = b.column("e").to_pylist()
            for x in set(label.tolist()) & shared.value.keys():
                p = shared.value[x]
                rows = np.flatnonzero(label == x)
                own = unit_rows([e[i] for i in rows], max(p.shape[1], *(len(e[i]) for i in rows)))[:, :p.shape[1]]
                r = min(overlap, len(p))
                top = np.sort(np.argpartition(-(own @ p.T), r - 1, axis=1)[:, :r], axis=1)
                for i, t in zip(rows, top.tolist()):
                    shards[i] = t
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shards, pa.list_(pa.int32()))],
                                             [*b.schema.names, "shards"])

    return cls.mapInArrow(run, schema)


def link(cls: DataFrame, limit: float, overlap: int, shard_rows: int) -> DataFrame:
    """(id, n, m, root) per class and task: links counted there (copies included), classes linked
    with, a root. An overlap below 0 compares all classes of a label exactly, without graphs."""
    exact = overlap < 0
    pivot = {} if exact else pivots(cls, overlap, shard_rows)
    rows = written(assign(cls, pivot, overlap), "nn-rows")
    rows = rows.withColumn("shard", F.explode("shards"))
    size = rows.groupBy("label", "shard").agg(F.ceil(F.count("*") / (2 * shard_rows)).cast("int").alias("blocks"))
    rows = rows.join(size, ["label", "shard"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))

    def build(pdf):
        ids = pdf["id"].to_numpy()
        return pd.DataFrame({"id": ids, "near": [ids[w] for w in build_graph(unit_rows(list(pdf["e"])))]})

    if exact:
        rows = rows.withColumn("near", F.array().cast("array<long>"))
    else:
        graph = (rows.groupBy("label", "shard", "block").applyInPandas(build, "id long, near array<long>")
                 .groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
        rows = rows.join(graph, "id")

    def search(pdf):
        x = unit_rows(list(pdf["e"]))
        ids, w, block = pdf["id"].to_numpy(), pdf["w"].to_numpy(), pdf["block"].to_numpy()
        lo, hi, shard = pdf["lo"].iloc[0], pdf["hi"].iloc[0], pdf["shard"].iloc[0]
        order = np.argsort(ids)

        def local(members):
            """Adjacency of the rows ``members`` among themselves."""
            own = np.sort(ids[members])
            back = np.argsort(ids[members], kind="stable")
            lists = []
            for near in pdf["near"].iloc[members]:
                at = np.minimum(np.searchsorted(own, near), len(own) - 1)
                lists.append(back[at[own[at] == near]])
            out = np.full((len(members), max(1, *map(len, lists))), -1, np.int64)
            for i, w_ in enumerate(lists):
                out[i, :len(w_)] = w_
            return out

        left, right = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        if not len(left) or not len(right):
            return pd.DataFrame({"id": [], "n": [], "m": [], "root": []}, dtype="int64")
        shards = pdf["shards"].tolist()
        width = max(map(len, shards))
        sets = np.array([list(s) + [-1] * (width - len(s)) for s in shards])
        if exact:
            found = x[left] @ x[right].T >= limit
        else:
            found = search_range(x[left], x[right], local(right), limit)
            found |= (found if lo == hi else search_range(x[right], x[left], local(left), limit)).T
            # pairs that meet again in a later shard count here alone: compared exactly
            for later in np.unique(sets[sets > shard]).tolist():
                has = (sets == later).any(axis=1)
                i, j = np.flatnonzero(has[left]), np.flatnonzero(has[right])
                found[np.ix_(i, j)] |= x[left[i]] @ x[right[j]].T >= limit
        if lo == hi:
            found |= found.T
        a, b = np.nonzero(found)
        a, b = left[a], right[b]
        a, b = a[a != b], b[a != b]
        # a pair that meets in an earlier shard too was decided there
        early = np.zeros(len(a), bool)
        for i in range(width):
            for j in range(width):
                early |= (sets[a, i] >= 0) & (sets[a, i] < shard) & (sets[a, i] == sets[b, j])
        a, b = a[~early], b[~early]
        n, m = np.zeros(len(ids), np.int64), np.bincount(a, minlength=len(ids))
        np.add.at(n, a, w[b])
        if lo != hi:
            np.add.at(n, b, w[a])
            m += np.bincount(b, minlength=len(ids))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        root = ids[order][roots(len(ids), rank[a], rank[b])[rank]]
        some = n > 0
        return pd.DataFrame({"id": ids[some], "n": n[some], "m": m[some], "root": root[some]})

    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    pairs = (rows.withColumn("_o", other)
             .withColumn("lo", F.least("block", "_o")).withColumn("hi", F.greatest("block", "_o")))
    cols = ["id", "e", "w", "shards", "label", "shard", "block", "lo", "hi", "near"]
    return pairs.select(cols).groupBy("label", "shard", "lo", "hi").applyInPandas(
        search, "id long, n long, m long, root long")


def audit(cls: DataFrame, found: DataFrame, limit: float) -> float:
    """The least of four recalls over a bounded sample of classes, whose links a full comparison
    finds: mean share of its links that a vector has, share of vectors that have all, and both with
    vectors weighted by 1 / (1 + links), so that each group of near copies counts alike. Links are
    counted by class, without copies; vectors without a link don't count."""
    n = max(1, cls.count())
    h = (F.xxhash64(F.lit("audit"), "id") + 2.0**63) / 2.0**64
    sample = cls.where(h < AUDIT / n).limit(2 * AUDIT).select("id", "label", "e").collect()
    if not sample:
        return 1.0
    ids, label = np.array([r["id"] for r in sample]), np.array([r["label"] for r in sample])
    shared = cls.sparkSession.sparkContext.broadcast((ids, label, [list(r["e"]) for r in sample]))

    def compare(batches):
        q_id, q_label, q = shared.value
        for b in batches:
            e = b.column("e").to_pylist()
            if not e:
                continue
            dim = max(max(map(len, e)), max(map(len, q)))
            x, qx = unit_rows(e, dim), unit_rows(q, dim)
            hit = ((qx @ x.T >= limit) & (q_label[:, None] == np.array(b.column("label").to_pylist()))
                   & (q_id[:, None] != b.column("id").to_numpy()))
            yield pa.RecordBatch.from_arrays([pa.array(q_id), pa.array(hit.sum(axis=1))], ["id", "n"])

    true = cls.mapInArrow(compare, "id long, n long").groupBy("id").agg(F.sum("n").alias("true")).where(F.col("true") > 0)
    share = F.least(F.lit(1.0), F.coalesce("m", F.lit(0)) / F.col("true"))
    group = 1 / (1 + F.col("true"))
    r = (true.join(found.groupBy("id").agg(F.sum("m").alias("m")), "id", "left")
         .withColumn("share", share).withColumn("whole", (F.col("share") >= 1).cast("int"))
         .agg(F.avg("share"), F.avg("whole"), F.sum(F.col("share") * group) / F.sum(group),
              F.sum(F.col("whole") * group) / F.sum(group)).first())
    return 1.0 if r[0] is None else min(r)


def near_duplicates(vectors: DataFrame, limit: float = 0.93, overlap: int = 2, shard_rows: int = 1024,
                    min_recall: float = 0.97) -> DataFrame:
    """Per row of ``vectors``: vec_id, n_links, component_id, kept (vec_id = component_id)."""
    cls = written(classes(vectors), "nn-classes")
    while True:
        found = written(link(cls, limit, overlap, shard_rows), "nn-links")
        if overlap < 0:
            break
        recall = audit(cls, found, limit)
        _log.info("near_duplicates: overlap %d, recall %.4f", overlap, recall)
        if recall >= min_recall:
            break
        overlap = overlap * 2 if overlap < 8 else -1   # at last no pivots: all blocks of a label, exactly
    comp = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    n = found.groupBy("id").agg(F.sum("n").alias("n"))
    per = (cls.join(n, "id", "left").join(comp.withColumnRenamed("node", "id"), "id", "left")
           .select("label", "e", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"),
                   F.coalesce("component", "id").alias("component_id")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                          F.col("embedding").cast("array<double>").alias("e"))
    out = rows.join(per, ["label", "e"], "left")
    named = F.col("vec_id").isNotNull()
    cid = F.when(named, F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce(F.when(named, F.col("n_links")), F.lit(0).cast("long")).alias("n_links"),
                      cid.alias("component_id"), F.coalesce(F.col("vec_id") == cid, F.lit(True)).alias("kept"))
