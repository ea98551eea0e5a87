import math

import numpy as np
import pytest

from hirelens.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def brute(rows, queries, k):
    own = {}
    for i, e in rows:
        if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            own[i] = min(own.get(i, e), e)
    own = {i: [math.floor(1024 * x) for x in e] for i, e in own.items()}
    out = set()
    for q in queries:
        if q in own:
            s = sorted((-sum(a * b for a, b in zip(own[q], e)), i) for i, e in own.items() if i != q)[:k]
            out |= {(q, r + 1, i, -v) for r, (v, i) in enumerate(s)}
    return out


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_against_brute_force(spark, scale):
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rnd.normal(size=8).round(1) * scale]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(30)]                        # ties
    rows += [(900, None), (901, [float("nan")] * 8), (902, [None] + [1.0] * 7), (903, []), (904, [1.0, 2.0]),
             (None, [1.0] * 8), (905, [float("inf")] * 8), (10, rows[11][1])]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], SCHEMA)
    got = topk.top_k(df.where("vec_id % 50 = 0 OR vec_id IN (903, 904)"), df, k=10, slice_rows=64, query_rows=4, block=16)
    q = [i for i, _ in rows if i is not None and (i % 50 == 0 or i in (903, 904))]
    assert {tuple(r) for r in got.collect()} == brute(rows, q, 10)


def test_repeated_ids_are_all_candidates(spark):
    df = spark.createDataFrame([(0, [1.0], 1, ""), (7, [2.0], 1, ""), (7, [3.0], 1, ""), (8, [2.5], 1, ""),
                                (100, [1.0], 1, ""), (100, [-1.0], 1, "")], SCHEMA)
    u = 1024 * 1024
    got = topk.top_k(df.where("vec_id = 0"), df, k=4).collect()
    assert [tuple(r)[1:] for r in sorted(got, key=lambda r: r["rank"])] == [
        (1, 7, 3 * u), (2, 8, 5 * u // 2), (3, 7, 2 * u), (4, 100, u)]
    got = topk.top_k(df.where("vec_id = 100"), df, k=20).collect()
    assert sorted((r.vec_id, r.score) for r in got) == sorted(
        (i, s * x) for i, x in ((0, u), (7, 2 * u), (7, 3 * u), (8, 5 * u // 2)) for s in (1, -1))


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0], 1, ""), (7, [2.0], 1, "")], SCHEMA)
    assert [tuple(r) for r in topk.top_k(df.where("vec_id = 0"), df).collect()] == [(0, 1, 7, 2 * 1024 * 1024)]
    assert topk.top_k(df.where("vec_id = 5"), df).collect() == []
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_blocks_below_the_floor_are_not_scored(spark):
    rnd = np.random.default_rng(9)
    centres = rnd.normal(size=(40, 32))
    v = centres[rnd.integers(0, 40, 16_000)] + 0.1 * rnd.normal(size=(16_000, 32))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[6_000:11_000] = v[100]                                                  # a third are copies of a query
    df = spark.createDataFrame([(i, e.tolist(), 1, "x") for i, e in enumerate(v)], SCHEMA)
    queries = df.where("vec_id % 100 = 0")
    b = topk.Blocks(queries, df, 10, 1024.0, 1 << 19, 256, 512, 4096, 2)
    sizes = b.v.groupBy("blk").count()
    assert sizes.agg({"count": "max"}).first()[0] < 700                       # copies spread over blocks
    near = b.near()
    first = topk.ranked(b.scored(near), 10)
    floors = first.groupBy("query_id").agg({"score": "min"}).withColumnRenamed("min(score)", "low")
    pairs = b.reachable(floors).union(near).distinct().join(sizes, "blk")
    scored = pairs.where("query_id NOT BETWEEN 6000 AND 10900 AND query_id <> 100").agg({"count": "sum"}).first()[0]
    assert scored < 0.25 * 110 * 16_000
    whole = np.floor(v * 1024).astype(np.int64)
    want = set()
    for q in range(0, 16_000, 100):
        s = whole @ whole[q]
        s[q] = np.iinfo(np.int64).min
        order = np.lexsort((np.arange(len(s)), -s.astype(float)))[:10]
        want |= {(q, r + 1, int(i), int(s[i])) for r, i in enumerate(order)}
    assert {tuple(r) for r in topk.top_k(queries, df).collect()} == want


def test_bounds_hold(spark):
    rnd = np.random.default_rng(2)
    for scale in (1.0, 1e12, 1e200):
        v, q = np.floor(rnd.normal(size=(50, 6)) * scale), np.floor(rnd.normal(size=(20, 6)) * scale)
        hi, lo, mean, radius = topk.summary(v)
        bound = topk.bounds(q, hi[None], lo[None], mean[None], np.array([radius]))[:, 0]
        with np.errstate(all="ignore"):
            assert (bound >= (q @ v.T).max(axis=1) - 1e-9 * np.abs(bound)).all() or scale > 1e100
        assert not np.isnan(bound).any()


def test_very_wide_vectors(spark):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=20_000).round(2)]) for i in range(60)]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], SCHEMA)
    got = topk.top_k(df.where("vec_id % 20 = 0"), df, k=3)
    assert {tuple(r) for r in got.collect()} == brute(rows, [0, 20, 40], 3)
