import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hirelens.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, score string, cell string, slice string, grp string, angle string, length string"
EXTRA = ("x",) * 6


def brute(rows, is_anchor, n_pos=5, n_neg=5, low=80, scale=256):
    dim = max([len(e) for _, e, _ in rows if e], default=1)
    own = []
    for i, e, label in rows:
        if i is not None and label is not None and e is not None and all(x is not None and math.isfinite(x) for x in e):
            own.append((i, label, [math.floor(scale * x) for x in e] + [0] * (dim - len(e))))
    out = []
    for a, label, u in {(i, lab, tuple(e)) for i, lab, e in own if is_anchor(i)}:
        s = sorted((-sum(x * y for x, y in zip(u, e)), i, lab) for i, lab, e in own if i != a)
        for p, pid, _ in [x for x in s if x[2] == label][:n_pos]:
            neg = [x for x in s if x[2] != label and low * -p <= 100 * -x[0] <= 100 * -p][:n_neg]
            out += [(a, pid, r + 1, i, -p, -v) for r, (v, i, _) in enumerate(neg)]
    return sorted(out)


def mined(spark, rows, every, **kw):
    df = spark.createDataFrame([(i, e, lab, *EXTRA) for i, e, lab in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df, F.col("vec_id") % every == 0, **kw).collect())


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_against_brute_force(spark, scale):
    rnd = np.random.default_rng(5)
    centres = rnd.normal(size=(6, 6))
    rows = [(i, [float(x) for x in (centres[i % 6] + 0.6 * rnd.normal(size=6)).round(1) * scale], int(rnd.integers(3))) for i in range(360)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(40)]                      # ties: copies under all labels
    rows += [(2000, None, 1), (2020, [1.0] * 6, None), (2040, [float("nan")] * 6, 1), (2060, [None] + [1.0] * 5, 1), (2080, [], 1),
             (2100, [scale, -scale], 2), (None, [1.0] * 6, 1), (2120, [0.0] * 6, 1), (2140, [float("inf")] * 6, 1),
             (20, rows[20][1], rows[20][2]), (7, rows[8][1], rows[8][2])]           # an anchor again; an id again with another vector
    got = mined(spark, rows, 20, slice_rows=48, group_rows=6, step=16, sample=100)
    assert got == brute(rows, lambda i: i % 20 == 0)
    assert len({r[0] for r in got}) > 10


def test_unlike_anchors_of_one_id_and_other_limits(spark):
    rows = [(i, [float(i % 7), float(i % 5) - 2, 1.0], i % 2) for i in range(60)] + [(0, [3.0, 1.0, 2.0], 1)]
    assert mined(spark, rows, 30, n_positives=2, n_negatives=3, low=50) == brute(rows, lambda i: i % 30 == 0, 2, 3, 50)


def test_small_tables(spark):
    assert mined(spark, [], 10) == [] and mined(spark, [(5, [1.0], 1)], 10) == [] and mined(spark, [(10, [1.0], 1)], 10) == []
    assert mined(spark, [(10, [1.0], 1), (11, [1.0], 1), (12, [0.9], 2)], 10) == [(10, 11, 1, 12, 256 * 256, 256 * 230)]


def clustered(n=4000, dim=32):
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(40, dim))
    v = np.floor(256 * (centres[np.arange(n) % 40] + 0.05 * rnd.normal(size=(n, dim))))
    return v, np.arange(n), rnd.integers(4, size=n)


def test_walks_end_early_and_stay_exact():
    v, ids, labels = clustered()
    m = np.arange(0, len(v), 40)[:50]                                              # anchors of one cluster
    s, i, made = hn.walk_best(v[m], ids[m], np.full(len(m), np.iinfo("int64").min), v, ids, 5, step=64)
    assert made < 0.2 * len(m) * len(v)                                            # certified long before the end of the list
    full = v[m] @ v.T
    for x, a in enumerate(m):
        order = sorted((-full[x, j], j) for j in ids if j != a)[:5]
        assert [(-t, j) for t, j in order] == list(zip(s[x], i[x]))
    tops = np.repeat(s[:, :1], 2, axis=1)
    lows = np.stack([tops[:, 0] * 4 // 5, np.full(len(m), np.iinfo("int64").max)], axis=1)     # the second window is empty
    ws, wi, made = hn.walk_windows(v[m], ids[m], labels[m], tops, lows, v, ids, labels, 3, step=64)
    assert made < 0.2 * len(m) * len(v) and (wi[:, 1] == np.iinfo("int64").max).all()
    for x, a in enumerate(m):
        order = sorted((-full[x, j], j) for j in ids if labels[j] != labels[a] and lows[x, 0] <= full[x, j] <= tops[x, 0])[:3]
        assert [(-t, j) for t, j in order] == [(t, j) for t, j in zip(ws[x, 0], wi[x, 0]) if j != np.iinfo("int64").max]


def test_slices_out_of_reach_do_not_travel(spark):
    v, ids, labels = clustered(2000)
    df = spark.createDataFrame([(int(i), [float(x) / 256 for x in e], int(c), *EXTRA) for i, e, c in zip(ids, v, labels)], SCHEMA)
    cells = hn.Cells(df, F.col("vec_id") % 40 == 0, 256.0, 50, 8, 2000, 64)
    need = cells.anchors.select("akey", (0.9 * F.col("length") ** 2).alias("need"))
    assert cells.reachable(need).count() < 0.4 * cells.anchors.select("grp").distinct().count() * cells.n_slices
    largest = cells.rows.groupBy("slice").count().agg(F.max("count")).first()[0]
    assert largest <= 150 and cells.rows.count() == 2000
