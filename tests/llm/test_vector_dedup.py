import math

import numpy as np

from hirelens.llm import vector_dedup as V

SCHEMA = "vec_id long, embedding array<float>, label int, e string, shard int, w int"


def brute(rows, limit=0.93):
    """(n_links, component) per row by comparing all."""
    ok = [i for i, (d, e, x) in enumerate(rows) if d is not None and x is not None and e
          and all(v is not None and math.isfinite(v) for v in e) and any(e)]
    dim = max(len(rows[i][1]) for i in ok)
    m = np.array([[*rows[i][1], *[0] * (dim - len(rows[i][1]))] for i in ok], np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    label = np.array([rows[i][2] for i in ok])
    link = (m @ m.T >= limit) & (label[:, None] == label[None, :])
    np.fill_diagonal(link, False)
    root = [rows[i][0] for i in ok]
    while True:
        new = [min([root[i], *(root[j] for j in np.flatnonzero(link[i]))]) for i in range(len(ok))]
        if new == root:
            break
        root = new
    out = {i: (0, rows[i][0]) for i in range(len(rows))}
    out.update({i: (int(link[k].sum()), root[k]) for k, i in enumerate(ok)})
    return out


def data():
    rnd = np.random.default_rng(7)
    rows = [(i, rnd.normal(size=16).tolist(), i % 2) for i in range(500)]
    for i in range(120):                                                     # a large group of near copies
        rows.append((1000 + i, (np.array(rows[0][1]) + rnd.normal(size=16) * 0.12).tolist(), 0))
    rows += [(2000 + i, rows[3][1], 1) for i in range(60)]                   # copies
    rows += [(3000 + i, [2 * v for v in rows[5][1]], 1) for i in range(3)]   # scaled
    rows += [(4000, rows[3][1], 0), (4001, None, 1), (4002, [0.0] * 16, 1), (4003, [float("nan")] * 16, 1),
             (4004, [None] * 16, 1), (4005, rows[3][1], None), (4006, [], 1), (4007, [float("inf")] * 16, 0),
             (2000, rows[3][1], 1), (None, rows[3][1], 1), (4008, rows[7][1][:12], 1)]
    return rows


def test_against_brute_force(spark):
    rows = data()
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    want = brute(rows)
    by_id = {}
    for i, r in enumerate(rows):
        by_id.setdefault(r[0], []).append(want[i])
    for shard_rows in (32, 1024):                                            # blocks and overlapping shards; one shard
        got = V.near_duplicates(df, shard_rows=shard_rows, min_recall=0.95).collect()
        assert len(got) == len(rows)
        assert all(r.n_links <= max(n for n, _ in by_id[r.vec_id]) for r in got)
        found, true = sum(r.n_links for r in got), sum(n for n, _ in want.values())
        assert found >= 0.95 * true
        wrong = [r for r in got if r.component_id not in {c for _, c in by_id[r.vec_id]}]
        assert len(wrong) <= 0.02 * len(got)
        assert all(r.kept == (r.vec_id == r.component_id) or r.vec_id is None for r in got)


def test_recall_is_complete_in_one_block():
    rnd = np.random.default_rng(1)
    base = rnd.normal(size=(40, 24))
    x = V.unit_rows(list(np.repeat(base, 10, axis=0) + rnd.normal(size=(400, 24)) * 0.1))
    lists = V.build_graph(x)
    adj = np.full((400, max(map(len, lists))), -1)
    for i, w in enumerate(lists):
        adj[i, :len(w)] = w
    found = V.search_range(x, x, adj, 0.93)
    true = x @ x.T >= 0.93
    assert not (found & ~true).any() and found.sum() >= 0.99 * true.sum()


def clusters(n=8, size=100):
    """Groups of near copies too large for a graph of nearest neighbours to connect."""
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(n, 16))
    return [(g * size + i, (base[g] + rnd.normal(size=16) * 0.1).tolist(), 0) for g in range(n) for i in range(size)]


def test_last_round_is_exact(spark):
    rows = clusters()
    want = brute(rows)
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    for shard_rows in (128, 1024):
        got = {r.vec_id: (r.n_links, r.component_id) for r in V.near_duplicates(df, shard_rows=shard_rows, min_recall=1.1).collect()}
        assert got == {rows[i][0]: x for i, x in want.items()}


def test_pairs_that_meet_twice_are_all_found(spark):
    rows = clusters()
    cls = V.written(V.classes(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)), "test-classes")
    shards = {r.id: set(r.shards) for r in V.assign(cls, V.pivots(cls, 4, 128), 4).collect()}
    x = V.unit_rows([np.array(r[1], np.float32) for r in rows])
    a, b = np.nonzero(x @ x.T >= 0.93)
    least = dict.fromkeys(shards, 0)
    for i, j in zip(a.tolist(), b.tolist()):
        least[i] += i != j and len(shards[i] & shards[j]) > 1
    assert sum(least.values()) > 10_000
    got = {}
    for r in V.link(cls, 0.93, 4, 128).collect():
        got[r.id] = got.get(r.id, 0) + r.n
    assert all(got.get(i, 0) >= n for i, n in least.items())


def test_audit_sees_small_groups_beside_dense_ones(spark):
    rnd = np.random.default_rng(5)
    base = rnd.normal(size=(151, 16))
    rows = [(i, (base[150] + rnd.normal(size=16) * 0.02).tolist(), 0) for i in range(200)]         # one dense group
    rows += [(1000 + i, (base[i // 2] + rnd.normal(size=16) * 0.02).tolist(), 0) for i in range(300)]   # pairs
    rows += [(2000, rows[0][1], 0)] * 5000                                                          # and many copies
    cls = V.written(V.classes(spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)), "test-classes")
    found = V.link(cls, 0.93, -1, 1024)
    assert V.audit(cls, found, 0.93) == 1.0
    assert V.audit(cls, found.where("id < 1000"), 0.93) < 0.5                                       # pairs lost
    assert V.audit(cls, found.where("id >= 1000 OR id % 2 = 0"), 0.93) < 0.9                        # dense ones lost


def test_empty(spark):
    assert V.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
