import random

import pytest

from hirelens.llm import mixing


def water(sizes):
    """Targets by resharing the excess until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: i % 3 + 1 for i, s in enumerate(names)}
    cap = {s: 3 * sizes[s] for s in names}
    fixed = {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = sum(sizes.values()) - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > cap[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: cap[s] for s in above})


def test_targets_and_taken_words(make_docs):
    rnd = random.Random(2)
    rows = [(i, "w " * rnd.randint(0, 30), "en", rnd.choice(["a", "b", "b", "b", "b", "c", None, "é", "tiny"][:8]))
            for i in range(3000)]
    rows += [(9001, "x y", "en", "tiny"), (9002, None, "en", "empty"), (9003, None, "en", None)]
    got = mixing.mix_report(make_docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = water(sizes)
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert own[0].source_size == sizes[s] and own[0].target == pytest.approx(want[s])
        assert sum(r.taken for r in own) == pytest.approx(want[s], abs=30)
    assert all(r.taken <= 3 * r.size and r.taken % max(1, r.size) == 0 for r in got)
    again = mixing.mix_report(make_docs(list(reversed(rows)), extra=True).repartition(5)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_repeats_rows_and_keeps_columns(make_docs):
    docs = make_docs([(1, "a b c", "en", "s1"), (2, "d", "en", "s2"), (2, "d", "en", "s2"), (None, None, "en", None)], extra=True)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    times = {(r.doc_id, r.taken, r.size) for r in mixing.mix_report(docs).collect()}
    assert out.where("doc_id = 1").count() * 3 == sum(t for d, t, _ in times if d == 1)


def test_empty(make_docs):
    assert mixing.mix_report(make_docs([])).collect() == []
    assert mixing.mix(make_docs([])).collect() == []
