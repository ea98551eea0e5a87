import hashlib
import random

import pytest

from hirelens.llm import substring as S


def brute(rows, window):
    """rows in order -> (doc_id, n_words, n_removed, sha256 of what stays)."""
    seen, out = set(), []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            g = tuple(w[i:i + window])
            if g in seen:
                gone[i:i + window] = [True] * window
            seen.add(g)
        stay = [x for x, y in zip(w, gone) if not y]
        out.append((d, len(w), sum(gone), hashlib.sha256(b" ".join(stay)).hexdigest()))
    return out


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(50)] + ["é", "The", "the"]
    common = [rnd.choices(words, k=k) for k in (19, 20, 21, 60, 300)]
    rows = []
    for i in range(n):
        t = rnd.choices(words, k=rnd.choice([0, 5, 19, 20, 21, 80]))
        for _ in range(rnd.choice([0, 1, 3])):
            at = rnd.randrange(len(t) + 1)
            t[at:at] = rnd.choice(common)
        rows.append((i, rnd.choice([" ", "\n", " \t "]).join(t)))
    rows += [(n + i, rows[7][1]) for i in range(5)]
    rows += [(n + 10, None), (n + 11, ""), (n + 12, "x " * 500), (n + 13, "ab cd " * 300), (n + 14, "x " * 30)]
    return rows


@pytest.mark.parametrize("max_runs,group,held,often", [(2000, 20_000, 200_000, 999), (3, 50, 40, 999), (0, 50, 7, 999),
                                                       (2000, 50, 40, 10), (2, 50, 40, 2)])
def test_against_brute_force(make_docs, monkeypatch, max_runs, group, held, often):
    monkeypatch.setattr(S, "OFTEN", often)                                   # prefixes known from the sample
    monkeypatch.setattr(S, "MAX_RUNS", max_runs)                             # short prefixes, long ones, both
    monkeypatch.setattr(S, "GROUP_RUNS", group)
    monkeypatch.setattr(S, "HELD_WINDOWS", held)
    rows = corpus(max_runs)
    docs = make_docs(rows, extra=True).repartition(4)
    got = S.without_repeats(docs)
    assert sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == brute(rows, 20)
    r = got.where("n_removed > 0").first()
    words = dict(rows)[r.doc_id].split()
    for x in reversed(r.removed):
        del words[x.s:x.e]
    assert r.kept == " ".join(words)


def test_repeated_and_missing_ids(make_docs):
    long = " ".join(f"w{i}" for i in range(30))
    rows = [(1, long), (1, long), (2, "z " + long), (None, long), (None, None), (3, "q"), (3, long + " tail")]
    got = {}
    for r in S.without_repeats(make_docs(rows)).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed))
    assert {k: sorted(v) for k, v in got.items()} == {
        1: [(30, 0)] * 2, 2: [(31, 30)], 3: [(1, 0), (31, 30)], None: [(0, 0), (30, 30)]}


def test_empty(make_docs):
    assert S.without_repeats(make_docs([])).collect() == []
