import random

import pytest

from hirelens.llm import minhash as M


def brute(rows, width, percent):
    sets = {d: M.shingle_set(M.words_of(t), width) for d, t in rows if d is not None}
    ids = sorted(sets)
    root = {d: d for d in ids}
    where = {}
    for d in ids:
        for g in sets[d]:
            where.setdefault(g, []).append(d)
    links, seen = [], set()
    for w in where.values():
        for i, a in enumerate(w):
            for b in w[i + 1:]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        links.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    return {(d, len(sets[d]), root[d], d == root[d]) for d in ids}


def corpus(seed=1, docs=160):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = rnd.choices(words, k=40)
    rows = []
    for i in range(docs):
        t = rnd.choices(words, k=rnd.choice([3, 8, 40, 200]))
        if i % 3 == 0:                                                       # a passage that many share
            t = t + passage
        rows.append((i, " ".join(t)))
        for j in range(rnd.choice([0, 0, 1, 4])):                            # near copies around the limit
            c = list(t)
            for _ in range(rnd.randint(0, max(1, len(c) // 8))):
                c[rnd.randrange(len(c))] = rnd.choice(words)
            rows.append((1000 + 10 * i + j, "\n".join(c).upper()))
    t = rnd.choices(words, k=100)
    for i in range(80):                                                      # a chain and a crowd of near copies
        t = list(t)
        t[rnd.randrange(100)] = rnd.choice(words)
        rows.append((5000 + i, " ".join(t)))
    rows += [(9000 + i, rows[0][1]) for i in range(50)]
    return rows + [(9100, None), (9101, ""), (9102, " \n"), (9103, "one"), (9104, "ONE"), (9105, "one"), (9106, "É x"),
                   (9107, "é x"), (9108, "a b " * 4000), (9109, "A  B\n" * 4000)]


@pytest.mark.parametrize("width,long_list,block", [(2, 32, 1024), (2, 2, 16), (5, 32, 1024)])
def test_against_brute_force(make_docs, monkeypatch, width, long_list, block):
    monkeypatch.setattr(M, "LONG_LIST", long_list)                           # short lists by join, or all in blocks
    monkeypatch.setattr(M, "BLOCK", block)
    rows = corpus(width)
    got = M.near_duplicates(make_docs(rows, extra=True), width=width)
    assert {tuple(r) for r in got.collect()} == brute(rows, width, 80)


def test_repeated_rows_and_null_ids(make_docs):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, "a b c d"), (None, None), (3, None)]
    got = sorted(map(tuple, M.near_duplicates(make_docs(rows), width=2).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (1, 3, 1, True), (2, 3, 1, False), (None, 0, None, True), (None, 0, None, True),
                          (3, 0, 3, True)], key=str)
    kept = M.deduplicated(make_docs(rows, extra=True), width=2)
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.doc_id) == [(1, "a b c d"), (3, None)]
    assert kept.where("doc_id IS NULL").count() == 2


def test_rows_that_share_an_id_with_unlike_texts(make_docs):
    rows = [(1, "a b c d"), (1, "p q r s t"), (2, "a b c d"), (3, "p q r s t"), (4, "x y z"), (4, "k l m"), (4, "K  l m"),
            (5, "u v w"), (5, None)]
    docs = make_docs(rows, extra=True)
    got = sorted(map(tuple, M.near_duplicates(docs, width=2).collect()))
    assert got == sorted([(1, 3, 1, True), (1, 4, 1, True), (2, 3, 1, False), (3, 4, 1, False), (4, 2, 4, True), (4, 2, 4, True),
                          (4, 2, 4, True), (5, 2, 5, True), (5, 0, 5, True)])
    kept = M.deduplicated(docs, width=2)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, (r.text or "").lower().split()) for r in kept.collect()) == sorted(
        (i, (t or "").lower().split()) for i, t in rows if i in (1, 4, 5) and t != "K  l m")


def test_empty(make_docs):
    assert M.near_duplicates(make_docs([])).collect() == []
    assert M.deduplicated(make_docs([])).collect() == []


def test_chances():
    c = M.least_shared(64, 0.8)
    rnd = random.Random(3)
    trials = [[rnd.random() < 0.8 for _ in range(64)] for _ in range(20_000)]
    assert 20 <= c < min(map(sum, trials))
    assert M.key_width(64, 0.8) == 3 and M.key_width(32, 0.8) == 2 and M.key_width(8, 0.5) == 1
    assert all(any(x[i] and x[i + 1] and x[i + 2] for i in range(62)) for x in trials)


def test_small_sets_are_met_for_certain(make_docs):
    rows, n = [], 0
    for size in range(3, 12):                                               # one shingle more or less, anywhere
        words = [f"a{size}x{i}" for i in range(size)]
        for t in [words] + [words[:i] + words[i + 1:] for i in (0, size - 1)] + [words + ["more"], ["more"] + words]:
            rows.append((n, " ".join(t)))
            n += 1
    got = M.near_duplicates(make_docs(rows), width=2)
    assert {tuple(r) for r in got.collect()} == brute(rows, 2, 80)
