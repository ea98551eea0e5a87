import hashlib
import zlib

import pytest

from hirelens.llm import merkle


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def counted(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, more=0):
    n = None if r.n_chars is None else r.n_chars + more
    return H(*map(counted, (r.doc_id, r.source, r.lang, n, r.text)))


def climb(hashes, fanout):
    """Top of a tree and, per leaf, (left siblings, right siblings) level by level."""
    paths = [[] for _ in hashes]
    level = [(h, [i]) for i, h in enumerate(hashes)]
    while len(level) > 1:
        above = []
        for x in range(0, len(level), fanout):
            run = level[x:x + fanout]
            for y, (_, under) in enumerate(run):
                for i in under:
                    paths[i].append(("".join(h for h, _ in run[:y]), "".join(h for h, _ in run[y + 1:])))
            above.append((H(*[h for h, _ in run]), [i for _, under in run for i in under]))
        level = above
    return level[0][0], paths


def brute(rows, fanout=2, modulus=7):
    groups = {}
    for r in rows:
        groups.setdefault(r.lang, []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own], fanout)))
    if not trees:
        return []
    root, upper = climb([t[1] for t in trees], fanout)
    out = []
    for (own, sub, paths), up in zip(trees, upper):
        for r, path in zip(own, paths):
            hit = modulus and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % modulus == 0
            fold = leaf(r, 1 if hit else 0)
            for left, right in path + up:
                fold = H(left, fold, right)
            out.append((r.doc_id, leaf(r), sub, root, H(*[a + b for a, b in path + up]), fold, fold == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("fanout", [2, 3, 20])
def test_against_brute_force(spark, make_docs, fanout):
    rows = [(i, None if i % 9 == 4 else "ä" * i, [None, "a", "b", "é", "z"][i % 5] if i % 11 else "q",
             None if i % 6 == 0 else "src") for i in range(41)]
    rows += [(3, "again", "a"), (3, "again", "a"), (None, "no id", "a"), (-7, "", "lone")]      # ties, nulls, a lone leaf
    docs = make_docs(rows, extra=True)
    got = rows_of(merkle.manifest(docs, fanout))
    assert got == brute(docs.collect(), fanout)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_tampering_and_nulls(spark, docs_schema):
    docs = spark.createDataFrame([(i, "t", "en", "s", None if i % 2 else i) for i in range(100)], docs_schema)
    got = rows_of(merkle.manifest(docs))
    assert got == brute(docs.collect())
    assert all(r[-1] for r in got if r[0] % 2)                     # no n_chars to raise: never tampered with
    assert all(r[-1] for r in merkle.manifest(docs, tamper_modulus=0).collect())


def test_hot_group_and_small_tables(spark, make_docs):
    docs = make_docs([(i, str(i), "en" if i % 3 else f"x{i}") for i in range(700)])          # more levels than a step folds
    assert rows_of(merkle.manifest(docs)) == brute(docs.collect())
    one = make_docs([(5, "a")])
    [row] = merkle.manifest(one, tamper_modulus=0).collect()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == H()
    empty = merkle.manifest(make_docs([]))
    assert empty.collect() == [] and empty.columns[0] == "doc_id"


def test_any_change_moves_the_root(spark, make_docs):
    rows = [(i, f"text {i}") for i in range(40)]
    roots = {merkle.manifest(make_docs(x)).first().root
             for x in (rows, rows[:-1], rows[:-1] + [(39, "text 39 ")], rows[1:] + [(0, "text 0")])}
    assert len(roots) == 3                                         # row order does not count


def test_plan_has_no_window_over_leaves(spark, make_docs):
    plan = merkle.manifest(make_docs([(i, "x") for i in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
