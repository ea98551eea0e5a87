"""Invariants: union = sum of parts, dedup flags but never drops, clean + flagged =
total, shares sum to 1, cosine symmetric with unit diagonal, Wilson interval holds the estimate."""
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _q(key, spark):
    import __spark_entry__ as E
    return E.queries()[key](spark, SF)


def test_union_is_sum_of_parts(spark):
    from hirelens.operators import clean as C
    from hirelens.sources import fixtures as fx
    raw = fx.postings_raw(spark, SF, with_text=False)
    parts = [C.filter_roles(C.tag_postings(raw.filter(F.col("source") == s))).count() for s in fx.SOURCES]
    assert _q("union_sources", spark).count() == sum(parts)


def test_dedup_never_drops_rows(spark):
    assert _q("dedup_30d", spark).count() == _q("filter_geo", spark).count()


def test_clean_plus_flagged_is_total(spark):
    for r in _q("dedup_stats", spark).collect():
        assert r.n_clean + r.n_duplicate == r.n


def test_shares_sum_to_one(spark):
    for col, key in (("share", "role_share"), ("share_raw", "role_composition")):
        grp = "source" if key == "role_share" else "snapshot"
        for r in _q(key, spark).groupBy(grp).agg(F.sum(col).alias("s")).collect():
            assert abs(r.s - 1.0) < 1e-4


def test_cosine_symmetric_unit_diagonal(spark):
    rows = {(r.profile_a, r.profile_b): r.cosine for r in _q("role_similarity", spark).collect()}
    for (a, b), c in rows.items():
        if c is None:
            continue
        assert abs(c - rows[(b, a)]) < 1e-6
        if a == b:
            assert abs(c - 1.0) < 1e-6
        assert -1e-9 <= c <= 1.0 + 1e-9


def test_wilson_contains_estimate(spark):
    for r in _q("wilson_ci", spark).collect():
        if r.prevalence is not None:
            assert r.ci_low - 1e-6 <= r.prevalence <= r.ci_high + 1e-6


def test_attach_keeps_every_posting(spark):
    assert _q("attach_skills", spark).count() == _q("dedup_30d", spark).count()
