"""Goldens for Wilson (N-B), trend gate (N-C), cosine (N-F) and mapping."""
from pyspark.sql import functions as F

from hirelens.functions.stats import wilson_bounds
from hirelens.operators import taxonomy as TX
from hirelens.plans import analysis as AN


def test_wilson(spark):
    df = spark.createDataFrame([(0, 10), (5, 10), (0, 0)], "k long, n long")
    lo, hi = wilson_bounds("k", "n")
    rows = df.select(F.round(lo, 4).alias("lo"), F.round(hi, 4).alias("hi")).collect()
    assert (rows[0].lo, rows[0].hi) == (0.0, 0.2775)
    assert (rows[1].lo, rows[1].hi) == (0.2366, 0.7634)
    assert (rows[2].lo, rows[2].hi) == (None, None)


def test_trend_gate(spark):
    g = spark.createDataFrame([("a", .65, .45, .75), ("b", .1, .2, .3), ("c", .2, .2, .2)],
                              "skill string, p_0 double, p_1 double, p_2 double")
    g = g.withColumn("n_0", F.lit(1)).withColumn("n_1", F.lit(1)).withColumn("n_2", F.lit(1))
    got = {r.skill: r.direction for r in AN.trend(g).collect()}
    assert got == {"a": "non_monotone", "b": "increasing", "c": "flat"}


def test_cosine(spark):
    prof = spark.createDataFrame([("p", "x", 0.5), ("p", "y", 0.5), ("q", "x", 0.5), ("q", "y", 0.5),
                                  ("r", "z", 1.0)], "profile string, skill string, p double")
    out = AN.cosine_matrix(prof, ["p", "q", "r", "e"], [("p", "q"), ("p", "r"), ("p", "e"), ("p", "p")])
    got = {(r.profile_a, r.profile_b): r.cosine for r in out.collect()}
    assert got == {("p", "q"): 1.0, ("p", "r"): 0.0, ("p", "e"): None, ("p", "p"): 1.0}


def test_map_first_occurrence(spark):
    extr = spark.createDataFrame([("p1", 1, "Py"), ("p1", 2, "py"), ("p1", 3, "sql"), ("p1", 4, "zz")],
                                 "posting_id string, pos int, term string")
    d = spark.createDataFrame([("Python", "py", 1), ("SQL", "sql", 2)], "canonical string, alias string, seq long")
    out = TX.map_skills(extr, TX.reverse_lookup(d)).first()
    assert out.skills_present == ["Python", "SQL"]


def test_last_wins(spark):
    d = spark.createDataFrame([("A", "x", 1), ("B", "X", 2)], "canonical string, alias string, seq long")
    assert TX.reverse_lookup(d).first().canonical == "B"


def test_subcategory(spark):
    cats = spark.createDataFrame([("Python", "language", ""), ("Go", "language", ""), ("x", "new_cat", "")],
                                 "canonical_name string, category string, platform_family string")
    slots = spark.createDataFrame([("language", "Python", "python")], "category string, slot string, pattern string")
    got = {r.canonical_name: r.subcategory for r in TX.subcategory(cats, slots).collect()}
    assert got == {"Python": "Python", "Go": "Other Languages", "x": "Other New Cat"}
