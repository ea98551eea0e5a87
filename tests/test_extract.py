"""X1's index lookups and X2's negated stretches."""
import pytest

from hirelens.functions.text import skill_tokens
from hirelens.operators import extract as X

TAX = [("Spark", "spark"), ("Kafka", "kafka"), ("Python", "python"), ("Machine Learning", "machine learning"), ("C++", "c++"),
       ("Big Data", "big data")]


def _skills(spark, text, negation=True, tax=TAX):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return {r.skill for r in X.extract_skills(docs, spark.createDataFrame(tax, "canonical string, alias string"), negation=negation).collect()}


@pytest.mark.parametrize("text,want", [
    ("Spark is not required", set()),
    ("Spark and Kafka are not needed; Python is", {"Python"}),
    ("Python required, Spark not required", {"Python"}),
    ("no experience in Spark or Kafka", set()),
    ("no experience in Spark, Kafka or machine learning. Python is a must", {"Python"}),
    ("not only Python", {"Python"}),
    ("not only Spark but Kafka", {"Spark", "Kafka"}),
    ("without Spark but with Kafka", {"Kafka"}),
    ("never used C++\nbig data", {"Big Data"}),
    ("Not Spark", set()),
    ("Spark required. Not negotiable: Kafka", {"Spark", "Kafka"}),
    ("big, data and Node.js but-for Kafka", {"Big Data", "Kafka"}),
    ("", set()),
])
def test_negated_stretches(spark, text, want):
    assert _skills(spark, text) == want


def test_clauses_keep_all_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    odd = spark.createDataFrame([("a.b. c;d!\nbut x though.",), ("C++. C#; etc.) (but) all-but. but",), (None,), ("",)], "text string")
    from pyspark.sql import functions as F
    both = docs.union(odd).select(F.flatten(X.clause_tokens(F.col("text"))).alias("a"), skill_tokens("text").alias("b")).collect()
    assert all(r.a == r.b for r in both)


def test_lookups_do_not_grow_with_aliases_of_a_first_word(spark):
    """Ten times the aliases under one first word: the same rows between lookup and filter."""
    docs = spark.createDataFrame([(i, "the quick fox and the lazy dog " * 20) for i in range(5)], "doc_id long, text string")
    few = [("a", "the quick"), ("b", "the lazy dog")] + [(f"x{i}", f"the w{i}") for i in range(50)]
    many = few + [(f"y{i}", f"the v{i}") for i in range(500)] + [("c", "the quick")]
    rows = [X.looked_up(docs, spark.createDataFrame(t, "canonical string, alias string")).count() for t in (few, many)]
    assert rows[0] == rows[1] == 5 * 40
    grams = X.alias_index(spark.createDataFrame(many, "canonical string, alias string"))[1]
    assert grams.count() == grams.select("gram").distinct().count()
    assert _skills(spark, "the quick", tax=many) == {"a", "c"}


def test_no_aliases_and_no_texts(spark):
    empty = spark.createDataFrame([], "canonical string, alias string")
    docs = spark.createDataFrame([(1, "spark"), (2, None)], "doc_id long, text string")
    assert X.extract_skills(docs, empty).collect() == []
    assert X.extract_skills(docs.limit(0), spark.createDataFrame(TAX, "canonical string, alias string")).collect() == []


def test_no_token_travels_to_the_index(spark):
    """A taxonomy whose size Spark cannot tell beforehand is written first, so the lookups are planned as broadcasts."""
    docs = spark.createDataFrame([(1, "Spark and machine learning")], "doc_id long, text string")
    found = X.looked_up(docs, spark.createDataFrame(TAX, "canonical string, alias string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert {r.gram for r in found.collect()} == {"spark", "machine learning"}


def test_tokens_in_one_pass(spark):
    from itertools import product

    from pyspark.sql import functions as F

    from hirelens.functions.text import TOKEN_EDGES, TOKEN_PATTERN
    texts = ["".join(x) for x in product(".-a+ ", repeat=6)] + ["C++, .NET/CI/CD' 'Node.js. é́x ß½ 𝒳y ...", None, ""]
    df = spark.createDataFrame([(x,) for x in texts], "text string")
    raw = F.regexp_extract_all("text", F.lit(f"({TOKEN_PATTERN})"), F.lit(1))
    want = F.filter(F.transform(raw, lambda x: F.regexp_replace(x, TOKEN_EDGES, "")), lambda x: x != "")
    assert df.where(~want.eqNullSafe(skill_tokens("text"))).isEmpty()
