"""Goldens for the tagging rules (FIXTURES §2.1 index tables)."""
from pyspark.sql import functions as F

from hirelens.functions import rules
from hirelens.sources import fixtures as fx

TITLE_EXPECT = [
    ("Data Scientist", "unclassified"), ("Data Scientist", "senior"), ("Data Analyst", "mid"),
    ("ML Engineer", "unclassified"), ("ML Engineer", "senior"), ("Applied Scientist", "unclassified"),
    ("Research Scientist", "unclassified"), ("Research Scientist", "lead"), ("AI Engineer", "unclassified"),
    ("Data Engineer", "entry"), ("Analytics Engineer", "unclassified"), ("Data Engineer", "lead"),
    ("Data Analyst", "unclassified"), ("Data Engineer", "senior"), ("AI Engineer", "entry"),
    ("ML Engineer", "unclassified"), ("Other / Unclassified", "unclassified"), ("Data Analyst", "mid"),
    ("Data Scientist", "lead"), ("Other / Unclassified", "unclassified"), ("Other / Unclassified", "unclassified"),
    ("Data Analyst", "entry"), ("Other / Unclassified", "unclassified"),
]
GEO_EXPECT = ["US", "US", "US", "US", "UK", "US", "UK", "EU", "US", "EU", "APAC", "APAC", "APAC", "Other",
              "US", "Other", "US", "Other", "Other"]
HINT_EXPECT = [None, "entry", "senior", "lead", "entry", "senior", "mid"]


def test_titles_and_seniority(spark):
    df = spark.createDataFrame([(t,) for t in fx.TITLES], "t string")
    rows = df.select(rules.canonical_title("t").alias("c"), rules.seniority("t").alias("s")).collect()
    assert [(r.c, r.s) for r in rows] == TITLE_EXPECT


def test_geo(spark):
    df = spark.createDataFrame([(t,) for t in fx.LOCATIONS], "t string")
    assert [r.g for r in df.select(rules.geo_tag("t").alias("g")).collect()] == GEO_EXPECT


def test_geo_strict_option(spark):
    df = spark.createDataFrame([("London, UK",), ("Berlin, DE",)], "t string")
    assert [r.g for r in df.select(rules.geo_tag("t", strict=True).alias("g")).collect()] == ["UK", "US"]


def test_hint_branch_first(spark):
    df = spark.createDataFrame([("Software Engineer", h) for h in fx.HINTS], "t string, h string")
    got = [r.s for r in df.select(rules.seniority("t", F.col("h")).alias("s")).collect()]
    assert got == [h or "unclassified" for h in HINT_EXPECT]


def test_unicode_trim(spark):
    df = spark.createDataFrame([("  Data Scientist \t",)], "t string")
    assert df.select(rules.unicode_trim("t").alias("x")).first().x == "Data Scientist"


def test_carriage_return_in_entry_level(spark):
    # Python's `.` matches \r: "entry\rlevel" is entry level
    df = spark.createDataFrame([("Entry\rLevel Analyst",)], "t string")
    assert df.select(rules.seniority("t").alias("s")).first().s == "entry"
