"""Bridge views from the driver tables to the reference's inputs (FIXTURES.md §2.1).

Each view is defined twice, identically: as a PySpark builder (used by the
engine) and as a SQL snippet (used by the DuckDB oracle in
``hirelens.plans.registry``). The views are projections of ``orders`` /
``lineitem`` / ``part`` / ``documents``, so their size grows with the tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.functions.text import TOKEN_EDGES, TOKEN_PATTERN, skill_tokens

# ---------------------------------------------------------------------------
# Fixed values of the fixture (FIXTURES.md §2.1), in index order.
# ---------------------------------------------------------------------------
SOURCES = ["board_a", "network_b", "ats_c"]
TITLES = [
    "Data Scientist", "Senior Data Scientist", "Data Analyst II", "Machine Learning Engineer",
    "Lead ML Engineer", "Applied Scientist, Data Science", "Research Scientist",
    "Principal Research Engineer", "AI Engineer", "Jr. Data Engineer", "Analytics Engineer",
    "Staff Data Engineer", "Business Intelligence Analyst", "Sr Data Scientist / Data Engineer",
    "Artificial Intelligence Engineer (new grad)", "MLOps Engineer", "Data Scientists",
    "Mid-Level BI Analyst", "Director, Data Science", "Software Engineer", "Product Manager",
    "ENTRY LEVEL DATA ANALYST", None,
]
LOCATIONS = [
    "San Francisco, CA", "New York, United States", "Remote", "Austin, TX ", "London, England",
    "London, UK", "Manchester, United Kingdom", "Berlin, Germany", "Berlin, DE", "Paris, France",
    "Bangalore, India", "Indianapolis, Indiana", "Singapore", "Toronto, Canada", "Remote, India",
    "austin, tx", "Boston, MA", "", None,
]
HINTS = [None, "Entry level", "Mid-Senior level", "Director", "Associate", "Executive", "Mid"]
HINT_SOURCE = "network_b"
NULL_COMPANY_MOD = 97
COMPANY_DIV = 50

VALID_YEARS = [1995, 1998, 2000, 2001]
SNAPSHOT_MAP = {1995: 1995, 1998: 1998, 2000: 2001, 2001: 2001}
SNAPSHOTS = [1995, 1998, 2001]
FIRST_SNAPSHOT, MIDDLE_SNAPSHOT, LAST_SNAPSHOT = 1995, 1998, 2001
BIASED_SOURCE = "network_b"
SINGLE_SOURCE = "ats_c"
ARTEFACT_SOURCE, ARTEFACT_MIN_YEAR = "ats_c", 1998

# dictionary rule over part.p_name = "<adjective> <noun>"
SHARED_ADJECTIVES = ["red", "blue", "old", "new"]      # alias -> canonical = noun
OWN_ADJECTIVES = ["small", "large", "hot"]             # alias -> canonical = p_name
CONFLICT_ALIAS, CONFLICT_CANONICAL, CONFLICT_SEQ = "hot ring", "ring", 1_000_000
NOUN_CATEGORY = [
    ("ring", "language"), ("widget", "ml_framework"), ("gizmo", "genai"),
    ("gear", "data_engineering"), ("plate", "data_platform"), ("bolt", "cloud_infra"),
    ("anvil", "analytics_bi"),
]
PLATFORM_PREFIX, PLATFORM_FAMILY = "hot ", "HotSuite"
NAMED_SLOTS = [("language", "Ring", "ring"), ("genai", "Gizmo", "gizmo"), ("genai", "Gizmo", "small gizmo"),
               ("genai", "Later Gizmo", "gizmo")]          # a pattern in two slots: the first in file order counts
TEXT_ALIASES = ["the", "of the", "that", "que", "der", "la", "C", "C++", "C#", "S3", "D3", "CI/CD", "Node.js", "GPT-4"]
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def doc_of(docs: DataFrame, native_id):
    """The document whose text a posting carries: native id modulo the number of documents."""
    return native_id % docs.agg(F.count(F.lit(1))).scalar()


def _pick(values, idx_col):
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(arr, idx_col.cast("int"))


def source_of(key_col):
    return _pick(SOURCES, key_col % 3)


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(_doc, description_text) of every document."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), F.col("text").alias("description_text"))


def postings_raw(spark: SparkSession, sf_dir: str, with_text: bool = True, texts: DataFrame | None = None) -> DataFrame:
    """One raw posting per order (columns named after the reference's raw fields). ``texts``: a copy of
    ``document_texts`` that is laid out for the join."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    k = F.col("o_orderkey")
    src = source_of(k)
    df = o.select(
        k.alias("native_id"),
        src.alias("source"),
        _pick(TITLES, F.expr("(o_orderkey div 3) % 23")).alias("raw_title"),
        _pick(LOCATIONS, F.expr("(o_orderkey div 7) % 19")).alias("location"),
        F.when(src == HINT_SOURCE, _pick(HINTS, F.expr("(o_orderkey div 5) % 7"))).alias("level_hint"),
        F.when(F.col("o_custkey") % NULL_COMPANY_MOD != 0,
               F.concat(F.lit("C"), F.expr(f"o_custkey div {COMPANY_DIV}").cast("string"))).alias("company"),
        F.to_date("o_orderdate").alias("date"),
    )
    if not with_text:
        return df.withColumn("description_text", F.lit(None).cast("string"))
    docs = table(spark, sf_dir, "documents")
    text = document_texts(spark, sf_dir) if texts is None else texts
    return df.withColumn("_doc", doc_of(docs, F.col("native_id"))).join(text, "_doc", "left").drop("_doc")


def extractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw extractions long table ``(posting_id, pos, term)`` from lineitem x part."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    j = li.join(part, li.l_partkey == part.p_partkey)
    term = F.when(F.col("l_linenumber") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    j = j.select(
        F.concat(source_of(F.col("l_orderkey")), F.lit(":"), F.col("l_orderkey").cast("string")).alias("posting_id"),
        F.col("l_linenumber"), term.alias("term"))
    w = Window.partitionBy("posting_id").orderBy("l_linenumber", "term")
    return j.select("posting_id", F.row_number().over(w).alias("pos"), "term")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skill dictionary ``(canonical, alias, seq)`` derived from the distinct part names."""
    names = table(spark, sf_dir, "part").select(F.col("p_name").alias("alias")).distinct()
    adj = F.split("alias", " ").getItem(0)
    noun = F.element_at(F.split("alias", " "), -1)
    canon = (F.when(adj.isin(SHARED_ADJECTIVES), noun)
             .when(adj.isin(OWN_ADJECTIVES), F.col("alias")))
    d = names.select(canon.alias("canonical"), "alias").filter(F.col("canonical").isNotNull())
    # file order = canonical sorted case-insensitively, aliases alphabetical (bounded dimension)
    d = d.withColumn("seq", F.row_number().over(
        Window.orderBy(F.lower("canonical"), "canonical", "alias")).cast("long"))
    conflict = d.sparkSession.createDataFrame(
        [(CONFLICT_CANONICAL, CONFLICT_ALIAS, CONFLICT_SEQ)], "canonical string, alias string, seq long")
    return d.unionByName(conflict)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category input ``(canonical_name, category, platform_family)`` keyed by the canonical's noun."""
    canon = dictionary(spark, sf_dir).select(F.col("canonical").alias("canonical_name")).distinct()
    noun = F.element_at(F.split("canonical_name", " "), -1)
    cat_map = F.create_map(*[F.lit(x) for pair in NOUN_CATEGORY for x in pair])
    out = canon.select(
        "canonical_name",
        F.element_at(cat_map, noun).alias("category"),
        F.when(F.col("canonical_name").startswith(PLATFORM_PREFIX), F.lit(PLATFORM_FAMILY))
         .otherwise(F.lit("")).alias("platform_family"))
    return out.filter(F.col("category").isNotNull())


def named_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T18 slots ``(category, slot, pattern)`` in file order: the fixed ones, then for every part type a slot of
    each category that has the type's part names as patterns; a name of several types is in several slots."""
    fixed = spark.createDataFrame([(i, *x) for i, x in enumerate(NAMED_SLOTS)], "seq long, category string, slot string, pattern string")
    cats = F.explode(F.array(*[F.lit(c) for _, c in NOUN_CATEGORY])).alias("category")
    own = table(spark, sf_dir, "part").select(cats, F.initcap("p_type").alias("slot"), F.lower(F.trim("p_name")).alias("pattern"))
    own = own.distinct().withColumn("seq", F.lit(len(NAMED_SLOTS)).cast("long"))
    # the fixed slots stand first; the others follow by name
    return fixed.unionByName(own)


def text_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 taxonomy ``(canonical, alias)``: the fixed names, and every pair of neighbouring tokens
    of ``benchmark``; an alias is its own canonical."""
    fixed = spark.createDataFrame([(a,) for a in TEXT_ALIASES], "alias string")
    toks = table(spark, sf_dir, "benchmark").select(skill_tokens(F.lower("text")).alias("t"))
    pairs = toks.where(F.size("t") > 1).select(F.explode(F.zip_with(
        F.slice("t", 1, F.size("t") - 1), F.slice("t", 2, F.size("t") - 1),
        lambda a, b: F.concat_ws(" ", a, b))).alias("alias"))
    out = fixed.unionByName(pairs).distinct()
    return out.select(F.col("alias").alias("canonical"), "alias")


# ---------------------------------------------------------------------------
# SQL twins of the views above (DuckDB dialect), used by the oracle.
# ---------------------------------------------------------------------------
def _sql_str(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def _values(name, values):
    rows = ", ".join(f"({i}, {_sql_str(v)})" for i, v in enumerate(values))
    return f"{name}(i, v) AS (VALUES {rows})"


def _source_sql(k):
    return f"CASE {k} % 3 WHEN 0 THEN 'board_a' WHEN 1 THEN 'network_b' ELSE 'ats_c' END"


SQL_POSTINGS_RAW = f"""
{_values('fx_titles', TITLES)},
{_values('fx_locations', LOCATIONS)},
{_values('fx_hints', HINTS)},
postings_raw AS (
  SELECT o.o_orderkey AS native_id,
         {_source_sql('o.o_orderkey')} AS source,
         t.v AS raw_title,
         l.v AS location,
         CASE WHEN o.o_orderkey % 3 = 1 THEN h.v END AS level_hint,
         CASE WHEN o.o_custkey % {NULL_COMPANY_MOD} <> 0
              THEN 'C' || CAST(o.o_custkey // {COMPANY_DIV} AS VARCHAR) END AS company,
         CAST(o.o_orderdate AS DATE) AS date,
         d.text AS description_text
  FROM orders o
  JOIN fx_titles t ON t.i = (o.o_orderkey // 3) % 23
  JOIN fx_locations l ON l.i = (o.o_orderkey // 7) % 19
  JOIN fx_hints h ON h.i = (o.o_orderkey // 5) % 7
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM documents)
)"""

SQL_EXTRACTIONS = f"""
extractions AS (
  SELECT {_source_sql('l.l_orderkey')} || ':' || CAST(l.l_orderkey AS VARCHAR) AS posting_id,
         CAST(row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber,
              CASE WHEN l.l_linenumber % 3 = 0 THEN upper(p.p_name) ELSE p.p_name END) AS INTEGER) AS pos,
         CASE WHEN l.l_linenumber % 3 = 0 THEN upper(p.p_name) ELSE p.p_name END AS term
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

_shared = ", ".join(_sql_str(a) for a in SHARED_ADJECTIVES)
_own = ", ".join(_sql_str(a) for a in OWN_ADJECTIVES)
SQL_DICTIONARY = f"""
fx_dict_base AS (
  SELECT CASE WHEN split_part(alias, ' ', 1) IN ({_shared}) THEN split_part(alias, ' ', -1)
              WHEN split_part(alias, ' ', 1) IN ({_own}) THEN alias END AS canonical, alias
  FROM (SELECT DISTINCT p_name AS alias FROM part)
),
dictionary AS (
  SELECT canonical, alias,
         CAST(row_number() OVER (ORDER BY lower(canonical), canonical, alias) AS BIGINT) AS seq
  FROM fx_dict_base WHERE canonical IS NOT NULL
  UNION ALL SELECT {_sql_str(CONFLICT_CANONICAL)}, {_sql_str(CONFLICT_ALIAS)}, CAST({CONFLICT_SEQ} AS BIGINT)
)"""

_cat_case = " ".join(f"WHEN {_sql_str(n)} THEN {_sql_str(c)}" for n, c in NOUN_CATEGORY)
SQL_CATEGORIES = f"""
categories AS (
  SELECT canonical_name, category, platform_family FROM (
    SELECT canonical_name,
           CASE split_part(canonical_name, ' ', -1) {_cat_case} END AS category,
           CASE WHEN starts_with(canonical_name, {_sql_str(PLATFORM_PREFIX)}) THEN {_sql_str(PLATFORM_FAMILY)}
                ELSE '' END AS platform_family
    FROM (SELECT DISTINCT canonical AS canonical_name FROM dictionary)
  ) WHERE category IS NOT NULL
)"""

SQL_NAMED_SLOTS = f"""fx_slots(seq, category, slot, pattern) AS (VALUES {", ".join(
    f"({i}, {_sql_str(c)}, {_sql_str(s)}, {_sql_str(p)})" for i, (c, s, p) in enumerate(NAMED_SLOTS))}),
named_slots AS (
  SELECT category, pattern, arg_min(slot, lpad(CAST(seq AS VARCHAR), 9, '0') || slot) AS slot FROM (
    SELECT * FROM fx_slots
    UNION SELECT {len(NAMED_SLOTS)}, category, array_to_string(list_transform(string_split(lower(p_type), ' '),
                 lambda w: upper(w[1]) || w[2:]), ' '), lower(trim(p_name))
    FROM part, (SELECT unnest([{", ".join(_sql_str(c) for _, c in NOUN_CATEGORY)}]) AS category))
  GROUP BY category, pattern)"""

_edges = TOKEN_EDGES.replace("'", "''")
_token = TOKEN_PATTERN.replace("'", "''")


def sql_tokens(text: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all({text}, '{_token}'), "
            f"lambda x: regexp_replace(x, '{_edges}', '', 'g')), lambda x: x <> '')")


SQL_TEXT_ALIASES = f"""
fx_bench AS (SELECT {sql_tokens('lower(text)')} AS t FROM benchmark),
text_aliases AS (
  SELECT alias AS canonical, alias, lower(alias) AS key FROM (
    SELECT unnest([{", ".join(_sql_str(a) for a in TEXT_ALIASES)}]) AS alias
    UNION SELECT t[i] || ' ' || t[i + 1] FROM (SELECT t, unnest(range(1, len(t))) AS i FROM fx_bench)))"""
