"""Registered queries: sources and sinks (S1-S7, S14), batching (W2, W3, J7, W4),
occupation crosswalk (J11, J12) and response parsing (P1-P3)."""
from __future__ import annotations

from contextlib import ExitStack, contextmanager

from pyspark.sql import functions as F

from hirelens.functions import dates
from hirelens.functions.rules import DS_TITLES
from hirelens.functions.text import first_location, text_or_empty
from hirelens.operators import batching as B
from hirelens.operators import clean as C
from hirelens.operators import parse as P
from hirelens.operators import taxonomy as TX
from hirelens.plans.base import clean_documents, clean_postings, final_postings, skills_long, unified_postings, with_description
from hirelens.plans.q_text import sql_html_strip
from hirelens.plans.registry import _in, register, sql_geo, sql_seniority, sql_title, with_views
from hirelens.sources import feeds as FD
from hirelens.sources import fixtures as fx
from hirelens.sources import io as IO

BATCH = 5          # postings per extraction batch (W2)
DICT_BATCH = 10    # dictionary / category rows per response (P2, P3)

# Occupation crosswalk, canonical role -> O*NET SOC codes
# (roles without a dedicated code are absent and keep a null code).
CROSSWALK = [
    ("Data Scientist", "15-2051.00"),
    ("Data Analyst", "15-2031.00, 15-1242.00"),
    ("Data Engineer", "15-1242.00, 15-1252.00"),
    ("Research Scientist", "15-1221.00"),
    ("ML Engineer", "15-2051.00, 15-1221.00, 15-1252.00"),
]
CROSS_ROLE_MIN = 4


# ---- S1 / S2 -------------------------------------------------------------------------
RAW_CSV_SCHEMA = ("native_id long, source string, raw_title string, location string, level_hint string, "
                  "company string, date date, description_text string")


@contextmanager
def _raw_slices(spark, sf):
    """A function that gives the raw postings, with their texts, under a condition: slices of ascending ids."""
    ids = fx.postings_raw(spark, sf, with_text=False)
    texts = fx.document_texts(spark, sf)
    mean = texts.agg(F.avg(F.octet_length("description_text"))).first()[0] or 0.0
    with ExitStack() as stack:
        if IO.slice_count(spark, ids.count(), mean) > 1:
            texts = stack.enter_context(IO.bucketed(texts, "_doc", "texts"))
        raw = fx.postings_raw(spark, sf, texts=texts)

        def slices(where=F.lit(True)):
            some = ids.where(where)
            n = IO.slice_count(spark, some.count(), mean)
            return [raw.where(where & part) for part in IO.key_slices(some, "native_id", n)]

        yield slices


@register("src_csv", with_views("postings_raw", body="""
SELECT row_number() OVER (ORDER BY native_id) - 1 AS row_id, native_id, source, raw_title, company,
       CAST(length(description_text) AS BIGINT) AS desc_chars FROM postings_raw"""))
def src_csv(spark, sf):
    """Raw postings written as multi-line CSV (texts hold newlines), read back
    with an explicit schema; the row position in file order becomes the id. Slices of ascending
    ids are written and read in turn."""
    def write(raw, path):
        (raw.orderBy("native_id").write.option("header", True).option("escape", '"').options(**IO.GZIP)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))

    def read(path):
        back = (spark.read.schema(RAW_CSV_SCHEMA).option("header", True).option("multiLine", True)
                .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False).csv(path))
        return IO.row_places(back).select("native_id", "source", "raw_title", "company",
                                          F.char_length("description_text").cast("long").alias("desc_chars"), "_file", "_mid")

    with _raw_slices(spark, sf) as slices:
        back = IO.through_files(spark, slices(), write, read, "raw_csv")
    return IO.with_row_position(back, "row_id")


# ---- S3 / S4 -------------------------------------------------------------------------
_SLICES = {  # tag -> (source, id, title, text, company, location, date) column names
    "feed_a": ("board_a", "id", "title", "description_html", "source_slug", "locations", "posted_at"),
    "feed_b": ("network_b", "job_id", "name", "description", "company", "location", "created_at"),
    "feed_c": ("ats_c", "external_id", "job_title", "content", "company_name", "office_locations", "updated_at"),
}


def _write_slices(spark, sf) -> dict[str, str]:
    raw = fx.postings_raw(spark, sf, with_text=True)
    paths = {}
    for tag, (src, idc, tc, xc, cc, lc, dc) in _SLICES.items():
        part = raw.filter(F.col("source") == src)
        loc = (F.when(F.col("location").isNull(), F.array().cast("array<string>")).otherwise(F.array("location"))
               if lc.endswith("locations") else F.col("location"))
        iso = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T12:00:00Z"))
        out = part.select(F.col("native_id").cast("string").alias(idc), F.col("raw_title").alias(tc),
                          F.concat(F.lit("<p>"), F.replace(F.replace("description_text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                                   F.lit("</p>")).alias(xc), F.col("company").alias(cc), loc.alias(lc), iso.alias(dc))
        p = IO.scratch_path(spark, f"ats_{tag}")
        out.write.mode("overwrite").parquet(p)
        paths[tag] = p
    return paths


@register("src_tagged_union", with_views("postings_raw", body="""
SELECT CASE source WHEN 'board_a' THEN 'feed_a' WHEN 'network_b' THEN 'feed_b' ELSE 'feed_c' END AS _ats,
       count(*) AS n_rows,
       count(*) FILTER (WHERE source = 'board_a' AND raw_title IS NOT NULL) AS n_title_resolved
FROM postings_raw GROUP BY 1"""))
def src_tagged_union(spark, sf):
    """S3 + S4 (plan-time pick): three parquet files with drifting column names,
    tagged and unioned by name; the title column is the FIRST candidate that exists
    in the union, so rows of files that named it differently resolve to null."""
    u = IO.read_tagged_union(spark, _write_slices(spark, sf))
    title = IO.resolve_column(u, ["title", "name", "job_title"], "title")
    return u.select("_ats", title).groupBy("_ats").agg(F.count(F.lit(1)).alias("n_rows"),
                                                       F.count("title").alias("n_title_resolved"))


@register("src_resolve_columns", with_views("postings_raw", body="""
SELECT CASE source WHEN 'board_a' THEN 'feed_a' WHEN 'network_b' THEN 'feed_b' ELSE 'feed_c' END AS _ats,
       native_id, raw_title AS title, company, coalesce(location, '') AS location, date
FROM postings_raw"""))
def src_resolve_columns(spark, sf):
    """S4 (per-row variant) + T8 + T10: coalesce the candidate columns per row; first
    location of a list; ISO-8601 UTC text -> date."""
    u = IO.read_tagged_union(spark, _write_slices(spark, sf))
    loc = F.coalesce(first_location(F.col("locations")), F.lit(""))
    loc = F.when(F.col("_ats") == "feed_a", first_location(F.col("locations"))) \
        .when(F.col("_ats") == "feed_c", first_location(F.col("office_locations"))) \
        .otherwise(first_location(F.col("location"), is_array=False))
    ts = dates.iso_to_naive_utc(IO.resolve_column(u, ["posted_at", "created_at", "updated_at"], "d", per_row=True))
    return u.select("_ats",
                    IO.resolve_column(u, ["id", "job_id", "external_id"], "native_id", per_row=True).cast("long")
                    .alias("native_id"),
                    IO.resolve_column(u, ["title", "name", "job_title"], "title", per_row=True),
                    IO.resolve_column(u, ["source_slug", "company", "company_name"], "company", per_row=True),
                    loc.alias("location"), F.to_date(ts).alias("date"))


# ---- raw feed files to the unified table -------------------------------------------------
FEED_ANCHOR = "1998-07-01"
_FEED_HTML = "'<p>' || replace(replace(description_text, '&', '&amp;'), '<', '&lt;') || '</p>'"


@register("feeds_to_unified", with_views("postings_raw", body=f"""
, fed AS (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY native_id) - 1 AS pos, native_id, raw_title, location,
         CASE WHEN source = 'network_b' THEN level_hint END AS level_hint, trim(split_part(company, chr(10), 1)) AS company,
         CASE WHEN source = 'board_a' THEN DATE '{FEED_ANCHOR}' ELSE date END AS date,
         CASE WHEN source = 'ats_c' THEN {sql_html_strip(_FEED_HTML)} ELSE coalesce(description_text, '') END AS description_text
  FROM postings_raw),
tag AS (
  SELECT source || ':' || CAST(CASE WHEN source = 'board_a' THEN pos ELSE native_id END AS VARCHAR) AS posting_id, source, date,
         CAST(year(date) AS INTEGER) AS year, {sql_title('trim(raw_title)')} AS canonical_title, company,
         {sql_geo('location')} AS geo, {sql_seniority('trim(raw_title)', 'level_hint')} AS seniority, description_text
  FROM fed)
SELECT posting_id, source, date, canonical_title, company, seniority, md5(description_text) AS text_md5,
       coalesce(company IS NOT NULL AND date IS NOT NULL AND
         date_diff('day', lag(date) OVER (PARTITION BY company, canonical_title ORDER BY date, posting_id), date) <= 30,
         false) AS is_duplicate
FROM tag WHERE canonical_title IN ({_in(DS_TITLES)}) AND year IN ({_in(fx.VALID_YEARS)}) AND geo = 'US'"""))
def feeds_to_unified(spark, sf):
    """J1 from raw files: an undated CSV (T7, T11), a CSV with epoch milliseconds (T9, hint) and two
    Parquet files with drifting names (S4, T4, T8, T10), each through its adapter, in slices of ascending ids
    that are written and read in turn, then F1, F2, F5, W1."""
    # the digest is all that is asked of a text: taken where the text is read, so that no later step moves texts
    def digested(df, text="description_text"):
        return df.withColumn(text, F.md5(text_or_empty(text).cast("binary")))

    def scoped(df):
        return C.in_scope(df.withColumn("native_id", F.col("native_id").cast("string")), fx.VALID_YEARS)

    def write_undated(own, path):
        IO.write_csv(own.repartitionByRange("native_id").sortWithinPartitions("native_id").select(
            F.col("raw_title").alias("Job Title"), F.col("description_text").alias("Job Description"),
            F.concat("company", F.lit("\n3.9")).alias("Company Name"), F.col("location").alias("Location"),
            F.lit(3.9).alias("Rating")), path, **IO.GZIP)

    def read_undated(path):
        return digested(IO.row_places(IO.read_csv(spark, path, FD.UNDATED_CSV)), "Job Description")

    def write_epoch(own, path):
        IO.write_csv(own.select(
            F.col("native_id").alias("job_id"), F.col("raw_title").alias("title"), F.col("company").alias("company_name"),
            F.col("description_text").alias("description"), "location",
            F.col("level_hint").alias("formatted_experience_level"),
            (F.unix_date("date") * F.lit(86_400_000).cast("long") + 43_200_000).cast("string").alias("listed_time")), path, **IO.GZIP)

    def read_epoch(path):
        return scoped(digested(FD.epoch_csv(IO.read_csv(spark, path, FD.EPOCH_CSV), "network_b")))

    def write_drifting(ats, path):
        html = F.concat(F.lit("<p>"), F.replace(F.replace("description_text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                        F.lit("</p>"))
        iso = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("T12:00:00Z"))
        ats.filter("native_id % 2 = 0").select(
            F.col("native_id").alias("id"), F.col("raw_title").alias("title"), html.alias("description_html"),
            F.col("company").alias("source_slug"), F.array("location").alias("locations"), iso.alias("posted_at")).write.option("compression", "zstd").parquet(f"{path}/one")
        ats.filter("native_id % 2 = 1").select(
            F.col("native_id").alias("external_id"), F.col("raw_title").alias("job_title"), html.alias("content"),
            F.col("company").alias("company_name"), F.col("location"), iso.alias("updated_at")).write.option("compression", "zstd").parquet(f"{path}/two")

    def read_drifting(path):
        u = IO.read_tagged_union(spark, {"one": f"{path}/one", "two": f"{path}/two"})
        return scoped(digested(FD.drifting_parquet(u, "ats_c")))

    with _raw_slices(spark, sf) as slices:
        a, b, c = (IO.through_files(spark, slices(F.col("source") == source), write, read, f"feed_{x}")
                   for x, source, write, read in (("a", "board_a", write_undated, read_undated),
                                                  ("b", "network_b", write_epoch, read_epoch),
                                                  ("c", "ats_c", write_drifting, read_drifting)))
    # ids of the undated feed are places among all its rows
    u = C.flag_duplicates(C.union_sources([scoped(FD.undated_csv(a, "board_a", FEED_ANCHOR)), b, c]))
    return u.select("posting_id", "source", "date", "canonical_title", "company", "seniority",
                    F.col("description_text").alias("text_md5"), "is_duplicate")


# ---- S5 / S6 / S7 ----------------------------------------------------------------------
@register("sink_roundtrip", with_views("unified", body="SELECT posting_id, source, year, is_duplicate FROM unified"))
def sink_roundtrip(spark, sf):
    """Unified table written as parquet partitioned by (source, year), read back."""
    path = IO.scratch_path(spark, "unified")
    IO.write_unified(unified_postings(spark, sf), path)
    return spark.read.parquet(path).select("posting_id", "source", "year", "is_duplicate")


@register("sink_clean", with_views("unified", body="SELECT posting_id, source FROM unified WHERE NOT is_duplicate"))
def sink_clean(spark, sf):
    """Non-duplicate rows only, written and read back."""
    path = IO.scratch_path(spark, "clean")
    IO.write_clean(unified_postings(spark, sf), path)
    return spark.read.parquet(path).select("posting_id", "source")


_SCHEMA_ROWS = [("posting_id", "string"), ("date", "date"), ("quarter", "string"), ("canonical_title", "string"),
                ("raw_title", "string"), ("company", "string"), ("geo", "string"), ("seniority", "string"),
                ("description_text", "string"), ("skills_present", "array<string>"), ("is_duplicate", "boolean"),
                ("source", "string"), ("year", "int")]


@register("verify_schema", with_views("unified", body=f"""
SELECT v.position, v.column_name, v.data_type, true AS matches, (SELECT count(*) FROM unified) AS n_rows
FROM (VALUES {", ".join(f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_SCHEMA_ROWS))}) v(position, column_name, data_type)"""))
def verify_schema(spark, sf):
    """Reload the persisted unified table; one row per column (position, name,
    type, unified-schema match) with the row count."""
    from hirelens.schema import UNIFIED_SCHEMA
    back = final_postings(spark, sf)
    want = {f.name: f.dataType.simpleString() for f in UNIFIED_SCHEMA.fields}
    rows = [(i, f.name, f.dataType.simpleString(), want.get(f.name) == f.dataType.simpleString())
            for i, f in enumerate(back.schema.fields)]
    meta = spark.createDataFrame(rows, "position int, column_name string, data_type string, matches boolean")
    return meta.withColumn("n_rows", back.agg(F.count(F.lit(1))).scalar())


# ---- S14 / J11 / J12 ------------------------------------------------------------------
@register("companion_skills", """
SELECT n.n_name AS skill_name, r.r_name AS category, count(*) AS n_postings
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
GROUP BY n.n_name, r.r_name""")
def companion_skills(spark, sf):
    """Companion job_skills (posting -> skill code) joined to the skill mapping
    (code -> name, coarse category); the mapping is a broadcast dimension."""
    o = fx.table(spark, sf, "orders").select("o_custkey")
    c = fx.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("skill_abr"))
    job_skills = o.join(c, o.o_custkey == c.c_custkey).select("skill_abr")
    n = fx.table(spark, sf, "nation")
    r = fx.table(spark, sf, "region")
    skills = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("skill_abr"), F.col("n_name").alias("skill_name"), F.col("r_name").alias("category"))
    j = job_skills.join(skills, "skill_abr")
    return j.groupBy("skill_name", "category").agg(F.count(F.lit(1)).alias("n_postings"))


def _crosswalk_sql():
    vals = ", ".join(f"('{r}', '{c}')" for r, c in CROSSWALK)
    return f"crosswalk(role, codes) AS (VALUES {vals})"


@register("crosswalk", with_views("clean", body=f"""
, {_crosswalk_sql()}
SELECT c.canonical_title, trim(x.code) AS soc_code, count(*) AS n_postings
FROM clean c LEFT JOIN (SELECT role, unnest(string_split(codes, ',')) AS code FROM crosswalk) x
  ON x.role = c.canonical_title
GROUP BY c.canonical_title, trim(x.code)"""))
def crosswalk(spark, sf):
    """Role -> occupation codes (multi-valued, exploded); roles without a code keep null."""
    cw = spark.createDataFrame(CROSSWALK, "canonical_title string, codes string").select(
        "canonical_title", F.explode(F.split("codes", ",")).alias("soc_code")).withColumn(
        "soc_code", F.trim("soc_code"))
    c = clean_postings(spark, sf).select("canonical_title")
    return c.join(F.broadcast(cw), "canonical_title", "left").groupBy("canonical_title", "soc_code").agg(
        F.count(F.lit(1)).alias("n_postings"))


@register("cross_role_skills", with_views("skills", body=f"""
SELECT skill, count(DISTINCT canonical_title) AS n_roles FROM skills GROUP BY skill
HAVING count(DISTINCT canonical_title) >= {CROSS_ROLE_MIN}"""))
def cross_role_skills(spark, sf):
    """Skills mentioned in postings of at least 4 roles."""
    s = skills_long(spark, sf)
    return (s.groupBy("skill").agg(F.count_distinct("canonical_title").alias("n_roles"))
            .filter(F.col("n_roles") >= CROSS_ROLE_MIN))


# ---- W2 / W3 / J7 / W4 -----------------------------------------------------------------
def _batched(spark, sf, with_text=False):
    # postings are numbered without their texts, which join the numbered rows
    b = B.make_batches(clean_documents(spark, sf), "posting_id", BATCH)
    return with_description(spark, sf, b) if with_text else b.drop("_doc", "_copy")


@register("make_batches", with_views("clean", body=f"""
SELECT posting_id, CAST((row_number() OVER (ORDER BY posting_id) - 1) // {BATCH} AS BIGINT) AS batch FROM clean"""))
def make_batches(spark, sf):
    """Clean postings in id order, consecutive batches of 5 (no single-partition window)."""
    return _batched(spark, sf).select("posting_id", "batch")


@register("batch_payloads", with_views("clean", body=f"""
SELECT batch, count(*) AS n_items,
       '{{' || string_agg(CAST(to_json(posting_id) AS VARCHAR) || ':' || CAST(to_json(description_text) AS VARCHAR), ','
                         ORDER BY posting_id) || '}}' AS payload
FROM (SELECT posting_id, description_text, CAST((row_number() OVER (ORDER BY posting_id) - 1) // {BATCH} AS BIGINT) AS batch
      FROM clean) GROUP BY batch"""))
def batch_payloads(spark, sf):
    """Per batch one JSON object posting_id -> description text."""
    return B.batch_payloads(_batched(spark, sf, with_text=True), "posting_id", "description_text")


@register("pending_batches", with_views("clean", "extractions", body=f"""
SELECT batch, count(*) AS n_ids, count(*) FILTER (WHERE done) AS n_done FROM (
  SELECT (row_number() OVER (ORDER BY posting_id) - 1) // {BATCH} AS batch,
         EXISTS (SELECT 1 FROM extractions e WHERE e.posting_id = c.posting_id) AS done FROM clean c)
GROUP BY batch HAVING count(*) FILTER (WHERE done) < count(*)"""))
def pending_batches(spark, sf):
    """Batches with at least one posting not yet extracted."""
    done = fx.extractions(spark, sf).select("posting_id")
    return B.pending_batches(_batched(spark, sf), done, "posting_id").select(
        F.col("batch").cast("long").alias("batch"), "n_ids", "n_done")


@register("spot_check", with_views("unified", body="""
SELECT posting_id, source, company, canonical_title, date FROM unified WHERE is_duplicate
ORDER BY md5('42:' || posting_id), posting_id LIMIT 20"""))
def spot_check(spark, sf, n: int = 20, seed: int = 42):
    """Seeded sample of flagged duplicates for manual review."""
    u = final_postings(spark, sf, with_text=False).filter(F.col("is_duplicate"))
    return B.seeded_sample(u, "posting_id", n, seed).select("posting_id", "source", "company", "canonical_title",
                                                            "date")


@register("spot_check_skills", with_views("clean", "mapped", body="""
, k AS (SELECT posting_id, list(skill ORDER BY first_pos, skill) AS l FROM mapped GROUP BY posting_id)
SELECT c.posting_id, c.canonical_title, replace(substr(c.description_text, 1, 120), chr(10), ' ') AS snippet,
       CAST(len(k.l) AS INTEGER) AS n_skills, array_to_string(k.l[1:10], '|') AS first_skills
FROM clean c JOIN k ON k.posting_id = c.posting_id
ORDER BY md5('42:' || c.posting_id), c.posting_id LIMIT 5"""))
def spot_check_skills(spark, sf, n: int = 5, seed: int = 42):
    """Seeded sample of extracted postings: 120-char snippet and first 10 skills."""
    c = clean_postings(spark, sf, with_text=True).filter(F.size("skills_present") > 0)
    s = B.seeded_sample(c, "posting_id", n, seed)
    snippet = F.regexp_replace(F.substring("description_text", 1, 120), "\n", " ")
    return s.select("posting_id", "canonical_title", snippet.alias("snippet"),
                    F.size("skills_present").alias("n_skills"),
                    F.array_join(F.slice("skills_present", 1, 10), "|").alias("first_skills"))


# ---- P1 / P2 / P3 ----------------------------------------------------------------------
def _json_responses(spark, sf):
    b = _batched(spark, sf).select("posting_id", "batch")
    e = fx.extractions(spark, sf).join(b, "posting_id")
    per = e.groupBy("batch", "posting_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]).alias("terms"))
    obj = per.groupBy("batch").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("posting_id", "terms"))))
                                   .alias("j"))
    kind = F.col("batch") % 4
    text = (F.when(kind == 0, F.concat(F.lit("```json\n"), "j", F.lit("\n```")))
            .when(kind == 1, F.concat(F.lit("Here are the skills: "), "j", F.lit(" Let me know.")))
            .when(kind == 2, F.col("j"))
            .otherwise(F.lit("[1, 2, 3]")))
    return obj.select(F.col("batch").alias("response_id"), text.alias("text"))


@register("parse_json_responses", with_views("clean", "extractions", body=f"""
SELECT b.batch AS response_id, e.posting_id AS key, e.pos, e.term
FROM extractions e JOIN (SELECT posting_id, CAST((row_number() OVER (ORDER BY posting_id) - 1) // {BATCH} AS BIGINT)
                                AS batch FROM clean) b ON b.posting_id = e.posting_id
WHERE b.batch % 4 <> 3"""))
def parse_json_responses(spark, sf):
    """Per-batch JSON responses (fenced / wrapped in prose / bare / not an object) parsed back."""
    return P.parse_json_responses(_json_responses(spark, sf))


def _dict_batches(spark, sf):
    d = fx.dictionary(spark, sf)
    return d.withColumn("batch", F.floor((F.col("seq") - 1) / DICT_BATCH).cast("long"))


@register("parse_yaml_responses", with_views("dictionary", body=f"""
SELECT CAST((seq - 1) // {DICT_BATCH} AS BIGINT) AS response_id, canonical AS key, alias AS item FROM dictionary"""))
def parse_yaml_responses(spark, sf):
    """Per-batch YAML responses (``canonical:`` + ``- alias`` lines, a scalar note
    key that must be dropped, fences on every other response) parsed back."""
    d = _dict_batches(spark, sf)
    per = d.groupBy("batch", "canonical").agg(
        F.concat(F.col("canonical"), F.lit(":\n"), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("seq", "alias"))), lambda x: F.concat(F.lit("  - "), x["alias"])),
            "\n")).alias("block"))
    doc = per.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list("block")), "\n").alias("body"))
    body = F.concat(F.col("body"), F.lit("\nnote: reviewed"))
    text = F.when(F.col("batch") % 2 == 0, F.concat(F.lit("```yaml\n"), body, F.lit("\n```"))).otherwise(body)
    return P.parse_yaml_responses(doc.select(F.col("batch").alias("response_id"), text.alias("text")))


@register("parse_csv_responses", with_views("categories", body=f"""
SELECT CAST((row_number() OVER (ORDER BY canonical_name) - 1) // {DICT_BATCH} AS BIGINT) AS response_id,
       canonical_name, category, platform_family FROM categories"""))
def parse_csv_responses(spark, sf):
    """Per-batch CSV responses (quoted names, 2-column rows padded, 1-column junk dropped)."""
    c = B.global_positions(fx.categories(spark, sf), "canonical_name", "_pos").withColumn(
        "batch", F.floor(F.col("_pos") / DICT_BATCH).cast("long"))
    line = F.when(F.col("platform_family") == "", F.concat_ws(",", "canonical_name", "category")).otherwise(
        F.concat(F.lit('"'), F.col("canonical_name"), F.lit('",'), F.col("category"), F.lit(","),
                 F.col("platform_family")))
    doc = c.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    text = F.concat(F.col("body"), F.lit("\noops"))
    return P.parse_csv_responses(doc.select(F.col("batch").alias("response_id"), text.alias("text")))


# ---- S12 / T11 ---------------------------------------------------------------------------
@register("analysis_tables", with_views("clean", body="""
SELECT snapshot, canonical_title, count(*) AS n FROM clean GROUP BY snapshot, canonical_title"""))
def analysis_tables(spark, sf):
    """An analysis result written as a header CSV table and read back typed."""
    c = clean_postings(spark, sf)
    t = c.groupBy("snapshot", "canonical_title").agg(F.count(F.lit(1)).alias("n"))
    path = IO.write_analysis_table(t, IO.scratch_path(spark, "outputs"), "role_counts")
    return IO.read_csv(spark, path, "snapshot int, canonical_title string, n long")


@register("anchor_dates", with_views("postings_raw", body="""
SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, DATE '2020-01-01' AS date, 2020 AS year,
       '2020Q1' AS quarter FROM postings_raw WHERE source = 'board_a'"""))
def anchor_dates(spark, sf):
    """T11 + T5/T6: a source without dates gets the period-anchor date, then year and quarter."""
    from hirelens.schema import finalise
    raw = fx.postings_raw(spark, sf, with_text=False).filter(F.col("source") == "board_a")
    t = raw.select(F.concat("source", F.lit(":"), F.col("native_id").cast("string")).alias("posting_id"),
                   dates.anchor_date("2020-01-01").alias("date"))
    return finalise(t, "board_a").select("posting_id", "date", "year", "quarter")


# ---- P2 / P3 over responses that grow with the tables ------------------------------------------
@register("parse_yaml_extractions", with_views("clean", "extractions", body=f"""
SELECT b.batch AS response_id, e.posting_id AS key, e.term AS item
FROM extractions e JOIN (SELECT posting_id, CAST((row_number() OVER (ORDER BY posting_id) - 1) // {BATCH} AS BIGINT)
                                AS batch FROM clean) b ON b.posting_id = e.posting_id"""))
def parse_yaml_extractions(spark, sf):
    """One YAML response per batch of postings (quoted keys and terms with escapes, comments, a
    scalar note, fences on every other response) parsed back."""
    e = fx.extractions(spark, sf).join(_batched(spark, sf).select("posting_id", "batch"), "posting_id")
    item = F.concat(F.lit("  - "), IO.yaml_string("term"), F.lit(" # seen"))
    per = e.groupBy("batch", "posting_id").agg(F.concat(
        IO.yaml_string("posting_id"), F.lit(":\n"), F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("pos", item.alias("i")))), lambda x: x["i"]), "\n")).alias("block"))
    doc = per.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list("block")), "\n").alias("body"))
    body = F.concat(F.lit("# terms by posting\n"), F.col("body"), F.lit("\nnote: reviewed"))
    text = F.when(F.col("batch") % 2 == 0, F.concat(F.lit("```yaml\n"), body, F.lit("\n```"))).otherwise(body)
    return P.parse_yaml_responses(doc.select(F.col("batch").alias("response_id"), text.alias("text")))


@register("parse_csv_postings", with_views("clean", body=f"""
SELECT CAST((row_number() OVER (ORDER BY posting_id) - 1) // {BATCH} AS BIGINT) AS response_id, posting_id AS canonical_name,
       canonical_title || chr(10) || '"' || source || '"' AS category, coalesce(company, '') AS platform_family FROM clean"""))
def parse_csv_postings(spark, sf):
    """One CSV response per batch of postings, with line feeds and quotes inside quoted fields, parsed back."""
    b = _batched(spark, sf).select("posting_id", "batch", "canonical_title", "source", "company")
    line = F.concat(F.lit('"'), "posting_id", F.lit('","'), "canonical_title", F.lit('\n""'), "source", F.lit('""","'),
                    F.replace(F.coalesce("company", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    doc = b.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    return P.parse_csv_responses(doc.select(F.col("batch").alias("response_id"), F.concat("body", F.lit("\noops")).alias("text")))
