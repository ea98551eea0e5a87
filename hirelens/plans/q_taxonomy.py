"""Registered queries: dictionary, mapping, coverage, vocabulary and categories."""
from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.operators import clean as C
from hirelens.operators import batching as B
from hirelens.operators import taxonomy as TX
from hirelens.plans.base import clean_postings, clean_with_counts, lookup, mapped, r6, unified_postings
from hirelens.plans.registry import register, with_views
from hirelens.sources import fixtures as fx
from hirelens.sources import io as IO

# Expected-minimum shares of the reference's sanity checks (A12),
# followed by fixture checks on terms that exist in the test tables.
SANITY_CHECKS = [
    ("python", 0.80), ("sql", 0.60), ("machine learning", 0.40), ("llm", 0.00),
    ("red ring", 0.01), ("hot gizmo", 0.05), ("cold bolt", 0.50),
]


def _checks_sql():
    return "checks(term, threshold) AS (VALUES " + ", ".join(f"('{t}', {v})" for t, v in SANITY_CHECKS) + ")"


@register("reverse_lookup", with_views("reverse_lookup", body="SELECT alias_lower, canonical FROM reverse_lookup"))
def reverse_lookup(spark, sf):
    """lower(alias) -> canonical, last in file order wins."""
    return lookup(spark, sf)


@register("alias_conflicts", with_views("dictionary", body="""
SELECT lower(alias) AS alias_lower, count(DISTINCT canonical) AS n_canonicals,
       array_to_string(list_sort(list(DISTINCT canonical)), '|') AS canonicals
FROM dictionary GROUP BY lower(alias) HAVING count(DISTINCT canonical) > 1"""))
def alias_conflicts(spark, sf):
    """C4: aliases hidden by last-wins (two or more canonicals)."""
    return TX.alias_conflicts(fx.dictionary(spark, sf))


@register("map_skills", with_views("mapped", body="""
SELECT posting_id, string_agg(skill, '|' ORDER BY first_pos) AS skills, count(*) AS n_skills
FROM mapped GROUP BY posting_id"""))
def map_skills(spark, sf):
    """Canonical skills per extracted posting, first-occurrence order, distinct."""
    m = TX.map_skills(fx.extractions(spark, sf), lookup(spark, sf))
    return m.select("posting_id", F.array_join("skills_present", "|").alias("skills"),
                    F.size("skills_present").cast("long").alias("n_skills"))


@register("attach_skills", with_views("unified", "mapped", body="""
SELECT u.posting_id, coalesce(s.skills, '') AS skills, coalesce(s.n_skills, 0) AS n_skills
FROM unified u LEFT JOIN (SELECT posting_id, string_agg(skill, '|' ORDER BY first_pos) AS skills,
                                 count(*) AS n_skills FROM mapped GROUP BY posting_id) s
  ON u.posting_id = s.posting_id"""))
def attach_skills(spark, sf):
    """Every unified posting keeps its row; none -> []."""
    u = unified_postings(spark, sf)
    m = TX.map_skills(fx.extractions(spark, sf), lookup(spark, sf))
    a = TX.attach_skills(u, m)
    return a.select("posting_id", F.array_join("skills_present", "|").alias("skills"),
                    F.size("skills_present").cast("long").alias("n_skills"))


@register("unmapped_terms", with_views("extractions", "reverse_lookup", body="""
SELECT term, count(*) AS n FROM extractions e
WHERE NOT EXISTS (SELECT 1 FROM reverse_lookup r WHERE r.alias_lower = lower(e.term))
GROUP BY term ORDER BY n DESC, term LIMIT 20"""))
def unmapped_terms(spark, sf, top: int = 20):
    """Top unmapped raw spellings (lower() not in the lookup)."""
    e = fx.extractions(spark, sf)
    um = e.join(lookup(spark, sf), F.lower(e.term) == F.col("alias_lower"), "left_anti")
    return um.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(top)


@register("unmapped_stats", with_views("extractions", "reverse_lookup", body="""
SELECT count(DISTINCT term) AS n_unique, count(*) AS n_total FROM extractions e
WHERE NOT EXISTS (SELECT 1 FROM reverse_lookup r WHERE r.alias_lower = lower(e.term))"""))
def unmapped_stats(spark, sf):
    """Unique and total unmapped term occurrences."""
    e = fx.extractions(spark, sf)
    um = e.join(lookup(spark, sf), F.lower(e.term) == F.col("alias_lower"), "left_anti")
    per = um.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.count(F.lit(1)).alias("n_unique"), F.sum("n").cast("long").alias("n_total"))


@register("vocab", with_views("extractions", body="""
SELECT term, count(*) AS n FROM extractions GROUP BY term HAVING count(*) >= 2"""))
def vocab(spark, sf, min_count: int = 2):
    """Case-sensitive vocabulary with min count."""
    return TX.vocabulary(fx.extractions(spark, sf), min_count)


@register("vocab_stats", with_views("extractions", body="""
SELECT metric, CAST(value AS DOUBLE) AS value FROM (
SELECT 'postings' AS metric, CAST(count(DISTINCT posting_id) AS BIGINT) AS value FROM extractions
UNION ALL SELECT 'empty_postings', CAST(count(DISTINCT posting_id) FILTER (WHERE term IS NULL) AS BIGINT) FROM extractions
UNION ALL SELECT 'occurrences', CAST(count(term) AS BIGINT) FROM extractions
UNION ALL SELECT 'unique_terms', CAST(count(DISTINCT term) AS BIGINT) FROM extractions
UNION ALL SELECT 'unique_terms_min2', CAST(count(*) AS BIGINT) FROM (SELECT term FROM extractions
  WHERE term IS NOT NULL GROUP BY term HAVING count(*) >= 2))
UNION ALL SELECT 'empty_pct', round(100.0 * count(DISTINCT posting_id) FILTER (WHERE term IS NULL) / count(DISTINCT posting_id), 6)
FROM extractions"""))
def vocab_stats(spark, sf, min_count: int = 2):
    """A10: posting-level and vocabulary-level statistics as (metric, value) rows
    (two aggregates unioned; no cross join)."""
    e = fx.extractions(spark, sf)
    per_posting = e.groupBy("posting_id").agg(F.count("term").alias("k"))
    p = per_posting.agg(F.count(F.lit(1)).alias("postings"), F.count_if(F.col("k") == 0).alias("empty_postings"),
                        F.sum("k").alias("occurrences"))
    v = e.filter(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    vs = v.agg(F.count(F.lit(1)).alias("unique_terms"), F.count_if(F.col("n") >= min_count).alias("unique_terms_min2"))
    p = p.select(*[F.col(c).cast("double").alias(c) for c in ("postings", "empty_postings", "occurrences")]).withColumn(
        "empty_pct", r6(100.0 * F.col("empty_postings") / F.col("postings")))
    a = p.unpivot([], p.columns, "metric", "value")
    vs = vs.select(*[F.col(c).cast("double").alias(c) for c in vs.columns])
    return a.unionByName(vs.unpivot([], vs.columns, "metric", "value"))


@register("top_terms", with_views("extractions", body="""
SELECT term, count(*) AS n, round(count(*) / (SELECT count(DISTINCT posting_id) FROM extractions), 6) AS share
FROM extractions GROUP BY term ORDER BY n DESC, term LIMIT 20"""))
def top_terms(spark, sf, top: int = 20):
    """Top-N terms with count and share of postings (total via scalar subquery)."""
    e = fx.extractions(spark, sf)
    total = e.agg(F.count_distinct("posting_id")).scalar()
    t = e.groupBy("term").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "term").limit(top)
    return t.withColumn("share", r6(F.col("n") / total))


@register("sanity_checks", with_views("extractions", body=f"""
, {_checks_sql()}
SELECT c.term, c.threshold, round(coalesce(f.n, 0) / (SELECT count(DISTINCT posting_id) FROM extractions), 6) AS share,
       CASE WHEN coalesce(f.n, 0) / (SELECT count(DISTINCT posting_id) FROM extractions) >= c.threshold
            THEN 'OK' ELSE 'LOW' END AS status
FROM checks c LEFT JOIN (SELECT lower(term) AS term, count(*) AS n FROM extractions GROUP BY lower(term)) f
  ON f.term = c.term"""))
def sanity_checks(spark, sf, checks=tuple(SANITY_CHECKS)):
    """Case-folded term share vs expected minimum -> OK / LOW."""
    e = fx.extractions(spark, sf)
    total = e.agg(F.count_distinct("posting_id")).scalar()
    folded = e.groupBy(F.lower("term").alias("term")).agg(F.count(F.lit(1)).alias("n"))
    c = spark.createDataFrame(list(checks), "term string, threshold double")
    j = c.join(folded, "term", "left")
    share = F.coalesce(F.col("n"), F.lit(0)) / total
    return j.select("term", "threshold", r6(share).alias("share"),
                    F.when(share >= F.col("threshold"), "OK").otherwise("LOW").alias("status"))


@register("coverage_missing", with_views("clean", "extractions", body="""
SELECT posting_id, source FROM clean c
WHERE NOT EXISTS (SELECT 1 FROM extractions e WHERE e.posting_id = c.posting_id)"""))
def coverage_missing(spark, sf):
    """Expected clean postings minus extracted ids (left anti join)."""
    c = clean_postings(spark, sf).select("posting_id", "source")
    e = fx.extractions(spark, sf).select("posting_id")
    return c.join(e, "posting_id", "left_anti")


@register("coverage_by_source", with_views("clean", "extractions", body="""
SELECT source, count(*) FILTER (WHERE covered) AS covered, count(*) AS expected,
       round(100.0 * count(*) FILTER (WHERE covered) / count(*), 6) AS pct
FROM (SELECT c.source, EXISTS (SELECT 1 FROM extractions e WHERE e.posting_id = c.posting_id) AS covered FROM clean c)
GROUP BY source"""))
def coverage_by_source(spark, sf):
    """Covered / expected per source (left semi flag via left join on distinct ids)."""
    c = clean_postings(spark, sf).select("posting_id", "source")
    done = fx.extractions(spark, sf).select("posting_id").distinct().withColumn("_done", F.lit(True))
    j = c.join(done, "posting_id", "left")
    cov = F.coalesce(F.col("_done"), F.lit(False))
    return j.groupBy("source").agg(F.count_if(cov).alias("covered"), F.count(F.lit(1)).alias("expected"),
                                   r6(100.0 * F.count_if(cov) / F.count(F.lit(1))).alias("pct"))


@register("skills_by_source", with_views("clean", "extractions", body="""
SELECT coalesce(c.source, 'unknown') AS source, count(*) AS postings,
       quantile_cont(k.n, 0.5) AS median_terms, round(avg(k.n), 6) AS mean_terms
FROM (SELECT posting_id, count(term) AS n FROM extractions GROUP BY posting_id) k
LEFT JOIN clean c ON c.posting_id = k.posting_id
GROUP BY coalesce(c.source, 'unknown')"""))
def skills_by_source(spark, sf):
    """J9 + A14: raw terms per extracted posting by source; ids not in the clean
    table -> ``unknown``; exact median (value-count map, bounded by distinct counts)."""
    k = fx.extractions(spark, sf).groupBy("posting_id").agg(F.count("term").alias("n"))
    c = clean_postings(spark, sf).select("posting_id", "source")
    j = k.join(c, "posting_id", "left").withColumn("source", F.coalesce("source", F.lit("unknown")))
    return j.groupBy("source").agg(F.count(F.lit(1)).alias("postings"),
                                   F.median("n").alias("median_terms"), r6(F.avg("n")).alias("mean_terms"))


@register("skills_per_posting", with_views("clean_n", body="""
SELECT count(*) AS postings, quantile_cont(n_skills, 0.5) AS median_skills, round(avg(n_skills), 6) AS mean_skills,
       min(n_skills) AS min_skills, max(n_skills) AS max_skills, count(*) FILTER (WHERE n_skills = 0) AS zero_skill,
       round(100.0 * count(*) FILTER (WHERE n_skills = 0) / count(*), 6) AS zero_pct
FROM clean_n"""))
def skills_per_posting(spark, sf):
    """A13 + A17 + T17: distribution of mapped skills per clean posting."""
    c = clean_with_counts(spark, sf)
    n = F.col("n_skills")
    return c.agg(F.count(F.lit(1)).alias("postings"), F.median(n).alias("median_skills"),
                 r6(F.avg(n)).alias("mean_skills"), F.min(n).alias("min_skills"), F.max(n).alias("max_skills"),
                 F.count_if(n == 0).alias("zero_skill"),
                 r6(100.0 * F.count_if(n == 0) / F.count(F.lit(1))).alias("zero_pct"))


@register("zero_skill_reasons", with_views("clean_n", "extractions", body="""
SELECT reason, count(*) AS n FROM (
  SELECT CASE WHEN NOT EXISTS (SELECT 1 FROM extractions e WHERE e.posting_id = c.posting_id) THEN 'never_extracted'
              WHEN NOT EXISTS (SELECT 1 FROM extractions e WHERE e.posting_id = c.posting_id AND e.term IS NOT NULL)
                   THEN 'extracted_none'
              ELSE 'all_unmapped' END AS reason
  FROM clean_n c WHERE n_skills = 0) GROUP BY reason"""))
def zero_skill_reasons(spark, sf):
    """Zero-skill clean postings split by cause (never extracted / extracted
    nothing / extracted but all unmapped)."""
    c = clean_with_counts(spark, sf).filter(F.col("n_skills") == 0).select("posting_id")
    k = fx.extractions(spark, sf).groupBy("posting_id").agg(F.count("term").alias("_terms"))
    j = c.join(k, "posting_id", "left")
    reason = (F.when(F.col("_terms").isNull(), "never_extracted").when(F.col("_terms") == 0, "extracted_none")
              .otherwise("all_unmapped"))
    return j.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _runs(spark, sf):
    # two extraction runs: lines 1-3 in the first, later lines re-extracted in the second
    e = fx.extractions(spark, sf)
    return e.withColumn("run", F.when(F.col("pos") <= 3, 1).otherwise(2))


@register("upsert_latest", with_views("extractions", body="""
SELECT posting_id, max(run) AS run, count(*) AS n_terms FROM (
  SELECT e.*, CASE WHEN pos <= 3 THEN 1 ELSE 2 END AS run,
         max(CASE WHEN pos <= 3 THEN 1 ELSE 2 END) OVER (PARTITION BY posting_id) AS last_run
  FROM extractions e) WHERE run = last_run GROUP BY posting_id"""))
def upsert_latest(spark, sf):
    """A later run's result replaces the earlier one for the same posting id."""
    per_run = _runs(spark, sf).groupBy("posting_id", "run").agg(F.count(F.lit(1)).alias("n_terms"))
    return TX.upsert_latest(per_run, "posting_id", "run").select("posting_id", "run", "n_terms")


@register("merge_synonyms", with_views("dictionary", body="""
SELECT canonical, array_to_string(list_sort(list(DISTINCT alias)), '|') AS synonyms,
       count(DISTINCT alias) AS n_synonyms FROM dictionary GROUP BY canonical"""))
def merge_synonyms(spark, sf):
    """Union of synonym sets for equal canonicals across normalisation batches."""
    d = fx.dictionary(spark, sf).withColumn("batch", F.floor((F.col("seq") - 1) / 10))
    m = TX.merge_synonyms(d.select("batch", "canonical", "alias"))
    return m.select("canonical", F.array_join("synonyms", "|").alias("synonyms"),
                    F.size("synonyms").cast("long").alias("n_synonyms"))


_FALLBACK_CASE = "CASE category " + " ".join(
    f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in TX.FALLBACK_SUBCATEGORY.items()) + \
    " ELSE 'Other ' || (SELECT string_agg(upper(left(w, 1)) || lower(substr(w, 2)), ' ') " \
    "FROM unnest(string_split(category, '_')) t(w)) END"


def _slots_file(spark, sf) -> str:
    """The slot table written as a CSV file in file order."""
    path = IO.scratch_path(spark, "slots_csv")
    IO.write_csv(fx.named_slots(spark, sf).orderBy("seq", "slot", "category", "pattern").select("category", "slot", "pattern"), path)
    return path


@register("subcategory", with_views("categories", "named_slots", body=f"""
SELECT c.canonical_name, c.category, c.platform_family, coalesce(s.slot, {_FALLBACK_CASE.replace('category', 'c.category')}) AS subcategory
FROM categories c LEFT JOIN named_slots s ON s.category = c.category AND s.pattern = lower(trim(c.canonical_name))"""))
def subcategory(spark, sf):
    """Named slot or category fallback."""
    return TX.subcategory(fx.categories(spark, sf), IO.read_slots(spark, _slots_file(spark, sf)))


@register("category_join", with_views("skills", "categories", body="""
SELECT s.posting_id, s.skill, coalesce(c.category, 'unclassified') AS category
FROM skills s LEFT JOIN categories c ON c.canonical_name = s.skill"""))
def category_join(spark, sf):
    """Category per mapped skill of a clean posting; missing -> unclassified."""
    from hirelens.plans.base import skills_long
    s = skills_long(spark, sf).select("posting_id", "skill")
    return TX.category_join(s, fx.categories(spark, sf)).select("posting_id", "skill", "category")


@register("category_distribution", with_views("dictionary", "categories", "named_slots", body=f"""
, allc AS (
  SELECT d.canonical_name, coalesce(c.category, 'unclassified') AS category,
         coalesce(s.slot, {_FALLBACK_CASE.replace('category', "coalesce(c.category, 'unclassified')")}) AS subcategory
  FROM (SELECT DISTINCT canonical AS canonical_name FROM dictionary) d
  LEFT JOIN categories c ON c.canonical_name = d.canonical_name
  LEFT JOIN named_slots s ON s.category = c.category AND s.pattern = lower(trim(d.canonical_name)))
SELECT 'category' AS level, category AS name, count(*) AS n FROM allc GROUP BY category
UNION ALL
SELECT 'subcategory', subcategory, count(*) FROM allc
WHERE NOT starts_with(subcategory, 'Other ') AND subcategory <> 'Unclassified' GROUP BY subcategory""".replace(
    "\n, allc", "allc", 0)))
def category_distribution(spark, sf):
    """Canonicals per category (backfilled unclassified) and per named subcategory."""
    canon = fx.dictionary(spark, sf).select(F.col("canonical").alias("canonical_name")).distinct()
    cats = fx.categories(spark, sf)
    full = canon.join(cats, "canonical_name", "left").withColumn(
        "category", F.coalesce("category", F.lit(TX.UNCLASSIFIED)))
    sub = TX.subcategory(full, IO.read_slots(spark, _slots_file(spark, sf)))
    a = sub.groupBy(F.lit("category").alias("level"), F.col("category").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    named = sub.filter(~F.col("subcategory").startswith("Other ") & (F.col("subcategory") != "Unclassified"))
    b = named.groupBy(F.lit("subcategory").alias("level"), F.col("subcategory").alias("name")).agg(
        F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@register("platform_family_counts", with_views("categories", body="""
SELECT nullif(trim(platform_family), '') AS platform_family, count(*) AS n FROM categories
WHERE nullif(trim(platform_family), '') IS NOT NULL GROUP BY 1"""))
def platform_family_counts(spark, sf):
    """Canonicals per vendor suite (empty family ignored)."""
    c = fx.categories(spark, sf)
    pf = F.nullif(F.trim("platform_family"), F.lit(""))
    return c.filter(pf.isNotNull()).groupBy(pf.alias("platform_family")).agg(F.count(F.lit(1)).alias("n"))


JSON_BATCH = 100   # postings per JSON object (S8)

# ---- sources / sinks round trips -------------------------------------------------
@register("src_extractions", with_views("extractions", body="SELECT posting_id, pos, term FROM extractions"))
def src_extractions(spark, sf):
    """Write the extractions as JSON objects per batch of postings, read back long."""
    e = fx.extractions(spark, sf)
    e = e.join(B.make_batches(e.select("posting_id").distinct(), "posting_id", JSON_BATCH), "posting_id")
    path = IO.scratch_path(spark, "extractions_json")
    IO.write_extractions_json(e, path)
    return IO.read_extractions_json(spark, path)


@register("src_dictionary", with_views("dictionary", body="""
SELECT canonical, alias, CAST(row_number() OVER (ORDER BY lower(canonical), canonical, seq) AS BIGINT) AS seq
FROM dictionary"""))
def src_dictionary(spark, sf):
    """S9 + S10: dictionary -> sorted YAML text -> read back with the running key; seq = file order."""
    path = IO.scratch_path(spark, "dictionary_yaml")
    IO.write_dictionary_yaml(fx.dictionary(spark, sf), path)
    return IO.read_dictionary_yaml(spark, path)


@register("dictionary_sorted", with_views("reverse_lookup", "dictionary", body="""
SELECT canonical, alias FROM dictionary ORDER BY lower(canonical), canonical, alias"""))
def dictionary_sorted(spark, sf):
    """Dictionary rows in case-insensitive canonical order."""
    d = fx.dictionary(spark, sf)
    return d.select("canonical", "alias").orderBy(F.lower("canonical"), "canonical", "alias")


@register("categories_sorted", with_views("categories", "named_slots", body=f"""
SELECT c.canonical_name, c.category, coalesce(s.slot, {_FALLBACK_CASE.replace('category', 'c.category')}) AS subcategory,
       c.platform_family
FROM categories c LEFT JOIN named_slots s ON s.category = c.category AND s.pattern = lower(trim(c.canonical_name))"""))
def categories_sorted(spark, sf):
    """4-column category CSV written sorted by lower(name), read back."""
    sub = TX.subcategory(fx.categories(spark, sf), IO.read_slots(spark, _slots_file(spark, sf)))
    out = sub.select("canonical_name", "category", "subcategory", "platform_family").orderBy(
        F.lower("canonical_name"), "canonical_name")
    path = IO.scratch_path(spark, "categories_csv")
    IO.write_csv(out, path)
    back = IO.read_csv(spark, path, IO.CATEGORY_SCHEMA)
    return back.withColumn("platform_family", F.coalesce("platform_family", F.lit("")))


@register("src_taxonomy", with_views("dictionary", "categories", body="""
SELECT d.canonical AS canonical_name, d.alias, coalesce(c.category, 'unclassified') AS category, 1995 AS introduced
FROM dictionary d LEFT JOIN categories c ON c.canonical_name = d.canonical"""))
def src_taxonomy(spark, sf):
    """Flat taxonomy CSV (pipe-separated aliases) -> one row per alias."""
    d = fx.dictionary(spark, sf)
    cats = fx.categories(spark, sf).select(F.col("canonical_name").alias("canonical"), "category")
    flat = d.groupBy("canonical").agg(F.array_join(F.array_sort(F.collect_list("alias")), "|").alias("aliases"))
    flat = flat.join(cats, "canonical", "left").select(
        F.col("canonical").alias("canonical_name"), "aliases",
        F.coalesce("category", F.lit(TX.UNCLASSIFIED)).alias("category"), F.lit(1995).alias("introduced"))
    path = IO.scratch_path(spark, "taxonomy_csv")
    IO.write_csv(flat, path)
    return IO.read_taxonomy(spark, path)
