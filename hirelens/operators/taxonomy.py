"""Dictionary lookup and skill mapping.

The dictionary and category tables are small dimensions; whether one is broadcast is
left to Spark, which compares its measured bytes with spark.sql.autoBroadcastJoinThreshold.
Fact-side work (extractions, postings) is always a distributed join/aggregate.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fallback subcategory per category (everything outside a named slot).
FALLBACK_SUBCATEGORY = {
    "language": "Other Languages",
    "ml_framework": "Other ML Frameworks",
    "genai": "Other GenAI",
    "data_engineering": "Other Data Engineering",
    "data_platform": "Other Data Platforms",
    "cloud_infra": "Other Cloud",
    "analytics_bi": "Other BI & Analytics",
    "statistical_method": "Other Statistical Methods",
    "mlops": "Other MLOps",
    "role_adjacent": "Other Role Adjacent",
    "unclassified": "Unclassified",
}
UNCLASSIFIED = "unclassified"


def reverse_lookup(dictionary: DataFrame) -> DataFrame:
    """lower(alias) -> canonical, last in file order (max seq) wins; empty aliases skipped."""
    d = dictionary.filter(F.col("alias").isNotNull())
    return (d.groupBy(F.lower("alias").alias("alias_lower"))
            .agg(F.max_by("canonical", "seq").alias("canonical")))


def alias_conflicts(dictionary: DataFrame) -> DataFrame:
    """C4: lower-cased aliases that point to two or more canonicals."""
    return (dictionary.groupBy(F.lower("alias").alias("alias_lower"))
            .agg(F.count_distinct("canonical").alias("n_canonicals"),
                 F.array_join(F.array_sort(F.collect_set("canonical")), "|").alias("canonicals"))
            .filter(F.col("n_canonicals") > 1))


def mapped_long(extr: DataFrame, lookup: DataFrame) -> DataFrame:
    """Long mapped skills ``(posting_id, skill, first_pos)``: unmapped terms dropped,
    one row per (posting, canonical) at its first position."""
    j = extr.join(lookup, F.lower(extr.term) == F.col("alias_lower"))
    return j.groupBy("posting_id", F.col("canonical").alias("skill")).agg(F.min("pos").alias("first_pos"))


def map_skills(extr: DataFrame, lookup: DataFrame) -> DataFrame:
    """Per posting, canonical skills in first-occurrence order, distinct.

    One shuffle on posting_id: collect the (pos, canonical) pairs of a posting,
    sort by position, keep the first occurrence of each canonical.
    """
    j = extr.join(lookup, F.lower(extr.term) == F.col("alias_lower"))
    agg = j.groupBy("posting_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", "canonical"))).alias("_pairs"))
    return agg.select("posting_id",
                      F.array_distinct(F.transform("_pairs", lambda x: x["canonical"])).alias("skills_present"))


def attach_skills(postings: DataFrame, skills: DataFrame) -> DataFrame:
    """Every posting keeps its row; postings without skills get []."""
    p = postings.drop("skills_present") if "skills_present" in postings.columns else postings
    out = p.join(skills, "posting_id", "left")
    empty = F.array().cast(T.ArrayType(T.StringType(), False))
    cols = [F.coalesce(F.col("skills_present"), empty).alias("skills_present") if c == "skills_present"
            else F.col(c) for c in (postings.columns if "skills_present" in postings.columns
                                    else p.columns + ["skills_present"])]
    return out.select(*cols)


def subcategory(categories: DataFrame, slots: DataFrame) -> DataFrame:
    """Named slot when lower(trim(name)) is one of its category's patterns,
    else the category's fallback (``Other <Title Case>`` for unknown categories). ``slots``:
    ([seq], category, slot, pattern); of slots with one pattern the first by seq (then name) counts."""
    c = categories.withColumn("_key", F.lower(F.trim("canonical_name")))
    order = [c for c in ("seq", "slot") if c in slots.columns]
    s = slots.groupBy(F.col("category").alias("_scat"), F.col("pattern").alias("_key")).agg(
        F.min(F.struct(*order))["slot"].alias("slot"))
    j = c.join(s, (c.category == F.col("_scat")) & (c._key == s._key), "left")
    fb_map = F.create_map(*[F.lit(x) for kv in FALLBACK_SUBCATEGORY.items() for x in kv])
    generic = F.concat(F.lit("Other "), F.initcap(F.replace(F.col("category"), F.lit("_"), F.lit(" "))))
    fallback = F.coalesce(F.element_at(fb_map, F.col("category")), generic)
    return j.select(*[categories[c] for c in categories.columns],
                    F.coalesce(F.col("slot"), fallback).alias("subcategory"))


def category_join(skills_long: DataFrame, categories: DataFrame, skill_col: str = "skill") -> DataFrame:
    """Attach category; skills without a category row -> ``unclassified``."""
    cats = categories.select(F.col("canonical_name").alias(skill_col), "category", "platform_family")
    out = skills_long.join(cats, skill_col, "left")
    return out.withColumn("category", F.coalesce("category", F.lit(UNCLASSIFIED)))


def vocabulary(extr: DataFrame, min_count: int = 2) -> DataFrame:
    """Case-sensitive term counts, keep count >= min_count."""
    return extr.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def merge_synonyms(batches: DataFrame) -> DataFrame:
    """Union of synonym sets for equal canonicals across batches ``(batch, canonical, alias)``."""
    return batches.groupBy("canonical").agg(F.array_sort(F.collect_set("alias")).alias("synonyms"))


def upsert_latest(results: DataFrame, key: str = "posting_id", seq: str = "seq") -> DataFrame:
    """Newest result per key wins (a later batch overwrites an earlier one)."""
    vals = [c for c in results.columns if c not in (key, seq)]
    agg = results.groupBy(key).agg(F.max_by(F.struct(*vals), F.col(seq)).alias("_v"), F.max(seq).alias(seq))
    return agg.select(key, seq, *[F.col("_v")[c].alias(c) for c in vals])
