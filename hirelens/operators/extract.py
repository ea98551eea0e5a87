"""Skill extraction from text (X1, X2) and skill co-occurrence.

X1 is a distributed dictionary match over WHOLE texts: each document is tokenised once
inside its array (``skill_tokens`` keeps names such as C++, CI/CD or Node.js whole) and each
token leaves with the words that follow it. The taxonomy is an index of whole word n-grams:
one table tells for each first word which lengths its aliases have, another has one row per
alias text. A token meets at most one row of the first, and one row of the second per length,
however many aliases share a first word. Both are small dimensions, written once to the shared folder, so
that Spark knows their size before it plans the lookups and broadcasts them by its own size check: no
token travels. Only matched (document, skill) pairs are shuffled, for the final aggregate.

X2 leaves out matches that begin inside a negated stretch of words. Stretches end at clause borders:
closing punctuation, a line feed, or a contrasting word. A cue (no, not, ...) negates what follows it in its
clause, unless it is "not only" and the like; a cue before a word of need ("not required") negates
what stands before it, back to the last word of need or the border.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.functions.text import skill_tokens
from hirelens.session import written

# Words and borders of X2's stretches.
NEGATION_WORDS = ["no", "not", "without", "never"]
NEED_WORDS = ["required", "needed", "necessary", "mandatory", "essential"]
NOT_NEGATED = ["only", "just", "merely"]
CONTRAST = r"[ \t\r\n](but|however|although|though)[ \t\r\n]"
CLAUSE_END = r"[.;:!?]+([ \t\r\n]|$)|\n"


def alias_index(taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(canonical, alias)`` -> lengths ``(first, lengths)`` and n-grams ``(gram, canonicals)``, aliases
    tokenised like the text, in lower case, their words joined by one space."""
    toks = skill_tokens(F.lower("alias"))
    rows = taxonomy.select(toks.alias("_t"), "canonical").filter(F.size("_t") > 0).select(
        F.get("_t", F.lit(0)).alias("first"), F.size("_t").alias("n_words"), F.array_join("_t", " ").alias("gram"), "canonical")
    lengths = rows.groupBy("first").agg(F.array_sort(F.collect_set("n_words")).alias("lengths"))
    return lengths, rows.groupBy("gram").agg(F.array_sort(F.collect_set("canonical")).alias("canonicals"))


def clause_tokens(text) -> Column:
    """Tokens of each clause of a text; flattened they are the tokens of the whole text."""
    marked = F.regexp_replace(text, "(?i)" + CONTRAST, "\n$1 ")
    return F.transform(F.split(marked, CLAUSE_END), lambda c: skill_tokens(c))


def _let(value, use) -> Column:
    """``use`` of a value that is computed once, inside a lambda as well."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _among(x, words) -> Column:
    return F.coalesce(x.isin(*words), F.lit(False))


def negated(toks) -> Column:
    """For the lower-case tokens of one clause: whether each lies in a negated stretch."""
    def stretches(t):
        places = F.sequence(F.lit(1), F.size(t))
        near = F.zip_with(t, F.slice(t, F.lit(2), F.size(t)), lambda x, y: F.struct(
            _among(x, NEGATION_WORDS).alias("cue"), _among(x, NEED_WORDS).alias("need"),
            _among(y, NEED_WORDS).alias("back"), _among(y, NOT_NEGATED).alias("kept")))
        return _let(F.zip_with(places, near, lambda i, w: F.struct(i.alias("i"), w.alias("w"))), lambda marks: _let(F.struct(
            F.array_min(F.transform(F.filter(marks, lambda m: m["w"]["cue"] & ~m["w"]["back"] & ~m["w"]["kept"]),
                                    lambda m: m["i"])).alias("forward"),
            F.transform(F.filter(marks, lambda m: m["w"]["cue"] & m["w"]["back"]), lambda m: m["i"]).alias("backs"),
            F.transform(F.filter(marks, lambda m: m["w"]["need"]), lambda m: m["i"]).alias("needs")),
            lambda f: _let(F.transform(f["backs"], lambda c: F.struct(
                F.coalesce(F.array_max(F.filter(f["needs"], lambda p: p < c)), F.lit(0)).alias("after"), c.alias("before"))),
                lambda backward: F.transform(places, lambda i: F.coalesce(i > f["forward"], F.lit(False)) | F.exists(
                    backward, lambda b: (i > b["after"]) & (i < b["before"]))))))

    # most clauses hold no cue: nothing is negated there
    return _let(toks, lambda t: F.when(F.exists(t, lambda x: _among(x, NEGATION_WORDS)), stretches(t)).otherwise(
        F.array_repeat(F.lit(False), F.size(t))))


def looked_up(docs: DataFrame, taxonomy: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              negation: bool = False) -> DataFrame:
    """The index lookups of X1: one row per text position and alias length where an alias of that length begins
    with its words: (_id, pos, spelt, neg, n_words, gram, canonicals)."""
    lengths, grams = (written(x, "aliases") for x in alias_index(taxonomy))
    longest = lengths.agg(F.coalesce(F.max(F.array_max("lengths")), F.lit(1))).scalar()
    t = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if negation:
        t = t.withColumn("_c", clause_tokens(F.col("_text"))).withColumn(
            "_l", F.transform("_c", lambda c: F.transform(c, lambda x: F.lower(x)))).withColumn("_o", F.flatten("_c")).withColumn(
            "_t", F.flatten("_l")).withColumn("_neg", F.flatten(F.transform("_l", negated)))
    else:
        t = t.withColumn("_o", skill_tokens("_text")).withColumn("_t", F.transform("_o", lambda x: F.lower(x)))
    t = t.withColumn("_n", longest)

    def here(x, i):
        return F.struct((i + 1).alias("pos"), x["_t"].alias("first"), F.slice("_t", i + 1, F.col("_n")).alias("words"),
                        x["_o"].alias("spelt"), (x["_neg"] if negation else F.lit(False)).alias("neg"))

    # zipped outside the lambda, so that no array is built again for each token
    each = F.arrays_zip("_t", "_o", *["_neg"] * negation)
    at = t.select("_id", F.inline(F.transform(each, here))).join(lengths, "first")
    at = at.select("_id", "pos", "spelt", "neg", "words", F.explode("lengths").alias("n_words")).where(
        F.col("n_words") <= F.size("words"))
    return (at.withColumn("gram", F.array_join(F.slice("words", F.lit(1), F.col("n_words")), " ")).drop("words")
            .join(grams, "gram"))


def extract_skills(docs: DataFrame, taxonomy: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   negation: bool = False, strict_short: bool = False) -> DataFrame:
    """X1 (+ X2 with ``negation=True``): per document, every taxonomy skill whose
    alias occurs in the text (case-insensitive, whole tokens, all overlapping
    matches kept). Returns ``(id, skill, first_pos, n_matches)``.

    ``strict_short``: aliases of one or two letters match only where the text spells them
    in upper or title case (C, R, Go), since they over-match in prose."""
    found = looked_up(docs, taxonomy, id_col, text_col, negation)
    if strict_short:
        short = (F.col("n_words") == 1) & F.col("gram").rlike(r"^\p{L}{1,2}$")
        found = found.filter(~short | F.col("spelt").isin(F.upper("gram"), F.initcap("gram")))
    if negation:
        found = found.filter(~F.col("neg"))
    found = found.select("_id", "pos", F.explode("canonicals").alias("skill"))
    return (found.groupBy(F.col("_id").alias(id_col), "skill")
            .agg(F.min("pos").alias("first_pos"), F.count(F.lit(1)).alias("n_matches")))


def skill_pairs(skills_long: DataFrame, id_col: str = "posting_id") -> DataFrame:
    """Unordered skill pairs (a < b) per posting, built from the posting's sorted
    distinct skill array (narrow; the array is bounded by the posting's skills)."""
    per = skills_long.groupBy(id_col).agg(F.array_sort(F.collect_set("skill")).alias("_s"))
    pairs = F.flatten(F.transform(
        "_s", lambda a, i: F.transform(F.slice("_s", i + 2, F.size("_s")), lambda b: F.struct(a.alias("skill_a"),
                                                                                              b.alias("skill_b")))))
    return per.select(id_col, F.inline(pairs))


def cooccurrence(skills_long: DataFrame, n_postings, id_col: str = "posting_id") -> DataFrame:
    """Per unordered pair: postings with both, support (share of postings),
    Jaccard = both / (a + b - both). Pair counts use a map-side partial
    aggregate; per-skill counts are a small aggregate joined twice."""
    pairs = skill_pairs(skills_long, id_col)
    pc = pairs.groupBy("skill_a", "skill_b").agg(F.count(F.lit(1)).alias("n_both"))
    sc = skills_long.groupBy("skill").agg(F.count_distinct(id_col).alias("n"))
    a = sc.select(F.col("skill").alias("skill_a"), F.col("n").alias("n_a"))
    b = sc.select(F.col("skill").alias("skill_b"), F.col("n").alias("n_b"))
    j = pc.join(a, "skill_a").join(b, "skill_b")
    return j.select("skill_a", "skill_b", "n_both", F.round(F.col("n_both") / n_postings, 6).alias("support"),
                    F.round(F.col("n_both") / (F.col("n_a") + F.col("n_b") - F.col("n_both")), 6).alias("jaccard"))
