"""Analysis operators as DataFrame -> DataFrame functions.

Inputs are the clean postings (one row per posting, with ``snapshot``) and the
long skills table ``(posting_id, source, snapshot, canonical_title, skill)``.
Results are small per-(group, skill) aggregates. Per-snapshot denominators are
scalar subqueries (``DataFrame.scalar()``) or conditional aggregates, so no
cross join appears; windows only run over aggregates with a partition key.
Role-by-role cosines come from ONE pivoted pass over the skills (sum of
products per role pair), not from a self-join that emits all pairs per skill.
"""
from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions.stats import wilson_bounds

DS = "Data Scientist"

# Thresholds of the analysis plan (defaults of every parameter below).
WORKING_MIN_PREVALENCE = 0.05
DIRECTIONAL_MIN_MENTIONS = 15
FOOTNOTE_MIN_MENTIONS = 30
CONFIDENT_MIN_PREVALENCE = 0.30
RISE_MIN_CHANGE, RISE_MIN_LAST = 0.08, 0.05
CORE_MAX_RANGE, CORE_MIN_PREVALENCE = 0.05, 0.20
DECLINE_MIN_DROP, DECLINE_MIN_FIRST = 0.08, 0.05
SURPRISE_LOW, SURPRISE_HIGH, SURPRISE_MIN_FIRST_N, SURPRISE_MIN_LAST_N = 0.05, 0.10, 15, 25
CLAIMABLE_MIN = 0.10
DENOMINATOR_FLAG_PP = 2.0
DISTINCT_HIGH, DISTINCT_LOW = 2.0, 0.5


def _r6(c):
    return F.round(c, 6)


def _one(n=1):
    return F.count(F.lit(n))


# ---- N-G -----------------------------------------------------------------------
def role_composition(clean: DataFrame, biased_source: str, key: str = "snapshot") -> DataFrame:
    """N-G: per (snapshot, role) counts and shares; raw vs adjusted (biased source excluded)."""
    g = (clean.filter(F.col(key).isNotNull())
         .groupBy(key, "canonical_title")
         .agg(_one().alias("n_raw"), F.count_if(F.col("source") != biased_source).alias("n_adjusted")))
    w = Window.partitionBy(key)
    share_raw = F.col("n_raw") / F.sum("n_raw").over(w)
    tot_adj = F.sum("n_adjusted").over(w)
    share_adj = F.when(tot_adj > 0, F.col("n_adjusted") / tot_adj)
    return g.select(key, "canonical_title", "n_raw", _r6(share_raw).alias("share_raw"), "n_adjusted",
                    _r6(share_adj).alias("share_adjusted"), _r6(100 * (share_raw - share_adj)).alias("gap_pp"))


def role_share_change(clean: DataFrame, first, last, key: str = "snapshot") -> DataFrame:
    """N-G2: percentage-point change of each role's share between two snapshots."""
    g = clean.filter(F.col(key).isin(first, last)).groupBy("canonical_title").agg(
        F.count_if(F.col(key) == first).alias("n_first"), F.count_if(F.col(key) == last).alias("n_last"))
    t_first = clean.filter(F.col(key) == first).agg(_one()).scalar()
    t_last = clean.filter(F.col(key) == last).agg(_one()).scalar()
    s1 = F.col("n_first") / t_first
    s2 = F.col("n_last") / t_last
    return g.select("canonical_title", "n_first", "n_last", _r6(s1).alias("share_first"),
                    _r6(s2).alias("share_last"), _r6(100 * (s2 - s1)).alias("change_pp"))


# ---- N-A / N-A2 / M2 --------------------------------------------------------------
def prevalence(clean: DataFrame, skills: DataFrame, keys=("snapshot",)) -> DataFrame:
    """N-A: share of postings (zero-skill postings included in the denominator)
    mentioning each skill, per key group. Only present (group, skill) cells."""
    keys = list(keys)
    tot = clean.filter(F.col(keys[0]).isNotNull()).groupBy(*keys).agg(_one().alias("n_postings"))
    men = skills.groupBy(*keys, "skill").agg(F.count_distinct("posting_id").alias("n_mentions"))
    j = men.join(tot, keys)
    return j.select(*keys, "skill", "n_mentions", "n_postings",
                    _r6(F.col("n_mentions") / F.col("n_postings")).alias("prevalence"))


def denominator_sensitivity(clean_n: DataFrame, skills: DataFrame, key: str = "snapshot",
                            flag_pp: float = DENOMINATOR_FLAG_PP) -> DataFrame:
    """M2: prevalence with and without zero-skill postings in the denominator."""
    tot = clean_n.filter(F.col(key).isNotNull()).groupBy(key).agg(
        _one().alias("n_all"), F.count_if(F.col("n_skills") > 0).alias("n_nonzero"))
    men = skills.groupBy(key, "skill").agg(F.count_distinct("posting_id").alias("n_mentions"))
    j = men.join(tot, key)
    p_all = F.col("n_mentions") / F.col("n_all")
    p_nz = F.col("n_mentions") / F.col("n_nonzero")
    diff = 100 * (p_nz - p_all)
    return j.select(key, "skill", "n_mentions", _r6(p_all).alias("prevalence_all"),
                    _r6(p_nz).alias("prevalence_nonzero"), _r6(diff).alias("diff_pp"),
                    (diff > flag_pp).alias("diverges"))


# ---- wide per-skill grid over snapshots (zero-filled) ------------------------------
def snapshot_grid(clean: DataFrame, skills: DataFrame, snapshots, key: str = "snapshot") -> DataFrame:
    """Per skill: mentions n_i and prevalence p_i for each snapshot i (0 when absent),
    denominators N_i as scalar subqueries. Columns: skill, n_0.., tot_0.., p_0.."""
    agg = skills.groupBy("skill").agg(
        *[F.count_distinct(F.when(F.col(key) == s, F.col("posting_id"))).alias(f"n_{i}")
          for i, s in enumerate(snapshots)])
    for i, s in enumerate(snapshots):
        total = clean.filter(F.col(key) == s).agg(_one()).scalar()
        agg = agg.withColumn(f"tot_{i}", total).withColumn(
            f"p_{i}", F.when(F.col(f"tot_{i}") > 0, F.col(f"n_{i}") / F.col(f"tot_{i}")).otherwise(F.lit(0.0)))
    return agg


def working_skills(grid: DataFrame, k: int, min_prev: float = WORKING_MIN_PREVALENCE) -> DataFrame:
    """skills above ``min_prev`` in at least one snapshot."""
    mx = F.greatest(*[F.col(f"p_{i}") for i in range(k)])
    return grid.withColumn("max_prevalence", mx).filter(F.col("max_prevalence") > min_prev)


def wilson_long(grid: DataFrame, snapshots) -> DataFrame:
    """N-B: Wilson 95 % interval per (skill, snapshot) with small-n flags taken
    from the first snapshot (directional < 15, footnote < 30, confident > 30 %)."""
    k = len(snapshots)
    cells = F.array(*[F.struct(F.lit(s).alias("snapshot"), F.col(f"n_{i}").alias("n_mentions"),
                               F.col(f"tot_{i}").alias("n_postings")) for i, s in enumerate(snapshots)])
    flags = grid.select("skill", "n_0", "p_0", F.inline(cells))
    lo, hi = wilson_bounds("n_mentions", "n_postings")
    p = F.when(F.col("n_postings") > 0, F.col("n_mentions") / F.col("n_postings"))
    del k
    return flags.select(
        "skill", "snapshot", "n_mentions", "n_postings", _r6(p).alias("prevalence"),
        _r6(lo).alias("ci_low"), _r6(hi).alias("ci_high"),
        (F.col("n_0") < DIRECTIONAL_MIN_MENTIONS).alias("directional_only"),
        (F.col("n_0") < FOOTNOTE_MIN_MENTIONS).alias("footnote"),
        (F.col("p_0") > CONFIDENT_MIN_PREVALENCE).alias("confident"))


def trend(grid: DataFrame) -> DataFrame:
    """N-C: direction across first/middle/last snapshot; non-monotone rows are flagged."""
    a, b, c = F.col("p_0"), F.col("p_1"), F.col("p_2")
    direction = (F.when((a == b) & (b == c), "flat")
                 .when((a <= b) & (b <= c), "increasing")
                 .when((a >= b) & (b >= c), "decreasing")
                 .otherwise("non_monotone"))
    return grid.select("skill", "n_0", "n_1", "n_2", "p_0", "p_1", "p_2", direction.alias("direction"))


def trend_table(grid: DataFrame) -> DataFrame:
    t = trend(grid)
    return t.select("skill", _r6("p_0").alias("p_first"), _r6("p_1").alias("p_middle"), _r6("p_2").alias("p_last"),
                    "direction", (F.col("direction") != "non_monotone").alias("consistent"))


def narratives(grid: DataFrame) -> DataFrame:
    """N-D: rise / core / decline / surprising, NOT exclusive (one row per
    (skill, narrative)); ``claimable`` = above 10 % at both endpoints."""
    t = trend(grid)
    p0, p1, p2 = F.col("p_0"), F.col("p_1"), F.col("p_2")
    change = p2 - p0
    consistent = F.col("direction") != "non_monotone"
    rng = F.greatest(p0, p1, p2) - F.least(p0, p1, p2)
    rise = (change >= RISE_MIN_CHANGE) & (p2 > RISE_MIN_LAST) & consistent
    core = ((rng < CORE_MAX_RANGE) & (F.least(p0, p1, p2) > CORE_MIN_PREVALENCE)
            & (F.col("n_0") > 0) & (F.col("n_1") > 0) & (F.col("n_2") > 0))
    decline = (change <= -DECLINE_MIN_DROP) & (p0 > DECLINE_MIN_FIRST) & consistent
    surprising = ((change >= SURPRISE_LOW) & (change <= SURPRISE_HIGH)
                  & (F.col("n_0") >= SURPRISE_MIN_FIRST_N) & (F.col("n_2") >= SURPRISE_MIN_LAST_N))
    tags = F.filter(F.array(F.when(rise, F.lit("rise")), F.when(core, F.lit("core")),
                            F.when(decline, F.lit("decline")), F.when(surprising, F.lit("surprising"))),
                    lambda x: x.isNotNull())
    out = t.select("skill", F.explode(tags).alias("narrative"), _r6(100 * change).alias("change_pp"),
                   _r6(p0).alias("p_first"), _r6(p2).alias("p_last"),
                   ((p0 > CLAIMABLE_MIN) & (p2 > CLAIMABLE_MIN)).alias("claimable"))
    return out


# ---- cosine profiles ---------------------------------------------------------------
def profiles(clean: DataFrame, skills: DataFrame, profile_col) -> DataFrame:
    """Sparse long prevalence profiles ``(profile, skill, p)``; denominators include
    zero-skill postings."""
    tot = clean.groupBy(profile_col.alias("profile")).agg(_one().alias("_tot"))
    men = skills.groupBy(profile_col.alias("profile"), "skill").agg(F.count_distinct("posting_id").alias("_cnt"))
    return men.join(tot, "profile").select("profile", "skill", (F.col("_cnt") / F.col("_tot")).alias("p"))


def cosine_matrix(prof: DataFrame, names: list[str], pairs=None) -> DataFrame:
    """Cosine of every requested profile pair from ONE pivot: wide per-skill rows
    (one column per profile), then one aggregate of all sums of products; the
    single result row is turned into ``(profile_a, profile_b, cosine)`` rows.
    Default pairs: a <= b in ``names`` order. A zero vector gives null."""
    idx = {n: i for i, n in enumerate(names)}
    cmap = F.create_map(*[x for n in names for x in (F.lit(n), F.lit(f"c{idx[n]}"))])
    cols = [f"c{i}" for i in range(len(names))]
    p2 = prof.withColumn("_c", F.element_at(cmap, F.col("profile"))).filter(F.col("_c").isNotNull())
    wide = p2.groupBy("skill").pivot("_c", cols).agg(F.first("p")).na.fill(0.0, subset=cols)
    if pairs is None:
        pairs = list(combinations_with_replacement(names, 2))
    need = sorted({tuple(sorted((idx[a], idx[b]))) for a, b in pairs} | {(idx[a], idx[a]) for ab in pairs for a in ab})
    sums = wide.agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"d{i}_{j}") for i, j in need])

    def cos(a, b):
        i, j = sorted((idx[a], idx[b]))
        den = F.sqrt(F.col(f"d{idx[a]}_{idx[a]}") * F.col(f"d{idx[b]}_{idx[b]}"))
        return _r6(F.when(den > 0, F.col(f"d{i}_{j}") / den))

    rows = F.array(*[F.struct(F.lit(a).alias("profile_a"), F.lit(b).alias("profile_b"), cos(a, b).alias("cosine"))
                     for a, b in pairs])
    return sums.select(F.inline(rows))


def similarity_drivers(prof: DataFrame, anchor: str, top: int = 5) -> DataFrame:
    """N-H drivers: per other profile, the skills with the largest contribution
    p*q/(|p||q|) to its cosine with ``anchor`` (top-k per pair via row_number)."""
    norms = prof.groupBy("profile").agg(F.sqrt(F.sum(F.col("p") * F.col("p"))).alias("_norm"))
    a = prof.filter(F.col("profile") == anchor).select("skill", F.col("p").alias("_pa"))
    na = norms.filter(F.col("profile") == anchor).select(F.col("_norm").alias("_na"))
    na_val = na.agg(F.max("_na")).scalar()
    b = prof.filter(F.col("profile") != anchor).join(norms, "profile")
    j = b.join(a, "skill")
    contrib = F.col("p") * F.col("_pa") / (F.col("_norm") * na_val)
    j = j.select(F.col("profile").alias("other"), "skill", contrib.alias("contribution"))
    w = Window.partitionBy("other").orderBy(F.desc("contribution"), "skill")
    return (j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)
            .select("other", "rank", "skill", _r6("contribution").alias("contribution")))


# ---- N-I / N-K / N-L -----------------------------------------------------------------
def category_ownership(clean_slice: DataFrame, cat_skills: DataFrame, category: str) -> DataFrame:
    """N-I: among postings with >= 1 skill of ``category``, share per role."""
    owners = cat_skills.filter(F.col("category") == category).select("posting_id").distinct()
    p = clean_slice.join(owners, "posting_id", "left_semi")
    total = p.agg(_one()).scalar()
    return p.groupBy("canonical_title").agg(_one().alias("n")).withColumn("share", _r6(F.col("n") / total))


def ownership_by_skill(cat_skills: DataFrame, category: str) -> DataFrame:
    """N-I: per skill of ``category``, postings by role and the role's share of them."""
    g = (cat_skills.filter(F.col("category") == category)
         .groupBy("skill", "canonical_title").agg(F.count_distinct("posting_id").alias("n")))
    return g.withColumn("share", _r6(F.col("n") / F.sum("n").over(Window.partitionBy("skill"))))


def distinctiveness(clean_slice: DataFrame, skills_slice: DataFrame, anchor: str = DS,
                    high: float = DISTINCT_HIGH, low: float = DISTINCT_LOW) -> DataFrame:
    """N-K: anchor-role prevalence / unweighted mean prevalence over the roles of
    the slice (zeros counted)."""
    tot = clean_slice.groupBy("canonical_title").agg(_one().alias("_tot"))
    n_roles = clean_slice.agg(F.count_distinct("canonical_title")).scalar()
    men = skills_slice.groupBy("canonical_title", "skill").agg(F.count_distinct("posting_id").alias("_cnt"))
    p = men.join(tot, "canonical_title").withColumn("p", F.col("_cnt") / F.col("_tot"))
    g = p.groupBy("skill").agg(F.sum("p").alias("_sum"),
                               F.sum(F.when(F.col("canonical_title") == anchor, F.col("p")).otherwise(0.0)).alias("_a"))
    mean = F.col("_sum") / n_roles
    ratio = F.col("_a") / mean
    label = F.when(ratio > high, "specific").when(ratio < low, "under_represented").otherwise("neutral")
    return g.select("skill", _r6("_a").alias("anchor_prevalence"), _r6(mean).alias("mean_prevalence"),
                    _r6(ratio).alias("ratio"), label.alias("label"))


def skill_breadth(clean_n_slice: DataFrame) -> DataFrame:
    """N-L: median (and mean) skills per posting by role."""
    return clean_n_slice.groupBy("canonical_title").agg(
        _one().alias("postings"), F.median("n_skills").alias("median_skills"),
        _r6(F.avg("n_skills")).alias("mean_skills"))


# ---- M1 ------------------------------------------------------------------------------
def length_regression(df: DataFrame, y: str = "n_skills", length: str = "desc_len",
                      group: str = "source") -> DataFrame:
    """M1: OLS ``y ~ log(length) + C(group)`` via per-group centred moments:
    slope = sum Sxy / sum Sxx, RSS = sum Syy - slope * sum Sxy, s.e. from
    RSS / (N - k - 1), R^2 against the overall total sum of squares."""
    d = df.filter(F.col(length) > 0).select(F.log(F.col(length)).alias("x"), F.col(y).cast("double").alias("y"), group)
    g = d.groupBy(group).agg(_one().alias("n"), (F.count(F.lit(1)) * F.var_pop("x")).alias("sxx"),
                             (F.count(F.lit(1)) * F.covar_pop("x", "y")).alias("sxy"),
                             (F.count(F.lit(1)) * F.var_pop("y")).alias("syy"))
    tss = d.agg(F.count(F.lit(1)) * F.var_pop("y")).scalar()
    s = g.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.sum("sxx").alias("sxx"),
              F.sum("sxy").alias("sxy"), F.sum("syy").alias("syy"))
    slope = F.col("sxy") / F.col("sxx")
    rss = F.col("syy") - slope * F.col("sxy")
    dof = F.col("n") - F.col("k") - 1
    se = F.sqrt(rss / dof / F.col("sxx"))
    return s.select(F.col("n").cast("long").alias("n"), F.col("k").cast("long").alias("groups"),
                    _r6(slope).alias("slope"), _r6(se).alias("std_err"), _r6(slope / se).alias("t_stat"),
                    _r6(1 - rss / tss).alias("r_squared"))
