"""Ordered tagging rules (title, geography, seniority) as native Column expressions.

Every rule list compiles to one CASE WHEN / RLIKE / CONTAINS chain, so tagging
runs inside whole-stage codegen with constant patterns and never leaves the JVM.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's rules for identical labels.
# Order matters (first match wins); patterns are case-insensitive and
# word-bounded; titles are singular-only ("data scientists" does not match).
# ---------------------------------------------------------------------------
TITLE_RULES = [
    (r"\b(applied scientist|applied research)\b", "Applied Scientist"),
    (r"\b(research scientist|research engineer)\b", "Research Scientist"),
    (r"\b(ml engineer|machine learning engineer|mlops engineer|ml ops)\b", "ML Engineer"),
    (r"\b(ai engineer|artificial intelligence engineer)\b", "AI Engineer"),
    (r"\b(analytics engineer)\b", "Analytics Engineer"),
    (r"\b(data engineer)\b", "Data Engineer"),
    (r"\b(data scientist|data science)\b", "Data Scientist"),
    (r"\b(data analyst|business analyst|bi analyst|business intelligence analyst)\b", "Data Analyst"),
]
OTHER_TITLE = "Other / Unclassified"
DS_TITLES = [
    "Data Scientist", "ML Engineer", "Applied Scientist", "Analytics Engineer",
    "Data Analyst", "AI Engineer", "Data Engineer", "Research Scientist",
]

US_MARKERS = ["united states", ", us", ", usa", "remote"]
US_STATE_PATTERN = r",\s*[A-Z]{2}$"  # case-sensitive, on the trimmed original
UK_MARKERS = ["united kingdom", ", uk", "england", "london"]
EU_COUNTRIES = [
    "germany", "france", "netherlands", "spain", "italy", "sweden",
    "poland", "belgium", "austria", "denmark", "finland", "norway",
    "switzerland", "portugal", "czech", "czechia", "ireland", "romania",
    "hungary", "greece", "luxembourg",
]
APAC_KEYWORDS = [
    "india", "singapore", "australia", "japan", "china", "hong kong",
    "south korea", "korea", "malaysia", "indonesia", "new zealand",
    "taipei", "taiwan", "vietnam", "philippines",
]

SENIORITY_RULES = [
    (r"\b(vp|vice president|director|head of|principal|staff)\b", "lead"),
    (r"\b(senior|sr\.?|lead)\b", "senior"),
    (r"\b(junior|jr\.?|associate|entry.?level|new grad|graduate)\b", "entry"),
    (r"\b(mid.?level|mid|ii|iii)\b", "mid"),
]
# level-hint substrings, tested in this order before the title rules
HINT_RULES = [
    (["entry", "associate", "internship"], "entry"),
    (["senior", "executive"], "senior"),
    (["director"], "lead"),
    (["mid"], "mid"),
]
UNCLASSIFIED_SENIORITY = "unclassified"
# ---------------------------------------------------------------------------

# Java regex flags giving Python `re.IGNORECASE` behaviour on str patterns:
# i/u = Unicode case folding, U = Unicode \b \s \w, d = only \n ends a line
# (Python's `.` matches \r, Java's does not without UNIX_LINES).
_CI = "(?iuUd)"
_CS = "(?Ud)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c) -> Column:
    """Python ``str.strip()``: removes Unicode whitespace at both ends (Spark ``trim`` is ASCII space only)."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+$", "")


def _first_match(value: Column, rules, default: str, flags: str) -> Column:
    expr = None
    for pattern, label in rules:
        cond = value.rlike(flags + pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default))


def canonical_title(raw_title) -> Column:
    """Ordered word-bounded title rules; null or no match -> ``Other / Unclassified``."""
    t = _col(raw_title)
    return F.when(t.isNull(), F.lit(OTHER_TITLE)).otherwise(
        _first_match(t, TITLE_RULES, OTHER_TITLE, _CI))


def _any_contains(value: Column, needles) -> Column:
    """Substring test for any of ``needles``: ONE regex of quoted literals."""
    return value.rlike("(?s)" + "|".join(r"\Q" + n + r"\E" for n in needles))


def geo_tag(location, strict: bool = False) -> Column:
    r"""US -> two-letter state suffix -> UK -> EU -> APAC -> Other; null -> Other.

    Keyword groups are substring tests on ``lower(location)``; the state rule is
    case-sensitive on the trimmed text (``\s*$`` absorbs trailing whitespace, so
    no trim pass is needed). ``strict=True`` is an opt-in correction that tests
    UK/EU keywords before the two-letter suffix, so "London, UK" stops tagging
    as US (ISO codes such as "Berlin, DE" still need a country name to leave US).
    """
    loc = _col(location)
    low = F.lower(loc)
    state = loc.rlike(_CS + US_STATE_PATTERN[:-1] + r"\s*$")
    us = _any_contains(low, US_MARKERS)
    uk = _any_contains(low, UK_MARKERS)
    eu = _any_contains(low, EU_COUNTRIES)
    apac = _any_contains(low, APAC_KEYWORDS)
    chain = F.when(loc.isNull(), F.lit("Other")).when(us, F.lit("US"))
    if strict:
        chain = chain.when(uk, F.lit("UK")).when(eu, F.lit("EU")).when(state, F.lit("US"))
    else:
        chain = chain.when(state, F.lit("US")).when(uk, F.lit("UK")).when(eu, F.lit("EU"))
    return chain.when(apac, F.lit("APAC")).otherwise(F.lit("Other"))


def seniority(raw_title, level_hint=None) -> Column:
    """Hint branch first (entry/senior/lead/mid), then ordered title rules, else ``unclassified``."""
    t = _col(raw_title)
    expr = None
    if level_hint is not None:
        hint = F.lower(_col(level_hint))
        for needles, label in HINT_RULES:  # substring tests, as `in hint.lower()`
            cond = _any_contains(hint, needles)
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    for pattern, label in SENIORITY_RULES:
        cond = t.rlike(_CI + pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(UNCLASSIFIED_SENIORITY))
