"""Query registry: key -> (Spark builder, optional DuckDB oracle SQL).

A builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame. The oracle is
an ANSI/DuckDB query over the driver tables; bridge views it needs are
prepended as CTEs by ``with_views``.
"""
from __future__ import annotations

from collections.abc import Callable

from hirelens.functions import rules
from hirelens.sources import fixtures as fx

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- SQL twins of the tagging rules (generated from the same rule lists) ----
def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_title(col: str) -> str:
    parts = [f"WHEN {col} IS NULL THEN {_q(rules.OTHER_TITLE)}"]
    parts += [f"WHEN regexp_matches({col}, {_q('(?i)' + p)}) THEN {_q(label)}" for p, label in rules.TITLE_RULES]
    return "CASE " + " ".join(parts) + f" ELSE {_q(rules.OTHER_TITLE)} END"


def _any(col: str, needles) -> str:
    return "(" + " OR ".join(f"contains({col}, {_q(n)})" for n in needles) + ")"


def sql_geo(col: str) -> str:
    low = f"lower({col})"
    return ("CASE "
            f"WHEN {col} IS NULL THEN 'Other' "
            f"WHEN {_any(low, rules.US_MARKERS)} THEN 'US' "
            f"WHEN regexp_matches(trim({col}), {_q(rules.US_STATE_PATTERN)}) THEN 'US' "
            f"WHEN {_any(low, rules.UK_MARKERS)} THEN 'UK' "
            f"WHEN {_any(low, rules.EU_COUNTRIES)} THEN 'EU' "
            f"WHEN {_any(low, rules.APAC_KEYWORDS)} THEN 'APAC' "
            "ELSE 'Other' END")


def sql_seniority(title: str, hint: str | None) -> str:
    parts = []
    if hint is not None:
        h = f"lower({hint})"
        parts += [f"WHEN {_any(h, needles)} THEN {_q(label)}" for needles, label in rules.HINT_RULES]
    parts += [f"WHEN regexp_matches({title}, {_q('(?i)' + p)}) THEN {_q(label)}" for p, label in rules.SENIORITY_RULES]
    return "CASE " + " ".join(parts) + f" ELSE {_q(rules.UNCLASSIFIED_SENIORITY)} END"


def _in(values) -> str:
    return ", ".join(_q(v) if isinstance(v, str) else str(v) for v in values)


SNAPSHOT_SQL = "CASE year " + " ".join(f"WHEN {k} THEN {v}" for k, v in sorted(fx.SNAPSHOT_MAP.items())) + " END"

# ---- view graph --------------------------------------------------------------
VIEWS: dict[str, tuple[list[str], str]] = {
    "postings_raw": ([], fx.SQL_POSTINGS_RAW),
    "tagged": (["postings_raw"], f"""
tagged AS (
  SELECT source || ':' || CAST(native_id AS VARCHAR) AS posting_id, source, date,
         CAST(year(date) AS INTEGER) AS year,
         CASE WHEN date IS NOT NULL THEN CAST(year(date) AS VARCHAR) || 'Q' || CAST(quarter(date) AS VARCHAR) END AS quarter,
         {sql_title('trim(raw_title)')} AS canonical_title,
         trim(raw_title) AS raw_title,
         trim(split_part(company, chr(10), 1)) AS company,
         location,
         {sql_geo('location')} AS geo,
         level_hint,
         {sql_seniority('trim(raw_title)', 'level_hint')} AS seniority,
         coalesce(description_text, '') AS description_text
  FROM postings_raw
)"""),
    "unified": (["tagged"], f"""
unified AS (
  SELECT *, coalesce(company IS NOT NULL AND date IS NOT NULL AND
           date_diff('day', lag(date) OVER (PARTITION BY company, canonical_title ORDER BY date, posting_id), date) <= 30,
           false) AS is_duplicate
  FROM tagged
  WHERE canonical_title IN ({_in(rules.DS_TITLES)}) AND year IN ({_in(fx.VALID_YEARS)}) AND geo = 'US'
)"""),
    "clean": (["unified"], f"""
clean AS (
  SELECT *, {SNAPSHOT_SQL} AS snapshot FROM unified
  WHERE NOT is_duplicate AND NOT coalesce(source = {_q(fx.ARTEFACT_SOURCE)} AND year < {fx.ARTEFACT_MIN_YEAR}, false)
)"""),
    "extractions": ([], fx.SQL_EXTRACTIONS),
    "dictionary": ([], fx.SQL_DICTIONARY),
    "categories": (["dictionary"], fx.SQL_CATEGORIES),
    "named_slots": ([], fx.SQL_NAMED_SLOTS),
    "text_aliases": ([], fx.SQL_TEXT_ALIASES),
    "reverse_lookup": (["dictionary"], """
reverse_lookup AS (
  SELECT lower(alias) AS alias_lower, arg_max(canonical, seq) AS canonical
  FROM dictionary GROUP BY lower(alias)
)"""),
    "mapped": (["extractions", "reverse_lookup"], """
mapped AS (
  SELECT e.posting_id, r.canonical AS skill, min(e.pos) AS first_pos
  FROM extractions e JOIN reverse_lookup r ON lower(e.term) = r.alias_lower
  GROUP BY e.posting_id, r.canonical
)"""),
    "skills": (["clean", "mapped"], """
skills AS (
  SELECT c.posting_id, c.source, c.snapshot, c.canonical_title, m.skill
  FROM clean c JOIN mapped m ON c.posting_id = m.posting_id
)"""),
    "clean_n": (["clean", "mapped"], """
clean_n AS (
  SELECT c.*, coalesce(k.n_skills, 0) AS n_skills
  FROM clean c LEFT JOIN (SELECT posting_id, count(*) AS n_skills FROM mapped GROUP BY posting_id) k
    ON c.posting_id = k.posting_id
)"""),
}


def with_views(*names: str, body: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(VIEWS[n][1].strip() for n in order)
    return f"WITH {ctes}\n{body.strip()}"
