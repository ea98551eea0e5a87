"""Personal data: regular expressions propose spans, validators confirm, context adjusts.

Everything is a DataFrame expression. A pattern runs over a whole text once with the gap
before each match in front (``\\G`` and a lazy gap), so the lengths of the pieces give the
positions, in code points. Base kinds are email, ip, card and phone; added ones are iban
(mod-97), ssn and local (telephone numbers without a country code). A span starts with the
score of its kind, words before it within ``CONTEXT`` code points raise or lower that, and
spans below ``THRESHOLD`` are dropped; base kinds start at 1 and no word lowers those.

Patterns are written with possessive repeats, and with a look-behind where a match can
only begin at the start of a run (or where the last match ended), so that a long run is
read once; they match the same spans as their plain forms.

Nulls, ties, edges: a null text has no spans; spans of different kinds may overlap, those of
one kind don't; repeated rows are judged one by one; an empty table gives no row; columns
of the input pass through, those named like a result's are replaced.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT, THRESHOLD = 40, 0.5
_PART = 200
BASE = ("email", "ip", "card", "phone")

_LOCAL = r"[A-Za-z0-9._%+-]"
# kind -> pattern (one group: the match). The base patterns' classes and lengths.
PATTERNS = {
    "email": rf"((?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)",
    "ip": r"((?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++)",
    "card": r"([0-9](?:[\x20-]?[0-9])++)",
    "phone": r"(\+[0-9][\x20().0-9-]+[0-9])",
    "iban": r"((?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
    "ssn": r"((?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))",
    "local": r"((?<![0-9+).-])(?<!\+[0-9]{1,3}[\x20.-]?)(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-]))",
}
# A text without this can have no match (a cheaper search).
NEEDS = {"email": "@", "phone": r"\+[0-9]", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]",
         "iban": "[A-Z]{2}[0-9]{2}", "ssn": "[0-9]-[0-9]{2}-[0-9]", "local": "[0-9][.-][0-9]{4}"}
# kind -> score without context, words that raise it by 0.4, words that lower it by 0.4
SCORES = {
    "email": (1.0, None, None), "ip": (1.0, None, None), "card": (1.0, None, None), "phone": (1.0, None, None),
    "iban": (0.8, "iban|account|konto|compte|cuenta", "example|order|part no"),
    "ssn": (0.3, r"ssn|social security|tax id|taxpayer", "order|part no|serial"),
    "local": (0.3, r"phone|call|tel\b|tel\.|fax|mobile|cell|contact|whatsapp", "order|part no|serial|version"),
}
KINDS = tuple(PATTERNS)


def _digits(s):
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits):
    """Luhn check of a string of digits."""
    back = F.reverse(digits)

    def add(total, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(s):
    """Mod-97 check of an account number: first four signs to the end, letters from A as 10."""
    own = F.regexp_replace(s, " ", "")
    turned = F.concat(F.substring(own, F.lit(5), F.length(own)), F.substring(own, 1, 4))

    def step(rest, i):
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, (rest * 10 + c - 48) % 97).otherwise((rest * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, m):
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(16, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        return F.when(F.length(F.regexp_replace(m, " ", "")).between(15, 34), mod97(m)).otherwise(F.lit(False))
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def _score(kind: str, text, m, start):
    base, up, down = SCORES[kind]
    score = F.lit(base)
    if kind == "local":
        score = score + F.when(m.startswith("("), 0.4).otherwise(0.0)
    if up is None:
        return score
    first = F.greatest(start - CONTEXT, F.lit(0))
    before = F.lower(F.substring(text, first + 1, start - first))
    return (score + F.when(before.rlike(up), 0.4).otherwise(0.0) - F.when(before.rlike(down), 0.4).otherwise(0.0))


def _kind_spans(text, kind: str, pieces, matches):
    """array<struct<kind, start, end, text, score>> of one kind, in order of start."""
    none = F.array().cast("array<struct<start:int,end:int,text:string>>")

    def place(acc, x):
        end = acc["at"] + F.length(x["piece"])
        span = F.struct((end - F.length(x["match"])).alias("start"), end.alias("end"), x["match"].alias("text"))
        return F.struct(end.alias("at"), F.when(_valid(kind, x["match"]), F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("match"))
    zipped = F.transform(zipped, lambda x: F.struct(x["piece"].alias("piece"), x["match"].alias("match")))
    # positions within parts of ``_PART`` matches, then shifted by the length of the parts before:
    # appending to an array copies it, so arrays are kept short
    parts = F.transform(F.sequence(F.lit(0), F.greatest(F.size(zipped) - 1, F.lit(0)), F.lit(_PART)),
                        lambda i: F.aggregate(F.slice(zipped, i + 1, F.lit(_PART)),
                                              F.struct(F.lit(0).alias("at"), none.alias("out")), place))
    before = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
                         lambda acc, p: F.struct((acc["at"] + p["at"]).alias("at"),
                                                 F.concat(acc["out"], F.array(acc["at"])).alias("out")),
                         lambda acc: acc["out"])
    spans = F.flatten(F.transform(F.arrays_zip(parts.alias("part"), before.alias("by")), lambda x: F.transform(
        x["part"]["out"], lambda s: F.struct((s["start"] + x["by"]).alias("start"), (s["end"] + x["by"]).alias("end"),
                                             s["text"].alias("text")))))
    scored = F.transform(spans, lambda s: F.struct(
        F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"),
        _score(kind, text, s["text"], s["start"]).cast("double").alias("score")))
    return F.filter(scored, lambda s: s["score"] >= THRESHOLD)


def find_pii(docs: DataFrame, kinds=KINDS, spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``spans``: array<struct<kind, start, end, text, score>>, by kind as
    listed, then start; positions in code points, end exclusive."""
    t = F.coalesce(F.col("text"), F.lit(""))
    out = docs.drop(spans_col)
    strings = "array<string>"
    for k in kinds:
        p = F.lit(r"\G(?s:.*?)" + PATTERNS[k])
        may = t.rlike(NEEDS[k])
        none = F.array().cast(strings)
        out = (out.withColumn(f"_pieces_{k}", F.when(may, F.regexp_extract_all(t, p, F.lit(0))).otherwise(none))
               .withColumn(f"_matches_{k}", F.when(may, F.regexp_extract_all(t, p, F.lit(1))).otherwise(none)))
    parts = [_kind_spans(t, k, F.col(f"_pieces_{k}"), F.col(f"_matches_{k}")) for k in kinds]
    return (out.withColumn(spans_col, F.concat(*parts))
            .drop(*[f"_{a}_{k}" for k in kinds for a in ("pieces", "matches")]))


def span_text(spans):
    """kind:start:end of each span, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def redact(docs: DataFrame, kinds=KINDS) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; spans that
    overlap become one, named after the first. Columns stay as they are."""
    # the row travels in one column, so that no name of the input can clash
    found = find_pii(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), "text"), kinds, "_spans")
    by_start = F.array_sort(F.transform("_spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def join(acc, s):
        last = F.element_at(acc, -1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"),
                          last["kind"].alias("kind"))
        return (F.when(F.size(acc) == 0, F.array(s))
                .when(s["start"] < last["end"], F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer)))
                .otherwise(F.concat(acc, F.array(s))))

    found = found.withColumn("_cut", F.aggregate(by_start, none, join))
    cut, text = F.col("_cut"), F.col("text")

    def piece(s, i):
        at = F.when(i == 0, 0).otherwise(F.get(cut, i - 1)["end"])
        return F.concat(F.substring(text, at + 1, s["start"] - at), F.lit("["), F.upper(s["kind"]), F.lit("]"))

    tail = F.substring(text, F.element_at(cut, -1)["end"] + 1, F.length(text))
    clean = F.when(F.size(cut) == 0, text).otherwise(F.concat(F.concat_ws("", F.transform(cut, piece)), tail))
    return found.withColumn("_clean", clean).select(
        *[F.col("_clean").alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of the base kinds, base_sha256, spans."""
    found = find_pii(docs.select("doc_id", "text"))
    s = F.col("spans")
    base = F.filter(s, lambda x: x["kind"].isin(*BASE))

    def count(k):
        return F.size(F.filter(s, lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")

    return found.select("doc_id", *map(count, BASE), F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(s).alias("spans"))
