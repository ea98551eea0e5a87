"""Text cleanup as native Column expressions.

HTML stripping and entity decoding are chains of JVM expressions; no Python runs.
"""
from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelens.functions.rules import unicode_trim

# Blocks whose text the HTML text extractor skips, replaced by one separator.
_BLOCKS = (
    r"(?is)<!--.*?-->|<!--.*$"                          # comments (unterminated: to end)
    r"|<script\b[^>]*>.*?</script\s*>"
    r"|<style\b[^>]*>.*?</style\s*>"
    r"|<template\b[^>]*>.*?</template\s*>"
    r"|<![^>]*>"                                         # doctype / declarations
    r"|<\?[^>]*>"                                        # processing instructions
)
_TAGS = r"(?s)</?[A-Za-z][^>]*>"
# Names that end without a semicolon, longest first (the standard's legacy ones).
_LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code_point(n) -> Column:
    """Text of a numeric reference, by the HTML standard: 128-159 as Windows-1252, null, surrogates
    and numbers beyond Unicode as U+FFFD, other control characters and non-characters as nothing."""
    def windows(k):
        try:
            return bytes([k]).decode("cp1252")
        except UnicodeDecodeError:
            return chr(k)

    c1 = F.create_map(*[F.lit(x) for k in range(128, 160) for x in (k, windows(k))])
    none = (n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127) | n.between(0xFDD0, 0xFDEF)
            | ((n % 65536) >= 65534))
    text = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("\ufffd"))
            .when(n.between(128, 159), c1[n.cast("int")]).when(none, F.lit("")).otherwise(text))


def decode_entities(c) -> Column:
    """One pass of HTML entity decoding: numeric references, names with a semicolon, and the
    standard's legacy names without one; any other ``&`` stays (R&D, AT&T)."""
    text = _col(c)
    def table(keys):                                    # one literal: a map of literals would slow planning
        return F.str_to_map(F.lit("\x02".join(f"{k}\x01{html5[k]}" for k in keys)), F.lit("\x02"), F.lit("\x01"))

    common, every = table(["amp;", "lt;", "gt;", "quot;", "nbsp;", "apos;", "copy;", "middot;"]), table(html5)
    legacy = "^(" + "|".join(_LEGACY) + ")"

    def number(digits, base):
        d = F.regexp_replace(F.regexp_replace(digits, "[xX;]", ""), "^0+", "")
        return F.when(F.length(d) > 7, F.lit(0x110000)).when(d == "", F.lit(0)).otherwise(F.conv(d, base, 10)).cast("long")

    def decoded(p):
        ten = F.regexp_extract(p, "^#([0-9]+;?)", 1)
        hexa = F.regexp_extract(p, "^#([xX][0-9a-fA-F]+;?)", 1)
        name = F.regexp_extract(p, r"^([A-Za-z][A-Za-z0-9]*;)", 1)
        old = F.regexp_extract(p, legacy, 1)

        def rest(x, more=0):
            return F.substring(p, F.length(x) + 1 + more, F.length(p))

        return (F.when(ten != "", F.concat(_code_point(number(ten, 10)), rest(ten, 1)))
                .when(hexa != "", F.concat(_code_point(number(hexa, 16)), rest(hexa, 1)))
                .when(name != "", F.coalesce(F.concat(F.coalesce(common[name], every[name]), rest(name)),
                                             F.concat(F.coalesce(every[old], F.lit("&")), rest(old))))
                .when(old != "", F.concat(every[old], rest(old)))
                .otherwise(F.concat(F.lit("&"), p)))

    parts = F.split(text, "&")
    out = F.concat(F.get(parts, 0), F.concat_ws("", F.transform(F.slice(parts, 2, F.size(parts)), decoded)))
    return F.when(text.contains("&"), out).otherwise(text)


def collapse_ws(c) -> Column:
    """``re.sub(r"\\s+", " ", s).strip()`` with Unicode whitespace."""
    return unicode_trim(F.regexp_replace(_col(c), r"(?U)\s+", " "))


def _strip_markup(c: Column) -> Column:
    no_blocks = F.regexp_replace(c, _BLOCKS, " ")
    return F.regexp_replace(no_blocks, _TAGS, " ")


def html_to_text(raw) -> Column:
    """T4: entity-decode -> drop comments/doctype/script/style/template -> tags to " "
    -> decode again -> collapse whitespace -> trim; blank/null -> "".
    """
    r = _col(raw)
    blank = r.isNull() | (unicode_trim(r) == "")
    return F.when(blank, F.lit("")).otherwise(collapse_ws(decode_entities(_strip_markup(decode_entities(r)))))


def company_clean(c) -> Column:
    """Keep text before the first newline, then Unicode-trim ("Healthfirst\\n3.1" -> "Healthfirst")."""
    return unicode_trim(F.split(_col(c), "\n").getItem(0))


def first_location(c, is_array: bool = True) -> Column:
    """First element of a location list as string; empty/null -> ""."""
    v = _col(c)
    if is_array:
        return F.coalesce(F.get(v, 0).cast("string"), F.lit(""))
    return F.coalesce(v.cast("string"), F.lit(""))


def text_or_empty(c) -> Column:
    """T14 (deliberate deviation): null text -> "" instead of the literal "nan"."""
    return F.coalesce(_col(c).cast("string"), F.lit(""))


# What a token may hold besides letters and digits, and what it may not begin or
# end with (a leading dot stays, as in .NET).
TOKEN_PATTERN = r"[\p{L}\p{N}+#./&'-]+"
TOKEN_EDGES = r"^[/&'-]+|[./&'-]+$"
# A match of the first without what matches the second, if anything is left, in one pass over the text.
_TOKEN = r"(?:(?<!\.)\.[./&'-]*+)?[\p{L}\p{N}+#](?:[\p{L}\p{N}+#./&'-]*[\p{L}\p{N}+#])?"


def skill_tokens(c) -> Column:
    """Tokens in text order, spelling kept: letters, digits and inner ``+ # . / & - '``, without
    closing punctuation (C++, C#, CI/CD, Node.js, GPT-4 are tokens); whole text, no cap."""
    return F.regexp_extract_all(_col(c), F.lit(_TOKEN), F.lit(0))


def let(value, use) -> Column:
    """``use`` of a value that is computed once, inside a lambda as well."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# Escapes of a YAML double-quoted scalar that JSON lacks, as the JSON escape of the same character.
_YAML_ONLY = {"0": "u0000", "a": "u0007", "e": "u001b", "v": "u000b", " ": "u0020", "N": "u0085", "_": "u00a0", "L": "u2028",
              "P": "u2029"}
_BEFORE = r"(?<!\\)((?:\\\\)*)\\"          # an escape begins: an odd backslash


def yaml_scalar(c) -> Column:
    """Value of a one-line YAML scalar: quotes taken off, escapes decoded, a comment behind it removed."""
    t = F.trim(_col(c), F.lit(" \t\r"))
    inner = F.regexp_extract(t, r'^"([^"\\]*+(?:\\.[^"\\]*+)*+)"\s*(?:#.*)?$', 1)
    for name, code in _YAML_ONLY.items():
        inner = F.regexp_replace(inner, _BEFORE + name, f"$1\\\\{code}")
    inner = F.regexp_replace(inner, _BEFORE + "x([0-9A-Fa-f]{2})", r"$1\\u00$2")
    double = F.get(F.from_json(F.concat(F.lit('["'), inner, F.lit('"]')), "array<string>", {"allowUnquotedControlChars": "true"}), F.lit(0))
    single = F.replace(F.regexp_extract(t, r"^'((?:[^']|'')*+)'\s*(?:#.*)?$", 1), F.lit("''"), F.lit("'"))
    plain = F.when(t.startswith("#"), "").otherwise(F.regexp_replace(t, r"[ \t]+#.*$", ""))
    return F.when(t.startswith('"'), F.coalesce(double, t)).when(t.rlike(r"^'.*'\s*(#.*)?$"), single).otherwise(plain)


def last_entries(m) -> Column:
    """Entries (key, value) of a map that may hold a key more than once, as parsed JSON does: the last
    one of each key."""
    put = F.transform(F.map_entries(m), lambda e, i: F.struct(e["key"].alias("key"), (-i).alias("back"), e["value"].alias("value")))
    # sorted by key and from the end: the first of each key is its last entry
    return let(F.array_sort(put), lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["key"] != e["key"])))
