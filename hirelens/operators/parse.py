"""Model-response parsing (P1-P3) as jobs over a responses table ``(response_id, text)``.

Each parser is a column pipeline (strip fences, parse, explode); nothing is
parsed on the driver and every response is handled whole.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.functions.text import last_entries, let, yaml_scalar

_FENCE = r"(?s)^```[^\n]*\n(.*?)(\n```\s*)?$"


def strip_fence(text_col):
    """Drop a leading ```lang line and a trailing ``` line (trimmed text)."""
    t = F.trim(text_col)
    return F.when(t.startswith("```"), F.regexp_extract(t, _FENCE, 1)).otherwise(t)


def _object(t):
    """The entries of a text that is one JSON object and nothing else, as map<string,string>; else null.
    The outermost bracket may only close at the end; what stands between is the parser's to judge."""
    t = F.trim(t, F.lit(" \t\r\n"))
    marks = F.split(F.regexp_replace(F.regexp_replace(t, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', ""), r"[^{}\[\]]", ""), "")
    depth = F.aggregate(marks, F.struct(F.lit(0).alias("d"), F.lit(0).alias("tops")), lambda acc, x: let(
        acc["d"] + F.when(x.isin("{", "["), 1).when(x.isin("}", "]"), -1).otherwise(0),
        lambda d: F.struct(d.alias("d"), (acc["tops"] + F.when((x != "") & (d <= 0), 1).otherwise(0)).alias("tops"))))
    whole = t.startswith("{") & t.endswith("}") & (depth["tops"] == 1)
    return F.when(whole, F.from_json(t, "map<string,string>", {"allowSingleQuotes": "false"}))


def parse_json_responses(resp: DataFrame) -> DataFrame:
    """Fenced or bare JSON object -> map; else the first ``{`` .. last ``}`` span. Either must be one whole
    object (text behind it, or a second object, gives nothing); of equal keys the last one counts;
    anything that is not an object, and any value that is not a list -> nothing. Long output ``(response_id, key, pos, term)``;
    an empty list keeps its key with a null term."""
    t = strip_fence(F.col("text"))
    m = F.coalesce(_object(t), _object(F.regexp_extract(t, r"(?s)(\{.*\})", 1)), F.create_map().cast("map<string,string>"))
    # each value is judged by itself: one that is no list does not lose the others
    kv = resp.select("response_id", F.explode(last_entries(m)).alias("_e")).select(
        "response_id", F.col("_e.key").alias("key"),
        F.when(F.ltrim(F.col("_e.value")).startswith("["), F.from_json(F.col("_e.value"), "array<string>")).alias("terms"))
    kv = kv.filter(F.col("terms").isNotNull())
    # posexplode_outer: a key with an empty list is kept (pos/term null) - "extracted none"
    return kv.select("response_id", "key", F.posexplode_outer("terms").alias("pos", "term")).select(
        "response_id", "key", (F.col("pos") + 1).cast("int").alias("pos"), "term")


def parse_yaml_responses(resp: DataFrame) -> DataFrame:
    """``key:`` lines followed by ``- item`` lines, or ``key: [a, b]``; keys and items may
    be quoted, escapes are decoded, comments dropped; keys with a scalar value are dropped. Output ``(response_id, key, item)``; the running key is carried with a
    window partitioned by response (bounded by one response's lines)."""
    lines = resp.select("response_id", F.posexplode(F.split(strip_fence(F.col("text")), "\n")).alias("ln", "line"))
    key_re = r"""^("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s\-"'#][^:]*|-[^\s:][^:]*):(?:\s+(.*?))?\s*$"""
    is_key = F.col("line").rlike(key_re)
    lines = lines.select("response_id", "ln", "line",
                         F.when(is_key, yaml_scalar(F.regexp_extract("line", key_re, 1))).alias("_k"),
                         F.when(is_key, F.regexp_replace(F.coalesce(F.regexp_extract("line", key_re, 2), F.lit("")),
                                                         r"(^|[ \t]+)#.*$", "")).alias("_v"))
    w = Window.partitionBy("response_id").orderBy("ln").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("_key", F.last("_k", ignorenulls=True).over(w)).withColumn(
        "_val", F.last(F.when(F.col("_k").isNotNull(), F.col("_v")), ignorenulls=True).over(w))
    items = lines.filter(F.col("line").rlike(r"^\s*-\s+") & (F.col("_val") == ""))
    block = items.select("response_id", F.col("_key").alias("key"),
                         yaml_scalar(F.regexp_replace("line", r"^\s*-\s+", "")).alias("item"))
    # flow lists: key: [a, "b, c"]
    flow = lines.filter(F.col("_k").isNotNull() & F.col("_v").rlike(r"^\[.*\]$"))
    part = r"""("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^,\[\]"'\s][^,\[\]]*)"""
    flow = flow.select("response_id", F.col("_k").alias("key"),
                       F.explode(F.regexp_extract_all("_v", F.lit(part), 1)).alias("item"))
    return block.unionByName(flow.select("response_id", "key", yaml_scalar(F.col("item")).alias("item")))


def _opens(line):
    """Whether a line that begins outside quotes ends inside a quoted field. Only a quote at the start of a
    field opens one."""
    return F.regexp_replace(line, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1").rlike(r'(^|,)"')


def _stays_open(line):
    """Whether a line that begins inside a quoted field ends inside one."""
    rest = F.regexp_extract(line, r'^[^"]*+(?:""[^"]*+)*+"([^"].*)?$', 1)
    closed = line.rlike(r'^[^"]*+(?:""[^"]*+)*+"([^"].*)?$')
    return ~closed | _opens(F.concat(F.lit("x"), rest))


def csv_records(text) -> Column:
    """Records of a CSV text: its lines, put together again while a quoted field is open."""
    start = F.struct(F.lit(False).alias("open"), F.array().cast("array<string>").alias("recs"))

    def step(acc, line):
        n = F.size(acc["recs"])
        longer = F.concat(F.slice(acc["recs"], F.lit(1), F.greatest(n - 1, F.lit(0))),
                          F.array(F.concat(F.get(acc["recs"], n - 1), F.lit("\n"), line)))
        return F.struct(F.when(acc["open"], _stays_open(line)).otherwise(_opens(line)).alias("open"),
                        F.when(acc["open"], longer).otherwise(F.concat(acc["recs"], F.array(line))).alias("recs"))

    return F.aggregate(F.split(text, "\n"), start, step)["recs"]


def parse_csv_responses(resp: DataFrame, names=("canonical_name", "category", "platform_family")) -> DataFrame:
    """Quoted CSV records, which may hold line feeds inside quotes; 2-column records padded with "";
    records under 2 columns dropped; trimmed."""
    lines = resp.select("response_id", F.explode(csv_records(strip_fence(F.col("text")))).alias("line"))
    lines = lines.filter(F.trim("line") != "")
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    rec = F.from_csv("line", schema, {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
                                      "ignoreTrailingWhiteSpace": "false"})
    # an empty field and a missing column both parse to null: a record counts if a separator is
    # left once its quoted parts are taken out
    two = F.regexp_replace("line", r'"(?:[^"]|"")*"', "").contains(",")
    r = lines.filter(two).select("response_id", rec.alias("r"))
    return r.select("response_id", *[F.coalesce(F.trim(F.col(f"r.c{i}")), F.lit("")).alias(n)
                                      for i, n in enumerate(names)])
