"""Merkle manifest of a dataset: leaf hashes, a tree per language, a tree over the languages.

H is the lower-case hex SHA-256 of its inputs put together (digests as their hex text). A leaf
is H of the columns of a row, each ``-`` if null, else its number of UTF-8 bytes, ``:`` and its
value. The leaves of a group stand in ascending doc_id order; while more than one node remains,
every ``fanout`` consecutive ones (the last run may be shorter, even one node) become their H.
What remains is the group's subroot. The subroots, in order of the group's name (null first, then
bytewise), are the leaves of the upper tree, whose top is the root.

Slot pivot: nodes carry their place in the group. A conditional aggregate per slot spreads the
children of a parent over columns; hashing the columns put together gives the parent, and
leaving out a child's own column gives its siblings. One aggregation spreads ``fanout ** j`` (at
most 16, or one fanout) consecutive nodes and folds j levels with column expressions, so a leaf is shuffled once
for its place and once for its parents, and the node tables above shrink by that factor. Proofs
go down the same tables: each row hands its siblings and those from above to its children.

Places come from ranges of the order key and a prefix sum over the ranges, so a group that holds
most rows is spread over many tasks.

Nulls, ties, edges: a null text, source or n_chars is ``-``; rows without a language are a group of
their own; a null doc_id comes first in its group and is never tampered with; rows that repeat
a doc_id are leaves of their own, ordered by leaf (rows alike in all columns are interchangeable);
an empty table gives no row; other columns are not read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import written
from hirelens.operators.batching import global_positions

_MOST_SLOTS = 16
_PATH = "array<struct<l: string, r: string>>"


def counted(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value as text."""
    s = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def digest(*parts: Column) -> Column:
    """H: lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)


class Steps:
    """Sizes of a tree: levels folded per aggregation and slots per row."""

    def __init__(self, fanout: int):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.fanout, self.levels = fanout, 1
        while fanout ** (self.levels + 1) <= _MOST_SLOTS:
            self.levels += 1
        self.slots = fanout ** self.levels

    def needed(self, most: int) -> int:
        """Aggregations until ``most`` nodes have become one; at least one."""
        n = 1
        while self.slots ** n < most:
            n += 1
        return n


def _pivot(nodes: DataFrame, size: Steps, below: int) -> DataFrame:
    """One row per parent of ``slots`` nodes (g, n, pos, item): the children in columns c_0.., the
    nodes of the levels between in columns v{level}_{index}, the last of them as ``top``.
    ``below`` is the number of levels under the nodes; a level is folded while its group
    has more than one node there."""
    f, k = size.fanout, size.slots
    out = nodes.groupBy("g", F.expr(f"pos div {k}").alias("b")).agg(
        F.max("n").alias("n"), *[F.expr(f"max(CASE WHEN pos % {k} = {s} THEN item END)").alias(f"c_{s}") for s in range(k)])
    row = [f"c_{s}.h" for s in range(k)]
    for level in range(size.levels):
        made = []
        for x in range(0, len(row), f):
            run = row[x:x + f]
            made.append(f"CASE WHEN n > {f ** (below + level)}BD THEN if({run[0]} IS NULL, null, "
                        f"sha2(concat_ws('', {', '.join(run)}), 256)) ELSE {run[0]} END AS v{level + 1}_{x // f}")
        out = out.selectExpr("*", *made)
        row = [f"v{level + 1}_{x}" for x in range(len(made))]
    return out.withColumnRenamed(row[0], "top")


def _children(parents: DataFrame, size: Steps, below: int, keep: list[str]) -> DataFrame:
    """Rows of _pivot that carry ``path`` (siblings above them, nearest first) -> one row per child:
    g, pos, item, path with the child's own siblings in front. The expressions are SQL text, which
    Spark parses in one call."""
    f, k = size.fanout, size.slots

    def put(level: int, lo: int, hi: int) -> str:
        cols = [f"c_{y}.h" if level == 0 else f"v{level}_{y}" for y in range(lo, hi)]
        return f"concat_ws('', {', '.join(cols)})" if cols else "''"

    kids = []
    for s in range(k):
        own = []
        for level in range(size.levels):
            x = s // f ** level
            first = x // f * f
            own.append(f"if(n > {f ** (below + level)}BD, struct({put(level, first, x)} AS l, "
                       f"{put(level, x + 1, first + f)} AS r), null)")
        kids.append(f"struct(b * {k} + {s} AS pos, c_{s} AS item, CAST(concat(filter(array({', '.join(own)}), "
                    f"e -> e IS NOT NULL), path) AS {_PATH}) AS path)")
    return parents.selectExpr("g", *keep, f"inline(array({', '.join(kids)}))").where("item IS NOT NULL")


def _tree(nodes: DataFrame, most: int, size: Steps, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All levels over nodes (g, n, pos, item), written step by step; and (g, h) of the tops."""
    steps = []
    for k in range(size.needed(most)):
        steps.append(written(_pivot(nodes, size, k * size.levels), f"{name}-{k}"))
        nodes = steps[-1].select("g", "n", F.col("b").alias("pos"), F.struct(F.col("top").alias("h")).alias("item"))
    return steps, nodes.select("g", F.col("item.h").alias("h"))


def _paths(steps: list[DataFrame], tops: DataFrame, size: Steps) -> DataFrame:
    """(g, path, further columns) of the tops carried down: one row per node at the bottom with
    g, pos, item, path and the further columns."""
    keep = [c for c in tops.columns if c not in ("g", "path")]
    down = tops.withColumn("b", F.lit(0).cast("long"))
    for k in range(len(steps) - 1, -1, -1):
        kids = _children(steps[k].join(down, ["g", "b"]), size, k * size.levels, keep)
        down = kids.withColumnRenamed("pos", "b") if k else kids
        if k:
            down = down.drop("item")
    return down


def leaf(columns: dict[str, Column]) -> Column:
    return digest(*[counted(c) for c in columns.values()])


def manifest(docs: DataFrame, fanout: int = 2, tamper_modulus: int = 7) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256 (H of all siblings from the
    leaf up to the root, left to right on each level), folded_root (the root that the document and its
    siblings give) and verified (it equals the root).

    ``tamper_modulus``: documents for which it divides the CRC-32 of the decimal doc_id are folded
    with n_chars raised by one, everything else being as it was; 0 changes none.
    """
    size = Steps(fanout)
    cols = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    changed = {**cols, "n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    hit = F.lit(False)
    if tamper_modulus:
        hit = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % tamper_modulus == 0) & F.col("n_chars").isNotNull()
    leaves = written(docs.select(
        "lang", F.col("doc_id").cast("long").alias("doc_id"), leaf(cols).alias("h"),
        F.when(hit, leaf(changed)).alias("changed"), F.monotonically_increasing_id().alias("tie")), "merkle-leaves")
    # order: null languages first, then bytewise; null ids first
    placed = global_positions(leaves, ["lang", "doc_id", "h", "tie"], "at").withColumn("g", counted(F.col("lang")))
    groups = written(placed.groupBy("g", "lang").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-groups")
    most = groups.agg(F.max("n"), F.count(F.lit(1))).first()
    nodes = placed.join(groups.drop("lang"), "g").select(
        "g", "n", (F.col("at") - F.col("first")).alias("pos"), F.struct("h", "doc_id", "changed").alias("item"))
    steps, subroots = _tree(nodes, most[0] or 0, size, "merkle")

    upper = global_positions(subroots.join(groups.select("g", "lang"), "g"), ["lang"], "pos")
    upper_steps, top = _tree(upper.select(
        F.lit("").alias("g"), F.lit(most[1]).cast("long").alias("n"), "pos",
        F.struct("h", F.col("g").alias("of")).alias("item")), most[1], size, "merkle-upper")
    tops = _paths(upper_steps, top.select("g", F.array().cast(_PATH).alias("path"), F.col("h").alias("root")), size)
    tops = written(tops.select(F.col("item.of").alias("g"), "path", F.col("item.h").alias("subroot"), "root"), "merkle-tops")

    rows = _paths(steps, tops, size)
    folded = F.aggregate("path", F.coalesce("item.changed", "item.h"), lambda acc, x: digest(x["l"], acc, x["r"]))
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["l"], x["r"])), ""), 256)
    rows = rows.select(F.col("item.doc_id").alias("doc_id"), F.col("item.h").alias("leaf"), "subroot", "root",
                       proof.alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
