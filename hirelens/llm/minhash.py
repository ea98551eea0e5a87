"""Near-duplicate documents: bottom-k sketches, inverted lists, exact Jaccard.

A document's set is its distinct shingles of ``width`` words (A-Z lower-cased; a shorter
text is one shingle). One hash function orders all shingles; the ``k`` smallest are the
sketch. An inverted list is kept for every ``g`` neighbouring values of a sketch: in the
union of two sets with Jaccard >= t each value is shared with probability t, so k of them
without g shared ones in a row have a chance below 1e-9 (``key_width`` takes the largest
such g up to 3). Sets that fit the sketch are met for certain: of their union at most a fifth
isn't shared, and sets of up to six values have lists of two neighbours as well. Single
frequent shingles, lines or passages thus make no long list; near copies do.

Lists never become all pairs. First each member meets its list's smallest and largest
member; these candidates pass the union-sketch estimate and are decided on the full sets of
strings, read from the texts of candidates alone (a bitmap of fixed size over hashes of their
ids keeps other texts from being shuffled). Links found there merge documents into components,
and a list whose members are one component is done. In the others members of unlike components
are compared by their sketches, in pairs of blocks of bounded size; what leaves a task is not
the similar pairs but which components they connect. So the components that may still merge
form groups; a document is in one at most. Its full set (64-bit hashes) goes once to each pair of
blocks of the group that its own block is in, where similar pairs of unlike components are
decided one by one; a link merges its components, so a task returns fewer links than documents.

Documents with equal sets are one class and are compared once. Nulls, ties, edges: a null text
or one without words has an empty set and links with nothing; a null doc_id keeps its row and
links with nothing; repeated rows are copies; rows that share a doc_id and have unlike sets are
documents of their own, told apart by 64-bit hashes of id and text; an empty table gives no row.
Other columns are not read.
"""
from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import components, unused, written

BITMAP = 1 << 25                                       # slots of the candidate bitmap: 4 MB
LONG_LIST, BLOCK = 8, 1024


def least_shared(k: int, t: float, risk: float = 1e-10) -> int:
    """Sketch values that two full sketches share at least if Jaccard >= t: the largest c with
    P(Binomial(k, t) < c) < risk."""
    below, c = 0.0, 0
    while True:
        below += math.comb(k, c) * t**c * (1 - t) ** (k - c)
        if below >= risk:
            return max(1, c)
        c += 1


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased (ASCII white space separates)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_set(words: list[bytes], width: int) -> set:
    """The exact set: tuples of words."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


class _Hashes(dict):
    def __missing__(self, w: bytes) -> int:
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_set(words: list[bytes], width: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(h) < width:
        h, n = np.concatenate([h, np.zeros(width - len(h), np.uint64)]), 1
    else:
        n = len(h) - width + 1
    x = np.zeros(n, np.uint64)
    for i in range(width):
        x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + h[i:i + n] + np.uint64(i + 1))
    return np.unique(x.view(np.int64))


def sketches(docs: DataFrame, width: int, k: int) -> DataFrame:
    """(doc_id, n, key, sketch) of each row: set size, hash of the whole set, k smallest values."""
    def run(batches):
        hashes = _Hashes()
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                if len(hashes) > 200_000:
                    hashes.clear()
                ids, n, key, sk = [], [], [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    w = words_of(t)
                    s = hashed_set(w, width, hashes) if w else np.zeros(0, np.int64)
                    ids.append(d)
                    n.append(len(s))
                    key.append(xxhash.xxh3_128_digest(s.tobytes()))
                    sk.append(s[:k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
                     pa.array(sk, pa.list_(pa.int64()))], ["doc_id", "n", "key", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, key binary, sketch array<long>")


def key_width(k: int, t: float, risk: float = 1e-9) -> int:
    """The largest g <= 3 such that k independent values, each shared with probability t, miss g
    shared ones in a row with a chance below ``risk``; 1 if none is."""
    best = 1
    for g in (2, 3):
        run = [1.0] + [0.0] * (g - 1)                   # chance of a current run of 0 .. g - 1 shared values
        for _ in range(k):
            run = [(1 - t) * sum(run)] + [t * x for x in run[:-1]]
        if sum(run) < risk:
            best = g
    return best


def postings(cls: DataFrame, k: int, t: float) -> DataFrame:
    """(v, id, n, low, high): keys of neighbouring sketch values that several classes have, with
    the list's smallest and largest class."""
    s, g = F.col("sketch"), key_width(k, t)

    def rows(width):
        return F.transform(F.sequence(F.lit(1), F.size(s) - (width - 1)), lambda i: F.xxhash64(
            F.lit(width), *[F.element_at(s, i + j) for j in range(width)]))

    none = F.array().cast("array<bigint>")
    keys = F.when(F.size(s) >= g, rows(g)).otherwise(none)
    if g > 2:
        keys = F.concat(keys, F.when((F.size(s) >= 2) & (F.col("n") <= 2 * g), rows(2)).otherwise(none))
    post = cls.select("id", "n", F.explode(keys).alias("v"))
    lists = (post.groupBy("v").agg(F.count("*").alias("df"), F.min("id").alias("low"), F.max("id").alias("high"))
             .where("df > 1").drop("df"))
    return post.join(lists, "v")


def estimated(pairs: DataFrame, cls: DataFrame, k: int, t: float) -> DataFrame:
    """Pairs (a, b) whose union sketch leaves Jaccard >= t possible."""
    own = cls.select("id", "n", "sketch")
    both = (pairs.join(own.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a")), "a")
            .join(own.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b")), "b"))
    union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
    whole = (F.col("n_a") <= k) & (F.col("n_b") <= k)
    all_shared = F.size(F.array_intersect("s_a", "s_b"))
    exact = all_shared >= t * (F.col("n_a") + F.col("n_b") - all_shared) - 1e-6
    near = shared * k >= least_shared(k, t) * F.size(union)
    length = F.least("n_a", "n_b") >= t * F.greatest("n_a", "n_b") - 1e-6
    return both.where(length & F.when(whole, exact).otherwise(near)).select("a", "b")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """Bits of the slots that ``ids`` (column id) hash to; its size is fixed."""
    slot = F.pmod(F.xxhash64("id"), F.lit(BITMAP))
    rows = (ids.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect())
    out = np.zeros(BITMAP // 8 + 8192, np.uint8)
    for r in rows:
        at = (r["b"] - 1) * 4096
        out[at:at + len(r["m"])] = np.frombuffer(r["m"], np.uint8)
    return out


def _slot_position():
    s = F.pmod(F.xxhash64("doc_id"), F.lit(BITMAP))
    return ((F.bitmap_bucket_number(s) - 1) * 32768 + F.bitmap_bit_position(s)).cast("long")


def _of_candidates(docs: DataFrame, ids: DataFrame, make, column: str) -> DataFrame:
    """(doc_id, <column>) of the documents named in ``ids`` (column id): ``make`` maps a list of
    texts to a list of cells. Texts whose slot in the bitmap is empty never leave their task."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))
    name, kind = column.split(" ")
    arrow = pa.binary() if kind == "binary" else pa.list_(pa.int64())

    def run(batches):
        for b in batches:
            at = b.column(2).to_numpy()
            rows = np.flatnonzero((bits.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            for lo in range(0, len(rows), 1000):
                part = b.take(pa.array(rows[lo:lo + 1000]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(make(part.column(1).to_pylist()), arrow)], ["doc_id", name])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .where("doc_id IS NOT NULL AND text IS NOT NULL")
            .select("doc_id", "text", _slot_position().alias("slot"))
            .mapInArrow(run, f"doc_id long, {name} {kind}")
            .join(ids, F.col("doc_id") == F.col("id"), "left_semi"))


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links that connect what ``pairs`` (a, b) with 100 * intersection >= percent * union on the full
    sets of shingles connect: a task leaves out pairs whose ends its own links connect already."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    body = _of_candidates(docs, ids, lambda texts: [zlib.compress(b" ".join(words_of(t)), 1) for t in texts], "body binary")

    def compare(batches):
        last, last_set = None, None
        place: dict[int, int] = {}                      # rows of the task's disjoint sets
        merged = _Sets([])
        for b in batches:
            keep = []
            for x, y, tx, ty in zip(*(c.to_pylist() for c in b.columns)):
                i, j = (place.setdefault(d, len(place)) for d in (x, y))
                merged.up += range(len(merged.up), len(place))
                if merged.root(i) == merged.root(j):
                    continue
                if y != last:
                    last, last_set = y, shingle_set(zlib.decompress(ty).split(), width)
                own = shingle_set(zlib.decompress(tx).split(), width)
                both = len(own & last_set)
                if 100 * both >= percent * (len(own) + len(last_set) - both):
                    merged.join(i, j)
                    keep.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in keep], pa.int64()),
                                              pa.array([p[1] for p in keep], pa.int64())], ["a", "b"])

    one = pairs.join(body.select(F.col("doc_id").alias("a"), F.col("body").alias("x")), "a")
    two = one.join(body.select(F.col("doc_id").alias("b"), F.col("body").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(compare, "a long, b long").distinct()


def _shared(sets: list, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values each set of ``left`` shares with each of ``right`` (rows of ``sets``)."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, v, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(times > 1) - 1                     # values that at least two sets hold
    owner, v = owner[times[v] > 1], rank[v[times[v] > 1]]
    count = np.zeros((len(left), len(right)), np.float32)
    for first in range(0, int(v.max(initial=-1)) + 1, 2048):
        now = (v >= first) & (v < first + 2048)
        m = np.zeros((len(sets), 2048), np.float32)
        m[owner[now], v[now] - first] = 1
        count += m[left] @ m[right].T
    return count


def _similar(pdf, sketch: list, k: int, t: float):
    """Row pairs of a task's two blocks, of unlike components, that may reach Jaccard >= t."""
    lo, hi = pdf["lo"].iloc[0], pdf["hi"].iloc[0]
    left, right = np.flatnonzero(pdf["block"] == lo), np.flatnonzero(pdf["block"] == hi)
    if not len(left) or not len(right):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    n, c = pdf["n"].to_numpy(), pdf["component"].to_numpy()
    count = _shared(sketch, left, right)
    least = np.where(n <= k, np.ceil((2 * t - 1) / t * n - 1e-9), least_shared(k, t))
    na, nb = n[left][:, None], n[right][None, :]
    ok = ((count >= np.maximum(least[left][:, None], least[right][None, :]))
          & (c[left][:, None] != c[right][None, :])
          & (np.minimum(na, nb) >= t * np.maximum(na, nb) - 1e-6))
    if lo == hi:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    i, j = np.nonzero(ok)
    return left[i], right[j], count[i, j]


class _Sets:
    """Disjoint sets of rows."""

    def __init__(self, labels):
        first: dict = {}
        self.up = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _in_blocks(rows: DataFrame, size: str) -> DataFrame:
    """Rows of a key once per pair (lo, hi) of its blocks that their block is in."""
    rows = rows.withColumn("blocks", F.ceil(F.col(size) / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    return (rows.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("lo", F.least("block", "_o")).withColumn("hi", F.greatest("block", "_o")))


def open_edges(post: DataFrame, comp: DataFrame, cls: DataFrame, k: int, t: float) -> DataFrame:
    """(a, b): which components (by their labels) are connected by similar pairs in some list."""
    rows = (post.select("v", "id", "n").join(comp.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("component", F.coalesce("component", "id")))
    lists = (rows.groupBy("v").agg(F.count("*").alias("df"), F.min("component").alias("c0"), F.max("component").alias("c1"))
             .where("c0 <> c1").select("v", "df"))
    rows = written(rows.join(lists, "v"), "mh-lists")
    short = rows.where(F.col("df") <= LONG_LIST).select("v", "id", "n", "component")
    other = short.select("v", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("component").alias("c2"))
    near = F.least("n", "n2") >= t * F.greatest("n", "n2") - 1e-6
    found = (short.join(other, "v").where(F.col("id") < F.col("id2")).where(F.col("component") != F.col("c2"))
             .where(near).select(F.col("id").alias("a"), F.col("id2").alias("b")).distinct())

    def connect(pdf):
        a, b, _ = _similar(pdf, list(pdf["sketch"]), k, t)
        labels, of = np.unique(pdf["component"].to_numpy(), return_inverse=True)
        sets = _Sets(range(len(labels)))
        for x, y in zip(of[a].tolist(), of[b].tolist()):
            sets.join(x, y)
        root = np.array([sets.root(i) for i in range(len(labels))])
        own = root != np.arange(len(labels))
        return pd.DataFrame({"a": labels[root[own]], "b": labels[own]})

    long = _in_blocks(rows.where(F.col("df") > LONG_LIST).join(cls.select("id", "sketch"), "id"), "df")
    far = (long.select("v", "lo", "hi", "block", "id", "n", "component", "sketch")
           .groupBy("v", "lo", "hi").applyInPandas(connect, "a long, b long"))
    of = comp.select(F.col("node"), "component")
    near = estimated(found, cls, k, t)
    for c in ("a", "b"):
        near = (near.join(of, near[c] == of["node"], "left").withColumn(c, F.coalesce("component", c))
                .drop("node", "component"))
    return near.select("a", "b").union(far).distinct()


def resolved(edges: DataFrame, comp: DataFrame, docs: DataFrame, width: int, percent: int, k: int) -> DataFrame:
    """Links (a, b) that merge components, among those that ``edges`` connect: every similar pair of
    their documents is decided on the full sets of hashes."""
    t = percent / 100
    group = components(edges).select(F.col("node").alias("label"), F.col("component").alias("grp"))
    members = group.join(comp, group["label"] == comp["component"]).select(F.col("node").alias("id"), "component", "grp")
    alone = group.join(comp, group["label"] == comp["node"], "left_anti").select(
        F.col("label").alias("id"), F.col("label").alias("component"), "grp")
    group = written(members.union(alone), "mh-groups")

    def make(texts):
        hashes = _Hashes()
        return [hashed_set(w, width, hashes) if (w := words_of(x)) else None for x in texts]

    sets = _of_candidates(docs, group.select("id"), make, "set array<bigint>")
    size = group.groupBy("grp").agg(F.count("*").alias("size"))
    rows = (sets.select(F.col("doc_id").alias("id"), "set").join(group.join(size, "grp"), "id")
            .withColumn("n", F.size("set")))

    def decide(pdf):
        own, ids = list(pdf["set"]), pdf["id"].to_numpy()
        a, b, count = _similar(pdf, [x[:k] for x in own], k, t)
        merged, out = _Sets(pdf["component"].tolist()), []
        for at in np.argsort(-count, kind="stable").tolist():
            i, j = int(a[at]), int(b[at])
            if merged.root(i) == merged.root(j):
                continue
            x, y = (own[i], own[j]) if len(own[i]) <= len(own[j]) else (own[j], own[i])
            both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
            if 100 * both >= percent * (len(x) + len(y) - both):
                merged.join(i, j)
                out.append((ids[i], ids[j]))
        return pd.DataFrame({"a": [x for x, _ in out], "b": [y for _, y in out]}, dtype="int64")

    blocks = _in_blocks(rows, "size").select("grp", "lo", "hi", "block", "id", "n", "component", "set")
    return blocks.groupBy("grp", "lo", "hi").applyInPandas(decide, "a long, b long")


def own_ids(docs: DataFrame, rows: DataFrame, name: str) -> tuple[DataFrame, bool]:
    """``docs`` with a column ``name`` that tells documents apart, and whether it differs from doc_id:
    doc_id, or a hash of doc_id and text where rows of that doc_id have unlike sets."""
    unlike = (rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
              .where("lo <> hi"))
    did = F.col("doc_id").cast("long")
    if not unlike.limit(1).count():
        return docs.withColumn(name, did), False
    flag = unused("_unlike", docs.columns)
    unlike = written(unlike.select(F.col("doc_id").alias(flag)), "mh-unlike")
    return (docs.join(unlike, did == F.col(flag), "left")
            .withColumn(name, F.when(F.col(flag).isNotNull(), F.xxhash64(did, "text")).otherwise(did)).drop(flag)), True


def decided(docs: DataFrame, width: int, percent: int, k: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``docs`` with their ``own_ids``, and (_d, n, component_id, lead) of each such id whose text has words:
    set size, smallest doc_id of the component and the own id of that document."""
    t = percent / 100
    rows = written(sketches(docs, width, k), "mh-rows")
    docs, differ = own_ids(docs, rows, name)
    texts = docs.select(F.col(name).alias("doc_id"), "text")
    if differ:
        rows = written(sketches(texts, width, k), "mh-rows")
    rows = rows.where("doc_id IS NOT NULL AND n > 0")
    cls = written(rows.groupBy("key").agg(
        F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
        .select("key", "id", "n", "sketch"), "mh-classes")
    post = written(postings(cls, k, t), "mh-postings")
    # each list's members against its smallest and its largest member
    star = (post.where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"))
            .union(post.where("id <> high").select("id", "high")).distinct())
    links = written(verified(estimated(star, cls, k, t), texts, width, percent), "mh-links")
    comp = written(components(links), "mh-components")
    links = links.union(resolved(open_edges(post, comp, cls, k, t), comp, texts, width, percent, k))
    comp = components(links).select(F.col("node").alias("id"), "component")
    per = (cls.select("key", "id").join(comp, "id", "left")
           .select(F.col("key").alias("_k"), F.coalesce("component", "id").alias("lead")))
    sets = rows.select(F.col("doc_id").alias("_d"), "n", "key").distinct().join(per, F.col("key") == F.col("_k"), "left")
    if not differ:
        return docs, sets.select("_d", "n", F.col("lead").alias("component_id"), "lead")
    of = docs.select(F.col(name).alias("_o"), F.col("doc_id").cast("long").alias("real")).where("_o IS NOT NULL").distinct()
    sets = written(sets.select("_d", "n", F.col("lead").alias("_c")).join(of, F.col("_d") == F.col("_o")), "mh-sets")
    first = (sets.groupBy(F.col("_c").alias("_f")).agg(F.min(F.struct("real", "_d")).alias("first"))
             .select("_f", F.col("first.real").alias("component_id"), F.col("first._d").alias("lead")))
    return docs, sets.join(first, F.col("_c") == F.col("_f")).select("_d", "n", "component_id", "lead")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept."""
    docs, sets = decided(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), width, percent, k, "own")
    out = docs.select("doc_id", "own").join(sets, F.col("own") == F.col("_d"), "left")
    cid = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), cid.alias("component_id"),
                      F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """One row of ``docs`` for each component: the document with its smallest doc_id (of rows that
    repeat that id and its set, one). Rows without a doc_id stay."""
    own = unused("_own", docs.columns)
    rest, sets = decided(docs, width, percent, k, own)
    gone = sets.where("_d <> lead").select("_d")
    rest = rest.join(gone, rest[own] == gone["_d"], "left_anti")
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        rest = rest.where("doc_id IS NOT NULL").dropDuplicates([own]).unionByName(rest.where("doc_id IS NULL"))
    return rest.select(*docs.columns)
