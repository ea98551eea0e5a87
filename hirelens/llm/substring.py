"""Repeated passages: prefix-partitioned suffix trees over the words of all documents.

A passage repeats if some window of ``window`` consecutive words has the same words as an
earlier one (smaller doc_id, or same document and earlier start). The suffixes that begin
with such a window are the deep part of the corpus' suffix tree: two of them share an
internal node of depth >= window. The tree is never built whole:

* Suffixes are split by a prefix of ``GRAM`` words: the one with the smallest hash in the
  window, so neighbouring windows mostly share it and travel as one run of words. Equal
  windows have equal prefixes. A prefix that occurs once has no internal node below it; its
  suffixes are not sent at all.
* A prefix with more than ``MAX_RUNS`` runs is lengthened to the whole window, where each
  node is one class of equal windows; every task sends just its earliest of a class. Prefixes
  that at least ``OFTEN`` of some ``SAMPLE`` sampled documents hold take that way from the
  start and are not even counted, so no key of the count holds more than a few hundredths of
  the rows. The sample only routes; results don't depend on it.
* Tasks take prefixes in order and pack them into groups of some ``GROUP_RUNS`` runs. A group's
  suffixes are sorted by their words; neighbours that agree to depth ``window`` lie under one
  deep internal node, whose earliest suffix stays while the others are repeats.

Nothing is compared by hash alone except whole windows of very frequent prefixes (128 bits).

Nulls, ties, edges: a null text has no words; a text shorter than the window is kept whole;
rows equal in doc_id and text are one document; a null doc_id comes last, and of rows that
share a doc_id (or have none) with unlike texts the one with the smaller text hash is
earlier; an empty table gives no row. Other columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import written

GRAM, MAX_RUNS, GROUP_RUNS, HELD_WINDOWS = 8, 2000, 20_000, 200_000
SAMPLE, OFTEN = 2000, 20
_RUN, _WINDOW, _REPEAT = 0, 1, 2                       # kinds of rows on the way to the trees
_ROW = "kind int, key long, key2 long, doc long, s int, n int, body binary"


class _Hashes(dict):
    def __missing__(self, w: bytes) -> int:
        self[w] = h = xxhash.xxh3_64_intdigest(w)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, unchanged (ASCII white space separates)."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefixes(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window start: where the word group with the smallest hash begins (the first of
    equals), and that hash, over an array of word hashes."""
    g = h
    step = 1
    while step < GRAM:                                  # hashes of 2, 4, .. GRAM words
        g = _mix(g[:-step] * np.uint64(0x9E3779B97F4A7C15) + g[step:] + np.uint64(step))
        step *= 2
    at = np.arange(len(g))
    width, span = window - GRAM + 1, 1
    while span < width:                                 # least of 2, 4, .. width groups
        step = min(span, width - span)
        left, right = g[:-step], g[step:]
        take = left <= right
        g, at = np.where(take, left, right), np.where(take, at[:-step], at[step:])
        span += step
    return at, g


class _Batch:
    """Windows of a batch of documents, prefixes found over all of them at once."""

    def __init__(self, texts, window: int, hashes: dict):
        if len(hashes) > 200_000:
            hashes.clear()
        self.words = [words_of(t) for t in texts]
        size = np.array([len(w) for w in self.words])
        self.first = np.concatenate([[0], np.cumsum(size)])
        flat = np.concatenate([np.fromiter(map(hashes.__getitem__, w), np.uint64, len(w)) for w in self.words]
                              + [np.zeros(0, np.uint64)])
        if len(flat) < window:
            self.start = self.at = self.doc = np.zeros(0, np.int64)
            self.hash = np.zeros(0, np.int64)
            return
        at, g = prefixes(flat, window)
        windows = np.maximum(size - window + 1, 0)
        self.doc = np.repeat(np.arange(len(size)), windows)
        self.start = np.arange(len(self.doc)) + np.repeat(self.first[:-1] - np.cumsum(windows) + windows, windows)
        self.at, self.hash = at[self.start], g[self.start].view(np.int64)


def frequent(docs: DataFrame, window: int) -> np.ndarray:
    """Sorted hashes of the prefixes that many documents of a bounded sample hold."""
    n = max(1, docs.count())
    sample = docs.where((F.xxhash64(F.lit("often"), "doc") + 2.0**63) / 2.0**64 < SAMPLE / n).limit(2 * SAMPLE)
    found = (anchors(sample, window, np.zeros(0, np.int64)).groupBy("h")
             .agg(F.countDistinct("doc").alias("c")).where(F.col("c") >= OFTEN).select("h").collect())
    return np.sort(np.array([r["h"] for r in found], np.int64))


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def anchors(docs: DataFrame, window: int, often: np.ndarray) -> DataFrame:
    """(h, doc, pos): each document's prefixes and where they begin, those in ``often`` left out."""
    def run(batches):
        hashes = _Hashes()
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                x = _Batch(part.column(1).to_pylist(), window, hashes)
                new = np.ones(len(x.at), bool)
                new[1:] = (x.at[1:] != x.at[:-1])
                new &= ~_member(often, x.hash)
                at, doc = x.at[new], x.doc[new]
                ids = part.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.hash[new]), pa.array(ids[doc]), pa.array((at - x.first[doc]).astype(np.int32))],
                    ["h", "doc", "pos"])

    return docs.mapInArrow(run, "h long, doc long, pos int")


def suffixes(docs: DataFrame, window: int, often: np.ndarray) -> DataFrame:
    """Rows for the trees from (doc, text, places): runs of words around repeated prefixes,
    and whole windows where the prefix is very frequent (in ``often``, or its place negative)."""
    def run(batches):
        hashes = _Hashes()
        held: dict[bytes, tuple[int, int]] = {}         # earliest of each frequent window so far
        out: list[tuple] = []

        def flush():
            for key, (doc, s) in held.items():
                hi, lo = np.frombuffer(key, np.int64).tolist()
                out.append((_WINDOW, hi, lo, doc, s, 1, None))
            held.clear()

        def send():
            cols = list(zip(*out)) or [()] * 7
            out.clear()
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              ["kind", "key", "key2", "doc", "s", "n", "body"])

        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                x = _Batch(part.column(1).to_pylist(), window, hashes)
                ids, places = part.column(0).to_pylist(), part.column(2).to_pylist()
                # first and last window of each prefix place
                head = np.flatnonzero(np.diff(x.at, prepend=-1)) if len(x.at) else np.zeros(0, np.int64)
                ends = np.append(head[1:], len(x.at))
                run_doc, run_pos = x.doc[head], x.at[head] - x.first[x.doc[head]]
                bounds = np.searchsorted(run_doc, np.arange(len(ids) + 1))
                known = _member(often, x.hash[head])
                for d, (doc, own) in enumerate(zip(ids, places)):
                    w, base = x.words[d], x.first[d]
                    own = np.array(own or [], np.int64)
                    pos = np.where(own < 0, ~own, own)
                    i = bounds[d] + np.searchsorted(run_pos[bounds[d]:bounds[d + 1]], pos)
                    far = bounds[d] + np.flatnonzero(known[bounds[d]:bounds[d + 1]])
                    for r, whole in [*zip(i.tolist(), (own < 0).tolist()), *((r, True) for r in far.tolist())]:
                        s, n = int(x.start[head[r]] - base), int(ends[r] - head[r])
                        if not whole:
                            out.append((_RUN, int(x.hash[head[r]]), 0, doc, s, n,
                                        b" ".join(w[s:s + n + window - 1])))
                            continue
                        for s in range(s, s + n):
                            key = xxhash.xxh3_128_digest(b" ".join(w[s:s + window]))
                            here, there = (doc, s), held.get(key)
                            if there is None or here < there:
                                held[key] = here
                                here = there
                            if here is not None:
                                out.append((_REPEAT, here[0] * 0x9E3779B1 % 2**62, 0, here[0], here[1], 1, None))
                    if len(held) > HELD_WINDOWS:
                        flush()
                    if len(out) > 20_000:
                        yield send()
        flush()
        yield send()

    return docs.mapInArrow(run, _ROW)


def _repeats(doc, s, n, bodies, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of windows under deep nodes of a group's tree, the earliest of a node left out."""
    code: dict[bytes, int] = {}
    words = [code.setdefault(w, len(code)) for b in bodies for w in b.split(b" ")]
    flat = np.array(words, np.int64)
    n = np.asarray(n)
    first = np.concatenate([[0], np.cumsum(n + window - 1)])[:-1]
    row = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    begin = first[row] + step
    # three words to a number, so that a suffix is compared in few steps
    bits = max(1, len(code).bit_length())
    per = 62 // bits
    cols = []
    for lo in range(0, window, per):
        c = flat[begin + lo]
        for k in range(lo + 1, min(lo + per, window)):
            c = (c << bits) | flat[begin + k]
        cols.append(c)
    own_doc, own_s = np.asarray(doc)[row], np.asarray(s)[row] + step
    order = np.lexsort((own_s, own_doc, *cols[::-1]))
    deep = np.ones(len(order), bool)                    # shares a node of depth >= window with the one before
    deep[:1] = False
    for c in cols:
        deep[1:] &= c[order[1:]] == c[order[:-1]]
    hit = order[deep]
    return own_doc[hit], own_s[hit]


def tree_repeats(rows: DataFrame, window: int) -> DataFrame:
    """(doc, s, e): repeated windows from s to e, from rows of ``suffixes`` sorted by key."""
    def intervals(doc, s):
        if not len(doc):
            return None
        order = np.lexsort((s, doc))
        doc, s = doc[order], s[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (s[1:] > s[:-1] + 1)
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(doc)) - 1
        return pa.RecordBatch.from_arrays([pa.array(doc[at], pa.int64()), pa.array(s[at].astype(np.int32)),
                                           pa.array(s[last].astype(np.int32))], ["doc", "s", "e"])

    def run(batches):
        held: list[tuple] = []                          # runs of whole prefixes, and of the current one
        before = None                                   # the last whole window
        for b in batches:
            kind, doc, s = (b.column(c).to_numpy() for c in ("kind", "doc", "s"))
            key, key2 = b.column("key").to_numpy(), b.column("key2").to_numpy()
            is_run = np.flatnonzero(kind == _RUN)
            if len(is_run):
                part = b.take(pa.array(is_run))
                held += zip(*(part.column(c).to_pylist() for c in ("key", "doc", "s", "n", "body")))
                while len(held) >= GROUP_RUNS and held[0][0] != held[-1][0]:
                    cut = min(len(held), 2 * GROUP_RUNS) - 1
                    last = held[cut][0]
                    while cut and held[cut - 1][0] == last:
                        cut -= 1
                    if not cut:
                        break
                    _, d, t, n, body = zip(*held[:cut])
                    held = held[cut:]
                    if (r := intervals(*_repeats(d, t, n, body, window))) is not None:
                        yield r
            w = np.flatnonzero(kind == _WINDOW)
            if len(w):
                keys = np.stack([key[w], key2[w]], 1)
                prev = np.concatenate([[before if before is not None else (0, 0)], keys[:-1]])
                same = (keys == prev).all(axis=1)
                same[0] &= before is not None
                before = tuple(keys[-1].tolist())
                if (r := intervals(doc[w][same], s[w][same])) is not None:
                    yield r
            if (r := intervals(doc[kind == _REPEAT], s[kind == _REPEAT])) is not None:
                yield r
        if held:
            _, d, t, n, body = zip(*held)
            if (r := intervals(*_repeats(d, t, n, body, window))) is not None:
                yield r

    return rows.mapInArrow(run, "doc long, s int, e int")


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((doc, text) with unique doc in the order of documents; input rows by their doc).

    ``doc`` is doc_id itself where that names one row each. Only if ids repeat or are missing,
    distinct (doc_id, text) pairs are numbered in order.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    odd = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count()
    if not odd:
        rows = rows.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("doc"), "text")
        return rows, rows
    h = F.xxhash64("text")
    keys = rows.select("doc_id", h.alias("h")).distinct().orderBy(F.col("doc_id").asc_nulls_last(), "h")
    number = written(keys.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1])).toDF(
        "_i long, _h long, doc long"), "sub-order")
    full = rows.withColumn("h", h).join(number, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("h") == F.col("_h")))
    full = written(full.select("doc", "doc_id", "text"), "sub-docs")
    return full.groupBy("doc").agg(F.first("text").alias("text")), full


def repeated_windows(docs: DataFrame, window: int = 20) -> DataFrame:
    """(doc, places: array<struct<s, e>>): starts s..e of repeated windows, of (doc, text) rows."""
    often = frequent(docs, window)
    a = anchors(docs, window, often)
    again = a.groupBy("h").agg(F.count("*").alias("c")).where("c > 1")
    at = F.when(F.col("c") > MAX_RUNS, -F.col("pos") - 1).otherwise(F.col("pos"))
    places = a.join(again, "h").groupBy("doc").agg(F.collect_list(at).alias("places"))
    rows = suffixes(docs.join(places, "doc", "left").select("doc", "text", "places"), window, often)
    rows = rows.repartition("key").sortWithinPartitions("kind", "key", "key2", "doc", "s")
    return (tree_repeats(rows, window).groupBy("doc")
            .agg(F.collect_list(F.struct("s", "e")).alias("places")))


def without_repeats(docs: DataFrame, window: int = 20, with_text: bool = True) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, removed (word ranges, end exclusive)
    and, if ``with_text``, kept (the words that stay, joined by one space)."""
    unique, rows = numbered(docs)
    found = repeated_windows(unique, window)
    schema = ("doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<s:int,e:int>>"
              + (", kept string" if with_text else ""))
    pair = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                n, gone, sha, cut, kept = [], [], [], [], []
                for text, places in zip(part.column("text").to_pylist(), part.column("places").to_pylist()):
                    w = words_of(text)
                    ranges = []
                    for p in sorted((p["s"], p["e"] + window) for p in places or ()):
                        if ranges and p[0] <= ranges[-1][1]:
                            ranges[-1][1] = max(ranges[-1][1], p[1])
                        else:
                            ranges.append(list(p))
                    stay, at = [], 0
                    for s, e in ranges:
                        stay += w[at:s]
                        at = e
                    stay += w[at:]
                    own = b" ".join(stay)
                    n.append(len(w))
                    gone.append(len(w) - len(stay))
                    sha.append(hashlib.sha256(own).hexdigest())
                    cut.append([{"s": s, "e": e} for s, e in ranges])
                    kept.append(own.decode("utf-8", "surrogatepass"))
                cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                        pa.array(sha, pa.string()), pa.array(cut, pair)]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"]
                if with_text:
                    cols.append(pa.array(kept, pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(cols, names)

    own = F.col("doc_id" if "doc_id" in rows.columns else "doc").alias("doc_id")
    return rows.join(found, "doc", "left").select(own, "text", "places").mapInArrow(run, schema)
