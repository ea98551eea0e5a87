"""Token counts of whole texts; huge documents in overlapping chunks that are spliced again.

A document of more than ``whole_chars`` characters is cut into units of ``chunk_chars``; each unit
is encoded on its own, with its offsets, together with the ``overlap`` characters that
follow it. Units are rows, so the chunks of one document run in many tasks. At each junction the two
encodings are spliced at the first place in the overlap where both begin a pre-token.

Why such a place is stable: a byte-level pre-token is matched from where the last one ended,
looks ahead at most two characters, never back, and merges stay inside it; strings of added tokens
are found first, wherever they stand. So what follows a common beginning is the same in both
encodings up to the end of the shorter chunk, less the longest added token and that look-ahead; these last
characters of a chunk are never used. A unit's share is the number of its tokens between its two places,
and the shares of a document add up to the count of its whole text.

Where the overlap holds no common beginning (one pre-token may be longer than it), the pieces
on both sides are put together, which widens their overlap to a whole chunk, the overlap behind them grows
fourfold, and only they are encoded again; this goes on until every junction is spliced.
Tokenizers for which the above is not proven (anything but plain byte-level pre-tokens, or added
tokens that take white space with them) and sentencepiece models encode each text whole.

Nulls, ties, edges: a null or empty text has no bytes and no tokens; rows that repeat a doc_id
are counted each; a null doc_id stays; an empty table gives no row; strings of added tokens inside a text
are those tokens, as the library does by default; other columns are not read.
"""
from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import written
from hirelens.llm.token_cache import CachedTokenizer

_CUT = "doc_id long, n_bytes long, n_tokens long, uid string, unit int, last boolean, body string, ahead string"
_PIECE = ("uid string, a int, b int, last boolean, total long, left array<struct<at: int, n: long>>, "
          "right array<struct<at: int, n: long>>")
# Longest look-ahead of a byte-level pre-token (a contraction such as 're), and one to spare.
_LOOK = 3


class Counter:
    """Counts and pre-token places of one tokenizer file, as its library gives them."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.margin = None                              # None: chunks can't be spliced
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.counts = lambda texts: [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
        pre, added = self.tok.pre_tokenizer, self.tok.get_added_tokens_decoder().values()
        if (self.tok.normalizer is None and type(pre).__name__ == "ByteLevel" and pre.use_regex and not pre.add_prefix_space
                and not any(t.lstrip or t.rstrip or t.single_word for t in added)):
            self.margin = _LOOK + max((len(t.content) for t in added), default=0)
            cached = CachedTokenizer(path)
            self.counts = lambda texts: [len(x) // 4 for x in cached.encode_batch(texts)]

    def places(self, text: str) -> tuple[list[tuple[int, int]], int]:
        """((character, tokens before it) where a pre-token begins, number of tokens)."""
        e = self.tok.encode(text, add_special_tokens=False)
        out, last = [], None
        for i, (w, (at, _)) in enumerate(zip(e.word_ids, e.offsets)):
            if w != last:
                out.append((at, i))
                last = w
        return out, len(e)


def _cut(docs: DataFrame, tokenizer: str, whole: int, chunk: int, overlap: int) -> DataFrame:
    """A row with its count per document of up to ``whole`` characters; a row per unit of any other,
    the first of which has the document's number of bytes."""
    def run(batches):
        counter = Counter(tokenizer)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                huge = [counter.margin is not None and len(t) > whole for t in texts]
                counts = iter(counter.counts([t for t, h in zip(texts, huge) if not h]))
                rows, held = [], 0
                for d, t, h, size in zip(part.column(0).to_pylist(), texts, huge, part.column(2).to_pylist()):
                    if not h:
                        rows.append((d, size, next(counts), None, None, None, None, None))
                        continue
                    uid, n = uuid.uuid4().hex, max(1, len(t) // chunk)
                    for u in range(n):
                        end = (u + 1) * chunk if u < n - 1 else len(t)         # the last unit takes the rest
                        rows.append((d, size, None, uid, u, u == n - 1, t[u * chunk:end], t[end:end + overlap]))
                        held += chunk + overlap
                        if held > 1 << 22:
                            yield _batch(rows, _CUT_TYPES)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, _CUT_TYPES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")).mapInArrow(run, _CUT)


_CUT_TYPES = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("uid", pa.string()),
                        ("unit", pa.int32()), ("last", pa.bool_()), ("body", pa.string()), ("ahead", pa.string())])
_LIST = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int64())]))
_PIECE_TYPES = pa.schema([("uid", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("last", pa.bool_()),
                          ("total", pa.int64()), ("left", _LIST), ("right", _LIST)])


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _encode(pieces: DataFrame, tokenizer: str, overlap: int) -> DataFrame:
    """Pieces (uid, a, b, last, body, ahead) -> their tokens, the places in the overlap with the piece before
    (``left``) and behind (``right``), as characters from the junction and tokens before."""
    def run(batches):
        counter = Counter(tokenizer)
        for b in batches:
            for i in range(b.num_rows):
                uid, lo, hi, last, body, ahead = (c[i].as_py() for c in b.columns)
                places, total = counter.places(body + ahead)
                end = len(body) + len(ahead) - counter.margin
                left = [{"at": p, "n": n} for p, n in places if 0 < p <= overlap and (last or p <= end)] if lo else []
                right = [] if last else [{"at": p - len(body), "n": n} for p, n in places if len(body) < p <= end]
                yield _batch([(uid, lo, hi, last, total, left, right)], _PIECE_TYPES)

    return pieces.select("uid", "a", "b", "last", "body", "ahead").mapInArrow(run, _PIECE)


def _joined(pieces: DataFrame) -> DataFrame:
    """Each piece with its junction to the next one: ``cut``, the first common place (tokens of this
    piece before it, tokens of the next one before it), and ``open``: there is none."""
    nxt = pieces.select("uid", F.col("a").alias("b"), F.col("left").alias("next"))
    common = F.expr("filter(transform(right, r -> struct(r.n AS mine, get(filter(next, x -> x.at = r.at), 0).n AS theirs)), "
                    "c -> c.theirs IS NOT NULL)")
    return (pieces.join(nxt, ["uid", "b"], "left").withColumn("cut", F.try_element_at(common, F.lit(1)))
            .withColumn("open", ~F.col("last") & F.col("cut").isNull()).drop("next"))


def _runs(joined: DataFrame) -> DataFrame:
    """Maximal runs of pieces with open junctions between them, as (uid, a, b, last). The windows hold
    one narrow row per unit of one document."""
    along = Window.partitionBy("uid").orderBy("a")
    up = F.coalesce(F.lag("open").over(along), F.lit(False))
    p = joined.select("uid", "a", "b", "last", "open").withColumn("up", up).where(F.col("open") | F.col("up"))
    return (p.withColumn("run", F.count_if(~F.col("up")).over(along)).groupBy("uid", "run")
            .agg(F.min("a").alias("a"), F.max("b").alias("b"), F.max("last").alias("last")).drop("run"))


def _texts(runs: DataFrame, units: DataFrame, ahead: int) -> DataFrame:
    """Runs with their text and up to ``ahead`` characters (at most a unit) behind it."""
    own = runs.withColumn("unit", F.explode(F.sequence("a", "b"))).join(units.select("uid", "unit", "body"), ["uid", "unit"])
    text = F.expr("array_join(transform(array_sort(collect_list(struct(unit, body)) FILTER (WHERE unit < b)), x -> x.body), '')")
    behind = F.coalesce(F.max(F.when(F.col("unit") == F.col("b"), F.substring("body", 1, ahead))), F.lit(""))
    return own.groupBy("uid", "a", "b", "last").agg(text.alias("body"), behind.alias("ahead"))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512, whole_chars: int = 32768,
                 chunk_chars: int = 16384, overlap: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens of the whole text, over_limit
    (more than ``limit`` tokens).

    ``overlap`` is a first guess and must be smaller than ``chunk_chars``; junctions that it does not
    settle are widened, so no count depends on it.
    """
    if not 0 < overlap < chunk_chars:
        raise ValueError("overlap must be positive and smaller than chunk_chars")
    cut = written(_cut(docs, tokenizer, whole_chars, chunk_chars, overlap), "token-units")
    units = cut.where(F.col("uid").isNotNull())
    first = units.select("uid", F.col("unit").alias("a"), (F.col("unit") + 1).alias("b"), "last", "body", "ahead")
    # both sides of a junction read the encoded pieces, so they are written first
    done = written(_joined(written(_encode(first.repartition("uid", "a"), tokenizer, overlap), "token-encoded")), "token-pieces")
    wide = overlap
    while not done.where("open").isEmpty():
        wide = min(4 * wide, chunk_chars)
        runs = written(_runs(done), "token-runs")
        gone = runs.select("uid", F.explode(F.sequence(F.col("a"), F.col("b") - 1)).alias("a"))
        again = _encode(_texts(runs, units, wide), tokenizer, wide)
        kept = done.drop("cut", "open").join(gone, ["uid", "a"], "left_anti")
        done = written(_joined(written(kept.unionByName(again), "token-encoded")), "token-pieces")
    spliced = done.groupBy("uid").agg(
        F.sum(F.when(F.col("last"), F.col("total")).otherwise(F.col("cut.mine") - F.col("cut.theirs"))).alias("n_tokens"))
    huge = units.where(F.col("unit") == 0).select("uid", "doc_id", "n_bytes").join(spliced, "uid").drop("uid")
    out = cut.where(F.col("uid").isNull()).select("doc_id", "n_bytes", "n_tokens").unionByName(huge)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
