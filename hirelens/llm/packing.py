"""Best-fit packing of documents into sequences of a fixed number of tokens.

Bounded-space best-fit: a packer keeps at most ``max_open`` open sequences, found by
their free space through a bitset (bit f set: some open sequence has f tokens free). A
piece goes to the fullest sequence that it fits; if all are open and none fits, the
fullest one closes. Pieces are dealt to packers by document and each packer takes its
pieces longest first, so a packer's memory is the bitset and the open sequences.

Only documents longer than a sequence are cut: the first piece takes what is left over
by the full ones. Nulls, ties, edges: a null or empty text is a piece with the end id
alone; a repeated row is packed once per row; a null doc_id is kept; an empty table gives
no row. Other columns are not read.
"""
from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelens.llm.token_cache import CachedTokenizer

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` tokens."""
    first = n if n <= size else (n % size or size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2,
           with_ids: bool = False, cache_bytes: int = 40 << 20) -> DataFrame:
    """Encode each ``text``, append ``end_id`` and cut: one row per piece (without
    ``with_ids`` the ids stay in the task that made them). ``cache_bytes`` bounds what a
    worker remembers of the chunks it has met; it moves no id."""
    def encode(batches):
        tok = CachedTokenizer(tokenizer, max_bytes=cache_bytes)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                rows, ids = [], []
                for d, x in zip(part.column(0).to_pylist(), tok.encode_batch(part.column(1).to_pylist())):
                    x += end
                    for k, (s, n) in enumerate(cut(len(x) // 4, size)):
                        own = x[4 * s:4 * (s + n)]
                        rows.append((d, k, s, n, zlib.crc32(own)))
                        if with_ids:
                            ids.append(np.frombuffer(own, "<i4"))
                d, k, s, n, c = zip(*rows)
                cols = [pa.array(d, pa.int64()), pa.array(k, pa.int32()), pa.array(s, pa.int64()),
                        pa.array(n, pa.int64()), pa.array(c, pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, schema)


class Packer:
    """Bounded-space best-fit over lengths 1..size. ``put`` gives (sequence, offset)."""

    def __init__(self, size: int, max_open: int = 4096):
        self.size, self.max_open = size, max_open
        self.bits = 0                                   # bit f: a sequence with f free is open
        self.open: list[list[int]] = [[] for _ in range(size + 1)]
        self.n_open = self.n = 0

    def put(self, length: int) -> tuple[int, int]:
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            seq = self.open[free].pop()
            if not self.open[free]:
                self.bits &= ~(1 << free)
            self.n_open -= 1
        else:
            if self.n_open == self.max_open:            # the fullest closes
                least = (self.bits & -self.bits).bit_length() - 1
                self.open[least].pop(0)
                if not self.open[least]:
                    self.bits &= ~(1 << least)
                self.n_open -= 1
            seq, free = self.n, self.size
            self.n += 1
        left = free - length
        if left:
            self.open[left].append(seq)
            self.bits |= 1 << left
            self.n_open += 1
        return seq, self.size - free


def pack(pieces: DataFrame, size: int = 1024, max_open: int = 4096) -> DataFrame:
    """Add sequence_id and offset to rows that have doc_id, piece and length (1..size).

    Sequence ids are the packer's number times 2**40 plus its own count. Each packer's
    pieces are sorted in its task, so a task that runs again gives the same rows.
    """
    out = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()),
                        T.StructField("offset", T.LongType())])

    def run(batches):
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        packer = Packer(size, max_open)
        for b in batches:
            got = [packer.put(n) for n in b.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([base + s for s, _ in got], pa.int64()),
                 pa.array([o for _, o in got], pa.int64())], out.names)

    rest = [c for c in ("start", "ids_crc32") if c in pieces.columns]
    dealt = pieces.hint("rebalance", "doc_id", "piece")
    return dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece", *rest).mapInArrow(run, out)
