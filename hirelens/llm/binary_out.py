"""Token ids as length-delimited binary records, with an index for shuffled reads.

A shard holds the records of one range of ``doc_id``, ascending. A record is

    length of the body (8 bytes) | masked CRC-32 of those 8 bytes (4)
    body                         | masked CRC-32 of the body (4)

and a body is: flags (1 byte; 1: doc_id is null, 2: ids are 4 bytes wide), doc_id (8),
then the ids. All numbers are little-endian. The masked checksum rotates the CRC right by
15 bits and adds 0xA282EAD8. The index beside a shard has one entry of 3 x 8 bytes per
record: its offset, its length with frame, its number of ids.

Nulls, ties, edges: a null or empty text is a record with the end id alone; a null doc_id
sorts first; rows that repeat a doc_id are records of their own, ordered by text; an
empty table gives no record. Columns other than doc_id and text are not read.
"""
from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens.llm.common import open_fs, shared_dir
from hirelens.llm.token_cache import CachedTokenizer

_MANIFEST = "shard int, path string, n_records long, n_ids long"
_BODY = "<Bq"
# Fixed value: the constant of the masked checksum of this record format.
_MASK_DELTA = 0xA282EAD8


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + _MASK_DELTA) & 0xFFFFFFFF


def frame(body: bytes) -> bytes:
    n = struct.pack("<Q", len(body))
    return b"".join((n, struct.pack("<I", masked_crc(n)), body, struct.pack("<I", masked_crc(body))))


def read_record(f) -> bytes | None:
    """The next body of an open shard, None at its end; ValueError if a checksum fails."""
    head = f.read(12)
    if not head:
        return None
    if len(head) < 12:
        raise ValueError("record file ends inside a frame")
    n, crc = struct.unpack("<QI", head)
    if masked_crc(head[:8]) != crc:
        raise ValueError("length checksum differs")
    rest = f.read(n + 4)
    if len(rest) < n + 4:
        raise ValueError("record file ends inside a record")
    body = rest[:n]
    if masked_crc(body) != struct.unpack("<I", rest[n:])[0]:
        raise ValueError("body checksum differs")
    return body


def parse_body(body: bytes) -> tuple[int | None, np.ndarray]:
    flags, doc_id = struct.unpack_from(_BODY, body)
    ids = np.frombuffer(body, "<u4" if flags & 2 else "<u2", offset=struct.calcsize(_BODY))
    return (None if flags & 1 else doc_id), ids


def write_records(docs: DataFrame, tokenizer: str, out_dir: str | None = None, end_id: int = 2,
                  wide: bool = False) -> str:
    """Encode ``text``, append ``end_id``, write shards in ascending doc_id order.

    ``wide`` stores ids in 4 bytes (needed for vocabularies over 65,536). Each task
    streams its range into a file of a new name; only names of finished tasks get into
    the manifest (Parquet, committed by Spark), so a lost or repeated task leaves at most
    an unlisted file. Returns the folder.
    """
    spark = docs.sparkSession
    out_dir = out_dir or shared_dir(spark, "records")
    code = "<u4" if wide else "<u2"

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        tok = CachedTokenizer(tokenizer, wide)
        end = np.array([end_id], code).tobytes()
        fs, root = open_fs(out_dir)
        fs.create_dir(root, recursive=True)
        name = f"shard-{shard:06d}-{uuid.uuid4().hex[:8]}.rec"
        data = index = None
        at = n = n_ids = 0
        for b in batches:
            if data is None and b.num_rows:
                data = fs.open_output_stream(f"{root}/{name}")
                index = fs.open_output_stream(f"{root}/{name}.idx")
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                ids = tok.encode_batch(part.column(1).to_pylist())
                rec, idx = [], []
                for d, x in zip(part.column(0).to_pylist(), ids):
                    x += end
                    body = struct.pack(_BODY, (d is None) | wide << 1, d or 0) + x
                    rec.append(frame(body))
                    k = len(x) // (4 if wide else 2)
                    idx.append(struct.pack("<QQQ", at, len(body) + 16, k))
                    at += len(body) + 16
                    n += 1
                    n_ids += k
                data.write(b"".join(rec))
                index.write(b"".join(idx))
        if data is not None:
            data.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "path": [f"{out_dir}/{name}"],
                 "n_records": [n], "n_ids": [n_ids]})

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(write, _MANIFEST).write.parquet(f"{out_dir}/manifest"))
    return out_dir


def shards(spark: SparkSession, out_dir: str) -> DataFrame:
    """The manifest with the number of ids before each shard: one row per shard."""
    m = spark.read.schema(_MANIFEST).parquet(f"{out_dir}/manifest")
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return m.withColumn("start", F.coalesce(before, F.lit(0).cast("long")))


def read_records(spark: SparkSession, out_dir: str, with_ids: bool = True) -> DataFrame:
    """Read every record back: doc_id, start (ids before it), n_tokens, ids_crc32 (over the
    ids as 4-byte integers) and, if ``with_ids``, ids as array<int>."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")

    def read(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                fs, p = open_fs(path)
                with fs.open_input_stream(p, buffer_size=1 << 20) as f:
                    rows, held = [], 0
                    while True:
                        body = read_record(f)
                        if body is not None:
                            d, ids = parse_body(body)
                            row = (d, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                            rows.append(row + (ids.astype("i4"),) * with_ids)
                            start += len(ids)
                            held += len(ids) * with_ids + 16
                        if rows and (body is None or held > 1 << 21):
                            cols = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]]
                            names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                            if with_ids:
                                cols.append(pa.array([r[4] for r in rows], pa.list_(pa.int32())))
                                names.append("ids")
                            yield pa.RecordBatch.from_arrays(cols, names)
                            rows, held = [], 0
                        if body is None:
                            break

    m = shards(spark, out_dir).select("shard", "path", "start")
    return m.repartition(max(1, 2 * m.count()), "shard").select("path", "start").mapInArrow(read, schema)


def read_index(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per record (path, offset, length, n_ids), for shuffled reads with ``fetch``."""
    def read(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, p = open_fs(path + ".idx")
                with fs.open_input_stream(p, buffer_size=1 << 20) as f:
                    while raw := f.read(24 << 13):
                        e = np.frombuffer(raw, "<u8").astype("i8").reshape(-1, 3)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([path] * len(e)), *(pa.array(e[:, i]) for i in range(3))],
                            ["path", "offset", "length", "n_ids"])

    m = shards(spark, out_dir).select("shard", "path")
    return m.repartition(max(1, 2 * m.count()), "shard").select("path").mapInArrow(
        read, "path string, offset long, length long, n_ids long")


def fetch(index: DataFrame) -> DataFrame:
    """Read the records that ``index`` rows name, in their order within each partition."""
    def read(batches):
        for b in batches:
            docs, ids, files = [], [], {}
            for path, off in zip(b.column("path").to_pylist(), b.column("offset").to_pylist()):
                if path not in files:
                    fs, p = open_fs(path)
                    files[path] = fs.open_input_file(p)
                files[path].seek(off)
                d, x = parse_body(read_record(files[path]))
                docs.append(d)
                ids.append(x.astype("i4"))
            for f in files.values():
                f.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return index.select("path", "offset").mapInArrow(read, "doc_id long, ids array<int>")
