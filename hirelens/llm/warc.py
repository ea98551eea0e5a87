"""WARC archives of web pages: writing with revisit records, sequential reading.

Writing: one gzip member per record. Of records with equal payloads of at least
``min_revisit`` bytes the one with the largest page_id is a response; the others are
revisits that refer to it and hold only the HTTP header. Each task streams its rows into
archives of a new name (a new one past ``max_bytes``); finished ones are in a manifest.

Reading: an archive is read in steps of 64 KB through an incremental decompressor, records
are framed by Content-Length, and the block and payload digests are verified while the
bytes pass. An error names the archive and the record. Archives of other writers may hold records of other types
(passed over), lack digests or use other ids.

Nulls, ties, edges: a null html is an empty payload; a null url leaves out the target URI; a
null page_id refers to others but is never referred to; rows that repeat a page_id and its
payload are responses together or revisits together; an empty table gives no record.
Characters not allowed in a URI are percent-encoded. Other columns are not read.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import open_fs, shared_dir

_MANIFEST = "archive string, n_records long"
_STEP = 1 << 16
_ID = "urn:page:"
# Profile of a revisit, and the WARC version line.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"


def _b32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _uri(url: str) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=-._~")


def make_record(page_id, url, payload: bytes, sha1_hex: str, refers_to, date: str) -> bytes:
    """One gzip member; a revisit if ``refers_to`` is given."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http + payload if refers_to is None else http
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{_b32(sha1_hex)}",
             f"WARC-Block-Digest: sha1:{_b32(hashlib.sha1(block).hexdigest())}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def revisits(pages: DataFrame, min_revisit: int) -> DataFrame:
    """(page_id, digest, refers_to) of the rows to write as revisits, one per pair of keys.

    Digests are aggregated before the shuffle and joined back to (page_id, digest) rows
    only, so a payload that a third of all pages share costs no more than its ids.
    """
    large = pages.where(F.col("n") >= min_revisit).select("page_id", "digest", "n")
    last = (large.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c"))
            .where("c > 1 AND refers_to IS NOT NULL").select("digest", "n", "refers_to"))
    return (large.join(last, ["digest", "n"]).where("page_id IS NULL OR page_id < refers_to")
            .select(F.col("page_id").alias("_p"), F.col("digest").alias("_d"), "refers_to").distinct())


def write_archives(pages: DataFrame, out_dir: str | None = None, min_revisit: int = 1000,
                   date: str = "1970-01-01T00:00:00Z", max_bytes: int = 1 << 30) -> str:
    """Write one record per row of ``pages`` (page_id, url, html); returns the folder."""
    spark = pages.sparkSession
    out_dir = out_dir or shared_dir(spark, "warc")
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("html"),
                        F.sha1(body.cast("binary")).alias("digest"), F.octet_length(body).alias("n"))
    again = revisits(rows, min_revisit)
    rows = rows.join(again, rows["page_id"].eqNullSafe(again["_p"]) & (rows["digest"] == again["_d"]), "left")

    def write(batches):
        fs, root = open_fs(out_dir)
        fs.create_dir(root, recursive=True)
        f = name = None
        n = size = 0
        for b in batches:
            for r in b.to_pylist():
                if f is None:
                    name = f"pages-{uuid.uuid4().hex}.warc.gz"
                    f, n, size = fs.open_output_stream(f"{root}/{name}", compression=None, buffer_size=1 << 20), 0, 0
                rec = make_record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["refers_to"], date)
                f.write(rec)
                n += 1
                size += len(rec)
                if size >= max_bytes:
                    f.close()
                    f = None
                    yield pa.RecordBatch.from_pydict({"archive": [f"{out_dir}/{name}"], "n_records": [n]})
        if f is not None:
            f.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{out_dir}/{name}"], "n_records": [n]})

    (rows.select("page_id", "url", "html", "digest", "refers_to")
     .mapInArrow(write, _MANIFEST).write.parquet(f"{out_dir}/manifest"))
    return out_dir


class _Stream:
    """Decompressed bytes of an archive, member by member."""

    def __init__(self, f):
        self.f, self.z, self.raw, self.buf, self.end = f, None, b"", b"", False

    def next_member(self) -> bool:
        """Begin the next member; False at the end of the archive."""
        if not self.raw:
            self.raw = self.f.read(_STEP)
        self.z, self.buf, self.end = zlib.decompressobj(31), b"", False
        return bool(self.raw)

    def more(self) -> bool:
        """Decompress one more step into ``buf``; False when the member has ended."""
        if self.end:
            return False
        if not self.raw:
            self.raw = self.f.read(_STEP)
        got = self.z.decompress(self.raw, _STEP)
        if not (self.raw or got or self.z.eof):
            raise ValueError("archive ends inside a member")
        self.buf += got
        if self.z.eof:
            self.raw, self.end = self.z.unused_data, True
        else:
            self.raw = self.z.unconsumed_tail
        return True

    def until(self, mark: bytes) -> bytes:
        while mark not in self.buf:
            if not self.more():
                raise ValueError("member ends inside a header")
        head, _, self.buf = self.buf.partition(mark)
        return head

    def take(self, n: int):
        """The next ``n`` bytes, in pieces."""
        while n:
            if not self.buf and not self.more():
                raise ValueError("member ends inside a block")
            piece, self.buf = self.buf[:n], self.buf[n:]
            n -= len(piece)
            yield piece


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}


def _page(uri: str | None) -> int | None:
    """The page of an id that this module wrote; None for any other."""
    number = (uri or "").strip("<>").removeprefix(_ID)
    return int(number) if (uri or "").strip("<>").startswith(_ID) and number else None


def _sha1(value: str | None) -> str | None:
    """Hex form of a SHA-1 digest given in base 32 or hex; None if there is none or of another kind."""
    kind, _, text = (value or "").partition(":")
    if kind.strip().lower().replace("-", "") != "sha1":
        return None
    text = text.strip()
    return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()


def records(f, with_payload: bool = False):
    """Responses, revisits and resources of an open archive, in order; ValueError at the first record that
    doesn't verify. Records of other types are verified and passed over. Digests are checked where a
    record has SHA-1 ones; the payload's only where no transfer coding changes its bytes."""
    s, k = _Stream(f), 0
    while s.next_member():
        try:
            head = s.until(b"\r\n\r\n")
            if not head.startswith(b"WARC/1."):
                raise ValueError("no WARC header")
            h = _fields(head)
            kind, left = h["warc-type"].lower(), int(h["content-length"])
            block, payload, kept, http, n = hashlib.sha1(), hashlib.sha1(), [], b"", 0
            # other blocks than HTTP messages are payload as they stand
            inside = not h.get("content-type", "").lower().startswith("application/http")
            for piece in s.take(left):
                block.update(piece)
                if not inside:
                    http += piece
                    at = http.find(b"\r\n\r\n")
                    if at < 0:
                        continue
                    inside, piece = True, http[at + 4:]
                    http = http[:at]
                payload.update(piece)
                n += len(piece)
                if with_payload and kind in ("response", "resource"):
                    kept.append(piece)
            after = s.until(b"\r\n\r\n")
            while s.more():
                pass
            if after or s.buf:
                raise ValueError("block is not followed by the record's end")
            if _sha1(h.get("warc-block-digest")) not in (None, block.hexdigest()):
                raise ValueError("block digest differs")
            full, message = _sha1(h.get("warc-payload-digest")), _fields(http)
            length = n
            if message.get("content-length", "").isdecimal():
                length = int(message["content-length"])
            whole = kind in ("response", "resource")
            if whole and "transfer-encoding" not in message and (full not in (None, payload.hexdigest()) or length != n):
                raise ValueError("payload digest or length differs")
            if whole:
                full, length = full or payload.hexdigest(), n
            if whole or kind == "revisit":
                yield {"page_id": _page(h["warc-record-id"]), "url": h.get("warc-target-uri"),
                       "payload_bytes": length, "payload_digest": full,
                       "record_type": kind, "refers_to": _page(h.get("warc-refers-to")),
                       "record_id": h["warc-record-id"].strip("<>"), "refers_to_id": (h.get("warc-refers-to") or "").strip("<>") or None,
                       **({"payload": b"".join(kept) if whole else None} if with_payload else {})}
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"record {k}: {e}") from e
        k += 1


_COLUMNS = {"page_id": (pa.int64(), "long"), "url": (pa.string(), "string"), "payload_bytes": (pa.int64(), "long"),
            "payload_digest": (pa.string(), "string"), "record_type": (pa.string(), "string"), "refers_to": (pa.int64(), "long"),
            "record_id": (pa.string(), "string"), "refers_to_id": (pa.string(), "string"), "payload": (pa.binary(), "binary")}


def _read(archives: DataFrame, names: list[str]) -> DataFrame:
    """The named columns of every record of ``archives`` (archive: path or URI); one task streams an archive."""
    def read(batches):
        for b in batches:
            for path in b.column("archive").to_pylist():
                fs, p = open_fs(path)
                with fs.open_input_stream(p, compression=None) as f:
                    rows, held = [], 0
                    try:
                        for r in records(f, "payload" in names):
                            rows.append(r)
                            held += 300 + len(r.get("payload") or b"")
                            if held > 1 << 22:
                                yield batch(rows)
                                rows, held = [], 0
                    except ValueError as e:
                        raise ValueError(f"{path}: {e}") from e
                    if rows:
                        yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], _COLUMNS[c][0]) for c in names], names)

    schema = ", ".join(f"{c} {_COLUMNS[c][1]}" for c in names)
    return archives.repartition(max(1, 2 * archives.count()), "archive").mapInArrow(read, schema)


def read_archives(spark: SparkSession, out_dir: str, with_payload: bool = True) -> DataFrame:
    """Every record of the archives in the manifest: page_id, url, payload_bytes,
    payload_digest (hex SHA-1), record_type, refers_to and, if asked for, payload."""
    m = spark.read.schema(_MANIFEST).parquet(f"{out_dir}/manifest").select("archive")
    return _read(m, ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload)


def read_files(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Responses, revisits and resources of archives of any origin (a column ``archive`` of paths or URIs):
    as read_archives, page ids being null where another writer gave the ids, with record_id and refers_to_id."""
    return _read(archives.select("archive"), [c for c in _COLUMNS if with_payload or c != "payload"])
