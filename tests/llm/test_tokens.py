"""Token ids, packing and record files against the tokenizers library and exact round trips."""
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hirelens.llm import binary_out, packing
from hirelens.llm.token_cache import CachedTokenizer

PARTS = ["a", "B", " ", "  ", "\n", "\t", " \n", "'s", "é", "é", "1", "23", ".", "!!", "\x1c", "漢", "😀", "́", "ß",
         "Σ", "<|endoftext|>", " x", "İ", "word.", "Word,\nNext", "x" * 50, " ", "\x0b", "\r\n"]


@pytest.mark.parametrize("name,wide", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_ids_equal_whole_text_ids(name, wide):
    rnd = random.Random(5)
    texts = ["".join(rnd.choices(PARTS, k=rnd.randint(0, 15))) for _ in range(5000)] + ["", None, "w " * 5000]
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    cached = CachedTokenizer(public_tokenizers.path(name), wide, max_bytes=100_000)
    want = [np.array(e.ids, "<u4" if wide else "<u2").tobytes()
            for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    got = [x for lo in range(0, len(texts), 100) for x in cached.encode_batch(texts[lo:lo + 100])]
    assert got == want


ROWS = [(3, "one two three"), (1, None), (2, ""), (5, "long text " * 2000), (4, "é ü " * 30), (9, "tail")]


def test_records_round_trip(spark, make_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = make_docs(ROWS + [(None, "no id"), (9, "tail")], extra=True).repartition(3)
    out = binary_out.write_records(docs, path)
    got = binary_out.read_records(spark, out).orderBy("start").collect()
    order = [(None, "no id")] + sorted(ROWS + [(9, "tail")], key=lambda r: r[0])
    at = 0
    for r, (d, text) in zip(got, order, strict=True):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        assert (r.doc_id, r.start, r.n_tokens, list(r.ids)) == (d, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    index = binary_out.read_index(spark, out)
    assert index.count() == len(order)
    some = {(r.doc_id, tuple(r.ids)) for r in binary_out.fetch(index.orderBy("length").limit(4)).collect()}
    assert some <= {(r.doc_id, tuple(r.ids)) for r in got} and some


def test_records_of_an_empty_table(spark, make_docs):
    out = binary_out.write_records(make_docs([]), public_tokenizers.path("word_bpe_49k.json"))
    assert binary_out.read_records(spark, out).count() == 0


def test_broken_records_are_noticed(tmp_path):
    rec = bytearray(binary_out.frame(b"abcdef"))
    for at in (0, 9, 13, len(rec) - 1):
        bad = bytearray(rec)
        bad[at] ^= 1
        p = tmp_path / f"r{at}"
        p.write_bytes(bad)
        with p.open("rb") as f, pytest.raises(ValueError):
            binary_out.read_record(f)


def test_packing(make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    docs = make_docs(ROWS + [(7, "many words here " * 900)], extra=True)
    rows = packing.pack(packing.pieces(docs, path, size=64), size=64).collect()
    seqs, own = {}, {}
    for r in rows:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
        own.setdefault(r.doc_id, []).append(r)
    for s in seqs.values():
        end = 0
        for o, n in sorted(s):
            assert o == end
            end += n
        assert end <= 64
    total = 0
    for d, text in ROWS + [(7, "many words here " * 900)]:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(own[d], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            assert k == 0 or r.length == 64
            at += r.length
        assert at == len(ids)
    assert len(seqs) <= total // 64 + 3


def test_packer_is_bounded_and_full():
    rnd = random.Random(1)
    sizes = [rnd.randint(1, 1024) for _ in range(20_000)]
    for open_ in (8, 4096):
        p = packing.Packer(1024, open_)
        fill = {}
        for n in sizes:
            s, o = p.put(n)
            assert o == fill.get(s, 0)
            fill[s] = o + n
            assert p.n_open <= open_ and fill[s] <= 1024
        assert len(fill) <= sum(sizes) / 1024 * (1.1 if open_ == 8 else 1.02)


def test_packing_an_empty_table(make_docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert packing.pack(packing.pieces(make_docs([]), path)).collect() == []
