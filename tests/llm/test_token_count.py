import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hirelens.llm import token_count

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "B", " ", "  ", "\n", "\t", " \n", "'s", "'re", "'", "é", "1", "23", ".", "!!", "\x1c", "漢", "😀", "l", "<|end",
         "<|endoftext|>", " x", "word.", "Word,\nNext", "x" * 50, " "]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = [(i, "".join(rnd.choices(PARTS, k=rnd.randint(0, 900)))) for i in range(60)]
    # one pre-token longer than overlap and chunk; runs of spaces; added tokens across junctions
    out += [(100, "z" * 5000), (101, " " * 4000), (102, "ab " * 30 + "q" * 900 + " cd" * 100), (103, None), (104, ""),
            (105, "'" * 3000), (106, "<|endoftext|>" * 200), (None, "no id"), (107, "tail" * 9)]
    return out


def want(rows, limit, encode):
    return sorted(((i, len((t or "").encode()), n, n > limit) for i, t in rows for n in [encode(t or "")]), key=str)


def counts(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("whole,chunk,overlap", [(64, 32, 8), (300, 100, 40), (10**6, 500, 100)])
def test_spliced_counts_equal_whole_text_counts(spark, make_docs, rows, whole, chunk, overlap):
    tok = Tokenizer.from_file(BYTES)
    docs = make_docs(rows + [(100, "z" * 5000), (104, "")], extra=True)                # repeated rows are counted each
    got = counts(token_count.token_counts(docs, BYTES, 100, whole, chunk, overlap))
    assert got == want(rows + [(100, "z" * 5000), (104, "")], 100, lambda t: len(tok.encode(t, add_special_tokens=False)))


def test_places_of_a_chunk_are_places_of_the_text():
    """Past a common beginning, a chunk and the whole text have the same tokens up to the margin."""
    counter = token_count.Counter(BYTES)
    rnd = random.Random(11)
    for _ in range(200):
        text = "".join(rnd.choices(PARTS, k=120))
        whole = dict(counter.places(text)[0])
        lo = rnd.randrange(len(text) // 2)
        hi = rnd.randrange(lo + 40, len(text))
        part = {lo + at: n for at, n in counter.places(text[lo:hi])[0]}
        common = [p for p in part if p in whole and lo < p <= hi - counter.margin]
        if common:
            first = common[0]
            inner = {p: n - part[first] for p, n in part.items() if first <= p <= hi - counter.margin}
            assert inner == {p: n - whole[first] for p, n in whole.items() if first <= p <= hi - counter.margin}


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_libraries_encode_whole_texts(spark, make_docs, rows, name):
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        encode = lambda t: len(model.encode(t))
    else:
        tok = Tokenizer.from_file(path)
        encode = lambda t: len(tok.encode(t, add_special_tokens=False))
    some = rows[:20] + rows[-6:]
    assert counts(token_count.token_counts(make_docs(some), path, 100, 64, 32, 8)) == want(some, 100, encode)


def test_empty_table_and_bad_overlap(spark, make_docs):
    got = token_count.token_counts(make_docs([]), BYTES)
    assert got.collect() == [] and got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    with pytest.raises(ValueError):
        token_count.token_counts(make_docs([]), BYTES, chunk_chars=100, overlap=100)
