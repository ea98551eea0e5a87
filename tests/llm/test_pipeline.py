"""The pipeline's stages against their brute-force versions on planted documents."""
import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.conftest import SF001
from tests.llm.test_minhash import brute as near_brute
from tests.llm.test_pii import base


def planted():
    rnd = random.Random(11)
    words = {"en": "the and of to house river stone word".split(), "de": "der und die zu haus fluss stein wort".split()}
    rows = []
    for i in range(60):
        lang = rnd.choice(["en", "de"])
        t = rnd.choices(words[lang], k=120)
        rows.append((i, " ".join(t), lang, rnd.choice(["a", "a", "a", "b", None])))
    t = rows[0][1].split()
    t[5] = "changed"
    rows += [(100, rows[0][1], "en", "a"), (101, " ".join(t), None, "b"), (102, None, "en", "a"), (103, "12 34 !!", "en", "a"),
             (104, "write to me@site.org and 4111 1111 1111 1111 the house of stone", "en", "b"), (105, "", None, None)]
    return rows


def test_stages(spark, make_docs):
    rows = planted()
    docs = make_docs(rows)
    cols = docs.columns
    assert [n for n, _ in C.STAGES] == ["language", "dedup", "private", "mix", "pack"]
    out = {}
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, SF001), "test-pipeline")
        out[name] = docs.collect()
        if name != "pack":
            assert docs.columns == cols
    text = {r[0]: r[1] for r in rows}
    letters = {d for d, t in text.items() if t and any(map(str.isalpha, t))}
    assert {r.doc_id for r in out["language"]} == letters
    keep = {d for d, _, _, kept in near_brute([(d, text[d]) for d in letters], 5, 80) if kept}
    assert {r.doc_id for r in out["dedup"]} == keep and 100 not in keep and 101 not in keep
    for r in out["private"]:
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(text[r.doc_id]):
            assert r.text == text[r.doc_id]
    assert any("[EMAIL]" in r.text and "[CARD]" in r.text for r in out["private"])
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = sum(len(tok.encode(r.text, add_special_tokens=False).ids) + 1 for r in out["mix"])
    assert sum(r.length for r in out["pack"]) == n
    assert max(r.offset + r.length for r in out["pack"]) <= 1024


def test_language_stage_without_a_learned_language(spark, make_docs):
    texts = {i: t for i, t, *_ in planted()}
    letters = {i for i, t in texts.items() if t and any(map(str.isalpha, t))}
    for rows in ([(i, t, None) for i, t in texts.items()],                           # no label
                 [(i, t, None) for i, t in texts.items()] + [(200, "12 34", "en")],   # a label without a letter
                 [(i, t, "und") for i, t in texts.items()]):                         # a label named like the unknown
        out = C.language(spark, make_docs(rows), SF001)
        assert out.columns == make_docs([]).columns and {r.doc_id for r in out.collect()} == letters


def test_run_over_a_table(spark):
    df = C.run(spark, SF001)
    assert df.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(df.columns)


def test_stages_keep_columns_with_clashing_names(spark, make_docs):
    docs = make_docs(planted(), extra=True)
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns and out.where("_d <> 'x' OR lang_pred <> 'x'").count() == 0 < out.count()
    assert C.STAGES[-1][1](spark, docs, SF001).count() > 0


def test_stages_take_an_empty_table(spark, make_docs):
    for _, stage in C.STAGES:
        assert stage(spark, make_docs([]), SF001).count() == 0
