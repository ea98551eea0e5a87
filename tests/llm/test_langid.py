import numpy as np
from pyspark.sql import functions as F

from hirelens.llm import langid
from tests.conftest import SF01


def longest_phrases(text, train):
    """Cross-parsing by plain substring search."""
    n, i = 0, 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i:i + k] in train:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_automaton_holds_every_substring():
    text = "abracadabra banana"
    go = langid.automaton(text)

    def has(s):
        state = 0
        for c in s:
            if c not in go[state]:
                return False
            state = go[state][c]
        return True

    subs = {text[i:j] for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    assert all(map(has, subs)) and not any(has(s[::-1] + "x") for s in subs)


def test_phrases_against_substring_search():
    training = {"en": " the cat sat on the mat \n cats and dogs \n", "xx": " ñandú über straße \n"}
    p = langid.Parser(langid.Model(training))
    texts = ["the cat", "The... CAT sat, on 12 mats", "thecat", "zzz", "ñan and ÜBER straße", "q", "mat cats", "漢字 𝒳𐐀", "mat\ncats"]
    total, size = p.totals(iter([*texts, None, "", "12 -"]), len(texts) + 3)
    for t, row, n in zip(texts, total, size):
        run = langid.spaced(t)
        assert n == len(run)
        assert list(row) == [longest_phrases(run, training[x]) for x in p.model.langs]
    assert not size[-3:].any() and not total[-3:].any()


def test_phrases_reach_over_words():
    m = langid.Model({"a": " one two three ", "b": " three one two "})
    total, _ = langid.Parser(m).totals(["one two three"], 1)
    assert list(total[0]) == [1, 2]


def test_long_text_is_parsed_whole(monkeypatch):
    training = {"de": " der Hund und die Katze \n".lower(), "en": " the dog and the cat \n"}
    monkeypatch.setattr(langid, "SPAN", 64)
    monkeypatch.setattr(langid, "BLOCK", 500)
    p = langid.Parser(langid.Model(training))
    text = "the cat and the dog " * 10 + "der Hund und die Katze " * 400
    total, size = p.totals([text], 1)
    want = np.zeros(2, int)
    for lo in range(0, len(text), 500):
        run = langid.spaced(text[lo:lo + 500])
        for at in range(0, len(run), 64):
            want += [longest_phrases(run[at:at + 64], training[x]) for x in p.model.langs]
    assert list(total[0]) == list(want)
    assert p.predict([text], 1)[0] == ["de"]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").withColumn("held", langid.held_out(F.col("doc_id")))
    model = langid.train(docs.where("NOT held"))
    out = langid.predict(docs.where("held").drop("held"), model)
    right, n = out.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n > 0.98
    assert out.where("score < 0 OR score > 1").count() == 0


def test_shared_words_in_front_hide_no_language(make_docs):
    front = "shared words " * 2000
    docs = make_docs([(1, front + "der Hund und die Katze", "de"), (2, front + "the dog and the cat", "en")])
    own = make_docs([(3, "der Hund", None), (4, "the dog", None)])
    got = {r.doc_id: r.lang_pred for r in langid.predict(own, langid.train(docs)).collect()}
    assert got == {3: "de", 4: "en"}


def test_edges(make_docs):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "", None),
            (5, "123 ... 456", "en"), (6, "der Hund", None), (6, "der Hund", None), (7, "die " * 20_000, "de"),
            (None, "the dog", "en"), (8, "x" * 5000, "en")]
    docs = make_docs(rows, extra=True)
    model = langid.train(docs)
    out = langid.predict(docs, model)
    assert set(docs.columns) <= set(out.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, set()).add((r.lang_pred, r.score > 0))
    assert got[1] == {("en", True)} and got[6] == {("de", True)} == got[7] and got[None] == {("en", True)}
    assert got[3] == got[4] == got[5] == {("und", False)}
    none = langid.predict(docs, langid.train(docs.where("lang IS NULL")))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    assert langid.predict(docs.limit(0), model).collect() == []
