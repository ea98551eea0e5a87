"""Goldens for text and date helpers (FIXTURES §3: T4, T5, T7, T8, T9)."""
import datetime as dt

from pyspark.sql import functions as F

from hirelens.functions import dates, text


def _one(spark, expr, value, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("x")).first().x


def test_html_strip_goldens(spark):
    cases = {
        "&lt;p&gt;A&amp;amp;B&lt;/p&gt;": "A&B",
        "a<!-- x -->b": "a b",
        'a<script>var t="</p>";</script>b': "a b",
        "  ": "",
        None: "",
        "<p>x&copy; &#169; &eacute;</p>": "x© © é",
    }
    for raw, want in cases.items():
        assert _one(spark, text.html_to_text(F.col("v")), raw) == want, raw


def test_quarter(spark):
    assert _one(spark, dates.quarter_label(F.col("v")), dt.date(2023, 5, 31), "v date") == "2023Q2"
    assert _one(spark, dates.quarter_label(F.col("v")), None, "v date") is None


def test_company_clean(spark):
    assert _one(spark, text.company_clean(F.col("v")), "Healthfirst\n3.1") == "Healthfirst"


def test_first_location(spark):
    df = spark.createDataFrame([([],), (None,), (["X", "Y"],)], "v array<string>")
    assert [r.x for r in df.select(text.first_location("v").alias("x")).collect()] == ["", "", "X"]


def test_epoch_ms(spark):
    assert _one(spark, dates.epoch_ms_to_date(F.col("v")), "1712966400000") == dt.date(2024, 4, 13)
    assert _one(spark, dates.epoch_ms_to_date(F.col("v")), "bad") is None


def test_iso_ts(spark):
    got = _one(spark, dates.iso_to_naive_utc(F.col("v")), "2026-04-01T10:00:00+02:00")
    assert got == dt.datetime(2026, 4, 1, 8, 0, 0)


def test_entities_decode_like_the_standard(spark):
    import html
    texts = ["&#169; &eacute; R&D AT&T &amp;lt; &notit; &ampx &#0; &#x80; &#150; &#xD800; &#99999999; &#x1F600; &# &#x; &;",
             "a&b &lt &copy2 &unknown; &#11;x &hellip;&nbsp;x &NotEqualTilde; &&amp;", "none", "&", "&amp", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    from hirelens.functions.text import decode_entities
    got = {r.i: r.d for r in df.select("i", decode_entities("t").alias("d")).collect()}
    assert [got[i] for i in range(len(texts))] == [html.unescape(t) for t in texts]


def test_html_strip_runs_no_python(spark):
    from hirelens.functions.text import html_to_text
    df = spark.createDataFrame([("<p>R&amp;D &#169;</p>",)], "h string").select(html_to_text("h").alias("t"))
    assert df.first().t == "R&D ©"
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_skill_names_are_tokens_of_their_own(spark):
    from hirelens.operators.extract import extract_skills
    names = ["C++", "C#", "C", "S3", "CI/CD", "Node.js", "GPT-4", "GPT", ".NET", "AT&T", "Go", "machine learning"]
    tax = spark.createDataFrame([(n, n) for n in names], "canonical string, alias string")
    docs = [(1, "We use C++, and an S3 bucket."), (2, "a b d c go"), (3, "(C#/.NET) CI/CD; Node.js."), (4, "GPT-4 not GPT"),
            (5, "C, Go and MACHINE Learning"), (6, None), (7, ""), (8, "machine-learning at AT&T")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {}
    for r in extract_skills(df, tax, strict_short=True).collect():
        got.setdefault(r.doc_id, set()).add(r.skill)
    assert got == {1: {"C++", "S3"}, 3: {"CI/CD", "Node.js"}, 4: {"GPT-4", "GPT"}, 5: {"C", "Go", "machine learning"}, 8: {"AT&T"}}
    loose = {r.skill for r in extract_skills(df.where("doc_id = 2"), tax).collect()}
    assert loose == {"C", "Go"}
