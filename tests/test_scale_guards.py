"""Inputs that the fixtures avoid: long chains, hot keys, whole texts, missing settings."""
import datetime as dt
import json
import re

import pytest
from pyspark.sql import functions as F

from hirelens.operators import batching as B
from hirelens.operators import fuzzy as FZ
from hirelens.operators import graph
from hirelens.plans import base
from hirelens.sources import fixtures as fx
from hirelens.streaming import ingest as ST
from tests.conftest import SF001, SF01


def _chain(spark, n):
    names = spark.createDataFrame([(f"n{i:05d}", i) for i in range(n)], "name string, ord int")
    pairs = spark.createDataFrame([(f"n{i:05d}", f"n{i + 1:05d}") for i in range(n - 1)], "name_a string, name_b string")
    return names, pairs


def test_a_long_chain_leaves_no_name_undecided(spark):
    names, pairs = _chain(spark, 1501)
    got = {r.name: (r.rep, r.is_rep) for r in FZ.greedy_clusters(names, pairs).collect()}
    assert len(got) == 1501 and all(rep is not None for rep, _ in got.values())
    assert all(is_rep == (int(n[1:]) % 2 == 0) for n, (_, is_rep) in got.items())
    assert got["n00007"] == ("n00006", False)


def test_rounds_and_tasks_agree(spark):
    names = spark.createDataFrame([(f"n{i}", i) for i in range(12)], "name string, ord int")
    pairs = spark.createDataFrame([(f"n{i}", f"n{j}") for i, j in
                                   [(0, 5), (5, 1), (1, 7), (2, 3), (3, 4), (4, 6), (6, 2), (8, 9)]],
                                  "name_a string, name_b string")
    one = sorted(FZ.greedy_clusters(names, pairs).collect())
    assert one == sorted(FZ.greedy_clusters(names, pairs, task_edges=0).collect())


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


def test_every_document_reaches_the_postings(spark):
    docs = fx.table(spark, SF01, "documents")
    raw = fx.postings_raw(spark, SF01).join(docs.select(F.col("text").alias("description_text"), "doc_id"), "description_text")
    assert raw.select("doc_id").distinct().count() == docs.count()
    n = docs.count()
    final = base.final_postings(spark, SF01)
    nid = F.element_at(F.split("posting_id", ":"), -1).cast("long")
    wrong = final.join(docs, nid % n == F.col("doc_id")).where(F.col("text") != F.col("description_text"))
    assert wrong.count() == 0


def test_positions_are_consecutive_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    got = sorted((r.row_id, r.k) for r in B.global_positions(df, "k").collect())
    assert [i for i, _ in got] == list(range(5000)) and [k for _, k in got] == sorted(k for _, k in got)


def test_checkpoint_folder_is_asked_for_off_local(spark, monkeypatch):
    from hirelens import session

    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_stream_with_a_hot_missing_company(spark, tmp_path):
    day = dt.date(2020, 1, 1)
    rows = [(f"p{i}", None, "t", day) for i in range(300)] + [("a1", "c", "t", day), ("a2", "c", "t", day)]
    later = [("a3", "c", "t", day + dt.timedelta(days=30)), ("a4", "c", "t", day + dt.timedelta(days=90)), ("x", "d", "t", None)]
    schema = "posting_id string, company string, canonical_title string, date date"
    feed, out, ckpt, state = (str(tmp_path / x) for x in ("feed", "out", "ckpt", "state"))
    for drop in (rows, later):
        spark.createDataFrame(drop, schema).write.mode("append").parquet(feed)
        ST.dedup_stream_run(spark, feed, schema, out, ckpt, state)
    got = {r.posting_id: r.is_duplicate for r in spark.read.parquet(out).collect()}
    assert len(got) == 305 and {k for k, v in got.items() if v} == {"a2", "a3"}


def test_a_broken_target_is_an_error(spark, tmp_path):
    feed, target = tmp_path / "feed", tmp_path / "target"
    spark.createDataFrame([("a", "2020-01-01", "s")], "posting_id string, date string, source string") \
        .write.partitionBy("date", "source").parquet(str(feed))
    target.mkdir()
    (target / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        ST.ingest_new(spark, str(feed), "posting_id string, date date, source string", str(target), str(tmp_path / "c"), lambda b: b)


def _shuffled(spark, df):
    """Columns that the exchanges of a plan carry, by exchange."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]\n", plan)


def test_analyses_read_a_table_without_texts(spark):
    assert "description_text" not in base._skilled_postings(spark, SF01).columns
    assert "description_text" not in base.clean_postings(spark, SF01).columns
    # texts join on reading, and a table may be built from another persisted one
    a = base.clean_postings(spark, SF01, with_text=True).select("posting_id", "description_text")
    b = base.final_postings(spark, SF01).select("posting_id", "description_text")
    assert a.count() and a.exceptAll(b).isEmpty()


def test_repeated_document_ids_repeat_their_postings(spark, tmp_path):
    docs = [(0, "a"), (0, "b"), (1, "c"), (None, "d")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    df = spark.createDataFrame([("s:4",), ("s:1",), ("s:2",)], "posting_id string")
    got = base.with_description(spark, str(tmp_path), base.with_document(spark, str(tmp_path), df))
    assert sorted(map(tuple, got.collect())) == [("s:1", "c"), ("s:2", ""), ("s:4", "a"), ("s:4", "b")]


def test_payload_values_travel_once(spark):
    rows = spark.createDataFrame([(0, "a", "x"), (0, "a", None), (0, "b", None), (1, None, "y"), (1, "c", "z")],
                                 "batch long, id string, t string")
    out = B.batch_payloads(rows, "id", "t")
    assert len(_shuffled(spark, out)) == 1
    got = {r.batch: (r.n_items, json.loads(r.payload)) for r in out.collect()}
    assert got[1] == (1, {"c": "z"}) and got[0][0] == 2 and got[0][1]["a"] == "x"


def test_numbered_rows_stay_where_they_are(spark):
    at = B.global_positions(spark.createDataFrame([(i, "t") for i in range(9)], "k int, text string"), "k")
    assert not any("text" in columns for columns in _shuffled(spark, at))


def test_feeds_move_no_texts(spark):
    from hirelens.plans.registry import QUERIES

    carried = _shuffled(spark, QUERIES["feeds_to_unified"](spark, SF001))
    assert carried and not any(re.search(r"\b(Job Description|description|content|description_html)#", c) for c in carried)
