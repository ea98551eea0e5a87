"""Whole texts that go through files in slices: same rows, and a slice's files and shuffles go with it."""
import datetime as dt
import glob
import os

import pytest

from hirelens.plans.registry import QUERIES
from hirelens.session import ensure_checkpoint_dir, shuffles_released
from hirelens.sources import fixtures as fx
from hirelens.sources import io as IO

KEYS = [7 * i % 101 for i in range(101)] + [5, 5, None, 40]


@pytest.fixture()
def tables(spark, tmp_path):
    days = [dt.date(1998, 1, 1), dt.date(2000, 5, 1), dt.date(1996, 1, 1)]
    orders = [(k, i % 90, days[i % 3]) for i, k in enumerate(KEYS)]
    docs = [(i, None if i == 3 else f"a < b & c {i}\n\"quoted\", " + "text " * i) for i in range(10)] + [(4, "again"), (None, "no key")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate date").repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def _left(spark, name):
    """Bytes of text files that a query left below the shared folder."""
    at = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(f) for f in glob.glob(f"{at}/out/{name}-*/**/*", recursive=True) if os.path.isfile(f))


def _few_bytes(spark, monkeypatch, slices):
    seen = []
    count = IO.key_slices
    monkeypatch.setattr(IO, "SLICE_BYTES", 400 // slices)
    monkeypatch.setattr(IO, "key_slices", lambda *a: seen.append(count(*a)) or seen[-1])
    return seen


def test_csv_in_slices_numbers_rows_in_id_order(spark, tables, monkeypatch):
    raw = fx.postings_raw(spark, tables).collect()
    seen = _few_bytes(spark, monkeypatch, 8)
    got = sorted(map(tuple, QUERIES["src_csv"](spark, tables).collect()))
    assert len(seen[0]) > 4
    assert [r[0] for r in got] == list(range(len(raw)))
    order = [r[1] for r in got]
    assert order[0] is None and order[1:] == sorted(order[1:])
    value = lambda r: tuple("" if x is None else str(x) for x in r)                                    # noqa: E731
    chars = lambda t: None if t is None else len(t)                                                    # noqa: E731
    assert sorted(value(r[1:]) for r in got) == sorted(
        value((r.native_id, r.source, r.raw_title, r.company, chars(r.description_text))) for r in raw)


@pytest.mark.parametrize("query, files", [("src_csv", ["raw_csv"]), ("feeds_to_unified", ["feed_a", "feed_b", "feed_c"])])
def test_texts_leave_the_disk_with_their_slice(spark, tables, monkeypatch, query, files):
    before = [_left(spark, x) for x in files]
    tops = []
    remove = IO.remove_folder
    monkeypatch.setattr(IO, "remove_folder", lambda s, path: tops.append(path) or remove(s, path))
    seen = _few_bytes(spark, monkeypatch, 8)
    QUERIES[query](spark, tables).collect()
    assert [_left(spark, x) for x in files] == before
    assert len(tops) == sum(map(len, seen)) + 1                          # and the texts that were laid out for the joins
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("texts_")]


def test_shuffles_go_when_their_write_ends(spark, tmp_path):
    def kept():
        status = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(status.apply(i).getName().startswith("shuffle_") for i in range(status.size()))

    rows = spark.range(3000).repartition(5, "id")
    start = kept()
    with shuffles_released(spark):
        rows.write.parquet(f"{tmp_path}/a")
    assert kept() <= start
    rows.write.parquet(f"{tmp_path}/b")
    assert kept() > start
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_joins_on_a_bucketed_table_move_the_other_side_alone(spark, tables):
    with IO.bucketed(fx.document_texts(spark, tables), "_doc", "texts") as texts:
        plan = fx.postings_raw(spark, tables, texts=texts).hint("shuffle_merge")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            shown = plan._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, plan.collect())) == sorted(map(str, fx.postings_raw(spark, tables).collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shown.count("Exchange hashpartitioning") == 1


def test_equal_and_missing_keys_stay_in_one_slice(spark):
    place = lambda k: -1 if k is None else k                                                           # noqa: E731
    df = spark.createDataFrame([(k,) for k in KEYS + [5] * 50], "k long")
    parts = [sorted(place(r.k) for r in df.where(c).collect()) for c in IO.key_slices(df, "k", 6)]
    assert len(parts) > 3 and sum(parts, []) == sorted(map(place, KEYS + [5] * 50))
    none = spark.createDataFrame([(None,)], "k long")
    assert len(IO.key_slices(none, "k", 6)) == 1


def test_feeds_in_slices_give_the_same_rows(spark, tables, monkeypatch):
    whole = sorted(map(str, QUERIES["feeds_to_unified"](spark, tables).collect()))
    seen = _few_bytes(spark, monkeypatch, 8)
    assert sorted(map(str, QUERIES["feeds_to_unified"](spark, tables).collect())) == whole and whole
    assert len(seen) == 3 and all(len(x) > 1 for x in seen)
