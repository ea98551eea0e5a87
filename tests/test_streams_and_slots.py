"""W6's late rows and restarts; T18's order of slots."""
import datetime as dt

from hirelens.operators import taxonomy as TX
from hirelens.sources import io as IO
from hirelens.streaming import ingest as ST

SCHEMA = "posting_id string, company string, canonical_title string, date date, year int"


def _drop(spark, feed, rows):
    rows = [(i, c, "t", dt.date.fromisoformat(d) if d else None, 2000) for i, c, d in rows]
    spark.createDataFrame(rows, SCHEMA).write.mode("append").partitionBy("year").parquet(feed)


def test_late_rows_go_to_the_side(spark, tmp_path):
    feed, target, ckpt, state = (str(tmp_path / n) for n in ("feed", "out", "ckpt", "state"))
    run = lambda: ST.dedup_stream_run(spark, feed, SCHEMA, target, ckpt, state)
    _drop(spark, feed, [("a", "x", "2000-05-01"), ("b", "x", "2000-05-20"), ("c", None, "2000-05-01"), ("d", "y", None)]
          + [(f"h{i:03}", "hot", "2000-01-01") for i in range(300)])
    run()
    _drop(spark, feed, [("e", "x", "1998-12-01"), ("f", "x", "2000-06-10"), ("g", "x", "2000-09-01"), ("h", "hot", "2000-01-01"),
                        ("i", "z", "1990-01-01")])
    run()
    run()                                                            # nothing new: nothing changes
    got = {r.posting_id: r.is_duplicate for r in spark.read.parquet(target).collect()}
    assert "e" not in got and len(got) == 308
    assert {k: v for k, v in got.items() if k in "abcdfghi"} == {
        "a": False, "b": True, "c": False, "d": False, "f": True, "g": False, "h": True, "i": False}
    assert sum(not v for k, v in got.items() if k.startswith("h") and len(k) > 1) == 1
    late = [tuple(r) for r in spark.read.parquet(f"{target}_late").select("posting_id", "date", "last_date").collect()]
    assert late == [("e", dt.date(1998, 12, 1), dt.date(2000, 5, 20))]
    _drop(spark, feed, [("j", "x", "2000-09-20")])                   # the late row left the state as it was
    run()
    assert {r.posting_id: r.is_duplicate for r in spark.read.parquet(target).collect()}["j"]


def test_state_holds_touched_keys_and_reads_months_within_reach(spark, tmp_path):
    feed, target, ckpt, state = (str(tmp_path / n) for n in ("feed", "out", "ckpt", "state"))
    run = lambda: ST.dedup_stream_run(spark, feed, SCHEMA, target, ckpt, state)
    _drop(spark, feed, [(f"a{i}", f"c{i}", "1999-01-15") for i in range(50)])
    run()
    _drop(spark, feed, [(f"b{i}", "hot", f"2000-03-{1 + i % 28:02}") for i in range(500)] + [("b", "c1", "2000-03-31")])
    run()
    _drop(spark, feed, [("c", "hot", "2000-04-20"), ("d", "c1", "2000-04-30"), ("e", "c2", "2000-04-30"), ("f", "hot", "2000-07-01")])
    run()
    log = spark.read.parquet(state)
    assert {r.epoch: r["count"] for r in log.groupBy("epoch").count().collect()} == {0: 50, 1: 2, 2: 3}
    got = {r.posting_id: r.is_duplicate for r in spark.read.parquet(target).collect()}
    assert [got[k] for k in "bcdef"] == [False, True, True, False, False]
    assert sum(not got[f"b{i}"] for i in range(500)) == 1
    reach = ST.last_days(spark, state, 2, dt.date(2000, 4, 20), 30)
    assert sorted(map(tuple, reach.collect())) == [("c1", "t", dt.date(2000, 3, 31)), ("hot", "t", dt.date(2000, 3, 28))]
    plan = reach._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1][:200]
    # a repeated epoch sees neither its own state nor later ones
    assert {r.last_date for r in ST.last_days(spark, state, 1, dt.date(1999, 1, 1), 30).collect()} == {dt.date(1999, 1, 15)}
    assert ST.last_days(spark, state, 3, None, 30).isEmpty()


def test_first_slot_in_file_order(spark, tmp_path):
    rows = [("genai", "Zeta", "gizmo"), ("genai", "Alpha", "gizmo"), ("genai", "Alpha", "x"), ("other", "Beta", "gizmo"), ("genai", "Q, \"q\"", "y")]
    df = spark.createDataFrame(rows, "category string, slot string, pattern string").coalesce(1)
    IO.write_csv(df, str(tmp_path / "s"))
    slots = IO.read_slots(spark, str(tmp_path / "s"))
    assert [(r.category, r.slot, r.pattern) for r in slots.orderBy("seq").collect()] == rows
    cats = spark.createDataFrame([("Gizmo ", "genai"), ("x", "genai"), ("gizmo", "other"), ("y", "genai"), ("n", "my_own")],
                                 "canonical_name string, category string")
    got = {(r.canonical_name, r.category): r.subcategory for r in TX.subcategory(cats, slots).collect()}
    assert got == {("Gizmo ", "genai"): "Zeta", ("x", "genai"): "Alpha", ("gizmo", "other"): "Beta", ("y", "genai"): 'Q, "q"',
                   ("n", "my_own"): "Other My Own"}
