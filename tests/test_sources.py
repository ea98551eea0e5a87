"""S8 / S9 readers on hand-written files (single-object JSON, YAML with header and quotes)."""
import json

from hirelens.sources import io as IO


def test_extractions_single_object(spark, tmp_path):
    p = tmp_path / "ex.json"
    p.write_text(json.dumps({"a": ["x", "y"], "b": []}, indent=2))
    rows = sorted((r.posting_id, r.pos or 0, r.term or "") for r in IO.read_extractions_json(
        spark, str(p), whole_file=True).collect())
    assert rows == [("a", 1, "x"), ("a", 2, "y"), ("b", 0, "")]


def test_dictionary_yaml_roundtrip(spark, tmp_path):
    d = spark.createDataFrame([("C++", "c++", 1), ("C++", 'say "hi"', 2), ("b", "x", 3)],
                              "canonical string, alias string, seq long")
    path = str(tmp_path / "dict")
    IO.write_dictionary_yaml(d, path, header="# header line\n# second")
    got = [(r.canonical, r.alias) for r in IO.read_dictionary_yaml(spark, path).orderBy("seq").collect()]
    assert got == [("b", "x"), ("C++", "c++"), ("C++", 'say "hi"')]


def test_row_positions_move_no_rows(spark, tmp_path):
    rows = [(i, f"line one of {i}\nline two, \"quoted\"") for i in range(57)]
    path = str(tmp_path / "texts")
    df = spark.createDataFrame(rows, "k int, text string").repartitionByRange(5, "k").sortWithinPartitions("k")
    IO.write_csv(df, path, **IO.GZIP)
    at = IO.with_row_position(IO.read_csv(spark, path, "k int, text string"), "row_id")
    assert sorted((r.row_id, r.k, r.text) for r in at.collect()) == [(i, *row) for i, row in enumerate(rows)]
    plan = at._jdf.queryExecution().sparkPlan().toString()
    # the only window is the one over files, and the join brings the files to the rows
    assert plan.count("Window ") == 1 and "_file" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
