"""P1-P3 goldens (FIXTURES §3)."""
from hirelens.operators import parse as P


def _resp(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "response_id long, text string")


def test_json_responses(spark):
    texts = ['```json\n{"a":["x","y"],"b":[]}\n```', 'noise {"a":["z"]} tail', "[1]", "nope"]
    rows = P.parse_json_responses(_resp(spark, texts)).collect()
    keys = {}
    for r in rows:
        keys.setdefault(r.response_id, set()).add(r.key)
    assert keys == {0: {"a", "b"}, 1: {"a"}}
    assert sorted((r.pos, r.term) for r in rows if r.response_id == 0 and r.key == "a") == [(1, "x"), (2, "y")]


def test_csv_responses(spark):
    texts = ['"a, b",language,\na,language\na']
    got = sorted((r.canonical_name, r.category, r.platform_family)
                 for r in P.parse_csv_responses(_resp(spark, texts)).collect())
    assert got == [("a", "language", ""), ("a, b", "language", "")]


def test_yaml_responses(spark):
    texts = ["```yaml\nPython:\n  - python\n  - py\nnote: reviewed\nSQL:\n  - sql\n```"]
    got = sorted((r.key, r.item) for r in P.parse_yaml_responses(_resp(spark, texts)).collect())
    assert got == [("Python", "py"), ("Python", "python"), ("SQL", "sql")]


def test_json_one_bad_value_keeps_the_others(spark):
    rows = P.parse_json_responses(_resp(spark, ['{"a":["x"],"b":"scalar","c":{"d":1},"e":["y", "z"]}'])).collect()
    assert {(r.key, r.term) for r in rows} == {("a", "x"), ("e", "y"), ("e", "z")}


def test_yaml_quotes_and_flow_lists(spark):
    text = 'Python: [py, "python, 3"]\n"CI: CD":\n  - "ci/cd"\n\'it\'\'s\':\n  - x\n"C++":\n  - c++\nnote: reviewed\nEmpty: []'
    got = sorted((r.key, r.item) for r in P.parse_yaml_responses(_resp(spark, [text])).collect())
    assert got == [("C++", "c++"), ("CI: CD", "ci/cd"), ("Python", "py"), ("Python", "python, 3"), ("it's", "x")]


def test_csv_empty_fields_are_not_missing_columns(spark):
    got = sorted((r.canonical_name, r.category, r.platform_family)
                 for r in P.parse_csv_responses(_resp(spark, ['a,\nb,,Suite\noops\n"x, y"\n"q",language'])).collect())
    assert got == [("a", "", ""), ("b", "", "Suite"), ("q", "language", "")]


def test_json_is_one_whole_object(spark):
    texts = ['Here: {"a":["x"]} and {"b":["y"]}', '{"a":["x"]} tail', '{"a":["x"],"a":["y","z"]}', '{"a":["}"],"b":["\\"{"]}',
             "{'a':['x']}", '{"a":["x"]', 'x {"k":{"in":[1]},"l":["m"]} y', '{"a":["x"]}{"b":["y"]}', "", None]
    got = sorted((r.response_id, r.key, r.pos, r.term) for r in P.parse_json_responses(_resp(spark, texts)).collect())
    assert got == [(1, "a", 1, "x"), (2, "a", 1, "y"), (2, "a", 2, "z"), (3, "a", 1, "}"), (3, "b", 1, '"{'), (6, "l", 1, "m")]


def test_csv_records_over_lines(spark):
    import csv
    import io
    texts = ['"a\nb",c,d\ne,f\n"g ""h""\n\n, i",j', 'x"y,b\nq,"r', 'a,"b\n"c,"d\ne"\nf,g', '5" disk,part\n"say ""hi""",x,y', "one\n,two"]
    got = {}
    for r in P.parse_csv_responses(_resp(spark, texts[:1] + texts[3:])).collect():
        got.setdefault(r.response_id, []).append((r.canonical_name, r.category, r.platform_family))
    want = {}
    for i, t in enumerate(texts[:1] + texts[3:]):
        for rec in csv.reader(io.StringIO(t, newline="")):
            if len(rec) > 1:
                want.setdefault(i, []).append(tuple(x.strip() for x in (rec + ["", ""])[:3]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    lines = spark.createDataFrame([(t,) for t in texts], "t string").select(P.csv_records(P.F.col("t")).alias("r")).collect()
    assert [len(r.r) for r in lines] == [3, 2, 2, 2, 2]


def test_yaml_scalars(spark):
    text = ('K:\n  - "x\\ty"\n  - z # note\n  - "C:\\\\path" # why\n  - \'it\'\'s\' # so\n  - a#b\n  - "\\x41\\u00e9\\0\\\\x41"\n'
            '  - "say \\"hi\\""\n# whole line\nL: [a, "b, c"] # end\nM: # next\n  - m\nnote: x # y')
    got = sorted((r.key, r.item) for r in P.parse_yaml_responses(_resp(spark, [text])).collect())
    assert got == sorted([("K", "x\ty"), ("K", "z"), ("K", "C:\\path"), ("K", "it's"), ("K", "a#b"), ("K", "Aé\0\\x41"), ("K", 'say "hi"'),
                          ("L", "a"), ("L", "b, c"), ("M", "m")])


def test_dictionary_round_trip_of_odd_names(spark, tmp_path):
    from hirelens.sources import io as IO
    names = ["C:\\path", "tab\there", 'a "quote"', "colon: x", "# note", "x # y", "it's", " lead", "trail\\", "\\n", "é\u2028"]
    d = spark.createDataFrame([(n, f"{n}|{k}", 2 * i + k) for i, n in enumerate(names) for k in range(2)],
                              "canonical string, alias string, seq long")
    IO.write_dictionary_yaml(d, str(tmp_path / "y"))
    got = {(r.canonical, r.alias) for r in IO.read_dictionary_yaml(spark, str(tmp_path / "y")).collect()}
    assert got == {(n, f"{n}|{k}") for n in names for k in range(2)}


def test_objects_with_null_and_repeated_ids(spark, tmp_path):
    from hirelens.operators import batching as B
    from hirelens.sources import io as IO
    rows = spark.createDataFrame([(0, "a", "x"), (0, "a", "y"), (0, None, "z"), (0, "b", "w"), (1, "c", "v"), (2, None, "u")],
                                 "batch long, id string, t string")
    got = {r.batch: (r.n_items, r.payload) for r in B.batch_payloads(rows, "id", "t").collect()}
    assert got == {0: (2, '{"a":"y","b":"w"}'), 1: (1, '{"c":"v"}')}
    rejects = {r.batch: (r.n_without_key, r.n_repeated) for r in B.payload_rejects(rows, "id").collect()}
    assert rejects == {0: (1, 1), 1: (0, 0), 2: (1, 0)}
    e = spark.createDataFrame([(0, "p", 1, "s"), (0, None, 1, "t"), (0, "q", 1, "u")], "batch long, posting_id string, pos int, term string")
    IO.write_extractions_json(e, str(tmp_path / "j"))
    assert {(r.posting_id, r.term) for r in IO.read_extractions_json(spark, str(tmp_path / "j")).collect()} == {("p", "s"), ("q", "u")}
    (tmp_path / "k").mkdir()
    (tmp_path / "k" / "f.json").write_text('{"p":["a","b"],"q":["c"],"p":["d"]}\n')
    back = {(r.posting_id, r.pos, r.term) for r in IO.read_extractions_json(spark, str(tmp_path / "k")).collect()}
    assert back == {("p", 1, "d"), ("q", 1, "c")}
