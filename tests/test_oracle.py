"""Every registered query with an oracle matches DuckDB at sf0.001 (rows, columns, values)."""
import duckdb
import pytest

from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"


NO_ORACLE = {"op5_best_fit_packing", "op7_language_id",
             "op8_personal_data", "op9_token_records", "op12_token_counts", "pipeline"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _keys():
    import __spark_entry__ as E
    return sorted(E.queries())


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        # beyond SQL (edit-distance graphs, tokenizers, models): held against brute force in their own tests
        assert key in NO_ORACLE, f"{key} has no oracle"
        assert rows
        return
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    want = [tuple(r) for r in res.fetchall()]
    assert len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(cols, want)[0]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["snapshot", "canonical_title", "n_raw", "share_raw", "n_adjusted",
                          "share_adjusted", "gap_pp"]
