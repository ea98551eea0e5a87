"""W1 goldens: chained 30-day flag, null company, equal dates (FIXTURES §3)."""
import datetime as dt

from hirelens.operators.clean import flag_duplicates

D = dt.date


def _flags(spark, rows):
    df = spark.createDataFrame(rows, "posting_id string, company string, canonical_title string, date date")
    out = flag_duplicates(df).orderBy("posting_id").collect()
    return [r.is_duplicate for r in out]


def test_chain(spark):
    rows = [("a1", "C", "DS", D(2024, 1, 1)), ("a2", "C", "DS", D(2024, 1, 31)),
            ("a3", "C", "DS", D(2024, 3, 1)), ("a4", "C", "DS", D(2024, 4, 15))]
    assert _flags(spark, rows) == [False, True, True, False]


def test_null_company_never(spark):
    rows = [("a1", None, "DS", D(2024, 1, 1)), ("a2", None, "DS", D(2024, 1, 31)),
            ("a3", None, "DS", D(2024, 3, 1))]
    assert _flags(spark, rows) == [False, False, False]


def test_equal_dates_first_by_id(spark):
    rows = [("b", "C", "DS", D(2024, 1, 1)), ("a", "C", "DS", D(2024, 1, 1)), ("c", "C", "DS", D(2024, 1, 1))]
    assert _flags(spark, rows) == [False, True, True]


def test_null_date_never(spark):
    rows = [("a", "C", "DS", D(2024, 1, 1)), ("b", "C", "DS", None)]
    assert _flags(spark, rows) == [False, False]


def test_hot_key_matches_bruteforce(spark):
    # one (company, title) key holding most rows: same answer as the sequential rule
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        comp = "HOT" if i % 3 else f"C{i % 17}"
        rows.append((f"p{i:05d}", comp, "DS", D(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))))
    got = dict(zip(sorted(r[0] for r in rows), _flags(spark, rows)))
    want = {}
    by_key = {}
    for pid, comp, title, d in rows:
        by_key.setdefault((comp, title), []).append((d, pid))
    for items in by_key.values():
        items.sort()
        prev = None
        for d, pid in items:
            want[pid] = prev is not None and (d - prev).days <= 30
            prev = d
    assert got == want
