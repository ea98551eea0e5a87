"""Date derivations (T5, T6, T9, T10, T11, T16) as native Column expressions."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date_safe(c) -> Column:
    """Coerce to DATE; unparseable -> null; time part dropped."""
    v = _col(c)
    return F.to_date(F.try_to_timestamp(v.cast("string")))


def quarter_label(date_col) -> Column:
    """T5: ``YYYYQn``; null date -> null."""
    d = _col(date_col)
    return F.when(d.isNotNull(),
                  F.concat(F.year(d).cast("string"), F.lit("Q"), F.quarter(d).cast("string")))


def _ntz_utc(ltz) -> Column:
    """Instant -> its UTC wall clock as timestamp_ntz, whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ltz.cast("timestamp_ntz"))


def utc_instant(ntz_utc) -> Column:
    """A timestamp_ntz holding a UTC wall clock -> the instant (timestamp), session-zone independent."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), _col(ntz_utc)).cast("timestamp")


def epoch_ms_to_date(c) -> Column:
    """Epoch milliseconds -> UTC calendar date; bad values -> null."""
    ms = _col(c).try_cast("bigint")
    return F.to_date(_ntz_utc(F.timestamp_millis(ms)))


def iso_to_naive_utc(c) -> Column:
    """ISO-8601 text with offset -> naive UTC timestamp (timestamp_ntz); bad -> null.
    The offset is applied and dropped independently of the session time zone."""
    return _ntz_utc(F.try_to_timestamp(_col(c)))


def anchor_date(value: str = "2020-01-01") -> Column:
    """Constant period-anchor date for sources without a date."""
    return F.lit(_dt.date.fromisoformat(value))


def snapshot_of(year_col, mapping: dict[int, int]) -> Column:
    """Year -> snapshot via a literal map; unmapped -> null."""
    kv = []
    for k, v in sorted(mapping.items()):
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), _col(year_col))
