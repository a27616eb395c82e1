"""Column expressions for the cleaning and conforming rules.

All are built-in Spark expressions (whole-stage codegen, no Python UDF). Each
notes the behaviour it has to reproduce where the obvious Spark call differs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.schemas import MONEY

ColumnOrName = Column | str

# Word split used by the title-case rule (a run of letters or a
# run of non-letters) and the zip width.
TITLE_TOKEN = r"(\p{L}+|\P{L}+)"
ZIP_WIDTH = 5
WEEKEND_DAYS = (5, 6)  # Monday = 0


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_case(c: ColumnOrName) -> Column:
    """Python ``str.title()``: upper-case the first letter of every run of
    letters, lower-case the rest. ``initcap`` only splits on spaces and would
    give ``D'oeste`` / ``Mogi-guacu`` / ``(rj)``."""
    tokens = F.regexp_extract_all(_c(c), F.lit(TITLE_TOKEN), 1)
    return F.array_join(
        F.transform(tokens, lambda t: F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))),
        "")


def zfill(c: ColumnOrName, width: int = ZIP_WIDTH) -> Column:
    """``str(x).zfill(width)``: pad with zeros after an optional sign, never
    truncate (``lpad`` alone cuts longer values). NULL stays NULL."""
    s = _c(c).cast("string")
    signed = s.startswith("-") | s.startswith("+")
    padded_signed = F.concat(F.substring(s, 1, 1), F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0"))
    return (F.when(F.length(s) >= width, s)
            .when(signed, padded_signed)
            .otherwise(F.lpad(s, width, "0")))


def fill_int(c: ColumnOrName, value: float = 1.0) -> Column:
    """``fillna(value).astype(int)``: NULL and NaN become ``value``; the cast
    truncates toward zero (2.9 -> 2)."""
    x = _c(c).cast("double")
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(float(value))).cast("int")


def nan_to_null(c: ColumnOrName) -> Column:
    x = _c(c)
    return F.nanvl(x, F.lit(None).cast("double"))


def day_diff(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``(end - start).total_seconds() / 86400`` as a double; keeps the
    fraction of a day, NULL if either side is NULL."""
    a = _c(start).cast("timestamp_ntz")
    b = _c(end).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", a, b).cast("double") / F.lit(86400.0)


def to_varchar(c: ColumnOrName, n: int) -> Column:
    """``::varchar(n)`` truncates; a Spark cast to varchar does not."""
    return F.substring(_c(c).cast("string"), 1, n)


# Amounts are summed at this scale; rounding to cents happens once, at the end.
AMOUNT = "decimal(18,6)"
_UNITS, _UNITS_PER_CENT = 10**6, 10**4


def money(c: ColumnOrName) -> Column:
    """Exact money: double -> decimal(18,6) before any sum."""
    return _c(c).cast(AMOUNT)


def avg_money(total: ColumnOrName, n: ColumnOrName) -> Column:
    """round(total / n, 2), half away from zero, computed exactly in integer
    millionths: sign * ((2|units| + c) div 2c) / 100 with c = 10^4 n. NULL when
    n is 0 or NULL."""
    big = "decimal(38,0)"
    cnt = F.nullif(_c(n).cast("long"), F.lit(0))
    cents = (_c(total) * _UNITS).cast(big)
    cnt = cnt * _UNITS_PER_CENT
    num = (F.abs(cents) * 2 + cnt).cast(big)
    den = (cnt * 2).cast(big)
    whole = ((num - F.pmod(num, den)) / den).cast(big)  # exact integer quotient
    return (F.when(cents < 0, -whole).otherwise(whole) / 100).cast(MONEY)


def run_date_lit(run_date: _dt.date | str | None) -> Column:
    if run_date is None:
        return F.current_date()
    return F.lit(str(run_date)).cast("date")


def is_weekend(d: ColumnOrName) -> Column:
    return F.weekday(_c(d)).isin(*WEEKEND_DAYS)
