"""Column expressions shared by all plans (F-01 … F-12).

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it stays inside
whole-stage code generation; no Python UDFs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_TYPES = {
    "string": "string",
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "long": "bigint",
    "double": "double",
    "boolean": "boolean",
    "bool": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}


def typed(col: str | Column, type_name: str) -> Column:
    """F-01: lenient cast. ANSI mode raises on bad text, so a bad value becomes NULL instead."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(_TYPES.get(type_name, type_name))


def money_sum(col: str | Column) -> Column:
    """Sum of money through DECIMAL(18,2) so totals do not depend on summation order."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(18,2)"))


def as_double(c: Column) -> Column:
    return c.cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """A-08 / F-07: ``num / NULLIF(den, 0)`` in double arithmetic (NULL on a zero divisor)."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, scale: int = 1) -> Column:
    """Percent rounded half away from zero (SQL ``round``), as double."""
    return F.round(F.lit(100.0) * safe_div(num, den), scale).cast("double")


def round_half_up(c: Column, scale: int = 0) -> Column:
    """F-08: SQL rounding (half away from zero)."""
    return F.round(c, scale)


def round_half_even(c: Column, scale: int = 0) -> Column:
    """F-09: Python ``round`` (banker's rounding)."""
    return F.bround(c, scale)


def trunc_int(c: Column) -> Column:
    """F-10: truncation toward zero, like Python ``int(x)``."""
    return c.cast("long")


def days_between(start: str | Column, end: str | Column) -> Column:
    """F-03: whole days from ``start`` to ``end`` (Spark ``datediff(end, start)``), as bigint."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.datediff(e, s).cast("bigint")


def week_start(c: str | Column) -> Column:
    """F-04: Monday of the week, as a date."""
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("week", col).cast("date")


def month_start(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_trunc("month", col).cast("date")


def date_lit(d: _dt.date | str) -> Column:
    return F.lit(d if isinstance(d, str) else d.isoformat()).cast("date")


def ts_lit(t: _dt.datetime | str) -> Column:
    return F.lit(t if isinstance(t, str) else t.isoformat(sep=" ")).cast("timestamp")


def zero_floor(c: Column) -> Column:
    """F-07: ``max(0, x)`` with NULL treated as 0 first (greatest skips NULLs)."""
    return F.greatest(F.lit(0), F.coalesce(c, F.lit(0)))


def padded_id(prefix: str, c: Column, width: int) -> Column:
    """Identifier such as ``STU-004``: prefix + number zero-padded to ``width``; longer numbers
    are kept whole (``lpad`` alone would cut them and merge distinct ids)."""
    s = c.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0")))


def pick(values: list[str], index: Column) -> Column:
    """Element of a fixed list by a 0-based integer column (NULL outside the list)."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.get(arr, index.cast("int"))
