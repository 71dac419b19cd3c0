"""Column arithmetic shared by all operators.

Numbers follow IEEE division (x/0 is an infinity, 0/0 is missing) but a missing number is always
NULL, never a stored NaN: Spark orders NaN above every number, which would turn "unknown > 30"
into true. All helpers are built-in expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Markers and labels the outputs carry.
NO_DATE = date(1900, 1, 1)
NEED_CAT = "NEED CAT"
NOT_AVAILABLE = "NA"
SALES_NO_INV = "Sales No Inv"

DEAL = "DEAL_ID"
SERIES_COLUMNS = ["LOCATION", "COUNTRY", "DIVISION", "INVENTORY_TYPE", "TRIM_SKU"]
DAYS_PER_MONTH = 365 / 12


def null_double() -> Column:
    return F.lit(None).cast("double")


def known(x: Column) -> Column:
    """``x`` with NaN turned into NULL."""
    return F.nanvl(x, null_double())


def pdiv(a: Column, b: Column) -> Column:
    """IEEE division without ANSI errors: x/0 is +-inf, 0/0 and inf/inf are NULL."""
    inf = F.lit(float("inf"))
    by_zero = F.when(a > 0, inf).when(a < 0, -inf)
    return F.when(b == 0, by_zero).otherwise(known(F.try_divide(a, b)))


def finite(x: Column) -> Column:
    """``x`` with infinities and NaN turned into NULL."""
    return F.when(F.abs(x) < float("inf"), x)


def both_least(a: Column, b: Column) -> Column:
    """Smaller of two values, NULL when either is NULL (``least`` alone skips NULLs)."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def month_index(d: Column) -> Column:
    """Months since year 0: consecutive months differ by exactly one."""
    return F.year(d) * 12 + F.month(d)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def date_key(d: Column) -> Column:
    """``yyyyMMdd`` text; integer arithmetic, which is far cheaper per row than a date pattern."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("string")


def no_date() -> Column:
    return F.lit(NO_DATE).cast("date")


def series_keys(*frames: DataFrame) -> list[str]:
    """DEAL_ID plus the series columns that every given frame has."""
    shared = set.intersection(*(set(f.columns) for f in frames))
    return [DEAL] + [c for c in SERIES_COLUMNS if c in shared]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in names if c in have]


def clean_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Infinities and missing numbers become 0, and so does the text 'nan' or a missing text.

    By default every number and no text column is cleaned; name text columns to include them.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if columns is None:
        columns = [n for n, t in types.items() if isinstance(t, T.NumericType)]
    cleaned = {}
    for name in columns:
        if isinstance(types[name], (T.DoubleType, T.FloatType)):
            cleaned[name] = F.expr(finite_sql(name, "0D"))
        elif isinstance(types[name], T.StringType):
            cleaned[name] = F.expr(f"coalesce(if(`{name}` = 'nan', '0', `{name}`), '0')")
        else:
            cleaned[name] = F.expr(f"coalesce(`{name}`, 0)").cast(types[name])
    return df.withColumns(cleaned) if cleaned else df


# SQL text of the same rules, for building columns by the hundred.

def finite_sql(name: str, otherwise: str = "null") -> str:
    return f"if(abs(`{name}`) < double('Infinity'), `{name}`, {otherwise})"


def product(a: str, b: str) -> Column:
    """Product of two columns, NULL for 0 x infinity."""
    return F.expr(f"nanvl(`{a}` * `{b}`, cast(null as double))")
