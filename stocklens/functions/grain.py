"""Bringing raw rows to the grain the operators work on, without hot-key trouble.

Raw tables may hold a third of their rows under one key, so every step from raw rows to the
monthly grain is a plain hash aggregate: Spark combines map-side and what crosses the network is
at most one row per key, month and map task. After it a key has one row per month, so windows
over a key are bounded by the calendar, not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions.semantics import known, month_index, present, series_keys

INVENTORY_MEASURES = ["QUANTITY_ON_HAND", "TOTAL_COST_EXTENDED"]
SALES_MEASURES = ["QUANTITY_SOLD", "NET_SALES_$", "GROSS_MARGIN_$", "COGS_$"]
# Numbers that facts take from the picked row rather than sum.
PICKED_NUMBERS = ["ORIGINAL_RETAIL_PRICE_EXTENDED"]

IX = "_MONTH_IX"
SIDE = "_SIDE"


def sum_or_zero(name: str) -> Column:
    """Sum that skips missing numbers and is 0 when all are missing."""
    return F.coalesce(F.sum(known(F.col(name).cast("double"))), F.lit(0.0))


def monthly(df: DataFrame, keys: Sequence[str], month_col: str, measures: Sequence[str],
            keep_null_keys: bool = False) -> DataFrame:
    """Sum the measures per key and month; rows with a missing key are dropped unless kept."""
    group = [*keys, month_col]
    df = df.dropna(subset=[month_col] if keep_null_keys else group)
    return df.groupBy(*group).agg(*[sum_or_zero(m).alias(m) for m in present(df, measures)])


def condense(df: DataFrame, measures: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Sum the measures over rows that agree in all other columns (or in ``columns``).

    Numbers among the rest never group: the smallest is kept, which is the one a pick of the
    smallest row would take. Columns outside ``columns`` are pruned from the scan. One hash aggregate with map-side combine. Everything later reads the result, so raw rows are
    scanned once, whatever number of tables is derived from them.
    """
    measures = present(df, measures)
    wanted = present(df, columns if columns is not None else df.columns)
    picked = [c for c in wanted if c in PICKED_NUMBERS]
    rest = [c for c in wanted if c not in {*measures, *picked}]
    return df.groupBy(*rest).agg(*[sum_or_zero(m).alias(m) for m in measures], *[F.min(c).alias(c) for c in picked])


def monthly_inventory(inv: DataFrame, keys: Sequence[str] | None = None,
                      keep_null_keys: bool = False) -> DataFrame:
    return monthly(inv, keys or series_keys(inv), "BOM_INV_DATE", INVENTORY_MEASURES, keep_null_keys)


def monthly_sales(sale: DataFrame, keys: Sequence[str] | None = None,
                  keep_null_keys: bool = False) -> DataFrame:
    return monthly(sale, keys or series_keys(sale), "BEG_MO", SALES_MEASURES, keep_null_keys)


def first_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
               priority: Column | None = None) -> DataFrame:
    """One whole row of ``columns`` per key: lowest priority first, then smallest values.

    The pick is combined map-side, so a hot key sends one row per map task. It sorts its input
    locally (text has no fixed-width buffer), so give it condensed rows rather than raw ones.
    """
    rank = priority if priority is not None else F.lit(0)
    slim = df.select(*keys, rank.alias("_RANK"), *columns)
    ordered = [F.col("_RANK")]
    for c in columns:
        ordered += [F.col(c).isNull().alias(f"_{c}_MISSING"), F.col(c)]
    picked = slim.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_FIRST"))
    return picked.select(*keys, *[F.col("_FIRST").getField(c).alias(c) for c in columns])


def by_known_keys(df: DataFrame, keys: Sequence[str], name: str, *unknown: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``keys`` are all known, and the others with ``name`` for each key that is missing or in ``unknown``.

    The two share no key, since a known one that reads ``name`` is with the others. So what groups by keys may run on either
    part: the first keeps its columns as they are and with them the layout it is stored in, where naming them
    would make new columns and shuffle all rows for the few that need a name.
    """
    named = {k: F.col(k).cast("string") for k in keys}
    known = reduce(Column.__and__, [F.coalesce(~x.isin(name, *unknown), F.lit(False)) for x in named.values()], F.lit(True))
    filled = {k: F.coalesce(F.when(x.isin(*unknown), None).otherwise(x) if unknown else x, F.lit(name)) for k, x in named.items()}
    return df.where(known).withColumns(named), df.where(~known).withColumns(filled)


def stack(keys: Sequence[str], **sides: tuple[DataFrame, str]) -> DataFrame:
    """Union monthly tables, each tagged with its side and month number.

    Operators that need two tables at related months (same month, trailing n, lead k) read them
    from RANGE frames over this stack: one exchange on the keys and one sort, where a join per
    month offset would cost an exchange each. Missing keys group together, as they should here.
    """
    parts = [df.withColumns({SIDE: F.lit(side), IX: month_index(F.col(month))})
             for side, (df, month) in sides.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def around(keys: Sequence[str], start: int, end: int):
    """Window over one series from ``start`` to ``end`` months relative to the row's month."""
    return Window.partitionBy(*keys).orderBy(IX).rangeBetween(start, end)


def lifetime(keys: Sequence[str]):
    """The whole series, ordered like ``around`` so that both run in one window operator."""
    return around(keys, Window.unboundedPreceding, Window.unboundedFollowing)


def whole(keys: Sequence[str]):
    """Window over one whole series of an unstacked table."""
    return Window.partitionBy(*keys)


def side(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """Rows of one side of a stack."""
    return df.where(F.col(SIDE) == name).select(*columns)
