"""Months that came or changed: recompute the rows whose windows they touch, and only these.

A windowed operator reads some months before and after a row's own (``Reach``), so a changed month touches the rows from
``after`` months before it to ``before`` months after it; those rows need the months within reach of them. Monthly tables
and results are stored in one folder per month (``write_months``), so both are partition filters: a month appended to
ten years of trailing half-years reads six folders and writes one.

What a result says about a series' whole life (its first receipt, first and last sale) may change in rows that no window
touches. It is therefore kept apart, as one row per series (``lifetimes``), and put into the rows as they are
read (``with_lifetimes``); a later month is added to it by ``merged_lifetimes`` without its history.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions.semantics import present
from stocklens.sources.staging import delete, stage


class Reach(NamedTuple):
    """Months that a row reads before and after its own."""
    before: int = 0
    after: int = 0


def trailing_reach(n: int) -> Reach:
    return Reach(before=n - 1)


MOVEMENT_REACH, LEAD_REACH = Reach(before=11), Reach(after=3)


def _shifted(month: date, by: int) -> date:
    at = month.year * 12 + month.month - 1 + by
    return date(at // 12, at % 12 + 1, 1)


def touched_months(changed: Iterable[date], reach: Reach) -> list[date]:
    """Months whose rows read a changed month."""
    return sorted({_shifted(m, k) for m in changed for k in range(-reach.after, reach.before + 1)})


def needed_months(touched: Iterable[date], reach: Reach) -> list[date]:
    """Months that the rows of the touched months read."""
    return sorted({_shifted(m, k) for m in touched for k in range(-reach.before, reach.after + 1)})


def of_months(df: DataFrame, month: str, months: Sequence[date]) -> DataFrame:
    """Rows of some months; a partition filter where the table is stored by month."""
    return df.where(F.col(month).isin([F.lit(m) for m in months]))


def recomputed(compute: Callable[..., DataFrame], tables: Sequence[tuple[DataFrame, str]], changed: Iterable[date], reach: Reach,
               month: str = "BOM_INV_DATE") -> tuple[DataFrame, list[date]]:
    """(result rows of the touched months, those months), from the months in reach of (table, its month column) alone.

    The rows are stored aside, so that they may replace folders they were read from.
    """
    touched = touched_months(changed, reach)
    needed = needed_months(touched, reach)
    result = compute(*[of_months(df, column, needed) for df, column in tables])
    return stage(of_months(result, month, touched), "recomputed-months"), touched


def write_months(df: DataFrame, path: str, month: str, months: Sequence[date] | None = None) -> None:
    """Write a table by month; with ``months``, replace these and leave the others as they are.

    Named months without rows are emptied. The rows must not come from the folders they replace. A reader that overlaps the
    write may see some of the months replaced, so publish what is read meanwhile (``sources.published``).
    """
    if months is not None:
        df = of_months(df, month, months)
        for m in months:
            delete(df.sparkSession, f"{path}/{month}={m}")
    df.hint("rebalance", month).write.mode("append" if months is not None else "overwrite").partitionBy(month).parquet(path)


def read_months(spark: SparkSession, path: str, month: str, like: DataFrame) -> DataFrame:
    """A table stored by month, with the columns and types of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def lifetimes(inv_m: DataFrame, sale_m: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First receipt, first and last sale month of each series: one hash aggregate over keys and months."""
    day = F.lit(None).cast("date")
    both = inv_m.select(*keys, F.col("BOM_INV_DATE").alias("_RECEIVED"), day.alias("_SOLD")).unionByName(
        sale_m.select(*keys, day.alias("_RECEIVED"), F.col("BEG_MO").alias("_SOLD")))
    return both.groupBy(*keys).agg(F.min("_RECEIVED").alias("_RECEIPT"), F.min("_SOLD").alias("_FIRST"), F.max("_SOLD").alias("_LAST"))


def merged_lifetimes(*parts: DataFrame) -> DataFrame:
    """Lifetimes over all months of which each part knows some."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    keys = [c for c in whole.columns if c not in ("_RECEIPT", "_FIRST", "_LAST")]
    return whole.groupBy(*keys).agg(F.min("_RECEIPT").alias("_RECEIPT"), F.min("_FIRST").alias("_FIRST"), F.max("_LAST").alias("_LAST"))


def with_lifetimes(rows: DataFrame, life: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows with their series' dates as of now; a date that a row leaves out (no sale in its window) stays null."""
    life = life.withColumnsRenamed({k: f"_OF_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_OF_{k}")) for k in keys]
    sold = F.col("FIRST_SALE_DATE").isNotNull() if "FIRST_SALE_DATE" in rows.columns else F.lit(False)
    now = {"FIRST_RECEIPT_DATE": F.col("_RECEIPT"), "FIRST_SALE_DATE": F.when(sold, F.col("_FIRST")),
           "LAST_SALES_DATE": F.when(sold, F.col("_LAST")), "INTRODUCTION_DATE": F.when(sold, F.least("_FIRST", "_RECEIPT"))}
    held = present(rows, now)
    return rows.join(life, on, "left").select(*[now[c].alias(c) if c in held else F.col(c) for c in rows.columns])
