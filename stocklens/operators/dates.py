"""First and last activity dates, age in days and age buckets of every series and month."""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.grain import monthly, whole
from stocklens.functions.semantics import NO_DATE, SERIES_COLUMNS, no_date, series_keys

SALE_DATES = ["FIRST_SALE_DATE", "LAST_SALES_DATE"]
RECEIPT_DATES = ["FIRST_RECEIPT_DATE", "LAST_RECEIPT_DATE"]

# Age column -> (the date it is counted from, its bucket column).
AGES = {
    "LAST_SALES_DAYS": ("LAST_SALES_DATE", "LAST_SALE_DATE_BUCKET"),
    "FIRST_SALES_DAYS": ("FIRST_SALE_DATE", "FIRST_SALE_DATE_BUCKET"),
    "INTRODUCTION_DAYS": ("INTRODUCTION_DATE", "INTRODUCTION_BUCKET"),
    "LAST_RECEIPT_DAYS": ("LAST_RECEIPT_DATE", "LAST_RECEIPT_DATE_BUCKET"),
    "FIRST_RECEIPT_DAYS": ("FIRST_RECEIPT_DATE", "FIRST_RECEIPT_DATE_BUCKET"),
}
BUCKET_COLUMNS = [bucket for _, bucket in AGES.values()]
STAGING_DATES = [*SALE_DATES, *RECEIPT_DATES, "INTRODUCTION_DATE"]


#: Ranges that are one CASE; each is a comparison per row there.
CASE_RANGES = 64


class BucketRange(NamedTuple):
    lower: int
    upper: int
    value: str


def activity_dates(df: DataFrame, keys: Sequence[str], month_col: str, gate: str,
                   first: str, last: str) -> DataFrame:
    """First and last month with a non-zero ``gate`` total, on every (keys, month) row."""
    totals = monthly(df, keys, month_col, [gate])
    active = F.when(F.col(gate) != 0, F.col(month_col))
    return totals.select(
        *keys, month_col,
        F.coalesce(F.min(active).over(whole(keys)), no_date()).alias(first),
        F.coalesce(F.max(active).over(whole(keys)), no_date()).alias(last))


def exchange_dates(sale: DataFrame, inv: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Give each side the other side's dates; a series the other side lacks gets 1900-01-01.

    Both inputs arrive partitioned by the keys, so neither the distinct nor the joins move rows.
    """
    def key_columns(df: DataFrame) -> set[str]:
        return set(df.columns) & {*SERIES_COLUMNS, *keys}

    if key_columns(sale) != key_columns(inv):
        raise ValueError(f"sales keys {sorted(key_columns(sale))} differ from "
                         f"inventory keys {sorted(key_columns(inv))}")

    def with_dates(df: DataFrame, other: DataFrame, names: list[str]) -> DataFrame:
        joined = df.join(other.select(*keys, *names).distinct(), list(keys), "left")
        return joined.withColumns({n: F.coalesce(n, no_date()) for n in names})

    return with_dates(sale, inv, RECEIPT_DATES), with_dates(inv, sale, SALE_DATES)


def introduction_date(first_sale: Column, first_receipt: Column) -> Column:
    """Earlier of two known dates, the known one of two, NULL when the receipt is NULL."""
    none = F.lit(NO_DATE).cast("date")
    return (F.when(first_receipt.isNull(), first_receipt)
            .when(first_receipt == none, first_sale)
            .when(first_sale == none, first_receipt)
            .otherwise(F.least(first_sale, first_receipt)))


def age_days(df: DataFrame, anchor: str) -> DataFrame:
    """Days from each activity date to ``anchor``; negative for activity after that month."""
    return df.withColumns({days: F.datediff(F.col(anchor), F.col(since))
                           for days, (since, _) in AGES.items()})


class Piece(NamedTuple):
    """Days from ``lower`` up to the next piece's have this value, or none."""
    lower: int
    value: str | None


def disjoint_pieces(ranges: Sequence[BucketRange]) -> list[Piece]:
    """Overlapping last-match-wins ranges as sorted pieces that don't overlap.

    A sweep over the range ends: a heap holds the open ranges, the last in the list on top, and gives the value from one end to
    the next. n ranges take n log n steps and give at most 2 n pieces. Neighbours of equal value are one piece.
    """
    starts = sorted((r.lower, i) for i, r in enumerate(ranges) if r.lower <= r.upper)
    ends = sorted({x for r in ranges if r.lower <= r.upper for x in (r.lower, r.upper + 1)})
    pieces: list[Piece] = []
    opened: list[int] = []
    nxt = 0
    for end in ends:
        while nxt < len(starts) and starts[nxt][0] == end:
            heapq.heappush(opened, -starts[nxt][1])
            nxt += 1
        while opened and ranges[-opened[0]].upper < end:
            heapq.heappop(opened)
        value = ranges[-opened[0]].value if opened else None
        if not pieces or pieces[-1].value != value:
            pieces.append(Piece(end, value))
    return pieces


def piece_of(days: Column, pieces: Sequence[Piece]) -> Column:
    """Value of the piece that holds ``days``: a binary search over its sorted lower ends, halving its step each time.

    The pieces are two array literals, whose size the list of ranges bounds; log2 of their number is the work per row, and
    nothing is joined.
    """
    if not pieces:
        return F.lit(None).cast("string")
    lowers = F.array(*[F.lit(p.lower).cast("bigint") for p in pieces])
    values = F.array(*[F.lit(p.value).cast("string") for p in pieces])
    top = 1 << len(pieces).bit_length() - 1
    steps = F.array(*[F.lit(top >> i) for i in range(top.bit_length())])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(lowers, at + step - 1) <= days, at + step).otherwise(at))
    return F.when(found > 0, F.get(values, found - 1))


def bucket(days: Column, ranges: Sequence[BucketRange]) -> Column:
    """Value of the last range holding ``days`` (both bounds inclusive), NULL when none does.

    A short list becomes one CASE; a longer one is cut into disjoint pieces that a binary search looks up. No join is needed.
    """
    if not ranges:
        return F.lit(None).cast("string")
    if len(ranges) > CASE_RANGES:
        return piece_of(days, disjoint_pieces(ranges))
    out = None
    for r in reversed(ranges):
        inside = days.between(r.lower, r.upper)
        out = F.when(inside, r.value) if out is None else out.when(inside, r.value)
    return out


def bucketize(df: DataFrame, day_col: str, out_col: str, ranges: Sequence[BucketRange]) -> DataFrame:
    return df.withColumn(out_col, bucket(F.col(day_col), ranges))


def age_buckets(df: DataFrame, ranges: Sequence[BucketRange]) -> DataFrame:
    return df.withColumns({b: bucket(F.col(days), ranges) for days, (_, b) in AGES.items()})


def age_columns(df: DataFrame, anchor: str, ranges: Sequence[BucketRange]) -> DataFrame:
    """Introduction date, ages and buckets of rows that carry the four activity dates."""
    intro = introduction_date(F.col("FIRST_SALE_DATE"), F.col("FIRST_RECEIPT_DATE"))
    return age_buckets(age_days(df.withColumn("INTRODUCTION_DATE", intro), anchor), ranges)


def bucket_staging(sale: DataFrame, inv: DataFrame,
                   ranges: Sequence[BucketRange]) -> tuple[DataFrame, DataFrame]:
    """The two staging tables: (TEMP_SALESBUCKET, TEMP_INVBUCKET)."""
    keys = series_keys(inv)
    if keys != series_keys(sale):
        raise ValueError(f"sales keys {series_keys(sale)} differ from inventory keys {keys}")
    inv_dates = activity_dates(inv, keys, "BOM_INV_DATE", "TOTAL_COST_EXTENDED", *RECEIPT_DATES)
    sale_dates = activity_dates(sale, keys, "BEG_MO", "QUANTITY_SOLD", *SALE_DATES)
    sale_all, inv_all = exchange_dates(sale_dates, inv_dates, keys)
    return age_columns(sale_all, "BEG_MO", ranges), age_columns(inv_all, "BOM_INV_DATE", ranges)
