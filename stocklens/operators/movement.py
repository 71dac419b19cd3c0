"""Inventory movement: month-to-month direction over a year and the last move."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.grain import IX, around, sum_or_zero
from stocklens.functions.semantics import (DEAL, date_key, finite, month_index, month_start, no_date, pdiv,
                                           present)
from stocklens.operators.dates import BucketRange, bucket

SPAN = 12
# Direction labels and the counted spans (table prefix -> number of changes).
UP, DOWN, NO_INV, STATIC = "Up", "Down", "No Inv", "Static"
SPANS = {"TWELVE_MONTH": 11, "SIX_MONTH": 5}


def movement_matrix(fact_inv: DataFrame, months: int = SPAN,
                    series: Sequence[str] = (DEAL, "SKU_SEQ_ID")) -> DataFrame:
    """Quantity of each of the last ``months`` months (``QTY_M0`` newest) and the changes between.

    A missing month counts as 0. ``MOVE_i`` compares month i with month i+1; equal quantities are
    'No Inv', so 'Static' never shows at this level.
    """
    day = "INVENTORY_DATE" if "INVENTORY_DATE" in fact_inv.columns else "BOM_INV_DATE"
    rows = (fact_inv.withColumn("BOM_INV_DATE", month_start(F.col(day)))
            .dropna(subset=[*present(fact_inv, ["SKU_SEQ_ID"]), *series, "BOM_INV_DATE"])
            .groupBy(*series, "BOM_INV_DATE")
            .agg(sum_or_zero("QUANTITY_ON_HAND").alias("TOTAL_QUANTITY"),
                 sum_or_zero("TOTAL_COST_EXTENDED").alias("TOTAL_COST")))
    rows = rows.withColumn(IX, month_index(F.col("BOM_INV_DATE")))
    rows = rows.withColumns({
        f"QTY_M{i}": F.coalesce(F.sum("TOTAL_QUANTITY").over(around(series, -i, -i)), F.lit(0.0))
        for i in range(months)}).drop(IX)

    def move(i: int) -> Column:
        newer, older = F.col(f"QTY_M{i}"), F.col(f"QTY_M{i + 1}")
        return F.when(newer < older, DOWN).when(newer > older, UP).otherwise(NO_INV)

    return rows.withColumns({f"MOVE_{i}": move(i) for i in range(months - 1)})


def movement_summary(matrix: DataFrame, ranges: Sequence[BucketRange],
                     insert_date: date | None = None) -> DataFrame:
    """FACT_INV_MVMT: direction counts, categories and the last month that moved."""
    changes = [c for c in matrix.columns if c.startswith("MOVE_")]
    series = matrix.columns[:matrix.columns.index("BOM_INV_DATE")]

    def count(label: str, n: int) -> Column:
        total = F.lit(0)
        for c in changes[:n]:
            total = total + F.when(F.col(c) == label, 1).otherwise(0)
        return total

    counts, kinds = {}, {}
    for span, n in SPANS.items():
        for label in (UP, DOWN, NO_INV, STATIC):
            counts[f"{span}_{label.upper().replace(' ', '_')}"] = count(label, n)
        up, down = F.col(f"{span}_UP") != 0, F.col(f"{span}_DOWN") != 0
        kinds[f"{span}_MVMT_CAT"] = F.when(up & down, "Up/Down").when(up, UP).when(down, DOWN).otherwise(STATIC)

    month = F.col("BOM_INV_DATE")
    last = F.coalesce(*[F.when(F.col(c) != NO_INV, i) for i, c in enumerate(changes)])
    df = matrix.withColumns({**counts, "_LAST": last}).withColumns(kinds)
    df = df.withColumn("_LAST_DATE", F.add_months(month, -F.col("_LAST")))
    df = df.withColumn("_LAST_DAYS", F.datediff(month, F.col("_LAST_DATE")))
    return df.select(
        *series, "BOM_INV_DATE", date_key(month).alias("DATE_KEY"), "TOTAL_COST", "TOTAL_QUANTITY",
        F.coalesce(finite(pdiv(F.col("TOTAL_COST"), F.col("TOTAL_QUANTITY"))), F.lit(0.0)).alias("CPU"),
        *counts, *kinds,
        F.coalesce("_LAST", F.lit(0)).alias("MONTHS_LAST_MOVE"), F.lit(0).alias("MOST_LAST_MOVE"),
        F.coalesce("_LAST_DATE", no_date()).alias("LAST_MOVE_DATE"),
        F.coalesce("_LAST_DAYS", F.lit(0)).alias("LAST_MOVE_DAYS"),
        F.coalesce(bucket(F.col("_LAST_DAYS"), ranges), F.lit("0")).alias("LASTMOVE_BUCKET_SEQ_ID"),
        F.lit(insert_date).cast("date").alias("INSERT_DATE"))


def inventory_movement(fact_inv: DataFrame, ranges: Sequence[BucketRange],
                       series: Sequence[str] = (DEAL, "SKU_SEQ_ID"), insert_date: date | None = None) -> DataFrame:
    return movement_summary(movement_matrix(fact_inv, SPAN, series), ranges, insert_date)
