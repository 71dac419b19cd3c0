"""Base facts: monthly measures with dates, ages, buckets and SKU ids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions.grain import INVENTORY_MEASURES, SALES_MEASURES, condense, first_rows, sum_or_zero
from stocklens.functions.schema import fill_margin
from stocklens.functions.semantics import date_key, pdiv, present, series_keys
from stocklens.operators.dates import RECEIPT_DATES, SALE_DATES, BucketRange, age_columns

# Dates that refine a fact's grain when the input has them.
GRAIN_DATES = ["EXPIRATION_DATE", "ORDER_DATE", "SHIP_DATE"]
#: Set on condensed rows of several deals: true where a grain date that the row's deal has is missing.
NO_GRAIN = "_NO_GRAIN"


def sum_with_attributes(df: DataFrame, group: Sequence[str], measures: Sequence[str],
                        attributes: Sequence[str], condensed: bool = False) -> DataFrame:
    """Sum measures and pick one attribute row per group in one scan.

    Raw rows are condensed by the attributes first, a hash aggregate that combines map-side: only
    its small result meets the ordered pick, so a hot group is never sorted raw.
    """
    if not attributes:
        return df.groupBy(*group).agg(*[sum_or_zero(m).alias(m) for m in measures])
    slim = df if condensed else condense(df, measures, [*group, *attributes])
    ordered = [x for c in attributes for x in (F.col(c).isNull().alias(f"_{c}_MISSING"), F.col(c))]
    rows = slim.groupBy(*group).agg(*[sum_or_zero(m).alias(m) for m in measures],
                                    F.min(F.struct(*ordered)).alias("_FIRST"))
    return rows.select(*group, *measures, *[F.col("_FIRST").getField(c).alias(c) for c in attributes])


def sku_ids(dim_sku: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One SKU_SEQ_ID per series; the smallest when several raw SKUs trim to one TRIM_SKU."""
    return dim_sku.groupBy(*keys).agg(F.min("SKU_SEQ_ID").alias("SKU_SEQ_ID"))


def build_fact(df: DataFrame, dates: DataFrame, dim_sku: DataFrame, keys: Sequence[str],
               measures: Sequence[str], kind: str, ranges: Sequence[BucketRange],
               attributes: Sequence[str] | None = None, condensed: bool = False,
               insert_date: date | None = None) -> DataFrame:
    """Fact at keys x month (x order, ship and expiry date when present).

    ``condensed`` says that ``df`` comes from ``condense`` and need not be condensed again.
    Rows without a grain date are left out, or, where ``df`` says so itself (``NO_GRAIN``), those without one that their
    deal has. ``dates`` is the staging table of the same side. Its dates are constant per series, so they
    join on the keys alone and both joins share one exchange.
    """
    month = "BOM_INV_DATE" if kind == "inv" else "BEG_MO"
    df = fill_margin(df) if kind == "sale" else df
    group = [*keys, month, *present(df, GRAIN_DATES)]
    if NO_GRAIN in df.columns:
        df = df.where(~F.col(NO_GRAIN)).drop(NO_GRAIN).dropna(subset=[*keys, month])
    else:
        df = df.dropna(subset=group)
    if attributes is None:
        taken = {*group, *measures, "GROSS_MARGIN_$", "COGS_$", "NET_SALES_$"}
        attributes = [c for c in df.columns if c not in taken]
    fact = sum_with_attributes(df, group, measures, present(df, attributes), condensed)

    series_dates = dates.select(*keys, *SALE_DATES, *RECEIPT_DATES).distinct()
    fact = (fact.join(series_dates, list(keys), "left")
            .join(sku_ids(dim_sku, keys), list(keys), "left"))
    fact = age_columns(fact, month, ranges).withColumn("DATE_KEY", date_key(F.col(month)))
    fact = fact.withColumn("INSERT_DATE", F.lit(insert_date).cast("date"))
    if kind == "inv":
        unit_cost = F.when(F.col("QUANTITY_ON_HAND") == 0, 0.0).otherwise(
            pdiv(F.col("TOTAL_COST_EXTENDED"), F.col("QUANTITY_ON_HAND")))
        fact = fact.withColumns({"GROSS_INVENTORY_QUANTITY": F.col("QUANTITY_ON_HAND"),
                                 "GROSS_INVENTORY_COST": F.col("TOTAL_COST_EXTENDED"),
                                 "UNIT_COST": unit_cost})
    return fact


def fact_inventory(inv: DataFrame, dates: DataFrame, dim_sku: DataFrame,
                   ranges: Sequence[BucketRange], **options) -> DataFrame:
    return build_fact(inv, dates, dim_sku, series_keys(inv), INVENTORY_MEASURES, "inv", ranges, **options)


def fact_sales(sale: DataFrame, dates: DataFrame, dim_sku: DataFrame,
               ranges: Sequence[BucketRange], **options) -> DataFrame:
    return build_fact(sale, dates, dim_sku, series_keys(sale), SALES_MEASURES, "sale", ranges, **options)


def month_grain(fact: DataFrame, keys: Sequence[str], month: str, measures: Sequence[str]) -> DataFrame:
    """Collapse order, ship and expiry dates so that a fact has one row per series and month."""
    if not present(fact, GRAIN_DATES):
        return fact
    measures = present(fact, measures)
    rest = [c for c in fact.columns if c not in {*keys, month, *measures, *GRAIN_DATES}]
    sums = fact.groupBy(*keys, month).agg(*[sum_or_zero(m).alias(m) for m in measures])
    return sums.join(first_rows(fact, [*keys, month], rest), [*keys, month])
