"""Life cycles: a measure over the first 24 months from a series' first sale."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.functions.grain import IX, SIDE, by_known_keys, lifetime, monthly, stack
from stocklens.functions.schema import fill_margin
from stocklens.functions.semantics import DEAL, NOT_AVAILABLE, date_key, series_keys
from stocklens.operators.dates import BucketRange, age_columns
from stocklens.operators.facts import sku_ids

CYCLE_MONTHS = 24


def life_cycle(sale: DataFrame, inv: DataFrame, fact_sale: DataFrame, measure: str, prefix: str,
               ranges: Sequence[BucketRange], insert_date: date | None = None) -> DataFrame:
    """One row per series and sale month; the 24 cycle columns repeat on each row of a series.

    Missing keys read 'NA'. Such a series has no id in FACT_SALES and so no cycle. Sales and
    receipts meet in one stack: one exchange carries both.
    """
    keys = series_keys(sale, inv)
    text = [k for k in keys if k != DEAL]
    parts = zip(*[by_known_keys(df, text, NOT_AVAILABLE) for df in (sale, inv, sku_ids(fact_sale, keys))])
    return reduce(DataFrame.unionByName, [_life_cycle(*part, keys, measure, prefix, ranges, insert_date) for part in parts])


def _life_cycle(sale: DataFrame, inv: DataFrame, ids: DataFrame, keys: Sequence[str], measure: str, prefix: str,
                ranges: Sequence[BucketRange], insert_date: date | None) -> DataFrame:
    sale_m = monthly(sale, keys, "BEG_MO", [measure])
    received = inv.select(*keys, "BOM_INV_DATE").dropna().distinct()
    whole_life = lifetime(keys)
    st = stack(keys, sale=(sale_m, "BEG_MO"), inv=(received, "BOM_INV_DATE"))
    st = st.withColumns({
        "FIRST_SALE_DATE": F.min("BEG_MO").over(whole_life),
        "LAST_SALES_DATE": F.max("BEG_MO").over(whole_life),
        "FIRST_RECEIPT_DATE": F.min("BOM_INV_DATE").over(whole_life),
        "LAST_RECEIPT_DATE": F.max("BOM_INV_DATE").over(whole_life),
        "_AGE": F.col(IX) - F.min(F.when(F.col(SIDE) == "sale", F.col(IX))).over(whole_life),
    })
    names = [f"{prefix}_{i + 1:02d}" for i in range(CYCLE_MONTHS)]
    st = st.withColumns({c: F.sum(F.when(F.col("_AGE") == i, F.col(measure))).over(whole_life)
                         for i, c in enumerate(names)})
    rows = st.where(F.col(SIDE) == "sale").join(ids, keys, "left")
    rows = rows.withColumns({c: F.when(F.col("SKU_SEQ_ID").isNotNull(), F.coalesce(c, F.lit(0.0))) for c in names})
    rows = age_columns(rows, "BEG_MO", ranges)
    dates = ["FIRST_SALE_DATE", "LAST_SALES_DATE", "FIRST_RECEIPT_DATE", "LAST_RECEIPT_DATE", "INTRODUCTION_DATE"]
    ages = [c for c in rows.columns if c.endswith(("_DAYS", "_BUCKET"))]
    return rows.select(*keys, "SKU_SEQ_ID", "BEG_MO", date_key(F.col("BEG_MO")).alias("DATE_KEY"), measure,
                       *dates, *ages, *names, F.lit(insert_date).cast("date").alias("INSERT_DATE"))


def margin_cycle(sale: DataFrame, inv: DataFrame, fact_sale: DataFrame, ranges: Sequence[BucketRange],
                 insert_date: date | None = None) -> DataFrame:
    """FACT_GROSS_MARGIN_CYCLE."""
    return life_cycle(fill_margin(sale), inv, fact_sale, "GROSS_MARGIN_$", "GROSS_MARGIN_CYCLE", ranges, insert_date)


def sales_cycle(sale: DataFrame, inv: DataFrame, fact_sale: DataFrame, ranges: Sequence[BucketRange],
                insert_date: date | None = None) -> DataFrame:
    """FACT_SALES_CYCLE."""
    return life_cycle(sale, inv, fact_sale, "NET_SALES_$", "SALES_CYCLE", ranges, insert_date)
