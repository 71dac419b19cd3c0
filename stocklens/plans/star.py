"""The whole appraisal: two input tables to the full set of output tables, all deals in one plan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions import census
from stocklens.functions.grain import (INVENTORY_MEASURES, PICKED_NUMBERS, SALES_MEASURES, condense,
                                       monthly_inventory, monthly_sales)
from stocklens.functions.schema import FRAMES
from stocklens.functions.semantics import DEAL, SERIES_COLUMNS, present, series_keys
from stocklens.operators.cycles import margin_cycle, sales_cycle
from stocklens.operators.dates import BucketRange, bucket_staging
from stocklens.operators.demand import HORIZONS, demand_facts, demand_windows
from stocklens.operators.dims import DIM_KEYS, SKU_ATTRIBUTES, SKU_KEYS, dim_category, dim_sku, distinct_ids, id_clashes
from stocklens.operators.facts import GRAIN_DATES, NO_GRAIN, fact_inventory, fact_sales
from stocklens.operators.fifo import fifo
from stocklens.operators.movement import inventory_movement
from stocklens.operators.quintile import sales_quintile
from stocklens.operators.sellthru import lead_sales, sell_through
from stocklens.plans.outputs import conform_table
from stocklens.sources.published import manifest, read_published, write_run
from stocklens.sources.staging import small_side, stage

Cut = Callable[[DataFrame, str], DataFrame]

# All that outputs use of a raw row besides its measures. Anything else, such as an invoice
# number, would make each row its own group.
MONTHS = ["BOM_INV_DATE", "EOM_INV_DATE", "BEG_MO", "EOM_DATE"]
USED_COLUMNS = [DEAL, *SERIES_COLUMNS, "SKU", *MONTHS, "INVENTORY_DATE", *GRAIN_DATES, *SKU_ATTRIBUTES, *PICKED_NUMBERS]


# The tables of a run.
OUTPUT_TABLES = ["TEMP_INVBUCKET", "TEMP_SALESBUCKET", "DIM_CATEGORY", "DIM_SKU", "FACT_INVENTORY", "FACT_SALES",
                 *[f"FACT_{word}_MONTH_{kind}" for word in HORIZONS.values() for kind in ("INVENTORY", "ANNUALIZED")],
                 "FACT_TWO_MONTH_QUINTILE", "FACT_INV_MVMT", "FIFO", "FACT_GROSS_MARGIN_CYCLE", "FACT_SALES_CYCLE",
                 "FACT_SELL_THRU"]


def both_sided_deals(sale: DataFrame, inv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Drop deals that lack sales or lack inventory."""
    held = small_side(inv.select(DEAL).distinct(), "deals-held")
    sold = small_side(sale.select(DEAL).distinct(), "deals-sold")
    return sale.join(held, DEAL, "left_semi"), inv.join(sold, DEAL, "left_semi")


def laid_out(df: DataFrame, side: str, other: DataFrame) -> DataFrame:
    """Condensed rows (joined with the layout) as operators take them.

    Absent texts are marked; rows without a grain date that their deal has are left out of facts by ``_NO_GRAIN``.
    """
    df = census.mark_absent(df, [*census.OPTIONAL_KEYS, *SKU_ATTRIBUTES], side, other.columns)
    missing = [F.col(c).isNull() & ~census.lacks(side, c) for c in present(df, GRAIN_DATES)]
    return df.withColumn(NO_GRAIN, reduce(Column.__or__, missing, F.lit(False))).drop(census.SALE_COLUMNS, census.INV_COLUMNS)


def run_deals(sale: DataFrame, inv: DataFrame, ranges: Sequence[BucketRange],
              insert_date: date | None = None, quintile_months: Sequence[int] = (2,),
              cut: Cut = stage, sale_census: DataFrame | None = None,
              inv_census: DataFrame | None = None, stored: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """All output tables by name, under canonical headers.

    Deals may differ in their columns: each is read by its own layout (``functions.census``), which the censuses give;
    without them a deal has the columns it holds any value in. A column that a deal lacks is null in its outputs.

    ``stored`` holds the dimensions of earlier runs (``stored_dimensions``): their rows and ids stay, and only keys they lack are added.

    Raw rows are scanned once per side, into condensed tables that hold every column an output
    uses (``USED_COLUMNS``); others are left out. ``cut`` stores those and the other tables that many outputs read (dimensions, base
    facts, monthly sums, trailing windows); pass ``lambda df, name: df`` to leave them lazy.
    """
    sale = cut(condense(census.margin_parts(sale), [*SALES_MEASURES, *census.MARGIN_PARTS], USED_COLUMNS), "sales-condensed")
    inv = cut(condense(inv, INVENTORY_MEASURES, USED_COLUMNS), "inventory-condensed")
    sale, inv = both_sided_deals(sale, inv)
    layout = small_side(census.deal_layout(sale, inv, sale_census, inv_census), "deal-layout")
    census.check_layout(layout)
    if sale_census is not None or inv_census is not None:
        unknown = [r[0] for r in sale.select(DEAL).distinct().join(layout, DEAL, "left_anti").orderBy(DEAL).limit(10).collect()]
        if unknown:
            raise ValueError(f"deals without a census: {unknown}")
    sale, inv = (laid_out(census.fill_margin_by_deal(sale.join(layout, DEAL)), census.SALE_COLUMNS, inv),
                 laid_out(inv.join(layout, DEAL), census.INV_COLUMNS, sale))
    keys = series_keys(inv)
    inv_m = cut(monthly_inventory(inv, keys, keep_null_keys=True), "inventory-months")
    sale_m = cut(monthly_sales(sale, keys, keep_null_keys=True), "sales-months")
    inv_known, sale_known = inv_m.dropna(subset=keys), sale_m.dropna(subset=keys)
    sale_staging, inv_staging = bucket_staging(sale_known, inv_known, ranges)
    sale_staging, inv_staging = cut(sale_staging, "sales-staging"), cut(inv_staging, "inventory-staging")
    categories, skus = dimensions(sale, inv, layout, stored, cut)
    inv_fact = cut(fact_inventory(inv, inv_staging, skus, ranges, condensed=True, insert_date=insert_date),
                   "fact-inventory")
    sale_fact = cut(fact_sales(sale, sale_staging, skus, ranges, condensed=True, insert_date=insert_date),
                    "fact-sales")
    windows = cut(demand_windows(inv_fact, sale_known, keys), "demand-windows")

    tables = {"TEMP_INVBUCKET": inv_staging, "TEMP_SALESBUCKET": sale_staging, "DIM_CATEGORY": categories,
              "DIM_SKU": skus, "FACT_INVENTORY": inv_fact, "FACT_SALES": sale_fact}
    tables |= demand_facts(inv_fact, sale_known, keys, windows)
    for n in quintile_months:
        tables[f"FACT_{HORIZONS[n]}_MONTH_QUINTILE"] = sales_quintile(inv_m, sale_m, skus, n, insert_date=insert_date)
    tables["FACT_INV_MVMT"] = inventory_movement(inv_fact, ranges, insert_date=insert_date)
    tables["FIFO"] = fifo(inv_known, sale_known, skus, keys)
    tables["FACT_GROSS_MARGIN_CYCLE"] = margin_cycle(sale_m, inv_m, sale_fact, ranges, insert_date)
    tables["FACT_SALES_CYCLE"] = sales_cycle(sale_m, inv_m, sale_fact, ranges, insert_date)
    leads = lead_sales(inv_m, sale_m, keys, fact_inv=inv_fact)
    tables["FACT_SELL_THRU"] = sell_through(leads, keys, insert_date=insert_date)
    priced = [c for c in PICKED_NUMBERS if c in inv.columns]
    return {name: outgoing(df, layout, priced, insert_date) for name, df in tables.items()}


def dimensions(sale: DataFrame, inv: DataFrame, layout: DataFrame, stored: Mapping[str, DataFrame] | None,
               cut: Cut) -> tuple[DataFrame, DataFrame]:
    """The category and SKU dimension: the stored rows of the run's deals, then the keys that are new, with ids of their own."""
    def before(name: str) -> DataFrame | None:
        if stored is None or name not in stored:
            return None
        rows = stored[name].join(layout.select(DEAL), DEAL, "left_semi")  # stored by deal, so other deals' folders aren't read
        return rows.withColumns({c: F.coalesce(c, F.lit(census.ABSENT)) for c in present(rows, [*census.OPTIONAL_KEYS, "TRIM_SKU"])})

    def whole(new: DataFrame, old: DataFrame | None) -> DataFrame:
        return new if old is None else old.select(*present(old, new.columns)).unionByName(new, allowMissingColumns=True)

    old = before("DIM_CATEGORY")
    new = cut(dim_category(sale, inv, existing=old), "dim-category")
    new = distinct_ids(new, DIM_KEYS, "CATEGORY_SEQ_ID", old)
    old_skus = before("DIM_SKU")
    new_skus = cut(dim_sku(new, sale, inv), "dim-sku")
    new_skus = distinct_ids(new_skus, SKU_KEYS, "SKU_SEQ_ID", old_skus)
    if stored is None:
        return new, new_skus
    return cut(whole(new, old), "dim-category-whole"), cut(whole(new_skus, old_skus), "dim-sku-whole")


def stored_dimensions(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The dimensions that earlier runs have published, under canonical headers; none before the first run."""
    now = manifest(spark, root)
    frames = {frame: name for name, frame in FRAMES.items()}
    return {name: read_published(spark, root, name, now).withColumnsRenamed(frames).drop("INSERT_DATE")
            for name in ("DIM_CATEGORY", "DIM_SKU") if name in now["tables"]}


def outgoing(df: DataFrame, layout: DataFrame, priced: Sequence[str], insert_date: date | None) -> DataFrame:
    """An output as readers see it: an insert date, and null for what a deal lacks."""
    if "INSERT_DATE" not in df.columns:
        df = df.withColumn("INSERT_DATE", F.lit(insert_date).cast("date"))
    priced = present(df, priced)
    if priced:
        lacked = layout.select(DEAL, *[census.lacks(census.INV_COLUMNS, c).alias(f"_NO_{c}") for c in priced])
        df = df.join(lacked, DEAL, "left").select(
            *[F.when(~F.col(f"_NO_{c}"), F.col(c)).alias(c) if c in priced else F.col(c) for c in df.columns])
    return census.without_marks(df)


def write_tables(tables: dict[str, DataFrame], root: str) -> list[str]:
    """Write every table in output form and publish them as one run; refuses SKU ids that two natural keys share."""
    skus = tables["DIM_SKU"]
    if id_clashes(skus, present(skus, SKU_KEYS), "SKU_SEQ_ID").limit(1).count():
        raise ValueError("two SKU keys of one deal share a SKU_SEQ_ID")
    deals = [r[0] for r in skus.select(DEAL).distinct().collect()]  # one row per deal
    write_run({name: conform_table(df, name) for name, df in tables.items()}, root, deals)
    return [f"{root.rstrip('/')}/{name}" for name in tables]
