"""Every operator as a query over the test tables: ``QUERIES[name](spark, sf_dir)``.

Results are laid out for comparison across engines: numbers on a 1e-4 grid, dates as text, and
without hashed ids and the insert date.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import nullcontext
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixtures as fx
from checks.fixtures import KEYS, RANGES
from stocklens.functions import schema as sc
from stocklens.functions.grain import INVENTORY_MEASURES, SALES_MEASURES, condense
from stocklens.functions.semantics import DEAL, clean_numeric, date_key
from stocklens.operators import cycles, dates, demand, dims, facts, fifo, movement, quintile, sellthru
from stocklens.plans import append
from stocklens.plans.outputs import conform_table
from stocklens.plans.star import OUTPUT_TABLES, dimensions, run_deals
from stocklens.sources.readers import read_output
from stocklens.sources.staging import bucket_count, shared_folder, shuffled_into, small_splits, stage
from stocklens.sources.writers import write_output

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
HIDDEN = {"SKU_SEQ_ID", "CATEGORY_SEQ_ID", "INSERT_DATE"}


def on_grid(name: str) -> Column:
    """Round to 1e-4 with the rounding edge moved off .5, where quotients of cents often fall."""
    return F.expr(f"rint(double(`{name}`) * 10000D - 0.0363D) / 10000D + 0D")


def comparable(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        if f.name in HIDDEN:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.NumericType):
            c = on_grid(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, *args):
    """Register a function of (spark, sf_dir, *args) under a name."""
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: comparable(fn(spark, sf_dir, *args))
        return fn
    return add


#: Stored lines take some 16 bytes each, and by part most are a group of their own: half a million of them a task, where they are
#: not read by bucket.
SPLIT_BYTES = 8 << 20
#: By part, lines and what is made of them are stored by series, in buckets of the lines of this much input: some 200,000 each.
BUCKET_BYTES = 4 << 20

_LINES: dict[tuple[str, str, bool], DataFrame] = {}
_BUCKETS: dict[tuple[str, str, bool], int] = {}


def by_series(spark: SparkSession, d: str, by_part: bool) -> dict:
    """How a folder's tables are staged: by part nearly every line is a series of its own, so lines are spread by series once
    and no table made of them is shuffled again."""
    key = (spark.sparkContext.applicationId, d, by_part)
    return {"by": KEYS, "buckets": _BUCKETS[key]} if key in _BUCKETS else {}


def stored_lines(spark: SparkSession, d: str, by_part: bool = False) -> DataFrame:
    """The joined order lines, stored once per session: both sides read them, so neither joins the tables again."""
    key = (spark.sparkContext.applicationId, d, by_part)
    if key not in _LINES:
        joined = fx.lines(spark, d, by_part)
        if by_part:
            _BUCKETS[key] = bucket_count(joined, BUCKET_BYTES)
        spread = by_series(spark, d, by_part)
        with shuffled_into(spark, spread["buckets"]) if spread else nullcontext():
            _LINES[key] = stage(joined, "order-lines", **spread)
    return _LINES[key]


_STAGED: dict[tuple[str, str, bool], tuple[DataFrame, DataFrame]] = {}


def monthly(spark: SparkSession, d: str, by_part: bool = False) -> tuple[DataFrame, DataFrame]:
    """Monthly (inventory, sales), staged once per session as in a full run.

    All analytical operators start from this grain; the stored order lines are scanned once per side.
    """
    key = (spark.sparkContext.applicationId, d, by_part)
    if key not in _STAGED:
        fx_line = stored_lines(spark, d, by_part)
        spread = by_series(spark, d, by_part)
        with small_splits(spark, SPLIT_BYTES) if by_part else nullcontext():
            _STAGED[key] = (stage(fx.inventory(fx_line), "inventory-months", **spread), stage(fx.sales(fx_line), "sales-months", **spread))
    return _STAGED[key]


def months(spark: SparkSession, d: str, by_part: bool = False) -> tuple[DataFrame, DataFrame]:
    """Monthly (inventory, sales) of series whose keys are all known."""
    return tuple(df.dropna(subset=KEYS) for df in monthly(spark, d, by_part))


class Base:
    """Monthly inputs with the dimension and base facts, each staged when first asked for: a query pays for what it reads."""

    def __init__(self, spark: SparkSession, d: str, by_part: bool):
        self.inv, self.sale = monthly(spark, d, by_part)
        self.inv_m, self.sale_m = self.inv.dropna(subset=KEYS), self.sale.dropna(subset=KEYS)
        self.spread = by_series(spark, d, by_part)

    @cached_property
    def skus(self) -> DataFrame:
        made = dims.dim_sku(dims.dim_category(self.sale, self.inv), self.sale, self.inv)
        with shuffled_into(made.sparkSession, self.spread["buckets"]) if self.spread else nullcontext():
            return stage(made, "dim-sku", **self.spread)

    @cached_property
    def fact_inv(self) -> DataFrame:
        inv_dates = dates.bucket_staging(self.sale, self.inv, RANGES)[1]
        return stage(facts.fact_inventory(self.inv, inv_dates, self.skus, RANGES), "fact-inventory", **self.spread)

    @cached_property
    def fact_sale(self) -> DataFrame:
        sale_dates = dates.bucket_staging(self.sale, self.inv, RANGES)[0]
        return stage(facts.fact_sales(self.sale, sale_dates, self.skus, RANGES), "fact-sales", **self.spread)


_BASES: dict[tuple[str, str, bool], Base] = {}


def base(spark: SparkSession, d: str, by_part: bool = False) -> Base:
    """The base tables of a folder, staged once per session as in a full run."""
    key = (spark.sparkContext.applicationId, d, by_part)
    if key not in _BASES:
        _BASES[key] = Base(spark, d, by_part)
    return _BASES[key]


def line_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Order lines as raw (inventory, sales) input with SKU and category."""
    fx_line = stored_lines(spark, d)
    return fx.doubles(fx.inventory_lines(fx_line)), fx.doubles(fx.sales_lines(fx_line))


_CONDENSED: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}


def condensed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Raw (inventory, sales) condensed and stored, the first step of a full run."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _CONDENSED:
        inv, sale = line_inputs(spark, d)
        _CONDENSED[key] = (stage(condense(inv, INVENTORY_MEASURES), "inventory-condensed"),
                           stage(condense(sale, SALES_MEASURES), "sales-condensed"))
    return _CONDENSED[key]


# --- typing and layout -----------------------------------------------------------------------

@query("cast_to_schema")
def _(spark, d):
    raw = spark.read.parquet(f"{d}/lineitem.parquet").select(
        *[F.col(c).cast("string").alias(c.upper()) for c in
          ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate", "l_suppkey")])
    return sc.cast_to_schema(raw, {"L_ORDERKEY": "int", "L_QUANTITY": "float", "L_RETURNFLAG": "str",
                                   "L_SHIPDATE": "datetime", "L_SUPPKEY": "decimal"})


def _untyped(spark, d):
    """Order lines as text, in which a seventh line's quantity and some dates don't fit their declared types."""
    line = spark.read.parquet(f"{d}/lineitem.parquet")
    seventh = F.col("l_linenumber") == 7
    columns = {DEAL: F.col("l_suppkey") % 3, "KEY": F.col("l_orderkey"), "LINE": F.col("l_linenumber"),
               "QUANTITY": F.when(seventh, F.concat(F.col("l_returnflag"), F.lit(" pcs"))).otherwise(F.col("l_quantity").cast("string")),
               "SHIPPED": F.when(seventh & (F.col("l_linestatus") == "F"), F.lit("soon")).otherwise(F.col("l_shipdate").cast("string"))}
    raw = line.select(*[c.cast("string").alias(n) for n, c in columns.items()])
    return sc.checked_cast(raw, {DEAL: "int", "KEY": "int", "QUANTITY": "float", "SHIPPED": "datetime", "LINE": "str"})


@query("checked_cast_good_rows")
def _(spark, d):
    return sc.good_rows(_untyped(spark, d))


@query("checked_cast_rejected_values")
def _(spark, d):
    return sc.rejected_values(_untyped(spark, d))


def _raw_headers(df: DataFrame, month: str) -> DataFrame:
    framed = sc.to_frames(df).withColumnRenamed(month, "BOM")
    return framed.toDF(*[c.lower() for c in framed.columns])


@query("canonicalise_sales")
def _(spark, d):
    return sc.canonicalise(_raw_headers(monthly(spark, d)[1], "BEG_MO"), "sale")


@query("canonicalise_inventory")
def _(spark, d):
    return sc.canonicalise(_raw_headers(monthly(spark, d)[0], "BOM_INV_DATE"), "inv")


@query("to_frames")
def _(spark, d):
    return sc.to_frames(monthly(spark, d)[0])


@query("upper_strings")
def _(spark, d):
    return sc.upper_strings(spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name", "p_type"))


@query("align_columns")
def _(spark, d):
    inv, sale = line_inputs(spark, d)
    sale, inv = sc.align_columns(sale.drop("CATEGORY_1"), inv.drop("SKU"),
                                 [DEAL, "TRIM_SKU", "SKU", "CATEGORY_1", "CATEGORY_2"])
    return sale.unionByName(inv).groupBy(*sale.columns).agg(F.count("*").alias("ROWS"))


@query("fill_gross_margin")
def _(spark, d):
    return sc.fill_margin(monthly(spark, d)[1].drop("GROSS_MARGIN_$"))


@query("fill_cogs")
def _(spark, d):
    return sc.fill_margin(monthly(spark, d)[1].drop("COGS_$"))


@query("fill_margin_both")
def _(spark, d):
    return sc.fill_margin(monthly(spark, d)[1].drop("COGS_$", "GROSS_MARGIN_$"))


@query("date_key")
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    return orders.groupBy(date_key(F.col("o_orderdate")).alias("DATE_KEY")).agg(F.count("*").alias("ORDERS"))


# --- dates and buckets -----------------------------------------------------------------------

@query("activity_dates_inventory")
def _(spark, d):
    return dates.activity_dates(monthly(spark, d)[0], KEYS, "BOM_INV_DATE", "TOTAL_COST_EXTENDED",
                                *dates.RECEIPT_DATES)


@query("activity_dates_sales")
def _(spark, d):
    return dates.activity_dates(monthly(spark, d)[1], KEYS, "BEG_MO", "QUANTITY_SOLD", *dates.SALE_DATES)


def _exchanged(spark, d):
    inv, sale = monthly(spark, d)
    inv = dates.activity_dates(inv, KEYS, "BOM_INV_DATE", "TOTAL_COST_EXTENDED", *dates.RECEIPT_DATES)
    sale = dates.activity_dates(sale, KEYS, "BEG_MO", "QUANTITY_SOLD", *dates.SALE_DATES)
    return dates.exchange_dates(sale, inv, KEYS)


@query("exchange_dates_sales")
def _(spark, d):
    return _exchanged(spark, d)[0]


@query("exchange_dates_inventory")
def _(spark, d):
    return _exchanged(spark, d)[1]


def _introduced(spark, d):
    intro = dates.introduction_date(F.col("FIRST_SALE_DATE"), F.col("FIRST_RECEIPT_DATE"))
    return _exchanged(spark, d)[1].withColumn("INTRODUCTION_DATE", intro)


@query("introduction_date")
def _(spark, d):
    return _introduced(spark, d).select(*KEYS, "FIRST_SALE_DATE", "FIRST_RECEIPT_DATE", "INTRODUCTION_DATE").distinct()


@query("age_days")
def _(spark, d):
    return dates.age_days(_introduced(spark, d), "BOM_INV_DATE").select(*KEYS, "BOM_INV_DATE", *dates.AGES)


@query("bucketize")
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    aged = orders.select("o_orderkey", F.datediff(F.lit("2001-07-01"), F.col("o_orderdate")).alias("days"))
    return dates.bucketize(aged, "days", "age_bucket", RANGES)


#: Two thousand overlapping ranges; later ones win.
LONG_RANGES = [dates.BucketRange(i * 37 % 2900 - 100, i * 37 % 2900 - 100 + i * 13 % 61, f"range {i}") for i in range(2000)]


@query("bucketize_long_list")
def _(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet")
    aged = orders.select("o_orderkey", F.datediff(F.lit("2001-07-01"), F.col("o_orderdate")).alias("days"))
    return dates.bucketize(aged, "days", "age_bucket", LONG_RANGES)


@query("temp_salesbucket")
def _(spark, d):
    return dates.bucket_staging(*reversed(monthly(spark, d)), RANGES)[0]


@query("temp_invbucket")
def _(spark, d):
    return dates.bucket_staging(*reversed(monthly(spark, d)), RANGES)[1]


@query("conform_temp_invbucket")
def _(spark, d):
    staging = dates.bucket_staging(*reversed(monthly(spark, d)), RANGES)[1]
    return sc.conform(staging, [*KEYS, "BOM_INV_DATE", "INTRODUCTION_DATE", "INTRODUCTION_BUCKET", "NOT_THERE"])


# --- dimensions and base facts ---------------------------------------------------------------

@query("dim_category")
def _(spark, d):
    inv, sale = condensed(spark, d)
    return dims.dim_category(sale, inv)


@query("dim_category_new_rows")
def _(spark, d):
    inv, sale = condensed(spark, d)
    stored = dims.dim_category(inv.select(*KEYS), inv)
    return dims.dim_category(sale, inv, existing=stored)


@query("dim_category_second_run")
def _(spark, d):
    """The categories after a second run: the first saw half of the brands, the second all of them."""
    inv, sale = condensed(spark, d)
    even = F.substring("TRIM_SKU", -1, 1).isin(*"02468")
    first = dims.dim_category(sale.where(even), inv.where(even)).withColumn("CATEGORY_2", F.lit("first run"))
    whole = {"DIM_CATEGORY": stage(first, "first-run")}
    layout = sale.select(DEAL).distinct()
    return dimensions(sale, inv, layout, whole, stage)[0]


@query("dim_sku")
def _(spark, d):
    inv, sale = condensed(spark, d)
    return dims.dim_sku(dims.dim_category(sale, inv), sale, inv)


@query("surrogate_key")
def _(spark, d):
    inv, sale = condensed(spark, d)
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    return skus.groupBy(DEAL).agg(F.count("*").alias("KEYS"), F.countDistinct("SKU_SEQ_ID").alias("IDS"))


@query("fact_inventory")
def _(spark, d):
    inv, sale = condensed(spark, d)
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    return facts.fact_inventory(inv, dates.bucket_staging(sale, inv, RANGES)[1], skus, RANGES, condensed=True)


@query("fact_sales")
def _(spark, d):
    inv, sale = condensed(spark, d)
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    return facts.fact_sales(sale, dates.bucket_staging(sale, inv, RANGES)[0], skus, RANGES, condensed=True)


@query("fact_inventory_written")
def _(spark, d):
    """Write twice, as a re-run does, and read back."""
    b = base(spark, d)
    root = f"{shared_folder(spark)}/stocklens-out"
    slim = b.fact_inv.select(*KEYS, "BOM_INV_DATE", "QUANTITY_ON_HAND", "TOTAL_COST_EXTENDED", "UNIT_COST")
    for _run in range(2):
        write_output(slim, root, "FACT_INVENTORY")
    return read_output(spark, root, "FACT_INVENTORY")


# --- demand ----------------------------------------------------------------------------------

def _trailing(spark, d, n, by_part=False):
    inv_m, sale_m = months(spark, d, by_part)
    return demand.trailing_sales(inv_m, sale_m, KEYS, n)


def _available(spark, d, n):
    inv_m, sale_m = months(spark, d)
    return demand.month_availability(inv_m, sale_m, KEYS, n)


def _metrics(spark, d, n, annualized):
    trailing = demand.active_months(_trailing(spark, d, n), n)
    return clean_numeric(demand.demand_metrics(trailing, n, annualized)).select(
        *KEYS, "BOM_INV_DATE", "INTRODUCTION_DATE", *demand.METRICS, "DEMAND_UNITS_NO_SALES")


def _demand(spark, d, n, annualized, by_part=False):
    b = base(spark, d, by_part)
    return demand.demand_fact(b.fact_inv, b.sale_m, KEYS, n, annualized)


for _n, _word in demand.HORIZONS.items():
    query(f"trailing_sales_{_n}_months", _n)(_trailing)
    query(f"month_availability_{_n}_months", _n)(_available)
    query(f"demand_metrics_{_n}_months", _n, False)(_metrics)
    query(f"demand_metrics_{_n}_months_annualized", _n, True)(_metrics)
    query(f"fact_{_word.lower()}_month_inventory", _n, False)(_demand)
    query(f"fact_{_word.lower()}_month_annualized", _n, True)(_demand)
query("fact_six_month_inventory_by_part", 6, False, True)(_demand)
query("fact_twelve_month_annualized_by_part", 12, True, True)(_demand)


@query("active_months")
def _(spark, d):
    return demand.active_months(_trailing(spark, d, 12), 12).select(
        *KEYS, "BOM_INV_DATE", "INTRODUCTION_DATE", "SALES_INFO_MONTHS")


@query("demand_aging")
def _(spark, d):
    metrics = demand.demand_metrics(demand.active_months(_trailing(spark, d, 3), 3), 3)
    return demand.demand_aging(metrics).select(*KEYS, "BOM_INV_DATE", *demand.UNITS, *demand.COSTS)


@query("stock_out_run_off")
def _(spark, d):
    metrics = demand.demand_metrics(demand.active_months(_trailing(spark, d, 3), 3), 3)
    return demand.stock_out_run_off(metrics).select(*KEYS, "BOM_INV_DATE", *demand.RUN_OFF)


# --- appended months ------

def _by_month(spark, df, month, name):
    """A table stored by month, written without the last month and then given it, as a monthly delivery does."""
    path = f"{shared_folder(spark)}/stocklens/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    last = df.agg(F.max(month)).first()[0]
    append.write_months(df.where(F.col(month) < last), path, month)
    append.write_months(df, path, month, [last])
    return path, append.read_months(spark, path, month, df), last


def _appended(spark, d, compute, reach, two_sides):
    """A result stored up to the month before the last, brought up to date by the rows that the last month touches."""
    inv_m, sale_m = months(spark, d)
    _, inv, last = _by_month(spark, inv_m, "BOM_INV_DATE", "inv-by-month")
    tables = [(inv, "BOM_INV_DATE")]
    if two_sides:
        _, sale, _ = _by_month(spark, sale_m, "BEG_MO", "sale-by-month")
        tables.append((sale, "BEG_MO"))
    before = compute(*[df.where(F.col(m) < last) for df, m in tables])
    path = f"{shared_folder(spark)}/stocklens/{spark.sparkContext.applicationId}/result-{uuid.uuid4().hex}"
    append.write_months(before, path, "BOM_INV_DATE")
    rows, touched = append.recomputed(compute, tables, [last], reach)
    append.write_months(rows, path, "BOM_INV_DATE", touched)
    result = append.read_months(spark, path, "BOM_INV_DATE", before)
    if not two_sides:
        return result
    old, new = ([of(df, m) for df, m in tables] for of in (lambda df, m: df.where(F.col(m) < last), lambda df, m: append.of_months(df, m, [last])))
    life = append.merged_lifetimes(append.lifetimes(*old, KEYS), append.lifetimes(*new, KEYS))
    return append.with_lifetimes(result, life, KEYS)


query("trailing_sales_6_months_appended", lambda i, s: demand.trailing_sales(i, s, KEYS, 6), append.trailing_reach(6), True)(_appended)
query("lead_sales_appended", lambda i, s: sellthru.lead_sales(i, s, KEYS), append.LEAD_REACH, True)(_appended)
query("movement_matrix_appended", lambda i: movement.movement_matrix(i, series=KEYS), append.MOVEMENT_REACH, False)(_appended)


# --- quintile, movement ----------------------------------------------------------------------

def _quintile(spark, d, n, by_part):
    inv, sale = monthly(spark, d, by_part)
    return quintile.sales_quintile(inv, sale, None, n)


for _n, _word in demand.HORIZONS.items():
    query(f"fact_{_word.lower()}_month_quintile", _n, False)(_quintile)
query("fact_two_month_quintile_one_window", 2, False)(_quintile)  # the name stays; no window spans a deal any more
query("fact_six_month_quintile_by_part", 6, True)(_quintile)


def _moves(spark, d, by_part=False):
    b = base(spark, d, by_part)
    return movement.movement_matrix(b.fact_inv, series=KEYS)


query("movement_matrix")(_moves)


def _movement(spark, d, by_part=False):
    return movement.movement_summary(_moves(spark, d, by_part), RANGES)


query("fact_inv_mvmt")(_movement)
query("fact_inv_mvmt_by_part", True)(_movement)


# --- FIFO ------------------------------------------------------------------------------------

@query("fifo_eligible")
def _(spark, d):
    return fifo.fifo_eligible(months(spark, d)[0])


@query("fifo_flows")
def _(spark, d):
    return clean_numeric(fifo.fifo_flows(*months(spark, d), KEYS))


def _ledger(spark, d, by_part=False):
    b = base(spark, d, by_part)
    return fifo.fifo(b.inv_m, b.sale_m, b.skus, KEYS)


@query("fifo_ledger")
def _(spark, d):
    layers = [f"UNITS_{b}" for b in fifo.LAYERS] + [f"A_{b}_ASQ" for b in fifo.LAYERS]
    return _ledger(spark, d).select(*KEYS, "STEP", "USE_SALES", "USE_RECEIPTS", "TOTAL_RECEIPTS", *layers)


query("fifo")(_ledger)


@query("fifo_by_part")
def _(spark, d):
    return _ledger(spark, d, True).select(
        *KEYS, "STEP", "DATE_KEY", "USE_SALES", "USE_RECEIPTS", "TOTAL_RECEIPTS", "UNITS_0_30", "UNITS_30_60",
        "UNITS_60_90", *[f"{k}_{b}" for k in ("UNITS", "COST") for b in (*fifo.ROLL_UPS, "OVER_720")])


@query("fifo_m23")
def _(spark, d):
    return fifo.fifo_step(_ledger(spark, d), 23).select(
        *KEYS, "DATE_KEY", *[f"{k}_{b}" for k in ("UNITS", "COST") for b in (*fifo.ROLL_UPS, "OVER_720")])


# --- cycles, sell-through --------------------------------------------------------------------

def _cycle(spark, d, fn, by_part=False):
    b = base(spark, d, by_part)
    return fn(b.sale, b.inv, b.fact_sale, RANGES)


query("fact_gross_margin_cycle", cycles.margin_cycle)(_cycle)
query("fact_sales_cycle", cycles.sales_cycle)(_cycle)
query("fact_sales_cycle_by_part", cycles.sales_cycle, True)(_cycle)


def _leads(spark, d, require):
    return sellthru.lead_sales(*monthly(spark, d), KEYS, require_base_sale=require)


query("lead_sales", True)(_leads)
query("lead_sales_any_base", False)(_leads)


def _sell_through(spark, d, strict, by_part=False):
    b = base(spark, d, by_part)
    leads = sellthru.lead_sales(b.inv, b.sale, KEYS, fact_inv=b.fact_inv)
    return sellthru.sell_through(leads, KEYS, strict)


query("fact_sell_thru", False)(_sell_through)
query("fact_sell_thru_strict_band", True)(_sell_through)
query("fact_sell_thru_by_part", False, True)(_sell_through)


# --- the whole run ---------------------------------------------------------------------------

_RUNS: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


def whole_run(spark: SparkSession, d: str, name: str, inputs) -> dict[str, DataFrame]:
    """The output tables of a run over ``inputs(spark, d)``, made once per session."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _RUNS:
        inv, sale = inputs(spark, d)
        _RUNS[key] = run_deals(sale, inv, RANGES)
    return _RUNS[key]


def mixed_lines(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Line inputs of two deals with different layouts, in one table per side.

    Deal 1001 has order dates (missing on some sales, which its facts leave out) and no cost of goods; deal 1002 has
    neither order dates, gross margins, locations nor categories.
    """
    inv, sale = line_inputs(spark, d)
    first = F.col(DEAL) == 1001
    ordered = F.when(first & ~F.col("CATEGORY_1").startswith("LARGE"), F.last_day("BEG_MO"))
    sale = sale.withColumns({"ORDER_DATE": ordered, "COGS_$": F.when(~first, F.col("COGS_$")),
                             "GROSS_MARGIN_$": F.when(first, F.col("GROSS_MARGIN_$"))})
    return tuple(df.withColumns({c: F.when(first, F.col(c)) for c in ("LOCATION", "CATEGORY_1")}) for df in (inv, sale))


def by_natural_key(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """An output with what its SKU ids stand for: that row's key in DIM_SKU, as ID_KEY or, without keys of its own, as columns."""
    df = tables[name]
    if name == "DIM_SKU" or "SKU_SEQ_ID" not in df.columns:
        return df
    own = KEYS[1:]
    skus = tables["DIM_SKU"].select(DEAL, "SKU_SEQ_ID", *own, F.concat_ws("|", *own).alias("ID_KEY"))
    skus = skus.drop(*own) if "TRIM_SKU" in df.columns else skus.drop("ID_KEY")
    return df.join(skus, [DEAL, "SKU_SEQ_ID"], "left")


def _whole(spark, d, table):
    return by_natural_key(whole_run(spark, d, "lines", line_inputs), table)


for _name in OUTPUT_TABLES:
    query(f"run_deals_{_name.lower()}", _name)(_whole)


def _conformed(spark, d, table):
    return conform_table(whole_run(spark, d, "lines", line_inputs)[table], table)


for _name in OUTPUT_TABLES:
    query(f"conform_{_name.lower()}" if _name != "TEMP_INVBUCKET" else "conform_temp_invbucket_declared", _name)(_conformed)


@query("run_deals_mixed_columns")
def _(spark, d):
    """Sales facts of deals that differ in their columns, from one run."""
    return whole_run(spark, d, "mixed", mixed_lines)["FACT_SALES"]


def _mixed(spark, d, table):
    return whole_run(spark, d, "mixed", mixed_lines)[table]


query("run_deals_mixed_columns_demand", "FACT_THREE_MONTH_INVENTORY")(_mixed)
query("run_deals_mixed_columns_dim_category", "DIM_CATEGORY")(_mixed)

@query("run_deals")
def _(spark, d):
    """Rows per output table and deal of the whole appraisal."""
    tables = whole_run(spark, d, "lines", line_inputs)
    counts = [df.groupBy(DEAL).agg(F.count("*").alias("ROWS")).withColumn("TABLE_NAME", F.lit(name))
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
