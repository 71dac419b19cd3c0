"""FIFO ageing: stock split into 25 monthly layers, oldest sold first, over the last 24 months."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.grain import SIDE, around, stack, whole
from stocklens.functions.semantics import DEAL, date_key, finite_sql, month_index, pdiv, product
from stocklens.operators.facts import sku_ids
from stocklens.sources.staging import small_side, stage

# Steps, layers of 30 days, and the roll-up bands as (first layer, past last layer).
STEPS = 24
LAYERS = [f"{d}_{d + 30}" for d in range(0, 750, 30)]
ROLL_UPS = {"90_180": (3, 6), "180_270": (6, 9), "270_360": (9, 12), "361_540": (12, 18), "541_720": (18, 24)}
MIN_MONTHS = 12

FLOW_COLUMNS = ["CURRENT_UNITS", "CURRENT_COST", "QUANTITY_SOLD", "NET_SALES_$", "COGS_$", "GROSS_MARGIN_$",
                "EOM_CHANGE", "SALES_ADJ", "REC_ADJ", "USE_SALES", "USE_RECEIPTS", "CURRENT_CPU", "SP_U", "GM_U"]
# Series whose state one NumPy block holds; bounds a Python worker's memory at a few MB.
BLOCK = 1024


def fifo_calendar(inv_m: DataFrame) -> DataFrame:
    """Months of each eligible deal that the ledger reads, as STEP -1..23 (23 is the latest).

    A deal is eligible when its latest 12 months all have inventory. Only distinct (deal, month)
    pairs reach the windows, so a large deal is as small here as any other.
    """
    months = inv_m.select(DEAL, "BOM_INV_DATE").distinct()
    latest = F.max(month_index(F.col("BOM_INV_DATE"))).over(whole([DEAL]))
    months = months.withColumn("STEP", month_index(F.col("BOM_INV_DATE")) - latest + STEPS - 1)
    recent = F.sum(F.when(F.col("STEP") >= STEPS - MIN_MONTHS, 1).otherwise(0)).over(whole([DEAL]))
    return small_side(months.withColumn("_RECENT", recent)
                      .where((F.col("_RECENT") == MIN_MONTHS) & (F.col("STEP") >= -1))
                      .select(DEAL, "BOM_INV_DATE", "STEP"), "fifo-calendar")


def fifo_eligible(inv_m: DataFrame) -> DataFrame:
    """Deals with inventory in each of their latest 12 months."""
    return fifo_calendar(inv_m).select(DEAL).distinct()


def fifo_flows(inv_m: DataFrame, sale_m: DataFrame, keys: Sequence[str],
               calendar: DataFrame | None = None) -> DataFrame:
    """Units sold and received per series and step, from stock at the month and the month before.

    Sales in months without an inventory row are lost. The calendar joins on deal and month, which
    spreads one large deal over its months.
    """
    calendar = fifo_calendar(inv_m) if calendar is None else calendar
    inv = inv_m.join(calendar, [DEAL, "BOM_INV_DATE"])
    sale = sale_m.join(calendar.select(DEAL, F.col("BOM_INV_DATE").alias("BEG_MO")), [DEAL, "BEG_MO"], "left_semi")
    now, before = around(keys, 0, 0), around(keys, -1, -1)
    measures = ["QUANTITY_SOLD", "NET_SALES_$", "COGS_$", "GROSS_MARGIN_$"]
    st = stack(keys, inv=(inv, "BOM_INV_DATE"), sale=(sale, "BEG_MO"))
    zero = F.lit(0.0)
    rows = st.withColumns({
        **{f"_{m}": F.coalesce(F.sum(m).over(now), zero) for m in measures},
        "_PREVIOUS_UNITS": F.coalesce(F.sum("QUANTITY_ON_HAND").over(before), zero),
    }).where((F.col(SIDE) == "inv") & (F.col("STEP") >= 0))
    rows = rows.select(*keys, "BOM_INV_DATE", "STEP",
                       F.coalesce("QUANTITY_ON_HAND", zero).alias("CURRENT_UNITS"),
                       F.col("TOTAL_COST_EXTENDED").alias("CURRENT_COST"),
                       *[F.col(f"_{m}").alias(m) for m in measures], "_PREVIOUS_UNITS")
    return flow_columns(rows).select(*keys, "BOM_INV_DATE", "STEP", *FLOW_COLUMNS)


def flow_columns(rows: DataFrame) -> DataFrame:
    """Adjusted sales and receipts: returns count as receipts, unexplained losses as sales."""
    units, sold = F.col("CURRENT_UNITS"), F.col("QUANTITY_SOLD")
    eom, sales, rec, used = F.col("EOM_CHANGE"), F.col("SALES_ADJ"), F.col("REC_ADJ"), F.col("USE_SALES")
    rows = rows.withColumn("EOM_CHANGE", units - F.col("_PREVIOUS_UNITS"))
    rows = rows.withColumn("SALES_ADJ", F.when(sold >= 0, sold).otherwise(F.greatest(eom, F.lit(0.0))))
    rows = rows.withColumn("REC_ADJ", sales + eom)
    rows = rows.withColumn("USE_SALES", F.when((rec < 0) | (units == 0), -eom).otherwise(sales))
    rows = rows.withColumn("USE_RECEIPTS", F.when((rec < 0) | ((units == 0) & (used == -eom)), 0.0).otherwise(rec))
    return rows.withColumns({
        "CURRENT_CPU": pdiv(F.col("CURRENT_COST"), units),
        "SP_U": pdiv(F.col("NET_SALES_$"), used),
        "GM_U": pdiv(F.col("GROSS_MARGIN_$"), used),
    })


def consume(units: np.ndarray, sales: np.ndarray, receipts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One month for many series: (units sold per layer, layers at month end).

    ``units`` is [series x 25] with layer 0 newest. Sales take the oldest layer first; what the
    layers cannot cover comes off the month's receipts. Layers then age by one, and whatever
    stays in the oldest is dropped.
    """
    upto = np.cumsum(units[:, ::-1], axis=1)[:, ::-1]
    want = sales[:, None]
    part = np.maximum(want - (upto - units), 0.0)
    part[:, -1] = sales
    sold = np.where(np.abs(want) > upto, units, part)
    aged = np.empty_like(units)
    aged[:, 0] = receipts - (sales - sold.sum(axis=1))
    aged[:, 1:] = units[:, :-1] - sold[:, :-1]
    return sold, aged


def _ledger_block(rows: pa.RecordBatch, flow_names: list[str], names: list[str]) -> pa.RecordBatch:
    """All steps of a block of series: one output row per flow, with the layers before and after it."""
    n, layers = rows.num_rows, len(LAYERS)
    calendar, flows = rows.column("_CALENDAR"), rows.column("_FLOWS")
    cal_row, cal_step = pc.list_parent_indices(calendar).to_numpy(), calendar.flatten().to_numpy()
    flow_row, flow = pc.list_parent_indices(flows).to_numpy(), flows.flatten()
    flow_step = flow.field(flow.type.get_field_index("STEP")).to_numpy()

    open_month = np.zeros((n, STEPS), dtype=bool)
    open_month[cal_row, cal_step] = True
    flow_at = np.full((n, STEPS), -1, dtype=np.int64)
    flow_at[flow_row, flow_step] = np.arange(len(flow_row))
    sales, receipts = (np.zeros((n, STEPS)) for _ in range(2))
    for target, name in ((sales, "USE_SALES"), (receipts, "USE_RECEIPTS")):
        target[flow_row, flow_step] = flow.field(flow.type.get_field_index(name)).to_numpy()

    state = np.zeros((n, layers))
    sold_at, units_at = np.zeros((n, STEPS, layers)), np.zeros((n, STEPS, layers))
    for step in range(STEPS):
        sold, aged = consume(state, sales[:, step], receipts[:, step])
        here = (flow_at[:, step] >= 0)[:, None]
        sold_at[:, step], units_at[:, step] = sold, aged
        state = np.where(here, aged, np.where(open_month[:, [step]], 0.0, state))

    series, steps = np.nonzero(flow_at >= 0)
    offsets = pa.array(np.arange(0, (len(series) + 1) * layers, layers, dtype=np.int32))

    def lists(values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(offsets, pa.array(values[series, steps].reshape(-1)))

    flow_index = pa.array(flow_at[series, steps])
    columns = {c: rows.column(c).take(pa.array(series)) for c in rows.schema.names if c not in ("_CALENDAR", "_FLOWS")}
    columns |= {c: flow.field(flow.type.get_field_index(c)).take(flow_index) for c in flow_names}
    columns |= {"STEP": pa.array(steps.astype(np.int32)), "_ASQ": lists(sold_at), "_UNITS": lists(units_at)}
    return pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)


def fifo_ledger(flows: DataFrame, sku_keys: DataFrame, calendar: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Layers of every SKU after every step its deal has inventory in.

    ``sku_keys`` lists the series to report; one without inventory in a step that others have gets
    an empty row and starts over from empty layers. Each series is packed into one row of at most
    24 flows, so tasks stream over series and never hold a group. Layers are computed for the steps
    with a flow only; the empty rows of the others are made from the calendar, as nearly all rows are
    where series are many and thin.
    """
    packed = flows.groupBy(*keys).agg(F.collect_list(F.struct(F.col("STEP"), *FLOW_COLUMNS)).alias("_FLOWS"))
    steps = small_side(
        calendar.where(F.col("STEP") >= 0).groupBy(DEAL)
        .agg(F.sort_array(F.collect_set("STEP")).alias("_CALENDAR"), F.max("BOM_INV_DATE").alias("_LATEST")),
        "fifo-steps")
    base = sku_keys.join(packed, list(keys), "left").join(steps, DEAL)
    no_flows = F.array().cast(packed.schema["_FLOWS"].dataType)
    base = stage(base.withColumn("_FLOWS", F.coalesce("_FLOWS", no_flows)), "fifo-series")

    types = {f.name: f for f in base.schema.fields}
    kept = [types[c] for c in base.columns if c not in ("_CALENDAR", "_FLOWS")]
    doubles = [T.StructField(c, T.DoubleType()) for c in FLOW_COLUMNS]
    lists = [T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("_ASQ", "_UNITS")]
    schema = T.StructType([*kept, T.StructField("STEP", T.IntegerType()), *doubles, *lists])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                yield _ledger_block(batch.slice(start, BLOCK), FLOW_COLUMNS, names)

    moved = base.where(F.size("_FLOWS") > 0).mapInArrow(run, schema)
    idle = base.select(*[f.name for f in kept], F.explode(F.array_except("_CALENDAR", "_FLOWS.STEP")).alias("STEP"),
                       *[F.lit(None).cast(f.dataType).alias(f.name) for f in (*doubles, *lists)])
    rows = moved.unionByName(idle)
    rows = rows.withColumn("BOM_INV_DATE", F.add_months("_LATEST", F.col("STEP") - (STEPS - 1))).drop("_LATEST")
    total = F.aggregate("_ASQ", F.lit(0.0), lambda acc, x: acc + x)
    rows = rows.withColumn("TOTAL_RECEIPTS", F.col("USE_SALES") - total)

    out = {f"UNITS_{b}": F.expr(f"_UNITS[{i}]") for i, b in enumerate(LAYERS)}
    out |= {f"A_{b}_ASQ": F.expr(f"_ASQ[{i}]") for i, b in enumerate(LAYERS)}
    rows = rows.withColumns(out).drop("_UNITS", "_ASQ")
    values = {f"COST_{b}": (f"UNITS_{b}", "CURRENT_CPU") for b in LAYERS}
    values |= {f"A_{b}_S$A": (f"A_{b}_ASQ", "SP_U") for b in LAYERS}
    values |= {f"A_{b}GM$A": (f"A_{b}_ASQ", "GM_U") for b in LAYERS}
    return rows.withColumns({name: product(a, b) for name, (a, b) in values.items()})


def fifo_rollup(ledger: DataFrame) -> DataFrame:
    """Quarter and half-year bands on top of the layers; infinities become NULL first."""
    numbers = [f.name for f in ledger.schema.fields if isinstance(f.dataType, T.DoubleType)]
    df = ledger.withColumns({c: F.expr(finite_sql(c)) for c in numbers})
    bands = {}
    for kind in ("UNITS", "COST"):
        for band, (first, past) in ROLL_UPS.items():
            layers = [f"coalesce({kind}_{b}, 0D)" for b in LAYERS[first:past]]
            bands[f"{kind}_{band}"] = F.expr(" + ".join(layers))
        bands[f"{kind}_OVER_720"] = F.col(f"{kind}_720_750")
    return df.withColumns({**bands, "DATE_KEY": date_key(F.col("BOM_INV_DATE"))})


def reported_skus(inv_m: DataFrame, dim_sku: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Dimension SKUs whose TRIM_SKU occurs in the deal's inventory."""
    held = inv_m.select(DEAL, "TRIM_SKU").distinct()
    return sku_ids(dim_sku, keys).join(held, [DEAL, "TRIM_SKU"], "left_semi").select(*keys, "SKU_SEQ_ID")


def fifo(inv_m: DataFrame, sale_m: DataFrame, dim_sku: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The FIFO table, one STEP per month of history (0 oldest, 23 latest)."""
    calendar = fifo_calendar(inv_m)
    flows = fifo_flows(inv_m, sale_m, keys, calendar)
    return fifo_rollup(fifo_ledger(flows, reported_skus(inv_m, dim_sku, keys), calendar, keys))


def fifo_step(table: DataFrame, step: int) -> DataFrame:
    """One monthly table of the FIFO family (FIFO_M<step>)."""
    return table.where(F.col("STEP") == step).drop("STEP")
