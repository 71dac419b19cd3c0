"""Months-of-stock demand: trailing sales, rates, ageing waterfall and stock-out run-off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.grain import (INVENTORY_MEASURES, SALES_MEASURES, SIDE, around, lifetime,
                                       side, stack)
from stocklens.functions.semantics import (DAYS_PER_MONTH, DEAL, both_least, clean_numeric, date_key, known,
                                           pdiv, present, product)
from stocklens.operators.dates import BUCKET_COLUMNS, STAGING_DATES
from stocklens.operators.facts import month_grain
from stocklens.sources.staging import small_side

# Horizons in months and how output tables name them; ageing bands and their length
# in months; weeks of run-off.
HORIZONS = {2: "TWO", 3: "THREE", 6: "SIX", 12: "TWELVE", 24: "TWENTYFOUR"}
BANDS = {"0_30": 1, "31_60": 1, "61_90": 1, "91_180": 3, "181_270": 3, "271_360": 3, "361_720": 12}
WEEKS = 16

SALES_INFO = {
    "QUANTITY_SOLD": "SALES_INFO_QUANTITY_SOLD",
    "NET_SALES_$": "SALES_INFO_SOLD_AMOUNT",
    "COGS_$": "SALES_INFO_COGS",
    "GROSS_MARGIN_$": "SALES_INFO_GM_AMOUNT",
}
RATE = "SALES_INFO_SALES_QUANTITY_PER_MONTH"
PLAIN_RATE = "_PLAIN_RATE"
METRICS = [*SALES_INFO.values(), "SALES_INFO_MONTHS", "SALES_INFO_START_MONTH", "SALES_INFO_PERCENT_SKU_GM",
           "SALES_INFO_COGS_PER_UNIT", "SALES_INFO_TURNS", "SALES_INFO_PERCENT_SP_PER_UNIT_GM",
           "ADJ_QTY_DEMAND", "CPU", "SALES_INFO_PERCENT_COGS_CHANGE", "ADJUSTED_QTY", RATE]
UNITS = [f"DEMAND_UNITS_{b}" for b in [*BANDS, "720", "NO_SALES", "TOTAL", "CHECK"]]
COSTS = [f"DEMAND_COST_AMOUNT_{b}" for b in [*BANDS, "720"]] + [
    f"DEMAND_COST_{b}_AMOUNT" for b in ("NO_SALES", "TOTAL", "CHECK")]
RUN_OFF = (["STOCK_OUT_SALES_UNIT_SALES_PER_WEEK"]
           + [f"STOCK_OUT_SALES_UNIT_{i}_WEEK" for i in range(1, WEEKS + 1)]
           + ["STOCK_OUT_SALES_COST_COGS_PER_WEEK"]
           + [f"STOCK_OUT_SALES_COST_{i}_WEEK_AMOUNT" for i in range(1, WEEKS + 1)])


def trailing_windows(inv_m: DataFrame, sale_m: DataFrame, keys: Sequence[str],
                     horizons: Sequence[int]) -> DataFrame:
    """Every inventory row with one struct ``LAST_<n>`` of trailing sales per horizon.

    All horizons are frames of one window over one stack, so five horizons cost one exchange.
    """
    held = [c for c in inv_m.columns if c != "FIRST_RECEIPT_DATE"]
    st = stack(keys, inv=(inv_m.select(*held), "BOM_INV_DATE"),
               sale=(sale_m.select(*keys, "BEG_MO", *SALES_MEASURES), "BEG_MO"))
    out = {"FIRST_RECEIPT_DATE": F.min("BOM_INV_DATE").over(lifetime(keys)),
           "_FIRST_SALE": F.min("BEG_MO").over(lifetime(keys))}
    for n in horizons:
        w = around(keys, -(n - 1), 0)
        for m, name in SALES_INFO.items():
            out[f"_{name}_{n}"] = F.sum(m).over(w)
        out[f"_SALES_{n}"] = F.count("BEG_MO").over(w)
    rows = st.withColumns(out).where(F.col(SIDE) == "inv")

    def last(n: int) -> Column:
        first_sale = F.when(F.col(f"_SALES_{n}") > 0, F.col("_FIRST_SALE"))
        return F.struct(*[F.col(f"_{name}_{n}").alias(name) for name in SALES_INFO.values()],
                        first_sale.alias("FIRST_SALE_DATE")).alias(f"LAST_{n}")

    return rows.select(*held, "FIRST_RECEIPT_DATE", *[last(n) for n in horizons])


def horizon(windows: DataFrame, n: int) -> DataFrame:
    """Trailing sales of one horizon as plain columns."""
    rest = [c for c in windows.columns if not c.startswith("LAST_") or not c[5:].isdigit()]
    return windows.select(*rest, f"LAST_{n}.*")


def trailing_sales(inv_m: DataFrame, sale_m: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Sales of the months [M-(n-1), M] on every inventory row; NULL when there were none."""
    return horizon(trailing_windows(inv_m, sale_m, keys, [n]), n)


def month_availability(inv_m: DataFrame, sale_m: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """'use' when M and M-(n-1) both are some series' first sale month, or the series never sold."""
    st = stack(keys, inv=(inv_m, "BOM_INV_DATE"), sale=(sale_m.select(*keys, "BEG_MO"), "BEG_MO"))
    rows = side(st.withColumn("_FIRST_SALE", F.min("BEG_MO").over(lifetime(keys))), "inv",
                [*inv_m.columns, "_FIRST_SALE"])
    starts = small_side(
        rows.where(F.col("_FIRST_SALE").isNotNull()).select(DEAL, F.col("_FIRST_SALE").alias("_M")).distinct(),
        "first-sale-months")
    end, begin = starts.withColumn("_END", F.lit(True)), starts.withColumn("_BEGIN", F.lit(True))
    flagged = (rows.withColumn("_M", F.col("BOM_INV_DATE")).join(end, [DEAL, "_M"], "left")
               .withColumn("_M", F.add_months("BOM_INV_DATE", -(n - 1))).join(begin, [DEAL, "_M"], "left"))
    usable = F.col("_FIRST_SALE").isNull() | (F.col("_END") & F.col("_BEGIN"))
    return flagged.select(*inv_m.columns, F.when(usable, "use").otherwise("dnu").alias("MONTH_AVAILABILITY"))


def active_months(df: DataFrame, n: int) -> DataFrame:
    """Months a series was active within the horizon, from its introduction, rounded half to even."""
    df = df.withColumn("INTRODUCTION_DATE", F.least("FIRST_SALE_DATE", "FIRST_RECEIPT_DATE"))
    days = F.datediff("BOM_INV_DATE", "INTRODUCTION_DATE") + 30
    capped = F.when(days <= n * DAYS_PER_MONTH, days.cast("double")).when(
        days > n * DAYS_PER_MONTH, F.lit(n * DAYS_PER_MONTH))
    return df.withColumn("SALES_INFO_MONTHS", F.rint(capped / F.lit(DAYS_PER_MONTH)))


def demand_metrics(df: DataFrame, n: int, annualized: bool = False) -> DataFrame:
    """Margin, unit cost, turns and the monthly demand rate of a horizon of ``n`` months."""
    sold, qty, cogs = (F.col(f"SALES_INFO_{c}") for c in ("SOLD_AMOUNT", "QUANTITY_SOLD", "COGS"))
    cost, unit_cogs, cpu = F.col("TOTAL_COST_EXTENDED"), F.col("SALES_INFO_COGS_PER_UNIT"), F.col("CPU")
    change, adjusted = F.col("SALES_INFO_PERCENT_COGS_CHANGE"), F.col("ADJUSTED_QTY")

    df = df.withColumns({
        "SALES_INFO_GM_AMOUNT": known(sold - cogs),
        "SALES_INFO_START_MONTH": F.add_months("BOM_INV_DATE", -(n - 1)),
        "SALES_INFO_COGS_PER_UNIT": pdiv(cogs, qty),
        "SALES_INFO_TURNS": pdiv(cogs / n * 12, cost),
    })
    df = df.withColumns({
        "SALES_INFO_PERCENT_SKU_GM": pdiv(F.col("SALES_INFO_GM_AMOUNT"), sold),
        "SALES_INFO_PERCENT_SP_PER_UNIT_GM": 1 - pdiv(unit_cogs, pdiv(sold, qty)),
        "ADJ_QTY_DEMAND": F.coalesce("QUANTITY_ON_HAND", pdiv(cost, unit_cogs)),
    })
    df = df.withColumn("CPU", pdiv(cost, F.col("ADJ_QTY_DEMAND")))
    df = df.withColumn("SALES_INFO_PERCENT_COGS_CHANGE", F.when((unit_cogs == 0) | (cpu == 0), 0.0).otherwise(
        pdiv(known(cpu - unit_cogs), cpu)) * 100)
    df = df.withColumn("ADJUSTED_QTY", F.when((change > 30) | (change < -30) | (qty == 0), pdiv(cogs, cpu))
                       .otherwise(qty))
    plain = F.coalesce(adjusted / n, F.lit(0.0))
    rate = F.coalesce(pdiv(adjusted, F.col("SALES_INFO_MONTHS")), F.lit(0.0)) if annualized else plain
    df = df.withColumns({RATE: rate, PLAIN_RATE: plain})
    return df.withColumn("DEMAND_UNITS_NO_SALES", F.when(F.col(RATE) == 0, F.col("ADJ_QTY_DEMAND")).otherwise(0.0))


def demand_aging(df: DataFrame) -> DataFrame:
    """Spread stock over future months at the demand rate: units and cost per band.

    Bands fill in order, each with at most rate x months of what is left, so a band that starts
    W months ahead holds min(rate x months, stock - rate x W), and nothing once that is negative.
    Negative stock falls into the first band whole.
    """
    bands, ahead, stock = {}, 0, "ADJ_QTY_DEMAND"
    for band, months in BANDS.items():
        fill = (f"greatest(0D, least({RATE} * {months}, {stock} - {RATE} * {ahead}))" if ahead
                else f"least({RATE} * {months}, {stock})")
        bands[f"DEMAND_UNITS_{band}"] = F.expr(f"if({RATE} > 0 and {stock} is not null, nanvl({fill}, 0D), 0D)")
        ahead += months
    df = df.withColumns(bands)
    spread = " + ".join(bands)
    q = F.col(stock)
    df = df.withColumn("DEMAND_UNITS_720", known(q - F.expr(f"({spread} + DEMAND_UNITS_NO_SALES)")))
    df = df.withColumn("DEMAND_UNITS_TOTAL", F.expr(
        f"{spread} + coalesce(DEMAND_UNITS_720, 0D) + coalesce(DEMAND_UNITS_NO_SALES, 0D)"))
    df = df.withColumn("DEMAND_UNITS_CHECK", known(F.col("DEMAND_UNITS_TOTAL") - q))
    return df.withColumns({c: product("CPU", u) for u, c in zip(UNITS, COSTS)})


def stock_out_run_off(df: DataFrame, weeks: int = WEEKS, rate: str = PLAIN_RATE) -> DataFrame:
    """Weekly sales until the stock is gone; weeks after that are NULL."""
    unit, cost = "STOCK_OUT_SALES_UNIT", "STOCK_OUT_SALES_COST"
    df = df.withColumn(f"{unit}_SALES_PER_WEEK", F.col(rate) / 30 * 7)
    week, w, q = f"{unit}_{{}}_WEEK", f"{unit}_SALES_PER_WEEK", "ADJ_QTY_DEMAND"
    gone = week.format(1)
    df = df.withColumn(gone, both_least(F.col(w), F.col(q)))
    for i in range(2, weeks + 1):
        left = f"({q} - ({gone}))"
        df = df.withColumn(week.format(i), F.expr(f"if({left} > 0 and {w} > 0, least({w}, {left}), null)"))
        gone += f" + {week.format(i)}"
    amounts = {f"{cost}_COGS_PER_WEEK": product("CPU", w)}
    amounts |= {f"{cost}_{i}_WEEK_AMOUNT": product("CPU", week.format(i)) for i in range(1, weeks + 1)}
    return df.withColumns(amounts)


def demand_from(windows: DataFrame, keys: Sequence[str], n: int, annualized: bool) -> DataFrame:
    """One demand table from trailing windows over FACT_INVENTORY rows."""
    df = active_months(horizon(windows, n), n)
    df = stock_out_run_off(demand_aging(demand_metrics(df, n, annualized)))
    staged = [c for c in STAGING_DATES if f"_STAGED_{c}" in df.columns]
    extra = present(df, ["SKU_SEQ_ID", "CATEGORY_1", "ORIGINAL_RETAIL_PRICE_EXTENDED", "INVENTORY_DATE",
                         *BUCKET_COLUMNS, "INSERT_DATE"])
    numbers = [c for c in [*METRICS, *UNITS, *COSTS, *RUN_OFF] if c != "SALES_INFO_START_MONTH"]
    out = df.select(
        *keys, "BOM_INV_DATE", date_key(F.col("BOM_INV_DATE")).alias("DATE_KEY"),
        F.col("TRIM_SKU").alias("SKU"), "SALES_INFO_START_MONTH", *numbers,
        F.col("QUANTITY_ON_HAND").alias("GROSS_INVENTORY_QUANTITY"),
        F.col("TOTAL_COST_EXTENDED").alias("GROSS_INVENTORY_COST"),
        *[F.col(f"_STAGED_{c}").alias(c) for c in staged], *extra)
    receipt = {"FIRST_RECEIPT_DATE_BUCKET": "FIRST_RECEIPT_BUCKET_SEQ_ID"} if annualized else {}
    return clean_numeric(out, [*numbers, "GROSS_INVENTORY_QUANTITY", "GROSS_INVENTORY_COST",
                               *present(out, BUCKET_COLUMNS)]).withColumnsRenamed(receipt)


def demand_windows(fact_inv: DataFrame, sale_m: DataFrame, keys: Sequence[str],
                   horizons: Sequence[int] = tuple(HORIZONS)) -> DataFrame:
    """Trailing windows over FACT_INVENTORY; its own columns ride along, so nothing is joined back."""
    fact = month_grain(fact_inv, keys, "BOM_INV_DATE", INVENTORY_MEASURES)
    keep = present(fact, [*keys, "BOM_INV_DATE", *INVENTORY_MEASURES, *STAGING_DATES, *BUCKET_COLUMNS,
                          "SKU_SEQ_ID", "CATEGORY_1", "ORIGINAL_RETAIL_PRICE_EXTENDED", "INVENTORY_DATE",
                          "INSERT_DATE"])
    fact = fact.select(*keep).withColumnsRenamed({c: f"_STAGED_{c}" for c in STAGING_DATES})
    return trailing_windows(fact, sale_m, keys, list(horizons))


def demand_fact(fact_inv: DataFrame, sale_m: DataFrame, keys: Sequence[str], n: int,
                annualized: bool = False) -> DataFrame:
    """FACT_<n>_MONTH_INVENTORY or, annualized, FACT_<n>_MONTH_ANNUALIZED."""
    return demand_from(demand_windows(fact_inv, sale_m, keys, [n]), keys, n, annualized)


def demand_table_name(n: int, annualized: bool) -> str:
    return f"FACT_{HORIZONS[n]}_MONTH_{'ANNUALIZED' if annualized else 'INVENTORY'}"


def demand_facts(fact_inv: DataFrame, sale_m: DataFrame, keys: Sequence[str],
                 windows: DataFrame | None = None) -> dict[str, DataFrame]:
    """All ten demand tables; pass staged windows to compute the trailing sums once for all."""
    windows = demand_windows(fact_inv, sale_m, keys) if windows is None else windows
    return {demand_table_name(n, a): demand_from(windows, keys, n, a) for n in HORIZONS for a in (False, True)}
