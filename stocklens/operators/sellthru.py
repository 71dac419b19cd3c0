"""Sell-through: how much of a month's stock the next three months sold."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocklens.functions.grain import INVENTORY_MEASURES, SIDE, around, lifetime, stack
from stocklens.functions.semantics import DEAL, date_key, pdiv, present
from stocklens.operators.dates import BUCKET_COLUMNS
from stocklens.operators.facts import month_grain
from stocklens.sources.staging import small_side

LEADS = (1, 2, 3)
# Measure -> output prefix, and the cost check band.
LEAD_COLUMNS = {"NET_SALES_$": "SALES_AMOUNT_X", "QUANTITY_SOLD": "UNITS_SOLD_X", "COGS_$": "COGS_AMOUNT_X"}
COST_BAND = 0.3


def lead_sales(inv_m: DataFrame, sale_m: DataFrame, keys: Sequence[str], leads: Sequence[int] = LEADS,
               require_base_sale: bool = True, fact_inv: DataFrame | None = None) -> DataFrame:
    """Sales of the months M+k on every inventory row, with the series' sale and receipt dates.

    Only months in which the deal holds inventory count as M+k, and a row without a sale in its
    own month gets no leads unless ``require_base_sale`` is off. Missing keys match each other.
    Bucket columns and the id of ``fact_inv`` ride in the same stack instead of a join.
    """
    stocked = small_side(
        inv_m.select(DEAL, F.col("BOM_INV_DATE").alias("BEG_MO"), F.lit(True).alias("_STOCKED")).distinct(),
        "stocked-months")
    sale = sale_m.select(*keys, "BEG_MO", *LEAD_COLUMNS).join(stocked, [DEAL, "BEG_MO"], "left")
    sides = {"inv": (inv_m, "BOM_INV_DATE"), "sale": (sale, "BEG_MO")}
    carried = []
    if fact_inv is not None:
        fact = month_grain(fact_inv, keys, "BOM_INV_DATE", INVENTORY_MEASURES)
        carried = present(fact, ["SKU_SEQ_ID", *BUCKET_COLUMNS])
        sides["fact"] = (fact.select(*keys, F.col("BOM_INV_DATE").alias("_FACT_MONTH"), *carried), "_FACT_MONTH")
    st = stack(keys, **sides)

    life, now = lifetime(keys), around(keys, 0, 0)
    in_stock = F.col("_STOCKED")
    columns = {
        "_SOLD_NOW": F.count(F.when(in_stock, F.col("BEG_MO"))).over(now) > 0,
        "FIRST_RECEIPT_DATE": F.min("BOM_INV_DATE").over(life),
        "_FIRST_SALE": F.min("BEG_MO").over(life),
        "_LAST_SALE": F.max("BEG_MO").over(life),
    }
    columns |= {f"_FACT_{c}": F.max(c).over(now) for c in carried}
    for k in leads:
        at = around(keys, k, k)
        columns |= {f"_{name}_{k}": F.sum(F.when(in_stock, F.col(m))).over(at) for m, name in LEAD_COLUMNS.items()}
    rows = st.withColumns(columns).where(F.col(SIDE) == "inv")

    sold_now = F.col("_SOLD_NOW")
    gate = sold_now if require_base_sale else F.lit(True)
    first = F.when(sold_now, F.col("_FIRST_SALE"))
    leads_out = [F.when(gate, F.col(f"_{name}_{k}")).alias(f"{name}_{k}")
                 for k in leads for name in LEAD_COLUMNS.values()]
    return rows.select(*inv_m.columns, *leads_out, first.alias("FIRST_SALE_DATE"),
                       F.when(sold_now, F.col("_LAST_SALE")).alias("LAST_SALES_DATE"), "FIRST_RECEIPT_DATE",
                       F.when(sold_now, F.least("_FIRST_SALE", "FIRST_RECEIPT_DATE")).alias("INTRODUCTION_DATE"),
                       *[F.col(f"_FACT_{c}").alias(c) for c in carried])


def sell_through(leads: DataFrame, keys: Sequence[str], strict_band: bool = False,
                 insert_date: date | None = None) -> DataFrame:
    """FACT_SELL_THRU from ``lead_sales``.

    By default units sold count as they are wherever the cost check has a value, and 0 elsewhere;
    ``strict_band`` replaces them by cost of goods / unit cost outside the +-30% band.
    """
    lead_names = [f"{name}_{k}" for name in LEAD_COLUMNS.values() for k in LEADS]
    df = leads.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in lead_names})

    def total(name: str) -> Column:
        return F.col(f"{name}_1") + F.col(f"{name}_2") + F.col(f"{name}_3")

    cost, held = F.col("TOTAL_COST_EXTENDED"), F.col("QUANTITY_ON_HAND")
    unit, adj, cpu = F.col("COGS_UNIT"), F.col("ADJ_QTY_DEMAND"), F.col("CPU")
    diff = F.col("COGS_CHECK_PERCENTAGE_DIFF")
    cogs, units = F.col("THREE_MONTH_TOTAL_COGS"), F.col("THREE_MONTH_TOTAL_UNITS")

    def over(a: Column, b: Column) -> Column:
        return F.when(b != 0, a / F.when(b != 0, b))

    df = df.withColumns({"THREE_MONTH_TOTAL_COGS": total("COGS_AMOUNT_X"),
                         "THREE_MONTH_TOTAL_UNITS": total("UNITS_SOLD_X"),
                         "THREE_MONTH_TOTAL_SALES": total("SALES_AMOUNT_X")})
    df = df.withColumn("COGS_UNIT", F.when(units == 0, F.when(cogs != 0, 0.0)).otherwise(pdiv(cogs, units)))
    df = df.withColumn("ADJ_QTY_DEMAND", F.when(held == 0, over(cost, unit)).otherwise(held))
    df = df.withColumn("CPU", F.when(adj == 0, 0.0).otherwise(over(cost, adj)))
    df = df.withColumn("COGS_CHECK_PERCENTAGE_DIFF", over(unit - cpu, cpu))
    adjusted = {}
    for k in LEADS:
        plain = F.col(f"UNITS_SOLD_X_{k}")
        if strict_band:
            outside = (diff < -COST_BAND) | (diff > COST_BAND)
            plain = F.when(outside, over(F.col(f"COGS_AMOUNT_X_{k}"), cpu)).otherwise(plain)
        adjusted[f"UNITS_SOLD_X_{k}_ADJ"] = F.coalesce(F.when(diff.isNotNull(), plain), F.lit(0.0))
    df = df.withColumns(adjusted)
    left = adj
    for k in LEADS:
        df = df.withColumn(f"UNITS_ST_{k}", F.least(F.col(f"UNITS_SOLD_X_{k}_ADJ"), left))
        left = left - F.col(f"UNITS_ST_{k}")
    df = df.withColumns({f"COST_ST_{k}": F.col(f"UNITS_ST_{k}") * cpu for k in LEADS})

    month = F.col("BOM_INV_DATE")
    carried = present(df, ["SKU_SEQ_ID", *BUCKET_COLUMNS])
    computed = [*lead_names, "THREE_MONTH_TOTAL_COGS", "THREE_MONTH_TOTAL_UNITS", "THREE_MONTH_TOTAL_SALES",
                "COGS_UNIT", "ADJ_QTY_DEMAND", "CPU", "COGS_CHECK_PERCENTAGE_DIFF", *adjusted,
                *[f"UNITS_ST_{k}" for k in LEADS], *[f"COST_ST_{k}" for k in LEADS]]
    return df.select(*keys, "BOM_INV_DATE", date_key(month).alias("DATE_KEY"), F.col("TRIM_SKU").alias("SKU"),
                     held.alias("GROSS_INVENTORY_QUANTITY"), cost.alias("GROSS_INVENTORY_COST"), *computed,
                     "FIRST_SALE_DATE", "LAST_SALES_DATE", "FIRST_RECEIPT_DATE", "INTRODUCTION_DATE", *carried,
                     F.lit(insert_date).cast("date").alias("INSERT_DATE"))
