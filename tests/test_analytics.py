import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sample_tables import KEYS, inventory, key, month, sales
from stocklens.operators import cycles, dates, dims, facts, movement, quintile, sellthru

RANGES = [dates.BucketRange(0, 60, "new"), dates.BucketRange(61, 9999, "old")]


def _base(spark, inv, sale):
    staging = dates.bucket_staging(sale, inv, RANGES)
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    return (facts.fact_inventory(inv, staging[1], skus, RANGES), facts.fact_sales(sale, staging[0], skus, RANGES))


# --- quintile ----------------------------------------------------------------------------------

def test_quintile_with_ties_returns_and_missing_stock(spark):
    sold = {"A": 60.0, "B": 30.0, "C": 30.0, "R": -20.0, "N": 500.0, "Z": 40.0}
    sale = sales(spark, [(key(s), 5, 1.0, v, 1.0) for s, v in sold.items()] + [(key("OLD"), 1, 1.0, 999.0, 1.0)])
    inv = inventory(spark, [(key(s), 5, 2.0, 10.0) for s in "ABCR"] + [(key("Z"), 5, 0.0, 0.0), (key("N"), 4, 1.0, 1.0)])
    rows = {r["TRIM_SKU"]: r for r in quintile.sales_quintile(inv, sale).collect()}
    assert set(rows) == set(sold)
    assert {s: r["QUINTILE"] for s, r in rows.items()} == {
        "A": "3.0", "B": "5.0", "C": "nan", "R": "5.0", "N": "Sales No Inv", "Z": "Sales No Inv"}
    assert [rows[s]["COMMULATIVE_PERCENTAGE"] for s in "ABCR"] == [0.6, 0.9, 1.2, 1.0]
    assert (rows["N"]["PERCENT"], rows["N"]["SKU"], rows["Z"]["SKU"], rows["A"]["CPU"]) == (0.0, 1, 0, 5.0)
    assert rows["A"]["DATE_KEY"] == month(5).strftime("%Y%m%d")


@pytest.mark.parametrize("parts", [1, 9])
def test_chunked_running_totals_equal_one_window(spark, parts):
    rnd = random.Random(2)
    rows = [(1 if i % 3 else 2, float(rnd.choice([0, 0, 1, 5, 7])), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "DEAL_ID long, v double, id long").repartition(parts)
    order = [F.col("v").desc(), F.col("id").asc()]
    run = Window.partitionBy("DEAL_ID").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("id", F.sum("v").over(run).alias("T_RUN"), F.sum("v").over(Window.partitionBy("DEAL_ID")).alias("T_ALL"))
    a, b = ({r["id"]: (float(r["T_RUN"]), float(r["T_ALL"])) for r in x.collect()}
            for x in (quintile.running_totals(df, "DEAL_ID", order, {"T": F.col("v")}), plain))
    assert a == b and len(a) == 3000


# --- movement ----------------------------------------------------------------------------------

def test_movement_over_gaps_and_equal_months(spark):
    inv = inventory(spark, [(key(), m, q, 10.0) for m, q in ((0, 5.0), (1, 5.0), (2, 8.0), (4, 8.0))]
                    + [(key("Z"), 3, 0.0, 0.0)])
    sale = sales(spark, [(key(), 0, 1.0, 1.0, 1.0)])
    fact, _ = _base(spark, inv, sale)
    rows = {(r["SKU_SEQ_ID"], r["BOM_INV_DATE"]): r for r in movement.inventory_movement(fact, RANGES).collect()}
    assert len(rows) == 5
    a = {r["BOM_INV_DATE"]: r for r in rows.values() if r["TOTAL_COST"] == 10.0}
    moves = {m: (a[month(m)]["TWELVE_MONTH_UP"], a[month(m)]["TWELVE_MONTH_DOWN"], a[month(m)]["MONTHS_LAST_MOVE"])
             for m in (0, 1, 2, 4)}
    # month 4 sees 8 now, a missing month (0), then 8, 5, 5: up, down, up, no change, up
    assert moves == {0: (1, 0, 0), 1: (1, 0, 1), 2: (2, 0, 0), 4: (3, 1, 0)}
    assert a[month(4)]["TWELVE_MONTH_MVMT_CAT"] == "Up/Down" and a[month(1)]["LAST_MOVE_DATE"] == month(0)
    assert a[month(1)]["LASTMOVE_BUCKET_SEQ_ID"] == "new" and a[month(1)]["LAST_MOVE_DAYS"] == 31
    still = next(r for r in rows.values() if r["TOTAL_COST"] == 0.0)
    assert (still["SIX_MONTH_MVMT_CAT"], str(still["LAST_MOVE_DATE"]), still["CPU"]) == ("Static", "1900-01-01", 0.0)
    for r in rows.values():
        assert r["TWELVE_MONTH_UP"] + r["TWELVE_MONTH_DOWN"] + r["TWELVE_MONTH_NO_INV"] == 11
        assert r["SIX_MONTH_UP"] + r["SIX_MONTH_DOWN"] + r["SIX_MONTH_NO_INV"] == 5


def test_movement_leaves_out_rows_without_an_id(spark):
    inv = inventory(spark, [(key(), 0, 1.0, 1.0)])
    fact, _ = _base(spark, inv, sales(spark, [(key(), 0, 1.0, 1.0, 1.0)]))
    assert movement.movement_matrix(fact.withColumn("SKU_SEQ_ID", F.lit(None).cast("long"))).count() == 0


# --- cycles ------------------------------------------------------------------------------------

def test_cycle_counts_from_the_first_sale(spark):
    sale = sales(spark, [(key(), 2, 1.0, 10.0, 4.0), (key(), 4, 1.0, 20.0, 5.0), (key(), 26, 1.0, 99.0, 1.0),
                         (key(division=None), 2, 1.0, 7.0, 1.0)])
    inv = inventory(spark, [(key(), 1, 1.0, 1.0)])
    _, fact = _base(spark, inv, sale)
    rows = cycles.sales_cycle(sale, inv, fact, RANGES).collect()
    named = [r for r in rows if r["DIVISION"] == "D"]
    assert len(named) == 3
    for r in named:
        assert [r[f"SALES_CYCLE_{i:02d}"] for i in range(1, 25)] == [10.0, 0.0, 20.0] + [0.0] * 21
        assert (r["FIRST_RECEIPT_DATE"], r["INTRODUCTION_DATE"]) == (month(1), month(1))
    other = next(r for r in rows if r["DIVISION"] == "NA")
    assert other["SALES_CYCLE_01"] is None and other["INTRODUCTION_DATE"] is None and other["INTRODUCTION_BUCKET"] is None
    margin = cycles.margin_cycle(sale, inv, fact, RANGES).where("DIVISION = 'D'").first()
    assert (margin["GROSS_MARGIN_CYCLE_01"], margin["GROSS_MARGIN_CYCLE_03"]) == (6.0, 15.0)


# --- sell-through ------------------------------------------------------------------------------

def test_leads_need_a_sale_in_the_base_month_and_stock_in_the_deal(spark):
    inv = inventory(spark, [(key(), m, 10.0, 20.0) for m in (0, 1, 3)])
    sale = sales(spark, [(key(), 1, 4.0, 40.0, 8.0), (key(), 2, 5.0, 50.0, 10.0), (key(), 3, 6.0, 60.0, 12.0)])
    got = {r["BOM_INV_DATE"]: r for r in sellthru.lead_sales(inv, sale, KEYS).collect()}
    assert got[month(0)]["UNITS_SOLD_X_1"] is None and got[month(0)]["FIRST_SALE_DATE"] is None
    # month 2 has no inventory anywhere in the deal, so it is never a lead month
    assert (got[month(1)]["UNITS_SOLD_X_1"], got[month(1)]["UNITS_SOLD_X_2"]) == (None, 6.0)
    assert got[month(1)]["LAST_SALES_DATE"] == month(3)
    free = {r["BOM_INV_DATE"]: r for r in sellthru.lead_sales(inv, sale, KEYS, require_base_sale=False).collect()}
    assert (free[month(0)]["UNITS_SOLD_X_1"], free[month(0)]["UNITS_SOLD_X_3"]) == (4.0, 6.0)


def test_missing_keys_match_each_other(spark):
    k = key(division=None)
    inv = inventory(spark, [(k, 0, 10.0, 20.0), (k, 1, 10.0, 20.0)])
    sale = sales(spark, [(k, 0, 1.0, 1.0, 1.0), (k, 1, 3.0, 9.0, 6.0)])
    assert {r["UNITS_SOLD_X_1"] for r in sellthru.lead_sales(inv, sale, KEYS).collect()} == {3.0, None}


def _sold(spark, held, cost, units, cogs):
    one = {"DEAL_ID": 1, "LOCATION": "L", "COUNTRY": "C", "DIVISION": "D", "INVENTORY_TYPE": "FG", "TRIM_SKU": "A"}
    row = {**one, "BOM_INV_DATE": month(0), "QUANTITY_ON_HAND": held, "TOTAL_COST_EXTENDED": cost}
    for k in (1, 2, 3):
        row |= {f"SALES_AMOUNT_X_{k}": 0.0, f"UNITS_SOLD_X_{k}": units[k - 1], f"COGS_AMOUNT_X_{k}": cogs[k - 1]}
    row |= dict.fromkeys(("FIRST_SALE_DATE", "LAST_SALES_DATE", "FIRST_RECEIPT_DATE", "INTRODUCTION_DATE"), month(0))
    return spark.createDataFrame([row])


def test_sell_through_stops_at_the_stock(spark):
    r = sellthru.sell_through(_sold(spark, 10.0, 20.0, [4.0, 4.0, 4.0], [8.0, 8.0, 8.0]), KEYS).first()
    assert [r[f"UNITS_ST_{k}"] for k in (1, 2, 3)] == [4.0, 4.0, 2.0]
    assert (r["COST_ST_3"], r["COGS_UNIT"], r["CPU"], r["COGS_CHECK_PERCENTAGE_DIFF"]) == (4.0, 2.0, 2.0, 0.0)


def test_band_is_only_applied_when_strict(spark):
    dear = _sold(spark, 10.0, 20.0, [4.0, 0.0, 0.0], [16.0, 0.0, 0.0])
    assert sellthru.sell_through(dear, KEYS).first()["UNITS_SOLD_X_1_ADJ"] == 4.0
    assert sellthru.sell_through(dear, KEYS, strict_band=True).first()["UNITS_SOLD_X_1_ADJ"] == 8.0
    worthless = _sold(spark, 10.0, 0.0, [4.0, 0.0, 0.0], [16.0, 0.0, 0.0])
    r = sellthru.sell_through(worthless, KEYS).first()
    assert (r["COGS_CHECK_PERCENTAGE_DIFF"], r["UNITS_SOLD_X_1_ADJ"], r["UNITS_ST_1"]) == (None, 0.0, 0.0)


def test_stock_without_quantity_is_counted_from_its_cost(spark):
    r = sellthru.sell_through(_sold(spark, 0.0, 20.0, [2.0, 0.0, 0.0], [8.0, 0.0, 0.0]), KEYS).first()
    assert (r["COGS_UNIT"], r["ADJ_QTY_DEMAND"], r["CPU"]) == (4.0, 5.0, 4.0)
    idle = sellthru.sell_through(_sold(spark, 0.0, 20.0, [0.0] * 3, [0.0] * 3), KEYS).first()
    assert (idle["COGS_UNIT"], idle["ADJ_QTY_DEMAND"], idle["CPU"], idle["UNITS_ST_1"]) == (None, None, None, 0.0)
