import random

import pytest
from pyspark.sql import functions as F

from sample_tables import KEYS, inventory, key, month, sales
from stocklens.operators import dates, demand, dims, facts


def _random_inputs(spark, seed=3):
    rnd = random.Random(seed)
    inv, sale = {}, {}
    for k in (key("A"), key("B"), key("A", deal=2), key("C", location="M")):
        for m in range(30):
            if rnd.random() < 0.6:
                inv[k, m] = (float(rnd.randrange(0, 50)), float(rnd.randrange(0, 500)))
            if rnd.random() < 0.5:
                sale[k, m] = (float(rnd.randrange(-3, 20)), float(rnd.randrange(0, 300)), float(rnd.randrange(0, 100)))
    return (inv, sale, inventory(spark, [(k, m, *v) for (k, m), v in inv.items()]),
            sales(spark, [(k, m, *v) for (k, m), v in sale.items()]))


@pytest.mark.parametrize("n", [2, 6, 24])
def test_trailing_sales_match_a_plain_loop(spark, n):
    inv, sale, inv_df, sale_df = _random_inputs(spark)
    got = {(tuple(r[k] for k in KEYS), r["BOM_INV_DATE"]): r for r in
           demand.trailing_sales(inv_df, sale_df, KEYS, n).collect()}
    assert len(got) == len(inv)
    for k, m in inv:
        window = [sale[k, x] for x in range(m - n + 1, m + 1) if (k, x) in sale]
        first = min(x for kk, x in sale if kk == k)
        row = got[k, month(m)]
        assert row["SALES_INFO_QUANTITY_SOLD"] == (sum(w[0] for w in window) if window else None)
        assert row["SALES_INFO_COGS"] == (sum(w[2] for w in window) if window else None)
        assert row["FIRST_SALE_DATE"] == (month(first) if window else None)
        assert row["FIRST_RECEIPT_DATE"] == month(min(x for kk, x in inv if kk == k))


def test_month_availability(spark):
    inv = inventory(spark, [(key(), m, 1.0, 1.0) for m in range(4)] + [(key("N"), 3, 1.0, 1.0), (key("B"), 0, 1.0, 1.0)])
    sale = sales(spark, [(key(), 1, 1.0, 1.0, 1.0), (key(), 3, 1.0, 1.0, 1.0), (key("B"), 2, 1.0, 1.0, 1.0)])
    got = {(r["TRIM_SKU"], r["BOM_INV_DATE"]): r["MONTH_AVAILABILITY"]
           for r in demand.month_availability(inv, sale, KEYS, 2).collect()}
    # first sale months are 1 (A) and 2 (B): only month 2 has both ends; N never sold
    assert got == {("A", month(0)): "dnu", ("A", month(1)): "dnu", ("A", month(2)): "use", ("A", month(3)): "dnu",
                   ("N", month(3)): "use", ("B", month(0)): "dnu"}


def _metrics(spark, stock, cost, sold, net, cogs, n=2, annualized=False):
    df = spark.createDataFrame(
        [(month(5), stock, cost, sold, net, cogs, None, month(0), month(0))],
        "BOM_INV_DATE date, QUANTITY_ON_HAND double, TOTAL_COST_EXTENDED double, SALES_INFO_QUANTITY_SOLD double, "
        "SALES_INFO_SOLD_AMOUNT double, SALES_INFO_COGS double, SALES_INFO_GM_AMOUNT double, FIRST_SALE_DATE date, "
        "FIRST_RECEIPT_DATE date")
    return demand.demand_metrics(demand.active_months(df, n), n, annualized)


def test_metrics_by_hand(spark):
    r = _metrics(spark, 10.0, 50.0, 8.0, 80.0, 44.0).first()
    assert (r["SALES_INFO_GM_AMOUNT"], r["SALES_INFO_PERCENT_SKU_GM"], r["SALES_INFO_COGS_PER_UNIT"]) == (36.0, 0.45, 5.5)
    assert (r["CPU"], r["SALES_INFO_TURNS"], r["SALES_INFO_MONTHS"]) == (5.0, 44.0 / 2 * 12 / 50, 2.0)
    assert r["SALES_INFO_PERCENT_COGS_CHANGE"] == (5.0 - 5.5) / 5.0 * 100
    assert (r["ADJUSTED_QTY"], r[demand.RATE], r["DEMAND_UNITS_NO_SALES"]) == (8.0, 4.0, 0.0)
    assert r["SALES_INFO_START_MONTH"] == month(4)


@pytest.mark.parametrize("cogs,adjusted", [(44.0, 8.0), (24.0, 24.0 / 5), (64.0, 64.0 / 5)])
def test_a_cost_change_beyond_30_percent_replaces_the_quantity(spark, cogs, adjusted):
    assert _metrics(spark, 10.0, 50.0, 8.0, 80.0, cogs).first()["ADJUSTED_QTY"] == adjusted


def test_exactly_30_percent_keeps_the_quantity(spark):
    # unit cost 10 against 13 and 7: the change is 30 either way
    for cogs in (13.0, 7.0):
        r = _metrics(spark, 1.0, 10.0, 1.0, 20.0, cogs).first()
        assert abs(r["SALES_INFO_PERCENT_COGS_CHANGE"]) == 30.0 and r["ADJUSTED_QTY"] == 1.0


def test_zero_cost_zero_sales_and_missing_stock(spark):
    free = _metrics(spark, 10.0, 0.0, 4.0, 8.0, 2.0).first()
    assert (free["CPU"], free["SALES_INFO_PERCENT_COGS_CHANGE"], free["ADJUSTED_QTY"]) == (0.0, 0.0, 4.0)
    none = _metrics(spark, 10.0, 5.0, None, None, None).first()
    assert (none[demand.RATE], none["DEMAND_UNITS_NO_SALES"]) == (0.0, 10.0)
    lost = _metrics(spark, None, 20.0, 2.0, 9.0, 4.0).first()
    assert (lost["ADJ_QTY_DEMAND"], lost["CPU"]) == (10.0, 2.0)


def test_annualized_rate_uses_active_months(spark):
    r = _metrics(spark, 10.0, 50.0, 8.0, 80.0, 44.0, n=24, annualized=True).first()
    assert r["SALES_INFO_MONTHS"] == 6.0 and r[demand.RATE] == 8.0 / 6


def _stock(spark, rows):
    df = spark.createDataFrame(rows, f"ADJ_QTY_DEMAND double, {demand.RATE} double, CPU double")
    return df.withColumns({demand.PLAIN_RATE: F.col(demand.RATE), "DEMAND_UNITS_NO_SALES":
                           F.when(F.col(demand.RATE) == 0, F.col("ADJ_QTY_DEMAND")).otherwise(0.0)})


def _waterfall(q, r):
    taken, out = 0.0, []
    for months in demand.BANDS.values():
        fill = min(r * months, q - taken) if r > 0 else 0.0
        out.append(fill)
        taken += fill
    none = q if r == 0 else 0.0
    return [*out, q - taken - none, none]


def test_waterfall_matches_the_band_by_band_fill(spark):
    cases = [(100.0, 7.0), (100.0, 0.0), (100.0, -2.0), (3.0, 5.0), (-4.0, 5.0), (0.0, 5.0), (1000.0, 1.5), (24.0, 1.0)]
    names = [f"DEMAND_UNITS_{b}" for b in [*demand.BANDS, "720", "NO_SALES"]]
    for (q, r), row in zip(cases, demand.demand_aging(_stock(spark, [(q, r, 2.0) for q, r in cases])).collect()):
        assert [row[n] for n in names] == pytest.approx(_waterfall(q, r))
        assert row["DEMAND_UNITS_CHECK"] == pytest.approx(0) and row["DEMAND_COST_TOTAL_AMOUNT"] == pytest.approx(2 * q)


def test_run_off_ends_with_the_stock(spark):
    rows = demand.stock_out_run_off(_stock(spark, [(31.5, 30.0, 2.0), (5.0, 0.0, 2.0), (3.0, 30.0, 1.0), (5.0, -30.0, 1.0),
                                                   (None, 30.0, 1.0)])).collect()
    weeks = [[r[f"STOCK_OUT_SALES_UNIT_{i}_WEEK"] for i in range(1, 17)] for r in rows]
    assert weeks[0][:6] == [7.0, 7.0, 7.0, 7.0, 3.5, None] and weeks[0][6:] == [None] * 10
    assert weeks[1] == [0.0] + [None] * 15
    assert weeks[2] == [3.0] + [None] * 15
    assert weeks[3] == [-7.0] + [None] * 15
    assert weeks[4] == [None] * 16
    assert rows[0]["STOCK_OUT_SALES_COST_5_WEEK_AMOUNT"] == 7.0


def test_all_ten_tables_have_one_row_per_inventory_month(spark):
    _, _, inv, sale = _random_inputs(spark, 9)
    staging = dates.bucket_staging(sale, inv, [dates.BucketRange(-9999, 9999, "x")])
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    fact = facts.fact_inventory(inv, staging[1], skus, [dates.BucketRange(-9999, 9999, "x")])
    tables = demand.demand_facts(fact, sale, KEYS)
    assert len(tables) == 10
    plain, yearly = tables["FACT_TWELVE_MONTH_INVENTORY"], tables["FACT_TWELVE_MONTH_ANNUALIZED"]
    assert "FIRST_RECEIPT_BUCKET_SEQ_ID" in yearly.columns and "FIRST_RECEIPT_DATE_BUCKET" in plain.columns
    rows = plain.collect()
    assert len(rows) == inv.count()
    assert all(abs(r["DEMAND_UNITS_CHECK"]) < 1e-6 for r in rows)
    assert all(sum(r[f"STOCK_OUT_SALES_UNIT_{i}_WEEK"] for i in range(1, 17)) <= r["ADJ_QTY_DEMAND"] + 1e-6
               for r in rows if r[demand.RATE] > 0)
    # the run-off of the annualized table keeps the plain rate
    pick = ["DEAL_ID", "LOCATION", "TRIM_SKU", "DATE_KEY", "STOCK_OUT_SALES_UNIT_SALES_PER_WEEK"]
    assert {tuple(r) for r in plain.select(*pick).collect()} == {tuple(r) for r in yearly.select(*pick).collect()}
