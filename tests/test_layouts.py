"""Deals that differ in their columns: one run over all equals the runs of each."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from sample_tables import inventory, key, sales
from stocklens.functions import census
from stocklens.functions.grain import condense
from stocklens.operators.dates import BucketRange
from stocklens.plans.star import run_deals
from stocklens.sources import readers

RANGES = [BucketRange(-9999, 90, "young"), BucketRange(91, 99999, "old")]
TODAY = date(2022, 8, 15)


def deal_tables(spark, deal):
    """(sales, inventory) of one deal, in its own layout."""
    keys = [key(s, deal=deal, location=place) for s in "AB" for place in ("L1", "L2")]
    sale = sales(spark, [(k, m, float(m % 3 + 1), 5.0 * m + i, 2.0 + i) for i, k in enumerate(keys) for m in range(14) if (m + i) % 4])
    inv = inventory(spark, [(k, m, float(m % 4 + 3), 10.0 + m + i) for i, k in enumerate(keys) for m in range(14)])
    if deal == 1:
        sale = sale.withColumn("ORDER_DATE", F.when(F.month("BEG_MO") != 5, F.last_day("BEG_MO"))).drop("COGS_$")
        return sale, inv.withColumn("ORIGINAL_RETAIL_PRICE_EXTENDED", F.lit(3.5))
    sale = sale.drop("LOCATION", "GROSS_MARGIN_$").withColumns({"SKU": F.concat("TRIM_SKU", F.lit("  ")), "LOT": F.lit("lot")})
    return sale, inv.drop("LOCATION").withColumns({"CATEGORY_CODE_1": F.lit("X"), "LOT": F.lit(None).cast("string")})


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("deals"))
    single = {}
    for deal in (1, 2):
        sale, inv = deal_tables(spark, deal)
        sale.drop("DEAL_ID").write.parquet(f"{root}/sale/DEAL_ID={deal}")
        inv.drop("DEAL_ID").write.parquet(f"{root}/inv/DEAL_ID={deal}")
        single[deal] = run_deals(sale, inv, RANGES, insert_date=TODAY)
    sale, sale_census = readers.read_deals(spark, f"{root}/sale", "sale")
    inv, inv_census = readers.read_deals(spark, f"{root}/inv", "inv")
    return run_deals(sale, inv, RANGES, insert_date=TODAY, sale_census=sale_census, inv_census=inv_census), single


def content(df, columns):
    have = [F.col(c) if c in df.columns else F.lit(None).alias(c) for c in columns]
    return sorted(str(tuple(r)) for r in df.select(*[h.cast("string") for h in have]).collect())


@pytest.mark.parametrize("name", ["FACT_SALES", "FACT_INVENTORY", "TEMP_SALESBUCKET", "DIM_CATEGORY", "DIM_SKU", "FACT_SIX_MONTH_INVENTORY",
                                  "FACT_TWO_MONTH_QUINTILE", "FIFO", "FACT_SALES_CYCLE", "FACT_SELL_THRU", "FACT_INV_MVMT"])
def test_one_run_equals_single_runs(runs, name):
    together, single = runs
    columns = together[name].columns
    want = sorted(x for deal in single.values() for x in content(deal[name], columns))
    assert len(want) and content(together[name], columns) == want  # ids included: they don't hang on other deals' columns


def test_margins_by_deal(spark):
    rows = [(d, 10.0, None if d in (2, 3) else 4.0, None if d in (1, 3) else 6.5) for d in (1, 2, 3, 4)]
    raw = spark.createDataFrame(rows, "DEAL_ID long, `NET_SALES_$` double, `GROSS_MARGIN_$` double, `COGS_$` double")
    slim = condense(census.margin_parts(raw), ["NET_SALES_$", "GROSS_MARGIN_$", "COGS_$", *census.MARGIN_PARTS])
    layout = census.deal_layout(slim, spark.range(1, 5).withColumnRenamed("id", "DEAL_ID"))
    got = census.fill_margin_by_deal(slim.join(layout, "DEAL_ID"))
    assert {r["DEAL_ID"]: (r["GROSS_MARGIN_$"], r["COGS_$"]) for r in got.collect()} == {1: (4, 6), 2: (3.5, 6.5), 3: (0, 0), 4: (4, 6.5)}


def test_refused_layouts(spark):
    sale, inv = deal_tables(spark, 1)
    headers = {1: sale.columns}, {1: [c for c in inv.columns if c != "LOCATION"]}
    with pytest.raises(ValueError, match="deal 1"):
        run_deals(sale, inv, RANGES, sale_census=census.census_of_headers(spark, headers[0]),
                  inv_census=census.census_of_headers(spark, headers[1]))
    with pytest.raises(ValueError, match="without a census"):
        run_deals(sale, inv, RANGES, sale_census=census.census_of_headers(spark, {2: sale.columns}))


def test_census_by_value(spark):
    df = spark.createDataFrame([(1, "a", None), (1, None, None), (2, None, 3.0)], "DEAL_ID long, A string, B double")
    assert {r[0]: r[1] for r in census.census_by_value(df).collect()} == {1: ["A"], 2: ["B"]}
