import uuid
from datetime import date

import pytest

from pyspark.sql import functions as F

from sample_tables import inventory, key, sales
from stocklens.functions.grain import INVENTORY_MEASURES, condense
from stocklens.operators.dates import BucketRange
from stocklens.plans.star import USED_COLUMNS, both_sided_deals, run_deals, write_tables
from stocklens.sources import readers
from stocklens.sources.staging import shared_folder, small_side
from stocklens.sources.writers import write_output

RANGES = [BucketRange(-9999, 90, "young"), BucketRange(91, 99999, "old")]
TODAY = date(2022, 8, 15)


@pytest.fixture(scope="module")
def inputs(spark):
    def rows(deal):
        return [(key(s, deal=deal), m) for s in "AB" for m in range(14) if (m + deal) % 5 or s == "A"]
    inv = inventory(spark, [(k, m, float(m % 4 + 3), 10.0 + m) for d in (1, 2) for k, m in rows(d)])
    sale = sales(spark, [(k, m, float(m % 3), 5.0 * m, 2.0) for d in (1, 2, 3) for k, m in rows(d) if m % 2])
    return sale, inv


@pytest.fixture(scope="module")
def tables(inputs):
    return run_deals(*inputs, RANGES, insert_date=TODAY)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_all_tables_of_both_deals(tables):
    assert len(tables) == 22
    for name, df in tables.items():
        assert {r["DEAL_ID"] for r in df.select("DEAL_ID").distinct().collect()} == {1, 2}, name


def test_deals_with_one_side_only_are_left_out(inputs):
    sale, inv = both_sided_deals(*inputs)
    assert {r[0] for r in sale.select("DEAL_ID").distinct().collect()} == {1, 2}
    assert inv.count() == inputs[1].count()


def test_one_run_equals_the_union_of_single_runs(inputs, tables):
    sale, inv = inputs
    single = [run_deals(sale.where(f"DEAL_ID = {d}"), inv.where(f"DEAL_ID = {d}"), RANGES, insert_date=TODAY) for d in (1, 2)]
    for name in ("TEMP_SALESBUCKET", "FACT_INVENTORY", "FACT_SIX_MONTH_ANNUALIZED", "FACT_TWO_MONTH_QUINTILE", "FIFO",
                 "FACT_SELL_THRU"):
        assert _rows(tables[name]) == _rows(single[0][name].unionByName(single[1][name])), name


def test_unused_columns_and_prices_never_group(inputs):
    _, inv = inputs
    raw = inv.unionByName(inv)
    noisy = raw.withColumns({"INVOICE_NUMBER": F.monotonically_increasing_id(), "ORIGINAL_RETAIL_PRICE_EXTENDED": F.rand(3)})
    slim = condense(noisy, INVENTORY_MEASURES, USED_COLUMNS)
    assert slim.count() == condense(raw, INVENTORY_MEASURES, USED_COLUMNS).count() == inv.count()
    assert "INVOICE_NUMBER" not in slim.columns
    assert slim.agg(F.max("ORIGINAL_RETAIL_PRICE_EXTENDED")).first()[0] < 1
    assert _rows(slim.drop("ORIGINAL_RETAIL_PRICE_EXTENDED")) == _rows(condense(raw, INVENTORY_MEASURES, USED_COLUMNS))


def test_writing_again_changes_nothing_and_other_deals_stay(spark, tables):
    root = f"{shared_folder(spark)}/out-{uuid.uuid4().hex}"
    slim = {n: tables[n] for n in ("DIM_SKU", "FACT_SALES", "FIFO")}
    write_tables(slim, root)
    before = {n: _rows(readers.read_output(spark, root, n)) for n in slim}
    write_tables(slim, root)
    assert {n: _rows(readers.read_output(spark, root, n)) for n in slim} == before
    assert "MAJOR_FRAME" in readers.read_output(spark, root, "FACT_SALES").columns
    assert dict(readers.read_output(spark, root, "FACT_SALES").dtypes)["DEAL_ID"] == "bigint"
    write_output(tables["FIFO"].where("STEP <> 1"), root, "FIFO", [1, 2])  # a later run without one month
    assert readers.read_output(spark, root, "FIFO").where("STEP = 1").isEmpty()
    write_output(tables["FACT_SALES"].where("DEAL_ID = 2"), root, "FACT_SALES", [1, 2])  # deal 1 yields nothing now
    assert readers.read_output(spark, root, "FACT_SALES", 1).isEmpty()
    two = readers.read_output(spark, root, "FACT_SALES", 2)
    assert "PartitionFilters: [isnotnull(DEAL_ID" in two._jdf.queryExecution().toString()


def test_configuration_files(spark, tmp_path):
    spec, ranges = tmp_path / "spec.csv", tmp_path / "ranges.csv"
    spec.write_text("name,type\nsku,str\nbom,datetime\nquantity_on_hand,float\ndeal_id,int\n")
    ranges.write_text("Lower Bound,Upper Bound,Value\n0,30,a\n20,60,b\n")
    assert readers.read_bucket_ranges(spark, str(ranges)) == [BucketRange(0, 30, "a"), BucketRange(20, 60, "b")]
    data = tmp_path / "inv.csv"
    data.write_text("deal_id,sku,bom,quantity_on_hand,major_frame\n7,00012,2021-03-01,2.5,US\n")
    df = readers.read_input(spark, str(data), "inv", readers.read_type_spec(spark, str(spec)), format="csv")
    assert df.first().asDict() == {"DEAL_ID": 7, "SKU": "00012", "BOM_INV_DATE": date(2021, 3, 1),
                                   "QUANTITY_ON_HAND": 2.5, "COUNTRY": "US"}


def test_broadcast_only_below_the_bound(spark):
    def plan(limit):
        small = small_side(spark.range(50), "probe", limit)
        return spark.range(100).join(small, "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan(1_000_000) and "strategy=broadcast" not in plan(100)
