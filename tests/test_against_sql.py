"""Queries on the smallest test tables against DuckDB, and what their plans may not contain."""

import pytest

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.compare import difference, duck
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
CHECKED = ["cast_to_schema", "align_columns", "temp_invbucket", "dim_category_new_rows", "dim_sku", "fact_sales",
           "month_availability_3_months", "demand_metrics_6_months", "fact_twelve_month_annualized", "stock_out_run_off",
           "fact_six_month_quintile", "fact_inv_mvmt", "fifo", "fact_gross_margin_cycle", "fact_sell_thru_strict_band"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_inputs_hold_every_line_on_both_sides(spark):
    lines = fx.lines(spark, SF)
    n = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    added = {b: lines.where((F.col("_BRAND") == b) & (F.col("COUNTRY") == c)).count() for b, c in (("Brand#1", "AFRICA"), ("Brand#2", "ASIA"))}
    assert fx.sales_lines(lines).count() == n + added["Brand#1"]
    assert fx.inventory_lines(lines).count() == n + added["Brand#2"]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLE[name]).df()) == ""


@pytest.mark.parametrize("name", ["fact_two_month_inventory", "fact_two_month_quintile", "fact_inv_mvmt", "fifo",
                                  "fact_sales_cycle", "fact_sell_thru", "temp_salesbucket", "dim_sku"])
def test_no_query_pairs_all_rows_or_gathers_them(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in plan
