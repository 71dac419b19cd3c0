"""By part the tables are spread by series once; nothing made of them is shuffled again."""

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import queries
from checks.compare import difference
from checks.oracle import ORACLE
from order_tables import write_orders
from sample_tables import KEYS, inventory, key, sales
from stocklens.functions.grain import by_known_keys, lifetime, stack
from stocklens.operators import cycles, dates, dims, facts
from stocklens.sources import staging


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    return write_orders(spark, str(tmp_path_factory.mktemp("order tables")))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _matches_sql(spark, orders, name):
    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{orders}/{t}.parquet/*.parquet')")
    assert difference(queries.QUERIES[name](spark, orders).toPandas(), con.execute(ORACLE[name]).df()) == ""


def _series_stay_where_they_are(spark, orders, name):
    plan = _plan(queries.QUERIES[name](spark, orders))
    assert "Window" in plan and "Exchange hashpartitioning(" not in plan


def test_staged_by_series_tables_group_join_and_stack_in_place(spark):
    rows = [(key(s, division=d), m, 1.0 + m, 2.0) for s in "ABCDEF" for d in ("D", None) for m in range(3)]
    inv, sale = inventory(spark, rows), sales(spark, [(k, m, q, c, c) for k, m, q, c in rows])
    a, b = (staging.stage(df, "test-series", by=KEYS, buckets=3) for df in (inv, sale))
    assert a.columns == inv.columns and b.dtypes == sale.dtypes
    assert sorted(map(str, a.collect())) == sorted(map(str, inv.collect()))
    st = stack(KEYS, inv=(a.dropna(subset=KEYS), "BOM_INV_DATE"), sale=(b, "BEG_MO")).withColumn("_ALL", F.count("*").over(lifetime(KEYS)))
    joined = a.dropna().groupBy(*KEYS).count().join(b.select(*KEYS).distinct(), KEYS)
    assert "Exchange" not in _plan(st) and joined.count() == 6
    assert {r["_ALL"] for r in st.where("DIVISION IS NOT NULL").collect()} == {6}
    table = spark.catalog.listTables(pattern=staging._table_prefix(spark) + "*")
    assert len(table) >= 2


def test_known_keys_and_others_share_no_key(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("a", "NA"), ("gone", "b"), (None, None)], "x string, y string")
    known, others = by_known_keys(df, ["x", "y"], "NA", "gone")
    assert [tuple(r) for r in known.collect()] == [("a", "b")]
    assert sorted(map(tuple, others.collect())) == [("NA", "NA"), ("NA", "b"), ("a", "NA"), ("a", "NA")]


def test_order_lines_carry_what_months_read(spark, orders):
    fine = queries.fx.lines(spark, orders, True)
    coarse = queries.fx.lines(spark, orders)
    assert not {"CATEGORY_1", "_BRAND"} & set(fine.columns)
    for side in (queries.fx.sales_lines, queries.fx.inventory_lines):
        assert side(fine).count() == side(coarse).count() > coarse.count()


def test_bucket_count_follows_the_input(spark, orders):
    lines = queries.fx.lines(spark, orders, True)
    assert staging.bucket_count(lines, 1 << 30) == spark.sparkContext.defaultParallelism
    assert staging.bucket_count(lines, 100) > 50


def test_sell_thru_by_part(spark, orders):
    _series_stay_where_they_are(spark, orders, "fact_sell_thru_by_part")
    _matches_sql(spark, orders, "fact_sell_thru_by_part")


def test_six_month_inventory_by_part(spark, orders):
    _series_stay_where_they_are(spark, orders, "fact_six_month_inventory_by_part")
    _matches_sql(spark, orders, "fact_six_month_inventory_by_part")


def _first_of_union(plan):
    """The text of the first branch of a plan's topmost union."""
    lines = plan.splitlines()
    top = next(i for i, x in enumerate(lines) if x.lstrip(" :+-").startswith("Union"))
    at = lines[top].index("Union")
    end = next(i for i in range(top + 1, len(lines)) if lines[i][at:at + 2] == "+-")
    return "\n".join(lines[top + 1:end])


def test_sales_cycle_by_part(spark, orders):
    """Only series with a missing key, which reads 'NA', move."""
    with staging._setting(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        plan = _first_of_union(_plan(queries.QUERIES["fact_sales_cycle_by_part"](spark, orders)))
    assert "Window" in plan and "SortMergeJoin" in plan and "Exchange hashpartitioning(" not in plan
    _matches_sql(spark, orders, "fact_sales_cycle_by_part")


def test_a_cycle_takes_missing_and_written_na_for_one(spark):
    sale = sales(spark, [(key(division=d), m, 1.0, 10.0, 5.0) for d, m in ((None, 1), ("NA", 2), ("D", 3))])
    inv = inventory(spark, [(key(division="NA"), 0, 1.0, 1.0)])
    staged = dates.bucket_staging(sale, inv, [])[0]
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    fact = facts.fact_sales(sale, staged, skus, [])
    got = sorted((r["DIVISION"], r["BEG_MO"].month, r["SALES_CYCLE_01"], r["SALES_CYCLE_02"]) for r in cycles.sales_cycle(sale, inv, fact, []).collect())
    assert got == [("D", 4, 10.0, 0.0), ("NA", 2, 10.0, 10.0), ("NA", 3, 10.0, 10.0)]


def test_inv_mvmt_by_part(spark, orders):
    _series_stay_where_they_are(spark, orders, "fact_inv_mvmt_by_part")
    _matches_sql(spark, orders, "fact_inv_mvmt_by_part")


def test_twelve_month_annualized_by_part(spark, orders):
    _series_stay_where_they_are(spark, orders, "fact_twelve_month_annualized_by_part")
    _matches_sql(spark, orders, "fact_twelve_month_annualized_by_part")
