from pyspark.sql import functions as F

from sample_tables import KEYS, inventory, key, month, sales
from stocklens.functions.grain import condense, monthly_inventory
from stocklens.operators import dates, dims, facts


def _with(df, **cols):
    return df.withColumns({c: F.lit(v) for c, v in cols.items()})


def test_inventory_wins_and_gaps_are_named(spark):
    inv = _with(inventory(spark, [(key(), 0, 1.0, 1.0), (key(division=None), 0, 1.0, 1.0)]), SKU="A", CATEGORY_1="inv")
    sale = _with(sales(spark, [(key(), 0, 1.0, 1.0, 1.0), (key("B"), 0, 1.0, 1.0, 1.0)]), SKU="A", CATEGORY_1="sale",
                 CATEGORY_CODE_1=None).withColumn("CATEGORY_CODE_1", F.lit(None).cast("string"))
    dim = {(r["TRIM_SKU"], r["DIVISION"]): r.asDict() for r in dims.dim_category(sale, inv).collect()}
    assert {k: r["CATEGORY_1"] for k, r in dim.items()} == {("A", "D"): "inv", ("A", "NEED CAT"): "inv", ("B", "D"): "sale"}
    row = dim["A", "D"]
    assert (row["CATEGORY_2"], row["CATEGORY_CODE_1"], row["CATEGORY_CODE_2"]) == ("NEED CAT", "NEED CAT", "NA")
    assert len({r["CATEGORY_SEQ_ID"] for r in dim.values()}) == 3


def test_known_keys_are_not_added_again(spark):
    inv, sale = inventory(spark, [(key(), 0, 1.0, 1.0)]), sales(spark, [(key("B"), 0, 1.0, 1.0, 1.0)])
    stored = dims.dim_category(sale, inv).where("TRIM_SKU = 'A'")
    assert [r["TRIM_SKU"] for r in dims.dim_category(sale, inv, stored).collect()] == ["B"]


def test_sku_attributes_fill_from_sales_and_blanks_are_trimmed(spark):
    inv = _with(inventory(spark, [(key(), 0, 1.0, 1.0), (key("B"), 0, 1.0, 1.0)]), SKU=" A ", DESCRIPTION_1="inv")
    inv = inv.withColumn("DESCRIPTION_1", F.when(F.col("TRIM_SKU") == "A", F.col("DESCRIPTION_1")))
    sale = _with(sales(spark, [(key(), 0, 1.0, 1.0, 1.0), (key("B"), 0, 1.0, 1.0, 1.0)]), SKU=" A ", DESCRIPTION_1="sale")
    dim = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    rows = dim.orderBy("DESCRIPTION_1").collect()
    assert [r["DESCRIPTION_1"] for r in rows] == ["inv", "sale"]
    assert {r["TRIM_SKU"] for r in rows} == {"A"} and len({r["SKU_SEQ_ID"] for r in rows}) == 1
    assert dims.id_clashes(dim, ["DEAL_ID", "SKU", "TRIM_SKU"], "SKU_SEQ_ID").count() == 0


def test_ids_do_not_depend_on_partitions_and_tell_null_from_empty(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "x"), (1, "x", None)], "DEAL_ID long, A string, B string")
    one = dims.surrogate_key(df.coalesce(1), df.columns, "ID").collect()
    spread = dims.surrogate_key(df.repartition(3), df.columns, "ID").collect()
    assert set(map(tuple, one)) == set(map(tuple, spread))
    assert len({r["ID"] for r in one}) == 3


def test_clashing_ids_are_found(spark):
    df = spark.createDataFrame([(1, "a", 7), (1, "b", 7), (2, "a", 7)], "DEAL_ID long, SKU string, ID long")
    assert [r["KEYS"] for r in dims.id_clashes(df, ["DEAL_ID", "SKU"], "ID").collect()] == [2]


def test_fact_sums_lines_and_keeps_one_attribute_row(spark):
    lines = [(key(), 0, 2.0, 10.0), (key(), 0, 3.0, 5.0), (key(), 1, 0.0, 4.0), (key(division=None), 0, 1.0, 1.0)]
    inv = inventory(spark, lines).withColumn("LOT", F.when(F.col("QUANTITY_ON_HAND") == 2, "z").otherwise("a"))
    sale = sales(spark, [(key(), 0, 1.0, 1.0, 1.0)])
    staging = dates.bucket_staging(sale, inv, [])
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    got = {r["BOM_INV_DATE"]: r.asDict() for r in facts.fact_inventory(inv, staging[1], skus, []).collect()}
    first, second = got[month(0)], got[month(1)]
    assert (first["QUANTITY_ON_HAND"], first["GROSS_INVENTORY_COST"], first["UNIT_COST"], first["LOT"]) == (5.0, 15.0, 3.0, "a")
    assert second["UNIT_COST"] == 0.0 and second["DATE_KEY"] == "20200201"
    assert len(got) == 2 and first["SKU_SEQ_ID"] == second["SKU_SEQ_ID"] is not None
    fact = facts.fact_sales(sale, staging[0], skus, []).first()
    assert (fact["GROSS_MARGIN_$"], fact["FIRST_RECEIPT_DATE"]) == (0.0, month(0))


def test_order_dates_refine_the_fact_and_collapse_again(spark):
    inv = inventory(spark, [(key(), 0, 2.0, 10.0), (key(), 0, 3.0, 5.0)])
    inv = inv.withColumn("EXPIRATION_DATE", F.when(F.col("QUANTITY_ON_HAND") == 2, F.lit(month(5))).otherwise(F.lit(month(6))))
    sale = sales(spark, [(key(), 0, 1.0, 1.0, 1.0)])
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    fact = facts.fact_inventory(inv, dates.bucket_staging(sale, inv, [])[1], skus, [])
    assert fact.count() == 2
    month_rows = facts.month_grain(fact, KEYS, "BOM_INV_DATE", ["QUANTITY_ON_HAND", "TOTAL_COST_EXTENDED"]).collect()
    assert [(r["QUANTITY_ON_HAND"], r["TOTAL_COST_EXTENDED"]) for r in month_rows] == [(5.0, 15.0)]


def test_missing_numbers_are_skipped_in_sums(spark):
    inv = inventory(spark, [(key(), 0, float("nan"), 1.0), (key(), 0, 2.0, None), (key("B"), 0, None, None)])
    got = {r["TRIM_SKU"]: (r["QUANTITY_ON_HAND"], r["TOTAL_COST_EXTENDED"]) for r in monthly_inventory(inv).collect()}
    assert got == {"A": (2.0, 1.0), "B": (0.0, 0.0)}
    slim = condense(inv, ["QUANTITY_ON_HAND", "TOTAL_COST_EXTENDED"])
    assert {r["TRIM_SKU"]: r["QUANTITY_ON_HAND"] for r in monthly_inventory(slim).collect()} == {"A": 2.0, "B": 0.0}
