"""Dimensions over several runs, and ids that clash."""

import uuid

import pytest
from pyspark.sql import functions as F

from sample_tables import inventory, key, sales
from stocklens.functions import census
from stocklens.operators.dims import DIM_KEYS, dim_category, distinct_ids, id_clashes
from stocklens.plans.outputs import SCHEMAS, conform_table
from stocklens.plans.star import OUTPUT_TABLES, dimensions, laid_out, stored_dimensions, write_tables
from stocklens.sources.readers import read_output
from stocklens.sources.staging import shared_folder, stage


def sides(spark, skus, deals=(1,)):
    keys = [key(s, deal=d) for d in deals for s in skus]
    sale, inv = sales(spark, [(k, 1, 1.0, 2.0, 1.0) for k in keys]), inventory(spark, [(k, 1, 1.0, 2.0) for k in keys])
    layout = sale.select("DEAL_ID").distinct().select("DEAL_ID", F.array(*[F.lit(c) for c in sale.columns]).alias(census.SALE_COLUMNS),
                                                      F.array(*[F.lit(c) for c in inv.columns]).alias(census.INV_COLUMNS))
    return laid_out(sale.join(layout, "DEAL_ID"), census.SALE_COLUMNS, inv), laid_out(inv.join(layout, "DEAL_ID"), census.INV_COLUMNS, sale), layout


def ids(df, name):
    return {(r["DEAL_ID"], r["TRIM_SKU"]): r[name] for r in df.collect()}


def test_second_run_adds_only_new_keys(spark):
    root = f"{shared_folder(spark)}/second-{uuid.uuid4().hex}"
    assert stored_dimensions(spark, root) == {}
    cat, sku = dimensions(*sides(spark, "AB", (1, 2)), None, stage)
    odd = cat.withColumns({"CATEGORY_SEQ_ID": F.col("CATEGORY_SEQ_ID") + 1, "CATEGORY_1": F.lit("kept")})  # told apart from ids made anew
    day = F.lit(None).cast("date")
    write_tables({"DIM_CATEGORY": odd.withColumn("INSERT_DATE", day), "DIM_SKU": sku.withColumn("INSERT_DATE", day)}, root)
    stored = stored_dimensions(spark, root)
    cat2, sku2 = dimensions(*sides(spark, "BC"), stored, stage)
    got, before = ids(cat2, "CATEGORY_SEQ_ID"), ids(odd, "CATEGORY_SEQ_ID")
    assert set(got) == {(1, "A"), (1, "B"), (1, "C")} and all(got[k] == before[k] for k in got if k in before)
    assert {r["TRIM_SKU"]: r["CATEGORY_1"] for r in cat2.collect()} == {"A": "kept", "B": "kept", "C": "NEED CAT"}
    assert ids(sku2, "SKU_SEQ_ID").items() >= {k: v for k, v in ids(sku, "SKU_SEQ_ID").items() if k[0] == 1}.items()
    plan = dimensions(*sides(spark, "BC"), stored, lambda df, name: df)[0]._jdf.queryExecution().toString()
    assert "DEAL_ID" in plan and len(ids(sku2, "SKU_SEQ_ID")) == 3
    write_tables({"DIM_CATEGORY": cat2.withColumn("INSERT_DATE", day), "DIM_SKU": sku2.withColumn("INSERT_DATE", day)}, root)
    assert read_output(spark, root, "DIM_CATEGORY", 2).count() == 2  # the other deal's rows stay


def test_clashing_ids_end_distinct_and_stable(spark):
    sale, inv, _ = sides(spark, [f"S{i:02}" for i in range(40)], (1, 2))
    dim = dim_category(sale, inv)
    made = [ids(distinct_ids(d, DIM_KEYS, "CATEGORY_SEQ_ID", bits=6), "CATEGORY_SEQ_ID") for d in (dim, dim.repartition(7, "TRIM_SKU"))]
    assert made[0] == made[1] and all(len({v for k, v in made[0].items() if k[0] == d}) == 40 for d in (1, 2))
    assert max(made[0].values()) < 64
    assert ids(distinct_ids(dim, DIM_KEYS, "CATEGORY_SEQ_ID"), "CATEGORY_SEQ_ID") == ids(dim, "CATEGORY_SEQ_ID")


def test_new_ids_avoid_stored_ones(spark):
    sale, inv, _ = sides(spark, "ABCDEFGH")
    dim = dim_category(sale, inv)
    taken = dim.where("TRIM_SKU < 'E'").select("DEAL_ID", "CATEGORY_SEQ_ID")
    got = distinct_ids(dim, DIM_KEYS, "CATEGORY_SEQ_ID", taken)
    assert got.join(taken, ["DEAL_ID", "CATEGORY_SEQ_ID"]).isEmpty() and id_clashes(got, DIM_KEYS, "CATEGORY_SEQ_ID").isEmpty()


def test_declared_layouts(spark):
    assert set(OUTPUT_TABLES) <= set(SCHEMAS)
    df = spark.createDataFrame([(1, "L", 5)], "DEAL_ID int, LOCATION string, LAST_SALES_DAYS int").withColumn("BEG_MO", F.current_timestamp())
    out = conform_table(df, "TEMP_SALESBUCKET")
    assert out.columns[:3] == ["DEAL_ID", "LOCATION", "MAJOR_FRAME"] and dict(out.dtypes)["INTRODUCTION_DATE"] == "string"
    assert dict(out.dtypes)["DEAL_ID"] == "bigint" and out.first()["FIRST_SALES_DAYS"] is None
    with pytest.raises(ValueError, match="LOT"):
        conform_table(df.withColumn("LOT", F.lit("x")), "TEMP_SALESBUCKET")
    assert "LOT" not in conform_table(df.withColumn("LOT", F.lit("x")), "TEMP_SALESBUCKET", drop_strangers=True).columns
    with pytest.raises(TypeError, match="LAST_SALES_DAYS"):
        conform_table(df.withColumn("LAST_SALES_DAYS", F.lit("five")), "TEMP_SALESBUCKET")
