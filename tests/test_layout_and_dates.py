from datetime import date

import pytest
from pyspark.sql import functions as F

from sample_tables import KEYS, inventory, key, month, sales
from stocklens.functions import schema as sc
from stocklens.functions.semantics import clean_numeric, date_key, known, month_index, pdiv
from stocklens.operators import dates
from stocklens.operators.dates import BucketRange

INF = float("inf")
NONE = date(1900, 1, 1)


def test_division_never_fails_and_never_gives_nan(spark):
    rows = [(6.0, 3.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (INF, INF), (None, 2.0), (1.0, None), (1.0, INF)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = [r[0] for r in df.select(pdiv(F.col("a"), F.col("b"))).collect()]
    assert got == [2.0, INF, -INF, None, None, None, None, 0.0]
    assert spark.range(1).select(known(F.lit(float("nan")))).first()[0] is None


def test_month_index_and_date_key(spark):
    df = spark.createDataFrame([(date(2021, 12, 1), date(2022, 1, 9))], "a date, b date")
    a, b, k = df.select(month_index(F.col("a")), month_index(F.col("b")), date_key(F.col("b"))).first()
    assert (b - a, k) == (1, "20220109")


def test_clean_numeric(spark):
    df = spark.createDataFrame([(INF, None, 1), (float("nan"), "nan", None), (2.5, "x", 3)], "a double, s string, n long")
    assert [tuple(r) for r in clean_numeric(df, ["a", "s", "n"]).collect()] == [(0.0, "0", 1), (0.0, "0", 0), (2.5, "x", 3)]
    assert clean_numeric(df).columns == df.columns


def test_cast_to_schema_reports_what_it_leaves(spark):
    df = spark.createDataFrame([("1", "2.5", "2020-03-04", "q", 7)], "A string, B string, D string, X string, S int")
    spec = {"A": "int", "B": "float", "D": "datetime", "X": "blob", "S": "str"}
    assert list(sc.cast_to_schema(df, spec).first()) == [1, 2.5, date(2020, 3, 4), "q", "7"]
    assert sc.schema_report(df, {"A": "int", "X": "blob"}) == {"undeclared": ["B", "D", "S"], "unknown_type": ["X"]}


def test_canonical_names_and_back(spark):
    df = spark.createDataFrame([(1, "c", "d", "t", 5, date(2020, 1, 1), date(2020, 1, 31))],
                               "deal_id long, major_frame string, Minor_Frame string, sub_minor_frame string, "
                               "sku int, bom date, eom date")
    sale = sc.canonicalise(df, "sale")
    assert sale.columns == ["DEAL_ID", "COUNTRY", "DIVISION", "INVENTORY_TYPE", "SKU", "BEG_MO", "EOM_DATE"]
    assert dict(sale.dtypes)["SKU"] == "string"
    assert sc.canonicalise(df, "inv").columns[-2:] == ["BOM_INV_DATE", "EOM_INV_DATE"]
    assert sc.to_frames(sale).columns[1:4] == ["MAJOR_FRAME", "MINOR_FRAME", "SUB_MINOR_FRAME"]


def test_upper_strings_and_align(spark):
    assert sc.upper_strings(spark.createDataFrame([("ab", 1)], "s string, n int")).first()["s"] == "AB"
    a, b = spark.createDataFrame([("x",)], "K string"), spark.createDataFrame([("y", 2.0)], "K string, M double")
    left, right = sc.align_columns(a, b, ["M", "K", "NOWHERE"])
    assert left.columns == right.columns == ["M", "K"]
    assert left.first()["M"] is None and dict(left.dtypes)["M"] == "double"


def test_margin_is_filled_from_what_is_there(spark):
    df = sales(spark, [(key(), 0, 1.0, 10.0, 4.0)])
    assert sc.fill_margin(df.drop("COGS_$")).first()["COGS_$"] == 4.0
    assert sc.fill_margin(df.drop("GROSS_MARGIN_$")).first()["GROSS_MARGIN_$"] == 6.0
    both = sc.fill_margin(df.drop("GROSS_MARGIN_$", "COGS_$")).first()
    assert (both["GROSS_MARGIN_$"], both["COGS_$"]) == (0.0, 0.0)
    assert sc.fill_margin(df) is df


def test_conform_keeps_known_columns_and_writes_dates_as_text(spark):
    df = spark.createDataFrame([("c", date(2020, 5, 1), 1)], "COUNTRY string, BEG_DATE date, X int")
    assert sc.conform(df, ["BEG_DATE", "COUNTRY", "MISSING"]).first().asDict() == {
        "BEG_DATE": "2020-05-01", "MAJOR_FRAME": "c"}


def test_activity_needs_a_nonzero_total(spark):
    inv = inventory(spark, [(key(), 0, 1.0, 5.0), (key(), 0, 1.0, -5.0), (key(), 1, 1.0, 3.0), (key(), 4, 1.0, 2.0),
                            (key(), 6, 9.0, 0.0), (key("B"), 2, 1.0, 0.0), (key(division=None), 0, 1.0, 1.0)])
    got = {(r["TRIM_SKU"], r["BOM_INV_DATE"]): (r["F"], r["L"]) for r in dates.activity_dates(
        inv, KEYS, "BOM_INV_DATE", "TOTAL_COST_EXTENDED", "F", "L").collect()}
    assert got == {**{("A", month(m)): (month(1), month(4)) for m in (0, 1, 4, 6)}, ("B", month(2)): (NONE, NONE)}


def test_dates_cross_over_to_the_other_side(spark):
    inv = inventory(spark, [(key(), 0, 1.0, 1.0), (key("ONLY_INV"), 3, 1.0, 1.0)])
    sale = sales(spark, [(key(), 2, 1.0, 1.0, 1.0), (key("ONLY_SALE"), 1, 1.0, 1.0, 1.0)])
    s, i = dates.bucket_staging(sale, inv, [])
    s, i = ({r["TRIM_SKU"]: r.asDict() for r in df.collect()} for df in (s, i))
    assert i["A"]["FIRST_SALE_DATE"] == month(2) and s["A"]["LAST_RECEIPT_DATE"] == month(0)
    assert i["ONLY_INV"]["FIRST_SALE_DATE"] == NONE and s["ONLY_SALE"]["FIRST_RECEIPT_DATE"] == NONE
    assert i["ONLY_INV"]["INTRODUCTION_DATE"] == month(3) and s["ONLY_SALE"]["INTRODUCTION_DATE"] == month(1)
    assert i["A"]["FIRST_SALES_DAYS"] == -60 and i["A"]["INTRODUCTION_BUCKET"] is None
    with pytest.raises(ValueError):
        dates.bucket_staging(sale.drop("DIVISION"), inv, [])


def test_introduction_date(spark):
    d1, d2 = date(2020, 1, 1), date(2020, 2, 1)
    rows = [(NONE, NONE), (d1, NONE), (NONE, d2), (d1, d2), (d2, d1), (d1, None), (NONE, None)]
    df = spark.createDataFrame(rows, "s date, r date")
    got = [r[0] for r in df.select(dates.introduction_date(F.col("s"), F.col("r"))).collect()]
    assert got == [NONE, d1, d2, d1, d1, None, None]


def test_last_matching_range_wins(spark):
    ranges = [BucketRange(0, 30, "a"), BucketRange(31, 60, "b"), BucketRange(50, 70, "c")]
    df = spark.createDataFrame([(d,) for d in (0, 30, 31, 49, 50, 60, 70, 71, None)], "d int")
    got = [r["v"] for r in dates.bucketize(df, "d", "v", ranges).collect()]
    assert got == ["a", "a", "b", "b", "c", "c", "c", None, None]
