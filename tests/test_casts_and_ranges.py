"""Values that don't fit, and range lists too long for one CASE."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from stocklens.functions import schema as sc
from stocklens.operators.dates import BucketRange, bucket, bucketize, disjoint_pieces
from stocklens.sources.readers import read_checked


def plain(day, ranges):
    return next((r.value for r in reversed(ranges) if r.lower <= day <= r.upper), None)


def some_ranges(n, seed):
    rnd = random.Random(seed)
    lows = [rnd.randrange(-500, 20_000) for _ in range(n)]
    return [BucketRange(x, x + rnd.choice([-3, 0, 1, 5, 40, 3000]), f"v{i % (n // 2 + 1)}") for i, x in enumerate(lows)]


def test_pieces_equal_the_plain_loop():
    for n, seed in ((1, 1), (7, 2), (60, 3), (400, 4)):
        ranges = some_ranges(n, seed)
        pieces = disjoint_pieces(ranges)
        lowers = [p.lower for p in pieces]
        assert lowers == sorted(set(lowers)) and len(pieces) <= 2 * n
        for day in {x + e for r in ranges for x in (r.lower, r.upper) for e in (-1, 0, 1)}:
            at = sum(1 for x in lowers if x <= day)
            assert (pieces[at - 1].value if at else None) == plain(day, ranges)


@pytest.mark.parametrize("n", [65, 10_000])
def test_long_list_equals_the_plain_loop_without_a_join(spark, n):
    ranges = some_ranges(n, n)
    rnd = random.Random(5)
    days = [rnd.randrange(-700, 24_000) for _ in range(300)] + [None, -(2 ** 31), 2 ** 31 - 1]
    df = bucketize(spark.createDataFrame([(d,) for d in days], "d int"), "d", "b", ranges)
    assert {r["d"]: r["b"] for r in df.collect()} == {d: None if d is None else plain(d, ranges) for d in days}
    assert "Join" not in df._jdf.queryExecution().executedPlan().toString()


def test_short_and_long_form_agree(spark):
    ranges = some_ranges(64, 9)
    df = spark.range(-600, 24_000, 7).select(F.col("id").cast("int").alias("d"))
    both = df.select(bucket(F.col("d"), ranges).alias("a"), bucket(F.col("d"), [*ranges, BucketRange(1, 0, "never")]).alias("b"))
    assert both.where(~F.col("a").eqNullSafe(F.col("b"))).isEmpty()
    assert spark.range(1).select(bucket(F.col("id"), [BucketRange(1, 0, "x")] * 70).alias("b")).first()["b"] is None


def test_one_bad_value_costs_its_row(spark, tmp_path):
    path = tmp_path / "sale.csv"
    path.write_text("deal_id,sku,bom,quantity_sold,extra\n1,A,2021-01-01,2.5,x\n1,B,2021-13-01,many,y\n1,C,,,\n2,D,2021-02-01,1e3,z\n2,E,soon,3,z\n"
                    "two,F,2021-02-01,4,z\n")
    spec = {"deal_id": "int", "sku": "str", "bom": "datetime", "quantity_sold": "float", "not_there": "int"}
    good, bad = read_checked(spark, str(path), "sale", spec, format="csv")
    assert {r["SKU"]: (r["DEAL_ID"], r["BEG_MO"], r["QUANTITY_SOLD"]) for r in good.collect()} == {
        "A": (1, date(2021, 1, 1), 2.5), "C": (1, None, None), "D": (2, date(2021, 2, 1), 1000.0)}
    assert sorted(map(tuple, bad.collect()), key=str) == sorted(
        [(1, "bom", "2021-13-01", 1), (1, "quantity_sold", "many", 1), (2, "bom", "soon", 1), (None, "deal_id", "two", 1)], key=str)


def test_nothing_declared(spark):
    df = spark.createDataFrame([("x", 1)], "A string, `B.C` int")
    checked = sc.checked_cast(df, {})
    assert sc.good_rows(checked).collect() == df.collect() and sc.rejected_values(checked).isEmpty()
