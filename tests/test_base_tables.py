"""What queries stage before they run: each table when it is read, and once."""

from pyspark.sql import functions as F

from checks import queries
from sample_tables import inventory, key, sales
from stocklens.operators import dims
from stocklens.sources import staging


def _inputs(spark):
    return inventory(spark, [(key("A"), 1, 5.0, 9.0)]), sales(spark, [(key("A"), 1, 2.0, 8.0, 4.0)])


def _recorded(monkeypatch):
    names = []
    monkeypatch.setattr(queries, "stage", lambda df, name: names.append(name) or df)
    return names


def test_base_facts_wait_until_they_are_read(spark, monkeypatch):
    inv, sale = _inputs(spark)
    names = _recorded(monkeypatch)
    monkeypatch.setattr(queries, "monthly", lambda *a: (inv, sale))
    b = queries.Base(spark, "nowhere", False)
    assert b.skus.count() == 1 and names == ["dim-sku"]
    b.fact_inv, b.fact_inv
    assert names == ["dim-sku", "fact-inventory"]


def test_order_lines_are_joined_once(spark, monkeypatch):
    names = _recorded(monkeypatch)
    monkeypatch.setattr(queries, "_LINES", {})
    monkeypatch.setattr(queries.fx, "lines", lambda s, d, by_part: s.range(1))
    assert queries.stored_lines(spark, "nowhere") is queries.stored_lines(spark, "nowhere")
    assert names == ["order-lines"]


def test_a_dimension_without_attributes_joins_nothing(spark):
    inv, sale = _inputs(spark)
    skus = dims.dim_sku(dims.dim_category(sale, inv), sale, inv)
    assert "Join" not in skus._jdf.queryExecution().optimizedPlan().toString()


def test_months_by_part_are_combined_in_small_splits(spark, monkeypatch):
    """The map-side combine of nearly distinct groups reads bounded splits, whatever the size of the lines; the session's bound comes back."""
    bound, seen = "spark.sql.files.maxPartitionBytes", {}
    before = spark.conf.get(bound)
    monkeypatch.setattr(queries, "_LINES", {})
    monkeypatch.setattr(queries, "_STAGED", {})
    monkeypatch.setattr(queries, "stage", lambda df, name, **more: seen.update({name: spark.conf.get(bound)}) or df)
    for name in ("lines", "inventory", "sales"):
        monkeypatch.setattr(queries.fx, name, lambda *a: spark.range(1))
    queries.monthly(spark, "nowhere", True)
    assert seen == {"order-lines": before, "inventory-months": str(queries.SPLIT_BYTES), "sales-months": str(queries.SPLIT_BYTES)}
    assert spark.conf.get(bound) == before


def test_staged_files_split_at_their_row_groups(spark):
    wide = spark.range(0, 1 << 20, 1, 1).selectExpr("id", "uuid() as text")
    stored = staging.stage(wide, "test-splits", row_group_bytes=4 << 20)
    with staging.small_splits(spark, 4 << 20):
        sizes = stored.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 1 << 20 and max(r["count"] for r in sizes) < 1 << 19


def test_jobs_that_fill_buckets_shuffle_into_as_many(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(n) for n in names]
    with staging.shuffled_into(spark, 7):
        assert [spark.conf.get(n) for n in names] == ["7", str(staging.SHUFFLED_BYTES)]
    assert [spark.conf.get(n) for n in names] == before
