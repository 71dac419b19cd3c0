"""Reading inputs: sales and inventory tables, type declarations, bucket ranges, stored dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions.census import census_of_headers
from stocklens.functions.schema import canonicalise, cast_to_schema, checked_cast, good_rows, rejected_values
from stocklens.functions.semantics import DEAL
from stocklens.operators.dates import BucketRange
from stocklens.sources.published import read_published
from stocklens.sources.staging import folders


def read_table(spark: SparkSession, path: str, format: str = "parquet", **options) -> DataFrame:
    """All deals of one table; a folder per deal written as DEAL_ID=<id> gives the column back."""
    if format == "csv":
        options = {"header": True, **options}
    return spark.read.format(format).options(**options).load(path)


def read_input(spark: SparkSession, path: str, kind: str, spec: Mapping[str, str] | None = None,
               format: str = "parquet", **options) -> DataFrame:
    """Typed input of one side ('sale' or 'inv') under canonical headers."""
    df = read_table(spark, path, format, **options)
    return canonicalise(cast_to_schema(df, spec) if spec else df, kind)


def read_checked(spark: SparkSession, path: str, kind: str, spec: Mapping[str, str], format: str = "parquet",
                 **options) -> tuple[DataFrame, DataFrame]:
    """Input of one side whose values all fit their declared types, and the values that don't, counted by deal and column.

    ``spec`` names columns as the files do; one bad value costs its row, not the run.
    """
    raw = read_table(spark, path, format, **options)
    deal = next((c for c in raw.columns if c.upper() == DEAL), None)
    checked = checked_cast(raw, spec)
    counted = checked.withColumnRenamed(deal, DEAL) if deal else checked
    return canonicalise(good_rows(checked), kind), rejected_values(counted)


def read_deals(spark: SparkSession, root: str, kind: str, spec: Mapping[str, str] | None = None,
               format: str = "parquet", **options) -> tuple[DataFrame, DataFrame]:
    """Typed input of one side from ``<root>/DEAL_ID=<id>/`` folders, and the census of their headers.

    Deals may differ in their columns. Each folder's header is read once; folders with equal headers are one
    scan, so the plan grows with the number of layouts, not of deals.
    """
    if format == "csv":
        options = {"header": True, **options}
    reader = spark.read.format(format).options(**options)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path in folders(spark, root):
        if path.rsplit("/", 1)[-1].startswith(f"{DEAL}="):
            layouts.setdefault(tuple(reader.load(path).columns), []).append(path)
    sides, headers = [], {}
    for paths in layouts.values():
        df = reader.option("basePath", root).load(paths)
        df = canonicalise(cast_to_schema(df, spec) if spec else df, kind)
        sides.append(df.withColumn(DEAL, F.col(DEAL).cast("bigint")))
        headers |= {int(p.rsplit("=", 1)[-1]): df.columns for p in paths}
    if not sides:
        raise FileNotFoundError(f"no {DEAL}=<id> folders in {root}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides), census_of_headers(spark, headers)


def read_type_spec(spark: SparkSession, path: str) -> dict[str, str]:
    """Declared column types from a CSV ``name,type``: one line per input column."""
    rows = spark.read.csv(path, header=True).select("name", "type").collect()
    return {r["name"]: r["type"] for r in rows}


def read_bucket_ranges(spark: SparkSession, path: str) -> list[BucketRange]:
    """Age ranges from a CSV ``Lower Bound,Upper Bound,Value`` in file order, which decides overlaps."""
    lines = spark.read.csv(path, header=True).coalesce(1).withColumn("_POS", F.monotonically_increasing_id())
    rows = lines.orderBy("_POS").collect()
    return [BucketRange(int(r["Lower Bound"]), int(r["Upper Bound"]), r["Value"]) for r in rows]


def read_output(spark: SparkSession, root: str, name: str, deal_id: int | None = None) -> DataFrame:
    """A published output table, or one deal of it (only that deal's folder is read)."""
    df = read_published(spark, root, name)
    return df if deal_id is None else df.where(F.col(DEAL) == deal_id)
