"""Sales and inventory inputs derived from the order tables (FIXTURES.md section 2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocklens.functions.semantics import DEAL, SERIES_COLUMNS, present
from stocklens.operators.dates import BucketRange

KEYS = [DEAL, *SERIES_COLUMNS]

# Age ranges; the last one overlaps its neighbour on purpose.
RANGES = [BucketRange(*r) for r in (
    (-99999, 30, "0-30"), (31, 60, "31-60"), (61, 90, "61-90"), (91, 180, "91-180"), (181, 270, "181-270"),
    (271, 360, "271-360"), (361, 720, "361-720"), (721, 40000, ">720"), (30000, 99999, "NONE"))]


#: Lines that come once more under a series of their own: suffix of its SKU, and the brand and country they are of.
SALES_ONLY, STOCK_ONLY = "-S", "-I"
_COPIED = {SALES_ONLY: ("Brand#1", "AFRICA"), STOCK_ONLY: ("Brand#2", "ASIA")}


def _money(x: Column) -> Column:
    return x.cast("decimal(18,4)")


def lines(spark: SparkSession, sf_dir: str, by_part: bool = False) -> DataFrame:
    """One row per order line. The series SKU is the part's brand or, finer, the part itself.

    Lines travel to orders and parts with what is read of them later and nothing else. By part, the copies of some
    lines under a series of their own are rows as well (``_COPY``), so that rows stored by series need not move again.
    """
    def table(name: str, *columns: str | Column) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)

    number = F.col("l_linenumber")
    line = table("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_quantity",
                 _money(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("_NET"),
                 F.trunc("l_shipdate", "MM").alias("_SHIPPED"), (number % 2 == 0).alias("_EVEN"),
                 ((F.col("l_returnflag") == "R") & (number == 1)).alias("_RETURNED"),
                 ((F.col("l_linestatus") == "F") & (number == 7)).alias("_GONE"))
    joined = (line
              .join(table("supplier", "s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
              .join(table("orders", "o_orderkey", F.trunc("o_orderdate", "MM").alias("_ORDERED")), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(table("part", "p_partkey", "p_brand", "p_type", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
              .join(table("nation", "n_nationkey", "n_name", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
              .join(table("region", "r_regionkey", "r_name"), F.col("n_regionkey") == F.col("r_regionkey")))
    sku = F.col("p_brand")
    named = {"_BRAND": F.col("p_brand"), "CATEGORY_1": F.col("p_type")}
    if by_part:
        copies = [F.when((F.col("p_brand") == brand) & (F.col("r_name") == country), suffix)
                  for suffix, (brand, country) in _COPIED.items()]
        joined = joined.withColumn("_COPY", F.explode(F.array_compact(F.array(F.lit(""), *copies))))
        sku, named = F.concat(F.col("l_partkey").cast("string"), "_COPY"), {"_COPY": F.col("_COPY")}
    return joined.select(
        F.when(F.col("r_regionkey") <= 2, 1001).otherwise(1002).cast("bigint").alias(DEAL),
        F.col("n_name").alias("LOCATION"), F.col("r_name").alias("COUNTRY"),
        F.when(F.col("p_brand") != "Brand#25", "DIV1").alias("DIVISION"),
        F.lit("FG").alias("INVENTORY_TYPE"), sku.alias("TRIM_SKU"), *[c.alias(n) for n, c in named.items()], "_SHIPPED",
        F.when(F.col("_EVEN"), F.col("_ORDERED")).otherwise(F.col("_SHIPPED")).alias("_STOCKED"), "_RETURNED", "_GONE",
        F.col("l_quantity").alias("_UNITS"), F.col("p_retailprice").alias("_RETAIL"), "_NET")


def _with_copies(fx_line: DataFrame, suffix: str) -> DataFrame:
    """All lines, and those that come once more under a series of their own."""
    if "_COPY" in fx_line.columns:
        return fx_line.where(F.col("_COPY").isin("", suffix))
    brand, country = _COPIED[suffix]
    rows = fx_line.where((F.col("_BRAND") == brand) & (F.col("COUNTRY") == country))
    return fx_line.unionByName(rows.withColumn("TRIM_SKU", F.concat("TRIM_SKU", F.lit(suffix))))


def sales_lines(fx_line: DataFrame) -> DataFrame:
    """All lines as sales, and Brand#1's in AFRICA once more as series that are sales only."""
    kept = _with_copies(fx_line, SALES_ONLY)
    cogs = _money(F.col("_UNITS") * F.col("_RETAIL") * 0.6)

    def signed(x: Column) -> Column:
        return F.when(F.col("_RETURNED"), -x).otherwise(x)

    return kept.select(*KEYS, F.concat("TRIM_SKU", F.lit(" ")).alias("SKU"), *present(kept, ["CATEGORY_1"]),
                       F.trunc("_SHIPPED", "MM").alias("BEG_MO"), signed(_money(F.col("_UNITS"))).alias("QUANTITY_SOLD"),
                       signed(F.col("_NET")).alias("NET_SALES_$"),
                       signed(F.col("_NET") - cogs).alias("GROSS_MARGIN_$"),
                       signed(cogs).alias("COGS_$"))


def inventory_lines(fx_line: DataFrame) -> DataFrame:
    """All lines as stock, and Brand#2's in ASIA once more as series that are inventory only."""
    kept = _with_copies(fx_line, STOCK_ONLY)
    cost = _money(F.col("_UNITS") * F.col("_RETAIL") * 0.7)

    def held(x: Column) -> Column:
        return F.when(F.col("_GONE"), F.lit(0).cast("decimal(18,4)")).otherwise(x)

    return kept.select(*KEYS, F.concat("TRIM_SKU", F.lit(" ")).alias("SKU"), *present(kept, ["CATEGORY_1"]),
                       F.trunc("_STOCKED", "MM").alias("BOM_INV_DATE"), held(_money(F.col("_UNITS"))).alias("QUANTITY_ON_HAND"),
                       held(cost).alias("TOTAL_COST_EXTENDED"))


def _exact_months(rows: DataFrame, month: str, measures: list[str]) -> DataFrame:
    return rows.groupBy(*KEYS, month).agg(*[F.sum(m).cast("double").alias(m) for m in measures])


def sales(fx_line: DataFrame) -> DataFrame:
    """Monthly sales, summed as decimals so that every engine gets the same doubles."""
    return _exact_months(sales_lines(fx_line), "BEG_MO", ["QUANTITY_SOLD", "NET_SALES_$", "GROSS_MARGIN_$", "COGS_$"])


def inventory(fx_line: DataFrame) -> DataFrame:
    return _exact_months(inventory_lines(fx_line), "BOM_INV_DATE", ["QUANTITY_ON_HAND", "TOTAL_COST_EXTENDED"])


def doubles(df: DataFrame) -> DataFrame:
    """Lines with double measures, as an input file would hold them."""
    return df.withColumns({f.name: F.col(f.name).cast("double") for f in df.schema.fields
                           if f.dataType.typeName() == "decimal"})
