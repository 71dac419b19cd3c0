"""Sales quintiles of the latest months, and the running totals they need."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocklens.functions.grain import SALES_MEASURES, monthly_inventory, sum_or_zero
from stocklens.functions.semantics import DEAL, SALES_NO_INV, date_key, finite, pdiv, series_keys
from stocklens.operators.facts import sku_ids
from stocklens.sources.staging import small_side, stage

# Upper bounds of the five quintiles on the cumulative share.
QUINTILE_BOUNDS = {0.2: "1.0", 0.4: "2.0", 0.6: "3.0", 0.8: "4.0", 1.0: "5.0"}
EXACT = "decimal(28,6)"


def running_totals(df: DataFrame, group: str, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """Add ``<name>_RUN`` (total up to the row) and ``<name>_ALL`` (total of the group).

    Totals are decimal, so they do not depend on partitioning. No group is held in
    one task: range-partition on the full order, total each chunk, add the totals of
    earlier chunks to a running sum within the chunk. The chunked rows are staged because both
    passes must see the same chunk bounds.
    """
    df = df.withColumns({f"_{n}": F.coalesce(x.cast(EXACT), F.lit(0).cast(EXACT)) for n, x in sums.items()})
    chunked = df.repartitionByRange(group, *order).withColumn("_CHUNK", F.spark_partition_id())
    chunked = stage(chunked, "running-totals")
    totals = chunked.groupBy(group, "_CHUNK").agg(*[F.sum(f"_{n}").alias(f"_{n}_CHUNK") for n in sums])
    earlier = Window.partitionBy(group).orderBy("_CHUNK").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(group).orderBy("_CHUNK").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast(EXACT)
    offsets = totals.select(
        group, "_CHUNK",
        *[F.coalesce(F.sum(f"_{n}_CHUNK").over(earlier), zero).alias(f"_{n}_BEFORE") for n in sums],
        *[F.sum(f"_{n}_CHUNK").over(every).alias(f"{n}_ALL") for n in sums])
    run = Window.partitionBy(group, "_CHUNK").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = chunked.withColumns({f"_{n}_WITHIN": F.sum(f"_{n}").over(run) for n in sums})
    rows = within.join(offsets, [group, "_CHUNK"])
    return rows.select(*[c for c in df.columns if c not in {f"_{n}" for n in sums}],
                       *[(F.col(f"_{n}_BEFORE") + F.col(f"_{n}_WITHIN")).alias(f"{n}_RUN") for n in sums],
                       *[F.col(f"{n}_ALL") for n in sums])


def sales_quintile(inv: DataFrame, sale: DataFrame, dim_sku: DataFrame | None = None, n: int = 2,
                   insert_date: date | None = None) -> DataFrame:
    """FACT_<n>_MONTH_QUINTILE: series ranked by sales of the latest ``n`` months of their deal."""
    keys = series_keys(inv, sale)
    latest = sale.groupBy(DEAL).agg(F.max("BEG_MO").alias("_LATEST"))
    months = latest.select(DEAL, "_LATEST", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_BACK"))
    months = small_side(months.select(DEAL, "_LATEST", F.add_months("_LATEST", -F.col("_BACK")).alias("BEG_MO")),
                        "quintile-months")
    # The month join comes first, so that only the latest months are aggregated, and once.
    sold = (sale.dropna(subset=[*keys, "BEG_MO"]).join(months, [DEAL, "BEG_MO"]).groupBy(*keys)
            .agg(*[sum_or_zero(m).alias(m) for m in SALES_MEASURES], F.max("_LATEST").alias("_LATEST")))
    now = months.where(F.col("BEG_MO") == F.col("_LATEST")).select(DEAL, F.col("_LATEST").alias("BOM_INV_DATE"))
    stock = monthly_inventory(inv.join(now, [DEAL, "BOM_INV_DATE"], "left_semi"), keys).drop("BOM_INV_DATE")
    rows = sold.join(stock, keys, "left")

    cost, net = F.col("TOTAL_COST_EXTENDED"), F.col("NET_SALES_$")
    has_inv = F.coalesce(cost != 0, F.lit(False))
    order = [net.desc(), *[F.col(k).asc() for k in keys if k != DEAL]]
    rows = running_totals(rows, DEAL, order, {"_SOLD": F.when(has_inv, net), "_COST": cost})

    def share(part: Column, name: str) -> Column:
        return pdiv(part.cast("double"), F.col(f"{name}_ALL").cast("double"))

    cum = F.col("COMMULATIVE_PERCENTAGE")
    quintile = F.when(~has_inv, SALES_NO_INV)
    for bound, label in QUINTILE_BOUNDS.items():
        quintile = quintile.when(cum <= bound, label)
    rows = rows.withColumns({
        "PERCENT": F.when(has_inv, share(net, "_SOLD")).otherwise(0.0),
        "COMMULATIVE_PERCENTAGE": share(F.col("_SOLD_RUN"), "_SOLD"),
        "CPU": F.when(F.col("QUANTITY_ON_HAND") == 0, F.when(cost != 0, 0.0)).otherwise(
            pdiv(cost, F.col("QUANTITY_ON_HAND"))),
        "SKU": F.when(cost == 0, 0).otherwise(1),
        "INVENTORY_PERCENT": F.coalesce(finite(share(cost, "_COST")), F.lit(0.0)),
        "INVENTORY_CUM_PERCENT": F.coalesce(finite(share(F.col("_COST_RUN"), "_COST")), F.lit(0.0)),
    }).withColumn("QUINTILE", quintile.otherwise("nan"))
    if dim_sku is not None:
        rows = rows.join(sku_ids(dim_sku, keys), keys, "left")
    ids = ["SKU_SEQ_ID"] if dim_sku is not None else []
    return rows.select(
        *keys, *ids, date_key(F.col("_LATEST")).alias("DATE_KEY"), "QUANTITY_SOLD", "NET_SALES_$",
        F.col("COGS_$").alias("COGS"), "GROSS_MARGIN_$", F.col("QUANTITY_ON_HAND").alias("QUANTITY"),
        F.col("TOTAL_COST_EXTENDED").alias("GROSS_INVENTORY_COST"), "PERCENT", "COMMULATIVE_PERCENTAGE",
        "CPU", "SKU", "INVENTORY_PERCENT", "INVENTORY_CUM_PERCENT", "QUINTILE",
        F.lit(insert_date).cast("date").alias("INSERT_DATE"))
