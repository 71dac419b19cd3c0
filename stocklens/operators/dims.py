"""Category and SKU dimensions with stable surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.census import ABSENT, ELSEWHERE, unmarked
from stocklens.functions.grain import by_known_keys, first_rows
from stocklens.functions.schema import align_columns
from stocklens.functions.semantics import DEAL, NEED_CAT, NOT_AVAILABLE, present, series_keys
from stocklens.sources.staging import stage

# The dimension columns.
CATEGORIES = [f"CATEGORY_{i}" for i in range(1, 5)]
CATEGORY_CODES = [f"CATEGORY_CODE_{i}" for i in range(1, 5)]
DIM_KEYS = [DEAL, "TRIM_SKU", "LOCATION", "COUNTRY", "DIVISION", "INVENTORY_TYPE"]
DIM_CATEGORY_COLUMNS = [DEAL, *CATEGORIES, *CATEGORY_CODES, "SKU", *DIM_KEYS[1:]]
SKU_KEYS = [DEAL, "SKU", "LOCATION", "COUNTRY", "DIVISION", "INVENTORY_TYPE", "TRIM_SKU"]
SKU_ATTRIBUTES = ["DESCRIPTION_1", "LOT", *CATEGORIES, *CATEGORY_CODES]


def surrogate_key(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """64-bit id from the natural key, so re-runs and late joins give the same id.

    Missing parts are told apart from empty ones by a NULL flag per column. A column that the row's deal lacks
    gives neither, since a NULL leaves the hash as it is: the id doesn't hang on other deals' columns.
    """
    def part(c: str):
        flag, value = F.col(c).isNull(), F.col(c)
        if not isinstance(df.schema[c].dataType, T.StringType):
            return flag, value
        return F.when(value == ABSENT, None).otherwise(flag), unmarked(c)

    parts = [p for c in columns for p in part(c)]
    return df.withColumn(name, F.xxhash64(*parts))


def distinct_ids(df: DataFrame, columns: Sequence[str], name: str, taken: DataFrame | None = None, bits: int = 63) -> DataFrame:
    """``df`` with ids that no two natural keys of a deal share, and none that ``taken`` (DEAL_ID, id) holds.

    Of keys that clash, the first in order keeps the id, or none if it is taken; the others hash anew with a salt, until none
    clash. So ids are the same on each run over the same keys, and stay as they are while nothing clashes. A
    round numbers the rows of each id, which are one but for clashes; it runs a job, so give it a stored table. ``bits``
    narrows the ids, for tests.
    """
    columns = [c for c in columns if c in df.columns]
    ids = None if taken is None else taken.select(F.col(DEAL).alias("_OF"), F.col(name).alias("_TAKEN")).distinct()
    salt = 0
    if bits < 63:
        df = df.withColumn(name, F.pmod(F.col(name), F.lit(1 << bits)))
    while True:
        if ids is not None:
            df = df.join(ids, (F.col(DEAL) == F.col("_OF")) & (F.col(name) == F.col("_TAKEN")), "left").drop("_OF")
        else:
            df = df.withColumn("_TAKEN", F.lit(None).cast("long"))
        order = Window.partitionBy(DEAL, name).orderBy(*present(df, ["_SALT"]), *columns)
        df = df.withColumn("_CLASH", F.col("_TAKEN").isNotNull() | (F.row_number().over(order) > 1))
        if df.where("_CLASH").isEmpty():
            return df.drop("_CLASH", "_TAKEN", "_SALT")
        salt += 1
        anew = surrogate_key(df, columns, "_ANEW").withColumn("_ANEW", F.xxhash64(F.col("_ANEW"), F.lit(salt)))
        if bits < 63:
            anew = anew.withColumn("_ANEW", F.pmod(F.col("_ANEW"), F.lit(1 << bits)))
        before = F.col("_SALT") if "_SALT" in df.columns else F.lit(0)
        anew = anew.withColumns({name: F.when(F.col("_CLASH"), F.col("_ANEW")).otherwise(F.col(name)),
                                 "_SALT": F.when(F.col("_CLASH"), F.lit(salt)).otherwise(before)})
        df = stage(anew.drop("_CLASH", "_TAKEN", "_ANEW"), f"ids-{name.lower()}")


def id_clashes(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Ids shared by several natural keys of one deal; empty unless two keys hash alike."""
    return (df.select(name, *columns).distinct().groupBy(DEAL, name)
            .agg(F.count("*").alias("KEYS")).where(F.col("KEYS") > 1))


def dim_category(sale: DataFrame, inv: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per natural key of either side, inventory first; keys in ``existing`` are left out."""
    keys = present(inv, DIM_KEYS)
    sale_part, inv_part = align_columns(sale, inv, DIM_CATEGORY_COLUMNS)
    attributes = [c for c in inv_part.columns if c not in keys]
    both = (inv_part.withColumn("_SOURCE", F.lit(0))
            .unionByName(sale_part.withColumn("_SOURCE", F.lit(1))))
    both = both.withColumns({c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit(ELSEWHERE)), F.lit(NEED_CAT)) for c in attributes})
    order = series_keys(inv)  # as series are stored
    known, others = by_known_keys(both, [c for c in keys if c != DEAL], NEED_CAT, ELSEWHERE)
    dim = reduce(DataFrame.unionByName, [first_rows(rows, order, attributes, F.col("_SOURCE")) for rows in (known, others)])

    defaults = dict.fromkeys(CATEGORIES, NEED_CAT) | dict.fromkeys(CATEGORY_CODES, NOT_AVAILABLE)
    dim = dim.withColumns({c: unmarked(c, x) if c in dim.columns else F.lit(x) for c, x in defaults.items()})
    if existing is not None:
        dim = dim.join(existing.select(*keys).distinct(), keys, "left_anti")
    out = [c for c in DIM_CATEGORY_COLUMNS if c in dim.columns]
    return surrogate_key(dim.select(*out), keys, "CATEGORY_SEQ_ID")


def dim_sku(dim_cat: DataFrame, sale: DataFrame, inv: DataFrame,
            attributes: Sequence[str] = SKU_ATTRIBUTES) -> DataFrame:
    """One row per SKU key with attributes from inventory, filled from sales; TRIM_SKU = trimmed SKU.

    An attribute both sides have keeps its name; when only one side has it, that side's value.
    """
    keys = [c for c in SKU_KEYS if c in dim_cat.columns and (c in sale.columns or c in inv.columns)]
    base = dim_cat.select(*keys, "CATEGORY_SEQ_ID")

    def picked(df: DataFrame, suffix: str) -> tuple[DataFrame, list[str]]:
        own, on = present(df, attributes), present(df, keys)
        rows = first_rows(df.dropna(subset=on), on, own)
        return rows.withColumnsRenamed({c: c + suffix for c in own}), own

    inv_rows, inv_cols = picked(inv, "_INV")
    sale_rows, sale_cols = picked(sale, "_SALE")
    def with_rows(df: DataFrame, rows: DataFrame, own: list[str], on: list[str]) -> DataFrame:
        if not own and "SKU" not in on:
            return df  # one row a key without a column: the join would change nothing
        rows = rows.withColumnsRenamed({c: f"_ON_{c}" for c in on})
        match = [F.col(c) == F.col(f"_ON_{c}") for c in on if c != "SKU"]
        if "SKU" in on:
            match.append((F.col("_ON_SKU") == ELSEWHERE) | (F.col("SKU") == F.col("_ON_SKU")))
        return df.join(rows, match, "left").drop(*[f"_ON_{c}" for c in on])

    joined = with_rows(with_rows(base, inv_rows, inv_cols, present(inv, keys)), sale_rows, sale_cols, present(sale, keys))
    shown = []
    for c in attributes:
        sources = [F.col(c + s) for s, cols in (("_INV", inv_cols), ("_SALE", sale_cols)) if c in cols]
        if sources:
            shown.append(F.coalesce(*sources).alias(c))
    dim = joined.select(*keys, "CATEGORY_SEQ_ID", *shown)
    if "SKU" in dim.columns:
        dim = dim.withColumn("TRIM_SKU", F.when(F.col("SKU") == ABSENT, F.col("TRIM_SKU")).otherwise(F.trim("SKU")))
    return surrogate_key(dim, keys, "SKU_SEQ_ID")
