"""Typing, renaming and shaping of input and output tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.semantics import DEAL, present

log = logging.getLogger(__name__)

# The two header vocabularies and the declared type names.
FRAMES = {"COUNTRY": "MAJOR_FRAME", "DIVISION": "MINOR_FRAME", "INVENTORY_TYPE": "SUB_MINOR_FRAME"}
MONTH_HEADERS = {
    "sale": {"BOM": "BEG_MO", "EOM": "EOM_DATE"},
    "inv": {"BOM": "BOM_INV_DATE", "EOM": "EOM_INV_DATE"},
}
TEXT_COLUMNS = ["SKU", "TRIM_SKU", "LOT", "DESCRIPTION_1"]
TYPE_NAMES = {"int": "bigint", "str": "string", "float": "double", "datetime": "date"}


def cast_to_schema(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Cast each column to its declared type; undeclared columns and unknown types pass through."""
    out = []
    for name in df.columns:
        kind = spec.get(name)
        if kind in TYPE_NAMES:
            out.append(F.col(name).cast(TYPE_NAMES[kind]).alias(name))
            continue
        log.warning("column %s: %s", name, "not declared" if kind is None else f"unknown type {kind}")
        out.append(F.col(name))
    return df.select(*out)


BAD = "_BAD_VALUES"


def checked_cast(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    """Like ``cast_to_schema``, but a value that doesn't fit its declared type ends no run.

    It becomes null and is noted in ``_BAD_VALUES``, an array of (COLUMN, VALUE) that is empty for good rows.
    ``good_rows`` and ``rejected_values`` part the result. Only declared text, which may fail, is tried; all in one projection.
    """
    out, bad = [], []
    for f in df.schema.fields:
        kind = TYPE_NAMES.get(spec.get(f.name, ""))
        value = F.col(f"`{f.name}`")
        if kind is None:
            out.append(value)
            continue
        tried = value.try_cast(kind)
        out.append(tried.alias(f.name))
        if kind != "string":
            note = F.struct(F.lit(f.name).alias("COLUMN"), value.cast("string").alias("VALUE"))
            bad.append(F.when(value.isNotNull() & tried.isNull(), note))
    none = F.array().cast("array<struct<COLUMN:string,VALUE:string>>")
    return df.select(*out, (F.array_compact(F.array(*bad)) if bad else none).alias(BAD))


def good_rows(checked: DataFrame) -> DataFrame:
    """Rows of ``checked_cast`` whose declared values all fit, without the note."""
    return checked.where(F.size(BAD) == 0).drop(BAD)


def rejected_values(checked: DataFrame) -> DataFrame:
    """How often which value of which column didn't fit, per deal where there is one: (DEAL_ID, COLUMN, VALUE, ROWS).

    A row with several bad values counts for each. Combined map-side, so a value that a whole file repeats is one row per task.
    """
    deal = F.col(DEAL) if DEAL in checked.columns else F.lit(None).cast("bigint")
    each = checked.select(deal.alias(DEAL), F.explode(BAD).alias("_BAD"))
    return each.groupBy(DEAL, F.col("_BAD.COLUMN").alias("COLUMN"), F.col("_BAD.VALUE").alias("VALUE")).agg(F.count(F.lit(1)).alias("ROWS"))


def schema_report(df: DataFrame, spec: Mapping[str, str]) -> dict[str, list[str]]:
    """Columns that ``cast_to_schema`` leaves as they are, by reason."""
    return {
        "undeclared": [c for c in df.columns if c not in spec],
        "unknown_type": [c for c in df.columns if c in spec and spec[c] not in TYPE_NAMES],
    }


def canonicalise(df: DataFrame, kind: str) -> DataFrame:
    """Upper-case headers, frame names to COUNTRY/DIVISION/INVENTORY_TYPE, month headers by side."""
    df = df.toDF(*[c.upper() for c in df.columns])
    to_canonical = {frame: name for name, frame in FRAMES.items()}
    df = df.withColumnsRenamed({**to_canonical, **MONTH_HEADERS[kind]})
    return df.withColumns({c: F.col(c).cast("string") for c in present(df, TEXT_COLUMNS)})


def to_frames(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(FRAMES)


def upper_strings(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.upper(c) for c in text}) if text else df


def align_columns(sale: DataFrame, inv: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Give both sides the wanted columns that at least one has, in the wanted order."""
    types = {f.name: f.dataType for df in (sale, inv) for f in df.schema.fields}
    shared = [c for c in wanted if c in types]

    def lay_out(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select(*[F.col(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in shared])

    return lay_out(sale), lay_out(inv)


def fill_margin(df: DataFrame) -> DataFrame:
    """Derive whichever of gross margin and cost of goods the input lacks; both lacking means 0."""
    gm, cogs, net = "GROSS_MARGIN_$", "COGS_$", "NET_SALES_$"
    have_gm, have_cogs = gm in df.columns, cogs in df.columns
    if not have_gm and not have_cogs:
        return df.withColumns({gm: F.lit(0.0), cogs: F.lit(0.0)})
    if not have_gm:
        return df.withColumn(gm, F.col(net) - F.col(cogs))
    if not have_cogs:
        return df.withColumn(cogs, F.col(net) - F.col(gm))
    return df


def conform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the output table's columns that exist, dates as text, headers in frame names."""
    types = {f.name: f.dataType for f in df.schema.fields}
    kept = [F.col(c).cast("string").alias(c) if "DATE" in c and not isinstance(types[c], T.StringType)
            else F.col(c) for c in present(df, columns)]
    return to_frames(df.select(*kept))
