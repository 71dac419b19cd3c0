"""Which deal has which column, and the rules that hang on it.

Deals arrive with different layouts: one has order dates and no cost of goods, another no locations. In one table
a column that a deal lacks is all null there, which rules must not take for missing values: a series column the
deal lacks is no part of its key, a date it lacks doesn't refine its grain, and a margin is derived from what it has.

A census is a table with a row per deal: DEAL_ID and COLUMNS, the names it has. It is exact when taken from the deals'
files (``readers.read_deals``); without files it is taken by value, where a deal has a column if any of its
rows holds a value in it. ``deal_layout`` puts both sides' censuses in one small table, which joins condensed rows only.

Within a run, text columns that a deal lacks on both sides hold ``ABSENT``: a constant in each key, so that
operators need no rule of their own; ``surrogate_key`` skips it, and ``without_marks`` turns it to null in outputs. So
an output is the same whether deals run together or one by one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.semantics import DEAL, SERIES_COLUMNS, present

COLUMNS, SALE_COLUMNS, INV_COLUMNS = "COLUMNS", "_SALE_COLUMNS", "_INV_COLUMNS"
#: Fixed value: stands for a text column that a deal lacks; no input can hold it by accident.
ABSENT = "\x01ABSENT"
#: Fixed value: stands for a SKU that this side of the deal lacks and the other has; it joins on the other keys.
ELSEWHERE = "\x01ELSEWHERE"
#: Series columns a deal may lack; TRIM_SKU and DEAL_ID are always there.
OPTIONAL_KEYS = [c for c in SERIES_COLUMNS if c != "TRIM_SKU"] + ["SKU"]

GM, COGS, NET = "GROSS_MARGIN_$", "COGS_$", "NET_SALES_$"
NET_LESS_COGS, NET_LESS_GM, GM_ROWS, COGS_ROWS = "_NET_LESS_COGS", "_NET_LESS_GM", "_GM_ROWS", "_COGS_ROWS"
MARGIN_PARTS = [NET_LESS_COGS, NET_LESS_GM, GM_ROWS, COGS_ROWS]


def census_of_headers(spark: SparkSession, headers: Mapping[int, Iterable[str]]) -> DataFrame:
    """Census from the header of each deal's files."""
    rows = [(deal, sorted(columns)) for deal, columns in headers.items()]
    return spark.createDataFrame(rows, f"{DEAL} long, {COLUMNS} array<string>")


def census_by_value(df: DataFrame, held: Mapping[str, Column] | None = None) -> DataFrame:
    """Census of a table: the columns in which a deal has any value; ``held`` says so for columns that are sums by now.

    One hash aggregate of a few flags, combined map-side.
    """
    flags = {c: F.col(c).isNotNull() for c in df.columns if c != DEAL} | dict(held or {})
    names = [F.when(F.max(flag), F.lit(c)) for c, flag in flags.items()]
    return df.groupBy(DEAL).agg(F.array_compact(F.array(*names)).alias(COLUMNS))


def margin_parts(sale: DataFrame) -> DataFrame:
    """Raw sales with both margin columns and the sums from which either is derived after condensing."""
    sale = sale.withColumns({c: F.lit(None).cast("double") for c in (GM, COGS) if c not in sale.columns})
    return sale.withColumns({NET_LESS_COGS: F.col(NET) - F.col(COGS), NET_LESS_GM: F.col(NET) - F.col(GM),
                             GM_ROWS: F.when(F.col(GM).isNotNull(), 1), COGS_ROWS: F.when(F.col(COGS).isNotNull(), 1)})


def deal_layout(sale: DataFrame, inv: DataFrame, sale_census: DataFrame | None = None,
                inv_census: DataFrame | None = None) -> DataFrame:
    """DEAL_ID with the columns of its condensed sales and of its inventory.

    By value, a series column that only one side holds counts for both: a side whose values are all missing has the
    column, and its rows are left out as rows with a missing key are.
    """
    if sale_census is None:
        sale_census = census_by_value(sale, {GM: F.col(GM_ROWS) > 0, COGS: F.col(COGS_ROWS) > 0})
        by_value = inv_census is None
    else:
        by_value = False
    if inv_census is None:
        inv_census = census_by_value(inv)
    sold = sale_census.select(DEAL, F.col(COLUMNS).alias(SALE_COLUMNS))
    layout = sold.join(inv_census.select(DEAL, F.col(COLUMNS).alias(INV_COLUMNS)), DEAL)
    if by_value:
        keys = F.array(*[F.lit(c) for c in SERIES_COLUMNS])
        shared = F.array_intersect(F.array_union(SALE_COLUMNS, INV_COLUMNS), keys)
        layout = layout.withColumns({c: F.array_union(c, shared) for c in (SALE_COLUMNS, INV_COLUMNS)})
    return layout


def check_layout(layout: DataFrame) -> None:
    """Refuse deals whose two sides have different series columns, naming the first of them."""
    keys = F.array(*[F.lit(c) for c in SERIES_COLUMNS])
    sides = [F.array_sort(F.array_intersect(F.col(c), keys)) for c in (SALE_COLUMNS, INV_COLUMNS)]
    bad = layout.where(sides[0] != sides[1]).select(DEAL, *sides).orderBy(DEAL).limit(10).collect()
    if bad:
        raise ValueError("sales keys differ from inventory keys: " + "; ".join(f"deal {d}: {s} and {i}" for d, s, i in bad))


def lacks(side: str, column: str) -> Column:
    """True for rows (joined with the layout) of deals whose ``side`` lacks the column."""
    return ~F.array_contains(side, column)


def fill_margin_by_deal(sale: DataFrame) -> DataFrame:
    """Margins of condensed sales (joined with the layout), derived by what the deal has; both lacking means 0."""
    no_gm, no_cogs = lacks(SALE_COLUMNS, GM), lacks(SALE_COLUMNS, COGS)
    return sale.withColumns({
        GM: F.when(no_gm & no_cogs, 0.0).when(no_gm, F.col(NET_LESS_COGS)).otherwise(F.col(GM)),
        COGS: F.when(no_gm & no_cogs, 0.0).when(no_cogs, F.col(NET_LESS_GM)).otherwise(F.col(COGS))}).drop(*MARGIN_PARTS)


def mark_absent(df: DataFrame, columns: Iterable[str], side: str, other: Iterable[str] = ()) -> DataFrame:
    """Text columns that a row's deal lacks on both sides hold ``ABSENT``; the row is joined with the layout.

    A SKU that only this side lacks is ``ELSEWHERE``; the column is added if none of the side's deals, but the ``other`` table, has it.
    """
    if "SKU" in other and "SKU" not in df.columns:
        df = df.withColumn("SKU", F.lit(None).cast("string"))
    text = [c for c in present(df, columns) if isinstance(df.schema[c].dataType, T.StringType)]

    def marked(c: str) -> Column:
        out = F.when(lacks(SALE_COLUMNS, c) & lacks(INV_COLUMNS, c), ABSENT)
        return (out.when(lacks(side, c), ELSEWHERE) if c == "SKU" else out).otherwise(F.col(c))

    return df.withColumns({c: marked(c) for c in text}) if text else df


def unmarked(column: str, instead: str | None = None) -> Column:
    """The column with another value, or null, for what stands for a lacking one."""
    return F.when(F.col(column).isin(ABSENT, ELSEWHERE), F.lit(instead)).otherwise(F.col(column))


def without_marks(df: DataFrame) -> DataFrame:
    """``df`` with null for all that stands for a lacking column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: unmarked(c) for c in text}) if text else df
