"""Declared layout of every output table, and bringing a table to it.

``SCHEMAS`` holds a StructType per table under canonical headers: what its section computes, then the optional columns it
carries when the input has them. ``conform_table`` gives a table exactly these columns in this order: cast where it
can't lose a value's meaning, null where the run had no such column, dates as text and frame headers, as consumers
read them. A column that isn't declared is refused or, on request, dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocklens.functions.grain import INVENTORY_MEASURES, PICKED_NUMBERS, SALES_MEASURES
from stocklens.functions.schema import conform
from stocklens.functions.semantics import DEAL
from stocklens.operators.cycles import CYCLE_MONTHS
from stocklens.operators.dates import AGES, BUCKET_COLUMNS, RECEIPT_DATES, SALE_DATES, STAGING_DATES
from stocklens.operators.demand import COSTS, HORIZONS, METRICS, RUN_OFF, UNITS
from stocklens.operators.dims import CATEGORIES, CATEGORY_CODES, SKU_ATTRIBUTES
from stocklens.operators.facts import GRAIN_DATES
from stocklens.operators.fifo import FLOW_COLUMNS, LAYERS, ROLL_UPS
from stocklens.operators.movement import SPANS
from stocklens.operators.sellthru import LEAD_COLUMNS, LEADS

LONG, INT, TEXT, DAY, NUMBER = T.LongType(), T.IntegerType(), T.StringType(), T.DateType(), T.DoubleType()
KEY_TEXTS = ["LOCATION", "COUNTRY", "DIVISION", "INVENTORY_TYPE", "TRIM_SKU"]
INSERTED = (DAY, ["INSERT_DATE"])
IDS = (LONG, ["SKU_SEQ_ID"])
AGED = [(DAY, STAGING_DATES), (INT, list(AGES)), (TEXT, BUCKET_COLUMNS)]
#: What a base fact carries from its input where the input has it.
CARRIED = [(TEXT, ["SKU", *SKU_ATTRIBUTES]), (DAY, GRAIN_DATES)]


def table(*groups: tuple[T.DataType, list[str]], keys: bool = True) -> T.StructType:
    start = [(LONG, [DEAL]), (TEXT, KEY_TEXTS)] if keys else [(LONG, [DEAL])]
    return T.StructType([T.StructField(name, kind) for kind, names in [*start, *groups] for name in names])


def _demand() -> T.StructType:
    start = "SALES_INFO_START_MONTH"
    return table((DAY, ["BOM_INV_DATE", start]), (TEXT, ["DATE_KEY", "SKU"]), (NUMBER, [m for m in METRICS if m != start]),
                 (NUMBER, [*UNITS, *COSTS, *RUN_OFF, "GROSS_INVENTORY_QUANTITY", "GROSS_INVENTORY_COST"]), IDS, (DAY, STAGING_DATES),
                 (TEXT, BUCKET_COLUMNS), INSERTED, (TEXT, ["CATEGORY_1"]), (NUMBER, PICKED_NUMBERS), (DAY, ["INVENTORY_DATE"]))


def _cycle(measure: str, prefix: str) -> T.StructType:
    return table(IDS, (DAY, ["BEG_MO"]), (TEXT, ["DATE_KEY"]), (NUMBER, [measure]), *AGED,
                 (NUMBER, [f"{prefix}_{i:02d}" for i in range(1, CYCLE_MONTHS + 1)]), INSERTED)


def _sell_through() -> T.StructType:
    months = [f"{c}_{k}" for c in LEAD_COLUMNS.values() for k in LEADS]
    totals = [f"THREE_MONTH_TOTAL_{x}" for x in ("COGS", "UNITS", "SALES")]
    adjusted = [f"UNITS_SOLD_X_{k}_ADJ" for k in LEADS] + [f"{x}_ST_{k}" for x in ("UNITS", "COST") for k in LEADS]
    return table((DAY, ["BOM_INV_DATE"]), (TEXT, ["DATE_KEY", "SKU"]), (NUMBER, ["GROSS_INVENTORY_QUANTITY", "GROSS_INVENTORY_COST"]),
                 (NUMBER, [*months, *totals, "COGS_UNIT", "ADJ_QTY_DEMAND", "CPU", "COGS_CHECK_PERCENTAGE_DIFF", *adjusted]),
                 (DAY, [*SALE_DATES, RECEIPT_DATES[0], "INTRODUCTION_DATE"]), IDS, (TEXT, BUCKET_COLUMNS), INSERTED)


def _movement() -> T.StructType:
    counts = [f"{span}_{way}" for span in SPANS for way in ("UP", "DOWN", "NO_INV", "STATIC")]
    return table(IDS, (DAY, ["BOM_INV_DATE"]), (TEXT, ["DATE_KEY"]), (NUMBER, ["TOTAL_COST", "TOTAL_QUANTITY", "CPU"]), (INT, counts),
                 (TEXT, [f"{span}_MVMT_CAT" for span in SPANS]), (INT, ["MONTHS_LAST_MOVE", "MOST_LAST_MOVE"]), (DAY, ["LAST_MOVE_DATE"]),
                 (INT, ["LAST_MOVE_DAYS"]), (TEXT, ["LASTMOVE_BUCKET_SEQ_ID"]), INSERTED, keys=False)


def _fifo() -> T.StructType:
    layers = [f"{k}_{b}" for k in ("UNITS", "COST") for b in LAYERS]
    sales = [f"A_{b}{k}" for k in ("_ASQ", "_S$A", "GM$A") for b in LAYERS]
    rolled = [f"{k}_{b}" for k in ("UNITS", "COST") for b in (*ROLL_UPS, "OVER_720")]
    flows = [c for c in FLOW_COLUMNS if c != "BOM_INV_DATE"]
    return table(IDS, (INT, ["STEP"]), (DAY, ["BOM_INV_DATE"]), (TEXT, ["DATE_KEY"]), (NUMBER, [*flows, "TOTAL_RECEIPTS", *layers, *sales, *rolled]),
                 INSERTED)


SCHEMAS: dict[str, T.StructType] = {
    "TEMP_INVBUCKET": table((DAY, ["BOM_INV_DATE"]), *AGED, INSERTED),
    "TEMP_SALESBUCKET": table((DAY, ["BEG_MO"]), *AGED, INSERTED),
    "DIM_CATEGORY": table((TEXT, ["SKU", *CATEGORIES, *CATEGORY_CODES]), (LONG, ["CATEGORY_SEQ_ID"]), INSERTED),
    "DIM_SKU": table((TEXT, ["SKU"]), (LONG, ["CATEGORY_SEQ_ID", "SKU_SEQ_ID"]), (TEXT, SKU_ATTRIBUTES), INSERTED),
    "FACT_INVENTORY": table((DAY, ["BOM_INV_DATE"]), (TEXT, ["DATE_KEY"]), (NUMBER, INVENTORY_MEASURES),
                            (NUMBER, ["GROSS_INVENTORY_QUANTITY", "GROSS_INVENTORY_COST", "UNIT_COST"]), IDS, *AGED, INSERTED, *CARRIED,
                            (DAY, ["EOM_INV_DATE", "INVENTORY_DATE"]), (NUMBER, PICKED_NUMBERS)),
    "FACT_SALES": table((DAY, ["BEG_MO"]), (TEXT, ["DATE_KEY"]), (NUMBER, SALES_MEASURES), IDS, *AGED, INSERTED, *CARRIED,
                        (DAY, ["EOM_DATE"]), (NUMBER, PICKED_NUMBERS)),
    **{f"FACT_{word}_MONTH_INVENTORY": _demand() for word in HORIZONS.values()},
    **{f"FACT_{word}_MONTH_QUINTILE": table(
        IDS, (TEXT, ["DATE_KEY"]), (NUMBER, ["QUANTITY_SOLD", "NET_SALES_$", "COGS", "GROSS_MARGIN_$", "QUANTITY", "GROSS_INVENTORY_COST",
                                             "PERCENT", "COMMULATIVE_PERCENTAGE", "CPU"]), (INT, ["SKU"]),
        (NUMBER, ["INVENTORY_PERCENT", "INVENTORY_CUM_PERCENT"]), (TEXT, ["QUINTILE"]), INSERTED) for word in HORIZONS.values()},
    "FACT_INV_MVMT": _movement(),
    "FIFO": _fifo(),
    "FACT_GROSS_MARGIN_CYCLE": _cycle("GROSS_MARGIN_$", "GROSS_MARGIN_CYCLE"),
    "FACT_SALES_CYCLE": _cycle("NET_SALES_$", "SALES_CYCLE"),
    "FACT_SELL_THRU": _sell_through(),
}
# Fixed value: the annualized tables name one bucket column differently.
ANNUALIZED_NAMES = {"FIRST_RECEIPT_DATE_BUCKET": "FIRST_RECEIPT_BUCKET_SEQ_ID"}
SCHEMAS |= {f"FACT_{word}_MONTH_ANNUALIZED": T.StructType([T.StructField(ANNUALIZED_NAMES.get(f.name, f.name), f.dataType) for f in _demand()])
            for word in HORIZONS.values()}


def _keeps_meaning(have: T.DataType, want: T.DataType) -> bool:
    """Casts that no value of the type can fail or be changed by beyond rounding to a double."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    sizes = {kind: i for i, kind in enumerate(whole)}
    if have == want or isinstance(have, T.NullType) or isinstance(want, T.StringType):
        return True
    if isinstance(want, T.DoubleType):
        return isinstance(have, T.NumericType)
    if isinstance(want, T.DateType):
        return isinstance(have, (T.TimestampType, T.TimestampNTZType))
    return type(have) in sizes and type(want) in sizes and sizes[type(have)] <= sizes[type(want)]


def conform_table(df: DataFrame, name: str, drop_strangers: bool = False) -> DataFrame:
    """``df`` in the declared layout of output ``name``, in output form."""
    schema = SCHEMAS[name]
    have = {f.name: f.dataType for f in df.schema.fields}
    strangers = [c for c in have if c not in schema.names]
    if strangers and not drop_strangers:
        raise ValueError(f"{name}: not declared: {strangers}")
    wrong = [f"{f.name} is {have[f.name].simpleString()}, not {f.dataType.simpleString()}" for f in schema.fields
             if f.name in have and not _keeps_meaning(have[f.name], f.dataType)]
    if wrong:
        raise TypeError(f"{name}: " + "; ".join(wrong))
    typed = df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    return conform(typed, schema.names)
