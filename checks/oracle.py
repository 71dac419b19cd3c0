"""DuckDB SQL for every query in ``checks.queries``, written from the definitions.

The Spark side mostly uses window frames; the SQL here uses joins on month distance, closed forms
or a recursive query wherever it can, so that a shared mistake is unlikely.
"""

from __future__ import annotations

from checks.fixtures import RANGES
from stocklens.plans.star import OUTPUT_TABLES

ORACLE: dict[str, str] = {}

K = "deal_id, location, country, division, inventory_type, trim_sku"
KEY = K.split(", ")
NODATE = "DATE '1900-01-01'"
BANDS = (("0_30", 1, 0), ("31_60", 1, 1), ("61_90", 1, 2), ("91_180", 3, 3), ("181_270", 3, 6),
         ("271_360", 3, 9), ("361_720", 12, 12))
WORDS = {2: "two", 3: "three", 6: "six", 12: "twelve", 24: "twentyfour"}
LAYERS = [f"{30 * i}_{30 * i + 30}" for i in range(25)]
ROLL = {"90_180": (3, 6), "180_270": (6, 9), "270_360": (9, 12), "361_540": (12, 18), "541_720": (18, 24)}


# --- expression text ---------------------------------------------------------------------------

def grid(x):
    return f"round(CAST({x} AS DOUBLE) * 10000 - 0.0363) / 10000 + 0.0"


def num(**cols):
    return nums(cols)


def nums(cols):
    return ", ".join(f'{grid(x)} AS "{name}"' for name, x in cols.items())


def days(**cols):
    return ", ".join(f'CAST(CAST({x} AS DATE) AS VARCHAR) AS "{name}"' for name, x in cols.items())


def txt(**cols):
    return ", ".join(f'CAST({x} AS VARCHAR) AS "{name}"' for name, x in cols.items())


def keys_out(alias="", division=None):
    p = f"{alias}." if alias else ""
    return num(DEAL_ID=p + "deal_id") + ", " + txt(
        LOCATION=p + "location", COUNTRY=p + "country", DIVISION=division or p + "division",
        INVENTORY_TYPE=p + "inventory_type", TRIM_SKU=p + "trim_sku")


def ix(d):
    return f"(year({d}) * 12 + month({d}))"


def known(x):
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


def pdiv(a, b):
    return (f"(CASE WHEN ({b}) = 0 THEN CASE WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) END ELSE {known(f'(({a}) / ({b}))')} END)")


def fin(x):
    return f"(CASE WHEN isnan({x}) OR isinf({x}) THEN NULL ELSE {x} END)"


def zero(x):
    return f"coalesce({fin(x)}, 0)"


def key_date(d):
    return f"strftime({d}, '%Y%m%d')"


def bucket(x):
    return f"(SELECT arg_max(val, pos) FROM fx_buckets WHERE ({x}) BETWEEN lb AND ub)"


def same(a, b, nulls=False):
    eq = " IS NOT DISTINCT FROM " if nulls else " = "
    return " AND ".join(f"{a}.{c}{eq}{b}.{c}" for c in KEY)


def pick(alias, cols=KEY):
    return ", ".join(f"{alias}.{c}" for c in cols)


# --- inputs ------------------------------------------------------------------------------------

BUCKETS = "fx_buckets AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {r.lower}, {r.upper}, '{r.value}')" for i, r in enumerate(RANGES)) + ") AS t(pos, lb, ub, val))"


def inputs(by_part=False):
    """CTEs: lines (il, sl), months (i, s), months of known keys (ik, sk)."""
    sku = "CAST(l_partkey AS VARCHAR)" if by_part else "p_brand"
    return [f"""fx_line AS (
SELECT CAST(CASE WHEN r_regionkey <= 2 THEN 1001 ELSE 1002 END AS BIGINT) AS deal_id,
  r_name AS country, n_name AS location, CASE WHEN p_brand = 'Brand#25' THEN NULL ELSE 'DIV1' END AS division,
  'FG' AS inventory_type, {sku} AS trim_sku, p_brand AS brand, p_type AS category_1,
  CAST(date_trunc('month', l_shipdate) AS DATE) AS ship_mo, CAST(date_trunc('month', CASE WHEN l_linenumber % 2 = 0 THEN o_orderdate ELSE l_shipdate END) AS DATE) AS order_mo,
  CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN -1 ELSE 1 END AS DECIMAL(2,0)) AS sgn,
  CAST(CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 0 ELSE 1 END AS DECIMAL(2,0)) AS held,
  CAST(l_quantity AS DECIMAL(18,4)) AS qty, CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS net,
  CAST(l_quantity * p_retailprice * 0.6 AS DECIMAL(18,4)) AS cogs,
  CAST(l_quantity * p_retailprice * 0.7 AS DECIMAL(18,4)) AS cost
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey)""",
            """sl AS (SELECT * FROM fx_line UNION ALL
SELECT * REPLACE (trim_sku || '-S' AS trim_sku) FROM fx_line WHERE brand = 'Brand#1' AND country = 'AFRICA')""",
            """il AS (SELECT * FROM fx_line UNION ALL
SELECT * REPLACE (trim_sku || '-I' AS trim_sku) FROM fx_line WHERE brand = 'Brand#2' AND country = 'ASIA')""",
            f"""s AS (SELECT {K}, ship_mo AS mo, CAST(SUM(sgn * qty) AS DOUBLE) AS q, CAST(SUM(sgn * net) AS DOUBLE) AS net,
CAST(SUM(sgn * (net - cogs)) AS DOUBLE) AS gm, CAST(SUM(sgn * cogs) AS DOUBLE) AS cogs FROM sl GROUP BY {K}, ship_mo)""",
            f"""i AS (SELECT {K}, order_mo AS mo, CAST(SUM(held * qty) AS DOUBLE) AS qoh,
CAST(SUM(held * cost) AS DOUBLE) AS cost FROM il GROUP BY {K}, order_mo)""",
            "sk AS (SELECT * FROM s WHERE division IS NOT NULL)", "ik AS (SELECT * FROM i WHERE division IS NOT NULL)",
            BUCKETS]


# first and last dates per series, either side, 1900-01-01 when there is none
DATES = [f"""sd AS (SELECT {K}, min(mo) FILTER (q <> 0) AS fs, max(mo) FILTER (q <> 0) AS ls FROM sk GROUP BY {K})""",
         f"""rd AS (SELECT {K}, min(mo) FILTER (cost <> 0) AS fr, max(mo) FILTER (cost <> 0) AS lr FROM ik GROUP BY {K})""",
         f"""kd0 AS (SELECT {K}, coalesce(fs, {NODATE}) AS fs, coalesce(ls, {NODATE}) AS ls,
coalesce(fr, {NODATE}) AS fr, coalesce(lr, {NODATE}) AS lr FROM sd FULL JOIN rd USING ({K}))""",
         f"""kd AS (SELECT *, CASE WHEN fr = {NODATE} THEN fs WHEN fs = {NODATE} THEN fr ELSE least(fs, fr) END AS intro
FROM kd0)"""]

AGE = {"LAST_SALES_DAYS": ("ls", "LAST_SALE_DATE_BUCKET"), "FIRST_SALES_DAYS": ("fs", "FIRST_SALE_DATE_BUCKET"),
       "INTRODUCTION_DAYS": ("intro", "INTRODUCTION_BUCKET"), "LAST_RECEIPT_DAYS": ("lr", "LAST_RECEIPT_DATE_BUCKET"),
       "FIRST_RECEIPT_DAYS": ("fr", "FIRST_RECEIPT_DATE_BUCKET")}
FOUR_DATES = days(FIRST_SALE_DATE="fs", LAST_SALES_DATE="ls", FIRST_RECEIPT_DATE="fr", LAST_RECEIPT_DATE="lr",
                  INTRODUCTION_DATE="intro")


def ages(anchor="mo"):
    return nums({n: f"date_diff('day', {d}, {anchor})" for n, (d, _) in AGE.items()})


def age_buckets(anchor="mo", default=None):
    out = {}
    for d, name in AGE.values():
        x = bucket(f"date_diff('day', {d}, {anchor})")
        out[name] = f"coalesce({x}, '{default}')" if default is not None else x
    return txt(**out)


def sql(ctes, select):
    return "WITH " + ("RECURSIVE " if any(c.startswith("rec ") for c in ctes) else "") + \
        ",\n".join(ctes) + "\n" + select


def add(name, ctes, select):
    ORACLE[name] = sql(ctes, select)


FX = inputs()
FXP = inputs(True)
SALES_OUT = {"QUANTITY_SOLD": "q", "NET_SALES_$": "net", "GROSS_MARGIN_$": "gm", "COGS_$": "cogs"}
INV_OUT = {"QUANTITY_ON_HAND": "qoh", "TOTAL_COST_EXTENDED": "cost"}

# --- typing and layout ---------------------------------------------------------------------------

ORACLE["cast_to_schema"] = f"""SELECT {num(L_ORDERKEY="l_orderkey", L_QUANTITY="l_quantity")},
{txt(L_LINENUMBER="l_linenumber", L_RETURNFLAG="l_returnflag", L_SUPPKEY="l_suppkey")},
{days(L_SHIPDATE="l_shipdate")} FROM lineitem"""
RAW = """raw AS (SELECT l_suppkey % 3 AS deal_id, l_orderkey AS k, l_linenumber AS line, l_quantity AS q, l_shipdate AS shipped,
l_linenumber = 7 AS odd, l_linenumber = 7 AND l_linestatus = 'F' AS late, l_returnflag || ' pcs' AS text FROM lineitem)"""
ORACLE["checked_cast_good_rows"] = f"""WITH {RAW} SELECT {num(DEAL_ID="deal_id", KEY="k", QUANTITY="q")},
{txt(LINE="line")}, {days(SHIPPED="shipped")} FROM raw WHERE NOT odd"""
ORACLE["checked_cast_rejected_values"] = f"""WITH {RAW}, bad AS (
SELECT deal_id, 'QUANTITY' AS c, text AS v FROM raw WHERE odd UNION ALL SELECT deal_id, 'SHIPPED', 'soon' FROM raw WHERE late)
SELECT {num(DEAL_ID="deal_id", ROWS="count(*)")}, {txt(COLUMN="c", VALUE="v")} FROM bad GROUP BY deal_id, c, v"""
add("canonicalise_sales", FX, f"SELECT {keys_out()}, {days(BEG_MO='mo')}, {nums(SALES_OUT)} FROM s")
add("canonicalise_inventory", FX, f"SELECT {keys_out()}, {days(BOM_INV_DATE='mo')}, {nums(INV_OUT)} FROM i")
add("to_frames", FX, f"""SELECT {num(DEAL_ID="deal_id")}, {txt(LOCATION="location", MAJOR_FRAME="country",
    MINOR_FRAME="division", SUB_MINOR_FRAME="inventory_type", TRIM_SKU="trim_sku")},
{days(BOM_INV_DATE="mo")}, {nums(INV_OUT)} FROM i""")
ORACLE["upper_strings"] = f"""SELECT {num(p_partkey="p_partkey")},
{txt(p_name="upper(p_name)", p_type="upper(p_type)")} FROM part"""
add("align_columns", FX, f"""SELECT {num(DEAL_ID="deal_id", ROWS="count(*)")},
{txt(TRIM_SKU="trim_sku", SKU="sku", CATEGORY_1="cat")} FROM (
SELECT deal_id, trim_sku, trim_sku || ' ' AS sku, NULL AS cat FROM sl
UNION ALL SELECT deal_id, trim_sku, NULL, category_1 FROM il) GROUP BY deal_id, trim_sku, sku, cat""")
add("fill_gross_margin", FX, f"""SELECT {keys_out()}, {days(BEG_MO='mo')},
{nums({**SALES_OUT, "GROSS_MARGIN_$": "net - cogs"})} FROM s""")
add("fill_cogs", FX, f"SELECT {keys_out()}, {days(BEG_MO='mo')}, {nums({**SALES_OUT, 'COGS_$': 'net - gm'})} FROM s")
add("fill_margin_both", FX, f"""SELECT {keys_out()}, {days(BEG_MO='mo')},
{nums({**SALES_OUT, "GROSS_MARGIN_$": "0", "COGS_$": "0"})} FROM s""")
ORACLE["date_key"] = f"""SELECT {txt(DATE_KEY="k")}, {num(ORDERS="count(*)")}
FROM (SELECT {key_date("o_orderdate")} AS k FROM orders) GROUP BY k"""

# --- dates and buckets ---------------------------------------------------------------------------

FXD = FX + DATES
RECEIPTS = days(FIRST_RECEIPT_DATE="fr", LAST_RECEIPT_DATE="lr")
SOLD = days(FIRST_SALE_DATE="fs", LAST_SALES_DATE="ls")
ON_INV, ON_SALE = f"FROM ik JOIN kd USING ({K})", f"FROM sk JOIN kd USING ({K})"
add("activity_dates_inventory", FXD, f"SELECT {keys_out()}, {days(BOM_INV_DATE='mo')}, {RECEIPTS} {ON_INV}")
add("activity_dates_sales", FXD, f"SELECT {keys_out()}, {days(BEG_MO='mo')}, {SOLD} {ON_SALE}")
add("exchange_dates_sales", FXD, f"SELECT {keys_out()}, {days(BEG_MO='mo')}, {SOLD}, {RECEIPTS} {ON_SALE}")
add("exchange_dates_inventory", FXD, f"SELECT {keys_out()}, {days(BOM_INV_DATE='mo')}, {SOLD}, {RECEIPTS} {ON_INV}")
add("introduction_date", FXD, f"""SELECT DISTINCT {keys_out()},
{days(FIRST_SALE_DATE="fs", FIRST_RECEIPT_DATE="fr", INTRODUCTION_DATE="intro")} {ON_INV}""")
add("age_days", FXD, f"SELECT {keys_out()}, {days(BOM_INV_DATE='mo')}, {ages()} {ON_INV}")
ORACLE["bucketize"] = f"""WITH {BUCKETS}, o AS (SELECT o_orderkey,
date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-07-01') AS d FROM orders)
SELECT {num(o_orderkey="o_orderkey", days="d")}, {txt(age_bucket=bucket("d"))} FROM o"""
ORACLE["bucketize_long_list"] = f"""WITH r AS (SELECT i, i * 37 % 2900 - 100 AS lb, i * 37 % 2900 - 100 + i * 13 % 61 AS ub
FROM range(2000) AS t(i)), o AS (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-07-01') AS d FROM orders),
v AS (SELECT d, (SELECT 'range ' || max(i) FROM r WHERE d BETWEEN lb AND ub) AS v FROM (SELECT DISTINCT d FROM o))
SELECT {num(o_orderkey="o_orderkey", days="d")}, {txt(age_bucket="v")} FROM o JOIN v USING (d)"""
STAGED = f"{FOUR_DATES}, {ages()}, {age_buckets()}"
add("temp_salesbucket", FXD, f"SELECT {keys_out()}, {days(BEG_MO='mo')}, {STAGED} {ON_SALE}")
add("temp_invbucket", FXD, f"SELECT {keys_out()}, {days(BOM_INV_DATE='mo')}, {STAGED} {ON_INV}")
add("conform_temp_invbucket", FXD, f"""SELECT {num(DEAL_ID="deal_id")}, {txt(LOCATION="location", MAJOR_FRAME="country",
    MINOR_FRAME="division", SUB_MINOR_FRAME="inventory_type", TRIM_SKU="trim_sku")},
{days(BOM_INV_DATE="mo", INTRODUCTION_DATE="intro")},
{txt(INTRODUCTION_BUCKET=bucket("date_diff('day', intro, mo)"))} {ON_INV}""")

# --- dimensions and base facts -------------------------------------------------------------------

DIM = [f"""both_sides AS (SELECT 0 AS src, deal_id, location, country, coalesce(division, 'NEED CAT') AS division,
inventory_type, trim_sku, category_1 FROM il UNION ALL SELECT 1, deal_id, location, country,
coalesce(division, 'NEED CAT'), inventory_type, trim_sku, category_1 FROM sl)""",
       f"""dim AS (SELECT * FROM both_sides QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY src, category_1) = 1)"""]


def dim_row(category):
    fixed = {f"CATEGORY_{n}": "'NEED CAT'" for n in (2, 3, 4)} | {f"CATEGORY_CODE_{n}": "'NA'" for n in (1, 2, 3, 4)}
    return f"{keys_out()}, {txt(SKU='''trim_sku || ' ' ''', CATEGORY_1=category, **fixed)}"


add("dim_category", FX + DIM, f"SELECT {dim_row('category_1')} FROM dim")
add("dim_category_new_rows", FX + DIM, f"""SELECT {dim_row('category_1')} FROM dim WHERE ({K}) NOT IN
(SELECT ({K}) FROM both_sides WHERE src = 0)""")
add("dim_category_second_run", FX + DIM, f"""SELECT * REPLACE (CASE WHEN right("TRIM_SKU", 1) IN ('0', '2', '4', '6', '8')
THEN 'first run' ELSE "CATEGORY_2" END AS "CATEGORY_2") FROM (SELECT {dim_row('category_1')} FROM dim)""")
add("dim_sku", FX + DIM + [
    f"ia AS (SELECT {K}, min(category_1) AS c FROM il WHERE division IS NOT NULL GROUP BY {K})",
    f"sa AS (SELECT {K}, min(category_1) AS c FROM sl WHERE division IS NOT NULL GROUP BY {K})"],
    f"""SELECT {keys_out("dim")}, {txt(SKU="dim.trim_sku || ' '", CATEGORY_1="coalesce(ia.c, sa.c)")}
FROM dim LEFT JOIN ia USING ({K}) LEFT JOIN sa USING ({K})""")
add("surrogate_key", FX + DIM, f"SELECT {num(DEAL_ID='deal_id', KEYS='count(*)', IDS='count(*)')} FROM dim GROUP BY deal_id")

INV_FACT = [f"""f AS (SELECT {K}, order_mo AS mo, CAST(SUM(held * qty) AS DOUBLE) AS qoh,
CAST(SUM(held * cost) AS DOUBLE) AS cost, min(category_1) AS category_1 FROM il WHERE division IS NOT NULL
GROUP BY {K}, order_mo)"""]
SALE_FACT = [f"""f AS (SELECT {K}, ship_mo AS mo, CAST(SUM(sgn * qty) AS DOUBLE) AS q, CAST(SUM(sgn * net) AS DOUBLE) AS net,
CAST(SUM(sgn * (net - cogs)) AS DOUBLE) AS gm, CAST(SUM(sgn * cogs) AS DOUBLE) AS cogs, min(category_1) AS category_1
FROM sl WHERE division IS NOT NULL GROUP BY {K}, ship_mo)"""]
UNIT_COST = f"CASE WHEN qoh = 0 THEN 0 ELSE {pdiv('cost', 'qoh')} END"
ATTR = txt(SKU="trim_sku || ' '", CATEGORY_1="category_1", DATE_KEY=key_date("mo"))
GROSS = {"GROSS_INVENTORY_QUANTITY": "qoh", "GROSS_INVENTORY_COST": "cost", "UNIT_COST": UNIT_COST}
add("fact_inventory", FXD + INV_FACT, f"""SELECT {keys_out()}, {days(BOM_INV_DATE='mo')}, {ATTR},
{nums({**INV_OUT, **GROSS})}, {STAGED} FROM f JOIN kd USING ({K})""")
add("fact_sales", FXD + SALE_FACT, f"""SELECT {keys_out()}, {days(BEG_MO='mo')}, {ATTR}, {nums(SALES_OUT)}, {STAGED}
FROM f JOIN kd USING ({K})""")
add("fact_inventory_written", FX, f"""SELECT {keys_out()}, {days(BOM_INV_DATE='mo')},
{nums({**INV_OUT, "UNIT_COST": UNIT_COST})} FROM ik""")

# --- demand --------------------------------------------------------------------------------------


def trailing(n):
    return [f"fsale AS (SELECT {K}, min(mo) AS fs FROM sk GROUP BY {K})",
            f"frec AS (SELECT {K}, min(mo) AS fr FROM ik GROUP BY {K})",
            f"""tw AS (SELECT {pick('a')}, a.mo, a.qoh, a.cost, sum(b.q) AS q, sum(b.net) AS net, sum(b.cogs) AS cogs,
sum(b.gm) AS gm, count(b.mo) AS n_sales FROM ik a LEFT JOIN sk b
ON {same('a', 'b')} AND {ix('a.mo')} - {ix('b.mo')} BETWEEN 0 AND {n - 1}
GROUP BY {pick('a')}, a.mo, a.qoh, a.cost)""",
            f"""t AS (SELECT tw.*, CASE WHEN n_sales > 0 THEN fsale.fs END AS wfs, frec.fr AS wfr
FROM tw JOIN frec USING ({K}) LEFT JOIN fsale USING ({K}))"""]


TRAILING_OUT = {"SALES_INFO_QUANTITY_SOLD": "q", "SALES_INFO_SOLD_AMOUNT": "net", "SALES_INFO_COGS": "cogs",
                "SALES_INFO_GM_AMOUNT": "gm", "QUANTITY_ON_HAND": "qoh", "TOTAL_COST_EXTENDED": "cost"}


def metrics(n, annualized):
    """m: one row per inventory month with every metric; r is the rate of the variant, pr the plain rate."""
    span = f"({n} * (CAST(365 AS DOUBLE) / 12))"
    rate = f"coalesce({pdiv('adjq', 'mths')}, 0)" if annualized else "pr"
    return trailing(n) + [
        f"""m0 AS (SELECT *, least(wfs, wfr) AS wintro, date_diff('day', least(wfs, wfr), mo) + 30 AS d FROM t)""",
        f"""m1 AS (SELECT * REPLACE (net - cogs AS gm),
round_even((CASE WHEN d <= {span} THEN CAST(d AS DOUBLE) WHEN d > {span} THEN {span} END) / (CAST(365 AS DOUBLE) / 12), 0) AS mths,
{pdiv('cogs', 'q')} AS cogs_u, {pdiv(f'cogs / {n} * 12', 'cost')} AS turns FROM m0)""",
        f"""m2 AS (SELECT *, {pdiv('gm', 'net')} AS pgm, 1 - {pdiv('cogs_u', pdiv('net', 'q'))} AS psp,
coalesce(qoh, {pdiv('cost', 'cogs_u')}) AS adj FROM m1)""",
        f"m3 AS (SELECT *, {pdiv('cost', 'adj')} AS cpu FROM m2)",
        f"""m4 AS (SELECT *, (CASE WHEN cogs_u = 0 OR cpu = 0 THEN 0 ELSE {pdiv(known('(cpu - cogs_u)'), 'cpu')} END) * 100 AS chg
FROM m3)""",
        f"""m5 AS (SELECT *, CASE WHEN chg > 30 OR chg < -30 OR q = 0 THEN {pdiv('cogs', 'cpu')} ELSE q END AS adjq FROM m4)""",
        f"m6 AS (SELECT *, coalesce(adjq / {n}, 0) AS pr FROM m5)",
        f"m7 AS (SELECT *, {rate} AS r FROM m6)",
        "m AS (SELECT *, CASE WHEN r = 0 THEN adj ELSE 0 END AS no_sales FROM m7)"]


METRIC_OUT = {"SALES_INFO_QUANTITY_SOLD": "q", "SALES_INFO_SOLD_AMOUNT": "net", "SALES_INFO_COGS": "cogs",
              "SALES_INFO_GM_AMOUNT": "gm", "SALES_INFO_MONTHS": "mths", "SALES_INFO_PERCENT_SKU_GM": "pgm",
              "SALES_INFO_COGS_PER_UNIT": "cogs_u", "SALES_INFO_TURNS": "turns",
              "SALES_INFO_PERCENT_SP_PER_UNIT_GM": "psp", "ADJ_QTY_DEMAND": "adj", "CPU": "cpu",
              "SALES_INFO_PERCENT_COGS_CHANGE": "chg", "ADJUSTED_QTY": "adjq",
              "SALES_INFO_SALES_QUANTITY_PER_MONTH": "r"}


def waterfall():
    """a: units per band by the closed form for stock that is not negative."""
    bands = []
    for name, w, before in BANDS:
        left = f"adj - r * {before}" if before else "adj"
        bands.append(f"CASE WHEN r > 0 THEN greatest(0, least(r * {w}, {left})) ELSE 0 END AS u_{name}")
    total = " + ".join(f"u_{b[0]}" for b in BANDS)
    return [f"a0 AS (SELECT *, {', '.join(bands)} FROM m)",
            f"a1 AS (SELECT *, adj - ({total} + no_sales) AS u_720 FROM a0)",
            f"a AS (SELECT *, {total} + u_720 + no_sales AS u_total FROM a1)"]


UNIT_OUT = {f"DEMAND_UNITS_{b[0]}": f"u_{b[0]}" for b in BANDS} | {
    "DEMAND_UNITS_720": "u_720", "DEMAND_UNITS_NO_SALES": "no_sales", "DEMAND_UNITS_TOTAL": "u_total",
    "DEMAND_UNITS_CHECK": "u_total - adj"}
COST_OUT = {f"DEMAND_COST_AMOUNT_{b}": known(f"(cpu * u_{b})") for b in [x[0] for x in BANDS] + ["720"]} | {
    "DEMAND_COST_NO_SALES_AMOUNT": known("(cpu * no_sales)"), "DEMAND_COST_TOTAL_AMOUNT": known("(cpu * u_total)"),
    "DEMAND_COST_CHECK_AMOUNT": known("(cpu * (u_total - adj))")}


def run_off(source):
    """o16: week after week, each takes what the earlier ones left; a missing week ends the series."""
    out = [f"""o1 AS (SELECT *, pr / 30 * 7 AS w, CASE WHEN pr IS NOT NULL AND adj IS NOT NULL
THEN least(pr / 30 * 7, adj) END AS w_1, CASE WHEN pr IS NOT NULL AND adj IS NOT NULL
THEN least(pr / 30 * 7, adj) END AS gone FROM {source})"""]
    for i in range(2, 17):
        week = "CASE WHEN adj - gone > 0 AND w > 0 THEN least(w, adj - gone) END"
        out.append(f"o{i} AS (SELECT * REPLACE (gone + {week} AS gone), {week} AS w_{i} FROM o{i - 1})")
    return out


RUN_OUT = {"STOCK_OUT_SALES_UNIT_SALES_PER_WEEK": "w", "STOCK_OUT_SALES_COST_COGS_PER_WEEK": known("(cpu * w)")}
RUN_OUT |= {f"STOCK_OUT_SALES_UNIT_{i}_WEEK": f"w_{i}" for i in range(1, 17)}
RUN_OUT |= {f"STOCK_OUT_SALES_COST_{i}_WEEK_AMOUNT": known(f"(cpu * w_{i})") for i in range(1, 17)}


def zeros(cols):
    return nums({n: zero(f"CAST({x} AS DOUBLE)") for n, x in cols.items()})


def demand(n, annualized, by_part=False):
    out = {**METRIC_OUT, **UNIT_OUT, **COST_OUT, **RUN_OUT, "GROSS_INVENTORY_QUANTITY": "qoh",
           "GROSS_INVENTORY_COST": "cost"}
    buckets = age_buckets(default="0")
    if annualized:
        buckets = buckets.replace('"FIRST_RECEIPT_DATE_BUCKET"', '"FIRST_RECEIPT_BUCKET_SEQ_ID"')
    ctes = (FXP if by_part else FX) + DATES + metrics(n, annualized) + waterfall() + run_off("a")
    return sql(ctes, f"""SELECT {keys_out("o16")}, {days(BOM_INV_DATE="mo",
    SALES_INFO_START_MONTH=f"mo - INTERVAL {n - 1} MONTH")}, {txt(DATE_KEY=key_date("mo"), SKU="o16.trim_sku")},
{zeros(out)}, {FOUR_DATES}, {buckets} FROM o16 JOIN kd USING ({K})""")


for _n, _word in WORDS.items():
    add(f"trailing_sales_{_n}_months", FX + trailing(_n), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo",
    FIRST_SALE_DATE="wfs", FIRST_RECEIPT_DATE="wfr")}, {nums(TRAILING_OUT)} FROM t""")
    add(f"month_availability_{_n}_months", FX + [
        f"fsale AS (SELECT {K}, min(mo) AS fs FROM sk GROUP BY {K})",
        f"starts AS (SELECT DISTINCT deal_id, fs FROM fsale WHERE ({K}) IN (SELECT ({K}) FROM ik))"],
        f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo")}, {nums(INV_OUT)}, CASE WHEN fs IS NULL OR (
(deal_id, mo) IN (SELECT (deal_id, fs) FROM starts) AND
(deal_id, CAST(mo - INTERVAL {_n - 1} MONTH AS DATE)) IN (SELECT (deal_id, fs) FROM starts)) THEN 'use' ELSE 'dnu' END
AS "MONTH_AVAILABILITY" FROM ik LEFT JOIN fsale USING ({K})""")
    for _a in (False, True):
        _suffix = "_annualized" if _a else ""
        add(f"demand_metrics_{_n}_months{_suffix}", FX + metrics(_n, _a), f"""SELECT {keys_out()}, {days(
            BOM_INV_DATE="mo", INTRODUCTION_DATE="wintro", SALES_INFO_START_MONTH=f"mo - INTERVAL {_n - 1} MONTH")},
{zeros({**METRIC_OUT, "DEMAND_UNITS_NO_SALES": "no_sales"})} FROM m""")
        ORACLE[f"fact_{_word}_month_{'annualized' if _a else 'inventory'}"] = demand(_n, _a)
ORACLE["fact_six_month_inventory_by_part"] = demand(6, False, True)
ORACLE["fact_twelve_month_annualized_by_part"] = demand(12, True, True)
add("active_months", FX + metrics(12, False), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo",
    INTRODUCTION_DATE="wintro")}, {num(SALES_INFO_MONTHS="mths")} FROM m""")
add("demand_aging", FX + metrics(3, False) + waterfall(), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo")},
{nums({**UNIT_OUT, **COST_OUT})} FROM a""")
add("stock_out_run_off", FX + metrics(3, False) + run_off("m"), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo")},
{nums(RUN_OUT)} FROM o16""")

# --- quintile ------------------------------------------------------------------------------------


def quintile(n, by_part=False):
    dec = "CAST({} AS DECIMAL(28,6))"
    ctes = (FXP if by_part else FX) + [
        "latest AS (SELECT deal_id, max(mo) AS l FROM s GROUP BY deal_id)",
        f"""sold AS (SELECT {K}, l, sum(q) AS q, sum(net) AS net, sum(gm) AS gm, sum(cogs) AS cogs FROM sk
JOIN latest USING (deal_id) WHERE {ix('l')} - {ix('mo')} < {n} GROUP BY {K}, l)""",
        f"""x AS (SELECT {pick('a')}, a.l, a.q, a.net, a.gm, a.cogs, b.qoh, b.cost, coalesce(b.cost <> 0, FALSE) AS has_inv
FROM sold a LEFT JOIN ik b ON {same('a', 'b')} AND b.mo = a.l)""",
        f"""y AS (SELECT *, CASE WHEN has_inv THEN {dec.format('net')} ELSE 0 END AS ns, coalesce({dec.format('cost')}, 0) AS nc
FROM x)""",
        """z AS (SELECT *, sum(ns) OVER w AS ns_run, sum(nc) OVER w AS nc_run, sum(ns) OVER (PARTITION BY deal_id) AS ns_all,
sum(nc) OVER (PARTITION BY deal_id) AS nc_all FROM y WINDOW w AS (PARTITION BY deal_id ORDER BY net DESC, location, country,
division, inventory_type, trim_sku ROWS UNBOUNDED PRECEDING))""",
        f"""v AS (SELECT *, {pdiv('CAST(ns_run AS DOUBLE)', 'CAST(ns_all AS DOUBLE)')} AS cum FROM z)"""]
    return sql(ctes, f"""SELECT {keys_out()}, {txt(DATE_KEY=key_date("l"))}, {nums({
        "QUANTITY_SOLD": "q", "NET_SALES_$": "net", "COGS": "cogs", "GROSS_MARGIN_$": "gm", "QUANTITY": "qoh",
        "GROSS_INVENTORY_COST": "cost",
        "PERCENT": f"CASE WHEN has_inv THEN {pdiv('net', 'CAST(ns_all AS DOUBLE)')} ELSE 0 END",
        "COMMULATIVE_PERCENTAGE": "cum",
        "CPU": f"CASE WHEN isinf({pdiv('cost', 'qoh')}) THEN 0 ELSE {pdiv('cost', 'qoh')} END",
        "SKU": "CASE WHEN cost = 0 THEN 0 ELSE 1 END",
        "INVENTORY_PERCENT": zero(pdiv('cost', 'CAST(nc_all AS DOUBLE)')),
        "INVENTORY_CUM_PERCENT": zero(pdiv('CAST(nc_run AS DOUBLE)', 'CAST(nc_all AS DOUBLE)'))})},
CASE WHEN NOT has_inv THEN 'Sales No Inv' WHEN cum <= 0.2 THEN '1.0' WHEN cum <= 0.4 THEN '2.0' WHEN cum <= 0.6 THEN '3.0'
WHEN cum <= 0.8 THEN '4.0' WHEN cum <= 1 THEN '5.0' ELSE 'nan' END AS "QUINTILE" FROM v""")


for _n, _word in WORDS.items():
    ORACLE[f"fact_{_word}_month_quintile"] = quintile(_n)
ORACLE["fact_two_month_quintile_one_window"] = quintile(2)
ORACLE["fact_six_month_quintile_by_part"] = quintile(6, True)

# --- movement ------------------------------------------------------------------------------------


def movement(by_part=False):
    back = f"({ix('a.mo')} - {ix('b.mo')})"
    quantities = ", ".join(f"coalesce(max(b.qoh) FILTER ({back} = {i}), 0) AS q{i}" for i in range(12))
    moves = ", ".join(f"CASE WHEN q{i} < q{i + 1} THEN 'Down' WHEN q{i} > q{i + 1} THEN 'Up' ELSE 'No Inv' END AS m{i}"
                      for i in range(11))
    return (FXP if by_part else FX) + [
        f"""mq AS (SELECT {pick('a')}, a.mo, a.qoh, a.cost, {quantities} FROM ik a JOIN ik b ON {same('a', 'b')}
AND {back} BETWEEN 0 AND 11 GROUP BY {pick('a')}, a.mo, a.qoh, a.cost)""",
        f"mm AS (SELECT *, {moves}, [{', '.join(f'm{i}' for i in range(11))}] AS ms FROM mq)",
        """mz AS (SELECT *, len(list_filter(ms, lambda x: x = 'Up')) AS u12, len(list_filter(ms, lambda x: x = 'Down')) AS d12,
len(list_filter(ms[1:5], lambda x: x = 'Up')) AS u6, len(list_filter(ms[1:5], lambda x: x = 'Down')) AS d6,
CAST(list_position(list_transform(ms, lambda x: x <> 'No Inv'), TRUE) - 1 AS INTEGER) AS lm FROM mm)""",
        "mx AS (SELECT *, CAST(mo - to_months(lm) AS DATE) AS lmd FROM mz)"]


def movement_fact(by_part=False):
    def kind(u, d):
        return f"CASE WHEN {u} = 0 AND {d} = 0 THEN 'Static' WHEN {d} = 0 THEN 'Up' WHEN {u} = 0 THEN 'Down' ELSE 'Up/Down' END"
    return sql(movement(by_part), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo",
    LAST_MOVE_DATE=f"coalesce(lmd, {NODATE})")}, {txt(DATE_KEY=key_date("mo"), TWELVE_MONTH_MVMT_CAT=kind("u12", "d12"),
    SIX_MONTH_MVMT_CAT=kind("u6", "d6"),
    LASTMOVE_BUCKET_SEQ_ID=f"coalesce({bucket("date_diff('day', lmd, mo)")}, '0')")}, {num(
        TOTAL_COST="cost", TOTAL_QUANTITY="qoh", CPU=zero(pdiv("cost", "qoh")), TWELVE_MONTH_UP="u12",
        TWELVE_MONTH_DOWN="d12", TWELVE_MONTH_NO_INV="11 - u12 - d12", TWELVE_MONTH_STATIC="0", SIX_MONTH_UP="u6",
        SIX_MONTH_DOWN="d6", SIX_MONTH_NO_INV="5 - u6 - d6", SIX_MONTH_STATIC="0",
        MONTHS_LAST_MOVE="coalesce(lm, 0)", MOST_LAST_MOVE="0",
        LAST_MOVE_DAYS="coalesce(date_diff('day', lmd, mo), 0)")} FROM mx""")


add("movement_matrix", movement(), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo")},
{num(TOTAL_QUANTITY="qoh", TOTAL_COST="cost", **{f"QTY_M{i}": f"q{i}" for i in range(12)})},
{txt(**{f"MOVE_{i}": f"m{i}" for i in range(11)})} FROM mx""")
ORACLE["fact_inv_mvmt"] = movement_fact()
ORACLE["fact_inv_mvmt_by_part"] = movement_fact(True)

# --- FIFO ----------------------------------------------------------------------------------------

CALENDAR = [
    "dm AS (SELECT DISTINCT deal_id, mo FROM ik)",
    "dl AS (SELECT deal_id, max(mo) AS l FROM dm GROUP BY deal_id)",
    f"""ok AS (SELECT deal_id, l FROM dm JOIN dl USING (deal_id) GROUP BY deal_id, l
HAVING count(*) FILTER ({ix('l')} - {ix('mo')} BETWEEN 0 AND 11) = 12)""",
    f"""cal AS (SELECT deal_id, mo, CAST({ix('mo')} - {ix('l')} + 23 AS INTEGER) AS step FROM dm JOIN ok USING (deal_id)
WHERE {ix('l')} - {ix('mo')} <= 23)"""]
FLOWS = CALENDAR + [
    f"""fl0 AS (SELECT {pick('c')}, c.mo, cal.step, c.qoh AS cu, c.cost, coalesce(p.qoh, 0) AS pu, coalesce(b.q, 0) AS qs,
coalesce(b.net, 0) AS net, coalesce(b.gm, 0) AS gm, coalesce(b.cogs, 0) AS cogs
FROM ik c JOIN cal ON cal.deal_id = c.deal_id AND cal.mo = c.mo
LEFT JOIN ik p ON {same('c', 'p')} AND {ix('p.mo')} = {ix('c.mo')} - 1
LEFT JOIN sk b ON {same('c', 'b')} AND b.mo = c.mo)""",
    "fl1 AS (SELECT *, cu - pu AS eom FROM fl0)",
    "fl2 AS (SELECT *, CASE WHEN qs >= 0 THEN qs WHEN eom >= 0 THEN eom ELSE 0 END AS sa FROM fl1)",
    "fl3 AS (SELECT *, sa + eom AS rec FROM fl2)",
    "fl4 AS (SELECT *, CASE WHEN rec < 0 OR cu = 0 THEN -eom ELSE sa END AS us FROM fl3)",
    f"""fl AS (SELECT *, CASE WHEN rec < 0 THEN 0 WHEN cu = 0 AND us = -eom THEN 0 ELSE rec END AS ur,
{pdiv('cost', 'cu')} AS cpu FROM fl4)""",
    f"flx AS (SELECT *, {pdiv('net', 'us')} AS spu, {pdiv('gm', 'us')} AS gmu FROM fl)"]
FLOW_OUT = {"CURRENT_UNITS": "cu", "CURRENT_COST": "cost", "QUANTITY_SOLD": "qs", "NET_SALES_$": "net", "COGS_$": "cogs",
            "GROSS_MARGIN_$": "gm", "EOM_CHANGE": "eom", "SALES_ADJ": "sa", "REC_ADJ": "rec", "USE_SALES": "us",
            "USE_RECEIPTS": "ur", "CURRENT_CPU": "cpu", "SP_U": "spu", "GM_U": "gmu"}
ZERO_LAYERS = "list_transform(range(25), lambda x: CAST(0 AS DOUBLE))"


def ledger(by_part=False):
    """led: one row per reported series and open step; u and asq are lists of 25."""
    older = "coalesce(list_sum(r.u[(j + 1):25]), 0)"
    upto = "list_sum(r.u[j:25])"
    sold = f"""list_transform(range(1, 26), lambda j: CASE WHEN abs(f.us) > {upto} THEN r.u[j]
WHEN j = 25 THEN f.us ELSE greatest(f.us - {older}, 0) END)"""
    return (FXP if by_part else FX) + FLOWS + [
        f"""rep AS (SELECT DISTINCT {K} FROM (SELECT {K.replace('division', "coalesce(division, 'NEED CAT') AS division")} FROM i
UNION ALL SELECT {K.replace('division', "coalesce(division, 'NEED CAT')")} FROM s)
WHERE (deal_id, trim_sku) IN (SELECT (deal_id, trim_sku) FROM ik) AND deal_id IN (SELECT deal_id FROM ok))""",
        f"""rec AS (SELECT {K}, -1 AS step, {ZERO_LAYERS} AS u, CAST(NULL AS DOUBLE[]) AS asq, FALSE AS open, FALSE AS held FROM rep
UNION ALL
SELECT {K}, step, CASE WHEN held THEN list_prepend(ur - (us - list_sum(asq)),
list_transform(range(1, 25), lambda j: u[j] - asq[j])) WHEN open THEN {ZERO_LAYERS} ELSE u END, asq, open, held
FROM (SELECT {pick('r')}, r.step + 1 AS step, r.u, f.us, f.ur, {sold} AS asq, c.step IS NOT NULL AS open, f.us IS NOT NULL AS held
FROM rec r LEFT JOIN cal c ON c.deal_id = r.deal_id AND c.step = r.step + 1
LEFT JOIN flx f ON {same('r', 'f')} AND f.step = r.step + 1 WHERE r.step < 23))""",
        f"""led AS (SELECT {pick('r')}, r.step, r.held, CASE WHEN r.held THEN r.u END AS u, CASE WHEN r.held THEN r.asq END AS asq,
{pick('f', ['cu', 'cost', 'qs', 'net', 'cogs', 'gm', 'eom', 'sa', 'rec', 'us', 'ur'])},
{fin('f.cpu')} AS cpu, {fin('f.spu')} AS spu, {fin('f.gmu')} AS gmu, f.cpu AS cpu0, f.spu AS spu0, f.gmu AS gmu0, c.mo AS bom
FROM rec r JOIN cal c ON c.deal_id = r.deal_id AND c.step = r.step
LEFT JOIN flx f ON {same('r', 'f')} AND f.step = r.step)"""]


LAYER_OUT = {f"UNITS_{b}": f"u[{j + 1}]" for j, b in enumerate(LAYERS)}
SOLD_OUT = {f"A_{b}_ASQ": f"asq[{j + 1}]" for j, b in enumerate(LAYERS)}


def roll(kind):
    def layer(j):
        return f"u[{j + 1}]" if kind == "UNITS" else f"u[{j + 1}] * cpu0"
    out = {f"{kind}_{b}": " + ".join(f"coalesce({fin(layer(j))}, 0)" for j in range(*span)) for b, span in ROLL.items()}
    return {**out, f"{kind}_OVER_720": fin(layer(24))}


def fifo_table():
    out = {**FLOW_OUT, **LAYER_OUT, **SOLD_OUT, "TOTAL_RECEIPTS": "us - list_sum(asq)", "STEP": "step"}
    for j, b in enumerate(LAYERS):
        out |= {f"COST_{b}": fin(f"(u[{j + 1}] * cpu0)"), f"A_{b}_S$A": fin(f"(asq[{j + 1}] * spu0)"),
                f"A_{b}GM$A": fin(f"(asq[{j + 1}] * gmu0)")}
    return sql(ledger(), f"""SELECT {keys_out()}, {days(BOM_INV_DATE="bom")}, {txt(DATE_KEY=key_date("bom"))},
{nums({**out, **roll("UNITS"), **roll("COST")})} FROM led""")


add("fifo_eligible", FX + CALENDAR, f"SELECT {num(DEAL_ID='deal_id')} FROM ok")
add("fifo_flows", FX + FLOWS, f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo")}, {num(STEP="step")}, {zeros(FLOW_OUT)}
FROM flx""")
add("fifo_ledger", ledger(), f"""SELECT {keys_out()}, {nums({"STEP": "step", "USE_SALES": "us", "USE_RECEIPTS": "ur",
    "TOTAL_RECEIPTS": "us - list_sum(asq)", **LAYER_OUT, **SOLD_OUT})} FROM led""")
ORACLE["fifo"] = fifo_table()
add("fifo_by_part", ledger(True), f"""SELECT {keys_out()}, {txt(DATE_KEY=key_date("bom"))}, {nums({
    "STEP": "step", "USE_SALES": "us", "USE_RECEIPTS": "ur", "TOTAL_RECEIPTS": "us - list_sum(asq)", "UNITS_0_30": "u[1]",
    "UNITS_30_60": "u[2]", "UNITS_60_90": "u[3]", **roll("UNITS"), **roll("COST")})} FROM led""")
add("fifo_m23", ledger(), f"""SELECT {keys_out()}, {txt(DATE_KEY=key_date("bom"))}, {nums({**roll("UNITS"), **roll("COST")})}
FROM led WHERE step = 23""")

# --- cycles --------------------------------------------------------------------------------------


def cycle(prefix, column, measure, by_part=False):
    na = K.replace("division", "coalesce(division, 'NA') AS division")
    offset = f"({ix('b.mo')} - {ix('a.fs')})"
    sums = ", ".join(f"coalesce(sum(b.m) FILTER ({offset} = {i}), 0) AS c{i}" for i in range(24))
    ctes = (FXP if by_part else FX) + [
        f"cs AS (SELECT {na}, division IS NOT NULL AS has_id, mo, {measure} AS m FROM s)",
        f"ci AS (SELECT {K}, min(mo) AS fr, max(mo) AS lr FROM (SELECT {na}, mo FROM i) GROUP BY {K})",
        f"ck AS (SELECT {K}, min(mo) AS fs, max(mo) AS ls FROM cs GROUP BY {K})",
        f"cc AS (SELECT {pick('a')}, {sums} FROM ck a JOIN cs b ON {same('a', 'b')} GROUP BY {pick('a')})",
        f"""ca AS (SELECT cs.*, ck.fs, ck.ls, ci.fr, ci.lr, CASE WHEN ci.fr IS NOT NULL THEN least(ck.fs, ci.fr) END AS intro,
{', '.join(f'CASE WHEN has_id THEN c{i} END AS c{i}' for i in range(24))}
FROM cs JOIN ck USING ({K}) JOIN cc USING ({K}) LEFT JOIN ci USING ({K}))"""]
    return sql(ctes, f"""SELECT {keys_out()}, {days(BEG_MO="mo")}, {txt(DATE_KEY=key_date("mo"))},
{nums({column: "m", **{f"{prefix}_{i + 1:02d}": f"c{i}" for i in range(24)}})}, {FOUR_DATES}, {ages()}, {age_buckets()}
FROM ca""")


ORACLE["fact_gross_margin_cycle"] = cycle("GROSS_MARGIN_CYCLE", "GROSS_MARGIN_$", "gm")
ORACLE["fact_sales_cycle"] = cycle("SALES_CYCLE", "NET_SALES_$", "net")
ORACLE["fact_sales_cycle_by_part"] = cycle("SALES_CYCLE", "NET_SALES_$", "net", True)

# --- sell-through --------------------------------------------------------------------------------

LEAD = {"SALES_AMOUNT_X": "net", "UNITS_SOLD_X": "q", "COGS_AMOUNT_X": "cogs"}


def leads(require=True, by_part=False):
    """ld: inventory months with sales of the three following stocked months as x_1.."""
    joins = "".join(f"""
LEFT JOIN sb b{k} ON {same('a', f'b{k}', True)} AND {ix(f'b{k}.mo')} = {ix('a.mo')} + {k}""" for k in (1, 2, 3))
    gate = "b0.mo IS NOT NULL" if require else "TRUE"
    cols = ", ".join(f"CASE WHEN {gate} THEN b{k}.{m} END AS {m}_{k}" for k in (1, 2, 3) for m in LEAD.values())
    return (FXP if by_part else FX) + [
        "sb AS (SELECT * FROM s WHERE (deal_id, mo) IN (SELECT (deal_id, mo) FROM i))",
        f"life AS (SELECT {K}, min(mo) AS lfs, max(mo) AS lls FROM s GROUP BY {K})",
        f"held AS (SELECT {K}, min(mo) AS lfr FROM i GROUP BY {K})",
        f"""ld AS (SELECT a.*, {cols}, held.lfr, CASE WHEN b0.mo IS NOT NULL THEN life.lfs END AS lfs,
CASE WHEN b0.mo IS NOT NULL THEN life.lls END AS lls, CASE WHEN b0.mo IS NOT NULL THEN least(life.lfs, held.lfr) END AS lintro
FROM i a JOIN held ON {same('a', 'held', True)} LEFT JOIN life ON {same('a', 'life', True)}
LEFT JOIN sb b0 ON {same('a', 'b0', True)} AND b0.mo = a.mo{joins})"""]


LEAD_OUT = {f"{name}_{k}": f"{m}_{k}" for k in (1, 2, 3) for name, m in LEAD.items()}
LEAD_DATES = days(FIRST_SALE_DATE="lfs", LAST_SALES_DATE="lls", FIRST_RECEIPT_DATE="lfr", INTRODUCTION_DATE="lintro")
for _name, _require in (("lead_sales", True), ("lead_sales_any_base", False)):
    add(_name, FX + leads(_require)[len(FX):], f"""SELECT {keys_out()}, {days(BOM_INV_DATE="mo")}, {nums(INV_OUT)},
{nums(LEAD_OUT)}, {LEAD_DATES} FROM ld""")


def sell_through(strict, by_part=False):
    def adjusted(k):
        plain = f"q_{k}"
        if strict:
            plain = f"CASE WHEN abs(diff) > 0.3 THEN CASE WHEN cpu <> 0 THEN cogs_{k} / cpu END ELSE q_{k} END"
        return f"coalesce(CASE WHEN diff IS NOT NULL THEN {plain} END, 0) AS x_{k}"
    ctes = leads(True, by_part) + DATES + [
        "e0 AS (SELECT * REPLACE (" + ", ".join(f"coalesce({m}_{k}, 0) AS {m}_{k}" for m in LEAD.values() for k in (1, 2, 3))
        + ") FROM ld)",
        """e1 AS (SELECT *, cogs_1 + cogs_2 + cogs_3 AS tc, q_1 + q_2 + q_3 AS tq, net_1 + net_2 + net_3 AS tn FROM e0)""",
        f"e2 AS (SELECT *, CASE WHEN isinf({pdiv('tc', 'tq')}) THEN 0 ELSE {pdiv('tc', 'tq')} END AS cu FROM e1)",
        "e3 AS (SELECT *, CASE WHEN qoh = 0 THEN CASE WHEN cu <> 0 THEN cost / cu END ELSE qoh END AS adj FROM e2)",
        "e4 AS (SELECT *, CASE WHEN adj = 0 THEN 0 WHEN adj <> 0 THEN cost / adj END AS cpu FROM e3)",
        "e5 AS (SELECT *, CASE WHEN cpu <> 0 THEN (cu - cpu) / cpu END AS diff FROM e4)",
        f"e6 AS (SELECT *, {', '.join(adjusted(k) for k in (1, 2, 3))} FROM e5)",
        "e7 AS (SELECT *, least(x_1, adj) AS st_1 FROM e6)", "e8 AS (SELECT *, least(x_2, adj - st_1) AS st_2 FROM e7)",
        "e9 AS (SELECT *, least(x_3, adj - st_1 - st_2) AS st_3 FROM e8)"]
    out = {**LEAD_OUT, "GROSS_INVENTORY_QUANTITY": "qoh", "GROSS_INVENTORY_COST": "cost", "THREE_MONTH_TOTAL_COGS": "tc",
           "THREE_MONTH_TOTAL_UNITS": "tq", "THREE_MONTH_TOTAL_SALES": "tn", "COGS_UNIT": "cu", "ADJ_QTY_DEMAND": "adj",
           "CPU": "cpu", "COGS_CHECK_PERCENTAGE_DIFF": "diff"}
    out |= {f"UNITS_SOLD_X_{k}_ADJ": f"x_{k}" for k in (1, 2, 3)} | {f"UNITS_ST_{k}": f"st_{k}" for k in (1, 2, 3)}
    out |= {f"COST_ST_{k}": f"st_{k} * cpu" for k in (1, 2, 3)}
    return sql(ctes, f"""SELECT {keys_out("e9")}, {days(BOM_INV_DATE="e9.mo")}, {txt(DATE_KEY=key_date("e9.mo"),
        SKU="e9.trim_sku")}, {nums(out)}, {LEAD_DATES}, {age_buckets("e9.mo")}
FROM e9 LEFT JOIN kd USING ({K})""")


ORACLE["fact_sell_thru"] = sell_through(False)
ORACLE["fact_sell_thru_strict_band"] = sell_through(True)
ORACLE["fact_sell_thru_by_part"] = sell_through(False, True)

# --- the whole run -------------------------------------------------------------------------------


def run_deals():
    by_rows = {"TEMP_INVBUCKET": "ik", "TEMP_SALESBUCKET": "sk", "FACT_INVENTORY": "ik", "FACT_SALES": "sk",
               "FACT_INV_MVMT": "ik", "FACT_GROSS_MARGIN_CYCLE": "s", "FACT_SALES_CYCLE": "s", "FACT_SELL_THRU": "i",
               "DIM_CATEGORY": "dim", "DIM_SKU": "dim", "FIFO": "led"}
    for word in WORDS.values():
        by_rows |= {f"FACT_{word.upper()}_MONTH_{kind}": "ik" for kind in ("INVENTORY", "ANNUALIZED")}
    parts = [f"SELECT deal_id, '{name}' AS t, count(*) AS n FROM {source} GROUP BY deal_id" for name, source in by_rows.items()]
    parts.append(f"""SELECT deal_id, 'FACT_TWO_MONTH_QUINTILE', count(*) FROM (SELECT DISTINCT {K} FROM sk
JOIN (SELECT deal_id, max(mo) AS l FROM s GROUP BY deal_id) USING (deal_id) WHERE {ix('l')} - {ix('mo')} < 2) GROUP BY deal_id""")
    return sql(ledger() + DIM, f"""SELECT {num(DEAL_ID="deal_id", ROWS="n")}, {txt(TABLE_NAME="t")}
FROM ({' UNION ALL '.join(parts)})""")


ORACLE["run_deals"] = run_deals()


def with_category(name):
    """An inventory fact with CATEGORY_1, which only order lines carry."""
    on = " AND ".join([f"q.{c.upper()} = f.{c}" for c in KEY[1:]] + ["q.DEAL_ID = f.deal_id", "q.BOM_INV_DATE = CAST(f.mo AS VARCHAR)"])
    return sql(FX + INV_FACT, f"""SELECT q.*, CAST(f.category_1 AS VARCHAR) AS "CATEGORY_1" FROM ({ORACLE[name]}) q JOIN f ON {on}""")


def with_id_key(text):
    """What a SKU id stands for; series with an unknown part have none."""
    known_parts = " AND ".join(f"coalesce({c.upper()}, 'NA') <> 'NA'" for c in KEY[1:])
    own = ", ".join(c.upper() for c in KEY[1:])
    return f"""SELECT *, CASE WHEN {known_parts} THEN concat_ws('|', {own}) END AS "ID_KEY" FROM ({text})"""


for _name in OUTPUT_TABLES:
    _sql = with_category(_name.lower()) if "_MONTH_" in _name and "QUINTILE" not in _name else ORACLE[_name.lower()]
    _bare = _name.startswith(("TEMP_", "DIM_")) or _name == "FACT_INV_MVMT"
    ORACLE[f"run_deals_{_name.lower()}"] = _sql if _bare else with_id_key(_sql)


def conformed(name, text):
    """Declared columns that the run had no input for are null; the frames have their other names."""
    absent = {"DIM_SKU": "DESCRIPTION_1 LOT CATEGORY_2 CATEGORY_3 CATEGORY_4 CATEGORY_CODE_1 CATEGORY_CODE_2 CATEGORY_CODE_3 CATEGORY_CODE_4"}
    dates = "EXPIRATION_DATE ORDER_DATE SHIP_DATE ORIGINAL_RETAIL_PRICE_EXTENDED"
    absent |= {"FACT_SALES": f"{absent['DIM_SKU']} {dates} EOM_DATE", "FACT_INVENTORY": f"{absent['DIM_SKU']} {dates} EOM_INV_DATE INVENTORY_DATE"}
    missing = absent.get(name, "INVENTORY_DATE ORIGINAL_RETAIL_PRICE_EXTENDED" if "_MONTH_" in name and "QUINTILE" not in name else "")
    nulls = "".join(f', NULL AS "{c}"' for c in missing.split())
    if name == "FACT_INV_MVMT":
        return f"SELECT * EXCLUDE ({', '.join(c.upper() for c in KEY[1:])}) FROM ({text})"
    return f"""SELECT * RENAME (COUNTRY AS "MAJOR_FRAME", DIVISION AS "MINOR_FRAME", INVENTORY_TYPE AS "SUB_MINOR_FRAME"){nulls} FROM ({text})"""


for _name in OUTPUT_TABLES:
    _sql = with_category(_name.lower()) if "_MONTH_" in _name and "QUINTILE" not in _name else ORACLE[_name.lower()]
    ORACLE["conform_temp_invbucket_declared" if _name == "TEMP_INVBUCKET" else f"conform_{_name.lower()}"] = conformed(_name, _sql)


def mixed(text):
    """The same SQL over deals of which 1002 has neither locations nor categories."""
    text = text.replace("n_name AS location", "CASE WHEN r_regionkey <= 2 THEN n_name ELSE '' END AS location")
    text = text.replace("p_type AS category_1", "CASE WHEN r_regionkey <= 2 THEN p_type END AS category_1")
    return f"SELECT * REPLACE (nullif(LOCATION, '') AS LOCATION) FROM ({text})"


ORDERED = [f"""f AS (SELECT {K}, ship_mo AS mo, CASE WHEN deal_id = 1001 THEN last_day(ship_mo) END AS ordered,
CAST(SUM(sgn * qty) AS DOUBLE) AS q, CAST(SUM(sgn * net) AS DOUBLE) AS net, CAST(SUM(sgn * (net - cogs)) AS DOUBLE) AS gm,
CAST(SUM(sgn * cogs) AS DOUBLE) AS cogs, min(category_1) AS category_1 FROM sl
WHERE division IS NOT NULL AND (deal_id <> 1001 OR category_1 NOT LIKE 'LARGE%') GROUP BY {K}, ship_mo)"""]
ORACLE["run_deals_mixed_columns"] = mixed(sql(FXD + ORDERED, f"""SELECT {keys_out()},
{days(BEG_MO='mo', ORDER_DATE='ordered')}, {ATTR}, {nums(SALES_OUT)}, {STAGED} FROM f JOIN kd USING ({K})"""))
ORACLE["run_deals_mixed_columns_demand"] = mixed(with_category("fact_three_month_inventory"))
MIXED_CATEGORY = "coalesce(category_1, 'NEED CAT')"
ORACLE["run_deals_mixed_columns_dim_category"] = mixed(sql(FX + DIM, f"SELECT {dim_row(MIXED_CATEGORY)} FROM dim"))

ORACLE["trailing_sales_6_months_appended"] = ORACLE["trailing_sales_6_months"]
ORACLE["movement_matrix_appended"] = ORACLE["movement_matrix"]
# Series with an unknown key part aren't stored by month here.
ORACLE["lead_sales_appended"] = f"SELECT * FROM ({ORACLE['lead_sales']}) WHERE DIVISION IS NOT NULL"
