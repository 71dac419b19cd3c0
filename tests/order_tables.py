"""Small order tables that tests of the by-part queries write and read."""

from datetime import datetime

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp")


def write_orders(spark, folder: str) -> str:
    """Parts of known and missing division (Brand#25), brands with copies (Brand#1, Brand#2), repeated and unknown keys."""
    brands = ["Brand#1", "Brand#2", "Brand#25", "Brand#7", "Brand#9"]
    day = [datetime(2020 + m // 12, m % 12 + 1, 1 + m % 27) for m in range(30)]
    rows = [(o, o % 13, o % 7, n, float(1 + (o + n) % 50), 10.0 + o * n, 0.01 * (o % 9), "NRA"[o % 3], "OF"[n % 2], day[(o * n) % 30])
            for o in range(120) for n in (1, 2, 7)]
    rows += [rows[0], (None, 1, 1, 1, 1.0, 1.0, 0.0, "N", "O", day[0]), (1, 1, 1, None, 2.0, 3.0, 0.0, None, None, day[4])]
    tables = {
        "lineitem": (rows, LINES),
        "orders": ([(o, day[o % 29]) for o in range(119)] + [(5, day[3]), (7, day[9])], "o_orderkey long, o_orderdate timestamp"),
        "part": ([(p, brands[p % 5], f"TYPE{p % 3}", 900.0 + p) for p in range(13)],
                 "p_partkey long, p_brand string, p_type string, p_retailprice double"),
        "supplier": ([(s, s % 4) for s in range(6)] + [(6, None)], "s_suppkey long, s_nationkey int"),
        "nation": ([(0, "KENYA", 0), (1, "CHINA", 2), (2, "FRANCE", 3), (3, "INDIA", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "AFRICA"), (2, "ASIA"), (3, "EUROPE")], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder
