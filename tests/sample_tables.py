"""Small monthly tables that the tests build their cases from."""

from datetime import date


def month(i: int) -> date:
    """Month number ``i`` from January 2020."""
    return date(2020 + i // 12, i % 12 + 1, 1)


SERIES = "DEAL_ID long, LOCATION string, COUNTRY string, DIVISION string, INVENTORY_TYPE string, TRIM_SKU string"
KEYS = ["DEAL_ID", "LOCATION", "COUNTRY", "DIVISION", "INVENTORY_TYPE", "TRIM_SKU"]


def key(sku="A", deal=1, division="D", location="L"):
    return (deal, location, "C", division, "FG", sku)


def inventory(spark, rows):
    """rows: (key, month number, quantity, cost)."""
    return spark.createDataFrame([(*k, month(m), q, c) for k, m, q, c in rows],
                                 SERIES + ", BOM_INV_DATE date, QUANTITY_ON_HAND double, TOTAL_COST_EXTENDED double")


def sales(spark, rows):
    """rows: (key, month number, quantity, net, cogs)."""
    return spark.createDataFrame([(*k, month(m), q, n, n - c, c) for k, m, q, n, c in rows],
                                 SERIES + ", BEG_MO date, QUANTITY_SOLD double, `NET_SALES_$` double, "
                                          "`GROSS_MARGIN_$` double, `COGS_$` double")
