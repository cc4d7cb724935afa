"""Schemas of the model tables, the invoice files and the catalog type names."""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()

AGENT = T.StructType([
    T.StructField("agent_id", ID, False),
    T.StructField("agent_name", T.StringType(), False),
    T.StructField("release_date", T.DateType(), True),
])

PRODUCT = T.StructType([
    T.StructField("product_id", ID, False),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("unit_price", T.LongType(), False),
])

TERRITORY = T.StructType([
    T.StructField("territory_id", ID, False),
    T.StructField("agent_id", ID, True),
    T.StructField("city", T.StringType(), False),
    T.StructField("district", T.StringType(), False),
])

PURCHASE = T.StructType([
    T.StructField("date_bought", T.DateType(), False),
    T.StructField("agent_id", ID, False),
    T.StructField("product_id", ID, False),
    T.StructField("amount_bought", T.LongType(), False),
])

SALE = T.StructType([
    T.StructField("date_sold", T.DateType(), False),
    T.StructField("product_id", ID, False),
    T.StructField("agent_id", ID, False),
    T.StructField("territory_id", ID, False),
    T.StructField("amount_sold", T.LongType(), False),
    T.StructField("price", T.LongType(), False),
])

# Invoice files are read by position; the header line is skipped, not parsed.
PURCHASE_INVOICE = T.StructType([
    T.StructField("date_bought", T.DateType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("agent_name", T.StringType(), True),
    T.StructField("amount_bought", T.LongType(), True),
])

SALE_INVOICE = T.StructType([
    T.StructField("date_sold", T.DateType(), True),
    T.StructField("product_name", T.StringType(), True),
    T.StructField("agent_name", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("district", T.StringType(), True),
    T.StructField("amount_sold", T.LongType(), True),
    T.StructField("price", T.LongType(), True),
])

# Primary keys of the fact tables (the territory is not part of a sale's key).
PURCHASE_KEY = ["date_bought", "agent_id", "product_id"]
SALE_KEY = ["date_sold", "product_id", "agent_id"]

# Maximum length of a name column (declared VARCHAR(256) in the model).
MAX_NAME_LENGTH = 256

# SQL catalog type names reported by the table exporter.
CATALOG_TYPE_NAMES = {
    "int": "integer",
    "bigint": "bigint",
    "string": "character varying",
    "date": "date",
}


def catalog_type_name(dtype: T.DataType) -> str:
    name = dtype.simpleString()
    return CATALOG_TYPE_NAMES.get(name, name)
