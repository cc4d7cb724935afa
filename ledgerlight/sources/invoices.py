"""Monthly invoice files (CSV) and their staging frames.

Invoices are comma separated with one header line; columns are taken by
position under a fixed schema (the header's own spelling is ignored).  A malformed
row fails the whole read, as a bulk load would, or (``malformed="reject"``) arrives
with its text in ``MALFORMED``, for the checks to reject; so one bad line can't stop
a stream for good.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlight.model import Model
from ledgerlight.plans.joins import maybe_broadcast
from ledgerlight.schema import PURCHASE_INVOICE, SALE_INVOICE

CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "mode": "FAILFAST",
    "encoding": "UTF-8",
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


MALFORMED = "_malformed"  # text of a line that does not fit the schema, else null


def _reader(reader, schema: StructType, malformed: str):
    if malformed not in ("fail", "reject"):
        raise ValueError("malformed must be 'fail' or 'reject'")
    if malformed == "fail":
        return reader.schema(schema).options(**CSV_OPTIONS)
    return (reader.schema(StructType([*schema.fields, StructField(MALFORMED, StringType())]))
            .options(**{**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}))


def read_purchase_invoice(spark: SparkSession, path: str | list[str], malformed: str = "fail") -> DataFrame:
    return _reader(spark.read, PURCHASE_INVOICE, malformed).csv(path)


def read_sale_invoice(spark: SparkSession, path: str | list[str], malformed: str = "fail") -> DataFrame:
    return _reader(spark.read, SALE_INVOICE, malformed).csv(path)


def stream_invoice(spark: SparkSession, kind: str, directory: str, files_per_batch: int | None = None,
                   malformed: str = "fail") -> DataFrame:
    """A file stream of invoices, oldest files first; ``files_per_batch`` bounds a micro-batch."""
    reader = _reader(spark.readStream, PURCHASE_INVOICE if kind == "purchase" else SALE_INVOICE, malformed)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(directory)


def purchase_stage(model: Model) -> DataFrame:
    """Purchases as an invoice would list them (names instead of keys)."""
    agents = maybe_broadcast(model.agent.select("agent_id", "agent_name"))
    products = maybe_broadcast(model.product.select("product_id", "product_name"))
    return (model.purchase.join(agents, "agent_id").join(products, "product_id")
            .select("date_bought", "product_name", "agent_name", "amount_bought"))


def sale_stage(model: Model) -> DataFrame:
    """Sales as an invoice would list them (names and city/district instead of keys)."""
    agents = maybe_broadcast(model.agent.select("agent_id", "agent_name"))
    products = maybe_broadcast(model.product.select("product_id", "product_name"))
    places = maybe_broadcast(model.territory.select("territory_id", "city", "district"))
    return (model.sale.join(agents, "agent_id").join(products, "product_id").join(places, "territory_id")
            .select("date_sold", "product_name", "agent_name", "city", "district", "amount_sold", "price"))


def write_invoice(stage: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """Write a stage frame as invoice CSV files (header in every part file); the readers take compressed files too."""
    (stage.write.mode(mode).option("header", "true").option("dateFormat", "yyyy-MM-dd")
     .option("compression", compression).csv(path))
