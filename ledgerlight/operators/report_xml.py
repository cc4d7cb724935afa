"""XML export of chosen tables with catalog metadata.

For each requested (table, id) pair, in argument order, the export holds a
comment naming the table and id (``ALL`` when no id is given), an
``<info>`` element with the table name, its columns and types and the row
count of the *whole* table, and a ``<table>`` element with one ``<row>``
per selected row.  NULL values are written as ``<col xsi:nil="true"/>``.
The result is a frame of lines ordered by (pos, block, row_key); rows are
rendered on the executors, so the export scales with the tables.

Only tables registered by name can be exported (no SQL is ever built from
the name); an id filter needs a ``<table>_id`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlight.functions.text import xml_escape_py, xml_text
from ledgerlight.schema import catalog_type_name

XSI_NS = "http://www.w3.org/2001/XMLSchema-instance"
LINE_COLUMNS = ["pos", "block", "row_key", "line"]

# Element names of the export (unquoted SQL names fold to lower case).
ROOT = "tables"
INFO = "info"
TABLE_NAME = "tablename"
TABLE_COLS = "tablecols"
COLUMN = "column"
NUM_ROWS = "num_of_rows"
TABLE = "table"
ROW = "row"


def key_column(name: str) -> str:
    return f"{name}_id"


def select_rows(tables: dict[str, DataFrame], name: str, row_id: int | None) -> DataFrame:
    if name not in tables:
        raise KeyError(f"unknown table {name!r}; known: {sorted(tables)}")
    df = tables[name]
    if row_id is None:
        return df
    key = key_column(name)
    if key not in df.columns:
        raise ValueError(f"table {name!r} has no {key} column to filter by")
    return df.filter(F.col(key) == F.lit(row_id))


def row_xml(df: DataFrame) -> Column:
    """``<row><c>v</c>...</row>`` with xsi:nil for NULLs."""
    cells = []
    for c in df.columns:
        value = F.concat(F.lit(f"<{c}>"), xml_text(F.col(c)), F.lit(f"</{c}>"))
        cells.append(F.when(F.col(c).isNull(), F.lit(f'<{c} xsi:nil="true"/>')).otherwise(value))
    return F.concat(F.lit(f"<{ROW}>"), *cells, F.lit(f"</{ROW}>"))


def table_rows(tables: dict[str, DataFrame], name: str, row_id: int | None = None) -> DataFrame:
    """(row_key, line) for every selected row of one table."""
    df = select_rows(tables, name, row_id)
    key = key_column(name)
    row_key = F.col(key).cast("bigint") if key in df.columns else F.lit(None).cast("bigint")
    return df.select(row_key.alias("row_key"), row_xml(df).alias("line"))


def column_lines(df: DataFrame) -> list[str]:
    return [f"<{COLUMN}>{xml_escape_py(f.name)} - {catalog_type_name(f.dataType)}</{COLUMN}>"
            for f in df.schema.fields]


def table_counts(tables: dict[str, DataFrame], names: list[str]) -> DataFrame:
    """(table_name, n_rows) of whole tables, one aggregate per table."""
    parts = [tables[n].agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
             .select(F.lit(n).alias("table_name"), "n_rows") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def tables_xml(spark: SparkSession, tables: dict[str, DataFrame],
               pairs: list[tuple[str, int | None]]) -> DataFrame:
    """Lines of the export document (see module docstring)."""
    if not pairs:
        return spark.createDataFrame([(0, 0, None, f"<{ROOT}/>")],
                                     "pos int, block int, row_key bigint, line string")
    static: list[tuple[int, int, int | None, str]] = [(0, 0, None, f"<{ROOT}>"), (len(pairs) + 1, 0, None,
                                                                                 f"</{ROOT}>")]
    frames: list[DataFrame] = []
    for i, (name, row_id) in enumerate(pairs, start=1):
        rows = table_rows(tables, name, row_id)  # validates name and id column
        shown = "ALL" if row_id is None else str(row_id)
        static.append((i, 0, None, f"<{name}><!--Data for table: {name}. And ID = {shown}-->"))
        static.append((i, 2, None, f'<{TABLE} xmlns:xsi="{XSI_NS}">'))
        static.append((i, 4, None, f"</{TABLE}>"))
        static.append((i, 5, None, f"</{name}>"))
        info_head = (f'<{INFO} data="{xml_escape_py(name + "_table_info", True)}">'
                     f"<{TABLE_NAME}>{name}</{TABLE_NAME}><{TABLE_COLS}>"
                     + "".join(column_lines(tables[name])) + f"</{TABLE_COLS}><{NUM_ROWS}>")
        count = tables[name].agg(F.count(F.lit(1)).alias("n"))
        frames.append(count.select(
            F.lit(i).alias("pos"), F.lit(1).alias("block"), F.lit(None).cast("bigint").alias("row_key"),
            F.concat(F.lit(info_head), F.col("n").cast("string"), F.lit(f"</{NUM_ROWS}></{INFO}>")).alias("line")))
        frames.append(rows.select(F.lit(i).alias("pos"), F.lit(3).alias("block"), "row_key", "line"))
    out = spark.createDataFrame(static, "pos int, block int, row_key bigint, line string")
    for f in frames:
        out = out.unionByName(f)
    return out


def ordered_lines(lines: DataFrame) -> DataFrame:
    return lines.orderBy("pos", "block", "row_key", "line")


def write_xml(lines: DataFrame, path: str) -> None:
    """Write the document as ordered text part files (concatenate in name order)."""
    ordered_lines(lines).select("line").write.mode("overwrite").text(path)
