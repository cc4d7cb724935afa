"""XML export queries."""

from __future__ import annotations

from ledgerlight.catalog import model, register, with_views
from ledgerlight.operators import report_xml

# Column layout of the model tables, as the oracle sees them.
ORACLE_COLUMNS = {
    "agent": [("agent_id", "bigint"), ("agent_name", "character varying"), ("release_date", "date")],
    "product": [("product_id", "bigint"), ("product_name", "character varying"), ("unit_price", "bigint")],
    "territory": [("territory_id", "bigint"), ("agent_id", "bigint"), ("city", "character varying"),
                  ("district", "character varying")],
}
EXPORT_PAIRS: list[tuple[str, int | None]] = [("agent", None), ("territory", None), ("product", 5)]


def _esc(expr: str) -> str:
    return f"replace(replace(replace(CAST({expr} AS VARCHAR), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def row_sql(name: str, row_id: int | None) -> str:
    cells = " || ".join(
        f"CASE WHEN {c} IS NULL THEN '<{c} xsi:nil=\"true\"/>' ELSE '<{c}>' || {_esc(c)} || '</{c}>' END"
        for c, _ in ORACLE_COLUMNS[name])
    where = "" if row_id is None else f" WHERE {name}_id = {row_id}"
    return f"SELECT CAST({name}_id AS BIGINT) AS row_key, '<row>' || {cells} || '</row>' AS line FROM {name}{where}"


def export_sql(pairs: list[tuple[str, int | None]]) -> str:
    parts = ["SELECT 0 AS pos, 0 AS block, CAST(NULL AS BIGINT) AS row_key, '<tables>' AS line",
             f"SELECT {len(pairs) + 1}, 0, NULL, '</tables>'"]
    for i, (name, row_id) in enumerate(pairs, start=1):
        shown = "ALL" if row_id is None else str(row_id)
        cols = "".join(f"<column>{c} - {t}</column>" for c, t in ORACLE_COLUMNS[name])
        parts += [
            f"SELECT {i}, 0, NULL, '<{name}><!--Data for table: {name}. And ID = {shown}-->'",
            f"SELECT {i}, 1, NULL, '<info data=\"{name}_table_info\"><tablename>{name}</tablename><tablecols>"
            f"{cols}</tablecols><num_of_rows>' || CAST(count(*) AS VARCHAR) || '</num_of_rows></info>' FROM {name}",
            f"SELECT {i}, 2, NULL, '<table xmlns:xsi=\"http://www.w3.org/2001/XMLSchema-instance\">'",
            f"SELECT {i}, 3, row_key, line FROM ({row_sql(name, row_id)}) r{i}",
            f"SELECT {i}, 4, NULL, '</table>'",
            f"SELECT {i}, 5, NULL, '</{name}>'",
        ]
    return with_views("\nUNION ALL\n".join(parts))


COUNTED = ["agent", "product", "territory", "purchase", "sale"]


@register("table_count", with_views("\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM {n}" for n in COUNTED)))
def table_count(spark, sf_dir):
    return report_xml.table_counts(model(spark, sf_dir).tables(), COUNTED)


@register("table_rows_xml", with_views(row_sql("territory", None)))
def table_rows_xml(spark, sf_dir):
    return report_xml.table_rows(model(spark, sf_dir).tables(), "territory")


@register("table_rows_xml_one", with_views(row_sql("product", 5)))
def table_rows_xml_one(spark, sf_dir):
    return report_xml.table_rows(model(spark, sf_dir).tables(), "product", 5)


@register("tables_xml", export_sql(EXPORT_PAIRS))
def tables_xml(spark, sf_dir):
    return report_xml.tables_xml(spark, model(spark, sf_dir).tables(), EXPORT_PAIRS)
