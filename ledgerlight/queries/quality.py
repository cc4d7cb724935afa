"""Data-quality queries (K1-K6, Q9)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerlight.catalog import model, read_raw, register, with_views
from ledgerlight.operators import ingest, quality
from ledgerlight.schema import PURCHASE_KEY, SALE_KEY
from ledgerlight.sources import invoices

CASCADE_AGENT = 0


@register("duplicate_keys", with_views("""
SELECT 'purchase' AS table_name, date_bought AS key_date, agent_id, product_id, CAST(count(*) AS BIGINT) AS n_rows
FROM purchase GROUP BY 1, 2, 3, 4 HAVING count(*) > 1
UNION ALL
SELECT 'sale', date_sold, agent_id, product_id, CAST(count(*) AS BIGINT)
FROM sale GROUP BY 1, 2, 3, 4 HAVING count(*) > 1"""))
def duplicate_keys(spark, sf_dir):
    m = model(spark, sf_dir)
    cols = ["table_name", "key_date", "agent_id", "product_id", "n_rows"]
    p = (quality.duplicate_keys(m.purchase, PURCHASE_KEY)
         .select(F.lit("purchase").alias("table_name"), F.col("date_bought").alias("key_date"),
                 "agent_id", "product_id", "n_rows"))
    s = (quality.duplicate_keys(m.sale, SALE_KEY)
         .select(F.lit("sale").alias("table_name"), F.col("date_sold").alias("key_date"),
                 "agent_id", "product_id", "n_rows"))
    return p.unionByName(s).select(*cols)


@register("sale_stage_rejects", with_views("""
sale_stage AS (
  SELECT s.date_sold, p.product_name, a.agent_name, t.city, t.district, s.amount_sold, s.price,
         s.agent_id, s.product_id, s.territory_id
  FROM sale s JOIN agent a ON a.agent_id = s.agent_id JOIN product p ON p.product_id = s.product_id
  JOIN territory t ON t.territory_id = s.territory_id
), counted AS (
  SELECT *, count(*) OVER (PARTITION BY date_sold, product_id, agent_id) AS n FROM sale_stage
)
SELECT date_sold, product_name, agent_name, city, district, amount_sold, price, agent_id, product_id, territory_id,
       CASE WHEN length(product_name) > 256 OR length(agent_name) > 256 OR length(city) > 256
                 OR length(district) > 256 THEN 'name too long; ' ELSE '' END || 'duplicate key in batch' AS reason
FROM counted WHERE n > 1"""))
def sale_stage_rejects(spark, sf_dir):
    m = model(spark, sf_dir)
    flagged = quality.flag_sales(ingest.resolve_sales(invoices.sale_stage(m), m))
    return flagged.filter(F.col(quality.REASON).isNotNull())


@register("orphan_rows", with_views("""
SELECT 'purchase' AS table_name, 'unknown agent' AS reason, agent_id, product_id,
       CAST(NULL AS BIGINT) AS territory_id, date_bought AS row_date
FROM purchase WHERE agent_id NOT IN (SELECT agent_id FROM agent)
UNION ALL SELECT 'purchase', 'unknown product', agent_id, product_id, NULL, date_bought
FROM purchase WHERE product_id NOT IN (SELECT product_id FROM product)
UNION ALL SELECT 'sale', 'unknown agent', agent_id, product_id, territory_id, date_sold
FROM sale WHERE agent_id NOT IN (SELECT agent_id FROM agent)
UNION ALL SELECT 'sale', 'unknown product', agent_id, product_id, territory_id, date_sold
FROM sale WHERE product_id NOT IN (SELECT product_id FROM product)
UNION ALL SELECT 'sale', 'unknown territory', agent_id, product_id, territory_id, date_sold
FROM sale WHERE territory_id NOT IN (SELECT territory_id FROM territory)
UNION ALL SELECT 'territory', 'unknown owner', agent_id, NULL, territory_id, NULL
FROM territory WHERE agent_id IS NOT NULL AND agent_id NOT IN (SELECT agent_id FROM agent)"""))
def orphan_rows(spark, sf_dir):
    return quality.orphan_rows(model(spark, sf_dir))


LOST_AGENT, LOST_PRODUCT, LOST_TERRITORY = 7, 5, 3


@register("orphan_rows_found", with_views(f"""
SELECT 'purchase' AS table_name, 'unknown agent' AS reason, agent_id, product_id,
       CAST(NULL AS BIGINT) AS territory_id, date_bought AS row_date FROM purchase WHERE agent_id = {LOST_AGENT}
UNION ALL SELECT 'purchase', 'unknown product', agent_id, product_id, NULL, date_bought
FROM purchase WHERE product_id = {LOST_PRODUCT}
UNION ALL SELECT 'sale', 'unknown agent', agent_id, product_id, territory_id, date_sold FROM sale WHERE agent_id = {LOST_AGENT}
UNION ALL SELECT 'sale', 'unknown product', agent_id, product_id, territory_id, date_sold
FROM sale WHERE product_id = {LOST_PRODUCT}
UNION ALL SELECT 'sale', 'unknown territory', agent_id, product_id, territory_id, date_sold
FROM sale WHERE territory_id = {LOST_TERRITORY}
UNION ALL SELECT 'territory', 'unknown owner', agent_id, NULL, territory_id, NULL
FROM territory WHERE agent_id = {LOST_AGENT} AND territory_id <> {LOST_TERRITORY}"""))
def orphan_rows_found(spark, sf_dir):
    """Dimension rows taken out without their facts: every kind of orphan is found."""
    m = model(spark, sf_dir)
    return quality.orphan_rows(replace(m, agent=m.agent.filter(F.col("agent_id") != LOST_AGENT),
                                       product=m.product.filter(F.col("product_id") != LOST_PRODUCT),
                                       territory=m.territory.filter(F.col("territory_id") != LOST_TERRITORY)))


@register("dimension_duplicate_names", with_views("""
SELECT 'agent' AS table_name, agent_name AS name, CAST(count(*) AS BIGINT) AS n_rows
FROM agent GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT 'product', product_name, CAST(count(*) AS BIGINT) FROM product GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT 'territory', city || '/' || district, CAST(count(*) AS BIGINT)
FROM territory GROUP BY 1, 2 HAVING count(*) > 1"""))
def dimension_duplicate_names(spark, sf_dir):
    m = model(spark, sf_dir)
    a = quality.duplicate_names(m.agent, ["agent_name"]).select(
        F.lit("agent").alias("table_name"), F.col("agent_name").alias("name"), "n_rows")
    p = quality.duplicate_names(m.product, ["product_name"]).select(
        F.lit("product").alias("table_name"), F.col("product_name").alias("name"), "n_rows")
    t = quality.duplicate_names(m.territory, ["city", "district"]).select(
        F.lit("territory").alias("table_name"), F.concat("city", F.lit("/"), "district").alias("name"), "n_rows")
    return a.unionByName(p).unionByName(t)


@register("surrogate_keys", with_views("""
new_names AS (
  SELECT DISTINCT c_name AS agent_name FROM customer
  WHERE c_name IS NOT NULL AND c_name NOT IN (SELECT agent_name FROM agent)
)
SELECT agent_name, CAST((SELECT max(agent_id) FROM agent) + row_number() OVER (ORDER BY agent_name) AS BIGINT)
         AS agent_id
FROM new_names"""))
def surrogate_keys(spark, sf_dir):
    customers = read_raw(spark, sf_dir, "customer").select(F.col("c_name").alias("agent_name"))
    return quality.assign_keys(customers, model(spark, sf_dir).agent, "agent_name", "agent_id")


@register("cascade_delete_counts", with_views(f"""
gone_places AS (SELECT territory_id FROM territory WHERE agent_id = {CASCADE_AGENT})
SELECT 'agent' AS table_name, CAST(count(*) AS BIGINT) AS n_deleted FROM agent WHERE agent_id = {CASCADE_AGENT}
UNION ALL SELECT 'territory', CAST(count(*) AS BIGINT) FROM territory WHERE agent_id = {CASCADE_AGENT}
UNION ALL SELECT 'purchase', CAST(count(*) AS BIGINT) FROM purchase WHERE agent_id = {CASCADE_AGENT}
UNION ALL SELECT 'sale', CAST(count(*) AS BIGINT) FROM sale
  WHERE agent_id = {CASCADE_AGENT} OR territory_id IN (SELECT territory_id FROM gone_places)"""))
def cascade_delete_counts(spark, sf_dir):
    return quality.cascade_delete_agent(model(spark, sf_dir), CASCADE_AGENT)[1]


CASCADE_PRODUCT, CASCADE_TERRITORY = 1, 1


def _counts_sql(column: str, value: int, tables: list[str]) -> str:
    return with_views("\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n_deleted FROM {t} WHERE {column} = {value}"
        for t in tables))


@register("cascade_delete_product", _counts_sql("product_id", CASCADE_PRODUCT, ["product", "purchase", "sale"]))
def cascade_delete_product(spark, sf_dir):
    return quality.cascade_delete_product(model(spark, sf_dir), CASCADE_PRODUCT)[1]


@register("cascade_delete_territory", _counts_sql("territory_id", CASCADE_TERRITORY, ["territory", "sale"]))
def cascade_delete_territory(spark, sf_dir):
    return quality.cascade_delete_territory(model(spark, sf_dir), CASCADE_TERRITORY)[1]
