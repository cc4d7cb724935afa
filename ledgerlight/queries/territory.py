"""Territory report queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerlight.catalog import AS_OF, d, model, read_raw, register, with_views
from ledgerlight.model import Model
from ledgerlight.operators import report_md, territory


def sql_quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def territory_cte(owner_filter: str = "") -> str:
    return TERRITORY_CTE_TEMPLATE.replace("{owner_filter}", owner_filter)


TERRITORY_CTE_TEMPLATE = f"""
owned AS (
  SELECT t.territory_id, t.agent_id AS owner_id, a.agent_name AS owner_name, t.city, t.district
  FROM territory t JOIN agent a ON a.agent_id = t.agent_id {{owner_filter}}
), per_seller AS (
  SELECT s.territory_id, s.agent_id AS seller_id, a.agent_name AS seller_name, sum(s.amount_sold) AS qty
  FROM sale s JOIN agent a ON a.agent_id = s.agent_id
  WHERE s.date_sold < {d(AS_OF)}
  GROUP BY s.territory_id, s.agent_id, a.agent_name
), district_sales AS (
  SELECT o.territory_id, o.owner_id, o.owner_name, o.city, o.district,
         CAST(coalesce(sum(CASE WHEN p.seller_id = o.owner_id THEN p.qty ELSE 0 END), 0) AS BIGINT) AS qty_own,
         CAST(coalesce(sum(CASE WHEN p.seller_id <> o.owner_id THEN p.qty ELSE 0 END), 0) AS BIGINT)
           AS qty_competitor
  FROM owned o LEFT JOIN per_seller p ON p.territory_id = o.territory_id
  GROUP BY o.territory_id, o.owner_id, o.owner_name, o.city, o.district
), rolled AS (
  SELECT owner_id, city, district, CAST(GROUPING(district) AS INTEGER) AS is_total,
         CAST(sum(qty_own) AS BIGINT) AS qty_own, CAST(sum(qty_competitor) AS BIGINT) AS qty_competitor,
         CAST(sum(qty_own + qty_competitor) AS BIGINT) AS qty_total
  FROM district_sales
  GROUP BY ROLLUP (owner_id, city, district)
  HAVING GROUPING(city) = 0
), rollup_lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY owner_id, city
                 ORDER BY is_total, regexp_replace(district, '[^\\p{{L}}\\p{{N}}]', '', 'g'), district) AS BIGINT)
              AS line_no
  FROM rolled
), sections AS (
  SELECT CAST(row_number() OVER (ORDER BY owner_id, city) AS BIGINT) AS section_no, owner_id, city, owner_name
  FROM (SELECT DISTINCT owner_id, city, owner_name FROM owned) x
), ranking AS (
  SELECT o.owner_id, o.city, p.seller_id, p.seller_name, CAST(sum(p.qty) AS BIGINT) AS qty_sold,
         CAST(row_number() OVER (PARTITION BY o.owner_id, o.city
                                 ORDER BY sum(p.qty) DESC, p.seller_name, p.seller_id) AS BIGINT) AS rank_no
  FROM per_seller p JOIN owned o ON o.territory_id = p.territory_id
  GROUP BY o.owner_id, o.city, p.seller_id, p.seller_name
)"""


TERRITORY_CTE = territory_cte()
LAST_OWNER_SQL = "WHERE t.agent_id = (SELECT max(agent_id) FROM territory)"


# by owner alone: nations as cities and their initials as districts, so owners have several cities and shared names
BY_OWNER_CTE = """territory_by_initial AS (
  SELECT territory_id, agent_id, district AS city, substr(district, 1, 1) AS district FROM territory
),""" + TERRITORY_CTE.replace("FROM territory t", "FROM territory_by_initial t") + """,
by_name AS (
  SELECT owner_id, district, sum(qty_own) AS qty_own, sum(qty_competitor) AS qty_competitor
  FROM district_sales GROUP BY owner_id, district
), owner_rolled AS (
  SELECT o.owner_id, o.city, o.district, CAST(GROUPING(o.district) AS INTEGER) AS is_total,
         CAST(sum(b.qty_own) AS BIGINT) AS qty_own, CAST(sum(b.qty_competitor) AS BIGINT) AS qty_competitor,
         CAST(sum(b.qty_own + b.qty_competitor) AS BIGINT) AS qty_total
  FROM district_sales o JOIN by_name b ON b.owner_id = o.owner_id AND b.district = o.district
  GROUP BY ROLLUP (o.owner_id, o.city, o.district)
  HAVING GROUPING(o.city) = 0
), owner_lines AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY owner_id
                 ORDER BY is_total, regexp_replace(district, '[^\\p{L}\\p{N}]', '', 'g'), district, city) AS BIGINT)
              AS line_no
  FROM owner_rolled
), owner_ranking AS (
  SELECT owner_id, city, seller_id, seller_name, qty_sold,
         CAST(row_number() OVER (PARTITION BY owner_id ORDER BY qty_sold DESC, seller_name, seller_id, city) AS BIGINT)
           AS rank_no
  FROM ranking
)"""


def markdown_sql(h: report_md.Headings = report_md.ENGLISH, owner_filter: str = "", by_owner: bool = False) -> str:
    parts = []
    heading = [h.title, "", *h.intro, ""]
    for i, line in enumerate(heading):
        parts.append(f"SELECT CAST(0 AS BIGINT) AS section_no, 0 AS block, CAST({i + 1} AS BIGINT) AS line_no, "
                     f"{sql_quote(line)} AS line")
    n = "CAST(section_no AS VARCHAR)"
    templates = {
        0: [f"'## ' || {n} || ') ' || city", "''", f"'### ' || {n} || {sql_quote('.1) ' + h.overall)}", "''",
            f"{sql_quote('**' + h.managed_by + ': ')} || owner_name || '**'", "''",
            sql_quote(h.table_header), sql_quote(h.table_rule)],
        2: ["''", f"'### ' || {n} || {sql_quote('.2) ' + h.individual)}", "''"],
        4: ["''"],
    }
    for block, exprs in templates.items():
        for i, expr in enumerate(exprs):
            parts.append(f"SELECT section_no, {block}, CAST({i + 1} AS BIGINT), {expr} FROM sections")
    parts.append(f"""SELECT s.section_no, 1, r.line_no,
  CASE WHEN r.is_total = 1
       THEN {sql_quote('| **' + h.total + '** | **')} || CAST(r.qty_own AS VARCHAR) || '** | **'
            || CAST(r.qty_competitor AS VARCHAR) || '** | **' || CAST(r.qty_total AS VARCHAR) || '** |'
       ELSE '| ' || r.district || ' | ' || CAST(r.qty_own AS VARCHAR) || ' | ' || CAST(r.qty_competitor AS VARCHAR)
            || ' | ' || CAST(r.qty_total AS VARCHAR) || ' |' END
FROM {"owner_lines" if by_owner else "rollup_lines"} r JOIN sections s ON s.owner_id = r.owner_id
  {"" if by_owner else "AND s.city = r.city"}""")
    parts.append(f"""SELECT s.section_no, 3, k.rank_no,
  CAST(k.rank_no AS VARCHAR) || ') ' || k.seller_name || ' - ' || CAST(k.qty_sold AS VARCHAR)
FROM {"owner_ranking" if by_owner else "ranking"} k JOIN sections s ON s.owner_id = k.owner_id
  {"" if by_owner else "AND s.city = k.city"}""")
    return with_views((BY_OWNER_CTE if by_owner else territory_cte(owner_filter)) + "\n" + "\nUNION ALL\n".join(parts))


@register("territory_district_sales", with_views(TERRITORY_CTE + """
SELECT territory_id, owner_id, owner_name, city, district, qty_own, qty_competitor,
       qty_own + qty_competitor AS qty_total
FROM district_sales"""))
def territory_district_sales(spark, sf_dir):
    return territory.district_sales(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("territory_rollup", with_views(TERRITORY_CTE + "\nSELECT * FROM rollup_lines"))
def territory_rollup(spark, sf_dir):
    return territory.territory_rollup(model(spark, sf_dir, up_to=AS_OF), AS_OF)


# one territory per customer, with names that differ in accents, case and punctuation before they differ in digits
BY_CUSTOMER_CTE = """territory_by_customer AS (
  SELECT CAST(c_custkey AS BIGINT) AS territory_id, CAST(c_nationkey % 10 + 1 AS BIGINT) AS agent_id,
         c_mktsegment AS city, CASE c_custkey % 4
           WHEN 0 THEN c_name WHEN 1 THEN replace(c_name, 'Customer', 'Cústomér')
           WHEN 2 THEN replace(c_name, 'Customer#', 'cust. omer-') ELSE replace(c_name, 'Customer', 'CUSTOMER ') END AS district
  FROM customer
), sale_by_customer AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date_sold, CAST(l.l_suppkey AS BIGINT) AS agent_id,
         CAST(o.o_custkey AS BIGINT) AS territory_id, CAST(round(l.l_quantity) AS BIGINT) AS amount_sold
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),""" + (TERRITORY_CTE.replace("FROM territory t", "FROM territory_by_customer t").replace("FROM sale s", "FROM sale_by_customer s")
         .replace("regexp_replace(district, '[^\\p{L}\\p{N}]', '', 'g')",
                  "strip_accents(lower(regexp_replace(district, '[^\\p{L}\\p{N}]', '', 'g')))"))


@register("territory_rollup_customers", with_views(BY_CUSTOMER_CTE + "\nSELECT * FROM rollup_lines"))
def territory_rollup_customers(spark, sf_dir):
    """The roll-up of one territory per customer: many lines a section, in an order that binary comparison does not give."""
    name = F.col("c_name")
    label = (F.when(F.col("c_custkey") % 4 == 0, name)
             .when(F.col("c_custkey") % 4 == 1, F.replace(name, F.lit("Customer"), F.lit("Cústomér")))
             .when(F.col("c_custkey") % 4 == 2, F.replace(name, F.lit("Customer#"), F.lit("cust. omer-")))
             .otherwise(F.replace(name, F.lit("Customer"), F.lit("CUSTOMER "))))
    territories = read_raw(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("bigint").alias("territory_id"),
        (F.col("c_nationkey") % 10 + 1).cast("bigint").alias("agent_id"),
        F.col("c_mktsegment").alias("city"), label.alias("district"))
    sales = (read_raw(spark, sf_dir, "lineitem").join(read_raw(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
             .select(F.to_date("l_shipdate").alias("date_sold"), F.col("l_suppkey").cast("bigint").alias("agent_id"),
                     F.col("o_custkey").cast("bigint").alias("territory_id"),
                     F.round("l_quantity").cast("bigint").alias("amount_sold")))
    m = replace(model(spark, sf_dir, up_to=AS_OF), territory=territories, sale=sales)
    return territory.territory_rollup(m, AS_OF)


@register("territory_sections", with_views(TERRITORY_CTE + "\nSELECT * FROM sections"))
def territory_sections(spark, sf_dir):
    return territory.sections(model(spark, sf_dir, up_to=AS_OF))


@register("seller_ranking", with_views(TERRITORY_CTE + "\nSELECT * FROM ranking"))
def seller_ranking(spark, sf_dir):
    return territory.seller_ranking(model(spark, sf_dir, up_to=AS_OF), AS_OF)


@register("territory_markdown", markdown_sql())
def territory_markdown(spark, sf_dir):
    return report_md.territory_markdown(model(spark, sf_dir, up_to=AS_OF), AS_OF)


def last_owner(m) -> int:
    """Highest owner id among the territories (a single aggregated value)."""
    return int(m.territory.agg(F.max("agent_id").alias("o")).first()["o"])


@register("territory_markdown_one", markdown_sql(owner_filter=LAST_OWNER_SQL))
def territory_markdown_one(spark, sf_dir):
    m = model(spark, sf_dir, up_to=AS_OF)
    return report_md.territory_markdown(m, AS_OF, agent_id=last_owner(m))


def by_initial(m):
    """The model with nations as cities and their initials as districts."""
    t = m.territory.select("territory_id", "agent_id", F.col("district").alias("city"),
                           F.substring("district", 1, 1).alias("district"))
    return Model(agent=m.agent, product=m.product, territory=t, purchase=m.purchase, sale=m.sale)


@register("owner_rollup", with_views(BY_OWNER_CTE + "\nSELECT * FROM owner_lines"))
def owner_rollup(spark, sf_dir):
    return territory.owner_rollup(by_initial(model(spark, sf_dir, up_to=AS_OF)), AS_OF)


@register("owner_seller_ranking", with_views(BY_OWNER_CTE + "\nSELECT * FROM owner_ranking"))
def owner_seller_ranking(spark, sf_dir):
    return territory.owner_seller_ranking(by_initial(model(spark, sf_dir, up_to=AS_OF)), AS_OF)


@register("territory_markdown_owner", markdown_sql(by_owner=True))
def territory_markdown_owner(spark, sf_dir):
    return report_md.territory_markdown(by_initial(model(spark, sf_dir, up_to=AS_OF)), AS_OF, by_owner=True)
