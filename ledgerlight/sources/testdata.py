"""Map the generated star-schema tables onto the consignment model.

=========  ===============================================================
agent      supplier: s_suppkey -> agent_id, s_name -> agent_name
product    part: p_partkey, ``p_name || '#' || p_partkey`` (p_name alone
           repeats), unit price in cents ``round(p_retailprice * 100)``
purchase   lineitem x orders: one row per (order date, supplier, part),
           quantity summed
sale       lineitem x orders x customer: ship date,
           part, supplier, the customer's nation as territory, quantity,
           revenue in cents ``round(l_extendedprice * 100)``
territory  nation x region: nation -> district, region -> city; the owner
           of a region's districts is the lowest supplier key located in it
=========  ===============================================================

Everything is lazy; only the columns a query touches are read (Catalyst
prunes the rest at the Parquet scan).  The two fact adapters are the only
big joins (lineitem with orders on the order key, then customer on the
customer key); at production scale write them once with
``Warehouse.materialize`` and point the queries at the written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.model import Model
from ledgerlight.plans.joins import broadcast_limit, estimated_size_bytes
from ledgerlight.plans.session import scale_partitions

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


_FRAMES: dict[tuple[int, str], tuple[SparkSession, DataFrame]] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy frame of one generated table, reused per live session (the files are read-only).

    Reusing the frame skips a repeated file listing and footer read; it
    holds no data.  The entry keeps its session, so a frame is only handed
    back to that same, still running session.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    hit = _FRAMES.get(key)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    frame = spark.read.parquet(path)
    _FRAMES[key] = (spark, frame)
    return frame


def cents(c: F.Column) -> F.Column:
    return F.round(c * F.lit(100)).cast("bigint")


def agent_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("bigint").alias("agent_id"),
        F.col("s_name").alias("agent_name"),
        F.lit(None).cast("date").alias("release_date"),
    )


def product_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("bigint").alias("product_id"),
        F.concat(F.col("p_name"), F.lit("#"), F.col("p_partkey").cast("string")).alias("product_name"),
        cents(F.col("p_retailprice")).alias("unit_price"),
    )


def territory_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    supplier = read_table(spark, sf_dir, "supplier")
    # lowest supplier per nation first (partial aggregation), then per region
    per_nation = supplier.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first_supplier"))
    owners = (per_nation.join(nation, per_nation.s_nationkey == nation.n_nationkey)
              .groupBy("n_regionkey").agg(F.min("first_supplier").cast("bigint").alias("owner_id")))
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .join(owners, "n_regionkey", "left")
            .select(
                F.col("n_nationkey").cast("bigint").alias("territory_id"),
                F.col("owner_id").alias("agent_id"),
                F.col("r_name").alias("city"),
                F.col("n_name").alias("district"),
            ))


def purchase_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return (li.join(orders, li.l_orderkey == orders.o_orderkey)
            .groupBy(
                F.to_date("o_orderdate").alias("date_bought"),
                F.col("l_suppkey").cast("bigint").alias("agent_id"),
                F.col("l_partkey").cast("bigint").alias("product_id"),
            )
            .agg(F.sum(F.round("l_quantity").cast("bigint")).alias("amount_bought")))


def sale_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = (read_table(spark, sf_dir, "lineitem")
          .select("l_orderkey", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # the two small tables first: lineitem's rows are shuffled once, by the order
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    size = estimated_size_bytes(orders)  # a buyer is a row of two keys, as an order is; Spark has no estimate of the join
    if size is not None and 0 <= size <= broadcast_limit(orders):
        buyers = F.broadcast(buyers)
    return (li.join(buyers, li.l_orderkey == F.col("o_orderkey"))
            .select(
                F.to_date("l_shipdate").alias("date_sold"),
                F.col("l_partkey").cast("bigint").alias("product_id"),
                F.col("l_suppkey").cast("bigint").alias("agent_id"),
                F.col("c_nationkey").cast("bigint").alias("territory_id"),
                F.round("l_quantity").cast("bigint").alias("amount_sold"),
                cents(F.col("l_extendedprice")).alias("price"),
            ))


def load_model(spark: SparkSession, sf_dir: str) -> Model:
    facts = [estimated_size_bytes(read_table(spark, sf_dir, t)) or 0 for t in ("lineitem", "orders")]
    scale_partitions(spark, sum(facts))
    return Model(
        agent=agent_frame(spark, sf_dir),
        product=product_frame(spark, sf_dir),
        territory=territory_frame(spark, sf_dir),
        purchase=purchase_frame(spark, sf_dir),
        sale=sale_frame(spark, sf_dir),
    )


# SQL text of the same mapping, used by the DuckDB oracle queries.
ORACLE_VIEWS = """
WITH agent AS (
  SELECT CAST(s_suppkey AS BIGINT) AS agent_id, s_name AS agent_name, CAST(NULL AS DATE) AS release_date
  FROM supplier
), product AS (
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name || '#' || CAST(p_partkey AS VARCHAR) AS product_name,
         CAST(round(p_retailprice * 100) AS BIGINT) AS unit_price
  FROM part
), territory AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS territory_id, o.owner_id AS agent_id, r.r_name AS city, n.n_name AS district
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT n2.n_regionkey, CAST(min(s.s_suppkey) AS BIGINT) AS owner_id
             FROM supplier s JOIN nation n2 ON s.s_nationkey = n2.n_nationkey
             GROUP BY n2.n_regionkey) o ON o.n_regionkey = n.n_regionkey
), purchase AS (
  SELECT CAST(o.o_orderdate AS DATE) AS date_bought, CAST(l.l_suppkey AS BIGINT) AS agent_id,
         CAST(l.l_partkey AS BIGINT) AS product_id, CAST(sum(CAST(round(l.l_quantity) AS BIGINT)) AS BIGINT) AS amount_bought
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  GROUP BY 1, 2, 3
), sale AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date_sold, CAST(l.l_partkey AS BIGINT) AS product_id,
         CAST(l.l_suppkey AS BIGINT) AS agent_id, CAST(c.c_nationkey AS BIGINT) AS territory_id,
         CAST(round(l.l_quantity) AS BIGINT) AS amount_sold, CAST(round(l.l_extendedprice * 100) AS BIGINT) AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
)"""
