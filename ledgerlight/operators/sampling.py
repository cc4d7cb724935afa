"""Seeded sampling and noise over the history (re-expressed seeding queries).

* ``sample_products_per_agent_month``: for every (agent, month) with
  purchases, keep a pseudo-random 1..``max_k`` of the products bought
  (the group's k is itself drawn from the seed), i.e. ORDER BY random
  LIMIT k per group.  One window pass while the product table bounds every
  group (a group holds distinct products), else a salted two-phase top-k
  so a hot group is ranked in pieces.
* ``random_rows``: ORDER BY random LIMIT k over a whole frame, without sorting it: only
  rows with a key below a limit that lets about 2k pass are sorted, and the limit is
  raised when fewer than k do.
* ``random_territory_per_owner``: one pseudo-random territory of each owner, as the
  minimum of (key, id) in a plain aggregate, so a hot owner is combined map-side.
* ``agent_month_grid``: every agent x month of a calendar series with what
  the agent bought that month (zeros when it skipped the month).
* ``restock_revenue``: the revenue of selling each outstanding pair's stock
  at a noisy price, ``round_half_even(unit_price * qty * f / 1000)`` with
  ``f`` drawn from [600, 1500] per mille, in exact integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.functions.dates import DateLike, as_date, shift_months
from ledgerlight.functions.random import MODULUS, day_number, month_number, rand_key
from ledgerlight.model import Model
from ledgerlight.operators.stock import outstanding_stock
from ledgerlight.plans.indexing import top_k_per_group
from ledgerlight.plans.joins import maybe_broadcast


def sample_products_per_agent_month(model: Model, seed: int = 7, max_k: int = 7,
                                    salt_buckets: int = 16, always_salt: bool = False) -> DataFrame:
    bought = (model.purchase
              .withColumn("month", F.trunc("date_bought", "month"))
              .groupBy("agent_id", "month", "product_id")
              .agg(F.sum("amount_bought").cast("bigint").alias("qty")))
    keyed = bought.withColumn("_ll_rand", rand_key(seed, F.col("agent_id"), month_number(F.col("month")),
                                                 F.col("product_id")))
    # a group holds distinct products: bounded by the product table when that is small
    top = top_k_per_group(keyed, ["agent_id", "month"], [F.col("_ll_rand"), F.col("product_id")], max_k,
                          salt=F.col("product_id"), salt_buckets=salt_buckets, rank_name="pick_no",
                          group_bounded_by=None if always_salt else model.product)
    group_k = F.lit(1) + rand_key(seed + 1, F.col("agent_id"), month_number(F.col("month"))) % F.lit(max_k)
    return (top.filter(F.col("pick_no") <= group_k)
            .select("agent_id", "month", "product_id", "qty", F.col("pick_no").cast("bigint").alias("pick_no")))


def random_rows(df: DataFrame, k: int, seed: int, key_cols: list[str]) -> DataFrame:
    """``k`` pseudo-random rows of ``df`` (all, if fewer), with their place ``pick_no``.

    ``key_cols`` (non-negative integers) draw the order; equal keys are ordered by the other
    columns.  The rows that pass the limit are counted until ``k`` do, two counts as a rule.
    """
    keyed = df.withColumn("_ll_rand", rand_key(seed, *[F.col(c) for c in key_cols]))
    total = df.count()
    share, some = min(1.0, 2 * k / max(total, 1)), keyed
    while share < 1:
        some = keyed.filter(F.col("_ll_rand") < int(share * MODULUS))
        if some.count() >= k:
            break
        some, share = keyed, share * 8
    picked = some.orderBy("_ll_rand", *df.columns).limit(k)  # a top-k per task, then of those
    number = F.row_number().over(Window.orderBy("_ll_rand", *df.columns)).cast("bigint")  # k rows
    return picked.withColumn("pick_no", number).drop("_ll_rand")


def random_territory_per_owner(model: Model, seed: int = 13) -> DataFrame:
    """One territory of each owner, drawn by seed."""
    owned = model.territory.filter(F.col("agent_id").isNotNull())
    draw = F.min(F.struct(rand_key(seed, F.col("agent_id"), F.col("territory_id")).alias("r"), "territory_id", "city", "district"))
    return owned.groupBy("agent_id").agg(draw.alias("d")).select("agent_id", "d.territory_id", "d.city", "d.district")


def agent_month_grid(model: Model, start: DateLike, months: int) -> DataFrame:
    first = as_date(start).replace(day=1)
    last = shift_months(first, months - 1)
    grid = model.agent.select(
        "agent_id", F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    activity = (model.purchase
                .filter((F.col("date_bought") >= F.lit(first)) & (F.col("date_bought") < F.lit(shift_months(last, 1))))
                .groupBy("agent_id", F.trunc("date_bought", "month").alias("month"))
                .agg(F.countDistinct("product_id").cast("bigint").alias("n_products"),
                     F.sum("amount_bought").cast("bigint").alias("qty")))
    return (grid.join(activity, ["agent_id", "month"], "left")
            .select("month", "agent_id",
                    F.coalesce("n_products", F.lit(0)).cast("bigint").alias("n_products"),
                    F.coalesce("qty", F.lit(0)).cast("bigint").alias("qty")))


def noisy_price(unit_price: F.Column, qty: F.Column, permille: F.Column) -> F.Column:
    """round_half_even(unit_price * qty * permille / 1000) on integers."""
    x = unit_price.cast("bigint") * qty.cast("bigint") * permille.cast("bigint")
    r = F.pmod(x, F.lit(1000))
    q = ((x - r) / F.lit(1000)).cast("bigint")  # exact: x - r is a multiple of 1000
    up = (r > 500) | ((r == 500) & (q % 2 == 1))
    return q + F.when(up, F.lit(1)).otherwise(F.lit(0))


def restock_revenue(model: Model, as_of: DateLike | None = None, seed: int = 11) -> DataFrame:
    day = as_date(as_of)
    stock = outstanding_stock(model, day)
    prices = maybe_broadcast(model.product.select("product_id", "unit_price"))
    permille = F.lit(600) + rand_key(seed, F.col("agent_id"), F.col("product_id"), day_number(F.lit(day))) % F.lit(901)
    return (stock.join(prices, "product_id")
            .select("agent_id", "product_id", "debt", permille.cast("bigint").alias("price_permille"),
                    noisy_price(F.col("unit_price"), F.col("debt"), permille).alias("revenue")))
