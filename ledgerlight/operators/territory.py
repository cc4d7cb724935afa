"""Territory sales: owner vs competitor per district, sub-totals, seller ranking.

A territory (city, district) is owned by at most one agent; unowned
territories take no part in the report.  Sales count strictly before
``as_of`` here (unlike the statistics, which are inclusive).

Plan shape: sales are filtered at the scan and reduced to one row per
(territory, seller) by partial aggregation before the first shuffle, so a
hot territory or seller never reaches a single task as raw rows.  The
owned-territory dimension joins that small aggregate.  The report is keyed
by section = (owner, city); every later step (roll-up, ranking, text) runs
on per-territory or per-seller rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlight.functions.dates import DateLike, as_date
from ledgerlight.functions.text import district_sort_key
from ledgerlight.model import Model
from ledgerlight.plans.indexing import global_row_number, row_number_within
from ledgerlight.plans.joins import maybe_broadcast

SECTION = ["owner_id", "city"]


def owned_territories(model: Model, agent_id: int | None = None) -> DataFrame:
    """Territories whose owner exists, with the owner's name (at most one row per territory).

    The territory dimension may itself be derived from large tables; a
    report that uses it several times materialises it once (see
    ``report_md.territory_markdown``).
    """
    owners = model.agent.select(F.col("agent_id").alias("owner_id"), F.col("agent_name").alias("owner_name"))
    t = model.territory.filter(F.col("agent_id").isNotNull())
    if agent_id is not None:
        t = t.filter(F.col("agent_id") == F.lit(agent_id))
    return (t.select("territory_id", F.col("agent_id").alias("owner_id"), "city", "district")
            .join(maybe_broadcast(owners), "owner_id"))


def sales_by_territory_seller(model: Model, as_of: DateLike | None = None,
                              owned: DataFrame | None = None) -> DataFrame:
    """Quantity sold per (territory, seller) strictly before ``as_of``; seller must exist.

    ``owned``, when given, keeps only its territories.  Where it is broadcast Catalyst moves
    that semi join below the aggregate, to the scan; otherwise it meets the summed rows.
    """
    day = as_date(as_of)
    per_seller = (model.sale.filter(F.col("date_sold") < F.lit(day))
                  .groupBy("territory_id", F.col("agent_id").alias("seller_id"))
                  .agg(F.sum("amount_sold").alias("qty")))
    if owned is not None:
        per_seller = per_seller.join(owned.select("territory_id"), "territory_id", "left_semi")
    sellers = model.agent.select(F.col("agent_id").alias("seller_id"), F.col("agent_name").alias("seller_name"))
    return per_seller.join(maybe_broadcast(sellers), "seller_id")


def sections(model: Model, agent_id: int | None = None, owned: DataFrame | None = None) -> DataFrame:
    """Report sections: one per (owner, city), numbered 1..n by owner id then city."""
    owned = owned if owned is not None else owned_territories(model, agent_id)
    heads = owned.select(*SECTION, "owner_name").distinct()
    # never more sections than territories
    return global_row_number(heads, [F.col("owner_id"), F.col("city")], "section_no", bounded_by=model.territory)


def district_sales(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                   per_seller: DataFrame | None = None, owned: DataFrame | None = None) -> DataFrame:
    """Every owned territory with owner / competitor / total quantity (zero when nothing sold)."""
    owned = owned if owned is not None else owned_territories(model, agent_id)
    if per_seller is None:
        per_seller = sales_by_territory_seller(model, as_of, maybe_broadcast(owned) if agent_id is not None else None)
    keyed = per_seller.join(maybe_broadcast(owned.select("territory_id", "owner_id")), "territory_id")
    own = F.when(F.col("seller_id") == F.col("owner_id"), F.col("qty")).otherwise(F.lit(0))
    other = F.when(F.col("seller_id") != F.col("owner_id"), F.col("qty")).otherwise(F.lit(0))
    split = keyed.groupBy("territory_id").agg(F.sum(own).alias("qty_own"), F.sum(other).alias("qty_competitor"))
    return (owned.join(split, "territory_id", "left")
            .select("territory_id", "owner_id", "owner_name", "city", "district",
                    F.coalesce("qty_own", F.lit(0)).cast("bigint").alias("qty_own"),
                    F.coalesce("qty_competitor", F.lit(0)).cast("bigint").alias("qty_competitor"))
            .withColumn("qty_total", F.col("qty_own") + F.col("qty_competitor")))


def _rolled(rows: DataFrame) -> DataFrame:
    """District rows and one total row per (owner, city)."""
    rolled = (rows.rollup("owner_id", "city", "district")
              .agg(F.sum("qty_own").alias("qty_own"),
                   F.sum("qty_competitor").alias("qty_competitor"),
                   F.sum("qty_total").alias("qty_total"),
                   F.grouping("city").alias("_g_city"),
                   F.grouping("district").alias("is_total"))
              .filter(F.col("_g_city") == 0)
              .drop("_g_city"))
    return rolled.select(
        "owner_id", "city", "district", F.col("is_total").cast("int").alias("is_total"),
        F.col("qty_own").cast("bigint").alias("qty_own"),
        F.col("qty_competitor").cast("bigint").alias("qty_competitor"),
        F.col("qty_total").cast("bigint").alias("qty_total"),
    )


def territory_rollup(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                     districts: DataFrame | None = None, small_limit: int | None = None) -> DataFrame:
    """District rows plus one total row per section, with the table line number.

    ``ROLLUP(owner, city, district)`` keeps the (owner, city, district) and
    (owner, city) levels; the owner-only and grand-total levels are
    dropped.  ``line_no`` orders districts by ``district_sort_key`` and puts
    the total last.
    """
    rows = districts if districts is not None else district_sales(model, as_of, agent_id)
    shaped = _rolled(rows)
    order = [F.col("is_total"), district_sort_key("district"), F.col("district")]
    # one line per territory plus one total per section: bounded by the territory table
    bound = model.territory if small_limit is None else None
    return row_number_within(shaped, SECTION, order, "line_no", small_limit=small_limit, bounded_by=bound)


def seller_ranking(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                   per_seller: DataFrame | None = None, small_limit: int | None = None,
                   owned: DataFrame | None = None) -> DataFrame:
    """Sellers in each section ranked by quantity (desc), ties by name then id."""
    owned = (owned if owned is not None else owned_territories(model, agent_id)).select("territory_id", *SECTION)
    if per_seller is None:
        per_seller = sales_by_territory_seller(model, as_of, maybe_broadcast(owned) if agent_id is not None else None)
    per_section = (per_seller.join(maybe_broadcast(owned), "territory_id")
                   .groupBy(*SECTION, "seller_id", "seller_name")
                   .agg(F.sum("qty").cast("bigint").alias("qty_sold")))
    # a section ranks distinct sellers, so it never has more rows than the agent table: a
    # per-section window is safe while that table is small; beyond it the ranks are
    # computed without putting a section in one task
    return row_number_within(per_section, SECTION,
                             [F.col("qty_sold").desc(), F.col("seller_name"), F.col("seller_id")], "rank_no",
                             small_limit=small_limit, group_bounded_by=model.agent)


def district_sales_by_name(districts: DataFrame) -> DataFrame:
    """``district_sales`` rows with districts of one owner matched by name, whatever their city.

    An owner's districts of the same name in several cities each show the sum over all of
    them; a null name matches nothing and shows zeros.
    """
    sums = ["qty_own", "qty_competitor", "qty_total"]
    names = districts.groupBy("owner_id", "district").agg(*[F.sum(c).alias(c) for c in sums])
    return (districts.drop(*sums).join(names, ["owner_id", "district"], "left")
            .select("territory_id", "owner_id", "owner_name", "city", "district",
                    *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in sums]))


def owner_rollup(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                 districts: DataFrame | None = None, small_limit: int | None = None) -> DataFrame:
    """The roll-up of an owner's whole holding: districts of all cities by name, then one total per city.

    This is the table that every section of the owner shows when sections are kept by owner
    alone; ``line_no`` counts within the owner.
    """
    rows = district_sales_by_name(districts if districts is not None else district_sales(model, as_of, agent_id))
    order = [F.col("is_total"), district_sort_key("district"), F.col("district"), F.col("city")]
    bound = model.territory if small_limit is None else None
    return row_number_within(_rolled(rows), ["owner_id"], order, "line_no", small_limit=small_limit, bounded_by=bound)


def owner_seller_ranking(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                         per_seller: DataFrame | None = None, small_limit: int | None = None,
                         owned: DataFrame | None = None) -> DataFrame:
    """Sellers per city in all cities of an owner, in one ranking per owner: by quantity, then name, id and city."""
    owned = (owned if owned is not None else owned_territories(model, agent_id)).select("territory_id", *SECTION)
    if per_seller is None:
        per_seller = sales_by_territory_seller(model, as_of, maybe_broadcast(owned) if agent_id is not None else None)
    per_city = (per_seller.join(maybe_broadcast(owned), "territory_id")
                .groupBy(*SECTION, "seller_id", "seller_name")
                .agg(F.sum("qty").cast("bigint").alias("qty_sold")))
    order = [F.col("qty_sold").desc(), F.col("seller_name"), F.col("seller_id"), F.col("city")]
    return row_number_within(per_city, ["owner_id"], order, "rank_no", small_limit=small_limit)
