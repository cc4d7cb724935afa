"""Outstanding stock per (agent, product): what is still unsold at a date.

Both sides count strictly before the date and purchases are not lagged
(unlike the statistics).  A pair appears once it has a purchase before the
date; its sales before that date all count, and pairs with nothing left
(``debt <= 0``) are skipped.

The monthly form evaluates the same quantity at every month start of a
series without re-scanning history per month: each purchase / sale row is
assigned the first month start at which it counts, rows are pre-aggregated
per (pair, month) (partial aggregation, so hot pairs are reduced map-side),
history before the series is folded into its first month, running sums
are taken per pair over at most ``months`` rows, and each value is carried
forward to the months until the pair's next change.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from ledgerlight.functions.dates import DateLike, as_date, shift_months
from ledgerlight.model import Model
from ledgerlight.plans.joins import keep_known

PAIR = ["agent_id", "product_id"]


def _known_pairs(df: DataFrame, model: Model) -> DataFrame:
    return keep_known(keep_known(df, model.agent, "agent_id"), model.product, "product_id")


def purchase_months(model: Model) -> tuple[dt.date, int]:
    """The month of the first purchase and the number of months to the last one (one aggregated row)."""
    row = model.purchase.agg(F.trunc(F.min("date_bought"), "month").alias("first"),
                             F.max("date_bought").alias("last")).first()
    if row["first"] is None:
        raise ValueError("no purchase, so no month series")
    first, last = row["first"], row["last"]
    return first, 12 * (last.year - first.year) + last.month - first.month + 1


def outstanding_stock(model: Model, as_of: DateLike | None = None, only_positive: bool = True) -> DataFrame:
    """(agent_id, product_id, debt) strictly before ``as_of``."""
    day = as_date(as_of)
    bought = (model.purchase.filter(F.col("date_bought") < F.lit(day))
              .groupBy(*PAIR).agg(F.sum("amount_bought").alias("qty_bought")))
    sold = (model.sale.filter(F.col("date_sold") < F.lit(day))
            .groupBy(*PAIR).agg(F.sum("amount_sold").alias("qty_sold")))
    out = (_known_pairs(bought, model).join(sold, PAIR, "left")
           .select(*PAIR, (F.col("qty_bought") - F.coalesce(F.col("qty_sold"), F.lit(0))).cast("bigint")
                   .alias("debt")))
    return out.filter(F.col("debt") > 0) if only_positive else out


def outstanding_stock_monthly(model: Model, start: DateLike, months: int,
                              only_positive: bool = True) -> DataFrame:
    """(month, agent_id, product_id, debt) at each of ``months`` month starts from ``start``."""
    first = as_date(start)
    if first.day != 1:
        raise ValueError("start must be the first day of a month")
    if months < 1:
        raise ValueError("months must be positive")
    last: dt.date = shift_months(first, months - 1)
    counts_from = F.greatest(F.add_months(F.trunc(F.col("day"), "month"), 1), F.lit(first))
    deltas = (
        model.purchase.select(*PAIR, F.col("date_bought").alias("day"), F.col("amount_bought").alias("b"),
                              F.lit(0).cast("bigint").alias("s"), F.lit(1).alias("n"))
        .unionByName(model.sale.select(*PAIR, F.col("date_sold").alias("day"), F.lit(0).cast("bigint").alias("b"),
                                       F.col("amount_sold").alias("s"), F.lit(0).alias("n")))
        .filter(F.col("day") < F.lit(last))
        .withColumn("month", counts_from)
        .groupBy(*PAIR, "month")
        .agg(F.sum("b").alias("b"), F.sum("s").alias("s"), F.sum("n").alias("n"))
    )
    deltas = _known_pairs(deltas, model)
    w = Window.partitionBy(*PAIR).orderBy("month")
    running = deltas.select(
        *PAIR, "month",
        F.sum("b").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_b"),
        F.sum("s").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_s"),
        F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum_n"),
        F.coalesce(F.add_months(F.lead("month").over(w), -1), F.lit(last)).alias("until"),
    )
    expanded = running.filter(F.col("cum_n") > 0).select(
        *PAIR, F.explode(F.sequence(F.col("month"), F.col("until"), F.expr("INTERVAL 1 MONTH"))).alias("month"),
        (F.col("cum_b") - F.col("cum_s")).cast("bigint").alias("debt"))
    out = expanded.select("month", *PAIR, "debt")
    return out.filter(F.col("debt") > 0) if only_positive else out
