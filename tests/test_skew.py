"""One agent holds a third of all rows: shuffle-only plans with AQE skew splitting
must give the same answers as the broadcast plans."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight.model import Model
from ledgerlight.operators import report_md, sampling, stats, stock, territory
from ledgerlight.sources.testdata import load_model

SHUFFLE_ONLY = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


def skewed(spark) -> Model:
    m = load_model(spark, "/root/testdata/sf0.001")

    def remap(df, date_col):
        return df.withColumn("agent_id", F.when(F.pmod(F.xxhash64("product_id", date_col), F.lit(3)) == 0,
                                                F.lit(0).cast("bigint")).otherwise(F.col("agent_id")))
    return m.with_facts(purchase=remap(m.purchase, "date_bought"), sale=remap(m.sale, "date_sold"))


def run_all(m):
    day = dt.date(1999, 1, 1)
    return {
        "totals": sorted(stats.agent_stats(m, day).collect()),
        "named": sorted(stats.agent_product_named(m, day).collect()),
        "districts": sorted(territory.district_sales(m, day).collect()),
        "ranking": sorted(territory.seller_ranking(m, day).collect()),
        "markdown": sorted(report_md.territory_markdown(m, day).collect()),
        "stock": sorted(stock.outstanding_stock_monthly(m, dt.date(1998, 6, 1), 6).collect()),
        "sample": sorted(sampling.sample_products_per_agent_month(m, 7, 7).collect()),
    }


@pytest.fixture()
def shuffle_only(spark):
    old = {k: spark.conf.get(k, None) for k in SHUFFLE_ONLY}
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_agent_has_a_third(spark):
    m = skewed(spark)
    share = m.purchase.filter("agent_id = 0").count() / m.purchase.count()
    assert share > 0.3


def test_shuffle_plans_match_broadcast_plans(spark, shuffle_only):
    m = skewed(spark)
    shuffled = run_all(m)
    plan = stats.agent_product_stats(m, "1999-01-01")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    for k, v in SHUFFLE_ONLY.items():
        spark.conf.unset(k)
    broadcast = run_all(m)
    for key in shuffled:
        assert shuffled[key] == broadcast[key], key
