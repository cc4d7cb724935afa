from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlight.functions.random import rand_key
from ledgerlight.plans.indexing import global_row_number, row_number_within, top_k_per_group
from ledgerlight.plans import joins, session
from ledgerlight.plans.joins import estimated_size_bytes, maybe_broadcast


def test_global_row_number_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 13).withColumn("k", (F.col("id") * 7919) % 5003)
    for limit in (1, None):  # distributed path, then the small-frame window
        out = global_row_number(df, [F.col("k"), F.col("id")], "rn", small_limit=limit).collect()
        assert sorted(r.rn for r in out) == list(range(1, 5001))
        by_rn = sorted(out, key=lambda r: r.rn)
        keys = [(r.k, r.id) for r in by_rn]
        assert keys == sorted(keys)


def test_top_k_matches_brute_force(spark):
    rows = [(g, i, (i * 37) % 11) for g in range(5) for i in range(40 if g == 0 else 5)]
    df = spark.createDataFrame(rows, "g int, i int, v int")
    got = top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("i")], 3, salt=F.col("i"), salt_buckets=4)
    got = sorted((r.g, r.rank_no, r.i) for r in got.collect())
    expected = []
    for g in range(5):
        members = sorted([(v, i) for gg, i, v in rows if gg == g], key=lambda t: (-t[0], t[1]))[:3]
        expected += [(g, n + 1, i) for n, (_, i) in enumerate(members)]
    assert got == sorted(expected)


def test_broadcast_only_when_small(spark):
    small = spark.range(10)
    assert estimated_size_bytes(small) == 80
    hinted = maybe_broadcast(small)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in hinted and "broadcast" in hinted
    plain = maybe_broadcast(small, limit=1)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plain


def test_rand_key_is_deterministic_and_spread(spark):
    df = spark.range(1000).select(rand_key(3, F.col("id")).alias("r"))
    a = [r.r for r in df.collect()]
    b = [r.r for r in df.collect()]
    assert a == b
    assert len(set(a)) > 990 and min(a) >= 0 and max(a) < 2147483647


def test_row_number_within_hot_group(spark):
    # group 0 holds most rows; the distributed path must equal the window
    df = spark.range(0, 6000, 1, 9).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 5).alias("g"),
        ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))
    order = [F.col("v").desc(), F.col("id")]
    dist = {(r.g, r.id): r.rn for r in row_number_within(df, ["g"], order, "rn", small_limit=1).collect()}
    win = {(r.g, r.id): r.rn for r in row_number_within(df, ["g"], order, "rn").collect()}
    assert dist == win and len(dist) == 6000


def test_sampling_paths_agree(spark):
    from ledgerlight.operators import sampling
    from ledgerlight.sources.testdata import load_model
    m = load_model(spark, "/root/testdata/sf0.001")
    one = sorted(sampling.sample_products_per_agent_month(m).collect())
    salted = sorted(sampling.sample_products_per_agent_month(m, always_salt=True).collect())
    assert one == salted and len(one) > 0


@pytest.mark.parametrize("text, size", [("1KB", 1024), ("-1", -1), ("10485760b", 10485760), ("256k", 262144), ("2g", 2 << 30)])
def test_byte_sizes(text, size):
    assert joins.parse_bytes(text) == size


def test_unknown_byte_size_is_an_error():
    with pytest.raises(ValueError):
        joins.parse_bytes("ten")


def test_cluster_without_shared_folder_fails(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

    monkeypatch.setattr(session, "checkpoint_root", lambda spark: None)
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
