"""Distributed numbering and per-group top-k.

``global_row_number`` numbers the rows of a frame 1..n in a given order
without pulling them into one partition (a window with no PARTITION BY
would).  The frame is range-partitioned and sorted, each row gets
``monotonically_increasing_id`` (partition index in the upper 31 bits,
position in the lower 33), the frame is checkpointed so the ids survive
executor loss and re-execution, and per-partition row counts (one row per
partition, so their size is bounded by the partition count) are turned
into offsets and broadcast back.

``row_number_within`` does the same inside groups (a window's PARTITION
BY) with per-(partition, group) offsets, so one hot group is split across
tasks.

``top_k_per_group`` keeps the k first rows of each group.  A hot group is
first cut into ``salt_buckets`` sub-groups, each reduced to its own top k,
so no task ever ranks more than the rows of one sub-group plus
``k * salt_buckets`` survivors.

All three fall back to a plain window only when one task provably holds
the data (see ``_is_small``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlight.plans.joins import broadcast_limit, estimated_size_bytes, maybe_broadcast
from ledgerlight.plans.session import ensure_checkpoint_dir

_ROW_BITS = 33


def _is_small(df: DataFrame, small_limit: int | None, bounded_by: DataFrame | None) -> bool:
    """True when ``df`` provably fits one task.

    The bound is Catalyst's size estimate of ``df`` or, when the caller
    knows ``df`` has at most as many rows as another frame (sections of a
    territory table, say), the estimate of that frame times two.
    """
    limit = broadcast_limit(df, small_limit)
    size = estimated_size_bytes(df)
    if size is not None and 0 <= size <= limit:
        return True
    if bounded_by is not None:
        base = estimated_size_bytes(bounded_by)
        return base is not None and 0 <= 2 * base <= limit
    return False


def global_row_number(df: DataFrame, order_cols: list[Column | str], name: str = "row_no",
                      checkpoint: bool = True, small_limit: int | None = None,
                      bounded_by: DataFrame | None = None) -> DataFrame:
    """Rows numbered 1..n in ``order_cols`` order.

    When the frame provably fits one task (``_is_small``) a plain window
    numbers it.  Otherwise the distributed path below runs.
    """
    if _is_small(df, small_limit, bounded_by):
        cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
        return df.withColumn(name, F.row_number().over(Window.orderBy(*cols)).cast("bigint"))
    spark = df.sparkSession
    ordered = df.orderBy(*order_cols).withColumn("_ll_mid", F.monotonically_increasing_id())
    if checkpoint:
        ensure_checkpoint_dir(spark)
        ordered = ordered.checkpoint(eager=True)
    part = F.shiftright(F.col("_ll_mid"), _ROW_BITS)
    counts = ordered.groupBy(part.alias("_ll_part")).agg(F.count(F.lit(1)).alias("_ll_n"))
    offsets = counts.select(
        "_ll_part",
        F.coalesce(
            F.sum("_ll_n").over(Window.orderBy("_ll_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_ll_offset"),
    )
    numbered = ordered.join(F.broadcast(offsets), part == F.col("_ll_part"))
    pos = F.col("_ll_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.withColumn(name, (F.col("_ll_offset") + pos + F.lit(1)).cast("bigint")).drop(
        "_ll_mid", "_ll_part", "_ll_offset")


def top_k_per_group(df: DataFrame, group_cols: list[str], order_cols: list[Column], k: int,
                    salt: Column | None = None, salt_buckets: int = 16,
                    rank_name: str = "rank_no", group_bounded_by: DataFrame | None = None) -> DataFrame:
    """Rows ranked 1..k within each group by ``order_cols`` (ties broken by the order given).

    ``salt`` must be a deterministic column (for example a hash of the row's
    key); rows of one group are pre-reduced per salt bucket.  When every
    group provably has at most as many rows as ``group_bounded_by`` and that
    frame is small, one window pass suffices.
    """
    if group_bounded_by is not None and _is_small(group_bounded_by, None, None):
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(rank_name, F.row_number().over(w)).filter(F.col(rank_name) <= k)
    if salt is None:
        salt = F.xxhash64(*[F.col(c) for c in df.columns])
    bucketed = df.withColumn("_ll_salt", F.pmod(salt, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group_cols, "_ll_salt").orderBy(*order_cols)
    survivors = (bucketed.withColumn("_ll_topk_rn", F.row_number().over(w1))
                 .filter(F.col("_ll_topk_rn") <= k).drop("_ll_topk_rn", "_ll_salt"))
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (survivors.withColumn(rank_name, F.row_number().over(w2))
            .filter(F.col(rank_name) <= k))


def row_number_within(df: DataFrame, group_cols: list[str], order_cols: list[Column], name: str = "row_no",
                      small_limit: int | None = None, bounded_by: DataFrame | None = None,
                      group_bounded_by: DataFrame | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` without one task per group.

    A window puts every row of a group in one task; a hot group (one
    section holding a third of the rows) would then be sorted by a single
    task.  Here rows are range-partitioned by (group, order) instead, which
    splits a hot group over several partitions, and each row's number is
    its position in its partition plus the rows of the same group in
    earlier partitions.  The per-(partition, group) counts have at most
    #partitions + #groups rows.  The plain window is used when one task
    provably holds any group: the whole frame is small (``bounded_by``), or
    every group has at most as many rows as ``group_bounded_by`` (a section
    ranks distinct agents, say) and that frame is small.
    """
    if _is_small(df, small_limit, bounded_by) or (
            group_bounded_by is not None and small_limit is None
            and _is_small(group_bounded_by, None, None)):
        w = Window.partitionBy(*group_cols).orderBy(*order_cols)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(c) for c in group_cols] + list(order_cols)
    ordered = (df.repartitionByRange(*keys).sortWithinPartitions(*keys)
               .withColumn("_ll_mid", F.monotonically_increasing_id())
               .checkpoint(eager=True))
    part = F.shiftright(F.col("_ll_mid"), _ROW_BITS)
    pos = F.col("_ll_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    spans = (ordered.groupBy(part.alias("_ll_part"), *group_cols)
             .agg(F.count(F.lit(1)).alias("_ll_n"), F.min(pos).alias("_ll_first")))
    earlier = Window.partitionBy(*group_cols).orderBy("_ll_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.select("_ll_part", *group_cols, "_ll_first",
                           F.coalesce(F.sum("_ll_n").over(earlier), F.lit(0)).alias("_ll_offset"))
    numbered = ordered.withColumn("_ll_part", part).join(maybe_broadcast(offsets), ["_ll_part", *group_cols])
    return (numbered.withColumn(name, (F.col("_ll_offset") + pos - F.col("_ll_first") + F.lit(1)).cast("bigint"))
            .drop("_ll_mid", "_ll_part", "_ll_first", "_ll_offset"))
