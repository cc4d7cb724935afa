"""Join helpers: broadcast only behind a size check.

``maybe_broadcast`` asks Catalyst for the optimized plan's size estimate
(file size scaled by the pruned columns for a Parquet scan, propagated
through filters and aggregates) and adds a broadcast hint only when the
estimate is under the limit.  Beyond it the frame is returned unhinted and
the join runs as a shuffle join; AQE can still demote it to a broadcast at
runtime from real shuffle sizes, and splits skewed partitions otherwise.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F


def estimated_size_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` in bytes, or None when unavailable."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(size.toString())
    except Exception:  # Spark Connect or an unexpected plan: no estimate
        return None


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    """A Spark byte size (``10485760``, ``10485760b``, ``1KB``, ``-1``) as a number of bytes."""
    match = re.fullmatch(r"\s*(-?\d+)\s*([a-z]*)\s*", text.lower())
    if match is None or match.group(2) not in ("", *_UNITS):
        raise ValueError(f"not a byte size: {text!r}")
    return int(match.group(1)) * _UNITS.get(match.group(2), 1)


def broadcast_limit(df: DataFrame, limit: int | None = None) -> int:
    """The size up to which a side may be broadcast (negative: never)."""
    if limit is not None:
        return limit
    return parse_bytes(str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")))


def maybe_broadcast(df: DataFrame, limit: int | None = None, bounded_by: DataFrame | None = None) -> DataFrame:
    """``F.broadcast(df)`` when its estimated size is within ``limit``.

    ``bounded_by`` is a frame with at least as many rows as ``df`` (the
    owned territories of a territory table, say); its estimate, doubled,
    stands in when ``df`` has none (a checkpointed frame).
    """
    size = estimated_size_bytes(df)
    bound = broadcast_limit(df, limit)
    if size is not None and 0 <= size <= bound:
        return F.broadcast(df)
    if bounded_by is not None:
        base = estimated_size_bytes(bounded_by)
        if base is not None and 0 <= 2 * base <= bound:
            return F.broadcast(df)
    return df


def keep_known(df: DataFrame, keys: DataFrame, on: list[str] | str, limit: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key exists in ``keys`` (a foreign-key filter).

    When the key set is small it is a broadcast semi join, which Catalyst
    may push below aggregations down to the scan (cheap: no shuffle).
    When it is not, a semi join pushed that far would shuffle the raw fact
    rows by the key (and put a hot key in one task), so the filter is
    written as an inner join with the distinct keys instead: Catalyst does
    not move an inner join below an aggregate, so it applies to the
    already aggregated rows, and AQE can split a skewed key.
    """
    cols = [on] if isinstance(on, str) else list(on)
    key_frame = keys.select(*cols)
    size = estimated_size_bytes(key_frame)
    if size is not None and 0 <= size <= broadcast_limit(key_frame, limit):
        return df.join(F.broadcast(key_frame), cols, "left_semi")
    return df.join(key_frame.distinct(), cols, "inner")
