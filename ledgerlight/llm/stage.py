"""Written stages in the shared checkpoint folder, and table reading."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ledgerlight.plans.session import scratch_path


_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_shared: dict[str, str] = {}


def _zipped() -> bytes:
    """The package's modules as a zip archive."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in sorted(os.walk(_PACKAGE)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    return out.getvalue()


def share_package(spark: SparkSession) -> None:
    """Ship this package to the Python workers, once a session: an archive in the shared folder that executors fetch.

    Call it before a function of this package is handed to Spark.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shared:
        return
    target = sc._jvm.org.apache.hadoop.fs.Path(f"{scratch_path(spark, 'package')}/ledgerlight.zip")
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(target)
    try:
        out.write(_zipped())
    finally:
        out.close()
    sc.addPyFile(fs.makeQualified(target).toString())
    _shared[sc.applicationId] = target.toString()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later jobs reread files, not lineage."""
    share_package(df.sparkSession)
    path = f"{scratch_path(df.sparkSession, label)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is computed inside; the session's own number is put back.

    A batch is held by the JVM outside its heap and by the Python worker at once, in several copies.
    """
    before = spark.conf.get(BATCH_ROWS)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def set_apart(df: DataFrame, *names: str) -> DataFrame:
    """``names`` as columns of their own and all others in one struct, so no name of theirs can clash."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*names, (F.struct(*others) if others else F.lit(None).cast("int")).alias("others"))


def put_back(df: DataFrame, columns: list[str], *names: str) -> list[Column]:
    """The select list that gives ``set_apart`` frames their ``columns`` back, ``names`` as they are now."""
    return [df[c] if c in names else df["others"].getField(c).alias(c) for c in columns]


def smallest_keys(rows: DataFrame, key: str, count: int, n: int) -> list[Row]:
    """The ``n`` distinct rows with the smallest 64-bit hashes ``key``, ties by the other columns.

    ``count`` is the number of rows.  Only hashes below a limit that lets about ``2 * n`` of
    them pass are sorted, so the tasks together send that many rows to the driver, not ``n`` each;
    where repeated rows leave fewer, the limit is raised.
    """
    share = 2 * n / max(count, 1)
    order = [key, *(c for c in rows.columns if c != key)]
    while True:
        some = rows if share >= 1 else rows.filter(F.col(key) < int(-(2**63) + share * 2**64))
        got = some.distinct().orderBy(*order).limit(n).collect()
        if share >= 1 or len(got) == n:
            return got
        share *= 8
