"""Incremental invoice ingestion with Structured Streaming.

Invoice files dropped into a folder are picked up by a file stream (CSV,
fixed schema); every micro-batch goes through the same ``load_batch`` as a
batch load, so names are resolved, rules checked and rows appended in one
step per batch.  Sale batches refresh the statistics snapshot afterwards;
purchase batches do not.

Exactly-once: the stream checkpoint records which files each batch_id
consumed, and ``load_batch`` commits each batch as one log entry under the id
``<stream>-<query id>-<batch_id>``, so a batch
replayed after a failure replaces its earlier output instead of duplicating it.
The query id lives in the checkpoint, so a stream with a new checkpoint, whose
batch ids begin at 0 again, never touches what another one has loaded.

``files_per_batch`` is 1 by default: files are loaded one after another, oldest
first, so of a key in two files the first file's row is loaded and the second is
rejected, however many files a drain finds.  None loads all new files as one batch.
No streaming state is needed: the refresh reads the full fact tables.
"""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerlight.functions.dates import DateLike
from ledgerlight.operators.ingest import load_batch
from ledgerlight.plans.sinks import Warehouse
from ledgerlight.sources.invoices import stream_invoice


def start_invoice_stream(spark: SparkSession, kind: str, in_dir: str, warehouse: Warehouse,
                         checkpoint: str, mode: str = "quarantine", available_now: bool = True,
                         refresh_as_of: DateLike | None = None, name: str | None = None,
                         processing_time: str | None = None, files_per_batch: int | None = 1) -> StreamingQuery:
    """Start ingesting ``kind`` ('purchase' or 'sale') invoices from ``in_dir``.

    In modes ``quarantine`` and ``set_aside`` a malformed line is a rejected row; in mode
    ``fail`` it stops the stream, as any other bad row does.
    """
    if kind not in ("purchase", "sale"):
        raise ValueError("kind must be 'purchase' or 'sale'")
    label = name or kind
    started: Future[StreamingQuery] = Future()

    def handle(batch: DataFrame, batch_id: int) -> None:
        folder = f"{label}-{started.result(timeout=300).id}-{batch_id}"
        # a replayed batch must not see its own earlier output as "already loaded"
        model = warehouse.model(batch.sparkSession, exclude_batch=folder)
        load_batch(
            model, warehouse,
            purchase_stage=batch if kind == "purchase" else None,
            sale_stage=batch if kind == "sale" else None,
            mode=mode, batch_id=folder,
            refresh_as_of=refresh_as_of, refresh=(kind == "sale"),
        )

    malformed = "fail" if mode == "fail" else "reject"
    writer = (stream_invoice(spark, kind, in_dir, files_per_batch, malformed).writeStream
              .foreachBatch(handle)
              .option("checkpointLocation", checkpoint)
              .queryName(f"ingest-{label}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    query = writer.start()
    started.set_result(query)
    return query


def run_invoice_streams(spark: SparkSession, purchase_dir: str | None, sale_dir: str | None,
                        warehouse: Warehouse, checkpoint_root: str, mode: str = "quarantine",
                        refresh_as_of: DateLike | None = None, files_per_batch: int | None = 1) -> None:
    """Drain both folders once (purchases before sales), then stop."""
    for kind, folder in (("purchase", purchase_dir), ("sale", sale_dir)):
        if folder is None:
            continue
        query = start_invoice_stream(spark, kind, folder, warehouse, f"{checkpoint_root.rstrip('/')}/{kind}",
                                     mode=mode, refresh_as_of=refresh_as_of, files_per_batch=files_per_batch)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
