"""Invoice ingestion: resolve names to keys, check, append, refresh.

A load takes a purchase invoice and a sale invoice.  Both are resolved
against the dimensions (exact, case-sensitive names; territories by
(city, district)) and checked in full before anything is written, so a
load that fails writes nothing.  Both tables, their summaries, the rejected rows and, for
a sale load, the statistics snapshot are then written into folders of their own, and one
log entry makes all of them count: a load is one transaction.  The snapshot
sees the purchases of the same load, as with purchases loaded first.

``mode="fail"`` rejects the whole load when any row breaks a rule (what a
transactional bulk load does); ``mode="quarantine"`` loads the good rows
and writes the rejected ones, with their reasons, next to the facts;
``mode="set_aside"`` also rejects the whole load when any row breaks a rule, but
records it: all its rows are quarantined and later loads go on.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.functions.dates import DateLike, as_date
from ledgerlight.model import Model
from ledgerlight.operators import quality
from ledgerlight.operators.maintenance import write_snapshot_part
from ledgerlight.plans.commits import token
from ledgerlight.plans.joins import broadcast_limit, maybe_broadcast
from ledgerlight.plans.session import ensure_checkpoint_dir
from ledgerlight.plans.sinks import Warehouse, run_concurrently
from ledgerlight.sources.invoices import MALFORMED, read_purchase_invoice, read_sale_invoice


class IngestError(ValueError):
    def __init__(self, table: str, counts: dict[str, int]):
        self.table = table
        self.counts = counts
        detail = ", ".join(f"{reason}: {n}" for reason, n in sorted(counts.items()))
        super().__init__(f"{table} invoice rejected ({detail})")


def _malformed(stage: DataFrame) -> list[str]:
    return [c for c in stage.columns if c == MALFORMED]


def _agent_lookup(agent: DataFrame) -> DataFrame:
    return maybe_broadcast(agent.select(F.col("agent_name").alias("_ll_an"), "agent_id"))


def _product_lookup(product: DataFrame) -> DataFrame:
    return maybe_broadcast(product.select(F.col("product_name").alias("_ll_pn"), "product_id"))


def resolve_purchases(stage: DataFrame, model: Model) -> DataFrame:
    """Purchase stage with agent_id / product_id (NULL when the name is unknown)."""
    agents, products = _agent_lookup(model.agent), _product_lookup(model.product)
    return (stage
            .join(agents, stage["agent_name"] == agents["_ll_an"], "left")
            .join(products, stage["product_name"] == products["_ll_pn"], "left")
            .select("date_bought", "product_name", "agent_name", "amount_bought", "agent_id", "product_id",
                    *_malformed(stage)))


def resolve_sales(stage: DataFrame, model: Model) -> DataFrame:
    """Sale stage with agent_id / product_id / territory_id (NULL when unknown)."""
    agents, products = _agent_lookup(model.agent), _product_lookup(model.product)
    places = maybe_broadcast(model.territory.select(
        F.col("city").alias("_ll_city"), F.col("district").alias("_ll_district"), "territory_id"))
    return (stage
            .join(agents, stage["agent_name"] == agents["_ll_an"], "left")
            .join(products, stage["product_name"] == products["_ll_pn"], "left")
            .join(places, (stage["city"] == places["_ll_city"]) & (stage["district"] == places["_ll_district"]),
                  "left")
            .select("date_sold", "product_name", "agent_name", "city", "district", "amount_sold", "price",
                    "agent_id", "product_id", "territory_id", *_malformed(stage)))


LOADED = "loaded"
MODES = ("fail", "quarantine", "set_aside")
SET_ASIDE = "set aside with its file"


def outcome_counts(flagged: DataFrame) -> dict[str, int]:
    """Rows per outcome: ``loaded`` or the reject reason (a handful of rows reach the driver)."""
    outcome = F.coalesce(F.col(quality.REASON), F.lit(LOADED)).alias("outcome")
    rows = flagged.groupBy(outcome).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["outcome"]: int(r["n"]) for r in rows}


@dataclass
class LoadResult:
    batch_id: str
    loaded: dict[str, int]
    rejected: dict[str, dict[str, int]]


def _checked(resolved: DataFrame) -> DataFrame:
    # materialise once in the shared checkpoint folder: the same rows feed the date
    # span, the checks, the reject count and both writes, and survive executor loss
    ensure_checkpoint_dir(resolved.sparkSession)
    return resolved.checkpoint(eager=True)


KEY_BYTES = 64  # of a marked key in a broadcast table, at most


def _settled(marks: DataFrame) -> DataFrame:
    """The marked keys of a batch, computed first: where they are few, no row of the batch is shuffled for them."""
    marks = marks.checkpoint(eager=True)
    return F.broadcast(marks) if marks.count() * KEY_BYTES <= broadcast_limit(marks) else marks


def _loaded_rows(warehouse: Warehouse, table: str, stage: DataFrame, date_col: str,
                 batch_id: str) -> DataFrame:
    """Rows already loaded in the stage's date span (month partitions pruned)."""
    spark = stage.sparkSession
    span = stage.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    if span is None or span["lo"] is None:
        return warehouse.read_fact(spark, table, exclude_batch=batch_id).limit(0)
    return warehouse.read_fact(spark, table, exclude_batch=batch_id, between=(span["lo"], span["hi"]))


def load_batch(model: Model, warehouse: Warehouse, purchase_stage: DataFrame | None = None,
               sale_stage: DataFrame | None = None, mode: str = "fail", batch_id: str | None = None,
               refresh_as_of: DateLike | None = None, refresh: bool = True) -> LoadResult:
    """Check and append one batch of staged invoices (either may be None).

    ``model`` supplies the dimensions; keys already loaded are looked up in
    the warehouse's facts, reading only the months the batch covers.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    spark = (purchase_stage if purchase_stage is not None else sale_stage).sparkSession
    batch_id = batch_id or f"load-{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    done = warehouse.state(spark).batches.get(batch_id)
    if done is not None and done.get("merged"):  # loaded before, and its rows compacted since
        return LoadResult(batch_id, done["loaded"], done["rejected"])
    checked: dict[str, DataFrame] = {}
    if purchase_stage is not None:
        resolved = _checked(resolve_purchases(purchase_stage, model))  # the file is parsed once
        loaded_p = _loaded_rows(warehouse, "purchase", resolved, "date_bought", batch_id)
        checked["purchase"] = quality.flag_purchases(resolved, loaded_p, _settled)
    if sale_stage is not None:
        resolved = _checked(resolve_sales(sale_stage, model))
        loaded_s = _loaded_rows(warehouse, "sale", resolved, "date_sold", batch_id)
        checked["sale"] = quality.flag_sales(resolved, loaded_s, _settled)
    # the flags feed the counts and up to three writes; keep them cached (their lineage is
    # short and starts at the reliable checkpoint above, so a lost block recomputes the same rows)
    for frame in checked.values():
        frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _write_checked(spark, warehouse, checked, mode, batch_id, refresh_as_of, refresh)
    finally:
        for frame in checked.values():
            frame.unpersist()


def _write_checked(spark: SparkSession, warehouse: Warehouse, checked: dict[str, DataFrame], mode: str,
                   batch_id: str, refresh_as_of: DateLike | None, refresh: bool) -> LoadResult:
    # independent Spark jobs (one per table and output) are submitted from a few threads so
    # the scheduler runs them side by side; every count finishes before the first write
    counted = dict(zip(checked, run_concurrently(*[lambda f=f: outcome_counts(f) for f in checked.values()])))
    loaded = {table: counts.pop(LOADED, 0) for table, counts in counted.items()}
    rejected = counted
    if mode == "fail":
        for table, counts in rejected.items():
            if counts:
                raise IngestError(table, counts)
    if mode == "set_aside" and any(rejected.values()):
        checked = {t: f.withColumn(quality.REASON, F.coalesce(quality.REASON, F.lit(SET_ASIDE))) for t, f in checked.items()}
        for table, n in loaded.items():
            rejected[table] = rejected[table] | ({SET_ASIDE: n} if n else {})
        loaded = dict.fromkeys(loaded, 0)
    state, part = warehouse.state(spark), token()
    replaced = warehouse.replaced(state, batch_id)
    added = warehouse.write_rows({t: f.filter(F.col(quality.REASON).isNull()) for t, f in checked.items()}, part)
    for table, frame in checked.items():
        if rejected[table]:
            warehouse.write_quarantine(frame.filter(F.col(quality.REASON).isNotNull()), table, part)
            added[f"quarantine/{table}"] = {part: ["all"]}
    entry = {"kind": "load", "batch": batch_id, "part": part, "loaded": loaded, "rejected": rejected,
             "add": added, "drop": replaced}
    if refresh and "sale" in checked:
        # computed from what the commit will add, so facts, summaries and snapshot count from the same moment
        day = as_date(refresh_as_of)
        entry["snapshots"] = {day.isoformat(): write_snapshot_part(spark, warehouse, state.apply(entry), day)}
    warehouse.log(spark).commit(entry, state)
    return LoadResult(batch_id, loaded, rejected)


def files_batch_id(spark: SparkSession, paths: list[str]) -> str:
    """A batch id determined by the input files (path, size, modification time).

    Re-running a load of the same files (after a failure part-way through)
    gets the same id, so it replaces its own earlier output; new or changed
    files get a new id.  Only file metadata is listed, nothing is read.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    entries = []
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(conf)
        files = fs.listFiles(hpath, True)
        while files.hasNext():
            st = files.next()
            entries.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
    digest = hashlib.sha1("\n".join(sorted(entries)).encode("utf-8")).hexdigest()[:16]
    return f"load-{digest}"


def ingest_invoices(spark: SparkSession, purchase_path: str | None, sale_path: str | None,
                    warehouse: Warehouse, mode: str = "fail", batch_id: str | None = None,
                    refresh_as_of: DateLike | None = None) -> LoadResult:
    """Read both invoice files and load them as one batch.

    Without ``batch_id`` the id is derived from the files, so running the
    same load again is idempotent.
    """
    if batch_id is None:
        batch_id = files_batch_id(spark, [p for p in (purchase_path, sale_path) if p])
    model = warehouse.model(spark, exclude_batch=batch_id)
    p = read_purchase_invoice(spark, purchase_path) if purchase_path else None
    s = read_sale_invoice(spark, sale_path) if sale_path else None
    return load_batch(model, warehouse, p, s, mode, batch_id, refresh_as_of)


def refresh_snapshot(spark: SparkSession, warehouse: Warehouse, as_of: DateLike | None = None,
                     lag_months: int = 1) -> dt.date:
    """Bring the statistics snapshot up to ``as_of`` (default today) with the loaded facts.

    Only pairs that loads or a later cut-off touched since the last snapshot are recomputed
    (``maintenance.snapshot_rows``), from the monthly summaries for complete months and the raw
    facts for the two cut-off months; the other rows are taken over.
    """
    day = as_date(as_of)
    state = warehouse.state(spark)
    part = write_snapshot_part(spark, warehouse, state, day, lag_months)
    warehouse.log(spark).commit({"kind": "snapshot", "snapshots": {day.isoformat(): part}}, state)
    return day
