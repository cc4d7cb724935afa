"""Upkeep of a warehouse: delta refresh of snapshots, compaction, stored cascade deletes, key blocks, vacuum.

Each writes folders of its own first and commits one log entry (``plans.commits``), so
readers see all of it or nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlight.functions.dates import DateLike, as_date, shift_months
from ledgerlight.model import Model
from ledgerlight.operators import stats
from ledgerlight.plans.commits import ConflictError, State, token
from ledgerlight.plans.indexing import global_row_number
from ledgerlight.plans.joins import maybe_broadcast
from ledgerlight.plans.sinks import DATE_COLUMN, DIM_SCHEMAS, FACT_SCHEMAS, Warehouse, write_snapshot

PUSHED_AGENTS = 1000  # touched agents named in a pushed filter; with more, the join alone limits the rows


def _pairs_of(warehouse: Warehouse, spark: SparkSession, parts: dict, by_month: bool) -> list[DataFrame]:
    """(agent_id, product_id) of the fact folders of a log entry's ``add`` or ``drop``."""
    out = []
    for table in FACT_SCHEMAS:
        listed = (parts or {}).get(table, {})
        folders = [(m, p) for m, ps in listed.items() for p in ps] if by_month else [
            (m, p) for p, months in listed.items() for m in months]
        if folders:
            out.append(warehouse.read_parts(spark, table, folders).select(*stats.PAIR))
    return out


def touched_pairs(spark: SparkSession, warehouse: Warehouse, state: State, base: dict, base_day: dt.date,
                  day: dt.date, lag_months: int) -> DataFrame | None:
    """Pairs whose measures may differ from a snapshot taken at ``base_day``; None: all may.

    These are the pairs of rows added or replaced by loads since, and of rows between the two cut-offs.
    """
    since = [c for c in state.changes if c["version"] > base["version"]]
    if day < base_day or any(c["kind"] == "dimensions" for c in since):
        return None
    frames = []
    for change in since:
        if change["kind"] == "load":
            frames += _pairs_of(warehouse, spark, change["add"], False) + _pairs_of(warehouse, spark, change["drop"], True)
    if day > base_day:
        spans = {"purchase": (shift_months(base_day, -lag_months), shift_months(day, -lag_months)), "sale": (base_day, day)}
        for table, (lo, hi) in spans.items():
            if hi > lo:
                rows = warehouse.read_fact(spark, table, between=(lo + dt.timedelta(days=1), hi), state=state)
                frames.append(rows.select(*stats.PAIR))
    out = spark.createDataFrame([], "agent_id bigint, product_id bigint")
    for f in frames:
        out = out.unionByName(f)
    return out.distinct()


def only_pairs(model: Model, pairs: DataFrame) -> Model:
    """The model with the facts of some pairs; for few agents their ids are pushed into the scans as well."""
    agents = [r.agent_id for r in pairs.select("agent_id").distinct().limit(PUSHED_AGENTS + 1).collect()]

    def some(facts: DataFrame) -> DataFrame:
        if len(agents) <= PUSHED_AGENTS:
            facts = facts.filter(F.col("agent_id").isin(agents))
        return facts.join(maybe_broadcast(pairs), stats.PAIR, "left_semi")

    return model.with_facts(purchase=some(model.purchase), sale=some(model.sale))


def snapshot_rows(spark: SparkSession, warehouse: Warehouse, state: State, day: dt.date, lag_months: int = 1,
                  pairs: DataFrame | None = None) -> DataFrame:
    """The snapshot at ``day`` in ``state``: pairs a change may have touched recomputed, the others from the last one.

    ``pairs`` adds pairs to recompute (those of deleted rows).
    """
    model = warehouse.stats_model(spark, day, lag_months, state)
    earlier = [d for d in state.snapshots if d <= day.isoformat()]
    base_day = max(earlier, key=lambda d: (state.snapshots[d]["version"], d), default=None)
    touched = None if base_day is None else touched_pairs(
        spark, warehouse, state, state.snapshots[base_day], as_date(base_day), day, lag_months)
    if touched is None:
        return stats.agent_product_stats(model, day, lag_months)
    if pairs is not None:
        touched = touched.unionByName(pairs.select(*stats.PAIR)).distinct()
    touched = touched.checkpoint()  # read by the filter, the two fact sides and the merge
    fresh = stats.agent_product_stats(only_pairs(model, touched), day, lag_months)
    kept = warehouse.read_snapshot(spark, base_day, state).join(maybe_broadcast(touched), stats.PAIR, "left_anti")
    return kept.select(*fresh.columns).unionByName(fresh)


def write_snapshot_part(spark: SparkSession, warehouse: Warehouse, state: State, day: dt.date, lag_months: int = 1,
                        pairs: DataFrame | None = None) -> str:
    part = token()
    write_snapshot(snapshot_rows(spark, warehouse, state, day, lag_months, pairs), warehouse.path("snapshot", f"part={part}"), day)
    return part


def compact(spark: SparkSession, warehouse: Warehouse, before: DateLike) -> dict[str, int]:
    """Merge the parts of every month before ``before``'s month, facts and summaries; folders saved per table.

    Afterwards such a month has one part, however many batches wrote it.
    """
    limit = as_date(before).replace(day=1).isoformat()
    state, part = warehouse.state(spark), token()
    entry = {"kind": "compact", "add": {}, "drop": {}}
    saved = {}
    for table in (*FACT_SCHEMAS, *(f"summary/{t}" for t in FACT_SCHEMAS)):
        months = {m: ps for m, ps in state.live.get(table, {}).items() if m < limit and len(ps) > 1}
        if not months:
            continue
        folders = [(m, p) for m, ps in months.items() for p in ps]
        rows = warehouse.read_parts(spark, table, folders).drop("part")
        if table.startswith("summary/"):
            sums = [c for c in ("amount", "price") if c in rows.columns]
            keys = [c for c in rows.columns if c not in ("month", *sums)]
            entry["add"][table] = {part: warehouse.write_sums(rows, keys, [F.sum(c).alias(c) for c in sums], table, part,
                                                                    warehouse.blocks(spark, table, folders))}
        else:
            entry["add"][table] = {part: warehouse._write_part(rows, table, part)}
        entry["drop"][table] = months
        saved[table] = sum(len(ps) - 1 for ps in months.values())
    if saved:
        warehouse.log(spark).commit(entry, state)
    return saved


def delete_agent(spark: SparkSession, warehouse: Warehouse, agent_id: int) -> dict[str, int]:
    """Delete an agent with its purchases, sales and territories, and every sale made in those territories."""
    return _delete(spark, warehouse, "agent", agent_id)


def delete_product(spark: SparkSession, warehouse: Warehouse, product_id: int) -> dict[str, int]:
    """Delete a product with its purchases and sales."""
    return _delete(spark, warehouse, "product", product_id)


def delete_territory(spark: SparkSession, warehouse: Warehouse, territory_id: int) -> dict[str, int]:
    """Delete a territory with the sales made in it."""
    return _delete(spark, warehouse, "territory", territory_id)


def _delete(spark: SparkSession, warehouse: Warehouse, kind: str, key: int) -> dict[str, int]:
    """Copy on write: only months that lose rows are rewritten, and summaries and snapshots repaired, in one commit."""
    state, part = warehouse.state(spark), token()
    model = warehouse.model(spark, state=state)
    named = F.col(f"{kind}_id") == F.lit(key)
    dims = {"agent": ["agent", "territory"], "product": ["product"], "territory": ["territory"]}[kind]
    facts = ["sale"] if kind == "territory" else ["purchase", "sale"]
    places = maybe_broadcast(model.territory.filter(named).select("territory_id").distinct()) if kind == "agent" else None

    def flagged(rows: DataFrame, table: str) -> DataFrame:
        if places is None or table != "sale":
            return rows.withColumn("gone", F.coalesce(named, F.lit(False)))
        second = rows.join(places.withColumn("lost", F.lit(True)), "territory_id", "left")
        return second.withColumn("gone", named | F.coalesce("lost", F.lit(False))).drop("lost")

    entry = {"kind": "delete", "add": {}, "drop": {}, "dims": {}, "snapshots": {}}
    counts = {}
    for name in dims:
        table = getattr(model, name)
        counts[name] = table.filter(named).count()
        if counts[name]:
            warehouse.write_dimension_part(table.filter(~F.coalesce(named, F.lit(False))), name, part)
            entry["dims"][name] = part
    lost = None
    for table in facts:
        rows = flagged(warehouse.read_parts(spark, table, state.parts(table)), table)
        gone = rows.filter("gone").groupBy("month").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per month
        counts[table] = sum(r.n for r in gone)
        if not gone:
            continue
        months = sorted(r.month.isoformat() for r in gone)
        hit = flagged(warehouse.read_parts(spark, table, state.parts(table, lambda m: m in months)), table)
        pairs = hit.filter("gone").select(*stats.PAIR).distinct()
        lost = pairs if lost is None else lost.unionByName(pairs)
        kept = hit.filter("NOT gone").select(*[f.name for f in FACT_SCHEMAS[table].fields])
        entry["add"].update(warehouse.write_rows({table: kept}, part))
        for stored in (table, f"summary/{table}"):
            entry["drop"][stored] = {m: state.live[stored][m] for m in months if m in state.live.get(stored, {})}
    after = state.apply(entry)
    for as_of in state.snapshots:
        day = as_date(as_of)
        pairs = lost if lost is not None else spark.createDataFrame([], "agent_id bigint, product_id bigint")
        repaired = _repaired(spark, warehouse, state, after, day, pairs, named if kind != "territory" else None)
        write_snapshot(repaired, warehouse.path("snapshot", f"part={part}"), day)
        entry["snapshots"][as_of] = part
    warehouse.log(spark).commit(entry, state)
    return counts


def _repaired(spark: SparkSession, warehouse: Warehouse, before: State, after: State, day: dt.date, pairs: DataFrame,
              gone) -> DataFrame:
    """A snapshot without the deleted rows: pairs that lost rows recomputed, the others taken over."""
    pairs = pairs.distinct().checkpoint()
    model = only_pairs(warehouse.stats_model(spark, day, state=after), pairs)
    fresh = stats.agent_product_stats(model, day)
    kept = warehouse.read_snapshot(spark, day, before).join(maybe_broadcast(pairs), stats.PAIR, "left_anti")
    if gone is not None:
        kept = kept.filter(~gone)
    return kept.select(*fresh.columns).unionByName(fresh)


def reserve_keys(spark: SparkSession, warehouse: Warehouse, name: str, count: int, at_least: int = 0, tries: int = 20) -> int:
    """Reserve ``count`` keys; the first is the returned number plus one.  No key is given out twice, also not after deletes."""
    for _ in range(tries):
        state = warehouse.state(spark)
        start = max(state.marks.get(name, 0), at_least)
        try:
            warehouse.log(spark).commit({"kind": "keys", "marks": {name: start + count}}, state)
            return start
        except ConflictError:
            continue
    raise ConflictError(f"no block of keys for {name} after {tries} tries")


def assign_stored_keys(spark: SparkSession, warehouse: Warehouse, candidates: DataFrame, name: str, name_col: str,
                       id_col: str) -> DataFrame:
    """Keys for the names not yet in dimension ``name``, by name, from a reserved block."""
    dim = warehouse.read_dimension(spark, name)
    new = (candidates.select(name_col).filter(F.col(name_col).isNotNull()).distinct()
           .join(dim.select(name_col), name_col, "left_anti").checkpoint())
    count = new.count()
    if not count:
        return spark.createDataFrame([], f"{name_col} string, {id_col} bigint")
    start = reserve_keys(spark, warehouse, name, count, dim.agg(F.max(id_col)).first()[0] or 0)
    numbered = global_row_number(new, [F.col(name_col)], "n")
    return numbered.select(name_col, (F.lit(start) + F.col("n")).cast("bigint").alias(id_col))


def vacuum(spark: SparkSession, warehouse: Warehouse) -> int:
    """Delete folders that no longer count (failed loads, merged parts); only while no writer or old reader is active."""
    state = warehouse.state(spark)
    used = {p for months in state.live.values() for parts in months.values() for p in parts}
    used |= set(state.dims.values()) | {s["part"] for s in state.snapshots.values()}
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    tables = [*FACT_SCHEMAS, *(f"{k}/{t}" for k in ("summary", "quarantine") for t in FACT_SCHEMAS), "snapshot",
              *(f"dimension/{n}" for n in DIM_SCHEMAS)]
    for table in tables:
        folder = fs_path(warehouse.path(*table.split("/")))
        fs = folder.getFileSystem(conf)
        for status in fs.listStatus(folder) if fs.exists(folder) else []:
            name = status.getPath().getName()
            if name.startswith("part=") and name.removeprefix("part=") not in used:
                fs.delete(status.getPath(), True)
                removed += 1
    return removed
