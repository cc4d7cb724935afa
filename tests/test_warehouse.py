"""Commits, delta snapshots, compaction, stored deletes, key blocks, set-aside files, samples."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from fixtures import invoice_model
from pyspark.sql import functions as F
from test_ingest import (PURCHASE_HEADER, SALE_HEADER, fresh_warehouse, purchase_lines, sale_lines, write_csv)

from ledgerlight.operators import ingest, maintenance, quality, sampling, stats
from ledgerlight.plans.commits import ConflictError
from ledgerlight.plans.sinks import Warehouse
from ledgerlight.streaming.invoices import run_invoice_streams

DAY = "2024-04-01"


def load(spark, wh, root, name, purchases=None, sales=None, **options):
    p = write_csv(f"{root}/{name}/p.csv", PURCHASE_HEADER, purchases) if purchases is not None else None
    s = write_csv(f"{root}/{name}/s.csv", SALE_HEADER, sales) if sales is not None else None
    return ingest.ingest_invoices(spark, p, s, wh, batch_id=name, refresh_as_of=DAY, **options)


def contents(spark, wh):
    m = wh.model(spark)
    summaries = [sorted(wh.read_summary(spark, t).collect()) for t in ("purchase", "sale")]
    snapshots = {d: sorted(map(tuple, wh.read_snapshot(spark, d).collect())) for d in wh.state(spark).snapshots}
    return sorted(m.purchase.collect()), sorted(m.sale.collect()), summaries, snapshots


def full(spark, wh, day=DAY):
    return sorted(map(tuple, stats.agent_product_stats(wh.model(spark), day).collect()), key=str)


def stored(spark, wh, day=DAY):
    got = wh.read_snapshot(spark, day)
    return sorted(map(tuple, got.select(stats.agent_product_stats(wh.model(spark), day).columns).collect()), key=str)


@pytest.mark.parametrize("step", ["write_summary", "write_fact", "snapshot"])
def test_a_load_that_dies_leaves_everything_as_it_was(spark, workdir, monkeypatch, step):
    wh = fresh_warehouse(spark, workdir)
    load(spark, wh, workdir, "one", purchase_lines()[:9], sale_lines()[:7])
    before = contents(spark, wh)

    def die(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if step == "snapshot":
            patch.setattr(ingest, "write_snapshot_part", die)
        else:
            original = getattr(Warehouse, step)
            patch.setattr(Warehouse, step, lambda self, df, table, part: die() if table == "sale" else original(
                self, df, table, part))
        with pytest.raises(RuntimeError):
            load(spark, wh, workdir, "two", purchase_lines()[9:], sale_lines()[7:])
    assert contents(spark, wh) == before
    load(spark, wh, workdir, "two", purchase_lines()[9:], sale_lines()[7:])
    m = invoice_model(spark)
    assert sorted(wh.model(spark).sale.collect()) == sorted(m.sale.collect())
    assert stored(spark, wh) == sorted(map(tuple, stats.agent_product_stats(m, DAY).collect()), key=str)
    assert maintenance.vacuum(spark, wh) > 0  # the folders of the lost load
    assert stored(spark, wh) == full(spark, wh)


def test_two_writers_from_one_state(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    log, state = wh.log(spark), wh.state(spark)
    log.commit({"kind": "keys", "marks": {"x": 1}}, state)
    with pytest.raises(ConflictError):
        log.commit({"kind": "keys", "marks": {"x": 2}}, state)
    assert wh.state(spark).marks == {"x": 1}


def test_log_checkpoints(spark, workdir):
    wh = Warehouse(f"{workdir}/wh")
    state = wh.state(spark)
    for i in range(103):
        state = wh.log(spark).commit({"kind": "keys", "marks": {"x": i}}, state)
    again = wh.state(spark)
    assert again == state and again.version == 102 and again.marks == {"x": 102}


def test_delta_snapshot_equals_full_recompute(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    load(spark, wh, workdir, "a", purchase_lines()[:8], sale_lines()[:5])
    assert stored(spark, wh) == full(spark, wh)
    load(spark, wh, workdir, "b", purchase_lines()[8:12], None)  # no refresh after purchases alone
    load(spark, wh, workdir, "c", purchase_lines()[12:], sale_lines()[5:])
    assert stored(spark, wh) == full(spark, wh)
    load(spark, wh, workdir, "c", purchase_lines()[12:], sale_lines()[5:9])  # replaces its first run
    assert stored(spark, wh) == full(spark, wh)
    for day in ("2024-06-01", "2024-05-01"):  # a later cut-off, then an earlier one
        ingest.refresh_snapshot(spark, wh, day)
        assert stored(spark, wh, day) == full(spark, wh, day)


def test_delta_reads_touched_pairs_only(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    load(spark, wh, workdir, "a", purchase_lines(), sale_lines()[:-1])
    base = wh.state(spark)
    load(spark, wh, workdir, "b", None, sale_lines()[-1:])
    log = wh.log(spark)
    entry = log._read(f"{base.version + 1:010d}.entry.json")
    del entry["snapshots"]  # as the refresh of that load saw it
    state = base.apply(entry)
    touched = maintenance.touched_pairs(spark, wh, state, base.snapshots[DAY], dt.date(2024, 4, 1), dt.date(2024, 4, 1), 1)
    assert touched.count() == 1
    model = maintenance.only_pairs(wh.stats_model(spark, DAY, state=state), touched)
    plan = model.sale._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(agent_id" in plan or "In(agent_id" in plan  # pushed into the scan of sorted files


def test_compaction_keeps_results_and_bounds_files(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    for i in range(5):
        load(spark, wh, workdir, f"b{i}", purchase_lines()[i * 3:i * 3 + 3 + (i == 4)], sale_lines()[i * 3:i * 3 + 3])
    before = contents(spark, wh)
    totals = sorted(stats.agent_stats(wh.stats_model(spark, DAY), DAY).collect())
    assert maintenance.compact(spark, wh, "2030-01-01")
    state = wh.state(spark)
    assert all(len(parts) == 1 for t in ("purchase", "sale", "summary/sale") for parts in state.live[t].values())
    after = contents(spark, wh)
    assert after[:2] == before[:2] and after[3] == before[3]
    assert sorted(stats.agent_stats(wh.stats_model(spark, DAY), DAY).collect()) == totals
    assert maintenance.compact(spark, wh, "2030-01-01") == {}
    replay = load(spark, wh, workdir, "b0", purchase_lines()[:3], sale_lines()[:3])  # merged: not loaded again
    assert replay.loaded == {"purchase": 3, "sale": 3} and wh.model(spark).sale.count() == 15


@pytest.mark.parametrize("kind, key", [("agent", 1), ("product", 1), ("territory", 1), ("agent", 999)])
def test_stored_delete_equals_delete_of_frames(spark, workdir, kind, key):
    wh = fresh_warehouse(spark, workdir)
    load(spark, wh, workdir, "a", purchase_lines()[:9], sale_lines()[:8])
    load(spark, wh, workdir, "b", purchase_lines()[9:], sale_lines()[8:])
    model = wh.model(spark)
    kept, counts = {"agent": quality.cascade_delete_agent, "product": quality.cascade_delete_product,
                    "territory": quality.cascade_delete_territory}[kind](model, key)
    def rows(m):
        return {n: sorted(map(tuple, f.select(sorted(f.columns)).collect()), key=str) for n, f in m.tables().items()}

    want = rows(kept)
    numbers = {r.table_name: r.n_deleted for r in counts.collect()}
    untouched = wh.state(spark).live["sale"]
    deleted = {"agent": maintenance.delete_agent, "product": maintenance.delete_product,
               "territory": maintenance.delete_territory}[kind](spark, wh, key)
    assert deleted == numbers
    assert rows(wh.model(spark)) == want
    assert stored(spark, wh) == full(spark, wh)
    assert sorted(stats.agent_stats(wh.stats_model(spark, DAY), DAY).collect()) == sorted(stats.agent_stats(wh.model(spark), DAY).collect())
    if key == 999:
        assert wh.state(spark).live["sale"] == untouched


def test_keys_are_never_given_out_twice(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    top = wh.read_dimension(spark, "agent").agg(F.max("agent_id")).first()[0]
    names = spark.createDataFrame([("New B",), ("New A",), ("New A",), (None,), ("Agent 01",)], "agent_name string")
    first = dict(map(tuple, maintenance.assign_stored_keys(spark, wh, names, "agent", "agent_name", "agent_id").collect()))
    assert first == {"New A": top + 1, "New B": top + 2}
    # the new ones were never stored (or were deleted): their ids stay used up
    again = spark.createDataFrame([("New C",)], "agent_name string")
    assert maintenance.assign_stored_keys(spark, wh, again, "agent", "agent_name", "agent_id").first()[1] == top + 3
    assert maintenance.assign_stored_keys(spark, wh, names.limit(0), "agent", "agent_name", "agent_id").count() == 0


def test_bad_lines_and_files_do_not_stop_a_stream(spark, workdir):
    lines = sale_lines()
    bad = [*lines[0][:5], "12x", lines[0][6]]
    for mode, want in (("quarantine", 3), ("set_aside", 2)):
        root = f"{workdir}/{mode}"
        wh = fresh_warehouse(spark, root)
        write_csv(f"{root}/in/a.csv", SALE_HEADER, [bad, lines[1]])
        os.utime(f"{root}/in/a.csv", (1_700_000_000, 1_700_000_000))
        write_csv(f"{root}/in/b.csv", SALE_HEADER, lines[2:4])
        run_invoice_streams(spark, None, f"{root}/in", wh, f"{root}/ck", mode=mode, refresh_as_of=DAY)
        assert wh.model(spark).sale.count() == want
        reasons = sorted(r.reason for r in wh.read_quarantine(spark, "sale").collect())
        assert reasons == ["malformed row; missing value"] + ([ingest.SET_ASIDE] if mode == "set_aside" else [])


def test_random_rows(spark):
    rows = spark.createDataFrame([(i % 7, i) for i in range(500)], "a bigint, b bigint")
    all_rows = [tuple(r) for r in sampling.random_rows(rows, 1000, 3, ["a", "b"]).orderBy("pick_no").collect()]
    assert len(all_rows) == 500 and [r[2] for r in all_rows] == list(range(1, 501))
    for k in (0, 1, 10):
        assert sorted(map(tuple, sampling.random_rows(rows, k, 3, ["a", "b"]).collect())) == sorted(all_rows[:k])
    same = spark.createDataFrame([(1, 1)] * 50, "a bigint, b bigint")  # one key: the limit lets all or none pass
    assert sampling.random_rows(same, 5, 3, ["a"]).count() == 5
    assert sampling.random_rows(rows.limit(0), 5, 3, ["a"]).count() == 0
