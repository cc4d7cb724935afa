from __future__ import annotations

import csv
import os

import pytest
import render
from fixtures import (agent_name, invoice_model, parse_purchases, parse_sales, product_name, territory_rows)
from pyspark.sql import functions as F

from ledgerlight.operators import ingest, stats
from ledgerlight.operators.ingest import IngestError
from ledgerlight.plans.sinks import Warehouse, read_snapshot, write_snapshot
from ledgerlight.streaming.invoices import run_invoice_streams

PURCHASE_HEADER = ["date_bought", " product_name", " agent_name", " amount_bought"]
SALE_HEADER = ["date_sold", " product_name", " agent_name", " city", " district", " amount_sold", " price"]


def places():
    return {t[0]: (t[2], t[3]) for t in territory_rows()}


def purchase_lines():
    return [[str(day), product_name(p), agent_name(a), str(q)] for day, a, p, q in parse_purchases()]


def sale_lines():
    where = places()
    return [[str(day), product_name(p), agent_name(a), *where[t], str(q), str(r)]
            for day, p, a, t, q, r in parse_sales()]


def write_csv(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)
    return path


def fresh_warehouse(spark, root):
    wh = Warehouse(os.path.join(root, "wh"))
    wh.write_dimensions(invoice_model(spark))
    return wh


def test_batch_load_matches_fixture(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    p = write_csv(f"{workdir}/in/p.csv", PURCHASE_HEADER, purchase_lines())
    s = write_csv(f"{workdir}/in/s.csv", SALE_HEADER, sale_lines())
    result = ingest.ingest_invoices(spark, p, s, wh, mode="fail", refresh_as_of="2024-04-01")
    assert result.loaded == {"purchase": 16, "sale": 15}
    assert result.rejected == {"purchase": {}, "sale": {}}
    loaded = wh.model(spark)
    expected = invoice_model(spark)
    assert sorted(loaded.sale.collect()) == sorted(expected.sale.collect())
    assert sorted(loaded.purchase.collect()) == sorted(expected.purchase.collect())
    snap = read_snapshot(spark, wh.snapshot_path(), "2024-04-01")
    direct = stats.agent_product_stats(expected, "2024-04-01")
    assert sorted(snap.select(direct.columns).collect()) == sorted(direct.collect())


@pytest.mark.parametrize("mutate, reason", [
    (lambda rows: rows + [["2024-04-01", "Product A", "Nobody", "City 1", "District 1-1", "1", "1"]], "unknown agent"),
    (lambda rows: rows + [["2024-04-03", "Product A", "Agent 01", "City 1", "Nowhere", "1", "1"]],
     "unknown territory"),
    (lambda rows: rows + [rows[0]], "duplicate key in batch"),
    (lambda rows: rows + [["2024-04-02", "Product A", "A" * 257, "City 1", "District 1-1", "1", "1"]],
     "name too long"),
])
def test_fail_mode_rejects_and_writes_nothing(spark, workdir, mutate, reason):
    wh = fresh_warehouse(spark, workdir)
    p = write_csv(f"{workdir}/in/p.csv", PURCHASE_HEADER, purchase_lines())
    s = write_csv(f"{workdir}/in/s.csv", SALE_HEADER, mutate(sale_lines()))
    with pytest.raises(IngestError) as err:
        ingest.ingest_invoices(spark, p, s, wh, mode="fail")
    assert any(reason in key.split("; ") for key in err.value.counts), err.value.counts
    assert wh.model(spark).purchase.count() == 0  # purchases were not written either


def test_quarantine_and_reload(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    p = write_csv(f"{workdir}/in/p.csv", PURCHASE_HEADER, purchase_lines())
    first = ingest.ingest_invoices(spark, p, None, wh, mode="fail", batch_id="b1")
    assert first.loaded == {"purchase": 16}
    again = ingest.ingest_invoices(spark, p, None, wh, mode="quarantine", batch_id="b2")
    assert again.loaded == {"purchase": 0}
    assert again.rejected == {"purchase": {"key already loaded": 16}}
    assert spark.read.parquet(wh.path("quarantine", "purchase")).count() == 16
    replay = ingest.ingest_invoices(spark, p, None, wh, mode="fail", batch_id="b1")
    assert replay.loaded == {"purchase": 16}  # re-running a batch replaces its own rows
    assert wh.model(spark).purchase.count() == 16


def test_bad_number_fails_the_read(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    rows = purchase_lines()
    rows[3][3] = "12x"
    p = write_csv(f"{workdir}/in/p.csv", PURCHASE_HEADER, rows)
    with pytest.raises(Exception):
        ingest.ingest_invoices(spark, p, None, wh, mode="quarantine")


def test_stream_equals_batch(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    write_csv(f"{workdir}/pin/p1.csv", PURCHASE_HEADER, purchase_lines()[:9])
    write_csv(f"{workdir}/pin/p2.csv", PURCHASE_HEADER, purchase_lines()[9:])
    write_csv(f"{workdir}/sin/s1.csv", SALE_HEADER, sale_lines())
    run_invoice_streams(spark, f"{workdir}/pin", f"{workdir}/sin", wh, f"{workdir}/ckpt",
                        mode="fail", refresh_as_of="2024-04-01")
    expected = invoice_model(spark)
    got = wh.model(spark)
    assert sorted(got.purchase.collect()) == sorted(expected.purchase.collect())
    assert sorted(got.sale.collect()) == sorted(expected.sale.collect())
    totals = stats.agent_stats(got, "2024-04-01").filter(F.col("agent_id") == 1).first()
    assert (totals.qty_bought, totals.revenue, totals.profit) == (77, 780, 66)
    # a second run finds nothing new (checkpointed), so nothing is duplicated
    run_invoice_streams(spark, f"{workdir}/pin", f"{workdir}/sin", wh, f"{workdir}/ckpt", mode="fail")
    assert wh.model(spark).sale.count() == 15


def test_materialized_summaries_give_same_statistics(spark, workdir):
    from ledgerlight.sources.testdata import load_model
    m = load_model(spark, "/root/testdata/sf0.001")
    wh = Warehouse(f"{workdir}/wh")
    wh.materialize(m)
    from ledgerlight.operators import report_md
    for day in ("1996-03-15", "1998-12-31", "1999-01-01"):
        direct = sorted(stats.agent_stats(m, day).collect())
        summarised = sorted(stats.agent_stats(wh.stats_model(spark, day), day).collect())
        assert direct == summarised, day
        report = render.markdown(report_md.territory_markdown(m, day))
        assert report == render.markdown(report_md.territory_markdown(wh.report_model(spark, day), day)), day


def test_rerun_of_same_files_is_idempotent(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    p = write_csv(f"{workdir}/in/p.csv", PURCHASE_HEADER, purchase_lines())
    s = write_csv(f"{workdir}/in/s.csv", SALE_HEADER, sale_lines())
    first = ingest.ingest_invoices(spark, p, s, wh, mode="fail", refresh_as_of="2024-04-01")
    again = ingest.ingest_invoices(spark, p, s, wh, mode="fail", refresh_as_of="2024-04-01")
    assert first.batch_id == again.batch_id
    assert again.loaded == {"purchase": 16, "sale": 15}
    assert wh.model(spark).sale.count() == 15


def test_warehouse_reads_prune_months(spark, workdir):
    import datetime as dt

    from ledgerlight.sources.testdata import load_model
    wh = Warehouse(f"{workdir}/wh")
    wh.materialize(load_model(spark, "/root/testdata/sf0.001"))
    upto = wh.read_fact(spark, "sale", up_to=dt.date(1996, 1, 1))
    plan = upto._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "1996-01-01" in plan
    span = wh.read_fact(spark, "purchase", between=(dt.date(1997, 3, 5), dt.date(1997, 4, 20)))
    assert span.agg(F.min("date_bought"), F.max("date_bought")).first()[0] >= dt.date(1997, 3, 5)
    span_plan = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in span_plan and "1997-03-01" in span_plan


def test_batch_id_follows_file_content(spark, workdir):
    import time as _time
    p = write_csv(f"{workdir}/in/p.csv", PURCHASE_HEADER, purchase_lines())
    first = ingest.files_batch_id(spark, [p])
    assert ingest.files_batch_id(spark, [p]) == first
    _time.sleep(1.1)  # a rewrite gets a new modification time even with equal size
    write_csv(p, PURCHASE_HEADER, purchase_lines()[:-1])
    assert ingest.files_batch_id(spark, [p]) != first


def drain(spark, wh, folder, checkpoint, **options):
    run_invoice_streams(spark, None, folder, wh, checkpoint, refresh_as_of="2024-04-01", **options)


def test_second_checkpoint_adds_to_what_is_loaded(spark, workdir):
    wh, lines = fresh_warehouse(spark, workdir), sale_lines()
    write_csv(f"{workdir}/one/s.csv", SALE_HEADER, lines[:9])
    write_csv(f"{workdir}/two/s.csv", SALE_HEADER, lines[9:])
    drain(spark, wh, f"{workdir}/one", f"{workdir}/ck1")
    drain(spark, wh, f"{workdir}/two", f"{workdir}/ck2")
    assert wh.model(spark).sale.count() == 15


def test_load_after_a_fully_rejected_batch(spark, workdir):
    wh = fresh_warehouse(spark, workdir)
    bad = [[row[0], row[1], "Nobody", *row[3:]] for row in sale_lines()]
    first = ingest.ingest_invoices(spark, None, write_csv(f"{workdir}/a/s.csv", SALE_HEADER, bad), wh, mode="quarantine",
                                   batch_id="007", refresh_as_of="2024-04-01")
    assert first.loaded == {"sale": 0} and wh.model(spark).sale.count() == 0
    good = ingest.ingest_invoices(spark, None, write_csv(f"{workdir}/b/s.csv", SALE_HEADER, sale_lines()), wh,
                                  mode="quarantine", batch_id="008", refresh_as_of="2024-04-01")
    assert good.loaded == {"sale": 15} and wh.model(spark, exclude_batch="008").sale.count() == 0


def test_empty_refresh_empties_the_snapshot(spark, workdir):
    path = f"{workdir}/snap"
    rows = spark.createDataFrame([(1, 2)], "agent_id int, product_id int")
    write_snapshot(rows, path, "2024-04-01")
    write_snapshot(rows, path, "2024-05-01")
    write_snapshot(rows.limit(0), path, "2024-04-01")
    assert read_snapshot(spark, path, "2024-04-01").count() == 0
    assert read_snapshot(spark, path, "2024-05-01").count() == 1


def test_first_file_wins_in_one_drain_or_two(spark, workdir):
    lines, loaded = sale_lines()[:4], []
    again = [*lines[3][:-1], "1"]
    for drains in (1, 2):
        root = f"{workdir}/d{drains}"
        wh = fresh_warehouse(spark, root)
        write_csv(f"{root}/in/a.csv", SALE_HEADER, lines)
        os.utime(f"{root}/in/a.csv", (1_700_000_000, 1_700_000_000))
        if drains == 2:
            drain(spark, wh, f"{root}/in", f"{root}/ck")
        write_csv(f"{root}/in/b.csv", SALE_HEADER, [again])
        drain(spark, wh, f"{root}/in", f"{root}/ck")
        loaded.append(sorted(wh.model(spark).sale.collect()))
    assert loaded[0] == loaded[1] and len(loaded[0]) == 4 and 1 not in [r.price for r in loaded[0]]
