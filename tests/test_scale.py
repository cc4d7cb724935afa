"""Work that must not grow with the tables: invoices in several files, one shuffle a summary, no shuffle for few marked keys."""

from __future__ import annotations

import os

import duckdb
from fixtures import invoice_model
from pyspark.sql import functions as F
from test_entry import SF, TABLES, norm, rows_by_name
from test_ingest import fresh_warehouse

import __spark_entry__ as entry
from ledgerlight.operators import ingest, maintenance, quality
from ledgerlight.plans import session, sinks
from ledgerlight.queries import ingest as queries
from ledgerlight.sources import invoices, testdata


def against_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df, cur = entry.queries()[name](spark, SF), con.execute(entry.oracle_sql()[name])
    assert rows_by_name(df.columns, df.collect()) == rows_by_name([c[0] for c in cur.description], cur.fetchall())


def test_two_invoices_of_several_files_are_two_transactions(spark, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 1000)
    made = []
    two = queries._two_invoices
    monkeypatch.setattr(queries, "_two_invoices", lambda *args: made.append(two(*args)) or made[-1])
    for name in ("stream_duplicate_across_files", "invoice_files_set_aside"):
        against_oracle(spark, name)
        wh, _, inbox, files = made.pop()
        parts = [n for n in os.listdir(inbox.removeprefix("file:")) if n.startswith("part-")]
        assert files > 2 and files < len(parts) <= 2 * files
        assert len(wh.state(spark).batches) == 2


def test_only_the_invoices_a_query_loads_are_written(spark, monkeypatch):
    monkeypatch.setattr(queries, "_INPUTS", {})
    written = []
    monkeypatch.setattr(invoices, "write_invoice", lambda stage, path, *args, **options: written.append(path))
    queries._warehouse(spark, SF, "none")
    assert written == []
    _, _, inbox = queries._warehouse(spark, SF, "sale", "sale")
    assert written == [f"{inbox}/sale"]


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_summaries_come_from_the_written_facts_in_one_shuffle(spark, workdir, monkeypatch):
    wh = fresh_warehouse(spark, workdir)
    seen, files = {}, sinks.Warehouse._write_files
    monkeypatch.setattr(sinks.Warehouse, "_write_files", lambda self, dealt, table, part: (
        seen.__setitem__(table, dealt), files(self, dealt, table, part))[1])
    m = invoice_model(spark)
    for share in (0, 1):
        part = f"p{share}"
        rows = {t: getattr(m, t).filter(F.pmod("product_id", F.lit(2)) == share) for t in ("purchase", "sale")}
        added = wh.write_rows(rows, part)
        for t in rows:
            summary = seen[f"summary/{t}"]
            assert all(f"/{t}/part={part}/" in f for f in summary.inputFiles()) and summary.inputFiles()
            assert exchanges(summary) == 1
        wh.log(spark).commit({"kind": "load", "batch": part, "part": part, "loaded": {}, "rejected": {}, "add": added}, wh.state(spark))
    maintenance.compact(spark, wh, "9999-01-01")
    for t in ("purchase", "sale"):
        assert exchanges(seen[f"summary/{t}"]) == 1
        amount = "amount_bought" if t == "purchase" else "amount_sold"
        keys = ["agent_id", "product_id", *(["territory_id"] if t == "sale" else [])]
        want = getattr(m, t).groupBy(*keys, F.trunc(sinks.DATE_COLUMN[t], "month").alias("month")).agg(F.sum(amount).alias("amount"))
        got = wh.read_summary(spark, t).select(*want.columns)
        assert sorted(got.collect()) == sorted(want.collect())


def test_blocks_follow_the_largest_month(spark, workdir, monkeypatch):
    wh = fresh_warehouse(spark, workdir)
    months = wh.write_fact(invoice_model(spark).sale, "sale", "p")
    assert wh.blocks(spark, "sale", [(m, "p") for m in months]) == 1
    monkeypatch.setattr(sinks, "BLOCK_BYTES", 500)
    assert wh.blocks(spark, "sale", [(m, "p") for m in months]) > 1
    many = wh.write_summary(wh.read_parts(spark, "sale", [(m, "p") for m in months]), "sale", "p")
    assert many == months
    stored = wh.read_parts(spark, "summary/sale", [(m, "p") for m in months])
    assert stored.count() == stored.select("month", "agent_id", "product_id", "territory_id").distinct().count()
    assert stored.agg(F.sum("amount")).first()[0] == invoice_model(spark).sale.agg(F.sum("amount_sold")).first()[0]


def test_few_marked_keys_shuffle_no_row_of_the_batch(spark, workdir):
    m = invoice_model(spark)
    resolved = ingest._checked(ingest.resolve_sales(invoices.sale_stage(m), m))
    one = m.sale.limit(1)
    key = ["date_sold", "product_id", "agent_id"]
    flagged = quality.flag_sales(resolved.unionByName(resolved.limit(1)), one, ingest._settled)
    assert exchanges(flagged) == 0 and "BroadcastHashJoin" in flagged._jdf.queryExecution().executedPlan().toString()
    lazy = quality.flag_sales(resolved.unionByName(resolved.limit(1)), one)
    assert sorted(map(norm, flagged.select(*key, "reason").collect())) == sorted(map(norm, lazy.select(*key, "reason").collect()))
    reasons = {r.reason for r in flagged.collect()}
    assert "key already loaded" in reasons or "duplicate key in batch; key already loaded" in reasons


def test_partitions_follow_the_input(spark):
    name = session.INITIAL_PARTITIONS
    try:
        session.scale_partitions(spark, 1000 * session.BYTES_PER_PARTITION + 1)
        assert spark.conf.get(name) == "1001"
        testdata.load_model(spark, SF)  # small tables: the session's own number again
        assert spark.conf.get(name, None) is None
        spark.conf.set(name, "7")  # the user's stays
        session.scale_partitions(spark, 1000 * session.BYTES_PER_PARTITION)
        assert spark.conf.get(name) == "7"
    finally:
        spark.conf.unset(name)
