"""Warehouse layout: dimension tables, fact tables, summaries, snapshots, and the log that says what counts.

```
<root>/agent, <root>/product, <root>/territory         Parquet dimensions
<root>/purchase/part=<token>/month=<yyyy-MM-01>/...    facts
<root>/sale/part=<token>/month=<yyyy-MM-01>/...
<root>/summary/<table>/part=<token>/month=<...>/...    per (agent, product, month) sums of a part
<root>/snapshot/part=<token>/as_of=<date>/...          statistics snapshots
<root>/quarantine/<table>/part=<token>/...             rejected invoice rows
<root>/dimension/<name>/part=<token>/...               dimensions rewritten by a delete
<root>/_log/<number>.entry.json                        commits
```

Every load, compaction or delete writes folders under a new token and then commits one
log entry; a load that dies before leaves everything as it was.  The log lists the month
folders of each part, so a read opens the months it needs and lists nothing else, and
writers never share an output folder.  Files are sorted by (agent, product), so their
min/max statistics skip row groups for one agent.  ``compact`` merges the parts of a
month, ``delete_*`` (``operators.maintenance``) rewrites the months that lose rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from ledgerlight.functions.dates import as_date, shift_months
from ledgerlight.model import Model
from ledgerlight.plans.commits import CommitLog, State, token
from ledgerlight.schema import AGENT, PRODUCT, PURCHASE, SALE, TERRITORY

BLOCK_BYTES = 16 << 20  # of stored rows of a month that one task sums up
FACT_SCHEMAS = {"purchase": PURCHASE, "sale": SALE}


def run_concurrently(*jobs: Callable[[], object], workers: int = 4) -> list[object]:
    """Run independent Spark actions (writes) from a few driver threads.

    Each is its own Spark job, so the scheduler runs them side by side
    instead of one after another; the first failure is re-raised.
    """
    with ThreadPoolExecutor(max_workers=workers) as pool:
        futures = [pool.submit(job) for job in jobs]
        return [f.result() for f in futures]
DIM_SCHEMAS = {"agent": AGENT, "product": PRODUCT, "territory": TERRITORY}
DATE_COLUMN = {"purchase": "date_bought", "sale": "date_sold"}


def summary_schema(table: str) -> StructType:
    kinds = {f.name: f.dataType for f in FACT_SCHEMAS[table].fields}
    keys = ["agent_id", "product_id", *(["territory_id"] if table == "sale" else [])]
    sums = ["amount", *(["price"] if table == "sale" else [])]
    return StructType([*(StructField(k, kinds[k]) for k in keys), *(StructField(c, LongType()) for c in sums)])


@dataclass(frozen=True)
class Warehouse:
    root: str
    dims_root: str | None = None  # dimensions kept elsewhere (shared, read-only), else under root

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    # commits --------------------------------------------------------------
    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.path("_log"))

    def state(self, spark: SparkSession) -> State:
        return self.log(spark).state()

    # dimensions -----------------------------------------------------------
    def dim_path(self, name: str, state: State | None = None) -> str:
        if state is not None and name in state.dims:
            return self.path("dimension", name, f"part={state.dims[name]}")
        base = (self.dims_root or self.root).rstrip("/")
        return f"{base}/{name}"

    def write_dimensions(self, model: Model) -> None:
        """Replace the dimension tables; later refreshes recompute everything (prices may differ)."""
        spark = model.agent.sparkSession
        run_concurrently(*[
            (lambda n=name: getattr(model, n).write.mode("overwrite").parquet(self.dim_path(n)))
            for name in DIM_SCHEMAS])
        state = self.state(spark)
        if state.version >= 0:
            self.log(spark).commit({"kind": "dimensions"}, state)

    def write_dimension_part(self, df: DataFrame, name: str, part: str) -> None:
        df.select(*[f.name for f in DIM_SCHEMAS[name].fields]).write.parquet(
            self.path("dimension", name, f"part={part}"))

    def read_dimension(self, spark: SparkSession, name: str, state: State | None = None) -> DataFrame:
        state = state or self.state(spark)
        return spark.read.schema(DIM_SCHEMAS[name]).parquet(self.dim_path(name, state))

    # facts ----------------------------------------------------------------
    def write_fact(self, df: DataFrame, table: str, part: str) -> list[str]:
        """Write fact rows as one part, by month; returns the months.  Nothing counts before the commit.

        ``REBALANCE(month)`` groups each month's rows into few tasks (few
        files per month folder) while AQE splits a large month into chunks
        of the advisory partition size, so file and task sizes stay bounded
        whatever the volume.  Each file is sorted by (agent, product).
        """
        cols = [f.name for f in FACT_SCHEMAS[table].fields]
        return self._write_part(df.select(*cols).withColumn("month", F.trunc(F.col(DATE_COLUMN[table]), "month")),
                                table, part)

    def write_summary(self, df: DataFrame, table: str, part: str) -> list[str]:
        """Per (agent, product[, territory], month) sums of one part's rows.

        Sales keep their territory, so the same summary serves the agent /
        product statistics and the territory report.
        """
        amount = "amount_bought" if table == "purchase" else "amount_sold"
        sums = [F.sum(amount).alias("amount")]
        keys = ["agent_id", "product_id"]
        if table == "sale":
            sums.append(F.sum("price").alias("price"))
            keys.append("territory_id")
        rows = df.withColumn("month", F.trunc(F.col(DATE_COLUMN[table]), "month"))
        folder = self.path(table, f"part={part}")
        stored = [(m, part) for m in self._months(df.sparkSession, folder)] if self.exists(df.sparkSession, folder) else []
        return self.write_sums(rows, keys, sums, f"summary/{table}", part, self.blocks(df.sparkSession, table, stored))

    def blocks(self, spark: SparkSession, table: str, folders: list[tuple[str, str]]) -> int:
        """The number of ``BLOCK_BYTES`` in the largest month of some (month, part) folders, 1 at least."""
        base, sizes = self.path(*table.split("/")), {}
        for month, part in folders:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/part={part}/month={month}")
            fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            sizes[month] = sizes.get(month, 0) + fs.getContentSummary(path).getLength()
        return max(1, -(-max(sizes.values(), default=0) // BLOCK_BYTES))

    def write_sums(self, rows: DataFrame, keys: list[str], sums: list[Column], table: str, part: str, blocks: int = 1) -> list[str]:
        """Write ``sums`` per ``keys`` and ``month`` as one part.

        The rows are dealt by month and block of pairs (``blocks`` a month), which serves the grouping
        and the folders alike: one shuffle, and a task's memory doesn't grow with the table.
        """
        block = F.pmod(F.hash("agent_id", "product_id"), F.lit(blocks)).alias("_ll_block")
        dealt = rows.select("*", block).repartition("month", "_ll_block")
        return self._write_files(dealt.groupBy("month", "_ll_block", *keys).agg(*sums).drop("_ll_block"), table, part)

    def _write_part(self, rows: DataFrame, table: str, part: str) -> list[str]:
        return self._write_files(rows.hint("rebalance", "month"), table, part)

    def _write_files(self, dealt: DataFrame, table: str, part: str) -> list[str]:
        folder = self.path(*table.split("/"), f"part={part}")
        dealt.sortWithinPartitions("month", "agent_id", "product_id").write.partitionBy("month").parquet(folder)
        return self._months(dealt.sparkSession, folder)

    def _months(self, spark: SparkSession, folder: str) -> list[str]:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(n.removeprefix("month=") for n in names if n.startswith("month="))

    def read_parts(self, spark: SparkSession, table: str, folders: list[tuple[str, str]]) -> DataFrame:
        """The rows of some (month, part) folders of a fact or summary table, with ``month`` and ``part``."""
        kind = table.split("/")[-1]
        schema = summary_schema(kind) if table.startswith("summary/") else FACT_SCHEMAS[kind]
        # declared, never inferred: a token may look like a number
        stored = StructType([*schema.fields, StructField("part", StringType()), StructField("month", DateType())])
        if not folders:
            return spark.createDataFrame([], stored)
        base = self.path(*table.split("/"))
        return (spark.read.schema(stored).option("basePath", base)
                .parquet(*[f"{base}/part={p}/month={m}" for m, p in folders]))

    def read_summary(self, spark: SparkSession, table: str, state: State | None = None, before: dt.date | None = None
                     ) -> DataFrame:
        state = state or self.state(spark)
        keep = None if before is None else (lambda m: m < before.isoformat())
        rows = self.read_parts(spark, f"summary/{table}", state.parts(f"summary/{table}", keep))
        return rows.drop("part")

    def exists(self, spark: SparkSession, path: str) -> bool:
        jvm = spark.sparkContext._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(hadoop_path))

    def read_fact(self, spark: SparkSession, table: str, exclude_batch: str | None = None,
                  between: tuple | None = None, up_to=None, state: State | None = None) -> DataFrame:
        """Committed rows of a fact table.

        ``exclude_batch`` hides one batch's own earlier output; ``between``
        (first, last date) and ``up_to`` (last date) choose month folders
        before any file is listed.
        """
        state = state or self.state(spark)
        hidden = state.batches.get(exclude_batch or "", {}).get("part")
        lo = None if between is None else as_date(between[0]).replace(day=1).isoformat()
        hi = None if between is None and up_to is None else as_date(between[1] if between else up_to).isoformat()
        folders = [(m, p) for m, p in state.parts(table, lambda m: (lo is None or m >= lo) and (hi is None or m <= hi))
                   if p != hidden]
        df = self.read_parts(spark, table, folders)
        day = F.col(DATE_COLUMN[table])
        if between is not None:
            lo, hi = between
            df = df.filter(F.col("month").cast("date").between(F.trunc(F.lit(lo), "month"), F.lit(hi))
                           & day.between(F.lit(lo), F.lit(hi)))
        if up_to is not None:
            df = df.filter((F.col("month").cast("date") <= F.lit(up_to)) & (day <= F.lit(up_to)))
        return df.select(*[F.col(f.name).cast(f.dataType) for f in FACT_SCHEMAS[table].fields])

    def model(self, spark: SparkSession, exclude_batch: str | None = None, up_to=None, state: State | None = None) -> Model:
        """Dimensions and facts; ``up_to`` (a date) reads only the months up to it."""
        state = state or self.state(spark)
        return Model(
            **{n: self.read_dimension(spark, n, state) for n in DIM_SCHEMAS},
            purchase=self.read_fact(spark, "purchase", exclude_batch, up_to=up_to, state=state),
            sale=self.read_fact(spark, "sale", exclude_batch, up_to=up_to, state=state),
        )

    def facts_up_to(self, spark: SparkSession, table: str, cutoff, state: State | None = None) -> DataFrame:
        """Fact rows up to ``cutoff`` (inclusive), read cheaply for the statistics.

        Whole months before the cutoff's month come from the
        monthly summaries (one row per pair [and territory] and month, dated
        the 1st); only the cutoff's own month is read from the raw facts.
        """
        state = state or self.state(spark)
        date_col = DATE_COLUMN[table]
        amount_col = "amount_bought" if table == "purchase" else "amount_sold"
        extra = ["price"] if table == "sale" else []
        keys = ["agent_id", "product_id"] + (["territory_id"] if table == "sale" else [])
        first = cutoff.replace(day=1)
        recent = self.read_fact(spark, table, between=(first, cutoff), state=state).select(date_col, *keys, amount_col, *extra)
        older = (self.read_summary(spark, table, state, before=first)
                 .select(F.col("month").alias(date_col), *keys,
                         F.col("amount").cast("bigint").alias(amount_col),
                         *[F.col(c).cast("bigint").alias(c) for c in extra]))
        return older.unionByName(recent)

    def report_model(self, spark: SparkSession, as_of, state: State | None = None) -> Model:
        """A model for the territory report at ``as_of`` (sales strictly before it) from summaries."""
        day, state = as_date(as_of), state or self.state(spark)
        return Model(
            **{n: self.read_dimension(spark, n, state) for n in DIM_SCHEMAS},
            purchase=spark.createDataFrame([], FACT_SCHEMAS["purchase"]),
            sale=self.facts_up_to(spark, "sale", day - dt.timedelta(days=1), state),
        )

    def stats_model(self, spark: SparkSession, as_of, lag_months: int = 1, state: State | None = None) -> Model:
        """A model for ``operators.stats`` at ``as_of`` reading summaries for whole months."""
        day, state = as_date(as_of), state or self.state(spark)
        return Model(
            **{n: self.read_dimension(spark, n, state) for n in DIM_SCHEMAS},
            purchase=self.facts_up_to(spark, "purchase", shift_months(day, -lag_months), state),
            sale=self.facts_up_to(spark, "sale", day, state),
        )

    def write_rows(self, rows: dict[str, DataFrame], part: str) -> dict[str, dict[str, list[str]]]:
        """Facts and their summaries as one part; what a log entry adds.

        The summary is made of the facts just written, so whatever ``rows`` are derived from is read once.
        """
        def write(table: str, frame: DataFrame) -> dict[str, dict[str, list[str]]]:
            months = self.write_fact(frame, table, part)
            stored = self.read_parts(frame.sparkSession, table, [(m, part) for m in months])
            return {table: {part: months}, f"summary/{table}": {part: self.write_summary(stored, table, part)}}

        done = run_concurrently(*[lambda t=t, f=f: write(t, f) for t, f in rows.items()])
        return {name: added for one in done for name, added in one.items()}

    def materialize(self, model: Model, batch_id: str = "initial") -> None:
        """Write a whole model (dimensions and facts) into this warehouse as one commit.

        Queries then read the month-partitioned facts instead of re-deriving
        them from their sources on every run.
        """
        spark = model.agent.sparkSession
        self.write_dimensions(model)
        state, part = self.state(spark), token()
        added = self.write_rows({"purchase": model.purchase, "sale": model.sale}, part)
        self.log(spark).commit({"kind": "load", "batch": batch_id, "part": part, "loaded": {}, "rejected": {},
                                "add": added, "drop": self.replaced(state, batch_id)}, state)

    def replaced(self, state: State, batch_id: str) -> dict[str, dict[str, list[str]]]:
        """What a repeated batch takes out of the state: the folders of its earlier run."""
        old = state.batches.get(batch_id, {}).get("part")
        out: dict[str, dict[str, list[str]]] = {}
        for table in state.live:
            for month, part in state.parts(table):
                if part == old:
                    out.setdefault(table, {}).setdefault(month, []).append(part)
        return out

    # quarantine -----------------------------------------------------------
    def write_quarantine(self, df: DataFrame, table: str, part: str) -> None:
        df.write.parquet(self.path("quarantine", table, f"part={part}"))

    def read_quarantine(self, spark: SparkSession, table: str, state: State | None = None) -> DataFrame | None:
        """Committed rejected rows of a table with the ``part`` of their load, None when there are none."""
        state = state or self.state(spark)
        base = self.path("quarantine", table)
        folders = [f"{base}/part={p}" for _, p in state.parts(f"quarantine/{table}")]
        reader = spark.read.option("basePath", base).option("mergeSchema", "true")  # bad lines have a column more
        return reader.parquet(*folders).withColumn("part", F.col("part").cast("string")) if folders else None

    # snapshots ------------------------------------------------------------
    def snapshot_path(self, as_of=None, state: State | None = None) -> str:
        """The folder of the committed snapshot at ``as_of`` (default: of the one committed last)."""
        state = state or self.state(SparkSession.getActiveSession())
        known = state.snapshots
        day = str(as_of) if as_of is not None else max(known, key=lambda d: (known[d]["version"], d), default=None)
        if day not in known:
            raise FileNotFoundError(f"no snapshot at {day} in {self.root}")
        return self.path("snapshot", f"part={known[day]['part']}")

    def read_snapshot(self, spark: SparkSession, as_of, state: State | None = None) -> DataFrame:
        return spark.read.parquet(f"{self.snapshot_path(as_date(as_of), state or self.state(spark))}/as_of={as_date(as_of)}")


def write_snapshot(snapshot: DataFrame, path: str, as_of) -> None:
    """Replace the ``as_of`` folder of a snapshot table with ``snapshot``, also by no rows at all."""
    snapshot.write.mode("overwrite").parquet(f"{path.rstrip('/')}/as_of={as_of}")


def read_snapshot(spark: SparkSession, path: str, as_of) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("as_of") == F.lit(as_of)).drop("as_of")
