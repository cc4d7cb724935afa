"""Data-quality rules of the model (keys, names, references).

Each rule is a DataFrame transformation that flags or lists offending rows;
nothing is collected except per-reason counts.

* K1 primary key unique within a batch and against loaded facts
* K2 every name resolves to a key
* K3 required values present, names at most ``MAX_NAME_LENGTH`` long
* K4 every fact row references existing dimension rows
* K5 new dimension members get generated keys after the current maximum
* K6 deleting an agent removes its purchases, sales and territories, and
  every sale made in those territories
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.model import Model
from ledgerlight.plans.indexing import global_row_number
from ledgerlight.plans.joins import maybe_broadcast
from ledgerlight.schema import MAX_NAME_LENGTH, PURCHASE_KEY, SALE_KEY
from ledgerlight.sources.invoices import MALFORMED

REASON = "reason"


def reasons(*checks: tuple[Column, str]) -> Column:
    """``'a; b'`` for every failed check, NULL when all pass."""
    text = F.concat_ws("; ", *[F.when(cond, F.lit(label)) for cond, label in checks])
    return F.when(text == "", F.lit(None).cast("string")).otherwise(text)


def key_marks(batch: DataFrame, loaded: DataFrame | None, key: list[str]) -> DataFrame:
    """Keys of ``batch`` that occur in it more than once (``_ll_dup``) or are in ``loaded`` (``_ll_loaded``).

    A row per such key, so usually few.  Only keys are shuffled, pre-counted on the map side.
    Callers pass the facts already limited to the batch's date span (see
    ``ingest.load_batch``) so only those partitions are scanned.
    """
    keys = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("_ll_n"))
    if loaded is None:
        keys = keys.withColumn("_ll_loaded", F.lit(False))
    else:
        known = loaded.select(*key).distinct().withColumn("_ll_loaded", F.lit(True))
        keys = keys.join(known, key, "left").withColumn("_ll_loaded", F.coalesce("_ll_loaded", F.lit(False)))
    return keys.filter("_ll_n > 1 OR _ll_loaded").select(*key, (F.col("_ll_n") > 1).alias("_ll_dup"), "_ll_loaded")


def with_key_flags(batch: DataFrame, loaded: DataFrame | None, key: list[str],
                   settle: Callable[[DataFrame], DataFrame] = maybe_broadcast) -> DataFrame:
    """``batch`` with ``_ll_dup`` and ``_ll_loaded``; ``settle`` decides how the marked keys are joined."""
    flagged = batch.join(settle(key_marks(batch, loaded, key)), key, "left")
    return flagged.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("_ll_dup", "_ll_loaded")})


def too_long(*cols: str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | (F.length(F.col(c)) > MAX_NAME_LENGTH)
    return out


def any_null(*cols: str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | F.col(c).isNull()
    return out


def _is_malformed(df: DataFrame) -> Column:
    return F.col(MALFORMED).isNotNull() if MALFORMED in df.columns else F.lit(False)


def flag_purchases(resolved: DataFrame, loaded: DataFrame | None = None,
                   settle: Callable[[DataFrame], DataFrame] = maybe_broadcast) -> DataFrame:
    """Resolved purchase stage with a ``reason`` column (NULL = row may be loaded)."""
    df = with_key_flags(resolved, loaded, PURCHASE_KEY, settle)
    flagged = df.withColumn(REASON, reasons(
        (_is_malformed(df), "malformed row"),
        (any_null("date_bought", "product_name", "agent_name", "amount_bought"), "missing value"),
        (too_long("product_name", "agent_name"), "name too long"),
        (F.col("agent_id").isNull(), "unknown agent"),
        (F.col("product_id").isNull(), "unknown product"),
        (F.col("_ll_dup"), "duplicate key in batch"),
        (F.col("_ll_loaded"), "key already loaded"),
    ))
    return flagged.drop("_ll_dup", "_ll_loaded")


def flag_sales(resolved: DataFrame, loaded: DataFrame | None = None,
               settle: Callable[[DataFrame], DataFrame] = maybe_broadcast) -> DataFrame:
    """Resolved sale stage with a ``reason`` column (NULL = row may be loaded)."""
    df = with_key_flags(resolved, loaded, SALE_KEY, settle)
    flagged = df.withColumn(REASON, reasons(
        (_is_malformed(df), "malformed row"),
        (any_null("date_sold", "product_name", "agent_name", "city", "district", "amount_sold", "price"),
         "missing value"),
        (too_long("product_name", "agent_name", "city", "district"), "name too long"),
        (F.col("agent_id").isNull(), "unknown agent"),
        (F.col("product_id").isNull(), "unknown product"),
        (F.col("territory_id").isNull(), "unknown territory"),
        (F.col("_ll_dup"), "duplicate key in batch"),
        (F.col("_ll_loaded"), "key already loaded"),
    ))
    return flagged.drop("_ll_dup", "_ll_loaded")


def duplicate_keys(fact: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (K1 on a loaded table)."""
    return (fact.groupBy(*key).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def duplicate_names(dim: DataFrame, name_cols: list[str]) -> DataFrame:
    """Dimension names that are not unique (a lookup by them would fan out)."""
    return duplicate_keys(dim, name_cols)


def orphan_rows(model: Model) -> DataFrame:
    """Fact rows whose agent, product or territory does not exist, a row per missing reference (K4).

    Each table is read once: its references are looked up side by side, and the reasons of a
    row are exploded.
    """
    def looked_up(rows: DataFrame, table: str, date_col: str | None, checks: list[tuple[str, DataFrame, str]]) -> DataFrame:
        missing = []
        for i, (column, dim, reason) in enumerate(checks):
            keys = dim.select(F.col(column).alias(f"_ll_k{i}")).distinct()
            rows = rows.join(maybe_broadcast(keys), F.col(column) == F.col(f"_ll_k{i}"), "left")
            missing.append(F.when(F.col(f"_ll_k{i}").isNull(), F.lit(reason)))
        found = rows.withColumn("reason", F.explode(F.array_compact(F.array(*missing))))
        return found.select(
            F.lit(table).alias("table_name"), "reason", "agent_id",
            (F.col("product_id") if "product_id" in rows.columns else F.lit(None).cast("bigint")).alias("product_id"),
            (F.col("territory_id") if "territory_id" in rows.columns else F.lit(None).cast("bigint")).alias("territory_id"),
            (F.col(date_col) if date_col else F.lit(None).cast("date")).alias("row_date"))

    agent, product = ("agent_id", model.agent, "unknown agent"), ("product_id", model.product, "unknown product")
    place = ("territory_id", model.territory, "unknown territory")
    owned = model.territory.filter(F.col("agent_id").isNotNull())
    return (looked_up(model.purchase, "purchase", "date_bought", [agent, product])
            .unionByName(looked_up(model.sale, "sale", "date_sold", [agent, product, place]))
            .unionByName(looked_up(owned, "territory", None, [("agent_id", model.agent, "unknown owner")])))


def assign_keys(candidates: DataFrame, dim: DataFrame, name_col: str, id_col: str) -> DataFrame:
    """Generated keys for names not yet in ``dim``: current maximum + 1, 2, ... by name (K5)."""
    new = (candidates.select(F.col(name_col)).filter(F.col(name_col).isNotNull()).distinct()
           .join(dim.select(name_col), name_col, "left_anti"))
    top = dim.agg(F.max(id_col).alias("m")).first()
    base = 0 if top is None or top["m"] is None else int(top["m"])
    numbered = global_row_number(new, [F.col(name_col)], "_ll_n")
    return numbered.select(name_col, (F.lit(base) + F.col("_ll_n")).cast("bigint").alias(id_col))


def cascade_delete_agent(model: Model, agent_id: int) -> tuple[Model, DataFrame]:
    """The model without one agent and everything that depends on it, plus per-table counts (K6)."""
    gone = F.col("agent_id") == F.lit(agent_id)
    lost_places = model.territory.filter(gone).select("territory_id")
    sale_gone = model.sale.join(maybe_broadcast(lost_places.withColumn("_ll_t", F.lit(True))),
                                "territory_id", "left")
    sale_hit = gone | F.col("_ll_t").isNotNull()
    kept = Model(
        agent=model.agent.filter(~gone),
        product=model.product,
        territory=model.territory.filter(~gone | F.col("agent_id").isNull()),
        purchase=model.purchase.filter(~gone),
        sale=sale_gone.filter(~sale_hit).drop("_ll_t"),
    )
    counts = [
        model.agent.filter(gone).agg(F.count(F.lit(1)).alias("n")).select(F.lit("agent").alias("table_name"), "n"),
        model.territory.filter(gone).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("territory").alias("table_name"), "n"),
        model.purchase.filter(gone).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("purchase").alias("table_name"), "n"),
        sale_gone.filter(sale_hit).agg(F.count(F.lit(1)).alias("n")).select(F.lit("sale").alias("table_name"), "n"),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return kept, out.select("table_name", F.col("n").cast("bigint").alias("n_deleted"))


def _without(model: Model, column: str, value: int, tables: list[str]) -> tuple[Model, DataFrame]:
    """The model without the rows of ``tables`` whose ``column`` is ``value``, and how many each loses."""
    gone = F.col(column) == F.lit(value)
    kept, counts = dict(model.tables()), []
    for name in tables:
        table = kept[name]
        kept[name] = table.filter(~gone | F.col(column).isNull())
        counts.append(table.agg(F.count(F.when(gone, 1)).alias("n_deleted"))
                      .select(F.lit(name).alias("table_name"), F.col("n_deleted").cast("bigint")))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return Model(**kept), out


def cascade_delete_product(model: Model, product_id: int) -> tuple[Model, DataFrame]:
    """The model without one product, its purchases and its sales, plus per-table counts (K6)."""
    return _without(model, "product_id", product_id, ["product", "purchase", "sale"])


def cascade_delete_territory(model: Model, territory_id: int) -> tuple[Model, DataFrame]:
    """The model without one territory and the sales in it, plus per-table counts (K6)."""
    return _without(model, "territory_id", territory_id, ["territory", "sale"])
