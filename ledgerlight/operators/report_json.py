"""JSON documents for agents and their products.

* ``agent_stats_json`` / ``agent_product_json``: one JSON object per row
  (numbers stay numbers), i.e. JSON Lines.
* ``agent_document_fragments``: the combined document
  ``{"<root>":[{agent..., "data":[{product...}, ...] | null}, ...]}`` with
  every value as text, emitted as ordered fragments: one per agent head,
  one per product, one closing fragment per agent with products, plus the
  document's opening and closing fragments.  Concatenating the
  ``fragment`` column in (doc_part, agent_no, part, child_name, child_id)
  order gives the document; no agent's products are ever gathered into one
  value, so a hot agent cannot overload a task.

Agents are numbered by name with the distributed ``global_row_number`` (no
single-partition window), which also decides which agent head carries a
leading comma; the first product of each agent is found with a partial
``min`` aggregate joined back on the agent key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlight.functions.dates import DateLike
from ledgerlight.model import Model
from ledgerlight.operators import stats
from ledgerlight.plans.indexing import global_row_number, row_number_within
from ledgerlight.plans.joins import maybe_broadcast
from ledgerlight.plans.session import ensure_checkpoint_dir

JSON_OPTIONS = {"ignoreNullFields": "false"}

# Output key -> source column, in document order.
AGENT_KEYS = {"agent_name": "agent_name", **{m: m for m in stats.MEASURES}}
PRODUCT_KEYS = {"product_name": "product_name", **{m: m for m in stats.MEASURES}}

# The original combined document's key names, for identical output.
REFERENCE_ROOT = "dealers"
REFERENCE_AGENT_KEYS = {
    "street_name": "agent_name",
    "amount_bought": "qty_bought",
    "amount_payed": "cost",
    "amount_sold": "qty_sold",
    "amount_gained": "revenue",
    "debt": "debt",
    "profit": "profit",
}
REFERENCE_PRODUCT_KEYS = {
    "drug_name": "product_name",
    "amount_bought": "qty_bought",
    "amount_payed": "cost",
    "amount_sold": "qty_sold",
    "amount_gained": "revenue",
    "debt": "debt",
    "profit": "profit",
}
REFERENCE_STATS_KEYS = {
    "street_name": "agent_name",
    "am_bought": "qty_bought",
    "am_payed": "cost",
    "am_sold": "qty_sold",
    "am_gained": "revenue",
    "debt": "debt",
    "profit": "profit",
}
REFERENCE_PAIR_KEYS = {
    "street_name": "agent_name",
    "name": "product_name",
    "am_bought": "qty_bought",
    "am_payed": "cost",
    "am_sold": "qty_sold",
    "am_gained": "revenue",
    "debt": "debt",
    "profit": "profit",
}

FRAGMENT_COLUMNS = ["doc_part", "agent_no", "agent_id", "part", "child_name", "child_id", "fragment"]


def json_object(keys: dict[str, str], as_text: bool = False) -> Column:
    fields = [(F.col(src).cast("string") if as_text else F.col(src)).alias(key) for key, src in keys.items()]
    return F.to_json(F.struct(*fields), JSON_OPTIONS)


def agent_stats_json(totals: DataFrame, keys: dict[str, str] = AGENT_KEYS) -> DataFrame:
    """One JSON object per agent (numbers as numbers)."""
    return totals.select("agent_id", json_object(keys).alias("doc"))


def agent_product_json(named: DataFrame, keys: dict[str, str] | None = None) -> DataFrame:
    """One JSON object per (agent, product) pair (numbers as numbers)."""
    keys = keys or {"agent_name": "agent_name", **PRODUCT_KEYS}
    return named.select("agent_id", "product_id", json_object(keys).alias("doc"))


ARRAY_COLUMNS = ["doc_part", "item_no", "fragment"]


def array_fragments(docs: DataFrame, order_cols: list[str], doc_col: str = "doc",
                    bounded_by: DataFrame | None = None) -> DataFrame:
    """A JSON array of per-row objects as ordered fragments: ``[``, items, ``]``.

    Items are numbered with ``global_row_number`` (distributed unless the
    items are provably few: ``bounded_by`` has at least as many rows); every
    item but the first carries a leading comma.  No rows give the document
    ``null`` (an aggregate over nothing), as the original functions return.
    """
    items = global_row_number(docs, [F.col(c) for c in order_cols], "item_no", bounded_by=bounded_by)
    body = items.select(
        F.lit(1).alias("doc_part"), "item_no",
        F.concat(F.when(F.col("item_no") > 1, F.lit(",")).otherwise(F.lit("")), F.col(doc_col)).alias("fragment"))
    n = docs.agg(F.count(F.lit(1)).alias("n"))
    edges = n.select(F.explode(F.array(
        F.struct(F.lit(0).alias("doc_part"), F.when(F.col("n") == 0, F.lit("null")).otherwise(F.lit("["))
                 .alias("fragment")),
        F.struct(F.lit(2).alias("doc_part"), F.when(F.col("n") == 0, F.lit("")).otherwise(F.lit("]"))
                 .alias("fragment")),
    )).alias("e")).select(F.col("e.doc_part").alias("doc_part"), F.lit(0).cast("bigint").alias("item_no"),
                          F.col("e.fragment").alias("fragment"))
    return edges.unionByName(body).select(*ARRAY_COLUMNS)



def agent_stats_document(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                         keys: dict[str, str] = AGENT_KEYS) -> DataFrame:
    """Per-agent totals as one JSON array ordered by agent name (numbers as numbers)."""
    totals = stats.agent_stats(model, as_of, agent_id=agent_id)
    docs = totals.select("agent_id", "agent_name", json_object(keys).alias("doc"))
    return array_fragments(docs, ["agent_name", "agent_id"], bounded_by=model.agent)  # one item per agent


def agent_product_document(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                           keys: dict[str, str] | None = None) -> DataFrame:
    """Per-pair statistics as one JSON array ordered by agent then product name."""
    keys = keys or {"agent_name": "agent_name", **PRODUCT_KEYS}
    named = stats.agent_product_named(model, as_of, agent_id=agent_id)
    docs = named.select("agent_name", "agent_id", "product_name", "product_id", json_object(keys).alias("doc"))
    return array_fragments(docs, ["agent_name", "agent_id", "product_name", "product_id"])


def agent_document_fragments(totals: DataFrame, named: DataFrame, root: str = "agents",
                             agent_keys: dict[str, str] = AGENT_KEYS,
                             product_keys: dict[str, str] = PRODUCT_KEYS,
                             agents: DataFrame | None = None) -> DataFrame:
    """Fragments of the combined document (see module docstring).

    ``agents`` (agent_id, agent_name), when given, is the dimension the
    totals were built from (one totals row per agent); numbering it instead
    of the derived totals lets the size check see a plain table scan.
    """
    dim = agents
    if agents is not None:
        numbers = global_row_number(agents.select("agent_id", "agent_name"),
                                    [F.col("agent_name"), F.col("agent_id")], "agent_no")
        agents = totals.join(numbers.select("agent_id", "agent_no"), "agent_id")
    else:
        agents = global_row_number(totals, [F.col("agent_name"), F.col("agent_id")], "agent_no")
    if "_first" in totals.columns:  # computed with the totals in one aggregation
        heads = agents
    else:
        firsts = named.groupBy("agent_id").agg(F.min(F.struct("product_name", "product_id")).alias("_first"))
        heads = agents.join(maybe_broadcast(firsts), "agent_id", "left")
    head_json = json_object(agent_keys, as_text=True)
    head_body = F.expr("substr(_ll_obj, 1, length(_ll_obj) - 1)")
    head = (heads.withColumn("_ll_obj", head_json)
            .select(
                F.lit(1).alias("doc_part"), "agent_no", "agent_id", F.lit(0).alias("part"),
                F.lit(None).cast("string").alias("child_name"), F.lit(None).cast("bigint").alias("child_id"),
                F.concat(
                    F.when(F.col("agent_no") > 1, F.lit(",")).otherwise(F.lit("")),
                    head_body,
                    F.when(F.col("_first").isNull(), F.lit(',"data":null}')).otherwise(F.lit(',"data":[')),
                ).alias("fragment")))
    close = (heads.filter(F.col("_first").isNotNull())
             .select(F.lit(1).alias("doc_part"), "agent_no", "agent_id", F.lit(2).alias("part"),
                     F.lit(None).cast("string").alias("child_name"), F.lit(None).cast("bigint").alias("child_id"),
                     F.lit("]}").alias("fragment")))
    numbered = maybe_broadcast(heads.select("agent_id", "agent_no", "_first"), bounded_by=dim)  # one row per agent
    children = (named.join(numbered, "agent_id")
                .select(
                    F.lit(1).alias("doc_part"), "agent_no", "agent_id", F.lit(1).alias("part"),
                    F.col("product_name").alias("child_name"), F.col("product_id").alias("child_id"),
                    F.concat(
                        F.when(F.struct("product_name", "product_id") == F.col("_first"), F.lit(""))
                        .otherwise(F.lit(",")),
                        json_object(product_keys, as_text=True),
                    ).alias("fragment")))
    n_agents = totals.agg(F.count(F.lit(1)).alias("n"))
    edges = n_agents.select(F.explode(F.array(
        F.struct(F.lit(0).alias("doc_part"),
                 F.when(F.col("n") == 0, F.lit(f'{{"{root}":null}}'))
                 .otherwise(F.lit(f'{{"{root}":[')).alias("fragment")),
        F.struct(F.lit(2).alias("doc_part"),
                 F.when(F.col("n") == 0, F.lit("")).otherwise(F.lit("]}")).alias("fragment")),
    )).alias("e")).select(
        F.col("e.doc_part").alias("doc_part"), F.lit(0).cast("bigint").alias("agent_no"),
        F.lit(None).cast("bigint").alias("agent_id"), F.lit(0).alias("part"),
        F.lit(None).cast("string").alias("child_name"), F.lit(None).cast("bigint").alias("child_id"),
        F.col("e.fragment").alias("fragment"))
    return (edges.unionByName(head).unionByName(children).unionByName(close)
            .select(*FRAGMENT_COLUMNS))


def agent_documents(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                    root: str = "agents", agent_keys: dict[str, str] = AGENT_KEYS,
                    product_keys: dict[str, str] = PRODUCT_KEYS) -> DataFrame:
    # the pairs feed the children, the first-child marks and the totals: materialise
    # them once in the shared checkpoint folder instead of scanning the facts three times
    ensure_checkpoint_dir(model.sale.sparkSession)
    named = stats.agent_product_named(model, as_of, agent_id=agent_id).checkpoint(eager=True)
    # one aggregation per agent gives both the totals and the first product (for the commas)
    totals = stats.agent_stats_from_named(
        model, named, agent_id, extra=[F.min(F.struct("product_name", "product_id")).alias("_first")])
    dim = model.agent if agent_id is None else model.agent.filter(F.col("agent_id") == F.lit(agent_id))
    return agent_document_fragments(totals, named, root, agent_keys, product_keys, agents=dim)


def ordered_fragments(fragments: DataFrame) -> DataFrame:
    return fragments.orderBy("doc_part", "agent_no", "part", "child_name", "child_id")


def write_document(fragments: DataFrame, path: str) -> None:
    """Write the document as ordered text part files (concatenate in name order)."""
    ordered_fragments(fragments).select("fragment").write.mode("overwrite").text(path)



def parse_children(fragments: DataFrame, product_keys: dict[str, str] = PRODUCT_KEYS) -> DataFrame:
    """Product fragments back to typed rows (the document read as data)."""
    schema = "struct<" + ",".join(f"`{k}`:string" for k in product_keys) + ">"
    body = F.regexp_replace(F.col("fragment"), r"^,", "")
    parsed = (fragments.filter(F.col("part") == 1)
              .select("agent_id", F.col("child_id").alias("product_id"), F.from_json(body, schema).alias("j")))
    cols = []
    for key, src in product_keys.items():
        value = F.col(f"j.`{key}`")
        cols.append((value if src.endswith("name") else value.cast("bigint")).alias(src))
    return parsed.select("agent_id", "product_id", *cols)


DOCUMENT_ROW_PRODUCTS = 8


def document_rows(model: Model, as_of: DateLike | None = None, products: int = DOCUMENT_ROW_PRODUCTS,
                  root: str = "agents") -> DataFrame:
    """The combined document as rows of complete JSON text, each with at most ``products`` products of one agent.

    A row holds the products of one range of ``products`` consecutive ids, so no list grows
    with the data.  An agent without products has one row whose
    ``data`` is null.
    """
    named = stats.agent_product_named(model, as_of)
    item = F.struct("product_id", "product_name", *[F.col(c).cast("string").alias(c) for c in stats.MEASURES])
    rows = (named.groupBy("agent_id", F.floor(F.col("product_id") / products).alias("part"))
            .agg(F.sort_array(F.collect_list(item)).alias("data")))
    agents = model.agent.select("agent_id", "agent_name")
    whole = agents.join(rows, "agent_id", "left")
    agent = F.struct("agent_id", "agent_name", "data")
    return whole.select(F.to_json(F.struct(F.array(agent).alias(root)), JSON_OPTIONS).alias("doc"))


def read_documents(docs: DataFrame, root: str = "agents", doc_col: str = "doc") -> DataFrame:
    """Agent and product rows of combined JSON documents; everything comes from their text.

    An agent whose ``data`` is null or empty gives one row without product.  Text that is
    not JSON, or null, gives no rows.
    """
    fields = "product_id:bigint,product_name:string," + ",".join(f"{c}:string" for c in stats.MEASURES)
    schema = f"struct<`{root}`:array<struct<agent_id:bigint,agent_name:string,data:array<struct<{fields}>>>>>"
    agents = (docs.select(F.from_json(doc_col, schema).alias("d"))
              .select(F.explode(F.col(f"d.`{root}`")).alias("a")))
    pairs = agents.select("a.agent_id", "a.agent_name", F.explode_outer("a.data").alias("p"))
    return pairs.select("agent_id", "agent_name", "p.product_id", "p.product_name",
                        *[F.col(f"p.{c}").cast("bigint").alias(c) for c in stats.MEASURES])


def profit_per_product(pairs: DataFrame, agents: DataFrame | None = None) -> DataFrame:
    """Chart input grouped by product: its agents numbered by name, with their profits, as ordered rows.

    ``agents`` bounds the rows of a product (one per agent).
    """
    rows = pairs.filter("product_id IS NOT NULL").select("product_id", "product_name", "agent_id", "agent_name", "profit")
    return row_number_within(rows, ["product_id"], [F.col("agent_name"), F.col("agent_id")], "agent_no",
                             group_bounded_by=agents)


def profit_by_agent(totals: DataFrame) -> DataFrame:
    """Chart input: (agent, profit) for every agent (zero when nothing was sold)."""
    return totals.select("agent_id", "agent_name", "profit")


def profit_by_product(named: DataFrame) -> DataFrame:
    """Chart input: (product, agent, profit) for every agent that has products."""
    return named.select("product_id", "product_name", "agent_id", "agent_name", "profit")
