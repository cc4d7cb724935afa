"""Territory report as Markdown, one row per output line.

The document is the frame's ``line`` values in (section_no, block, line_no)
order joined by newlines, with a final newline.  No section is ever
concatenated into one value: table and ranking lines are rendered where
their rows live, and ``write_lines`` writes the sorted lines as text
part files whose concatenation is the document.

Blocks per section n (section 0 is the document heading):

0. ``## n) city``, blank, ``### n.1) <overall>``, blank, ``**<managed by>: owner**``, blank, table header, rule
1. one table line per district, then the bold total line
2. blank, ``### n.2) <individual>``, blank
3. ``r) seller - qty`` per ranked seller
4. blank
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ledgerlight.functions.dates import DateLike
from ledgerlight.model import Model
from ledgerlight.operators import territory as terr
from ledgerlight.plans.joins import maybe_broadcast
from ledgerlight.plans.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Headings:
    title: str
    intro: tuple[str, ...]
    overall: str
    managed_by: str
    table_header: str
    table_rule: str
    total: str
    individual: str


ENGLISH = Headings(
    title="# Territory statistics",
    intro=(
        "Overview of every territory with its total sales: who owns it and which districts it is split into.",
        "How much was sold there, and how much of it by competing agents.",
    ),
    overall="Overall results",
    managed_by="Managed by",
    table_header="| District | Sold by owner | Sold by competitors | Sold in total |",
    table_rule="|---|---|---|---|",
    total="Total",
    individual="Individual results",
)

# The original report's Czech text, for byte-identical output.
CZECH = Headings(
    title="# Statistiky teritorii",
    intro=(
        "Prehled jednotlivych teritorii se statistikami ohledne jejich celkoveho prodeje. "
        "Komu patri a na jake districty se deli.",
        "Kolik zde bylo prodano drog. Kolik zde bylo prodano konkurencnimi dealery.",
    ),
    overall="Celkove vysledky",
    managed_by="Spravuje",
    table_header="| District                | Prodano spravcem | Prodano konkurenci | Prodano celkem |",
    table_rule="|-------------------------|------------------|--------------------|----------------|",
    total="Celkem",
    individual="Jednotlive vysledkly",
)

LINE_SCHEMA = "section_no bigint, block int, line_no bigint, line string"


def _s(c: str) -> F.Column:
    return F.col(c).cast("string")


def heading_lines(spark, h: Headings) -> DataFrame:
    lines = [h.title, "", *h.intro, ""]
    return spark.createDataFrame([(0, 0, i + 1, text) for i, text in enumerate(lines)], LINE_SCHEMA)


def section_lines(secs: DataFrame, h: Headings) -> DataFrame:
    """Blocks 0, 2 and 4 of each section (fixed line count per section)."""
    n = _s("section_no")
    top = [
        F.concat(F.lit("## "), n, F.lit(") "), F.col("city")),
        F.lit(""),
        F.concat(F.lit("### "), n, F.lit(f".1) {h.overall}")),
        F.lit(""),
        F.concat(F.lit(f"**{h.managed_by}: "), F.col("owner_name"), F.lit("**")),
        F.lit(""),
        F.lit(h.table_header),
        F.lit(h.table_rule),
    ]
    mid = [F.lit(""), F.concat(F.lit("### "), n, F.lit(f".2) {h.individual}")), F.lit("")]
    tail = [F.lit("")]

    def block(b: int, cols: list[F.Column]) -> list[F.Column]:
        return [F.struct(F.lit(b).alias("block"), F.lit(i + 1).cast("bigint").alias("line_no"), c.alias("line"))
                for i, c in enumerate(cols)]

    parts = F.array(*block(0, top), *block(2, mid), *block(4, tail))
    return (secs.select("section_no", F.explode(parts).alias("p"))
            .select("section_no", "p.block", "p.line_no", "p.line"))


def table_lines(secs: DataFrame, rollup: DataFrame, h: Headings, bound: DataFrame | None = None,
                on: list[str] = terr.SECTION) -> DataFrame:
    detail = F.concat(F.lit("| "), F.col("district"), F.lit(" | "), _s("qty_own"), F.lit(" | "),
                      _s("qty_competitor"), F.lit(" | "), _s("qty_total"), F.lit(" |"))
    total = F.concat(F.lit(f"| **{h.total}** | **"), _s("qty_own"), F.lit("** | **"),
                     _s("qty_competitor"), F.lit("** | **"), _s("qty_total"), F.lit("** |"))
    keys = maybe_broadcast(secs.select("section_no", *on), bounded_by=bound)
    return (rollup.join(keys, on)
            .select("section_no", F.lit(1).alias("block"), "line_no",
                    F.when(F.col("is_total") == 1, total).otherwise(detail).alias("line")))


def ranking_lines(secs: DataFrame, ranking: DataFrame, bound: DataFrame | None = None,
                  on: list[str] = terr.SECTION) -> DataFrame:
    keys = maybe_broadcast(secs.select("section_no", *on), bounded_by=bound)
    return (ranking.join(keys, on)
            .select("section_no", F.lit(3).alias("block"), F.col("rank_no").alias("line_no"),
                    F.concat(_s("rank_no"), F.lit(") "), F.col("seller_name"), F.lit(" - "),
                             _s("qty_sold")).alias("line")))


def territory_markdown(model: Model, as_of: DateLike | None = None, agent_id: int | None = None,
                       headings: Headings = ENGLISH, by_owner: bool = False) -> DataFrame:
    """All lines of the report: (section_no, block, line_no, line).

    Sections are one per (owner, city) and show what belongs to both.  With ``by_owner``
    each section shows the owner's holding in all cities (``territory.owner_rollup`` and
    ``owner_seller_ranking``); both are computed once per owner and joined to the sections.
    """
    spark = model.sale.sparkSession
    # the owned territories (a few rows, possibly derived from big tables) feed the
    # sections, the table and the ranking: materialise them once
    ensure_checkpoint_dir(spark)
    owned = maybe_broadcast(terr.owned_territories(model, agent_id).checkpoint(eager=True),
                            bounded_by=model.territory)
    # the one pass over the sales, of one owner's territories where one is asked for:
    # (territory, seller) sums feed both the table and the ranking
    per_seller = terr.sales_by_territory_seller(
        model, as_of, owned if agent_id is not None else None).checkpoint(eager=True)
    secs = terr.sections(model, agent_id, owned=owned)
    districts = terr.district_sales(model, as_of, agent_id, per_seller, owned=owned)
    if by_owner:
        on = ["owner_id"]
        rollup = terr.owner_rollup(model, districts=districts)
        ranking = terr.owner_seller_ranking(model, as_of, agent_id, per_seller, owned=owned)
    else:
        on = terr.SECTION
        rollup = terr.territory_rollup(model, districts=districts)
        ranking = terr.seller_ranking(model, as_of, agent_id, per_seller, owned=owned)
    return (heading_lines(spark, headings)
            .unionByName(section_lines(secs, headings))
            .unionByName(table_lines(secs, rollup, headings, bound=model.territory, on=on))
            .unionByName(ranking_lines(secs, ranking, bound=model.territory, on=on)))


def ordered_lines(lines: DataFrame) -> DataFrame:
    return lines.orderBy("section_no", "block", "line_no")


def write_lines(lines: DataFrame, path: str) -> None:
    """Write the document as ordered text part files (concatenate in name order)."""
    ordered_lines(lines).select("line").write.mode("overwrite").text(path)
