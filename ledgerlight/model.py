"""The relational model every operator works on.

Five DataFrames with fixed schemas (see ``ledgerlight.schema``):

* ``agent``      agent_id, agent_name, release_date
* ``product``    product_id, product_name, unit_price
* ``territory``  territory_id, agent_id (owner, nullable), city, district
* ``purchase``   date_bought, agent_id, product_id, amount_bought
* ``sale``       date_sold, product_id, agent_id, territory_id, amount_sold, price

``price`` on a sale is the revenue of the whole row, ``unit_price`` on a
product is per unit.  The three dimensions are small in the reference
workload but are never assumed to be: every join against them goes through
``ledgerlight.plans.joins`` which broadcasts only after a size check.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Model:
    agent: DataFrame
    product: DataFrame
    territory: DataFrame
    purchase: DataFrame
    sale: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        """Name -> frame registry used by the generic exporters."""
        return {
            "agent": self.agent,
            "product": self.product,
            "territory": self.territory,
            "purchase": self.purchase,
            "sale": self.sale,
        }

    def with_facts(self, purchase: DataFrame | None = None, sale: DataFrame | None = None) -> "Model":
        return replace(
            self,
            purchase=self.purchase if purchase is None else purchase,
            sale=self.sale if sale is None else sale,
        )
