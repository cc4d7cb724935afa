"""ledgerlight: consignment-sales analytics on Spark DataFrames.

Agents take products on consignment, sell them in territories and owe for
the unsold remainder.  The package computes as-of statistics, territory
reports and exports (JSON, Markdown, XML) and ingests monthly invoices,
all as Spark DataFrame plans.
"""

from ledgerlight.model import Model

__all__ = ["Model"]
