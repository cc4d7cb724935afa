"""Query registrations (one module per area), see ``ledgerlight.catalog``."""
