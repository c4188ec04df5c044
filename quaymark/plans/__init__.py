"""All queries over the driver's tables, each with its SQL twin where there is one."""

from quaymark.plans import gateway, gold, market, research, silver  # noqa: F401  (each adds its queries)

QUERIES, SQL = market.QUERIES, market.SQL
