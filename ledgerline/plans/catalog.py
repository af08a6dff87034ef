"""All registered queries of the record operators, and their SQL."""

from ledgerline.plans import collections, contracts, declared, inventories, monitoring, obligations, registry, releases, search, stored, upkeep  # noqa: F401
from ledgerline.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
