"""Every operator as a query over the driver's tables, and the same question in SQL."""

from plumbline.registry.oracles import oracle_sql
from plumbline.registry.queries import queries

__all__ = ["oracle_sql", "queries"]
