"""Every operator as a query over the driver tables, with the SQL that checks it."""

from shiftlode.registry import aggregation, columns, joining, models, ordering, reports, scans
from shiftlode.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "aggregation", "columns", "joining", "models", "ordering", "reports", "scans"]
