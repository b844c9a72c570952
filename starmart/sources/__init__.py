"""Sources and sinks: raw files, the stream, the warehouse, test-data mapping."""

from starmart.sources import files, testdata, warehouse
from starmart.sources.warehouse import Star, Warehouse

__all__ = ["files", "testdata", "warehouse", "Star", "Warehouse"]
