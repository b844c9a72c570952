"""DataFrame operators: cleansing, keys, dimensions, enrichment, OLAP."""

from starmart.operators import cleanse, dims, enrich, keys, olap

__all__ = ["cleanse", "dims", "enrich", "keys", "olap"]
