"""Column expressions: cycles, dimensions and surrogate keys."""

from metricbook.functions import cycles, dims, keys

__all__ = ["cycles", "dims", "keys"]
