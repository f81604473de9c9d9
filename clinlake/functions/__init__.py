"""Column-level functions: standardizers, keys, calendar and numeric helpers."""

from clinlake.functions import columns, dates, keys

__all__ = ["columns", "dates", "keys"]
