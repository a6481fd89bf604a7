"""Landed API pages to typed, keyed tables, as Spark DataFrame operators."""

__version__ = "0.1.0"
