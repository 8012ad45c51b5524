"""Decimal measure expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def line_value(quantity: Column | str = "quantity", price: Column | str = "unit_price") -> Column:
    """``quantity * unit_price`` as NUMERIC(12,2) (exact decimal product, P9)."""
    return (_c(quantity) * _c(price)).cast("decimal(12,2)")


def shipment_value(quantity: Column | str = "quantity",
                   price: Column | str = "unit_price") -> Column:
    """``round(quantity * unit_price, 2)`` as NUMERIC(12,2) (P10)."""
    return F.round(_c(quantity) * _c(price), 2).cast("decimal(12,2)")
