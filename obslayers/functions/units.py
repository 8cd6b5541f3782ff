"""Unit conversions and numeric guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ZERO_CELSIUS_IN_KELVIN = 273.15
KMH_PER_MS = 3.6


def celsius(kelvin: Column) -> Column:
    return kelvin - F.lit(ZERO_CELSIUS_IN_KELVIN)


def best_celsius(*kelvin: Column) -> Column:
    """The first reading that is present, in °C."""
    return celsius(F.coalesce(*kelvin))


def kmh(metres_per_second: Column) -> Column:
    return metres_per_second * F.lit(KMH_PER_MS)


def two_decimals(value: Column) -> Column:
    """``value`` as text with two decimals, rounding half to even on the exact value."""
    return F.call_function("format_number", value, F.lit("0.00"))


def or_text(value: Column, text: Column, otherwise: str) -> Column:
    """``text`` where ``value`` is a number, else the literal ``otherwise``."""
    return F.when(value.isNotNull(), text).otherwise(F.lit(otherwise))
