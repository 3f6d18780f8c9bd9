"""Spherical Mercator projection and fixed-scale text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HALF_CIRCUMFERENCE = 20037508.34


def mercator_x(lon: Column) -> Column:
    return lon * HALF_CIRCUMFERENCE / 180


def mercator_y(lat: Column) -> Column:
    degrees = F.ln(F.tan((lat + 90) * F.pi() / 360)) / (F.pi() / 180)
    return degrees * HALF_CIRCUMFERENCE / 180


def fixed_text(value: Column, digits: int = 7) -> Column:
    return F.format_string(f"%.{digits}f", value)
