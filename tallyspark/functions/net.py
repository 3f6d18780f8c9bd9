"""IPv4 text and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ip_to_long(ip: Column) -> Column:
    """Dotted text (octets may be zero-padded) to its 32-bit value as a long."""
    octets = F.split(F.trim(ip), r"\.")
    value = F.lit(0).cast("long")
    for i in range(4):
        value = value * 256 + F.get(octets, i).try_cast("long")
    return value


def long_to_ip(value: Column) -> Column:
    return F.concat_ws(
        ".",
        *[F.shiftrightunsigned(value, bits).bitwiseAND(255).cast("string") for bits in (24, 16, 8, 0)],
    )
