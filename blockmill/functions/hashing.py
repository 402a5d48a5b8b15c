"""Seeded hash that stands in for a random draw."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# 13 hex digits = 52 bits, so the quotient below is an exact double in [0, 1).
_HEX_DIGITS = 13
_SCALE = float(1 << (4 * _HEX_DIGITS))


def unit_hash(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    head = F.substring(F.md5(text.cast("binary")), 1, _HEX_DIGITS)
    return F.conv(head, 16, 10).cast("long") / F.lit(_SCALE)
