"""Log positions: (seconds, increment), both unsigned 32 bits, and their 64-bit decimal text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO32 = 1 << 32


def encode(t: Column, i: Column) -> Column:
    """seconds * 2^32 + increment as decimal text; exact up to 2^64 - 1."""
    d = "decimal(20,0)"
    return (t.cast(d) * F.lit(TWO32).cast(d) + i.cast(d)).cast(d).cast("string")


def decode_t(text: Column) -> Column:
    """Seconds of a position text; null if it is no unsigned 64-bit number."""
    return F.when(_valid(text), F.floor(_number(text) / F.lit(TWO32).cast("decimal(20,0)")).cast("long"))


def decode_i(text: Column) -> Column:
    return F.when(_valid(text), (_number(text) % F.lit(TWO32).cast("decimal(20,0)")).cast("long"))


def _number(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{1,20}$"), text).cast("decimal(20,0)")


def _valid(text: Column) -> Column:
    return _number(text) <= F.lit("18446744073709551615").cast("decimal(20,0)")


def dedupe_key(prefix: str, t: Column, i: Column, tx_idx: Column) -> Column:
    return F.concat(F.lit(f"{prefix}processed::"), encode(t, i), F.lit("::"), tx_idx.cast("string"))
