"""Reading a log from a position, and positions of shards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def after_position(log: DataFrame, ts_t: int, ts_i: int) -> DataFrame:
    """Entries strictly after a position; the seconds alone are a predicate that reaches the file scan."""
    return log.where((F.col("ts_t") >= ts_t) & ((F.col("ts_t") > ts_t) | (F.col("ts_i") > ts_i)))


def latest_position(log: DataFrame) -> DataFrame:
    """(ts_t, ts_i) of the last entry; nulls for an empty log.  A maximum, so no sort."""
    return log.agg(F.max(F.struct("ts_t", "ts_i")).alias("x")).select("x.ts_t", "x.ts_i")


def min_position(positions: DataFrame, shards: int) -> DataFrame:
    """The least of the positions (ordinal, ts_t, ts_i) of shards 0 to shards - 1; nulls unless each has one."""
    p = positions.where((F.col("ordinal") >= 0) & (F.col("ordinal") < shards) & F.col("ts_t").isNotNull())
    m = p.agg(F.min(F.struct("ts_t", "ts_i")).alias("x"), F.count_distinct("ordinal").alias("n"))
    return m.select(*(F.when(F.col("n") == shards, F.col(f"x.{c}")).alias(c) for c in ("ts_t", "ts_i")))


def shard_positions(pubs: DataFrame) -> DataFrame:
    """(ordinal, ts_t, ts_i): the last position of each shard's publications (shard, ts_t, ts_i)."""
    return pubs.groupBy(F.col("shard").alias("ordinal")).agg(F.max(F.struct("ts_t", "ts_i")).alias("x")).select("ordinal", "x.ts_t", "x.ts_i")
