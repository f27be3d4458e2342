"""The operational aggregates: counts, sums, histograms with fixed bounds, maxima by interval."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import documents, names
from . import filters, flatten

#: Upper bounds of the histograms.
SIZE_BOUNDS = [0, *(8 * 2**k for k in range(29))]
GAP_BOUNDS = [1, 2.5, 5, 10, 25, 50, 100, 250, 500, 1000]
BATCH_BOUNDS = [1, 2, 5, 10, 18, 25, 50, 100]
DURATION_BOUNDS = [0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1, 2, 5]
STALENESS_BOUNDS = [0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1, 2, 3, 5, 7, 10, 20, 50, 100]


def histogram(df: DataFrame, value: str, bounds: list[float], labels: list[str]) -> DataFrame:
    """labels, le (text, with +Inf), n: cumulative counts of value <= le.

    Rows are counted once, by the first bound that holds them; the running sum is over at most
    len(bounds) + 1 rows for each label set.
    """
    v = F.col(value)
    slot = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        slot = F.when(v <= bounds[i], i).otherwise(slot)
    counted = df.groupBy(*labels, slot.alias("slot")).agg(F.count(F.lit(1)).alias("c"))
    by = counted.groupBy(*labels).agg(F.map_from_entries(F.collect_list(F.struct("slot", "c"))).alias("m"))
    names = F.array(*(F.lit(_text(b)) for b in bounds), F.lit("+Inf"))
    upto = lambda i: F.aggregate(F.sequence(F.lit(0), i), F.lit(0).cast("long"), lambda a, k: a + F.coalesce(F.try_element_at(F.col("m"), k), F.lit(0)))
    rows = by.select(*labels, "m", F.posexplode(names).alias("i", "le"))
    return rows.select(*labels, "le", upto(F.col("i")).alias("n"))


def _text(b: float) -> str:
    return str(int(b)) if float(b).is_integer() else str(b)


def entry_metrics(log: DataFrame, denylist: DataFrame | None = None) -> DataFrame:
    """(ts_t, ts_i, wall, size, database, status): one row for each entry (with size, its bytes) with a publication.

    status is error if any operation failed beside one that did not, else processed; database is that
    of the first operation with an id.  All within the row: an entry's operations are never exploded,
    so nothing is shuffled to bring them together again.
    """

    def state(x: Column) -> Column:
        """none, ok or failed, as process() would find the operation; null without an id."""
        db, coll = names.database(x["ns"]), names.collection(x["ns"])
        doc = filters.id_source(x["op"], x["o"], x["o2"])
        kind = F.get(F.transform(F.array(documents.id_variant(doc)), documents.id_kind), 0)
        quiet = coll.startswith("system.") | (db == "config")
        typed = F.when(quiet, "none").when(kind == "unsupported", "failed").otherwise("ok")
        return F.struct(F.when(~flatten.is_crud(x), "failed").when(documents.has_key(doc, "_id"), typed).alias("state"), F.coalesce(db, F.lit("")).alias("db"))

    d = flatten.operations(log, denylist).withColumn("_s", F.filter(F.transform("_ops", state), lambda s: s["state"].isNotNull()))
    d = d.where(F.exists("_s", lambda s: s["state"] == "ok"))
    database = F.coalesce(F.nullif(F.get("_s", 0)["db"], F.lit("")), F.lit("(no database)"))
    status = F.when(F.exists("_s", lambda s: s["state"] == "failed"), "error").otherwise("processed")
    return d.select("ts_t", "ts_i", "wall", "size", database.alias("database"), status.alias("status"))


def interval_max(df: DataFrame, time: str, value: str, labels: list[str], interval: str = "1 minute") -> DataFrame:
    """labels, window_start, visible_from, value: the maximum of each interval, to be read in the next one."""
    w = F.window(time, interval)
    g = df.groupBy(*labels, w.alias("w")).agg(F.max(value).alias("value"))
    return g.select(*labels, F.col("w.start").alias("window_start"), F.col("w.end").alias("visible_from"), "value")


def interval_report(maxima: DataFrame, at: Column, labels: list[str], interval_s: int = 60) -> DataFrame:
    """labels, value of the interval that ended where the one around ``at`` (a timestamp) began."""
    start = F.timestamp_seconds(F.floor(F.unix_seconds(at) / interval_s) * interval_s)
    return maxima.where(F.col("visible_from") == start).select(*labels, "value")


def head_staleness(batches: DataFrame, stale: Column) -> DataFrame:
    """(ordinal, batch, staleness_s): of each batch's first publication (shard, batch, ts_t, ts_i, tx_idx), before it is sent."""
    return batches.groupBy(F.col("shard").alias("ordinal"), "batch").agg(F.min_by(stale, F.struct("ts_t", "ts_i", "tx_idx")).alias("staleness_s"))


def staleness(as_of: Column, wall: Column) -> Column:
    """Seconds from wall to as_of, 0 if the clocks disagree."""
    return F.greatest((F.unix_micros(as_of) - F.unix_micros(wall)) / 1e6, F.lit(0.0))


def oldest_pending(pubs: DataFrame, positions: DataFrame, as_of: Column) -> DataFrame:
    """positions (ordinal, client_index, ts_t, ts_i: what a destination has of a shard) with age_s, of the oldest publication (shard, ts_t, ts_i) beyond it; 0 if there is none.

    as_of: seconds.  positions has a row for each shard and destination.
    """
    p = positions.select("ordinal", "client_index", F.struct("ts_t", "ts_i").alias("at"))
    waiting = pubs.select(F.col("shard").alias("ordinal"), F.struct("ts_t", "ts_i").alias("x")).join(p, "ordinal").where(F.col("x") > F.col("at"))
    oldest = waiting.groupBy("ordinal", "client_index").agg(F.min("x.ts_t").alias("oldest"))
    return positions.select("ordinal", "client_index").join(oldest, ["ordinal", "client_index"], "left").select("ordinal", "client_index", F.coalesce(as_of - F.col("oldest"), F.lit(0)).cast("long").alias("age_s"))
