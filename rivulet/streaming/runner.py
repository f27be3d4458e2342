"""The log as a running service: source, transforms, destinations, restarts."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..config import Config
from ..operators import decode, publish, resume, scan
from ..operators.denylist import Denylist
from ..operators.metrics import GAP_BOUNDS, STALENESS_BOUNDS
from ..sources import changelog
from ..sources.versions import Versions
from . import http, sinks, state
from .metrics import Metrics

log = logging.getLogger(__name__)


class StartFailure(RuntimeError):
    """reason: session (the log or the stores cannot be opened), start_time or query."""

    def __init__(self, reason: str, cause: Exception):
        super().__init__(f"{reason}: {cause}")
        self.reason = reason


def _entries(df: DataFrame) -> DataFrame:
    """Valid entries of raw JSON lines; entries as they are."""
    return decode.decode_envelope(df).where("valid").drop("valid") if "raw" in df.columns and "op" not in df.columns else df


def publication_stream(entries: DataFrame, denylist: DataFrame | None = None, config: Config = Config(), dedupe: str | None = None) -> DataFrame:
    """Publications of entries (or raw JSON lines), batch or stream; dedupe "ttl" keeps a key's time to live in the state store."""
    p = publish.publications(publish.from_log(_entries(entries), denylist, config.extract_subfield_changes))
    if dedupe == "ttl":
        p = state.first_by_ttl(p, config.dedupe_expiration)
    return publish.sharded(p, config.write_parallelism)


def start(
    spark: SparkSession, config: Config, checkpoint: str, destinations: dict[str, sinks.Send] | None = None, fmt: str = "parquet", dedupe: bool = True, available_now: bool = False,
    drop_after_retries: bool = False, denylist: Denylist | None = None, metrics: Metrics | None = None, now: Callable[[], float] = time.time, sleep: Callable[[float], None] = time.sleep,
) -> StreamingQuery:
    """The running query, from where the shards' positions say.

    A position younger than the catch-up limit is resumed from; else only entries after the log's end, as
    it is now, are published.  The denylist is read anew for each micro-batch, keys published within
    the time to live are not published again, each database's publications arrive in order, and
    positions follow once every destination has them.  No entry is dropped for being late.
    """
    metrics = metrics or Metrics()
    try:
        stream = changelog.stream_log(spark, config.log_url, fmt, config.files_per_trigger)
        kept = config.positions_url or checkpoint
        positions = sinks.Positions(Versions(spark, f"{kept}/positions"), config.write_parallelism, config.timestamp_flush_interval)
        denylist = denylist or Denylist(spark, config.denylist_url)
        seen = state.Seen(spark, f"{kept}/published", config.dedupe_expiration, now) if dedupe else None
    except Exception as e:
        raise StartFailure("session", e) from e

    def end_of_log() -> tuple[int, int]:
        at = scan.latest_position(_entries(changelog.read_log(spark, config.log_url, fmt))).first()
        return (at["ts_t"], at["ts_i"]) if at["ts_t"] is not None else (0, 0)

    try:
        begin, error = resume.start_position(
            positions.first, end_of_log, now(), config.max_catch_up, config.resume_read_retries, config.resume_read_retry_delay, config.resume_from_end_on_failure, sleep,
            lambda status, gap: metrics.observe("resume_gap_seconds", gap, GAP_BOUNDS, status=status),
        )
        if error is not None:
            raise error
    except Exception as e:
        raise StartFailure("start_time", e) from e

    shards = range(config.write_parallelism)
    destinations = destinations or {u: sinks.table_sink(u) for u in config.destinations}
    send = sinks.fan_out_sink(destinations, drop_after_retries, sleep=sleep, metrics=metrics)

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        denylist.refresh()
        pubs = publication_stream(scan.after_position(_entries(batch), *begin), denylist.frame(), config).persist()
        try:
            # a row for each shard
            by = {r["shard"]: r for r in pubs.groupBy("shard").agg(F.max(F.struct("ts_t", "ts_i")).alias("last"), F.count(F.lit(1)).alias("n"), F.unix_micros(F.min("wall")).alias("oldest")).collect()}
            for i in shards:
                for k in range(len(destinations)):
                    waiting = by[i]["n"] if i in by else 0
                    metrics.set("buffer_available", max(0, config.buffer_size - waiting), ordinal=i, clientIndex=k)
                    oldest = by[i]["oldest"] if i in by else None
                    metrics.set("oldest_message_age", max(0.0, now() - oldest / 1e6) if oldest is not None else 0, ordinal=i, clientIndex=k)
                if i in by and by[i]["oldest"] is not None:
                    metrics.set("pre_retry_staleness", now() - by[i]["oldest"] / 1e6, ordinal=i)
            fresh = (seen.fresh(pubs) if seen else pubs).persist()
            try:
                send(publish.ordered_per_db(fresh, config.write_parallelism), batch_id)
                if seen:
                    seen.remember(fresh, batch_id)
                _staleness(fresh, by, metrics, now())
            finally:
                fresh.unpersist()
            positions.advance({i: (r["last"]["ts_t"], r["last"]["ts_i"]) for i, r in by.items()})
            for i in shards:
                for k in range(len(destinations)):
                    metrics.set("buffer_available", config.buffer_size, ordinal=i, clientIndex=k)
                    metrics.set("oldest_message_age", 0, ordinal=i, clientIndex=k)
        finally:
            pubs.unpersist()

    try:
        w = stream.writeStream.foreachBatch(publish_batch).option("checkpointLocation", f"{checkpoint}/stream").outputMode("append")
        return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{config.timestamp_flush_interval:g} seconds")).start()
    except Exception as e:
        raise StartFailure("query", e) from e


def _staleness(fresh: DataFrame, by: dict, metrics: Metrics, now: float) -> None:
    """Histograms by shard of what was published, and counts of what was not: rows for each shard and bound."""
    age = F.greatest(F.lit(now) - F.unix_micros("wall") / 1e6, F.lit(0.0))
    slot = F.lit(STALENESS_BOUNDS[-1] + 1.0)
    for b in reversed(STALENESS_BOUNDS):
        slot = F.when(age <= b, float(b)).otherwise(slot)
    sent: dict[int, int] = {}
    for r in fresh.groupBy("shard", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.max_by(age, F.struct("ts_t", "ts_i", "tx_idx")).alias("age")).collect():
        sent[r["shard"]] = sent.get(r["shard"], 0) + r["n"]
        metrics.observe("entry_staleness_seconds", r["slot"], STALENESS_BOUNDS, r["n"], ordinal=r["shard"], status="published")
        if r["age"] is not None:
            metrics.set("last_entry_staleness_seconds", r["age"], ordinal=r["shard"], status="published")
    for i, r in by.items():
        metrics.inc("duplicates", r["n"] - sent.get(i, 0), ordinal=i)


#: What says that files of the log are gone, and that a read took too long.
LOST = ("FILE_NOT_EXIST", "FileNotFoundException", "PATH_NOT_FOUND")
SLOW = ("SocketTimeoutException", "TimeoutException", "timed out")


def read_status(error: Exception | None) -> str:
    """result, lost position, timeout or error: how a read of the log ended."""
    if error is None:
        return "result"
    text = f"{type(error).__name__}: {error}"
    return "lost position" if any(x in text for x in LOST) else "timeout" if any(x in text for x in SLOW) else "error"


class Service:
    """Restarts the query when it stops, until told to stop.

    After a timeout or a lost position it begins again at once, from the last position.  After anything else
    it waits, and a streak of early stops is logged as an error.  checks say of each dependency whether it is well.
    """

    SETTLE_S = 0.1

    def __init__(self, begin: Callable[[], StreamingQuery], pause_s: float = 1.0, clock=time.monotonic, checks: dict[str, Callable[[], bool]] | None = None, metrics: Metrics | None = None):
        self.begin, self.pause, self.clock, self.checks, self.metrics = begin, pause_s, clock, checks or {}, metrics or Metrics()
        self.streak, self.ended = resume.Streak(), threading.Event()
        self.query: StreamingQuery | None = None
        self.error: Exception | None = None
        self.server = None

    def run(self, max_stops: int | None = None) -> None:
        n = 0
        while not self.ended.is_set() and (max_stops is None or n < max_stops):
            began, self.error = self.clock(), None
            try:
                self.query = self.begin()
                self.query.awaitTermination()
            except Exception as e:  # noqa: BLE001  whatever stopped it, it starts again
                self.error = e
                if isinstance(e, StartFailure):
                    self.metrics.inc("tail_failed_to_start", reason=e.reason)
            if self.ended.is_set():
                return
            n += 1
            if not isinstance(self.error, StartFailure) and read_status(self.error) in ("timeout", "lost position"):
                log.info("reading the log again: %s", self.error)
                self.ended.wait(self.SETTLE_S)
                continue
            k, level = self.streak.stopped(self.clock() - began)
            log.log(logging.ERROR if level == "error" else logging.WARNING, "the query stopped (%d in a row): %s", k, self.error)
            self.ended.wait(self.pause)

    def serve(self, address: str, denylist: Denylist) -> None:
        """Answers HTTP requests at host:port until the service stops."""
        self.server = http.serve(address, denylist, self.metrics, self.health)

    def stop(self) -> None:
        self.ended.set()
        if self.query is not None:
            self.query.stop()
        if self.server is not None:
            self.server.shutdown()
            self.server.server_close()

    def health(self) -> tuple[int, dict]:
        """(200 or 500, what is well): each dependency by its own check, and the query."""

        def well(check: Callable[[], bool]) -> bool:
            try:
                return bool(check())
            except Exception:  # noqa: BLE001  a check that fails says that its dependency does
                return False

        running = self.query is not None and self.query.isActive and self.query.exception() is None
        state_ = {"running": running, **{name: well(check) for name, check in self.checks.items()}}
        return (200 if all(state_.values()) else 500), state_


def checks(spark: SparkSession, config: Config) -> dict[str, Callable[[], bool]]:
    """sourceOK: the log's folder is there; sinksOK: so is the file system of every destination."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    there = lambda url: at(url).getFileSystem(conf).exists(at(url))

    def sinks_ok() -> bool:
        return all(at(u).getFileSystem(conf).getStatus() is not None for u in config.destinations)

    return {"sourceOK": lambda: there(config.log_url), "sinksOK": sinks_ok}


class Progress(StreamingQueryListener):
    """Progress of the queries as metrics: rows and durations of the last micro-batch, and ends."""

    def __init__(self, metrics: Metrics):
        self.metrics = metrics

    def onQueryStarted(self, event) -> None:
        self.metrics.inc("query_started")

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.metrics.set("batch_rows", p.numInputRows)
        for step, ms in dict(p.durationMs).items():
            self.metrics.set("batch_duration_ms", ms, step=step)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.metrics.inc("query_terminated")
