"""Where publications go: one call for each destination of each micro-batch."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import BATCH_BOUNDS, DURATION_BOUNDS
from ..sources.versions import Versions
from .metrics import Metrics

log = logging.getLogger(__name__)
RETRIES, PAUSE_S = 30, 1.0
Send = Callable[[DataFrame, int], None]


class PermanentFailure(RuntimeError):
    pass


def publish_with_retries(send: Callable[[DataFrame], None], batch: DataFrame, retries: int = RETRIES, pause_s: float = PAUSE_S, sleep=time.sleep, on_failure: Callable[[Exception], None] | None = None) -> int:
    """Failed tries before send(batch) succeeded; PermanentFailure after ``retries`` of them.  An empty batch is not sent."""
    if batch.isEmpty():
        return 0
    for k in range(retries):
        try:
            send(batch)
            return k
        except Exception as e:  # noqa: BLE001  any failure of the destination is tried again
            last = e
            if on_failure:
                on_failure(e)
            log.warning("sending failed, try %d of %d: %s", k + 1, retries, e)
            sleep(pause_s)
    raise PermanentFailure(f"gave up after {retries} tries: {last}") from last


def table_sink(path: str) -> Send:
    """Appends each micro-batch as Parquet under batch=<id>; a batch that is sent again replaces itself."""

    def send(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return send


def client_sink(connect: Callable[[], Callable[[list[dict]], None]], size: int = 1, metrics: Metrics | None = None) -> Send:
    """Sends rows from the executors in runs of at most ``size`` of one shard, in the order of their partition.

    connect() is called once for each partition and returns what sends a run (of dicts).  A run that
    fails, fails the micro-batch, which is sent again.  Sizes and durations of the runs are counted in
    histograms there, so a bounded number of rows comes back, whatever their number.
    """
    slot = lambda v, bounds: next((b for b in bounds if v <= b), float("inf"))

    def partition(frames):
        import pandas as pd

        send, counts = None, {}

        def out(rows):
            began = time.perf_counter()
            send(rows)
            took = time.perf_counter() - began
            key = rows[0]["shard"], slot(len(rows), BATCH_BOUNDS), slot(took, DURATION_BOUNDS)
            n, total = counts.get(key, (0, 0.0))
            counts[key] = n + 1, total + took

        held: list[dict] = []
        for frame in frames:
            send = send or connect()
            for row in frame.to_dict("records"):
                if held and (len(held) == size or held[0]["shard"] != row["shard"]):
                    out(held)
                    held = []
                held.append(row)
        if held:
            out(held)
        yield pd.DataFrame([(*k, *v) for k, v in counts.items()], columns=["shard", "size", "seconds", "n", "total"])

    def send(batch: DataFrame, batch_id: int) -> None:
        sent = batch.mapInPandas(partition, "shard int, size double, seconds double, n long, total double").groupBy("shard", "size", "seconds").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for r in sent.collect():
            if metrics:
                metrics.observe("batch_size", r["size"], BATCH_BOUNDS, r["n"], ordinal=r["shard"], status="sent")
                metrics.observe("command_duration_seconds", r["seconds"] if r["seconds"] < float("inf") else r["total"] / r["n"], DURATION_BOUNDS, r["n"], ordinal=r["shard"])

    return send


def fan_out_sink(destinations: dict[str, Send], drop_after_retries: bool = False, retries: int = RETRIES, pause_s: float = PAUSE_S, sleep=time.sleep, on_failure: Callable[[Exception], None] | None = None, metrics: Metrics | None = None) -> Send:
    """For foreachBatch: the micro-batch, computed once, to every destination; on_failure hears of each failed try.

    A permanent failure fails the micro-batch, so the checkpoint does not pass it and it is sent again
    after a restart; with drop_after_retries it is logged and the batch is lost to that destination.
    """

    def send(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            n = batch.count() if metrics else 0
            for name, to in destinations.items():

                def failed(e: Exception) -> None:
                    if metrics:
                        metrics.inc("temporary_send_failures", n)
                    if on_failure:
                        on_failure(e)

                try:
                    publish_with_retries(lambda b, to=to: to(b, batch_id), batch, retries, pause_s, sleep, failed)
                    if metrics:
                        metrics.inc("processed_messages", n, status="sent")
                except PermanentFailure:
                    if metrics:
                        metrics.inc("processed_messages", n, status="failed")
                    if not drop_after_retries:
                        raise
                    log.exception("batch %d dropped for %s", batch_id, name)
        finally:
            batch.unpersist()

    return send


class PositionStore:
    """The last position, written at most once in ``every_s`` seconds and not on close."""

    def __init__(self, write: Callable[[object], None], every_s: float = 1.0, clock=time.monotonic):
        self.write, self.every, self.clock = write, every_s, clock
        self.last: float | None = None
        self.pending: object | None = None

    def advance(self, position: object) -> None:
        self.pending = position
        self.tick()

    def tick(self) -> None:
        """Also called when idle."""
        now = self.clock()
        if self.pending is not None and (self.last is None or now - self.last >= self.every):
            self.write(self.pending)
            self.last, self.pending = now, None


class Positions:
    """The last published position of each shard, kept in a folder of versions."""

    def __init__(self, versions: Versions, shards: int, every_s: float = 1.0, clock=time.monotonic):
        self.versions, self.shards = versions, shards
        self.known: dict[int, tuple[int, int]] = self.load()
        self.flush = PositionStore(lambda p: versions.put(json.dumps({str(k): list(v) for k, v in p.items()})), every_s, clock)

    def load(self) -> dict[int, tuple[int, int]]:
        return {int(k): tuple(v) for k, v in json.loads(self.versions.get() or "{}").items()}

    def get(self, shard: int) -> tuple[int, int] | None:
        return self.load().get(shard)

    def first(self) -> tuple[int, int] | None:
        """The least position; None unless every shard has one."""
        known = self.load()
        return min((known[i] for i in range(self.shards)), default=None) if all(i in known for i in range(self.shards)) else None

    def advance(self, moved: dict[int, tuple[int, int]]) -> None:
        self.known = self.known | moved
        self.flush.advance(self.known)
