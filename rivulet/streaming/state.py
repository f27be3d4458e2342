"""Duplicate suppression over streams, by processing time: a key's first row, and the next one after its time to live."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedupe import KEY

TTL_S = 150.0
_SCHEMA = "ts_t long, ts_i long, tx_idx int"


class Seen:
    """Keys that micro-batches have published, as a folder of Parquet for each, named by its number and time.

    No row is late: what counts is when a key was published, not what its entry says.  Duplicates do not
    prolong the time.  A micro-batch's keys are written once all destinations have it, so one that
    failed on the way is published again.  Folders older than the time to live are deleted.
    """

    def __init__(self, spark: SparkSession, path: str, ttl_s: float = TTL_S, clock: Callable[[], float] = time.time):
        self.spark, self.path, self.ttl, self.clock = spark, path, ttl_s, clock
        jvm = spark.sparkContext._jvm
        self.at = jvm.org.apache.hadoop.fs.Path
        self.files = self.at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _recent(self) -> list[str]:
        folder, out = self.at(self.path), []
        if not self.files.exists(folder):
            return out
        for s in self.files.listStatus(folder):
            name = s.getPath().getName()
            at = int(name.partition("-")[2]) / 1000
            if self.clock() - at >= self.ttl:
                self.files.delete(s.getPath(), True)
            else:
                out.append(f"{self.path}/{name}")
        return out

    def fresh(self, pubs: DataFrame) -> DataFrame:
        """pubs without repeated keys and those published lately; one shuffle, and the keys of one time to live are read."""
        pubs, recent = pubs.dropDuplicates(KEY), self._recent()
        return pubs.join(self.spark.read.schema(_SCHEMA).parquet(*recent).distinct(), KEY, "left_anti") if recent else pubs

    def remember(self, pubs: DataFrame, batch_id: int) -> None:
        pubs.select(*KEY).write.mode("overwrite").parquet(f"{self.path}/{batch_id}-{int(self.clock() * 1000)}")


def first_by_ttl(stream: DataFrame, ttl_s: float = TTL_S) -> DataFrame:
    """The same as an operator of a streaming plan, with the time to live in the state store.

    Needs the RocksDB state store, which evicts keys.  Without
    spark.sql.streaming.noDataMicroBatches.enabled=false such a query runs empty micro-batches on and
    on to clean its state.
    """
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    schema = stream.schema

    class First(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.seen = handle.getValueState("seen", "seen boolean", int(ttl_s * 1000))

        def handleInputRows(self, key, rows: Iterator, timerValues) -> Iterator:
            done = self.seen.exists()
            for pdf in rows:
                if not done and len(pdf):
                    done = True
                    self.seen.update((True,))
                    yield pdf.iloc[:1]

        def close(self) -> None:
            pass

    return stream.groupBy(*KEY).transformWithStateInPandas(statefulProcessor=First(), outputStructType=schema, outputMode="append", timeMode="processingTime")
