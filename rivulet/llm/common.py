"""What the corpus operators share: word patterns, staged tables and connected components."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only a local master may leave it unset (as tests do); a folder of this machine is then used.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file://" + os.path.join(tempfile.gettempdir(), "rivulet-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    try:
        _delete(spark, path)
    except Exception:  # noqa: BLE001  the JVM may be gone; the folder then stays for the cluster's own cleaning
        pass


class Stages:
    """Tables written once in the shared folder and read again.

    A staged table cuts lineage (a lost executor costs a reread, not a recomputation), is computed
    once however often it is used, and has a known size, from which Catalyst chooses between
    broadcast and shuffle.  ``drop`` deletes one that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/rivulet/{name}-{uuid.uuid4().hex}", 0
        atexit.register(_delete_at_exit, spark, self.root)

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._staged_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            _delete(self.spark, t._staged_path)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, stages: Stages, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``edges`` (u, v): component is the smallest id reachable.

    Alternating large-star and small-star steps: each is an aggregation of neighbourhood minima
    (map-side combined, so a hub costs no large group) and a join back, staged to cut lineage.
    Nothing but the count of changed edges comes to the driver.  Ids may be any ordered type;
    null ids and self-loops are dropped.  No edges give no rows.
    """
    e = (
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    e = stages.put(e, "cc")
    for _ in range(max_rounds):
        # large-star: every larger neighbour of x is linked to the smallest of x and its neighbours
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = stages.put(least, "cc-min")
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stages.put(large, "cc-large")
        # small-star: x and its smaller neighbours are linked to the smallest of them
        small_min = stages.put(large.groupBy("u").agg(F.min("v").alias("m")), "cc-smin")
        small = (
            large.join(small_min, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.u", "x.v")
            .where("u <> v")
            .distinct()
        )
        small = stages.put(small, "cc-small")
        same = _digest(e) == _digest(small)
        stages.drop(e, least, large, small_min)
        e = small
        if same:
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    """Order-free count and two sums over the edges: equal edge sets give equal digests."""
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
            F.sum(F.xxhash64("v", "u", F.lit(7)).cast("decimal(38,0)")),
        ).collect()[0]
    )
