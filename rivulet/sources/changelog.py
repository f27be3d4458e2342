"""Change logs: files of entries, as a batch or a stream, and the log derived from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DENYLIST, ENTRY


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Entries of a folder in Parquet (ENTRY's columns) or raw JSON lines (column raw)."""
    return spark.read.text(path).withColumnRenamed("value", "raw") if fmt == "json" else spark.read.schema(ENTRY).parquet(path)


def stream_log(spark: SparkSession, path: str, fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """The same as a stream: files that appear in the folder, in order; the checkpoint keeps the place."""
    r = spark.readStream
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.text(path).withColumnRenamed("value", "raw") if fmt == "json" else r.schema(ENTRY).parquet(path)


def read_denylist(spark: SparkSession, url: str, table: str = "denylist", **options) -> DataFrame:
    """(entry): a JDBC table that has the column entry, or a folder of Parquet."""
    if url.startswith("jdbc:"):
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().selectExpr("entry").distinct()
    return spark.read.schema(DENYLIST).parquet(url).select("entry").distinct()


#: Databases that the derived log's denylist names.
DENIED = ("db3", "db6")


def derived_denylist(spark: SparkSession) -> DataFrame:
    return spark.sql("select entry from values " + ", ".join(f"('{x}')" for x in DENIED) + " as t(entry)")  # a local relation: its size is known to Catalyst


def derived_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ENTRY's columns, and raw (the entry as one JSON text), from the events table: a row each, by integer rules only.

    signup inserts, click and view update (modifiers and diffs), purchase is a transaction (every
    tenth another command), error deletes.
    """
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "user_id", "event_type", F.get_json_object("props", "$.k").cast("long").alias("k"))
    e = e.selectExpr(
        "event_id as e", "user_id as u", "k", "event_type", "unix_seconds(cast(ts as timestamp)) as ts_t", "event_id as ts_i", "cast(ts as timestamp) as wall",
        "case when event_id % 50 = 7 then 'config' else concat('db', user_id % 8) end as db",
        "case when event_id % 40 = 3 then 'system.indexes' else event_type end as coll",
        "case event_type when 'signup' then 'i' when 'purchase' then 'c' when 'error' then 'd' else 'u' end as op",
        """case when event_id % 101 = 0 then cast(event_id as string)
                when event_id % 3 = 0 then concat('{"$oid":"', lpad(lower(hex(event_id)), 24, '0'), '"}')
                else concat('"u', user_id, '-', event_id, '"') end as id""",
    )
    e = e.selectExpr(
        "*",
        "case when op <> 'c' then concat(db, '.', coll) when e % 10 = 5 then concat(db, '.$cmd') else 'admin.$cmd' end as ns",
        """case when op = 'i' then concat('{"_id":', id, ',"user":', u, ',"k":', k, ',"props":{"k":', k, '}}')
                when op = 'd' then concat('{"_id":', id, '}')
                when op = 'c' and e % 10 = 5 then '{"drop":"x"}'
                when op = 'c' then concat('{"applyOps":[{"op":"i","ns":"', db, '.', coll, '","o":{"_id":', id, ',"n":', k, '}}',
                  case when k % 5 = 0 then concat(',{"op":"c","ns":"admin.$cmd","o":{"applyOps":[{"op":"i","ns":"db', (u + 1) % 8, '.nested","o":{"_id":"n', e, '"}}]}}') else '' end,
                  ',{"op":"u","ns":"', db, '.', coll, '","o":{"$v":2,"diff":{"u":{"x":', k, '}}},"o2":{"_id":', id, '}},{"op":"d","ns":"', db, '.', coll, '","o":{"_id":', id, '}}]}')
                when event_type = 'click' and k % 4 = 0 then concat('{"_id":', id, ',"k":', k, '}')
                when event_type = 'click' and k % 4 = 1 then concat('{"$v":1,"$set":{"a.b":', k, ',"c":1}}')
                when event_type = 'click' and k % 4 = 2 then '{"$v":1,"$unset":{"d":1}}'
                when event_type = 'click' then '{"$v":1,"$set":{"a":1},"$unset":{"e":1}}'
                when k % 4 = 0 then concat('{"$v":2,"diff":{"i":{"n":{"m":', k, '}},"u":{"x":', k, '}}}')
                when k % 4 = 1 then concat('{"$v":2,"diff":{"d":{"z":false},"sfoo":{"u":{"bar":', k, '}}}}')
                when k % 4 = 2 then '{"$v":2,"diff":{"slist":{"a":true,"u3":"i","u4":"h"}}}'
                else '{"$v":2,"diff":{"sg":10,"a":true,"q":1}}' end as o""",
        """case when op = 'u' then concat('{"_id":', id, '}') end as o2""",
    )
    raw = """concat('{"ts":{"t":', ts_t, ',"i":', ts_i, '},"wall":"', date_format(wall, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '","op":"', op, '","ns":"', ns, '","o":', o,
             case when o2 is not null then concat(',"o2":', o2) else '' end, '}')"""
    return e.selectExpr("ts_t", "ts_i", "wall", "op", "ns", "o", "o2", f"{raw} as raw")
