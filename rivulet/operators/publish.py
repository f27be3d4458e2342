"""Operations to messages on channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import documents, names
from . import decode, filters, flatten


def _escaped(json: Column) -> Column:
    """JSON text with <, >, & and the two Unicode line separators escaped, as consumers of the messages expect."""
    for c in ("<", ">", "&", "\u2028", "\u2029"):
        json = F.replace(json, F.lit(c), F.lit(f"\\u{ord(c):04x}"))
    return json


def message(event: Column, id_kind: Column, id_text: Column, fields: Column) -> Column:
    """{"e": event, "d": {"_id": id}, "f": fields}; object ids are {"$type": "oid", "$value": hex}."""
    plain = F.to_json(F.struct(event.alias("e"), F.struct(id_text.alias("_id")).alias("d"), fields.alias("f")))
    oid = F.struct(F.lit("oid").alias("$type"), id_text.alias("$value"))
    return _escaped(F.when(id_kind == "oid", F.to_json(F.struct(event.alias("e"), F.struct(oid.alias("_id")).alias("d"), fields.alias("f")))).otherwise(plain))


def process(ops: DataFrame, deep: bool = False) -> DataFrame:
    """ops (as flatten returns them) with everything that a publication needs, and error.

    Operations without _id, of system collections and of the config database have no rows; those of
    an unsupported id and transactions nested too deep have an error and no message.
    """
    d = decode.with_names(ops)
    too_deep = d.where(~F.col("op").isin(*filters.CRUD)).withColumns({"id_kind": F.lit(None).cast("string"), "id_text": F.lit(None).cast("string"), "id_value": F.lit(None).cast("string")})
    d = filters.not_config(filters.not_system(d.where(F.col("op").isin(*filters.CRUD))))  # by name, before documents are read
    d = filters.with_doc_id(d).unionByName(too_deep)
    error = F.when(~F.col("op").isin(*filters.CRUD), "transactions nested too deep").when(F.col("id_kind") == "unsupported", "unsupported document _id type")
    d = d.withColumns({"error": error, "e": filters.event_name(F.col("op")), "_kind": documents.update_kind(F.col("op"), F.col("o"))})
    d = d.withColumn("_c", documents.changed_fields(F.col("op"), F.col("o"), deep, F.col("_kind")))
    d = d.withColumns({"fields": F.coalesce("_c.fields", F.array().cast("array<string>")), "n_bad": F.coalesce("_c.n_bad", F.lit(1))}).drop("_c", "_kind")
    ok = F.col("error").isNull()
    return d.withColumns(
        {
            "msg": F.when(ok, message(F.col("e"), F.col("id_kind"), F.col("id_text"), F.col("fields"))),
            "channels": F.when(ok, names.channels(F.col("ns"), F.col("id_text"))),
            "parallelism_key": names.parallelism_key(F.col("db")),
        }
    )


def publications(processed: DataFrame) -> DataFrame:
    return processed.where("error is null").select("channels", "msg", "ts_t", "ts_i", "wall", "tx_idx", "parallelism_key")


def dead_letters(processed: DataFrame) -> DataFrame:
    """What cannot be published, with the reason and without the documents."""
    return processed.where("error is not null").select("ts_t", "ts_i", "tx_idx", "op", "ns", "id_value", "error")


def from_log(log: DataFrame, denylist: DataFrame | None = None, deep: bool = False) -> DataFrame:
    """The whole way from entries (valid ones) to processed operations; flatten applies the denylist to entries and their operations alike, without a shuffle."""
    return process(flatten.flatten(log, denylist), deep)


def sharded(pubs: DataFrame, shards: int) -> DataFrame:
    return pubs.withColumn("shard", names.shard(F.col("parallelism_key"), shards))


def ordered_per_db(pubs: DataFrame, partitions: int) -> DataFrame:
    """Each database's publications in one partition, in the order of the log; one shuffle, sorted within partitions only."""
    return pubs.repartition(partitions, "parallelism_key").sortWithinPartitions("ts_t", "ts_i", "tx_idx")


def fan_out(pubs: DataFrame, destinations: list[str]) -> DataFrame:
    """A row for each destination of each publication."""
    return pubs.withColumn("destination", F.explode(F.array(*map(F.lit, destinations))))


def batches(pubs: DataFrame, size: int) -> DataFrame:
    """pubs (shard, ...) with batch: consecutive runs of ``size`` of a shard's publications.

    Places are counts of the minutes before plus the place within the minute, so no shard is sorted in one task.
    """
    p = pubs.withColumn("_minute", F.expr("ts_t div 60"))
    before = p.groupBy("shard", "_minute").agg(F.count(F.lit(1)).alias("_n")).selectExpr("shard", "_minute", "sum(_n) over (partition by shard order by _minute) - _n as _before")
    p = p.selectExpr("*", "row_number() over (partition by shard, _minute order by ts_t, ts_i, tx_idx) - 1 as _r").join(before, ["shard", "_minute"])
    return p.withColumn("batch", F.floor((F.col("_before") + F.col("_r")) / int(size)).cast("long")).select(*pubs.columns, "batch")
