"""Row filters of the change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import documents, names

ADMIN = "admin.$cmd"
CRUD = ("i", "u", "d")


def denylist_filter(df: DataFrame, denylist: DataFrame) -> DataFrame:
    """df (ns, db) without entries of listed databases; an empty ns and the admin namespace always pass.

    A left anti join: Catalyst broadcasts the list while it is small.
    """
    exempt = F.coalesce(F.col("ns"), F.lit("")).isin("", ADMIN)
    listed = denylist.select(F.col("entry").alias("_entry")).distinct()
    return df.join(listed, (F.when(exempt, None).otherwise(F.col("db")) == F.col("_entry")), "left_anti")


def crud_ops(df: DataFrame) -> DataFrame:
    """Inserts, updates, deletes, and commands of the admin namespace."""
    return df.where(F.col("op").isin(*CRUD) | ((F.col("op") == "c") & (F.col("ns") == ADMIN)))


def transactions(df: DataFrame) -> DataFrame:
    """Commands of the admin namespace that hold an array of operations."""
    return df.where((F.col("op") == "c") & (F.col("ns") == ADMIN) & is_operations(F.col("o")))


def is_operations(o: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.from_json(o, "applyOps variant")["applyOps"]).startswith("ARRAY"), F.lit(False))


def not_system(df: DataFrame) -> DataFrame:
    return df.where(~F.col("coll").startswith("system."))


def not_config(df: DataFrame) -> DataFrame:
    return df.where(F.col("db") != "config")


def classified(df: DataFrame) -> DataFrame:
    return df.withColumns({f"is_{name}": F.col("op") == op for name, op in (("insert", "i"), ("update", "u"), ("remove", "d"))})


def of_shard(df: DataFrame, shards: int, ordinal: int) -> DataFrame:
    """Rows (parallelism_key) of one shard."""
    return df.where(names.shard(F.col("parallelism_key"), shards) == ordinal)


def event_name(op: Column) -> Column:
    return F.when(op == "d", "r").otherwise(op)


def id_source(op: Column, o: Column, o2: Column) -> Column:
    return F.when(op == "u", o2).otherwise(o)


def with_doc_id(df: DataFrame) -> DataFrame:
    """df with id_kind, id_text and id_value (JSON text); rows without the key _id go."""
    d = df.withColumn("_d", id_source(F.col("op"), F.col("o"), F.col("o2"))).where(documents.has_key(F.col("_d"), "_id"))
    d = d.withColumn("_v", documents.id_variant(F.col("_d")))
    return d.withColumns({"id_kind": documents.id_kind(F.col("_v")), "id_text": documents.id_text(F.col("_v")), "id_value": F.coalesce(F.to_json(F.col("_v")), F.lit("null"))}).drop("_d", "_v")
