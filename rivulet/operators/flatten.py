"""Transactions to operations, inside the row: no shuffle, and numbers follow the order of the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import ADMIN, CRUD

#: Levels of transactions within transactions that are opened; deeper ones are reported, not dropped.
DEPTH = 3
_OP = "struct<op:string,ns:string,o:string,o2:string>"


def _inner(text: Column, depth: int) -> Column:
    """Array of the operations (structs) in an array of them (JSON text), depth first.  Elements that are no documents go."""
    items = F.filter(F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>")), lambda x: F.json_object_keys(x).isNotNull())
    get = lambda x, p: F.get_json_object(x, p)
    as_op = lambda x: F.struct(get(x, "$.op").alias("op"), F.coalesce(get(x, "$.ns"), F.lit("")).alias("ns"), get(x, "$.o").alias("o"), get(x, "$.o2").alias("o2")).cast(_OP)
    if depth <= 1:
        return F.transform(items, as_op)
    nested = lambda x: (get(x, "$.op") == "c") & (get(x, "$.ns") == ADMIN) & F.startswith(F.coalesce(get(x, "$.o.applyOps"), F.lit("")), F.lit("["))
    return F.flatten(F.transform(items, lambda x: F.when(nested(x), _inner(get(x, "$.o.applyOps"), depth - 1)).otherwise(F.array(as_op(x)))))


def _denied(x: Column, denied: Column) -> Column:
    return (x["ns"] != "") & (x["ns"] != ADMIN) & F.array_contains(denied, F.substring_index(x["ns"], ".", 1))


def _with_denied(df: DataFrame, denylist: DataFrame) -> DataFrame:
    """df with _denied, the listed databases as one array: a scalar subquery, not a join.  The list is small by nature: it is kept in memory by whoever edits it."""
    return df.withColumn("_denied", F.coalesce(denylist.agg(F.array_sort(F.collect_set("entry"))).scalar(), F.array().cast("array<string>")))


def _admin() -> Column:
    return (F.col("op") == "c") & (F.col("ns") == ADMIN)


def _own() -> Column:
    return F.array(F.struct("op", F.coalesce("ns", F.lit("")).alias("ns"), "o", "o2").cast(_OP))


def is_crud(x: Column) -> Column:
    return F.coalesce(x["op"].isin(*CRUD), F.lit(False))


def operations(log: DataFrame, denylist: DataFrame | None = None, depth: int = DEPTH) -> DataFrame:
    """log with _ops, the operations of each entry in order: inserts, updates and deletes that are not denied, then transactions below ``depth`` levels."""
    ops = F.when(F.col("op").isin(*CRUD), _own()).when(_admin(), _inner(F.get_json_object("o", "$.applyOps"), depth)).otherwise(F.array().cast(f"array<{_OP}>"))
    df = log.withColumn("_ops", ops)
    if denylist is not None:
        df = _with_denied(df, denylist)
        df = df.withColumn("_ops", F.filter("_ops", lambda x: ~F.coalesce(_denied(x, F.col("_denied")), F.lit(False)))).drop("_denied")
    deep = lambda x: F.coalesce((x["op"] == "c") & (x["ns"] == ADMIN) & F.startswith(F.coalesce(F.get_json_object(x["o"], "$.applyOps"), F.lit("")), F.lit("[")), F.lit(False))
    return df.withColumn("_ops", F.concat(F.filter("_ops", is_crud), F.filter("_ops", deep)))


def flatten(log: DataFrame, denylist: DataFrame | None = None, depth: int = DEPTH) -> DataFrame:
    """log's ts_t, ts_i, wall and other columns with one row for each operation: tx_idx, op, ns, o, o2.

    Operations inherit their entry's position and time.  tx_idx numbers, from 0 and depth first, the
    inserts, updates and deletes of databases that are not denied, whether or not they have an id.
    Entries that are no operation or transaction have no rows.  A transaction below ``depth`` levels
    appears as a row with op c, so that it can be told of.
    """
    rest = [c for c in log.columns if c not in ("op", "ns", "o", "o2", "tx_idx")]
    df = operations(log, denylist, depth).select(*rest, F.posexplode("_ops").alias("tx_idx", "_x"))
    return df.select(*rest, "tx_idx", "_x.op", "_x.ns", "_x.o", "_x.o2")


def filtered(log: DataFrame, denylist: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(ts_t, ts_i, db): what the denylist drops, a row for each entry and for each operation inside a transaction."""
    ops = F.when(_admin(), _inner(F.get_json_object("o", "$.applyOps"), depth)).otherwise(_own())
    df = _with_denied(log.withColumn("_ops", ops), denylist)
    return df.select("ts_t", "ts_i", F.explode(F.filter("_ops", lambda x: F.coalesce(_denied(x, F.col("_denied")), F.lit(False)))).alias("x")).select("ts_t", "ts_i", F.substring_index("x.ns", ".", 1).alias("db"))
