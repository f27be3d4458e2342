"""Duplicate suppression in batch; rivulet.streaming.state does it for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

KEY = ["ts_t", "ts_i", "tx_idx"]


def first_only(df: DataFrame, order: str = "arrival") -> DataFrame:
    """One row of each key, the one that arrived first.

    An aggregation, combined before the shuffle, rather than a sort of each key's rows.
    """
    rest = [c for c in df.columns if c not in KEY]
    x = df.groupBy(*KEY).agg(F.min_by(F.struct(*rest), F.struct(order, *[c for c in rest if c == "instance"])).alias("x"))
    return x.select(*KEY, "x.*")


def with_ttl(df: DataFrame, ttl_s: float, order: str = "arrival_s", carry: list[str] = ()) -> DataFrame:
    """Keys with each arrival (seconds) and whether it publishes: the first, and each that comes ttl or more after the last that did.

    Duplicates do not prolong the time.  A key's arrivals are folded in order as they are read, so
    memory does not grow with the copies of a key.  Rows without an arrival are left out.
    carry: columns that a key's rows agree in.
    """
    columns = [*KEY, *carry, order]
    a = df.where(F.col(order).isNotNull()).select(*columns, F.col(order).cast("double").alias("_at"))
    a = a.repartition(*KEY).sortWithinPartitions(*KEY, "_at")

    def fold(batches):
        import pyarrow as pa

        key = last = None  # kept from batch to batch, since a key's arrivals may go on in the next
        for batch in batches:
            out = []
            for k, at in zip(zip(*(batch.column(c).to_pylist() for c in KEY), strict=True), batch.column("_at").to_pylist(), strict=True):
                go = k != key or not at - last < ttl_s
                if go:
                    key, last = k, at
                out.append(go)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(out, pa.bool_())], [*columns, "published"])

    return a.mapInArrow(fold, StructType([*a.schema.fields[:-1], StructField("published", BooleanType())]))
