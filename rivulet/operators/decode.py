"""Raw entries (one JSON text each) to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names

_NUMBER = "^(BIGINT|INT|SMALLINT|TINYINT)$"


def decode_envelope(raw: DataFrame, col: str = "raw") -> DataFrame:
    """raw's other columns with ts_t, ts_i, wall, op, ns, o, o2, valid.

    Every field may be missing (null); a field of another type than its own makes the entry invalid,
    as does text that is no JSON document.  The text is parsed once; o and o2 stay text.
    """
    e = F.from_json(col, "ts variant, wall variant, op variant, ns variant, o variant, o2 variant")
    kind = lambda f: F.schema_of_variant(F.col(f"_e.{f}"))
    ok = lambda f, pattern: F.coalesce(kind(f).rlike(pattern), F.lit(True))
    get = lambda f, path, t: F.try_variant_get(F.col(f"_e.{f}"), path, t)
    u32 = lambda path: F.schema_of_variant(get("ts", path, "variant")).rlike(_NUMBER) & get("ts", path, "bigint").between(0, (1 << 32) - 1)
    wall = F.try_to_timestamp(get("wall", "$", "string"))
    valid = (
        F.coalesce(F.col("_e.ts").isNull() | (u32("$.t") & u32("$.i")), F.lit(False))
        & ok("wall", "^STRING$")
        & (F.col("_e.wall").isNull() | wall.isNotNull())
        & ok("op", "^STRING$")
        & ok("ns", "^STRING$")
        & ok("o", "^OBJECT")
        & ok("o2", "^OBJECT")
        & F.json_object_keys(col).isNotNull()
    )
    rest = [c for c in raw.columns if c not in (col, "ts_t", "ts_i", "wall", "op", "ns", "o", "o2", "valid")]
    return raw.withColumn("_e", e).select(
        *rest, get("ts", "$.t", "bigint").alias("ts_t"), get("ts", "$.i", "bigint").alias("ts_i"), wall.alias("wall"),
        get("op", "$", "string").alias("op"), get("ns", "$", "string").alias("ns"),
        F.get_json_object(col, "$.o").alias("o"), F.get_json_object(col, "$.o2").alias("o2"), F.coalesce(valid, F.lit(False)).alias("valid"),
    )


def with_names(df: DataFrame, ns: str | Column = "ns") -> DataFrame:
    """df with db and coll."""
    ns = F.col(ns) if isinstance(ns, str) else ns
    return df.withColumns({"db": F.coalesce(names.database(ns), F.lit("")), "coll": F.coalesce(names.collection(ns), F.lit(""))})


def log_projection(df: DataFrame) -> DataFrame:
    """What may be logged: everything but the documents."""
    return df.drop("o", "o2", "raw")
