"""The shapes that pass between operators."""

from pyspark.sql import types as T

#: A change-log entry: o and o2 are JSON texts, whose key order counts.
ENTRY = T.StructType(
    [
        T.StructField("ts_t", T.LongType()),
        T.StructField("ts_i", T.LongType()),
        T.StructField("wall", T.TimestampType()),
        T.StructField("op", T.StringType()),
        T.StructField("ns", T.StringType()),
        T.StructField("o", T.StringType()),
        T.StructField("o2", T.StringType()),
    ]
)

#: A message with its addresses.
PUBLICATION = T.StructType(
    [
        T.StructField("channels", T.ArrayType(T.StringType())),
        T.StructField("msg", T.StringType()),
        T.StructField("ts_t", T.LongType()),
        T.StructField("ts_i", T.LongType()),
        T.StructField("wall", T.TimestampType()),
        T.StructField("tx_idx", T.IntegerType()),
        T.StructField("parallelism_key", T.LongType()),
    ]
)

POSITION = T.StructType([T.StructField("ordinal", T.IntegerType()), T.StructField("ts_t", T.LongType()), T.StructField("ts_i", T.LongType())])
DENYLIST = T.StructType([T.StructField("entry", T.StringType())])
