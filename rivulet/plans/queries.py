"""The registered queries: each operator over the log derived from the events table, as flat columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import documents, names, positions
from ..operators import decode, dedupe, denylist, filters, flatten, metrics, publish, resume, scan
from ..sources import changelog

SHARDS = 4
PREFIX = "rivulet::"
Query = Callable[[SparkSession, str], DataFrame]


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.derived_log(spark, sf_dir)


def _named(spark, sf_dir) -> DataFrame:
    return decode.with_names(_log(spark, sf_dir).drop("raw"))


def _ops(spark, sf_dir) -> DataFrame:
    return flatten.flatten(_log(spark, sf_dir).drop("raw"), changelog.derived_denylist(spark))


def _processed(spark, sf_dir, deep: bool = False) -> DataFrame:
    return publish.from_log(_log(spark, sf_dir).drop("raw"), changelog.derived_denylist(spark), deep)


def _pubs(spark, sf_dir) -> DataFrame:
    return _processed(spark, sf_dir).where("error is null")


def _fields(df: DataFrame) -> DataFrame:
    return df.withColumn("fields", F.array_join(F.array_sort("fields"), ","))


def _entries(spark, sf_dir) -> DataFrame:
    log = _log(spark, sf_dir).withColumn("size", F.octet_length("raw").cast("long")).drop("raw")
    return metrics.entry_metrics(log, changelog.derived_denylist(spark))


def publications(spark, sf_dir):
    p = publish.publications(_processed(spark, sf_dir))
    return p.select(F.array_join("channels", "$").alias("channels"), "msg", "ts_t", "ts_i", "tx_idx", "parallelism_key")


def scan_after_position(spark, sf_dir):
    log = _log(spark, sf_dir)
    return scan.after_position(log, 1704110400, 5000).select("ts_t", "ts_i", "op", "ns")


def latest_position(spark, sf_dir):
    return scan.latest_position(_log(spark, sf_dir))


def min_position(spark, sf_dir):
    p = scan.shard_positions(publish.sharded(_pubs(spark, sf_dir), SHARDS))
    return scan.min_position(p, SHARDS)


def premature_stop_streak(spark, sf_dir):
    """Runs of the tailer made from purchases: each starts at its event and lasts value % 100 seconds, whole."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").where("event_type = 'error'")
    runs = e.selectExpr("event_id as run_id", "event_id * 1000 as started_t", "event_id * 1000 + (event_id * 37) % 100 as stopped_t")
    return resume.streaks(runs)


def resume_cases(spark, sf_dir) -> DataFrame:
    return _log(spark, sf_dir).selectExpr(
        "ts_i as case_id", "case when ts_i % 5 = 0 then null else ts_t - ts_i % 300 end as stored_t", "ts_i % 11 = 0 as store_failed",
        "case when ts_i % 13 = 0 then null else ts_t - 1 end as end_t", "ts_t as as_of_t",
    )


def resume_decision(spark, sf_dir, from_end: bool = False):
    return resume.resume_decisions(resume_cases(spark, sf_dir), 120, from_end)


def decode_envelope(spark, sf_dir):
    d = decode.decode_envelope(_log(spark, sf_dir).select("raw"))
    return d.select("ts_t", "ts_i", F.unix_seconds("wall").alias("wall_s"), "op", "ns", "valid", F.octet_length("o").cast("long").alias("o_bytes"), F.octet_length("o2").cast("long").alias("o2_bytes"))


def publish_log(spark, sf_dir):
    p = publish.sharded(_pubs(spark, sf_dir), SHARDS)
    return p.select("shard", F.array_join("channels", "$").alias("channels"), "msg", positions.encode(F.col("ts_t"), F.col("ts_i")).alias("position"), "tx_idx")


def _two_instances(spark, sf_dir) -> DataFrame:
    p = publish.sharded(_pubs(spark, sf_dir), SHARDS).select("ts_t", "ts_i", "tx_idx", "msg", "wall", "shard")
    a = p.withColumns({"instance": F.lit(1), "arrival_s": F.unix_seconds("wall")})
    b = p.withColumns({"instance": F.lit(2), "arrival_s": F.unix_seconds("wall") + F.col("ts_i") % 300})
    return a.unionByName(b).drop("wall")


def publish_status(spark, sf_dir):
    d = dedupe.with_ttl(_two_instances(spark, sf_dir), 150)
    return d.select("ts_t", "ts_i", "tx_idx", "arrival_s", F.when(F.col("published"), "published").otherwise("duplicate").alias("status"))


def dedupe_first(spark, sf_dir):
    return dedupe.first_only(_two_instances(spark, sf_dir), "arrival_s").select("ts_t", "ts_i", "tx_idx", "msg", "instance", "arrival_s")


def dedupe_ttl(spark, sf_dir):
    return dedupe.with_ttl(_two_instances(spark, sf_dir), 150)


def ha_dedupe(spark, sf_dir):
    x = dedupe.first_only(_two_instances(spark, sf_dir), "arrival_s")
    return x.groupBy("instance").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ts_i").alias("n_entries"))


def fanout_destinations(spark, sf_dir):
    return publish.fan_out(_pubs(spark, sf_dir).select("ts_i", "tx_idx", "msg"), ["a", "b"])


def parse_sentinel_url(spark, sf_dir):
    u = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        """concat('redis-sentinel://', if(event_id % 3 = 0, concat('pw', user_id, '@'), ''), 'h', user_id, ':', 7000 + event_id % 100,
           if(event_id % 2 = 0, concat(',g', user_id, ':', if(event_id % 7 = 0, 'x', '1')), ''), if(event_id % 5 = 0, concat('/', event_id % 16), ''),
           if(event_id % 4 = 0, concat('?sentinelMasterId=m', event_id % 9), '')) as url""",
    )
    p = names.sentinel_parts(F.col("url"))
    return u.select("event_id", "url", p["valid"].alias("valid"), p["password"].alias("password"), F.array_join(p["endpoints"], ",").alias("endpoints"), p["db"].alias("db"), p["master"].alias("master"))


def _edits(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("event_id as seq", "case when (event_id * 7) % 3 = 0 then 'remove' else 'add' end as verb", "concat('db', user_id % 12) as entry")


def denylist_apply(spark, sf_dir):
    return denylist.applied(changelog.derived_denylist(spark), _edits(spark, sf_dir))


def denylist_state(spark, sf_dir):
    return denylist.states(_edits(spark, sf_dir))


def denylist_filter(spark, sf_dir):
    return filters.denylist_filter(_named(spark, sf_dir), changelog.derived_denylist(spark)).select("ts_t", "ts_i", "op", "ns", "db", "coll")


def filter_crud_ops(spark, sf_dir):
    return filters.crud_ops(_log(spark, sf_dir)).select("ts_i", "op", "ns")


def filter_commands(spark, sf_dir):
    return filters.transactions(_log(spark, sf_dir)).select("ts_i", "op", "ns")


def flatten_transaction(spark, sf_dir):
    return _ops(spark, sf_dir).select("ts_t", "ts_i", "tx_idx", "op", "ns", "o", "o2")


def flatten_nested(spark, sf_dir):
    return flatten.flatten(_log(spark, sf_dir).where("ns = 'admin.$cmd'").drop("raw")).where("ns like '%.nested'").select("ts_t", "ts_i", "tx_idx", "op", "ns", "o")


def tx_index(spark, sf_dir):
    return _ops(spark, sf_dir).groupBy("ts_i").agg(F.count(F.lit(1)).alias("n_ops"), F.max("tx_idx").alias("last_tx_idx"), F.sum("tx_idx").alias("sum_tx_idx"))


def doc_id(spark, sf_dir):
    return filters.with_doc_id(_ops(spark, sf_dir)).select("ts_i", "tx_idx", "op", "id_kind", "id_text", "id_value")


def filter_system(spark, sf_dir):
    return filters.not_system(_named(spark, sf_dir)).select("ts_i", "ns")


def filter_config(spark, sf_dir):
    return filters.not_config(_named(spark, sf_dir)).select("ts_i", "ns")


def id_typing(spark, sf_dir):
    return filters.with_doc_id(_ops(spark, sf_dir)).groupBy("op", "id_kind").agg(F.count(F.lit(1)).alias("n"), F.count("id_text").alias("n_publishable"))


def dead_letters(spark, sf_dir):
    return publish.dead_letters(_processed(spark, sf_dir))


def event_name(spark, sf_dir):
    return _ops(spark, sf_dir).groupBy(filters.event_name(F.col("op")).alias("event")).agg(F.count(F.lit(1)).alias("n"))


def classify_ops(spark, sf_dir):
    return filters.classified(_log(spark, sf_dir)).select("ts_i", "is_insert", "is_update", "is_remove")


def update_kind(spark, sf_dir):
    return _ops(spark, sf_dir).where("op = 'u'").select("ts_i", "tx_idx", documents.update_kind(F.col("op"), F.col("o")).alias("kind"))


def shard_filter(spark, sf_dir):
    return filters.of_shard(_pubs(spark, sf_dir), SHARDS, 1).select("ts_i", "tx_idx", "parallelism_key")


def parallelism_key(spark, sf_dir):
    db = names.database(F.col("ns"))
    return _log(spark, sf_dir).select("ns").distinct().select("ns", names.parallelism_key(db).alias("parallelism_key"))


def shard_assign(spark, sf_dir):
    k = names.parallelism_key(names.database(F.col("ns")))
    return _log(spark, sf_dir).groupBy(names.shard(k, SHARDS).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def parse_namespace(spark, sf_dir):
    return _named(spark, sf_dir).groupBy("ns", "db", "coll").agg(F.count(F.lit(1)).alias("n"))


def changed_fields_insert(spark, sf_dir):
    return _log(spark, sf_dir).where("op = 'i'").select("ts_i", F.array_join(documents.keys(F.col("o")), ",").alias("fields"))


def changed_fields(spark, sf_dir, deep: bool = False):
    return _fields(_processed(spark, sf_dir, deep).where("error is null").select("ts_i", "tx_idx", "op", "fields", "n_bad"))


def _updates_of(spark, sf_dir, kind: str) -> DataFrame:
    return _ops(spark, sf_dir).where("op = 'u'").where(documents.update_kind(F.col("op"), F.col("o")) == kind)


def changed_fields_v1(spark, sf_dir):
    c = documents.modifier_fields(F.col("o"))
    return _fields(_updates_of(spark, sf_dir, "v1").select("ts_i", "tx_idx", c.alias("c")).select("ts_i", "tx_idx", "c.fields", "c.n_bad"))


def changed_fields_v2_shallow(spark, sf_dir):
    c = documents.shallow_diff(F.get_json_object("o", "$.diff"))
    return _fields(_updates_of(spark, sf_dir, "v2").select("ts_i", "tx_idx", c.alias("c")).select("ts_i", "tx_idx", "c.fields", "c.n_bad"))


def changed_fields_v2_deep(spark, sf_dir):
    c = documents.deep_diff(F.get_json_object("o", "$.diff"))
    return _fields(_updates_of(spark, sf_dir, "v2").select("ts_i", "tx_idx", c.alias("c")).select("ts_i", "tx_idx", "c.fields", "c.n_bad"))


def is_array_operator(spark, sf_dir):
    v2 = _updates_of(spark, sf_dir, "v2").select("ts_i", "tx_idx", F.get_json_object("o", "$.diff.slist").alias("d"))
    return v2.select("ts_i", "tx_idx", documents.is_array_operator(F.col("d")).alias("is_array_operator"))


def message_json(spark, sf_dir):
    return _pubs(spark, sf_dir).select("ts_i", "tx_idx", "msg")


def channels(spark, sf_dir):
    return _pubs(spark, sf_dir).select("ts_i", "tx_idx", F.get("channels", 0).alias("collection_channel"), F.get("channels", 1).alias("document_channel"))


def channel_explode(spark, sf_dir):
    joined = _pubs(spark, sf_dir).select("ts_i", "tx_idx", names.join_channels(F.col("channels")).alias("c"))
    return joined.select("ts_i", "tx_idx", F.explode(names.split_channels(F.col("c"))).alias("channel"))


def ts_encode(spark, sf_dir):
    return _log(spark, sf_dir).select("ts_t", "ts_i", positions.encode(F.col("ts_t"), F.col("ts_i")).alias("position"))


def ts_decode(spark, sf_dir):
    p = _log(spark, sf_dir).select(F.when(F.col("ts_i") % 17 == 0, F.concat(F.lit("x"), F.col("ts_i"))).otherwise(positions.encode(F.col("ts_t"), F.col("ts_i"))).alias("position"))
    return p.select("position", positions.decode_t(F.col("position")).alias("ts_t"), positions.decode_i(F.col("position")).alias("ts_i"))


def dedupe_key(spark, sf_dir):
    return _pubs(spark, sf_dir).select("ts_i", "tx_idx", positions.dedupe_key(PREFIX, F.col("ts_t"), F.col("ts_i"), F.col("tx_idx")).alias("key"))


def staleness(spark, sf_dir):
    as_of = F.timestamp_seconds(F.col("ts_t") + F.col("ts_i") % 7 - 3)
    return _log(spark, sf_dir).select("ts_i", metrics.staleness(as_of, F.timestamp_seconds("ts_t")).alias("staleness_s"))


def log_projection(spark, sf_dir):
    return decode.log_projection(_log(spark, sf_dir)).select("ts_t", "ts_i", "op", "ns")


def entries_received(spark, sf_dir):
    return _entries(spark, sf_dir).groupBy("database", "status").agg(F.count(F.lit(1)).alias("n"))


def entries_size(spark, sf_dir):
    return _entries(spark, sf_dir).groupBy("database").agg(F.sum("size").alias("bytes"))


def size_histogram(spark, sf_dir):
    return metrics.histogram(_entries(spark, sf_dir), "size", metrics.SIZE_BOUNDS, ["database", "status"])


def filtered_count(spark, sf_dir):
    return flatten.filtered(_log(spark, sf_dir).drop("raw"), changelog.derived_denylist(spark)).groupBy("db").agg(F.count(F.lit(1)).alias("n"))


def _maxima(spark, sf_dir) -> DataFrame:
    return metrics.interval_max(_entries(spark, sf_dir), "wall", "size", ["database", "status"])


def interval_max(spark, sf_dir):
    return _maxima(spark, sf_dir).select("database", "status", F.unix_seconds("window_start").alias("window_start_s"), F.unix_seconds("visible_from").alias("visible_from_s"), F.col("value").alias("max_size"))


def interval_max_report(spark, sf_dir):
    """By the hour: what a reader at the last entry's time sees."""
    e = _entries(spark, sf_dir)
    maxima = metrics.interval_max(e, "wall", "size", ["database", "status"], "1 hour")
    return metrics.interval_report(maxima, e.agg(F.max("wall")).scalar(), ["database", "status"], 3600).withColumnRenamed("value", "max_size")


def _arrived(spark, sf_dir) -> DataFrame:
    """Publications with what their staleness is when they are read: up to six seconds after their time."""
    p = publish.sharded(_pubs(spark, sf_dir), SHARDS)
    return p.withColumn("stale", metrics.staleness(F.timestamp_seconds(F.col("ts_t") + F.col("ts_i") % 7), F.timestamp_seconds("ts_t")))


def last_staleness(spark, sf_dir):
    return _arrived(spark, sf_dir).groupBy(F.col("shard").alias("ordinal")).agg(F.max_by("stale", F.struct("ts_t", "ts_i", "tx_idx")).alias("staleness_s"))


def pre_retry_staleness(spark, sf_dir):
    return metrics.head_staleness(publish.batches(_arrived(spark, sf_dir), 25), F.col("stale"))


def resume_gap_histogram(spark, sf_dir):
    return metrics.histogram(resume.gaps(resume_decision(spark, sf_dir)), "gap_s", metrics.GAP_BOUNDS, ["status"])


def unprocessable_count(spark, sf_dir, deep: bool = False):
    return _processed(spark, sf_dir, deep).agg(F.sum("n_bad").cast("long").alias("n"))


def _sent(spark, sf_dir) -> DataFrame:
    """(ordinal, status, size) of batches sent to a destination that refuses those whose first publication's number divides by 97."""
    b = publish.batches(publish.sharded(_pubs(spark, sf_dir), SHARDS), 25).groupBy(F.col("shard").alias("ordinal"), "batch")
    b = b.agg(F.count(F.lit(1)).alias("size"), F.min_by("ts_i", F.struct("ts_t", "ts_i", "tx_idx")).alias("head"))
    return b.select("ordinal", F.when(F.col("head") % 97 == 0, "failed").otherwise("sent").alias("status"), "size")


def processed_messages(spark, sf_dir):
    return _sent(spark, sf_dir).groupBy("status").agg(F.sum("size").alias("n"))


def batch_assign(spark, sf_dir):
    p = publish.sharded(_pubs(spark, sf_dir), SHARDS)
    return publish.batches(p, 25).select("shard", "ts_i", "tx_idx", "batch")


def batch_size_histogram(spark, sf_dir):
    return metrics.histogram(_sent(spark, sf_dir), "size", metrics.BATCH_BOUNDS, ["ordinal", "status"])


def _statuses(spark, sf_dir) -> DataFrame:
    d = dedupe.with_ttl(_two_instances(spark, sf_dir), 150, carry=["shard"])
    stale = F.greatest(F.col("arrival_s") - F.col("ts_t"), F.lit(0)).cast("long")
    return d.select("ts_t", "ts_i", "tx_idx", "arrival_s", F.col("shard").alias("ordinal"), F.when(F.col("published"), "published").otherwise("duplicate").alias("status"), stale.alias("staleness_s"))


def last_entry_staleness(spark, sf_dir):
    return _statuses(spark, sf_dir).groupBy("ordinal", "status").agg(F.max_by("staleness_s", F.struct("ts_t", "ts_i", "tx_idx", "arrival_s")).alias("staleness_s"))


def staleness_histogram(spark, sf_dir):
    return metrics.histogram(_statuses(spark, sf_dir), "staleness_s", metrics.STALENESS_BOUNDS, ["ordinal", "status"])


def oldest_pending_age(spark, sf_dir):
    """Two destinations: one has each shard up to its last insert, the other up to its last removal; as of the log's last entry."""
    p = publish.sharded(_pubs(spark, sf_dir), SHARDS)
    client = F.when(F.col("op") == "i", 0).when(F.col("op") == "d", 1).alias("client_index")
    at = p.groupBy(F.col("shard").alias("ordinal"), client).agg(F.max(F.struct("ts_t", "ts_i")).alias("x")).where("client_index is not null").select("ordinal", "client_index", "x.ts_t", "x.ts_i")
    return metrics.oldest_pending(p, at, _log(spark, sf_dir).agg(F.max("ts_t")).scalar())


def ordered_per_db(spark, sf_dir):
    """Publications with their place in their database's order, read off partitions that are sorted, not ranked."""
    p = publish.ordered_per_db(_pubs(spark, sf_dir).select("ts_t", "ts_i", "tx_idx", "parallelism_key"), SHARDS)
    return p.selectExpr("parallelism_key", "ts_i", "tx_idx", "row_number() over (partition by parallelism_key order by ts_t, ts_i, tx_idx) as place")


def shard_route(spark, sf_dir):
    return publish.sharded(_pubs(spark, sf_dir), SHARDS).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("parallelism_key").alias("n_databases"))


NAMES = (
    "publications scan_after_position latest_position min_position premature_stop_streak resume_decision decode_envelope publish_log publish_status dedupe_first dedupe_ttl ha_dedupe "
    "fanout_destinations parse_sentinel_url denylist_apply denylist_state denylist_filter filter_crud_ops filter_commands flatten_transaction flatten_nested tx_index doc_id filter_system "
    "filter_config id_typing dead_letters event_name classify_ops update_kind shard_filter parallelism_key shard_assign parse_namespace changed_fields_insert changed_fields changed_fields_v1 "
    "changed_fields_v2_shallow changed_fields_v2_deep is_array_operator message_json channels channel_explode ts_encode ts_decode dedupe_key staleness log_projection entries_received entries_size "
    "size_histogram filtered_count interval_max interval_max_report last_staleness pre_retry_staleness resume_gap_histogram unprocessable_count processed_messages batch_assign batch_size_histogram "
    "last_entry_staleness staleness_histogram oldest_pending_age ordered_per_db shard_route"
).split()

QUERIES: dict[str, Query] = {name: globals()[name] for name in NAMES} | {
    "changed_fields_deep": partial(changed_fields, deep=True),
    "unprocessable_count_deep": partial(unprocessable_count, deep=True),
    "resume_decision_from_end": partial(resume_decision, from_end=True),
}
