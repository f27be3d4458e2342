"""DuckDB SQL with the registered queries' rows.

The SQL follows the rules of the derived log (rivulet.sources.changelog) and states what each
operator should make of them, rather than parsing the documents again.
"""

from __future__ import annotations

from ..operators import metrics

_ID = """CASE WHEN event_id % 101 = 0 THEN event_id::VARCHAR
     WHEN event_id % 3 = 0 THEN '{"$oid":"' || lpad(lower(hex(event_id)), 24, '0') || '"}'
     ELSE '"u' || user_id || '-' || event_id || '"' END"""

BASE = f"""
ev AS (SELECT event_id AS e, user_id AS u, (json_extract_string(props, '$.k'))::BIGINT AS k, event_type, epoch_us(ts) // 1000000 AS ts_t, ts,
  CASE WHEN event_id % 50 = 7 THEN 'config' ELSE 'db' || (user_id % 8) END AS db,
  CASE WHEN event_id % 40 = 3 THEN 'system.indexes' ELSE event_type END AS coll,
  CASE event_type WHEN 'signup' THEN 'i' WHEN 'purchase' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, {_ID} AS id FROM events),
log AS (SELECT *, e AS ts_i, CASE WHEN op <> 'c' THEN db || '.' || coll WHEN e % 10 = 5 THEN db || '.$cmd' ELSE 'admin.$cmd' END AS ns,
  CASE WHEN op = 'i' THEN '{{"_id":' || id || ',"user":' || u || ',"k":' || k || ',"props":{{"k":' || k || '}}}}'
    WHEN op = 'd' THEN '{{"_id":' || id || '}}'
    WHEN op = 'c' AND e % 10 = 5 THEN '{{"drop":"x"}}'
    WHEN op = 'c' THEN '{{"applyOps":[{{"op":"i","ns":"' || db || '.' || coll || '","o":{{"_id":' || id || ',"n":' || k || '}}}}' ||
      CASE WHEN k % 5 = 0 THEN ',{{"op":"c","ns":"admin.$cmd","o":{{"applyOps":[{{"op":"i","ns":"db' || ((u + 1) % 8) || '.nested","o":{{"_id":"n' || e || '"}}}}]}}}}' ELSE '' END ||
      ',{{"op":"u","ns":"' || db || '.' || coll || '","o":{{"$v":2,"diff":{{"u":{{"x":' || k || '}}}}}},"o2":{{"_id":' || id || '}}}},{{"op":"d","ns":"' || db || '.' || coll || '","o":{{"_id":' || id || '}}}}]}}'
    WHEN event_type = 'click' AND k % 4 = 0 THEN '{{"_id":' || id || ',"k":' || k || '}}'
    WHEN event_type = 'click' AND k % 4 = 1 THEN '{{"$v":1,"$set":{{"a.b":' || k || ',"c":1}}}}'
    WHEN event_type = 'click' AND k % 4 = 2 THEN '{{"$v":1,"$unset":{{"d":1}}}}'
    WHEN event_type = 'click' THEN '{{"$v":1,"$set":{{"a":1}},"$unset":{{"e":1}}}}'
    WHEN k % 4 = 0 THEN '{{"$v":2,"diff":{{"i":{{"n":{{"m":' || k || '}}}},"u":{{"x":' || k || '}}}}}}'
    WHEN k % 4 = 1 THEN '{{"$v":2,"diff":{{"d":{{"z":false}},"sfoo":{{"u":{{"bar":' || k || '}}}}}}}}'
    WHEN k % 4 = 2 THEN '{{"$v":2,"diff":{{"slist":{{"a":true,"u3":"i","u4":"h"}}}}}}'
    ELSE '{{"$v":2,"diff":{{"sg":10,"a":true,"q":1}}}}' END AS o,
  CASE WHEN op = 'u' THEN '{{"_id":' || id || '}}' END AS o2 FROM ev),
raw AS (SELECT *, '{{"ts":{{"t":' || ts_t || ',"i":' || ts_i || '}},"wall":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","op":"' || op || '","ns":"' || ns || '","o":' || o ||
  CASE WHEN o2 IS NOT NULL THEN ',"o2":' || o2 ELSE '' END || '}}' AS raw FROM log),
parts AS (
  SELECT e, u, k, event_type, ts_t, ts_i, ts, raw, 0 AS pos, op, ns, db, coll, id, o, o2, 'own' AS part FROM raw WHERE op <> 'c'
  UNION ALL SELECT e, u, k, event_type, ts_t, ts_i, ts, raw, 0, 'i', db || '.' || coll, db, coll, id, '{{"_id":' || id || ',"n":' || k || '}}', NULL, 'inner' FROM raw WHERE ns = 'admin.$cmd'
  UNION ALL SELECT e, u, k, event_type, ts_t, ts_i, ts, raw, 1, 'i', 'db' || ((u + 1) % 8) || '.nested', 'db' || ((u + 1) % 8), 'nested', '"n' || e || '"', '{{"_id":"n' || e || '"}}', NULL, 'nested' FROM raw WHERE ns = 'admin.$cmd' AND k % 5 = 0
  UNION ALL SELECT e, u, k, event_type, ts_t, ts_i, ts, raw, 2, 'u', db || '.' || coll, db, coll, id, '{{"$v":2,"diff":{{"u":{{"x":' || k || '}}}}}}', '{{"_id":' || id || '}}', 'inner' FROM raw WHERE ns = 'admin.$cmd'
  UNION ALL SELECT e, u, k, event_type, ts_t, ts_i, ts, raw, 3, 'd', db || '.' || coll, db, coll, id, '{{"_id":' || id || '}}', NULL, 'inner' FROM raw WHERE ns = 'admin.$cmd'),
ops AS (
  SELECT *, (row_number() OVER (PARTITION BY e ORDER BY pos) - 1)::INTEGER AS tx_idx, first_value(db) OVER (PARTITION BY e ORDER BY pos) AS first_db,
    CASE WHEN id[1] = '"' THEN 'string' WHEN id[1] = '{{' THEN 'oid' ELSE 'unsupported' END AS id_kind,
    CASE WHEN id[1] = '"' THEN id[2:-2] WHEN id[1] = '{{' THEN json_extract_string(id, '$."$oid"') END AS id_text,
    CASE WHEN op = 'd' THEN []::VARCHAR[] WHEN part = 'nested' THEN ['_id'] WHEN part = 'inner' AND op = 'i' THEN ['_id', 'n'] WHEN part = 'inner' THEN ['x']
      WHEN op = 'i' THEN ['_id', 'user', 'k', 'props']
      WHEN event_type = 'click' THEN CASE k % 4 WHEN 0 THEN ['_id', 'k'] WHEN 1 THEN ['a.b', 'c'] WHEN 2 THEN ['d'] ELSE ['a', 'e'] END
      ELSE CASE k % 4 WHEN 0 THEN ['n', 'x'] WHEN 1 THEN ['z', 'foo'] WHEN 2 THEN ['list'] ELSE ['g'] END END AS f,
    CASE WHEN part = 'own' AND event_type = 'view' THEN CASE k % 4 WHEN 0 THEN ['n.m', 'x'] WHEN 1 THEN ['foo.bar', 'z'] WHEN 2 THEN ['list.3', 'list.4'] ELSE []::VARCHAR[] END END AS f_deep,
    CASE WHEN part = 'own' AND event_type = 'view' AND k % 4 = 3 THEN 1 ELSE 0 END AS bad,
    CASE WHEN op <> 'u' THEN NULL WHEN part = 'inner' OR event_type = 'view' THEN 'v2' WHEN k % 4 = 0 THEN 'replacement' ELSE 'v1' END AS kind
  FROM parts WHERE db NOT IN ('db3', 'db6')),
proc AS (
  SELECT *, list_reduce(list_prepend(0::HUGEINT, list_transform(range(8), lambda i: ('0x' || sha256(db)[49 + 2 * i:50 + 2 * i])::HUGEINT * (256::HUGEINT ** i)::HUGEINT)), lambda a, b: a + b) AS key_u,
    CASE op WHEN 'd' THEN 'r' ELSE op END AS ev, id_kind = 'unsupported' AS failed
  FROM ops WHERE NOT starts_with(coll, 'system.') AND db <> 'config'),
pubs AS (
  SELECT *, (CASE WHEN key_u >= 9223372036854775808 THEN key_u - 18446744073709551616 ELSE key_u END)::BIGINT AS parallelism_key,
    '{{"e":"' || ev || '","d":{{"_id":' || CASE id_kind WHEN 'oid' THEN '{{"$type":"oid","$value":"' || id_text || '"}}' ELSE '"' || id_text || '"' END || '}},"f":[' ||
      array_to_string(list_transform(f, lambda x: '"' || x || '"'), ',') || ']}}' AS msg
  FROM proc WHERE NOT failed),
sharded AS (SELECT *, (((parallelism_key % 4) + 4) % 4)::INTEGER AS shard FROM pubs),
entries AS (
  SELECT ts_t, ts_i, max(octet_length(encode(raw)))::BIGINT AS size, min(first_db) AS database, CASE WHEN bool_or(failed) THEN 'error' ELSE 'processed' END AS status
  FROM proc GROUP BY ts_t, ts_i HAVING bool_or(NOT failed)),
two AS (
  SELECT ts_t, ts_i, tx_idx, msg, 1 AS instance, ts_t AS arrival_s, shard FROM sharded UNION ALL SELECT ts_t, ts_i, tx_idx, msg, 2, ts_t + ts_i % 300, shard FROM sharded),
batched AS (
  SELECT *, r // 25 AS batch FROM (SELECT shard AS ordinal, ts_i, row_number() OVER (PARTITION BY shard ORDER BY ts_t, ts_i, tx_idx) - 1 AS r FROM sharded)),
sent AS (
  SELECT ordinal, CASE WHEN arg_min(ts_i, r) % 97 = 0 THEN 'failed' ELSE 'sent' END AS status, count(*) AS size FROM batched GROUP BY ordinal, batch),
status AS (
  SELECT ts_t, ts_i, tx_idx, arrival_s, shard, instance = 1 OR ts_i % 300 >= 150 AS published FROM two),
cases AS (
  SELECT ts_i AS case_id, CASE WHEN ts_i % 5 = 0 THEN NULL ELSE ts_t - ts_i % 300 END AS stored_t, ts_i % 11 = 0 AS store_failed, CASE WHEN ts_i % 13 = 0 THEN NULL ELSE ts_t - 1 END AS end_t, ts_t AS as_of_t FROM log),
edits AS (SELECT event_id AS seq, CASE WHEN (event_id * 7) % 3 = 0 THEN 'remove' ELSE 'add' END AS verb, 'db' || (user_id % 12) AS entry FROM events)
"""


def _decisions(on_failure: str) -> str:
    return f"""decided AS (
  SELECT *, CASE WHEN d = 'end' AND end_t IS NULL THEN 'now' ELSE d END AS decision
  FROM (SELECT *, CASE WHEN store_failed THEN '{on_failure}' WHEN stored_t > as_of_t - 120 THEN 'resume' ELSE 'end' END AS d FROM cases)),
decisions AS (SELECT case_id, stored_t, store_failed, end_t, as_of_t, CASE decision WHEN 'resume' THEN stored_t WHEN 'end' THEN end_t WHEN 'now' THEN as_of_t END AS start_t, decision FROM decided)"""


def _histogram(table: str, value: str, bounds: list[float], labels: list[str]) -> str:
    rows = ", ".join([f"({i}, '{metrics._text(b)}', {b}::DOUBLE)" for i, b in enumerate(bounds)] + [f"({len(bounds)}, '+Inf', 'infinity'::DOUBLE)"])
    k = ", ".join(labels)
    return f"SELECT {k}, le, count(*) FILTER ({value} <= bound)::BIGINT AS n FROM {table}, (VALUES {rows}) AS b(i, le, bound) GROUP BY {k}, i, le"


def _with(body: str, more: str = "") -> str:
    return f"WITH {BASE}{',' if more else ''}{more}\n{body}"


_DECISION = "SELECT * FROM decisions"
_FIELDS = "SELECT ts_i, tx_idx, array_to_string(list_sort(f), ',') AS fields, bad AS n_bad FROM ops WHERE kind = '{}'"
_FIELDS_DEEP = "array_to_string(list_sort(coalesce(f_deep, f)), ',')"
_POSITION = "(ts_t::HUGEINT * 4294967296 + ts_i)::VARCHAR"

SQL = {
    name: _with(body)
    for name, body in {
        "publications": "SELECT ns || '$' || ns || '::' || id_text AS channels, msg, ts_t, ts_i, tx_idx, parallelism_key FROM pubs",
        "scan_after_position": "SELECT ts_t, ts_i, op, ns FROM log WHERE (ts_t, ts_i) > (1704110400, 5000)",
        "latest_position": "SELECT ts_t, ts_i FROM log ORDER BY ts_t DESC, ts_i DESC LIMIT 1",
        "min_position": "SELECT m.ts_t AS ts_t, m.ts_i AS ts_i FROM (SELECT min(p) AS m, count(*) AS n FROM (SELECT shard, max({'ts_t': ts_t, 'ts_i': ts_i}) AS p FROM sharded GROUP BY shard)) WHERE n = 4",
        "premature_stop_streak": """SELECT run_id, started_t, stopped_t, streak, CASE WHEN streak >= 5 THEN 'error' ELSE 'warn' END AS level FROM (
          SELECT *, row_number() OVER (PARTITION BY part ORDER BY started_t, run_id)::INTEGER AS streak FROM (
            SELECT *, sum(CASE WHEN stopped_t - started_t >= 60 THEN 1 ELSE 0 END) OVER (ORDER BY started_t, run_id) AS part FROM (
              SELECT event_id AS run_id, event_id * 1000 AS started_t, event_id * 1000 + (event_id * 37) % 100 AS stopped_t FROM events WHERE event_type = 'error')))""",
        "decode_envelope": """SELECT ts_t, ts_i, ts_t AS wall_s, op, ns, true AS valid, octet_length(encode(o))::BIGINT AS o_bytes, octet_length(encode(o2))::BIGINT AS o2_bytes FROM log""",
        "publish_log": f"SELECT shard, ns || '$' || ns || '::' || id_text AS channels, msg, {_POSITION} AS position, tx_idx FROM sharded",
        "publish_status": "SELECT ts_t, ts_i, tx_idx, arrival_s, CASE WHEN published THEN 'published' ELSE 'duplicate' END AS status FROM status",
        "dedupe_first": "SELECT ts_t, ts_i, tx_idx, msg, instance, arrival_s FROM two WHERE instance = 1",
        "dedupe_ttl": "SELECT ts_t, ts_i, tx_idx, arrival_s, published FROM status",
        "ha_dedupe": "SELECT 1 AS instance, count(*) AS n, count(DISTINCT ts_i) AS n_entries FROM pubs",
        "fanout_destinations": "SELECT ts_i, tx_idx, msg, unnest(['a', 'b']) AS destination FROM pubs",
        "parse_sentinel_url": """SELECT event_id, 'redis-sentinel://' || CASE WHEN event_id % 3 = 0 THEN 'pw' || user_id || '@' ELSE '' END || ends || CASE WHEN event_id % 5 = 0 THEN '/' || (event_id % 16) ELSE '' END ||
            CASE WHEN event_id % 4 = 0 THEN '?sentinelMasterId=m' || (event_id % 9) ELSE '' END AS url, valid,
          CASE WHEN valid THEN CASE WHEN event_id % 3 = 0 THEN 'pw' || user_id ELSE '' END END AS password, CASE WHEN valid THEN ends END AS endpoints,
          CASE WHEN valid THEN CASE WHEN event_id % 5 = 0 THEN event_id % 16 ELSE 0 END END::BIGINT AS db, CASE WHEN valid THEN CASE WHEN event_id % 4 = 0 THEN 'm' || (event_id % 9) ELSE '' END END AS master
          FROM (SELECT *, event_id % 2 <> 0 OR event_id % 7 <> 0 AS valid, 'h' || user_id || ':' || (7000 + event_id % 100) || CASE WHEN event_id % 2 = 0 THEN ',g' || user_id || ':' || CASE WHEN event_id % 7 = 0 THEN 'x' ELSE '1' END ELSE '' END AS ends FROM events)""",
        "denylist_apply": """SELECT entry FROM (SELECT entry, arg_max(verb, seq) AS verb FROM edits GROUP BY entry) WHERE verb = 'add'
          UNION SELECT e FROM (VALUES ('db3'), ('db6')) AS d(e) WHERE e NOT IN (SELECT entry FROM edits)""",
        "denylist_state": "SELECT entry, arg_max(CASE WHEN verb = 'add' THEN 1 ELSE 0 END, seq) AS enabled FROM edits GROUP BY entry",
        "denylist_filter": "SELECT ts_t, ts_i, op, ns, split_part(ns, '.', 1) AS db, substr(ns, strpos(ns, '.') + 1) AS coll FROM log WHERE ns = 'admin.$cmd' OR split_part(ns, '.', 1) NOT IN ('db3', 'db6')",
        "filter_crud_ops": "SELECT ts_i, op, ns FROM log WHERE op IN ('i', 'u', 'd') OR ns = 'admin.$cmd'",
        "filter_commands": "SELECT ts_i, op, ns FROM log WHERE op = 'c' AND ns = 'admin.$cmd'",
        "flatten_transaction": "SELECT ts_t, ts_i, tx_idx, op, ns, o, o2 FROM ops",
        "flatten_nested": "SELECT ts_t, ts_i, 1::INTEGER AS tx_idx, op, ns, o FROM parts WHERE part = 'nested'",
        "tx_index": "SELECT ts_i, count(*) AS n_ops, max(tx_idx) AS last_tx_idx, sum(tx_idx)::BIGINT AS sum_tx_idx FROM ops GROUP BY ts_i",
        "doc_id": "SELECT ts_i, tx_idx, op, id_kind, id_text, id AS id_value FROM ops",
        "filter_system": "SELECT ts_i, ns FROM log WHERE op = 'c' OR NOT starts_with(coll, 'system.')",
        "filter_config": "SELECT ts_i, ns FROM log WHERE ns = 'admin.$cmd' OR db <> 'config'",
        "id_typing": "SELECT op, id_kind, count(*) AS n, count(id_text) AS n_publishable FROM ops GROUP BY ALL",
        "dead_letters": "SELECT ts_t, ts_i, tx_idx, op, ns, id AS id_value, 'unsupported document _id type' AS error FROM proc WHERE failed",
        "event_name": "SELECT CASE op WHEN 'd' THEN 'r' ELSE op END AS event, count(*) AS n FROM ops GROUP BY ALL",
        "classify_ops": "SELECT ts_i, op = 'i' AS is_insert, op = 'u' AS is_update, op = 'd' AS is_remove FROM log",
        "update_kind": "SELECT ts_i, tx_idx, kind FROM ops WHERE op = 'u'",
        "shard_filter": "SELECT ts_i, tx_idx, parallelism_key FROM sharded WHERE shard = 1",
        "changed_fields_insert": "SELECT ts_i, '_id,user,k,props' AS fields FROM log WHERE op = 'i'",
        "changed_fields": "SELECT ts_i, tx_idx, op, array_to_string(list_sort(f), ',') AS fields, bad AS n_bad FROM pubs",
        "changed_fields_deep": f"SELECT ts_i, tx_idx, op, {_FIELDS_DEEP} AS fields, 2 * bad AS n_bad FROM pubs",
        "changed_fields_v1": _FIELDS.format("v1"),
        "changed_fields_v2_shallow": _FIELDS.format("v2"),
        "changed_fields_v2_deep": f"SELECT ts_i, tx_idx, {_FIELDS_DEEP} AS fields, 2 * bad AS n_bad FROM ops WHERE kind = 'v2'",
        "is_array_operator": "SELECT ts_i, tx_idx, part = 'own' AND k % 4 = 2 AS is_array_operator FROM ops WHERE kind = 'v2'",
        "message_json": "SELECT ts_i, tx_idx, msg FROM pubs",
        "channels": "SELECT ts_i, tx_idx, ns AS collection_channel, ns || '::' || id_text AS document_channel FROM pubs",
        "channel_explode": "SELECT ts_i, tx_idx, unnest([ns, ns || '::' || id_text]) AS channel FROM pubs",
        "ts_encode": f"SELECT ts_t, ts_i, {_POSITION} AS position FROM log",
        "ts_decode": f"SELECT CASE WHEN ts_i % 17 = 0 THEN 'x' || ts_i ELSE {_POSITION} END AS position, CASE WHEN ts_i % 17 <> 0 THEN ts_t END AS ts_t, CASE WHEN ts_i % 17 <> 0 THEN ts_i END AS ts_i FROM log",
        "dedupe_key": f"SELECT ts_i, tx_idx, 'rivulet::processed::' || {_POSITION} || '::' || tx_idx AS key FROM pubs",
        "staleness": "SELECT ts_i, greatest(ts_i % 7 - 3, 0)::DOUBLE AS staleness_s FROM log",
        "log_projection": "SELECT ts_t, ts_i, op, ns FROM log",
        "parse_namespace": "SELECT ns, split_part(ns, '.', 1) AS db, substr(ns, strpos(ns, '.') + 1) AS coll, count(*) AS n FROM log GROUP BY ALL",
        "entries_received": "SELECT database, status, count(*) AS n FROM entries GROUP BY ALL",
        "entries_size": "SELECT database, sum(size)::BIGINT AS bytes FROM entries GROUP BY ALL",
        "size_histogram": _histogram("entries", "size", metrics.SIZE_BOUNDS, ["database", "status"]),
        "filtered_count": """SELECT db, count(*) AS n FROM (
          SELECT split_part(ns, '.', 1) AS db FROM log WHERE ns <> 'admin.$cmd' UNION ALL SELECT db FROM parts WHERE part <> 'own') WHERE db IN ('db3', 'db6') GROUP BY ALL""",
        "interval_max": "SELECT database, status, ts_t // 60 * 60 AS window_start_s, ts_t // 60 * 60 + 60 AS visible_from_s, max(size) AS max_size FROM entries GROUP BY ALL",
        "interval_max_report": "SELECT database, status, max(size) AS max_size FROM entries WHERE ts_t // 3600 = (SELECT max(ts_t) // 3600 - 1 FROM entries) GROUP BY ALL",
        "last_staleness": "SELECT shard AS ordinal, arg_max(ts_i % 7, {'a': ts_t, 'b': ts_i, 'c': tx_idx})::DOUBLE AS staleness_s FROM sharded GROUP BY ALL",
        "pre_retry_staleness": "SELECT ordinal, batch, (ts_i % 7)::DOUBLE AS staleness_s FROM batched WHERE r % 25 = 0",
        "unprocessable_count": "SELECT sum(bad)::BIGINT AS n FROM proc",
        "unprocessable_count_deep": "SELECT sum(2 * bad)::BIGINT AS n FROM proc",
        "processed_messages": "SELECT status, sum(size)::BIGINT AS n FROM sent GROUP BY ALL",
        "batch_assign": "SELECT shard, ts_i, tx_idx, (row_number() OVER (PARTITION BY shard ORDER BY ts_t, ts_i, tx_idx) - 1) // 25 AS batch FROM sharded",
        "batch_size_histogram": _histogram("sent", "size", metrics.BATCH_BOUNDS, ["ordinal", "status"]),
        "last_entry_staleness": """SELECT shard AS ordinal, CASE WHEN published THEN 'published' ELSE 'duplicate' END AS status,
          arg_max(greatest(arrival_s - ts_t, 0), {'a': ts_t, 'b': ts_i, 'c': tx_idx, 'd': arrival_s}) AS staleness_s FROM status GROUP BY ALL""",
        "staleness_histogram": _histogram("(SELECT shard AS ordinal, CASE WHEN published THEN 'published' ELSE 'duplicate' END AS status, greatest(arrival_s - ts_t, 0) AS s FROM status)", "s", metrics.STALENESS_BOUNDS, ["ordinal", "status"]),
        "oldest_pending_age": """SELECT ordinal, client_index, coalesce((SELECT max(ts_t) FROM log) - min(CASE WHEN (s.ts_t, s.ts_i) > (p.t, p.i) THEN s.ts_t END), 0)::BIGINT AS age_s
          FROM (SELECT shard AS ordinal, CASE op WHEN 'i' THEN 0 ELSE 1 END::INTEGER AS client_index, max(ts_t) AS t, arg_max(ts_i, {'a': ts_t, 'b': ts_i}) AS i FROM sharded WHERE op IN ('i', 'd') GROUP BY ALL) p
          JOIN sharded s ON s.shard = p.ordinal GROUP BY ordinal, client_index""",
        "ordered_per_db": "SELECT parallelism_key, ts_i, tx_idx, row_number() OVER (PARTITION BY parallelism_key ORDER BY ts_t, ts_i, tx_idx)::INTEGER AS place FROM pubs",
        "shard_route": "SELECT shard, count(*) AS n, count(DISTINCT parallelism_key) AS n_databases FROM sharded GROUP BY ALL",
    }.items()
} | {
    "resume_decision": _with(_DECISION, _decisions("fail")),
    "resume_decision_from_end": _with(_DECISION, _decisions("end")),
    "resume_gap_histogram": _with(
        _histogram("(SELECT CASE WHEN store_failed THEN 0 ELSE as_of_t - stored_t END AS gap, CASE WHEN decision = 'resume' THEN 'success' ELSE 'failed' END AS status FROM decisions WHERE store_failed OR stored_t IS NOT NULL)", "gap", metrics.GAP_BOUNDS, ["status"]),
        _decisions("fail"),
    ),
}

_KEY = """list_reduce(list_prepend(0::HUGEINT, list_transform(range(8), lambda i: ('0x' || sha256(db)[49 + 2 * i:50 + 2 * i])::HUGEINT * (256::HUGEINT ** i)::HUGEINT)), lambda a, b: a + b)"""
_KEYS = f"""keys AS (SELECT ns, (CASE WHEN v >= 9223372036854775808 THEN v - 18446744073709551616 ELSE v END)::BIGINT AS parallelism_key
  FROM (SELECT ns, {_KEY} AS v FROM (SELECT ns, split_part(ns, '.', 1) AS db FROM log)))"""
SQL["parallelism_key"] = _with("SELECT DISTINCT ns, parallelism_key FROM keys", _KEYS)
SQL["shard_assign"] = _with("SELECT (((parallelism_key % 4) + 4) % 4)::INTEGER AS shard, count(*) AS n FROM keys GROUP BY ALL", _KEYS)
