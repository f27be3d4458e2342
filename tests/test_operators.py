import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from rivulet.config import Config, seconds
from rivulet.operators import decode, dedupe, denylist, filters, flatten, metrics, publish, resume, scan
from rivulet.schema import DENYLIST, ENTRY

KEY = -5843589418109203719
WALL = datetime(2024, 1, 1, tzinfo=timezone.utc).replace(tzinfo=None)


def log_of(spark, *entries):
    return spark.createDataFrame([(t, i, WALL, op, ns, json.dumps(o, separators=(",", ":")) if o is not None else None, json.dumps(o2) if o2 is not None else None) for t, i, op, ns, o, o2 in entries], ENTRY)


def one(spark, op, ns, o, o2=None, deep=False):
    return publish.from_log(log_of(spark, (1234, 0, op, ns, o, o2)), None, deep).collect()


ID = {"_id": "someid"}


@pytest.mark.parametrize(
    "op, o, o2, event, fields",
    [
        ("i", {"_id": "someid", "some": "field"}, None, "i", ["_id", "some"]),
        ("u", {"_id": "someid", "some": 1, "new": 2}, ID, "u", ["_id", "new", "some"]),
        ("u", {"$v": "1.2.3", "$set": {"a": 1, "b": 2}, "$unset": {"c": 1}}, ID, "u", ["a", "b", "c"]),
        ("d", ID, None, "r", []),
    ],
)
def test_publications(spark, op, o, o2, event, fields):
    (r,) = one(spark, op, "foo.bar", o, o2)
    m = json.loads(r.msg)
    assert r.channels == ["foo.bar", "foo.bar::someid"] and r.parallelism_key == KEY and (r.ts_t, r.ts_i, r.tx_idx) == (1234, 0, 0)
    assert list(m) == ["e", "d", "f"] and (m["e"], m["d"], sorted(m["f"])) == (event, {"_id": "someid"}, fields)


def test_object_ids_errors_and_silence(spark):
    (r,) = one(spark, "i", "foo.bar", {"_id": {"$oid": "deadbeefdeadbeefdeadbeef"}})
    assert json.loads(r.msg)["d"]["_id"] == {"$type": "oid", "$value": "deadbeefdeadbeefdeadbeef"} and r.channels[1] == "foo.bar::deadbeefdeadbeefdeadbeef"
    for bad in (1234, None, {"x": 1}, ["a"], True):
        (r,) = one(spark, "i", "foo.bar", {"_id": bad})
        assert r.error == "unsupported document _id type" and r.msg is None
    assert one(spark, "i", "foo.system.indexes", {"_id": 5}) == [] == one(spark, "i", "config.transactions", {"_id": {"a": 1}})
    assert one(spark, "i", "foo.bar", {"x": 1}) == [] == one(spark, "n", "foo.bar", {"_id": "a"}) == one(spark, "u", "foo.bar", {"$set": {}}, None)


def test_message_escapes(spark):
    (r,) = one(spark, "d", "foo.bar", {"_id": "<a&b> "})
    assert r.msg == '{"e":"r","d":{"_id":"\\u003ca\\u0026b\\u003e\\u2028"},"f":[]}'


def op(kind, id_, ns="test.Tx"):
    return {"op": kind, "ns": ns, "o": {"_id": id_} if kind != "u" else {"$set": {"a": 1}}, **({"o2": {"_id": id_}} if kind == "u" else {})}


def tx(*ops, ns="admin.$cmd"):
    return {"op": "c", "ns": ns, "o": {"applyOps": list(ops)}}


def test_transactions(spark):
    log = log_of(
        spark,
        (1234, 0, "c", "admin.$cmd", {"applyOps": [tx(op("i", "id1")), op("i", "id1"), op("u", "id2"), op("d", "id3")]}, None),
        (1235, 0, "c", "foo.$cmd", {"drop": "x"}, None),
        (1236, 0, "c", "admin.$cmd", {"applyOps": "x"}, None),
        (1237, 0, "c", "admin.$cmd", {"drop": "x"}, None),
        (1238, 0, "c", "admin.$cmd", {"applyOps": [1, op("n", "z"), {"op": "i", "ns": "test.Tx", "o": {"x": 1}}, op("i", "b")]}, None),
    )
    got = [(r.ts_t, r.tx_idx, r.op, r.wall) for r in flatten.flatten(log).orderBy("ts_t", "tx_idx").collect()]
    assert got == [(1234, 0, "i", WALL), (1234, 1, "i", WALL), (1234, 2, "u", WALL), (1234, 3, "d", WALL), (1238, 0, "i", WALL), (1238, 1, "i", WALL)]
    ids = [(r.ts_t, r.tx_idx, r.id_text) for r in filters.with_doc_id(flatten.flatten(log)).orderBy("ts_t", "tx_idx").collect()]
    assert ids == [(1234, 0, "id1"), (1234, 1, "id1"), (1234, 2, "id2"), (1234, 3, "id3"), (1238, 1, "b")]  # an operation without _id has taken number 0
    assert filters.transactions(log).count() == 2


def test_denied_inner_operations_take_no_number_and_deep_ones_are_told_of(spark):
    deny = spark.createDataFrame([("no",)], DENYLIST)
    deep = op("i", "x")
    for _ in range(5):
        deep = tx(deep)
    log = log_of(spark, (1, 1, "c", "admin.$cmd", {"applyOps": [op("i", "a", "no.x"), op("i", "b", "yes.x"), op("i", "c", "config.x"), op("i", "d", "yes.x")]}, None), (2, 1, "c", "admin.$cmd", {"applyOps": [deep]}, None), (3, 1, "i", "no.x", {"_id": "e"}, None), (4, 1, "i", "", {"_id": "f"}, None))
    p = publish.from_log(log, deny)
    assert [(r.ts_t, r.tx_idx) for r in p.where("error is null").orderBy("ts_t", "tx_idx").collect()] == [(1, 0), (1, 2), (4, 0)]
    assert [(r.ts_t, r.error) for r in publish.dead_letters(p).collect()] == [(2, "transactions nested too deep")]
    assert [(r.ts_t, r.db) for r in flatten.filtered(log, deny).orderBy("ts_t").collect()] == [(1, "no"), (3, "no")]  # inner operations count too


def test_decode_envelope(spark):
    good = '{"ts":{"t":4294967295,"i":1},"wall":"2024-01-01T00:00:00Z","op":"i","ns":"a.b","o":{"b":1,"a":2}}'
    bad = ['{"ts":5}', '{"ts":{"t":-1,"i":0}}', '{"wall":5}', '{"wall":"x"}', '{"op":1}', '{"ns":{}}', '{"o":"x"}', '{"o2":[1]}', "nope", "", None, "[1]"]
    rows = decode.decode_envelope(spark.createDataFrame([(x,) for x in [good, "{}", *bad]], "raw string")).collect()
    assert [r.valid for r in rows] == [True, True] + [False] * len(bad)
    assert (rows[0].ts_t, rows[0].ts_i, rows[0].wall, rows[0].op, rows[0].ns, rows[0].o, rows[0].o2) == (4294967295, 1, WALL, "i", "a.b", '{"b":1,"a":2}', None)


def test_scan(spark):
    log = log_of(spark, (1, 5, "i", "a.b", {}, None), (2, 1, "i", "a.b", {}, None), (2, 2, "i", "a.b", {}, None))
    assert [(r.ts_t, r.ts_i) for r in scan.after_position(log, 2, 1).collect()] == [(2, 2)]
    assert scan.latest_position(log).first() == (2, 2) and scan.latest_position(log.limit(0)).first() == (None, None)
    p = spark.createDataFrame([(0, 5, 1), (1, 4, 9)], "ordinal int, ts_t long, ts_i long")
    assert scan.min_position(p, 2).first() == (4, 9) and scan.min_position(p, 3).first() == (None, None)


def test_resume_cases(spark):
    now = 1000
    cases = [(970, False, None, now, "resume", 970), (880, False, 970, now, "end", 970), (0, False, 880, now, "end", 880), (0, False, None, now, "now", now), (None, False, 5, now, "end", 5), (970, True, 5, now, "fail", None), (940, False, 7, now, "end", 7)]
    df = spark.createDataFrame([c[:4] for c in cases], "stored_t long, store_failed boolean, end_t long, as_of_t long")
    got = [(r.decision, r.start_t) for r in resume.resume_decisions(df, 60).collect()]
    assert got == [c[4:] for c in cases]
    assert resume.resume_decisions(df.limit(6), 60, True).collect()[5].decision == "end"


def test_start_position():
    calls, slept = [], []

    def failing(n, value):
        def read():
            calls.append(1)
            if len(calls) <= n:
                raise OSError("down")
            return value

        return read

    assert resume.start_position(failing(3, (970, 0)), lambda: (1, 1), 1000, 60, sleep=slept.append) == ((970, 0), None)
    assert slept == [0.0, 0.5, 1.0]
    calls.clear()
    with pytest.raises(OSError):
        resume.start_position(failing(9, None), lambda: (1, 1), 1000, 60, sleep=lambda s: None)
    calls.clear()
    assert resume.start_position(failing(9, None), lambda: (880, 1), 1000, 60, from_end_on_failure=True, sleep=lambda s: None) == ((880, 1), None)
    assert resume.start_position(lambda: None, lambda: (5, 0), 1000) == ((5, 0), None)

    def broken():
        raise OSError("no log")

    at, e = resume.start_position(lambda: (0, 0), broken, 1000)
    assert at == (1000, 0) and isinstance(e, OSError)


def test_gaps(spark):
    df = spark.createDataFrame([(970, False, 5, 1000), (880, False, 5, 1000), (None, False, 5, 1000), (970, True, 5, 1000), (None, True, 5, 1000)], "stored_t long, store_failed boolean, end_t long, as_of_t long")
    assert sorted(tuple(r) for r in resume.gaps(resume.resume_decisions(df, 60)).collect()) == [("failed", 0), ("failed", 0), ("failed", 120), ("success", 30)]
    seen = []
    resume.start_position(lambda: (970, 0), lambda: (1, 1), 1000.7, 60, observe=lambda *x: seen.append(x))
    resume.start_position(lambda: (880, 0), lambda: (1, 1), 1000, 60, observe=lambda *x: seen.append(x))
    resume.start_position(lambda: None, lambda: (1, 1), 1000, 60, observe=lambda *x: seen.append(x))
    assert seen == [("success", 30), ("failed", 120)]


def test_entry_metrics(spark):
    """Status and database of an entry without its operations being brought together again; entries of equal position stay two."""
    bad = {"op": "i", "ns": "q.x", "o": {"_id": 5}}
    log = log_of(
        spark,
        (1, 1, "i", "a.b", {"_id": "x"}, None), (1, 1, "i", "b.b", {"_id": "y"}, None), (2, 1, "i", "a.b", {"_id": 5}, None), (3, 1, "i", "a.system.x", {"_id": "x"}, None),
        (4, 1, "c", "admin.$cmd", {"applyOps": [{"op": "i", "ns": "noid.x", "o": {"z": 1}}, bad, op("d", "k", "r.x")]}, None), (5, 1, "i", "", {"_id": "x"}, None),
    ).withColumn("size", F.lit(7).cast("long"))
    got = sorted((r.ts_t, r.database, r.status) for r in metrics.entry_metrics(log).collect())
    assert got == [(1, "a", "processed"), (1, "b", "processed"), (4, "q", "error"), (5, "(no database)", "processed")]
    assert "Exchange" not in metrics.entry_metrics(log)._jdf.queryExecution().executedPlan().toString()


def test_oldest_pending(spark):
    pubs = spark.createDataFrame([(0, 5, 1), (0, 7, 1), (1, 4, 1)], "shard int, ts_t long, ts_i long")
    at = spark.createDataFrame([(0, 0, 5, 1), (0, 1, 9, 0), (1, 0, 4, 0), (1, 1, 4, 1)], "ordinal int, client_index int, ts_t long, ts_i long")
    assert sorted(tuple(r) for r in metrics.oldest_pending(pubs, at, F.lit(10)).collect()) == [(0, 0, 3), (0, 1, 0), (1, 0, 6), (1, 1, 0)]


def test_streak(spark):
    s = resume.Streak()
    assert [s.stopped(x) for x in (1, 1, 1, 1, 1, 60, 2)] == [(1, "warn"), (2, "warn"), (3, "warn"), (4, "warn"), (5, "error"), (1, "warn"), (2, "warn")]
    df = spark.createDataFrame([(i, 100 * i, 100 * i + d) for i, d in enumerate((1, 1, 1, 1, 1, 60, 2))], "run_id long, started_t long, stopped_t long")
    assert [(r.streak, r.level) for r in resume.streaks(df).orderBy("run_id").collect()] == [(1, "warn"), (2, "warn"), (3, "warn"), (4, "warn"), (5, "error"), (1, "warn"), (2, "warn")]


def test_dedupe(spark):
    rows = [(1, 1, 0, a) for a in (0, 100, 149, 150, 299, 301)] + [(1, 1, 1, 5)]
    df = spark.createDataFrame(rows, "ts_t long, ts_i long, tx_idx int, arrival_s long")
    got = {(r.tx_idx, r.arrival_s): r.published for r in dedupe.with_ttl(df, 150).collect()}
    assert got == {(0, 0): True, (0, 100): False, (0, 149): False, (0, 150): True, (0, 299): False, (0, 301): True, (1, 5): True}
    assert sorted((r.tx_idx, r.arrival_s) for r in dedupe.first_only(df, "arrival_s").collect()) == [(0, 0), (1, 5)]


def test_ttl_of_a_key_with_many_copies(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(1000).selectExpr("1L as ts_t", "1L as ts_i", "id % 2 as tx_idx", "id as arrival_s", "'d' as db").unionByName(spark.sql("select 1L as ts_t, 1L as ts_i, 0L as tx_idx, null as arrival_s, 'd' as db"))
        got = dedupe.with_ttl(df, 150, carry=["db"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 1000 and {r.db for r in got} == {"d"}
    assert sorted((r.tx_idx, r.arrival_s) for r in got if r.published) == [(k, 150 * i + k) for k in (0, 1) for i in range(7)]


def test_histogram_and_interval(spark):
    df = spark.createDataFrame([("a", 0), ("a", 8), ("a", 9), ("a", 10**12), ("b", 5)], "k string, v long")
    got = {(r.k, r.le): r.n for r in metrics.histogram(df, "v", metrics.SIZE_BOUNDS, ["k"]).collect()}
    assert len(got) == 2 * 31 and (got["a", "0"], got["a", "8"], got["a", "16"], got["a", str(8 * 2**28)], got["a", "+Inf"], got["b", "8"]) == (1, 2, 3, 3, 4, 1)


def test_interval_max(spark):
    """What a reader sees is the maximum of the interval before, and nothing if that had no value."""
    at = lambda s: datetime.fromtimestamp(s, timezone.utc).replace(tzinfo=None)
    df = spark.createDataFrame([("a", at(5), 7), ("a", at(59), -3), ("a", at(130), -8), ("b", at(70), 1), ("a", at(190), 0)], "k string, t timestamp, v long")
    maxima = metrics.interval_max(df, "t", "v", ["k"])
    seen = {s: {r.k: r["value"] for r in metrics.interval_report(maxima, F.lit(at(s)), ["k"]).collect()} for s in (30, 61, 125, 185, 240, 300)}
    assert seen == {30: {}, 61: {"a": 7}, 125: {"b": 1}, 185: {"a": -8}, 240: {"a": 0}, 300: {}}


def test_denylist(spark, tmp_path):
    d = denylist.Denylist(spark, str(tmp_path / "deny"))
    assert d.handle("GET", "/denylist") == (200, []) and d.handle("PUT", "/denylist/abc")[0] == 201 and d.handle("PUT", "/denylist/abc")[0] == 204
    assert d.handle("GET", "/denylist/abc")[0] == 200 and d.handle("GET", "/denylist/def")[0] == 404 and d.handle("PUT", "/denylist/a/b")[0] == 404 and d.handle("POST", "/denylist/a")[0] == 404
    assert denylist.Denylist(spark, str(tmp_path / "deny")).list() == ["abc"]
    assert d.handle("DELETE", "/denylist/abc")[0] == 204 == d.handle("DELETE", "/denylist/abc")[0] and d.list() == []


def test_config():
    c = Config.from_env({"RIVULET_LOG_URL": "x", "RIVULET_SINK_URL": "a,b", "RIVULET_MAX_CATCH_UP": "1m30s", "RIVULET_EXTRACT_SUBFIELD_CHANGES": "true"})
    assert (c.max_catch_up, c.dedupe_expiration, c.batch_size, c.extract_subfield_changes, c.destinations) == (90.0, 150.0, 1, True, ["a", "b"])
    with pytest.raises(ValueError):
        Config.from_env({})
    with pytest.raises(ValueError):
        seconds("soon")
    assert seconds("500ms") == 0.5


def test_ordering_and_batches(spark):
    df = spark.createDataFrame([(i % 3, 1, i, 0, 0) for i in range(60)], "parallelism_key long, ts_t long, ts_i long, tx_idx int, shard int").orderBy(F.rand(1))
    for part in publish.ordered_per_db(df, 4).select(F.spark_partition_id().alias("p"), "ts_i", "parallelism_key").toPandas().groupby("p"):
        for _, x in part[1].groupby("parallelism_key"):
            assert x.ts_i.is_monotonic_increasing
    assert [r["count"] for r in publish.batches(df, 25).groupBy("batch").count().orderBy("batch").collect()] == [25, 25, 10]
