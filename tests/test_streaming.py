import json
import urllib.error
import urllib.request
from datetime import datetime, timezone

import pytest

from rivulet.config import Config
from rivulet.operators import dedupe, denylist, resume
from rivulet.schema import ENTRY
from rivulet.sources import changelog
from rivulet.sources.versions import Versions
from rivulet.streaming import metrics, runner, sinks, state

SF = "/root/testdata/sf0.001"
NOW = 2_000_000_000


def write_log(spark, path, lo, hi):
    changelog.derived_log(spark, SF).drop("raw").where(f"ts_i >= {lo} and ts_i < {hi}").coalesce(1).write.mode("append").parquet(path)


def write_entries(spark, path, *entries):
    """entries: (seconds, id or (id, database))."""
    rows = []
    for t, x in entries:
        name, db = x if isinstance(x, tuple) else (x, "tests")
        wall = datetime.fromtimestamp(t, timezone.utc).replace(tzinfo=None)
        rows.append((t, 1, wall, "i", f"{db}.Foo", json.dumps({"_id": name, "f": 1}), None))
    spark.createDataFrame(rows, ENTRY).coalesce(1).write.mode("append").parquet(path)


def ids(spark, path):
    try:
        return sorted(json.loads(r.msg)["d"]["_id"] for r in spark.read.parquet(path).select("msg").collect())
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return []
        raise


def run(spark, config, folder, **more):
    q = runner.start(spark, config, str(folder / "checkpoint"), available_now=True, sleep=lambda s: None, **more)
    q.awaitTermination()


def test_restart_publishes_each_change_once(spark, tmp_path):
    log, out = str(tmp_path / "log"), {n: str(tmp_path / n) for n in "ab"}
    c = Config(log_url=log, sink_url=",".join(out.values()), max_catch_up=1e10)
    sinks.Positions(Versions(spark, str(tmp_path / "checkpoint/positions")), 1).advance({0: (1, 0)})
    write_log(spark, log, 0, 300)
    run(spark, c, tmp_path)
    first = spark.read.parquet(out["a"]).count()
    write_log(spark, log, 300, 600)
    run(spark, c, tmp_path)
    want = runner.publication_stream(spark.read.schema(ENTRY).parquet(log), None, c)
    for path in out.values():
        got = spark.read.parquet(path)
        assert got.count() == want.count() > first > 0
        assert got.select(*dedupe.KEY).distinct().count() == got.count()


def test_resume(spark, tmp_path):
    """From the log's end without a position, from the position while it is young, from the end again when it is old."""
    log, out, at = str(tmp_path / "log"), str(tmp_path / "out"), [NOW]
    c, m = Config(log_url=log, sink_url=out, max_catch_up=8.0, timestamp_flush_interval=0.0), metrics.Metrics()
    again = lambda: run(spark, c, tmp_path, now=lambda: at[0], metrics=m)
    write_entries(spark, log, (NOW - 9, "id1"), (NOW - 8, "id2"), (NOW - 7, "id3"))
    again()
    assert ids(spark, out) == []
    write_entries(spark, log, (NOW, "id4"))
    # the end of the log was id3 when the service began; what a stream of files shows later is new to it
    positions = sinks.Positions(Versions(spark, str(tmp_path / "checkpoint/positions")), 1, 0.0)
    positions.advance({0: (NOW - 7, 1)})
    again()
    assert ids(spark, out) == ["id4"] and positions.first() == (NOW, 1) == positions.get(0)
    write_entries(spark, log, (NOW + 1, "id5"))
    at[0] = NOW + 2
    write_entries(spark, log, (NOW + 2, "id6"))
    again()
    assert ids(spark, out) == ["id4", "id5", "id6"]
    write_entries(spark, log, (NOW + 3, "id7"))
    at[0] = NOW + 12
    again()
    assert ids(spark, out) == ["id4", "id5", "id6"]
    write_entries(spark, log, (NOW + 12, "id8"))
    positions.advance({0: (NOW + 11, 1)})
    again()
    assert ids(spark, out) == ["id4", "id5", "id6", "id8"]
    assert (m.count("resume_gap_seconds", status="success"), m.count("resume_gap_seconds", status="failed")) == (3, 1)


def test_late_entries_are_published(spark, tmp_path):
    """An entry whose wall time is an hour behind the newest is as good as any."""
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    c = Config(log_url=log, sink_url=out, max_catch_up=1e10)
    write_entries(spark, log, (NOW - 9000, "first"))
    run(spark, c, tmp_path)
    sinks.Positions(Versions(spark, str(tmp_path / "checkpoint/positions")), 1, 0.0).advance({0: (NOW - 9000, 1)})
    write_entries(spark, log, (NOW, "new"))
    run(spark, c, tmp_path)
    sinks.Positions(Versions(spark, str(tmp_path / "checkpoint/positions")), 1, 0.0).advance({0: (NOW - 9000, 1)})
    write_entries(spark, log, (NOW - 3600, "late"), (NOW - 200, "later"))
    run(spark, c, tmp_path)
    assert ids(spark, out) == ["late", "later", "new"]


def test_denylist_edit_under_a_running_query(spark, tmp_path):
    """An edit counts from the next micro-batch on and stops nothing, whoever makes it."""
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    c = Config(log_url=log, sink_url=out, denylist_url=str(tmp_path / "deny"), max_catch_up=1e10, timestamp_flush_interval=0.2)
    write_entries(spark, log, (NOW, "id0"))
    q = runner.start(spark, c, str(tmp_path / "checkpoint"))
    edits = denylist.Denylist(spark, c.denylist_url)  # another service's
    try:
        q.processAllAvailable()
        write_entries(spark, log, (NOW + 1, "id1"))
        q.processAllAvailable()
        assert edits.handle("PUT", "/denylist/tests")[0] == 201
        write_entries(spark, log, (NOW + 2, "id2"), (NOW + 2, ("other", "elsewhere")))
        q.processAllAvailable()
        assert edits.handle("DELETE", "/denylist/tests")[0] == 204
        write_entries(spark, log, (NOW + 3, "id3"))
        q.processAllAvailable()
        assert q.isActive and q.exception() is None and ids(spark, out) == ["id1", "id3", "other"]
    finally:
        q.stop()


def test_seen_keys_expire(spark, tmp_path):
    now = [1000.0]
    s = state.Seen(spark, str(tmp_path / "seen"), 150, lambda: now[0])
    pubs = spark.createDataFrame([(1, 1, 0, "a"), (1, 1, 0, "a"), (1, 2, 0, "b")], "ts_t long, ts_i long, tx_idx int, msg string")
    assert s.fresh(pubs).count() == 2
    s.remember(s.fresh(pubs), 0)
    now[0] = 1149.0
    more = pubs.unionByName(spark.createDataFrame([(1, 3, 0, "c")], pubs.schema))
    assert [r.msg for r in s.fresh(more).collect()] == ["c"]
    now[0] = 1150.0
    assert s.fresh(more).count() == 3


def test_two_instances_publish_once(spark, tmp_path):
    """The same as an operator of a streaming plan."""
    log = str(tmp_path / "log")
    for _ in range(2):
        write_log(spark, log, 0, 200)
    entries = changelog.stream_log(spark, log)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    w = runner.publication_stream(entries, None, Config(), "ttl").writeStream.format("memory").queryName("once").outputMode("append").option("checkpointLocation", str(tmp_path / "c"))
    q = w.trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(90)
        got = spark.table("once")
        want = runner.publication_stream(spark.read.schema(ENTRY).parquet(log))
        assert want.count() == 2 * got.count() == 2 * got.select(*dedupe.KEY).distinct().count()
    finally:
        q.stop()


def test_raw_lines_stream(spark, tmp_path):
    log = str(tmp_path / "raw")
    changelog.derived_log(spark, SF).select("raw").limit(50).coalesce(1).write.text(log)
    q = runner.publication_stream(changelog.stream_log(spark, log, "json"), None, Config(extract_subfield_changes=True)).writeStream.format("memory").queryName("raw_lines").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        assert spark.table("raw_lines").count() > 30
    finally:
        q.stop()


def test_retries(spark):
    batch, calls, slept = spark.range(1), [], []

    def failing(n):
        def send(_):
            calls.append(1)
            if len(calls) <= n:
                raise OSError("down")

        return send

    assert sinks.publish_with_retries(failing(0), batch, sleep=slept.append) == 0 and len(calls) == 1
    calls.clear()
    assert sinks.publish_with_retries(failing(29), batch, sleep=slept.append) == 29 and slept == [1.0] * 29
    calls.clear()
    with pytest.raises(sinks.PermanentFailure, match="after 30 tries"):
        sinks.publish_with_retries(failing(30), batch, sleep=lambda s: None)
    calls.clear()
    assert sinks.publish_with_retries(failing(0), spark.range(0), sleep=slept.append) == 0 and not calls
    sent, m = [], metrics.Metrics()
    send = sinks.fan_out_sink({"bad": lambda b, i: failing(99)(b), "good": lambda b, i: sent.append(b.count())}, drop_after_retries=True, retries=2, sleep=lambda s: None, metrics=m)
    send(spark.range(3), 0)
    assert sent == [3]
    assert (m.get("temporary_send_failures"), m.get("processed_messages", status="failed"), m.get("processed_messages", status="sent")) == (6, 3, 3)


def test_client_sink(spark, tmp_path):
    """Runs of one shard, in order, of at most the batch size, with sizes and durations by shard."""
    folder, m = str(tmp_path), metrics.Metrics()

    def connect():
        import os
        import uuid

        def send(rows):
            with open(os.path.join(folder, f"{uuid.uuid4().hex}.json"), "w") as f:
                json.dump([(r["shard"], r["id"]) for r in rows], f)

        return send

    df = spark.range(60).selectExpr("id", "cast(id % 2 as int) as shard").repartition(2, "shard").sortWithinPartitions("shard", "id")
    sinks.client_sink(connect, 25, m)(df, 0)
    runs = [json.loads(p.read_text()) for p in tmp_path.glob("*.json")]
    assert sorted(len(r) for r in runs) == [5, 5, 25, 25] and all(len({s for s, _ in r}) == 1 and [i for _, i in r] == sorted(i for _, i in r) for r in runs)
    assert all(m.count("batch_size", ordinal=i, status="sent") == 2 == m.count("command_duration_seconds", ordinal=i) for i in (0, 1))


def test_position_flush():
    now, out = [0.0], []
    p = sinks.PositionStore(out.append, 1.0, lambda: now[0])
    for t, x in ((0.0, 1), (0.75, 2), (1.25, 3), (1.75, 4)):
        now[0] = t
        p.advance((x, 0))
    assert [x for x, _ in out] == [1, 3]
    now[0] = 3.75
    p.tick()
    assert [x for x, _ in out] == [1, 3, 4]


def test_versions(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "v"))
    assert v.get() is None
    for i in range(20):
        v.put(f"é{i}")
    assert v.get() == "é19" and len(v.numbers()) <= 9
    p = sinks.Positions(v.__class__(spark, str(tmp_path / "p")), 2, 0.0)
    p.advance({1: (5, 6)})
    assert p.first() is None and p.get(1) == (5, 6)
    p.advance({0: (7, 1)})
    assert p.first() == (5, 6)


def test_denylist_in_a_database(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/deny;create=true"
    d = denylist.Denylist(spark, url)
    assert d.handle("PUT", "/denylist/abc")[0] == 201 and d.handle("PUT", "/denylist/def")[0] == 201 and d.handle("DELETE", "/denylist/def")[0] == 204
    other = denylist.Denylist(spark, url)
    assert other.list() == ["abc"] and d.gauges == {"abc": 1, "def": 0} and other.gauges == {}
    assert [r.entry.lower() for r in changelog.read_denylist(spark, url).collect()] == ["abc"]


@pytest.mark.parametrize("text, status", [("FAILED_READ_FILE.FILE_NOT_EXIST", "lost position"), ("java.net.SocketTimeoutException: x", "timeout"), ("anything", "error")])
def test_read_status(text, status):
    assert runner.read_status(RuntimeError(text)) == status and runner.read_status(None) == "result"


class Query:
    isActive = False

    def __init__(self, error="stopped"):
        self.error = error

    def awaitTermination(self):
        raise RuntimeError(self.error)

    def exception(self):
        return None

    def stop(self):
        pass


def test_service_restarts_until_stopped():
    begun = []
    s = runner.Service(lambda: begun.append(1) or Query(), pause_s=0.0)
    s.run(max_stops=6)
    assert len(begun) == 6 and s.streak.n == 6 and s.health()[0] == 500
    lost = runner.Service(lambda: Query("FILE_NOT_EXIST"), pause_s=9.0)
    lost.SETTLE_S = 0.0
    lost.run(max_stops=3)
    assert lost.streak.n == 0

    def fails():
        raise runner.StartFailure("start_time", OSError("no store"))

    f = runner.Service(fails, pause_s=0.0)
    f.run(max_stops=2)
    assert f.metrics.get("tail_failed_to_start", reason="start_time") == 2
    assert state.TTL_S == 150.0


def test_start_fails_with_its_reason(spark, tmp_path):
    c = Config(log_url=str(tmp_path / "nothing"), sink_url=str(tmp_path / "out"))
    with pytest.raises(runner.StartFailure) as e:
        runner.start(spark, c, str(tmp_path / "checkpoint"), sleep=lambda s: None)
    assert e.value.reason in ("session", "start_time")


def test_health_by_dependency():
    class Running(Query):
        isActive = True

    s = runner.Service(Running, checks={"sourceOK": lambda: True, "sinksOK": lambda: 1 / 0})
    s.query = Running()
    assert s.health() == (500, {"running": True, "sourceOK": True, "sinksOK": False})
    s.checks["sinksOK"] = lambda: True
    assert s.health()[0] == 200


def test_http(spark):
    s = runner.Service(Query)
    d = denylist.Denylist(spark)
    s.serve("127.0.0.1:0", d)
    base = f"http://127.0.0.1:{s.server.server_address[1]}"

    def ask(verb, path):
        try:
            with urllib.request.urlopen(urllib.request.Request(base + path, method=verb)) as r:
                return r.status, r.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode()

    try:
        assert ask("GET", "/denylist") == (200, "[]") and ask("PUT", "/denylist/a%20b")[0] == 201 and ask("PUT", "/denylist/a%20b")[0] == 204
        assert ask("GET", "/denylist/a%20b") == (200, '"a b"') and ask("GET", "/denylist/x")[0] == 404 and ask("PUT", "/denylist/a/b")[0] == 404 and ask("POST", "/denylist/a")[0] == 404
        s.metrics.observe("h", 3, [1, 5], ordinal=0)
        status, text = ask("GET", "/metrics")
        assert status == 200 and 'denylist_filter_enabled{db="a b"} 1' in text and 'h_bucket{ordinal="0",le="5"} 1' in text and 'h_bucket{ordinal="0",le="1"} 0' in text
        assert ask("GET", "/healthz")[0] == 500 and ask("DELETE", "/denylist/a%20b")[0] == 204 == ask("DELETE", "/denylist/a%20b")[0]
        assert resume.HEALTHY_S == 60
    finally:
        s.stop()
