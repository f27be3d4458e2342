import json

import pytest
from pyspark.sql import functions as F

from rivulet.functions import documents, names, positions

#: Own documents for each rule: (op, document, shallow fields, bad, deep fields, bad).
CHANGED = [
    ("i", {"name": "n", "size": 3}, "name,size", 0, None, 0),
    ("u", {"name": "n", "size": 3}, "name,size", 0, None, 0),
    ("d", {"name": "n", "size": 3}, "", 0, None, 0),
    ("u", {"$set": {"p": 1, "q": {"r": 2}, "s.t": 3}, "$unset": {"v": ""}}, "p,q,s.t,v", 0, None, 0),
    ("u", {"$unset": {}}, "", 0, None, 0),
    ("u", {"$inc": 5, "$set": {"p": 1}}, "p", 1, None, 1),
    ("u", {"$set": '{"k":1}', "$unset": {"x": 1}}, "x", 1, None, 1),
    ("u", {"$set": None}, "", 1, None, 1),
    ("u", {"$v": 2, "diff": {"i": {"p": 1}, "u": {"q": 2, "r": 3}, "d": {"t": False}, "sv": 4, "sw": {}}}, "p,q,r,t,v,w", 0, "p,q,r,t", 1),
    ("u", {"$v": 2, "diff": {}}, "", 0, "", 0),
    ("u", {"$v": 2, "diff": {"d": [1], "what": 2, "sv": "x"}}, "v", 2, "", 3),
    ("u", {"$v": 2, "diff": {"u": None, "what": 2, "sv": {"i": {"x": {"y": 1}}}}}, "v", 2, "v.x.y", 2),
    ("u", {"$v": "2", "diff": {"i": {"a": 1}}}, "$v,diff", 0, None, 0),
    ("u", {"$v": 1, "diff": {"i": {"a": 1}}}, "$v,diff", 0, None, 0),
    ("u", {"$v": 2}, "$v", 0, None, 0),
]

#: Own diffs for each rule and their paths.
DEEP = [
    ({"sone": {"stwo": {"u": {"three": 1}}}}, ["one.two.three"]),
    ({"u": {"p": 1}, "i": {"o": 2}}, ["o", "p"]),
    ({"slines": {"a": True, "u7": None}}, ["lines.7"]),
    ({"i": {"p": {"q": {"r": 1}, "s": []}}}, ["p.q.r", "p.s"]),
    ({"d": {"p": {}}}, ["p"]),
    ({"sp": {"d": {"q": False}, "u": {"r": {"t": 1}}}}, ["p.q", "p.r.t"]),
    ({"sp": {"a": True, "u0": {"x": 1}, "u12": 2}, "u": {"o": "x"}}, ["o", "p.0", "p.12"]),
    ({"sp": {"sq": {"a": True, "u1": 1}, "i": {"r": 1}}}, ["p.q.1", "p.r"]),
    ({"sp": {"a": True, "s4": {"u": {"q": 1}}}}, ["p.4.q"]),
    ({"a": True, "sp": {"a": True}}, []),
]


def test_changed_fields(spark):
    rows = [(i, op, json.dumps(d)) for i, (op, d, *_) in enumerate(CHANGED)]
    df = spark.createDataFrame(rows, "i int, op string, o string")
    for deep in (False, True):
        got = df.select("i", documents.changed_fields(F.col("op"), F.col("o"), deep).alias("c")).orderBy("i").collect()
        for r, (_, d, shallow, bad, deep_fields, deep_bad) in zip(got, CHANGED, strict=True):
            fields, n = (shallow, bad) if not deep or deep_fields is None else (deep_fields, deep_bad)
            assert (",".join(sorted(r.c.fields)), r.c.n_bad) == (fields, n), (d, deep)


@pytest.mark.parametrize("diff, fields", DEEP)
def test_walk_diff(diff, fields):
    assert documents.walk_diff(diff) == (fields, 0)


def test_array_with_length_key_is_no_array_operator():
    assert documents.walk_diff({"sx": {"a": True, "l": 3, "u1": 2}}) == ([], 2)


def test_keys_keep_order_and_duplicates(spark):
    r = spark.range(1).select(documents.keys(F.lit('{"b":1,"a":2,"b":3}')).alias("k"), documents.keys(F.lit("[1]")).alias("n"), documents.keys(F.lit(None).cast("string")).alias("z")).first()
    assert (r.k, r.n, r.z) == (["b", "a", "b"], [], [])


def test_update_kind_and_array_operator(spark):
    docs = ['{"$set":1}', '{"$unset":null}', '{"$v":{"x":1},"foo":1}', '{"$v":2,"diff":{}}', '{"$v":2.0,"diff":1}', '{"a":true,"u1":1}', '{"a":1,"x":1}', "{}", '{"u1":1}']
    df = spark.createDataFrame([(d,) for d in docs], "o string").select("o", documents.update_kind(F.lit("u"), F.col("o")).alias("k"), documents.is_array_operator(F.col("o")).alias("a"))
    got = {r.o: (r.k, r.a) for r in df.collect()}
    assert [got[d][0] for d in docs[:5]] == ["v1", "v1", "replacement", "v2", "v2"]
    assert [got[d][1] for d in docs[5:]] == [True, False, False, False]


def test_positions(spark):
    cases = [(0, 1234, "1234"), (1234, 0, "5299989643264"), (1234, 5678, "5299989648942"), (0, 0, "0"), (4294967295, 4294967295, "18446744073709551615")]
    df = spark.createDataFrame(cases, "t long, i long, s string")
    for r in df.select("*", positions.encode(F.col("t"), F.col("i")).alias("e"), positions.decode_t(F.col("s")).alias("dt"), positions.decode_i(F.col("s")).alias("di")).collect():
        assert (r.e, r.dt, r.di) == (r.s, r.t, r.i)
    bad = spark.createDataFrame([("nope",), ("18446744073709551616",), ("-1",), ("",), (None,)], "s string")
    assert all(r.a is None and r.b is None for r in bad.select(positions.decode_t(F.col("s")).alias("a"), positions.decode_i(F.col("s")).alias("b")).collect())


def test_names(spark):
    df = spark.createDataFrame([("foo.bar",), ("foo.system.indexes",), ("foo",), ("",)], "ns string")
    got = [(r.db, r.coll) for r in df.select(names.database(F.col("ns")).alias("db"), names.collection(F.col("ns")).alias("coll")).collect()]
    assert got == [("foo", "bar"), ("foo", "system.indexes"), ("foo", ""), ("", "")]
    r = spark.range(1).select(names.parallelism_key(F.lit("foo")).alias("k"), names.shard(F.lit(-5), 3).alias("s"), names.split_channels(F.lit("a$$b$")).alias("c")).first()
    assert (r.k, r.s, r.c) == (-5843589418109203719, 1, ["a", "b"])


def test_destinations(spark):
    url = "redis-sentinel://pw@h1:1,h2:2/3?sentinelMasterId=m"
    assert names.parse_destination(url) == {"kind": "sentinel", "password": "pw", "endpoints": ["h1:1", "h2:2"], "db": 3, "master": "m", "tls": False}
    assert names.parse_destination("rediss://:secret@host/2")["tls"] is True
    for bad in ("redis-sentinel://h1", "redis-sentinel://h1:1/x", "http://x"):
        with pytest.raises(ValueError):
            names.parse_destination(bad)
    df = spark.createDataFrame([(url,), ("redis-sentinel://h1",), (None,)], "u string")
    p = names.sentinel_parts(F.col("u"))
    got = df.select(*(c.alias(k) for k, c in p.items())).collect()
    assert (got[0].password, got[0].endpoints, got[0].db, got[0].master, got[0].valid) == ("pw", ["h1:1", "h2:2"], 3, "m", True)
    assert [r.valid for r in got] == [True, False, False]


SENTINELS = [  # (URL, password, endpoints, db, master); None if it is none
    ("redis-sentinel://h:1/99999999999", "", ["h:1"], 99999999999, ""),
    ("redis-sentinel://h:1/99999999999999999999", None, None, None, None),
    ("redis-sentinel://h:1?sentinelMasterId=a%2Fb+c", "", ["h:1"], 0, "a/b c"),
    ("redis-sentinel://h:1?x=1&sentinelMasterId=m&sentinelMasterId=n", "", ["h:1"], 0, "m"),
    ("redis-sentinel://h:1?sentinelMasterId=%zz", None, None, None, None),
    ("redis-sentinel://h:1/", None, None, None, None),
    ("redis-sentinel://p/w@h:1/2", "p/w", ["h:1"], 2, ""),
    ("redis-sentinel://h:1:2", None, None, None, None),
    ("redis-sentinel://:1", None, None, None, None),
    ("redis-sentinel://", None, None, None, None),
    ("xredis-sentinel://h:1", None, None, None, None),
]


def test_sentinel_urls(spark):
    df = spark.createDataFrame([(i, u) for i, (u, *_) in enumerate(SENTINELS)], "i int, u string")
    got = df.select("i", *(c.alias(k) for k, c in names.sentinel_parts(F.col("u")).items())).orderBy("i").collect()
    assert [(r.password, r.endpoints, r.db, r.master) for r in got] == [x[1:] for x in SENTINELS]
    for url, password, ends, db, master in SENTINELS:
        if ends is None:
            with pytest.raises(ValueError):
                names.parse_destination(url)
        else:
            d = names.parse_destination(url)
            assert (d["password"], d["endpoints"], d["db"], d["master"]) == (password, ends, db, master)
