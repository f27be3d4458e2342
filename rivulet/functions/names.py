"""Namespaces, channels, shards and destination URLs."""

from __future__ import annotations

import re
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F


def database(ns: Column) -> Column:
    """What stands before the first dot."""
    return F.get(F.split(ns, r"\.", 2), 0)


def collection(ns: Column) -> Column:
    """What stands after the first dot; empty without one."""
    return F.coalesce(F.get(F.split(ns, r"\.", 2), 1), F.lit(""))


def parallelism_key(db: Column) -> Column:
    """The last eight bytes of SHA-256(db), little-endian, as a signed 64-bit number."""
    pairs = F.regexp_extract_all(F.right(F.sha2(db, 256), F.lit(16)), F.lit("(..)"), F.lit(1))
    return F.conv(F.array_join(F.reverse(pairs), ""), 16, -10).cast("long")


def shard(key: Column, shards: int) -> Column:
    return F.pmod(key, F.lit(shards).cast("long")).cast("int")


def channels(ns: Column, id_text: Column) -> Column:
    """The collection's channel and the document's."""
    return F.array(ns, F.concat(ns, F.lit("::"), id_text))


def join_channels(c: Column) -> Column:
    return F.array_join(c, "$")


def split_channels(c: Column) -> Column:
    return F.filter(F.split(c, r"\$"), lambda x: x != "")


SENTINEL = "redis-sentinel://"


def _after(text: Column, at: Column) -> Column:
    return F.substring(text, at + 1, F.length(text))


def sentinel_parts(url: Column) -> dict[str, Column]:
    """password, endpoints (array), db, master, valid of redis-sentinel://[password@]host:port[,host:port][/db][?sentinelMasterId=name].

    The query is form-encoded.  Parts of an invalid URL are null; a db beyond 64 bits is invalid.
    """
    mark = F.instr(url, "?")
    base, query = F.substring_index(url, "?", 1), F.when(mark > 0, _after(url, mark)).otherwise("")
    rest = F.when(F.startswith(base, F.lit(SENTINEL)), _after(base, F.lit(len(SENTINEL))))
    at = F.instr(rest, "@")  # a password has a character at least
    password, tail = F.when(at > 1, F.substring_index(rest, "@", 1)).otherwise(""), F.when(at > 1, _after(rest, at)).otherwise(rest)
    slash = F.instr(tail, "/")
    ends, number = F.split(F.substring_index(tail, "/", 1), ","), F.when(slash > 0, _after(tail, slash))
    db = F.when(slash == 0, F.lit(0).cast("long")).when(number.rlike(r"^[0-9]+\z"), number.try_cast("bigint"))
    host_port = lambda x: (F.size(x) == 2) & (F.get(x, 0) != "") & F.coalesce(F.get(x, 1).rlike(r"^[0-9]+\z"), F.lit(False))
    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), lambda p: F.struct(F.try_url_decode(F.substring_index(p, "=", 1)).alias("k"), F.try_url_decode(F.when(F.instr(p, "=") > 0, _after(p, F.instr(p, "="))).otherwise("")).alias("v")))
    read = ~F.contains(query, F.lit(";")) & F.forall(pairs, lambda p: p["k"].isNotNull() & p["v"].isNotNull())
    master = F.coalesce(F.get(F.filter(pairs, lambda p: p["k"] == "sentinelMasterId"), 0)["v"], F.lit(""))
    valid = F.coalesce(F.forall(ends, lambda x: host_port(F.split(x, ":"))) & db.isNotNull() & read, F.lit(False))
    return {k: F.when(valid, v) for k, v in {"password": password, "endpoints": ends, "db": db, "master": master}.items()} | {"valid": valid}


def parse_destination(url: str) -> dict:
    """The same for one URL on the driver; redis:// and rediss:// also. Raises ValueError on others."""
    base, _, query = url.partition("?")
    scheme, sep, rest = base.partition("://")
    if not sep or scheme not in ("redis", "rediss", "redis-sentinel") or re.search(r"%(?![0-9A-Fa-f]{2})", query) or ";" in query:
        raise ValueError(f"not a destination URL: {url}")
    if scheme == "redis-sentinel":
        before, found, after = rest.partition("@")
        password, tail = (before, after) if found and before else ("", rest)
        ends, slash, db = tail.partition("/")
        if slash and not db.isascii() or slash and not db.isdigit() or int(db or 0) >= 1 << 63:
            raise ValueError(f"bad db: {url}")
        for end in ends.split(","):
            host, _, port = end.partition(":")
            if not host or not (port.isascii() and port.isdigit()):
                raise ValueError(f"bad endpoints: {url}")
        return {"kind": "sentinel", "password": password, "endpoints": ends.split(","), "db": int(db or 0), "master": parse_qs(query, keep_blank_values=True).get("sentinelMasterId", [""])[0], "tls": False}
    u = urlsplit(base)
    db = u.path.removeprefix("/")
    if not u.hostname or db and not db.isdigit():
        raise ValueError(f"not a destination URL: {url}")
    return {"kind": "single", "password": u.password or "", "endpoints": [f"{u.hostname}:{u.port or 6379}"], "db": int(db or 0), "master": "", "tls": scheme == "rediss"}
