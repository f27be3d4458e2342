"""URL filters: rules first, then an empirical-Bayes reputation of the host.

Outcomes of labelled pages (bad or not) are summed by host, registered domain and public suffix.
Each level's bad rate gets a beta prior whose mean is the posterior mean of the level above (the
suffix's is the corpus's rate).  Its strength s follows from the correlation rho = 1 / (s + 1) of pages
within one group, estimated by moments (beta-binomial) from the spread of a level's groups about
their own parents: 0 pools a level fully, 1 trusts each group alone, so it needs no limits.  The
variance of a parent's mean is passed down, and a host without labelled pages has its domain's mean
(else its suffix's, else the corpus's) with the variance of an unseen group.  A host is blocked if the
lower bound of its posterior bad rate is above the corpus's rate times LIFT.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages, lower_ascii

#: (verdict, host and path prefix), as the query's contract lists them.
RULES = (("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/"))
#: Standard normal quantile of the posterior's bound, and the multiple of the corpus's bad rate above which a host is blocked.
Z, LIFT = 1.2816, 1.0
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Labels under which countries register domains; with a country's two letters they are one suffix (co.uk).
SECOND = "ac co com edu go gob gov ltd me mil ne net nom or org plc sch".split()
SUFFIX = rf"(?:(?:{'|'.join(SECOND)})[.][a-z][a-z]|[^.]*)"


def split_url(pages: DataFrame) -> DataFrame:
    """pages with host and path; null or without ://: both empty."""
    part = lambda i: F.coalesce(F.regexp_extract("url", URL, i), F.lit(""))
    return pages.withColumns({"host": lower_ascii(part(1)), "path": part(2)})


def apply_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (host, path) with rule and rule_verdict: the longest rule that fits, else null.

    rules are few, so they are an expression; of equally long ones the first listed wins.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        host, slash, path = text.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return pages.withColumns({"rule": rule, "rule_verdict": verdict})


def site(host: Column) -> Column:
    """The host's name: without user@, port and dots at the end."""
    for pattern in (r"(?s)^.*@", r":[0-9]*\z", r"[.]+\z"):
        host = F.regexp_replace(host, pattern, "")
    return host


def registered(name: Column) -> dict[str, Column]:
    """domain and suffix of a name; an address is its own domain and suffix."""
    address = name.rlike(r"^(?:[0-9.]+\z|\[)")
    part = lambda pattern: F.when(address, name).otherwise(F.regexp_extract(name, rf"(?:^|[.])({pattern})\z", 1))
    return {"domain": part(rf"(?:[^.]+[.])?{SUFFIX}"), "suffix": part(SUFFIX)}


def _correlation(groups: DataFrame, parent: list[str]) -> float:
    """rho of groups (n, x) about their parents' rates, by moments, between 0 and 1: one row for the driver."""
    g = groups.where("n > 0").selectExpr(*parent, "double(n) as n", "double(x) as x").groupBy(*parent)
    p = g.agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("m"), F.sum("x").alias("k"), F.sum(F.col("n") * F.col("n")).alias("m2"), F.sum(F.col("x") * F.col("x") / F.col("n")).alias("xx"))
    p = p.selectExpr("g - 1 as df", "k / m * (1 - k / m) as v", "xx - k * k / m as s", "m - m2 / m as c")
    r = p.agg(F.sum(F.expr("s - df * v")).alias("a"), F.sum(F.expr("v * (c - df)")).alias("b")).first()
    return min(1.0, max(0.0, r["a"] / r["b"])) if r["b"] and r["b"] > 0 else 0.0


def _posterior(groups: DataFrame, rho: float, prior: str, above: str, mean: str, var: str) -> DataFrame:
    """groups (n, x, prior mean, variance of that) with the posterior mean and its variance."""
    g = groups.withColumn(mean, F.expr(f"case when n = 0 then {prior} else ({1 - rho!r}D * {prior} + {rho!r}D * x) / ({1 - rho!r}D + {rho!r}D * n) end"))
    passed = f"case when n = 0 then 1D else {1 - rho!r}D / ({1 - rho!r}D + {rho!r}D * n) end"
    return g.withColumn(var, F.expr(f"{mean} * (1 - {mean}) * {rho!r}D / (1 + {rho!r}D * n) + power({passed}, 2) * {above}"))


def reputation(outcomes: DataFrame, stages: Stages, z: float = Z, hosts: DataFrame | None = None) -> tuple[DataFrame, float | None]:
    """(name, n, mean, low), the corpus's bad rate: posterior mean and lower bound of the bad rate of names.

    outcomes: (name, bad 0/1).  hosts: further names (name, distinct), judged with n = 0 if they have no
    outcomes.  No outcomes at all: the rate is None and there are no rows.
    """
    host = outcomes.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("x"))
    if hosts is not None:
        host = host.join(hosts, "name", "full_outer").fillna(0, ["n", "x"])
    host = stages.put(host.withColumns(registered(F.col("name"))), "names")
    domain = stages.put(host.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "domains")
    suffix = stages.put(domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "suffixes")
    rate = suffix.agg(F.expr("sum(x) / nullif(sum(n), 0)")).first()[0]
    if rate is None:
        return host.where("false").selectExpr("name", "n", "0D as mean", "0D as low"), None
    rate = float(rate)
    s = suffix.withColumns({"p0": F.lit(rate), "v0": F.lit(0.0)})
    s = _posterior(s, _correlation(suffix, []), "p0", "v0", "p1", "v1").select("suffix", "p1", "v1")
    d = _posterior(domain.join(s, "suffix"), _correlation(domain, ["suffix"]), "p1", "v1", "p2", "v2").select("domain", "suffix", "p2", "v2")
    h = _posterior(host.join(d, ["domain", "suffix"]), _correlation(host, ["domain", "suffix"]), "p2", "v2", "mean", "var")
    return h.selectExpr("name", "n", "mean", f"mean - {z!r}D * sqrt(var) as low"), rate


def url_filter(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, lift: float = LIFT, carry: list[str] = ("page_id",)) -> DataFrame:
    """pages (url, ...) judged: ``carry``, host, path, rule, verdict, bad_low.

    outcomes: (host, bad), one row for each labelled page; a null or empty host is no evidence.  A rule
    decides before the host's reputation.  A host without outcomes is judged by its domain, suffix or
    the corpus; pages without a host are allowed.  Null url: empty host and path, no rule, allowed.
    Empty tables: no rows; no outcomes: rules alone decide.  Repeated rows are judged alike.  Columns
    of pages that are not carried are dropped, clashing or not.
    """
    stages = Stages(pages.sparkSession, "urls")
    p = apply_rules(split_url(pages.select(*dict.fromkeys([*carry, "url"]))), rules).withColumn("name", site(F.col("host")))
    # staged: its true size decides between broadcast and a join that AQE can split at a hot host
    known = stages.put(p.where("name <> ''").select("name").distinct(), "known")
    seen = outcomes.select(site(F.col("host")).alias("name"), "bad").where("name <> ''")
    rep, rate = reputation(seen, stages, z, known)
    hosts = stages.put(rep.select("name", F.col("low").alias("bad_low")), "hosts")
    verdict = F.coalesce("rule_verdict", F.when(F.col("bad_low") > lift * (rate or 0.0), "block").otherwise("allow"))
    return p.join(hosts, "name", "left").select(*carry, "host", "path", "rule", verdict.alias("verdict"), "bad_low")


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad): pages show the document whose number ends their path (/en/123, /en/123.html); bad: low quality or toxic."""
    shown = split_url(pages.select("url")).select("host", F.regexp_extract("path", r"^/[a-z]+/([0-9]{1,18})", 1).alias("d")).where("d <> ''")
    bad = labels.select(F.col("doc_id").cast("string").alias("d"), ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int").alias("bad"))
    return shown.where("host <> ''").join(bad.where("d is not null"), "d").select("host", "bad")


def op7_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    out = url_filter(pages, labelled_outcomes(pages, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    fits = []
    for kind, text in sorted(RULES, key=lambda r: -len(r[1])):
        host, _, path = text.partition("/")
        fits.append((f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}') THEN ", text, kind))
    rule = " ".join(f"{c}'{t}'" for c, t, _ in fits)
    verdict = " ".join(f"{c}'{k}'" for c, _, k in fits)

    def rho(table: str, parent: str) -> str:
        """Correlation of a level's groups, one row (r)."""
        by = f"GROUP BY {parent}" if parent else ""
        return f"""(SELECT CASE WHEN b > 0 THEN least(1.0, greatest(0.0, a / b)) ELSE 0.0 END AS r FROM (
    SELECT sum((xx - k * k / m) - (g - 1) * v) AS a, sum(v * ((m - m2 / m) - (g - 1))) AS b FROM (
      SELECT *, k / m * (1 - k / m) AS v FROM (
        SELECT count(*) AS g, sum(n)::DOUBLE AS m, sum(x)::DOUBLE AS k, sum(n * n)::DOUBLE AS m2, sum(x * x / n::DOUBLE) AS xx FROM {table} WHERE n > 0 {by}))))"""

    def posterior(prior: str, above: str, mean: str, var: str, table: str, rho_: str, keep: str) -> str:
        return f"""(SELECT {keep}, {mean}, {mean} * (1 - {mean}) * r / (1 + r * n) + pow(CASE WHEN n = 0 THEN 1 ELSE (1 - r) / ((1 - r) + r * n) END, 2) * {above} AS {var}
    FROM (SELECT *, CASE WHEN n = 0 THEN {prior} ELSE ((1 - r) * {prior} + r * x) / ((1 - r) + r * n) END AS {mean} FROM {table}, {rho_}))"""

    second = "|".join(SECOND)
    suffix = f"(?:(?:{second})[.][a-z][a-z]|[^.]*)"
    return f"""
WITH cut AS (SELECT page_id, coalesce(strpos(url, '://'), 0) AS k0, url FROM pages),
tails AS (SELECT page_id, CASE WHEN k0 > 0 THEN substr(url, k0 + 3) ELSE '' END AS t FROM cut),
split AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '(?s)^.*@', ''), ':[0-9]*\\z', ''), '[.]+\\z', '') AS name FROM (
    SELECT page_id, translate(regexp_extract(t, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(t, '^[^/?#]*([^?#]*)', 1) AS path FROM tails)),
shown AS (SELECT name, regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})', 1) AS d FROM split WHERE name <> ''),
outcomes AS (
  SELECT name, CASE WHEN coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1 THEN 1 ELSE 0 END AS bad
  FROM shown JOIN labels ON d = doc_id::VARCHAR WHERE d <> ''),
hosts AS (
  SELECT name, n, x, CASE WHEN address THEN name ELSE regexp_extract(name, '(?:^|[.])((?:[^.]+[.])?{suffix})\\z', 1) END AS domain,
         CASE WHEN address THEN name ELSE regexp_extract(name, '(?:^|[.])({suffix})\\z', 1) END AS suffix
  FROM (SELECT name, count(bad) AS n, coalesce(sum(bad), 0) AS x, regexp_matches(name, '^(?:[0-9.]+\\z|\\[)') AS address
        FROM (SELECT DISTINCT name FROM split WHERE name <> '') LEFT JOIN outcomes USING (name) GROUP BY name)),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(x) AS x FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(x) AS x FROM domains GROUP BY ALL),
corpus AS (SELECT sum(x) / nullif(sum(n), 0)::DOUBLE AS p0, 0.0::DOUBLE AS v0 FROM suffixes),
s1 AS (SELECT * FROM {posterior("p0", "v0", "p1", "v1", "(SELECT * FROM suffixes, corpus)", rho("suffixes", ""), "suffix")}),
s2 AS (SELECT * FROM {posterior("p1", "v1", "p2", "v2", "(SELECT * FROM domains JOIN s1 USING (suffix))", rho("domains", "suffix"), "domain, suffix")}),
s3 AS (SELECT * FROM {posterior("p2", "v2", "mean", "var", "(SELECT * FROM hosts JOIN s2 USING (domain, suffix))", rho("hosts", "domain, suffix"), "name")})
SELECT page_id, host, path, CASE {rule} END AS rule,
       CASE {verdict} WHEN mean - {Z} * sqrt(var) > {LIFT} * p0 THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT * FROM split, corpus) LEFT JOIN s3 USING (name)
"""


OP7_SQL = _sql()
