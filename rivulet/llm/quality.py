"""Quality rules with adaptive thresholds (native: DataFrame functions only).

Every document gets exact integer signals.  For each (lang, source) the signals are summarised by a
mergeable quantile sketch: counts by a log-linear bucket of the value (64 buckets for each power of
two, a relative error below 1/64).  Sketches are sums, so they combine map-side, and the sketch of a
language is the sum of its sources'.  A fence is median + spread * (third quartile - median) +
tolerance of the signal.  Each document's threshold blends the fences of its (lang, source), its
language and the whole corpus: one with n documents weighs n / (n + BLEND) against the next level's
blend, so that small groups lean on larger ones and no group size switches rules.  Where a quarter of
a group is bad its third quartile is a bad value, so its fence is held to the larger of the next
level's and the one with the spread of the group's good side (median - first quartile), which up to
half of bad documents do not move.  The whole corpus's is held to its good side's.  The thresholds
join back to the documents; a document is kept if it passes the base rules and every threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Stages

#: (signal, tolerance, side): side 1 rejects values above, -1 below, the mirrored fence.
RULES = (
    ("symbols_pm", 100, 1),
    ("upper_pm", 150, 1),
    ("dup_lines_pm", 500, 1),
    ("word_len_c", 250, 1),
    ("word_len_c", 250, -1),
)
SPREAD = 8
#: Documents at which a group's own fence weighs as much as the next level's.
BLEND = 200
SIGNALS = ("symbols_pm", "upper_pm", "dup_lines_pm", "word_len_c")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def _windows(hashes: Column, width: int = 5) -> Column:
    """(64-bit hash, place) of each width-word window, sorted: equal windows become neighbours."""
    return F.array_sort(
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.struct(F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]).alias("h"), i.alias("p")),
        )
    )


def signals(docs: DataFrame, carry: list[str]) -> DataFrame:
    """docs' ``carry`` columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper.

    Windows with equal hashes are compared word by word, so the counts are exact; memory is linear in
    the words of one document.  A null text counts as one without words.  Columns of docs named like a result are not carried.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(*carry, text.alias("_t"))
    base = base.select(*carry, "_t", _words(F.col("_t")).alias("_w"))
    base = base.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))  # a column of its own: lambdas would compute it anew for each window
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = base.select(
        *carry,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_t", F.lit(r"[A-Z]")).cast("long").alias("n_upper"),
        lines.alias("_l"),
        "_w",
        F.when(F.size("_w") >= 6, _windows(F.col("_h"))).alias("_s"),
    )
    base = base.select(
        *carry, "n_words", "word_chars", "n_symbols", "n_upper", F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), "_w", "_s",
        F.when(
            F.col("_s").isNotNull(),
            F.filter(F.sequence(F.lit(1), F.size("_s") - 1), lambda i: F.get(F.col("_s"), i)["h"] == F.get(F.col("_s"), i - 1)["h"]),
        ).alias("_e"),
    )
    place = lambda i: F.get(F.col("_s"), i)["p"]
    same = F.filter("_e", lambda i: F.slice("_w", place(i) + 1, 5) == F.slice("_w", place(i - 1) + 1, 5))
    base = base.withColumn("_p", F.array_sort(F.array_distinct(F.flatten(F.transform(same, lambda i: F.array(place(i - 1), place(i)))))))
    covered = F.aggregate(
        F.sequence(F.lit(1), F.size("_p")),
        F.lit(0),
        lambda acc, i: acc + F.least(F.lit(5), F.coalesce(F.get(F.col("_p"), i) - F.get(F.col("_p"), i - 1), F.lit(5))),
    )
    return base.select(
        *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("_p") > 0, covered).otherwise(0).cast("long").alias("n_repeat_words"), "n_lines", "n_upper",
    )


def _rates(d: DataFrame) -> DataFrame:
    rate = lambda a, b, by: F.expr(f"if({b} > 0, {by} * {a} div {b}, 0L)")
    return d.withColumns(
        {
            "symbols_pm": rate("n_symbols", "n_words", 1000),
            "upper_pm": rate("n_upper", "word_chars", 1000),
            "dup_lines_pm": rate("n_dup_lines", "n_lines", 1000),
            "word_len_c": rate("word_chars", "n_words", 100),
        }
    )


def sketches(d: DataFrame) -> DataFrame:
    """(lang_, source_, signal, bucket, n): the sketch of each signal by language and source, of documents with words."""
    v = d.where("n_words > 0").select("lang_", "source_", F.expr("stack(4, " + ", ".join(f"'{s}', {s}" for s in SIGNALS) + ") as (signal, v)"))
    v = v.withColumn("k", F.greatest(F.length(F.bin("v")) - 7, F.lit(0)))
    return v.withColumn("bucket", F.expr("shiftleft(shiftright(v, k), k)")).groupBy("lang_", "source_", "signal", "bucket").agg(F.count(F.lit(1)).alias("n"))


def thresholds(sketch: DataFrame, blend: int = BLEND, spread: int = SPREAD) -> DataFrame:
    """(lang_, source_, <signal>_hi, word_len_c_lo) for each (lang_, source_) of the sketch."""
    levels = []
    for level, keys in enumerate((["lang_", "source_"], ["lang_"], [])):
        g = sketch.groupBy(*keys, "signal", "bucket").agg(F.sum("n").alias("n"))
        part = ", ".join([*keys, "signal"])
        g = g.selectExpr("*", f"sum(n) over (partition by {part} order by bucket) as upto", f"sum(n) over (partition by {part}) as total")
        q = g.groupBy(*keys, "signal").agg(
            F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("bucket"))).alias("q1"),
            F.min(F.when(F.col("upto") * 2 >= F.col("total"), F.col("bucket"))).alias("q2"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("bucket"))).alias("q3"),
            F.max("total").alias("total"),
        )
        levels.append(q.select(*keys, "signal", *[F.col(c).alias(f"{c}_{level}") for c in ("q1", "q2", "q3", "total")]))
    t = levels[0].join(levels[1], ["lang_", "signal"]).join(levels[2], ["signal"])
    fences = []
    for name, slack, side in RULES:
        tighter, looser = (F.least, F.greatest) if side > 0 else (F.greatest, F.least)
        fence = None
        for level in (2, 1, 0):
            q1, q2, q3 = (F.col(f"{c}_{level}") for c in ("q1", "q2", "q3"))
            bad, good = (q3 - q2, q2 - q1) if side > 0 else (q2 - q1, q3 - q2)
            wide, robust = (q2 + side * (spread * x + slack) for x in (bad, good))
            n = F.col(f"total_{level}")
            if fence is None:
                fence = tighter(wide, robust).cast("double")
            else:
                fence = (n * tighter(wide, looser(robust, fence)) + blend * fence) / (n + blend)
        fences.append(F.max(F.when(F.col("signal") == name, fence)).alias(f"{name}_{'hi' if side > 0 else 'lo'}"))
    return t.groupBy("lang_", "source_").agg(*fences)


def quality_rules(docs: DataFrame, carry: list[str] = ("doc_id",), blend: int = BLEND, spread: int = SPREAD) -> DataFrame:
    """``carry`` columns, the signals, base_failed and kept, one row for each row of docs.

    docs needs text, lang and source; other columns pass only if carried.  Null text: no words, so
    base_failed.  Null lang or source: a group of its own.  Empty table: no rows.  Repeated rows and
    ties: judged alike.  Every signal covers the whole text.
    """
    stages = Stages(docs.sparkSession, "quality")
    key = lambda c: F.when(F.col(c).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(c)))
    keyed = docs.withColumns({"lang_": key("lang"), "source_": key("source")})
    d = stages.put(_rates(signals(keyed, [*carry, "lang_", "source_"])), "signals")
    cut = stages.put(thresholds(stages.put(sketches(d), "sketches"), blend, spread), "thresholds")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    passes = F.lit(True)
    for name, _, side in RULES:
        passes = passes & (F.col(name) <= F.col(f"{name}_hi") if side > 0 else F.col(name) >= F.col(f"{name}_lo"))
    return (
        d.join(cut, ["lang_", "source_"], "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & F.coalesce(passes, F.lit(False)))
        .select(*carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *SIGNALS)
    )


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    """DuckDB SQL for op3's rows."""
    word = r"[^\x20\x09-\x0D]+"
    levels = []
    for level, keys in enumerate((["lang_", "source_"], ["lang_"], [])):
        k = "".join(f"{x}, " for x in keys)
        levels.append(f"""q{level} AS (
  SELECT {k}signal, min(bucket) FILTER (upto * 4 >= total) AS q1, min(bucket) FILTER (upto * 2 >= total) AS q2,
         min(bucket) FILTER (upto * 4 >= total * 3) AS q3, max(total) AS total
  FROM (SELECT *, sum(n) OVER (PARTITION BY {k}signal ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {k}signal) AS total
        FROM (SELECT {k}signal, bucket, sum(n) AS n FROM sketch GROUP BY {k}signal, bucket))
  GROUP BY {k}signal)""")
    fences, blends = [], []
    for i, (name, slack, side) in enumerate(RULES):
        tighter, looser = ("least", "greatest") if side > 0 else ("greatest", "least")
        wide = lambda t: f"{t}.q2 + {SPREAD} * ({t}.q3 - {t}.q2) + {slack}" if side > 0 else f"{t}.q2 - {SPREAD} * ({t}.q2 - {t}.q1) - {slack}"  # noqa: E731, B023
        robust = lambda t: f"{t}.q2 + {SPREAD} * ({t}.q2 - {t}.q1) + {slack}" if side > 0 else f"{t}.q2 - {SPREAD} * ({t}.q3 - {t}.q2) - {slack}"  # noqa: E731, B023
        blends.append(f"{tighter}({wide('c')}, {robust('c')})::DOUBLE AS c{i}")
        for t, above in (("b", f"c{i}"), ("a", f"b{i}")):
            blends.append(f"({t}.total * {tighter}({wide(t)}, {looser}({robust(t)}, {above})) + {BLEND} * {above}) / ({t}.total + {BLEND}) AS {t}{i}")
        fences.append(f"max(a{i}) FILTER (signal = '{name}') AS {name}_{'hi' if side > 0 else 'lo'}")
    fences, blends = ", ".join(fences), ", ".join(blends)
    passes = " AND ".join(f"{name} {'<=' if side > 0 else '>='} {name}_{'hi' if side > 0 else 'lo'}" for name, _, side in RULES)
    parts = " UNION ALL ".join(f"SELECT lang_, source_, '{s}' AS signal, {s} AS v FROM rates WHERE n_words > 0" for s in SIGNALS)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS lang_,
         CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS source_ FROM documents),
worded AS (SELECT *, regexp_extract_all(t, '{word}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS l FROM docs),
windows AS (
  SELECT rid, i, w[i:i + 4] AS g FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 4)) AS i FROM worded WHERE len(w) >= 5)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM twice) GROUP BY rid),
counts AS (
  SELECT doc_id, lang_, source_, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(t, '[A-Z]'))::BIGINT AS n_upper,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM worded LEFT JOIN covered c USING (rid)),
rates AS (
  SELECT *, CASE WHEN n_words > 0 THEN 1000 * n_symbols // n_words ELSE 0 END AS symbols_pm,
         CASE WHEN word_chars > 0 THEN 1000 * n_upper // word_chars ELSE 0 END AS upper_pm,
         CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines ELSE 0 END AS dup_lines_pm,
         CASE WHEN n_words > 0 THEN 100 * word_chars // n_words ELSE 0 END AS word_len_c FROM counts),
sketch AS (
  SELECT lang_, source_, signal, (v >> k) << k AS bucket, count(*) AS n
  FROM (SELECT *, greatest(length(bin(v)) - 7, 0)::BIGINT AS k FROM ({parts})) GROUP BY ALL),
{', '.join(levels)},
cut AS (
  SELECT lang_, source_, {fences} FROM (
    SELECT a.lang_, a.source_, signal, {blends} FROM q0 a JOIN q1 b USING (lang_, signal) JOIN q2 c USING (signal)) GROUP BY lang_, source_)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce({passes}, false) AS kept, symbols_pm, upper_pm, dup_lines_pm, word_len_c
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM rates) LEFT JOIN cut USING (lang_, source_)
"""


OP3_SQL = _sql()
