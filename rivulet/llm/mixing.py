"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree (native).

1. Sizes in words and, by source, their sums; targets by water-filling (below).
2. Blocks: a source's documents by a seeded hash of id and text, about ``docs_per_block`` each; rows
   that are equal in both, which no hash parts, get blocks of their own beyond that number.  An epoch
   is one pass over all blocks of a source.  A source with target T and size S takes floor(T / S)
   whole epochs and a part of one more: blocks in permuted order while they fit and, of the block at
   the boundary, documents in a drawn order, each that still fits, and one more if that comes
   nearer; of several drawn orders the one that ends nearest counts.  Documents are never cut.
3. Splitting tree: the exact numbers of blocks of each source are the root.  Each node halves its
   range of output shards and draws the left half's blocks of every source from the multivariate
   hypergeometric distribution (a chain of exact hypergeometric draws, inverted from log factorials
   with seeded uniforms); the right half gets the rest.  The leaves are quotas that add up exactly.
4. Draw: shards take consecutive, so disjoint, runs of each source's permuted blocks by their quotas.
   What the mix takes of a document is what the shards drew of its block; copies are ordered by a
   seeded hash within their shard.
No step needs a source's documents or blocks in one task: running sums over permuted blocks are sums
over slices of the permutation plus sums within a slice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Stages

CAP = 3
#: Blocks in a slice of the permutation, and multiples of docs_per_block from which a block is searched for equal rows.
SLICE, CROWDED = 2000, 8
#: Drawn orders in which a boundary block's documents are tried.
ORDERS = 32


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: int = CAP) -> DataFrame:
    """sources (has_, name_, source_size, ...) with rank, weight and target.

    Sources rank by code point (the order of UTF-8 bytes), null last.  A level L solves
    sum(min(cap * size, weight * L)) = sum(size): sources sorted by cap * size / weight are capped
    up to one place, and L is what is left over the other weights.  One row for each source.
    """
    s = sources.selectExpr("*", "row_number() over (order by has_ desc, name_) as rank")
    s = s.withColumn("weight", F.get(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights)).cast("int")))
    s = s.selectExpr(
        "*", "sum(source_size) over () as all_size",
        f"sum({cap} * source_size) over (order by {cap} * source_size / weight, rank rows between unbounded preceding and 1 preceding) as capped",
        f"sum(weight) over (order by {cap} * source_size / weight desc, rank desc rows unbounded preceding) as open_weight",
    )
    s = s.withColumn("level", (F.col("all_size") - F.coalesce("capped", F.lit(0))) / F.col("open_weight"))
    #: the level at the first source that is not capped; where all are, each has its cap
    s = s.withColumn("free", F.col("weight") * F.col("level") <= cap * F.col("source_size"))
    s = s.selectExpr("*", f"min_by(level, if(free, struct({cap} * source_size / weight, rank), null)) over () as water")
    t = F.least((cap * F.col("source_size")).cast("double"), F.coalesce(F.col("weight") * F.col("water"), (cap * F.col("source_size")).cast("double")))
    return s.withColumn("target", t).drop("all_size", "capped", "open_weight", "level", "free", "water")


def _log_factorial(x: str) -> str:
    """SQL of ln x! : exact below 8, else Stirling's series (error below 1e-10)."""
    stirling = f"(y + 0.5D) * ln(y) - y + {0.5 * math.log(2 * math.pi)!r}D + 1D / (12 * y) - 1D / (360 * y * y * y) + 1D / (1260 * y * y * y * y * y)"
    return f"transform(array(double({x})), y -> if(y < 8, ln(double(factorial(int(least(y, 8D))))), {stirling}))[0]"


def _hypergeometric(good: str, total: str, draws: str, u: str) -> str:
    """SQL of a draw: how many of ``draws`` out of ``total`` things are among the ``good``; u is uniform in [0, 1).

    Inverts the distribution over its support within ten standard deviations; each probability follows from the one before.
    """
    given = f"named_struct('g', {good}, 'b', {total} - {good}, 'd', {draws}, 't', {total}, 'm', {draws} * ({good} / greatest({total}, 1L)), 'u', {u})"
    sd = "sqrt(x.m * (1 - x.g / greatest(x.t, 1L)))"
    first = f"greatest(0L, x.d - x.b, bigint(floor(x.m - 10 * {sd} - 3)))"
    last = f"least(x.g, x.d, bigint(ceil(x.m + 10 * {sd} + 3)))"
    parts = [("+", "x.g"), ("-", "s.f"), ("-", "x.g - s.f"), ("+", "x.b"), ("-", "x.d - s.f"), ("-", "x.b - x.d + s.f"), ("-", "x.t"), ("+", "x.d"), ("+", "x.t - x.d")]
    start = "exp(0D " + " ".join(f"{sign} {_log_factorial(v)}" for sign, v in parts) + ")"
    step = "named_struct('upto', acc.upto + acc.w, 'w', acc.w * (x.g - k) * (x.d - k) / ((k + 1D) * (x.b - x.d + k + 1)), 'k', if(acc.upto <= x.u, k, acc.k))"
    found = f"aggregate(sequence(s.f, s.l), named_struct('upto', 0D, 'w', {start}, 'k', s.f), (acc, k) -> {step}).k"
    return f"transform(array({given}), x -> transform(array(named_struct('f', {first}, 'l', {last})), s -> if(s.f >= s.l, s.f, {found}))[0])[0]"


def split_quotas(counts: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """(shard, rank, quota, before): blocks of each source for each shard; before: those of earlier shards.

    counts: (rank, n_blocks), ranks from 1 without gaps.  One array of counts, one row a source, is
    the root; mixtures are defined source by source, so it is as small as their definition.  All levels
    of the tree are one plan without a shuffle.
    """
    node = counts.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "n_blocks"))), lambda x: x["n_blocks"].cast("long")).alias("c"))
    node = node.select(F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), "c")
    for depth in range(max(1, n_shards - 1).bit_length()):
        total = F.aggregate("c", F.lit(0).cast("long"), lambda a, x: a + x)
        mid = ((F.col("lo") + F.col("hi")) / 2).cast("int")
        node = node.withColumns({"n": total, "mid": mid, "depth": F.lit(depth)})
        node = node.withColumn("draw", F.floor(F.col("n") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long"))
        k = _hypergeometric("c[i]", "so_far.n", "so_far.draw", f"pmod(xxhash64({seed}, depth, lo, i), {1 << 53}L) / {float(1 << 53)!r}D")
        step = f"transform(array({k}), k -> named_struct('n', so_far.n - c[i], 'draw', so_far.draw - k, 'left', concat(so_far.left, array(k))))[0]"
        zero = "named_struct('n', n, 'draw', draw, 'left', cast(array() as array<bigint>))"
        node = node.withColumn("left", F.expr(f"aggregate(filter(sequence(0, size(c)), i -> i < size(c)), {zero}, (so_far, i) -> {step}).left"))
        leaf = F.array(F.struct("lo", "hi", "c"))
        halves = F.array(F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("c")), F.struct(F.col("mid").alias("lo"), "hi", F.zip_with("c", "left", lambda a, b: a - b).alias("c")))
        node = node.select(F.explode(F.when(F.col("hi") - F.col("lo") > 1, halves).otherwise(leaf)).alias("x")).select("x.*")
    q = node.select(F.col("lo").alias("shard"), F.posexplode("c").alias("i", "quota")).withColumn("rank", F.col("i") + 1)
    return q.selectExpr("shard", "rank", "quota", "sum(quota) over (partition by rank order by shard) - quota as before")


def _running(blocks: DataFrame, value: str) -> DataFrame:
    """blocks (rank, slices, p, block, sub, ...) with upto: the sum of value over the source's blocks in the order of p, this one's included."""
    b = blocks.withColumn("slice", F.expr("least(slices - 1, floor((p / 9223372036854775808D + 1) / 2 * slices))"))
    before = b.groupBy("rank", "slice").agg(F.sum(value).alias("s")).selectExpr("rank", "slice", "sum(s) over (partition by rank order by slice) - s as before_")
    return b.join(before, ["rank", "slice"]).withColumn("upto", F.expr(f"before_ + sum({value}) over (partition by rank, slice order by p, block, sub)")).drop("before_", "slice")


def _shard_of(nth: Column, n_shards: int) -> Column:
    """The last of runs (before, shard) with before <= nth: a binary search."""
    lo_hi = F.struct(F.lit(0).alias("lo"), (F.size("runs") - 1).alias("hi"))

    def step(acc, _):
        mid = F.ceil((acc["lo"] + acc["hi"]) / 2).cast("int")
        right = F.get("runs", mid)["before"] <= nth
        return F.struct(F.when(right, mid).otherwise(acc["lo"]).alias("lo"), F.when(right, acc["hi"]).otherwise(F.greatest(mid - 1, acc["lo"])).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(0), F.lit(n_shards.bit_length())), lo_hi, step)["lo"]
    return F.get("runs", found)["shard"]


def _sums(d: DataFrame) -> DataFrame:
    return d.groupBy("rank", "block", "sub").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), *(F.max(c).alias(c) for c in ("epochs", "rest", "slices")))


def _parted(d: DataFrame, stages: Stages, docs_per_block: int) -> tuple[DataFrame, DataFrame]:
    """(d (rank, block, h, row_) with sub, its blocks): sub is 0 but for rows of one hash that crowd a block, which get sub-blocks of their own."""
    plain = d.withColumn("sub", F.lit(0).cast("long"))
    blocks = stages.put(_sums(plain), "blocks")
    over = blocks.where(F.col("n") > CROWDED * docs_per_block).select("rank", "block")
    if over.isEmpty():
        return plain, blocks
    equal = d.join(over, ["rank", "block"], "left_semi").groupBy("rank", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > docs_per_block)
    equal = stages.put(equal.select("rank", "h"), "equal")
    # row_ was stored with the row: equal rows, which are interchangeable, are numbered by the task that wrote them, then within it
    hot = d.join(equal, ["rank", "h"], "left_semi").withColumn("part", F.shiftright("row_", 33))
    before = hot.groupBy("rank", "h", "part").agg(F.count(F.lit(1)).alias("k")).selectExpr("rank", "h", "part", "sum(k) over (partition by rank, h order by part) - k as before_")
    hot = hot.selectExpr("*", "row_number() over (partition by rank, h, part order by row_) - 1 as r").join(before, ["rank", "h", "part"])
    hot = hot.withColumn("sub", F.xxhash64("h", F.floor((F.col("r") + F.col("before_")) / docs_per_block))).drop("part", "r", "before_")
    d = plain.join(equal, ["rank", "h"], "left_anti").unionByName(hot)
    return d, stages.put(_sums(d), "parted-blocks")


def _boundary(line: DataFrame) -> DataFrame:
    """line (rank, block, sub, room, h, size, row_), the documents of boundary blocks -> row_ of those taken: of ORDERS drawn orders, the one that ends nearest."""
    at = ["rank", "block", "sub", "order"]
    a = line.withColumn("order", F.explode(F.sequence(F.lit(1), F.lit(ORDERS))))
    a = a.groupBy(*at).agg(F.max("room").alias("room"), F.array_sort(F.collect_list(F.struct(F.xxhash64("h", "order").alias("o"), "size", "row_"))).alias("a"))
    fits = lambda acc, x: x["size"] <= acc["room"]
    fill = F.aggregate(
        "a",
        F.struct(F.col("room").alias("room"), F.array().cast("array<bigint>").alias("rows"), F.lit(None).cast("long").alias("next"), F.lit(None).cast("long").alias("gap")),
        lambda acc, x: F.struct(
            F.when(fits(acc, x), acc["room"] - x["size"]).otherwise(acc["room"]).alias("room"),
            F.when(fits(acc, x), F.concat(acc["rows"], F.array(x["row_"]))).otherwise(acc["rows"]).alias("rows"),
            F.when(fits(acc, x) | F.coalesce(acc["gap"] <= x["size"], F.lit(False)), acc["next"]).otherwise(x["row_"]).alias("next"),
            F.when(fits(acc, x) | F.coalesce(acc["gap"] <= x["size"], F.lit(False)), acc["gap"]).otherwise(x["size"]).alias("gap"),
        ),
    )  # next: the smallest that did not fit, with its size
    more = F.coalesce(F.col("f.gap") < 2 * F.col("f.room"), F.lit(False))
    a = a.withColumn("f", fill).withColumn("rows", F.when(more, F.concat("f.rows", F.array("f.next"))).otherwise(F.col("f.rows")))
    off = F.when(more, F.col("f.gap") - F.col("f.room")).otherwise(F.col("f.room"))
    return a.groupBy(*at[:3]).agg(F.min_by("rows", F.struct(off.alias("off"), "order")).alias("rows")).select(F.explode("rows").alias("row_"))


def mix(docs: DataFrame, id_col: str = "doc_id", n_shards: int = 64, docs_per_block: int = 32, seed: int = 20, carry: list[str] = ()) -> tuple[DataFrame, DataFrame, Stages]:
    """(per document, per copy): how the mix uses each row of docs.

    Per document: id, ``carry``, size, source_size, target, draws (epoch and shard of each copy), taken.
    Per copy: id, ``carry``, size, epoch, shard and place_key, by which to order within the shard.
    Null text: size 0, taken 0 words (it goes with its block).  Null source: a source of its own.
    Null and repeated ids: rows are documents of their own; which of rows equal in id and text is
    drawn is left open, how many of them is not.  A source whose target equals a multiple of its
    size takes whole epochs.  Empty table: no rows.  Reruns agree: every choice is a seeded hash.
    """
    stages = Stages(docs.sparkSession, "mixing")
    sized = docs.select(
        F.col(id_col).alias("doc_id"), *carry, F.col("source").isNotNull().alias("has_"), F.coalesce("source", F.lit("")).alias("name_"),
        n_words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), "text").alias("h"), F.monotonically_increasing_id().alias("row_"),
    )
    sized = stages.put(sized, "sized")
    sources = stages.put(sized.groupBy("has_", "name_").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "sources")
    t = targets(sources).withColumn("n_blocks", F.ceil(F.col("n_docs") / docs_per_block)).withColumn("slices", F.ceil(F.col("n_blocks") / SLICE))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(1).cast("long")
    t = t.withColumn("epochs", F.least(whole, F.lit(CAP).cast("long")))
    t = t.withColumn("rest", F.when(F.col("epochs") < CAP, F.col("target") - F.col("epochs") * F.col("source_size")).otherwise(0.0))
    t = stages.put(t.drop("n_docs", "weight"), "targets")
    d, blocks = _parted(sized.join(t, ["has_", "name_"]).withColumn("block", F.pmod("h", "n_blocks")), stages, docs_per_block)

    permuted = lambda epoch: F.xxhash64(F.lit(seed), epoch, "block", "sub")
    blocks = _running(blocks.withColumn("p", permuted(F.col("epochs") + 1)), "words")
    room = F.col("rest") - (F.col("upto") - F.col("words"))
    blocks = blocks.withColumn("cut", (F.col("upto") > F.col("rest")) & (room > 0)).withColumn("part", (F.col("rest") > 0) & ((F.col("upto") <= F.col("rest")) | F.col("cut")))
    blocks = stages.put(blocks.select("rank", "block", "sub", "slices", "epochs", "part", "cut", room.alias("room")), "filled")
    cut = blocks.where("cut").select("rank", "block", "sub", "room")
    # about docs_per_block documents of one block a source
    picked = stages.put(_boundary(d.join(cut, ["rank", "block", "sub"]).select("rank", "block", "sub", "room", "h", "size", "row_")), "picked")

    n = F.col("epochs") + F.col("part").cast("long")
    drawn = blocks.withColumn("epoch", F.explode(F.when(n > 0, F.sequence(F.lit(1).cast("long"), n)).otherwise(F.array().cast("array<bigint>"))))
    drawn = drawn.select("rank", "block", "sub", "slices", "epoch", (F.col("cut") & (F.col("epoch") > F.col("epochs"))).alias("some"))
    counts = t.select("rank").join(drawn.groupBy("rank").agg(F.count(F.lit(1)).alias("n_blocks")), "rank", "left").fillna(0, ["n_blocks"])
    quotas = split_quotas(counts, n_shards, seed).where("quota > 0")
    runs = stages.put(quotas.groupBy("rank").agg(F.array_sort(F.collect_list(F.struct("before", "shard"))).alias("runs")), "quotas")
    order = _running(drawn.withColumn("p", permuted(F.col("epoch"))).withColumn("one", F.lit(1).cast("long")), "one")
    placed = order.join(runs, "rank").withColumn("shard", _shard_of(F.col("upto") - 1, n_shards))
    draws = placed.groupBy("rank", "block", "sub").agg(F.array_sort(F.collect_list(F.struct("epoch", "shard", "some"))).alias("draws"))  # at most CAP
    draws = stages.put(draws, "draws")

    d = d.join(draws, ["rank", "block", "sub"], "left").join(picked.withColumn("picked", F.lit(True)), "row_", "left")
    got = F.filter("draws", lambda x: ~x["some"] | F.coalesce("picked", F.lit(False)))
    d = d.withColumn("draws", F.coalesce(F.transform(got, lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"))), F.array().cast("array<struct<epoch:bigint,shard:int>>")))
    d = d.select("doc_id", *carry, "size", "source_size", "target", "draws", (F.col("size") * F.size("draws")).alias("taken"))
    copies = d.select("doc_id", *carry, "size", F.explode("draws").alias("x")).select("doc_id", *carry, "size", "x.epoch", "x.shard", F.xxhash64(F.lit(seed + 1), "doc_id", "x.epoch").alias("place_key"))
    return d, copies, stages


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """taken is what the shards drew: the sum over the document's copies."""
    d, _, _ = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", "size", "source_size", "target", "taken")
