"""Near-duplicate vectors by a random-projection tree forest.

1. Equal vectors of one label are one class from here on.
2. For each label a forest is grown in passes.  A pass takes every node with more than twice LEAF
   vectors, fits a subtree on at most SAMPLE of the node's own vectors (those with the smallest
   hashes) in one task for each node, and sends all its vectors down.  A subtree splits at the median
   of its sample's projections on a seeded random direction until about LEAF of the vectors it stands
   for are left; within SPILL of a threshold a vector goes both ways.  Passes go on until every node
   is a leaf or cannot be split, so leaves are bounded however large a label is, and nothing but row
   counts comes to the driver.  Vectors so near to each other that every cut would send most of them
   both ways are no longer split.
3. Vectors are compared within leaves only, in tiles of bounded size, by the cosine in double
   precision.  A pair counts in the first leaf that both share, so nothing is counted twice, and a
   tile returns sums of links and a spanning forest of them, never all pairs.
4. Links unite by alternating large-star and small-star.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages, connected_components
from .minhash import _forest

TREES, LEAF, TILE, SAMPLE, SPILL = 6, 400, 1500, 8192, 0.75
#: Levels of a subtree, directions tried for a cut, and the share of a sample that may go both ways.
LEVELS, TRIES, BOTH = 6, 4, 0.6
COSINE = 0.98


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _direction(group: int, node: int, k: int, attempt: int, dim: int) -> np.ndarray:
    v = np.random.default_rng([71, node, k, attempt, group & 0x7FFFFFFF]).standard_normal(dim)
    return v / np.sqrt((v * v).sum())


def _spill(cosine: float, dim: int) -> float:
    return SPILL * np.sqrt((2 - 2 * cosine) / dim)


def fit_subtree(x: np.ndarray, n: int, group: int, node: int, leaf: int, spill: float) -> dict[int, tuple[int, float]]:
    """{k: (direction, threshold)} of unit vectors x that stand for n; 1 is the subtree's root, 2k and 2k + 1 are the halves of k."""
    cuts: dict[int, tuple[int, float]] = {}
    open_ = [(1, np.arange(len(x)))]
    while open_:
        k, rows = open_.pop()
        if len(rows) * n <= leaf * len(x) or len(rows) < 8 or k >> LEVELS:
            continue
        best = None
        for attempt in range(TRIES):
            p = x[rows] @ _direction(group, node, k, attempt, x.shape[1])
            cut = float(np.median(p))
            both = float((np.abs(p - cut) <= spill).mean())
            if best is None or both < best[0]:
                best = both, attempt, cut, p
            if both < BOTH / 2:
                break
        both, attempt, cut, p = best
        if both > BOTH or (p <= cut).all():
            continue
        cuts[k] = attempt, cut
        open_ += [(2 * k, rows[p <= cut]), (2 * k + 1, rows[p > cut])]
    return cuts


def send_down(x: np.ndarray, cuts: dict[int, tuple[int, float]], group: int, node: int, spill: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, k) of unit vectors x in one subtree, with spill."""
    rows, nodes = [], []
    open_ = [(1, np.arange(len(x)))]
    while open_:
        k, at = open_.pop()
        if k not in cuts:
            rows.append(at)
            nodes.append(np.full(len(at), k))
            continue
        attempt, cut = cuts[k]
        p = x[at] @ _direction(group, node, k, attempt, x.shape[1])
        for child, side in ((2 * k, p <= cut + spill), (2 * k + 1, p > cut - spill)):
            if side.any():
                open_.append((child, at[side]))
    return np.concatenate(rows), np.concatenate(nodes)


def _matrix(lists) -> np.ndarray:
    at = np.asarray(lists.offsets).astype(np.int64)
    return np.asarray(lists.values)[at[0] : at[-1]].astype(np.float64).reshape(len(lists), -1)


def _fitted(cosine: float, leaf: int):
    """A node's sample (group, node, n, v) -> group, node, ks, tries, cuts: its subtree."""

    def run(key, sample):
        import pyarrow as pa

        group, node = (k.as_py() for k in key)
        x = _unit(_matrix(sample.column("v").combine_chunks()))
        cuts = fit_subtree(x, sample.column("n")[0].as_py(), group, node, leaf, _spill(cosine, x.shape[1]))
        return pa.table(
            {"group": pa.array([group]), "node": pa.array([node]), "ks": pa.array([list(cuts)], pa.list_(pa.int32())), "tries": pa.array([[a for a, _ in cuts.values()]], pa.list_(pa.int32())), "cuts": pa.array([[c for _, c in cuts.values()]], pa.list_(pa.float64()))}
        )

    return run


def _sent(cosine: float):
    """(rep, group, node, ks, tries, cuts, v) -> rep, group, node, done: the nodes below, whose numbers go on from the node's."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rep, group, node = (np.asarray(batch.column(i)) for i in range(3))
            out: list[list[np.ndarray]] = [[], [], [], []]
            order = np.lexsort((node, group))
            edges = np.flatnonzero(np.append(True, (np.diff(node[order]) != 0) | (np.diff(group[order]) != 0)))
            for at in np.split(order, edges[1:]) if len(order) else ():
                g, i = int(group[at[0]]), int(node[at[0]])
                ks, tries, cuts = (batch.column(c)[int(at[0])].as_py() for c in (3, 4, 5))
                x = _unit(_matrix(batch.column(6).take(pa.array(at))))
                row, k = send_down(x, dict(zip(ks, zip(tries, cuts, strict=True), strict=True)), g, i, _spill(cosine, x.shape[1]))
                for o, v in zip(out, (rep[at][row], np.full(len(row), g), i << LEVELS + 1 | k, np.full(len(row), not ks)), strict=True):
                    o.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(o) if o else np.zeros(0, t), ty) for o, t, ty in zip(out, (np.int64, np.int64, np.int64, bool), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["rep", "group", "node", "done"])

    return run


def grow(reps: DataFrame, stages: Stages, cosine: float) -> DataFrame:
    """(rep, group, leaf) for reps (rep, group, v): the leaves of every vector."""
    at = reps.select("rep", "group", F.explode(F.array(*(F.lit(t + 1).cast("long") for t in range(TREES)))).alias("node"), F.lit(False).alias("done"))
    final = None
    for _ in range(8):  # each pass adds LEVELS + 1 bits to a node's number: LEAF * 2 ** 48 vectors of a label
        large = at.where("not done").groupBy("group", "node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2 * LEAF)
        large = stages.put(large, "large-nodes")
        small = at.join(large.select("group", "node"), ["group", "node"], "left_anti").select("rep", "group", F.col("node").alias("leaf"))
        final = small if final is None else final.unionByName(small)
        if large.isEmpty():
            return final
        at = stages.put(at.join(large, ["group", "node"]).select("rep", "group", "node", "n"), "open")
        chosen = at.withColumn("place", F.expr("row_number() over (partition by group, node order by xxhash64(rep, node), rep)")).where(F.col("place") <= SAMPLE)
        chosen = chosen.drop("place").join(reps.select("rep", "v"), "rep")
        trees = chosen.groupBy("group", "node").applyInArrow(_fitted(cosine, LEAF), "group long, node long, ks array<int>, tries array<int>, cuts array<double>")
        trees = stages.put(trees, "subtrees")
        # each vector once with its open nodes, so that it is not shuffled for each of them; subtrees are broadcast only if they are small
        open_ = reps.select("rep", "v").join(at.groupBy("rep", "group").agg(F.collect_list("node").alias("nodes")), "rep")
        open_ = open_.select("rep", "group", F.explode("nodes").alias("node"), "v").join(trees, ["group", "node"])
        sent = open_.select("rep", "group", "node", "ks", "tries", "cuts", "v").mapInArrow(_sent(cosine), "rep long, group long, node long, done boolean")
        at = stages.put(sent, "sent")
    return final.unionByName(at.select("rep", "group", F.col("node").alias("leaf")))


def _linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): pairs of rows of x and y with at least the cosine; near the threshold it is computed anew, as dot / (norm * norm)."""
    c = _unit(x) @ _unit(y).T
    i, j = np.nonzero(c >= cosine - 1e-9)
    near = np.flatnonzero(np.abs(c[i, j] - cosine) <= 1e-9)
    ok = np.ones(len(i), bool)
    for k in near:
        a, b = x[i[k]], y[j[k]]
        ok[k] = np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))) >= cosine
    return i[ok], j[ok]


def _compare(cosine: float):
    """Rows of one tile (rep, mult, group, leaf, a, b, side, leaves, v) -> u, v, n: links of u (v null), and forest edges."""

    def run(key, tile):
        import pyarrow as pa

        t = tile.combine_chunks()
        rep, mult, side = (np.asarray(t.column(c).combine_chunks()) for c in ("rep", "mult", "side"))
        leaf, a, b = (t.column(c)[0].as_py() for c in ("leaf", "a", "b"))
        lists = t.column("leaves").combine_chunks()
        at = np.asarray(lists.offsets).astype(np.int64)
        inner = np.asarray(lists.values)
        earlier = np.full((len(rep), max(1, int(np.diff(at).max()))), -1, np.int64)
        for i in range(len(rep)):
            x = inner[at[i] : at[i + 1]]
            x = x[x < leaf]
            earlier[i, : len(x)] = x
        v = _matrix(t.column("v").combine_chunks())
        left, right = (np.flatnonzero(side == s) for s in ((0, 0) if a == b else (0, 1)))
        i, j = _linked(v[left], v[right], cosine)
        i, j = left[i], right[j]
        if a == b:
            i, j = i[i < j], j[i < j]
        fresh = np.ones(len(i), bool)
        for lo in range(0, len(i), 20_000):
            p, q = earlier[i[lo : lo + 20_000]], earlier[j[lo : lo + 20_000]]
            fresh[lo : lo + 20_000] = ~((p[:, :, None] == q[:, None, :]) & (p[:, :, None] >= 0)).any((1, 2))
        i, j = i[fresh], j[fresh]
        n = np.bincount(i, mult[j], len(rep)) + np.bincount(j, mult[i], len(rep))
        some = np.flatnonzero(n)
        keep = _forest(i, j)
        u = np.concatenate([rep[some], rep[i[keep]]])
        w = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(rep[j[keep]])])
        return pa.table({"u": pa.array(u), "v": w, "n": pa.array(np.concatenate([n[some], np.zeros(len(keep))]).astype(np.int64))})

    return run


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row for each row of vectors (vec_id, embedding, label; other columns are ignored).

    Vectors of equal, not null labels (and equal lengths) with at least the cosine are linked.  Null,
    empty or zero vectors and those with null or non-finite components, and rows without label or
    vec_id, link with nothing: n_links 0, component_id their own vec_id (null if that is), kept.
    Rows are vectors: repeated rows, whether of one vec_id or several, and ties count as links of each other.  Empty table: no rows.
    """
    stages = Stages(vectors.sparkSession, "vectors")
    e = F.col("embedding").cast("array<double>")
    size = F.aggregate(e, F.lit(0.0), lambda s, x: s + x * x)  # null with a null, not finite with another
    ok = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & (size > 0) & (size < float("inf")) & ~F.isnan(size), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.when(ok, F.xxhash64("label", F.size("embedding"))).alias("group"), F.when(ok, e).alias("v"),
        F.when(ok, F.xxhash64(e)).alias("k1"), F.when(ok, F.xxhash64(F.lit(5), e)).alias("k2"),
    )
    rows = stages.put(rows, "rows")
    key = ["group", "k1", "k2"]
    classes = rows.where("group is not null").groupBy(*key).agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("mult"))
    classes = stages.put(classes.withColumn("rep", F.xxhash64(*key)), "classes")
    reps = rows.join(classes, key).where("vec_id = first").dropDuplicates(key).select("rep", "mult", "group", "v")
    reps = stages.put(reps, "reps")

    leaves = stages.put(grow(reps.select("rep", "group", "v"), stages, cosine), "leaves")
    own = leaves.groupBy("rep").agg(F.array_sort(F.collect_list("leaf")).alias("leaves"))
    routed = reps.join(own, "rep").select("rep", "mult", "group", F.explode("leaves").alias("leaf"), "leaves", "v")
    sizes = leaves.groupBy("group", "leaf").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("nb")).where("nb > 1")
    routed = routed.join(stages.put(sizes, "large-leaves"), ["group", "leaf"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    block = F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int")
    tiles = routed.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    tiles = tiles.select(
        "rep", "mult", "group", "leaf", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), (F.col("block") > F.col("other")).cast("int").alias("side"), "leaves", "v"
    )
    found = stages.put(tiles.groupBy("group", "leaf", "a", "b").applyInArrow(_compare(cosine), "u long, v long, n long"), "found")
    comp = stages.put(connected_components(found.where("v is not null").select("u", "v"), stages), "components")
    links = stages.put(found.where("v is null").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n")), "links")
    comp = comp.select(F.col("id").alias("rep"), "component")
    least = comp.join(classes.select("rep", "first"), "rep").groupBy("component").agg(F.min("first").alias("least"))
    comp = comp.join(least, "component").select("rep", "least")
    classes = classes.join(links, "rep", "left").join(comp, "rep", "left")
    out = rows.select("vec_id", *key).join(stages.put(classes, "classes-linked"), key, "left")
    cid = F.coalesce("least", "first", "vec_id")
    n = F.coalesce(F.coalesce("n", F.lit(0)) + F.col("mult") - 1, F.lit(0)).cast("long")
    return out.select("vec_id", n.alias("n_links"), cid.alias("component_id"), F.coalesce(F.col("vec_id") == cid, F.lit(True)).alias("kept"))


def op6_near_vectors(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CASE WHEN label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0 THEN list_transform(embedding, lambda x: x::DOUBLE) END AS e FROM embeddings),
n AS (SELECT *, sqrt(list_dot_product(e, e)) AS size FROM v WHERE e IS NOT NULL),
links AS (
  SELECT a.r AS a, b.r AS b FROM n a JOIN n b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
reach AS (SELECT r, r AS to_ FROM v UNION SELECT reach.r, b FROM reach JOIN links ON a = to_)
SELECT x.vec_id, (SELECT count(*) FROM links WHERE a = x.r) AS n_links, c AS component_id, coalesce(x.vec_id = c, true) AS kept
FROM v x JOIN (SELECT reach.r, min(y.vec_id) AS c FROM reach JOIN v y ON y.r = to_ GROUP BY reach.r) USING (r)
"""
