"""MinHash near-duplicates: universal hash minima, banding, verification, alternating-star components.

1. Each text's set of word shingles becomes BANDS bands of ROWS minima of universal hashes, 16 bits
   each, so that one band is one 64-bit key.  Texts with equal sets are one class from here on.
2. Classes that share a band key share a bucket.  Each bucket's least member is its hub; hub pairs,
   linear in the members, pass a signature check and then the exact check on full sets of whole
   texts; verified pairs give components by alternating large-star and small-star.
3. Losing no link: in each bucket with members of other components than the hub's, those members are
   compared with all members of other components by signature, in tiles of bounded size.  Members
   with an agreeing partner are then compared exactly, by their sets' differences to the hub's set,
   in the same tiles, which return a spanning forest of the links found.  Copies are never expanded
   to pairs, and pairs within one component need no comparison.
Missed by the bands: a pair at similarity 0.8 with probability (1 - 0.8^4)^25 = 2e-6.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages, connected_components
from .shingles import buffers, groups, minima, mix, shingle_sets

BANDS, ROWS = 25, 4
#: Signature agreements of BANDS * ROWS below which no pair is checked exactly: five standard deviations under 0.8.
AGREE = 60
TILE = 2000


def _signatures(width: int):
    rng = np.random.default_rng(np.random.PCG64(4177))
    a = rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, at = buffers(batch.column(1))
            n = len(at) - 1
            size, s1, s2 = np.zeros(n, np.int64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            sig = np.zeros((n, BANDS * ROWS), np.uint16)
            for lo, hi in groups(at):
                h, owner = shingle_sets(data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], width)
                size[lo:hi] = np.bincount(owner, minlength=hi - lo)
                np.add.at(s1, owner + lo, mix(h + np.uint64(11)))
                np.add.at(s2, owner + lo, mix(h ^ np.uint64(0x5555555555555555)))
                sig[lo:hi] = (mix(minima(h, owner, hi - lo, a, b)) >> np.uint64(48)).astype(np.uint16)
            keys = np.ascontiguousarray(sig).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.ListArray.from_arrays(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32), pa.array(keys.reshape(-1)))],
                ["doc_id", "n_shingles", "s1", "s2", "sig"],
            )

    return run


def _agreeing(batches):
    """(a, b, sa, sb) -> (a, b) of the pairs whose signatures agree often enough."""
    import pyarrow as pa

    for batch in batches:
        sa, sb = (np.asarray(c.flatten()).view(np.uint16).reshape(len(batch), -1) for c in (batch.column(2), batch.column(3)))
        good = (sa == sb).sum(1) >= AGREE
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in (0, 1)], ["a", "b"])


def _verified(width: int, percent: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            (da, ata), (db, atb) = buffers(batch.column(2)), buffers(batch.column(3))
            good = np.zeros(len(batch), bool)
            for lo, hi in groups(ata + atb):
                n = hi - lo
                data = np.concatenate([da[ata[lo] : ata[hi]], db[atb[lo] : atb[hi]]])
                at = np.concatenate([ata[lo : hi + 1] - ata[lo], atb[lo + 1 : hi + 1] - atb[lo] + (ata[hi] - ata[lo])])
                h, owner = shingle_sets(data, at, width)
                size = np.bincount(owner, minlength=2 * n)
                pair = owner % n
                order = np.lexsort((h, pair))
                h, pair = h[order], pair[order]
                twice = (h[1:] == h[:-1]) & (pair[1:] == pair[:-1])
                both = np.bincount(pair[1:][twice], minlength=n)
                good[lo:hi] = 100 * both >= percent * (size[:n] + size[n:] - both)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in (0, 1)], ["u", "v"])

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indices of the edges (a, b), in the order given, that join two trees: a spanning forest."""
    parent: dict[int, int] = {}

    def root(x):
        while (y := parent.get(x, x)) != x:
            parent[x] = x = parent.get(y, y)
        return x

    keep = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep.append(i)
    return np.array(keep, np.int64)


def _by_tile(work):
    """Batches sorted by their first four columns -> work(rows) for each run of equal values, as column lists."""

    def run(batches):
        import pyarrow as pa

        held, last = [], None
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            key = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(4)], 1)
            cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, [n]])
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                k = tuple(key[lo])
                if held and k != last:
                    yield work(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held = []
                last = k
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield work(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    return run


def _candidates(tile):
    """A tile's rows (band, key, g, r, guest, hub, rep, comp, sig) that agree with a row of another component, without sig."""
    import pyarrow as pa

    guest, comp = (np.asarray(tile.column(i).to_numpy(zero_copy_only=False)) for i in (4, 7))
    guest = guest.astype(bool)
    sig = np.asarray(tile.column(8).flatten()).view(np.uint16).reshape(len(tile), -1)
    keep, rest = np.zeros(len(tile), bool), np.flatnonzero(~guest)
    for i in np.flatnonzero(guest):
        hit = rest[comp[rest] != comp[i]]
        hit = hit[(sig[hit] == sig[i]).sum(1) >= AGREE]
        keep[hit] = True
        keep[i] = len(hit) > 0
    return pa.RecordBatch.from_arrays([tile.column(i).filter(pa.array(keep)) for i in range(8)], ["band", "key", "g", "r", "guest", "hub", "rep", "comp"])


def _differences(width: int):
    """(hub, rep, hub's text, rep's text) -> hub, rep, size of rep's set, symmetric difference of the two sets."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            (da, ata), (db, atb) = buffers(batch.column(2)), buffers(batch.column(3))
            sizes, found, ends = [], [], [0]
            for lo, hi in groups(ata + atb):
                n = hi - lo
                data = np.concatenate([da[ata[lo] : ata[hi]], db[atb[lo] : atb[hi]]])
                at = np.concatenate([ata[lo : hi + 1] - ata[lo], atb[lo + 1 : hi + 1] - atb[lo] + (ata[hi] - ata[lo])])
                h, owner = shingle_sets(data, at, width)
                sizes.append(np.bincount(owner, minlength=2 * n)[n:])
                pair = owner % n
                order = np.lexsort((h, pair))
                h, pair = h[order], pair[order]
                same = np.zeros(len(h) + 1, bool)
                same[1:-1] = (h[1:] == h[:-1]) & (pair[1:] == pair[:-1])
                alone = ~(same[:-1] | same[1:])
                found.append(h[alone].view(np.int64))
                ends.extend((ends[-1] + np.cumsum(np.bincount(pair[alone], minlength=n))).tolist())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(found) if found else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64)), lists], ["hub", "rep", "size", "diff"])

    return run


def _exact(percent: int):
    """A tile's rows (band, key, g, r, guest, rep, comp, size, diff) -> links (u, v) that join all its linked components.

    Sets are compared exactly through their differences to the bucket's hub:
    |A ^ B| = |A ^ H| + |B ^ H| - 2 |(A ^ H) & (B ^ H)|.
    """

    def work(tile):
        import pyarrow as pa

        guest = np.asarray(tile.column(4).to_numpy(zero_copy_only=False)).astype(bool)
        rep, comp, size = (np.asarray(tile.column(i)) for i in (5, 6, 7))
        lists = tile.column(8)
        n = np.diff(np.asarray(lists.offsets))
        item, inverse = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        row = np.repeat(np.arange(len(tile)), n)
        often = np.bincount(inverse, minlength=len(item)) > 1
        number = np.cumsum(often) - 1
        row, col = row[often[inverse]], number[inverse[often[inverse]]]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        g, m = np.flatnonzero(guest), np.flatnonzero(~guest)
        at = np.zeros(len(tile), np.int64)
        at[g], at[m] = np.arange(len(g)), np.arange(len(m))
        both = np.zeros((len(g), len(m)), np.float32)
        for lo in range(0, int(often.sum()), 2048):
            i, j = np.searchsorted(col, [lo, lo + 2048])
            x, y = np.zeros((len(g), 2048), np.float32), np.zeros((len(m), 2048), np.float32)
            r, c = row[i:j], col[i:j] - lo
            x[at[r[guest[r]]], c[guest[r]]] = 1
            y[at[r[~guest[r]]], c[~guest[r]]] = 1
            both += x @ y.T
        apart = n[g][:, None] + n[m][None, :] - 2 * both.astype(np.int64)
        total = size[g][:, None] + size[m][None, :]
        a, b = np.nonzero((100 * (total - apart) >= percent * (total + apart)) & (comp[g][:, None] != comp[m][None, :]))
        keep = _forest(comp[g[a]], comp[m[b]])
        return pa.RecordBatch.from_arrays([pa.array(rep[g[a[keep]]]), pa.array(rep[m[b[keep]]])], ["u", "v"])

    return work


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, one row for each row of docs.

    Documents whose sets of ``width``-word shingles (A-Z folded; fewer words: the whole sequence as
    one) have a Jaccard similarity of ``percent`` hundredths or more are linked; component_id is the
    smallest doc_id reachable, kept says that it is the row's own.  docs needs an integer doc_id and
    text; other columns are ignored.  Null, empty or blank text: no set, linked with nothing.  Null
    doc_id: linked with nothing, component_id null, kept.  Rows of one doc_id are one document: they
    are linked by their id.  Empty table: no rows.
    """
    stages = Stages(docs.sparkSession, "minhash")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sig = stages.put(d.mapInArrow(_signatures(width), "doc_id long, n_shingles long, s1 long, s2 long, sig array<bigint>"), "signatures")
    same = ["s1", "s2", "n_shingles"]
    some = sig.where("n_shingles > 0 and doc_id is not null")
    rep = stages.put(some.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = stages.put(some.join(rep, same).where("doc_id = rep").dropDuplicates(["rep", *same]).select("rep", "sig"), "reps")

    bands = reps.select(F.posexplode("sig").alias("band", "key"), "rep")
    buckets = stages.put(bands.groupBy("band", "key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"), F.count(F.lit(1)).alias("n")).where("hub <> top").drop("top"), "buckets")
    members = stages.put(bands.join(buckets, ["band", "key"]), "members")
    wanted = stages.put(members.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    texts = stages.put(d.join(wanted, "doc_id", "left_semi"), "texts")
    sigs = reps.select("rep", "sig")

    def check(pairs: DataFrame) -> DataFrame:
        """Exact check of (a, b) on whole texts."""
        x = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
        return stages.put(x.select("a", "b", "ta", "tb").mapInArrow(_verified(width, percent), "u long, v long"), "hub-edges")

    hubs = stages.put(members.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "hub-pairs")
    hubs = hubs.join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b").join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
    hubs = stages.put(hubs.select("a", "b", "sa", "sb").mapInArrow(_agreeing, "a long, b long"), "hub-agree")
    edges = check(hubs)
    comp = stages.put(connected_components(edges, stages), "hub-components")

    #: buckets that still hold more than one component, beyond pairs that were checked as hub pairs
    m = members.where("n > 2").join(comp, members.rep == comp.id, "left").select("band", "key", "hub", "rep", F.coalesce("component", "rep").alias("comp"))
    hub_comp = comp.select(F.col("id").alias("hub"), F.col("component").alias("hub_comp"))
    m = stages.put(m.join(hub_comp, "hub", "left").withColumn("guest", F.col("comp") != F.coalesce("hub_comp", "hub")).drop("hub_comp"), "tagged")
    mixed = m.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n_all"), F.sum(F.col("guest").cast("long")).alias("n_guest")).where("n_guest > 0")
    mixed = stages.put(mixed.select("band", "key", F.ceil(F.col("n_all") / TILE).cast("int").alias("nr"), F.ceil(F.col("n_guest") / TILE).cast("int").alias("ng")), "mixed")
    rows = m.join(mixed, ["band", "key"]).withColumn("h", F.xxhash64("rep"))
    tile = ["band", "key", "g", "r"]
    as_member = rows.select("band", "key", F.explode(F.sequence(F.lit(0), F.col("ng") - 1)).alias("g"), F.pmod("h", "nr").cast("int").alias("r"), F.lit(False).alias("guest"), "hub", "rep", "comp")
    as_guest = rows.where("guest").select("band", "key", F.pmod("h", "ng").cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("r"), "guest", "hub", "rep", "comp")
    tiles = as_member.unionByName(as_guest).join(sigs, "rep").select(*tile, "guest", "hub", "rep", "comp", "sig")
    tiles = tiles.repartition(*tile).sortWithinPartitions(*tile)
    kinds = "band int, key long, g int, r int, guest boolean, hub long, rep long, comp long"
    cand = stages.put(tiles.mapInArrow(_by_tile(_candidates), kinds), "candidates")
    ends = stages.put(cand.select("hub", "rep").distinct(), "ends")
    ends = ends.join(texts.select(F.col("doc_id").alias("hub"), F.col("text").alias("th")), "hub").join(texts.select(F.col("doc_id").alias("rep"), F.col("text").alias("tr")), "rep")
    diffs = stages.put(ends.select("hub", "rep", "th", "tr").mapInArrow(_differences(width), "hub long, rep long, size long, diff array<bigint>"), "differences")
    exact = cand.join(diffs, ["hub", "rep"]).select(*tile, "guest", "rep", "comp", "size", "diff").repartition(*tile).sortWithinPartitions(*tile)
    more = stages.put(exact.mapInArrow(_by_tile(_exact(percent)), "u long, v long"), "across-edges")
    comp = stages.put(connected_components(edges.unionByName(more), stages), "components")
    stages.drop(texts, members, buckets)
    out = sig.join(rep, same, "left").join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
    cid = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", cid.alias("component_id"), F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))


def op9_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2)


OP9_SQL = """
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT r, doc_id, CASE len(w) WHEN 0 THEN []::VARCHAR[][] WHEN 1 THEN [w] ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i:i + 1])) END AS g FROM d),
sizes AS (SELECT r, doc_id, len(g) AS n FROM s),
items AS (SELECT r, unnest(g) AS x FROM s),
both_ AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM items a JOIN items b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
near AS (SELECT a, b FROM both_ JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT r, r AS to_ FROM d UNION SELECT reach.r, b FROM reach JOIN links ON a = to_)
SELECT x.doc_id, x.n AS n_shingles, c AS component_id, x.doc_id = c AS kept
FROM sizes x JOIN (SELECT reach.r, min(y.doc_id) AS c FROM reach JOIN d y ON y.r = to_ GROUP BY reach.r) USING (r)
"""
