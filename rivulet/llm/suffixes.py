"""Repeated passages by a suffix array over sampled suffixes.

A window is WINDOW bytes of a text; it repeats if the same bytes start anywhere else.  Sorting every
suffix would shuffle each byte with its context, so only suffixes at content-chosen places enter the
array: of those starting in a window, the one whose LEAD leading bytes have the least hash.  Equal
windows choose equal places, so each window belongs to exactly one sampled suffix, and windows can
only be equal if their suffixes' leading bytes are.
1. Each text's sampled suffixes are found (about one in 70 bytes) and described by hashes of their
   leading bytes and of all bytes of their windows; equal ones within a task are settled there.
2. Sampled splitters range-partition the suffixes by leading tokens; buckets are sorted and scanned:
   suffixes equal in all their windows repeat as a whole, leading bytes that occur once repeat
   nowhere, and a leading run at a bucket's edge goes on for comparison across the boundary.
3. The rest, one of each kind, is fetched with its bytes and range-partitioned by its leading bytes,
   equal ones together.  Buckets sort by multikey quicksort, to the right of the place and, reversed,
   to the left; common prefixes of neighbours tell for each window whether its bytes occur again.
4. Leading bytes with more than FIT kinds, which no task should hold, are told apart by more of them,
   as a bucket of a sort is by its next characters: each of their suffixes is cut into bands of
   windows, a band leads with the bytes that all its windows share, and steps 2 and 3 are repeated
   with these longer leads.  Bands narrow fourfold each time; one of a single window leads with the
   window itself, so this ends, whatever the data.
5. Spans of repeated windows return to their texts, are merged and cut out.
What is compared in step 3 is compared byte by byte.  Suffixes that are settled as a whole, in step 2,
rest on 128 hash bits and texts on more than 64 (80 for windows of 200 bytes): among 10^10 texts two
are taken for one with a probability of 4e-5, and among 10^12 suffixes two with 1e-15.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .shingles import U, buffers, groups, mix

WINDOW, LEAD = 200, 32
#: Different kinds of suffixes with the same leading bytes that a task compares at once; more get longer leads.
FIT = 20_000
#: Texts that a task remembers, to skip their copies.
SEEN = 1_000_000
CHUNK = 8_000
#: Bytes of a text that are sampled at a time; windows that cross pieces belong to the earlier.
PIECE = 1_000_000
_RNG = np.random.default_rng(np.random.PCG64(90210))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_BASE = 0xD6E8FEB86659FD93


def _pow(e: int) -> np.uint64:
    return U(pow(_BASE, e, 2**64))


def rolling(v: np.ndarray, length: int) -> np.ndarray:
    """Hash of v[i:i + length] for each i that allows it, by doubling; v holds a 64-bit number for each byte."""
    out, done, power, size = None, 0, v, 1
    while True:
        if length & size:
            if out is None:
                out, done = power, size
            else:
                n = len(v) - done - size + 1
                out = out[:n] * _pow(size) + power[done : done + n]
                done += size
        if size * 2 > length:
            return out[: len(v) - length + 1]
        n = len(power) - size
        power = power[:n] * _pow(size) + power[size:]
        size *= 2


def anchors(data: np.ndarray, at: np.ndarray, window: int, lead: int):
    """(text, place, first, last, lead hash): the sampled suffixes of texts data[at[i]:at[i+1]].

    Of the suffixes that start inside a window with room for ``lead`` bytes, the one with the least
    hash of its leading bytes is sampled (the leftmost of equals).  Equal windows sample at equal
    places, so every window belongs to one suffix: [first, last] are the starts of place's windows.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if len(data) < window:
        return none
    h = mix(rolling(_BYTE[data], lead))
    w = window - lead + 1
    x = (h >> U(24) << U(24)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    if size < w:
        x = np.minimum(x[: len(x) - (w - size)], x[w - size :])
    size = np.diff(at)
    long = size >= window
    n = np.where(long, size - window + 1, 0)
    starts = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[:-1], n)
    if not len(starts):
        return none
    text = np.repeat(np.arange(len(size)), n)
    place = (x[starts] & U((1 << 24) - 1)).astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (text[1:] != text[:-1]))
    i = np.flatnonzero(new)
    j = np.append(i[1:], len(starts)) - 1
    return text[i], place[i], starts[i], starts[j], h[place[i]]


_CONTEXT = mix(_BYTE + U(77))
_STEP = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _segments(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], of at most a few hundred bytes each."""
    if len(_powers[0]) <= len(data):
        for i, base in enumerate((_STEP, pow(_STEP, -1, 2**64))):
            _powers[i] = np.cumprod(np.concatenate([[U(1)], np.full(len(data), base, np.uint64)]))
    upto = np.concatenate([[U(0)], np.cumsum(_CONTEXT[data] * _powers[0][: len(data)], dtype=np.uint64)])
    return mix((upto[end] - upto[start]) * _powers[1][start] + (end - start).astype(np.uint64))


def _pieces(data: np.ndarray, at: np.ndarray, window: int):
    """(first text, offset in it, bytes, bounds): texts together in groups, long ones in overlapping pieces."""
    for lo, hi in groups(at, PIECE):
        if at[hi] - at[lo] <= PIECE:
            yield lo, 0, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        else:
            for i in range(lo, hi):
                for s in range(0, max(1, at[i + 1] - at[i] - window + 1), PIECE):
                    part = data[at[i] + s : min(at[i + 1], at[i] + s + PIECE + window - 1)]
                    yield i, s, part, np.array([0, len(part)])


class Layout:
    """A suffix in 64 bits: its place, the bytes of its windows left of it, their number less one, and some bits of the text's second key."""

    def __init__(self, window: int, lead: int):
        self.window, self.lead = window, lead
        self.bits = max(8, (window - lead).bit_length())
        if not 0 < lead <= window or self.bits > 12:
            raise ValueError("a window has at least its lead and at most 4095 bytes more")
        self.key_bits = 32 - 2 * self.bits

    def pack(self, place, left, more, k2):
        return place << 32 | left << 32 - self.bits | more << self.key_bits | k2

    def left(self, p):
        return p >> 32 - self.bits & (1 << self.bits) - 1

    def more(self, p):
        return p >> self.key_bits & (1 << self.bits) - 1

    def k2(self, p):
        return p & (1 << self.key_bits) - 1

    def columns(self) -> tuple[Column, Column, Column]:
        """k2, start and stop of all windows of the suffix p."""
        some = lambda shift, bits: F.shiftright("p", shift).bitwiseAND((1 << bits) - 1)
        start = F.shiftright("p", 32) - some(32 - self.bits, self.bits)
        return some(0, self.key_bits).cast("int").alias("k2"), start.alias("start"), (start + some(self.key_bits, self.bits) + self.window).alias("stop")

    def keys(self) -> list[Column]:
        """The bits of a text's hashes by which texts are told apart."""
        return [F.xxhash64("t").alias("k1"), F.shiftrightunsigned(F.xxhash64(F.lit(19), "t"), 64 - self.key_bits).cast("int").alias("k2")]

    def band(self, p: int, width: int) -> int:
        """Which band of so many windows the suffix's windows are in, counted by the bytes left of its place."""
        return (self.left(p) - self.more(p)) // width

    def core(self, p: int, width: int, text: bytes) -> bytes:
        """The bytes that all windows of a band share; of the widest band: the lead."""
        place, j = p >> 32, self.band(p, width)
        return text[place - j * width : place + self.window - (j + 1) * width + 1]


def _sampled(layout: Layout):
    """(k1, k2, text) -> suffixes (h, c, k1, p, settled): of equal ones in the task one goes on, with settled false if it is alone.

    Rows with h null are spans that are settled here: they repeat within the task.  Texts that the
    task has seen are skipped; that they are copies is counted elsewhere.
    """

    window, lead = layout.window, layout.lead

    def run(batches):
        import pyarrow as pa

        seen_texts: set[tuple[int, int]] = set()
        held: list[list[np.ndarray]] = []

        def out():
            h, c, k, p = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
            held.clear()
            order = np.lexsort((p, k, c, h))
            h, c, k, p = h[order], c[order], k[order], p[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
            twice = ~np.append(new[1:], True) | ~new if len(h) else new
            more = ~new
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([h[new], h[more]]).view(np.int64), mask=np.concatenate([np.zeros(new.sum(), bool), np.ones(more.sum(), bool)])),
                 *(pa.array(np.concatenate([x[new], x[more]])) for x in (c.view(np.int64), k, p, twice))],
                ["h", "c", "k1", "p", "settled"],
            )

        n = 0
        for batch in batches:
            k1, k2 = (np.asarray(batch.column(i)) for i in (0, 1))
            fresh = np.zeros(len(batch), bool)
            for i, key in enumerate(zip(k1.tolist(), k2.tolist(), strict=True)):
                fresh[i] = key not in seen_texts
                seen_texts.add(key)
            if len(seen_texts) > SEEN:  # copies that are not skipped are found like any repeat
                seen_texts.clear()
            rows = np.flatnonzero(fresh)
            data, at = buffers(batch.column(2).filter(pa.array(fresh)))
            for first, offset, part, bounds in _pieces(data, at, window):
                text, place, lo, hi, h = anchors(part, bounds, window, lead)
                if not len(place):
                    continue
                c = _segments(part, lo, hi + window) + mix((place - lo).astype(np.uint64))
                row = rows[first + text]
                p = layout.pack(place - bounds[text] + offset, place - lo, hi - lo, k2[row].astype(np.int64))
                held.append([h, c, k1[row], p])
                n += len(p)
                if n > 400_000:
                    yield out()
                    n = 0
        yield out()

    return run


def _scanned(batches):
    """Suffixes sorted by (h, c) -> settled spans (k1, p) and those to compare (h, k1, p, settled).

    Output: h null for a span that is settled, else a suffix to compare.  One row of each run is held
    back, so runs may be of any length.
    """
    import pyarrow as pa

    names = ["h", "k1", "p", "settled"]

    def rows(x):
        return pa.RecordBatch.from_arrays([pa.array([a for a, *_ in x], pa.int64()), pa.array([b for _, b, *_ in x], pa.int64()), pa.array([c for _, _, c, _ in x], pa.int64()), pa.array([d for *_, d in x], pa.bool_())], names)

    first_h, last = None, None  # last: (h, c, k1, p, settled, h has other kinds)
    for batch in batches:
        if not len(batch):
            continue
        h, c, k, p, s = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(5))
        s = s.astype(bool)
        if last is not None:  # the row held back goes first again
            h, c, k, p, s = (np.concatenate([[v], x]) for v, x in zip(last[:5], (h, c, k, p, s), strict=True))
        other_before = last[5] if last is not None else True  # the partition's first run may go on from the one before
        n = len(h)
        new_h = np.append(True, h[1:] != h[:-1])
        new = new_h | np.append(True, c[1:] != c[:-1])
        run = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        size = np.diff(np.append(heads, n))
        settled = np.logical_or.reduceat(s, heads) | (size > 1)
        group = (np.cumsum(new_h) - 1)[heads]
        kinds = np.bincount(group)
        several = (kinds > 1)[group]
        several |= (group == 0) & other_before
        # the last run is open: all rows but its head leave now, the head waits
        open_head = heads[-1]
        spans = settled[run]
        spans[open_head] = False
        compare = np.zeros(n, bool)
        compare[heads[:-1]] = several[:-1]
        out = np.concatenate([np.flatnonzero(spans), np.flatnonzero(compare)])
        null = np.concatenate([np.ones(spans.sum(), bool), np.zeros(compare.sum(), bool)])
        yield pa.RecordBatch.from_arrays([pa.array(h[out], mask=null), pa.array(k[out]), pa.array(p[out]), pa.array(settled[run[out]])], names)
        last = (h[open_head], c[open_head], k[open_head], p[open_head], bool(settled[-1]), bool(several[-1]))
    if last is not None:  # the partition's last run may go on in the next
        x = [(int(last[0]), int(last[2]), int(last[3]), last[4])]
        if last[4]:
            x.append((None, int(last[2]), int(last[3]), True))
        yield rows(x)


def _squeezed(batches):
    """(k1, k2, id, text) -> the same with the text compressed, for shuffling."""
    import pyarrow as pa
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, at = buffers(batch.column(3))
        packed = [z.compress(data[at[i] : at[i + 1]].tobytes()) for i in range(len(batch))]
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), pa.array(packed, pa.binary())], ["k1", "k2", "doc_id", "z"])


def _fetched(layout: Layout, width: int):
    """(k1, z, suffixes) -> a row for each: lead (the bytes that its band shares), k1, p, settled, bytes of all its windows."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        z = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k, packed, suffixes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = z.decompress(packed)
                for s in suffixes:
                    p = s["p"]
                    start = (p >> 32) - layout.left(p)
                    for x, v in zip(out, (layout.core(p, width, text), k, p, s["settled"], text[start : start + layout.more(p) + layout.window]), strict=True):
                        x.append(v)
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["lead", "k1", "p", "settled", "t"])

    return run


def _banded(layout: Layout, width: int):
    """(k1, z, suffixes) -> the suffixes cut into bands of ``width`` windows: h (hash of the bytes that a band shares), c (of all its bytes), k1, p, settled."""

    def run(batches):
        import pyarrow as pa
        import xxhash
        import zstandard

        z = zstandard.ZstdDecompressor()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for k, packed, suffixes in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                text = z.decompress(packed)
                for s in suffixes:
                    p = s["p"]
                    place, last = p >> 32, layout.left(p)
                    first = last - layout.more(p)
                    for j in range(first // width, last // width + 1):
                        lo, hi = max(first, j * width), min(last, (j + 1) * width - 1)
                        q = layout.pack(place, hi, hi - lo, layout.k2(p))
                        h = xxhash.xxh3_64_intdigest(layout.core(q, width, text), seed=j)
                        c = xxhash.xxh3_64_intdigest(text[place - hi : place - lo + layout.window], seed=lo << 12 | hi)
                        for x, v in zip(out, (h - (h >> 63 << 64), c - (c >> 63 << 64), k, q, s["settled"]), strict=True):
                            x.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], ["h", "c", "k1", "p", "settled"])

    return run


def multikey_sort(words: np.ndarray) -> np.ndarray:
    """Order of the rows of ``words`` (big-endian bytes as numbers): multikey quicksort.

    Each round splits the groups of rows that are still equal by their next word; rows that are alone
    in their group take no further part.
    """
    order, group = np.arange(len(words)), np.zeros(len(words), np.int64)
    tied = np.arange(len(words))
    for d in range(words.shape[1]):
        if not len(tied):
            break
        rows, g = order[tied], group[tied]
        i = np.lexsort((words[rows, d], g))
        rows = rows[i]
        order[tied] = rows
        key = words[rows, d]
        new = np.append(True, (key[1:] != key[:-1]) | (g[1:] != g[:-1]))
        group[tied] = tied[np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))]
        alone = new & np.append(new[1:], True)
        tied = tied[~alone]
    return order


def _ranked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common prefix with the row before) of byte rows."""
    words = np.ascontiguousarray(np.pad(x, ((0, 0), (0, -x.shape[1] % 8)))).view(">u8").astype(np.uint64)
    order = multikey_sort(words)
    y = x[order]
    unlike = y[1:] != y[:-1]
    common = np.where(unlike.any(1), unlike.argmax(1), x.shape[1])
    return order, np.append(0, common)


def repeated(left: np.ndarray, more: np.ndarray, texts: list[bytes], window: int) -> np.ndarray:
    """(row, o): whether the window o bytes left of each suffix's place occurs in another row too."""
    m, span = len(left), window
    right = np.zeros((m, span), np.uint8)
    back = np.zeros((m, span), np.uint8)
    size = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    base = np.cumsum(size) - size
    j = np.arange(span, dtype=np.int32)
    for a in range(0, m, 4096):  # a few rows at a time: the indices are larger than the bytes
        r = slice(a, a + 4096)
        ok = j[None, :] < np.minimum(size[r] - left[r], span)[:, None]
        right[r][ok] = flat[((base[r] + left[r])[:, None] + j)[ok]]
        ok = j[None, :] < left[r][:, None]
        back[r][ok] = flat[((base[r] + left[r] - 1)[:, None] - j)[ok]]
    (ro, rc), (lo, lc) = _ranked(right), _ranked(back)
    flags = np.zeros((m, int(left.max()) + 1 if m else 1), bool)
    gr, gl = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(flags.shape[1]):
        rows = np.flatnonzero((o <= left) & (o >= left - more))
        if len(rows) < 2:
            continue
        gr[ro] = np.cumsum(rc < window - o)
        gl[lo] = np.cumsum(lc < o)
        key = gr[rows] * (m + 1) + gl[rows]
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        flags[rows[order], o] = np.append(False, same) | np.append(same, False)
    return flags


def _compared(layout: Layout):
    """Rows sorted by lead (lead, k1, p, settled, t) -> spans (k1, k2, start, stop) of windows that occur again."""

    def work(rows):
        import pyarrow as pa

        k, p, settled, t = (sum((r[i] for r in rows), []) for i in range(4))
        k, p, settled = np.array(k, np.int64), np.array(p, np.int64), np.array(settled, bool)
        _, one = np.unique(np.stack([k, p], 1), axis=0, return_index=True)  # boundary runs may arrive twice
        k, p, settled = k[one], p[one], settled[one]
        flags = repeated(layout.left(p), layout.more(p), [t[i] for i in one], layout.window)
        flags[settled] = False
        edge = np.diff(np.pad(flags, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        row, first = np.nonzero(edge == 1)
        _, after = np.nonzero(edge == -1)
        place = p[row] >> 32
        return pa.RecordBatch.from_arrays([pa.array(k[row]), pa.array(layout.k2(p[row]).astype(np.int32)), pa.array(place - (after - 1)), pa.array(place - first + layout.window)], ["k1", "k2", "start", "stop"])

    def run(batches):
        held, n, last = [], 0, None
        for batch in batches:
            leads = batch.column(0).to_pylist()
            cols = [batch.column(i).to_pylist() for i in range(1, 5)]
            lo = 0
            for i in range(len(leads)):
                if leads[i] != last and n + i - lo >= CHUNK:  # only between leads
                    held.append([c[lo:i] for c in cols])
                    yield work(held)
                    held, n, lo = [], 0, i
                last = leads[i]
            held.append([c[lo:] for c in cols])
            n += len(leads) - lo
        if n:
            yield work(held)

    return run


def _whole(text: bytes, spans: list[tuple[int, int]]) -> str:
    """text without the spans, each widened to whole characters."""
    rest, at = [], 0
    for a, b in spans:
        while a > at and text[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        rest.append(text[at:a])
        at = b
    rest.append(text[at:])
    return b"".join(rest).decode("utf-8", "replace")


def _cut(carry_text: bool):
    """(id, z, spans) -> id, n_bytes, n_removed, n_spans, kept_sha256 (and the remaining text)."""

    def run(batches):
        import pyarrow as pa
        import zstandard

        z = zstandard.ZstdDecompressor()
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * carry_text
        for batch in batches:
            out: list[list] = [[] for _ in names[1:]]
            lists = batch.column(2)
            for i, packed in enumerate(batch.column(1).to_pylist()):
                text, spans = z.decompress(packed), []
                for a, b in sorted((s["start"], min(s["stop"], len(text))) for s in lists[i].as_py() or ()) if lists[i].is_valid else ():
                    if spans and a <= spans[-1][1]:  # adjacent runs are one
                        spans[-1] = spans[-1][0], max(b, spans[-1][1])
                    else:
                        spans.append((a, b))
                edges = [0, *(x for s in spans for x in s), len(text)]
                digest = hashlib.sha256()
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    digest.update(text[a:b])
                values = [len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest()] + [_whole(text, spans)] * carry_text
                for x, v in zip(out, values, strict=True):
                    x.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()] + [pa.string()] * carry_text
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(out, kinds, strict=True))], names)

    return run


def repeated_spans(docs: DataFrame, stages: Stages, layout: Layout, fit: int = FIT) -> DataFrame:
    """(k1, k2, spans): the spans of repeated windows of each text (docs: t, k1, k2) that has any."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k2, start, stop = layout.columns()
    kinds = "h long, c long, k1 long, p long, settled boolean"
    long = docs.where(F.octet_length("t") >= layout.window)
    copies = long.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("t")).alias("stop")).where("n > 1")
    parts = [copies.select("k1", "k2", F.lit(0).cast("long").alias("start"), F.col("stop").cast("long"))]
    texts = docs.select("k1", "k2", F.lit(None).cast("long").alias("doc_id"), "t").mapInArrow(_squeezed, "k1 long, k2 int, doc_id long, z binary").dropDuplicates(["k1", "k2"]).select("k1", "k2", "z")
    found = stages.put(long.select("k1", "k2", "t").mapInArrow(_sampled(layout), kinds), "suffixes")
    #: settled within a task: the repeats, and the one that went on
    parts += [found.where("h is null").select("k1", k2, start, stop), found.where("h is not null and settled").select("k1", k2, start, stop)]
    width = layout.window - layout.lead + 1
    while True:
        order = found.where("h is not null").repartitionByRange(partitions, "h", "c").sortWithinPartitions("h", "c")
        scanned = stages.put(order.mapInArrow(_scanned, "h long, k1 long, p long, settled boolean"), "scanned")
        parts.append(scanned.where("h is null").select("k1", k2, start, stop))
        compare = scanned.where("h is not null")
        count = compare.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        compare = stages.put(compare.join(stages.put(count, "leads"), "h"), "compare")
        some = lambda c: F.collect_set(F.when(c, F.struct("p", "settled")))
        wanted = compare.groupBy("k1", k2).agg(some(F.col("n") <= fit).alias("suffixes"), some(F.col("n") > fit).alias("crowded"))
        texts = texts.join(stages.put(wanted, "wanted"), ["k1", "k2"])
        more = not compare.where(F.col("n") > fit).isEmpty()
        if more:
            texts = stages.put(texts, "texts")
        rows = texts.where(F.size("suffixes") > 0).select("k1", "z", "suffixes").mapInArrow(_fetched(layout, width), "lead binary, k1 long, p long, settled boolean, t binary")
        buckets = stages.put(rows, "bytes").repartitionByRange(partitions, "lead").sortWithinPartitions("lead")
        parts.append(buckets.mapInArrow(_compared(layout), "k1 long, k2 int, start long, stop long"))
        if not more:
            break
        width = -(-width // 4)
        texts = texts.where(F.size("crowded") > 0)
        found = stages.put(texts.select("k1", "z", "crowded").mapInArrow(_banded(layout, width), kinds), "bands")
        texts = texts.select("k1", "k2", "z")
    spans = parts[0]
    for x in parts[1:]:
        spans = spans.unionByName(x)
    return stages.put(spans.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW, lead: int = LEAD, fit: int = FIT, carry_text: bool = False, key: Column | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (carry_text: kept, the remaining text), one row for each row of docs.

    key: what to return as doc_id, for example a struct of columns to carry.

    kept: a character of which a byte is removed goes as a whole, so kept may have fewer bytes than
    kept_sha256 was taken of; bytes of a text that are no UTF-8 become replacement characters in it.

    Every byte of a text (UTF-8) that is covered by ``window`` bytes which also start anywhere else,
    in the same or another row, is removed; overlaps count, and all is judged on the input.  docs
    needs doc_id and text; other columns are ignored.  Null text: empty.  Null doc_id and repeated
    rows: rows of their own, so the texts of repeated rows are removed if they have ``window`` bytes.
    Shorter texts stay whole.  Empty table: no rows.  A window of more than ``lead`` + 4095 bytes is a
    ValueError.
    """
    stages = Stages(docs.sparkSession, "suffixes")
    d = docs.select((F.col("doc_id") if key is None else key).alias("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    kind = d.schema["doc_id"].dataType.simpleString()
    layout = Layout(window, lead)
    d = d.select("doc_id", "t", *layout.keys())
    spans = repeated_spans(d, stages, layout, fit)
    z = d.select("k1", "k2", "doc_id", "t").mapInArrow(_squeezed, f"k1 long, k2 int, doc_id {kind}, z binary")
    out = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * carry_text
    return z.join(spans, ["k1", "k2"], "left").select("doc_id", "z", "spans").mapInArrow(_cut(carry_text), out)


def op4_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP4_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
pieces AS (SELECT r, p, len(x) // 2 - 199 - 250 * p AS n, substr(x, 500 * p + 1, 898) AS x FROM (SELECT r, x, unnest(range((len(x) // 2 + 50) // 250)) AS p FROM d WHERE len(x) >= 400)),
windows AS (SELECT r, 250 * p + i AS i, md5_number(substr(x, 2 * i + 1, 400)) AS w FROM (SELECT r, p, x, unnest(range(least(250, n))) AS i FROM pieces)),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
starts AS (SELECT r, i FROM windows SEMI JOIN twice USING (w)),
runs AS (SELECT r, i, sum(CASE WHEN i > before + 200 OR before IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run
  FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM starts)),
spans AS (SELECT r, run, min(i) AS a, max(i) + 200 AS b FROM runs GROUP BY r, run),
gaps AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS lo, a AS hi FROM spans
  UNION ALL SELECT d.r, coalesce(b, 0), len(x) // 2 FROM d LEFT JOIN (SELECT r, max(b) AS b FROM spans GROUP BY r) USING (r)),
kept AS (SELECT g.r, string_agg(substr(x, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo) AS k FROM gaps g JOIN d ON d.r = g.r GROUP BY g.r)
SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN (SELECT r, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY r) USING (r)
"""
