"""Best-fit packing by a configuration linear program over the length histogram.

1. Texts become pieces of at most CAPACITY tokens (whole texts, ids from the named tokenizer, 0 at
   the end); only longer ones are cut.
2. The histogram of piece lengths, CAPACITY numbers however large the corpus, goes to the driver.
   The covering program "fewest sequences such that every length is covered" has one variable for
   each configuration (multiset of lengths that fits); multiplicative weights on the lengths are the
   prices, and a knapsack by dynamic programming over the capacity finds the configurations of
   (nearly) greatest price, many for each table.
3. Rounding: configurations are taken whole, in order of their weight, while the histogram has their
   pieces; what remains, few pieces of each length, is packed best-fit decreasing, by length groups.
4. Pieces are ranked within their length by salted counts and prefix sums (no sort of a length in
   one task) and look up their place by rank.
"""

from __future__ import annotations

import functools
import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .shingles import buffers, groups

CAPACITY = 2048
#: Pieces of one length that a task ranks.
RANKED = 100_000
ROUNDS, COLUMNS, STEP = 150, 64, 0.25
_SPECIAL = (b"<|startoftext|>", b"<|endoftext|>")


#: Letters of ASCII and Latin-1, and ASCII marks but the apostrophe after them: one or two pieces for the tokenizer, whatever is around.
_LETTERS = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)")
#: Lower case of those letters' bytes, and the three of the bytes that byte-level vocabularies write as other characters.
_LOWER = bytes(b + 32 if 65 <= b <= 90 or 0x80 <= b <= 0x9E else b for b in range(256))
_ALPHABET = tuple((chr(b), chr(256 + sum(not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174) for x in range(b)))) for b in (0x9F, 0xA0, 0xAD))


class WordTokens:
    """Ids of whole texts as little-endian uint32 bytes.

    The tokenizer splits at white space and each word's ids do not depend on its neighbours, so words
    are encoded once and kept: words of the last ``most`` new ones, and those met again since.  Words
    of plain letters are encoded many at a time as one text; their ids part at the ids that end a
    word.  Texts with the strings of special tokens go to the tokenizer whole.
    """

    def __init__(self, path: str, most: int = 600_000, special_as_text: bool = False):
        from tokenizers import Tokenizer, pre_tokenizers

        self.t, self.most = Tokenizer.from_file(path), most
        self.words = Tokenizer(self.t.model)  # for words of plain letters, which come in the model's own alphabet
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.t.encode_special_tokens = special_as_text
        self.special = () if special_as_text else _SPECIAL
        vocab = self.t.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for x, i in vocab.items() if x.endswith("</w>")]] = True

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        got = self.t.encode_batch_fast([x.decode("utf-8", "replace") for x in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _learn(self, new: list[bytes]) -> None:
        words, cores, tails, odd = [], [], [], []
        for w in new:
            if m := _LETTERS.fullmatch(w):
                words.append(w)
                cores.append(m[1])
                tails.append(m[2] and self._mark(m[2]))
            else:
                odd.append(w)
        self.known.update(zip(odd, self._encode(odd), strict=True))
        for i in range(0, len(cores), 2000):
            part = cores[i : i + 2000]
            text = b" ".join(part).translate(_LOWER).decode("latin-1")
            for a, b in _ALPHABET:
                text = text.replace(a, b)
            data = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()
            cuts = 4 * np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 4
            if len(cuts) != len(part):
                raise ValueError("the tokenizer does not end each word of letters once")
            hi = cuts.tolist()
            ids = [data[a:b] + t for a, b, t in zip([0, *hi[:-1]], hi, tails[i : i + 2000], strict=True)]
            self.known.update(zip(words[i : i + 2000], ids, strict=True))

    def _mark(self, mark: bytes) -> bytes:
        if (x := self.known.get(mark) or self.before.get(mark)) is None:
            x = self._encode([mark])[0]
        self.known[mark] = x
        return x

    def rest(self) -> None:
        """Between tasks only a small memory stays."""
        self.before = {}
        if len(self.known) > self.most // 4:
            self.known = {}

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        words = [None if any(s in t for s in self.special) else t.split() for t in texts]
        known, before = self.known, self.before
        new: set[bytes] = set()
        for ws in words:
            if ws is not None:
                new.update(ws)
        new.difference_update(known)
        old = new.intersection(before)
        known.update((w, before[w]) for w in old)
        new -= old
        if new:
            self._learn(list(new))
        get = known.__getitem__
        out = [self._encode([t])[0] if ws is None else b"".join(map(get, ws)) for t, ws in zip(texts, words, strict=True)]
        if len(known) > self.most:
            self.before, self.known = known, {}
        return out


def token_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def shared_tokens(path: str, special_as_text: bool = False) -> WordTokens:
    """One WordTokens for the tasks of a worker process: loading a vocabulary takes longer than a small task."""
    return WordTokens(path, special_as_text=special_as_text)


def _each(tokens: WordTokens, data: np.ndarray, at: np.ndarray):
    """(row, ids) of each text data[at[i]:at[i+1]]."""
    for lo, hi in groups(at):
        yield from zip(range(lo, hi), tokens([data[at[i] : at[i + 1]].tobytes() for i in range(lo, hi)]), strict=True)


def _pieces(path: str, capacity: int):
    def run(batches):
        import os

        import pyarrow as pa

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = shared_tokens(path)
        for batch in batches:
            data, at = buffers(batch.column(1))
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in _each(tokens, data, at):
                ids = memoryview(text + b"\0\0\0\0")
                for k, s in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * s : 4 * (s + capacity)]
                    row.append(i)
                    piece.append(k)
                    start.append(s)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        tokens.rest()

    return run


def _knapsack(value: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(best value, last item or 0) for each capacity; value[l] is of an item of length l, repeats allowed."""
    best, item = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    top = len(value) - 1
    for c in range(1, capacity + 1):
        m = min(c, top)
        v = value[1 : m + 1] + best[c - m : c][::-1]
        j = int(v.argmax())
        if v[j] > best[c - 1]:
            best[c], item[c] = v[j], j + 1
        else:
            best[c] = best[c - 1]
    return best, item


def configuration_program(n: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Fractional configurations {((length, times), ...): weight} covering n[l] pieces of each length l < capacity."""
    lengths = np.flatnonzero(n)
    x: dict[tuple, float] = {}
    if not len(lengths):
        return x
    log_w, covered = np.zeros(len(n)), np.zeros(len(n))
    for _ in range(rounds):
        value = np.zeros(len(n))
        value[lengths] = np.exp(log_w[lengths] - log_w[lengths].max()) / n[lengths]
        best, item = _knapsack(value, capacity)
        through = value[lengths] + best[capacity - lengths]  # the best configuration that holds each length
        order = np.argsort(-through, kind="stable")
        order = order[through[order] >= (1 - STEP) * through[order[0]]][: 8 * COLUMNS]
        for first in lengths[order[:: max(1, len(order) // COLUMNS)]]:
            config: dict[int, int] = {int(first): 1}
            c = capacity - int(first)
            while c > 0:
                l = int(item[c])
                if l and config.get(l, 0) < n[l]:
                    config[l] = config.get(l, 0) + 1
                c -= l or 1
            a = np.array(sorted(config.items()))
            step = STEP * (n[a[:, 0]] / a[:, 1]).min()
            key = tuple(map(tuple, a.tolist()))
            x[key] = x.get(key, 0.0) + step
            covered[a[:, 0]] += step * a[:, 1]
            log_w[a[:, 0]] -= step * a[:, 1] / n[a[:, 0]]
    scale = np.median(covered[lengths] / n[lengths]) or 1.0
    return {c: v / scale for c, v in x.items()}


def best_fit_decreasing(n: np.ndarray, capacity: int = CAPACITY) -> dict[tuple, int]:
    """{configuration: sequences} by best fit decreasing; equal lengths move together."""
    bins: dict[int, dict[tuple, int]] = {}
    for l in range(capacity, 0, -1):
        left = int(n[l]) if l < len(n) else 0
        for space in sorted(s for s in bins if s >= l):
            now = space
            while left and now >= l and bins.get(now):  # groups that take one piece may take another, as now the best fit
                config, count = next(iter(bins[now].items()))
                take = min(left, count)
                if take == count:
                    del bins[now][config]
                else:
                    bins[now][config] = count - take
                last = config[-1] if config and config[-1][0] == l else (l, 0)
                new = (config[:-1] if last[1] else config) + ((l, last[1] + 1),)
                group = bins.setdefault(now - l, {})
                group[new] = group.get(new, 0) + take
                left -= take
                if now - l >= l:
                    now -= l
                elif not bins.get(now):
                    now = space
        fits = capacity // l
        if left:
            for times, count in ((fits, left // fits), (left % fits, 1)):
                if times and count:
                    group = bins.setdefault(capacity - times * l, {})
                    group[((l, times),)] = group.get(((l, times),), 0) + count
        bins = {s: g for s, g in bins.items() if g}
    out: dict[tuple, int] = {}
    for g in bins.values():
        for c, k in g.items():
            out[c] = out.get(c, 0) + k
    return out


def pack_lengths(n: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple, int]]:
    """[(configuration, sequences)] that hold exactly n[l] pieces of each length l (0 to capacity).

    The program's weights are rounded down at several shares of their size, the rest of each is
    packed best-fit decreasing, and the rounding with the fewest sequences stays: short pieces that
    whole configurations would use up may be worth more as fillers of what rounding leaves.
    """
    n = np.array(n, np.int64)
    program = configuration_program(n[:capacity], capacity)
    fill = lambda c: sum(l * t for l, t in c)
    order = sorted(program.items(), key=lambda x: (-x[0][-1][0], -fill(x[0]), -x[1], x[0]))  # the longest pieces first
    best: dict[tuple, int] | None = None
    for share in (1.0, 0.9, 0.75, 0.5, 0.25, 0.1):
        out: dict[tuple, int] = {}
        if n[capacity]:
            out[((capacity, 1),)] = int(n[capacity])
        left = n.copy()
        left[capacity] = 0
        for config, weight in order:
            times = min(int(share * weight + 0.5), *(int(left[l]) // t for l, t in config), int(left.sum()))
            if times > 0 and fill(config) >= capacity - 2:
                out[config] = out.get(config, 0) + times
                for l, t in config:
                    left[l] -= times * t
        for config, times in best_fit_decreasing(left, capacity).items():
            config = tuple(sorted(config))
            out[config] = out.get(config, 0) + times
        if best is None or sum(out.values()) < sum(best.values()):
            best = out
    return sorted(best.items())


def _slots(packed: list[tuple[tuple, int]]) -> tuple[np.ndarray, ...]:
    """For each length and configuration: key (length << 40 | first rank), times, first sequence, offset; sorted by key."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for config, count in packed:
        offset = 0
        for l, times in sorted(config, reverse=True):
            rows.append((l << 40 | rank.get(l, 0), times, base, offset))
            rank[l] = rank.get(l, 0) + times * count
            offset += l * times
        base += count
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return tuple(a[:, i].copy() for i in range(4))


def _placed(slots):
    key, times, base, offset = slots

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in (3, 5))
            k = np.searchsorted(key, length << 40 | rank, "right") - 1
            j = rank - (key[k] & ((1 << 40) - 1))
            seq, at = base[k] + j // times[k], offset[k] + (j % times[k]) * length
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), pa.array(seq), pa.array(at)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset, one row for each piece of each row of docs.

    docs needs doc_id and text; other columns are ignored.  Null and empty texts are the one token 0.
    Null doc_id: packed like any.  Repeated rows are packed each; equal rows are interchangeable.
    Empty table: no rows.
    """
    stages = Stages(docs.sparkSession, "packing")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = docs.select("doc_id", "text").mapInArrow(_pieces(path or token_path(), capacity), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")
    cut = stages.put(cut, "pieces")
    counts = dict(cut.groupBy("length").count().collect())  # at most ``capacity`` rows
    n = np.zeros(capacity + 1, np.int64)
    for l, k in counts.items():
        n[l] = k
    slots = _slots(pack_lengths(n, capacity))
    # as many salts as a length has RANKED pieces: a row for each length, at most ``capacity``
    salts = docs.sparkSession.createDataFrame([(l, math.ceil(k / RANKED)) for l, k in counts.items()], "length long, salts long")
    cut = cut.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "salts")).drop("salts")
    before = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("k"))
    before = stages.put(before.selectExpr("length", "salt", "sum(k) over (partition by length order by salt) - k as before"), "ranks")
    ranked = cut.selectExpr("*", "row_number() over (partition by length, salt order by doc_id, piece, start, ids_crc32) - 1 as r").join(before, ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("r") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_placed(slots), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op5_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
