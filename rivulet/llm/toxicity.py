"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression.

Fit, on a bounded sample of the labelled training rows (``max_fit_rows`` with the smallest hashes):
  - lexicons: words and five-letter word beginnings that toxic texts hold far more often, counted by
    document over the whole sample in Spark, in two folds, so that the features of a training row
    come from a lexicon that has not seen its fold;
  - trees: logistic loss, histogram splits; the calibration is fitted on out-of-fold margins.
Score, every document once: features over the whole text, trees, calibration.
The model (lexicons, which hold no more than the units of the sample, and trees) is as bounded as the
sample and goes with the task.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stages
from .shingles import buffers

MAX_FIT_ROWS = 100_000
CUTOFF = 0.3
#: Second-person pronouns of the corpus's languages.
SECOND = frozenset("you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine euch euer ihr ihre tú ti usted ustedes vosotros su sus".split())
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»“”‘’…¿¡"
_PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})
HIT, START, YOU, CAPS, ODD, HIDDEN = 1, 2, 4, 8, 16, 32
FEATURES = (
    "log_words", "hit_rate", "log_hits", "start_rate", "log_starts", "start_share", "hidden_rate", "you_rate", "near_you", "near_rate",
    "densest", "caps_words", "upper", "exclaim", "question", "punctuation", "digits", "odd_words",
)


def plain(word: str) -> tuple[str, bool]:
    """(folded word without outer punctuation and common disguises, whether a disguise was undone)."""
    w = word.strip(_EDGE).lower()
    if w.isalpha():
        return w, False
    p = w.translate(_PLAIN)
    return p, p != w and any(c.isalpha() for c in w)


def units(word: str) -> list[str]:
    p, _ = plain(word)
    return [p, p[:5] + "*"] if len(p) > 5 else [p]


def _counted(batches):
    """(text, toxic, fold) -> (unit, p0, n0, p1, n1): documents with the unit by fold and label."""
    import pyarrow as pa

    def out(counts):
        keys = list(counts)
        v = np.array([counts[k] for k in keys], np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array(v[:, i]) for i in range(4))], ["unit", "p0", "n0", "p1", "n1"])

    counts: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
    known: dict[str, list[str]] = {}
    for batch in batches:
        for text, toxic, fold in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            at, seen = 2 * fold + 1 - toxic, set()
            for w in set(_WORD.findall(text or "")):
                if (u := known.get(w)) is None:
                    u = known[w] = units(w)
                seen.update(u)
            for x in seen:
                counts[x][at] += 1
            if len(counts) > 150_000:
                yield out(counts)
                counts.clear()
            if len(known) > 150_000:
                known.clear()
    yield out(counts)


class _Codes(dict):
    """word -> bits, kept for words seen before; emptied when it grows large."""

    def __init__(self, lexicon: frozenset):
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        p, undone = plain(word)
        bits = HIT * (p in self.lexicon) | START * (len(p) > 5 and p[:5] + "*" in self.lexicon) | YOU * (p in SECOND) | CAPS * (len(p) > 1 and word.isupper()) | ODD * undone
        if undone and bits & (HIT | START):
            bits |= HIDDEN
        if len(self) > 300_000:
            self.clear()
        self[word] = bits
        return bits


def _classes() -> np.ndarray:
    t = np.zeros((256, 5), np.int32)
    t[65:91, 0] = 1
    t[ord("!"), 1] = t[ord("?"), 2] = 1
    t[[c for c in range(33, 127) if not chr(c).isalnum()], 3] = 1
    t[48:58, 4] = 1
    return t


_CLASS = _classes()


def features(column, codes: _Codes) -> np.ndarray:
    """(texts, FEATURES) over whole texts; null and empty texts have zeros."""
    data, at = buffers(column)
    x = np.zeros((len(at) - 1, len(FEATURES)))
    for i in range(len(x)):
        piece = data[at[i] : at[i + 1]]
        words = _WORD.findall(piece.tobytes().decode("utf-8", "replace"))
        n = len(words)
        if not n:
            continue
        c = np.fromiter((codes[w] for w in words), np.uint8, n)
        hit = np.flatnonzero(c & (HIT | START))
        whole, start, you = (np.count_nonzero(c & b) for b in (HIT, START, YOU))
        near = densest = 0
        if len(hit):
            near = 0
            if you:
                where = np.flatnonzero(c & YOU)
                k = np.searchsorted(where, hit)
                gap = np.minimum(np.abs(hit - where[np.minimum(k, len(where) - 1)]), np.abs(hit - where[np.maximum(k - 1, 0)]))
                near = np.count_nonzero(gap <= 5)
            densest = int((np.searchsorted(hit, hit + 50) - np.arange(len(hit))).max())
        byte = np.bincount(piece, minlength=256) @ _CLASS
        x[i] = (
            np.log1p(n), 100 * whole / n, np.log1p(whole), 100 * start / n, np.log1p(start), start / max(1, len(hit)), 100 * np.count_nonzero(c & HIDDEN) / n,
            100 * you / n, np.log1p(near), 100 * near / n, densest, 100 * np.count_nonzero(c & CAPS) / n, *(100 * byte / len(piece)), 100 * np.count_nonzero(c & ODD) / n,
        )
    return x


class Trees:
    """Gradient-boosted trees for the logistic loss, of depth ``depth``, over at most 64 bins a feature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 100, depth: int = 3, rate: float = 0.1, least: float = 3.0, ridge: float = 1.0):
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 65)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
        self.depth, self.trees = depth, []
        share = min(max(y.mean() if len(y) else 0.0, 1e-4), 1 - 1e-4)
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return
        b = self._bins(x)
        f = np.full(len(y), self.base)
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-f))
            g, h = p - y, p * (1 - p)
            node, tree = np.zeros(len(y), np.int64), []
            for level in range(depth):
                n = 1 << level
                best = np.zeros(n), np.zeros(n, np.int64), np.full(n, 64, np.int64)
                for j in range(x.shape[1]):
                    k = node * 64 + b[:, j]
                    gs = np.bincount(k, g, n * 64).reshape(n, 64).cumsum(1)
                    hs = np.bincount(k, h, n * 64).reshape(n, 64).cumsum(1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + ridge) + (gt - gs) ** 2 / (ht - hs + ridge) - gt**2 / (ht + ridge)
                    gain[(hs < least) | (ht - hs < least)] = 0
                    at = gain.argmax(1)
                    top = gain[np.arange(n), at]
                    better = top > best[0] + 1e-9
                    for a, v in zip(best, (top, np.full(n, j), at), strict=True):
                        a[better] = v[better]
                tree.append((best[1], best[2]))
                node = 2 * node + (b[np.arange(len(y)), best[1][node]] > best[2][node])
            leaf = -rate * np.bincount(node, g, 1 << depth) / (np.bincount(node, h, 1 << depth) + ridge)
            self.trees.append((tree, leaf))
            f += leaf[node]

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(self.edges)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b, f, row = self._bins(x), np.full(len(x), self.base), np.arange(len(x))
        for tree, leaf in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in tree:
                node = 2 * node + (b[row, feature[node]] > cut[node])
            f += leaf[node]
        return f


class Isotonic:
    """The nondecreasing step function nearest to y by x (pool adjacent violators), joined linearly."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        order = np.argsort(x, kind="stable")
        pools: list[list[float]] = []
        for a, v in zip(x[order], y[order], strict=True):
            pools.append([v, 1.0, a, a])
            while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
                v2, n2, _, hi = pools.pop()
                v1, n1, lo, _ = pools.pop()
                pools.append([(v1 * n1 + v2 * n2) / (n1 + n2), n1 + n2, lo, hi])
        self.x = np.array([z for p in pools for z in (p[2], p[3])] or [0.0])
        self.y = np.array([p[0] for p in pools for _ in (0, 1)] or [0.0])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(x, self.x, self.y), 0.0, 1.0)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4; 0 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4, F.lit(0))


def _lexicon(counts: DataFrame, fold: str, totals: tuple[int, int]) -> frozenset:
    """Units that toxic documents hold significantly and much more often."""
    p, n = {"0": (F.col("p0"), F.col("n0")), "1": (F.col("p1"), F.col("n1")), "": (F.col("p0") + F.col("p1"), F.col("n0") + F.col("n1"))}[fold]
    pos, neg = (max(1, t) for t in totals)
    a, b = (p + 0.5) / (pos + 1.0), (n + 0.5) / (neg + 1.0)
    z = (a - b) / F.sqrt(a * (1 - a) / pos + b * (1 - b) / neg)
    top = counts.where((p >= 3) & (a > 4 * b)).select("unit", z.alias("z")).where("z > 1.5")
    return frozenset(r[0] for r in top.collect())


def fit(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS):
    """(lexicon, trees, calibration) from labelled rows whose remainder is not 2, ``max_fit_rows`` of them at most."""
    known = labels.where("toxic is not null and doc_id is not null").where(remainder(F.col("doc_id")) != 2).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    h = F.xxhash64(F.lit(3), "doc_id")
    sample = known.select("doc_id", "toxic", F.pmod(h, F.lit(2)).cast("int").alias("fold"), h.alias("h")).orderBy("h", "doc_id").limit(max_fit_rows).drop("h")
    stages = Stages(docs.sparkSession, "toxicity")
    sample = stages.put(sample, "sample")
    rows = stages.put(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"), "rows")  # at most max_fit_rows of 16 bytes
    counts = rows.select("text", "toxic", "fold").mapInArrow(_counted, "unit string, p0 long, n0 long, p1 long, n1 long")
    counts = stages.put(counts.groupBy("unit").agg(*(F.sum(c).alias(c) for c in ("p0", "n0", "p1", "n1"))).where("p0 + p1 >= 3"), "units")
    t = {(r[0], r[1]): r[2] for r in sample.groupBy("fold", "toxic").count().collect()}
    per = {f: (t.get((f, 1), 0), t.get((f, 0), 0)) for f in (0, 1)}
    lexicons = [_lexicon(counts, str(f), per[f]) for f in (0, 1)]
    lexicon = _lexicon(counts, "", tuple(map(sum, zip(*per.values(), strict=True))))

    def other_fold(batches):
        import pyarrow as pa

        codes = [_Codes(x) for x in lexicons]
        for batch in batches:
            fold = np.asarray(batch.column(2))
            x = np.where((fold == 1)[:, None], features(batch.column(0), codes[0]), features(batch.column(0), codes[1])) if len(batch) else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *(pa.array(x[:, j]) for j in range(len(FEATURES)))], ["toxic", "fold", *FEATURES])

    schema = "toxic int, fold int, " + ", ".join(f"{f} double" for f in FEATURES)
    got = rows.select("text", "toxic", "fold").mapInArrow(other_fold, schema).toArrow()
    x = np.stack([got.column(f).to_numpy() for f in FEATURES], 1) if got.num_rows else np.zeros((0, len(FEATURES)))
    y, fold = (got.column(c).to_numpy().astype(float) for c in ("toxic", "fold"))
    order = np.lexsort((*x.T, y, fold))  # rows come in any order; sums shall not depend on it
    x, y, fold = x[order], y[order], fold[order]
    margin = np.zeros(len(y))
    for f in (0, 1):
        margin[fold == f] = Trees(x[fold != f], y[fold != f]).margin(x[fold == f])
    return lexicon, Trees(x, y), Isotonic(margin, y)


def score_toxicity(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS, cutoff: float = CUTOFF) -> DataFrame:
    """doc_id, held_out, score, predicted, one row for each row of docs (doc_id, text; other columns are ignored).

    Null, empty and blank texts are scored with features of zero.  Null doc_id: scored, not held out,
    never learnt from.  Several labels of one doc_id: toxic if any says so; null labels are ignored.
    Without any labelled row, or with labels of one kind, every score is the calibrated base rate (0
    without rows).  Repeated rows are scored alike.  Empty table: no rows.
    """
    lexicon, trees, calibrate = fit(docs, labels, max_fit_rows)

    def run(batches):
        import pyarrow as pa

        codes = _Codes(lexicon)
        for batch in batches:
            score = calibrate(trees.margin(features(batch.column(2), codes)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= cutoff).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", (remainder(F.col("doc_id")) == 2).alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return score_toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
