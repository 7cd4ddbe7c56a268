"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

``fit`` learns, from a bounded sample of labelled rows, first two lexicons (whole words; word beginnings),
then trees over each text's densities: lexicon hits, hits near second-person words, capitals, punctuation
and obfuscated spellings. Features of a text come from the whole text. Labels, language, source and ids
are never features.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import stage

#: Most labelled rows that a fit takes, drawn by hash; folds for calibration; trees and their shape.
SAMPLE_ROWS, FOLDS, TREES, DEPTH, RATE, SEED = 16_000, 3, 40, 3, 0.25, 11
THRESHOLD = 0.7
#: A lexicon entry needs this many toxic texts of the sample, and this much of its texts toxic.
SUPPORT, PRECISION = 4, 0.9
HEADS = (4, 5, 6)
CACHE_WORDS = 300_000

# Second-person words of English, German, French and Spanish.
SECOND_PERSON = ("you", "your", "yours", "yourself", "du", "dich", "dir", "dein", "deine", "ihr", "euch", "tu", "te", "toi", "ton", "ta", "vous", "votre", "usted", "ustedes", "ti", "tus", "vos")
# Characters that stand for letters in disguised spellings.
DISGUISE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "l"}

EDGE = "\"'`.,;:?()[]{}<>*_~#-…!"
HIT, HEAD, SECOND, CAPS, ODD = 1, 2, 4, 8, 16
FEATURES = ("hits", "hit_rate", "heads", "head_rate", "near_second", "second_rate", "caps_rate", "exclaim_rate", "punct_rate", "odd_rate", "odd_hits", "upper_rate", "digit_rate", "words")


def plain(word: bytes) -> bytes:
    """A word as the lexicons hold it: lower case, edges and disguise removed, letters tripled or more reduced."""
    w = word.decode("utf-8", "replace").lower().strip(EDGE)
    if any(c in DISGUISE for c in w) and any(c.isalpha() for c in w):
        w = "".join(DISGUISE.get(c, c) for c in w)
    if "." in w or "*" in w or "-" in w or "_" in w:
        w = re.sub(r"(?<=\w)[.*_-](?=\w)", "", w)
    return re.sub(r"(.)\1\1+", r"\1", w).encode()


@dataclass
class Lexicon:
    words: frozenset[bytes] = frozenset()
    heads: frozenset[bytes] = frozenset()

    def flags(self, w: bytes) -> int:
        """What the lexicon says of a plain word."""
        text = w.decode("utf-8", "replace")
        return (HIT if w in self.words else 0) | (HEAD if any(text[:n].encode() in self.heads for n in HEADS if len(text) >= n) else 0)


def shape(word: bytes, w: bytes) -> int:
    """What a word and its plain form say without a lexicon."""
    out, raw = SECOND if w in _SECOND else 0, word.decode("utf-8", "replace")
    if len(raw) > 2 and raw.isupper():
        out |= CAPS
    bare = raw.strip(EDGE)
    if any(c.isalpha() for c in bare) and (any(c in DISGUISE for c in bare) or re.search(r"(.)\1\1", bare)):
        out |= ODD
    return out


_SECOND = frozenset(w.encode() for w in SECOND_PERSON)


class Flags(dict):
    """word -> a byte of flags for each of the lexicons."""

    def __init__(self, *lexicons: Lexicon):
        self.lexicons = lexicons

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > CACHE_WORDS:
            self.clear()
        w = plain(word)
        own = shape(word, w)
        out = self[word] = bytes(x.flags(w) | own for x in self.lexicons)
        return out


_PUNCT = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))


def features(text: str | None, flags: Flags) -> list[float]:
    """The features by each of the lexicons, one behind the other."""
    raw = text.encode("utf-8", "replace") if text else b""
    words = raw.split()
    f = np.frombuffer(b"".join(map(flags.__getitem__, words)), np.uint8).reshape(-1, len(flags.lexicons))
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    return [x for i in range(len(flags.lexicons)) for x in _features(f[:, i], kinds, len(words), len(raw))]


def _features(f: np.ndarray, kinds: np.ndarray, n_words: int, n_bytes: int) -> list[float]:
    n, size = max(n_words, 1), max(n_bytes, 1)
    hit, head, second = f & HIT > 0, f & HEAD > 0, f & SECOND > 0
    toxic = np.flatnonzero(hit | head)
    near = 0
    if len(toxic) and second.any():
        at = np.flatnonzero(second)
        j = np.searchsorted(at, toxic)
        left = np.abs(toxic - at[np.maximum(j - 1, 0)])
        right = np.abs(at[np.minimum(j, len(at) - 1)] - toxic)
        near = int((np.minimum(left, right) <= 5).sum())
    odd = f & ODD > 0
    return [
        float(hit.sum()), float(hit.sum()) / n, float(head.sum()), float(head.sum()) / n, float(near), float(second.sum()) / n, float((f & CAPS > 0).sum()) / n,
        float(kinds[33]) / n, float(kinds[list(_PUNCT)].sum()) / size, float(odd.sum()) / n, float((odd & (hit | head)).sum()), float(kinds[65:91].sum()) / size,
        float(kinds[48:58].sum()) / size, math.log1p(n_words),
    ]


# ---- trees


@dataclass
class Tree:
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    value: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        feature, cut, value = np.array(self.feature), np.array(self.cut), np.array(self.value)
        for _ in range(DEPTH):
            go = feature[at] >= 0
            right = x[np.arange(len(x)), np.maximum(feature[at], 0)] > cut[at]
            at = np.where(go, 2 * at + 1 + right, at)
        return value[at]


def fit_tree(bins: np.ndarray, edges: list[np.ndarray], g: np.ndarray, h: np.ndarray, least: int = 8, ridge: float = 1.0) -> Tree:
    """One regression tree on binned features by gain over gradient histograms; nodes in heap order."""
    n = 2 ** (DEPTH + 1) - 1
    tree, rows = Tree([-1] * n, [0.0] * n, [0.0] * n), {0: np.arange(len(g))}
    for node in range(n):
        if node not in rows:
            continue
        r = rows[node]
        tree.value[node] = float(g[r].sum() / (h[r].sum() + ridge))
        if node >= 2**DEPTH - 1 or len(r) < 2 * least:
            continue
        best = (1e-6, -1, 0)
        base = g[r].sum() ** 2 / (h[r].sum() + ridge)
        for j, e in enumerate(edges):
            m = len(e) + 1
            gs, hs, cs = (np.cumsum(np.bincount(bins[r, j], w, m))[:-1] for w in (g[r], h[r], np.ones(len(r))))
            if not len(gs):
                continue
            gain = gs**2 / (hs + ridge) + (g[r].sum() - gs) ** 2 / (h[r].sum() - hs + ridge) - base
            gain[(cs < least) | (len(r) - cs < least)] = -1
            i = int(gain.argmax())
            if gain[i] > best[0]:
                best = (float(gain[i]), j, i)
        if best[1] >= 0:
            _, j, i = best
            tree.feature[node], tree.cut[node] = j, float(edges[j][i])
            left = bins[r, j] <= i
            rows[2 * node + 1], rows[2 * node + 2] = r[left], r[~left]
    return tree


@dataclass
class Boosted:
    start: float = 0.0
    trees: list[Tree] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.start + RATE * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))


def fit_boosted(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Boosted:
    """Logistic boosting with Newton leaves."""
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    out = Boosted(float(np.log(p / (1 - p))))
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, 65)[1:-1])) if len(c) else np.zeros(0) for c in x.T]
    edges = [np.unique(np.concatenate([e, [0.0, 0.5]])) for e in edges]
    bins = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], 1)
    raw = np.full(len(y), out.start)
    for _ in range(trees):
        q = 1 / (1 + np.exp(-raw))
        t = fit_tree(bins, edges, y - q, q * (1 - q))
        out.trees.append(t)
        raw += RATE * t.predict(x)
    return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots of a rising step function from raw scores to rates; equal scores are one point."""
    points, at = np.unique(raw, return_inverse=True)
    sums, weights = np.bincount(at, y, len(points)), np.bincount(at, minlength=len(points))
    blocks: list[list[float]] = []  # sum, weight, lowest raw, highest raw
    for s, v, w in zip(points.tolist(), sums.tolist(), weights.tolist(), strict=True):
        blocks.append([v, w, s, s])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            b = blocks.pop()
            blocks[-1] = [blocks[-1][0] + b[0], blocks[-1][1] + b[1], blocks[-1][2], b[3]]
    xs = np.array([x for b in blocks for x in (b[2], b[3])])
    ys = np.array([(b[0] + 0.5 * 0.02) / (b[1] + 0.02) for b in blocks for _ in (0, 1)])
    return xs, np.maximum.accumulate(ys) if len(ys) else ys


@dataclass
class Model:
    lexicon: Lexicon = field(default_factory=Lexicon)
    boosted: Boosted = field(default_factory=Boosted)
    knots: tuple[np.ndarray, np.ndarray] = (np.zeros(0), np.zeros(0))

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.boosted.raw(x)
        if not len(self.knots[0]):
            return 1 / (1 + np.exp(-raw))
        calibrated = np.interp(raw, *self.knots)
        return np.clip(calibrated * 0.999 + 0.001 / (1 + np.exp(-raw)), 0.0, 1.0)  # the raw score orders texts within a step


# ---- fitting


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, entry, fold, toxic, n texts): words and word beginnings, each once a text."""
    seen: dict[tuple[int, int], Counter] = {(f, t): Counter() for f in range(FOLDS) for t in (0, 1)}
    known: dict[bytes, bytes] = {}
    for b in batches:
        for order, text, toxic in zip(b.column("order").to_pylist(), b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
            own = set()
            for raw in set((text or "").encode("utf-8", "replace").split()):
                w = known.get(raw)
                if w is None:
                    w = known[raw] = plain(raw)
                s = w.decode("utf-8", "replace")
                if s:
                    own.add((0, w))
                own.update((1, s[:n].encode()) for n in HEADS if len(s) >= n)
            seen[order % FOLDS, toxic].update(own)
            if len(known) > CACHE_WORDS:
                known.clear()
    for (fold, toxic), counter in seen.items():
        items = list(counter.items())
        for lo in range(0, len(items), 50_000):
            part = items[lo : lo + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for (k, _), _ in part], pa.int32()), pa.array([e for (_, e), _ in part], pa.binary()), pa.array([fold] * len(part), pa.int32()), pa.array([toxic] * len(part), pa.int32()), pa.array([n for _, n in part], pa.int64())],
                names=["kind", "entry", "fold", "toxic", "n"],
            )


def _feature_rows(lexicons: list[Lexicon]):
    """Features by each of the lexicons, one behind the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = Flags(*lexicons)
        for b in batches:
            x = [features(t, flags) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("order"), b.column("toxic"), pa.array(x, pa.list_(pa.float64()))], names=["order", "toxic", "x"])

    return run


def training_sample(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> DataFrame:
    """order, text, toxic of about ``sample_rows`` labelled documents at most, none of them held out.

    The labels are drawn by hash of the id before any text is touched, so the join's small side is bounded.
    Labels that contradict each other count as toxic; labels other than 0 and 1 are no labels.
    """
    known = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out(F.col("label_id")))
    order = F.xxhash64("label_id", F.lit(seed))
    share = min(1.0, sample_rows / max(known.count(), 1))
    drawn = known.where((order.cast("double") / 2.0**63 + 1) / 2 <= share).withColumn("order", order)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(rows.join(F.broadcast(drawn), F.col("doc_id") == F.col("label_id")).select("order", "text", "toxic"), "toxic_sample")


def chosen(counts: list, left_out: int | None) -> Lexicon:
    """The entries with enough toxic texts, and hardly others, in all folds but ``left_out``."""
    entries: tuple[set[bytes], set[bytes]] = (set(), set())
    for r in counts:
        pos, n = (sum(x for f, x in enumerate(c) if f != left_out) for c in (r.pos, r.n))
        if pos >= SUPPORT and pos >= PRECISION * n:
            entries[r.kind].add(bytes(r.entry))
    return Lexicon(frozenset(entries[0]), frozenset(entries[1]))


def fit(sample: DataFrame) -> Model:
    """Fits on ``sample`` (order, text, toxic), which ``training_sample`` bounds. Without rows every score is low.

    For calibration each fold is scored by a lexicon and trees that saw the other folds only.
    """
    cells = sample.mapInArrow(_entries, "kind int, entry binary, fold int, toxic int, n long")
    per_fold = lambda only: F.array(*[F.sum(F.when((F.col("fold") == f) & only, F.col("n")).otherwise(0)) for f in range(FOLDS)])
    counts = cells.groupBy("kind", "entry").agg(per_fold(F.col("toxic") == 1).alias("pos"), per_fold(F.lit(True)).alias("n"))
    total = lambda c, out: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) - (F.lit(0) if out is None else F.get(c, F.lit(out)))
    folds = [None, *range(FOLDS)]
    enough = [(total("pos", f) >= SUPPORT) & (total("pos", f) >= PRECISION * total("n", f)) for f in folds]
    good = counts.where(F.greatest(*enough)).collect()  # entries of at least SUPPORT texts of the bounded sample
    lexicons = [chosen(good, f) for f in folds]
    got = sorted(sample.mapInArrow(_feature_rows(lexicons), "order long, toxic int, x array<double>").collect(), key=lambda r: (r.order, r.toxic, r.x))
    if not got:
        return Model(boosted=Boosted(-5.0))
    x, y = np.array([r.x for r in got]).reshape(len(got), len(folds), -1), np.array([r.toxic for r in got], float)
    fold = np.array([r.order % FOLDS for r in got])
    held = np.zeros(len(y))
    for f in range(FOLDS):
        if (fold != f).any() and (fold == f).any():
            held[fold == f] = fit_boosted(x[fold != f, f + 1], y[fold != f]).raw(x[fold == f, f + 1])
    return Model(lexicons[0], fit_boosted(x[:, 0], y), isotonic(held, y))


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = Flags(model.lexicon)
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array([features(t.as_py(), flags) for t in b.column("text")])
            keep = [b.column(c) for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(model.score(x))], names=[*(c for c in b.schema.names if c != "text"), "score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, score in [0, 1], predicted (1 from 0.7 on).

    Null and empty texts are scored by their features, all zero. Repeated rows score alike. Extra columns
    are ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(_score(model), "doc_id long, text_hash long, score double")
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean_rows(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic; judged and passed on in one go.

    Null and empty texts are judged by features that are all zero; equal rows stay or go together; columns may
    have any names; an empty table stays empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = Flags(model.lexicon)
        for b in batches:
            if b.num_rows:
                x = np.array([features(t.as_py(), flags) for t in b.column("text")])
                yield b.filter(pa.array(model.score(x) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1: never learned from. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
