"""Removal of passages that repeat across documents, by level-wise doubling of repeated windows.

A window of ``length`` words that starts in two different texts shares every shorter window inside it. So
windows of a quarter of the length are compared first, those that repeat are extended to half the length,
and only what repeats there too is extended to the whole length and compared position by position; each level
reads the survivors of the one before and ends the work where none are left. ``longest`` goes on doubling past ``length``.

The first level need not hold all positions: of the shorter windows inside each window of ``length`` words the
one with the least hash is an anchor, so equal windows hold equal anchors, about one word in twenty is one, and no
repeat is missed. An anchor is extended to both sides, since at least one extension fits into the longer window.

Equal texts are one text, of their smallest doc_id: in all other copies every word of a text of ``length``
words or more goes. Windows of the last level are told apart by 96 bits of two hashes. Rows move as
(hash, document, position), never as pairs, and a window that a text repeats is one row of it: a passage that a third of all documents share costs a row a
window and document, its smallest doc_id is a pre-aggregated minimum, and the join that brings it back can be split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.llm.common import discard, stage

LENGTH = 50
#: Odd factors of the two rolling hashes, and the multiplier that mixes their bits.
BASES, MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)
#: Words a task remembers the hash of, and words it hashes at once (or one document, if that has more).
CACHE_WORDS, CHUNK_WORDS = 1_000_000, 200_000
#: Candidates' places travel to the tasks that hold the texts as a broadcast up to this size; beyond it texts and places are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
#: Null ids come after all others.
LAST_ID = (1 << 63) - 1
TOP = np.uint64((1 << 64) - 1)


class WordHashes(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    if len(_powers.get(base, ())) < n:
        steps = np.full(max(n, CHUNK_WORDS), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.multiply.accumulate(steps)
    return _powers[base][:n]


def windows(words: np.ndarray, length: int, base: int = BASES[0]) -> np.ndarray:
    """A hash of each run of ``length`` words: differences of prefix sums of word * base**i, moved to the same power."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers(base, len(words)), out=sums[1:])
    h = (sums[length:] - sums[:-length]) * powers(pow(base, -1, 1 << 64), n)
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


def sliding(x: np.ndarray, width: int, op: np.ufunc, pad: int) -> np.ndarray:
    """``op`` over each run of ``width`` values, from running results within blocks of that width."""
    n = len(x)
    blocks = np.append(x, np.full(-n % width, pad, x.dtype)).reshape(-1, width)
    ahead = op.accumulate(blocks, axis=1).ravel()
    back = op.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(back[: n - width + 1], ahead[width - 1 : n])


def anchors(words: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the texts that lie between ``bounds`` in ``words``: places, hashes of a quarter, and of half the length to the right and left.

    A last pair of arrays says which of the two extensions stay inside their text.
    """
    k, n = length // 4, len(words)
    if n < length:
        none = np.zeros(0, np.uint64)
        return none.astype(np.int64), none, none, none, none.astype(bool), none.astype(bool)
    sizes = np.diff(bounds)
    starts, ends = np.repeat(bounds[:-1], sizes), np.repeat(bounds[1:], sizes)
    at = np.arange(n)
    short = windows(words, k) | np.uint64(1)  # never 0
    m = len(short)
    short[at[:m] + k > ends[:m]] = TOP
    width = length - k + 1
    least = sliding(short, width, np.minimum, int(TOP))
    least[at[: len(least)] + length > ends[: len(least)]] = 0
    edge = np.zeros(width - 1, np.uint64)
    over = sliding(np.concatenate([edge, least, edge]), width, np.maximum, 0)
    place = np.flatnonzero((over == short) & (over > 0))
    double = windows(words, 2 * k)
    right, left = place + 2 * k <= ends[place], place - k >= starts[place]
    last = len(double) - 1
    return place, short[place], double[np.minimum(place, last)], double[np.clip(place - k, 0, last)], right, left


def first_of_each(*columns: np.ndarray) -> np.ndarray:
    """Ascending places of the first row of each distinct one."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return np.sort(order[new])


def alike(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """All places with a hash that one of ``places`` has: a window that a text repeats moves as one row, and is found again where the text is."""
    return np.flatnonzero(np.isin(hashes, hashes[places]))


def keyed(docs: DataFrame) -> DataFrame:
    """doc (the id; null: ``LAST_ID``), th and th2 (128 bits of the text), text, and the row's other columns as ``row``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
        F.xxhash64(text).alias("th"), F.xxhash64(F.lit(1), text).alias("th2"), text.alias("text"),
    )


def _texts(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def _longs(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _lists(values: np.ndarray, offsets: np.ndarray, mask: np.ndarray | None = None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, mask=mask))


def _first_pass(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            texts, lo = _texts(b.column("text")), 0
            while lo < len(texts):
                words, sizes, shas = [], [], []
                while lo + len(sizes) < len(texts) and len(words) < CHUNK_WORDS:
                    own = texts[lo + len(sizes)].split()
                    shas.append(hashlib.sha256(b" ".join(own)).hexdigest())
                    sizes.append(len(own))
                    words += own
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                place, short, right, left, has_right, has_left = anchors(cache.of(words), bounds, length)
                owner = np.searchsorted(bounds, place, side="right") - 1
                once = first_of_each(owner, right * np.uint64(BASES[1]) ^ left, short, has_right * 2 + has_left)
                place, short, right, left, has_right, has_left, owner = (v[once] for v in (place, short, right, left, has_right, has_left, owner))
                offsets = np.searchsorted(owner, np.arange(len(sizes) + 1))
                part = b.slice(lo, len(sizes))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"), part.column("th"), part.column("th2"), pa.array(sizes, pa.int64()), pa.array(shas), _lists((place - bounds[owner]).astype(np.int32), offsets),
                        _lists(_longs(short), offsets), _lists(_longs(right), offsets, ~has_right), _lists(_longs(left), offsets, ~has_left),
                    ],
                    names=["doc", "th", "th2", "n_words", "sha", "place", "short", "right", "left"],
                )
                lo += len(sizes)

    return run


def _window_pass(length: int, shorter: int, both: bool):
    """Hashes of the windows of ``length`` words that hold one of ``shorter`` words which starts alike one of ``places``; each distinct one of a text once.

    With ``both``, for ``places`` that are not anchors alone, both halves of a window have to be such windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        names = ["h", "x", "doc", "th"]
        for b in batches:
            for i, (text, places) in enumerate(zip(_texts(b.column("text")), b.column("places"), strict=True)):
                words = cache.of(text.split())
                n = len(words) - length + 1
                if n <= 0:
                    continue
                found = alike(windows(words, shorter), places.values.to_numpy())
                if both:
                    at = np.intersect1d(found, found - shorter, assume_unique=True)
                else:
                    marks = np.bincount(np.clip(found - (length - shorter), 0, n), minlength=n + 1) - np.bincount(np.clip(found + 1, 0, n), minlength=n + 1)
                    at = np.flatnonzero(np.cumsum(marks)[:n])
                h = windows(words, length)[at]
                at = at[np.sort(np.unique(h, return_index=True)[1])]
                if not len(at):
                    continue
                more = (windows(words, length, BASES[1])[at] & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
                own = [pa.array(np.full(len(at), b.column(c)[i].as_py(), np.int64)) for c in ("doc", "th")]
                yield pa.RecordBatch.from_arrays([pa.array(_longs(windows(words, length)[at])), pa.array(_longs(more)), *own], names=names)

    return run


def covered(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` words lie in a window of ``length`` words at one of ``starts``."""
    marks = np.bincount(starts, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(starts + length, n), minlength=n + 1)[: n + 1]
    return np.cumsum(marks)[:n] > 0


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            out = []
            for text, starts in zip(_texts(b.column("text")), b.column("starts"), strict=True):
                words = text.split()
                gone = np.zeros(len(words), bool)
                if starts.is_valid:
                    gone = covered(len(words), alike(windows(cache.of(words), length), starts.values.to_numpy()), length)
                out.append((int(gone.sum()), b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)))
            own = [b.column(c) for c in b.schema.names if c not in ("text", "starts")]
            names = [c for c in b.schema.names if c not in ("text", "starts")]
            yield pa.RecordBatch.from_arrays([*own, pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary()).cast(pa.string())], names=[*names, "n_removed", "kept"])

    return run


def with_places(rows: DataFrame, info: DataFrame, size_of: str) -> DataFrame:
    """``rows`` (with texts) that ``info`` (a staged table of doc, th and places) names; texts stay where they are while ``info`` is small."""
    n, held = info.agg(F.count("*"), F.coalesce(F.sum(F.size(size_of)), F.lit(0))).first()
    small = n * 64 + held * 4 <= BROADCAST_BYTES
    return rows.join(F.broadcast(info) if small else info, ["doc", "th"])


def repeated(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` occurs in two different texts."""
    both = rows.groupBy(key).agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo < hi").select(key)
    return rows.join(both, key, "left_semi")


def half_length(found: DataFrame, length: int) -> DataFrame:
    """doc, th, places: starts of repeated windows of half the length, for the smallest doc of each text."""
    zipped = F.explode(F.arrays_zip("place", "short", "right", "left"))
    rows = found.where(F.size("place") > 0).select("doc", "th", "th2", zipped.alias("a")).select("doc", "th", "th2", "a.*")
    sides = F.array(F.struct(F.col("right").alias("double"), F.col("place").alias("at")), F.struct(F.col("left").alias("double"), (F.col("place") - length // 4).alias("at")))
    doubled = repeated(rows, "short").select("doc", "th", "th2", F.explode(sides).alias("s")).select("doc", "th", "th2", "s.*").where("double IS NOT NULL")
    met = repeated(doubled, "double").groupBy("th", "th2").agg(F.min("doc").alias("doc"), F.collect_set("at").alias("places"))
    return stage(met.select("doc", "th", "places"), "repeats_half")


def window_rows(rows: DataFrame, places: DataFrame, length: int, shorter: int, both: bool = False) -> DataFrame:
    met = with_places(rows.select("doc", "th", "text"), places, "places")
    return stage(met.mapInArrow(_window_pass(length, shorter, both), "h long, x long, doc long, th long"), "repeats_windows")


def hits(rows: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """doc, th, starts: windows of ``length`` words that also start in a document with a smaller id."""
    found = window_rows(rows, places, length, 2 * (length // 4))
    key = ["h", "g"]
    met = found.withColumn("g", F.shiftright("x", 32))
    first = met.groupBy(*key).agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select(*key, "lo")
    later = met.join(first, key).where("doc > lo").select("doc", "th", F.col("x").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("at"))
    out = stage(later.groupBy("doc", "th").agg(F.collect_set("at").alias("starts")), "repeats_hits")
    discard(found)
    return out


def judged(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per row of ``docs``: doc, th, th2, n_words, sha; texts with later copies: th, th2, first; and ``hits``."""
    if length < 4:
        raise ValueError("windows have four words at least")
    rows = keyed(docs).drop("row")
    schema = "doc long, th long, th2 long, n_words long, sha string, place array<int>, short array<long>, right array<long>, left array<long>"
    found = stage(rows.mapInArrow(_first_pass(length), schema), "repeats_anchors")
    copies = found.groupBy("th", "th2").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last").select("th", "th2", "first")
    places = half_length(found, length)
    return found.select("doc", "th", "th2", "n_words", "sha"), copies, hits(rows, places, length)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of ``length`` words that covers it also starts in a document with a smaller doc_id;
    windows are judged on the input. A null or empty text has no words; rows that repeat are judged alike; ids
    that repeat are one document to each other (neither is smaller); a null id comes after all others. Other
    columns are ignored; an empty table gives an empty result.
    """
    own, copies, found = judged(docs, length)
    gone = with_places(keyed(docs).select("doc", "th", "text"), found, "starts").mapInArrow(_kept(length), "doc long, th long, n_removed long, kept string")
    gone = gone.select("doc", "th", "n_removed", F.sha2("kept", 256).alias("kept")).groupBy("doc", "th").agg(F.first("n_removed").alias("n_removed"), F.first("kept").alias("kept"))
    met = own.join(copies, ["th", "th2"], "left").join(gone, ["doc", "th"], "left")
    copy = F.coalesce(F.col("first") < F.col("doc"), F.lit(False)) & (F.col("n_words") >= length)
    return met.select(
        F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"), "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Every row of ``docs`` with all its columns, ``text`` being the kept words, joined by one space; n_removed beside it."""
    _, copies, found = judged(docs, length)
    rows = keyed(docs).join(copies, ["th", "th2"], "left").join(found, ["doc", "th"], "left")
    kept = rows.select("row", F.coalesce(F.col("first") < F.col("doc"), F.lit(False)).alias("copy"), "text", "starts")
    schema = T.StructType([kept.schema["row"], kept.schema["copy"], T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])
    out = kept.mapInArrow(_kept(length), schema)
    n = F.size(F.split("kept", " "))
    whole = F.col("copy") & (n >= length) & (F.col("kept") != "")
    text = F.when(whole, F.lit("")).otherwise(F.col("kept"))
    removed = F.when(whole, F.col("n_removed") + n).otherwise(F.col("n_removed")).cast("long")
    return out.select(*[text.alias("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns], removed.alias("n_removed"))


def longest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, words: the longest of ``length``, twice, four times ``length`` ... words that a window has which also starts in another text.

    Each level extends the windows that repeat at the one before to twice their length, until none are left.
    Documents without any are absent; copies of a text count as one text, under the smallest id.
    """
    rows = keyed(docs).drop("row")
    schema = "doc long, th long, th2 long, n_words long, sha string, place array<int>, short array<long>, right array<long>, left array<long>"
    found = stage(rows.mapInArrow(_first_pass(length), schema), "repeats_anchors")
    places, shorter, levels = half_length(found, length), 2 * (length // 4), []
    while places.limit(1).count():
        met = window_rows(rows, places, length, shorter, bool(levels)).withColumn("g", F.shiftright("x", 32)).withColumn("at", F.col("x").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))
        both = met.groupBy("h", "g").agg(F.min("th").alias("lo"), F.max("th").alias("hi")).where("lo < hi").select("h", "g")
        places = stage(met.join(both, ["h", "g"], "left_semi").groupBy("doc", "th").agg(F.collect_set("at").alias("places")), "repeats_level")
        levels.append(places.select("doc", F.lit(length).cast("long").alias("words")))
        shorter, length = length, 2 * length
    if not levels:
        return docs.sparkSession.createDataFrame([], "doc_id long, words long")
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out.groupBy(F.nullif("doc", F.lit(LAST_ID)).alias("doc_id")).agg(F.max("words").alias("words"))
