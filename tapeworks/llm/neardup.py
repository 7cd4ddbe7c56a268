"""SimHash near-duplicates with covering locality-sensitive hashing, and near-duplicates by set similarity.

Fingerprints that differ in at most ``radius`` of 64 bits are linked. For radius 2, bit positions are dealt
over the seven non-zero vectors of GF(2)^3; table v (also non-zero) keeps the positions whose vector has an
odd inner product with v. Two differing positions span at most a plane, so some v is orthogonal to both and
the pair agrees on all bits that table keeps: no link can be missed.

Only distinct fingerprints enter the tables. A bucket of up to ``SMALL`` of them is compared pair by
pair. In a larger one every member names the 65 points within one bit of it; members that name the same
point are within two bits of each other, and any two within two bits share one. So the work stays
proportional to the members, and the components are the same.

Links by similarity go through the same fingerprints first, of the sets of shingles: the pairs that the
covering tables name are held against the exact similarity, and those that have it are one label from then on. A
Jaccard similarity of 0.8 leaves about 10 +- 3 of 64 bits different, though, and a covering radius of 17 would
take 2^18 - 1 tables. What lies beyond the radius takes its candidates from MinHash bands, which miss a pair at
the threshold once in ``1 / MISS``; they only compare sets of different labels, again by the exact similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.common import discard, stage

RADIUS, SHINGLE, SMALL, SEED = 2, 3, 48, 42
#: Bands at most, and the chance that a pair at the similarity asked for shares none.
BANDS, MISS = 32, 1e-6
#: Set ids that a task remembers; rounds in which buckets are held against one of their members.
SEEN, ROUNDS = 1_000_000, 3


def covering_masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """One mask per non-zero v: the bits i with <vector(i), v> odd."""
    n = (1 << (radius + 1)) - 1
    return [sum(1 << i for i in range(bits) if ((i % n + 1) & v).bit_count() & 1) for v in range(1, n + 1)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def gram_hashes(text: str | None, shingle: int) -> np.ndarray:
    """A hash of each run of ``shingle`` words, of all words where there are fewer."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    grams = zip(*(words[k:] for k in range(shingle)), strict=False) if len(words) >= shingle else [words]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(g, SEED) for g in map(b" ".join, grams)], np.uint64)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one text; 0 without words."""
    return simhash(gram_hashes(text, shingle))


def simhash(h: np.ndarray) -> int:
    """A bit is 1 where it is set in over half of the hashes ``h``; 0 without any."""
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 65_536):
        block = h[lo : lo + 65_536, None].view(np.uint8)  # little-endian bytes
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [signed(fingerprint(t.as_py(), shingle)) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(fps, pa.int64())], names=["doc_id", "text_hash", "fp"])

    return run


def _points(radius: int) -> list[int]:
    """What to XOR with for every point within ``radius`` bits."""
    return [sum(1 << i for i in at) for n in range(radius + 1) for at in combinations(range(64), n)]


def link_fingerprints(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (u, v), u < v, between distinct fingerprints (column fp) that give the same components as all links."""
    if not 0 <= radius <= 4:
        raise ValueError("covering tables and points are for radius 0 to 4")
    masks = covering_masks(radius)
    table = F.explode(F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for i, m in enumerate(masks)]))
    hashed = nodes.select("fp", table.alias("x")).select("fp", "x.t", "x.key")
    size = hashed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = stage(hashed.join(size, ["t", "key"]), "simhash_buckets")

    near = lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= radius
    pairs = F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: (a < b) & near(a, b)), lambda b: F.struct(a.alias("u"), b.alias("v")))))
    small = met.where(F.col("n") <= SMALL).groupBy("t", "key").agg(F.collect_list("fp").alias("m")).select(F.explode(pairs).alias("e")).select("e.u", "e.v")

    # any two within the radius share a point that is within half of it, rounded down, of one and rounded up of the other
    inner, outer = len(_points(radius // 2)), _points(-(-radius // 2))
    points = F.explode(F.array(*[F.struct(F.col("fp").bitwiseXOR(F.lit(signed(x))).alias("point"), F.lit(i < inner).alias("inner")) for i, x in enumerate(outer)]))
    around = met.where(F.col("n") > SMALL).select("fp").distinct().select("fp", points.alias("p")).groupBy("p.point").agg(F.collect_list("fp").alias("m"), F.min(F.when(F.col("p.inner"), F.col("fp"))).alias("u")).where(F.size("m") > 1)
    star = around.where("u IS NOT NULL").select("u", F.explode("m").alias("v")).where("u <> v")
    large = star.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return small.union(large).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges`` (u, v): label is the smallest node of its component.

    Large-star and small-star steps in turn (Kiveris et al. 2014); each is a minimum per node and a join,
    written to the shared folder. Ends when the edges stay the same.
    """
    lower = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    edges = stage(edges.where("u <> v").select(*lower).distinct(), "cc")
    mark = lambda e: tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
    before = mark(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("u"), "v").where("u <> v").distinct()
        # small star: u's lower neighbours and u itself, to the least of them; edges hold u < v, so v is the centre
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(least, "v")
        small = joined.select(F.col("m").alias("u"), F.col("u").alias("v")).union(least.select(F.col("m").alias("u"), "v")).where("u <> v").distinct()
        new = stage(small, "cc")
        now = mark(new)
        discard(edges)
        edges = new
        if now == before:
            break
        before = now
    return stage(edges.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("label")), "cc_labels")  # staged: a join can split a hot node's rows


def banding(similarity: float) -> tuple[int, int]:
    """Bands, and values in a band: the most selective of at most ``BANDS`` bands that miss no more than ``MISS``."""
    if not 0 < similarity <= 1:
        raise ValueError("the similarity is above 0 and at most 1")
    for rows in range(16, 0, -1):
        hit = similarity**rows
        bands = 1 if hit == 1 else math.ceil(math.log(MISS) / math.log1p(-hit))
        if bands <= BANDS:
            return bands, rows
    raise ValueError(f"a similarity of {similarity} takes more than {BANDS} bands")


def band_keys(grams: np.ndarray, bands: int, rows: int) -> list[int]:
    """A key for each band of MinHash values of a set of hashes; none for an empty set."""
    import xxhash

    if not len(grams):
        return []
    rng = np.random.default_rng(SEED)
    by, plus = rng.integers(0, 1 << 64, (2, bands * rows, 1), np.uint64)
    by |= np.uint64(1)
    low = np.full(bands * rows, (1 << 64) - 1, np.uint64)
    for lo in range(0, len(grams), 1024):
        low = np.minimum(low, (grams[lo : lo + 1024] * by + plus).min(1))
    return [signed(xxhash.xxh64_intdigest(v.tobytes(), i)) for i, v in enumerate(low.reshape(bands, rows))]


def _sets(shingle: int, bands: int, rows: int):
    """doc_id, text_hash and the id of the text's set of shingles; the set, its fingerprint and its bands where the task meets it first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seen: set[int] = set()
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                b = whole.slice(lo, 256)
                ids, grams, fps, keys = [], [], [], []
                for t in b.column("text"):
                    h = np.unique(gram_hashes(t.as_py(), shingle))
                    ids.append(signed(xxhash.xxh64_intdigest(h.tobytes(), SEED)))
                    new = ids[-1] not in seen
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(ids[-1])
                    grams.append(h.view(np.int64) if new else None)
                    fps.append(signed(simhash(h)) if new else None)
                    keys.append(band_keys(h, bands, rows) if new else None)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("text_hash"), pa.array(ids, pa.int64()), pa.array(grams, pa.list_(pa.int64())), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["doc_id", "text_hash", "set_id", "grams", "fp", "keys"],
                )

    return run


def linked(pairs: DataFrame, grams: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (u, v) whose sets in ``grams`` (set_id, grams) have the similarity. Arrays of v travel once a pair, those of u once."""
    b, a = grams.select(F.col("set_id").alias("v"), F.col("grams").alias("b")), grams.select(F.col("set_id").alias("u"), F.col("grams").alias("a"))
    shared = F.size(F.array_intersect("a", "b"))
    return pairs.distinct().join(b, "v").join(a, "u").where(shared >= similarity * (F.size("a") + F.size("b") - shared) - 1e-9).select("u", "v")


def label_of(met: DataFrame, edges: DataFrame) -> DataFrame:
    """``met`` with the label of each set's component over ``edges``."""
    labels = components(edges)
    return met.join(labels, met.set_id == labels.node, "left").select("key", "set_id", "n", "degree", F.coalesce("label", "set_id").alias("label"))


def prefix_pairs(sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) of ``sets`` (set_id, n, label, grams) of different labels: all of the similarity asked for, and some others.

    Prefix filtering (Chaudhuri et al. 2006, Xiao et al. 2008): with elements in ascending order of frequency, two
    sets that share enough must share one of their first few, so frequent elements name hardly any pair. The
    position of the shared element bounds what two sets can share at all.
    """
    t = similarity
    each = sets.select("set_id", "n", "label", F.explode("grams").alias("g"))
    often = each.groupBy("g").agg(F.count("*").alias("c"))
    ordered = each.join(often, "g").groupBy("set_id", "n", "label").agg(F.sort_array(F.collect_list(F.struct("c", "g"))).alias("e"))
    reach = (F.col("n") - F.ceil(F.lit(t) * F.col("n") - 1e-9) + 1).cast("int")
    entries = ordered.select("set_id", "n", "label", F.posexplode(F.slice("e", F.lit(1), reach)).alias("at", "x")).select("set_id", "n", "label", "at", F.col("x.g").alias("g"))
    entries = stage(entries, "set_prefixes")
    met = entries.groupBy("g").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("g")
    entries = entries.join(met, "g", "left_semi")
    # the smaller set of a pair shares one of even fewer
    small = entries.where(F.col("at") <= F.col("n") - F.ceil(F.lit(2 * t / (1 + t)) * F.col("n") - 1e-9)).alias("s")
    large = entries.alias("l")
    same_size = (F.col("s.n") < F.col("l.n")) | ((F.col("s.n") == F.col("l.n")) & (F.col("s.set_id") < F.col("l.set_id")))
    rest = F.least(F.col("s.n") - F.col("s.at"), F.col("l.n") - F.col("l.at"))
    enough = (F.col("s.n") >= t * F.col("l.n") - 1e-9) & (rest >= t / (1 + t) * (F.col("s.n") + F.col("l.n")) - 1e-9)
    both = small.join(large, (F.col("s.g") == F.col("l.g")) & same_size & enough & (F.col("s.label") != F.col("l.label")))
    return both.select(F.least("s.set_id", "l.set_id").alias("u"), F.greatest("s.set_id", "l.set_id").alias("v"))


def near_sets(sets: DataFrame, similarity: float, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) of ``sets`` (set_id, grams, fp; repeated or null where met before) that their SimHash names: within ``radius`` bits, and of the similarity.

    Sets of one fingerprint go with the first of them, and the first ones of linked fingerprints with each other.
    """
    own = stage(sets.where("fp IS NOT NULL").select("set_id", "fp").distinct(), "set_fingerprints")
    first = stage(own.groupBy("fp").agg(F.min("set_id").alias("first")), "set_first")
    same = own.join(first, "fp").where("set_id <> first").select(F.col("first").alias("u"), F.col("set_id").alias("v"))
    a, b = (first.select(F.col("fp").alias(x), F.col("first").alias(f"f{x}")) for x in "uv")
    apart = link_fingerprints(first.select("fp"), radius).join(a, "u").join(b, "v").select(F.least("fu", "fv").alias("u"), F.greatest("fu", "fv").alias("v"))
    pairs = stage(same.union(apart), "set_near")
    named = pairs.select(F.explode(F.array("u", "v")).alias("set_id")).distinct()
    grams = sets.where("grams IS NOT NULL").join(named, "set_id", "left_semi").groupBy("set_id").agg(F.first("grams").alias("grams"))
    found = stage(linked(pairs, stage(grams, "near_grams"), similarity), "near_links")
    discard(own, first, pairs)
    return found


def link_sets(sets: DataFrame, similarity: float, known: DataFrame | None = None) -> DataFrame:
    """(node, label) of the components of sets (set_id, grams, keys; repeated or null where met before) of at least ``similarity``.

    ``known`` (u, v) are links found before; sets that they join are not compared again. Rounds first: each bucket's members are held against one of them, the one with most neighbours in all its
    buckets, in the next round against one that the first did not reach. A crowded bucket of copies so costs its
    members. What then still lies in several components of a bucket is compared across these: in small buckets
    pair by pair, in crowded ones by prefix filtering, which loses no pair and does not enumerate the bucket.
    """
    once = sets.where("keys IS NOT NULL").select("set_id", F.size("grams").alias("n"), "keys").groupBy("set_id").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    hashed = once.select("set_id", "n", F.explode("keys").alias("key"))
    size = hashed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = stage(hashed.join(size, "key"), "set_buckets")
    degree = met.groupBy("set_id").agg(F.sum("members").alias("degree"))
    grams = sets.where("grams IS NOT NULL").select("set_id", "grams").join(degree, "set_id").groupBy("set_id").agg(F.first("grams").alias("grams"), F.first("degree").alias("degree"))
    grams = stage(grams, "set_grams")
    met = stage(met.join(grams.select("set_id", "degree"), "set_id").select("key", "set_id", "n", "degree"), "set_met")
    size_fits = lambda a, b: F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9

    edges, links, open_ = None, 0, met.withColumn("label", F.col("set_id"))
    if known is not None:
        edges, links, open_ = known, known.count(), stage(label_of(met, known), "set_open")
    for _ in range(ROUNDS):
        # of the sets that no earlier centre of the bucket reached, the one of the highest degree
        lead = open_.groupBy("key").agg(F.max(F.struct("degree", (-F.col("set_id")).alias("first"), "n", "label")).alias("c"))
        lead = lead.select("key", (-F.col("c.first")).alias("centre"), F.col("c.n").alias("cn"), F.col("c.label").alias("cl"))
        pairs = open_.join(lead, "key").where((F.col("label") != F.col("cl")) & size_fits(F.col("n"), F.col("cn")))
        more = linked(pairs.select(F.col("centre").alias("u"), F.col("set_id").alias("v")), grams, similarity)
        edges = stage(more if edges is None else edges.union(more), "set_links")
        placed = stage(label_of(met, edges), "set_labels")
        now = lead.join(placed.select(F.col("key").alias("k"), F.col("set_id").alias("s"), F.col("label").alias("reached")), (F.col("key") == F.col("k")) & (F.col("centre") == F.col("s"))).select("key", "reached")
        left = open_.select("key", "set_id").join(placed, ["key", "set_id"]).join(now, "key").where("label <> reached").drop("reached")
        open_ = stage(left, "set_open")
        before, links = links, edges.count()
        if links == before or not open_.limit(1).count():
            break

    several = placed.groupBy("key").agg(F.count("*").alias("members"), F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("key", "members")
    mixed = stage(placed.join(several, "key"), "set_mixed")
    m = F.collect_list(F.struct("set_id", "n", "label"))
    apart = lambda a, b: (a["set_id"] < b["set_id"]) & (a["label"] != b["label"]) & size_fits(a["n"], b["n"])
    pairs = F.flatten(F.transform("m", lambda a: F.transform(F.filter("m", lambda b: apart(a, b)), lambda b: F.struct(a["set_id"].alias("u"), b["set_id"].alias("v")))))
    few = mixed.where(F.col("members") <= SMALL).groupBy("key").agg(m.alias("m")).select(F.explode(pairs).alias("e")).select("e.u", "e.v")
    pool = mixed.where(F.col("members") > SMALL).select("set_id", "n", "label").distinct()
    many = prefix_pairs(pool.join(grams.select("set_id", "grams"), "set_id"), similarity)
    found = components(edges.union(linked(few.union(many), grams, similarity)))
    discard(met, grams, placed, mixed, open_)  # the components are in tables of their own by now
    return found


def _rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def grouped_by_similarity(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """doc_id, text_hash, label of every row; label names the component by its smallest set of shingles."""
    sets = stage(_rows(docs).mapInArrow(_sets(shingle, *banding(similarity)), "doc_id long, text_hash long, set_id long, grams array<long>, fp long, keys array<long>"), "shingle_sets")
    labels = link_sets(sets, similarity, near_sets(sets, similarity))
    return sets.join(labels, sets.set_id == labels.node, "left").select("doc_id", "text_hash", F.coalesce("label", "set_id").alias("label"))


def grouped(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, text_hash, fp, label of every row; label names the component by its smallest fingerprint."""
    fps = stage(_rows(docs).mapInArrow(_fingerprints(shingle), "doc_id long, text_hash long, fp long"), "fingerprints")
    labels = components(link_fingerprints(fps.select("fp").distinct(), radius))
    return fps.join(labels, fps.fp == labels.node, "left").select("doc_id", "text_hash", "fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, *, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fp (long), component_id.

    A null text has no words, fingerprint zero, and is linked like any other. component_id is the smallest
    doc_id that can be reached over links; null doc_ids are reached but never name a component (null where
    a component has none other). Repeated rows come back as often as they came. Extra columns are ignored;
    an empty table gives an empty result.
    """
    rows = stage(grouped(docs, shingle, radius), "simhash_labels")
    ids = stage(rows.groupBy("label").agg(F.min("doc_id").alias("component_id")), "simhash_ids")
    return rows.join(ids, "label").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, *, shingle: int = 5, similarity: float = 0.8, radius: int | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, that lead their component: the smallest doc_id, a null one last; one row of several alike.

    Linked are texts whose sets of ``shingle``-word runs have a Jaccard similarity of ``similarity`` or more (by SimHash first, then
    by MinHash bands, each pair held against the exact similarity), or,
    where ``radius`` is given, those whose SimHash fingerprints differ in at most so many bits. A null text counts as
    an empty one, and texts without words are alike. An empty table gives no rows.
    """
    found = grouped_by_similarity(docs, shingle, similarity) if radius is None else grouped(docs, shingle, radius)
    rows = stage(found.select("doc_id", "text_hash", "label"), "near_labels")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("k")
    keep = rows.groupBy("label").agg(first).select(F.col("k.doc_id").alias("d"), F.col("k.text_hash").alias("t"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(row, F.col("doc_id").cast("long").alias("k"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    kept = keyed.join(keep, F.col("k").eqNullSafe(F.col("d")) & (F.col("h") == F.col("t")), "left_semi")
    repeats = rows.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
    if repeats:  # rows that repeat in both: any one of them
        kept = kept.dropDuplicates(["k", "h"])
    return kept.select("row.*")
