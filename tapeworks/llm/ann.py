"""Approximate nearest neighbours by multiprobe p-stable hashing over several tables.

In each of ``TABLES`` tables, Gaussian projections cut into slots of width ``WIDTH`` give a vector's bucket.
The number of projections follows the number of rows, so that a bucket holds some ``BUCKET_ROWS`` of them at
every size. A query visits, in each table, its own bucket and perturbed ones in estimated success order (Lv
et al. 2007: sets of slot borders by the expected sum of squared distances of their ranks, made once, then
mapped to each query's own borders by sorting them). The candidates of all tables are merged and ranked by
their exact inner product. Inner products become distances by one more coordinate, ``sqrt(M^2 - |x|^2)`` for
rows and 0 for queries, M the largest norm.

How many buckets a query visits is fitted on a bounded, documented set of queries against all rows; every
row is indexed in every table. Buckets are dealt over blocks by the slots of their first projections, so that
a task holds one block and streams the queries that probe it: no candidate pair is ever a row, and each block
returns at most ``k`` rows per query. Queries that the probes leave short of ``k`` rows, or all where no number
of probes reaches the recall asked for, are ranked against every row instead.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import stage

TABLES, WIDTH, SEED = 4, 2.0, 5
#: Rows that a bucket holds on average; bits that one projection's slot gives at this width (its entropy).
BUCKET_ROWS, SLOT_BITS = 32, math.log2(math.sqrt(2 * math.pi * math.e) / WIDTH)
#: Queries for fitting the number of probes, the recall asked of them, and the most probes a table.
FIT_QUERIES, TARGET, MOST_PROBES = 256, 0.95, 8_192
#: Rows of all tables that a block holds at most, but for chance.
BLOCK_ROWS = 32_768


def hash_count(rows: int) -> int:
    """Projections of a table: as many as part ``rows`` into buckets of ``BUCKET_ROWS``."""
    return max(4, round(math.log2(max(rows, 1) / BUCKET_ROWS + 1) / SLOT_BITS))


def perturbations(hashes: int, most: int) -> np.ndarray:
    """Sets of border ranks by expected score, the empty set first: a 0/1 matrix, sets by 2 * ``hashes`` ranks.

    Ranks r and 2 * ``hashes`` - 1 - r are the two borders of one slot, so no set holds both.
    """
    m = hashes
    near = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    z = near + [1 - j / (m + 1) + j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(m, 0, -1)]
    heap, out = [(z[0], (0,))], [()]
    while heap and len(out) < most:
        cost, ranks = heapq.heappop(heap)
        if all(2 * m - 1 - r not in ranks for r in ranks):
            out.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost - z[last] + z[last + 1], (*ranks[:-1], last + 1)))
            heapq.heappush(heap, (cost + z[last + 1], (*ranks, last + 1)))
    sets = np.zeros((len(out), 2 * m), np.int64)
    for i, ranks in enumerate(out):
        sets[i, list(ranks)] = 1
    return sets


class Hashing:
    """The projections of all tables, and what they make of vectors."""

    def __init__(self, dim: int, top: float, hashes: int, *, cell: int = 0, seed: int = SEED, tables: int = TABLES, most: int = MOST_PROBES):
        rng = np.random.default_rng(seed)
        self.top, self.tables, self.hashes = top or 1.0, tables, hashes
        self.a, self.b = rng.standard_normal((dim + 1, tables * hashes)), rng.uniform(0, WIDTH, tables * hashes)
        # a bucket's code is linear in its slots, so a probe's code is the query's own plus its moves'; a cell takes the first slots only
        self.weights = rng.integers(-(1 << 62), 1 << 62, (2, tables, hashes)) | 1
        self.weights[1, :, cell:] = 0
        self.shift = rng.integers(-(1 << 62), 1 << 62, (2, tables))
        self.sets = perturbations(hashes, most)

    def project(self, x: np.ndarray, rows: bool) -> np.ndarray:
        """In units of slots: vectors by tables by hashes. A query is scaled to the largest norm: its own length changes no order."""
        norm = np.sqrt((x * x).sum(1))
        if rows:
            extra = np.sqrt(np.maximum(1.0 - np.minimum(norm / self.top, 1.0) ** 2, 0.0))
            x = x / self.top
        else:
            extra, x = np.zeros(len(x)), x / np.maximum(norm, 1e-300)[:, None]
        return ((np.c_[x, extra] @ self.a + self.b) / WIDTH).reshape(len(x), self.tables, self.hashes)

    def codes(self, slots: np.ndarray) -> np.ndarray:
        """Bucket and cell of each vector in each table, 64 bits each: 2 by vectors by tables."""
        s = np.floor(slots).astype(np.int64)
        return np.stack([(s * w).sum(-1) + c for w, c in zip(self.weights, self.shift, strict=True)])

    def probes(self, x: np.ndarray, count: int) -> np.ndarray:
        """Buckets and cells to visit in estimated success order: 2 by queries by tables by probes."""
        p = self.project(x, rows=False)
        inside = p - np.floor(p)
        order = np.argsort(np.concatenate([inside, 1 - inside], -1), -1, kind="stable")  # borders below, then above
        base, sets = self.codes(p), self.sets[:count]
        out = np.empty((2, *p.shape[:2], len(sets)), np.int64)
        for i, w in enumerate(self.weights):
            moves = np.take_along_axis(np.broadcast_to(np.concatenate([-w, w], -1), order.shape), order, -1)
            out[i] = base[i][..., None] + moves @ sets.T
        return out


class Places:
    """Blocks of each table's cells. A cell of more rows than a block takes lies in several, its rows dealt by id."""

    def __init__(self, tables: int, per_table: int, crowded: dict[int, int]):
        self.tables, self.per_table = tables, per_table
        self.cells = np.array(sorted(crowded), np.int64)
        self.pieces = np.array([crowded[c] for c in sorted(crowded)], np.int64)

    def count(self, cells: np.ndarray) -> np.ndarray:
        """In how many blocks each cell lies."""
        if not len(self.cells):
            return np.ones(cells.shape, np.int64)
        at = np.minimum(np.searchsorted(self.cells, cells), len(self.cells) - 1)
        return np.where(self.cells[at] == cells, self.pieces[at], 1)

    def block(self, table: np.ndarray, cells: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return table * self.per_table + (_mix(cells) + piece) % self.per_table


def _mix(x: np.ndarray) -> np.ndarray:
    """31 well-mixed bits of 64-bit numbers."""
    u = x.astype(np.uint64)
    return (((u ^ (u >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def _short(codes: np.ndarray) -> np.ndarray:
    """A bucket's name inside a block: 32 of its bits. Two buckets of one name only add candidates."""
    return (codes >> 32).astype(np.int32)


def fit_probes(queries: np.ndarray, best: list[np.ndarray], hashing: Hashing, target: float = TARGET) -> int:
    """The least number of probes a table that finds ``target`` of the queries' true neighbours ``best``; more than there are if none does."""
    every, at = len(hashing.sets), []
    for i, near in enumerate(best):
        if not len(near):
            continue
        own, probes = hashing.codes(hashing.project(near, rows=True))[0], hashing.probes(queries[i : i + 1], every)[0, 0]
        first = np.full(len(near), every)
        for t in range(hashing.tables):
            order = np.argsort(probes[t], kind="stable")
            j = np.minimum(np.searchsorted(probes[t], own[:, t], sorter=order), every - 1)
            first = np.minimum(first, np.where(probes[t][order[j]] == own[:, t], order[j], every))
        at += first.tolist()
    return sorted(at)[min(len(at) - 1, math.ceil(target * len(at)) - 1)] + 1 if at else 1


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _few(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def _scan(asked: np.ndarray, asked_ids: list[int], dim: int, k: int):
    """Of each partition, the ``k`` vectors of largest inner product with each of the given queries but their own rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(asked), 0, dim)), np.zeros((len(asked), 0))
        for b in _few(batches, 2_048):
            x, ids = _matrix(b.column("v"), dim), b.column("ids").to_pylist()
            s = asked @ x.T
            own = {i: n for n, i in enumerate(asked_ids)}
            for j, of in enumerate(ids):
                if len(of) == 1 and of[0] in own:
                    s[own[of[0]], j] = -np.inf
            take = min(k, len(x))
            top = np.argpartition(-s, take - 1, axis=1)[:, :take]
            rows, score = np.concatenate([held[0], x[top]], 1), np.concatenate([held[1], np.take_along_axis(s, top, 1)], 1)
            keep = np.argsort(-score, axis=1, kind="stable")[:, :k]
            held = np.take_along_axis(rows, keep[..., None], 1), np.take_along_axis(score, keep, 1)
        n = held[1].shape[1]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(asked)), n), pa.int32()), pa.array(list(held[0].reshape(-1, dim)), pa.list_(pa.float64())), pa.array(held[1].ravel())],
                names=["n", "v", "score"],
            )

    return run


def _cell_counts(hashing: Hashing, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells, counts = np.unique(hashing.codes(hashing.project(_matrix(b.column("v"), dim), rows=True))[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts)], names=["cell", "n"])

    return run


def _place(hashing: Hashing, places: Places, dim: int):
    """Each row once a table, with its block and its bucket there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches, 4_096):
            codes, cells = hashing.codes(hashing.project(_matrix(b.column("v"), dim), rows=True))
            least = np.array([min(i) for i in b.column("ids").to_pylist()], np.int64)
            for t in range(hashing.tables):
                block = places.block(np.int64(t), cells[:, t], _mix(least) % places.count(cells[:, t]))
                n = len(block)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int32()), pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.int64()), b.column("ids"), b.column("v"),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32)), pa.array(_short(codes[:, t])))],
                    names=["block", "kind", "vec_id", "ids", "v", "codes"],
                )

    return run


def _route(hashing: Hashing, places: Places, dim: int, probes: int):
    """Query rows, one for each block that can hold a bucket they probe, with the buckets to visit there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _few(batches, 32):
            codes, cells = hashing.probes(_matrix(b.column("v"), dim), probes)
            who, table = np.broadcast_to(np.arange(len(cells))[:, None, None], cells.shape).ravel(), np.broadcast_to(np.arange(cells.shape[1])[:, None], cells.shape).ravel()
            codes, cells = _short(codes.ravel()), cells.ravel()
            pieces = places.count(cells)
            at = np.repeat(np.arange(len(cells)), pieces)
            piece = np.arange(len(at)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            block = places.block(table[at], cells[at], piece)
            order = np.lexsort((block, who[at]))
            at, block = at[order], block[order]
            starts = np.flatnonzero(np.r_[True, (np.diff(who[at]) != 0) | (np.diff(block) != 0)])
            query = pa.array(who[at][starts])
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[starts], pa.int32()), pa.array(np.ones(n, np.int32)), b.column("vec_id").take(query), pa.nulls(n, pa.list_(pa.int64())), b.column("v").take(query),
                 pa.ListArray.from_arrays(pa.array(np.r_[starts, len(at)].astype(np.int32)), pa.array(codes[at]))],
                names=["block", "kind", "vec_id", "ids", "v", "codes"],
            )

    return run


def _rank(dim: int, k: int):
    """Per block: its rows come first, then the queries; yields each query's best k of the buckets it visits there (of all where it names none)."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def best(x, ids, codes, q_ids, q, visits) -> pa.RecordBatch | None:
        out: list[tuple[int, int, float]] = []
        for i, who in enumerate(q_ids):
            if visits[i].is_valid:
                wanted = visits[i].values.to_numpy()
                lo, hi = np.searchsorted(codes, wanted, "left"), np.searchsorted(codes, wanted, "right")
                lo, n = lo[hi > lo], (hi - lo)[hi > lo]
                of = np.unique(np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum()))
                scores = x[of] @ q[i]
            else:
                of, scores = None, x @ q[i]
            if not len(scores):
                continue
            take = min(k + 1, len(scores))  # one more: the query itself may be among them
            near = np.flatnonzero(scores >= np.partition(scores, len(scores) - take)[len(scores) - take] - 1e-9 * max(1.0, np.abs(scores).max()))
            near = near if of is None else of[near]
            exact = (q[i] * x[near]).sum(1)  # the same sum for equal vectors
            rows = [(-s, v) for s, j in zip(exact.tolist(), near.tolist(), strict=True) for v in ids[j] if v != who]
            out += [(who, v, -s) for s, v in sorted(rows)[:k]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, parts, ready = None, [], None
        for b in batches:
            blocks, kinds = b.column("block").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if hi == lo:
                    continue
                s = b.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, parts, ready = blocks[lo], [], None
                if kinds[lo] == 0:
                    parts.append((_matrix(s.column("v"), dim), s.column("ids").to_pylist(), s.column("codes").flatten().to_numpy()))
                    continue
                if ready is None:
                    if not parts:
                        continue
                    codes = np.concatenate([p[2] for p in parts])
                    order = np.argsort(codes, kind="stable")
                    ids = [i for p in parts for i in p[1]]
                    ready = np.concatenate([p[0] for p in parts])[order], [ids[i] for i in order], codes[order]
                    parts = []
                for q in _few([s], 256):
                    out = best(*ready, q.column("vec_id").to_pylist(), _matrix(q.column("v"), dim), q.column("codes"))
                    if out is not None:
                        yield out

    return run


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, seed: int = SEED, stats: dict | None = None) -> DataFrame:
    """The ``k`` rows of ``vectors`` (vec_id, embedding) of largest inner product for each row of ``queries``.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; a row with the query's own
    vec_id is no candidate. Vectors that are null, zero, hold nulls or non-finite numbers, lack an id, or have
    another length than most, take no part. Equal vectors are indexed once, with their ``k + 1`` smallest ids:
    no other copy can be among the nearest k. Repeated query rows count once; of several vectors under one
    query id the smallest asks. Extra columns are ignored. Empty tables give an empty result. ``stats`` is
    filled with the numbers of rows, hashes, probes and queries ranked against every row.

    On the driver: ``k`` vectors for each of ``FIT_QUERIES`` queries, and a number for each cell that is
    larger than a block (at most ``TABLES`` / ``BLOCK_ROWS`` of the number of rows).
    """
    spark, empty = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    kind = "array<float>" if all(df.schema["embedding"].dataType.simpleString() == "array<float>" for df in (vectors, queries)) else "array<double>"
    v = F.col("embedding").cast(kind)
    clean = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf')) AND exists(v, x -> x <> 0)"
    )
    rows = clean(vectors)
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.sqrt(F.max(square)).alias("top")).orderBy(F.desc("n"), "dim").first()
    if dims is None:
        return spark.createDataFrame([], empty)
    dim, top = dims.dim, dims.top
    rows = rows.where(F.size("v") == dim)
    # copies of a vector: ids are dealt over 64 parts first, so that no task gathers a hot vector's ids
    few = lambda c: F.slice(F.array_sort(F.array_distinct(c)), 1, k + 1)
    in_part = Window.partitionBy("v", "salt").orderBy("vec_id")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("rn", F.row_number().over(in_part)).where(F.col("rn") <= k + 1)
    index = stage(salted.groupBy("v").agg(few(F.collect_list("vec_id")).alias("ids")), "ann_index")
    asked = stage(clean(queries).where(F.size("v") == dim).groupBy("vec_id").agg(F.min("v").alias("v")), "ann_queries")
    shape = index.agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).first()
    total, width = shape.n, int(spark.conf.get("spark.sql.shuffle.partitions"))
    capacity = min(BLOCK_ROWS, max(256, -(-total // max(width, 1))))
    hashes, per_table = hash_count(total), -(-total // capacity)
    cell = min(hashes, math.ceil(max(0.0, math.log2(8 * total / capacity)) / SLOT_BITS))
    hashing = Hashing(dim, top, hashes, cell=cell, seed=seed)
    block_schema = f"block int, kind int, vec_id long, ids array<long>, v {kind}, codes array<int>"

    def ranked(work: DataFrame, blocks: int) -> DataFrame:
        work = work.repartition(max(width, blocks), "block").sortWithinPartitions("block", "kind", "vec_id")
        found = work.mapInArrow(_rank(dim, k), "query_id long, vec_id long, score double").dropDuplicates(["query_id", "vec_id"])
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def exact(some: DataFrame) -> DataFrame:
        least, no = F.array_min("ids"), lambda t: F.lit(None).cast(t)
        held = index.select(F.pmod(F.xxhash64(least), F.lit(per_table)).cast("int").alias("block"), F.lit(0).alias("kind"), no("long").alias("vec_id"), "ids", "v", F.array(F.lit(0)).alias("codes"))
        every = F.explode(F.sequence(F.lit(0), F.lit(per_table - 1)))
        asking = some.select(every.alias("block"), F.lit(1).alias("kind"), "vec_id", no("array<long>").alias("ids"), "v", no("array<int>").alias("codes"))
        return ranked(held.union(asking), per_table)

    # the number of probes: fitted on queries drawn by hash, against all rows
    drawn = asked.select("vec_id", "v", F.xxhash64("v", F.lit(seed)).alias("h")).orderBy("h", "vec_id").limit(FIT_QUERIES).collect()
    if not drawn:
        return spark.createDataFrame([], empty)
    fit = np.array([r.v for r in drawn], np.float64).reshape(-1, dim)
    scanned = index.mapInArrow(_scan(fit, [r.vec_id for r in drawn], dim, k), "n int, v array<double>, score double").where("score > double('-inf')")
    near = scanned.withColumn("rn", F.row_number().over(Window.partitionBy("n").orderBy(F.desc("score"), "v"))).where(F.col("rn") <= k).collect()
    best = [np.array([r.v for r in near if r.n == i], np.float64).reshape(-1, dim) for i in range(len(fit))]
    probes = fit_probes(fit, best, hashing)
    if stats is not None:
        stats.update(rows=total, hashes=hashes, probes=probes, exact=0)
    if probes > len(hashing.sets):  # no number of probes serves these vectors
        if stats is not None:
            stats["exact"] = asked.count()
        return exact(asked)

    crowded = index.mapInArrow(_cell_counts(hashing, dim), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).where(F.col("n") > capacity).collect()
    places = Places(TABLES, per_table, {r.cell: -(-r.n // capacity) for r in crowded})
    work = index.mapInArrow(_place(hashing, places, dim), block_schema).union(asked.mapInArrow(_route(hashing, places, dim, probes), block_schema))
    first = stage(ranked(work, TABLES * per_table), "ann_ranked")
    full = first.groupBy("query_id").count().where(F.col("count") >= min(k, shape.ids))
    short = stage(asked.join(full, asked.vec_id == full.query_id, "left_anti"), "ann_short")
    left = short.count()
    if stats is not None:
        stats["exact"] = left
    if not left:
        return first
    return first.join(short, first.query_id == short.vec_id, "left_anti").union(exact(short))
