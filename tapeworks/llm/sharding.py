"""Shards of near-equal bytes by sampled splitters, with DataFrame functions only.

Records are ordered by (hash of the text, doc_id, copy), the last a number where rows repeat. A sample drawn with chances in proportion to size
gives the splitters, its quantiles; they cut the order into many more ranges than shards. Ranges that
turn out overfull are sampled and cut again, until none is or no cut is left to make. Ranges then go, largest first, to the lightest shard.
Equal texts are neighbours in the order and stay in one range, and so in one shard, unless they alone
weigh over ``KEEP`` of a shard: such a run is cut by doc_id and copy. The driver holds the sample and a plan
row a range: some 25 rows for each ``RANGE_ROWS`` records.
"""

from __future__ import annotations

import heapq
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tapeworks.llm.common import numbered, stage

SHARDS, RANGES_PER_SHARD, OVERSAMPLE, SEED = 8, 32, 24, 29
#: A range holds about this many rows at most, so the number of ranges follows the input.
RANGE_ROWS = 1_000_000
#: A run of equal texts lighter than this part of a shard is never split.
KEEP = 0.5
LOWEST = -(1 << 63)
Key = tuple[int, int, int]  # hash, doc_id, copy


def _draw(rows: DataFrame, want: float, total: float, seed: int) -> list[Key]:
    """About ``want`` keys, drawn in proportion to size; want is bounded by the number of ranges."""
    chance = F.least(F.col("size") * (want / max(total, 1.0)), F.lit(1.0))
    u = (F.xxhash64("h", "doc_id", "copy", F.lit(seed)).cast("double") / 2.0**63 + 1.0) / 2.0
    # records heavier than total / want stand for several quantiles
    times = F.greatest(F.floor(F.col("size") * (want / max(total, 1.0))), F.lit(1)).cast("int")
    got = rows.where(u < chance).select("h", F.coalesce("doc_id", F.lit(LOWEST)).alias("d"), "copy", times.alias("times")).collect()
    return sorted((r.h, r.d, r.copy) for r in got for _ in range(r.times))


def _splitters(sample: list[Key], ranges: int) -> list[Key]:
    """Quantiles of the sample; one inside a run of equal texts moves to the run's start, unless the run spans several."""
    picks = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    out: list[Key] = []
    for h, run in groupby(picks, key=lambda x: x[0]):
        run = list(run)
        out.append((h, LOWEST, 0))
        if len(run) > 1:  # heavy: its own inner cuts, and one behind it
            out += [*run[1:], (h + 1, LOWEST, 0)]
    return sorted(set(out))


def _locate(rows: DataFrame, splitters: list[Key]) -> DataFrame:
    """Adds ``range``: how many splitters are at or below (h, doc_id, copy).

    The splitters lie in a small table by the top 16 bits of the hash; a record looks at those in its own
    cell only.
    """
    spark = rows.sparkSession
    cells: dict[int, list[Key]] = {}
    for s in splitters:
        cells.setdefault(s[0] >> 48, []).append(s)
    table, seen = [], 0
    for cell in range(-(1 << 15), 1 << 15):
        own = cells.get(cell, [])
        if own or cell == -(1 << 15):
            table.append((cell, seen, own))
        seen += len(own)
    # cells without splitters take their base from a step function: the last cell before them
    starts = [t[0] for t in table]
    full, at = [], -1
    for cell in range(-(1 << 15), 1 << 15):
        if at + 1 < len(starts) and starts[at + 1] == cell:
            at += 1
            full.append((cell, table[at][1], table[at][2]))
        else:
            full.append((cell, table[at][1] + len(table[at][2]), []))
    small = spark.createDataFrame(full, "cell int, base int, own array<struct<h:long,d:long,c:long>>")
    here = F.struct(F.col("h").alias("h"), F.coalesce("doc_id", F.lit(LOWEST)).alias("d"), F.col("copy").alias("c"))
    found = F.when(F.size("own") == 0, 0).otherwise(F.size(F.filter("own", lambda s: s <= here)))
    joined = rows.withColumn("cell", F.shiftright("h", 48).cast("int")).join(F.broadcast(small), "cell")
    return joined.withColumn("range", F.col("base") + found).drop("cell", "base", "own")


def _assign(ranges: list, splitters: list[Key], shards: int) -> list[tuple[int, int, int]]:
    """(range, shard, rows before it in the shard): largest unit first to the lightest shard."""
    total = sum(r.bytes for r in ranges)
    starts = [(LOWEST, LOWEST, 0), *splitters]
    units = []
    for _, run in groupby(sorted(ranges, key=lambda r: r.range), key=lambda r: starts[r.range][0] if r.range else LOWEST):
        run = list(run)
        whole = sum(r.bytes for r in run) <= KEEP * total / shards
        units += [run] if whole else [[r] for r in run]
    heap = [(0, s) for s in range(shards)]
    before, out = [0] * shards, []
    for unit in sorted(units, key=lambda u: (-sum(r.bytes for r in u), u[0].range)):
        load, s = heapq.heappop(heap)
        for r in unit:
            out.append((r.range, s, before[s]))
            before[s] += r.rows
        heapq.heappush(heap, (load + sum(r.bytes for r in unit), s))
    return out


def shard(docs: DataFrame, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1; a null text counts as empty. law is always ``bytes``;
    grown_shard is null. Slots run from 0 without gaps in the order of (hash, doc_id, copy). Repeated rows are
    numbered, get slots of their own and are split like other rows. Extra columns are ignored. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("h"),
    )
    rows = stage(numbered(rows, ["doc_id", "size", "text_crc32", "h"]), "shard_keys")
    n, total = rows.agg(F.count("*"), F.sum("size")).first()
    ranges = max(shards * RANGES_PER_SHARD, -(-n // RANGE_ROWS))
    splitters, again = _splitters(_draw(rows, ranges * OVERSAMPLE, float(total or 0), seed), ranges), 0
    while True:
        located, again = _locate(rows, splitters), again + 1
        at = F.struct("h", F.coalesce("doc_id", F.lit(LOWEST)).alias("d"), "copy")
        sums = located.groupBy("range").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.min(at).alias("lo"), F.max(at).alias("hi")).collect()
        over = [r.range for r in sums if r.bytes > 3 * total / ranges and tuple(r.lo) < tuple(r.hi)]
        if not over:
            break
        inner = located.join(F.broadcast(spark.createDataFrame([(r,) for r in over], "range int")), "range", "left_semi")
        heavy = sum(r.bytes for r in sums if r.range in set(over))
        cuts = max(2, round(2 * heavy * ranges / total))
        more = _splitters(_draw(inner, cuts * OVERSAMPLE, float(heavy), seed + again), cuts)
        if set(more) <= set(splitters):
            break
        splitters = sorted({*splitters, *more})
    plan = spark.createDataFrame(_assign(sums, splitters, shards), "range int, shard int, before long")
    order = Window.partitionBy("range").orderBy("h", "doc_id", "copy")
    return located.join(F.broadcast(plan), "range").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("before") + F.row_number().over(order) - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
