"""Duplicate audits and key-set algebra of two captures; batch twins of the streaming operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def audit(rows: DataFrame, key: Column, groups: list[str]) -> DataFrame:
    """n, distinct, duplicates per group; all NULL keys are one value."""
    g = rows.groupBy(*groups).agg(F.count("*").alias("n"), (F.count_distinct(key) + F.max(key.isNull().cast("int"))).alias("distinct"))
    return g.withColumn("duplicates", F.col("n") - F.col("distinct"))


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def coverage(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row over two key sets: n_a, n_b, shared, either, only_a, only_b and each side's share of either."""
    keys = a.columns
    t = a.select(*keys, F.lit(1).alias("x"), F.lit(0).alias("y")).union(b.select(*keys, F.lit(0), F.lit(1))).groupBy(*keys).agg(F.max("x").alias("x"), F.max("y").alias("y"))
    g = t.agg(F.sum("x").alias("n_a"), F.sum("y").alias("n_b"), F.sum(F.col("x") * F.col("y")).alias("shared"), F.count("*").alias("either"))
    return g.select("n_a", "n_b", "shared", "either", (F.col("n_a") - F.col("shared")).alias("only_a"), (F.col("n_b") - F.col("shared")).alias("only_b"), (F.col("n_a") / F.col("either")).alias("share_a"), (F.col("n_b") / F.col("either")).alias("share_b"))


def algebra(a: DataFrame, b: DataFrame) -> DataFrame:
    """op and key columns: the distinct keys of either (union), of both, and of one alone (a_b, b_a), from one count of all."""
    keys = a.columns
    t = a.select(*keys, F.lit(True).alias("_x"), F.lit(False).alias("_y")).union(b.select(*keys, F.lit(False), F.lit(True))).groupBy(*keys).agg(F.bool_or("_x").alias("_x"), F.bool_or("_y").alias("_y"))
    x, y = F.col("_x"), F.col("_y")
    ops = F.array(F.lit("union"), F.when(x & y, "both").when(x, "a_b").otherwise("b_a"))
    return t.select(F.explode(ops).alias("op"), *keys)


def dedup_window(rows: DataFrame, keys: list[str], at: str, order: str, gap: float = 60.0, skip: Column | None = None) -> DataFrame:
    """Keeps a row unless its key was kept less than ``gap`` before; drops do not renew that. Rows that ``skip`` names, and rows without a time, are all kept.

    A key's rows are split where two neighbours are ``gap`` or more apart: the later one is kept whatever came
    before, so each run can be folded by itself. A run passes by in order, with its last kept time alone in memory and a search from one
    kept row to the next, and whole rows come out: neither the order column nor any other has to be unique.
    """
    free = F.col(at).isNull() if skip is None else F.col(at).isNull() | F.coalesce(skip, F.lit(False))
    w = Window.partitionBy(*keys).orderBy(at, order)
    marked = rows.where(~free).withColumn("_new", F.coalesce(F.col(at) - F.lag(at).over(w) >= gap, F.lit(True)).cast("int"))
    runs = marked.withColumn("_run", F.sum("_new").over(w)).withColumn("_t", F.col(at).cast("double"))
    columns = rows.columns

    def fold(batches):
        last = 0.0
        for b in batches:
            t, new = b.column("_t").to_numpy(), b.column("_new").to_numpy() > 0
            keep = new.copy()
            cuts = np.flatnonzero(new).tolist()
            for lo, hi in zip([0, *cuts] if not cuts or cuts[0] else cuts, [*cuts, len(t)] if not cuts or cuts[0] else [*cuts[1:], len(t)], strict=True):
                i = lo
                if lo < hi and new[lo]:
                    last, i = t[lo], lo + 1
                while i < hi:  # from one kept row to the next
                    i += int(np.searchsorted(t[i:hi], last + gap))
                    while i > lo + 1 and t[i - 1] - last >= gap:  # the sum was rounded, the difference counts
                        i -= 1
                    while i < hi and t[i] - last < gap:
                        i += 1
                    if i < hi:
                        keep[i], last = True, t[i]
                        i += 1
            yield b.filter(pa.array(keep)).select(columns)

    out = runs.repartition(*keys, "_run").sortWithinPartitions(*keys, "_run", at, order, F.desc("_new")).mapInArrow(fold, rows.schema)
    return out.unionByName(rows.where(free))


def gaps(rows: DataFrame, keys: list[str], at: str, silence: float) -> DataFrame:
    """Silences of ``silence`` or longer between a key's neighbours: from_ts (when it was told), to_ts, lost."""
    w = Window.partitionBy(*keys).orderBy(at)
    g = rows.withColumn("_p", F.lag(at).over(w)).where(F.col(at) - F.col("_p") >= silence)
    return g.select(*keys, (F.col("_p") + silence).alias("from_ts"), F.col(at).alias("to_ts"), (F.col(at) - F.col("_p") - silence).alias("lost"))


def islands(rows: DataFrame, keys: list[str], at: str, silence: float) -> DataFrame:
    """Runs without such a silence: start, stop, n."""
    w = Window.partitionBy(*keys).orderBy(at)
    r = rows.withColumn("_new", F.coalesce(F.col(at) - F.lag(at).over(w) >= silence, F.lit(True)).cast("int")).withColumn("_run", F.sum("_new").over(w))
    return r.groupBy(*keys, "_run").agg(F.min(at).alias("start"), F.max(at).alias("stop"), F.count("*").alias("n")).drop("_run")
