"""Ordered funnels per client: strict as-of joins within client-time ranges, merged and ranked by Spark.

An attempt ends at most ``within`` after its first step. So a client's time is cut into ranges, each range also gets
the rows of ``within`` after its end (its halo), and attempts that start in a range are followed there alone: the
rows of one client lie in as many tasks as it has ranges. In a task DuckDB joins each step to the client's
next row of the next kind and to its next excluded row, both strictly later (ASOF joins), and counts attempts by step and time.

Spark adds up those counts. The quarter-way time of a step is found in two rounds of counts, first by
ranges of 2**14 microseconds and then within the one range that holds the rank, so no
client's times are gathered or sorted in one place.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import stage

SECOND = 1_000_000
WITHIN = 300 * SECOND
#: Length of a client-time range: a twelfth of the rows is also halo. Rows that a task joins at once.
RANGE, CHUNK_ROWS = 3_600 * SECOND, 250_000
#: Bits of a time, in microseconds, that the first round of ranking leaves to the second.
FINE_BITS = 14


@dataclass(frozen=True)
class Funnel:
    name: str
    steps: tuple[str, ...]
    excluding: str | None = None


FUNNELS = (
    Funnel("A", ("view", "click", "view", "purchase"), "error"),
    Funnel("B", ("signup", "view", "click", "purchase"), "error"),
    Funnel("C", ("click", "click", "purchase", "view"), "signup"),
)


def micros(name: str, kind: str) -> Column:
    """Microseconds since 1970 of a timestamp column; one without a zone is read as it stands, whatever the session's zone."""
    c = F.col(name)
    if kind != "timestamp_ntz":
        return F.unix_micros(c.cast("timestamp"))
    second = F.expr(f"cast(extract(SECOND FROM `{name}`) * {SECOND} AS bigint)")
    return F.unix_date(F.to_date(c)).cast("long") * (86_400 * SECOND) + (F.hour(c) * 3600 + F.minute(c) * 60).cast("long") * SECOND + second


def events(clicks: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Distinct client_id, kind (its place in ``kinds``), t (microseconds); rows with a null or another kind are gone."""
    code = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind")).cast("int") - 1
    rows = clicks.where(F.col("kind").isin(*kinds) & F.col("client_id").isNotNull() & F.col("arrived_at").isNotNull())
    return rows.select(F.col("client_id").cast("long").alias("client_id"), code.alias("kind"), micros("arrived_at", dict(clicks.dtypes)["arrived_at"]).alias("t")).distinct()


def ranges(rows: DataFrame, length: int, within: int) -> DataFrame:
    """Adds ``part``, the range, and ``own``; a row that an attempt of an earlier range may still reach comes in that range too."""
    range_of = lambda t: F.expr(f"({t} - pmod({t}, {length})) div {length}")
    here = range_of("t")
    out = rows.select("client_id", "kind", "t", here.alias("here"), F.explode(F.sequence(range_of(f"(t - {within})"), here)).alias("part"))
    return out.select("client_id", "part", "t", "kind", (F.col("part") == F.col("here")).alias("own"))


def step_sql(funnel: Funnel, kinds: tuple[str, ...], within: int) -> str:
    """Counts of attempts by group, step (from 1) and microseconds since the previous step (step 1: 0), over tables ``kind<i>`` (g, t, own)."""
    code = {k: kinds.index(k) for k in kinds}
    said = [f"s1 AS (SELECT g, t AS t1, t, 0::BIGINT AS dt FROM kind{code[funnel.steps[0]]} WHERE own)"]
    for i, kind in enumerate(funnel.steps[1:], 2):
        before = f"s{i - 1}"
        kept, barred = f"n.t - p.t1 <= {within}", ""
        if funnel.excluding is not None:
            barred = f" ASOF LEFT JOIN kind{code[funnel.excluding]} x ON p.g = x.g AND p.t < x.t"
            kept += " AND (x.t IS NULL OR x.t > n.t)"
        said.append(f"s{i} AS (SELECT p.g, p.t1, n.t, n.t - p.t AS dt FROM {before} p ASOF JOIN kind{code[kind]} n ON p.g = n.g AND p.t < n.t{barred} WHERE {kept})")
    each = " UNION ALL ".join(f"SELECT g, {i}::INTEGER AS step, dt, count(*)::BIGINT AS n FROM s{i} GROUP BY g, dt" for i in range(1, len(funnel.steps) + 1))
    return f"WITH {', '.join(said)} {each}"


def _follow(funnels: tuple[Funnel, ...], kinds: tuple[str, ...], within: int, chunk_rows: int):
    names = ["client_id", "part", "t", "kind", "own"]

    def count(con, rows: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        new = np.ones(len(rows["t"]), bool)
        new[1:] = (rows["client_id"][1:] != rows["client_id"][:-1]) | (rows["part"][1:] != rows["part"][:-1])
        g = np.cumsum(new) - 1
        clients = rows["client_id"][new]
        for k in range(len(kinds)):
            at = rows["kind"] == k
            con.register(f"kind{k}", pa.table({"g": g[at], "t": rows["t"][at], "own": rows["own"][at]}))
        for f in funnels:
            got = con.sql(step_sql(f, kinds, within)).to_arrow_table()
            met = pa.table({"funnel": pa.array([f.name] * len(got), pa.string()), "client_id": clients[got.column("g").to_numpy()], "step": got.column("step"), "dt": got.column("dt"), "n": got.column("n")})
            # ranges of one client follow each other: their counts are added up before they are shuffled
            met = met.group_by(["funnel", "client_id", "step", "dt"]).aggregate([("n", "sum")])
            met = met.select(["funnel", "client_id", "step", "dt", "n_sum"]).rename_columns(["funnel", "client_id", "step", "dt", "n"])
            yield from met.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(":memory:")
        con.execute("SET threads = 1")
        held: list[dict[str, np.ndarray]] = []
        n, limit = 0, chunk_rows
        for b in batches:
            held.append({c: b.column(c).to_numpy(zero_copy_only=False) for c in names})
            n += b.num_rows
            if n < limit:
                continue
            rows = {c: np.concatenate([h[c] for h in held]) for c in names}
            # attempts of the last range that may still meet rows to come wait, with every row after their start
            last = (rows["client_id"] == rows["client_id"][-1]) & (rows["part"] == rows["part"][-1])
            wait = last & (rows["t"] >= rows["t"][-1] - within)
            yield from count(con, rows | {"own": rows["own"] & ~wait})
            held = [{c: v[wait] for c, v in rows.items()}]
            n = int(wait.sum())
            limit = max(chunk_rows, 2 * n)
        rows = {c: np.concatenate([h[c] for h in held]) for c in names} if held else {}
        if rows and len(rows["t"]):
            yield from count(con, rows)
        con.close()

    return run


def step_times(clicks: DataFrame, funnels: tuple[Funnel, ...] = FUNNELS, within: int = WITHIN, length: int = RANGE, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """funnel, client_id, step, dt, n: attempts that reached the step ``dt`` microseconds after the one before; staged."""
    kinds = tuple(sorted({k for f in funnels for k in (*f.steps, f.excluding) if k is not None}))
    rows = ranges(events(clicks, kinds), length, within).repartition("client_id", "part").sortWithinPartitions("client_id", "part", "t")
    counted = rows.mapInArrow(_follow(funnels, kinds, within, chunk_rows), "funnel string, client_id long, step int, dt long, n long")
    return stage(counted.groupBy("funnel", "client_id", "step", "dt").agg(F.sum("n").alias("n")), "funnel_times")


def ranked(times: DataFrame, percent: int = 25) -> DataFrame:
    """funnel, client_id, step, dt: the ceil(percent * n / 100)-th smallest of a step's n times."""
    key = ["funnel", "client_id", "step"]
    coarse = times.groupBy(*key, F.shiftright("dt", FINE_BITS).alias("high")).agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*key)
    coarse = coarse.withColumn("all", F.sum("n").over(w)).withColumn("before", F.sum("n").over(w.orderBy("high")) - F.col("n"))
    coarse = coarse.withColumn("rank", F.expr(f"(`all` * {percent} + 99) div 100"))
    edge = coarse.where("before < rank AND rank <= before + n").select(*key, "high", (F.col("rank") - F.col("before")).alias("rank"))
    fine = times.withColumn("high", F.shiftright("dt", FINE_BITS)).join(edge, [*key, "high"])
    fine = fine.withColumn("upto", F.sum("n").over(w.orderBy("dt")))
    return fine.where("upto >= rank").groupBy(*key).agg(F.min("dt").alias("dt"))


def funnels(clicks: DataFrame, kinds: tuple[Funnel, ...] = FUNNELS, within: int = WITHIN, length: int = RANGE, percent: int = 25) -> DataFrame:
    """Per funnel and client with attempts: n1 ..., deepest, t2 ..., same_depth.

    ``clicks``: client_id, kind, arrived_at. Rows with a null in one of them are left out, rows that repeat count
    once, of equal times none follows the other. Each row of the first kind starts an attempt; the next step is the client's earliest
    row of its kind later than the step before. It is reached unless that is over ``within`` microseconds after
    the first step or an excluded row lies after the previous step and not after this one. t2 ... are null where no
    attempt got there. Other columns are ignored; an empty table gives an empty result.
    """
    most = max(len(f.steps) for f in kinds)
    times = step_times(clicks, kinds, within, length)
    at = lambda i, c: F.when(F.col("step") == i, F.col(c))
    counts = times.groupBy("funnel", "client_id").agg(*[F.coalesce(F.sum(at(i, "n")), F.lit(0)).cast("long").alias(f"n{i}") for i in range(1, most + 1)], F.max("step").alias("deepest"))
    counts = stage(counts, "funnel_counts")
    # a row for each funnel and step, whatever the input
    depth = counts.groupBy("funnel", "deepest").agg(F.count("*").alias("same_depth"))
    quarter = ranked(times.where("step > 1"), percent).groupBy("funnel", "client_id").agg(*[F.max(at(i, "dt")).alias(f"t{i}") for i in range(2, most + 1)])
    out = counts.join(quarter, ["funnel", "client_id"], "left").join(F.broadcast(depth), ["funnel", "deepest"])
    return out.select("funnel", "client_id", *[f"n{i}" for i in range(1, most + 1)], "deepest", *[f"t{i}" for i in range(2, most + 1)], "same_depth")
