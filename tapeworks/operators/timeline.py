"""Latency of a bar's start: log events pivoted per (line, slug) and split into its parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scalars import slug_epoch


def pivot(events: DataFrame) -> DataFrame:
    """Per line and slug the times of bar, token, sub and first (by connection); the last of repeated events counts, the first by order."""
    at = lambda kind, conn=None, value="t": F.max_by(F.when(_is(kind, conn), F.col(value)), F.when(_is(kind, conn), F.col("i")))
    return events.groupBy("line", "slug").agg(
        at("bar").alias("bar"), at("token").alias("token"), at("sub", 0).alias("sub0"), at("sub", 1).alias("sub1"), at("first", 0).alias("first0"), at("first", 1).alias("first1"),
        at("first", 0, "server_ms").alias("server0"), at("first", 1, "server_ms").alias("server1"),
    )


def _is(kind: str, conn: int | None) -> Column:
    return (F.col("kind") == kind) if conn is None else (F.col("kind") == kind) & (F.col("conn") == conn)


def decompose(pivoted: DataFrame, slow_s: float = 5.0) -> DataFrame:
    """detect, token, sub, server and first in seconds after the bar's start; the faster connection counts; flag tells what was slow.

    Detection more than 30 s after the start is another bar's and is left out.
    """
    start = slug_epoch(F.col("slug")) % 86_400
    d = pivoted.withColumn("epoch", slug_epoch(F.col("slug"))).withColumn("detect", F.col("bar") - start)
    d = d.where("detect <= 30").withColumn("sub", F.least("sub0", "sub1")).withColumn("first", F.least("first0", "first1"))
    d = d.select("line", "slug", "epoch", "detect", (F.col("token") - F.col("bar")).alias("token_s"), (F.col("sub") - F.col("token")).alias("sub_s"), (F.col("first") - F.col("sub")).alias("server_s"), (F.col("first") - start).alias("first_s"))
    flag = F.when(F.col("first_s") > slow_s, F.when(F.col("detect") > 5, "detect").when(F.col("token_s") + F.col("sub_s") > 3, "rebuild").when(F.col("server_s") > 2, "server").otherwise("unknown"))
    return d.withColumn("flag", flag)


def recent(decomposed: DataFrame, n: int) -> DataFrame:
    return decomposed.orderBy(F.desc("epoch"), F.desc("line")).limit(n).orderBy("epoch", "line")
