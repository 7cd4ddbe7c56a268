"""Latest-at-time operators: one partial-then-final aggregate each, no sort of whole groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """Per key the row that is last by ``order``, as max_by over a struct."""
    row = F.max_by(F.struct(*keep), F.struct(*order)).alias("_r")
    return df.groupBy(*keys).agg(row).select(*keys, "_r.*")


def as_of(df: DataFrame, keys: list[str], target_ms: Column, order: list[str], keep: list[str], ts: str = "ts_ms") -> DataFrame:
    """Per key the last row at or before its target time."""
    return latest(df.where(F.col(ts) <= target_ms), keys, order, keep)


def lagged(df: DataFrame, keys: list[str], seq: str, ts: str = "ts_ms") -> DataFrame:
    """Adds prev: the time of the row before in file order."""
    return df.withColumn("prev", F.lag(ts).over(Window.partitionBy(*keys).orderBy(seq)))


def first_seen_mode(df: DataFrame, keys: list[str], value: str, seq: str, counted: Column | None = None) -> DataFrame:
    """Per key the most frequent ``value``; ties go to the value seen first. ``counted`` limits what counts, as to number and first sight."""
    hit = F.lit(True) if counted is None else counted
    n = df.groupBy(*keys, value).agg(F.count_if(hit).alias("_n"), F.min(F.when(hit, F.col(seq))).alias("_first"))
    return n.where("_n > 0").groupBy(*keys).agg(F.max_by(value, F.struct(F.col("_n"), (-F.col("_first")).alias("f"))).alias(value), F.max("_n").alias("n"))
