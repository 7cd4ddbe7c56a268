"""File reconciliation as joins over (path, bytes) tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(\d{4}-\d{2}-\d{2})/", 1)


def within_days(files: DataFrame, days: int, now_s: float) -> DataFrame:
    """Files of the last ``days`` days by directory name; 0: all."""
    return files if not days else files.where(day_of(F.col("path")) >= F.date_format(F.timestamp_seconds(F.lit(now_s - days * 86_400)), "yyyy-MM-dd"))


def _both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("path", F.col("bytes").alias("a_bytes"), F.lit(True).alias("in_a")).join(b.select("path", F.col("bytes").alias("b_bytes"), F.lit(True).alias("in_b")), "path", "full")


def diff(remote: DataFrame, local: DataFrame) -> DataFrame:
    """path, state (missing, mismatch, extra), remote, local; equal files are left out."""
    state = F.when(F.col("in_b").isNull(), "missing").when(F.col("in_a").isNull(), "extra").when(~F.col("a_bytes").eqNullSafe(F.col("b_bytes")), "mismatch")
    return _both(remote, local).select("path", state.alias("state"), F.col("a_bytes").alias("remote"), F.col("b_bytes").alias("local")).where("state IS NOT NULL")


def reconcile(manifest: DataFrame, disk: DataFrame) -> DataFrame:
    """path, bytes (as on disk), change (gone, added, changed, NULL)."""
    change = F.when(F.col("in_b").isNull(), "gone").when(F.col("in_a").isNull(), "added").when(~F.col("a_bytes").eqNullSafe(F.col("b_bytes")), "changed")
    return _both(manifest, disk).select("path", F.col("b_bytes").alias("bytes"), change.alias("change"))


def residual(short: DataFrame, before: DataFrame, now: DataFrame) -> DataFrame:
    """Of files still short after a sync: growing where the remote size changed or the file went, else real."""
    j = short.join(before.select("path", F.col("bytes").alias("was")), "path", "left").join(now.select("path", F.col("bytes").alias("is")), "path", "left")
    return j.withColumn("state", F.when(F.col("was").eqNullSafe(F.col("is")), "real").otherwise("growing"))


def totals(classified: DataFrame, state: str = "state", bytes_: str = "bytes") -> DataFrame:
    return classified.groupBy(state).agg(F.count("*").alias("n"), F.coalesce(F.sum(bytes_), F.lit(0)).alias("bytes"))


def package_plan(remote: DataFrame, have: DataFrame, today: str, days: int, now_s: float) -> DataFrame:
    """name, plan (uptodate, redo, missing) of daily packages but today's, within the window. ``remote``: name, sha256; ``have``: name, sha256."""
    day = F.regexp_extract("name", r"(\d{4}-\d{2}-\d{2})", 1)
    r = remote.withColumn("day", day).where((F.col("day") != "") & (F.col("day") != today))
    if days:
        r = r.where(F.col("day") >= F.date_format(F.timestamp_seconds(F.lit(now_s - days * 86_400)), "yyyy-MM-dd"))
    j = r.join(have.select("name", F.col("sha256").alias("got")), "name", "left")
    return j.select("name", "day", F.when(F.col("got").isNull(), "missing").when(F.col("got") == F.col("sha256"), "uptodate").otherwise("redo").alias("plan"))


def stale_packages(packages: DataFrame, members: DataFrame) -> DataFrame:
    """Packages (day, mtime) older than their newest member (path, mtime)."""
    newest = members.groupBy(day_of(F.col("path")).alias("day")).agg(F.max("mtime").alias("newest"))
    return packages.join(newest, "day").where("mtime < newest")


def retention(packages: DataFrame, now_s: float, publish_days: int = 1, delete_days: int = 7, exempt: str = "l2_full") -> DataFrame:
    age = (F.lit(now_s) - F.col("mtime")) / 86_400
    keep = F.col("name").startswith(exempt)
    return packages.withColumn("publish", ~keep & (age <= publish_days)).withColumn("delete", ~keep & (age > delete_days))


def drift(snapshot: DataFrame, current: DataFrame) -> DataFrame:
    """name, state of files (name, sha256) that differ between a snapshot and what is there."""
    j = snapshot.select("name", F.col("sha256").alias("a")).join(current.select("name", F.col("sha256").alias("b")), "name", "full")
    return j.select("name", F.when(F.col("b").isNull(), "gone").when(F.col("a").isNull(), "new").when(F.col("a") != F.col("b"), "changed").alias("state")).where("state IS NOT NULL")


def verify_sha(want: DataFrame, got: DataFrame) -> DataFrame:
    """name, want, got where they differ."""
    return want.select("name", F.col("sha256").alias("want")).join(got.select("name", F.col("sha256").alias("got")), "name").where("want <> got")


def file_sha(spark, paths) -> DataFrame:
    return spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("sha256"))
