"""Raw frames: gzip JSON lines, one file per bar, read without failing on bad lines or cut files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.scalars import slug_of
from tapeworks.schemas import RAW_FRAME
from tapeworks.sources.captures import gzip_lines

# What file names look like, and where a line names its event.
EVENT_RULE = r'"event_type"\s*:\s*"([^"]+)"'
NAME_RULE = r"([a-z]+)-updown-(\d+m)-(\d+)\.jsonl\.gz$"


def resolve(root: str, *days: str) -> list[str]:
    """Glob paths below ``root`` for days, months (YYYY-MM), or paths given as they are; all days without any."""
    out = []
    for d in days or ("*",):
        if re.fullmatch(r"\d{4}-\d{2}", d):
            out.append(f"{root}/{d}-*/*.jsonl.gz")
        elif re.fullmatch(r"\d{4}-\d{2}-\d{2}|\*", d):
            out.append(f"{root}/{d}/*.jsonl.gz")
        else:
            out.append(d if d.endswith(".gz") else f"{d.rstrip('/')}/*.jsonl.gz")
    return sorted(set(out))


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """value, seq (line order within a file), file, day, coin, cycle, bar_ts, slug; blank lines are gone.

    A file that breaks off gives its lines up to there. Names that don't fit give other / other / 0.
    """
    lines = spark.read.option("ignoreCorruptFiles", "true").text(paths)
    return named(lines.select("value", F.monotonically_increasing_id().alias("seq"), F.col("_metadata.file_path").alias("file"))).where(F.trim("value") != "")


def named(rows: DataFrame) -> DataFrame:
    """Adds what a file's name says: day, coin, cycle, bar_ts, slug."""
    name = F.element_at(F.split("file", "/"), -1)
    part = lambda i: F.nullif(F.regexp_extract(name, NAME_RULE, i), F.lit(""))
    return rows.withColumns({
        "day": F.element_at(F.split("file", "/"), -2), "coin": F.coalesce(part(1), F.lit("other")), "cycle": F.coalesce(part(2), F.lit("other")),
        "bar_ts": F.coalesce(part(3).cast("long"), F.lit(0)), "slug": slug_of(name),
    })


def read_captures(spark: SparkSession, paths: str | list[str], *, whole: bool = False) -> DataFrame:
    """As ``read_lines``, with all lines and a closing row a file: status (NULL for lines), bytes, error.

    seq counts a file's lines. With ``whole``, files that break off have their closing row alone. One pass gives
    both, so counts of lines and of damaged files come from one scan; ``lines`` and ``closing`` take them apart.
    """
    return named(gzip_lines(spark, paths, whole=whole))


def matching(rows: DataFrame, *, coins: list[str] | None = None, cycles: list[str] | None = None, days: list[str] | None = None, name: str = "") -> DataFrame:
    """Rows of files by what their names say: coins and cycles as whole words, days as prefixes (2026-01 is a month), ``name`` as a part of the file's name.

    Without a condition all rows stay; an empty list keeps none.
    """
    keep = F.lit(True)
    for column, wanted in (("coin", coins), ("cycle", cycles)):
        if wanted is not None:
            keep = keep & F.col(column).isin(wanted)
    if days is not None:
        keep = keep & F.exists(F.array(*[F.lit(d) for d in days]).cast("array<string>"), lambda d: F.col("day").startswith(d))
    return rows.where(keep & F.element_at(F.split("file", "/"), -1).contains(name))


def lines(captures: DataFrame) -> DataFrame:
    return captures.where(F.col("status").isNull() & (F.trim("value") != "")).drop("status", "bytes", "error")


def closing(captures: DataFrame) -> DataFrame:
    """file, day, slug, status (ok, truncated, corrupt, unreadable), lines (that were given), bytes, error."""
    return captures.where("status IS NOT NULL").select("file", "day", "slug", "status", F.col("seq").alias("lines"), "bytes", "error")


def damaged(captures: DataFrame) -> DataFrame:
    return closing(captures).where("status <> 'ok'")


def parse(lines: DataFrame, *, books_only: bool = False) -> DataFrame:
    """Adds the frame's fields as struct ``f`` and bad_json. ``books_only`` parses lines with "book" alone; ev is the event by pattern."""
    f = F.from_json("value", RAW_FRAME, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"})
    ev = F.nullif(F.regexp_extract("value", EVENT_RULE, 1), F.lit(""))
    if books_only:
        f = F.when(F.col("value").contains('"book"'), f)
    out = lines.withColumn("ev", ev).withColumn("f", f)
    return out.withColumn("bad_json", F.col("f._corrupt").isNotNull() if books_only else (F.col("f").isNull() | F.col("f._corrupt").isNotNull())).drop("value")


def kind(frames: DataFrame) -> DataFrame:
    """Adds ``kind``: book, trade, gap or NULL."""
    e, m = F.col("f.event_type"), F.col("f.mark")
    return frames.withColumn("kind", F.when(F.col("bad_json"), None).when(e == "book", "book").when(e == "last_trade_price", "trade").when(e.isNull() & (m == "gap"), "gap"))


def without_files(frames: DataFrame, bad_files: DataFrame) -> DataFrame:
    """Drops all rows of files that are listed as damaged (column file)."""
    return frames.join(bad_files.select("file"), "file", "left_anti")
