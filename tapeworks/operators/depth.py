"""Depth and interval audit over book frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions import book
from tapeworks.functions.scalars import interval_bucket
from tapeworks.operators.asof import lagged
from tapeworks.sources import frames as raw


def profile(frames: DataFrame, bids: str = "bids", asks: str = "asks") -> DataFrame:
    """Adds counts, boundary prices and step flags of each book frame; counts are of prices that parse."""
    f = frames.withColumns({"_b": book.prices(F.col(bids)), "_a": book.prices(F.col(asks))})
    f = f.withColumns({"_bs": book.steps(F.col("_b")), "_as": book.steps(F.col("_a"))})
    return f.withColumns({
        "bid_n": F.size("_b"), "ask_n": F.size("_a"), "bid_min": F.array_min("_b"), "ask_max": F.array_max("_a"),
        "bid_odd": book.odd_step(F.col("_bs")), "ask_odd": book.odd_step(F.col("_as")), "bid_hole": book.hole(F.col("_bs")), "ask_hole": book.hole(F.col("_as")),
        "bid_low": book.reaches_low(F.col("_b")), "ask_high": book.reaches_high(F.col("_a")),
    }).drop("_b", "_a", "_bs", "_as")


def totals(profiled: DataFrame) -> DataFrame:
    """One row: frames, empty sides, boundary, odd-step and hole counts (holes of either side apart), shares of deep books."""
    n = lambda c: F.count_if(c)
    return profiled.agg(
        F.count("*").alias("frames"), n(F.col("bid_n") == 0).alias("bid_empty"), n(F.col("ask_n") == 0).alias("ask_empty"), n("bid_low").alias("bid_low"),
        n("ask_high").alias("ask_high"), n("bid_odd").alias("bid_odd"), n("ask_odd").alias("ask_odd"), n("bid_hole").alias("bid_hole"), n("ask_hole").alias("ask_hole"),
        F.avg((F.col("bid_n") >= 50).cast("double")).alias("bid_50"), F.avg((F.col("bid_n") >= 90).cast("double")).alias("bid_90"),
    )


def histograms(profiled: DataFrame) -> DataFrame:
    """metric, key, n in one pass."""
    pairs = [("bid_n", F.col("bid_n").cast("double")), ("ask_n", F.col("ask_n").cast("double")), ("bid_min", F.col("bid_min")), ("ask_max", F.col("ask_max"))]
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), k.alias("key")) for m, k in pairs]))
    return profiled.select(each.alias("x")).select("x.*").where("key IS NOT NULL").groupBy("metric", "key").agg(F.count("*").alias("n"))


def percentile(histogram: DataFrame, p: float, groups: list[str]) -> DataFrame:
    """The least key whose cumulative count reaches p of all."""
    w = Window.partitionBy(*groups)
    run = histogram.withColumn("_c", F.sum("n").over(w.orderBy("key"))).withColumn("_t", F.sum("n").over(w))
    return run.where(F.col("_c") >= F.col("_t") * p).groupBy(*groups).agg(F.min("key").alias("key"))


def percentiles(histogram: DataFrame, shares: list[float], groups: list[str]) -> DataFrame:
    """p, key for each of ``shares``, from one running sum."""
    w = Window.partitionBy(*groups)
    run = histogram.withColumn("_c", F.sum("n").over(w.orderBy("key"))).withColumn("_t", F.sum("n").over(w))
    least = [F.min(F.when(F.col("_c") >= F.col("_t") * p, F.col("key"))) for p in shares]
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(f"_{i}").alias("key")) for i, p in enumerate(shares)]))
    return run.groupBy(*groups).agg(*[x.alias(f"_{i}") for i, x in enumerate(least)]).select(*groups, each.alias("x")).select(*groups, "x.*")


def most_common(histogram: DataFrame, metric: str, top: int) -> DataFrame:
    return histogram.where(F.col("metric") == metric).orderBy(F.desc("n"), "key").limit(top)


def intervals(frames: DataFrame, keys: list[str], seq: str = "seq", ts: str = "ts_ms") -> DataFrame:
    """bucket, n of times between neighbours in file order; a step back is not counted but becomes the next one's start."""
    gaps = lagged(frames.where(F.col(ts).isNotNull()), keys, seq, ts).where(F.col(ts) >= F.col("prev"))
    return gaps.groupBy(interval_bucket((F.col(ts) - F.col("prev")) / 1000).alias("bucket")).agg(F.count("*").alias("n"))


def regressions(frames: DataFrame, keys: list[str], seq: str = "seq", ts: str = "ts_ms") -> DataFrame:
    return lagged(frames, keys, seq, ts).where(F.col(ts) < F.col("prev"))


def audit(captures: DataFrame) -> DataFrame:
    """One row over ``frames.read_captures``: files, files_unreadable, lines, bad_json, book_frames, in one pass.

    Lines of a file that breaks off count up to the break, and the file is one that could not be read.
    """
    line, said = F.col("status").isNull(), F.col("value").contains('"book"')
    good = F.coalesce(F.col("f").isNotNull() & F.col("f._corrupt").isNull(), F.lit(False))
    rows = raw.parse(captures.withColumn("_said", said), books_only=True)
    return rows.agg(
        F.count_if(~line).alias("files"), F.count_if(~line & (F.col("status") != "ok")).alias("files_unreadable"), F.count_if(line).alias("lines"),
        F.count_if(line & F.col("_said") & ~good).alias("bad_json"), F.count_if(line & good & (F.col("f.event_type") == "book")).alias("book_frames"),
    )


def event_counts(captures: DataFrame) -> DataFrame:
    """ev, n of all lines that name an event; book lines without one are "?"."""
    rows = raw.parse(captures.where(F.col("status").isNull()).withColumn("_said", F.col("value").contains('"book"')), books_only=True)
    ev = F.when(F.col("_said") & ~F.col("bad_json"), F.coalesce(F.nullif("f.event_type", F.lit("")), F.lit("?"))).when(~F.col("_said"), F.col("ev"))
    return rows.select(ev.alias("ev")).where("ev IS NOT NULL").groupBy("ev").agg(F.count("*").alias("n"))


def tidy(one_row: DataFrame) -> DataFrame:
    """metric, key (NULL), n: the columns of a one-row report as rows."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.lit(None).cast("string").alias("key"), F.col(c).cast("double").alias("n")) for c in one_row.columns]))
    return one_row.select(each.alias("x")).select("x.*")


def dump(path: str, reports: list[DataFrame], counts: dict[str, DataFrame]) -> None:
    """The audit as JSON lines (metric, key, n): one-row reports, and counts (metric, key, n or any first column and n) by name."""
    out = None
    for df in [tidy(r) for r in reports]:
        out = df if out is None else out.unionByName(df)
    for name, df in counts.items():
        metric = F.col("metric") if "metric" in df.columns else F.lit(name)
        key = "key" if "key" in df.columns else next(c for c in df.columns if c != "n")
        rows = df.select(metric.alias("metric"), F.col(key).cast("string").alias("key"), F.col("n").cast("double").alias("n"))
        out = rows if out is None else out.unionByName(rows)
    out.sort("metric", "key").coalesce(1).write.mode("overwrite").json(path)
