"""Bar coverage: first and last book frame of each bar's dominant market."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.functions.scalars import utc_hour


def bar_offsets(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per bar (``keys`` with bar_ts): market with most book rows (ties: first seen), book_rows, first, last (seconds from the start), markets_seen.

    ``rows``: keys, market, ts_ms, is_book, seq. Rows without a time are no book rows; a bar without any is absent. The rows are
    grouped once, by bar and market; what follows reads those groups.
    """
    usable = F.coalesce(F.col("is_book") & (F.col("ts_ms") > 0), F.lit(False))
    at = F.when(usable, F.col("ts_ms"))
    each = rows.groupBy(*keys, "market").agg(F.count(at).alias("book_rows"), F.min(at).alias("lo"), F.max(at).alias("hi"), F.min("seq").alias("_seq"))
    best = F.max_by(F.struct("market", "book_rows", "lo", "hi"), F.struct(F.col("book_rows"), -F.col("_seq")))
    bars = each.groupBy(*keys).agg(best.alias("_b"), F.count("market").alias("markets_seen")).where("_b.book_rows > 0")
    offset = lambda c: F.col(f"_b.{c}") / 1000 - F.col("bar_ts")
    return bars.select(*keys, "_b.market", "_b.book_rows", "markets_seen", offset("lo").alias("first"), offset("hi").alias("last"))


#: Columns of the report: metric and share.
RANKS = {"first_p50": ("first", 0.5), "first_p90": ("first", 0.9), "last_p50": ("last", 0.5), "cover_p50": ("cover", 0.5), "rows_p50": ("book_rows", 0.5)}


def report(offsets: DataFrame, groups: list[str], *, by_hour: bool = True, ok_s: float = 10.0, late_s: float = 90.0) -> DataFrame:
    """Per group and, with ``by_hour``, UTC hour (NULL: all): bars, nearest-rank percentiles, ok_pct, late, latest.

    All of them come from counts per value and their running sums: no group's values are gathered in a list, and nothing is read or joined twice.
    """
    hour = F.explode(F.array(utc_hour(F.col("bar_ts")), F.lit(None).cast("int"))) if by_hour else F.lit(None).cast("int")
    keys = [*groups, "hour"]
    values = {"first": F.col("first"), "last": F.col("last"), "cover": F.col("last") - F.col("first"), "book_rows": F.col("book_rows").cast("double")}
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in values.items()]))
    counts = offsets.select("*", hour.alias("hour")).select(*keys, each.alias("x")).groupBy(*keys, "x.metric", "x.value").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys, "metric")  # rows that lie together by keys do so by keys and metric
    run = counts.repartition(*keys).withColumn("upto", F.sum("n").over(w.orderBy("value"))).withColumn("all", F.sum("n").over(w))
    first, n = F.col("metric") == "first", F.col("n")
    rank = lambda q: F.bround(F.lit(q) * (F.col("all") - 1), 0)  # noqa: E731  halves go to the even rank
    ranked = [F.min(F.when((F.col("metric") == m) & (F.col("upto") > rank(q)), F.col("value"))).alias(name) for name, (m, q) in RANKS.items()]
    total = lambda c: F.coalesce(F.sum(F.when(first & c, n)), F.lit(0))
    out = run.groupBy(*keys).agg(
        total(F.lit(True)).alias("bars"), *ranked, (total(F.col("value") <= ok_s) * 100 / total(F.lit(True))).alias("ok_pct"), total(F.col("value") > late_s).alias("late"), F.max(F.when(first, F.col("value"))).alias("latest")
    )
    return out.withColumn("rows_p50", F.col("rows_p50").cast("long"))
