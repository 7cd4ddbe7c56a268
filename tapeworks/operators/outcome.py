"""Spread to outcome: snapshot, leader, won, return, and statistics by spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.scalars import fee_roi, roi, won
from tapeworks.operators.asof import as_of

#: Spread buckets [lo, hi) and cumulative thresholds. Fixed values.
BUCKETS = ((0.0, 0.015), (0.015, 0.025), (0.025, 0.035), (0.035, 0.055), (0.055, 1.0))
THRESHOLDS = (0.01, 0.02, 0.03, 0.05)


def snapshot(quotes: DataFrame, keys: list[str], offset_s: float, order: list[str]) -> DataFrame:
    """Per key and asset the last primary two-sided quote at or before bar + offset."""
    q = quotes.where("is_primary = 1 AND mid IS NOT NULL AND spread IS NOT NULL")
    return as_of(q, [*keys, "asset_id"], (F.col("bar_ts") + offset_s) * 1000, order, ["mid", "spread", "best_ask"])


def leaders(snap: DataFrame, keys: list[str]) -> DataFrame:
    """Per market the asset of highest mid (ties: smaller asset); kept with both sides or a mid above one half."""
    lead = F.min_by(F.struct("asset_id", "mid", "spread", "best_ask"), F.struct((-F.col("mid")).alias("m"), "asset_id")).alias("l")
    g = snap.groupBy(*keys).agg(lead, F.count("*").alias("n_sides"))
    return g.select(*keys, F.col("l.asset_id").alias("lead"), F.col("l.mid").alias("lead_mid"), F.col("l.spread").alias("spread"), F.col("l.best_ask").alias("ask"), "n_sides").where("n_sides = 2 OR lead_mid > 0.5")


def returns(lead: DataFrame, tokens: DataFrame, *, parity: bool = False) -> DataFrame:
    """Adds won, roi, fee_roi. Unsettled markets are left out; with ``parity`` they count as DOWN."""
    j = lead.join(tokens.select("market", "up_token", "down_token", "winner"), "market")
    j = j if parity else j.where("winner IS NOT NULL")
    j = j.withColumn("won", won(F.col("winner"), F.col("lead"), F.col("up_token"), F.col("down_token")))
    j = j.withColumn("roi", roi(F.col("won"), F.col("ask")))
    return j.withColumn("fee_roi", fee_roi(F.col("roi"), F.col("ask")))


def _stats() -> list:
    return [F.count("spread").alias("n"), (F.avg(F.col("won").cast("double")) * 100).alias("win_pct"), F.avg("ask").alias("ask"), F.avg("roi").alias("roi"), F.avg("fee_roi").alias("fee_roi")]


def by_bucket(r: DataFrame, buckets=BUCKETS) -> DataFrame:
    """lo, hi and statistics; an empty bucket has n 0; a spread below all buckets is in none."""
    each = F.explode(F.array(*[F.struct(F.lit(float(a)).alias("lo"), F.lit(float(b)).alias("hi")) for a, b in buckets]))
    dim = r.sparkSession.range(1, numPartitions=1).select(each.alias("b")).select("b.*")
    i = F.lit(None).cast("double")
    for a, b in buckets:
        i = F.when((F.col("spread") >= a) & (F.col("spread") < b), F.lit(float(a))).otherwise(i)
    stats = r.withColumn("lo", i).where("lo IS NOT NULL").groupBy("lo").agg(*_stats())
    return dim.join(stats, "lo", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def cumulative(r: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """Statistics of spread <= t for each threshold: a row goes to the thresholds it meets, aggregated before the shuffle."""
    ts = F.filter(F.array(*[F.lit(float(t)) for t in thresholds]), lambda t: F.col("spread") <= t)
    return r.withColumn("t", F.explode(ts)).groupBy("t").agg(*_stats())


def pooled(r: DataFrame, groups: list[str]) -> DataFrame:
    """Sums over each group and over all (NULL), and the ratio of sums."""
    g = r.rollup(*groups).agg(F.count("*").alias("n"), F.count_if("won").alias("wins"), F.sum("roi").alias("roi_sum"), F.sum("fee_roi").alias("fee_sum"))
    return g.withColumn("roi", F.col("roi_sum") / F.col("n"))
