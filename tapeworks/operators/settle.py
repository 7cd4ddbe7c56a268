"""Settlement check: the winner as the last bids tell it, against the official one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_MS, CLOSE_MS, COVER_MS = 60_000, 2_000, 20_000


def predict(quotes: DataFrame, markets: DataFrame, order: list[str]) -> DataFrame:
    """Per settled market: bid_up, bid_dn (-1: none), pred, winner, reason (NULL: used).

    ``markets``: market, up_token, down_token, winner, start_ms, cycle_ms. The last bid of a side is its last
    non-null one in [end - 60 s, end - 2 s]; equal bids say DOWN. Reasons: no_window (no bar time), no_cover
    (no frame in the last 20 s), no_bid (neither side).
    """
    m = markets.where("winner IN ('UP', 'DOWN')").withColumn("end", F.col("start_ms") + F.col("cycle_ms"))
    j = quotes.join(m, "market")
    inside = F.col("best_bid").isNotNull() & F.col("ts_ms").between(F.col("end") - WINDOW_MS, F.col("end") - CLOSE_MS)
    last = lambda token: F.max_by(F.when(inside & (F.col("asset_id") == F.col(token)), F.col("best_bid")), F.when(inside & (F.col("asset_id") == F.col(token)), F.struct(*order)))
    g = j.groupBy("market", "winner", "end").agg(last("up_token").alias("up"), last("down_token").alias("dn"), F.max("ts_ms").alias("seen"))
    reason = F.when(F.col("end").isNull(), "no_window").when(F.col("seen") < F.col("end") - COVER_MS, "no_cover").when(F.col("up").isNull() & F.col("dn").isNull(), "no_bid")
    none = lambda c: F.coalesce(c, F.lit(-1.0))
    return g.select("market", "winner", none("up").alias("bid_up"), none("dn").alias("bid_dn"), F.when(none("up") > none("dn"), "UP").otherwise("DOWN").alias("pred"), reason.alias("reason"))


def agreement(predicted: DataFrame) -> DataFrame:
    """winner (NULL: both), n, agree, rate and the median bids, of used markets."""
    used = predicted.where("reason IS NULL")
    g = used.rollup("winner").agg(F.count("*").alias("n"), F.count_if(F.col("pred") == F.col("winner")).alias("agree"), F.median("bid_up").alias("up_median"), F.median("bid_dn").alias("dn_median"))
    return g.withColumn("rate", F.col("agree") / F.col("n"))


def reasons(predicted: DataFrame) -> DataFrame:
    return predicted.groupBy(F.coalesce("reason", F.lit("used")).alias("reason")).agg(F.count("*").alias("n"))


def mismatches(predicted: DataFrame, top: int = 10) -> DataFrame:
    return predicted.where("reason IS NULL AND pred <> winner").orderBy("market").limit(top)


def gate(rate_row, least: int = 50, rate: float = 0.99) -> bool:
    return bool(rate_row and rate_row["n"] >= least and rate_row["rate"] >= rate)
