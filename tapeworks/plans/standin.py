"""The driver's star-schema tables seen as order-book data.

``events``: an asset is a user, a market a pair of users within a seven-day bar; views and clicks are book
frames, purchases trades, errors marks. ``lineitem``: an order's lines are price levels, returned ones bids
('A') and asks ('R').
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.sources import frames as raw

BAR_S, OFFSET_S = 604_800, 302_400


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    e = e.select(F.col("event_id").alias("seq"), F.col("user_id").alias("asset_id"), "event_type", "value", "props", ms.alias("ts_ms"))
    k = F.from_json("props", "k long")["k"]
    e = e.withColumns({"bar_ts": F.floor(F.col("ts_ms") / (BAR_S * 1000)) * BAR_S, "pair": F.expr("asset_id div 2"), "side": F.col("asset_id") % 2, "mid": F.col("value") / 500, "spread": (k % 8) / 100})
    said = F.when(F.col("event_type").isin("view", "click"), "book").when(F.col("event_type") == "purchase", "last_trade_price")
    f = F.struct(said.alias("event_type"), F.when(F.col("event_type") == "error", "gap").alias("mark"))
    e = raw.kind(e.withColumns({"f": f, "bad_json": F.lit(False)})).drop("f", "bad_json")
    return e.withColumns({"market": F.concat_ws("-", "pair", "bar_ts"), "best_ask": F.col("mid") + F.col("spread") / 2, "best_bid": F.col("mid") - F.col("spread") / 2, "is_primary": F.when(F.col("pair") % 13 != 5, 1).otherwise(0), "is_book": F.coalesce(F.col("kind") == "book", F.lit(False))})


EV = f"""ev AS (
  SELECT event_id AS seq, user_id AS asset_id, event_type, value, props, epoch_us(ts) // 1000 AS ts_ms, ((epoch_us(ts) // 1000) // {BAR_S * 1000}) * {BAR_S} AS bar_ts,
         user_id // 2 AS pair, user_id % 2 AS side, value / 500 AS mid, (CAST(json_extract(props, '$.k') AS BIGINT) % 8) / 100.0::DOUBLE AS spread,
         CASE WHEN event_type IN ('view', 'click') THEN 'book' WHEN event_type = 'purchase' THEN 'trade' WHEN event_type = 'error' THEN 'gap' END AS kind FROM events),
e AS (SELECT *, CASE WHEN pair % 13 <> 5 THEN 1 ELSE 0 END AS own, CAST(pair AS VARCHAR) || '-' || CAST(bar_ts AS VARCHAR) AS market, mid + spread / 2 AS best_ask, mid - spread / 2 AS best_bid FROM ev)"""


def tokens(f: DataFrame) -> DataFrame:
    """market, up_token, down_token, winner: the asset of the market's last purchase, NULL without one."""
    w = F.max_by(F.when(F.col("kind") == "trade", F.col("asset_id")), F.when(F.col("kind") == "trade", F.struct("ts_ms", "seq")))
    rows = f.groupBy("market").agg(w.cast("string").alias("winner"), F.first("pair").alias("pair"))  # a market has one pair
    return rows.select("market", (F.col("pair") * 2 + 1).cast("string").alias("up_token"), (F.col("pair") * 2).cast("string").alias("down_token"), "winner")


TOKENS = """tok AS (SELECT market, CAST(pair * 2 + 1 AS VARCHAR) AS up_token, CAST(pair * 2 AS VARCHAR) AS down_token,
  CAST(arg_max(asset_id, (ts_ms, seq)) FILTER (kind = 'trade') AS VARCHAR) AS winner FROM e GROUP BY market, pair)"""


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """l_orderkey, bids, asks; a level's price and size as text, in the order of the lines."""
    li = read(spark, sf_dir, "lineitem")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 10_000 + 0.5) / 10_000
    level = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", price.alias("p"))
    side = lambda flag: F.transform(F.sort_array(F.collect_list(F.when(F.col("l_returnflag") == flag, level))), lambda x: F.struct(x["p"].cast("string").alias("price"), x["l_quantity"].cast("string").alias("size")))
    return li.groupBy("l_orderkey").agg(side("A").alias("bids"), side("R").alias("asks"))


LEVELS = """lv AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS size, floor(l_extendedprice / l_quantity * 10000 + 0.5) / 10000 AS price,
  l_returnflag AS flag FROM lineitem)"""
