"""Raw frames to quotes, trades and marks; their sink; and the check of one against the other."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions import book
from tapeworks.functions.scalars import safe_double, safe_long
from tapeworks.operators.asof import first_seen_mode

SORT = {"quotes": ("asset_id", "ts_ms"), "trades": ("asset_id", "ts_ms"), "marks": ("from_ts",)}


def file_summary(frames: DataFrame) -> DataFrame:
    """Per file: rows, bad_json, n_markets, primary (most frequent market of all kinds, ties: first seen)."""
    market = F.nullif(F.col("f.market"), F.lit(""))
    f = frames.withColumn("market", market)
    counts = f.groupBy("file").agg(F.count("*").alias("rows"), F.count_if("bad_json").alias("bad_json"), F.count_distinct("market").alias("n_markets"))
    mode = first_seen_mode(f.where("market IS NOT NULL"), ["file"], "market", "seq").select("file", F.col("market").alias("primary"))
    return counts.join(mode, "file", "left")


def market_ids(frames: DataFrame) -> DataFrame:
    return frames.select(F.col("f.market").alias("market")).where("market <> ''").distinct()


def sides(tokens: DataFrame, *, parity: bool = False) -> DataFrame:
    """asset_id, side (1 up, 0 down). Reversed outcomes count too, unless ``parity`` asks for plain ones only."""
    t = tokens.where(F.col("outcome_kind") == "updown" if parity else F.col("outcome_kind").isin("updown", "updown_rev"))
    pair = F.explode(F.array(F.struct(F.col("up_token").alias("asset_id"), F.lit(1).alias("side")), F.struct(F.col("down_token").alias("asset_id"), F.lit(0).alias("side"))))
    return t.select(pair.alias("x")).select("x.asset_id", F.col("x.side").cast("tinyint").alias("side")).where("asset_id IS NOT NULL").dropDuplicates(["asset_id"])


def with_context(frames: DataFrame, summary: DataFrame, side: DataFrame) -> DataFrame:
    """Adds side (-1: unknown) and is_primary. The small sides are broadcast by size where Spark finds them small."""
    return with_primary(with_side(frames.withColumn("asset_id", F.col("f.asset_id")), side), summary, ["file"], F.col("f.market"))


def with_side(rows: DataFrame, side: DataFrame) -> DataFrame:
    """Adds the side of asset_id, -1 where it is unknown."""
    return rows.join(side, "asset_id", "left").withColumn("side", F.coalesce("side", F.lit(-1).cast(dict(side.dtypes)["side"])))


def with_primary(rows: DataFrame, primary: DataFrame, keys: list[str], market: Column) -> DataFrame:
    """Adds primary, and is_primary: 1 for rows of the primary market of their ``keys``."""
    f = rows.join(primary.select(*keys, "primary"), keys, "left")
    return f.withColumn("is_primary", F.when((market != "") & (market == F.col("primary")), 1).otherwise(0).cast("tinyint"))


def quotes(frames: DataFrame) -> DataFrame:
    b, a = book.best(F.col("f.bids"), True), book.best(F.col("f.asks"), False)
    q = frames.where("kind = 'book'").withColumns({"_b": b, "_a": a})
    bid, ask = F.col("_b.price"), F.col("_a.price")
    return q.select(
        "day", "coin", "cycle", safe_long(F.col("f.timestamp"), 0).alias("ts_ms"), "bar_ts", F.col("f.market").alias("market"), "asset_id", "side",
        bid.alias("best_bid"), F.col("_b.size").alias("best_bid_sz"), ask.alias("best_ask"), F.col("_a.size").alias("best_ask_sz"),
        book.mid(bid, ask).alias("mid"), book.spread(bid, ask).alias("spread"), book.level_count(F.col("f.bids")).alias("n_bids"),
        book.level_count(F.col("f.asks")).alias("n_asks"), F.col("f.hash").alias("book_hash"), "slug", "is_primary", "file", "seq",
    )


def trades(frames: DataFrame) -> DataFrame:
    return frames.where("kind = 'trade'").select(
        "day", "coin", "cycle", safe_long(F.col("f.timestamp"), 0).alias("ts_ms"), "bar_ts", F.col("f.market").alias("market"), "asset_id", "side",
        F.col("f.side").alias("taker_side"), safe_double(F.col("f.price")).alias("price"), safe_double(F.col("f.size")).alias("size"),
        safe_long(F.col("f.fee_rate_bps"), 0).cast("int").alias("fee_rate_bps"), F.col("f.transaction_hash").alias("tx_hash"), "slug", "is_primary", "file", "seq",
    )


def marks(frames: DataFrame) -> DataFrame:
    f = frames.where("kind = 'gap'")
    zero = lambda c: F.coalesce(F.col(f"f.{c}"), F.lit(0.0)).alias(c)
    return f.select("day", "coin", "cycle", "bar_ts", zero("from_ts"), zero("to_ts"), zero("lost_s"), F.coalesce("f.slug", "slug").alias("slug"), F.col("f.note").alias("note"), "file", "seq")


def write(table: DataFrame, name: str, out: str) -> None:
    """Parquet by day, coin and cycle; only the partitions present are replaced; rows lie by asset and time.

    Ranges over all sort columns, so that a large day of one line is written by several tasks.
    """
    order = [*SORT[name], "file", "seq"]
    rows = table.repartitionByRange("day", "coin", "cycle", *order).sortWithinPartitions("day", "coin", "cycle", *order).drop("file", "seq")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("day", "coin", "cycle").parquet(f"{out}/{name}")


def write_tokens(tokens: DataFrame, out: str) -> None:
    tokens.orderBy("market").coalesce(1).write.mode("overwrite").parquet(f"{out}/bar_tokens")


def row_counts(frames: DataFrame, by: str = "day") -> DataFrame:
    """day or other column ``by`` (NULL: all), kind, n."""
    return frames.where("kind IS NOT NULL").groupingSets([[by, "kind"], ["kind"]], by, "kind").agg(F.count("*").alias("n"))


def unknown_assets(rows: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent assets of unknown side."""
    return rows.where("side = -1").groupBy("asset_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "asset_id").limit(top)


def unknown_totals(rows: DataFrame) -> DataFrame:
    """One row: rows of unknown side, and how many assets they name."""
    return rows.where("side = -1").agg(F.count("*").alias("rows"), F.count_distinct("asset_id").alias("assets"))


def sample_files(frames: DataFrame, n: int = 8, seed: int = 7) -> DataFrame:
    return frames.select("file").distinct().orderBy(F.xxhash64("file", F.lit(seed)), "file").limit(n)


def compare(raw: DataFrame, stored: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Rows of ``raw`` that ``stored`` lacks or holds differently; NULL equals NULL."""
    same = F.lit(True)
    for c in fields:
        same = same & F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    met = raw.alias("r").join(stored.withColumn("_there", F.lit(True)).alias("s"), on, "left")
    best = met.groupBy(*[F.col(f"r.{k}").alias(k) for k in keys], *[F.col(f"r.{c}").alias(c) for c in fields]).agg(
        F.coalesce(F.bool_or("s._there"), F.lit(False)).alias("found"), F.bool_or(F.coalesce(F.col("s._there"), F.lit(False)) & same).alias("equal")
    )
    return best.where("NOT equal")


def stored_rows(spark: SparkSession, out: str, name: str) -> DataFrame:
    """day, coin, cycle, n of a derived table, from the files' footers: the count is pushed into the Parquet scan.

    That takes the V2 reader, which a session of its own switches on, and a grouping by all partition columns.
    A table that is not there has no rows.
    """
    own = spark.newSession()
    for key, value in {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true", "spark.sql.sources.partitionColumnTypeInference.enabled": "false"}.items():
        own.conf.set(key, value)
    try:
        return own.read.parquet(f"{out}/{name}").groupBy("day", "coin", "cycle").agg(F.count("*").alias("n"))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "day string, coin string, cycle string, n long")


def verify(frames: DataFrame, out: str) -> DataFrame:
    """table, day, raw, stored of the processed days where the counts differ; stored rows are counted in footers."""
    spark, bad = frames.sparkSession, None
    for name, kind in (("quotes", "book"), ("trades", "trade"), ("marks", "gap")):
        raw = frames.groupBy("day").agg(F.count_if(F.col("kind") == kind).alias("raw"))
        have = stored_rows(spark, out, name).groupBy("day").agg(F.sum("n").alias("stored"))
        both = raw.join(have, "day", "left").select(F.lit(name).alias("table"), "day", "raw", F.coalesce("stored", F.lit(0)).cast("long").alias("stored")).where("raw <> stored")
        bad = both if bad is None else bad.unionByName(both)
    return bad
