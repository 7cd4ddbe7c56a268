"""All registered queries over the driver's tables, each with the SQL it is held against."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.functions import book, scalars
from tapeworks.operators import asof, coverage, depth, derive, duplicates, inventory, outcome, settle
from tapeworks.plans.standin import BAR_S, EV, LEVELS, OFFSET_S, TOKENS, books, frames, read, tokens
from tapeworks.sources import captures, files, integrity, listings
from tapeworks.sources import frames as raw

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def r6(*names: str) -> list:
    return [F.round(n, 6).alias(n) for n in names]


def rounded(*names: str) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" for n in names)


# ---- frames, casts, buckets


@query(f"WITH {EV} SELECT kind, bar_ts, count(*) AS n FROM e WHERE kind IS NOT NULL GROUP BY GROUPING SETS ((kind, bar_ts), (kind))")
def frame_counts(spark, d):
    return derive.row_counts(frames(spark, d), "bar_ts").select("kind", "bar_ts", "n")


@query("SELECT (epoch_us(ts) // 300000000) * 300 AS bar_ts, event_type, count(*) AS n FROM events GROUP BY ALL")
def bar_bucket_counts(spark, d):
    bar = scalars.bar_of(F.unix_millis(F.col("ts").cast("timestamp")) / 1000, 300)
    return read(spark, d, "events").groupBy(bar.alias("bar_ts"), "event_type").agg(F.count("*").alias("n"))


MODE = "SELECT bar_ts, market, n FROM (SELECT bar_ts, market, count(*) AS n, row_number() OVER (PARTITION BY bar_ts ORDER BY count(*) DESC, min(seq)) AS rn FROM e {where} GROUP BY bar_ts, market) WHERE rn = 1"


@query(f"WITH {EV} " + MODE.format(where=""))
def primary_market_mode(spark, d):
    return asof.first_seen_mode(frames(spark, d), ["bar_ts"], "market", "seq").select("bar_ts", "market", "n")


@query(f"WITH {EV} " + MODE.format(where="WHERE kind = 'book'"))
def dominant_market_mode(spark, d):
    return asof.first_seen_mode(frames(spark, d), ["bar_ts"], "market", "seq", F.col("is_book")).select("bar_ts", "market", "n")


@query(f"WITH {EV}, p AS ({MODE.format(where='')}) SELECT e.bar_ts, count(*) FILTER (e.market = p.market) AS own, count(*) AS n FROM e JOIN p ON e.bar_ts = p.bar_ts GROUP BY e.bar_ts")
def is_primary_rows(spark, d):
    f = frames(spark, d).drop("is_primary")
    p = asof.first_seen_mode(f, ["bar_ts"], "market", "seq").select("bar_ts", F.col("market").alias("primary"))
    own = derive.with_primary(f, p, ["bar_ts"], F.col("market"))
    return own.groupBy("bar_ts").agg(F.sum("is_primary").alias("own"), F.count("*").alias("n"))


@query("""SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS head, TRY_CAST(o_orderpriority AS DOUBLE) AS whole,
  coalesce(CAST(trunc(TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE)) AS BIGINT), 0) AS whole_price FROM orders""")
def safe_cast(spark, d):
    p = F.col("o_orderpriority")
    return read(spark, d, "orders").select("o_orderkey", scalars.safe_double(F.substring(p, 1, 1)).alias("head"), scalars.safe_double(p).alias("whole"), scalars.safe_long(F.col("o_totalprice"), 0).alias("whole_price"))


# ---- book


TIE = "l_linenumber, l_partkey, l_suppkey, size, price"


@query(f"""WITH {LEVELS}, b AS (
  SELECT l_orderkey, arg_max(struct_pack(p := price, s := size), r) FILTER (flag = 'A') AS bid, arg_max(struct_pack(p := price, s := size), q) FILTER (flag = 'R') AS ask,
         count(*) FILTER (flag = 'A') AS n_bids, count(*) FILTER (flag = 'R') AS n_asks
  FROM (SELECT *, -row_number() OVER (PARTITION BY l_orderkey ORDER BY price DESC, {TIE}) AS r, -row_number() OVER (PARTITION BY l_orderkey ORDER BY price, {TIE}) AS q FROM lv)
  GROUP BY l_orderkey)
SELECT l_orderkey, bid.p AS best_bid, bid.s AS best_bid_sz, ask.p AS best_ask, ask.s AS best_ask_sz, round((bid.p + ask.p) / 2, 6) AS mid, round(ask.p - bid.p, 6) AS spread, n_bids, n_asks FROM b""")
def top_of_book(spark, d):
    b = books(spark, d).withColumns({"b": book.best(F.col("bids"), True), "a": book.best(F.col("asks"), False)})
    bid, ask = F.col("b.price"), F.col("a.price")
    return b.select(
        "l_orderkey", bid.alias("best_bid"), F.col("b.size").alias("best_bid_sz"), ask.alias("best_ask"), F.col("a.size").alias("best_ask_sz"), F.round(book.mid(bid, ask), 6).alias("mid"),
        F.round(book.spread(bid, ask), 6).alias("spread"), book.level_count(F.col("bids")).cast("long").alias("n_bids"), book.level_count(F.col("asks")).cast("long").alias("n_asks"),
    )


@query(f"""WITH {LEVELS}, s AS (SELECT l_orderkey, flag, price, round(price - lag(price) OVER (PARTITION BY l_orderkey, flag ORDER BY price), 4) AS step,
    max(price) OVER (PARTITION BY l_orderkey, flag) > min(price) OVER (PARTITION BY l_orderkey, flag) AS wide FROM lv WHERE flag IN ('A', 'R')),
g AS (SELECT l_orderkey, count(*) FILTER (flag = 'A') AS bid_n, count(*) FILTER (flag = 'R') AS ask_n, min(price) FILTER (flag = 'A') AS bid_min, max(price) FILTER (flag = 'R') AS ask_max,
    coalesce(bool_or(wide AND step <> 0.01) FILTER (flag = 'A'), false) AS bid_odd, coalesce(bool_or(wide AND step <> 0.01) FILTER (flag = 'R'), false) AS ask_odd,
    coalesce(bool_or(wide AND step > 0.0101) FILTER (flag = 'A'), false) AS bid_hole, coalesce(bool_or(wide AND step > 0.0101) FILTER (flag = 'R'), false) AS ask_hole FROM s GROUP BY l_orderkey)
SELECT k.l_orderkey, coalesce(bid_n, 0) AS bid_n, coalesce(ask_n, 0) AS ask_n, bid_min, ask_max, coalesce(bid_odd, false) AS bid_odd, coalesce(ask_odd, false) AS ask_odd,
  coalesce(bid_hole, false) AS bid_hole, coalesce(ask_hole, false) AS ask_hole FROM (SELECT DISTINCT l_orderkey FROM lineitem) k LEFT JOIN g ON k.l_orderkey = g.l_orderkey""")
def book_step_audit(spark, d):
    p = depth.profile(books(spark, d))
    return p.select("l_orderkey", F.col("bid_n").cast("long").alias("bid_n"), F.col("ask_n").cast("long").alias("ask_n"), "bid_min", "ask_max", "bid_odd", "ask_odd", "bid_hole", "ask_hole")


@query(f"""WITH {LEVELS}, g AS (SELECT l_orderkey, count(*) FILTER (flag = 'A') AS bid_n, count(*) FILTER (flag = 'R') AS ask_n,
  min(price) FILTER (flag = 'A') AS bid_min, max(price) FILTER (flag = 'R') AS ask_max FROM lv GROUP BY l_orderkey)
SELECT count(*) AS frames, count(*) FILTER (bid_n = 0) AS bid_empty, count(*) FILTER (ask_n = 0) AS ask_empty, count(*) FILTER (bid_min <= 0.0101) AS bid_low, count(*) FILTER (ask_max >= 0.9899) AS ask_high, round(avg(CASE WHEN bid_n >= 50 THEN 1.0::DOUBLE ELSE 0 END), 6) AS bid_50 FROM g""")
def depth_totals(spark, d):
    return depth.totals(depth.profile(books(spark, d))).select("frames", "bid_empty", "ask_empty", "bid_low", "ask_high", *r6("bid_50"))


@query(f"""WITH {LEVELS}, g AS (SELECT l_orderkey, CAST(count(*) FILTER (flag = 'A') AS DOUBLE) AS bid_n, CAST(count(*) FILTER (flag = 'R') AS DOUBLE) AS ask_n,
  min(price) FILTER (flag = 'A') AS bid_min, max(price) FILTER (flag = 'R') AS ask_max FROM lv GROUP BY l_orderkey),
u AS (SELECT 'bid_n' AS metric, bid_n AS key FROM g UNION ALL SELECT 'ask_n', ask_n FROM g UNION ALL SELECT 'bid_min', bid_min FROM g UNION ALL SELECT 'ask_max', ask_max FROM g)
SELECT metric, key, count(*) AS n FROM u WHERE key IS NOT NULL GROUP BY ALL""")
def depth_histograms(spark, d):
    return depth.histograms(depth.profile(books(spark, d)))


@query(f"""WITH {LEVELS}, g AS (SELECT l_orderkey, CAST(count(*) FILTER (flag = 'A') AS DOUBLE) AS bid_n, CAST(count(*) FILTER (flag = 'R') AS DOUBLE) AS ask_n FROM lv GROUP BY l_orderkey),
u AS (SELECT 'bid_n' AS metric, bid_n AS key FROM g UNION ALL SELECT 'ask_n', ask_n FROM g)
SELECT metric, p, quantile_disc(key, p) AS key FROM u, (SELECT unnest([0.1, 0.5, 0.9, 0.99]::DOUBLE[]) AS p) GROUP BY metric, p""".replace("quantile_disc(key, p)", "CASE p WHEN 0.1 THEN quantile_disc(key, 0.1) WHEN 0.5 THEN quantile_disc(key, 0.5) WHEN 0.9 THEN quantile_disc(key, 0.9) ELSE quantile_disc(key, 0.99) END"))
def hist_percentile(spark, d):
    h = depth.histograms(depth.profile(books(spark, d))).where("metric IN ('bid_n', 'ask_n')")
    return depth.percentiles(h, [0.1, 0.5, 0.9, 0.99], ["metric"]).select("metric", "p", "key")


@query(f"""WITH {LEVELS}, g AS (SELECT l_orderkey, CAST(count(*) FILTER (flag = 'A') AS DOUBLE) AS key FROM lv GROUP BY l_orderkey)
SELECT 'bid_n' AS metric, key, count(*) AS n FROM g GROUP BY key ORDER BY n DESC, key LIMIT 6""")
def most_common_counts(spark, d):
    return depth.most_common(depth.histograms(depth.profile(books(spark, d))), "bid_n", 6)


# ---- joins and top-k


@query("SELECT count(*) AS rows, count(DISTINCT l_suppkey) AS assets FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 12) ON l_suppkey = s_suppkey WHERE s_suppkey IS NULL")
def unknown_counts(spark, d):
    side = read(spark, d, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("asset_id"), F.col("s_nationkey").alias("side"))
    return derive.unknown_totals(derive.with_side(read(spark, d, "lineitem").select(F.col("l_suppkey").alias("asset_id")), side))


@query("""WITH lv AS (SELECT l_orderkey, l_returnflag AS flag, (l_partkey * 7 + l_linenumber) % 60 AS c FROM lineitem),
p AS (SELECT l_orderkey, flag, CASE WHEN flag = 'A' THEN greatest(c, 1) / 100.0::DOUBLE ELSE least(40 + c, 99) / 100.0::DOUBLE END AS price FROM lv WHERE flag IN ('A', 'R')),
g AS (SELECT l_orderkey, min(price) FILTER (flag = 'A') AS lo, max(price) FILTER (flag = 'R') AS hi FROM p GROUP BY l_orderkey)
SELECT k.l_orderkey, coalesce(lo <= 0.0101, false) AS bid_low, coalesce(hi >= 0.9899, false) AS ask_high FROM (SELECT DISTINCT l_orderkey FROM lineitem) k LEFT JOIN g ON k.l_orderkey = g.l_orderkey""")
def boundary_flags(spark, d):
    c = (F.col("l_partkey") * 7 + F.col("l_linenumber")) % 60
    side = lambda flag, cents: F.collect_list(F.when(F.col("l_returnflag") == flag, F.struct((cents / 100).cast("string").alias("price"), F.lit("1").alias("size"))))
    b = read(spark, d, "lineitem").groupBy("l_orderkey").agg(side("A", F.greatest(c, F.lit(1))).alias("bids"), side("R", F.least(c + 40, F.lit(99))).alias("asks"))
    return depth.profile(b).select("l_orderkey", "bid_low", "ask_high")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(s_nationkey, -1) AS side FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 12) ON l_suppkey = s_suppkey")
def side_lookup(spark, d):
    side = read(spark, d, "supplier").where("s_nationkey < 12").select(F.col("s_suppkey").alias("asset_id"), F.col("s_nationkey").alias("side"))
    li = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("asset_id"))
    return derive.with_side(li, side).select("l_orderkey", "l_linenumber", "l_partkey", F.col("asset_id").alias("l_suppkey"), "side")


@query("SELECT l_suppkey AS asset_id, count(*) AS n FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_nationkey < 12) ON l_suppkey = s_suppkey WHERE s_suppkey IS NULL GROUP BY l_suppkey ORDER BY n DESC, asset_id LIMIT 10")
def unknown_topk(spark, d):
    return derive.unknown_assets(side_lookup(spark, d).select(F.col("l_suppkey").alias("asset_id"), "side"))


@query(f"WITH {EV} SELECT market, asset_id, ts_ms, value, props FROM e WHERE kind = 'book' QUALIFY row_number() OVER (PARTITION BY market, asset_id ORDER BY ts_ms DESC, seq DESC) = 1")
def latest_per_asset(spark, d):
    return asof.latest(frames(spark, d).where("kind = 'book'"), ["market", "asset_id"], ["ts_ms", "seq"], ["ts_ms", "value", "props"])


@query(f"""WITH {EV}, g AS (SELECT (ts_ms - lag(ts_ms) OVER (PARTITION BY asset_id ORDER BY seq)) / 1000.0::DOUBLE / 10000 AS s FROM e WHERE kind = 'book')
SELECT CASE WHEN s < 0.05 THEN '0~0.05' WHEN s < 0.1 THEN '0.05~0.1' WHEN s < 0.2 THEN '0.1~0.2' WHEN s < 0.5 THEN '0.2~0.5' WHEN s < 1 THEN '0.5~1' WHEN s < 2 THEN '1~2'
  WHEN s < 5 THEN '2~5' WHEN s < 10 THEN '5~10' WHEN s < 60 THEN '10~60' ELSE '60~inf' END AS bucket, count(*) AS n FROM g WHERE s >= 0 GROUP BY 1""")
def interval_hist(spark, d):
    f = frames(spark, d).where("kind = 'book'").withColumn("ts_ms", F.col("ts_ms") / 10_000)
    return depth.intervals(f, ["asset_id"])


@query("""SELECT o_custkey, count(*) AS n FROM (SELECT o_custkey, epoch_ms(o_orderdate) AS t, lag(epoch_ms(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS p FROM orders)
WHERE t < p GROUP BY o_custkey""")
def time_regressions(spark, d):
    o = read(spark, d, "orders").select("o_custkey", F.col("o_orderkey").alias("seq"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"))
    return depth.regressions(o, ["o_custkey"]).groupBy("o_custkey").agg(F.count("*").alias("n"))


# ---- coverage

OFFSETS = f"""{EV}, k AS (SELECT pair % 7 AS line, * FROM e),
m AS (SELECT line, bar_ts, market, count(*) FILTER (kind = 'book') AS book_rows, min(ts_ms) FILTER (kind = 'book') AS lo, max(ts_ms) FILTER (kind = 'book') AS hi, min(seq) AS s,
  count(*) OVER (PARTITION BY line, bar_ts) AS markets_seen FROM k GROUP BY line, bar_ts, market),
o AS (SELECT line, bar_ts, market, book_rows, markets_seen, lo / 1000.0::DOUBLE - bar_ts AS first, hi / 1000.0::DOUBLE - bar_ts AS last FROM m WHERE book_rows > 0
  QUALIFY row_number() OVER (PARTITION BY line, bar_ts ORDER BY book_rows DESC, s) = 1)"""


def _offsets(spark, d):
    return coverage.bar_offsets(frames(spark, d).withColumn("line", F.col("pair") % 7), ["line", "bar_ts"])


@query(f"WITH {OFFSETS} SELECT line, bar_ts, market, book_rows, markets_seen, {rounded('first', 'last')} FROM o")
def bar_coverage(spark, d):
    return _offsets(spark, d).select("line", "bar_ts", "market", "book_rows", "markets_seen", *r6("first", "last"))


NEAREST = "list_sort(list({c}))[CAST(round_even({q} * (count(*) - 1), 0) AS INTEGER) + 1]"
COVER = f"""count(*) AS bars, round({NEAREST.format(c='first', q=0.5)}, 6) AS first_p50, round({NEAREST.format(c='first', q=0.9)}, 6) AS first_p90, round({NEAREST.format(c='last', q=0.5)}, 6) AS last_p50,
  round({NEAREST.format(c='last - first', q=0.5)}, 6) AS cover_p50, {NEAREST.format(c='book_rows', q=0.5)} AS rows_p50, round(avg(CASE WHEN first <= 20000 THEN 100.0::DOUBLE ELSE 0 END), 6) AS ok_pct,
  count(*) FILTER (first > 90000) AS late, round(max(first), 6) AS latest"""


@query(f"WITH {OFFSETS} SELECT line, {COVER} FROM o GROUP BY line")
def coverage_pct_nearest_rank(spark, d):
    r = coverage.report(_offsets(spark, d), ["line"], by_hour=False, ok_s=20_000, late_s=90_000)
    return r.select("line", "bars", *r6("first_p50", "first_p90", "last_p50", "cover_p50"), "rows_p50", *r6("ok_pct"), "late", *r6("latest"))


@query(f"WITH {OFFSETS}, h AS (SELECT *, CAST(bar_ts // 3600 % 24 AS INTEGER) AS hour FROM o) SELECT line, hour, {COVER} FROM h GROUP BY GROUPING SETS ((line, hour), (line))")
def coverage_grouping_sets(spark, d):
    r = coverage.report(_offsets(spark, d), ["line"], ok_s=20_000, late_s=90_000)
    return r.select("line", "hour", "bars", *r6("first_p50", "first_p90", "last_p50", "cover_p50"), "rows_p50", *r6("ok_pct"), "late", *r6("latest"))


# ---- outcome

SNAP = f"""{EV}, {TOKENS}, snap AS (SELECT market, pair, bar_ts, asset_id, arg_max(struct_pack(mid := mid, spread := spread, ask := best_ask), (ts_ms, seq)) AS x FROM e
  WHERE kind = 'book' AND own = 1 AND mid IS NOT NULL AND spread IS NOT NULL AND ts_ms <= (bar_ts + {OFFSET_S}) * 1000 GROUP BY ALL),
lead AS (SELECT market, bar_ts, arg_min(struct_pack(a := asset_id, x := x), (-x.mid, asset_id)) AS l, count(*) AS n_sides FROM snap GROUP BY market, bar_ts),
ld AS (SELECT market, bar_ts, l.a AS lead, l.x.mid AS lead_mid, l.x.spread AS spread, l.x.ask AS ask, n_sides FROM lead WHERE n_sides = 2 OR l.x.mid > 0.5),
w AS (SELECT ld.*, CASE WHEN winner = CAST(lead AS VARCHAR) THEN true WHEN lower(winner) IN ('up', '1') THEN CAST(lead AS VARCHAR) = up_token ELSE CAST(lead AS VARCHAR) = down_token END AS won
  FROM ld JOIN tok ON ld.market = tok.market WHERE winner IS NOT NULL),
r AS (SELECT *, CASE WHEN won THEN (1 - ask) / ask ELSE -1.0::DOUBLE END AS roi, CASE WHEN won THEN (1 - ask) / ask ELSE -1.0::DOUBLE END - 0.07::DOUBLE * (1 - ask) / ask AS fee_roi FROM w)"""


def _snap(spark, d):
    return outcome.snapshot(frames(spark, d).where("kind = 'book'"), ["market", "bar_ts"], OFFSET_S, ["ts_ms", "seq"])


def _returns(spark, d):
    lead = outcome.leaders(_snap(spark, d), ["market", "bar_ts"]).withColumn("lead", F.col("lead").cast("string"))
    return outcome.returns(lead, tokens(frames(spark, d)))


@query(f"WITH {SNAP} SELECT market, asset_id, {rounded('x.mid', 'x.spread').replace('AS x.', 'AS ')}, round(x.ask, 6) AS best_ask FROM snap")
def asof_snapshot(spark, d):
    return _snap(spark, d).select("market", "asset_id", *r6("mid", "spread", "best_ask"))


@query(f"WITH {SNAP} SELECT market, lead, {rounded('lead_mid', 'spread', 'ask')}, n_sides FROM ld")
def leader_pick(spark, d):
    return outcome.leaders(_snap(spark, d), ["market", "bar_ts"]).select("market", "lead", *r6("lead_mid", "spread", "ask"), "n_sides")


STATS = "count(spread) AS n, round(avg(CASE WHEN won THEN 100.0::DOUBLE ELSE 0 END), 6) AS win_pct, round(avg(ask), 6) AS ask, round(avg(roi), 6) AS roi, round(avg(fee_roi), 6) AS fee_roi"


@query(f"""WITH {SNAP}, b AS (SELECT * FROM (VALUES {', '.join(f'({a}::DOUBLE, {b}::DOUBLE)' for a, b in outcome.BUCKETS)}) t(lo, hi)),
s AS (SELECT lo, {STATS} FROM r JOIN b ON spread >= lo AND spread < hi GROUP BY lo)
SELECT b.lo, b.hi, coalesce(n, 0) AS n, win_pct, ask, roi, fee_roi FROM b LEFT JOIN s ON b.lo = s.lo""")
def roi_by_bucket(spark, d):
    return outcome.by_bucket(_returns(spark, d)).select("lo", "hi", "n", *r6("win_pct", "ask", "roi", "fee_roi"))


@query(f"WITH {SNAP} SELECT t, {STATS} FROM r JOIN (SELECT unnest({list(outcome.THRESHOLDS)}::DOUBLE[]) AS t) ON spread <= t GROUP BY t")
def roi_cumulative(spark, d):
    return outcome.cumulative(_returns(spark, d)).select("t", "n", *r6("win_pct", "ask", "roi", "fee_roi"))


@query(f"WITH {SNAP} SELECT bar_ts, count(*) AS n, count(*) FILTER (won) AS wins, round(sum(roi), 6) AS roi_sum, round(sum(fee_roi), 6) AS fee_sum, round(sum(roi) / count(*), 6) AS roi FROM r GROUP BY ROLLUP (bar_ts)")
def roi_pooled_rollup(spark, d):
    return outcome.pooled(_returns(spark, d), ["bar_ts"]).select("bar_ts", "n", "wins", *r6("roi_sum", "fee_sum", "roi"))


# ---- settlement: the last 40 % of a bar stands for its closing window

SETTLE = f"""{EV}, {TOKENS}, mk AS (SELECT e.market, up_token, down_token, winner, CASE WHEN pair % 11 = 0 THEN NULL ELSE min(bar_ts) + {BAR_S} END AS end_s FROM e JOIN tok ON e.market = tok.market
    WHERE winner IS NOT NULL GROUP BY e.market, pair, up_token, down_token, winner),
j AS (SELECT e.*, up_token, down_token, CASE WHEN winner = up_token THEN 'UP' ELSE 'DOWN' END AS winner, end_s,
    CAST((ts_ms - bar_ts * 1000) // 2500 AS BIGINT) + (bar_ts + {BAR_S}) * 1000 - {BAR_S * 1000 // 2500} AS t FROM e JOIN mk ON e.market = mk.market WHERE kind = 'book'),
i AS (SELECT *, best_bid IS NOT NULL AND t BETWEEN end_s * 1000 - 60000 AND end_s * 1000 - 2000 AS inside FROM j),
g AS (SELECT market, winner, end_s, arg_max(best_bid, (t, seq)) FILTER (inside AND CAST(asset_id AS VARCHAR) = up_token) AS up,
    arg_max(best_bid, (t, seq)) FILTER (inside AND CAST(asset_id AS VARCHAR) = down_token) AS dn, max(t) AS seen FROM i GROUP BY ALL),
p AS (SELECT market, winner, coalesce(up, -1) AS bid_up, coalesce(dn, -1) AS bid_dn, CASE WHEN coalesce(up, -1) > coalesce(dn, -1) THEN 'UP' ELSE 'DOWN' END AS pred,
    CASE WHEN end_s IS NULL THEN 'no_window' WHEN seen < end_s * 1000 - 20000 THEN 'no_cover' WHEN up IS NULL AND dn IS NULL THEN 'no_bid' END AS reason FROM g)"""


def _predicted(spark, d):
    f = frames(spark, d)
    t = F.floor((F.col("ts_ms") - F.col("bar_ts") * 1000) / 2500) + (F.col("bar_ts") + BAR_S) * 1000 - BAR_S * 1000 // 2500
    q = f.where("kind = 'book'").select("market", F.col("asset_id").cast("string").alias("asset_id"), "best_bid", t.alias("ts_ms"), "seq")
    m = tokens(f).where("winner IS NOT NULL").withColumn("winner", F.when(F.col("winner") == F.col("up_token"), "UP").otherwise("DOWN"))
    pair = F.expr("CAST(down_token AS BIGINT) div 2")
    start = F.when(pair % 11 != 0, F.split("market", "-")[1].cast("long") * 1000)
    return settle.predict(q, m.withColumn("start_ms", start).withColumn("cycle_ms", F.lit(BAR_S * 1000)), ["ts_ms", "seq"])


@query(f"WITH {SETTLE} SELECT market, winner, {rounded('bid_up', 'bid_dn')}, pred, reason FROM p")
def settle_predictions(spark, d):
    return _predicted(spark, d).select("market", "winner", *r6("bid_up", "bid_dn"), "pred", "reason")


@query(f"""WITH {SETTLE} SELECT winner, count(*) AS n, count(*) FILTER (pred = winner) AS agree, round(median(bid_up), 6) AS up_median, round(median(bid_dn), 6) AS dn_median,
  round(count(*) FILTER (pred = winner) / count(*), 6) AS rate FROM p WHERE reason IS NULL GROUP BY ROLLUP (winner)""")
def settle_agreement(spark, d):
    return settle.agreement(_predicted(spark, d)).select("winner", "n", "agree", *r6("up_median", "dn_median", "rate"))


@query(f"WITH {SETTLE} SELECT coalesce(reason, 'used') AS reason, count(*) AS n FROM p GROUP BY 1")
def settle_skip_reasons(spark, d):
    return settle.reasons(_predicted(spark, d))


@query(f"WITH {SETTLE} SELECT market, winner, {rounded('bid_up', 'bid_dn')}, pred FROM p WHERE reason IS NULL AND pred <> winner ORDER BY market LIMIT 10")
def settle_mismatches(spark, d):
    return settle.mismatches(_predicted(spark, d)).select("market", "winner", *r6("bid_up", "bid_dn"), "pred")


@query("SELECT event_type, round(median(value), 6) AS median FROM events GROUP BY event_type")
def median_interp(spark, d):
    return read(spark, d, "events").groupBy("event_type").agg(F.round(F.median("value"), 6).alias("median"))


# ---- inventories: orders as files, perturbed

FILES = """a AS (SELECT '2026-09-' || lpad(CAST(o_orderkey % 28 + 1 AS VARCHAR), 2, '0') || '/' || CAST(o_orderkey AS VARCHAR) AS path, CAST(floor(o_totalprice) AS BIGINT) AS bytes, o_orderkey AS k FROM orders),
b AS (SELECT path, CASE WHEN k % 7 = 0 THEN bytes + 1 ELSE bytes END AS bytes FROM a WHERE k % 5 <> 0 UNION ALL SELECT path || 'x', bytes FROM a WHERE k % 11 = 0),
f AS (SELECT coalesce(a.path, b.path) AS path, a.bytes AS a_bytes, b.bytes AS b_bytes, a.path IS NOT NULL AS in_a, b.path IS NOT NULL AS in_b FROM a FULL JOIN b ON a.path = b.path)"""


def _files(spark, d):
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.floor("o_totalprice").alias("bytes"))
    a = o.withColumn("path", F.concat(F.lit("2026-09-"), F.lpad((F.col("k") % 28 + 1).cast("string"), 2, "0"), F.lit("/"), F.col("k").cast("string")))
    b = a.where("k % 5 <> 0").select("path", F.when(F.col("k") % 7 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")).alias("bytes"))
    return a, b.union(a.where("k % 11 = 0").select(F.concat("path", F.lit("x")), "bytes"))


@query(f"""WITH {FILES} SELECT path, CASE WHEN NOT in_b THEN 'missing' WHEN NOT in_a THEN 'extra' ELSE 'mismatch' END AS state, a_bytes AS remote, b_bytes AS local FROM f
WHERE NOT in_a OR NOT in_b OR a_bytes IS DISTINCT FROM b_bytes""")
def inventory_diff(spark, d):
    return inventory.diff(*_files(spark, d))


@query(f"""WITH {FILES}, s AS (SELECT CASE WHEN NOT in_b THEN 'missing' WHEN NOT in_a THEN 'extra' ELSE 'mismatch' END AS state, a_bytes AS bytes FROM f
WHERE (NOT in_a OR NOT in_b OR a_bytes IS DISTINCT FROM b_bytes) AND substr(path, 1, 10) >= '2026-09-13') SELECT state, count(*) AS n, CAST(coalesce(sum(bytes), 0) AS BIGINT) AS bytes FROM s GROUP BY state""")
def inventory_window_totals(spark, d):
    a, b = (inventory.within_days(x, 2, 1_789_430_400.0) for x in _files(spark, d))
    return inventory.totals(inventory.diff(a, b), bytes_="remote")


@query(f"WITH {FILES} SELECT path, b_bytes AS bytes, CASE WHEN NOT in_b THEN 'gone' WHEN NOT in_a THEN 'added' WHEN a_bytes IS DISTINCT FROM b_bytes THEN 'changed' END AS change FROM f")
def inventory_reconcile(spark, d):
    return inventory.reconcile(*_files(spark, d))


@query(f"""WITH {FILES}, n AS (SELECT path, CASE WHEN k % 3 = 0 THEN bytes * 2 ELSE bytes END AS bytes FROM a WHERE k % 13 <> 0)
SELECT f.path, CASE WHEN a.bytes IS NOT DISTINCT FROM n.bytes THEN 'real' ELSE 'growing' END AS state FROM f LEFT JOIN a ON f.path = a.path LEFT JOIN n ON f.path = n.path WHERE in_a AND (NOT in_b OR a_bytes IS DISTINCT FROM b_bytes)""")
def growing_vs_real(spark, d):
    a, b = _files(spark, d)
    short = inventory.diff(a, b).where("state <> 'extra'").select("path")
    now = a.where("k % 13 <> 0").select("path", F.when(F.col("k") % 3 == 0, F.col("bytes") * 2).otherwise(F.col("bytes")).alias("bytes"))
    return inventory.residual(short, a, now).select("path", "state")


@query("""WITH r AS (SELECT 'l2_2026-09-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') || '_' || CAST(p_partkey AS VARCHAR) AS name, sha256(p_name) AS sha, p_partkey AS k,
  '2026-09-' || lpad(CAST(p_partkey % 28 + 1 AS VARCHAR), 2, '0') AS day FROM part)
SELECT name, day, CASE WHEN k % 4 = 0 THEN 'missing' WHEN k % 6 = 1 THEN 'redo' ELSE 'uptodate' END AS plan FROM r WHERE day <> '2026-09-20' AND day >= '2026-09-05'""")
def package_plan(spark, d):
    k = F.col("p_partkey")
    r = read(spark, d, "part").select(k, F.concat(F.lit("l2_2026-09-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("_"), k.cast("string")).alias("name"), F.sha2("p_name", 256).alias("sha256"))
    have = r.where("p_partkey % 4 <> 0").select("name", F.when(k % 6 == 1, F.lit("old")).otherwise(F.col("sha256")).alias("sha256"))
    return inventory.package_plan(r, have, "2026-09-20", 10, 1_789_430_400.0)


# ---- duplicates, digests, sets


@query("""SELECT 'lineitem' AS what, count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber)) AS "distinct", count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem
UNION ALL SELECT 'documents', count(*), count(DISTINCT coalesce(text, '~null')), count(*) - count(DISTINCT coalesce(text, '~null')) FROM documents""")
def dup_audit(spark, d):
    li = read(spark, d, "lineitem").select(F.lit("lineitem").alias("what"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("key"))
    docs = read(spark, d, "documents").select(F.lit("documents").alias("what"), F.sha2("text", 256).alias("key"))
    return duplicates.audit(li.union(docs), F.col("key"), ["what"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def dup_keys(spark, d):
    return duplicates.repeated(read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT doc_id, sha256(text) AS sha FROM documents")
def content_sha(spark, d):
    return read(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("sha"))


@query("SELECT CAST(doc_id AS VARCHAR) AS name, sha256(text) AS want, sha256(text || 'x') AS got FROM documents WHERE doc_id % 9 = 0 AND text IS NOT NULL")
def sha_verify(spark, d):
    docs = read(spark, d, "documents").where("text IS NOT NULL").withColumn("name", F.col("doc_id").cast("string"))
    got = docs.select("name", F.sha2(F.when(F.col("doc_id") % 9 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")), 256).alias("sha256"))
    return inventory.verify_sha(docs.select("name", F.sha2("text", 256).alias("sha256")), got)


SETS = "a AS (SELECT DISTINCT user_id, props FROM events WHERE event_id % 3 <> 0), b AS (SELECT DISTINCT user_id, props FROM events WHERE event_id % 3 <> 1)"


@query(f"""WITH {SETS}, x AS (SELECT (SELECT count(*) FROM a) AS n_a, (SELECT count(*) FROM b) AS n_b, (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS shared,
  (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS either) SELECT n_a, n_b, shared, either, n_a - shared AS only_a, n_b - shared AS only_b, round(n_a / either, 6) AS share_a, round(n_b / either, 6) AS share_b FROM x""")
def set_coverage(spark, d):
    a, b = (read(spark, d, "events").where(f"event_id % 3 <> {i}").select("user_id", "props") for i in (0, 1))
    return duplicates.coverage(a, b).select("n_a", "n_b", "shared", "either", "only_a", "only_b", *r6("share_a", "share_b"))


@query(f"WITH {SETS} SELECT 'union' AS op, * FROM (SELECT * FROM a UNION SELECT * FROM b) UNION ALL SELECT 'both', * FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'a_b', * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'b_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)")
def set_algebra(spark, d):
    a, b = (read(spark, d, "events").where(f"event_id % 3 <> {i}").select("user_id", "props") for i in (0, 1))
    return duplicates.algebra(a, b)


@query("""WITH RECURSIVE e AS (SELECT event_id, user_id, event_type, (epoch_us(ts) // 1000) / 1000.0::DOUBLE AS t FROM events),
k AS (SELECT event_id, user_id, event_type, t FROM e QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY t, event_id) = 1
  UNION ALL SELECT n.event_id, n.user_id, n.event_type, n.t FROM k JOIN LATERAL (SELECT e.* FROM e WHERE e.user_id = k.user_id AND e.event_type = k.event_type AND e.t - k.t >= 86400 ORDER BY e.t, e.event_id LIMIT 1) n ON true)
SELECT event_id, user_id, event_type FROM k""")
def dedup_window(spark, d):
    e = read(spark, d, "events").select("event_id", "user_id", "event_type", (F.unix_millis(F.col("ts").cast("timestamp")) / 1000).alias("t"))
    return duplicates.dedup_window(e, ["user_id", "event_type"], "t", "event_id", 86_400.0).select("event_id", "user_id", "event_type")


GAPS = "WITH g AS (SELECT user_id, (epoch_us(ts) // 1000) / 1000.0::DOUBLE AS t, lag((epoch_us(ts) // 1000) / 1000.0::DOUBLE) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)"


@query(f"{GAPS} SELECT user_id, p + 86400 AS from_ts, t AS to_ts, round(t - p - 86400, 3) AS lost FROM g WHERE t - p >= 86400")
def gap_islands(spark, d):
    e = read(spark, d, "events").select("user_id", (F.unix_millis(F.col("ts").cast("timestamp")) / 1000).alias("t"))
    return duplicates.gaps(e, ["user_id"], "t", 86_400.0).select("user_id", "from_ts", "to_ts", F.round("lost", 3).alias("lost"))


@query(f"{GAPS}, i AS (SELECT *, sum(CASE WHEN p IS NULL OR t - p >= 86400 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS run FROM g) SELECT user_id, min(t) AS start, max(t) AS stop, count(*) AS n FROM i GROUP BY user_id, run")
def activity_islands(spark, d):
    e = read(spark, d, "events").select("user_id", (F.unix_millis(F.col("ts").cast("timestamp")) / 1000).alias("t"))
    return duplicates.islands(e, ["user_id"], "t", 86_400.0)


# ---- text, JSON, files, streams


@query(r"""SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, regexp_extract(url, '://([^/?#]+)', 1) AS host, TRY_CAST(regexp_extract(url, '/(\d+)', 1) AS BIGINT) AS number FROM pages""")
def regex_timeline(spark, d):
    u = F.col("url")
    return read(spark, d, "pages").select("page_id", F.regexp_extract(u, "^(https?)://", 1).alias("scheme"), F.regexp_extract(u, "://([^/?#]+)", 1).alias("host"), F.regexp_extract(u, r"/(\d+)", 1).try_cast("bigint").alias("number"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark, d):
    return read(spark, d, "events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query(r"""WITH m AS (SELECT c_custkey AS k, CASE c_custkey % 6 WHEN 0 THEN '["Up","Down"]' WHEN 1 THEN '["Down", "Up"]' WHEN 2 THEN '["Yes","No"]' WHEN 3 THEN 'oops' WHEN 4 THEN '["Up"," down "]' END AS outcomes,
  CASE c_custkey % 5 WHEN 0 THEN '["1","0"]' WHEN 1 THEN '["0","1"]' WHEN 2 THEN '["0.5","0.5"]' WHEN 3 THEN 'x' END AS prices FROM customer)
SELECT CAST(k AS VARCHAR) AS market, CASE k % 6 WHEN 0 THEN 'u' || k WHEN 4 THEN 'u' || k WHEN 1 THEN 'd' || k END AS up_token, CASE k % 6 WHEN 0 THEN 'd' || k WHEN 4 THEN 'd' || k WHEN 1 THEN 'u' || k END AS down_token,
  CASE WHEN k % 6 IN (0, 4) THEN 'updown' WHEN k % 6 = 1 THEN 'updown_rev' ELSE 'other:' || coalesce(outcomes, '') END AS outcome_kind,
  CASE WHEN k % 5 > 1 OR k % 6 NOT IN (0, 1, 4) THEN NULL WHEN (k % 5 = 0) = (k % 6 <> 1) THEN 'UP' ELSE 'DOWN' END AS winner FROM m""")
def token_dimension(spark, d):
    k = F.col("c_custkey")
    pick = lambda n, texts: F.element_at(F.array(*[F.lit(t) for t in texts]), (k % n + 1).cast("int"))
    m = read(spark, d, "customer").select(
        k.cast("string").alias("market"), F.lit("s").alias("slug"), pick(6, ['["Up","Down"]', '["Down", "Up"]', '["Yes","No"]', "oops", '["Up"," down "]', None]).alias("outcomes"),
        F.to_json(F.array(F.concat(F.lit("u"), k), F.concat(F.lit("d"), k))).alias("clobTokenIds"), pick(5, ['["1","0"]', '["0","1"]', '["0.5","0.5"]', "x", None]).alias("outcomePrices"),
        F.lit(True).alias("closed"), F.lit("q").alias("question"), F.lit("e").alias("end_date"),
    )
    return listings.bar_tokens(m).select("market", "up_token", "down_token", "outcome_kind", "winner")


@query(f"""WITH {EV}, l AS (SELECT seq, bar_ts, event_type, asset_id % 2 AS conn, (ts_ms // 1000) % 86400 AS s, ts_ms % 1000 AS ms FROM e WHERE event_type <> 'error')
SELECT 'btc-5m' AS line, 'btc-updown-5m-' || bar_ts || '-' || seq AS slug, CASE event_type WHEN 'view' THEN 'bar' WHEN 'click' THEN 'token' WHEN 'signup' THEN 'sub' ELSE 'first' END AS kind,
  CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(conn AS INTEGER) END AS conn, round(s + ms / 1000.0::DOUBLE, 3) AS t, CASE WHEN event_type = 'purchase' THEN (seq % 900)::DOUBLE END AS server_ms FROM l""")
def log_lines(spark, d):
    f = frames(spark, d)
    second = F.floor(F.col("ts_ms") / 1000) % 86_400
    clock = F.format_string("%02d:%02d:%02d.%03d", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60, F.col("ts_ms") % 1000)
    slug, conn = F.concat(F.lit("btc-updown-5m-"), "bar_ts", F.lit("-"), "seq"), F.concat(F.lit("[c"), F.col("asset_id") % 2, F.lit("] "))
    said = (
        F.when(F.col("event_type") == "view", F.concat(F.lit(" "), clock, F.lit(" bar→ "), slug, F.lit(" (旧 x)")))
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), clock, F.lit(" 新市场 "), slug, F.lit(" token 就绪")))
        .when(F.col("event_type") == "signup", F.concat(conn, clock, F.lit(" 已发订阅 "), slug))
        .when(F.col("event_type") == "purchase", F.concat(conn, clock, F.lit(" 首帧 "), slug, F.lit(" (发订阅后 "), F.col("seq") % 900, F.lit("ms)")))
        .otherwise("noise")
    )
    out = _shared(spark, "log")
    f.select(F.concat(F.lit("  [btc-5m]"), said).alias("value")).write.text(out)
    return listings.log_events(spark, out).select("line", "slug", "kind", "conn", F.round("t", 3).alias("t"), "server_ms")


@query(f"WITH {EV} SELECT market, asset_id, ts_ms, value FROM e WHERE kind = 'book' AND side = 1 AND bar_ts >= 1705000000")
def partition_prune_roundtrip(spark, d):
    out = _shared(spark, "roundtrip")
    f = frames(spark, d).where("kind = 'book'").select(F.col("bar_ts").cast("string").alias("day"), F.col("side").cast("string").alias("coin"), F.lit("7d").alias("cycle"), "market", "asset_id", "ts_ms", "value", F.lit("-").alias("file"), "seq")
    derive.write(f, "quotes", out)
    return spark.read.parquet(f"{out}/quotes").where("coin = '1' AND CAST(day AS BIGINT) >= 1705000000").select("market", "asset_id", "ts_ms", "value")


# ---- the raw path: events as gzip JSON lines, one file a bar, read back as captures are


def _capture_lines(spark, d):
    """day, slug, seq, value: events as lines of captures, one file a bar."""
    f = frames(spark, d)
    k = F.col("seq") % 40
    level = lambda p: F.struct((p / 100).cast("string").alias("price"), (k + 1).cast("string").alias("size"))
    book_ = F.struct(
        F.lit("book").alias("event_type"), "market", F.col("asset_id").cast("string").alias("asset_id"), F.col("ts_ms").cast("string").alias("timestamp"), F.concat(F.lit("h"), "seq").alias("hash"),
        F.when(k > 2, F.array(level(k + 10), level(k + 12), level(k + 11))).otherwise(F.array()).alias("bids"), F.array(level(k + 20), level(k + 15)).alias("asks"),
    )
    trade = F.struct(
        F.lit("last_trade_price").alias("event_type"), "market", F.col("asset_id").cast("string").alias("asset_id"), F.col("ts_ms").cast("string").alias("timestamp"),
        ((k + 1) / 100).cast("string").alias("price"), (k + 2).cast("string").alias("size"), F.when(k % 2 == 0, "BUY").otherwise("SELL").alias("side"), F.lit("0").alias("fee_rate_bps"),
    )
    gap = F.struct(F.lit("gap").alias("mark"), (F.col("ts_ms") / 1000).alias("from_ts"), (F.col("ts_ms") / 1000 + 2).alias("to_ts"), F.lit(2.0).alias("lost_s"))
    said = F.when(F.col("kind") == "book", F.to_json(book_)).when(F.col("kind") == "trade", F.to_json(trade)).when(F.col("kind") == "gap", F.to_json(gap)).otherwise("{broken")
    return f.select(F.lit("2024-01-01").alias("day"), F.concat(F.lit("btc-updown-5m-"), "bar_ts").alias("slug"), "seq", said.alias("value"))


_CAPTURES: dict[tuple[str, str, bool], str] = {}


def _captures(spark, d, damaged=False):
    """Folder of captures, written once for all queries of a session. ``damaged``: the first bar's file breaks off in a second member, the last one's ends in bytes that are no gzip."""
    key = (spark.sparkContext.applicationId, d, damaged)
    if key not in _CAPTURES:
        out = _shared(spark, "raw")
        captures.write_captures(_capture_lines(spark, d), out)
        if damaged:
            found = [path for path, _ in files.listed(f"{out}/2024-01-01/*.jsonl.gz")]
            _append(min(found, key=len_and_name), b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03")
            _append(max(found, key=len_and_name), b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\xff\xff\xff\xff")
        _CAPTURES[key] = out
    return _CAPTURES[key]


def len_and_name(path: str) -> tuple[int, str]:
    """Orders bars as numbers."""
    return len(path), path


def _append(path: str, data: bytes) -> None:
    where, at = files.place(path)
    with where.open_input_stream(at, compression=None) as f:
        data = f.read() + data  # one bar's file
    tmp = files.new_name(path.rsplit("/", 2)[0] + "/.staging")
    with where.open_output_stream(files.place(tmp)[1], compression=None) as f:
        f.write(data)
    files.move(tmp, path)


def _raw(spark, d):
    """Captures read, parsed and named."""
    return raw.kind(raw.parse(raw.read_lines(spark, raw.resolve(_captures(spark, d), "2024-01-01"))))


def _derived(spark, d):
    f = _raw(spark, d)
    pairs = frames(spark, d).where("pair % 3 <> 0").select("market", (F.col("pair") * 2 + 1).cast("string").alias("up_token"), (F.col("pair") * 2).cast("string").alias("down_token"), F.lit("updown").alias("outcome_kind")).distinct()
    return derive.with_context(f, derive.file_summary(f), derive.sides(pairs))


RAW = f"""{EV}, m AS ({MODE.format(where="WHERE kind IN ('book', 'trade')")}), x AS (SELECT e.*, CASE WHEN e.market = m.market THEN 1 ELSE 0 END AS prim, seq % 40 AS k,
  CASE WHEN pair % 3 = 0 THEN -1 ELSE asset_id % 2 END AS which FROM e LEFT JOIN m ON e.bar_ts = m.bar_ts)"""


@query(f"""WITH {EV}, m AS ({MODE.format(where="WHERE kind IN ('book', 'trade')")}), c AS (SELECT bar_ts, count(*) AS rows, count(*) FILTER (kind IS NULL) AS bad_json,
  count(DISTINCT market) FILTER (kind IN ('book', 'trade')) AS n_markets FROM e GROUP BY bar_ts) SELECT c.*, m.market AS "primary" FROM c LEFT JOIN m ON c.bar_ts = m.bar_ts""")
def raw_file_summary(spark, d):
    s = derive.file_summary(_raw(spark, d))
    return s.select(F.regexp_extract("file", r"-(\d+)\.jsonl", 1).cast("long").alias("bar_ts"), "rows", "bad_json", "n_markets", "primary")


@query(f"""WITH {RAW} SELECT 'btc' AS coin, '5m' AS cycle, ts_ms, bar_ts, market, CAST(asset_id AS VARCHAR) AS asset_id, which AS side, CASE WHEN k > 2 THEN (k + 12) / 100.0::DOUBLE END AS best_bid,
  CASE WHEN k > 2 THEN (k + 1)::DOUBLE END AS best_bid_sz, (k + 15) / 100.0::DOUBLE AS best_ask, (k + 1)::DOUBLE AS best_ask_sz, CASE WHEN k > 2 THEN 3 ELSE 0 END AS n_bids, 2 AS n_asks,
  'h' || seq AS book_hash, 'btc-updown-5m-' || bar_ts AS slug, prim AS is_primary FROM x WHERE kind = 'book'""")
def raw_quotes(spark, d):
    return derive.quotes(_derived(spark, d)).drop("day", "mid", "spread", "file", "seq")


@query(f"""WITH {RAW} SELECT ts_ms, bar_ts, market, CAST(asset_id AS VARCHAR) AS asset_id, which AS side, CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS taker_side, (k + 1) / 100.0::DOUBLE AS price,
  (k + 2)::DOUBLE AS size, 0 AS fee_rate_bps, prim AS is_primary FROM x WHERE kind = 'trade'""")
def raw_trades(spark, d):
    return derive.trades(_derived(spark, d)).select("ts_ms", "bar_ts", "market", "asset_id", "side", "taker_side", "price", "size", "fee_rate_bps", "is_primary")


@query(f"WITH {EV} SELECT bar_ts, round(ts_ms / 1000.0::DOUBLE, 3) AS from_ts, round(ts_ms / 1000.0::DOUBLE + 2, 3) AS to_ts, 2.0::DOUBLE AS lost_s, 'btc-updown-5m-' || bar_ts AS slug FROM e WHERE kind = 'gap'")
def raw_marks(spark, d):
    return derive.marks(_derived(spark, d)).select("bar_ts", F.round("from_ts", 3).alias("from_ts"), F.round("to_ts", 3).alias("to_ts"), "lost_s", "slug")


@query(f"WITH {EV} SELECT kind, count(*) AS n FROM e WHERE kind IS NOT NULL GROUP BY kind")
def raw_row_counts(spark, d):
    return derive.row_counts(_raw(spark, d)).where("day IS NULL").select("kind", "n")


@query(f"""WITH {EV}, b AS (SELECT bar_ts, row_number() OVER (ORDER BY bar_ts) AS lo, row_number() OVER (ORDER BY bar_ts DESC) AS hi FROM e GROUP BY bar_ts)
SELECT (SELECT count(*) FROM b) AS files, (SELECT count(*) FROM b WHERE lo = 1 OR hi = 1) AS files_unreadable, count(*) AS lines, 0 AS bad_json, count(*) FILTER (kind = 'book') AS book_frames FROM e""")
def raw_damaged_audit(spark, d):
    return depth.audit(raw.read_captures(spark, raw.resolve(_captures(spark, d, damaged=True), "2024-01-01")))


@query(f"""WITH {EV}, b AS (SELECT bar_ts, count(*) AS n, row_number() OVER (ORDER BY bar_ts) AS lo, row_number() OVER (ORDER BY bar_ts DESC) AS hi FROM e GROUP BY bar_ts)
SELECT bar_ts, CASE WHEN hi = 1 THEN 'corrupt' WHEN lo = 1 THEN 'truncated' ELSE 'ok' END AS status, CASE WHEN hi = 1 OR lo = 1 THEN 0 ELSE n END AS lines FROM b""")
def raw_whole_files(spark, d):
    rows = raw.read_captures(spark, raw.resolve(_captures(spark, d, damaged=True), "2024-01-01"), whole=True)
    return rows.groupBy("bar_ts").agg(F.max("status").alias("status"), F.count_if(F.col("status").isNull() & (F.trim("value") != "")).alias("lines"))


@query(f"WITH {EV} SELECT coalesce(event_type, '?') AS ev, count(*) AS n FROM (SELECT CASE WHEN kind = 'trade' THEN 'last_trade_price' ELSE kind END AS event_type FROM e WHERE kind IN ('book', 'trade')) GROUP BY 1")
def raw_event_counts(spark, d):
    return depth.event_counts(raw.read_captures(spark, raw.resolve(_captures(spark, d, damaged=True), "2024-01-01")))


@query(f"WITH {EV}, b AS (SELECT row_number() OVER (ORDER BY bar_ts) - 1 AS i, bar_ts, count(*) AS n FROM e GROUP BY bar_ts) SELECT 'btc-updown-5m-' || bar_ts || '.jsonl.gz' AS name, 0 AS member, true AS ok, n AS lines FROM b")
def raw_gzip_members(spark, d):
    integrity.register(spark)
    spark.read.format("binaryFile").load(f"{_captures(spark, d)}/2024-01-01").createOrReplaceTempView("tapeworks_gz_files")
    return spark.sql("SELECT element_at(split(path, '/'), -1) AS name, m.member, m.ok, m.lines FROM tapeworks_gz_files, LATERAL gz_members(content) m WHERE m.ok")


@query(f"WITH {EV} SELECT 'd' || bar_ts AS day, 'c' || side AS coin, count(*) AS n FROM e WHERE kind = 'book' GROUP BY ALL")
def footer_row_counts(spark, d):
    out = _shared(spark, "footers")
    f = frames(spark, d).where("kind = 'book'").select(F.concat(F.lit("d"), "bar_ts").alias("day"), F.concat(F.lit("c"), "side").alias("coin"), F.lit("7d").alias("cycle"), "market", "asset_id", "ts_ms", F.lit("-").alias("file"), "seq")
    derive.write(f, "quotes", out)
    return derive.stored_rows(spark, out, "quotes").select("day", "coin", "n")


@query(f"WITH {EV} SELECT bar_ts, count(*) AS n FROM e WHERE kind = 'book' AND bar_ts <> (SELECT min(bar_ts) FROM e WHERE kind = 'book') GROUP BY bar_ts")
def partitions_without_damaged(spark, d):
    out = _shared(spark, "partitions")
    f = frames(spark, d).where("kind = 'book'")
    f.select("bar_ts", "market", "ts_ms").repartition("bar_ts").write.partitionBy("bar_ts").parquet(out)
    victim = min((path for path, _ in files.listed(f"{out}/*/*.parquet")), key=len_and_name)
    _append(victim, b"no footer")
    rows, errors = integrity.readable_partitions(spark, out)
    assert errors.count() == 1
    return rows.groupBy(F.col("bar_ts").cast("long").alias("bar_ts")).agg(F.count("*").alias("n"))


# ---- replays through the streaming operators


def _replay(spark, d):
    """events as a stream: seq, at (seconds), ts (with a watermark), line, conn, kind."""
    schema = read(spark, d, "events").schema
    src = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "0 seconds")
    at = F.unix_micros("ts") / 1_000_000
    return src.select(F.col("event_id").alias("seq"), at.alias("at"), "ts", F.concat(F.lit("l"), F.col("user_id") % 40).alias("line"), (F.col("user_id") % 2).cast("int").alias("conn"), "event_type", F.col("user_id").alias("user_id"))


def half_up(c: str, digits: int):
    """Rounded as the SQL rounds a double: the scaled number, halves away from zero. Times to the microsecond often end in a half of the last digit kept."""
    return (F.round(F.col(c) * 10**digits) / 10**digits).alias(c)


STREAM = "r AS (SELECT event_id AS seq, epoch_us(ts) / 1000000.0::DOUBLE AS tm, 'l' || (user_id % 40) AS line, CAST(user_id % 2 AS INTEGER) AS conn, event_type, user_id FROM events)"


@query(f"""WITH {STREAM}, g AS (SELECT line, tm, lag(tm) OVER (PARTITION BY line ORDER BY tm) AS p FROM r), s AS (SELECT line, p + 7200 AS lo, tm AS hi FROM g WHERE tm - p >= 7200),
c AS (SELECT line, lo, hi, unnest(generate_series(CAST(floor(lo / 86400) AS BIGINT), CAST(floor(hi / 86400) AS BIGINT))) AS k FROM s),
x AS (SELECT line, k * 86400 AS bar_ts, greatest(lo, k * 86400.0::DOUBLE) AS lo, least(hi, (k + 1) * 86400.0::DOUBLE) AS hi, hi >= (k + 1) * 86400 AS cut FROM c)
SELECT line, bar_ts, round(lo, 4) AS from_ts, round(hi, 4) AS to_ts, round(hi - lo, 4) AS lost_s, CASE WHEN cut THEN 'unresolved' ELSE 'reconnected' END AS note FROM x WHERE hi > lo OR (NOT cut AND lo = hi)""")
def stream_silences(spark, d):
    from tapeworks.streaming import stateful

    s = _drain(spark, stateful.silences(_replay(spark, d).select("line", "at", "ts"), 7200.0, 86_400), "append", "silences")
    # a last row may be followed by marks of timers that fire as the replay ends
    last = read(spark, d, "events").groupBy(F.concat(F.lit("l"), F.col("user_id") % 40).alias("line")).agg((F.max(F.unix_micros(F.col("ts").cast("timestamp"))) / 1_000_000).alias("last"))
    closed = s.where("note <> 'open'").join(last, "line").where("from_ts < last")
    return closed.select("line", "bar_ts", *[half_up(c, 4) for c in ("from_ts", "to_ts", "lost_s")], "note")


@query(f"""WITH {STREAM}, f AS (SELECT line AS slug, conn, tm, event_type = 'purchase' AS sub FROM r WHERE event_type <> 'error'),
n AS (SELECT *, lead(tm) OVER w AS next, lead(sub) OVER w AS again FROM f WINDOW w AS (PARTITION BY slug, conn ORDER BY tm, NOT sub))
SELECT slug, conn, round(tm, 4) AS subscribed_ts, round(next, 4) AS first_ts, round((next - tm) * 1000, 1) AS latency_ms FROM n WHERE sub AND NOT again""")
def stream_first_frames(spark, d):
    from tapeworks.streaming import stateful

    kind = F.when(F.col("event_type") == "purchase", "subscribe").when(F.col("event_type") == "error", "lost").otherwise(F.col("event_type"))
    r = _replay(spark, d).select(F.col("line").alias("slug"), "conn", kind.alias("event_type"), F.col("at").alias("arrival_ts"), "ts")
    out = _drain(spark, stateful.first_frames(r, 1e8), "append", "first_frames")
    return out.select("slug", "conn", half_up("subscribed_ts", 4), half_up("first_ts", 4), half_up("latency_ms", 1))


@query(f"""WITH {STREAM}, x AS (SELECT CAST(floor(tm / 86400) AS BIGINT) AS k, CAST(floor(tm / 86400) AS BIGINT) - CASE WHEN seq % 11 = 0 THEN 1 WHEN seq % 13 = 0 THEN 3 WHEN seq % 17 = 0 THEN -1 ELSE 0 END AS own FROM r)
SELECT 'd-' || (own * 86400) AS slug, count(*) FILTER (k - own = 1) AS late_1, count(*) FILTER (k - own > 1) AS late_more, count(*) FILTER (k < own) AS early FROM x WHERE k <> own GROUP BY own""")
def stream_late_counts(spark, d):
    from tapeworks.streaming import flow

    shift = F.when(F.col("seq") % 11 == 0, 1).when(F.col("seq") % 13 == 0, 3).when(F.col("seq") % 17 == 0, -1).otherwise(0)
    r = _replay(spark, d).select(F.col("at").alias("arrival_ts"), F.concat(F.lit("d-"), scalars.bar_of(F.col("at"), 86_400) - shift * 86_400).alias("slug"))
    return _drain(spark, flow.late_by_slug(r, 86_400), "complete", "late").select("slug", "late_1", "late_more", "early")


@query(f"""WITH RECURSIVE {STREAM}, k AS (SELECT seq, user_id, event_type, tm FROM r QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY tm, seq) = 1
  UNION ALL SELECT n.seq, n.user_id, n.event_type, n.tm FROM k JOIN LATERAL (SELECT r.* FROM r WHERE r.user_id = k.user_id AND r.event_type = k.event_type AND r.tm - k.tm >= 86400 ORDER BY r.tm, r.seq LIMIT 1) n ON true)
SELECT r.seq, k.seq IS NULL AS duplicate FROM r LEFT JOIN k ON r.seq = k.seq""")
def stream_dedup_tagged(spark, d):
    from tapeworks.streaming import stateful

    r = _replay(spark, d).select(F.col("at").alias("arrival_ts"), "conn", "event_type", F.lit("a").alias("asset_id"), F.col("user_id").cast("string").alias("hash"), F.lit("s").alias("slug"), "seq")
    return _drain(spark, stateful.dedup(r, 86_400.0, live=False, tag=True), "append", "tagged").select("seq", "duplicate")


@query(f"WITH {STREAM} SELECT 'l' || (user_id % 40) || '-' || CAST(floor(tm / 604800) AS BIGINT) * 604800 AS slug, count(*) AS lines, min(seq) AS first_seq, max(seq) AS last_seq FROM r GROUP BY ALL")
def stream_bar_files(spark, d):
    from tapeworks.streaming import flow

    out = _shared(spark, "bars")
    r = _replay(spark, d).select(F.col("at").alias("arrival_ts"), F.concat("line", F.lit("-"), scalars.bar_of(F.col("at"), 604_800)).alias("slug"), "seq")
    flow.write_bars(r, f"{out}/files", f"{out}/state", None).awaitTermination()
    captures.close_bars(f"{out}/files")
    rows = raw.lines(raw.read_captures(spark, f"{out}/files/*/*.jsonl.gz")).withColumn("n", F.from_json("value", "seq long")["seq"])
    return rows.groupBy("slug").agg(F.count("*").alias("lines"), F.min("n").alias("first_seq"), F.max("n").alias("last_seq"))


@query("SELECT (epoch_us(ts) // 86400000000) * 86400 AS bar_ts, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_bar_counts(spark, d):
    from tapeworks.streaming import flow

    schema = read(spark, d, "events").schema
    src = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))
    return _drain(spark, flow.bar_counts(src, "ts", "1 day", ["event_type"]), "complete", "bar_counts")


@query("SELECT o_custkey, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY o_custkey")
def running_extremes(spark, d):
    o = read(spark, d, "orders")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    run = o.select("o_custkey", F.count("*").over(w).alias("n"), F.min("o_totalprice").over(w).alias("low"), F.max("o_totalprice").over(w).alias("high"))
    return run.groupBy("o_custkey").agg(F.max("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


_LOCAL: list[str] = []


def _shared(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared one; a temporary one only where none is set and the master is local."""
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _LOCAL:
            _LOCAL.append(tempfile.mkdtemp(prefix="tapeworks-"))
            atexit.register(shutil.rmtree, _LOCAL[0], ignore_errors=True)
        base = f"file://{_LOCAL[0]}"
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _drain(spark: SparkSession, stream: DataFrame, mode: str, tag: str) -> DataFrame:
    """Runs a stream over what is there and returns its last result as a table."""
    out = _shared(spark, tag)

    def put(batch: DataFrame, i: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{out}/rows")

    q = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/rows")
