"""Hand-computed cases of the analytical operators."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeworks.functions import book, scalars
from tapeworks.operators import asof, coverage, depth, duplicates, inventory, outcome, settle, timeline
from tapeworks.sources import listings


def test_scalars(spark):
    df = spark.createDataFrame([("1.9", 0.05), ("", 0.049), ("x", 60.0), (None, 10.0), ("-2.7", 59.9)], "s string, iv double")
    r = df.select(scalars.safe_double(F.col("s")).alias("d"), scalars.safe_long(F.col("s"), 0).alias("i"), scalars.interval_bucket(F.col("iv")).alias("b")).collect()
    assert [x.d for x in r] == [1.9, None, None, None, -2.7] and [x.i for x in r] == [1, 0, 0, 0, -2]
    assert [x.b for x in r] == ["0.05~0.1", "0~0.05", "60~inf", "10~60", "10~60"]
    w = spark.createDataFrame([("btc-updown-15m-1789000000",), ("odd",)], "s string").select(*scalars.slug_window(F.col("s"))).collect()
    assert tuple(w[0]) == (1789000000000, 900000) and tuple(w[1]) == (None, None)


def test_best_level_ties_and_bad_prices(spark):
    rows = [([("0.5", "1"), ("0.5", "2"), ("x", "9")], [("0.7", "3"), ("0.6", "4"), ("0.6", "5")]), ([], None)]
    df = spark.createDataFrame(rows, "b array<struct<price:string,size:string>>, a array<struct<price:string,size:string>>")
    r = df.select(book.best(F.col("b"), True).alias("b"), book.best(F.col("a"), False).alias("a"), book.level_count(F.col("b")).alias("n"), book.level_count(F.col("a")).alias("m")).collect()
    assert tuple(r[0].b) == (0.5, 1.0) and tuple(r[0].a) == (0.6, 4.0) and r[0].n == 3
    assert tuple(r[1].b) == (None, None) and (r[1].n, r[1].m) == (0, 0)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=30), st.sampled_from([0.1, 0.25, 0.5, 0.75, 0.9]))
def test_nearest_rank_is_half_even(spark, xs, q):
    got = spark.createDataFrame([(xs,)], "x array<int>").select(scalars.nearest_rank(F.col("x"), q)).first()[0]
    assert got == sorted(xs)[min(len(xs) - 1, max(0, int(round(q * (len(xs) - 1)))))]


def levels(*ps):
    return [(str(p), "1") for p in ps]


def test_depth(spark):
    rows = [
        (1, levels(0.01, 0.02, 0.03), levels(0.99, 0.98)), (2, levels(0.1, 0.13), levels(0.5)), (3, [], levels(0.5, 0.45)), (4, levels(0.2, 0.2, 0.21), levels(0.7, 0.699)),
    ]
    p = depth.profile(spark.createDataFrame(rows, "i int, bids array<struct<price:string,size:string>>, asks array<struct<price:string,size:string>>"))
    t = depth.totals(p).first()
    assert (t.frames, t.bid_empty, t.bid_low, t.ask_high, t.bid_odd, t.ask_odd, t.bid_hole, t.ask_hole) == (4, 1, 1, 1, 2, 2, 1, 1)
    h = depth.histograms(p)
    assert depth.percentile(h.where("metric = 'bid_n'"), 0.5, ["metric"]).first().key == 2.0
    f = spark.createDataFrame([("f", "a", i, t) for i, t in enumerate([0, 50, 40, 1040, 61040])], "file string, asset string, seq int, ts_ms long")
    assert {r.bucket: r.n for r in depth.intervals(f, ["file", "asset"]).collect()} == {"0.05~0.1": 1, "1~2": 1, "60~inf": 1}
    assert depth.regressions(f, ["file", "asset"]).count() == 1


def test_coverage_uses_the_market_with_most_books(spark):
    rows = [(0, "m1", 5000, False, 0), (0, "m1", 6000, False, 1), (0, "m1", 7000, True, 2), (0, "m2", 10000, True, 3), (0, "m2", 100000, True, 4), (300, "m3", 400000, False, 5)]
    df = spark.createDataFrame(rows, "bar_ts long, market string, ts_ms long, is_book boolean, seq int")
    o = coverage.bar_offsets(df, ["bar_ts"])
    r = o.collect()
    assert len(r) == 1 and (r[0].market, r[0].book_rows, r[0]["first"], r[0]["last"], r[0].markets_seen) == ("m2", 2, 10.0, 100.0, 2)
    g = coverage.report(o.withColumn("g", F.lit("x")), ["g"]).where("hour IS NULL").first()
    assert (g.ok_pct, g.late) == (100.0, 0)
    assert asof.first_seen_mode(df, ["bar_ts"], "market", "seq").where("bar_ts = 0").first().market == "m1"


def test_ties_go_to_the_market_first_seen_among_what_counts(spark):
    rows = [(0, "late", False, 1), (0, "soon", True, 2), (0, "late", True, 3), (0, "none", False, 0)]
    df = spark.createDataFrame(rows, "bar_ts long, market string, is_book boolean, seq int")
    assert asof.first_seen_mode(df, ["bar_ts"], "market", "seq", F.col("is_book")).collect() == [(0, "soon", 1)]
    assert asof.first_seen_mode(df, ["bar_ts"], "market", "seq").collect() == [(0, "late", 2)]


SCHEMA = "market string, asset_id string, ts_ms long, bar_ts long, best_ask double, mid double, spread double, is_primary int"


def test_outcome(spark):
    """At 4,000 s, 100 s into a bar: two-sided, one-sided, crossed and unsettled markets, frames after the moment and of other markets."""
    at, bar = 4_000_000, 3_900
    now = [
        ("pear", "p+", 0.80, 0.79, 0.02), ("pear", "p-", 0.23, 0.22, 0.02), ("plum", "l+", 0.55, 0.525, 0.05), ("plum", "l-", 0.50, 0.475, 0.05),
        ("sloe", "s-", 0.64, 0.645, -0.01), ("figs", "f+", 0.45, 0.44, 0.02), ("lime", "m-", 0.90, 0.885, 0.03),
    ]
    rows = [(m, a, at, bar, ask, mid, spread, 1) for m, a, ask, mid, spread in now]
    rows += [("pear", "p-", at + 250, bar, 0.97, 0.96, 0.02, 1), ("pear", "p-", at - 250, bar, 0.97, 0.96, 0.02, 0), ("plum", "l+", at - 9_000, bar, 0.2, 0.1, 0.2, 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("seq", F.monotonically_increasing_id())
    tok = spark.createDataFrame([("pear", "p+", "p-", "p+"), ("plum", "l+", "l-", "DOWN"), ("sloe", "s+", "s-", "DOWN"), ("lime", "m+", "m-", None)], "market string, up_token string, down_token string, winner string")
    lead = outcome.leaders(outcome.snapshot(df, ["market", "bar_ts"], 100, ["ts_ms", "seq"]), ["market", "bar_ts"])
    assert {r.market: r.lead for r in lead.collect()} == {"pear": "p+", "plum": "l+", "sloe": "s-", "lime": "m-"}  # one-sided below one half is left out
    got = {r.market: r for r in outcome.returns(lead, tok).collect()}
    assert set(got) == {"pear", "plum", "sloe"} and [got[m].won for m in ("pear", "plum", "sloe")] == [True, False, True]
    assert abs(got["pear"].roi - 0.25) < 1e-9 and got["plum"].roi == -1.0 and abs(got["sloe"].roi - 0.5625) < 1e-9
    assert abs(got["pear"].fee_roi - (0.25 - 0.07 * 0.25)) < 1e-9
    assert set(r.market for r in outcome.returns(lead, tok, parity=True).collect()) == {"pear", "plum", "sloe", "lime"}
    r = outcome.returns(lead, tok)
    assert {x.lo: x.n for x in outcome.by_bucket(r).collect()} == {0.0: 0, 0.015: 1, 0.025: 0, 0.035: 1, 0.055: 0}  # crossed books are in none
    assert {x.t: x.n for x in outcome.cumulative(r).collect()} == {0.01: 1, 0.02: 2, 0.03: 2, 0.05: 3}
    assert outcome.pooled(r, ["bar_ts"]).where("bar_ts IS NULL").first().n == 3


def test_settle(spark):
    end = 1_000_300_000
    rows = [
        ("a", "u", end - 60000, 0.6, 0), ("a", "d", end - 2000, 0.4, 1), ("a", "u", end - 1999, 0.1, 2), ("b", "u", end - 60001, 0.9, 3), ("b", "d", end - 5000, 0.3, 4),
        ("c", "u", end - 30000, 0.9, 5), ("d", "u", end - 1000, None, 6), ("e", "u", end - 10000, 0.5, 7), ("e", "d", end - 10000, 0.5, 8), ("f", "u", end - 3000, 0.5, 9),
    ]
    df = spark.createDataFrame(rows, "market string, asset_id string, ts_ms long, best_bid double, seq int")
    m = spark.createDataFrame([(x, "u", "d", "UP", None if x == "f" else end - 300_000, 300_000) for x in "abcdef"], "market string, up_token string, down_token string, winner string, start_ms long, cycle_ms long")
    got = {r.market: r for r in settle.predict(df, m, ["ts_ms", "seq"]).collect()}
    assert (got["a"].bid_up, got["a"].bid_dn, got["a"].pred, got["a"].reason) == (0.6, 0.4, "UP", None)
    assert (got["b"].bid_up, got["b"].pred) == (-1.0, "DOWN") and got["e"].pred == "DOWN"
    assert [got[x].reason for x in "cdf"] == ["no_cover", "no_bid", "no_window"]
    a = settle.agreement(settle.predict(df, m, ["ts_ms", "seq"])).where("winner IS NULL").first()
    assert (a.n, a.agree) == (3, 1) and not settle.gate(a)


def test_inventory(spark, tmp_path):
    mk = lambda d: spark.createDataFrame(list(d.items()), "path string, bytes long")
    remote = {"2026-03-04/sun": 12, "2026-03-04/moon": 71, "2026-03-05/star": 5_000}
    d = {r.path: (r.state, r.remote, r.local) for r in inventory.diff(mk(remote), mk({"2026-03-04/sun": 12, "2026-03-04/moon": 70, "2026-02-27/dust": 9})).collect()}
    assert d == {"2026-03-04/moon": ("mismatch", 71, 70), "2026-03-05/star": ("missing", 5_000, None), "2026-02-27/dust": ("extra", None, 9)}
    noon = 1_772_712_000.0  # 2026-03-05
    assert {r.path for r in inventory.within_days(mk(remote), 0, noon).collect()} == set(remote)
    assert inventory.within_days(mk({"2026-02-20/x": 1, "2026-03-05/y": 1}), 2, noon).count() == 1
    res = {r.path: r.state for r in inventory.residual(mk({"p": 1, "q": 1, "r": 1}), mk({"p": 31, "q": 44, "r": 2}), mk({"p": 32, "q": 44})).collect()}
    assert res == {"p": "growing", "q": "real", "r": "growing"}
    p = str(tmp_path / "inv.txt")
    listings.write_inventory(mk(remote), p, "header")
    (tmp_path / "inv.txt").open("a").write("bad row\n# note\n")
    assert {r.path: r.bytes for r in listings.read_inventory(spark, p).collect()} == remote
    got = {r.path: r.change for r in inventory.reconcile(mk({"k": 3, "l": 4}), mk({"k": 7, "m": 6})).collect()}
    assert got == {"k": "changed", "l": "gone", "m": "added"}
    packs = spark.createDataFrame([("l2_2026-09-16", 100.0), ("l2_full", 0.0)], "name string, mtime double")
    r = {x.name: (x.publish, x["delete"]) for x in inventory.retention(packs, 100.0 + 8 * 86400).collect()}
    assert r == {"l2_2026-09-16": (False, True), "l2_full": (False, False)}


def test_timeline(spark, tmp_path):
    slug = "btc-updown-5m-1789000200"  # starts at 00:30:00 UTC
    start = 1789000200 % 86400
    t = lambda s: f"{int(start + s) // 3600:02d}:{int(start + s) // 60 % 60:02d}:{(start + s) % 60:06.3f}"
    lines = [
        f"  [btc-5m] {t(1)} bar→ {slug} (旧 x)", f"  [btc-5m] {t(2)} 新市场 {slug} token 就绪", f"  [btc-5m][c0] {t(3)} 已发订阅 {slug}", f"  [btc-5m][c1] {t(9)} 已发订阅 {slug}",
        f"  [btc-5m][c0] {t(8)} 首帧 {slug} (发订阅后 240ms)", "noise",
    ]
    (tmp_path / "log.txt").write_text("\n".join(lines))
    r = timeline.recent(timeline.decompose(timeline.pivot(listings.log_events(spark, str(tmp_path / "log.txt")))), 5).collect()
    assert len(r) == 1
    assert [round(r[0][c], 3) for c in ("detect", "token_s", "sub_s", "server_s", "first_s")] == [1.0, 1.0, 1.0, 5.0, 8.0] and r[0].flag == "server"


def test_duplicates_and_windows(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "h string")
    r = duplicates.audit(df, F.col("h"), []).first()
    assert (r.n, r["distinct"], r.duplicates) == (5, 3, 2)
    rows = [("k", float(t), i) for i, t in enumerate([1000, 1040, 1070, 1119, 1129.9, 1130, 1200])] + [("", 1.0, 90), ("", 2.0, 91)]
    k = duplicates.dedup_window(spark.createDataFrame(rows, "hash string, at double, i int"), ["hash"], "at", "i", 60.0, F.col("hash") == "")
    assert sorted(x.i for x in k.collect()) == [0, 2, 5, 6, 90, 91]
    g = duplicates.gaps(spark.createDataFrame([("l", 0.0), ("l", 59.0), ("l", 120.0)], "line string, at double"), ["line"], "at", 60.0).collect()
    assert [tuple(x) for x in g] == [("l", 119.0, 120.0, 1.0)]


def test_catalogue_registers_sql_for_each_query():
    from tapeworks.plans.catalogue import oracle_sql, queries

    assert set(oracle_sql()) == set(queries()) and len(queries()) >= 45


@pytest.mark.parametrize("name", ["roi_by_bucket", "settle_agreement", "top_of_book"])
def test_catalogue_on_the_smallest_tables(spark, name):
    from tapeworks.plans.catalogue import queries

    assert queries()[name](spark, "/root/testdata/sf0.001").count() > 0


def test_dedup_window_keeps_rows_not_orders(spark):
    from tapeworks.operators import duplicates

    rows = [("a", 0.0, 1), ("a", 10.0, 2), ("b", 0.0, 2), ("b", 59.9, 2), ("b", 60.0, 2), ("b", 119.0, 3), (None, 5.0, 1), (None, 6.0, 1), ("a", None, 9), ("c", 0.0, 4), ("c", 0.0, 4)]
    df = spark.createDataFrame(rows, "k string, t double, o int").repartition(3)
    got = sorted(duplicates.dedup_window(df, ["k"], "t", "o", 60.0).collect(), key=str)
    assert sorted(map(tuple, got), key=str) == sorted([("a", 0.0, 1), ("b", 0.0, 2), ("b", 60.0, 2), (None, 5.0, 1), ("a", None, 9), ("c", 0.0, 4)], key=str)
    assert duplicates.dedup_window(df, ["k"], "t", "o", 60.0, F.col("k") == "c").where("k = 'c'").count() == 2
    long = spark.range(3000).select(F.lit("x").alias("k"), F.col("id").cast("double").alias("t"), F.col("id").alias("o"))  # never silent
    assert [r.t for r in duplicates.dedup_window(long, ["k"], "t", "o", 60.0).orderBy("t").collect()] == [60.0 * i for i in range(50)]
    assert duplicates.dedup_window(long.limit(0), ["k"], "t", "o").count() == 0


def test_set_algebra_and_percentiles(spark):
    from tapeworks.operators import depth, duplicates

    a, b = (spark.createDataFrame([(x,) for x in xs], "v int") for xs in ([1, 1, 2, None], [2, 3, None, None]))
    got = sorted(map(tuple, duplicates.algebra(a, b).collect()), key=str)
    assert got == sorted([("union", 1), ("union", 2), ("union", 3), ("union", None), ("both", 2), ("both", None), ("a_b", 1), ("b_a", 3)], key=str)
    h = spark.createDataFrame([("m", 1.0, 5), ("m", 2.0, 4), ("m", 9.0, 1)], "metric string, key double, n long")
    assert {r.p: r.key for r in depth.percentiles(h, [0.1, 0.5, 0.9, 0.99], ["metric"]).collect()} == {0.1: 1.0, 0.5: 1.0, 0.9: 2.0, 0.99: 9.0}
    assert depth.percentile(h, 0.9, ["metric"]).first().key == 2.0


def test_file_helpers(spark, tmp_path):
    import json

    from tapeworks.operators import derive
    from tapeworks.sources import frames as src

    day = tmp_path / "2026-03-04"
    day.mkdir()
    (day / "btc-updown-5m-1772582400.jsonl.gz").write_bytes(b"abc")
    (day / "notes.txt").write_text("x")
    assert [(r.path, r.bytes) for r in listings.scan_files(spark, str(tmp_path)).collect()] == [("2026-03-04/btc-updown-5m-1772582400.jsonl.gz", 3)]
    (tmp_path / "packs.json").write_text(json.dumps({"generated": "x", "files": [{"name": "p1", "size": 4, "mtime": 1.5, "sha256": "ab", "final": True}]}))
    assert [tuple(r) for r in listings.read_packages(spark, str(tmp_path / "packs.json")).collect()] == [("p1", 4, 1.5, "ab", True)]
    f = spark.createDataFrame([(f"f{i}", "d1" if i < 6 else "d2", "book" if i % 2 else None) for i in range(12)], "file string, day string, kind string")
    assert derive.sample_files(f, 5).count() == 5 and derive.sample_files(f, 5).collect() == derive.sample_files(f.repartition(7), 5).collect()
    assert {(r.day, r.n) for r in derive.row_counts(f).collect()} == {("d1", 3), ("d2", 3), (None, 6)}
    assert src.without_files(f, f.where("file IN ('f1', 'f2')").select("file")).count() == 10
    derive.write_tokens(spark.createDataFrame([("m2", "u"), ("m1", "v")], "market string, up_token string"), str(tmp_path))
    assert [r.market for r in spark.read.parquet(f"{tmp_path}/bar_tokens").collect()] == ["m1", "m2"]


def test_predicates_on_names_and_look_ups_that_wait(spark):
    from tapeworks.sources import frames as src

    names = [f"/r/2026-0{m}-0{d}/{c}-updown-{y}-{i}.jsonl.gz" for i, (m, d, c, y) in enumerate([(1, 2, "btc", "5m"), (1, 3, "eth", "5m"), (2, 1, "btc", "15m"), (2, 9, "sol", "5m")])] + ["/r/2026-01-02/odd.gz"]
    df = src.named(spark.createDataFrame([(n,) for n in names], "file string"))
    got = lambda **c: sorted(names.index(r.file) for r in src.matching(df, **c).collect())
    assert got() == [0, 1, 2, 3, 4] and got(coins=["btc"]) == [0, 2] and got(cycles=["5m"]) == [0, 1, 3] and got(days=["2026-01"]) == [0, 1, 4]
    assert got(coins=["btc", "eth"], cycles=["5m"], days=["2026-01-03", "2026-02"]) == [1] and got(name="updown-15m") == [2] and got(days=[]) == [] and got(coins=["other"]) == [4]

    waits, calls = [], []

    def fetch(ids, closed):
        calls.append((tuple(ids), closed))
        if len(calls) in (1, 2):
            raise OSError("busy")
        return [{"market": i} for i in ids if closed == (i == "a")]

    missing = spark.createDataFrame([("a",), ("b",)], "market string")
    assert listings.look_up(missing, fetch, sleep=waits.append) == [{"market": "a"}, {"market": "b"}]
    assert waits == [1.0, 2.0] and calls[-1] == (("b",), False)
    with pytest.raises(OSError):
        listings.look_up(missing, lambda ids, closed: (_ for _ in ()).throw(OSError("down")), sleep=waits.append)


def test_reports_digests_and_days(spark, tmp_path):
    import hashlib
    import json

    from tapeworks.operators import derive

    listings.write_report(str(tmp_path / "report.json"), {"b": 1, "a": [2]})
    assert json.loads((tmp_path / "report.json").read_text()) == {"a": [2], "b": 1}
    (tmp_path / "one.bin").write_bytes(b"12")
    assert [tuple(r) for r in inventory.file_sha(spark, str(tmp_path / "one.bin")).collect()] == [("one.bin", hashlib.sha256(b"12").hexdigest())]
    mk = lambda d: spark.createDataFrame(list(d.items()), "name string, sha256 string")
    assert {r.name: r.state for r in inventory.drift(mk({"x": "1", "y": "2", "z": "3"}), mk({"x": "1", "y": "9", "w": "4"})).collect()} == {"y": "changed", "z": "gone", "w": "new"}
    packs = spark.createDataFrame([("2026-03-04", 50.0), ("2026-03-05", 50.0)], "day string, mtime double")
    members = spark.createDataFrame([("2026-03-04/a", 10.0), ("2026-03-04/b", 60.0), ("2026-03-05/a", 40.0)], "path string, mtime double")
    assert [r.day for r in inventory.stale_packages(packs, members).collect()] == ["2026-03-04"]
    days = spark.createDataFrame([(1772582399999,), (1772582400000,), (None,)], "ms long").select(scalars.utc_day(F.col("ms")).alias("d")).collect()
    assert [r.d for r in days] == ["2026-03-03", "2026-03-04", None]
    rows = spark.createDataFrame([("a", -1), ("a", -1), ("b", 1), ("c", -1)], "asset_id string, side int")
    assert tuple(derive.unknown_totals(rows).first()) == (3, 2)
