"""Replays through the streaming operators, held against their batch twins."""

import time

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import duplicates
from tapeworks.streaming import flow, stateful

SCHEMA = "arrival_ts double, conn int, event_type string, asset_id string, hash string, slug string"


def drain(df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    try:
        assert q.awaitTermination(90)
    finally:
        q.stop()
    return df.sparkSession.table(name)


def replay(spark, tmp_path, batches, schema=SCHEMA):
    import os
    import time

    path = str(tmp_path / "in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            if f.startswith("part") and os.stat(f"{path}/{f}").st_mtime > time.time() - 3600:
                os.utime(f"{path}/{f}", (time.time() - 7200 + i, time.time() - 7200 + i))
    return flow.replay(spark, path, schema)


def test_dedup_is_exact_and_equals_batch(spark, tmp_path):
    b = 1_789_000_000.0
    row = lambda t, h="k": (b + t, int(t) % 2, "book", "a", h, "s")
    batches = [[row(0), row(40), row(1, ""), row(2, "")], [row(70)], [row(129), row(200)]]
    got = drain(stateful.dedup(replay(spark, tmp_path, batches), live=False), "dedup_out")
    assert sorted(r.arrival_ts - b for r in got.where("hash = 'k'").collect()) == [0, 70, 200]
    assert got.where("hash = ''").count() == 2
    flat = spark.createDataFrame([(*r, i) for i, r in enumerate(x for y in batches for x in y)], SCHEMA + ", i int")
    twin = duplicates.dedup_window(flat, ["event_type", "asset_id", "hash"], "arrival_ts", "i", 60.0, F.col("hash") == "")
    assert sorted(r.arrival_ts for r in twin.collect()) == sorted(r.arrival_ts for r in got.collect())


def test_silence_marks(spark, tmp_path):
    b = 1_789_000_000.0
    batches = [[("l", b), ("m", b)], [("l", b + 59), ("m", b + 61)], [("l", b + 300)]]
    s = replay(spark, tmp_path, batches, "line string, at double").withColumn("ts", F.timestamp_seconds("at")).withWatermark("ts", "0 seconds")
    got = drain(stateful.silences(s), "silence_out")
    closed = {(r.line, r.from_ts - b, r.to_ts - b) for r in got.where("note = 'reconnected'").collect()}
    assert closed == {("m", 60.0, 61.0), ("l", 119.0, 300.0)}


def test_rows_without_a_hash_need_no_state(spark, tmp_path):
    b = 1_789_000_000.0
    batches = [[(b, 0, "book", "a", None, "s"), (b, 1, "book", "a", "", "s"), (b, 0, "book", "a", "k", "s")], [(b + 1, 1, "book", "a", None, "s"), (b + 1, 1, "book", "a", "k", "s")]]
    got = drain(stateful.dedup(replay(spark, tmp_path, batches), live=False), "hashless_out")
    assert sorted((r.arrival_ts - b, r.hash or "") for r in got.collect()) == [(0, ""), (0, ""), (0, "k"), (1, "")]


def test_dedup_of_a_live_stream_ends_by_wall_clock(spark, tmp_path):
    b = 1_789_000_000.0
    src = replay(spark, tmp_path, [[(b, 0, "book", "a", "k", "s"), (b + 1, 1, "book", "a", "k", "s"), (b + 60, 1, "book", "a", "k", "s")]])
    q = stateful.dedup(src).writeStream.format("memory").queryName("live_out").outputMode("append").start()
    try:
        until = time.time() + 60  # such a query never runs dry
        while spark.table("live_out").count() < 2 and time.time() < until:
            time.sleep(0.5)
        assert sorted(r.arrival_ts - b for r in spark.table("live_out").collect()) == [0, 60]
    finally:
        q.stop()


def test_one_hash_of_several_ids(spark):
    df = spark.createDataFrame([("h", "t", "x"), ("", "t", "x"), (None, None, "x"), (None, "", None)], "hash string, transaction_hash string, txhash string")
    assert [r.hash for r in flow.keyed(df).collect()] == ["h", "t", "x", ""] and flow.keyed(df).columns == ["hash"]


def test_a_silence_over_a_bar_switch_is_closed_unresolved(spark, tmp_path):
    b = 1_789_000_200.0  # a bar of 300 s begins
    batches = [[("l", b + 100)], [("l", b + 710)]]
    s = replay(spark, tmp_path, batches, "line string, at double").withColumn("ts", F.timestamp_seconds("at")).withWatermark("ts", "0 seconds")
    got = drain(stateful.silences(s, 60.0, 300), "switch_out").where("note <> 'open'").collect()
    want = {(0, 160, 300, "unresolved"), (300, 300, 600, "unresolved"), (600, 600, 710, "reconnected")}
    assert {(r.bar_ts - b, r.from_ts - b, r.to_ts - b, r.note) for r in got} == want and len(got) == 3


def test_the_watchdog_orders_once_a_limit(spark, tmp_path):
    b = 1_789_000_000.0
    batches = [[("l", b), ("m", b)], [("m", b + 40)], [("m", b + 80), ("l", b + 100)], [("l", b + 101), ("m", b + 110)]]
    s = replay(spark, tmp_path, batches, "line string, at double").withColumn("ts", F.timestamp_seconds("at")).withWatermark("ts", "0 seconds")
    got = drain(stateful.watchdog(s), "dog_out").collect()
    assert sorted((r.line, r.at - b, r.generation, r.action) for r in got) == [("l", 45, 1, "resubscribe"), ("l", 90, 2, "resubscribe")]


def test_heartbeat_of_each_line(spark):
    f = spark.createDataFrame([("l", 0, 100.0), ("l", 1, 30.0), ("l", 0, 101.0), ("m", 0, 10.0)], "line string, conn int, arrival_ts double")
    marks = spark.createDataFrame([("l", "reconnected"), ("l", "unresolved"), ("l", "open")], "line string, note string")
    breaks = spark.createDataFrame([("m",)], "line string")
    got = flow.heartbeat(f, f.where("arrival_ts <> 101"), marks, breaks, 110.0).collect()
    assert {tuple(r) for r in got} == {("l", 3, 1, 0, 1, 2), ("m", 1, 0, 1, 0, 0)}


def test_late_frames_and_bars(spark, tmp_path):
    s = 1_789_000_200
    f = spark.createDataFrame([(s + 1.0, 0, "book", "a", "h", f"btc-updown-5m-{s}"), (s + 301.0, 0, "book", "a", "h", f"btc-updown-5m-{s}"), (s + 302.0, 1, "book", "a", "i", f"btc-updown-5m-{s + 300}")], SCHEMA)
    assert flow.on_time(f, 300).count() == 2
    assert {r.conn: r.messages for r in flow.liveness(f).collect()} == {0: 2, 1: 1}
    got = flow.silent(f.withColumn("line", F.concat(F.lit("l"), "conn")), s + 346.5).collect()
    assert [(r.line, r.action) for r in got] == [("l0", "resubscribe")]


def test_unresolved_comes_out_at_the_switch(spark, tmp_path):
    """The line never speaks again: only another line's rows move the clock."""
    b = 1_789_000_200.0  # a bar of 300 s begins
    batches = [[("l", b + 100), ("m", b + 100)], [("m", b + 170)], [("m", b + 229)], [("m", b + 288)], [("m", b + 301)], [("m", b + 360)], [("m", b + 420)]]
    s = replay(spark, tmp_path, batches, "line string, at double").withColumn("ts", F.timestamp_seconds("at")).withWatermark("ts", "0 seconds")
    got = drain(stateful.silences(s, 60.0, 300), "still_silent").where("line = 'l'").collect()
    assert [(r.bar_ts - b, r.from_ts - b, r.to_ts and r.to_ts - b, r.lost_s, r.note) for r in sorted(got, key=lambda r: r.note)] == [(0, 160, None, None, "open"), (0, 160, 300, 140, "unresolved")]


def test_late_frames_are_counted(spark, tmp_path):
    s, schema = 1_789_000_200, SCHEMA
    row = lambda at, bar, h: (at, 0, "book", "a", h, bar if isinstance(bar, str) else f"btc-updown-5m-{bar}")
    batches = [[row(s + 1.0, s, "a"), row(s + 1.5, s - 300, "b"), row(s + 1.6, s - 300, "c")], [row(s + 2.0, s - 900, "d"), row(s + 3.0, s + 300, "e"), row(s + 4.0, "odd", "f"), row(s + 5.0, s, "g")]]
    seen = []
    listener = flow.Heartbeat(seen.append)
    spark.streams.addListener(listener)
    try:
        kept = drain(flow.on_time(replay(spark, tmp_path, batches, schema), 300, "late"), "late_out")
        assert sorted(r.hash for r in kept.collect()) == ["a", "g"]
        until = time.time() + 20
        while sum(x["late"]["frames"] for x in seen if "late" in x) < 7 and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    told = [x["late"] for x in seen if "late" in x]
    assert {k: sum(x[k] for x in told) for k in ("frames", "late_1", "late_more", "early", "unnamed")} == {"frames": 7, "late_1": 2, "late_more": 1, "early": 1, "unnamed": 1}
    counts = drain(flow.late_by_slug(flow.replay(spark, str(tmp_path / "in"), schema), 300), "late_counts", "complete")
    got = {r.slug: (r.late_1, r.late_more, r.early, r.unnamed) for r in counts.collect()}
    assert got == {f"btc-updown-5m-{s - 300}": (2, 0, 0, 0), f"btc-updown-5m-{s - 900}": (0, 1, 0, 0), f"btc-updown-5m-{s + 300}": (0, 0, 1, 0), "odd": (0, 0, 0, 1)}


def test_first_frame_of_a_subscription(spark, tmp_path):
    b = 1_789_000_000.0
    row = lambda t, conn, kind, slug="s": (b + t, conn, kind, "a", "h", slug)
    batches = [
        [row(0, 0, "subscribe"), row(0.25, 0, "book"), row(0.5, 0, "book"), row(0, 1, "subscribe")],
        [row(2, 1, "book"), row(0.1, 0, "book"), row(3, 1, "last_trade_price"), row(4, 0, "lost")],  # a late copy changes nothing
        [row(10, 0, "subscribe"), row(10.5, 0, "book"), row(11, 2, "book"), row(12, 0, "book", "t")],
        [row(9000, 3, "subscribe", "u")], [row(9001, 0, "book"), row(9001, 3, "book", "u")],  # the state of s has expired
    ]
    s = replay(spark, tmp_path, batches).withColumn("ts", F.timestamp_seconds("arrival_ts")).withWatermark("ts", "0 seconds")
    got = drain(stateful.first_frames(s), "first_out").collect()
    assert sorted((r.slug, r.conn, r.subscribed_ts - b, r.latency_ms) for r in got) == [("s", 0, 0, 250), ("s", 0, 10, 500), ("s", 1, 0, 2000), ("u", 3, 9000, 1000)]


def test_a_pulse_each_interval(spark, tmp_path):
    now = time.time()
    row = lambda t, conn, kind, h, line="l": (now + t, conn, kind, "a", h, "s", line)
    batches = [
        [row(-200, 0, "subscribe", None), row(-200, 0, "book", "h1"), row(-199.9, 1, "book", "h1"), row(-130, 1, "book", "h2")],
        [row(-1, 1, "lost", None), row(-0.5, 0, "book", "h3"), row(-0.4, 1, "book", "h3"), row(-500, 0, "book", "x", "m")],
    ]
    src = replay(spark, tmp_path, batches, SCHEMA + ", line string")
    q = stateful.pulse(stateful.dedup(src, tag=True), every=1.0).writeStream.format("memory").queryName("pulse_out").outputMode("append").start()
    try:
        until = time.time() + 90
        full = lambda: spark.table("pulse_out").where("line = 'l' AND messages = 5")
        while full().count() < 3 and time.time() < until:
            time.sleep(0.5)
        rows = full().orderBy("at").collect()
        assert len(rows) >= 3 and all(b.at - a.at > 0.9 for a, b in zip(rows, rows[1:], strict=False))
        assert {(r.messages, r.duplicates, r.disconnects, r.rebuilt, r.connections, r.gaps) for r in rows} == {(5, 2, 1, 1, 2, 2)} and rows[0].alive == 2 and rows[0].gap_s == 0
        m = spark.table("pulse_out").where("line = 'm'").orderBy(F.desc("at")).first()
        assert (m.messages, m.alive, m.gaps) == (1, 0, 0) and m.gap_s > 499
    finally:
        q.stop()


# ---- the live source: connections read in tasks


def reader(log, **options):
    return flow.LiveReader({"feed": "feeds:feed", "log": str(log), "rows": "9", "seconds": "5"} | options)


def rows_of(r, start, end):
    return [x for p in r.partitions(start, end) for b in r.read(p) for x in map(tuple, b.to_pandas().astype(object).itertuples(index=False))]


def test_connections_resume_and_repeat_exactly(tmp_path):
    flow._open.clear()
    r = reader(tmp_path)
    offsets, taken = [r.initialOffset()], []
    for _ in range(4):
        offsets.append(r.latestOffset())
        taken.append(rows_of(r, offsets[-2], offsets[-1]))
    assert [o["at"] for o in offsets] == sorted({o["at"] for o in offsets})
    flow._open.clear()  # another worker
    again = reader(tmp_path)
    assert [rows_of(again, a, b) for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == taken
    flat = [x for t in taken for x in t]
    assert [x[4] for x in flat if x[1] == 0 and x[2] == "book"] == [f"h{i}" for i in range(35)]  # 4 times 9, less the subscription
    assert [x[2] for x in flat if x[1] == 1][:9] == ["subscribe", *["book"] * 7, "lost"]
    state = __import__("json").loads(again.recall(1, offsets[-1]["at"]).schema.metadata[b"state"])
    assert (state["generation"], state["attempt"], state["cursor"]) == (1, 1, 0) and 0 < state["retry_at"] - time.time() <= 3
    again.commit(offsets[3])
    assert again.recall(0, offsets[2]["at"]) is None and again.recall(0, offsets[3]["at"]) is not None
    offsets.append(again.latestOffset())
    assert [x[4] for x in rows_of(again, offsets[-2], offsets[-1]) if x[1] == 0] == [f"h{i}" for i in range(35, 44)]
    assert again.partitions(offsets[-1], offsets[-1]) == []


def test_an_order_makes_connections_subscribe_anew(spark, tmp_path):
    flow._open.clear()
    folder = str(tmp_path / "orders")
    r = reader(tmp_path / "log", orders=folder, line="l", conns="1")
    a, b = r.initialOffset(), r.latestOffset()
    assert [x[5] for x in rows_of(r, a, b)][0] == "g0"
    src = replay(spark, tmp_path, [[("l", 45.0, 1, "resubscribe"), ("m", 45.0, 7, "resubscribe")]], "line string, at double, generation int, action string")
    q = flow.obey(src, folder, str(tmp_path / "checkpoint"))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    c, d = r.latestOffset(), r.latestOffset()
    assert [x[5] for x in rows_of(r, b, c)][0] == "g1"
    assert [x[4] for x in rows_of(r, c, d)] == [f"h{i}" for i in range(8, 17)]  # obeyed once


def test_two_connections_stop_and_start_without_loss(spark, tmp_path):
    """Two connections as one stream through de-duplication into a file sink, stopped twice in the middle and started again from the checkpoint."""
    import feeds

    spark.sparkContext.addPyFile(feeds.__file__)
    spark.dataSource.register(flow.LiveBooks)

    def start():
        src = spark.readStream.format("live_books").option("feed", "feeds:feed").option("log", str(tmp_path / "log")).option("rows", "9").option("seconds", "5").load()
        out = stateful.dedup(src.where("event_type = 'book'"), live=False)
        return out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="200 milliseconds").start()

    def seen():
        return spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")) if (tmp_path / "out" / "_spark_metadata").exists() else None

    for goal in (5, 30, 60):
        q = start()
        try:
            until = time.time() + 60
            while (seen() is None or seen().count() < goal) and time.time() < until:
                time.sleep(0.3)
        finally:
            q.stop()
    got = [r.hash for r in seen().collect()]
    assert sorted(got) == sorted(f"h{i}" for i in range(60))


# ---- the sink of one file a bar


def written(spark, out):
    from tapeworks.sources import frames as src

    return {(r.slug, r.value) for r in src.lines(src.read_captures(spark, f"{out}/*/*.jsonl.gz")).collect()}


def batch(rows):
    import pyarrow as pa

    return iter([pa.RecordBatch.from_pylist([{"day": "d", "slug": f"btc-5m-{bar}", "value": str(i)} for bar, i in rows], pa.schema([("day", "string"), ("slug", "string"), ("value", "string")]))] if rows else [])


def test_fifty_batches_leave_one_file_a_bar(spark, tmp_path):
    from tapeworks.sources import captures, files

    out = f"file://{tmp_path}/out"
    rows = [((i // 120) * 300 + 300, i) for i in range(1000)]
    for n in range(50):
        w = captures.BarStreamWriter(out)
        own = rows[n * 20 : n * 20 + 20]
        if n % 7 == 3:
            w.write(batch(own))  # a task that was lost: its files name nothing
        m = w.write(batch(own))
        if n % 11 == 5:
            w.abort([m, None], n)
            m = w.write(batch(own))
        w.commit([m, None], n)
        if n % 5 == 4:  # the driver was killed before it noted the commit: the batch is run again
            w = captures.BarStreamWriter(out)
            w.commit([w.write(batch(own))], n)
    open_bars = captures.close_bars(out)
    assert open_bars == ["btc-5m-2700"] and sorted(p.name for p in (tmp_path / "out" / "d").iterdir()) == sorted(f"btc-5m-{b}.jsonl.gz" for b in range(300, 2701, 300))
    assert written(spark, out) == {(f"btc-5m-{b}", str(i)) for b, i in rows}
    from tapeworks.sources import frames as src

    assert src.lines(src.read_captures(spark, f"{out}/d/*.gz")).count() == 1000 and files.children(f"{out}/.late") == []


def test_a_commit_that_breaks_off_is_made_good(tmp_path, monkeypatch):
    import gzip

    from tapeworks.sources import captures, files

    out = f"file://{tmp_path}"
    first = captures.BarStreamWriter(out)
    first.commit([first.write(batch([(300, 1), (300, 2)]))], 0)
    second = [(300, 3), (600, 4)]  # closes the first bar
    for stop_at in (1, 2, 3, 1, 2):
        w, calls, move, remove = captures.BarStreamWriter(out), [0], files.move, files.remove
        m = w.write(batch(second))

        def counted(real, calls=calls, stop_at=stop_at):
            def run(*a):
                calls[0] += 1
                if calls[0] == stop_at:
                    raise KeyboardInterrupt
                return real(*a)

            return run

        with monkeypatch.context() as c:
            c.setattr(files, "move", counted(move))
            c.setattr(files, "remove", counted(remove))
            with pytest.raises(KeyboardInterrupt):
                w.commit([m], 1)
    w = captures.BarStreamWriter(out)
    w.commit([w.write(batch(second))], 1)
    w = captures.BarStreamWriter(out)
    w.commit([w.write(batch([(300, 9), (600, 5)]))], 2)  # late
    captures.close_bars(out)
    read = lambda name: gzip.decompress((tmp_path / name).read_bytes()).decode().split()
    assert read("d/btc-5m-300.jsonl.gz") == ["1", "2", "3"] and read("d/btc-5m-600.jsonl.gz") == ["4", "5"]
    assert read(".late/d~btc-5m-300/000000000002.gz") == ["9"]


def test_bars_from_a_stream(spark, tmp_path):
    s = 1_789_000_200
    batches = [[(s + 60.0 * i + j, 0, "book", "a", f"h{i}-{j}", f"{coin}-updown-5m-{s + 60 * i // 300 * 300}") for j in range(3) for coin in ("btc", "eth")] for i in range(7)]
    q = flow.write_bars(replay(spark, tmp_path, batches), f"{tmp_path}/bars", f"{tmp_path}/state", None)
    assert q.awaitTermination(120)
    from tapeworks.sources import captures

    assert sorted(captures.close_bars(f"{tmp_path}/bars")) == [f"{c}-updown-5m-{s + 300}" for c in ("btc", "eth")]
    got = sorted((slug, __import__("json").loads(v)["hash"]) for slug, v in written(spark, f"{tmp_path}/bars"))
    assert got == sorted((r[5], r[4]) for b in batches for r in b) and len(list((tmp_path / "bars").glob("*/*.gz"))) == 4


@pytest.mark.parametrize("name", ["stream_silences", "stream_first_frames", "stream_dedup_tagged"])
def test_a_session_as_spark_makes_it(spark, name):
    """Spark's default state store knows no state variables; the operators see to one that does. Held against the SQL."""
    duckdb = pytest.importorskip("duckdb")
    from tapeworks.plans.catalogue import oracle_sql, queries

    sf, before = "/root/testdata/sf0.001", spark.conf.get(stateful.STORE)
    spark.conf.set(stateful.STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        out = queries()[name](spark, sf)
        assert spark.conf.get(stateful.STORE) == stateful.ROCKSDB
    finally:
        spark.conf.set(stateful.STORE, before)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{sf}/events.parquet'")
    want = db.execute(f"SELECT {', '.join(out.columns)} FROM ({oracle_sql()[name]})").fetchall()
    assert want and sorted(map(tuple, out.collect())) == sorted(want)


def test_another_state_store_stays(spark):
    before = spark.conf.get(stateful.STORE)
    spark.conf.set(stateful.STORE, "some.OtherProvider")
    try:
        stateful.with_store(spark.range(1))
        assert spark.conf.get(stateful.STORE) == "some.OtherProvider"
    finally:
        spark.conf.set(stateful.STORE, before)
