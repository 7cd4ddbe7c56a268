"""Damaged captures through the chunked reader, footer counts, partitions that can't be read, and files written one a bar."""

import gzip
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeworks.operators import depth, derive
from tapeworks.sources import captures, files, integrity
from tapeworks.sources import frames as src

DAY = "2026-02-03"


def line(i, event="book"):
    return json.dumps({"event_type": event, "market": "fir", "asset_id": str(i % 2), "timestamp": str(1770076800000 + i), "bids": [], "asks": [], "pad": "x" * (i % 90)})


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Seven files: whole, two members, cut within a member, cut after one, damaged bytes, no gzip, empty."""
    day = tmp_path_factory.mktemp("captures") / DAY
    day.mkdir()
    put = lambda bar, data: (day / f"btc-updown-5m-{bar}.jsonl.gz").write_bytes(data)
    text = lambda lo, hi: "".join(line(i) + "\n" for i in range(lo, hi)).encode()
    put(1, gzip.compress(text(0, 500) + b"\n{bad \"book\"\r\n" + line(7, "last_trade_price").encode()))  # no end of line
    put(2, gzip.compress(text(0, 40)) + b"\0\0" + gzip.compress(text(40, 90)))
    whole = gzip.compress(text(0, 4000))
    put(3, whole[: len(whole) * 7 // 10])
    put(4, gzip.compress(text(0, 30)) + gzip.compress(b"more")[:12])
    hurt = bytearray(whole)
    hurt[len(hurt) // 2] ^= 255
    put(5, bytes(hurt))
    put(6, b"plain text\n")
    put(7, b"")
    return str(day.parent)


def plain(path):
    """Lines that Python's own reader gives before it fails."""
    out = []
    try:
        with gzip.open(path, "rt", errors="replace") as f:
            out.extend(x.rstrip("\n") for x in f)
        return out, True
    except (OSError, EOFError, gzip.zlib.error):
        return out, False


def test_lines_and_states_of_damaged_files(spark, folder):
    got = src.read_captures(spark, src.resolve(folder, DAY)).cache()
    state = {r.slug[-1]: (r.status, r.lines) for r in src.closing(got).collect()}
    assert [state[k][0] for k in "1234567"] == ["ok", "ok", "truncated", "truncated", "corrupt", "corrupt", "truncated"]
    assert state["1"][1] == 503 and state["2"][1] == 90 and state["4"][1] == 30 and 0 < state["3"][1] < 4000 and state["7"][1] == 0
    for k in "12345":
        want, ok = plain(f"{folder}/{DAY}/btc-updown-5m-{k}.jsonl.gz")
        have = [r.value for r in got.where(f"slug LIKE '%-{k}' AND status IS NULL").orderBy("seq").collect()]
        assert have[: len(want)] == want and (have == want or not ok)
    assert {r.slug[-1] for r in src.damaged(got).collect()} == set("34567")
    r = got.where("slug LIKE '%-2' AND status IS NULL").agg(F.min("seq"), F.max("seq"), F.min("bar_ts"), F.min("coin")).first()
    assert tuple(r) == (0, 89, 2, "btc")
    kept = src.read_captures(spark, src.resolve(folder, DAY), whole=True)
    assert {r.slug[-1]: r.n for r in src.lines(kept).groupBy("slug").agg(F.count("*").alias("n")).collect()} == {"1": 502, "2": 90}
    assert src.closing(kept).count() == 7 and src.damaged(kept).count() == 5
    # rows of both readers agree where a file is one whole member
    old = src.read_lines(spark, f"{folder}/{DAY}/btc-updown-5m-1.jsonl.gz")
    assert sorted(r.value for r in old.collect()) == sorted(r.value for r in src.lines(kept).where("bar_ts = 1").collect())


def test_missing_files_and_patterns(spark, folder):
    assert len(files.listed(f"{folder}/*/*-[12].jsonl.gz")) == 2 and len(files.listed(f"file://{folder}/{DAY}")) == 7
    assert files.listed(f"{folder}/{DAY}/btc-updown-5m-2.jsonl.gz")[0][0].endswith("-2.jsonl.gz") and files.listed(f"{folder}/nowhere") == []
    assert captures.gzip_lines(spark, f"{folder}/nowhere").count() == 0
    r = captures.GzipReader({"path": folder})
    batches = list(r.read(captures.Files([f"{folder}/{DAY}/gone.jsonl.gz"])))
    assert len(batches) == 1 and batches[0].column("status").to_pylist() == ["unreadable"]
    small = captures.GzipReader({"paths": json.dumps([f"{folder}/{DAY}"]), "partition_bytes": "1"})
    assert len(small.partitions()) >= 6 and sum(len(p.paths) for p in small.partitions()) == 7


@settings(max_examples=40, deadline=None)
@given(st.lists(st.binary(max_size=300), min_size=1, max_size=4), st.integers(0, 400), st.booleans())
def test_inflate_against_python(parts, cut, hurt):
    data = b"".join(gzip.compress(p) for p in parts)
    data = data[: max(1, len(data) - cut)] if cut < 200 else data
    if hurt:
        data = data[: len(data) // 2] + bytes([data[len(data) // 2] ^ 1]) + data[len(data) // 2 + 1 :]
    try:
        want = gzip.decompress(data)
    except (OSError, EOFError, gzip.zlib.error):
        want = None
    status, n = captures.inflate(data)
    assert (status == "ok") == (want is not None) and (want is None or n == len(want))


def test_pieces_stay_small_for_any_ratio():
    import io

    data = gzip.compress(b"\0" * (40 << 20))  # a thousandfold
    it, most, total = captures.Inflater(), 0, 0
    for piece in it.pieces(io.BytesIO(data)):
        most, total = max(most, len(piece)), total + len(piece)
    assert it.status == "ok" and total == 40 << 20 == it.bytes and most <= captures.CHUNK


def test_the_audit_counts_what_could_not_be_read(spark, folder, tmp_path):
    c = src.read_captures(spark, f"{folder}/{DAY}/*-[!5].jsonl.gz").cache()
    r = depth.audit(c).first()
    state = {x.slug[-1]: x.lines for x in src.closing(c).collect()}
    assert (r.files, r.files_unreadable, r.bad_json) == (6, 4, 1) and r.lines == sum(state.values())
    assert r.book_frames == r.lines - 3  # the bad line, the blank one and the trade
    ev = {x.ev: x.n for x in depth.event_counts(c).collect()}
    assert ev == {"book": r.book_frames, "last_trade_price": 1}
    depth.dump(str(tmp_path / "audit"), [depth.audit(c)], {"ev": depth.event_counts(c)})
    said = {(x.metric, x.key): x.n for x in spark.read.json(str(tmp_path / "audit")).select("metric", "key", "n").collect()}
    assert said["files_unreadable", None] == 4 and said["ev", "last_trade_price"] == 1 and said["lines", None] == r.lines


def test_members_in_sql(spark, folder):
    integrity.register(spark)
    spark.read.format("binaryFile").load(f"{folder}/{DAY}").createOrReplaceTempView("gz_files")
    rows = spark.sql("SELECT path, m.* FROM gz_files, LATERAL gz_members(content) m WHERE path LIKE '%-2.jsonl.gz' OR path LIKE '%-4.jsonl.gz' ORDER BY path, member").collect()
    assert [(r.member, r.ok, r.lines, r.error) for r in rows] == [(0, True, 40, None), (1, True, 50, None), (0, True, 30, None), (1, False, 0, "truncated")]
    assert integrity.members(spark, f"{folder}/{DAY}").where("NOT ok").count() >= 3


def test_header_bytes_inside_a_member():
    inside = gzip.compress(b"a\n\x1f\x8b\x08 b\n", compresslevel=0)  # stored as it is
    good, large = gzip.compress(b"c\n"), gzip.compress(b"d\n" * 3_000_000)
    says = lambda *parts: [(r[3], r[4], r[5]) for r in integrity.found_members(b"".join(parts))]
    assert inside.count(integrity.HEADER) == 2
    assert says(inside, good, large) == [(True, 2, None), (True, 1, None), (True, 3_000_000, None)]
    found = integrity.found_members(inside + good)
    assert [(r[0], r[1], r[2]) for r in found] == [(0, 0, len(inside)), (1, len(inside), len(good))]
    cut = says(gzip.compress(b"e\nf\n", compresslevel=0)[:-8], good)  # a member without its end, and a whole one behind it
    assert [c[0] for c in cut] == [False, True] and cut[1][1] == 1
    assert says(b"no gzip") == [] and says(inside[:-1])[0][0] is False


def test_rows_are_counted_in_footers(spark, tmp_path, capsys):
    q = spark.range(1000).select(F.concat(F.lit("2026-02-0"), F.col("id") % 3 + 1).alias("day"), F.lit("btc").alias("coin"), F.when(F.col("id") % 2 == 0, "5m").otherwise("15m").alias("cycle"), F.col("id").cast("string").alias("asset_id"), F.col("id").alias("ts_ms"), F.lit("f").alias("file"), F.col("id").alias("seq"))
    derive.write(q, "quotes", str(tmp_path))
    counted = derive.stored_rows(spark, str(tmp_path), "quotes")
    counted.explain()
    plan = capsys.readouterr().out
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [day, coin, cycle]" in plan
    scanned = spark.read.parquet(f"{tmp_path}/quotes").groupBy("day", "coin", "cycle").count()
    assert sorted(map(tuple, counted.collect())) == sorted(map(tuple, scanned.collect()))
    assert derive.stored_rows(spark, str(tmp_path), "trades").count() == 0
    frames = q.select("day", F.lit("book").alias("kind")).union(spark.createDataFrame([("2026-02-01", "trade"), ("2026-02-09", "book")], "day string, kind string"))
    assert sorted(map(tuple, derive.verify(frames, str(tmp_path)).collect())) == [("quotes", "2026-02-09", 1, 0), ("trades", "2026-02-01", 1, 0)]


@pytest.mark.parametrize("harm", ["footer", "page"])
def test_a_damaged_partition_is_named_and_left_out(spark, tmp_path, harm):
    root = str(tmp_path / "quotes")
    spark.range(3000).select(F.concat(F.lit("d"), F.col("id") % 3).alias("day"), F.lit("btc").alias("coin"), "id", F.sha2(F.col("id").cast("string"), 256).alias("noise")).repartition(2).write.partitionBy("day", "coin").option("compression", "zstd").parquet(root)
    victim = sorted((tmp_path / "quotes" / "day=d1" / "coin=btc").glob("*.parquet"))[0]
    data = bytearray(victim.read_bytes())
    if harm == "footer":
        data = data[:-40]
    else:
        data[2000:2400] = bytes(400)
    victim.write_bytes(bytes(data))
    for crc in victim.parent.glob(".*.crc"):
        crc.unlink()
    rows, errors = integrity.readable_partitions(spark, root, deep=harm == "page")
    bad = errors.collect()
    assert [(r.partition, r.file.rsplit("/", 1)[1]) for r in bad] == [("day=d1/coin=btc", victim.name)] and bad[0].error
    assert {r.day: r.n for r in rows.groupBy("day").agg(F.count("*").alias("n")).collect()} == {"d0": 1000, "d2": 1000}
    assert sorted(rows.columns) == ["coin", "day", "id", "noise"]
    victim.unlink()
    rows, errors = integrity.readable_partitions(spark, root, deep=True)
    assert errors.count() == 0 and rows.where("day = 'd1'").count() > 0


def bars(n, bar):
    return [(DAY, f"btc-updown-5m-{bar}", i, f'{{"n": {i}}}') for i in range(n)]


def test_one_file_a_bar(spark, tmp_path):
    rows = spark.createDataFrame(bars(1000, 300) + bars(3, 600) + [("2026-02-04", "eth-updown-5m-900", 0, "é"), ("2026-02-04", "eth-updown-5m-900", 1, None)], "day string, slug string, seq long, value string")
    captures.write_captures(rows.repartition(6), str(tmp_path))
    assert sorted(p.name for p in (tmp_path / DAY).iterdir()) == ["btc-updown-5m-300.jsonl.gz", "btc-updown-5m-600.jsonl.gz"] and files.children(f"{tmp_path}/.staging") == []
    back = src.lines(src.read_captures(spark, f"{tmp_path}/*/*.gz"))
    assert [r.value for r in back.where("bar_ts = 300").orderBy("seq").collect()] == [f'{{"n": {i}}}' for i in range(1000)]
    assert [r.value for r in back.where("coin = 'eth'").collect()] == ["é"]
