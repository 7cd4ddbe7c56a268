"""Funnels, whitening and repeated passages against brute force on small tables."""

import datetime as dt
import hashlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapeworks.llm import funnel, mixing, repeats, whiten

# ---- ordered funnels

CLICKS = "click_id long, client_id long, kind string, arrived_at timestamp_ntz, funnel string, t long, n1 int"
BASE = dt.datetime(2024, 3, 31, 1, 58)  # a night with a clock change in some zones


def brute_funnels(rows, within=funnel.WITHIN):
    own = {}
    for c, k, t in {r for r in rows if None not in r}:
        own.setdefault(c, []).append((t, k))
    out = {}
    for f in funnel.FUNNELS:
        for c, events in own.items():
            reached, times = [0] * 4, [[] for _ in range(4)]
            for t1 in (t for t, k in events if k == f.steps[0]):
                reached[0] += 1
                last = t1
                for i, kind in enumerate(f.steps[1:], 1):
                    later = [t for t, k in events if k == kind and t > last]
                    if not later or min(later) - t1 > within or any(last < t <= min(later) for t, k in events if k == f.excluding):
                        break
                    reached[i] += 1
                    times[i].append(min(later) - last)
                    last = min(later)
            if reached[0]:
                quarter = [sorted(x)[-(-25 * len(x) // 100) - 1] if x else None for x in times[1:]]
                out[f.name, c] = (*reached, max(i + 1 for i in range(4) if reached[i]), *quarter)
    same = {}
    for (f, _), v in out.items():
        same[f, v[4]] = same.get((f, v[4]), 0) + 1
    return {(*k, *v, same[k[0], v[4]]) for k, v in out.items()}


def clicks(spark, rows):
    return spark.createDataFrame([(i, c, k, None if t is None else BASE + dt.timedelta(microseconds=t), "x", 1, 2) for i, (c, k, t) in enumerate(rows)], CLICKS)


def random_clicks(seed, n=700, span=2_000_000_000):
    rng = np.random.default_rng(seed)
    kinds = ["view", "click", "purchase", "error", "signup", "other", None]
    rows = []
    for _ in range(n):
        t = int(rng.integers(0, span // 1_000_000)) * 1_000_000 + int(rng.choice([0, 0, 1, 999_999]))
        rows.append((None if rng.random() < 0.02 else int(rng.choice([1, 1, 1, 2, 3, -5])), kinds[rng.choice(7, p=[0.4, 0.3, 0.1, 0.08, 0.08, 0.02, 0.02])], t if rng.random() > 0.02 else None))
    return rows + rows[:50]


def fetched(df):
    return {tuple(r) for r in df.select("funnel", "client_id", "n1", "n2", "n3", "n4", "deepest", "t2", "t3", "t4", "same_depth").collect()}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_funnels_equal_plain_loops(spark, zone):
    rows = random_clicks(5)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert fetched(funnel.funnels(clicks(spark, rows).repartition(5))) == brute_funnels(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_funnels_are_the_same_for_any_ranges_and_chunks(spark):
    rows = random_clicks(6, 400, 900_000_000)
    df, want = clicks(spark, rows), None
    for length, chunk in ((60_000_000, 10), (7_000_000_000, 20), (300_000_000, 10_000)):
        got = {tuple(r) for r in funnel.step_times(df, length=length, chunk_rows=chunk).collect()}
        assert want is None or got == want
        want = got


def test_funnel_edges(spark):
    m = 1_000_000
    rows = [
        (1, "view", 0), (1, "click", 10 * m), (1, "view", 10 * m), (1, "view", 20 * m), (1, "purchase", 300 * m),  # an equal time does not follow; five minutes still count
        (2, "view", 0), (2, "click", 300 * m + 1), (3, "view", 0), (3, "error", 5 * m), (3, "click", 5 * m), (4, "view", 5 * m), (4, "error", 5 * m), (4, "click", 6 * m),
        (5, "view", 0), (5, "view", 0), (6, "error", 1), (7, None, 5), (None, "view", 5),
    ]
    got = fetched(funnel.funnels(clicks(spark, rows)))
    assert got == brute_funnels(rows)
    a = {r[1]: r[2:7] for r in got if r[0] == "A"}
    assert a[1] == (3, 1, 1, 1, 4) and a[2] == (1, 0, 0, 0, 1) and a[3] == (1, 0, 0, 0, 1) and a[4] == (1, 1, 0, 0, 2) and a[5] == (1, 0, 0, 0, 1)
    assert funnel.funnels(clicks(spark, [])).count() == 0 and funnel.funnels(clicks(spark, [(None, None, None)])).count() == 0


def test_one_client_lies_in_many_tasks(spark):
    one = spark.range(60_000).select(F.lit(7).cast("long").alias("client_id"), F.when(F.col("id") % 3 == 0, "click").otherwise("view").alias("kind"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 5_000_000).alias("arrived_at"))
    rows = funnel.ranges(funnel.events(one, ("click", "view")), funnel.RANGE, funnel.WITHIN)
    assert rows.count() < 1.1 * 60_000 and rows.groupBy("part").count().agg(F.max("count")).first()[0] <= 3600 / 5 + 61
    got = {r.funnel: r for r in funnel.funnels(one).collect()}
    # ids 0, 3, ... click; of two views in a row each meets the next click and the view after that
    assert (got["A"].n1, got["A"].n2, got["A"].t2, got["C"].n1, got["C"].n2, got["C"].t2) == (40_000, 39_998, 5_000_000, 20_000, 19_999, 15_000_000)


# ---- whitening

VECTORS = "vec_id long, embedding array<float>, x int, component string"


def test_whitening_against_exact_sums(spark):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6))
    data = (rng.normal(size=(400, 6)) @ mix).astype(np.float32)
    rows = [(i, v.tolist(), 0, "c") for i, v in enumerate(data)] + [(7, data[7].tolist(), 0, "c")]
    rows += [(900, None, 0, "c"), (901, [1.0, None, 2.0, 3.0, 4.0, 5.0], 0, "c"), (902, [float("nan")] * 6, 0, None), (903, [float("inf"), 1.0, 1.0, 1.0, 1.0, 1.0], 0, "c"), (904, [], 0, "c"), (905, [1.0, 2.0], 0, "c")]
    got = whiten.whiten(spark.createDataFrame(rows, VECTORS).repartition(7), 4).toPandas()
    kept = np.concatenate([data, data[7:8]])
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for v in kept]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    assert len(got) == n * 4 and set(got.n) == {n} and set(got.vec_id) == set(range(400))
    cov = [[sum((Fraction(r[i]) - Fraction(s[i], n)) * (Fraction(r[j]) - Fraction(s[j], n)) for r in x) / n for j in range(6)] for i in range(6)]
    v = np.array([[float(c) for c in r] for r in cov])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    wide = got.drop_duplicates(["vec_id", "component"]).pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    want = (np.array([[float(Fraction(c) - Fraction(t, n)) for c, t in zip(r, s, strict=True)] for r in x[:400]]) @ axes / np.sqrt(values))[:, :4]
    assert np.allclose(np.abs(wide), np.abs(want), rtol=1e-9, atol=1e-11)
    assert got.identity_error.iloc[0] < 1e-10 and np.allclose(sorted(set(got.explained), reverse=True), values[:4] / np.trace(v), rtol=1e-12)
    deviation = {i: sum((n * c - t) ** 2 for c, t in zip(r, s, strict=True)) for i, r in enumerate(x[:400])}
    assert all(deviation[i] == d for i, d in zip(got.vec_id, got.deviation, strict=True))


def test_compensated_covariance_keeps_what_doubles_lose(spark):
    """Two dimensions of 2**46 that differ by their last bits: the centred products need over 53 bits together."""
    rng = np.random.default_rng(4)
    x = (1 << 46) + rng.integers(-9, 9, size=(3000, 3))
    x[:, 2] += rng.integers(-(1 << 44), 1 << 44, 3000)
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<long>").repartition(9)
    model = whiten.fit(rows, 3)
    ints = [[int(c) for c in r] for r in x]
    s = [sum(c) for c in zip(*ints, strict=True)]
    for i in range(3):
        for j in range(3):
            want = Fraction(sum((3000 * r[i] - s[i]) * (3000 * r[j] - s[j]) for r in ints), 3000**3)
            found = Fraction(float(model.covariance[0][i, j])) + Fraction(float(model.covariance[1][i, j]))
            assert abs(found - want) <= abs(want) * Fraction(1, 10**26) + Fraction(1, 10**15)
    assert [int(v) for v in model.sums] == s


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-(1 << 60), 1 << 60), st.integers(-60, 40)), min_size=1, max_size=40))
def test_double_double_sums(parts):
    xs = np.array([[m * 2.0**e] for m, e in parts])
    high, low = whiten.fold(xs, np.zeros_like(xs))
    want = sum(Fraction(float(x)) for x in xs[:, 0])
    assert abs(Fraction(float(high[0])) + Fraction(float(low[0])) - want) <= sum(abs(Fraction(float(x))) for x in xs[:, 0]) / (1 << 98)
    p, q = whiten.outer_sum(xs, np.zeros_like(xs))
    squares = sum(Fraction(float(x)) ** 2 for x in xs[:, 0])
    assert abs(Fraction(float(p[0])) + Fraction(float(q[0])) - squares) <= squares / (1 << 98)


def test_whitening_without_variance(spark):
    same = spark.createDataFrame([(i, [0.5, -0.25], 0, "c") for i in range(5)], VECTORS)
    got = whiten.whiten(same).collect()
    assert len(got) == 10 and {(r.deviation, r.whitened, r.explained, r.identity_error) for r in got} == {(0, 0.0, 0.0, 0.0)}
    line = whiten.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 0, "c") for i in range(6)], VECTORS)).collect()
    assert max(r.identity_error for r in line) < 1e-9 and {r.whitened for r in line if r.component == 2} == {0.0}
    assert whiten.whiten(same.limit(0)).count() == 0
    assert {(r.deviation, r.whitened) for r in whiten.whiten(same.limit(1)).collect()} == {(0, 0.0)}


# ---- repeated passages

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, starts string, place string"


def split(text):
    return text.encode().split() if text else []


def brute_repeats(rows, length):
    last = 1 << 63
    key = lambda d: last if d is None else d
    first = {}
    for d, text in rows:
        w = split(text)
        for i in range(len(w) - length + 1):
            g = tuple(w[i : i + length])
            first[g] = min(first.get(g, last), key(d))
    out = []
    for d, text in rows:
        w = split(text)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < key(d):
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(seed, length):
    rng = np.random.default_rng(seed)
    words = [*"abcdefgh", "é", "Word,", " x"]
    fresh = lambda n: " ".join(rng.choice(words, n)) if rng.random() < 0.5 else " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    passages = [fresh(int(n)) for n in (length - 1, length, length + 1, 2 * length, 3 * length + 5)]
    rows = []
    for i in range(60):
        parts = [x for _ in range(rng.integers(1, 4)) for x in (fresh(int(rng.integers(0, 2 * length))), passages[rng.integers(5)])]
        rows.append((int(rng.permutation(60)[0]) if i % 9 == 0 else i, "\t".join(parts)))
    rows += [(200, rows[3][1]), (200, rows[3][1]), (201, rows[3][1]), (None, rows[4][1]), (None, rows[5][1]), (202, None), (203, ""), (204, " \n "), (205, "x " * 3000), (206, "x " * 2990 + "y"), (207, "x " * (length - 1))]
    cut = rows[7][1].split()
    rows += [(300, " ".join(cut[: len(cut) // 2] + ["changed"] + cut[len(cut) // 2 + 1 :])), (301, rows[8][1] + " tail"), (302, " ".join(rows[8][1].split()))]
    return rows


@pytest.mark.parametrize(("seed", "length"), [(1, 50), (2, 50), (3, 7), (4, 4), (5, 23)])
def test_repeats_equal_plain_loops(spark, monkeypatch, seed, length):
    if seed == 2:  # texts and places meet by a shuffle; tiny chunks and caches
        monkeypatch.setattr(repeats, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(repeats, "CHUNK_WORDS", 60)
        monkeypatch.setattr(repeats, "CACHE_WORDS", 20)
    rows = texts(seed, length)
    df = spark.createDataFrame([(d, t, "en", "s", 1, 2, "st", "p") for d, t in rows], DOCS).repartition(5)
    got = sorted((tuple(r) for r in repeats.digests(df, length).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)
    assert got == brute_repeats(rows, length)
    whole = repeats.without_repeats(df, length)
    assert whole.columns == [*df.columns, "n_removed"]
    assert sorted(((r.doc_id, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in whole.collect()), key=str) == sorted(((d, g, s) for d, _, g, s in got), key=str)


def test_repeats_of_no_or_single_texts(spark):
    df = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1, 2, "", "")], DOCS)
    assert repeats.digests(df.limit(0)).count() == 0 and repeats.without_repeats(df.limit(0)).count() == 0 and repeats.longest(df.limit(0)).count() == 0
    assert [tuple(r)[:3] for r in repeats.digests(df, 4).collect()] == [(1, 6, 0)]
    with pytest.raises(ValueError):
        repeats.digests(df, 3)


def test_anchors_hold_every_window():
    rng = np.random.default_rng(9)
    for length in (4, 9, 50):
        words = rng.integers(0, 5, 700).astype(np.uint64)
        bounds = np.array([0, 0, 3, 60, 400, 400, 700])
        place, short, right, left, has_right, has_left = repeats.anchors(words, bounds, length)
        k = length // 4
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            for i in range(a, b - length + 1):
                own = (place >= i) & (place <= i + length - k)
                assert own.any()
                inside = (has_right & own & (place + 2 * k <= i + length)) | (has_left & own & (place - k >= i))
                assert inside.any()


def test_longest_repeats(spark):
    w = [f"w{i}" for i in range(900)]
    rows = [(1, " ".join(w)), (2, " ".join(["a"] + w[100:340] + ["b"])), (3, " ".join(["c"] + w[600:655] + ["d"])), (4, " ".join(w[:49])), (5, "z " * 80)]
    df = spark.createDataFrame([(d, t, "", "", 1, 2, "", "") for d, t in rows], DOCS)
    assert {tuple(r) for r in repeats.longest(df).collect()} == {(1, 200), (2, 200), (3, 50)}


def test_a_shared_passage_costs_a_row_a_position(spark):
    """2,000 documents share 60 words: rows grow with the documents, and no pairs are made."""
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.range(2000).select("id", F.concat_ws(" ", F.concat(F.lit("u"), "id"), F.lit(passage), F.concat(F.lit("v"), "id")).alias("text")).withColumnRenamed("id", "doc_id")
    own = repeats.keyed(df).drop("row")
    found = repeats.stage(own.mapInArrow(repeats._first_pass(50), "doc long, th long, th2 long, n_words long, sha string, place array<int>, short array<long>, right array<long>, left array<long>"), "t")
    places = repeats.half_length(found, 50)
    assert repeats.window_rows(own, places, 50, 24).count() <= 2000 * 13
    assert repeats.digests(df).agg(F.sum("n_removed")).first()[0] == 1999 * 60
    same = spark.range(40).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("a b "), 2000), F.col("id").cast("string")).alias("text"))
    own = repeats.keyed(same).drop("row")
    found = repeats.stage(own.mapInArrow(repeats._first_pass(50), found.schema), "t")
    assert found.select(F.explode("place")).count() <= 40 * 60  # not a row for each of 4,000 places
    assert repeats.window_rows(own, repeats.half_length(found, 50), 50, 24).count() <= 40 * 60
    assert repeats.digests(same).agg(F.sum("n_removed")).first()[0] == 39 * 4000


# ---- mixing: budgets that end exactly where a range of keys ends


def plain_mix(rows, spark):
    """Documents by source in key order until the budget, to the nearest whole document."""
    keyed = mixing.keyed(rows).drop("row").collect()
    sizes = {}
    for r in keyed:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    target = {r.source: r.target for r in mixing.water_fill(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    out = []
    for source, size in sizes.items():
        epochs = int(target[source] // size) if size else 0
        budget, reach = target[source] - epochs * size, 0
        for r in sorted((r for r in keyed if r.source == source), key=lambda r: (r["key"], r.doc_id)):
            reach += r["size"]
            out.append((r.doc_id, (epochs + (budget > 0 and reach - r["size"] / 2 <= budget)) * r["size"]))
    return sorted(out)


@pytest.mark.parametrize(("sizes", "want"), [([10] * 100, 1500), ([2] * 4, 12), ([0, 5, 0, 5, 5, 5], 30), ([1], None), ([7, 1, 1, 1, 2], None)])
def test_a_budget_that_ends_with_a_range_of_keys(spark, sizes, want):
    df = spark.createDataFrame([(i, " ".join(["w"] * n), "s") for i, n in enumerate(sizes)], "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.taken) for r in mixing.mix(df).collect())
    assert got == plain_mix(df, spark) and (want is None or sum(t for _, t in got) == want)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=25))
def test_small_sources_of_short_texts(spark, rows):
    df = spark.createDataFrame([(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate(rows)], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.taken) for r in mixing.mix(df).collect()) == plain_mix(df, spark)
