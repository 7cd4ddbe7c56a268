"""Parts of the toxicity scores against plain loops, and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import toxicity


@pytest.mark.parametrize("seed", range(20))
def test_isotonic_is_the_best_rising_fit(seed):
    """The best rising fit at a point is the largest over starts of the least over ends of the mean between them."""
    rng = np.random.default_rng(seed)
    raw, y = rng.integers(0, 12, 60) / 4.0, rng.integers(0, 2, 60).astype(float)
    points = sorted(set(raw.tolist()))
    mean = lambda a, b: y[(raw >= points[a]) & (raw <= points[b])].mean()
    best = [max(min(mean(a, b) for b in range(i, len(points))) for a in range(i + 1)) for i in range(len(points))]
    want, top = {}, 0.0
    for value in sorted({round(v, 12) for v in best}):
        own = [p for p, v in zip(points, best, strict=True) if round(v, 12) == value]
        some = np.isin(raw, own)
        top = max(top, (y[some].sum() + 0.01) / (some.sum() + 0.02))  # shrunk towards one half by 0.02 of a row
        want.update(dict.fromkeys(own, top))
    xs, ys = toxicity.isotonic(raw, y)
    assert np.allclose(np.interp(points, xs, ys), [want[p] for p in points])


def test_isotonic_of_nothing_and_of_one():
    assert [len(a) for a in toxicity.isotonic(np.zeros(0), np.zeros(0))] == [0, 0]
    xs, ys = toxicity.isotonic(np.array([2.0]), np.array([1.0]))
    assert xs.tolist() == [2.0, 2.0] and np.allclose(ys, 1.01 / 1.02)


def test_features_against_loops():
    rng = np.random.default_rng(3)
    for n in (0, 1, 7, 400):
        f = rng.choice([0, 0, 0, 0, 1, 2, 3, 4, 8, 17, 20], n).astype(np.uint8)
        raw = bytes(rng.integers(32, 127, 5 * n).astype(np.uint8))
        got = dict(zip(toxicity.FEATURES, toxicity._features(f, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), n, len(raw)), strict=True))
        bad = [i for i in range(n) if f[i] & 3]
        you = [i for i in range(n) if f[i] & 4]
        text = raw.decode()
        assert got["near_second"] == sum(any(abs(i - j) <= 5 for j in you) for i in bad)
        assert got["hits"] == sum(bool(v & 1) for v in f) and got["odd_hits"] == sum(bool(v & 16 and v & 3) for v in f)
        assert got["second_rate"] == len(you) / max(n, 1) and got["caps_rate"] == sum(bool(v & 8) for v in f) / max(n, 1)
        assert got["exclaim_rate"] == text.count("!") / max(n, 1) and got["upper_rate"] == sum("A" <= c <= "Z" for c in text) / max(len(raw), 1)
        assert got["digit_rate"] == sum("0" <= c <= "9" for c in text) / max(len(raw), 1)


def test_repeats_long_texts_and_clashing_names(spark):
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice([f"word{j}" for j in range(60)], 30)) + (" zork blargh" if i % 5 == 0 else "")) for i in range(600)]
    lab = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id long, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(toxicity.training_sample(df, lab))
    odd = [(1, rows[1][1]), (1, rows[1][1]), (5, rows[5][1]), (5, rows[5][1]), (None, None), (7, "word1 " * 300_000), (8, "zork you blargh " * 100_000)]
    more = spark.createDataFrame(odd, "doc_id long, text string").select("*", *[F.lit(1).alias(c) for c in ("score", "predicted", "text_hash", "row", "toxic")])
    said = {}
    for r in toxicity.score(more, model).collect():
        said.setdefault(r.doc_id, []).append((r.score, r.predicted))
    assert {k: len(v) for k, v in said.items()} == {1: 2, 5: 2, None: 1, 7: 1, 8: 1} and all(len(set(v)) == 1 for v in said.values())
    assert said[1][0][1] == said[7][0][1] == said[None][0][1] == 0 and said[5][0][1] == 1
    kept = toxicity.clean_rows(more, model)
    assert kept.columns == more.columns and {1, 7, None} <= {r.doc_id for r in kept.select("doc_id").collect()} and kept.where("doc_id = 5").count() == 0
    assert toxicity.clean_rows(more.limit(0), model).count() == 0
