"""The language model against plain loops: gradients, scores, counts, and what training depends on."""

import math
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import lm

FLAT = np.zeros(lm.CLASSES), np.zeros((lm.CLASSES, lm.MEMBERS)), np.zeros(lm.TAIL)


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def test_gradients():
    rng = np.random.default_rng(2)
    w = lm.init(rng, *FLAT)
    w["R"] = rng.standard_normal(w["R"].shape).astype(np.float32)
    ids, targets = rng.integers(0, lm.SYMBOLS, (3, lm.CONTEXT)), rng.integers(0, lm.SYMBOLS, (3, lm.STRIDE))
    targets[targets == lm.START] = -1
    w64 = {k: v.astype(np.float64) for k, v in w.items()}
    _, g = lm.gradients(w64, ids, targets)
    for k in w64:
        for _ in range(3):
            at = (int(ids[0, rng.integers(lm.CONTEXT)]), int(rng.integers(lm.DIM))) if k == "E" else tuple(rng.integers(0, s) for s in w64[k].shape)
            old, eps = w64[k][at], 1e-5
            w64[k][at] = old + eps
            up = lm.gradients(w64, ids, targets)[0]
            w64[k][at] = old - eps
            down = lm.gradients(w64, ids, targets)[0]
            w64[k][at] = old
            assert abs((up - down) / (2 * eps) - g[k][at]) < 1e-4 + 1e-2 * abs(g[k][at]), k
    used = targets >= 0
    t = lm.folded(w)
    assert abs(-lm.log_probs(t, ids, np.maximum(targets, 0))[used].mean() - lm.gradients(w, ids, targets)[0]) < 1e-3
    wild = {k: x * 40 if k in ("Wq", "Wc", "Wm") else x for k, x in w.items()}  # logits that need their maximum taken off
    assert not lm.folded(wild)["tame"] and np.isfinite(lm.log_probs(lm.folded(wild), ids, np.maximum(targets, 0))).all()
    later = ids.copy()
    later[:, -1] = (later[:, -1] + 1) % lm.SLOTS  # causal: the last input changes the last target's score only
    assert np.abs(lm.log_probs(t, ids, np.maximum(targets, 0)) - lm.log_probs(t, later, np.maximum(targets, 0)))[:, :-1].max() < 1e-6
    first = ids.copy()
    first[:, 0] = (first[:, 0] + 1) % lm.SLOTS  # the first target sees the window's first id
    assert np.abs(lm.log_probs(t, ids, np.maximum(targets, 0)) - lm.log_probs(t, first, np.maximum(targets, 0)))[:, 0].max() > 0


def brute_log10(model, weights, text):
    """One token at a time, in plain loops, from the weights themselves."""
    encode = lm.spaced(model.path)
    ids = [i for w in lm.words_of(text) for i in np.frombuffer(encode[w], "<u2").tolist()]
    symbols = [lm.START] * lm.CONTEXT + [int(model.symbol_of[i]) for i in ids] + [lm.END]
    w, width, total = weights, lm.DIM // lm.HEADS, sum(float(model.within_log[i]) for i in ids)
    softmax = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    for n in range(len(ids) + 1):
        block = n - n % lm.STRIDE  # the window's first target
        at = lm.CONTEXT + n - 1  # the query; the window begins CONTEXT - STRIDE before its first query
        seen = range(lm.CONTEXT + block - 1 - (lm.CONTEXT - lm.STRIDE), at + 1)
        x = w["E"][[symbols[j] for j in seen]].astype(float)
        q, k, v = x[-1] @ w["Wq"], x @ w["Wk"], x @ w["Wv"]
        z = []
        for h in range(lm.HEADS):
            own = slice(h * width, (h + 1) * width)
            logits = k[:, own] @ q[own] / math.sqrt(width) + np.array([w["R"][h, at - j] for j in seen])
            z.append(softmax(logits) @ v[:, own])
        hidden = x[-1] + np.concatenate(z) @ w["Wo"]
        f = hidden + np.maximum(hidden @ w["W1"] + w["b1"], 0) @ w["W2"]
        want = symbols[lm.CONTEXT + n]
        slot = lm.RARE if want > lm.START else want
        c, m = divmod(slot, lm.MEMBERS)
        total += math.log(softmax(f @ w["Wc"] + w["bc"])[c]) + math.log(softmax(f @ w["Wm"][c] + w["bm"][c])[m])
        if want > lm.START:
            total += math.log(softmax(f @ w["Wt"] + w["bt"])[want - lm.RANGE])
    return total / math.log(10)


@pytest.mark.parametrize("at_once", [4_096, 3])
def test_score_against_plain_loops(monkeypatch, at_once):
    monkeypatch.setattr(lm, "TEXT_WINDOWS", at_once)
    rng = np.random.default_rng(4)
    w = lm.init(rng, rng.standard_normal(lm.CLASSES), rng.standard_normal((lm.CLASSES, lm.MEMBERS)), rng.standard_normal(lm.TAIL))
    w["R"] = rng.standard_normal(w["R"].shape).astype(np.float32)
    freq = rng.integers(0, 50, 1 << 16)
    symbol_of, within, _ = lm.symbols(lm.vocabulary_path(lm.VOCABULARY), freq)
    model = lm.LanguageModel(lm.vocabulary_path(lm.VOCABULARY), lm.folded(w), symbol_of, within, 100, 10, {b"red": 1.0}, 1.0)
    texts = ["", "red", "Red green \u00e9\u4f60 zzxqj " * 40, "one two three " * 70, None, "x" * 700]
    got = list(lm.score_texts(model, [lm.words_of(t) for t in texts], lm.Words(model)))
    for t, g in zip(texts, got, strict=True):
        assert abs(g[0] - brute_log10(model, w, t)) < 1e-3 * max(1.0, abs(g[0]))
        assert g[2] == sum(x == b"red" for x in lm.words_of(t)) + 1 and g[3] == [x for x in lm.words_of(t) if x != b"red"]


def test_probabilities_add_up():
    rng = np.random.default_rng(6)
    freq = rng.integers(0, 50, 1 << 16)
    symbol_of, within, counts = lm.symbols(lm.vocabulary_path(lm.VOCABULARY), freq)
    for s in (2, lm.SLOTS - 1, lm.RANGE, lm.SYMBOLS - 1):
        assert abs(np.exp(within[symbol_of == s]).sum() - 1) < 1e-9
    assert set(symbol_of) == {*range(2, lm.SLOTS), *range(lm.RANGE, lm.SYMBOLS)} and counts[lm.RARE] > 0
    t = lm.folded(lm.init(rng, *FLAT))
    ids = np.repeat(rng.integers(0, lm.SYMBOLS, (1, lm.CONTEXT)), lm.SYMBOLS, 0)
    targets = np.repeat(np.arange(lm.SYMBOLS)[:, None], lm.STRIDE, 1)
    p = np.exp(lm.log_probs(t, ids, targets).astype(float))
    keep = (np.arange(lm.SYMBOLS) != lm.RARE) & (np.arange(lm.SYMBOLS) != lm.START)  # RARE is spent on the ranges
    assert np.abs(p[keep].sum(0) - 1).max() < 1e-4


@pytest.fixture(scope="module")
def quick():
    old, lm.STEPS = lm.STEPS, 30
    lm.train.__kwdefaults__["steps"] = 30
    yield
    lm.STEPS = lm.train.__kwdefaults__["steps"] = old


@pytest.fixture(scope="module")
def corpus(spark):
    rng = np.random.default_rng(2)
    rows = [(i, " ".join(rng.choice(["red", "green", "Blue", "\u00e9", "tiny,"], rng.integers(0, 90)))) for i in range(120)] + [(500, None), (501, "never seen words"), (502, None)]
    rows += [(503, "red " * 30_000), (504, "same text"), (504, "same text"), (505, "same text"), (None, "green"), (506, " \t\n")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit(0)).withColumn("word", F.lit("x")).cache()


@pytest.mark.parametrize("head", [True, False])
def test_counts_and_base(spark, corpus, quick, monkeypatch, head):
    if not head:  # every word is joined
        monkeypatch.setattr(lm, "frequent", lambda counts: {})
    rows, df = corpus
    got = sorted(map(tuple, lm.score(df).select("doc_id", "n_tokens", "held_out", "n_known", "train_tokens", "base_score", "score").collect()), key=str)
    split = [(d, [*(t or "").encode().lower().split(), "END"]) for d, t in rows]
    train = Counter(x for d, ws in split if not held(d) for x in ws)
    n, v = sum(train.values()), len(train)
    want = sorted(((d, len(ws), held(d), sum(train[x] > 0 for x in ws), n, sum(math.log10((train[x] + 1) / (n + v + 1)) for x in ws)) for d, ws in split), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[1])
    for g, x in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == x[:5] and abs(g[5] - x[5]) < 1e-6 * max(1, abs(x[5])) and g[6] < 0
    assert lm.score(df.limit(0)).count() == 0


def test_scores_do_not_depend_on_partitions(spark, corpus, quick, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_WINDOWS", 64)  # several groups
    monkeypatch.setattr(lm, "SAMPLE_WINDOWS", 200)
    rows, df = corpus
    one, seven = (sorted((str(r.doc_id), r.n_tokens, round(r.score, 3)) for r in lm.score(x).collect()) for x in (df.coalesce(1), df.repartition(7)))
    assert one == seven


def test_no_training_rows(spark, quick):
    ids = [i for i in range(100) if held(i)]
    got = lm.score(spark.createDataFrame([(i, "all held out") for i in ids], "doc_id long, text string")).collect()
    assert len(got) == len(ids) and {(r.n_known, r.train_tokens, r.held_out) for r in got} == {(0, 0, True)} and all(r.score < 0 and r.base_score == 0 for r in got)


def test_frequent_words_are_all_above_a_count(spark):
    counts = spark.createDataFrame([(b"a", 1000), (b"b", 500), (b"c", 3), (b"d", 3), (b"e", 1)], "word binary, n long")
    assert set(lm.frequent(counts, 2)) == {b"a", b"b"}
    assert set(lm.frequent(counts, 3)) == {b"a", b"b"}  # equal counts go together
    assert lm.frequent(counts, 9)[b"a"] == pytest.approx(math.log10(1001)) and len(lm.frequent(counts, 9)) == 5
    assert lm.frequent(counts.where("false"), 9) == {} and lm.frequent(counts, 0) == {}


def test_training_grows_with_the_corpus_and_helps(spark, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_WINDOWS", 256)
    rng = np.random.default_rng(5)
    texts = [(i, " ".join(rng.choice(["red", "green", "blue", "tiny"], 300))) for i in range(400)]
    docs = spark.createDataFrame(texts, "key long, text string").repartition(4)
    w = lm.init(rng, *FLAT)
    path, symbol_of = lm.vocabulary_path(lm.VOCABULARY), np.arange(1 << 16) % (lm.SLOTS - 2) + 2
    drawn = lambda df: df.mapInArrow(lm._draw_windows(path, symbol_of, 0.5, 1), "h long, w binary")
    few, n = lm.refine(drawn(docs.where("key < 100")), w)
    more, m = lm.refine(drawn(docs), w)
    assert n > 300 and 3 * n < m < 5 * n and set(more) == set(w)
    encode = lm.spaced(path)
    inputs, targets, _ = lm.windows_of([np.append(symbol_of[np.frombuffer(b"".join(map(encode.__getitem__, lm.words_of(texts[0][1]))), "<u2")], lm.END)])
    drawn_all = sorted(bytes(r.w) for r in docs.where("key = 0").mapInArrow(lm._draw_windows(path, symbol_of, 1.0, 1), "h long, w binary").collect())
    assert drawn_all == sorted(r.tobytes() for r in np.concatenate([inputs, targets], 1).astype("<i2"))
    loss = [lm.gradients(x, inputs, targets)[0] for x in (w, few, more)]
    assert loss[1] < loss[0] and loss[2] < loss[0]


def test_every_window_trains(spark, quick, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_WINDOWS", 64)
    monkeypatch.setattr(lm, "SAMPLE_WINDOWS", 20)
    rng, seen, real = np.random.default_rng(8), [], lm.refine
    texts = [(i, " ".join(rng.choice(["red", "green", "blue", "tiny"], rng.integers(1, 200)))) for i in range(150)]

    def counted(windows, weights):
        out = real(windows, weights)
        seen.append(out[1])
        return out

    monkeypatch.setattr(lm, "refine", counted)
    model, _ = lm.fit(spark.createDataFrame([*texts, texts[0]], "doc_id long, text string"))  # a row that repeats trains once
    encode = lm.spaced(model.path)
    assert sum(seen) == sum(sum(len(encode[w]) // 2 for w in lm.words_of(t)) // lm.STRIDE + 1 for _, t in texts)
    assert len(seen) == lm.ROUNDS and min(seen) > 0


def plain_gradients(w, ids, targets):
    """``lm.gradients`` step by step: divided attention weights, one class after the other, nothing packed."""
    heads = lambda x: x.reshape(len(ids), -1, lm.HEADS, lm.WIDTH).transpose(0, 2, 1, 3)
    join = lambda x: x.transpose(0, 2, 1, 3).reshape(len(ids), -1, lm.DIM)
    flat, scale = (lambda x: x.reshape(-1, x.shape[-1])), np.float32(1 / math.sqrt(lm.WIDTH))
    x = w["E"][ids]
    xq = x[:, -lm.STRIDE :]
    q, k, v = heads(xq @ w["Wq"]) * scale, heads(x @ w["Wk"]), heads(x @ w["Wv"])
    a = np.exp(np.minimum(q @ k.transpose(0, 1, 3, 2) + lm.bias(w), 30.0))
    a /= a.sum(-1, keepdims=True)
    z = join(a @ v)
    h = xq + z @ w["Wo"]
    r = np.maximum(h @ w["W1"] + w["b1"], 0)
    f, t = flat(h + r @ w["W2"]), targets.ravel()
    used = t >= 0
    n, loss, df, g = np.float32(max(used.sum(), 1)), 0.0, np.zeros_like(f), {k: np.zeros_like(y) for k, y in w.items()}
    slot = np.where(used, np.where(t > lm.START, lm.RARE, t), 0)

    def output(at, weight, added, own):
        nonlocal loss
        said, d = lm._cross_entropy(f[at] @ weight + added, own)
        loss -= float((said * used[at]).sum())
        d *= used[at][:, None] / n
        df[at] += d @ weight.T
        return f[at].T @ d, d.sum(0)

    g["Wc"], g["bc"] = output(np.arange(len(t)), w["Wc"], w["bc"], slot // lm.MEMBERS)
    for c in range(lm.CLASSES):
        at = np.flatnonzero(slot // lm.MEMBERS == c)
        if len(at):
            g["Wm"][c], g["bm"][c] = output(at, w["Wm"][c], w["bm"][c], slot[at] % lm.MEMBERS)
    at = np.flatnonzero(t > lm.START)
    g["Wt"], g["bt"] = output(at, w["Wt"], w["bt"], t[at] - lm.RANGE)
    du = (df @ w["W2"].T) * (flat(r) > 0)
    dh = df + du @ w["W1"].T
    g["W2"], g["W1"], g["b1"], g["Wo"] = flat(r).T @ df, flat(h).T @ du, du.sum(0), flat(z).T @ dh
    dz = heads((dh @ w["Wo"].T).reshape(z.shape))
    da, dv = dz @ v.transpose(0, 1, 3, 2), join(a.transpose(0, 1, 3, 2) @ dz)
    ds = a * (da - (da * a).sum(-1, keepdims=True))
    g["R"] = np.stack([np.bincount(lm.BEHIND[lm.BEHIND >= 0], y[lm.BEHIND >= 0], lm.CONTEXT) for y in ds.sum(0)]).astype(w["R"].dtype)
    dq, dk = join(ds @ k) * scale, join(ds.transpose(0, 1, 3, 2) @ q)
    g["Wq"], g["Wk"], g["Wv"] = flat(xq).T @ flat(dq), flat(x).T @ flat(dk), flat(x).T @ flat(dv)
    dx = dk @ w["Wk"].T + dv @ w["Wv"].T
    dx[:, -lm.STRIDE :] += dh.reshape(z.shape) + dq @ w["Wq"].T
    np.add.at(g["E"], ids.ravel(), flat(dx))
    return loss / float(n), g


def some_windows(n):
    rng = np.random.default_rng(12)
    w = lm.init(rng, *FLAT)
    w["R"] = rng.standard_normal(w["R"].shape).astype(np.float32)
    common = rng.geometric(0.01, (n, lm.CONTEXT + lm.STRIDE)).clip(1, lm.SYMBOLS - 1)
    ids, targets = common[:, : lm.CONTEXT], common[:, lm.CONTEXT :].copy()
    targets[targets == lm.START] = -1
    targets[0, 5:] = -1
    return w, ids, targets


@pytest.mark.parametrize("times", [1, 200])
def test_gradients_against_plain_steps(times):
    w, ids, targets = some_windows(40)
    w["Wc"], w["Wm"] = w["Wc"] * times, w["Wm"] * times  # at 200 the outputs' exp would overflow without their maximum taken off
    w = {k: x.astype(np.float64) for k, x in w.items()} if times > 1 else w
    loss, g = lm.gradients(w, ids, targets)
    want, plain = plain_gradients(w, ids, targets)
    assert np.isfinite(loss) and abs(loss - want) < 1e-5 * want
    for k in w:
        assert np.abs(g[k] - plain[k]).max() <= 2e-5 * np.abs(plain[k]).max(), k


def test_a_training_step_costs_less_than_plain_steps():
    w, ids, targets = some_windows(lm.BATCH)

    def cost(f):
        begin = time.process_time()
        for _ in range(5):
            f(w, ids, targets)
        return time.process_time() - begin

    ours, plain = zip(*((cost(lm.gradients), cost(plain_gradients)) for _ in range(8)), strict=True)
    assert min(ours) < 0.8 * min(plain)


def test_drawn_windows_come_many_at_once():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["red", "green"], rng.integers(0, 200))) for _ in range(300)]
    table = pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([*texts[:-1], None])], names=["key", "text"])
    path, symbol_of = lm.vocabulary_path(lm.VOCABULARY), np.arange(1 << 16) % (lm.SLOTS - 2) + 2
    whole = list(lm._draw_windows(path, symbol_of, 1.0, 1)(iter([table.slice(0, 100), table.slice(100)])))
    each = [b for i in range(300) for b in lm._draw_windows(path, symbol_of, 1.0, 1)(iter([table.slice(i, 1)]))]
    assert len(whole) == 1 and len(each) == 300
    assert whole[0].to_pylist() == [r for b in each for r in b.to_pylist()]


def test_groups_learn_their_windows_by_hash(monkeypatch):
    monkeypatch.setattr(lm, "BATCH", 4)
    w, ids, targets = some_windows(23)
    rows = np.concatenate([ids, targets], 1).astype("<i2")
    h = np.random.default_rng(1).integers(-50, 50, 23)
    h[:4] = 7  # equal hashes go by the windows' bytes
    g = np.arange(23) % 2
    order = sorted(range(23), key=lambda i: g[i])
    mixed_up = sorted(reversed(range(23)), key=lambda i: g[i])

    def learned(order, size):
        b = pa.RecordBatch.from_arrays([pa.array(g[order]), pa.array(h[order]), pa.array([rows[i].tobytes() for i in order], pa.binary())], names=["g", "h", "w"])
        (out,) = lm._train_groups(w)(b.slice(lo, size) for lo in range(0, 23, size))
        return out.column("n")[0].as_py(), np.frombuffer(out.column("w")[0].as_py()) / 23

    n, got = learned(order, 23)
    assert n == 23 and all((learned(*x)[1] == got).all() for x in ((order, 5), (mixed_up, 23), (mixed_up, 1)))
    want = 0
    for group in (0, 1):
        adam, own = lm.Adam(w), sorted((i for i in range(23) if g[i] == group), key=lambda i: (h[i], rows[i].tobytes()))
        for lo in range(0, len(own), 4):
            adam.step(rows[own[lo : lo + 4]], lm.PASS_RATE * min(1.0, (adam.at + 1) / 20))
        want = want + adam.flat.astype(float) * len(own)
    assert np.abs(want / 23 - got).max() < 1e-6
