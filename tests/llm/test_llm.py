"""Small brute-force checks of the training-data operators."""

import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapeworks.llm import ann, chat, decontam, mixing, neardup, sharding, tokenstore, toxicity, urls
from tapeworks.llm.common import stage

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int"


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(7)
    words = ["alpha", "beta,", "gamma", "Delta", "epsilon", "don't", "é", "zeta9", "<|endoftext|>", "--"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(1, 120))), "en", f"s{i % 3}", 0, 1) for i in range(60)]
    rows += [(100, None, "en", None, None, 1), (101, "", None, "s1", 0, None), (102, "x " * 20_000, "en", "s1", 0, 1), (None, "alpha beta", "en", "s0", 0, 1)]
    rows += [(103, rows[5][1], "en", "s2", 0, 1), (104, rows[5][1], "en", "s2", 0, 1), (104, rows[5][1], "en", "s2", 0, 1), (105, " \t\n", "en", "s0", 0, 1)]
    return spark.createDataFrame(rows, DOCS).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_tokenstore_round_trip(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenstore.vocabulary_path())
    path = tokenstore.write_store(docs)
    got, whole = tokenstore.read_store(spark, path).collect(), tokenstore.reconstruct(spark, path).collect()
    ids = {r.start: list(r.ids) for r in whole}
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(t.encode(r.text or "", add_special_tokens=False).ids + [1])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and ids[at] in texts[r.doc_id] and r.n_tokens == len(ids[at])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[at], "<u4").tobytes())
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order[0] is None and order[1:] == sorted(order[1:]) and len(got) == docs.count()
    assert spark.read.parquet(f"{path}/manifest").agg(F.sum("n_tokens")).first()[0] == at
    assert tokenstore.read_store(spark, tokenstore.write_store(empty(spark))).count() == 0


def test_tokenstore_fails_where_files_are_lost_or_changed(spark, docs, monkeypatch):
    import os
    import shutil
    from urllib.parse import urlparse

    monkeypatch.setattr(tokenstore, "HOT", 1)  # every repeated chunk is salted
    path = tokenstore.write_store(docs.repartition(4))
    local = urlparse(path).path
    want = sorted(map(str, tokenstore.read_store(spark, path).collect()))
    assert len(want) == docs.count() and tokenstore.reconstruct(spark, path).count() == len(want)

    def broken(change, reads=(tokenstore.read_store,)):
        copy = f"{local}-broken"
        shutil.copytree(local, copy)
        change(copy)
        for read in reads:
            with pytest.raises(Exception, match="root|missing|digest|PATH_NOT_FOUND"):
                read(spark, f"file://{copy}").collect()
        shutil.rmtree(copy)

    def lose(name):
        def change(at):
            part = max((f for f in os.listdir(f"{at}/{name}") if f.endswith(".parquet")), key=lambda f: os.path.getsize(f"{at}/{name}/{f}"))
            os.remove(f"{at}/{name}/{part}")

        return change

    for name in ("recipes", "chunks", "manifest", "corpus"):
        broken(lose(name), (tokenstore.read_store, tokenstore.reconstruct) if name == "chunks" else (tokenstore.reconstruct,))
    broken(lambda at: shutil.rmtree(f"{at}/manifest"))

    def swap(name, column, value):
        def change(at):
            df = spark.read.parquet(f"file://{at}/{name}").withColumn(column, value)
            rows, schema = df.collect(), df.schema
            shutil.rmtree(f"{at}/{name}")
            spark.createDataFrame(rows, schema).write.parquet(f"file://{at}/{name}")

        return change

    broken(swap("recipes", "n_tokens", F.col("n_tokens") + 1))
    broken(swap("recipes", "chunks", F.reverse("chunks")))
    broken(swap("recipes", "doc_id", F.col("doc_id") + 1))
    broken(swap("chunks", "payload", F.concat("payload", F.lit(b"xx"))))
    broken(swap("manifest", "n_docs", F.lit(0).cast("long")))


def test_word_encoder_against_the_tokenizer():
    e = tokenstore.WordEncoder(tokenstore.vocabulary_path(), 2)
    rng = np.random.default_rng(11)
    signs = [*"abzAB 's't.,;:!?<|>-_'\u00e9\u00c8\u00df\u0130\u03a3\u03c3\u03c2\ufb01\u4f60\u00fc\u0308\u0660\u00bd\u2167\t\n \u00a0", "<|endoftext|>", " ", " "]
    texts = ["".join(rng.choice(signs, rng.integers(0, 60))) for _ in range(3000)] + [None, "", "x" * 5000, "a " * 5000]
    for at in range(0, len(texts), 100):
        for t, got in zip(texts[at : at + 100], e.encode_all(texts[at : at + 100]), strict=True):
            assert np.frombuffer(got, "<u2").tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_word_cache_that_overflows(monkeypatch):
    monkeypatch.setattr(tokenstore, "CACHE_WORDS", 5)
    e = tokenstore.WordEncoder(tokenstore.vocabulary_path(), 4)
    for t in ("one two three four, five; six seven", "one two nine ten", "un deux trois, one two three!? \u00e9t\u00e9"):
        assert np.frombuffer(e.encode_all([t, t])[1], "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_crc_of_parts():
    a, b = b"hello", b"world" * 999
    got = tokenstore.crc_shift(np.array([zlib.crc32(a), zlib.crc32(b)], np.uint32), np.array([len(b), 0]))
    assert int(np.bitwise_xor.reduce(got)) == zlib.crc32(a + b)


def test_mix(spark, docs):
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault((r.source, r.source_size, r.target), []).append(r)
        assert r.taken <= 2 * r.size
    total = sum(k[1] for k in by)
    assert abs(sum(k[2] for k in by) - 1.5 * total) < 1e-6
    for (_, size, target), rows in by.items():
        assert target <= 2 * size + 1e-9 and abs(sum(r.taken for r in rows) - target) <= max(r.size for r in rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns and mixing.mixed_rows(docs).count() == sum(r.copies for r in got)


def test_mix_draws_equal_rows_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_DOCS", 3)  # several rounds
    rows = [(1, "w " * 10, "a")] * 100 + [(2, None, "a")] * 7 + [(None, "x y", None)] * 50 + [(i, "some words here", "b") for i in range(10, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    for source in ("a", "b", None):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own) / 2 and all(r.taken <= 2 * r.size for r in own)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.coalesce(1)).collect()))
    assert mixing.mixed_rows(df).count() == sum(r.copies for r in got)


def test_shards(spark, docs):
    got = sharding.shard(docs).collect()
    assert len(got) == docs.count()
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in got if r.text_crc32 == zlib.crc32(docs.where("doc_id = 103").first().text.encode())}) == 1
    assert {r.size for r in got if r.doc_id == 100} == {1} and sharding.shard(empty(spark)).count() == 0
    same = spark.range(20_000).select(F.lit(7).alias("doc_id"), F.lit("one text").alias("text"), F.lit(1).alias("copy"))  # rows that repeat in all columns
    sums = sharding.shard(same.unionByName(same.limit(5).withColumn("text", F.lit(None).cast("string")))).groupBy("shard").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("top")).collect()
    assert len(sums) == 8 and max(r.b for r in sums) < 1.2 * min(r.b for r in sums) and all(r.n == r.slots == r.top + 1 for r in sums) and sum(r.n for r in sums) == 20_005
    every = sorted((str(r.doc_id), r.size, r.text_crc32) for r in got)
    assert every == sorted((str(r.doc_id), len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    many = sharding.shard(spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"))).groupBy("shard").agg(F.sum("size").alias("b")).collect()
    assert max(r.b for r in many) < 1.05 * min(r.b for r in many)


def brute_components(fps):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_simhash_components(spark, docs):
    masks = neardup.covering_masks()
    for i in range(64):
        for j in range(i, 64):
            assert any(not (m >> i & 1) and not (m >> j & 1) for m in masks)
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    fps = {b for b in base}
    for _ in range(200):  # chains of near fingerprints
        b = list(fps)[int(rng.integers(0, len(fps)))]
        fps.add(b ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    fps |= {base[0] ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)}  # one crowded bucket
    fps = sorted(fps)
    nodes = spark.createDataFrame([(neardup.signed(f),) for f in fps], "fp long")
    got = {r.node % (1 << 64): r.label % (1 << 64) for r in neardup.components(neardup.link_fingerprints(nodes)).collect()}
    want = brute_components(fps)
    groups = {}
    for f, w in zip(fps, want, strict=True):
        groups.setdefault(w, set()).add(got.get(f, f))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)
    r = {x.doc_id: x for x in neardup.near_duplicates(docs).collect()}
    assert r[103].component_id == r[5].component_id and r[100].fp == 0 and r[100].component_id == 100 == r[101].component_id
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IN (103, 104)").count() == 0
    assert neardup.near_duplicates(empty(spark)).count() == 0


def test_one_of_each_by_similarity(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = []
    for g in range(40):  # a text and versions of it with one to eight words changed
        base = [f"v{x}" for x in rng.integers(0, 5000, 150)]
        for c in range(6):
            words = list(base)
            for at in rng.choice(150, 0 if c == 0 else int(rng.integers(1, 8)), replace=False):
                words[at] = f"new{rng.integers(0, 10**6)}"
            rows.append((len(rows), " ".join(words)))
    rows += [(900, None), (901, ""), (902, "a b"), (903, "a  B"), (904, rows[0][1]), (904, rows[0][1])]
    grams = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(max(1, len(w) - 4))}
    sets, label = [grams(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    want = sorted({rows[x][0] for x in label})
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(r.doc_id for r in neardup.one_of_each(docs).collect()) == want
    assert len(want) < neardup.one_of_each(docs, shingle=3, radius=2).count()
    assert neardup.one_of_each(docs.limit(0)).count() == 0
    nodes = [1 << 40 | int(x) for x in rng.choice(1 << 12, 300, replace=False)]
    monkeypatch.setattr(neardup, "SMALL", 4)  # all by points
    for radius in (0, 1, 3):
        got = {r.node: r.label for r in neardup.components(neardup.link_fingerprints(spark.createDataFrame([(x,) for x in nodes], "fp long"), radius)).collect()}
        near = {x: x for x in nodes}
        for x in nodes:
            for y in nodes:
                if (x ^ y).bit_count() <= radius and near[x] != near[y]:
                    a, b = sorted((near[x], near[y]))
                    near = {k: a if v == b else v for k, v in near.items()}
        assert {x: got.get(x, x) for x in nodes} == near


def test_chat(spark):
    texts = ["", "</s>[INST] ok [/INST]", "back\\slash \\\\", "<|turn|>user<|said|>", "<|end|>\n", "a<\\|turn|>b", "é\n", None]
    rows = [(1, i, ("user", "assistant")[i % 2], t, "x") for i, t in enumerate(texts)] + [(2, 0, "assistant", "first", "x"), (2, 1, None, "odd", "x"), (None, 0, "user", "lost", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_chats(df)
    v = {r.conv_id: (r.valid, r.broken_at) for r in out.collect()}
    assert v[1] == (True, None) and v[2] == (False, 0) and v[None] == (True, None)
    back = {r.conv_id: r for r in chat.read_chats(out).collect()}
    assert back[1].texts == [t or "" for t in texts] and back[1].loss == [t or "" for t in texts[1::2]] and back[2].roles == ["assistant", ""]
    d = {r.conv_id: r for r in chat.digests(chat.read_chats(out)).collect()}
    said = "".join(("user", "assistant")[i % 2] + "\n" + (t or "") + "\n" for i, t in enumerate(texts))
    assert d[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and d[1].loss_chars == sum(len(t or "") for t in texts[1::2])
    assert chat.format_chats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(turn="<|a", said="a>")


def test_nearest(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((1200, 16)) * rng.uniform(0.5, 2, (1200, 1))
    x[300:900] = x[300]
    rows = [(i, [float(y) for y in v], 0) for i, v in enumerate(x)] + [(5000, None, 0), (5001, [0.0] * 16, 0), (5002, [math.nan] * 16, 0), (5020, [1.0, 2.0], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit, want_n = 0, 0
    for q in range(0, 1200, 20):
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(1200), -np.round(s, 12))) if i != q][:20]
        assert [a for a, _, _ in got[q]] == list(range(1, 21)) and all(abs(sc - s[v]) < 1e-9 for _, v, sc in got[q]) and q not in [v for _, v, _ in got[q]]
        hit, want_n = hit + len(set(order) & {v for _, v, _ in got[q]}), want_n + 20
    assert hit / want_n >= 0.9 and set(got) == set(range(0, 1200, 20))
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_probes_are_the_perturbed_buckets_each_once_in_order_of_cost():
    rng = np.random.default_rng(8)
    h = ann.Hashing(6, 1.0, 4, cell=2)
    x = rng.standard_normal((5, 6))
    p, (codes, cells) = h.project(x, rows=False), h.probes(x, 10**6)
    assert codes.shape == (5, ann.TABLES, 3**4) and (codes[..., 0] == h.codes(p)[0]).all()
    moves = np.stack(np.meshgrid(*[[-1, 0, 1]] * 4, indexing="ij"), -1).reshape(-1, 4)
    for t in range(ann.TABLES):
        want = {tuple(h.codes(p + m)[:, 0, t].tolist()) for m in moves}  # bucket and cell
        assert set(zip(codes[0, t].tolist(), cells[0, t].tolist(), strict=True)) == want and len(set(codes[0, t].tolist())) == 81
    sets = ann.perturbations(4, 10**6)
    near = [j * (j + 1) / (4 * 5 * 6) for j in range(1, 5)]
    z = np.array(near + [1 - j / 5 + j * (j + 1) / (4 * 5 * 6) for j in range(4, 0, -1)])
    assert (np.diff(sets @ z) >= -1e-12).all() and not (sets & sets[:, ::-1]).any()


def test_crowded_cells_lie_in_several_blocks():
    places = ann.Places(2, 5, {7: 3, -9: 5})
    assert places.count(np.array([7, 8, -9])).tolist() == [3, 1, 5]
    cell = np.full(5, -9)
    assert sorted(places.block(np.int64(1), cell, np.arange(5)).tolist()) == [5, 6, 7, 8, 9]


def test_nearest_splits_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(9)
    x = rng.standard_normal((2000, 8))
    x[:900] = x[0] + rng.standard_normal((900, 8)) * 1e-3
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, stats = {}, {}
    for r in ann.nearest(df, df.where("vec_id % 20 = 0"), stats=stats).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q, found in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:20].tolist()) & found)
    assert len(got) == 100 and hit >= 0.9 * 2000 and stats["rows"] == 2000 and stats["probes"] >= 1


def test_nearest_with_a_dense_group_at_one_end(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((6000, 16))
    x /= np.sqrt((x * x).sum(1))[:, None]
    one = np.r_[np.full(15, 0.1), -1.0]
    x[:2000] = one / np.sqrt(one @ one) + rng.standard_normal((2000, 16)) * 1e-4  # near copies, smallest last coordinates
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id >= 2000 AND vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(2000, 6000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.argsort(-s)[:20].tolist()) & got.get(q, set()))
    assert hit / (200 * 20) >= 0.9


@pytest.mark.parametrize("probes", [1, 10**6])
def test_nearest_serves_queries_that_probes_leave_short(spark, monkeypatch, probes):
    monkeypatch.setattr(ann, "fit_probes", lambda *a, **b: probes)  # a million: no number of probes does
    x = np.random.default_rng(6).standard_normal((900, 16))
    x[7] *= 100  # all other distances shrink
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 30 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == set(range(0, 900, 30)) and all(len(v) == 20 for v in got.values())
    exact = 0
    for q, v in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        exact += v == np.argsort(-s)[:20].tolist()
    assert exact == len(got) if probes == 10**6 else exact > 0
    few = df.where("vec_id < 5")
    assert ann.nearest(few, few).count() == 20


def test_urls(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "https://B.Example.NET/en/1?x": ("b.example.net", "/en/1", "example.net/en/", "allow"), "http://net?q": ("net", "", None, "allow"),
        "x://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"), "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"), None: ("", "", None, "allow"),
        "no scheme": ("", "", None, "allow"), "a://w.org/fr/#t": ("w.org", "/fr/", "org/fr/", "allow"), "a://b://c.net/": ("b:", "//c.net/", None, "allow"),
    }
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(df).collect()}
    assert got == dict(enumerate(cases.values()))
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_nearest_recall_of_queries_that_did_not_fit_the_probes(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((6000, 16)) * rng.uniform(0.3, 3, (6000, 1))
    df = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 10 = 0")
    fitted = {r.vec_id for r in asked.orderBy(F.xxhash64("embedding", F.lit(ann.SEED)), "vec_id").limit(ann.FIT_QUERIES).collect()}
    got, stats = {}, {}
    for r in ann.nearest(df, asked, stats=stats).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in set(range(0, 6000, 10)) - fitted:
        s = x @ x[q]
        s[q] = -np.inf
        recall.append(len(set(np.argsort(-s)[:20].tolist()) & got[q]) / 20)
    print("held-out queries, mean and least recall:", len(recall), np.mean(recall), min(recall), stats)
    assert len(recall) == 600 - 256 and np.mean(recall) >= 0.9


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    mild, bad = [f"word{i}" for i in range(60)], ["zork", "blargh", "snerf"]
    rows, labels = [], []
    for i in range(900):
        toxic = int(i % 5 == 0)
        ws = list(rng.choice(mild, 30)) + (list(rng.choice(bad, 2)) if toxic else [])
        rows.append((i, " ".join(rng.permutation(ws)), 0.5))
        labels.append((i, toxic))
    rows += [(2000, None, 0.0), (2001, "", 0.0)]
    df, lab = spark.createDataFrame(rows, "doc_id long, text string, score double"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(toxicity.training_sample(df, lab))
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    assert np.mean([got[i].predicted == t for i, t in labels]) > 0.98 and got[2000].predicted == 0 and got[2000].score == got[2001].score
    assert toxicity.clean_rows(df, model).count() < 740
    assert toxicity.score(df.limit(0), toxicity.fit(toxicity.training_sample(df, lab.limit(0)))).count() == 0


def brute_hits(text, items, window=13):
    import re

    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    w, hit, names = words(text), set(), set()
    for name, t in items:
        v = words(t)
        n = min(len(v), window)
        grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1) if n else ():
            if tuple(w[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names.add(str(name))
    return len(w), len(hit), sorted(names)


def test_decontamination(spark):
    rng = np.random.default_rng(9)
    vocab = [f"w{i}" for i in range(6)]  # few words: many chance meetings
    say = lambda n: " ".join(rng.choice(vocab, n))
    items = [(i, say(int(rng.integers(13, 40)))) for i in range(8)] + [(30, "w3 w1"), (31, "w3 w1"), (32, "zz " * 1000), (33, "zz " * 40 + "w1")] + [(20, "W1 w2, w3"), (21, "é"), (22, None), (23, "--"), (24, say(12)), (25, "w0 " * 15)]
    rows = [(i, f"{say(30)}. {items[i % 8][1][: int(rng.integers(5, 200))]} {say(5)}") for i in range(40)] + [(90, None), (91, ""), (92, "w1 w2 w3 É é"), (93, say(3000)), (94, "Zz " * 20_000), (95, "zz " * 12), (90, None), (93, "w2"), (None, items[0][1]), (5, "other text")]
    df, b = spark.createDataFrame(rows, "doc_id long, text string").withColumn("th", F.lit(1)), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.decontaminate(df, b).collect()}
    want = set()
    for d, t in rows:
        n, h, names = brute_hits(t, items)
        want.add((d, n, h, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), h > 0 and 20 * h >= n))
    assert got == want
    assert decontam.decontaminate(df, b.limit(0)).where("n_hit > 0").count() == 0 and decontam.decontaminate(df.limit(0), b).count() == 0
    assert decontam.clean_rows(df, b).count() == sum(not w[5] for w in (next(x for x in want if x[0] == d and x[1] == brute_hits(t, [])[0]) for d, t in rows))


def test_decontamination_shuffles_as_it_broadcasts(spark):
    """Past the size of a broadcast the joins are dealt; spans and items stay the same."""
    rng = np.random.default_rng(10)
    say = lambda n: " ".join(rng.choice(["w0", "w1", "w2"], n))
    items = [(i, say(int(rng.integers(1, 30)))) for i in range(20)]
    rows = [(i, say(60)) for i in range(30)] + [(None, items[3][1])]
    df, b = decontam.keyed(spark.createDataFrame(rows, "doc_id long, text string")), spark.createDataFrame(items, "item_id long, text string")
    wide, dealt = decontam.hits(df, b), decontam.hits(df, b, prints_most=0, most=0)
    for x, y in zip(wide, dealt, strict=True):
        assert sorted(map(repr, x.collect())) == sorted(map(repr, y.select(x.columns).collect()))


def test_decontamination_of_a_shared_window(spark, monkeypatch):
    """1,000 items and 10,000 documents with one passage: rows follow documents and items, not their product."""
    sizes = {}

    def counted(df, tag):
        out = stage(df, tag)
        sizes[tag] = out.count()
        return out

    monkeypatch.setattr(decontam, "stage", counted)
    line = " ".join(f"k{i}" for i in range(13))
    items = spark.range(1000).select(F.col("id").alias("item_id"), F.concat_ws(" ", F.lit(line), F.concat(F.lit("own"), "id")).alias("text"))
    df = spark.range(10_000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.concat(F.lit("before"), "id"), F.lit(line), F.concat(F.lit("after"), "id")).alias("text"))
    names = ",".join(sorted(str(i) for i in range(1000)))
    got = decontam.decontaminate(df, items).groupBy("n_hit", "n_items", "items_sha256").count().collect()
    assert [tuple(r) for r in got] == [(13, 1000, hashlib.sha256(names.encode()).hexdigest(), 10_000)]
    assert sizes["hits"] == sizes["document_classes"] == 10_000 and sizes["item_lists"] == 1 and sizes["class_items"] == 2000
