"""The corpus pipeline: every stage's rows, read and held against plain loops."""

import zlib

import numpy as np
from pyspark.sql import functions as F
from test_llm import brute_hits

import corpus_pipeline
from tapeworks.llm import mixing, toxicity
from tapeworks.llm.common import stage, table

SF = "/root/testdata/sf0.001"


def grams(text, n=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_leaders(rows):
    """The smallest id of each component of sets of five words at similarity 0.8."""
    sets, label = [grams(r.text) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return sorted(min(r.doc_id for r, x in zip(rows, label, strict=True) if x == y) for y in set(label))


def test_every_stage(spark):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    extra = docs.limit(3).withColumn("doc_id", F.col("doc_id") + 900_000).union(docs.limit(1).withColumns({"doc_id": F.lit(910_000).cast("long"), "text": F.lit(None).cast("string")}))
    item = table(spark, SF, "benchmark").where("length(text) > 200").first()
    extra = extra.union(docs.limit(1).withColumns({"doc_id": F.lit(910_001).cast("long"), "text": F.lit(item.text)}))
    docs = stage(docs.union(extra.select(*docs.columns)), "pipeline_input")
    benchmark = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    for name, step in corpus_pipeline.STAGES:
        rows, out = docs.collect(), step(spark, docs, SF)
        if name != "token_store":
            assert out.columns == docs.columns
            out = stage(out, f"test_{name}")
        got = out.collect()
        ids = sorted(r.doc_id for r in got)
        if name == "toxicity":
            model = toxicity.fit(toxicity.training_sample(docs, table(spark, SF, "labels")))
            flags = toxicity.Flags(model.lexicon)
            score = model.score(np.array([toxicity.features(r.text, flags) for r in rows]))
            assert ids == sorted(r.doc_id for r, s in zip(rows, score, strict=True) if s < 0.7)
        elif name == "simhash":
            assert ids == brute_leaders(rows) and len(ids) < len(rows)
        elif name == "decontamination":
            hit = {r.doc_id: brute_hits(r.text, benchmark) for r in rows}
            assert ids == sorted(d for d, (n, h, _) in hit.items() if not (h > 0 and 20 * h >= n)) and 910_001 not in ids
        elif name == "mixing":
            copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
            assert ids == sorted(d for d, n in copies.items() for _ in range(n)) and max(copies.values()) <= 2
        else:
            tokenizer = Tokenizer.from_file(corpus_pipeline.tokenstore.vocabulary_path())
            want = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4").tobytes() for r in rows}
            assert ids == sorted(r.doc_id for r in rows) and all(r.ids_crc32 == zlib.crc32(want[r.doc_id]) and 4 * r.n_tokens == len(want[r.doc_id]) for r in got)
        by = {r.doc_id: r for r in rows}
        if name != "token_store":
            assert all(r == by[r.doc_id] for r in got)
        docs = out
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_tables(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, step in corpus_pipeline.STAGES:
        out = step(spark, docs, SF)
        assert out.count() == 0, name
