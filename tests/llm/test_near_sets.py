"""Links by SimHash and exact similarity, held against every pair."""

import numpy as np
from pyspark.sql import functions as F

from tapeworks.llm import neardup


def test_simhash_names_links_by_similarity(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(5_000)]
    texts = []
    for _ in range(12):
        base = list(rng.choice(words, 900))
        texts.append(" ".join(base))
        for k in (1, 1, 3, 40):  # words changed; 40 leave a similarity below 0.8
            own = list(base)
            for at in rng.choice(900, k, replace=False):
                own[at] = "changed"
            texts.append(" ".join(own))
    texts += ["", None, "one", "one two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    schema = "doc_id long, text_hash long, set_id long, grams array<long>, fp long, keys array<long>"
    sets = neardup._rows(docs).mapInArrow(neardup._sets(5, *neardup.banding(0.8)), schema).cache()

    own = {r.set_id: (set(r.grams), r.fp) for r in sets.where("grams IS NOT NULL").collect()}
    for grams, fp in own.values():
        assert fp == neardup.signed(neardup.simhash(np.array(sorted(grams), np.int64).view(np.uint64)))
    similar = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    close = {(u, v) for u, (a, x) in own.items() for v, (b, y) in own.items() if u < v and ((x ^ y) & (2**64 - 1)).bit_count() <= 2 and similar(a, b)}
    found = neardup.near_sets(sets, 0.8)
    assert close and {(r.u, r.v) for r in found.collect()} <= close
    label = {r.node: r.label for r in neardup.components(found).collect()}  # the smallest of a component has no row of its own
    assert all(label.get(u, u) == label.get(v, v) for u, v in close)

    # without any band the links of SimHash stand, with bands all links of the similarity
    bare = neardup.link_sets(sets.withColumn("keys", F.array().cast("array<long>")), 0.8, found)
    assert {r.node: r.label for r in bare.collect()} == label
    every = {r.node: r.label for r in neardup.link_sets(sets, 0.8, found).collect()}
    assert all(every.get(u, u) == every.get(v, v) for u, (a, _) in own.items() for v, (b, _) in own.items() if u < v and a and similar(a, b))
