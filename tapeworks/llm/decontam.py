"""Benchmark decontamination by winnowing, with DataFrame functions only.

Both sides' words give hashes of ``K`` consecutive words; of every ``WINDOW - K + 1`` consecutive hashes
the least is kept as a fingerprint. A span of ``WINDOW`` words that a document shares with an item holds
such a run of hashes, so both keep the same one: joined fingerprints name every document that can be hit.
Items of fewer words are one window each, with the hash of all their words as fingerprint. In the documents
that met an item, hits are extended to all words: each window is held, word for word, against the distinct
windows of all items. So a word that repeats costs a row for each of its places in the document, not for
each pair of places in document and item.

Which items a document met is worked out once for each set of windows that documents have in common, not for
each document: windows of the same items are one class, documents of the same classes one set. A passage of a
thousand items in ten thousand documents is one class and one set of a thousand rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tapeworks.llm.common import ascii_lower, stage

WINDOW, K = 13, 6
#: Item fingerprints (24 bytes each) and windows (some 100 bytes each) are broadcast up to so many; beyond, the join shuffles.
BROADCAST_FINGERPRINTS, BROADCAST_WINDOWS = 1_000_000, 200_000
#: Parts over which the rows of one key are dealt where a join shuffles.
SALTS = 32
BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text: Column) -> Column:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text, A-Z in lower case; null: none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BREAK), lambda x: x != "")


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once: inside a lambda a column expression would be computed per element."""
    return F.transform(F.array(value), body)[0]


def grams(ws: Column, k: int) -> Column:
    """Hashes of k consecutive words, by position from 0."""
    return F.when(F.size(ws) >= k, F.transform(F.sequence(F.lit(1), F.size(ws) - (k - 1)), lambda i: F.xxhash64(F.slice(ws, i, k)))).otherwise(
        F.array().cast("array<bigint>")
    )


def grams_of(k: int):
    """A function of words; the lambda takes one argument only, as Spark would fill a second one with the position."""
    return lambda ws: bound(ws, lambda w: grams(w, k))


def winnowed(ws: Column, window: int = WINDOW, k: int = K) -> Column:
    """The distinct least hashes over all runs of ``window - k + 1`` hashes; none for fewer than ``window`` words."""
    span = window - k + 1
    least = lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (span - 1)), lambda i: F.array_min(F.slice(h, i, span)))
    return F.when(F.size(ws) >= window, F.array_distinct(bound(grams(ws, k), least))).otherwise(F.array().cast("array<bigint>"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a key of both that tells documents apart; rows that repeat share it."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.withColumn("th", F.xxhash64("text"))


def windows(ws: Column, n: Column) -> Column:
    """(p, g): each run of n words, as its position from 0 and its words joined by spaces, which no word holds."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.struct((i - 1).alias("p"), F.array_join(F.slice(w, i, n), " ").alias("g")))
    return F.when(F.size(ws) >= n, bound(ws, runs)).otherwise(F.array().cast("array<struct<p:int,g:string>>"))


def digest(col: str) -> Column:
    """An aggregate that names a set by its number of members and 128 bits; ``col`` is distinct within the group."""
    return F.struct(F.count("*").alias("n"), F.bit_xor(F.xxhash64(col)).alias("a"), F.bit_xor(F.xxhash64(F.lit("b"), col)).alias("b"))


def meet(rows: DataFrame, few: DataFrame, key: str, most: int, deal: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``few`` by ``key``: by broadcast up to ``most`` rows, else with each key's rows dealt over ``SALTS`` parts by ``deal``."""
    if few.count() <= most:
        return rows.join(F.broadcast(few), key, how)
    parts = few.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(*deal), F.lit(SALTS))).join(parts, [key, "salt"], how).drop("salt")


def met_items(found: DataFrame, of_item: DataFrame, classes: DataFrame, most: int) -> DataFrame:
    """Of documents whose windows lie in classes (``found``: doc_id, th, c): doc_id, th, n_items, items_sha256."""
    heads = classes.groupBy("c").agg(F.min("g").alias("g"))
    members = stage(meet(of_item, heads, "g", most, ["item"]).select("c", "item"), "class_items")
    held = stage(found.select("doc_id", "th", "c").distinct(), "document_classes")
    sets = stage(held.groupBy("doc_id", "th").agg(digest("c").alias("s")), "document_sets")
    one = sets.groupBy("s").agg(F.min(F.struct("doc_id", "th")).alias("r")).select("s", F.col("r.doc_id").alias("d"), F.col("r.th").alias("t"))
    pairs = held.join(one, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t"))).select("s", "c")
    named = meet(pairs, members, "c", most, ["s"]).select("s", "item").distinct().groupBy("s").agg(F.sort_array(F.collect_list("item")).alias("names"))
    lists = stage(named.select("s", F.size("names").cast("long").alias("n_items"), F.sha2(F.array_join("names", ",").cast("binary"), 256).alias("items_sha256")), "item_lists")
    return meet(sets, lists, "s", most, ["doc_id", "th"]).drop("s")


def hits(docs: DataFrame, items: DataFrame, window: int = WINDOW, k: int = K, prints_most: int = BROADCAST_FINGERPRINTS, most: int = BROADCAST_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Spans of ``docs`` that windows of items cover (doc_id, th, lo, hi; word positions, ends included), and (doc_id, th, n_items, items_sha256)."""
    it = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("iw")).where(F.size("iw") > 0)
    it = stage(it.where("item IS NOT NULL").distinct(), "bench_items")
    d = docs.select("doc_id", "th", "text")
    lengths = sorted(r.n for r in it.where(F.size("iw") < window).select(F.size("iw").alias("n")).distinct().collect())  # window - 1 at most

    # fingerprints: winnowed ones, and whole items of fewer words
    long_prints = it.where(F.size("iw") >= window).select(F.explode(winnowed(F.col("iw"), window, k)).alias("f"))
    own = long_prints.union(it.where(F.size("iw") < window).select(F.xxhash64("iw"))).distinct()
    own = stage(own, "bench_fingerprints")
    prints = lambda w: F.concat(winnowed(w, window, k), *[F.array_distinct(grams(w, m)) for m in lengths])
    kept = d.select("doc_id", "th", F.explode(bound(words(F.col("text")), prints)).alias("f"))
    which = meet(kept, own, "f", prints_most, ["doc_id", "th"], "left_semi").select(F.col("doc_id").alias("d"), F.col("th").alias("t")).distinct()
    which = stage(which, "met_documents")
    same_doc = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t"))
    texts = d.join(which, same_doc, "left_semi").dropDuplicates(["doc_id", "th"])
    texts = stage(texts.select("doc_id", "th", words(F.col("text")).alias("dw")), "met_words")

    # an item's windows are of one length, so a document is cut at each length that occurs
    n = F.least(F.size("iw"), F.lit(window))
    of_item = stage(it.select("item", F.explode(windows(F.col("iw"), n)).alias("x")).select("item", "x.g").distinct(), "bench_windows")
    classes = stage(of_item.groupBy("g").agg(digest("item").alias("c")), "window_classes")
    each = texts.select("doc_id", "th", "dw", F.explode(F.array(*[F.lit(m) for m in [*lengths, window]])).alias("m"))
    seen = each.select("doc_id", "th", "m", F.explode(windows(F.col("dw"), F.col("m"))).alias("x")).select("doc_id", "th", F.col("x.p").alias("lo"), (F.col("x.p") + F.col("m") - 1).alias("hi"), "x.g")
    found = stage(meet(seen, classes, "g", most, ["doc_id", "lo"]).select("doc_id", "th", "lo", "hi", "c"), "hits")
    return found.select("doc_id", "th", "lo", "hi"), met_items(found, of_item, classes, most)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, k: int = K, rate: int = 20) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated.

    A document word is hit if it lies in a span that equals a window of an item of ``benchmark`` (item_id,
    text). Null and word-free texts have no words and no hits; items without words or id are no windows.
    Items with the same id and several texts count once by id. Rows that repeat come back as often, with
    the same values. Extra columns are ignored; empty tables are fine on either side.
    """
    d = keyed(docs)
    spans, met = hits(d, benchmark, window, k)
    order = W.partitionBy("doc_id", "th").orderBy("lo", "hi")
    reach = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    new = spans.select("doc_id", "th", F.greatest(F.col("hi") - F.greatest(F.col("lo") - 1, F.coalesce(reach, F.lit(-1))), F.lit(0)).alias("n"))
    n_hit = new.groupBy("doc_id", "th").agg(F.sum("n").alias("n_hit"))
    by = n_hit.alias("a").join(met.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.th <=> b.th")).select(
        F.col("a.doc_id").alias("d"), F.col("a.th").alias("t"), "n_hit", "n_items", "items_sha256"
    )
    by = stage(by, "contamination")
    n_words = F.size(words(F.col("text"))).cast("long")
    out = d.select("doc_id", "th", n_words.alias("n_words")).join(by, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("th").eqNullSafe(F.col("t")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", F.col("th").alias("text_hash"), "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"), ((n_hit > 0) & (n_hit * rate >= F.col("n_words"))).alias("contaminated"),
    )


def clean_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated.

    Null and word-free texts stay; rows that repeat stay or go together; columns may have any names; an empty
    table stays empty, and without items nothing goes.
    """
    judged = decontaminate(docs.select("doc_id", "text"), benchmark).where("contaminated").select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"))
    bad = stage(judged.distinct(), "contaminated")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed_rows = docs.select(row, F.col("doc_id").cast("long").alias("k"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    return keyed_rows.join(bad, F.col("k").eqNullSafe(F.col("d")) & (F.col("h") == F.col("t")), "left_anti").select("row.*")
