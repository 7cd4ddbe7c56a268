"""Mixing sources to target weights by Efraimidis-Spirakis sampling, with DataFrame functions only.

Each source gets a word budget. Whole epochs of it come first; what is left of the budget is filled
with documents in ascending order of exponential keys ``-ln(u) / quality`` until their prefix sum meets
the budget, to the nearest whole document. ``u`` comes from md5 of the document and, where rows repeat, of
the copy's number, so each copy has a key of its own and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import numbered, stage, unit_hash, word_count

WEIGHTS, SHARE, MOST, SEED = (5.0, 2.0, 1.0), 1.5, 2.0, 17
#: Documents that are sorted at once to find where a source's budget ends, and the bits of a key's place, 8 a round.
RANGE_DOCS, KEY_BITS = 1_000, 48
#: Sources whose plan (some 100 bytes each) is broadcast at most.
BROADCAST_SOURCES = 50_000


def default_quality(size: Column) -> Column:
    """A document's weight, from 1 for the shortest to 2 from 1,000 words on: odds of being drawn first."""
    return F.lit(1.0) + F.least(size.cast("double"), F.lit(1000.0)) / 1000.0


def water_fill(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """source, source_size -> target: by weight, at most ``most`` times the size, the excess shared anew.

    In ascending order of ``cap / weight`` the full sources form a prefix: source i is full exactly if its
    cap is at most its weight times what is left for it and all later ones. One prefix sum finds them.
    The table has a row per source, not per document.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")  # Spark compares strings by UTF-8 bytes: code points
    all_rows = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    s = sizes.withColumn("i", F.row_number().over(order) - 1).withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), "i")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum("source_size").over(all_rows) * share)
    s = s.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    s = s.withColumn("w_left", F.sum("w").over(all_rows) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.withColumn("full", F.col("cap") * F.col("w_left") <= F.col("w") * F.col("left"))
    first = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("w")).alias("ratio"), "i", (F.col("left") / F.col("w_left")).alias("level")))).over(all_rows)
    s = s.withColumn("level", first["level"])
    return s.select("source", "source_size", F.when(F.col("full") | F.col("level").isNull(), F.col("cap")).otherwise(F.col("w") * F.col("level")).alias("target"))


def keyed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """row (all columns of ``docs``), doc_id, source, text_hash, size, copy, key; copies of a row number from 1."""
    text = F.col("text").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.xxhash64(text).alias("text_hash"), word_count(text).alias("size"),
    )
    rows = numbered(rows, ["doc_id", "source", "text_hash", "size"])
    return rows.withColumn("key", -F.log(unit_hash(F.col("doc_id"), F.col("source"), F.col("copy"), seed=seed)) / default_quality(F.col("size")))


def plan(rows: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Per source: source_size, target, epochs, budget, and where in its key order the budget ends.

    Keys whose first bits (their place, shifted by ``shift``) are below ``edge_prefix`` lie in the budget as a
    whole; among those with these very bits, ``cut`` is the last document inside. A row per source.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    filled = water_fill(sources, share, most, weights).alias("p").join(sources.alias("s"), F.expr("p.source <=> s.source"))
    epochs = F.when(F.col("p.source_size") > 0, F.floor(F.col("target") / F.col("p.source_size"))).otherwise(0)
    budgets = filled.select(
        F.col("p.source").alias("source"), F.col("p.source_size").alias("source_size"), "target", epochs.cast("long").alias("epochs")
    ).withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    budgets = stage(budgets.coalesce(1), "mix_budgets")

    # the range of keys in which the budget ends, cut into 256 until it holds few documents; the rest is only summed up
    edge = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before"))
    for level in range(1, KEY_BITS // 8 + 1):
        above, own = KEY_BITS - 8 * (level - 1), KEY_BITS - 8 * level
        met = rows.alias("r").join(per_source(edge).alias("e"), F.expr("r.source <=> e.source") & (F.shiftright(key_place(), above) == F.col("e.prefix")))
        sums = met.groupBy("e.source", F.shiftright(key_place(), own).alias("prefix")).agg(
            F.sum("r.size").alias("range_size"), F.count("*").alias("n"), F.first("e.budget").alias("budget"), F.first("e.before").alias("base")
        )
        sums = sums.withColumn("before", F.col("base") + F.sum("range_size").over(Window.partitionBy("source").orderBy("prefix")) - F.col("range_size"))
        edge = stage(sums.where("before < budget AND before + range_size >= budget").select("source", "budget", "prefix", "before", "n").coalesce(1), "mix_edge")
        if (edge.agg(F.max("n")).first()[0] or 0) <= RANGE_DOCS:
            break
    # only that range is sorted document by document
    inside = rows.alias("r").join(per_source(edge).alias("e"), F.expr("r.source <=> e.source") & (F.shiftright(key_place(), own) == F.col("e.prefix")))
    order = Window.partitionBy("r.source").orderBy("key", "doc_id", "text_hash", "copy")
    reach = F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    inside = inside.select(F.col("r.source").alias("source"), "key", "doc_id", "text_hash", "copy", (reach - F.col("size") / 2 <= F.col("budget")).alias("in"))
    # keys ascend, so the last document inside says where the cut lies
    cut = inside.groupBy("source").agg(F.max(F.when(F.col("in"), F.struct("key", "doc_id", "text_hash", "copy"))).alias("cut"))
    out, shift = budgets.alias("b"), F.lit(own).alias("shift")
    for name, part in (("c", cut), ("e", edge.select("source", F.col("prefix").alias("edge_prefix")))):
        out = out.join(part.withColumnRenamed("source", f"{name}_source"), F.col("b.source").eqNullSafe(F.col(f"{name}_source")), "left")
    return stage(out.select("b.*", "cut", "edge_prefix", shift).coalesce(1), "mix_plan")


def per_source(small: DataFrame) -> DataFrame:
    """Broadcast where there are few sources; beyond that the join decides for itself."""
    return F.broadcast(small) if small.count() <= BROADCAST_SOURCES else small


def key_place() -> Column:
    """1 - exp(-key) in ``KEY_BITS`` bits: rises with the key, and no part of it holds over twice its share as qualities lie between 1 and 2."""
    top = 1 << KEY_BITS
    return F.least(F.floor((1 - F.exp(-F.col("r.key"))) * float(top)), F.lit(top - 1)).cast("long")


def decide(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """Adds source_size, target, epochs and copies to ``keyed`` rows; no row moves where the plan is broadcast."""
    out = rows.alias("r").join(per_source(marks).alias("m"), F.expr("r.source <=> m.source")).withColumn("place", key_place())
    place = F.expr("shiftright(place, shift)")
    below = F.struct(F.col("key"), F.col("r.doc_id"), F.col("text_hash"), F.col("copy")) <= F.struct(*[F.col(f"cut.{c}") for c in ("key", "doc_id", "text_hash", "copy")])
    at_edge = (place == F.col("edge_prefix")) & F.col("cut").isNotNull() & below
    drawn = (F.col("budget") > 0) & (F.coalesce(place < F.col("edge_prefix"), F.lit(False)) | F.coalesce(at_edge, F.lit(False)))
    return out.select("r.*", "source_size", "target", "epochs", (F.col("epochs") + drawn.cast("long")).alias("copies"))


def mix(docs: DataFrame, *, share: float = SHARE, most: float = MOST, weights: tuple[float, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): doc_id, source, size, source_size, target, epochs, copies, taken.

    ``copies`` says how often the mix holds the document. Sizes are words; a null or empty text has none,
    takes nothing and has as many copies as its source has whole epochs. A null source is a source of its
    own, last. Rows that repeat in doc_id, source and text are drawn each by itself. Extra columns are
    ignored. An empty table gives an empty result.
    """
    rows = stage(keyed(docs.select("doc_id", "text", "source"), seed).drop("row"), "mix_sizes")
    out = decide(rows, plan(rows, share, most, weights))
    return out.select("doc_id", "source", "size", "source_size", "target", "epochs", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, *, seed: int = SEED) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as ``mix`` has copies of it.

    Rows with a null text or no words come as often as their source has whole epochs; equal rows are drawn each
    by itself; columns may have any names; an empty table stays empty.
    """
    rows = keyed(docs, seed)
    marks = plan(stage(rows.drop("row"), "mix_sizes"))
    return decide(rows, marks).select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).select("row.*")
