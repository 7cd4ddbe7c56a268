"""Token-ID output as a content-addressed store.

``write_store`` encodes texts, cuts each id stream at content-defined places (a rolling hash over the
last 32 ids), keeps every distinct chunk once and writes, per document, a recipe: the ordered digests of
its chunks. Recipes lie in ascending doc_id order. A Merkle tree of fan-out ``FANOUT`` stands above them:
chunk digests give a document's root; documents (id, length, start, root) give the root of their block,
blocks that of their part file, parts that of the corpus. ``read_store`` and ``reconstruct`` read only the
written files, and first hold recipes against manifest and corpus root: a lost, added, cut or changed
recipe file, manifest or chunk is an error and never a shorter result.

Format, below one folder of the shared file system:

* ``chunks/``   digest (blake2b-128 of the payload), n_ids, payload (ids as little-endian unsigned 16-bit
  integers where the vocabulary fits, else 32-bit)
* ``recipes/``  part, pos, doc_id, n_tokens, start (within the part), root, chunks[digest, n, after]
* ``manifest/`` part, block, n_docs, n_tokens, root
* ``corpus/``   n_parts, n_docs, n_tokens, root: one row

Null texts count as empty, an empty text has the end id alone. A null doc_id sorts first. Repeated
doc_ids are separate documents, ordered by root. Extra columns are ignored. An empty table gives empty
files.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeworks.llm.common import discard, new_path, stage

END_ID = 1
#: Chunk lengths in ids: no cut before MIN_IDS, one at MAX_IDS at the latest, MEAN_IDS apart on average beyond the first.
MIN_IDS, MEAN_IDS, MAX_IDS = 64, 512, 4096
#: Words kept per worker with their ids; a full cache is emptied.
CACHE_WORDS = 1_200_000
#: Children of a node of the Merkle tree at most, and so the documents of a block.
FANOUT = 1024
#: A chunk that more references than this name is joined from several copies of it.
HOT, SALTS = 10_000, 64

CHUNK = "struct<digest:binary,n:int,after:long>"
RECIPE = f"part int, pos long, start long, doc_id long, n_tokens long, root string, chunks array<{CHUNK}>"
BLOCK = "part int, block long, n_docs long, n_tokens long, root string"
STORED = "digest binary, n_ids int, payload binary"
TOP = "n_parts long, n_docs long, n_tokens long, root string"
STAGED = f"kind int, doc_id long, row_key long, n_tokens long, chunks array<{CHUNK}>, digest binary, n_ids int, payload binary"


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class WordEncoder(dict):
    """word bytes -> bytes of its ids.

    The vocabulary's pre-tokenizer never joins text across white space, so a text's ids are those of its
    white-space-separated words in order, and words repeat. It also parts letters from punctuation and
    lowers case, so a word with punctuation behind it shares the entry of its bare form. A word of letters
    only is one piece whose last id alone ends a word, so many such words are encoded in one call and told
    apart by these ids. Apostrophes stay with their word, for contractions; so does all of a word that could
    hold a special token.
    """

    #: ASCII punctuation but the apostrophe.
    BEHIND = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    #: Words in one call.
    TOGETHER = 1_000

    def __init__(self, path: str, width: int):
        from tokenizers import Tokenizer

        self.tokenizer, self.width, self.tails = Tokenizer.from_file(path), width, {b"": b""}
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True

    def single(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, f"<u{self.width}").tobytes()

    def tail(self, marks: bytes) -> bytes:
        if marks not in self.tails:
            if len(self.tails) >= CACHE_WORDS:
                self.tails.clear()
            self.tails[marks] = self.single(marks)
        return self.tails[marks]

    def parts(self, word: bytes) -> tuple[bytes, bytes, bool]:
        """Bare form, punctuation behind it, and whether the bare form is of letters only."""
        core = word.rstrip(self.BEHIND)
        if core.isalpha():
            return core.lower(), word[len(core) :], True
        text = core.decode("utf-8", "replace")
        lower = text.lower()
        # letters whose lower case is one letter too: a mark left over would join the punctuation; a sigma's depends on its place
        if text.isalpha() and len(lower) == len(text) and lower.isalpha() and max(text) < "\u2000" and "\u03a3" not in text:
            return lower.encode(), word[len(core) :], True
        return word, b"", False

    def learn(self, new: set[bytes]) -> None:
        """Adds entries of words that are not in yet."""
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
        made = [(w, *self.parts(w)) for w in new]
        plain = list({core for _, core, _, letters in made if letters and core not in self})
        for lo in range(0, len(plain), self.TOGETHER):
            some = plain[lo : lo + self.TOGETHER]
            text = b" ".join(some).decode("utf-8", "replace")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some) or stops[-1] != len(ids):
                self.update((w, self.single(w)) for w in some)  # a vocabulary without word ends
                continue
            whole, at = ids.astype(f"<u{self.width}").tobytes(), (stops * self.width).tolist()
            self.update(zip(some, (whole[a:b] for a, b in zip([0, *at], at, strict=False)), strict=True))
        for w, core, marks, _ in made:
            if core not in self:
                self[core] = self.single(core)
            if w not in self:
                self[w] = self[core] + self.tail(marks)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Each text's ids; words that no text before had are learned together."""
        out: list = []
        holes: list[tuple[int, list[int], list[bytes]]] = []
        for n, t in enumerate(texts):
            words = t.encode("utf-8", "replace").split() if t else []
            ids = list(map(self.get, words))
            at = list(compress(range(len(words)), map(not_, ids)))
            if at:
                holes.append((n, at, [words[i] for i in at]))
            out.append(ids if at else b"".join(ids))
        self.learn({w for _, _, words in holes for w in words})
        for n, at, words in holes:
            for i, w in zip(at, words, strict=True):
                out[n][i] = self[w]
            out[n] = b"".join(out[n])
        return out


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, width: int) -> WordEncoder:
    if (path, width) not in _encoders:
        _encoders[path, width] = WordEncoder(path, width)
    return _encoders[path, width]


def id_width(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def rolling_cuts(ids: np.ndarray, mean: int = MEAN_IDS) -> np.ndarray:
    """Positions after which the rolling hash over the last 32 ids asks for a cut."""
    h = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    for step in (1, 2, 4, 8, 16):  # doubling: after each step h covers twice as many ids
        h[step:] = h[step:] + (h[:-step] << np.uint64(step))
    return np.flatnonzero((h >> np.uint64(40)) % np.uint64(mean) == 0)


def chunk_ends(cuts: np.ndarray, length: int) -> list[int]:
    """Ends of a document's chunks, given the cut positions within it."""
    ends, at = [], 0
    for c in (*(cuts + 1).tolist(), length):
        while c - at > MAX_IDS:
            ends.append(at := at + MAX_IDS)
        if c - at >= MIN_IDS and c < length:
            ends.append(at := c)
    return [*ends, length]


def _encode(path: str, width: int, end_id: int):
    kind = f"<u{width}"
    schema = pa.schema(
        [("kind", pa.int32()), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("n_tokens", pa.int64())]
        + [("chunks", pa.list_(pa.struct([("digest", pa.binary()), ("n", pa.int32()), ("after", pa.int64())])))]
        + [("digest", pa.binary()), ("n_ids", pa.int32()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(path, width), np.asarray([end_id], kind).tobytes()
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                streams = [x + end for x in words.encode_all(part.column("text").to_pylist())]
                lengths = np.array([len(s) // width for s in streams])
                begins = np.concatenate([[0], np.cumsum(lengths)])
                cuts = rolling_cuts(np.frombuffer(b"".join(streams), kind))
                bounds = np.searchsorted(cuts, begins)
                rows, seen = [], set()
                for i, (doc, s) in enumerate(zip(part.column("doc_id").to_pylist(), streams, strict=True)):
                    n, at, recipe = int(lengths[i]), 0, []
                    for stop in chunk_ends(cuts[bounds[i] : bounds[i + 1]] - begins[i], n):
                        payload = s[at * width : stop * width]
                        digest = hashlib.blake2b(payload, digest_size=16).digest()
                        recipe.append({"digest": digest, "n": stop - at, "after": n - stop})
                        if digest not in seen:
                            seen.add(digest)
                            rows.append((1, None, None, None, None, digest, stop - at, payload))
                        at = stop
                    rows.append((0, doc, key, n, recipe, None, None, None))
                    key += 1
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                    )

    return run


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds part, position in it and the ids before a document in it, to sorted recipes."""
    part, pos, start = TaskContext.get().partitionId(), 0, 0
    for b in batches:
        n = b.column("n_tokens").to_numpy(zero_copy_only=False).astype(np.int64)
        starts = start + np.cumsum(n) - n
        start += int(n.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), part, np.int32)), pa.array(np.arange(pos, pos + len(n), dtype=np.int64)), pa.array(starts), *b.columns],
            names=["part", "pos", "start", *b.schema.names],
        )
        pos += len(n)


def write_store(docs: DataFrame, path: str | None = None, *, vocabulary: str | None = None, end_id: int = END_ID) -> str:
    """Encodes ``docs`` (doc_id, text) and writes the store; returns its folder."""
    spark = docs.sparkSession
    vocabulary = vocabulary or vocabulary_path()
    path = path or new_path(spark, "tokenstore")
    width = id_width(vocabulary)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    staged = stage(rows.mapInArrow(_encode(vocabulary, width, end_id), STAGED), "encoded")

    # hot chunks: first() combines within each map task before anything is shuffled
    chunks = staged.where("kind = 1").groupBy("digest").agg(F.first("n_ids").alias("n_ids"), F.first("payload").alias("payload"))
    chunks.write.option("compression", "zstd").parquet(f"{path}/chunks")

    recipes = staged.where("kind = 0").select("doc_id", "row_key", "n_tokens", document_root(F.col("chunks")).alias("root"), "chunks")
    placed = (
        recipes.repartitionByRange("doc_id", "root", "row_key")
        .sortWithinPartitions("doc_id", "root", "row_key")
        .mapInArrow(_place, f"part int, pos long, start long, doc_id long, row_key long, n_tokens long, root string, chunks array<{CHUNK}>")
    )
    placed.drop("row_key").write.option("compression", "zstd").parquet(f"{path}/recipes")
    discard(staged)

    _blocks(spark.read.schema(RECIPE).parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")
    whole = _corpus(spark.read.schema(BLOCK).parquet(f"{path}/manifest"))
    spark.createDataFrame([whole], TOP).coalesce(1).write.parquet(f"{path}/corpus")
    return path


def _node(children: Column) -> Column:
    return F.sha2(F.array_join(children, ",").cast("binary"), 256)


def document_root(chunks: Column) -> Column:
    """The root over a recipe's digests: nodes of ``FANOUT`` digests each, and one node above them."""
    firsts = F.sequence(F.lit(0), F.ceil(F.size(chunks) / FANOUT).cast("int") - 1)
    digests = lambda i: F.transform(F.slice(chunks, i * FANOUT + 1, FANOUT), lambda c: F.concat_ws(":", F.hex(c["digest"]), c["n"].cast("string")))
    return _node(F.transform(firsts, lambda i: _node(digests(i))))


def _blocks(recipes: DataFrame) -> DataFrame:
    """The manifest that ``recipes`` give: a row for each block of ``FANOUT`` neighbours in a part."""
    said = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.col("n_tokens").cast("string"), F.col("start").cast("string"), "root")
    return (
        recipes.groupBy("part", F.floor(F.col("pos") / FANOUT).alias("block"))
        .agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("pos", said.alias("said")))).alias("r"))
        .select("part", "block", "n_docs", "n_tokens", _node(F.transform("r", lambda x: x["said"])).alias("root"))
    )


def _corpus(blocks: DataFrame) -> tuple[int, int, int, str]:
    """n_parts, n_docs, n_tokens and root of a manifest; the driver sees a row a part file."""
    by_part = blocks.groupBy("part").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t"), _node(F.transform(F.sort_array(F.collect_list(F.struct("block", "root"))), lambda x: x["root"])).alias("root"))
    parts = sorted(by_part.collect(), key=lambda r: r.part)
    said = ",".join(f"{r.part}:{r.d}:{r.t}:{r.root}" for r in parts)
    return len(parts), sum(r.d for r in parts), sum(r.t for r in parts), hashlib.sha256(said.encode()).hexdigest()


def verified(spark: SparkSession, path: str) -> DataFrame:
    """The recipes of a store, after its manifest, corpus root and recipes were held against each other; ValueError where they differ."""
    read = lambda name, schema: spark.read.schema(schema).parquet(f"{path}/{name}")
    recipes, manifest, top = read("recipes", RECIPE), read("manifest", BLOCK), read("corpus", TOP).collect()
    if len(top) != 1 or tuple(top[0]) != _corpus(manifest):
        raise ValueError("the manifest does not give the corpus root")
    keys = ["part", "block"]
    written, found = manifest.select(*keys, F.struct("n_docs", "n_tokens", "root").alias("a")), _blocks(recipes).select(*keys, F.struct("n_docs", "n_tokens", "root").alias("b"))
    bad = written.join(found, keys, "full").where("NOT a <=> b").limit(1).collect()
    if bad:
        raise ValueError(f"block {bad[0].block} of part {bad[0].part} does not give its root")
    return recipes


def _crc_tables() -> np.ndarray:
    """tables[j][b]: what bit b of a CRC-32 becomes when 2**j zero bytes follow."""
    poly, col = 0xEDB88320, []
    for bit in range(32):
        x = 1 << bit
        for _ in range(8):
            x = (x >> 1) ^ (poly if x & 1 else 0)
        col.append(x)
    tables = [np.array(col, np.uint32)]
    for _ in range(47):
        tables.append(crc_apply(tables[-1], tables[-1]))
    return np.stack(tables)


def crc_apply(matrix: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros_like(crc)
    for bit in range(32):
        out ^= np.where((crc >> np.uint32(bit)) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


def crc_shift(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """CRC-32 of parts, each moved in front of ``zeros`` more bytes: the xor over a text's parts is the text's CRC-32."""
    crc, tables = crc.astype(np.uint32), _crc_tables()
    for j in range(int(zeros.max(initial=0)).bit_length()):
        at = np.flatnonzero((zeros >> j) & 1)
        crc[at] = crc_apply(tables[j], crc[at])
    return crc


def _check_chunks(width: int):
    import zlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests, payloads = b.column("digest").to_pylist(), b.column("payload").to_pylist()
            crcs = []
            for d, p in zip(digests, payloads, strict=True):
                if hashlib.blake2b(p, digest_size=16).digest() != d:
                    raise ValueError(f"chunk {d.hex()} does not hold what its digest says")
                crcs.append(zlib.crc32(np.frombuffer(p, f"<u{width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(crcs, pa.int64())], names=["digest", "crc"])

    return run


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        crc = b.column("crc").to_numpy(zero_copy_only=False)
        after = b.column("after").to_numpy(zero_copy_only=False) * 4
        b = b.drop_columns(["crc", "after"])
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(crc_shift(crc, after).astype(np.int64))], names=[*b.schema.names, "crc"])


def _offsets(recipes: DataFrame) -> DataFrame:
    """part -> ids in the parts before it; one row per written part."""
    sums = recipes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    return sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))


def _met(refs: DataFrame, chunks: DataFrame) -> DataFrame:
    """``refs`` (digest, ...) with their chunks' columns; a chunk that very many name is joined from ``SALTS`` copies."""
    hot = refs.groupBy("digest").agg(F.count("*").alias("refs")).where(F.col("refs") > HOT).select("digest", F.lit(True).alias("hot"))
    hot = stage(hot, "hot_chunks")
    n = hot.count()  # at most one for each HOT references
    hot = F.broadcast(hot) if n <= 100_000 else hot
    salted = refs.join(hot, "digest", "left").withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("part", "pos"), F.lit(SALTS))).otherwise(0)).drop("hot")
    copies = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))).alias("salt")
    spread = chunks.join(hot, "digest", "left").select(*chunks.columns, copies)
    return salted.join(spread, ["digest", "salt"], "left").drop("salt")


def _sound(root: Column) -> Column:
    return F.when(root == document_root(F.col("chunks")), root).otherwise(F.raise_error(F.lit("a recipe does not give its root")))


def read_store(spark: SparkSession, path: str, *, vocabulary: str | None = None) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, root.

    Recipes are held against the Merkle manifest first. Then every stored chunk is read, held against its
    digest and summed up once; a document's CRC-32 is put together from those of its chunks, so no payload
    travels. A recipe that names a missing chunk, or a root that its digests don't give, fails.
    """
    width = id_width(vocabulary or vocabulary_path())
    recipes = verified(spark, path)
    crcs = spark.read.schema(STORED).parquet(f"{path}/chunks").select("digest", "payload").mapInArrow(_check_chunks(width), "digest binary, crc long")
    refs = recipes.select("part", "pos", "doc_id", "start", "n_tokens", _sound(F.col("root")).alias("root"), F.explode("chunks").alias("c"))
    refs = refs.select("part", "pos", "doc_id", "start", "n_tokens", "root", F.col("c.digest").alias("digest"), F.col("c.after").alias("after"))
    met = _met(refs, crcs).select(
        "part", "pos", "doc_id", "start", "n_tokens", "root", "after", F.coalesce("crc", F.raise_error(F.lit("a chunk is missing")).cast("long")).alias("crc")
    )
    shifted = met.mapInArrow(_shift, "part int, pos long, doc_id long, start long, n_tokens long, root string, crc long")
    whole = shifted.groupBy("part", "pos", "doc_id", "start", "n_tokens", "root").agg(F.bit_xor("crc").alias("ids_crc32"))
    return whole.join(F.broadcast(_offsets(recipes)), "part").select(
        "doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "root"
    )


def _check_payloads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for d, p in zip(b.column("digest").to_pylist(), b.column("payload").to_pylist(), strict=True):
            if hashlib.blake2b(p, digest_size=16).digest() != d:
                raise ValueError(f"chunk {d.hex()} does not hold what its digest says")
        yield b


def reconstruct(spark: SparkSession, path: str, *, vocabulary: str | None = None) -> DataFrame:
    """Per document, from the files: doc_id, start, ids (array<int>), put together from its recipe; verified as in ``read_store``."""
    width = id_width(vocabulary or vocabulary_path())
    recipes = verified(spark, path)
    chunks = spark.read.schema(STORED).parquet(f"{path}/chunks").select("digest", "payload").mapInArrow(_check_payloads, "digest binary, payload binary")
    refs = recipes.select("part", "pos", "doc_id", "start", _sound(F.col("root")).alias("root"), F.posexplode("chunks").alias("seq", "c")).withColumn("digest", F.col("c.digest"))

    @F.pandas_udf("array<int>")
    def joined(parts):
        return parts.map(lambda p: np.frombuffer(b"".join(x["payload"] for x in p), f"<u{width}").astype(np.int32))

    return (
        _met(refs.drop("c"), chunks)
        .withColumn("payload", F.coalesce("payload", F.raise_error(F.lit("a chunk is missing")).cast("binary")))
        .groupBy("part", "pos", "doc_id", "start", "root")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "payload"))).alias("parts"))
        .join(F.broadcast(_offsets(recipes)), "part")
        .select("doc_id", (F.col("start") + F.col("before")).alias("start"), joined("parts").alias("ids"))
    )
