"""URL filter over a sorted array of 64-bit xxhash digests.

Rules are ``host/path`` strings with a verdict. Their digests, sorted, and their strings lie in one file
that each Python worker memory-maps; urls probe it with a vectorised binary search and every hit is
confirmed against the stored string. A rule fits its host and all subdomains where the url's path starts
with the rule's; the longest rule wins.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DEFAULT = "allow"
#: An index travels as a broadcast up to this size; larger rule sets are cut into several, which judge one after the other.
INDEX_BYTES = 128 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first `://` up to `/ ? #` or the end, A-Z lower-cased; path up to `? #` or the end; both empty without `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    bare = F.regexp_extract(rest, "^([^?#]*)", 1)
    host = F.regexp_extract(bare, "^([^/]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.substr(bare, F.char_length(host) + 1, F.char_length(bare) + 1)


def build_index(rules: tuple[tuple[str, str], ...]) -> bytes:
    """counts, longest host | digests (sorted) | offsets (one more) | lengths of rule paths | strings; all numbers as little-endian u64."""
    import xxhash

    rows = sorted((xxhash.xxh64_intdigest(r.encode()), r.encode(), v.encode()) for r, v in dict(rules).items())
    lengths = sorted({len(r) - r.index(b"/") for _, r, _ in rows})
    longest = max((r.index(b"/") for _, r, _ in rows), default=0)
    strings = [r + b"\0" + v for _, r, v in rows]
    out = io.BytesIO()
    out.write(np.array([len(rows), len(lengths), longest], "<u8").tobytes())
    out.write(np.array([d for d, _, _ in rows], "<u8").tobytes())
    out.write(np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype("<u8").tobytes())
    out.write(np.array(lengths, "<u8").tobytes())
    out.write(b"".join(strings))
    return out.getvalue()


class Index:
    """The index of ``build_index``, memory-mapped from a file that is unlinked at once."""

    def __init__(self, content: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(content)
            f.flush()
            self.map = np.memmap(f, mode="r") if os.fstat(f.fileno()).st_size else np.zeros(0, np.uint8)
        n, m, self.longest_host = (int(x) for x in self.map[:24].view("<u8"))
        at = 24
        self.digests = self.map[at : at + 8 * n].view("<u8")
        at += 8 * n
        self.offsets = self.map[at : at + 8 * (n + 1)].view("<u8")
        at += 8 * (n + 1)
        self.path_lengths = self.map[at : at + 8 * m].view("<u8").tolist()
        self.strings = self.map[at + 8 * m :]

    def find(self, keys: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """The stored (rule, verdict) of each key, or None."""
        import xxhash

        h = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        at = np.searchsorted(self.digests, h)
        hit = (at < len(self.digests)) & (self.digests[np.minimum(at, max(len(self.digests) - 1, 0))] == h) if len(self.digests) else np.zeros(len(h), bool)
        out: list[tuple[bytes, bytes] | None] = [None] * len(keys)
        for i in np.flatnonzero(hit):
            j = int(at[i])
            while j < len(self.digests) and self.digests[j] == h[i]:  # digests that collide are neighbours
                rule, verdict = bytes(self.strings[int(self.offsets[j]) : int(self.offsets[j + 1])]).split(b"\0")
                if rule == keys[i]:
                    out[i] = rule, verdict
                j += 1
        return out


_indexes: dict[str, Index] = {}


def host_ends(host: bytes, longest: int) -> Iterator[bytes]:
    """The host and what lies behind each of its dots, as far as a rule of at most ``longest`` bytes can equal it."""
    at = 0 if len(host) <= longest else host.find(b".", len(host) - longest - 1) + 1
    if len(host) > longest and at == 0:
        return
    while True:
        yield host[at:]
        at = host.find(b".", at) + 1
        if not at:
            return


def _judge(shared):
    """Fills rule and verdict where a rule of this index is longer than the one found before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.id not in _indexes:
            _indexes.clear()
            _indexes[shared.id] = Index(shared.value)
        index = _indexes[shared.id]
        for b in batches:
            keys, owner = [], []
            for i, (host, path) in enumerate(zip(b.column("host").to_pylist(), b.column("path").to_pylist(), strict=True)):
                p = path.encode()
                heads = [p[:n] for n in index.path_lengths if n <= len(p)]
                for h in host_ends(host.encode(), index.longest_host) if heads else ():
                    keys += [h + x for x in heads]
                    owner += [i] * len(heads)
            before = zip(b.column("rule").to_pylist(), b.column("verdict").to_pylist(), strict=True)
            best: list[tuple[bytes, bytes] | None] = [None if r is None else (r.encode(), v.encode()) for r, v in before]
            for i, got in zip(owner, index.find(keys), strict=True):
                if got and (best[i] is None or len(got[0]) > len(best[i][0])):
                    best[i] = got
            rule = pa.array([x and x[0].decode() for x in best], pa.string())
            verdict = pa.array([x and x[1].decode() for x in best], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], rule, verdict], names=b.schema.names)

    return run


def judge_urls(pages: DataFrame, *, rules: tuple[tuple[str, str], ...] = RULES, default: str = DEFAULT) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule (null: none fits), verdict.

    A null url and one without `://` have an empty host and path, and no rule. Rules without a slash are
    an error. Repeated rows come back as often; extra columns are ignored; an empty table gives no rows.
    """
    if any("/" not in r for r, _ in rules):
        raise ValueError("a rule is a host, a slash and a path")
    indexes, waiting = [], [tuple(dict(rules).items())]
    while waiting:
        some = waiting.pop()
        content = build_index(some)
        if len(content) <= INDEX_BYTES or len(some) == 1:
            indexes.append(content)
        else:
            waiting += [some[: len(some) // 2], some[len(some) // 2 :]]
    host, path = host_and_path(F.col("url").cast("string"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")})
    for content in indexes:
        shared = _Shared(pages.sparkSession.sparkContext.broadcast(content))
        rows = rows.mapInArrow(_judge(shared), "page_id long, host string, path string, rule string, verdict string")
    return rows.withColumn("verdict", F.coalesce("verdict", F.lit(default)))


class _Shared:
    """A broadcast with a name by which workers keep what they made of it."""

    def __init__(self, broadcast):
        self.broadcast, self.id = broadcast, uuid.uuid4().hex

    @property
    def value(self) -> bytes:
        return self.broadcast.value
