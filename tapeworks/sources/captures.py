"""Capture files as data sources: gzip JSON lines read a megabyte at a time, and written one file a bar."""

from __future__ import annotations

import gzip
import io
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, InputPartition, WriterCommitMessage

from tapeworks.sources import files

CHUNK = 1 << 20


class Inflater:
    """Inflates the members of a gzip stream piece by piece; then ``status`` is ok, truncated or corrupt, and ``bytes`` what came out."""

    def __init__(self) -> None:
        self.status, self.bytes, self.error = "truncated", 0, "no member"

    def pieces(self, stream) -> Iterator[bytes]:
        """Each piece of input and of output is ``CHUNK`` bytes at most."""
        d, begun = None, False
        while data := stream.read(CHUNK):
            while data:
                if d is None:
                    data = data.lstrip(b"\0") if begun else data  # padding between members
                    if not data:
                        break
                    d, begun = zlib.decompressobj(31), True
                before, error = d.copy(), None
                try:
                    out = d.decompress(data, CHUNK)
                except zlib.error as e:
                    out, error = _up_to_error(before, data), str(e)
                self.bytes += len(out)
                if out:
                    yield out
                if error is not None:
                    self.status, self.error = "corrupt", error
                    return
                if d.eof:
                    data, d = d.unused_data, None
                else:
                    data = d.unconsumed_tail
                    while not data and len(out) == CHUNK:  # output that is still inside
                        out = d.decompress(b"", CHUNK)
                        self.bytes += len(out)
                        if out:
                            yield out
        if begun:
            self.status, self.error = ("truncated", "a member has no end") if d is not None else ("ok", "")

    def lines(self, stream) -> Iterator[list[str]]:
        """Whole lines, as many as a piece ends; a line that breaks off is not given."""
        rest: list[bytes] = []
        for piece in self.pieces(stream):
            head, end, tail = piece.rpartition(b"\n")
            if end:
                yield _texts(b"".join([*rest, head]))
                rest = []
            rest.append(tail)
        last = b"".join(rest)
        if self.status == "ok" and last:
            yield _texts(last)


def _up_to_error(d, data: bytes, step: int = 64) -> bytes:
    """What comes out before damaged input fails, of at most ``CHUNK`` bytes."""
    out = b""
    try:
        for lo in range(0, len(data), step):
            out += d.decompress(data[lo : lo + step], max(1, CHUNK - len(out)))
            if len(out) >= CHUNK:
                break
    except zlib.error:
        pass
    return out


def _texts(data: bytes) -> list[str]:
    return data.decode("utf-8", "replace").replace("\r\n", "\n").removesuffix("\r").split("\n")


def inflate(content: bytes) -> tuple[str, int]:
    """ok, truncated or corrupt, and how many bytes came out; all members count."""
    it = Inflater()
    for _ in it.pieces(io.BytesIO(content)):
        pass
    return it.status, it.bytes


class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class GzipLines(DataSource):
    """Lines of gzip files, and after a file's lines one closing row that says what became of it.

    Options: ``paths``, a JSON list of files, folders or patterns; ``keep``: "all" gives the lines before a break
    too, "whole" only those of files without one, which are inflated twice for that; ``partition_bytes``: small files
    share a task up to this size. A file is never held as one value.
    """

    SCHEMA = "file string, seq long, value string, status string, bytes long, error string"

    @classmethod
    def name(cls) -> str:
        return "gzip_lines"

    def schema(self) -> str:
        return self.SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return GzipReader(dict(self.options))


class GzipReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"]) if "paths" in options else [options["path"]]
        self.whole = options.get("keep", "all") == "whole"
        self.most = int(options.get("partition_bytes", str(32 << 20)))

    def partitions(self) -> list[Files]:
        found = dict(x for p in self.paths for x in files.listed(p))
        out: list[Files] = []
        room = 0
        for path, size in sorted(found.items()):
            if size > room or not out:
                out.append(Files([]))
                room = self.most
            out[-1].paths.append(path)
            room -= size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path in partition.paths:
            yield from self.file(path)

    def file(self, path: str) -> Iterator[pa.RecordBatch]:
        n, it = 0, Inflater()
        try:
            if self.whole:
                with self.opened(path) as f:
                    for _ in it.pieces(f):
                        pass
            if not self.whole or it.status == "ok":
                it = Inflater()
                with self.opened(path) as f:
                    for lines in it.lines(f):
                        yield self.batch(path, n, lines)
                        n += len(lines)
        except OSError as e:
            it.status, it.error = "unreadable", f"{type(e).__name__}: {e}"[:300]
        yield self.batch(path, n, [None], it.status, it.bytes, it.error)

    def opened(self, path: str):
        where, at = files.place(path)
        return where.open_input_stream(at, compression=None)

    def batch(self, path: str, at: int, values: list, status: str | None = None, size: int | None = None, error: str | None = None) -> pa.RecordBatch:
        n = len(values)
        text = lambda x: pa.array([x] * n, pa.string())
        return pa.RecordBatch.from_arrays(
            [text(path), pa.array(range(at, at + n), pa.int64()), pa.array(values, pa.string()), text(status), pa.array([size] * n, pa.int64()), text(error)],
            names=["file", "seq", "value", "status", "bytes", "error"],
        )


def gzip_lines(spark: SparkSession, paths: str | list[str], *, whole: bool = False) -> DataFrame:
    """file, seq (line number), value, and in a file's closing row (value NULL): status, bytes, error."""
    spark.dataSource.register(GzipLines)
    read = spark.read.format("gzip_lines").option("paths", json.dumps([paths] if isinstance(paths, str) else list(paths)))
    return read.option("keep", "whole" if whole else "all").load()


# ---- one file a bar


@dataclass
class Written(WriterCommitMessage):
    #: (day, slug, staged file) of rows; (day, slug, staged file or None) of bars that are over.
    parts: list[tuple[str, str, str]]
    closed: list[tuple[str, str, str | None]]


def line_of(slug: str) -> tuple[str, int]:
    """A slug's line (all before the last dash) and its bar; 0 where that is no number."""
    line, _, bar = slug.rpartition("-")
    return line, int(bar) if bar.isdigit() else 0


class BarFiles(DataSource):
    """Sink of rows (day, slug, value): gzip lines, one file a bar, ``<path>/<day>/<slug>.jsonl.gz``.

    As a table's sink, a bar's rows have to lie in one task, one after another (``write_captures`` sees to it). As a
    stream's, a line's rows have to (``write_bars`` of ``tapeworks.streaming.flow`` does), and a column ``at`` puts the rows of
    a micro-batch in order; each micro-batch adds a gzip member to
    ``.parts``, and the task that meets a later bar of the line joins the members of the bars before it. The driver
    only moves files. A batch that is run again replaces what it wrote; rows of a bar that was closed by an
    earlier batch are kept below ``.late``.
    """

    @classmethod
    def name(cls) -> str:
        return "bar_files"

    def schema(self) -> str:
        return "day string, slug string, value string"

    def writer(self, schema, overwrite: bool):
        return BarWriter(self.options["path"])

    def streamWriter(self, schema, overwrite: bool):
        return BarStreamWriter(self.options["path"])


class Members:
    """Open gzip files of a task, one for each (day, slug)."""

    def __init__(self, out: str):
        self.staging, self.open, self.names = f"{out.rstrip('/')}/.staging", {}, {}

    def add(self, key: tuple[str, str], values: list[str]) -> None:
        if key not in self.open:
            name = files.new_name(self.staging)
            where, at = files.place(name)
            raw = where.open_output_stream(at, compression=None)
            self.open[key], self.names[key] = (raw, gzip.GzipFile(fileobj=raw, mode="wb", mtime=0)), name
        self.open[key][1].write("".join(f"{v}\n" for v in values).encode())

    def close(self, key: tuple[str, str]) -> str:
        raw, packed = self.open.pop(key)
        packed.close()
        raw.close()
        return self.names[key]


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, str], list[str]]]:
    """Neighbouring rows of one (day, slug)."""
    keys = list(zip(batch.column("day").to_pylist(), batch.column("slug").to_pylist(), strict=True))
    values, lo = batch.column("value").to_pylist(), 0
    for hi in range(1, len(keys) + 1):
        if hi == len(keys) or keys[hi] != keys[lo]:
            yield keys[lo], [v for v in values[lo:hi] if v is not None]
            lo = hi


class BarWriter(DataSourceArrowWriter):
    def __init__(self, out: str):
        self.out = out.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        members, last, parts = Members(self.out), None, []
        for batch in iterator:
            for key, values in runs(batch):
                if last not in (None, key):
                    parts.append((*last, members.close(last)))
                members.add(key, values)
                last = key
        if last is not None:
            parts.append((*last, members.close(last)))
        return Written(parts, [])

    def commit(self, messages: list[Written | None]) -> None:
        for day, slug, name in (p for m in messages if m for p in m.parts):
            files.move(name, f"{self.out}/{day}/{slug}.jsonl.gz")
        files.remove(f"{self.out}/.staging")

    def abort(self, messages: list[Written | None]) -> None:
        for _, _, name in (p for m in messages if m for p in m.parts):
            files.remove(name)


def write_captures(rows: DataFrame, out: str) -> None:
    """``rows``: day, slug, seq, value -> one file a bar, lines by seq."""
    rows.sparkSession.dataSource.register(BarFiles)
    each = rows.repartition("day", "slug").sortWithinPartitions("day", "slug", "seq").select("day", "slug", "value")
    each.write.format("bar_files").mode("append").save(out)


def join_members(sources: list[str], target: str) -> None:
    """Gzip members one after another are a gzip file."""
    where, at = files.place(target)
    with where.open_output_stream(at, compression=None) as out:
        for source in sources:
            with where.open_input_stream(files.place(source)[1], compression=None) as f:
                while data := f.read(CHUNK):
                    out.write(data)


class BarStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, out: str):
        self.out = out.rstrip("/")

    def final(self, day: str, slug: str) -> str:
        return f"{self.out}/{day}/{slug}.jsonl.gz"

    def held(self, line: str) -> list[tuple[str, str, str]]:
        """(day, slug, folder) of the bars of a line that are not joined yet."""
        top = f"{self.out}/.parts/{line}"
        return [(*name.split("~", 1), f"{top}/{name}") for name in files.children(top)]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        members, batches = Members(self.out), list(iterator)
        if batches and "at" in batches[0].schema.names:  # shuffled blocks come in any order
            batches = pa.Table.from_batches(batches).sort_by([("at", "ascending"), ("value", "ascending")]).to_batches()
        for batch in batches:
            for key, values in runs(batch):
                members.add(key, values)
        own = {key: members.close(key) for key in list(members.open)}
        newest: dict[str, int] = {}
        for _, slug in own:
            line, bar = line_of(slug)
            newest[line] = max(newest.get(line, bar), bar)
        closed = []
        for line, now in newest.items():
            over = {(day, slug): folder for day, slug, folder in self.held(line) if line_of(slug)[1] < now}
            over |= {key: over.get(key) for key in own if line_of(key[1])[0] == line and line_of(key[1])[1] < now}
            for key, folder in over.items():
                if files.exists(self.final(*key)):
                    closed.append((*key, None))  # the commit tells a batch run again from late rows
                    continue
                parts = [f"{folder}/{name}" for name in files.children(folder)] if folder else []
                joined = files.new_name(f"{self.out}/.staging")
                join_members([*parts, *([own[key]] if key in own else [])], joined)
                if key in own:
                    files.remove(own.pop(key))
                closed.append((*key, joined))
        return Written([(*key, name) for key, name in own.items()], closed)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        for m in (m for m in messages if m):
            for day, slug, joined in m.closed:
                if joined is not None:
                    files.put_json(f"{self.out}/.closed", f"{day}~{slug}.json", batchId)
                    files.move(joined, self.final(day, slug))
                files.remove(f"{self.out}/.parts/{line_of(slug)[0]}/{day}~{slug}")
            for day, slug, name in m.parts:
                if files.exists(self.final(day, slug)):
                    if files.get_json(f"{self.out}/.closed", f"{day}~{slug}.json") == batchId:
                        files.remove(name)  # already in the file
                    else:
                        files.move(name, f"{self.out}/.late/{day}~{slug}/{batchId:012d}.gz")
                else:
                    files.move(name, f"{self.out}/.parts/{line_of(slug)[0]}/{day}~{slug}/{batchId:012d}.gz")

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        for m in (m for m in messages if m):
            for _, _, name in [*m.parts, *m.closed]:
                if name is not None:
                    files.remove(name)


def close_bars(out: str) -> list[str]:
    """Joins the bars that are still open, after the stream has ended; their slugs."""
    w, done = BarStreamWriter(out), []
    for line in files.children(f"{w.out}/.parts"):
        for day, slug, folder in w.held(line):
            joined = files.new_name(f"{w.out}/.staging")
            join_members([f"{folder}/{name}" for name in files.children(folder)], joined)
            files.move(joined, w.final(day, slug))
            files.remove(folder)
            done.append(slug)
    return done
