"""Which gzip and Parquet files are cut or damaged, and what gzip members hold."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from tapeworks.sources import files
from tapeworks.sources.captures import CHUNK, gzip_lines, inflate  # noqa: F401

HEADER = b"\x1f\x8b\x08"
MEMBER = "member int, offset long, length long, ok boolean, lines long, error string"


def probe(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, status, inflated bytes; files pass by in pieces and their lines stay in the task."""
    return gzip_lines(spark, paths).where("status IS NOT NULL").select("file", "status", "bytes")


def inflated(content: bytes, start: int, stop: int) -> tuple[int, int, str | None]:
    """Lines of the member at ``start``, the place behind it, and an error where it does not end before ``stop``; a piece at a time."""
    d, view, lines, at = zlib.decompressobj(31), memoryview(content), 0, start
    try:
        while at < stop and not d.eof:
            data = view[at : min(at + CHUNK, stop)]
            at += len(data)
            out = d.decompress(data, CHUNK)
            lines += out.count(b"\n")
            while not d.eof and (d.unconsumed_tail or len(out) == CHUNK):
                out = d.decompress(d.unconsumed_tail, CHUNK)
                lines += out.count(b"\n")
    except zlib.error as x:
        return 0, stop, str(x)
    return lines, at - len(d.unused_data), None if d.eof else "truncated"


def found_members(content: bytes) -> list[tuple]:
    """member, offset, length, ok, lines, error of each member, and of each other place with a gzip header.

    A header's three bytes also turn up by chance inside a member, about once in 16 MB; a member that inflates to its
    end is whole, whatever lies in it. Only where one does not, it is cut at the next header.
    """
    at, rows = content.find(HEADER), []
    while at >= 0:
        lines, end, error = inflated(content, at, len(content))
        if error is not None:
            cut = content.find(HEADER, at + 1)
            end = cut if cut >= 0 else len(content)
            if cut >= 0:
                lines, _, error = inflated(content, at, end)
        rows.append((len(rows), at, end - at, error is None, lines, error))
        at = content.find(HEADER, end)
    return rows


class GzMembers:
    """Table function ``gz_members(content)`` for LATERAL joins over a table of files."""

    def eval(self, content: bytes):
        yield from found_members(content or b"")


def register(spark: SparkSession) -> None:
    """Makes ``gz_members`` known to SQL: SELECT path, m.* FROM files, LATERAL gz_members(content) m."""
    spark.udtf.register("gz_members", udtf(GzMembers, returnType=MEMBER))


def members(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, member, offset, length, ok, lines, error: each member, and each other place with a gzip header, inflated by itself."""
    register(spark)
    found = spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), "content")
    return found.lateralJoin(udtf(GzMembers, returnType=MEMBER)(F.col("content").outer())).drop("content")


def parquet_files(spark: SparkSession, root: str, *, deep: bool = False) -> DataFrame:
    """file, partition (the folders below ``root``), rows, error of each Parquet file there; ``deep`` decodes the rows too, a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for b in batches:
            out = []
            for path in b.column("file").to_pylist():
                where, at = files.place(path)
                try:
                    with where.open_input_file(at) as f:
                        table = pq.ParquetFile(f, page_checksum_verification=deep)
                        n = table.metadata.num_rows
                        if deep and sum(len(x) for x in table.iter_batches(8_192)) != n:
                            raise OSError("rows are missing")
                    out.append((n, None))
                except (OSError, pa.ArrowException) as e:
                    out.append((None, f"{type(e).__name__}: {e}"[:300]))
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("partition"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], names=["file", "partition", "rows", "error"])

    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    tail = F.regexp_extract("path", r"((?:/[^/=]+=[^/]*)*)/[^/]*$", 1)
    rows = found.select(F.col("path").alias("file"), F.ltrim(tail, F.lit("/")).alias("partition"))
    return rows.repartition(spark.sparkContext.defaultParallelism, "file").mapInArrow(run, "file string, partition string, rows long, error string")


def readable_partitions(spark: SparkSession, root: str, *, deep: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of the partitions whose files can all be read, and beside them partition, file, error of the files that can't.

    A partition with a damaged file is left out as a whole. What reaches the driver are the names of damaged partitions.
    """
    found = parquet_files(spark, root, deep=deep)
    errors = found.where("error IS NOT NULL").select("partition", "file", "error")
    bad = sorted({r.partition for r in errors.select("partition").distinct().toLocalIterator()})
    read = spark.read.option("basePath", root).option("recursiveFileLookup", "false")
    if not bad:
        return read.parquet(root), errors
    if "" in bad:
        raise OSError(f"{root} has damaged files outside any partition")
    good = [r.partition for r in found.select("partition").distinct().where(~F.col("partition").isin(bad)).toLocalIterator()]
    if not good:
        raise OSError(f"no partition of {root} can be read")
    return read.parquet(*[f"{root.rstrip('/')}/{p}" for p in sorted(good)]), errors
