"""Shared helpers: table reading, staged tables in the shared folder, text rules."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space of the word rule `[^\x20\x09-\x0D]+`; ``bytes.split()`` splits at the same six bytes.
ASCII_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Parts over which copies of a row are numbered.
NUMBERING = 256

_roots: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is made, but only for a local master: on a
    cluster a machine-local folder would lose data with its executor, so that is an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        base = spark.conf.get("spark.checkpoint.dir", None)
        if base is None:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            local = tempfile.mkdtemp(prefix="tapeworks-")
            atexit.register(shutil.rmtree, local, ignore_errors=True)
            base = f"file://{local}"
        _roots[app] = f"{base.rstrip('/')}/tapeworks-{app}"
    return _roots[app]


def new_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"


def stage(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Writes ``df`` as Parquet in the shared folder and returns it reread: the lineage ends there."""
    spark = df.sparkSession
    path = path or new_path(spark, tag)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tapeworks_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Deletes staged tables that no later plan reads."""
    for df in frames:
        spark, path = df.sparkSession, df._tapeworks_path
        jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; all other characters as they are."""
    return F.translate(text, UPPER, LOWER)


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in the text, long; null: 0."""
    bare = F.btrim(text, F.lit(ASCII_SPACE))
    return (
        F.when(text.isNull() | (bare == ""), F.lit(0))
        .otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+")))
        .cast("long")
    )


def unit_hash(*cols: Column, seed: int) -> Column:
    """A reproducible uniform number in (0, 1) from 52 bits of md5; DuckDB's md5 gives the same digits."""
    said = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(c.cast("string"), F.lit("~")) for c in cols])
    digits = F.conv(F.substring(F.md5(said.cast("binary")), 1, 13), 16, 10).cast("double")
    return (digits + 0.5) / F.lit(float(1 << 52))


def numbered(rows: DataFrame, alike: list[str]) -> DataFrame:
    """Adds ``copy``: 1, and where rows repeat in the columns ``alike``, numbers without gaps.

    Rows that repeat are found by a count, and only they move: dealt over ``NUMBERING`` parts by the place they
    come from, numbered in each, with the parts before them added up. No task holds all copies of a row.
    """
    repeats = stage(rows.groupBy(*alike).agg(F.count("*").alias("n")).where("n > 1").select(*[F.col(c).alias(f"r_{c}") for c in alike]), "repeats")
    if not repeats.limit(1).count():
        discard(repeats)
        return rows.withColumn("copy", F.lit(1).cast("long"))
    same = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in alike]
    single = rows.join(repeats, same, "left_anti").withColumn("copy", F.lit(1).cast("long"))
    own = rows.join(repeats, same, "left_semi").withColumn("place", F.monotonically_increasing_id())
    own = stage(own.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(NUMBERING))), "copies")
    sums = own.groupBy(*alike, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*alike).orderBy("part")) - F.col("n")
    sums = sums.select(*[F.col(c).alias(f"s_{c}") for c in alike], F.col("part").alias("s_part"), before.alias("before"))
    met = own.withColumn("within", F.row_number().over(Window.partitionBy(*alike, "part").orderBy("place")))
    met = met.join(sums, [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in alike] + [F.col("part") == F.col("s_part")])
    return single.unionByName(met.withColumn("copy", F.col("before") + F.col("within")).select(*rows.columns, "copy"))
