"""File inventories, package manifests, event logs and market records."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, root: str) -> DataFrame:
    """path (relative), bytes of `YYYY…/*.jsonl.gz` files; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl.gz").load(root)
    rel = F.regexp_extract("path", r"(\d{4}[^/]*/[^/]+\.jsonl\.gz)$", 1)
    return files.select(rel.alias("path"), F.col("length").alias("bytes"), "modificationTime").where("path <> ''")


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes from `<bytes> <path>` lines; comments and bad rows are skipped, the last of a path counts."""
    rule = r"^\s*(\d+)\s+(\S.*?)\s*$"
    rows = spark.read.text(path).select(F.monotonically_increasing_id().alias("i"), F.regexp_extract("value", rule, 2).alias("path"), F.regexp_extract("value", rule, 1).alias("n"), "value")
    rows = rows.where(~F.ltrim("value").startswith("#") & (F.col("path") != ""))
    return rows.groupBy("path").agg(F.max_by(F.col("n").try_cast("bigint"), "i").alias("bytes")).where("bytes IS NOT NULL")


def write_inventory(inventory: DataFrame, path: str, header: str = "") -> None:
    """One text file, sorted by path, put in place at once. The listing is bounded by the number of files."""
    lines = [f"{r['bytes']} {r['path']}" for r in inventory.orderBy("path").toLocalIterator()]
    tmp = f"{path}.tmp"
    with open(tmp, "w") as f:
        f.write("\n".join([*([f"# {header}"] if header else []), *lines]) + "\n")
    os.replace(tmp, path)


def read_packages(spark: SparkSession, path: str) -> DataFrame:
    """name, size, mtime, sha256, final of a package manifest."""
    schema = "generated string, files array<struct<name:string,size:long,mtime:double,sha256:string,final:boolean>>"
    return spark.read.schema(schema).option("multiLine", "true").json(path).select(F.explode("files").alias("f")).select("f.*")


def log_events(spark: SparkSession, path: str) -> DataFrame:
    """line, slug, kind (bar, token, sub, first), conn, t (seconds of the day), server_ms, i (order) of a recorder's log."""
    from tapeworks.functions.scalars import clock_seconds

    # The log's phrases.
    rules = {"bar": r"bar→\s*(\S+)", "token": r"新市场\s+(\S+)\s+token", "sub": r"已发订阅\s+(\S+)", "first": r"首帧\s+(\S+)"}
    v = F.col("value")
    hit = lambda rule, n=1: F.nullif(F.regexp_extract(v, rule, n), F.lit(""))
    kind: Column = F.lit(None).cast("string")
    for name, rule in rules.items():
        kind = F.when(hit(rule).isNotNull(), name).otherwise(kind)
    rows = spark.read.text(path).select(
        F.monotonically_increasing_id().alias("i"), hit(r"\[([a-z]+-\d+m)\]").alias("line"), hit(r"\[c(\d)\]").try_cast("int").alias("conn"),
        clock_seconds(hit(r"(\d{2}:\d{2}:\d{2}(?:\.\d+)?)")).alias("t"), F.coalesce(*[hit(r) for r in rules.values()]).alias("slug"), kind.alias("kind"),
        hit(r"(\d+)\s*ms").try_cast("double").alias("server_ms"),
    )
    return rows.where("kind IS NOT NULL")


def list_of(text: Column) -> Column:
    """A list that may come as JSON text."""
    return F.from_json(text, "array<string>")


def bar_tokens(markets: DataFrame) -> DataFrame:
    """The token dimension from market records with JSON-in-text lists: outcomes, clobTokenIds, outcomePrices.

    ``updown`` where the outcomes are up and down in this order, ``updown_rev`` in the other (tokens already
    put right), else ``other:<outcomes>``. winner is UP or DOWN where the prices are exactly one 0 and one 1.
    """
    names = F.transform(list_of(F.col("outcomes")), lambda x: F.lower(F.trim(x)))
    tokens, prices = list_of(F.col("clobTokenIds")), F.transform(list_of(F.col("outcomePrices")), lambda x: x.try_cast("double"))
    up, down = F.array_position(names, "up"), F.array_position(names, "down")
    pair = F.coalesce((F.size(names) == 2) & (up > 0) & (down > 0) & (F.size(tokens) == 2), F.lit(False))
    settled = F.coalesce(F.array_sort(prices) == F.array(F.lit(0.0), F.lit(1.0)), F.lit(False))
    victor = F.upper(F.get(names, (F.array_position(prices, F.lit(1.0)) - 1).cast("int")))
    kind = F.when(pair & (up == 1), "updown").when(pair, "updown_rev").otherwise(F.concat(F.lit("other:"), F.coalesce(F.col("outcomes"), F.lit(""))))
    return markets.select(
        "market", "slug", F.when(pair, F.get(tokens, (up - 1).cast("int"))).alias("up_token"), F.when(pair, F.get(tokens, (down - 1).cast("int"))).alias("down_token"),
        kind.alias("outcome_kind"), F.col("outcomePrices").alias("outcome_prices"), F.when(settled & victor.isin("UP", "DOWN"), victor).alias("winner"),
        "closed", "question", "end_date",
    )


def unresolved(ids: DataFrame, tokens: DataFrame) -> DataFrame:
    """Market ids that the dimension lacks: what a lookup still has to fetch."""
    return ids.select("market").where("market <> ''").distinct().join(tokens, "market", "left_anti")


def look_up(missing: DataFrame, fetch, batch: int = 50, tries: int = 3, wait_s: float = 1.0, sleep=time.sleep) -> list[dict]:
    """Records from ``fetch(ids, closed)`` in batches, closed markets first, then the rest without that filter.

    ``fetch`` is the caller's; network access stays outside of Spark. Ids are markets, not frames. A try that fails with
    OSError is followed by a wait of ``wait_s``, twice that after the second and so on; the last one's error is raised.
    """
    ids, found = sorted(r.market for r in missing.toLocalIterator()), {}
    for closed in (True, False):
        left = [i for i in ids if i not in found]
        for lo in range(0, len(left), batch):
            for attempt in range(tries):
                try:
                    found |= {r["market"]: r for r in fetch(left[lo : lo + batch], closed)}
                    break
                except OSError:
                    if attempt + 1 == tries:
                        raise
                    sleep(wait_s * (attempt + 1))
    return [found[i] for i in ids if i in found]


def write_report(path: str, report: dict) -> None:
    tmp = f"{path}.tmp"
    with open(tmp, "w") as f:
        json.dump(report, f, indent=1, sort_keys=True)
    os.replace(tmp, path)
