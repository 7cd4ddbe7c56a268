"""Sources, per-bar routing and sinks of the live stream."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tapeworks.functions.scalars import bar_of, first_hash, slug_epoch
from tapeworks.sources import files
from tapeworks.sources.captures import BarFiles


def replay(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """Parquet files as a stream, in order of their times; back-pressure instead of a bounded queue that drops."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def routed(frames: DataFrame, cycle_s: int) -> DataFrame:
    """Adds ``late``: bars by which a frame's own bar lies behind the active one at arrival (below 0: it is yet to come); NULL without a slug's bar."""
    return frames.withColumn("late", (bar_of(F.col("arrival_ts"), cycle_s) - slug_epoch(F.col("slug"))) / F.lit(cycle_s))


def on_time(frames: DataFrame, cycle_s: int, watch: str | Observation | None = None) -> DataFrame:
    """Drops frames of a bar that is no longer, or not yet, the active one at arrival.

    ``watch`` names an observation of each batch, taken before the drop: frames, late_1 (of the bar before), late_more, early, unnamed.
    """
    out = routed(frames, cycle_s)
    if watch is not None:
        late = F.col("late")
        out = out.observe(watch, F.count("*").alias("frames"), F.count_if((late > 0) & (late <= 1)).alias("late_1"), F.count_if(late > 1).alias("late_more"), F.count_if(late < 0).alias("early"), F.count_if(late.isNull()).alias("unnamed"))
    return out.where("late = 0").drop("late")


def late_by_slug(frames: DataFrame, cycle_s: int) -> DataFrame:
    """slug, late_1, late_more, early, unnamed: what ``on_time`` drops, for a query of its own beside it."""
    late = F.col("late")
    dropped = routed(frames, cycle_s).where(late.isNull() | (late != 0))
    return dropped.groupBy("slug").agg(F.count_if((late > 0) & (late <= 1)).alias("late_1"), F.count_if(late > 1).alias("late_more"), F.count_if(late < 0).alias("early"), F.count_if(late.isNull()).alias("unnamed"))


def keyed(frames: DataFrame) -> DataFrame:
    """One ``hash`` of the ids that frames of different kinds carry: hash, transaction_hash, txhash; empty without any."""
    ids = [c for c in ("hash", "transaction_hash", "txhash") if c in frames.columns]
    return frames.withColumn("hash", first_hash(*ids)).drop(*ids[1:])


def bar_counts(events: DataFrame, ts: str, cycle: str, keys: list[str], delay: str | None = None) -> DataFrame:
    """Rows per epoch-aligned tumbling bar and key."""
    e = events.withWatermark(ts, delay) if delay else events
    return e.groupBy(F.window(ts, cycle), *keys).agg(F.count("*").alias("n")).select(F.unix_seconds("window.start").alias("bar_ts"), *keys, "n")


def first_frame_latency(frames: DataFrame) -> DataFrame:
    """Per slug: first arrival after its subscription; before any de-duplication."""
    return frames.groupBy("slug", "subscribed_ts").agg((F.min("arrival_ts") - F.col("subscribed_ts")).alias("latency_s"))


def liveness(frames: DataFrame) -> DataFrame:
    return frames.groupBy("conn").agg(F.max("arrival_ts").alias("last_ts"), F.count("*").alias("messages"))


def write_bars(frames: DataFrame, out: str, checkpoint: str, flush: str | None = "2 seconds") -> StreamingQuery:
    """One gzip file a bar below ``out``; a micro-batch, every ``flush``, is a flush; None takes what is there and ends.

    The day is the bar's. A line's rows go to one task, which puts a micro-batch's rows in order of arrival.
    """
    frames.sparkSession.dataSource.register(BarFiles)
    body = F.to_json(F.struct(*[c for c in frames.columns if c != "slug"])).alias("value")
    day = F.date_format(F.timestamp_seconds(slug_epoch(F.col("slug"))), "yyyy-MM-dd")
    rows = frames.where(slug_epoch(F.col("slug")).isNotNull()).withColumns({"day": day, "line": F.regexp_replace("slug", "-[^-]*$", "")})
    each = rows.repartition("line").select("day", "slug", body, F.col("arrival_ts").alias("at"))
    w = each.writeStream.format("bar_files").option("path", out).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if flush is None else w.trigger(processingTime=flush)
    return w.start()


class Heartbeat(StreamingQueryListener):
    """Collects ``observe`` metrics of each batch."""

    def __init__(self, report: Callable[[dict], None]):
        self.report = report

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.report({k: v.asDict() for k, v in event.progress.observedMetrics.items()})

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def observed(frames: DataFrame) -> DataFrame:
    return frames.observe("heartbeat", F.count("*").alias("messages"), F.count_if(F.coalesce("hash", F.lit("")) == "").alias("unkeyed"), F.max("arrival_ts").alias("last_ts"))


def silent(frames: DataFrame, now_s: float, limit: float = 45.0) -> DataFrame:
    """Lines that have written nothing for ``limit`` seconds: an action row each, to force a new subscription."""
    return frames.groupBy("line").agg(F.max("arrival_ts").alias("last_ts")).where(F.lit(now_s) - F.col("last_ts") >= limit).select("line", "last_ts", F.lit("resubscribe").alias("action"))


def heartbeat(frames: DataFrame, kept: DataFrame, marks: DataFrame, breaks: DataFrame, now_s: float, alive_s: float = 60.0) -> DataFrame:
    """Per line of ``frames`` (line, conn, arrival_ts): messages, duplicates, disconnects, connections alive, gaps closed.

    ``kept`` holds the frames that de-duplication let pass, ``marks`` silences, ``breaks`` a row for each lost connection.
    """
    lines = frames.groupBy("line").agg(F.count("*").alias("messages"))
    conns = frames.groupBy("line", "conn").agg(F.max("arrival_ts").alias("last_ts")).groupBy("line").agg(F.count_if(F.lit(now_s) - F.col("last_ts") < alive_s).alias("alive"))
    count = lambda df, name: df.groupBy("line").agg(F.count("*").alias(name))
    out = lines.join(conns, "line").join(count(kept, "kept"), "line", "left").join(count(breaks, "disconnects"), "line", "left")
    out = out.join(count(marks.where(F.col("note") != "open"), "gaps"), "line", "left").na.fill(0)
    return out.select("line", "messages", (F.col("messages") - F.col("kept")).alias("duplicates"), "disconnects", "alive", "gaps")


def obey(orders: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Hands the watchdog's orders to live sources that name ``folder``: the highest generation of a line, in a file of its own."""

    def write(batch: DataFrame, _: int) -> None:
        for r in batch.groupBy("line").agg(F.max("generation").alias("generation")).toLocalIterator():  # a row a line
            files.put_json(folder, f"{r.line}.json", r.generation)

    return orders.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()


class LiveBooks(DataSource):
    """Frames from a feed over several connections, each read in a task of its own.

    Options: ``feed`` ("module:function"), ``conns`` (2), ``log``, ``orders``, ``line``, ``seconds`` that a task reads at most (1), ``rows`` (10,000).

    The feed function takes (conn, generation, cursor) and yields (arrival_ts, event_type, asset_id, hash, slug, body), or None
    while nothing comes, so that a task can end in time. ``cursor`` counts the rows already taken of this generation: a feed
    that can resume goes on from there; one that can't ignores it, and what passes between two reads is left to the
    other connection. The feed says "subscribe" in a row of its own when it has subscribed to a slug. It raises OSError when the
    connection breaks: a row "lost" follows, and the next generation begins after a linear back-off of 3 s an attempt up to 60 s.

    ``log`` is a folder (URI or absolute path) that the driver and all tasks share. A task writes what it has read, and where it
    stopped, there before it gives rows out; a batch that is run again, by the same query or after a restart from its checkpoint,
    reads them there. The driver plans moments only, no row passes through it. Speculative copies of a task would read the
    connection twice, so they have to be off. ``orders`` is the folder that ``obey`` writes: a higher generation of ``line``
    there makes every connection subscribe anew.
    """

    @classmethod
    def name(cls) -> str:
        return "live_books"

    def schema(self) -> str:
        return "arrival_ts double, conn int, event_type string, asset_id string, hash string, slug string, body string"

    def streamReader(self, schema):
        return LiveReader(dict(self.options))


class Connection(InputPartition):
    def __init__(self, conn: int, start: int, end: int):
        super().__init__((conn, start, end))
        self.conn, self.start, self.end = conn, start, end


#: Feeds that this worker has open: (feed, line, conn) -> (generation, cursor, iterator). The worker that read a connection last goes on with it.
_open: dict[tuple, tuple[int, int, Iterator]] = {}


class LiveReader(DataSourceStreamReader):
    FIRST = {"generation": 0, "cursor": 0, "attempt": 0, "retry_at": 0.0, "ordered": 0}
    ROW = pa.schema([("arrival_ts", pa.float64()), ("conn", pa.int32()), *[(c, pa.string()) for c in ("event_type", "asset_id", "hash", "slug", "body")]])

    def __init__(self, options: dict):
        self.feed, self.log, self.conns = options["feed"], options["log"].rstrip("/"), int(options.get("conns", "2"))
        self.orders, self.line = options.get("orders"), options.get("line", "")
        self.seconds, self.rows, self.told = float(options.get("seconds", "1")), int(options.get("rows", "10000")), 0

    def initialOffset(self) -> dict:
        return {"at": 0}

    def latestOffset(self) -> dict:
        """A moment, in milliseconds; later than any before."""
        self.told = max(self.told + 1, int(time.time() * 1000))
        return {"at": self.told}

    def partitions(self, start: dict, end: dict) -> list[Connection]:
        return [Connection(c, start["at"], end["at"]) for c in range(self.conns)] if start["at"] < end["at"] else []

    def logged(self, conn: int, at: int) -> str:
        return f"{self.log}/{conn}/{at:020d}.arrow"

    def read(self, p: Connection) -> Iterator[pa.RecordBatch]:
        table = self.recall(p.conn, p.end)
        if table is None:
            before = self.recall(p.conn, p.start)
            rows, state = self.take(p.conn, json.loads(before.schema.metadata[b"state"]) if before is not None else dict(self.FIRST))
            table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, self.ROW.types, strict=True)], schema=self.ROW.with_metadata({"state": json.dumps(state)}))
            tmp = files.new_name(f"{self.log}/{p.conn}")
            where, at = files.place(tmp)
            with where.open_output_stream(at) as f, pa.ipc.new_file(f, table.schema) as out:
                out.write_table(table)
            files.move(tmp, self.logged(p.conn, p.end))
        yield from table.replace_schema_metadata(None).to_batches()

    def recall(self, conn: int, at: int) -> pa.Table | None:
        where, path = files.place(self.logged(conn, at))
        try:
            with where.open_input_file(path) as f:
                return pa.ipc.open_file(f).read_all()
        except FileNotFoundError:
            return None

    def take(self, conn: int, state: dict) -> tuple[list[tuple], dict]:
        """Rows that come within ``seconds``, and the state after them."""
        rows, now = [], time.time()
        ordered = self.orders and files.get_json(self.orders, f"{self.line}.json") or 0
        if ordered > state["ordered"]:
            state |= {"ordered": ordered, "generation": state["generation"] + 1, "cursor": 0, "retry_at": 0.0}
        if now < state["retry_at"]:
            return rows, state
        key = (self.feed, self.line, conn)
        generation, cursor, source = _open.pop(key, (None, None, None))
        try:
            if (generation, cursor) != (state["generation"], state["cursor"]):
                module, name = self.feed.split(":")
                source = iter(getattr(importlib.import_module(module), name)(conn, state["generation"], state["cursor"]))
            for row in source:
                if row is not None:
                    rows.append((row[0], conn, *row[1:]))
                if len(rows) >= self.rows or time.time() - now >= self.seconds:
                    break
            state |= {"cursor": state["cursor"] + len(rows), "attempt": 0}
            _open[key] = (state["generation"], state["cursor"], source)
        except OSError:
            wait = min(3 * (state["attempt"] + 1), 60)
            rows.append((time.time(), conn, "lost", "", None, None, None))
            state |= {"generation": state["generation"] + 1, "cursor": 0, "attempt": state["attempt"] + 1, "retry_at": time.time() + wait}
        return rows, state

    def commit(self, end: dict) -> None:
        """Logs before the last committed moment go; that one says where to go on."""
        for conn in range(self.conns):
            for name in files.children(f"{self.log}/{conn}"):
                if name.endswith(".arrow") and int(name.removesuffix(".arrow")) < end["at"]:
                    files.remove(f"{self.log}/{conn}/{name}")
