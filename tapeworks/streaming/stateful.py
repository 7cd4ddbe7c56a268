"""Streaming operators with state: exact de-duplication over a time span, and silence marks."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE, WITHOUT_VARIABLES = "spark.sql.streaming.stateStore.providerClass", "HDFSBackedStateStoreProvider"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def with_store(rows: DataFrame) -> DataFrame:
    """``rows``, in a session whose state store can keep the variables of these operators. Spark's default one cannot, and is changed for RocksDB; any other stays."""
    conf = rows.sparkSession.conf
    if conf.get(STORE).endswith(WITHOUT_VARIABLES):
        conf.set(STORE, ROCKSDB)
    return rows


class Dedup(StatefulProcessor):
    """Emits a key's row unless the key was emitted less than ``gap`` seconds before; drops do not renew that. With ``tag`` all rows pass, marked."""

    def __init__(self, gap: float, ttl: bool = True, tag: bool = False):
        self.gap, self.ttl, self.tag = gap, ttl, tag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at double", ttlDurationMs=int(self.gap * 4000)) if self.ttl else handle.getValueState("last", "at double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last = self.last.get()[0] if self.last.exists() else None
        for f in (pd.concat(list(rows)).sort_values("arrival_ts", kind="stable"),):
            keep = []
            for at in f["arrival_ts"]:
                keep.append(last is None or at - last >= self.gap)
                if keep[-1]:
                    last = at
            self.last.update((float(last),))
            yield f.assign(duplicate=[not k for k in keep]) if self.tag else f[keep]

    def close(self) -> None:
        pass


def dedup(frames: DataFrame, gap: float = 60.0, *, live: bool = True, tag: bool = False) -> DataFrame:
    """``frames``: arrival_ts double, conn, event_type, asset_id, hash, slug. Rows without a hash all pass, beside the state.

    With ``tag`` no row is dropped; ``duplicate`` says which ones would be. A live stream drops a key's state after
    four gaps of wall-clock time. A replay has no use for wall-clock time, and with it would never come to an end: ``live=False``.
    """
    mode, hashed = ("ProcessingTime" if live else "None"), F.coalesce("hash", F.lit("")) != ""
    schema = T.StructType([*frames.schema.fields, T.StructField("duplicate", T.BooleanType())]) if tag else frames.schema
    kept = with_store(frames).where(hashed).groupBy("event_type", "asset_id", "hash").transformWithStateInPandas(Dedup(gap, live, tag), schema, "Append", mode)
    rest = frames.where(~hashed)
    return kept.union(rest.withColumn("duplicate", F.lit(False)) if tag else rest)


class Silence(StatefulProcessor):
    """Marks of silences: told ``gap`` after the last row, closed by the next row, or by a timer where the bar ends."""

    COLUMNS = ["line", "bar_ts", "from_ts", "to_ts", "lost_s", "note"]

    def __init__(self, gap: float, cycle_s: int | None = None):
        self.gap, self.cycle_s = gap, cycle_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # since: where the piece of the silence begins that no mark has closed; NULL while the line speaks
        self.state = handle.getValueState("silence", "last double, since double")

    def bar(self, at: float) -> int | None:
        return int(at // self.cycle_s) * self.cycle_s if self.cycle_s else None

    def switch(self, at: float) -> float:
        """End of the bar that ``at`` lies in."""
        return float(self.bar(at) + self.cycle_s) if self.cycle_s else float("inf")

    def pieces(self, line: str, since: float, until: float) -> tuple[list[tuple], float]:
        """The bars that end by ``until`` close their pieces as unresolved; where the rest begins."""
        out = []
        while self.switch(since) <= until:
            end = self.switch(since)
            out.append((line, self.bar(since), since, end, end - since, "unresolved"))
            since = end
        return out, since

    def save(self, last: float, since: float | None) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.state.update((last, since))
        due = last + self.gap if since is None else self.switch(since)
        if due != float("inf"):
            self.handle.registerTimer(int(due * 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last, since = self.state.get() if self.state.exists() else (None, None)
        out = []
        for at in sorted(x for f in rows for x in f["at"].tolist()):
            if last is not None and at <= last:
                continue
            if last is not None and since is None and at - last >= self.gap:
                since = last + self.gap
            if since is not None and at >= since:
                more, since = self.pieces(key[0], since, at)
                out += more if since == at else [*more, (key[0], self.bar(since), since, at, at - since, "reconnected")]
            last, since = at, None
        if last is not None:
            self.save(last, since)
        yield self.frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, since = self.state.get()
        if since is None:
            since = last + self.gap
            out = [(key[0], self.bar(since), since, None, None, "open")]
        else:
            out, since = self.pieces(key[0], since, self.switch(since))
        self.save(last, since)
        yield self.frame(out)

    def frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=self.COLUMNS).astype({"bar_ts": "Int64"})

    def close(self) -> None:
        pass


def silences(rows: DataFrame, gap: float = 60.0, cycle_s: int | None = None) -> DataFrame:
    """``rows``: line, at (seconds), ts (timestamp with a watermark) -> line, bar_ts, from_ts, to_ts, lost_s, note.

    Marks begin when the silence is found out, ``gap`` after the last row. Open ones come first and have no end.
    With ``cycle_s``, a silence is closed as ``unresolved`` where its bar ends, at that time and while the line is still silent, and goes on in the next bar.
    """
    schema = "line string, bar_ts long, from_ts double, to_ts double, lost_s double, note string"
    return with_store(rows).groupBy("line").transformWithStateInPandas(Silence(gap, cycle_s), schema, "Append", "EventTime")


class Watchdog(StatefulProcessor):
    """Orders a new subscription each time a line has written nothing for ``limit`` seconds."""

    def __init__(self, limit: float):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", "due double, generation int")

    def orders(self, line: str, due: float, generation: int, until: float) -> tuple[list[tuple], float, int]:
        out = []
        while due < until:
            generation += 1
            out.append((line, due, generation, "resubscribe"))
            due += self.limit
        return out, due, generation

    def save(self, due: float, generation: int) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.state.update((due, generation))
        self.handle.registerTimer(int(due * 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        due, generation = self.state.get() if self.state.exists() else (float("inf"), 0)
        out = []
        for at in sorted(x for f in rows for x in f["at"].tolist()):
            said, due, generation = self.orders(key[0], due, generation, at)
            out += said
            due = at + self.limit if due == float("inf") else max(due, at + self.limit)
        self.save(due, generation)
        yield pd.DataFrame(out, columns=["line", "at", "generation", "action"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, generation = self.state.get()
        self.save(due + self.limit, generation + 1)
        yield pd.DataFrame([(key[0], due, generation + 1, "resubscribe")], columns=["line", "at", "generation", "action"])

    def close(self) -> None:
        pass


def watchdog(rows: DataFrame, limit: float = 45.0) -> DataFrame:
    """``rows``: line, at (seconds), ts (timestamp with a watermark) -> line, at, generation, action.

    A line that stays silent is ordered anew every ``limit`` seconds of event time, with the next generation.
    """
    return with_store(rows).groupBy("line").transformWithStateInPandas(Watchdog(limit), "line string, at double, generation int, action string", "Append", "EventTime")


class Pulse(StatefulProcessor):
    """Counts of a line's connections; a report at each processing-time timer."""

    COLUMNS = ["line", "at", "messages", "duplicates", "disconnects", "rebuilt", "alive", "connections", "gaps", "gap_s"]
    COUNTS = ("messages", "duplicates", "disconnects", "rebuilt")

    def __init__(self, every: float, alive: float):
        self.every, self.alive = every, alive

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.conns = handle.getMapState("conns", "conn int", "last double, messages long, duplicates long, disconnects long, rebuilt long")
        self.line = handle.getValueState("line", "gaps long, next long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = {int(k[0]): list(v) for k, v in self.conns.iterator()}
        gaps, due = self.line.get() if self.line.exists() else (0, None)
        for f in (pd.concat(list(rows)).sort_values("arrival_ts", kind="stable"),):
            spoke = max((v[0] for v in held.values()), default=None)
            for conn, kind, at, double in zip(f["conn"], f["event_type"], f["arrival_ts"], f["duplicate"], strict=True):
                c = held.setdefault(int(conn), [float("-inf"), 0, 0, 0, 0])
                if kind == "lost":
                    c[3] += 1
                    continue
                gaps += int(spoke is not None and at - spoke >= self.alive)
                spoke = at if spoke is None else max(spoke, at)
                c[0] = max(c[0], float(at))
                if kind == "subscribe":
                    c[4] += 1
                else:
                    c[1] += 1
                    c[2] += int(bool(double))
        for conn, c in held.items():
            self.conns.updateValue((conn,), tuple(c))
        if due is None:
            due = timerValues.getCurrentProcessingTimeInMs() + int(self.every * 1000)
            self.handle.registerTimer(due)
        self.line.update((int(gaps), int(due)))
        yield pd.DataFrame([], columns=self.COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held, (gaps, due) = [v for _, v in self.conns.iterator()], self.line.get()
        due = max(due + int(self.every * 1000), now + 1)
        self.handle.registerTimer(due)
        self.line.update((gaps, due))
        last = max(v[0] for v in held)
        silent = now / 1000 - last
        sums = [int(sum(v[i] for v in held)) for i in range(1, 5)]
        alive = sum(now / 1000 - v[0] < self.alive for v in held)
        yield pd.DataFrame([(key[0], now / 1000, *sums, alive, len(held), gaps, silent if silent >= self.alive else 0.0)], columns=self.COLUMNS)

    def close(self) -> None:
        pass


def pulse(tagged: DataFrame, every: float = 30.0, alive: float = 60.0) -> DataFrame:
    """A report each ``every`` seconds of the clock for each line: line, at, messages, duplicates, disconnects, rebuilt, alive, connections, gaps, gap_s.

    ``tagged``: line, conn, event_type, arrival_ts, duplicate, as ``dedup(..., tag=True)`` gives them; rows "subscribe" and
    "lost" count as such. gaps are silences of all connections of ``alive`` seconds that have ended, gap_s the length of one that lasts.
    """
    schema = "line string, at double, messages long, duplicates long, disconnects long, rebuilt long, alive int, connections int, gaps long, gap_s double"
    return with_store(tagged).groupBy("line").transformWithStateInPandas(Pulse(every, alive), schema, "Append", "ProcessingTime")


class FirstFrame(StatefulProcessor):
    """Time from a subscription to its first frame, once each; the state goes ``keep`` seconds after the subscription."""

    COLUMNS = ["slug", "conn", "subscribed_ts", "first_ts", "latency_ms"]

    def __init__(self, keep: float):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getValueState("waiting", "subscribed double, done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, done = self.waiting.get() if self.waiting.exists() else (None, True)
        out = []
        events = [(at, kind != "subscribe") for f in rows for at, kind in zip(f["arrival_ts"].tolist(), f["event_type"].tolist(), strict=True)]
        for at, frame in sorted(events):
            if not frame:
                since, done = at, False
            elif not done and at >= since:
                out.append((key[0], int(key[1]), since, at, (at - since) * 1000))
                done = True
        if since is not None:
            for t in list(self.handle.listTimers()):
                self.handle.deleteTimer(t)
            self.waiting.update((since, done))
            self.handle.registerTimer(int((since + self.keep) * 1000))
        yield pd.DataFrame(out, columns=self.COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.waiting.clear()
        yield pd.DataFrame([], columns=self.COLUMNS)

    def close(self) -> None:
        pass


def first_frames(frames: DataFrame, keep: float = 3600.0) -> DataFrame:
    """slug, conn, subscribed_ts, first_ts, latency_ms: one row a subscription, ahead of any de-duplication.

    ``frames``: slug, conn, event_type ("subscribe" or a frame's), arrival_ts, ts (timestamp with a watermark). Frames
    without a subscription before them, and all after the first, say nothing.
    """
    schema = "slug string, conn int, subscribed_ts double, first_ts double, latency_ms double"
    return with_store(frames).where("event_type <> 'lost'").groupBy("slug", "conn").transformWithStateInPandas(FirstFrame(keep), schema, "Append", "EventTime")
