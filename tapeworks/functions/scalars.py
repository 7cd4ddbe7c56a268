"""Column functions without a book: safe casts, slugs, bars, buckets, clocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Edges of the frame-interval histogram in seconds, left-closed; the last bin is open above. Fixed values.
INTERVAL_EDGES = (0.0, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 60.0)
INTERVAL_LABELS = ("0~0.05", "0.05~0.1", "0.1~0.2", "0.2~0.5", "0.5~1", "1~2", "2~5", "5~10", "10~60", "60~inf")


def safe_double(x: Column) -> Column:
    """NULL for null, empty and unparseable text."""
    return x.cast("string").try_cast("double")


def safe_long(x: Column, default: int | None = None) -> Column:
    """Through double, truncated toward zero; ``default`` on failure."""
    return F.coalesce(safe_double(x).try_cast("bigint"), F.lit(default).cast("bigint"))


def bar_of(seconds: Column, cycle_s: int | Column) -> Column:
    return (F.floor(seconds / cycle_s) * cycle_s).cast("long")


def slug_of(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.jsonl\.gz$", "")


def slug_epoch(slug: Column) -> Column:
    return F.element_at(F.split(slug, "-"), -1).try_cast("bigint")


def slug_window(slug: Column) -> tuple[Column, Column]:
    """Start and length of a bar in ms, from `-updown-(5|15)m-<epoch>`; NULL for other slugs."""
    rule = r"-updown-(5|15)m-(\d+)$"
    start = F.nullif(F.regexp_extract(slug, rule, 2), F.lit("")).try_cast("bigint") * 1000
    return start, F.nullif(F.regexp_extract(slug, rule, 1), F.lit("")).try_cast("bigint") * 60_000


def interval_bucket(seconds: Column) -> Column:
    out = F.when(seconds < 0, F.lit(None).cast("string"))
    for label, top in zip(INTERVAL_LABELS, (*INTERVAL_EDGES[1:], None), strict=True):
        out = out.otherwise(F.lit(label)) if top is None else out.when(seconds < top, label)
    return F.when(seconds.isNotNull(), out)


def clock_seconds(hms: Column) -> Column:
    """HH:MM:SS.mmm as seconds of the day; no wrap at midnight."""
    part = F.split(hms, ":")
    return F.get(part, 0).try_cast("double") * 3600 + F.get(part, 1).try_cast("double") * 60 + F.get(part, 2).try_cast("double")


def utc_hour(epoch_s: Column) -> Column:
    return (F.floor(epoch_s / 3600) % 24).cast("int")


def utc_day(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def first_hash(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def nearest_rank(values: Column, q: float) -> Column:
    """Nearest-rank percentile of an array: index round(q (n - 1)), halves to even; NULL without values."""
    n = F.size(values)
    at = F.bround(F.lit(float(q)) * (n - 1), 0).cast("int")
    return F.when(n > 0, F.get(F.array_sort(values), F.least(F.greatest(at, F.lit(0)), n - 1)))


def won(winner: Column, lead: Column, up_token: Column, down_token: Column) -> Column:
    """Did the leading token win? The winner may be a token id or name a side; anything else counts as DOWN."""
    side = F.lower(winner)
    return F.when(winner == lead, True).when(side.isin("up", "1"), lead == up_token).otherwise(lead == down_token)


def roi(is_win: Column, ask: Column) -> Column:
    return F.when(is_win, (1 - ask) / ask).otherwise(F.lit(-1.0))


def fee_roi(plain: Column, ask: Column, rate: float = 0.07) -> Column:
    return plain - rate * (1 - ask) / ask
