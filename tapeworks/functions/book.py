"""Column functions over price levels: array<struct<price, size>>, texts or doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks.functions.scalars import safe_double


def best(levels: Column, bid: bool) -> Column:
    """struct<price, size> of the highest bid or lowest ask whatever the order; ties: the first level; NULL if none parses."""
    keyed = F.transform(
        levels, lambda x, i: F.struct(safe_double(x["price"]).alias("price"), (-i if bid else i).alias("i"), safe_double(x["size"]).alias("size"))
    )
    usable = F.filter(keyed, lambda x: x["price"].isNotNull())
    top = F.array_max(usable) if bid else F.array_min(usable)
    return F.struct(top["price"].alias("price"), top["size"].alias("size"))


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / 2


def spread(bid: Column, ask: Column) -> Column:
    return ask - bid


def level_count(levels: Column) -> Column:
    return F.when(levels.isNull(), 0).otherwise(F.size(levels)).cast("smallint")


def prices(levels: Column) -> Column:
    """Prices that parse, rounded to 4 places, ascending."""
    return F.array_sort(F.filter(F.transform(F.coalesce(levels, F.array()), lambda x: F.round(safe_double(x["price"]), 4)), lambda p: p.isNotNull()))


def steps(sorted_prices: Column) -> Column:
    """Distances of neighbours, rounded to 4 places; none for fewer than two prices or no range."""
    n = F.size(sorted_prices)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.round(F.get(sorted_prices, i) - F.get(sorted_prices, i - 1), 4))
    return F.when((n > 1) & (F.array_max(sorted_prices) > F.array_min(sorted_prices)), pairs).otherwise(F.array().cast("array<double>"))


def odd_step(step: Column) -> Column:
    return F.exists(step, lambda s: s != 0.01)


def hole(step: Column) -> Column:
    return F.exists(step, lambda s: s > 0.0101)


def reaches_low(sorted_bids: Column) -> Column:
    return F.coalesce(F.array_min(sorted_bids) <= 0.0101, F.lit(False))


def reaches_high(sorted_asks: Column) -> Column:
    return F.coalesce(F.array_max(sorted_asks) >= 0.9899, F.lit(False))
