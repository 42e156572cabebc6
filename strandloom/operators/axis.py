"""Running sums and islands along an axis, without a window that holds the whole axis of a key.

The axis is cut into bins, and a bin's rows are summed up before; what lies before a bin comes from the bins, which are
an axis themselves. So a window holds a bin's different places, at most as many as the bin is wide, or a key's bins.
Both are combined before they are shuffled, and so do not grow with the depth of a place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Places of a bin.
WIDTH = 1 << 16


def same_keys(a: DataFrame, b: DataFrame, columns: list[str], how: str = "inner") -> DataFrame:
    """a joined with b on columns, null equal to null; b's columns of these names go."""
    renamed = b.select(*(F.col(c).alias(f"__same{n}") for n, c in enumerate(columns)), *(c for c in b.columns if c not in columns))
    on = reduce(Column.__and__, (a[c].eqNullSafe(renamed[f"__same{n}"]) for n, c in enumerate(columns)))
    return a.join(renamed, on, how).drop(*(f"__same{n}" for n in range(len(columns))))


def _bin(at: str, width: int) -> Column:
    return F.floor(F.col(at) / width)


def running_sums(places: DataFrame, keys: list[str], at: str, values: list[str], width: int = WIDTH, levels: int = 2) -> DataFrame:
    """places + <value>_to for each of values: its sum over the places of keys up to and including each row's.

    places must hold a place of a key once. levels is how often the axis is summed up: the windows at the top hold the
    range of the axis divided by width to the power of levels - 1, in rows for each key. A null place comes first.
    """
    up_to = lambda *by: Window.partitionBy(*keys, *by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    if levels == 1:
        return places.withColumns({f"{v}_to": F.sum(v).over(up_to()) for v in values})
    up = f"__bin{levels}"
    binned = places.withColumn(up, _bin(at, width))
    inner = binned.withColumns({f"{v}_to": F.sum(v).over(up_to(up)) for v in values})
    bins = binned.groupBy(*keys, up).agg(*(F.sum(v).alias(v) for v in values))
    before = running_sums(bins, keys, up, values, width, levels - 1).select(*keys, up, *((F.col(f"{v}_to") - F.col(v)).alias(f"__before_{v}") for v in values))
    both = same_keys(inner, before, [*keys, up])
    return both.select(*places.columns, *((F.col(f"{v}_to") + F.col(f"__before_{v}")).alias(f"{v}_to") for v in values))


def _number(nodes: DataFrame, keys: list[str], at: str, gap: int, width: int, levels: int) -> DataFrame:
    """(keys, at, number): number of the island that a node's first place belongs to; nodes are (keys, at, first, last, n), n the islands in a node."""
    up = f"__bin{levels}"
    by = [*keys, up] if levels > 1 else keys
    binned = nodes.withColumn(up, _bin(at, width)) if levels > 1 else nodes
    order = Window.partitionBy(*by).orderBy(at)
    goes_on = F.coalesce(F.col("first") - F.lag("last").over(order) < gap, F.lit(False)).cast("int")
    marked = binned.withColumn("fresh", F.col("n") - goes_on)
    number = F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n") + 1
    inner = marked.withColumn("number", number).select(*dict.fromkeys([*by, at]), "number")
    if levels == 1:
        return inner
    bins = marked.groupBy(*by).agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("fresh").alias("n"))
    start = _number(bins, keys, up, gap, width, levels - 1).withColumnRenamed("number", "start")
    return same_keys(inner, start, by).select(*keys, at, (F.col("start") + F.col("number") - 1).alias("number"))


def island_numbers(df: DataFrame, keys: list[str], at: str, gap: int, width: int = WIDTH, levels: int = 2) -> DataFrame:
    """(keys, at, number) of each different place of df: the number, from 1 within keys, of its island. An island ends where the next place is gap or more away.

    A null place comes first, as an island of its own.
    """
    places = df.groupBy(*keys, at).agg(F.first(at).alias("first"), F.first(at).alias("last"), F.lit(1).cast("long").alias("n"))
    return _number(places, keys, at, gap, width, levels)
