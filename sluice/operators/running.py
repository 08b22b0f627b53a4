"""Running values within keys of any size: rows are dealt out by ranges of key and order, not by key.

Each range works out its own rows; what a range takes over from the ranges before it is one row for the key that it begins with, so
there are no more of those than ranges. A key that holds a third of all rows is spread over a third of the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

_UP_TO = (Window.unboundedPreceding, Window.currentRow)
_BEFORE = (Window.unboundedPreceding, -1)


def dealt(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """df with the number of its range, stored: both looks at the ranges see the same rows in them. Ties are split by all columns' hash."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # named, so that adaptive execution keeps the ranges
    tie = F.xxhash64(*df.columns)
    return stored(df.withColumn("__tie", tie).repartitionByRange(n, *(F.col(k).asc_nulls_first() for k in keys), *order, "__tie").withColumn("__p", F.spark_partition_id()))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[Column], counts: Sequence[str] = (), greatest: dict[str, Column] | None = None, last: dict[str, Column] | None = None, before: bool = False, ranges: DataFrame | None = None) -> DataFrame:
    """df with running values within `keys` in `order`, up to each row (or before it, with `before`).

    counts: names of row numbers, from 1. greatest: the greatest value so far. last: the last non-null value so far. Null keys are one
    key. `ranges`: df as dealt() returned it, to use it again.
    """
    parts = dealt(df, keys, order) if ranges is None else ranges
    whole = Window.partitionBy("__p", *keys).orderBy(*order, "__tie").rowsBetween(*_UP_TO)
    frame = whole.rowsBetween(*_BEFORE) if before else whole
    kinds = {**{c: ("count", None) for c in counts}, **{c: ("max", v) for c, v in (greatest or {}).items()}, **{c: ("last", v) for c, v in (last or {}).items()}}
    over = {"count": lambda v: F.count(F.lit(1)), "max": F.max, "last": lambda v: F.last(v, ignorenulls=True)}
    local = parts.withColumns({c: over[kind](v).over(whole if kind == "count" else frame) for c, (kind, v) in kinds.items()})

    # a row for each key and range; of the last values that of the greatest place
    place = F.row_number().over(Window.partitionBy("__p", *keys).orderBy(*order, "__tie"))
    ends = parts.withColumn("__n", place) if last else parts
    total = {"count": lambda v: F.count(F.lit(1)), "max": F.max, "last": lambda v: F.max_by(v, F.when(v.isNotNull(), F.col("__n")))}
    totals = ends.groupBy(*keys, "__p").agg(*(total[kind](v).alias(c) for c, (kind, v) in kinds.items()))
    earlier = Window.partitionBy(*keys).orderBy("__p").rowsBetween(*_BEFORE)
    merge = {"count": F.sum, "max": F.max, "last": lambda v: F.last(v, ignorenulls=True)}
    taken = totals.select("__p", F.struct(*keys).alias("__k"), F.count(F.lit(1)).over(earlier).alias("__ranges"), *(merge[kind](F.col(c)).over(earlier).alias(f"__c_{c}") for c, (kind, _) in kinds.items())).filter("__ranges > 0")

    joined = local.withColumn("__k", F.struct(*keys)).join(F.broadcast(taken), ["__p", "__k"], "left")  # at most the first key of each range
    out = {}
    for c, (kind, _) in kinds.items():
        carry = F.col(f"__c_{c}")
        out[c] = F.col(c) + F.coalesce(carry, F.lit(0)) if kind == "count" else F.greatest(c, carry) if kind == "max" else F.coalesce(c, carry)
    return joined.withColumns(out).select(*df.columns, *kinds)
