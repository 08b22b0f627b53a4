"""Folds of append-only review logs into the latest state of each key, as window and aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .running import dealt, running


def fold_with_reset(events: DataFrame, key: str, order: Sequence[str], action: str, reset: str, carry: tuple[str, Column] | None = None) -> DataFrame:
    """Each key's last state: key, state (`latest` or `reset`), action, and the carried value.

    A reset closes the segment before it. With carry = (column, has_key): an event that lacks the key
    inherits the value of the last event in its segment that has it, if that value is truthy; one that has
    the key replaces it, with null if its value is null. One aggregation, partial before the shuffle.
    """
    at = F.struct(*order)
    columns = [F.col(action).alias("action"), *(F.col(c).alias(c) for c in order)]
    aggregates = [F.max_by(F.struct(*columns), at).alias("x"), F.max(F.when(F.col(action) == reset, at)).alias("__reset")]
    if carry is not None:
        column, has = carry
        said = F.when(has & (F.col(action) != reset), at)
        aggregates += [F.max(said).alias("__said"), F.max_by(F.struct(F.col(column).alias("v")), said).alias("__value")]
    last = events.groupBy(key).agg(*aggregates)
    out = [key, "x.*"]
    if carry is not None:  # only the last value said can count, and only if no reset came after it
        out.append(F.when(F.col("__reset").isNull() | (F.col("__said") > F.col("__reset")), F.col("__value.v")).alias("carried"))
    return last.select(*out).withColumn("state", F.when(F.col("action") == reset, "reset").otherwise("latest"))


def last_event(events: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], reset: tuple[str, str] | None = None, scope: DataFrame | None = None) -> DataFrame:
    """Plain last-wins fold; with reset = (column, value), keys whose last event is a reset are dropped.

    With a scope, only events of its keys are folded; other events are left out before they are shuffled for the fold.
    """
    if scope is not None:
        events = events.join(scope.select(key).distinct(), key, "left_semi")
    last = events.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("x")).select(key, "x.*")
    return last.filter(F.col(reset[0]) != reset[1]) if reset else last


def quality_status(severity_rank: Column) -> Column:
    """From the greatest severity rank (info 0, warning 1, error and blocked 2)."""
    return F.when(severity_rank >= 2, "blocked").when(severity_rank == 1, "needs_review").otherwise("pass")


def ordinals(df: DataFrame, group: str, code: Sequence[str], explicit: str) -> DataFrame:
    """Adds ordinal: the explicit one where it is not below the next free number, otherwise that number.

    A scan in (max, +): the place in the group and how far explicit numbers have run ahead of places, in ranges of any group's rows.
    """
    parts = dealt(df, [group], [F.col(c) for c in code])
    w = Window.partitionBy("__p", group).orderBy(*code, "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.withColumn("__rn", F.row_number().over(Window.partitionBy("__p", group).orderBy(*code, "__tie")))
    local = local.withColumn("__far", F.col(explicit) - F.col("__rn")).withColumn("__ahead", F.max("__far").over(w))
    # a row for each group and range; places of a range begin behind those of the ranges before it
    totals = local.groupBy(group, "__p").agg(F.max("__rn").alias("n"), F.max("__far").alias("far"))
    before = Window.partitionBy(group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.withColumn("__before", F.sum("n").over(before)).withColumn("__reached", F.max(F.col("far") - F.coalesce("__before", F.lit(0))).over(before))
    taken = placed.filter("__before is not null").select("__p", F.struct(group).alias("__k"), "__before", "__reached")
    joined = local.withColumn("__k", F.struct(group)).join(F.broadcast(taken), ["__p", "__k"], "left")  # at most the first group of each range
    begin = F.coalesce("__before", F.lit(0))
    ahead = F.coalesce(F.greatest(F.col("__ahead") - begin, F.col("__reached")), F.lit(0))
    return joined.select(*df.columns, (F.col("__rn") + begin + F.greatest(F.lit(0), ahead)).cast("long").alias("ordinal"))


#: Actions whose correction keeps them.
KEPT_ACTIONS = ("accept", "needs_review", "block", "exclude", "unblock", "comment", "reviewed")


def corrected_actions(events: DataFrame, key: str, order: Sequence[str], action: str, is_correction: Column, reset: str, kept: Sequence[str] = KEPT_ACTIONS) -> DataFrame:
    """events with the action of each correction rewritten to that of its key's state before it.

    The state is the last action that is no correction, and none after a reset or at the start; a state outside
    `kept`, or none, gives `reviewed`. Corrections take the state over, so a run of them keeps it. A key's events spread over tasks.
    """
    said = F.when(~is_correction, F.col(action))
    found = running(events, [key], [F.col(c) for c in order], last={"__before": said}, before=True)
    state = F.when(F.col("__before").isin(*(k for k in kept if k != reset)), F.col("__before")).otherwise("reviewed")
    return found.withColumn(action, F.when(is_correction, state).otherwise(F.col(action))).drop("__before")
