"""The log fold with carried corrections as a stateful stream, and queue-like micro-batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "seq long, action string, carried string, has_carried boolean"
OUTPUT = "key long, seq long, action string, state string, carried string"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Events of one key in one micro-batch, in order of seq; what is late by seq is left out."""
    last, action, carried, has = state.get if state.exists else (-1, None, None, False)
    rows = pd.concat(list(batches)).sort_values("seq", kind="stable")
    for e in rows.itertuples(index=False):
        if e.seq <= last:
            continue
        last, action = int(e.seq), e.action
        if e.action == "reset_review":
            carried, has = None, False
        elif e.has_correction:
            carried, has = (None if e.correction is None or e.correction != e.correction or e.correction == "" else str(e.correction)), True
    state.update((last, action, carried, has))
    kind = "reset" if action == "reset_review" else "latest"
    yield pd.DataFrame({"key": [key[0]], "seq": [last], "action": [action], "state": [kind], "carried": [carried]})


def fold_stream(events: DataFrame) -> DataFrame:
    """Latest state of each key after every micro-batch, from (key, seq, action, has_correction, correction).

    One small state row for each key; a key's events of one micro-batch meet in one task, history does not.
    """
    return events.groupBy("key").applyInPandasWithState(_fold, OUTPUT, STATE, "update", GroupStateTimeout.NoTimeout)


def drain(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Take what has arrived, in micro-batches, each handed to `handle` once per id; a restart resumes after the last."""
    run = stream.writeStream.foreachBatch(handle).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
