"""Structured Streaming forms of the sequence operators."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_RUN = "source string, run_no bigint, id string, first_seq bigint, last_seq bigint, n bigint"
_STATE = "run_no bigint, id string, first_seq bigint, last_seq bigint, n bigint"


def _emit(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        cur = state.get
        state.remove()
        yield pd.DataFrame([(key[0], *cur)], columns=[c.split()[0] for c in _RUN.split(", ")])
        return
    cur: tuple[Any, ...] | None = state.getOption
    out = []
    rows = pd.concat(list(frames)).sort_values("seq")
    for i, s in zip(rows["id"], rows["seq"]):
        if cur is None:
            cur = (0, i, int(s), int(s), 1)
        elif i == cur[1]:
            cur = (cur[0], cur[1], cur[2], int(s), cur[4] + 1)
        else:
            out.append((key[0], *cur))
            cur = (cur[0] + 1, i, int(s), int(s), 1)
    if cur is not None:
        state.update(cur)
        state.setTimeoutDuration(60_000)
    yield pd.DataFrame(out, columns=[c.split()[0] for c in _RUN.split(", ")])


def run_groups_stream(rows: DataFrame) -> DataFrame:
    """Runs of equal ids per source, across micro-batches (ST1): a run comes out when the id changes.

    ``rows`` is a stream with source, id and seq, a source's rows arriving in the
    order of seq. The last run of a source comes out when nothing has arrived for
    a minute. State is one small tuple per source.
    """
    return rows.groupBy("source").applyInPandasWithState(_emit, _RUN, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def windowed_counts(rows: DataFrame, at: str, key: str, length: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Rows per key and tumbling window; rows later than ``late`` behind the newest are dropped by the watermark."""
    t = rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return t.groupBy(F.window(at, length), key).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), key, "n")


def new_episodes(path_rows: DataFrame, done: DataFrame) -> DataFrame:
    """Stream of episodes that are not yet processed (ST3): anti-join with a static table."""
    return path_rows.join(done.select("episode_index").distinct(), "episode_index", "left_anti")
