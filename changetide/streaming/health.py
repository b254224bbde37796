"""Health of a stream as a state that turns by itself: no event for too long is an error, without a further event."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from changetide.operators.filters import TS
from changetide.schema import HEALTH_MAX_AGE_SECONDS

STATUS_SCHEMA = "source string, status string, last_event timestamp"


def heartbeats(events: DataFrame, source: str) -> DataFrame:
    """One row per Arrow batch of a task: source, newest. So few rows meet in the one group."""

    def newest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                last = pc.max(batch.column(0))
                yield pa.RecordBatch.from_arrays([pa.array([source]), pa.array([last.as_py()], batch.schema.field(0).type)], ["source", "newest"])

    return events.select(F.col(TS).cast("timestamp").alias("newest")).mapInArrow(newest, "source string, newest timestamp")


def stream_health_timeout(events: DataFrame, max_age: float = HEALTH_MAX_AGE_SECONDS, source: str = "stream") -> DataFrame:
    """Changes of state, each a row: source, status (OK or ERROR), last_event (newest event time so far).

    An event makes the state OK. ERROR comes `max_age` seconds after the last batch with events, by the clock of the
    cluster, whether or not anything arrives; the query has to run on, with triggers shorter than that.
    Before the first event there is no row, which `last_status` reads as ERROR. Output mode append.
    """
    patience = max(1, round(max_age * 1000))

    def follow(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, status = state.get if state.exists else (None, "ERROR")
        if state.hasTimedOut:
            now = "ERROR"
        else:
            seen = [t for t in [last, *(x for b in batches for x in b["newest"])] if not pd.isna(t)]
            last, now = max(map(pd.Timestamp, seen), default=None), "OK"
            state.setTimeoutDuration(patience)
        state.update((last, now))
        if now != status:
            yield pd.DataFrame({"source": [key[0]], "status": [now], "last_event": pd.Series([last], dtype="datetime64[us]")})

    return heartbeats(events, source).groupBy("source").applyInPandasWithState(
        follow, STATUS_SCHEMA, "last_event timestamp, status string", "append", GroupStateTimeout.ProcessingTimeTimeout
    )


def last_status(changes: list[tuple[str, str]], source: str = "stream") -> str:
    """State of a source after some changes (source, status), in order."""
    found = [status for name, status in changes if name == source]
    return found[-1] if found else "ERROR"
