"""Windowed usage and stateful job tracking over event logs that grow."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of JSON-lines files as a stream; lines that aren't objects of the schema are left out."""
    return spark.readStream.schema(schema).json(path, mode="DROPMALFORMED")


def windowed_usage(events: DataFrame, time: str, by: list[str], window: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Calls and tokens of each window and key; a window is final once the latest time is `late` past it."""
    return events.withWatermark(time, late).groupBy(F.window(time, window), *by).agg(F.count("*").alias("calls"), F.sum("total_tokens").alias("total_tokens"), F.sum("elapsed_seconds").alias("seconds"))


def sessions(events: DataFrame, time: str, key: str, gap: str = "15 minutes", late: str = "30 minutes") -> DataFrame:
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("events"))


def job_spans(events: DataFrame, key: str, time: str, kind: str, late: str = "1 hour") -> DataFrame:
    """key, started, ended and seconds of each job, from its start and end events in any order; a job without an end is
    dropped when the watermark has passed its start by an hour."""

    def run(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        start, end = state.get if state.exists else (None, None)
        for f in frames:
            for t, what in zip(f["t"], f["kind"], strict=True):
                us = int(pd.Timestamp(t).value // 1000)
                if what == "start":
                    start = us if start is None else min(start, us)
                elif what == "end":
                    end = us if end is None else max(end, us)
        if start is not None and end is not None:
            state.remove() if state.exists else None
            yield pd.DataFrame({"key": [k[0]], "started": [pd.Timestamp(start * 1000)], "ended": [pd.Timestamp(end * 1000)], "seconds": [(end - start) / 1e6]})
            return
        state.update((start, end))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs() + 1, (start or end) // 1000 + 3_600_000))

    rows = events.select(F.col(key).cast("string").alias("key"), F.col(time).alias("t"), F.col(kind).alias("kind")).withWatermark("t", late)
    return rows.groupBy("key").applyInPandasWithState(run, "key string, started timestamp, ended timestamp, seconds double", "start long, end long", "append", GroupStateTimeout.EventTimeTimeout)


def write_table(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to a Parquet table; with `once`, all that is there, then stop."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(path)
