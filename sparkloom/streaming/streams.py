"""Streams of rows: first rows within a watermark, windowed counts, and notes paired as their events arrive."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship


def first_seen(stream: DataFrame, keys: list[str], at: str, delay: str = "10 minutes") -> DataFrame:
    """Each key's first row; keys are forgotten once the watermark has passed them."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, at: str, key: str, size: str = "10 minutes", delay: str = "10 minutes") -> DataFrame:
    """Rows of each key in tumbling windows, out once the watermark has closed them."""
    w = F.window(at, size)
    return stream.withWatermark(at, delay).groupBy(w, key).agg(F.count("*").alias("rows")).select(F.col("window.start").alias("start"), key, "rows")


PAIRED = "track string, pitch int, velocity int, on_tick long, off_tick long"


def paired_notes(stream: DataFrame, idle_ms: int | None = None) -> DataFrame:
    """Notes of a stream of events (track, seq, tick, pitch, velocity); velocity 0 ends the oldest open note of a pitch.

    Open notes are kept as state for each track, so pairs form across micro-batches; ends
    without an open note are ignored. Within a batch events go by seq. With idle_ms a track
    without events for so long is forgotten, with its open notes; such a query has a batch at every trigger.
    """
    ship(stream.sparkSession)

    def run(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if idle_ms is not None and state.hasTimedOut:
            state.remove()
            return
        held = {int(k): v for k, v in json.loads(state.get[0]).items()} if state.exists else {}
        rows = []
        events = pd.concat(list(parts)).sort_values("seq")
        for e in events.itertuples():
            queue = held.setdefault(int(e.pitch), [])
            if e.velocity > 0:
                queue.append([int(e.tick), int(e.velocity)])
            elif queue:
                on, velocity = queue.pop(0)
                rows.append((key[0], int(e.pitch), velocity, on, max(int(e.tick), on + 1)))
        if idle_ms is not None:
            state.setTimeoutDuration(idle_ms)
        state.update((json.dumps({k: v for k, v in held.items() if v}),))
        yield pd.DataFrame(rows, columns=["track", "pitch", "velocity", "on_tick", "off_tick"])

    return stream.groupBy("track").applyInPandasWithState(run, PAIRED, "held string", "append", "NoTimeout" if idle_ms is None else "ProcessingTimeTimeout")


def flushed(stream: DataFrame, path: str, checkpoint: str, order: list[str], rows_per_shard: int):
    """Starts a query that writes each micro-batch as Parquet files of rows_per_shard rows at most, in order, into a folder of its own.

    A batch that is run again after a failure writes the same folder over, so each row is there once.
    What was read, and so where a restart goes on, is in the checkpoint.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.repartitionByRange(*order).sortWithinPartitions(*order)
        rows.write.mode("overwrite").option("maxRecordsPerFile", rows_per_shard).parquet(f"{path.rstrip('/')}/batch={number:08d}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def log_lines(stream: DataFrame, path: str, checkpoint: str):
    """Starts a query that adds rows as JSON lines to a log that only grows; it goes on where its checkpoint says."""
    return stream.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def resumable(stream: DataFrame, path: str, checkpoint: str):
    """Starts a query that copies a stream to Parquet, exactly once; run again, it reads on from its last position, which the checkpoint keeps."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
