"""Builders on streams: rows arrive, facts leave, each once within a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orrery.operators.triples import COLUMNS


def fact_stream(rows: DataFrame, facts: Callable[[DataFrame], list], time: str, delay: str = "1 hour") -> DataFrame:
    """(triple, time) of a stream of rows; the state that drops repeats is bounded by the watermark."""
    out = rows.withWatermark(time, delay).select(F.col(time), F.inline(F.array_compact(F.array(*facts(rows))))).toDF(time, *COLUMNS)
    return out.dropDuplicatesWithinWatermark(list(COLUMNS))


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "5 minutes", delay: str = "10 minutes") -> DataFrame:
    return events.withWatermark(time, delay).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))


def drained(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs a stream over what there is, into Parquet."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
