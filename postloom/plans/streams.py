"""The streaming operators over a table, as they would run over its batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from ..streaming.dedup import windowed_counts


def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return windowed_counts(table(spark, d, "events").select("ts", "event_type"), "ts", "event_type")


QUERIES = {"event_windows": event_windows}
SQL = {"event_windows": "select date_trunc('hour', ts) as start, event_type, count(*) as events from events group by 1, 2"}
