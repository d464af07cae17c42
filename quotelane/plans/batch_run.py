"""The batch run: reports over the archive, then the comparison with the stream."""

import time
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.operators.aggregates import (
    averages_from_cells,
    fare_cells,
    merge_cells,
    stats_from_cells,
)
from quotelane.operators.compare import compare_results
from quotelane.operators.ranking import cheapest
from quotelane.schema import ROUTE
from quotelane.session import materialize
from quotelane.sinks.columns import conform
from quotelane.streaming import runs

# Query type, table of the streaming side, table of the batch side.
COMPARED = [
    ("route_stats", "route_stats", "batch_route_stats"),
    ("best_airlines", "best_airlines", "batch_best_airlines"),
]


def batch_reports(quotes: DataFrame) -> tuple[dict[str, DataFrame], float]:
    """The stored batch reports, and the seconds it took to compute them.

    The quotes are read once; both reports come from the same cells.
    """
    started = time.monotonic()
    cells = materialize(fare_cells(quotes), "cells")
    reports = {
        "batch_route_stats": stats_from_cells(merge_cells(cells, ROUTE)),
        "batch_best_airlines": cheapest(averages_from_cells(cells)),
    }
    reports = {table: materialize(report, table) for table, report in reports.items()}
    return reports, time.monotonic() - started


def run_batch(
    quotes: DataFrame, store, fit: Callable[[DataFrame, str], DataFrame] = conform
) -> float:
    """Append the batch reports to ``store`` with their execution time."""
    reports, seconds = batch_reports(quotes)
    for table, report in reports.items():
        store.append(fit(report.withColumn("execution_time", F.lit(seconds)), table), table)
    return seconds


def run_comparison(
    spark: SparkSession,
    store,
    stream_seconds: float | None = None,
    as_of: Column | datetime | None = None,
    within: str = "1 hour",
) -> None:
    """Append one comparison row per query type to ``store``.

    The stream's time is the one that it stored, or 0 before its first report, unless
    ``stream_seconds`` is given. A side that has stored nothing counts 0 rows. Only folders
    that may hold rows stored ``within`` that time are opened.
    """
    if stream_seconds is None:
        stream_seconds = runs.stream_seconds(spark, store) or 0.0
    as_of = datetime.now(timezone.utc) if as_of is None else as_of
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    earliest = (now - F.expr(f"INTERVAL {within}")).cast("timestamp").cast("double")
    since = spark.range(1).select(earliest).first()[0]
    for query_type, streamed, batch in COMPARED:
        streaming = runs.stored_report(spark, store, streamed, since)
        row = compare_results(streaming, store.read(spark, batch, since), query_type, stream_seconds, now, within)
        store.append(conform(row, "comparison_metrics"), "comparison_metrics")
