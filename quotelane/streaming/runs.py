"""Starting and watching streaming queries.

All reports of a stream share one query over cells (see ``operators.aggregates``), so the
source is read once and aggregated once, whatever the number of reports. There are three ways
to keep them:

- ``start_all`` archives the quotes and adds up the cells of every micro-batch in the store,
  from one read of the source and without any state. Reports are computed on reading.
- ``start_reports`` keeps the cells as state and stores whole reports, or under a watermark
  each window once.
- ``start_cells`` keeps them as state and stores those that a batch changed.
"""

import time
from collections.abc import Callable, Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelane.functions.codec import DAMAGED_PAYLOAD, damaged_payloads, without_payloads
from quotelane.functions.windows import micros, pane
from quotelane.operators.aggregates import (
    MEASURES,
    averages_from_cells,
    fare_cells,
    merge_cells,
    stats_from_cells,
    trend_from_cells,
    window_bounds,
)
from quotelane.operators.ranking import cheapest
from quotelane.schema import CARRIER, ROUTE
from quotelane.session import adaptive_execution
from quotelane.sinks.columns import conform
from quotelane.sinks.stores import ARCHIVE, UNREADABLE

WINDOW = "30 minutes"
# The table with the seconds that each micro-batch took.
TIMES = "stream_times"
REPORTS = ("route_stats", "best_airlines", "price_trends")
CELL_KEYS = ROUTE + CARRIER
#: Tables of cells: newest versions, and sums over micro-batches with the windows they are for.
VERSIONS, CELL_SUMS, CELL_WINDOWS = "fare_cells", "fare_sums", "fare_windows"


def with_event_time(quotes: DataFrame, watermark: str | None = None) -> DataFrame:
    """Quotes with a zoned ``timestamp``, late by at most ``watermark`` if given.

    Without a watermark late quotes always count, and the state keeps every window.
    """
    zoned = quotes.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return zoned.withWatermark("timestamp", watermark) if watermark else zoned


def window_reports(cells: DataFrame) -> dict[str, DataFrame]:
    """The stored reports, from cells per route, airline and window."""
    routes = merge_cells(cells, ROUTE)
    return {
        "route_stats": stats_from_cells(routes),
        "best_airlines": cheapest(averages_from_cells(cells)),
        "price_trends": trend_from_cells(routes),
    }


def start_reports(
    quotes: DataFrame,
    store,
    checkpoints: str,
    window: str = WINDOW,
    slide: str | None = None,
    watermark: str | None = None,
    trigger: dict | None = None,
    fit: Callable[[DataFrame, str], DataFrame] = conform,
    tables: Collection[str] = REPORTS,
) -> StreamingQuery:
    """Keep the windowed reports of a stream in ``store``, all or those of ``tables``.

    Without a watermark each batch stores a new snapshot of every window. With one,
    a window is stored once, when it can no longer change. All airlines of a window
    leave the state in the same batch, so ranking a batch ranks whole windows. Mind
    that a stamp far in the future closes all windows before it.
    """
    timed = with_event_time(quotes, watermark)
    # State holds panes. Snapshots build the windows from them in each batch; under a
    # watermark a second aggregate does, which closes each window once.
    panes = None if watermark else pane(window, slide)

    def store_batch(rows: DataFrame, batch_id: int, stream: str) -> None:
        started = time.monotonic()
        cells = rows.persist()
        try:
            if cells.isEmpty():
                return
            if panes:
                cells = merge_cells(cells, CELL_KEYS, window, slide)
            reports = window_reports(cells)
            save = store.append_batch if watermark else store.replace
            for table in tables:
                save(fit(reports[table], table), table, batch_id, stream)
            _store_time(store, rows.sparkSession, started, batch_id, stream)
        finally:
            rows.unpersist()

    if panes:
        cells = fare_cells(timed, CELL_KEYS, panes)
    else:
        cells = fare_cells(timed, CELL_KEYS, window, slide)
    mode = "append" if watermark else "complete"
    return _start(cells, store_batch, mode, f"{checkpoints}/reports", trigger)


def start_archive(
    quotes: DataFrame, store, checkpoints: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append every decoded quote to the raw archive, and the payloads that could not be
    read in full to a table beside it, if ``decode_quotes`` kept them."""

    def store_batch(rows: DataFrame, batch_id: int, stream: str) -> None:
        _archive(rows, store, batch_id, stream)

    return _start(quotes, store_batch, "append", f"{checkpoints}/raw_flight_prices", trigger)


def _archive(rows: DataFrame, store, batch_id: int, stream: str) -> None:
    if DAMAGED_PAYLOAD in rows.columns:
        damaged = damaged_payloads(rows).withColumn("inserted_at", F.current_timestamp())
        store.append_batch(damaged, UNREADABLE, batch_id, stream)
    store.append_batch(conform(without_payloads(rows), ARCHIVE), ARCHIVE, batch_id, stream)


def start_all(
    quotes: DataFrame,
    store,
    checkpoints: str,
    window: str = WINDOW,
    slide: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Archive the quotes and keep all reports, from one read of the source.

    The stream has no state: each batch adds its own cells to ``fare_sums``, and the store
    adds them up when it merges folders. Late quotes always count. Every table takes a batch
    once, so after a failure between two of them only the missing ones are written.
    ``stored_report`` computes the reports. A sliding window's cells are its panes.
    """
    panes = pane(window, slide) or window
    if panes == window:
        if slide and micros(slide) != micros(window):
            raise ValueError("windows that no pane tiles must be stored by start_reports")
        slide = None
    settings = quotes.sparkSession.createDataFrame([(window, slide, panes)], "length string, slide string, pane string")

    def store_batch(rows: DataFrame, batch_id: int, stream: str) -> None:
        started = time.monotonic()
        quotes = rows.persist()
        try:
            if quotes.isEmpty():
                return
            stored = settings.sparkSession.createDataFrame(settings.collect(), settings.schema)
            store.replace(stored.coalesce(1), CELL_WINDOWS, batch_id, stream)
            _archive(quotes, store, batch_id, stream)
            timed = with_event_time(without_payloads(quotes))
            store.append_batch(fare_cells(timed, CELL_KEYS, panes), CELL_SUMS, batch_id, stream, added_cells)
            _store_time(store, rows.sparkSession, started, batch_id, stream)
        finally:
            rows.unpersist()

    return _start(quotes, store_batch, "append", f"{checkpoints}/all", trigger)


def added_cells(cells: DataFrame) -> DataFrame:
    """Cells of several batches, added up."""
    return merge_cells(cells, CELL_KEYS)


def stored_report(spark: SparkSession, store, table: str, since: float | None = None) -> DataFrame:
    """A stored report, or the one that the stored sums of cells give.

    The load stamp of a computed report is the time at which its cells last changed, as that
    of a snapshot is.
    """
    if not store.has(spark, CELL_SUMS):
        return store.read(spark, table, since)
    cells = added_cells(store.read(spark, CELL_SUMS))
    kept = store.read(spark, CELL_WINDOWS).first()  # one row
    if kept["slide"]:
        cells = merge_cells(cells, CELL_KEYS, kept["length"], kept["slide"])
    stamp = F.timestamp_seconds(F.lit(store.changed_at(spark, CELL_SUMS)))
    return conform(window_reports(cells)[table].withColumn("created_at", stamp), table)


def start_cells(
    quotes: DataFrame,
    store,
    checkpoints: str,
    window: str = WINDOW,
    watermark: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Store only the cells that a batch changed, in table ``fare_cells``.

    Unlike a snapshot, a batch costs no more than its own quotes touch. Reports are
    computed on reading: ``window_reports(latest_cells(...))``. ``merge_cells`` makes
    longer or sliding windows of the cells first. When folders are merged only the newest
    version of a cell stays, so there are at most as many versions of it as folders.
    """

    def store_batch(rows: DataFrame, batch_id: int, stream: str) -> None:
        changed = rows.withColumn("version", F.lit(batch_id).cast("long"))
        store.append_batch(changed, VERSIONS, batch_id, stream, newest_versions)

    cells = fare_cells(with_event_time(quotes, watermark), CELL_KEYS, window)
    return _start(cells, store_batch, "update", f"{checkpoints}/fare_cells", trigger)


def newest_versions(stored: DataFrame) -> DataFrame:
    """The newest version of each cell, with its version."""
    keys = [*CELL_KEYS, *window_bounds(stored)]
    # One by one: numbers can be aggregated in a hash table, a struct of them cannot.
    newest = [F.max_by(name, "version").alias(name) for name in MEASURES]
    return stored.groupBy(*keys).agg(*newest, F.max("version").alias("version"))


def latest_cells(stored: DataFrame) -> DataFrame:
    """The newest version of each cell."""
    return newest_versions(stored).drop("version")


def await_any(spark: SparkSession) -> None:
    """Block until one query stops; an error in it is raised here."""
    spark.streams.awaitAnyTermination()


def stream_seconds(spark: SparkSession, store) -> float | None:
    """Time that the stream of reports has spent in all its micro-batches, None if no
    report was stored yet. Each batch stores its time once, also if it is repeated."""
    return store.read(spark, TIMES).agg(F.sum("seconds")).first()[0]


def _store_time(store, spark: SparkSession, started: float, batch_id: int, stream: str) -> None:
    spent = spark.range(1).select(F.lit(time.monotonic() - started).alias("seconds"))
    store.append_batch(spent.coalesce(1), TIMES, batch_id, stream)


def _start(df: DataFrame, store_batch, mode: str, checkpoint: str, trigger: dict | None):
    def store_adaptively(rows: DataFrame, batch_id: int) -> None:
        # The query's id stands in its checkpoint; a new checkpoint has a new one.
        stream = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not stream:
            raise RuntimeError("Spark did not say which query the batch belongs to")
        with adaptive_execution(rows.sparkSession):
            store_batch(rows, batch_id, stream)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.foreachBatch(store_adaptively).start()
