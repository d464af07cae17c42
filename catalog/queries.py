"""One callable per registered query, each over its whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import quotelane as ql
from catalog.mapping import (
    event_metrics,
    event_quotes,
    event_stream,
    harsh,
    harsh_quotes,
    star_quotes,
    vast_quotes,
)
from quotelane.functions.codec import decode_quotes, encode_quotes, flatten_metadata
from quotelane.operators.aggregates import averages_from_cells, stats_from_cells
from quotelane.operators.ranking import cheapest
from quotelane.plans.batch_run import COMPARED, batch_reports, run_batch, run_comparison
from quotelane.schema import QUOTE, ROUTE
from quotelane.session import scratch_path
from quotelane.sinks.columns import conform
from quotelane.sinks.publish import publish_files
from quotelane.sinks.stores import ARCHIVE, UNREADABLE, ParquetStore
from quotelane.sources.tables import register_view
from quotelane.streaming import runs
from quotelane.streaming.cheapest import best_airline_stream

Query = Callable[[SparkSession, str], DataFrame]
Report = Callable[[DataFrame], DataFrame]

EVENT_WINDOW, EVENT_SLIDE = "30 minutes", "10 minutes"
STAR_WINDOW, STAR_SLIDE = "30 days", "10 days"
ROUNDED = (
    "avg_price",
    "streaming_avg_price",
    "batch_avg_price",
    "price_diff_percentage",
    "streaming",
    "batch",
    "speedup",
    "price_diff",
)


def presented(df: DataFrame) -> DataFrame:
    """Round computed means and drop the zone of stamps."""
    columns = []
    for name, kind in df.dtypes:
        value = F.col(name)
        if name in ROUNDED:
            value = F.round(value.cast("double"), 6)
        elif kind == "timestamp":
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(name))
    return df.select(*columns)


def on_events(report: Report) -> Query:
    return lambda spark, sf_dir: presented(report(event_quotes(spark, sf_dir)))


def on_star(report: Report) -> Query:
    return lambda spark, sf_dir: presented(report(star_quotes(spark, sf_dir)))


def on_metrics(report: Report) -> Query:
    return lambda spark, sf_dir: presented(report(event_metrics(spark, sf_dir)))


def stored_best(quotes: DataFrame) -> DataFrame:
    return cheapest(ql.airline_averages(quotes, EVENT_WINDOW))


def best_by_sql(quotes: DataFrame) -> DataFrame:
    """A user's own SQL over the registered view."""
    view = register_view(quotes, "flight_prices")
    return view.sparkSession.sql(
        "SELECT origin, destination, airline, max(price_usd) AS max_price, count(*) AS flight_count "
        "FROM flight_prices GROUP BY origin, destination, airline"
    )


def compared(report: Callable[..., DataFrame], query_type: str, window: str, as_of: str, within: str) -> Report:
    """Windowed results stored at the end of their window, against one batch run."""

    def run(quotes: DataFrame) -> DataFrame:
        now = F.lit(as_of).cast("timestamp_ntz")
        streamed = report(quotes, window).withColumn("created_at", F.col("window_end"))
        batch = report(quotes).withColumns({"created_at": now, "execution_time": F.lit(12.5)})
        return ql.compare_results(streamed, batch, query_type, 1800, now, within)

    return run


def published(quotes: DataFrame) -> DataFrame:
    """The messages, opened up."""
    messages = encode_quotes(quotes, published_at=F.col("timestamp"))
    field = lambda path: F.get_json_object("value", path)
    return messages.select(
        "key",
        "topic",
        field("$.price_usd").cast("double").alias("price_usd"),
        field("$.timestamp").alias("timestamp"),
        field("$._metadata.route_id").alias("route_id"),
        F.round(field("$._metadata.producer_timestamp").cast("double"), 3).alias("producer_timestamp"),
    )


def as_messages(quotes: DataFrame) -> DataFrame:
    """Encoded quotes with a broker stamp a second after the quote's own."""
    encoded = encode_quotes(quotes, published_at=F.col("timestamp"))
    sent = F.get_json_object("value", "$.timestamp").cast("timestamp") + F.expr("INTERVAL 1 SECOND")
    return encoded.withColumn("timestamp", sent)


def decoded_events(quotes: DataFrame) -> DataFrame:
    decoded = flatten_metadata(decode_quotes(as_messages(quotes)))
    return decoded.select(*QUOTE.fieldNames(), "route_id", "topic", "kafka_timestamp")


def damaged_messages(quotes: DataFrame) -> DataFrame:
    """Messages with a part of the payloads, prices and stamps unreadable."""
    messages = as_messages(quotes)
    value = (
        F.when(F.col("key") == "C0", F.lit("not json"))
        .when(F.col("key") == "C1", F.lit(None))
        .when(F.col("key") == "C2", F.regexp_replace("value", '"price_usd":', '"price_usd":"?","was":'))
        .when(F.col("key") == "C3", F.regexp_replace("value", '"timestamp":"', '"timestamp":"?'))
        .when(F.col("key") == "C4", F.regexp_replace("value", '"origin"', '"elsewhere"'))
        .otherwise(F.col("value"))
    )
    return messages.withColumn("value", value.cast("binary"))


def damaged_events(quotes: DataFrame) -> DataFrame:
    decoded = decode_quotes(damaged_messages(quotes), QUOTE)
    return decoded.select(*QUOTE.fieldNames(), "topic")


def streamed_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads that a stream could not read in full, as its archive keeps them. The
    stream is started twice from one checkpoint; the second run has nothing to do."""
    store, checkpoint = ParquetStore(scratch_path(spark, "stream")), scratch_path(spark, "checkpoint")
    for _ in range(2):
        quotes = decode_quotes(damaged_messages(event_stream(spark, sf_dir)), keep_damaged=True)
        runs.start_archive(quotes, store, checkpoint, {"availableNow": True}).awaitTermination()
    payload = F.col("payload").cast("string")
    field = lambda path: F.get_json_object(payload, path)
    return store.read(spark, UNREADABLE).select(
        "reason", "topic", F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"),
        F.when(payload == "not json", payload).alias("no_json"),
        field("$.airline_name").alias("airline_name"),
        field("$.was").cast("double").alias("price_was"),
        field("$.timestamp").alias("stamp"),
    )


def archived(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish to files, decode, archive, read the archive."""
    messages_path = scratch_path(spark, "messages")
    publish_files(event_quotes(spark, sf_dir), messages_path)
    messages = spark.read.parquet(messages_path).withColumn("timestamp", F.current_timestamp())
    store = ParquetStore(scratch_path(spark, "archive"))
    store.append(conform(decode_quotes(messages), "raw_flight_prices"), "raw_flight_prices")
    rows = store.read(spark, "raw_flight_prices")
    return presented(rows.select(*QUOTE.fieldNames(), "route_id", "topic", "date"))


def batch_table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reports, _ = batch_reports(star_quotes(spark, sf_dir))
        return presented(reports[name])

    return run


def batch_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch run's stored route statistics, in the types of the table."""
    store = ParquetStore(scratch_path(spark, "batch"))
    run_batch(event_quotes(spark, sf_dir), store)
    stored = store.read(spark, "batch_route_stats")
    return stored.select(
        *ROUTE,
        "min_price",
        "max_price",
        "flight_count",
        (F.col("execution_time") > 0).alias("timed"),
        F.col("created_at").isNotNull().alias("stamped"),
    )


def streamed(table: str, slide: str | None = None, watermark: str | None = None) -> Query:
    """Run the stream to its end, then read one of the stored reports."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = ParquetStore(scratch_path(spark, "stream"))
        query = runs.start_reports(
            event_stream(spark, sf_dir),
            store,
            scratch_path(spark, "checkpoint"),
            EVENT_WINDOW,
            slide,
            watermark,
            {"availableNow": True},
            tables=[table],
        )
        query.awaitTermination()
        return presented(store.read(spark, table).drop("created_at"))

    return run


def stream_against_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the stream to its end, then the batch, then compare what both have stored."""

    def stamped(df: DataFrame, table: str) -> DataFrame:
        return df.withColumn("created_at", F.current_timestamp())

    store = ParquetStore(scratch_path(spark, "both"))
    checkpoint = scratch_path(spark, "checkpoint")
    stream = event_stream(spark, sf_dir)
    now = {"availableNow": True}
    runs.start_reports(stream, store, checkpoint, EVENT_WINDOW, trigger=now, fit=stamped).awaitTermination()
    run_batch(event_quotes(spark, sf_dir), store, stamped)
    seconds = runs.stream_seconds(spark, store)
    first, second = (
        ql.compare_results(store.read(spark, streaming), store.read(spark, batch), query_type, seconds)
        for query_type, streaming, batch in COMPARED
    )
    timed = (F.col("streaming_execution_time") > 0).alias("timed")
    rows = first.unionAll(second)
    kept = [c for c in rows.columns if not c.endswith("_execution_time")]
    return presented(rows.select(*kept, timed))


def batch_without_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run and a comparison before any streamed result was stored, as stored."""
    store = ParquetStore(scratch_path(spark, "fresh"))
    run_batch(event_quotes(spark, sf_dir), store)
    run_comparison(spark, store, None)
    metrics = store.read(spark, "comparison_metrics")
    return presented(ql.latest_metrics(metrics).select(
        "query_type", "streaming_result_count", "batch_result_count", "streaming_avg_price",
        "price_diff_percentage"))


def vast_reports(report: Report) -> Query:
    """Prices up to 1e300; averages by their first nine digits."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = report(vast_quotes(spark, sf_dir))
        return found.withColumn("avg_price", F.format_string("%.8e", "avg_price"))

    return run


def merged_twice(quotes: DataFrame) -> DataFrame:
    """Route statistics by way of cells per window and airline."""
    cells = ql.fare_cells(quotes, window=EVENT_WINDOW).drop("window_start", "window_end")
    return stats_from_cells(ql.merge_cells(ql.merge_cells(cells, [*ROUTE, "airline"]), ROUTE))


def with_text_stamps(trends: DataFrame) -> DataFrame:
    return trends.withColumn("window_start", F.col("window_start").cast("string"))


def in_many_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive after one micro-batch per hour of the day, each repeated, and merges of its
    folders; then route statistics over it."""
    store = ParquetStore(scratch_path(spark, "merged"), readers=0, fan=4)
    quotes = conform(event_quotes(spark, sf_dir), ARCHIVE)
    for hour in range(24):
        rows = quotes.where(F.hour("timestamp") == hour)
        for _ in range(2):
            store.append_batch(rows, ARCHIVE, hour, "hours")
    if len(store.table(spark, ARCHIVE).current().live) > 6:
        raise AssertionError("folders were not merged")
    return presented(ql.route_stats(store.read(spark, ARCHIVE)))


def all_from_one_read(table: str, slide: str | None = None) -> Query:
    """The stream that archives the quotes and adds up cells, then a report from its sums."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store, checkpoint = ParquetStore(scratch_path(spark, "all")), scratch_path(spark, "checkpoint")
        now = {"availableNow": True}
        runs.start_all(event_stream(spark, sf_dir), store, checkpoint, EVENT_WINDOW, slide, now).awaitTermination()
        if table == ARCHIVE:
            return presented(store.read(spark, ARCHIVE).select(*QUOTE.fieldNames()))
        return presented(runs.stored_report(spark, store, table).drop("created_at"))

    return run


def streamed_plainly(slide: str | None = None) -> Query:
    """The cheapest airlines as a stream in append mode, written by Spark's file sink."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        best = best_airline_stream(event_stream(spark, sf_dir), EVENT_WINDOW, slide, "1 hour")
        path = scratch_path(spark, "best")
        writer = best.writeStream.format("parquet").option("path", path)
        writer = writer.option("checkpointLocation", scratch_path(spark, "checkpoint"))
        writer.trigger(availableNow=True).start().awaitTermination()
        return presented(spark.read.schema(best.schema).parquet(path))

    return run


def under_a_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream over a part of the quotes with one checkpoint, then over all with another."""
    store, now = ParquetStore(scratch_path(spark, "epochs")), {"availableNow": True}
    some = event_stream(spark, sf_dir).where("airline = 'C1'")
    for quotes in (some, event_stream(spark, sf_dir)):
        checkpoint = scratch_path(spark, "checkpoint")
        runs.start_reports(
            quotes, store, checkpoint, EVENT_WINDOW, trigger=now, tables=["route_stats"]).awaitTermination()
    return presented(store.read(spark, "route_stats").drop("created_at"))


def harsh_reports(report: Report) -> Query:
    """Prices of any size, fractions of a cent, unknown prices, averages and routes."""
    return lambda spark, sf_dir: coarsely(report(harsh_quotes(spark, sf_dir)))


def harsh_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Such quotes streamed into the archive, then reports over the archive."""
    store = ParquetStore(scratch_path(spark, "stream"))
    quotes = harsh(event_stream(spark, sf_dir))
    now = {"availableNow": True}
    runs.start_archive(quotes, store, scratch_path(spark, "checkpoint"), now).awaitTermination()
    return coarsely(ql.route_stats(store.read(spark, "raw_flight_prices")))


def coarsely(df: DataFrame) -> DataFrame:
    """Averages of prices up to billions have no six exact decimals."""
    return presented(df).withColumn("avg_price", F.round("avg_price", 3))


def best_by_tuples(quotes: DataFrame) -> DataFrame:
    """The cheapest airlines as a SQL user writes them, over the registered view."""
    view = register_view(quotes, "flight_prices")
    return view.sparkSession.sql("""
        WITH averages AS (
            SELECT origin, destination, airline, avg(cast(price_usd AS decimal(18,2))) AS avg_price,
                count(*) AS flight_count
            FROM flight_prices GROUP BY origin, destination, airline)
        SELECT origin, destination, airline, cast(avg_price AS double) AS avg_price, flight_count FROM averages
        WHERE (origin, destination, avg_price) IN (
            SELECT origin, destination, min(avg_price) FROM averages GROUP BY origin, destination)
    """)


def streamed_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = ParquetStore(scratch_path(spark, "stream"))
    messages = as_messages(event_stream(spark, sf_dir))
    query = runs.start_archive(
        decode_quotes(messages), store, scratch_path(spark, "checkpoint"), {"availableNow": True}
    )
    query.awaitTermination()
    rows = store.read(spark, "raw_flight_prices")
    return presented(rows.select(*QUOTE.fieldNames(), "topic", "kafka_timestamp"))


def streamed_cells(report: Report) -> Query:
    """Run the stream of changed cells to its end, then compute a report from them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        store = ParquetStore(scratch_path(spark, "stream"))
        checkpoint = scratch_path(spark, "checkpoint")
        trigger = {"availableNow": True}
        stream = event_stream(spark, sf_dir)
        runs.start_cells(stream, store, checkpoint, EVENT_WINDOW, trigger=trigger).awaitTermination()
        return presented(report(runs.latest_cells(store.read(spark, "fare_cells"))))

    return run


QUERIES: dict[str, Query] = {
    # Reports on the events.
    "route_stats": on_events(ql.route_stats),
    "route_stats_windowed": on_events(lambda q: ql.route_stats(q, EVENT_WINDOW)),
    "route_stats_sliding": on_events(lambda q: ql.route_stats(q, EVENT_WINDOW, EVENT_SLIDE)),
    "airline_averages": on_events(ql.airline_averages),
    "airline_averages_windowed": on_events(lambda q: ql.airline_averages(q, EVENT_WINDOW)),
    "price_rank": on_events(ql.price_rank),
    "price_rank_windowed": on_events(lambda q: ql.price_rank(q, EVENT_WINDOW)),
    "price_rank_in_slices": on_events(lambda q: ql.price_rank(q, EVENT_WINDOW, slices=8)),
    "best_airline": on_events(ql.best_airline),
    "best_airline_windowed": on_events(lambda q: ql.best_airline(q, EVENT_WINDOW)),
    "best_airline_sliding": on_events(lambda q: ql.best_airline(q, EVENT_WINDOW, EVENT_SLIDE)),
    "best_airline_semi": on_events(ql.best_airline_semi),
    "best_airline_semi_windowed": on_events(lambda q: ql.best_airline_semi(q, EVENT_WINDOW)),
    "price_trend_windowed": on_events(lambda q: ql.price_trend(q, EVENT_WINDOW)),
    "price_trend_sliding": on_events(lambda q: ql.price_trend(q, EVENT_WINDOW, EVENT_SLIDE)),
    "price_trend_daily": on_events(ql.price_trend_daily),
    "registered_view": on_events(best_by_sql),
    "registered_view_tuples": on_events(best_by_tuples),
    # Prices of any size; unknown prices, averages and routes.
    "harsh_route_stats": harsh_reports(ql.route_stats),
    "harsh_route_stats_sliding": harsh_reports(lambda q: ql.route_stats(q, EVENT_WINDOW, EVENT_SLIDE)),
    "harsh_airline_averages": harsh_reports(ql.airline_averages),
    "harsh_price_rank": harsh_reports(lambda q: ql.price_rank(q, slices=8)),
    "harsh_archive": harsh_archive,
    # Prices up to 1e300.
    "vast_route_stats": vast_reports(ql.route_stats),
    "vast_airline_averages": vast_reports(ql.airline_averages),
    "vast_merged_cells": vast_reports(merged_twice),
    # Reports whose order is a column.
    "price_trend_daily_numbered": on_events(lambda q: ql.price_trend_daily(q, row_numbers=True)),
    "trend_listing_numbered": on_events(lambda q: ql.trend_listing(ql.price_trend(q, EVENT_WINDOW), True)),
    "trend_series_numbered": on_events(lambda q: ql.trend_series(ql.price_trend(q, EVENT_WINDOW), True)),
    "trend_series_text_stamps": on_events(
        lambda q: ql.trend_series(with_text_stamps(ql.price_trend(q, EVENT_WINDOW)), True)),
    "best_airline_listing_numbered": on_events(lambda q: ql.best_airline_listing(stored_best(q), True)),
    # Listings and comparisons.
    "trend_listing": on_events(lambda q: ql.trend_listing(ql.price_trend(q, EVENT_WINDOW))),
    "trend_series": on_events(lambda q: ql.trend_series(ql.price_trend(q, EVENT_WINDOW))),
    "best_airline_listing": on_events(lambda q: ql.best_airline_listing(stored_best(q))),
    "latest_best": on_events(lambda q: ql.latest_best(stored_best(q))),
    "compare_route_stats": on_events(
        compared(ql.route_stats, "route_stats", EVENT_WINDOW, "2024-01-31", "15 days")
    ),
    "compare_best_airline": on_events(
        compared(ql.best_airline, "best_airlines", EVENT_WINDOW, "2024-01-31", "15 days")
    ),
    "latest_metrics": on_metrics(ql.latest_metrics),
    "comparison_summary": on_metrics(ql.comparison_summary),
    "comparison_summary_latest": on_metrics(lambda m: ql.comparison_summary(ql.latest_metrics(m))),
    # Messages and the archive.
    "publish_messages": on_events(published),
    "codec_round_trip": on_events(decoded_events),
    "decode_damaged": on_events(damaged_events),
    "raw_archive": archived,
    "batch_stored": batch_stored,
    # Streams.
    "stream_route_stats": streamed("route_stats"),
    "stream_best_airline": streamed("best_airlines"),
    "stream_price_trend": streamed("price_trends"),
    "stream_route_stats_sliding": streamed("route_stats", EVENT_SLIDE),
    "stream_route_stats_append": streamed("route_stats", watermark="1 hour"),
    "stream_best_airline_append": streamed("best_airlines", watermark="1 hour"),
    "stream_price_trend_append": streamed("price_trends", watermark="1 hour"),
    "stream_best_airline_sliding_append": streamed("best_airlines", EVENT_SLIDE, "1 hour"),
    "stream_raw_archive": streamed_archive,
    "stream_cells_route_stats": streamed_cells(lambda c: stats_from_cells(ql.merge_cells(c, ROUTE))),
    "stream_cells_best_airline": streamed_cells(lambda c: cheapest(averages_from_cells(c))),
    "stream_batch_comparison": stream_against_batch,
    "batch_without_stream": batch_without_stream,
    "stream_best_airline_plain": streamed_plainly(),
    "stream_best_airline_plain_sliding": streamed_plainly(EVENT_SLIDE),
    "stream_unreadable_payloads": streamed_unreadable,
    "stream_new_checkpoint": under_a_new_checkpoint,
    "stream_all_archive": all_from_one_read(ARCHIVE),
    "stream_all_route_stats": all_from_one_read("route_stats"),
    "stream_all_route_stats_sliding": all_from_one_read("route_stats", EVENT_SLIDE),
    "stream_all_best_airline": all_from_one_read("best_airlines"),
    "archive_in_many_batches": in_many_batches,
    # Reports on the star schema.
    "star_route_stats": on_star(ql.route_stats),
    "star_route_stats_windowed": on_star(lambda q: ql.route_stats(q, STAR_WINDOW)),
    "star_route_stats_sliding": on_star(lambda q: ql.route_stats(q, STAR_WINDOW, STAR_SLIDE)),
    "star_airline_averages": on_star(ql.airline_averages),
    "star_price_rank": on_star(ql.price_rank),
    "star_price_rank_in_slices": on_star(lambda q: ql.price_rank(q, slices=8)),
    "star_best_airline": on_star(ql.best_airline),
    "star_best_airline_windowed": on_star(lambda q: ql.best_airline(q, STAR_WINDOW)),
    "star_best_airline_semi": on_star(lambda q: ql.best_airline_semi(q, STAR_WINDOW)),
    "star_price_trend_windowed": on_star(lambda q: ql.price_trend(q, STAR_WINDOW)),
    "star_price_trend_daily": on_star(ql.price_trend_daily),
    "star_trend_series": on_star(lambda q: ql.trend_series(ql.price_trend(q, STAR_WINDOW))),
    "star_compare_route_stats": on_star(
        compared(ql.route_stats, "route_stats", STAR_WINDOW, "2001-12-31", "1000 days")
    ),
    "star_compare_best_airline": on_star(
        compared(ql.best_airline, "best_airlines", STAR_WINDOW, "2001-12-31", "1000 days")
    ),
    "star_batch_route_stats": batch_table("batch_route_stats"),
    "star_batch_best_airlines": batch_table("batch_best_airlines"),
}
