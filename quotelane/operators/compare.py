"""Streaming results against batch results."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelane.functions.measures import percent_difference, ratio
from quotelane.schema import LOAD_STAMPS, TABLES

METRIC_COLUMNS = [name for name in TABLES["comparison_metrics"] if name not in LOAD_STAMPS]


def compare_results(
    stream: DataFrame,
    batch: DataFrame,
    query_type: str,
    stream_seconds: float,
    as_of: Column | datetime | None = None,
    within: str = "1 hour",
) -> DataFrame:
    """One row on the results stored ``within`` the time before ``as_of``.

    Both sides go through one aggregate, which returns a row even without input.
    """
    now = F.current_timestamp() if as_of is None else as_of
    now = now if isinstance(now, Column) else F.lit(now)
    recent = F.col("created_at") > now - F.expr(f"INTERVAL {within}")
    no_time = F.lit(None).cast("double").alias("execution_time")
    price = F.col("avg_price").cast("double").alias("avg_price")
    time = F.col("execution_time").cast("double").alias("execution_time")
    rows = (
        stream.where(recent)
        .select(F.lit(True).alias("streamed"), price, no_time)
        .unionAll(batch.where(recent).select(F.lit(False), price, time))
    )
    streamed = F.col("streamed")
    totals = rows.agg(
        F.count_if(streamed).alias("streaming_result_count"),
        F.count_if(~streamed).alias("batch_result_count"),
        F.avg(F.when(streamed, F.col("avg_price"))).alias("streaming_avg_price"),
        F.avg(F.when(~streamed, F.col("avg_price"))).alias("batch_avg_price"),
        F.avg("execution_time").alias("batch_execution_time"),
    )
    difference = percent_difference(F.col("streaming_avg_price"), F.col("batch_avg_price"))
    return (
        totals.withColumn("query_type", F.lit(query_type))
        .withColumn("streaming_execution_time", F.lit(float(stream_seconds)))
        .withColumn("price_diff_percentage", difference)
        .select(*METRIC_COLUMNS)
    )


def latest_metrics(metrics: DataFrame, rows: int = 10) -> DataFrame:
    """The newest comparison rows."""
    newest = F.desc_nulls_first("comparison_timestamp")
    return metrics.select(*METRIC_COLUMNS, "comparison_timestamp").orderBy(newest).limit(rows)


def comparison_summary(metrics: DataFrame) -> DataFrame:
    """Mean times, speedup and mean price difference per query type."""
    means = (
        metrics.where("query_type IS NOT NULL")
        .groupBy("query_type")
        .agg(
            F.avg("streaming_execution_time").alias("streaming"),
            F.avg("batch_execution_time").alias("batch"),
            F.avg("price_diff_percentage").alias("price_diff"),
        )
    )
    speedup = ratio(F.col("batch"), F.col("streaming")).alias("speedup")
    return means.select("query_type", "streaming", "batch", speedup, "price_diff")
