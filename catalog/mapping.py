"""The driver's tables seen as quotes."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_quotes(events: DataFrame) -> DataFrame:
    """Events as quotes with a fine event time: 15 routes, 7 airlines."""
    return events.select(
        F.col("event_type").alias("origin"),
        F.expr("concat('G', user_id % 3)").alias("destination"),
        F.expr("concat('C', user_id % 7)").alias("airline"),
        F.expr("concat('Carrier ', user_id % 7)").alias("airline_name"),
        F.col("value").alias("price_usd"),
        F.col("ts").alias("timestamp"),
    )


def event_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_quotes(table(spark, sf_dir, "events"))


def harsh(quotes: DataFrame) -> DataFrame:
    """The same quotes with very large and very fine prices, and with unknown values: a
    price for every eleventh second and for one airline on one route, a route for some."""
    second = F.unix_seconds(F.col("timestamp").cast("timestamp")) % 11
    price = (
        F.when((second == 0) | ((F.col("airline") == "C3") & (F.col("destination") == "G1")), None)
        .when(F.col("airline") == "C0", F.col("price_usd") * 1e7)
        .when(F.col("airline") == "C1", F.col("price_usd") / 1000)
        .otherwise(F.col("price_usd"))
    )
    origin = F.when(second == 5, None).otherwise(F.col("origin"))
    return quotes.withColumns({"price_usd": price, "origin": origin})


def harsh_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harsh(event_quotes(spark, sf_dir))


def vast_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same quotes with prices of any size: some of 1e300, some too large for 64 bits."""
    quotes = event_quotes(spark, sf_dir)
    second = F.unix_seconds(F.col("timestamp").cast("timestamp")) % 11
    price = (
        F.when((F.col("airline") == "C2") & (second == 0), F.lit(1e300))
        .when(F.col("airline") == "C0", F.col("price_usd") * 1e22)
        .when(F.col("airline") == "C4", F.col("price_usd") * 1e12)
        .otherwise(F.col("price_usd"))
    )
    return quotes.withColumn("price_usd", price)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same quotes as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return as_quotes(files.parquet(sf_dir))


def star_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as quotes: routes are region pairs, airlines are suppliers.

    Orders meet customers before they meet the line items, so that the largest table
    is shuffled by order key once. Those two are both too large to broadcast, hence
    the merge join, which spills and whose skewed keys are split. Customers and
    suppliers are joined as plain tables: Spark knows their size and broadcasts them
    only below its limit. Nation and region have 25 and 5 rows at any scale.
    """
    places = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_name")
    )
    destinations = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", F.col("r_name").alias("destination"))
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(destinations.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("r_name").alias("origin"),
            "destination",
            F.expr("concat('S', s_suppkey)").alias("airline"),
            F.col("s_name").alias("airline_name"),
            F.col("l_extendedprice").alias("price_usd"),
            F.col("l_shipdate").alias("timestamp"),
        )
    )


def event_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a log of comparison results, one per event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("query_type"),
        F.expr("cast(60 + user_id % 50 as double)").alias("streaming_execution_time"),
        F.col("value").alias("batch_execution_time"),
        F.col("user_id").alias("streaming_result_count"),
        F.expr("user_id % 25").alias("batch_result_count"),
        F.col("value").alias("streaming_avg_price"),
        F.expr("value + 1").alias("batch_avg_price"),
        F.expr("value / 8").alias("price_diff_percentage"),
        F.col("ts").alias("comparison_timestamp"),
    )
