"""Fixed schemas. Nothing is inferred from data.

The field names, types and decimal sizes below are fixed values: messages and
stored tables must keep them to stay readable by existing producers and readers.
"""

from pyspark.sql import types as T

ROUTE = ["origin", "destination"]
CARRIER = ["airline", "airline_name"]

# What the reports need from a quote.
QUOTE = T.StructType(
    [
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("airline", T.StringType()),
        T.StructField("airline_name", T.StringType()),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# The whole JSON message.
QUOTE_FULL = T.StructType(
    [
        T.StructField("airline", T.StringType()),
        T.StructField("airline_name", T.StringType()),
        T.StructField("flight_number", T.StringType()),
        T.StructField("origin", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("departure_date", T.StringType()),
        T.StructField("departure_time", T.StringType()),
        T.StructField("arrival_time", T.StringType()),
        T.StructField("duration_minutes", T.IntegerType()),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("seats_available", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField(
            "_metadata",
            T.StructType(
                [
                    T.StructField("producer_timestamp", T.DoubleType()),
                    T.StructField("route_id", T.StringType()),
                ]
            ),
        ),
    ]
)

# Column types of the stored tables, load stamp last: those of the decoded quotes and of the
# reports, so nothing is lost or rounded in a store. Counts are long, as a busy route has
# more quotes than an int can count.
TABLES = {
    "raw_flight_prices": {
        "airline": "string",
        "airline_name": "string",
        "flight_number": "string",
        "origin": "string",
        "destination": "string",
        "departure_date": "string",
        "departure_time": "string",
        "arrival_time": "string",
        "duration_minutes": "int",
        "price_usd": "double",
        "seats_available": "int",
        "timestamp": "timestamp",
        "producer_timestamp": "double",
        "route_id": "string",
        "topic": "string",
        "kafka_timestamp": "timestamp",
        "inserted_at": "timestamp",
    },
    "route_stats": {
        "origin": "string",
        "destination": "string",
        "window_start": "timestamp",
        "window_end": "timestamp",
        "min_price": "double",
        "max_price": "double",
        "avg_price": "double",
        "flight_count": "bigint",
        "created_at": "timestamp",
    },
    "best_airlines": {
        "origin": "string",
        "destination": "string",
        "window_start": "timestamp",
        "window_end": "timestamp",
        "airline": "string",
        "airline_name": "string",
        "avg_price": "double",
        "flight_count": "bigint",
        "price_rank": "int",
        "created_at": "timestamp",
    },
    "price_trends": {
        "origin": "string",
        "destination": "string",
        "window_start": "timestamp",
        "window_end": "timestamp",
        "avg_price": "double",
        "created_at": "timestamp",
    },
    "batch_route_stats": {
        "origin": "string",
        "destination": "string",
        "min_price": "double",
        "max_price": "double",
        "avg_price": "double",
        "flight_count": "bigint",
        "execution_time": "double",
        "created_at": "timestamp",
    },
    "batch_best_airlines": {
        "origin": "string",
        "destination": "string",
        "airline": "string",
        "airline_name": "string",
        "avg_price": "double",
        "flight_count": "bigint",
        "price_rank": "int",
        "execution_time": "double",
        "created_at": "timestamp",
    },
    "stream_times": {"seconds": "double"},
    "comparison_metrics": {
        "query_type": "string",
        "streaming_execution_time": "double",
        "batch_execution_time": "double",
        "streaming_result_count": "bigint",
        "batch_result_count": "bigint",
        "streaming_avg_price": "double",
        "batch_avg_price": "double",
        # A double: a two-digit-scale decimal of five digits cannot hold 1000 %.
        "price_diff_percentage": "double",
        "comparison_timestamp": "timestamp",
    },
}

# Types of columns in a database, where they are narrower.
DATABASE_TYPES = {
    "price_usd": "decimal(10,2)",
    "min_price": "decimal(10,2)",
    "max_price": "decimal(10,2)",
    "avg_price": "decimal(10,2)",
    "streaming_avg_price": "decimal(10,2)",
    "batch_avg_price": "decimal(10,2)",
    "execution_time": "decimal(10,3)",
    "streaming_execution_time": "decimal(10,3)",
    "batch_execution_time": "decimal(10,3)",
    "producer_timestamp": "decimal(20,6)",
    "departure_date": "date",
}

# Bounded string sizes, used only where a database creates the table.
STRING_SIZES = {
    "airline": 10,
    "airline_name": 100,
    "flight_number": 10,
    "origin": 3,
    "destination": 3,
    "route_id": 7,
    "topic": 50,
    "query_type": 50,
}

LOAD_STAMPS = ("inserted_at", "created_at", "comparison_timestamp")
