"""Sending encoded quotes."""

from pyspark.sql import DataFrame

from quotelane.functions.codec import encode_quotes

# Kafka takes no message without a topic, so quotes of unknown routes need one.
OTHER_TOPIC = "unrouted_prices"


def publish_kafka(quotes: DataFrame, servers: str, other_topic: str = OTHER_TOPIC, **options: str) -> None:
    """Send each quote to its route's topic, or to ``other_topic`` if an end of its route
    is unknown (needs the Kafka connector)."""
    writer = encode_quotes(quotes, other_topic=other_topic).write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).options(**options).save()


def publish_files(quotes: DataFrame, path: str, other_topic: str | None = OTHER_TOPIC) -> None:
    """Write the messages as Parquet files with the same three columns."""
    encode_quotes(quotes, other_topic=other_topic).write.mode("append").parquet(path)
