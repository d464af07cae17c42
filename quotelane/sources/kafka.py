"""Quote messages from Kafka (needs the Kafka connector on the class path)."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    servers: str,
    topics: Iterable[str],
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Reader options; ``extra`` may hold e.g. ``minPartitions`` to split large topics."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **extra,
    }


def read_kafka_stream(spark: SparkSession, servers: str, topics: Iterable[str], **options) -> DataFrame:
    """One stream over all ``topics``; pass it to ``decode_quotes``."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topics, **options)).load()
