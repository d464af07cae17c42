"""Quote messages: JSON payloads with a key and a topic."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelane.functions.routes import route_label, route_topic
from quotelane.schema import QUOTE_FULL

# Fixed values of the message format.
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
UNKNOWN_KEY = "unknown"
DAMAGED, DAMAGED_PAYLOAD = "_damaged", "damaged_payload"


def decode_quotes(
    messages: DataFrame, schema: T.StructType = QUOTE_FULL, keep_damaged: bool = False
) -> DataFrame:
    """Messages (``value``, ``topic``, ``timestamp``) to quotes, one row for one row.

    Decoding is permissive: an unreadable payload gives NULL fields, an unreadable
    field is NULL by itself. The broker's stamp is kept as ``kafka_timestamp``. With
    ``keep_damaged`` the payloads that were not read in full stay in ``damaged_payload``,
    byte for byte; it is NULL for all others, and for messages without a payload.
    """
    read = T.StructType([*schema.fields, T.StructField(DAMAGED, T.StringType())]) if keep_damaged else schema
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), read, {"columnNameOfCorruptRecord": DAMAGED}).alias("data"),
        "topic",
        F.col("timestamp").alias("kafka_timestamp"),
        *([F.col("value").cast("binary").alias("payload")] if keep_damaged else []),
    )
    if not keep_damaged:
        return parsed.select("data.*", "topic", "kafka_timestamp")
    whole = F.col("data").isNotNull() & F.col(f"data.{DAMAGED}").isNull()
    damaged = F.when(~whole, F.col("payload")).alias(DAMAGED_PAYLOAD)
    return parsed.select(*[f"data.{f}" for f in schema.names], "topic", "kafka_timestamp", damaged)


def without_payloads(quotes: DataFrame) -> DataFrame:
    return quotes.drop(DAMAGED_PAYLOAD)


def damaged_payloads(quotes: DataFrame, schema: T.StructType = QUOTE_FULL) -> DataFrame:
    """The payloads that ``decode_quotes`` kept, and whether any field could be read."""
    known = [f for f in schema.names if f in quotes.columns]
    some = F.coalesce(*[F.col(f).cast("string") for f in known]).isNotNull()
    reason = F.when(some, F.lit("unreadable field")).otherwise(F.lit("unreadable payload"))
    kept = quotes.where(F.col(DAMAGED_PAYLOAD).isNotNull())
    return kept.select(F.col(DAMAGED_PAYLOAD).alias("payload"), reason.alias("reason"), "topic", "kafka_timestamp")


def flatten_metadata(quotes: DataFrame) -> DataFrame:
    """Replace ``_metadata`` with its two fields."""
    kept = [name for name in quotes.columns if name != "_metadata"]
    return quotes.select(*kept, "_metadata.producer_timestamp", "_metadata.route_id")


def message_metadata(published_at: Column | None = None) -> Column:
    at = F.current_timestamp() if published_at is None else published_at
    return F.struct(
        (F.unix_micros(at.cast("timestamp")) / 1e6).alias("producer_timestamp"),
        route_label().alias("route_id"),
    )


def encode_quotes(
    quotes: DataFrame, published_at: Column | None = None, other_topic: str | None = None
) -> DataFrame:
    """Quotes to messages with ``key``, ``value`` and ``topic``.

    The key is the airline, so that one airline's quotes of a route stay in order. A quote
    whose route has an unknown end has the topic ``other_topic``, NULL if none is given.
    """
    fields = [f.name for f in QUOTE_FULL.fields if f.name in quotes.columns]
    fields = [name for name in fields if name != "_metadata"]
    body = F.struct(*fields, message_metadata(published_at).alias("_metadata"))
    options = {"timestampFormat": STAMP_FORMAT, "timestampNTZFormat": STAMP_FORMAT}
    return quotes.select(
        F.coalesce(F.col("airline"), F.lit(UNKNOWN_KEY)).alias("key"),
        F.to_json(body, options).alias("value"),
        F.coalesce(route_topic(), F.lit(other_topic)).alias("topic"),
    )
