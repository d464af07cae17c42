import json
from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows_of
from quotelane.functions.codec import decode_quotes, encode_quotes, flatten_metadata
from quotelane.schema import QUOTE, QUOTE_FULL
from quotelane.sinks.publish import publish_files

FULL = {
    "airline": "DL",
    "airline_name": "Delta",
    "flight_number": "DL10",
    "origin": "JFK",
    "destination": "LAX",
    "departure_date": "2024-01-02",
    "departure_time": "06:15:00",
    "arrival_time": "09:45:00",
    "duration_minutes": 210,
    "price_usd": 300,
    "seats_available": 7,
    "timestamp": "2024-01-01T10:00:00.123456",
    "_metadata": {"producer_timestamp": 1704103200.5, "route_id": "JFK-LAX"},
}
MESSAGES = "key binary, value binary, topic string, timestamp timestamp"


def decoded(spark, *payloads, schema=QUOTE_FULL):
    rows = [
        (b"k", p if p is None or isinstance(p, bytes) else json.dumps(p).encode(), "t", datetime(2024, 1, 1))
        for p in payloads
    ]
    return decode_quotes(spark.createDataFrame(rows, MESSAGES), schema)


def test_whole_message(spark):
    row = flatten_metadata(decoded(spark, FULL)).first()
    assert row.price_usd == 300.0 and row.duration_minutes == 210
    assert row.timestamp == datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert (row.producer_timestamp, row.route_id) == (1704103200.5, "JFK-LAX")
    assert (row.topic, row.kafka_timestamp) == ("t", datetime(2024, 1, 1))


def test_damage_stays_where_it_is(spark):
    bad_fields = {**FULL, "price_usd": "?", "timestamp": "?"}
    short = {"origin": "JFK", "price_usd": 1.5}
    rows = decoded(spark, bad_fields, short, b"garbage", None, schema=QUOTE).collect()
    assert (rows[0].origin, rows[0].price_usd, rows[0].timestamp) == ("JFK", None, None)
    assert (rows[1].origin, rows[1].price_usd, rows[1].airline) == ("JFK", 1.5, None)
    for row in rows[2:]:
        assert all(row[name] is None for name in QUOTE.fieldNames()) and row.topic == "t"


def test_round_trip(spark):
    quotes = decoded(spark, FULL).drop("topic", "kafka_timestamp")
    sent = encode_quotes(quotes, F.lit(datetime(2024, 1, 1, 10, 0, 0, 500000)))
    row = sent.first()
    assert (row.key, row.topic) == ("DL", "jfk_lax_prices")
    assert json.loads(row.value)["timestamp"] == FULL["timestamp"]
    back = decode_quotes(sent.withColumn("timestamp", F.current_timestamp()))
    names = [name for name in quotes.columns if name != "_metadata"]
    assert rows_of(back, *names) == rows_of(quotes, *names)
    assert back.first()["_metadata"].producer_timestamp == 1704103200.5
    assert back.first()["_metadata"].route_id == "JFK-LAX"


def test_topics_and_unknown_airline(quotes):
    rows = [("ORD", "MIA", None, 1.0, None), ("SFO", "SEA", "UA", 1.0, None)]
    assert rows_of(encode_quotes(quotes(rows)), "key", "topic") == [
        ("UA", "sfo_sea_prices"),
        ("unknown", "ord_mia_prices"),
    ]


def test_publish_files(spark, quotes, tmp_path):
    path = str(tmp_path / "messages")
    publish_files(quotes([("ORD", "MIA", "AA", 1.0, None)]), path)
    assert spark.read.parquet(path).columns == ["key", "value", "topic"]
