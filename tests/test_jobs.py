import pytest
from pyspark.sql import functions as F

from quotelane.jobs import batch, publish, report, stream
from quotelane.jobs.options import open_store, parser
from quotelane.schema import TABLES
from quotelane.session import build_session
from quotelane.sinks.stores import JdbcStore, ParquetStore
from test_streaming import Feed, payloads, run


def test_stream_then_batch_then_report(spark, tmp_path, capsys):
    """The whole life of a quote, with state in RocksDB and the types of the stored tables."""
    build_session("test")
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    feed = Feed(spark, tmp_path)
    store = ParquetStore(str(tmp_path / "store"))
    feed.add(payloads(range(0, 30)))
    feed.add(payloads(range(30, 60)))
    from quotelane.sinks.columns import conform
    from quotelane.streaming import runs

    run(feed, store, tmp_path, fit=conform)
    now = {"availableNow": True}
    runs.start_archive(feed.quotes(), store, str(tmp_path / "checkpoints"), now).awaitTermination()
    for table in ("route_stats", "best_airlines", "price_trends"):
        assert dict(store.read(spark, table).dtypes) == TABLES[table]

    batch.main(["--store", store.root, "--stream-seconds", "3"])
    metrics = {row.query_type: row for row in store.read(spark, "comparison_metrics").collect()}
    assert metrics["route_stats"].streaming_result_count == 12
    assert metrics["route_stats"].batch_result_count == 2
    assert metrics["best_airlines"].batch_execution_time > 0

    report.main(["--store", store.root])
    printed = capsys.readouterr().out
    for title in ("Price trends", "Cheapest airlines", "Latest comparisons", "Comparison summary"):
        assert title in printed
    assert "JFK-LAX" in printed


def test_publish_and_whole_reports(spark, quotes, tmp_path, capsys):
    rows = [("JFK", "LAX", f"A{i}", 10.0 + i, "2024-01-01T00:00:00") for i in range(70)]
    df = quotes([*rows, (None, "LAX", "A", 1.0, "2024-01-01T00:00:00")])
    df.write.parquet(str(tmp_path / "quotes"))
    publish.main(["--quotes", str(tmp_path / "quotes"), "--files", str(tmp_path / "messages"), "--other-topic", "rest"])
    topics = {r["topic"]: r["count"] for r in spark.read.parquet(str(tmp_path / "messages")).groupBy("topic").count().collect()}
    assert topics == {"jfk_lax_prices": 70, "rest": 1}

    from quotelane.operators.ranking import rank_averages
    from quotelane.operators.aggregates import airline_averages
    from quotelane.sinks.columns import conform

    store = ParquetStore(str(tmp_path / "store"))
    best = rank_averages(airline_averages(df, "30 minutes")).withColumn("price_rank", F.lit(1))
    store.append(conform(best, "best_airlines"), "best_airlines")
    report.main(["--store", store.root, "--rows", "5", "--output", str(tmp_path / "out")])
    assert "only showing top 5 rows" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out" / "cheapest_airlines")).count() == 70


def test_store_options():
    options = parser("x")
    assert isinstance(open_store(options.parse_args(["--store", "/folder"])), ParquetStore)
    given = options.parse_args(["--store", "jdbc:x:y", "--property", "user=u", "--property", "password=a=b"])
    store = open_store(given)
    assert isinstance(store, JdbcStore)
    assert store.properties == {"user": "u", "password": "a=b"}


def test_batch_job_splits_a_database_scan(monkeypatch):
    seen = {}
    monkeypatch.setattr(batch, "build_session", lambda name: None)
    monkeypatch.setattr(JdbcStore, "read", lambda store, spark, table, **split: seen.update(split))
    monkeypatch.setattr(batch, "run_batch", lambda quotes, store: None)
    monkeypatch.setattr(batch, "run_comparison", lambda *a, **k: None)
    bounds = ["--column", "timestamp", "--lower", "2024-01-01", "--upper", "2024-02-01", "--partitions", "64"]
    batch.main(["--store", "jdbc:x", *bounds])
    assert seen == {"column": "timestamp", "lower": "2024-01-01", "upper": "2024-02-01", "partitions": 64}


@pytest.fixture
def started(spark, tmp_path, monkeypatch):
    """Runs the stream job without a broker; gives what it started."""
    Feed(spark, tmp_path).add(payloads([0]))

    def main(*options):
        calls, reading = [], {}

        def read(spark, servers, topics, **options):
            reading.update(options, servers=servers, topics=topics)
            return Feed(spark, tmp_path).messages()

        monkeypatch.setattr(stream, "read_kafka_stream", read)
        for name in ("start_reports", "start_archive", "start_cells", "start_all"):
            monkeypatch.setattr(stream.runs, name, lambda *a, name=name, **k: calls.append((name, a, k)))
        monkeypatch.setattr(stream.runs, "await_any", lambda session: calls.append(("awaited",)))
        stream.main(["--servers", "h:1", "--topics", "a", "b", *options])
        return reading, calls

    return main


def test_stream_job_wires_its_options(started, tmp_path):
    at = ["--store", str(tmp_path / "s")]
    reading, (reports, archive, last) = started(*at, "--watermark", "1 hour", "--kafka", "maxOffsetsPerTrigger=9")
    assert reading == {"servers": "h:1", "topics": ["a", "b"], "starting_offsets": "latest", "maxOffsetsPerTrigger": "9"}
    assert reports[0] == "start_reports" and archive[0] == "start_archive" and last == ("awaited",)
    assert reports[1][3:] == ("30 minutes", None, "1 hour", {"processingTime": "1 minute"})
    assert reports[1][2].endswith("/quotelane/streams") and archive[1][2] == reports[1][2]


@pytest.mark.parametrize(
    "options, names",
    [
        ([], ["start_all"]),
        (["--slide", "10 minutes"], ["start_all"]),
        (["--slide", "29 minutes"], ["start_reports", "start_archive"]),
        (["--reports"], ["start_reports", "start_archive"]),
        (["--changed-cells"], ["start_cells", "start_archive"]),
        (["--store", "jdbc:x"], ["start_reports", "start_archive"]),
    ],
)
def test_stream_job_chooses_how_reports_are_kept(started, tmp_path, options, names):
    _, calls = started("--store", str(tmp_path / "s"), *options)
    assert [c[0] for c in calls] == [*names, "awaited"]


def test_batch_and_report_after_a_stream_of_sums(spark, tmp_path, capsys):
    from quotelane.streaming import runs

    feed, store = Feed(spark, tmp_path), ParquetStore(str(tmp_path / "store"))
    feed.add(payloads(range(0, 60)))
    now = {"availableNow": True}
    runs.start_all(feed.quotes(), store, str(tmp_path / "c"), "10 minutes", trigger=now).awaitTermination()
    batch.main(["--store", store.root])
    metrics = {row.query_type: row for row in store.read(spark, "comparison_metrics").collect()}
    assert metrics["route_stats"].streaming_result_count == 12
    assert metrics["route_stats"].streaming_execution_time > 0
    report.main(["--store", store.root, "--output", str(tmp_path / "out")])
    assert "JFK-LAX" in capsys.readouterr().out
    trends = spark.read.parquet(str(tmp_path / "out" / "price_trends")).orderBy("row_number").collect()
    assert [r.row_number for r in trends] == list(range(1, 13))
    assert [(r.route, r.window_start) for r in trends] == sorted((r.route, r.window_start) for r in trends)
