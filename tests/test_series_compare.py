from datetime import datetime

import pytest
from pyspark.sql import functions as F

import quotelane as ql
from conftest import rows_of
from quotelane.operators.ordering import numbered
from quotelane.operators.compare import METRIC_COLUMNS

BEST = "origin string, destination string, airline string, airline_name string, avg_price double, window_start timestamp, price_rank int"
NOW = datetime(2024, 1, 1, 12)


def at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def test_latest_best_takes_the_last_known_value(spark):
    rows = [
        ("A", "B", "x", "X Air", 10.0, at(1), 1),
        ("A", "B", "x", None, 20.0, at(2), 1),
        ("A", "B", "x", "X2 Air", None, at(3), 1),
        ("A", "B", "y", None, None, at(3), 1),
        (None, "B", "x", "X Air", 1.0, at(9), 1),
        ("A", "B", None, "X Air", 1.0, at(9), 1),
    ]
    latest = ql.latest_best(spark.createDataFrame(rows, BEST))
    assert rows_of(latest, "airline", "airline_name", "avg_price", "window_start", "route") == [
        ("x", "X2 Air", 20.0, at(3), "A-B"),
        ("y", None, None, at(3), "A-B"),
    ]


def test_listing_keeps_rank_one_in_order(spark):
    rows = [
        ("B", "C", "x", "n", 1.0, at(1), 1),
        ("A", "C", "x", "n", 1.0, at(2), 1),
        ("A", "C", "y", "n", 2.0, at(1), 2),
        ("A", "C", "z", "n", 3.0, at(1), 1),
        (None, "C", "z", "n", 3.0, at(1), 1),
    ]
    listed = ql.best_airline_listing(spark.createDataFrame(rows, BEST)).collect()
    assert [(r.origin, r.airline) for r in listed] == [("A", "z"), ("A", "x"), ("B", "x"), (None, "z")]


def test_series_is_labelled_and_parses_text_stamps(spark):
    schema = "origin string, destination string, window_start string, avg_price double"
    rows = [("A", "B", "2024-01-01 02:00:00", 2.0), ("A", "B", "2024-01-01 01:00:00", 1.0), (None, "B", None, 3.0)]
    trends = spark.createDataFrame(rows, schema)
    series = ql.trend_series(trends).collect()
    assert [(r.route, r.window_start, r.avg_price) for r in series] == [("A-B", at(1), 1.0), ("A-B", at(2), 2.0)]
    assert [r.origin for r in ql.trend_listing(trends).collect()] == ["A", "A", None]


@pytest.fixture
def sides(spark):
    def make(stream, batch):
        return (
            spark.createDataFrame(stream, "avg_price double, created_at timestamp"),
            spark.createDataFrame(batch, "avg_price double, created_at timestamp, execution_time double"),
        )

    return make


def compare(stream, batch):
    return ql.compare_results(stream, batch, "route_stats", 1800, as_of=NOW).first()


def test_comparison_uses_the_last_hour_only(sides):
    row = compare(
        *sides(
            [(100.0, at(11, 30)), (300.0, at(11, 1)), (900.0, at(11)), (900.0, at(9))],
            [(150.0, at(11, 59), 2.0), (150.0, at(11, 59), 4.0), (1.0, at(1), 99.0)],
        )
    )
    assert row.streaming_result_count == 2 and row.batch_result_count == 2
    assert (row.streaming_avg_price, row.batch_avg_price) == (200.0, 150.0)
    assert (row.streaming_execution_time, row.batch_execution_time) == (1800.0, 3.0)
    assert row.price_diff_percentage == 25.0


def test_comparison_with_an_empty_side(sides):
    no_stream = compare(*sides([], [(150.0, at(11, 59), 2.0)]))
    assert (no_stream.streaming_result_count, no_stream.price_diff_percentage) == (0, 0.0)
    no_batch = compare(*sides([(150.0, at(11, 59))], []))
    assert (no_batch.batch_result_count, no_batch.price_diff_percentage) == (0, None)
    nothing = compare(*sides([], []))
    assert nothing.streaming_avg_price is None and nothing.price_diff_percentage == 0.0


def test_comparison_joins_nothing(sides):
    frame = ql.compare_results(*sides([], []), "route_stats", 1800)
    assert "Join" not in frame._jdf.queryExecution().executedPlan().toString()


def test_recency_filter_reaches_the_files(spark, sides, tmp_path):
    stream, batch = sides([(150.0, at(11, 59))], [(150.0, at(11, 59), 1.0)])
    stream.write.parquet(str(tmp_path / "stream"))
    stored = spark.read.parquet(str(tmp_path / "stream"))
    frame = ql.compare_results(stored, batch, "route_stats", 1800)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(created_at" in plan


@pytest.fixture
def metrics(spark):
    rows = [("route_stats" if i % 3 else None, 10.0 * (i % 2), float(i), i, i, 1.0, 1.0, float(i), at(i % 24, i)) for i in range(20)]
    columns = "query_type string, s double, b double, sc long, bc long, sa double, ba double, d double, t timestamp"
    return spark.createDataFrame(rows, columns).toDF(*METRIC_COLUMNS, "comparison_timestamp")


def test_latest_metrics(metrics):
    latest = ql.latest_metrics(metrics).collect()
    assert [row.streaming_result_count for row in latest] == list(range(19, 9, -1))
    plan = ql.latest_metrics(metrics)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_summary_leaves_out_unnamed_types(metrics):
    rows = ql.comparison_summary(metrics).collect()
    known = [i for i in range(20) if i % 3]
    mean = sum(known) / len(known)
    streaming = 10.0 * sum(i % 2 for i in known) / len(known)
    assert len(rows) == 1
    assert rows[0].batch == pytest.approx(mean)
    assert rows[0].speedup == pytest.approx(mean / streaming)


def test_speedup_over_no_time_is_unknown(metrics):
    idle = metrics.withColumn("streaming_execution_time", F.lit(0.0))
    assert rows_of(ql.comparison_summary(idle), "speedup") == [(None,)]


@pytest.mark.parametrize("parts", [1, 5])
def test_row_numbers_over_all_partitions(spark, parts):
    rows = [(k * 7919 % 500, None if k % 50 == 0 else f"n{k % 7}") for k in range(500)]
    df = spark.createDataFrame(rows, "k int, name string").repartition(parts)
    order = [F.asc_nulls_last("name"), F.desc("k")]
    found = sorted(numbered(df, order).collect(), key=lambda r: r.row_number)
    assert [r.row_number for r in found] == list(range(1, 501))
    assert [(r.k, r.name) for r in found] == sorted(rows, key=lambda r: (r[1] is None, r[1] or "", -r[0]))
    assert numbered(df.where("false"), order).collect() == []
