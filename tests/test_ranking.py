import re
from collections import Counter
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import quotelane as ql
from catalog.mapping import event_quotes, star_quotes
from conftest import SMALL, rows_of
from quotelane.operators.ranking import cheapest, rank_averages
from quotelane.session import materialize

T0 = "2024-01-01T00:00:00"
AVERAGES = "origin string, destination string, airline string, airline_name string, avg_price double, flight_count long"


def test_ties_are_all_kept(quotes):
    df = quotes(
        [
            ("A", "B", "x", 300.0, T0),
            ("A", "B", "y", 200.0, T0),
            ("A", "B", "y", 400.0, T0),
            ("A", "B", "z", 301.0, T0),
        ]
    )
    for report in (ql.best_airline, ql.best_airline_semi):
        assert rows_of(report(df, "1 hour"), "airline", "avg_price") == [("x", 300.0), ("y", 300.0)]
        assert rows_of(report(df), "airline", "flight_count") == [("x", 1), ("y", 2)]
    assert rows_of(ql.price_rank(df), "airline", "price_rank") == [("x", 1), ("y", 1), ("z", 3)]


def test_unknown_routes_and_averages_are_never_best(quotes):
    df = quotes(
        [
            (None, "B", "x", 1.0, T0),
            ("A", None, "x", 1.0, T0),
            ("A", "B", "x", None, T0),
            ("A", "B", "y", 9.0, T0),
            ("C", "D", "x", None, T0),
        ]
    )
    for best in (ql.best_airline(df), ql.best_airline_semi(df), cheapest(ql.airline_averages(df))):
        assert rows_of(best, "origin", "destination", "airline") == [("A", "B", "y")]


def test_not_a_number_ranks_last_but_is_a_known_average(quotes):
    nan = float("nan")
    df = quotes([("A", "B", "x", nan, T0), ("A", "B", "y", 9.0, T0), ("C", "D", "x", nan, T0), ("C", "D", "y", nan, T0)])
    for report in (ql.best_airline, ql.best_airline_semi):
        assert rows_of(report(df), "origin", "airline") == [("A", "y"), ("C", "x"), ("C", "y")]
    for slices in (None, 3):
        ranked = ql.price_rank(df, slices=slices)
        assert rows_of(ranked, "origin", "airline", "price_rank") == [("A", "x", 2), ("A", "y", 1), ("C", "x", 1), ("C", "y", 1)]


def test_an_airline_without_a_code_can_be_best(quotes):
    df = quotes([("A", "B", None, 1.0, T0), ("A", "B", "y", 9.0, T0)])
    assert rows_of(ql.best_airline(df), "airline", "avg_price") == [(None, 1.0)]


def test_both_forms_agree_on_events(spark):
    df = event_quotes(spark, SMALL)
    for window, slide in ((None, None), ("6 hours", None), ("6 hours", "2 hours")):
        assert rows_of(ql.best_airline(df, window, slide)) == rows_of(ql.best_airline_semi(df, window, slide))


def test_no_task_sees_a_whole_route(spark):
    best = ql.best_airline(event_quotes(spark, SMALL))
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "Window" not in plan


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("AB"), st.sampled_from([1.0, 2.0, 2.5, 7.0, 9.25]), st.integers(1, 4)),
        min_size=1,
        max_size=60,
    )
)
def test_rank_in_slices_against_brute_force(spark, drawn):
    rows = [(o, "Z", f"c{i}", f"n{i}", p, n) for i, (o, p, n) in enumerate(drawn)]
    averages = spark.createDataFrame(rows, AVERAGES)
    expected = [(*r, 1 + sum(q[0] == r[0] and q[4] < r[4] for q in rows)) for r in rows]
    for slices in (None, 1, 5):
        ranked = rank_averages(averages, slices)
        assert Counter(map(tuple, ranked.collect())) == Counter(expected)


def test_rank_in_slices_with_one_large_group(spark, monkeypatch):
    """A group that spans all slices, with a level that holds a third of its rows."""
    stored = {}

    def watched(df, label):
        stored[label] = materialize(df, label)
        return stored[label]

    monkeypatch.setattr("quotelane.operators.ranking.materialize", watched)
    averages = spark.range(9000).select(
        F.when(F.col("id") % 10 == 0, "B").otherwise("A").alias("origin"),
        F.lit("Z").alias("destination"),
        F.concat(F.lit("c"), "id").alias("airline"),
        F.lit("n").alias("airline_name"),
        F.when(F.col("id") % 3 == 0, 500.0).otherwise((F.col("id") % 1000).cast("double")).alias("avg_price"),
        F.lit(1).cast("long").alias("flight_count"),
    )
    sliced = rank_averages(averages, slices=8)
    assert stored["levels"].where("origin = 'A'").select("slice").distinct().count() >= 7
    order = Window.partitionBy("origin", "destination").orderBy("avg_price")
    assert rows_of(sliced) == rows_of(averages.withColumn("price_rank", F.rank().over(order)))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(1.0, 1e12), min_size=1, max_size=80), st.integers(1, 6), st.randoms(use_true_random=False))
def test_equal_prices_tie_in_any_order_and_partitioning(quotes, prices, parts, random):
    shuffled = list(prices)
    random.shuffle(shuffled)
    rows = [("A", "B", "x", p, T0) for p in prices] + [("A", "B", "y", p, T0) for p in shuffled]
    best = ql.best_airline(quotes(rows).repartition(parts))
    assert rows_of(best, "airline") == [("x",), ("y",)]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("window", [None, "30 minutes"])
def test_the_quotes_are_read_once(spark, window):
    assert final_plan(ql.best_airline(event_quotes(spark, SMALL), window)).count("FileScan") == 1
    star = final_plan(ql.best_airline(star_quotes(spark, SMALL), window))
    tables = re.findall(r"FileScan parquet \[([a-z]+)_", star)
    assert len(tables) <= 6 and tables.count("l") == tables.count("o") == 1 and "ReusedExchange" in star


def test_latest_report_reads_once_and_sorts_no_more_than_names(spark):
    best = cheapest(ql.airline_averages(event_quotes(spark, SMALL), "30 minutes"))
    plan = final_plan(ql.latest_best(best))
    assert "SortAggregate" not in plan and plan.count("FileScan") == 1


def test_latest_names_and_prices(spark):
    at = lambda h: datetime(2024, 1, 1, h)
    rows = [("A", "B", "x", "old", 1.0, at(1)), ("A", "B", "x", None, None, at(3)), ("A", "B", "x", "new", None, at(2)),
            ("A", "B", "x", "newer", 5.0, at(2)), ("A", "B", "y", None, None, at(1)), (None, "B", "x", "n", 1.0, at(1)),
            ("A", "B", "z", "n", 1.0, None)]
    best = spark.createDataFrame(
        rows, "origin string, destination string, airline string, airline_name string, avg_price double, window_start timestamp")
    assert rows_of(ql.latest_best(best), "airline", "airline_name", "avg_price", "window_start", "route") == [
        ("x", "newer", 5.0, at(3), "A-B"), ("y", None, None, at(1), "A-B"), ("z", "n", None, None, "A-B")]
