from datetime import datetime
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import quotelane as ql
from catalog.mapping import event_quotes
from conftest import SMALL, rows_of
from quotelane.functions.windows import micros, pane
from quotelane.operators.aggregates import BITS, FINE, LIMBS, averages_from_cells, stats_from_cells
from quotelane.schema import ROUTE

T0 = "2024-01-01T00:00:00"


def test_route_stats_counts_null_prices_but_does_not_average_them(quotes):
    df = quotes([("A", "B", "x", 10.0, T0), ("A", "B", "x", None, T0), ("A", "B", "y", 20.0, T0)])
    assert rows_of(ql.route_stats(df)) == [("A", "B", 10.0, 20.0, 15.0, 3)]


def test_route_without_any_price(quotes):
    df = quotes([("A", "B", "x", None, T0)])
    assert rows_of(ql.route_stats(df)) == [("A", "B", None, None, None, 1)]


def test_null_route_is_a_group(quotes):
    df = quotes([(None, "B", "x", 10.0, T0), (None, "B", "x", 30.0, T0), ("A", "B", "x", 5.0, T0)])
    stats = rows_of(ql.route_stats(df), "origin", "avg_price", "flight_count")
    assert stats == [("A", 5.0, 1), (None, 20.0, 2)]


def test_window_boundary(quotes):
    df = quotes([("A", "B", "x", 1.0, "2024-01-01T00:00:59.999"), ("A", "B", "x", 2.0, "2024-01-01T00:01:00")])
    stats = rows_of(ql.route_stats(df, "60 seconds"), "window_start", "window_end", "avg_price")
    minute = [datetime(2024, 1, 1, 0, m) for m in range(3)]
    assert stats == [(minute[0], minute[1], 1.0), (minute[1], minute[2], 2.0)]


def test_null_stamp_only_in_unwindowed_results(quotes):
    df = quotes([("A", "B", "x", 1.0, None), ("A", "B", "x", 3.0, T0)])
    assert rows_of(ql.route_stats(df), "flight_count") == [(2,)]
    assert rows_of(ql.route_stats(df, "1 hour"), "flight_count") == [(1,)]


def test_empty_input_gives_a_typed_empty_result(quotes):
    stats = ql.route_stats(quotes([]), "1 hour")
    assert stats.count() == 0
    assert stats.columns == [
        *ROUTE, "window_start", "window_end", "min_price", "max_price", "avg_price", "flight_count"
    ]
    assert dict(stats.dtypes)["flight_count"] == "bigint"


def test_average_does_not_depend_on_the_order_of_rows(spark, quotes):
    prices = [0.1, 0.2, 0.3, 1234.56, 99999.99, 0.01] * 50
    df = quotes([("A", "B", "x", p, T0) for p in prices] + [("A", "B", "y", p, T0) for p in prices])
    for parts, seed in ((1, 1), (7, 2), (13, 3)):
        shuffled = df.orderBy(F.rand(seed)).repartition(parts)
        averages = {row.avg_price for row in ql.airline_averages(shuffled).collect()}
        assert averages == {sum(round(p * 100) for p in prices) / (100 * len(prices))}
        assert ql.best_airline(shuffled).count() == 2


@pytest.mark.parametrize(
    "prices", [[1 / 3, 2 / 7, 5.005], [1e6, 2.5], [1e15, 1e15], [-3.25, 1.0], [0.0], [float("inf"), 1.0]]
)
def test_average_of_prices_that_are_not_cents(quotes, prices):
    average = ql.route_stats(quotes([("A", "B", "x", p, T0) for p in prices])).first().avg_price
    assert average == pytest.approx(sum(prices) / len(prices), rel=1e-12)


@pytest.mark.parametrize("window, slide", [("30 minutes", "10 minutes"), ("25 minutes", "10 minutes"), ("1 hour", "7 minutes"), ("60 minutes", "59 minutes")])
def test_panes_give_the_same_sliding_windows(spark, window, slide):
    df = event_quotes(spark, SMALL)
    direct = df.groupBy(*ROUTE, F.window("timestamp", window, slide).alias("w")).agg(
        F.min("price_usd"), F.max("price_usd"), F.round(F.avg("price_usd"), 5), F.count("*")
    )
    direct = direct.select(*ROUTE, "w.start", "w.end", *direct.columns[3:])
    stats = ql.route_stats(df, window, slide)
    stats = stats.withColumn("avg_price", F.round("avg_price", 5))
    assert rows_of(stats) == rows_of(direct)


def test_durations():
    hour = 3_600_000_000
    assert micros("1 week") == micros("INTERVAL 7 days") == 168 * hour
    assert micros("1 hour 30 minutes") == micros("5400 seconds") == 1.5 * hour
    assert pane("25 minutes", "10 minutes") == "300000000 microseconds"
    assert pane("60 minutes", "1 hour") is None and pane("60 minutes", None) is None
    assert pane("60 minutes", "59 minutes") is None
    assert pane("6 hours", "10 minutes") == "600000000 microseconds"


def test_slide_equal_to_window_is_tumbling(spark):
    df = event_quotes(spark, SMALL)
    assert rows_of(ql.route_stats(df, "1 hour", "60 minutes")) == rows_of(ql.route_stats(df, "1 hour"))


def test_reports_from_merged_cells_equal_the_direct_ones(spark):
    df = event_quotes(spark, SMALL)
    cells = ql.fare_cells(df, window="1 hour")
    assert rows_of(stats_from_cells(ql.merge_cells(cells, ROUTE))) == rows_of(ql.route_stats(df, "1 hour"))
    assert rows_of(averages_from_cells(cells)) == rows_of(ql.airline_averages(df, "1 hour"))


def test_daily_trend_is_ordered(quotes):
    df = quotes(
        [
            ("B", "C", "x", 1.0, "2024-01-02T01:00:00"),
            ("A", "C", "x", 2.0, "2024-01-03T23:59:59"),
            ("A", "C", "x", 4.0, "2024-01-03T00:00:00"),
            ("A", "C", "x", 9.0, "2024-01-01T12:00:00"),
        ]
    )
    trend = [(r.origin, str(r.date), r.avg_price) for r in ql.price_trend_daily(df).collect()]
    assert trend == [("A", "2024-01-01", 9.0), ("A", "2024-01-03", 3.0), ("B", "2024-01-02", 1.0)]


def test_only_needed_columns_are_read(spark):
    plan = ql.route_stats(event_quotes(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert "partial_sum" in plan


@pytest.mark.parametrize(
    "prices",
    [
        [8e24, 8e24], [9.9e27] * 40 + [0.01], [1e28, 2e28], [1e300, 1e300, 5.0], [1.5e308, 1.5e308, -1.5e308],
        [1.7e308] * 9, [-8e24, 3.5, 8e24], [-0.01, -0.02, -1e12], [1e-12, 3e-12, 2.5], [123456789012.34, 0.01, 1 / 3] * 7,
    ],
)
def test_prices_of_any_size_never_fail(quotes, prices):
    def average(order, parts):
        rows = quotes([("A", "B", f"x{k % 3}", p, T0) for k, p in enumerate(order)]).repartition(parts)
        direct = ql.route_stats(rows).first().avg_price
        merged = stats_from_cells(ql.merge_cells(ql.fare_cells(rows), ROUTE)).first().avg_price
        return {direct, merged}

    found = average(prices, 1) | average(prices[::-1], 3) | average(sorted(prices), 5)
    true = float(sum(map(Fraction, prices)) / len(prices))
    exact = max(map(abs, prices)) < 1e28  # larger ones are a sum of doubles
    assert len(found) == 1 or not exact
    assert all(f == pytest.approx(true, rel=1e-15 if exact else 1e-14, abs=1e-15) for f in found)


def test_merged_cells_beyond_64_bits(spark, quotes):
    cells = ql.fare_cells(quotes([("A", "B", "x", 1.0, T0)]))
    most = F.lit(9_200_000_000_000_000_000).cast("bigint")
    for name in (*LIMBS, *FINE):
        full = cells.withColumn(name, most)
        many = full.unionAll(full).unionAll(full).unionAll(full)
        twice = ql.merge_cells(ql.merge_cells(many, [*ROUTE, "airline"]), ROUTE)
        one = ql.merge_cells(full, ROUTE).first()
        again = ql.merge_cells(ql.merge_cells(many, ROUTE).unionAll(ql.merge_cells(many, ROUTE)), ROUTE)
        for merged, copies in ((twice, 4), (again, 8)):
            row = stats_from_cells(merged).first()
            single = stats_from_cells(spark.createDataFrame([one], merged.schema)).first()
            assert row.avg_price == pytest.approx(single.avg_price, rel=1e-12) and row.flight_count == copies


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.floats(-1e27, 1e27), st.integers(-10**7, 10**7).map(lambda n: n / 100), st.floats(-1, 1)), min_size=1, max_size=12))
def test_sums_are_exact(quotes, prices):
    cells = ql.fare_cells(quotes([("A", "B", "x", p, T0) for p in prices])).first()
    cents = sum(cells[name] << (BITS * k) for k, name in enumerate(LIMBS))
    fine = sum(Fraction(cells[name]) * Fraction(2) ** (BITS * k - 67) for k, name in enumerate(FINE))
    total = Fraction(cents, 100) + fine 
    close = max(sum(abs(Fraction(p)) for p in prices) / 10**15, Fraction(1, 10**18))
    assert abs(total - sum(map(Fraction, prices))) <= close
    assert cells["sum_rest"] == 0
