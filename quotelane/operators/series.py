"""Listings and chart series over stored results."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.functions.routes import route_label
from quotelane.operators.ordering import numbered
from quotelane.schema import ROUTE


def trend_listing(trends: DataFrame, row_numbers: bool = False) -> DataFrame:
    """Stored trends in order, routes without a name last."""
    return _in_order(trends.select(*ROUTE, "window_start", "avg_price"), row_numbers)


def trend_series(trends: DataFrame, row_numbers: bool = False) -> DataFrame:
    """One labelled line per route, points in time order; stamps may be text."""
    start = F.col("window_start")
    if dict(trends.dtypes)["window_start"] == "string":
        start = F.to_timestamp(start)
    named = trends.dropna(subset=ROUTE).select(
        *ROUTE, route_label().alias("route"), start.alias("window_start"), "avg_price")
    return _in_order(named, row_numbers)


def best_airline_listing(best: DataFrame, row_numbers: bool = False) -> DataFrame:
    """Stored rows of rank 1 in order, tied airlines by name."""
    first = best.where("price_rank = 1").select(
        *ROUTE, "airline", "airline_name", "avg_price", "window_start")
    return _in_order(first, row_numbers, "airline", "airline_name")


def latest_best(best: DataFrame) -> DataFrame:
    """The newest known value of each column per route and airline, with a label.

    Each column looks for its own newest window in which it is not NULL; of several names in
    that window the last in order is taken. The rows of a name are aggregated first, in hash
    tables and before the shuffle, so what is left to sort is one row per airline's name.
    """
    keys = [*ROUTE, "airline"]
    start = F.col("window_start")
    priced = F.when(F.col("avg_price").isNotNull(), start)
    names = (
        best.groupBy(*keys, "airline_name")
        .agg(F.max(start).alias("newest"), F.max(priced).alias("priced"), F.max_by("avg_price", priced).alias("price"))
    )
    of_airline = Window.partitionBy(*keys)
    named = F.col("airline_name").isNotNull()
    latest_name = of_airline.orderBy(named.desc(), F.desc_nulls_last("newest"), F.desc("airline_name"))
    # Unknown keys are left out with the rank. A filter of their own would move into one of the
    # two branches of ``cheapest``, which then could not share one read.
    known = F.col("origin").isNotNull() & F.col("destination").isNotNull() & F.col("airline").isNotNull()
    return (
        names.select(
            *keys, "airline_name",
            F.max_by("price", "priced").over(of_airline).alias("avg_price"),
            F.max("newest").over(of_airline).alias("window_start"),
            F.when(known, F.row_number().over(latest_name)).alias("place"),
        )
        .where("place = 1")
        .select(*keys, "airline_name", "avg_price", "window_start", route_label().alias("route"))
    )


def _in_order(report: DataFrame, row_numbers: bool, *then: str) -> DataFrame:
    """By route and time. With ``row_numbers`` the order is a column, which stays when the
    report is stored, and the report is written when this is called."""
    order = [F.asc_nulls_last(name) for name in (*ROUTE, "window_start", *then)]
    return numbered(report, order) if row_numbers else report.orderBy(*order)
