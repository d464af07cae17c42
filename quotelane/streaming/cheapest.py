"""The cheapest airlines of a stream as a stream, for any sink in append mode."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.operators.aggregates import average_price, window_cells
from quotelane.operators.ranking import rankable
from quotelane.schema import CARRIER, ROUTE
from quotelane.streaming.runs import with_event_time


def best_airline_stream(
    quotes: DataFrame, window: str, slide: str | None = None, watermark: str = "1 hour"
) -> DataFrame:
    """The airline or airlines with the lowest average price per route and closed window.

    A chain of stateful operators: the averages, their minimum per route and window, and a
    join of the averages with the minima. Each window is given out once, when the watermark
    has passed it, with all of its ties. A minimum is one number however many airlines share
    it, and the join spreads tied airlines by their average, so no row and no task holds all
    airlines of a window. Both sides of the join keep the averages as state; a closed window
    leaves all of it.
    """
    cells = window_cells(with_event_time(quotes, watermark), ROUTE + CARRIER, window, slide)
    averages = rankable(cells.select(*ROUTE, *CARRIER, "window", average_price(), "flight_count"))
    lowest = averages.groupBy(*[F.col(name).alias(f"of_{name}") for name in (*ROUTE, "window")]).agg(
        F.min("avg_price").alias("lowest"))
    same = [F.col(name) == F.col(f"of_{name}") for name in (*ROUTE, "window")]
    best = averages.join(lowest, [*same, F.col("avg_price") == F.col("lowest")])
    ends = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return best.select(*ROUTE, *ends, *CARRIER, "avg_price", "flight_count")
