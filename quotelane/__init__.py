"""Price-quote analytics on Spark: route statistics, cheapest carriers and price
trends, over all data or over event-time windows, in batch and in streams."""

from quotelane.operators.aggregates import (
    airline_averages,
    fare_cells,
    merge_cells,
    price_trend,
    price_trend_daily,
    route_stats,
)
from quotelane.operators.compare import comparison_summary, compare_results, latest_metrics
from quotelane.operators.ranking import best_airline, best_airline_semi, price_rank
from quotelane.operators.series import (
    best_airline_listing,
    latest_best,
    trend_listing,
    trend_series,
)

__all__ = [
    "airline_averages",
    "best_airline",
    "best_airline_listing",
    "best_airline_semi",
    "compare_results",
    "comparison_summary",
    "fare_cells",
    "latest_best",
    "latest_metrics",
    "merge_cells",
    "price_rank",
    "price_trend",
    "price_trend_daily",
    "route_stats",
    "trend_listing",
    "trend_series",
]
