"""Print the first lines of the stored trends, cheapest airlines and comparisons, and write
the whole reports where a folder is given."""

from quotelane.jobs.options import open_store, parser
from quotelane.operators.compare import comparison_summary, latest_metrics
from quotelane.operators.series import best_airline_listing, latest_best, trend_series
from quotelane.session import build_session
from quotelane.streaming.runs import stored_report


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__)
    options.add_argument("--rows", type=int, default=50, help="lines printed per report")
    options.add_argument("--output", help="folder for the whole reports, as Parquet")
    given = options.parse_args(arguments)

    spark = build_session("quotelane-report")
    store = open_store(given)
    stored = stored_report(spark, store, "best_airlines").where("price_rank = 1")
    metrics = latest_metrics(store.read(spark, "comparison_metrics"))
    # Where whole reports are stored, their order is a column.
    numbers = bool(given.output)
    reports = {
        "Price trends": trend_series(stored_report(spark, store, "price_trends"), numbers),
        "Cheapest airlines": best_airline_listing(stored, numbers),
        "Latest per route and airline": latest_best(stored),
        "Latest comparisons": metrics,
        "Comparison summary": comparison_summary(metrics),
    }
    for title, report in reports.items():
        print(title)
        shown = report.orderBy("row_number") if "row_number" in report.columns else report
        shown.show(given.rows, truncate=False)
        if given.output:
            folder = title.lower().replace(" ", "_")
            report.write.mode("overwrite").parquet(f"{given.output.rstrip('/')}/{folder}")


if __name__ == "__main__":
    main()
