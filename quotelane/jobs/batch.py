"""Compute the reports over the archive and compare them with the stream's."""

from quotelane.jobs.options import open_store, parser
from quotelane.plans.batch_run import run_batch, run_comparison
from quotelane.session import build_session


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__)
    options.add_argument("--stream-seconds", type=float, help="default: what the stream has stored")
    options.add_argument("--within", default="1 hour", help="compare results stored since then")
    split = options.add_argument_group("parallel scan of an archive in a database")
    split.add_argument("--column", help="column to split by")
    split.add_argument("--lower")
    split.add_argument("--upper")
    split.add_argument("--partitions", type=int)
    given = options.parse_args(arguments)

    spark = build_session("quotelane-batch")
    store = open_store(given)
    names = ("column", "lower", "upper", "partitions")
    ranges = {name: getattr(given, name) for name in names if getattr(given, name) is not None}
    run_batch(store.read(spark, "raw_flight_prices", **ranges), store)
    run_comparison(spark, store, given.stream_seconds, within=given.within)


if __name__ == "__main__":
    main()
