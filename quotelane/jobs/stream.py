"""Archive the quotes of some topics and keep the windowed reports over them.

By default the topics are read once and the sums behind the reports are stored; the batch and
report jobs compute the reports from them. ``--reports`` stores whole reports instead, as a
database always does, ``--changed-cells`` the newest versions of their cells, and
``--watermark`` only closed windows; these read the topics twice.
"""

from quotelane.functions.codec import decode_quotes
from quotelane.functions.windows import micros, pane
from quotelane.jobs.options import add_pairs, open_store, pairs, parser
from quotelane.session import build_session, scratch_root
from quotelane.sinks.stores import JdbcStore
from quotelane.sources.kafka import read_kafka_stream
from quotelane.streaming import runs


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__)
    options.add_argument("--servers", required=True, help="Kafka bootstrap servers")
    options.add_argument("--topics", required=True, nargs="+")
    options.add_argument("--starting-offsets", default="latest")
    add_pairs(options, "--kafka", "reader option, e.g. maxOffsetsPerTrigger=50000000")
    options.add_argument("--window", default=runs.WINDOW)
    options.add_argument("--slide")
    kept = options.add_mutually_exclusive_group()
    kept.add_argument("--watermark", help="store only windows that this delay has closed")
    kept.add_argument("--reports", action="store_true", help="store whole reports in every batch")
    kept.add_argument("--changed-cells", action="store_true", help="store the cells that a batch changed")
    options.add_argument("--every", default="1 minute", help="time between micro-batches")
    options.add_argument("--checkpoints", help="default: below spark.checkpoint.dir")
    given = options.parse_args(arguments)

    spark = build_session("quotelane-stream")
    store = open_store(given)
    checkpoints = given.checkpoints or f"{scratch_root(spark)}/quotelane/streams"
    reading = {"starting_offsets": given.starting_offsets, **pairs(given.kafka)}
    messages = read_kafka_stream(spark, given.servers, given.topics, **reading)
    quotes = decode_quotes(messages, keep_damaged=True)
    every = {"processingTime": given.every}
    tiled = not given.slide or pane(given.window, given.slide) or micros(given.slide) == micros(given.window)
    if given.changed_cells:
        runs.start_cells(quotes, store, checkpoints, given.window, trigger=every)
    elif given.watermark or given.reports or not tiled or isinstance(store, JdbcStore):
        runs.start_reports(
            quotes, store, checkpoints, given.window, given.slide, given.watermark, every
        )
    else:
        runs.start_all(quotes, store, checkpoints, given.window, given.slide, every)
        return runs.await_any(spark)
    runs.start_archive(quotes, store, checkpoints, every)
    runs.await_any(spark)


if __name__ == "__main__":
    main()
