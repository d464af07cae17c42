"""Publish a table of quotes as messages, to Kafka or to Parquet files."""

from quotelane.jobs.options import add_pairs, pairs, parser
from quotelane.session import build_session
from quotelane.sinks.publish import OTHER_TOPIC, publish_files, publish_kafka


def main(arguments: list[str] | None = None) -> None:
    options = parser(__doc__, store=False)
    options.add_argument("--quotes", required=True, help="folder of Parquet files")
    target = options.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers", help="Kafka bootstrap servers")
    target.add_argument("--files", help="folder of messages")
    options.add_argument("--other-topic", default=OTHER_TOPIC, help="for quotes of unknown routes")
    add_pairs(options, "--kafka", "writer option")
    given = options.parse_args(arguments)

    spark = build_session("quotelane-publish")
    quotes = spark.read.parquet(given.quotes)
    if given.servers:
        publish_kafka(quotes, given.servers, given.other_topic, **pairs(given.kafka))
    else:
        publish_files(quotes, given.files, given.other_topic)


if __name__ == "__main__":
    main()
