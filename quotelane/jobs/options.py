"""Command-line options shared by the jobs."""

import argparse

from quotelane.sinks.stores import JdbcStore, ParquetStore


def parser(description: str, store: bool = True) -> argparse.ArgumentParser:
    options = argparse.ArgumentParser(description=description)
    if not store:
        return options
    options.add_argument("--store", required=True, help="folder of the tables, or a jdbc: URL")
    add_pairs(options, "--property", "JDBC connection property")
    return options


def add_pairs(options: argparse.ArgumentParser, flag: str, meaning: str) -> None:
    """An option that may be given several times."""
    options.add_argument(flag, action="append", default=[], metavar="KEY=VALUE", help=meaning)


def pairs(given: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in given)


def open_store(given: argparse.Namespace):
    if given.store.startswith("jdbc:"):
        return JdbcStore(given.store, pairs(given.property))
    return ParquetStore(given.store)
