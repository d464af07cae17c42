from dataclasses import replace
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from quotelane.operators.aggregates import route_stats
from quotelane.plans.batch_run import batch_reports, run_batch, run_comparison
from quotelane.schema import TABLES
from quotelane.session import materialize, scratch_root
from quotelane.sinks.attempts import append_attempt, committed_rows, commits_table
from quotelane.sinks.columns import conform, database_types
from quotelane.sinks.folders import FOLDER, FolderTable, Generation
from quotelane.sinks.stores import JdbcStore, ParquetStore
from quotelane.sources.jdbc import read_jdbc, split_options
from quotelane.sources.kafka import kafka_options
from quotelane.sources.tables import register_view

T0 = "2024-01-01T00:00:00"


def test_conform_types_and_load_stamp(spark, quotes):
    archive = conform(quotes([("JFK", "LAX", "DL", 299.999, T0)]), "raw_flight_prices")
    assert dict(archive.dtypes) == TABLES["raw_flight_prices"]
    row = archive.first()
    assert row.price_usd == 299.999 and row.flight_number is None
    assert row.inserted_at is not None


def test_no_value_is_lost_in_a_folder(spark, quotes, tmp_path):
    store = ParquetStore(str(tmp_path))
    prices = [2.5e8, 0.005, 1e12, float("inf"), float("nan"), None]
    df = quotes([("JFK", "LAX", "DL", p, T0) for p in prices]).withColumn("departure_date", F.lit("soon"))
    store.append_batch(conform(df, "raw_flight_prices"), "raw_flight_prices", 0)
    archive = store.read(spark, "raw_flight_prices")
    found = [(str(r["price_usd"]), r["departure_date"]) for r in archive.collect()]
    assert sorted(found) == sorted((str(p), "soon") for p in prices)
    assert archive.schema["price_usd"].dataType.simpleString() == "double"


def test_rows_that_do_not_fit_a_database_are_kept_whole(spark, quotes, database):
    store = JdbcStore("jdbc:x")
    rows = [("A", "B", "x", 1.504, T0), ("A", "B", "x", 2.5e8, T0), ("LONGER", "B", "y", 1.0, T0), ("A", "B", "z", None, T0)]
    archive = conform(quotes(rows), "raw_flight_prices")
    for _ in range(2):  # a repeated batch
        store.append_batch(archive, "raw_flight_prices", 0)
    assert rows_of(store.read(spark, "raw_flight_prices"), "airline", "price_usd") == [("x", Decimal("1.50")), ("z", None)]
    stored, commits = (spark.read.parquet(path) for path in (
        database.path("raw_flight_prices_rejects"), database.path("raw_flight_prices_commits")))
    rejects = committed_rows(stored, commits)
    assert rows_of(rejects, "origin", "price_usd") == [("A", "2.5E8"), ("LONGER", "1.0")]
    assert rejects.columns == archive.columns


def test_reading_before_the_first_write(spark, quotes, tmp_path):
    store = ParquetStore(str(tmp_path))
    for table, columns in TABLES.items():
        empty = store.read(spark, table)
        assert empty.count() == 0 and dict(empty.drop("date").dtypes) == columns
    with pytest.raises(ValueError):
        store.read(spark, "unknown")
    run_batch(quotes([("A", "B", "x", 100.0, T0)]), store)
    run_comparison(spark, store)
    metrics = store.read(spark, "comparison_metrics")
    assert rows_of(metrics, "query_type", "streaming_result_count", "batch_result_count", "price_diff_percentage") == [
        ("best_airlines", 0, 1, 0.0), ("route_stats", 0, 1, 0.0)]
    store.replace(conform(quotes([]), "best_airlines"), "best_airlines", 0)  # a snapshot without rows
    assert store.read(spark, "best_airlines").count() == 0


def test_backfill_beside_a_stream(spark, quotes, tmp_path):
    store = ParquetStore(str(tmp_path))
    rows = conform(quotes([("A", "B", "x", 1.0, T0)]), "raw_flight_prices")
    store.append_batch(rows, "raw_flight_prices", 0)
    store.append(rows, "raw_flight_prices")
    store.append_batch(rows, "raw_flight_prices", 0)
    assert store.read(spark, "raw_flight_prices").count() == 2


def live(table):
    return [entry.folder for entry in table.current().live]


def on_disk(path):
    return {p.name.removeprefix(f"{FOLDER}=") for p in path.iterdir() if p.name.startswith(FOLDER)}


def test_repeated_batch_adds_no_rows(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    assert table.add(spark.range(3), "s", 0) and table.add(spark.range(10, 12), "s", 1)
    assert not table.add(spark.range(10, 12), "s", 1) and not table.add(spark.range(3), "s", 0)
    assert table.add(spark.range(1), "another", 0)
    assert rows_of(table.read()) == [(0,), (0,), (1,), (10,), (11,), (2,)]


def test_a_failure_before_the_list_is_written_leaves_the_old_table(spark, tmp_path, monkeypatch):
    table = FolderTable(spark, str(tmp_path / "t"), fan=3)
    for batch in range(2):
        table.add(spark.range(batch, batch + 1), "s", batch)

    def failing(*_):
        raise OSError("lost")

    monkeypatch.setattr(FolderTable, "_change", failing)
    with pytest.raises(OSError):
        table.add(spark.range(2, 3), "s", 2)
    assert rows_of(table.read()) == [(0,), (1,)]
    monkeypatch.undo()
    table.add(spark.range(2, 3), "s", 2)  # the stream repeats it; now three folders are merged
    assert rows_of(table.read()) == [(0,), (1,), (2,)] and len(live(table)) == 1
    assert len(on_disk(tmp_path / "t")) == 5  # the merged, the three before, the lost one
    assert not table.add(spark.range(2, 3), "s", 2)  # known, though its folder is merged


def test_a_merge_that_fails_halfway_changes_nothing(spark, tmp_path, monkeypatch):
    table = FolderTable(spark, str(tmp_path / "t"), fan=2)
    table.add(spark.range(1), "s", 0)
    before = rows_of(table.read())

    def failing(rows):
        raise OSError("lost")

    with pytest.raises(OSError):
        table.add(spark.range(1, 2), "s", 1, merge=failing)
    assert before == [(0,)] and rows_of(table.read()) == [(0,), (1,)] and len(live(table)) == 2
    assert not table.add(spark.range(1, 2), "s", 1)
    table.compact()
    assert rows_of(table.read()) == [(0,), (1,)] and len(live(table)) == 1


def test_folders_and_lists_stay_few_over_many_batches(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), readers=0, fan=5)
    for batch in range(60):
        reader = table.read()
        table.add(spark.range(batch, batch + 1).coalesce(1), "s", batch)
        if batch in (5, 25):
            assert reader.count() == batch or reader is None
    assert rows_of(table.read()) == sorted([(b,) for b in range(60)], key=str)
    assert len(live(table)) <= 4 * 3 and len(on_disk(tmp_path / "t")) <= 4 * 3 + 6
    lists = [p for p in (tmp_path / "t" / "_generations").iterdir() if p.name.isdigit()]
    assert len(lists) <= 4


def test_readers_keep_the_files_they_found(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), fan=2)
    table.add(spark.range(1), "s", 0)
    reader = table.read()
    for batch in range(1, 6):
        table.add(spark.range(batch, batch + 1), "s", batch)
    assert reader.count() == 1 and table.read().count() == 6


def test_large_folders_are_not_rewritten(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), fan=2, settled=1)
    for batch in range(4):
        table.add(spark.range(batch, batch + 1), "s", batch)
    assert len(live(table)) == 4 and table.read().count() == 4


def test_newest_snapshot_is_read(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(1), "s", 0)
    reader = table.read()
    for batch in range(1, 6):
        assert table.replace(spark.range(batch + 1), "s", batch)
        assert not table.replace(spark.range(99), "s", batch)
        assert table.read().count() == batch + 1
    assert reader.count() == 1  # its files are still there
    spark.range(99).write.parquet(str(tmp_path / "t" / f"{FOLDER}=lost"))  # in no list
    assert table.read().count() == 6


def test_snapshots_without_readers_are_deleted(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"), readers=0)
    for batch in range(4):
        table.replace(spark.range(batch + 1), "s", batch)
    assert len(on_disk(tmp_path / "t")) <= 2 and table.read().count() == 4


def test_a_new_checkpoint_comes_after_the_old_one(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "t"))
    for batch in range(5):
        table.replace(spark.range(batch + 1), "old", batch)
    table.replace(spark.range(100), "new", 0)
    assert table.read().count() == 100
    with pytest.raises(ValueError):  # the old stream goes on beside the new one
        table.replace(spark.range(7), "old", 5)
    assert table.read().count() == 100


def test_a_new_checkpoint_comes_after_the_old_one_in_a_database(spark, database):
    store = JdbcStore("jdbc:x")
    for batch in range(3):
        store.replace(spark.range(batch + 1), "t", batch, "old")
    store.replace(spark.range(50), "t", 0, "new")
    store.replace(spark.range(50), "t", 0, "new")
    assert store.read(spark, "t").count() == 50


def test_writers_of_one_table_do_not_lose_each_other(spark, tmp_path, monkeypatch):
    ours, theirs = (FolderTable(spark, str(tmp_path / "t")) for _ in range(2))
    ours.add(spark.range(1), "s", 0)
    create = ours.lists.create
    raced = []

    def late(name, text):
        if not raced:  # another writer takes the number first
            raced.append(theirs.add(spark.range(5, 6)))
        return create(name, text)

    monkeypatch.setattr(ours.lists, "create", late)
    ours.add(spark.range(1, 2), "s", 1)
    assert raced == [True] and rows_of(ours.read()) == [(0,), (1,), (5,)]


def test_a_list_that_was_not_written_in_full_is_passed_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("quotelane.sinks.folders.WRITING_SECONDS", 0.3)
    table = FolderTable(spark, str(tmp_path / "t"))
    table.add(spark.range(2), "s", 0)
    table.lists.create("000000000002", table.current().text()[:-20])
    assert table.read().count() == 2
    table.add(spark.range(2), "s", 1)
    assert table.current().number == 3 and table.read().count() == 4
    assert Generation.parsed(table.current().text()) == table.current()


def test_recent_rows_open_recent_folders_only(spark, tmp_path):
    store = ParquetStore(str(tmp_path), fan=1000)
    table = store.table(spark, "t")
    table.add(spark.range(1), "s", 0)

    def many(state):
        old = state.live[0]
        state.live = [replace(old, first=60.0 * k, last=60.0 * k + 30) for k in range(1000)]
        return True

    table._change(many)
    recent = store.read(spark, "t", since=60.0 * 940)
    assert len(store.read(spark, "t", since=60.0 * 5000).inputFiles()) == 0
    opened = [e for e in table.current().live if e.last >= 60.0 * 940]
    assert len(opened) == 60 and len(recent.inputFiles()) <= 60 * len(list((tmp_path / "t").rglob("*.parquet")))


def test_comparison_opens_the_folders_of_its_hour(spark, quotes, tmp_path, monkeypatch):
    store = ParquetStore(str(tmp_path), fan=1000)
    report = conform(route_stats(quotes([("A", "B", "x", 1.0, T0)]), "1 hour"), "route_stats")
    for batch in range(4):
        store.append_batch(report, "route_stats", batch, "s")
    table = store.table(spark, "route_stats")

    def age(state):
        for hours, entry in zip((30, 20, 10, 0), state.live):
            entry.first, entry.last = entry.first - 3600 * hours, entry.last - 3600 * hours
        return True

    table._change(age)
    seen = []
    read = FolderTable._open
    monkeypatch.setattr(FolderTable, "_open", lambda t, state, entries: seen.append(
        (t.path.rsplit("/", 1)[1], len(entries))) or read(t, state, entries))
    run_comparison(spark, store, 1.0)
    assert ("route_stats", 1) in seen and ("route_stats", 4) not in seen
    run_comparison(spark, store, 1.0, datetime.now(timezone.utc), "12 hours")
    assert ("route_stats", 2) in seen


def test_uncommitted_and_repeated_attempts_are_not_read(spark, tmp_path):
    def append(df, table):
        df.write.mode("append").parquet(str(tmp_path / table))

    def failing(df, table):
        if table == commits_table("t"):
            raise OSError("lost")
        append(df, table)

    with pytest.raises(OSError):
        append_attempt(spark.range(3), "t", 0, failing)
    append_attempt(spark.range(3), "t", 0, append)
    append_attempt(spark.range(3), "t", 0, append)
    append_attempt(spark.range(5, 6), "t", 1, append)
    stored, commits = (spark.read.parquet(str(tmp_path / t)) for t in ("t", commits_table("t")))
    assert stored.count() == 10
    assert rows_of(committed_rows(stored, commits)) == [(0,), (1,), (2,), (5,)]


def test_archive_is_laid_out_by_date(spark, quotes, tmp_path):
    store = ParquetStore(str(tmp_path))
    rows = [("A", "B", "x", 1.0, T0), ("A", "B", "x", 2.0, "2024-01-02T00:00:00"), ("A", "B", "x", 3.0, None)]
    store.append(conform(quotes(rows), "raw_flight_prices"), "raw_flight_prices")
    one_day = store.read(spark, "raw_flight_prices").where("date = '2024-01-02'")
    assert rows_of(one_day, "price_usd") == [(2.0,)]
    assert "PartitionFilters: [isnotnull(date" in one_day._jdf.queryExecution().executedPlan().toString()
    assert store.read(spark, "raw_flight_prices").count() == 3


def test_batch_run_then_comparison(spark, quotes, tmp_path):
    store = ParquetStore(str(tmp_path))
    df = quotes([("A", "B", "x", 100.0, T0), ("A", "B", "y", 50.0, T0), ("C", "D", "x", 30.0, T0)])
    seconds = run_batch(df, store)
    assert seconds > 0
    best = store.read(spark, "batch_best_airlines")
    assert rows_of(best, "origin", "airline", "price_rank") == [("A", "y", 1), ("C", "x", 1)]
    assert dict(best.dtypes) == TABLES["batch_best_airlines"]
    for table in ("route_stats", "best_airlines"):
        store.append(conform(store.read(spark, f"batch_{table}").drop("execution_time"), table), table)
    run_comparison(spark, store, 12.0)
    metrics = store.read(spark, "comparison_metrics")
    assert dict(metrics.dtypes) == TABLES["comparison_metrics"]
    assert rows_of(metrics, "query_type", "streaming_result_count", "price_diff_percentage") == [
        ("best_airlines", 2, 0.0),
        ("route_stats", 2, 0.0),
    ]


def test_batch_run_keeps_ties_and_leaves_out_the_unknown(spark, quotes):
    df = quotes(
        [
            ("A", "B", "x", 100.0, T0),
            ("A", "B", "y", 50.0, T0),
            ("A", "B", "y", 150.0, T0),
            ("A", "B", "z", None, T0),
            (None, "B", "x", 1.0, T0),
        ]
    )
    reports, _ = batch_reports(df)
    assert rows_of(reports["batch_best_airlines"], "airline", "avg_price", "price_rank") == [
        ("x", 100.0, 1),
        ("y", 100.0, 1),
    ]
    assert rows_of(reports["batch_route_stats"], "origin", "flight_count") == [("A", 4), (None, 1)]


def test_database_options():
    assert database_types("price_trends") == "origin VARCHAR(3), destination VARCHAR(3)"
    store = JdbcStore("jdbc:x", {"user": "u"})
    assert store.write_options("price_trends")["createTableColumnTypes"].startswith("origin")
    assert "createTableColumnTypes" not in store.write_options("other")
    assert split_options("id", 0, 100, 4)["numPartitions"] == "4"
    assert "partitionColumn" not in split_options()
    with pytest.raises(ValueError):
        split_options("id")


class Calls(list):
    """Writes seen by the stand-in, and where its tables are."""


@pytest.fixture
def database(spark, tmp_path, monkeypatch):
    """A stand-in for a database: its tables are folders, its writes only append or replace."""
    calls = Calls()
    calls.path = lambda table: str(tmp_path / table)

    def write(writer, url, table, mode=None, properties=None):
        calls.append((table, mode, properties))
        writer.mode(mode).parquet(str(tmp_path / table))

    def read(session, url, table, properties=None, **split):
        return session.read.parquet(str(tmp_path / table))

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", write)
    monkeypatch.setattr("quotelane.sinks.stores.read_jdbc", read)
    return calls


def test_database_store(spark, quotes, database):
    store = JdbcStore("jdbc:x", {"user": "u"}, writers=3)
    rows = conform(quotes([("A", "B", "x", 1.0, T0)]), "raw_flight_prices")
    for _ in range(2):
        store.append_batch(rows, "raw_flight_prices", 0)
    store.append_batch(rows, "raw_flight_prices", 1)
    archive = store.read(spark, "raw_flight_prices")
    assert archive.count() == 2 and archive.columns == list(TABLES["raw_flight_prices"])
    # Rejects are stored before the rows, and both before their commit.
    assert [call[0] for call in database[:3]] == [
        "raw_flight_prices_rejects", "raw_flight_prices", "raw_flight_prices_commits"]
    table, mode, properties = database[1]
    assert (mode, properties["numPartitions"]) == ("append", "3")
    assert "origin VARCHAR(3)" in properties["createTableColumnTypes"]

    for batch_id in (0, 1, 1):
        store.replace(spark.range(batch_id + 1), "snapshot", batch_id)
    assert store.read(spark, "snapshot").count() == 2
    assert {mode for _, mode, _ in database} == {"append"}  # no reader finds an empty table


def test_batch_run_from_a_database(spark, quotes, database):
    store = JdbcStore("jdbc:x")
    store.append_batch(conform(quotes([("A", "B", "x", 1.5, T0)]), "raw_flight_prices"), "raw_flight_prices", 0)
    run_batch(store.read(spark, "raw_flight_prices"), store)
    assert rows_of(store.read(spark, "batch_route_stats"), "avg_price") == [(Decimal("1.50"),)]


def test_jdbc_reader_options(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.load", lambda reader: reader)
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameReader.options", lambda reader, **o: seen.update(o) or reader
    )
    monkeypatch.setattr(
        "pyspark.sql.readwriter.DataFrameReader.jdbc", lambda reader, *a, **o: seen.update(o) or reader
    )
    split = {"column": "timestamp", "lower": "2024-01-01", "upper": "2024-02-01", "partitions": 64}
    read_jdbc(spark, "jdbc:x", "t", {"user": "u"}, **split)
    assert seen["dbtable"] == "t" and seen["partitionColumn"] == "timestamp" and seen["user"] == "u"
    read_jdbc(spark, "jdbc:x", "t", predicates=["id < 5", "id >= 5"])
    assert seen["predicates"] == ["id < 5", "id >= 5"]


def test_kafka_options():
    assert kafka_options("h:9092", ["a", "b"], minPartitions="64") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }


def test_materialize_uses_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_root(spark) == root
    stored = materialize(spark.range(5).withColumn("at", F.lit(datetime(2024, 1, 1))))
    assert stored.count() == 5 and root in stored.inputFiles()[0]


def test_view_for_sql_users(spark, quotes):
    register_view(quotes([("A", "B", "x", 1.0, T0)]), "quotes_view")
    assert spark.sql("SELECT max(price_usd) FROM quotes_view").first()[0] == 1.0
