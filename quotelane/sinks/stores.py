"""A store holds the named result tables, in folders or in a database."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelane.schema import TABLES
from quotelane.sinks.attempts import append_attempt, commits_table, committed_rows
from quotelane.sinks.columns import database_types, fit_database, rejects_table
from quotelane.sinks.folders import FAN, READER_SECONDS, SETTLED_BYTES, FolderTable, Merge
from quotelane.sources.jdbc import read_jdbc

ARCHIVE = "raw_flight_prices"
UNREADABLE = "raw_flight_prices_unreadable"


class ParquetStore:
    """One folder per table below ``root``; the raw archive has a folder per date.

    ``readers`` is the time in seconds for which the files that a reader found stay there.
    ``fan`` and ``settled`` bound the number of folders and the rewriting (see ``folders``).
    """

    def __init__(self, root: str, readers: float = READER_SECONDS, fan: int = FAN, settled: int = SETTLED_BYTES):
        self.root = root.rstrip("/")
        self.options = {"readers": readers, "fan": fan, "settled": settled}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, spark: SparkSession, table: str) -> FolderTable:
        return FolderTable(spark, self.path(table), **self.options)

    def read(self, spark: SparkSession, table: str, since: float | None = None) -> DataFrame:
        """The stored rows; none, with the table's columns, before the first write.

        ``since`` (seconds of the epoch) leaves out folders without rows stored since then.
        """
        rows = self.table(spark, table).read(since)
        if rows is not None:
            return rows
        if table not in TABLES:
            raise ValueError(f"nothing was stored in {table} yet, and its columns are not known")
        types = {**TABLES[table], **({"date": "date"} if table == ARCHIVE else {})}
        return spark.createDataFrame([], ", ".join(f"`{name}` {kind}" for name, kind in types.items()))

    def has(self, spark: SparkSession, table: str) -> bool:
        return self.changed_at(spark, table) is not None

    def changed_at(self, spark: SparkSession, table: str) -> float | None:
        """When rows were last stored, None before the first write."""
        return self.table(spark, table).changed_at()

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows outside any stream."""
        rows, outer = _laid_out(df, table)
        self.table(df.sparkSession, table).add(rows, outer=outer)

    def append_batch(
        self, df: DataFrame, table: str, batch_id: int, stream: str = "", merge: Merge | None = None
    ) -> None:
        """Add the rows of a micro-batch, once. ``merge`` may reduce rows when folders are
        merged."""
        rows, outer = _laid_out(df, table)
        self.table(df.sparkSession, table).add(rows, stream, batch_id, outer, merge)

    def replace(self, df: DataFrame, table: str, batch_id: int, stream: str = "") -> None:
        """Store a snapshot, which takes the place of earlier ones."""
        self.table(df.sparkSession, table).replace(df, stream, batch_id)


class JdbcStore:
    """Tables of a database, created by the first write if missing.

    ``writers`` bounds the number of connections that one write opens.
    """

    def __init__(self, url: str, properties: dict[str, str] | None = None, writers: int = 16):
        self.url = url
        self.properties = dict(properties or {})
        self.writers = writers

    def write_options(self, table: str) -> dict[str, str]:
        options = {**self.properties, "numPartitions": str(self.writers)}
        if table in TABLES and database_types(table):
            options["createTableColumnTypes"] = database_types(table)
        return options

    def read(self, spark: SparkSession, table: str, since: float | None = None, **split) -> DataFrame:
        """The committed rows. ``since`` has no effect: a filter on the load stamp is pushed
        down to the database."""
        rows = read_jdbc(spark, self.url, table, self.properties, **split)
        if "attempt" not in rows.columns:
            return rows
        commits = read_jdbc(spark, self.url, commits_table(table), self.properties)
        return committed_rows(rows, commits)

    def append(self, df: DataFrame, table: str) -> None:
        """Add rows outside any stream. Those that do not fit go to a table of rejects."""
        fitting, rejects = fit_database(df)
        self._write(rejects, rejects_table(table))
        self._write(fitting, table)

    def append_batch(
        self, df: DataFrame, table: str, batch_id: int, stream: str = "", merge: Merge | None = None
    ) -> None:
        """Add the rows of a micro-batch; a database merges nothing."""
        self._attempt(df, table, batch_id, stream, snapshot=False)

    def replace(self, df: DataFrame, table: str, batch_id: int, stream: str = "") -> None:
        """Store a snapshot as an attempt of its batch; readers take the newest committed
        one, so they never see an empty table or a part of one."""
        self._attempt(df, table, batch_id, stream, snapshot=True)

    def _attempt(self, df: DataFrame, table: str, batch_id: int, stream: str, snapshot: bool) -> None:
        fitting, rejects = fit_database(df)
        beside = {rejects_table(table): rejects}
        append_attempt(fitting, table, batch_id, self._write, beside, snapshot, stream)

    def has(self, spark: SparkSession, table: str) -> bool:
        """Cells are not kept in a database; its reports are stored as they are read."""
        return False

    def _write(self, df: DataFrame, table: str) -> None:
        df.write.jdbc(self.url, table, mode="append", properties=self.write_options(table))


def _laid_out(df: DataFrame, table: str) -> tuple[DataFrame, list[str]]:
    """The archive's quotes with their date, each date gathered into few files.

    Adaptive execution splits a large date among tasks. Without it a whole date would
    go to one task, so then the rows stay where they are.
    """
    if table != ARCHIVE:
        return df, []
    dated = df.withColumn("date", F.to_date("timestamp"))
    if dated.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        dated = dated.hint("rebalance", "date")
    return dated, ["date"]
