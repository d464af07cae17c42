"""Appends to tables that cannot replace a batch, such as database tables.

Rows carry the batch and the attempt that wrote them. When all rows of an attempt
are stored, one row in a table of commits says so. Readers take one committed attempt
per batch and leave out the rest, so a repeated batch is read once. A stream with a new
checkpoint numbers its batches from 0 again; commits carry the stream, and of snapshots that
of the stream which was first committed last is the newest.
"""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

Append = Callable[[DataFrame, str], None]


def commits_table(table: str) -> str:
    return f"{table}_commits"


def append_attempt(
    df: DataFrame,
    table: str,
    batch_id: int,
    append: Append,
    beside: dict[str, DataFrame] | None = None,
    snapshot: bool = False,
    stream: str = "",
) -> None:
    """Store one attempt with ``append(rows, table name)``.

    ``beside`` holds rows of other tables that belong to it; one commit covers all. A
    ``snapshot`` takes the place of earlier ones when it is committed.
    """
    attempt = uuid.uuid4().hex
    stamps = {"batch_id": F.lit(batch_id).cast("long"), "attempt": F.lit(attempt)}
    for name, rows in {**(beside or {}), table: df}.items():
        append(rows.withColumns(stamps), name)
    commit = df.sparkSession.range(1).select(
        F.lit(batch_id).cast("long").alias("batch_id"),
        F.lit(attempt).alias("attempt"),
        F.current_timestamp().alias("committed_at"),
        F.lit(snapshot).alias("snapshot"),
        F.lit(stream).alias("stream"),
    )
    append(commit, commits_table(table))


def committed_rows(rows: DataFrame, commits: DataFrame) -> DataFrame:
    """Rows of the first committed attempt of each batch; of snapshots the newest only."""
    winners = commits.groupBy("stream", "batch_id", "snapshot").agg(
        F.min_by("attempt", "committed_at").alias("attempt")
    )
    began = commits.groupBy("stream").agg(F.min("committed_at").alias("began"))
    winners = winners.join(began, "stream")
    place = F.struct("began", "stream", "batch_id")
    newest = F.max(F.when(F.col("snapshot"), place)).over(Window.partitionBy())  # one row per batch
    winners = winners.withColumn("newest", newest).where(~F.col("snapshot") | (place == F.col("newest")))
    kept = rows.join(winners, "attempt", "left_semi")
    return kept.drop("batch_id", "attempt")
