"""Row numbers over a whole report, without a task that sees all of it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.session import materialize


def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> DataFrame:
    """``df`` with the place of each row in ``order``, from 1; written when this is called.

    Rows are sorted in range partitions. A row's number is its place in its partition plus
    the number of rows in earlier ones, of which there is one count per partition. So the
    order survives being stored. Rows equal in ``order`` are numbered in any order.
    """
    columns = df.columns
    at = F.monotonically_increasing_id()  # the partition, and the place in it
    ranges = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "ordered")
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranges.groupBy(part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    shifts = counts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = ranges.withColumn("_part", part).join(shifts, "_part")
    return placed.select(*columns, (F.col("_at") + F.col("_shift") + 1).alias(name))
