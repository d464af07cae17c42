"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to ``BITS`` bits by cut points of its distribution (numbers) or
of its distinct values (strings), so every cell range holds about the same share. The cells
of a row give its index on the Hilbert curve, rows are sorted by it, and the sorted rows are
cut into runs of equal counts (law ``rows``: counts differ by one at most). Rows that are
near in all dimensions share a shard, so the minimum and maximum of each dimension per file
are narrow and a filter on any of them skips files.

The sort is a range partitioning by (curve index, id, size, checksum), so a cell with a
third of all rows is spread over tasks. Partitions are written once with their number;
ranks are the place within a partition plus the rows of earlier ones.

Defined results: nulls of a dimension are below all values; ties of the curve go by id,
size and checksum; repeated rows are interchangeable; a null text has size 8 and checksum
0; an empty table gives an empty result. There may be fewer rows than shards.
"""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelane.session import materialize

SHARDS = 24
BITS = 5
#: Rows that a sorting task takes, about.
TASK_ROWS = 100_000


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the curve of rows of cell numbers, one column per dimension.

    Works from the highest bit down: at each level the orthant's place is the Gray code
    of the bits seen through the reflections and swaps made so far.
    """
    x = cells.astype(np.int64).T.copy()
    dimensions = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for d in range(dimensions):
            inside = x[d] >> level & 1 == 1
            swap = np.where(inside, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(inside, low, swap)
            x[d] ^= swap if d else 0
    for d in range(1, dimensions):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] >> level & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    index = np.zeros_like(flip)
    for level in range(bits - 1, -1, -1):
        for d in range(dimensions):
            index = index << 1 | (x[d] >> level & 1)
    return index


def cut_points(df: DataFrame, dimension: str, bits: int) -> list:
    """At most 2 ** bits - 1 increasing values that cut a dimension into even parts."""
    parts = 1 << bits
    values = df.select(df[dimension].alias("v")).where("v is not null")
    if dict(df.dtypes)[dimension] != "string":
        steps = [k / parts for k in range(1, parts)]
        found = values.agg(F.percentile_approx(F.col("v").cast("double"), steps, 10_000)).first()[0]
        return sorted(set(found or []))
    # One row per distinct value, not per row of the table.
    distinct = values.distinct()
    ranked = distinct.select("v", F.row_number().over(Window.orderBy("v")).alias("k"))
    n = distinct.count()
    first_of_part = F.floor((F.col("k") - 1) * parts / n) != F.floor((F.col("k") - 2) * parts / n)
    return [r["v"] for r in ranked.where((F.col("k") > 1) & first_of_part).orderBy("k").collect()]


def curve(df: DataFrame, dimensions: Sequence[str], bits: int = BITS) -> Column:
    """The curve index of each row of ``df``; the cut points come from all its rows."""
    cuts = [cut_points(df, d, bits) for d in dimensions]
    strings = [dict(df.dtypes)[d] == "string" for d in dimensions]
    if bits * len(dimensions) > 62:
        raise ValueError("bits times dimensions must not exceed 62")

    def index(*columns: pa.Array) -> pa.Array:
        cells = []
        for column, cut in zip(columns, cuts):
            missing = column.is_null().to_numpy(zero_copy_only=False)
            fill = "" if pa.types.is_string(column.type) else 0.0
            kind = object if pa.types.is_string(column.type) else np.float64
            values = np.array(column.fill_null(fill).to_pylist(), kind)
            cell = np.searchsorted(np.array(cut, kind), values, side="right")
            cells.append(np.where(missing, 0, cell))
        return pa.array(hilbert_index(np.stack(cells, axis=1), bits))

    columns = [df[d] if text else df[d].cast("double") for d, text in zip(dimensions, strings)]
    return F.arrow_udf(index, "long")(*columns)


def sharded(
    docs: DataFrame, dimensions: Sequence[str] = ("lang", "source", "size"), shards: int = SHARDS,
    doc_id: str = "doc_id", text: str = "text", keep_rows: bool = False,
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, curve, shard, slot), with ``keep_rows`` also the row.

    ``size`` is the number of UTF-8 bytes of the text plus 8; as a dimension it may be
    named like a column of ``docs``.
    """
    size = F.coalesce(F.octet_length(docs[text]), F.lit(0)).cast("long") + 8
    given = [docs[d].alias(f"d{k}") if d != "size" else size.alias(f"d{k}") for k, d in enumerate(dimensions)]
    kept = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if keep_rows else []
    rows = docs.select(
        docs[doc_id].alias("doc_id"), size.alias("size"),
        F.coalesce(F.crc32(docs[text].cast("binary")), F.lit(0)).alias("text_crc32"), *given, *kept)
    if not keep_rows:
        rows = materialize(rows, "shard-rows")
    names = [f"d{k}" for k in range(len(dimensions))]
    rows = rows.withColumn("curve", curve(rows, names)).drop(*names)
    order = ["curve", "doc_id", "size", "text_crc32"]
    tasks = max(1, -(-rows.count() // TASK_ROWS), rows.sparkSession.sparkContext.defaultParallelism)
    dealt = materialize(
        rows.repartitionByRange(tasks, *order).withColumn("part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("part").agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy()).alias("all"))
    ranked = dealt.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    ranked = ranked.join(F.broadcast(counts), "part")  # one row per sorting task
    rank = F.col("before") + F.col("k") - 1
    shard = F.expr(f"((before + k - 1) * {shards}) div all")
    first = F.expr(f"(shard * all + {shards - 1}) div {shards}")
    return ranked.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", "curve", "shard", (rank - first).alias("slot"),
        *(["row"] if keep_rows else []))


def write_shards(docs: DataFrame, path: str, **options) -> None:
    """Write each shard as one folder of Parquet files in curve order, so that the files'
    column statistics prune by every dimension."""
    rows = sharded(docs, keep_rows=True, **options)
    (rows.select("shard", "slot", "row.*") if "slot" not in docs.columns and "shard" not in docs.columns
     else rows.select("shard", "slot", "row")) \
        .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(path)
