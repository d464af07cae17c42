"""Airlines ranked by average price within a route, and within a window if there is one.

Ties share a rank. Rows without a route or without an average are left out first:
ascending order would put a NULL average before the cheapest one.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelane.operators.aggregates import airline_averages, window_bounds
from quotelane.schema import ROUTE
from quotelane.session import materialize


def price_rank(
    quotes: DataFrame,
    window: str | None = None,
    slide: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Airline averages with ``price_rank``; they are written when this is called."""
    return rank_averages(airline_averages(quotes, window, slide), slices)


def best_airline(
    quotes: DataFrame, window: str | None = None, slide: str | None = None
) -> DataFrame:
    """The airline or airlines with the lowest average price."""
    return cheapest(airline_averages(quotes, window, slide)).drop("price_rank")


def best_airline_semi(
    quotes: DataFrame, window: str | None = None, slide: str | None = None
) -> DataFrame:
    """``best_airline`` from averages that are written when this is called, for many readers."""
    averages = materialize(rankable(airline_averages(quotes, window, slide)), "averages")
    return cheapest(averages).drop("price_rank")


def cheapest(averages: DataFrame) -> DataFrame:
    """The rows of rank 1, with ``price_rank``: a semi join of averages with their minima.

    The minima are aggregated before the shuffle and no task sees a whole group, so a
    route on which a great many airlines share the lowest average is no bottleneck. Both
    sides use the same columns of the averages, so that Spark plans their shuffle once and
    reuses it: the quotes are read and aggregated once. Sums are exact, so both sides see
    the same numbers. (Sums of prices from 1e28 on and of those that are not finite are not;
    store such averages first.)
    """
    known = rankable(averages)
    group = _group(known)
    # Always true, but not for the optimizer: without it the sides would lose columns apart.
    known = known.withColumn("every", F.xxhash64(*known.columns))
    lowest = known.groupBy(*group).agg(F.min("avg_price").alias("lowest"), F.min("every").alias("least"))
    lowest = lowest.select(*[F.col(name).alias(f"of_{name}") for name in group], "lowest", "least")
    same = [F.col(name) == F.col(f"of_{name}") for name in group]
    matched = known.join(
        lowest, [*same, F.col("avg_price") == F.col("lowest"), F.col("every") >= F.col("least")], "left_semi")
    return matched.select(*averages.columns, F.lit(1).alias("price_rank"))


def rankable(averages: DataFrame) -> DataFrame:
    return averages.where(" AND ".join(f"{name} IS NOT NULL" for name in (*ROUTE, "avg_price")))


def _group(averages: DataFrame) -> list[str]:
    return ROUTE + window_bounds(averages)


def rank_averages(averages: DataFrame, slices: int | None = None) -> DataFrame:
    """All rows with ``price_rank``, without bringing a group into one task.

    A rank is one more than the number of rows with a lower average. Equal averages
    are first counted as one level, which removes the ties. The levels are range
    partitioned in rank order, so a slice needs only the row count of the same
    group's earlier slices. A boundary between two slices cuts at most one group, so
    there are fewer such counts than slices. ``slices`` is their number; by default
    Spark chooses it.
    """
    stored = materialize(rankable(averages), "averages")
    group = _group(stored)
    levels = stored.groupBy(*group, "avg_price").agg(F.count("*").alias("rows"))
    sliced = materialize(
        levels.repartitionByRange(*([slices] if slices else []), *group, "avg_price")
        .withColumn("slice", F.spark_partition_id()),
        "levels",
    )
    earlier = (Window.unboundedPreceding, -1)
    in_slice = Window.partitionBy(*group, "slice").orderBy("avg_price").rowsBetween(*earlier)
    across = Window.partitionBy(*group).orderBy("slice").rowsBetween(*earlier)
    carried = (
        sliced.groupBy(*group, "slice")
        .agg(F.sum("rows").alias("rows"))
        .select(*group, "slice", F.sum("rows").over(across).alias("carried"))
        .where("carried IS NOT NULL")
    )
    below = F.coalesce(F.sum("rows").over(in_slice), F.lit(0))
    ranked = (
        sliced.withColumn("below", below)
        .join(carried, [*group, "slice"], "left")
        .withColumn("price_rank", (F.col("below") + F.coalesce("carried", F.lit(0)) + 1).cast("int"))
    )
    joined = stored.join(ranked.select(*group, "avg_price", "price_rank"), [*group, "avg_price"])
    return joined.select(*stored.columns, "price_rank")
