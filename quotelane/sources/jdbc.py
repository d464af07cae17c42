"""Tables in a database (needs the database's driver on the class path)."""

from pyspark.sql import DataFrame, SparkSession


def split_options(
    column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """Reader options for a scan split into ranges of ``column``.

    All four of ``column``, ``lower``, ``upper`` and ``partitions`` go together.
    Rows outside the bounds and NULLs are read too, by the outermost ranges.
    """
    options = {"fetchsize": str(fetch_rows)}
    given = [value is not None for value in (column, lower, upper, partitions)]
    if any(given) and not all(given):
        raise ValueError("column, lower, upper and partitions must be given together")
    if all(given):
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    predicates: list[str] | None = None,
    **split,
) -> DataFrame:
    """A table, scanned in parallel: one task per range, or per entry of ``predicates``.

    Ranges have equal width, so use ``predicates`` where the rows are unevenly spread.
    """
    options = {**split_options(**split), **(properties or {})}
    if predicates:
        return spark.read.jdbc(url, table, predicates=predicates, properties=options)
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
