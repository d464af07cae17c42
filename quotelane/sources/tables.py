"""Tables of quotes for SQL users."""

from pyspark.sql import DataFrame


def register_view(df: DataFrame, name: str = "flight_prices") -> DataFrame:
    """Make ``df`` usable from SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df
