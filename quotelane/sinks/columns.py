"""Fitting rows to the stored tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelane.functions.codec import flatten_metadata
from quotelane.schema import DATABASE_TYPES, LOAD_STAMPS, STRING_SIZES, TABLES


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the columns of ``table`` in its types, with the time of loading.

    The types are those of decoded quotes and of the reports, so no value changes.
    Columns that ``df`` lacks are NULL.
    """
    if "_metadata" in df.columns:
        df = flatten_metadata(df)
    columns = []
    for name, kind in TABLES[table].items():
        if name in df.columns:
            value = F.col(name).cast(kind)
        elif name in LOAD_STAMPS:
            value = F.current_timestamp()
        else:
            value = F.lit(None).cast(kind)
        columns.append(value.alias(name))
    return df.select(*columns)


def fit_database(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows in the types of a database, and the rows that do not fit, as strings.

    A row fits if every value it has is one of its column's type and no string is longer
    than its column. Decimals are rounded, as the database would.
    """
    fitted, fits = [], F.lit(True)
    for name, kind in df.dtypes:
        value = F.col(name)
        if name in DATABASE_TYPES:
            typed = value.try_cast(DATABASE_TYPES[name])
            fits = fits & (value.isNull() | typed.isNotNull())
            value = typed
        elif kind == "string" and name in STRING_SIZES:
            fits = fits & F.coalesce(F.length(value) <= STRING_SIZES[name], F.lit(True))
        fitted.append(value.alias(name))
    whole = [F.col(name).cast("string").alias(name) for name in df.columns]
    return df.where(fits).select(*fitted), df.where(~fits).select(*whole)


def rejects_table(table: str) -> str:
    return f"{table}_rejects"


def database_types(table: str) -> str:
    """Value of ``createTableColumnTypes`` for the bounded strings of ``table``."""
    sized = [name for name, kind in TABLES[table].items() if kind == "string" and name in STRING_SIZES]
    return ", ".join(f"{name} VARCHAR({STRING_SIZES[name]})" for name in sized)
