"""Column expressions and small helpers that several operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space between words, as a character class and as characters.
SPACES = r"[\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def packed(df: DataFrame, *columns: Column) -> DataFrame:
    """``df`` as one struct column ``row`` beside new columns, so that names never clash."""
    return df.select(F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row"), *columns)


def unpacked(df: DataFrame, names: list[str], **replaced: Column) -> DataFrame:
    """The columns of ``row`` again, some of them replaced."""
    return df.select(
        *[replaced[n].alias(n) if n in replaced else F.col(f"row.`{n}`").alias(n) for n in names]
    )
