import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quotelane.schema import QUOTE  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def quotes(spark):
    """Make quotes from (origin, destination, airline, price, stamp) rows."""

    def make(rows):
        full = [
            (o, d, a, a and f"{a} Air", p, stamp and datetime.fromisoformat(stamp + "+00:00"))
            for o, d, a, p, stamp in rows
        ]
        return spark.createDataFrame(full, QUOTE)

    return make


def rows_of(df, *columns):
    """Rows as a sorted list of tuples; NULLs last."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=lambda r: [(v is None, str(v)) for v in r])
