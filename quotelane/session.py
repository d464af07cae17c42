"""Session defaults, and where intermediate tables go."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Quotes carry stamps without an offset: read them all in one zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keeps streaming state off the JVM heap, so it can outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_roots: dict[str, str] = {}


def build_session(app_name: str, **extra: str) -> SparkSession:
    """A session with ``SETTINGS``; the cluster's own submit options still apply."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def adaptive_execution(spark: SparkSession) -> Iterator[None]:
    """Turn adaptive execution on for a while.

    Spark turns it off in the session of a stream, because state must stay where it
    is. The rows handed to ``foreachBatch`` have left the state; without adaptive
    execution each write of them would leave one small file per shuffle partition.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream checkpoints.

    It is the one named in ``spark.checkpoint.dir``. Only a local session without
    that setting gets a temporary folder; a cluster without it is refused, because
    executors cannot see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="quotelane-")
    return _local_roots[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/quotelane/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives every later reader the
    same rows: a sum of doubles computed twice may differ in its last digit.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
