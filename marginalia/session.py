"""Session settings the operators count on."""

import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Spark 4.1 may take a union of equally partitioned inputs for partitioned itself
# and leave out a shuffle; in 4.1.2 aggregates over such unions come out wrong.
CORRECTNESS = {"spark.sql.unionOutputPartitioning": "false"}

# Before a query runs, Spark guesses that rows exploded from a text are smaller than the text and
# would broadcast them.  So only what is tiny, such as a word list, is broadcast on a guess; other
# joins are planned as shuffles, and AQE broadcasts a side that it has measured to be small.
MEASURED = {
    "spark.sql.autoBroadcastJoinThreshold": "16KB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}

# Arrow batches end at this many bytes, so that batches of long texts stay small beside a worker's own arrays.
BATCH_BYTES = 8 << 20

# What a job writes and reads again is packed more tightly than Spark's default.
WRITTEN = "zstd"
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_SHIPPED: set[str] = set()

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    **MEASURED,
    **CORRECTNESS,
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def prepare(spark: SparkSession) -> SparkSession:
    """Set what right results depend on in a session that somebody else built."""
    for key, value in CORRECTNESS.items():
        spark.conf.set(key, value)
    return spark


def measured(spark: SparkSession) -> SparkSession:
    """As :func:`prepare`, and broadcast measured sides only."""
    for key, value in MEASURED.items():
        spark.conf.set(key, value)
    return prepare(spark)


def shipped(spark: SparkSession) -> SparkSession:
    """Send the package to the Python workers, once per application, and bound their batches."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        bundle = Path(tempfile.mkdtemp(prefix="marginalia-")) / "marginalia.zip"
        with zipfile.ZipFile(bundle, "w") as out:
            for file in package.rglob("*.py"):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(bundle))
        _SHIPPED.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when each of them ends, not when the driver happens to collect its garbage.

    For writes and counts only, which plan their input anew each time.
    """
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


def write_step(df: DataFrame, folder: str, *by: str, mode: str = "error") -> None:
    """Write a step of a job, partitioned by the columns ``by``; nothing but its files is left on disk."""
    with tidy(df.sparkSession):
        df.write.mode(mode).option("compression", WRITTEN).partitionBy(*by).parquet(folder)
