"""Cutting lineage on storage that outlives an executor."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from marginalia.session import write_step

_FALLBACK: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if context.applicationId not in _FALLBACK:
        _FALLBACK[context.applicationId] = tempfile.mkdtemp(prefix="marginalia-")
    return _FALLBACK[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once and read it back: later steps neither recompute nor lose it."""
    spark = df.sparkSession
    folder = new_folder(spark, name)
    write_step(df, folder)
    out = spark.read.schema(df.schema).parquet(folder)
    out._step_folder = folder
    return out


def discard(*steps: DataFrame) -> None:
    """Delete steps of :func:`durable` that nothing reads any more."""
    for df in steps:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df._step_folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
