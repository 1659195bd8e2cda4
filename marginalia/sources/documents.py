"""Reading the document table and choosing rows of it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_documents(spark: SparkSession, folder: str, columns=("doc_id", "text")) -> DataFrame:
    """Read only the given columns of the document table."""
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet").select(*columns)


def spread(df: DataFrame) -> DataFrame:
    """Share out an input that has fewer splits than the session has cores.

    Text work is bound by CPU; a table in a few small files would leave cores
    idle.  An input with enough splits is returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores)


def scan_from_key(df: DataFrame, start, key: str = "doc_id") -> DataFrame:
    """Resume at a start key, inclusive; the comparison reaches the Parquet scan."""
    return df.where(F.col(key) >= F.lit(start))


def scan_source(df: DataFrame, source: str) -> DataFrame:
    """Documents of one source."""
    return df.where(F.col("source") == source)


def scan_key_list(df: DataFrame, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents whose key is listed.

    A semi join needs no ``distinct`` on the list, and without a hint Spark
    broadcasts the list only if it is small.
    """
    return df.join(keys.select(key), key, "left_semi")
