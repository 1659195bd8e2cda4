"""Bounded samples of labelled documents to fit classifiers on."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(folds: int) -> Column:
    """The fold of a row: the crc32 of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, each: int) -> DataFrame:
    """``(doc_id, text, y)`` for at most ``each`` labelled ids of each class outside fold ``held``.

    Ids come in the order of a hash, so that the sample is the same in every run.  Rows with a
    null id or a null label teach nothing; of labels that disagree the larger holds.  The ids
    are broadcast: there are at most ``2 * each``.
    """
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
             .where(fold(folds) != held).groupBy("doc_id").agg(F.max(label).alias("y")))
    chosen = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(each) for y in (0, 1)]
    ids = chosen[0].union(chosen[1]).select(F.col("doc_id").alias("_id"), F.col("y").cast("int").alias("y"))
    return (docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("_id"))
            .select("doc_id", "text", "y"))


def scored(docs: DataFrame, score: Column, folds: int, held: int, bar: float) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs``."""
    return (docs.select("doc_id", (fold(folds) == held).alias("held_out"), score.alias("score"))
            .withColumn("predicted", F.when(F.col("score") >= bar, 1).otherwise(0)))
