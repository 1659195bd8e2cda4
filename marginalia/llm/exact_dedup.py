"""Exact duplicates by sorting content.

Normalised texts are range-partitioned by sampled splitters and sorted externally, so that equal
texts lie next to each other; a window walks the sorted rows, compares neighbours in full and
hands on the smallest identifier.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.llm import common

# A single space stands already; only other runs of blanks are replaced.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty, each run of blanks as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per row of ``docs``.

    Null texts are empty texts, and empty texts equal each other.  The smallest ``doc_id`` of a
    group stays; null ids come last and stay only where the group has no other.  Of rows that
    repeat both text and id, one stays.  Other columns are not read.  An empty table gives none.

    A text with more rows than an even partition holds is salted by ``doc_id``; its subgroups are
    compared in full again, one row each.  There are fewer such texts than partitions, so the
    tables of them that are broadcast have at most twice as many rows as there are partitions.
    """
    spark = docs.sparkSession
    steps = common.Steps(spark, "exact")
    rows = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    limit = max(64, math.ceil(docs.count() / common.partitions(spark)))
    hot = (rows.groupBy(F.xxhash64("norm").alias("digest")).count().where(F.col("count") > limit)
           .select("digest", F.ceil(F.col("count") / limit).alias("parts")))
    salt = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("parts"))
    rows = (rows.withColumn("digest", F.xxhash64("norm")).join(F.broadcast(hot), "digest", "left")
            .select("doc_id", "norm", F.coalesce(salt, F.lit(-1)).alias("salt")))

    # Splitters travel to the driver, so they are the leading characters and a digest, not whole
    # texts; the sort and the window compare whole texts.
    rows = rows.withColumn("lead", F.substring("norm", 1, 32)).withColumn("digest", F.xxhash64("norm"))
    text = W.partitionBy("lead", "digest", "norm", "salt")
    ordered = text.orderBy(F.col("doc_id").asc_nulls_last())
    found = (rows.repartitionByRange("lead", "digest", "salt")
             .select("doc_id", "norm", "salt", F.row_number().over(ordered).alias("place"),
                     F.first("doc_id").over(ordered).alias("head"), F.count("*").over(text).alias("size"))
             .select("doc_id", "place", "head", "size", F.sha2(F.col("norm"), 256).alias("text_sha256"),
                     F.when((F.col("salt") >= 0) & (F.col("place") == 1), F.col("norm")).alias("head_text")))
    found = steps.keep(found, "sorted")
    whole = (found.where("head_text IS NOT NULL").groupBy("head_text", "text_sha256")
             .agg(F.min("head").alias("all_head"), F.sum("size").alias("all_size"))
             .select("text_sha256", "all_head", "all_size"))
    keep, size = F.when(F.col("all_size").isNull(), F.col("head")).otherwise(F.col("all_head")), "group_size"
    return (found.join(F.broadcast(whole), "text_sha256", "left")
            .select("doc_id", keep.alias("keep_id"), F.coalesce("all_size", "size").alias(size),
                    ((F.col("place") == 1) & keep.eqNullSafe(F.col("doc_id"))).alias("kept"), "text_sha256"))


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` less its exact copies, with all columns."""
    own, key, sha = common.unused(docs, "own_sha", "kept_id", "kept_sha")
    kept = exact_groups(docs).where("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha))
    marked = docs.withColumn(own, F.sha2(normalised(F.col("text")), 256))
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(own) == F.col(sha))
    # Rows with the same id and text are one.
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(common.table(spark, folder, "documents"))


SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM n WINDOW g AS (PARTITION BY norm)
"""
