"""Filters that decide which documents and sentences go on.

Each is a step of its own with a limit that the caller names; no job applies one unasked.
"""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.sources.codecs import item_bytes


def has_text(mode: str = "empty") -> Column:
    """``empty`` asks for one character, ``blank`` for one above U+0020."""
    if mode == "empty":
        return F.length("text") > 0
    if mode == "blank":
        return F.col("text").rlike(r"[^\x00-\x20]")
    raise ValueError(f"unknown mode {mode!r}")


def guard_no_text(docs: DataFrame, mode: str = "empty") -> DataFrame:
    """Drop documents with null, empty or (``blank``) whitespace-only text."""
    return docs.where(F.col("text").isNotNull() & has_text(mode))


def guard_text_too_long(docs: DataFrame, limit: int) -> DataFrame:
    """Drop documents with more than ``limit`` characters."""
    return docs.where(F.length("text") <= limit)


def row_sizes(docs: DataFrame, ann: DataFrame) -> DataFrame:
    """``doc_id, bytes``: UTF-8 size of the text plus that of its encoded sets.

    A cell is its items, a comma between two and two brackets, so its size is a
    sum: nothing is collected, and each task adds up its part before the shuffle.
    """
    text = docs.select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    return text.unionByName(cell_sizes(ann).select("doc_id", "bytes")).groupBy("doc_id").agg(
        F.sum("bytes").alias("bytes"))


def cell_sizes(ann: DataFrame) -> DataFrame:
    """``doc_id, set, bytes`` of the encoded sets."""
    return ann.groupBy("doc_id", "set").agg((F.sum(item_bytes() + 1) + 1).alias("bytes"))


def guard_row_too_large(docs: DataFrame, ann: DataFrame, limit: int) -> DataFrame:
    """Drop documents whose text and layers together exceed ``limit`` bytes."""
    large = row_sizes(docs, ann).where(F.col("bytes") > limit)
    return docs.join(large.select("doc_id"), "doc_id", "left_anti")


def _held_sets(ann: DataFrame, sets: Iterable[str]) -> DataFrame:
    """One row per document with a flag per set; flags combine before the shuffle."""
    flags = [F.max(F.col("set") == name).alias(f"has_{name}") for name in sets]
    return ann.where(F.col("set").isin(*sets)).groupBy("doc_id").agg(*flags)


def require_sets(docs: DataFrame, ann: DataFrame, sets: Iterable[str]) -> DataFrame:
    """Keep documents that hold every set in ``sets``."""
    sets = list(sets)
    complete = _held_sets(ann, sets)
    for name in sets:
        complete = complete.where(F.col(f"has_{name}"))
    return docs.join(complete.select("doc_id"), "doc_id", "left_semi")


def skip_done(docs: DataFrame, ann: DataFrame, target: str) -> DataFrame:
    """Drop documents that already hold the set ``target``."""
    done = ann.where(F.col("set") == target).select("doc_id").distinct()
    return docs.join(done, "doc_id", "left_anti")


def skip_long_sentences(docs: DataFrame, toks: DataFrame, limit: int) -> DataFrame:
    """Drop a document when one of its sentences has more than ``limit`` tokens.

    Tokens carry the number of the sentence they lie in, so counting needs no
    span join.
    """
    long = (toks.groupBy("doc_id", "sent_no").agg(F.count("*").alias("n"))
            .where(F.col("n") > limit).select("doc_id").distinct())
    return docs.join(long, "doc_id", "left_anti")


def skip_many_nps(docs: DataFrame, nps: DataFrame, limit: int) -> DataFrame:
    """Drop documents with ``limit`` or more noun phrases."""
    many = (nps.groupBy("doc_id").agg(F.count("*").alias("n"))
            .where(F.col("n") >= limit).select("doc_id"))
    return docs.join(many, "doc_id", "left_anti")


def cap_sentences(sents: DataFrame, n: int) -> DataFrame:
    """The first ``n`` sentences of each document.

    Spark cuts each task's rows down to ``n`` per document before the shuffle.
    """
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy("start", "end"))
    return sents.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def first_pairs(pairs: DataFrame, n: int) -> DataFrame:
    """The first ``n`` mention pairs of each document, by mention, nearest first: a report, no step of a job."""
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy("j", F.desc("i")))
    return pairs.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def guard_report(docs: DataFrame, ann: DataFrame, sets: Iterable[str],
                 limit: int, done: str | None = None) -> DataFrame:
    """Documents per reason to skip them; the first failing guard counts."""
    sets = list(sets)
    wanted = [*sets, done] if done else sets
    held = docs.select("doc_id", "text").join(_held_sets(ann, wanted), "doc_id", "left")
    rules = [
        ("no text", F.col("text").isNull() | (F.length("text") == 0)),
        ("text too long", F.length("text") > limit),
        *[(f"no {name}", ~F.coalesce(f"has_{name}", F.lit(False))) for name in sets],
    ]
    if done:
        rules.append((f"has {done}", F.coalesce(f"has_{done}", F.lit(False))))
    reason = F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in rules], F.lit("ok"))
    return held.groupBy(reason.alias("reason")).agg(F.count("*").alias("docs"))


def drop_empty_spans(spans: DataFrame, docs: DataFrame) -> DataFrame:
    """Cut span ends to the text and drop spans with nothing left."""
    sizes = docs.select("doc_id", F.length("text").cast("bigint").alias("_chars"))
    return (spans.join(sizes, "doc_id")
            .withColumn("end", F.least("end", "_chars"))
            .where(F.col("start") < F.col("end")).drop("_chars"))
