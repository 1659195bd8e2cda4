"""Passages that repeat across documents, from a sparse suffix array.

Suffixes are kept only where a text's minimisers begin: of the shingles that begin in the first
``WINDOW`` words of a passage, the one with the smallest hash.  Equal passages keep equal suffixes,
at the same place.  The kept suffixes are sorted by a 64-bit hash of their first
``least - WINDOW + 1`` words, not by the words, and those whose hash stands alone are dropped.
Matches are found by hashes: of the whole context for which a suffix was kept, and at the borders
of a match of each window of ``least`` words.  So results are exact up to hash collisions.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.llm import common

LEAST = 50
WINDOW = 26
SHINGLE = 8


class _Suffixes:
    """Kept suffixes of the texts of one slice; ``least`` words make a passage."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, least: int):
        hashes, _, _, first = common.words(offsets, data)
        self.first, self.ranges = first, common.Ranges(hashes)
        row = common.owners(first)
        none = np.zeros(0, np.int64)
        self.row = self.at = self.low = self.high = none
        if len(hashes) < least:
            return
        shingles = common.runs_of(hashes, SHINGLE)
        begin = np.arange(len(hashes) - least + 1)
        begin = begin[begin + least <= first[row[begin] + 1]]
        if not len(begin):
            return
        # argmin takes the leftmost of equals, in every text alike.
        views = np.lib.stride_tricks.sliding_window_view(shingles, WINDOW)
        at = begin + views.argmin(axis=1)[begin]
        new = np.ones(len(begin), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[begin[1:]] != row[begin[:-1]])
        ends = np.append(np.flatnonzero(new)[1:], len(begin)) - 1
        self.at, self.row = at[new], row[at[new]]
        # The passages for which a suffix was kept begin from ``low`` to ``high``.
        self.low, self.high = begin[new], begin[ends]


def suffixes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(f, c, doc_id, at, left, right)`` of every kept suffix: hashes of its first words and of its whole context."""
    def make(batches):
        for batch in batches:
            for row, offsets, data in common.slices(batch.column(1)):
                s = _Suffixes(offsets, data, least)
                if not len(s.at):
                    continue
                left, right = s.at - s.low, s.high - s.at + least
                f = s.ranges.of(s.at, s.at + least - WINDOW + 1)
                c = s.ranges.of(s.low, s.high + least) ^ left.astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.view(np.int64)), pa.array(c.view(np.int64)), batch.column(0).take(pa.array(row + s.row)),
                     pa.array((s.at - s.first[s.row]).astype(np.int32)), pa.array(left.astype(np.int16)),
                     pa.array(right.astype(np.int16))], ["f", "c", "doc_id", "at", "left", "right"])

    return docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(
        make, "f bigint, c bigint, doc_id bigint, at int, left smallint, right smallint")


def _neighbours(batches):
    """Rows whose first words equal those of the row before or behind, and the ends of the partition."""
    held, matched = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        f = batch.column(0).to_numpy()
        same = np.ones(len(f) + 1, bool)  # with the row before; unknown at the ends
        same[1:-1] = f[1:] == f[:-1]
        if held is not None:
            same[0] = f[0] == held.column(0)[0].as_py()
            if matched or same[0]:
                yield held
        keep = same[:-2] | same[1:-1] if len(f) > 1 else np.zeros(0, bool)
        if keep.any():
            yield batch.slice(0, len(f) - 1).filter(pa.array(keep))
        # A copy, so that the batch can go.
        held, matched = batch.slice(len(f) - 1, 1), bool(same[-2])
    if held is not None:
        yield held


def repeated_passages(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(doc_id, start_word, end_word, n_words, other_doc)``: the repeated parts of every document.

    A part is made of all runs of ``least`` words that stand in another document too, word for
    word; overlapping and adjoining runs are one part, and every repeated word of a document is in
    exactly one.  ``other_doc`` is the smallest other document seen to share some of it.  Rows with
    the same id are one document; rows with a null id are not searched.  Null, empty and short
    texts have no parts.  Other columns are not read, an empty table gives none.

    Suffixes are range-partitioned with ``doc_id`` and position behind the words, so that a
    passage of a third of all documents spreads over partitions.
    """
    spark = docs.sparkSession
    steps = common.Steps(spark, "passages")
    order = ["f", "doc_id", "at"]
    kept = steps.keep(suffixes(docs, least), "suffixes")
    schema = kept.schema
    close = steps.keep(kept.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_neighbours, schema), "close")
    steps.drop("suffixes")

    # One row per context: the documents that have it, and the first place where it stands.
    context = ["f", "c", "left", "right"]
    contexts = close.groupBy(*context).agg(F.min("doc_id").alias("d1"), F.max("doc_id").alias("d2"),
                                           F.min(F.struct("doc_id", "at")).alias("place"))
    contexts = steps.keep(contexts, "contexts")
    alone = F.col("d1") == F.col("d2")
    starts = (contexts.groupBy("f").agg(F.min("d1").alias("m1"), F.max("d2").alias("m2"), F.count("*").alias("n"),
                                        F.count_if(alone).alias("alone"))
              .where("m1 <> m2 AND n > 1 AND alone > 0").select("f"))
    # Contexts that differ beyond equal first words: some of their windows may still be equal.
    borders = steps.keep(contexts.join(starts, "f").select(
        F.col("place.doc_id").alias("_id"), F.col("place.at").alias("at"), "left", "right", "f", "c", "d1", "d2"), "borders")
    todo = borders.groupBy("_id").agg(F.collect_list(F.struct("at", "left", "right", "f", "c", "d1", "d2")).alias("todo"))

    def windows(batches):
        for batch in batches:
            wanted = batch.column(1).to_pylist()
            for row, offsets, data in common.slices(batch.column(0)):
                hashes, _, _, first = common.words(offsets, data)
                ranges, out = common.Ranges(hashes), []
                for i in range(len(first) - 1):
                    for t in wanted[row + i]:
                        begin = first[i] + np.arange(t["at"] - t["left"], t["at"] + t["right"] - least + 1)
                        if first[i] + t["at"] + t["right"] > first[i + 1]:
                            continue  # another text with the same id
                        out.append((begin, begin - first[i] - t["at"], t))
                if not out:
                    continue
                begin = np.concatenate([o[0] for o in out])
                count = [len(o[0]) for o in out]
                whole = ranges.of(begin, begin + least).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(whole), pa.array(np.concatenate([o[1] for o in out]).astype(np.int32))]
                    + [pa.array(np.repeat(np.array([o[2][k] for o in out], np.int64), count)) for k in ("f", "c", "d1", "d2")],
                    ["whole", "shift", "f", "c", "d1", "d2"])

    # Texts meet the chosen ids by a shuffle at every size, so that the plan does not turn with it.
    seen = (docs.select("doc_id", "text").join(todo.hint("merge"), F.col("doc_id") == F.col("_id"))
            .select("text", "todo").mapInArrow(
                windows, "whole bigint, shift int, f bigint, c bigint, d1 bigint, d2 bigint"))
    seen = steps.keep(seen, "windows")
    equal = (seen.groupBy("whole").agg(F.min("d1").alias("m1"), F.max("d2").alias("m2")).where("m1 <> m2"))
    some = (seen.where("d1 = d2").join(equal, "whole").select("f", "c", "shift", "m1", "m2"))
    full = contexts.where("d1 <> d2").select("f", "c", F.col("d1").alias("m1"), F.col("d2").alias("m2"))

    other = F.when(F.col("doc_id") == F.col("m1"), F.col("m2")).otherwise(F.col("m1")).alias("other")
    matches = close.join(full, ["f", "c"]).select(
        "doc_id", (F.col("at") - F.col("left")).alias("start"), (F.col("at") + F.col("right")).alias("end"), other)
    matches = matches.union(close.join(some, ["f", "c"]).select(
        "doc_id", (F.col("at") + F.col("shift")).alias("start"), (F.col("at") + F.col("shift") + least).alias("end"), other))

    # A document has no more matches than words.
    line = W.partitionBy("doc_id").orderBy("start", "end")
    before = F.max("end").over(line.rowsBetween(W.unboundedPreceding, -1))
    parts = (matches.withColumn("new", F.when(before >= F.col("start"), 0).otherwise(1))
             .withColumn("part", F.sum("new").over(line.rowsBetween(W.unboundedPreceding, W.currentRow))))
    return (parts.groupBy("doc_id", "part")
            .agg(F.min("start").cast("bigint").alias("start_word"), F.max("end").cast("bigint").alias("end_word"),
                 F.min("other").alias("other_doc"))
            .select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"), "other_doc"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(common.table(spark, folder, "documents"))
