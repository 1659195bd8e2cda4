"""Mixing sources to target weights: a splitting tree deals block quotas to output shards.

The words of a source stand in one line, its documents in the order of a hash, cut into blocks of
``BLOCK`` words.  A source's quota is a number of block copies: as many rounds over the whole line
as fit into the target, then a permuted part of one more round.  From the root of a binary tree
over the output shards down, multivariate hypergeometric draws part the quotas of all sources
exactly; a shard draws the next permuted blocks of each source and shuffles them among themselves.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.llm import common

# Weights by rank of the source, share of all words, most rounds of a source.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 1024
SHARD_BLOCKS = 1024
# Sources of one tree.
GROUP = 4096
SEED = 11
# numpy draws from fewer than a thousand million items; where a node has more, what is drawn are runs of copies.
_DRAWABLE = 900_000_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(common.WORD)).cast("bigint")


def row_key() -> Column:
    """Same for the same id and text, in no order."""
    return F.xxhash64("doc_id", F.xxhash64("text"), F.lit(SEED))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(source_no, source, source_size, target)``: what each source is to give, in words.

    Sources by code point, null last, share by their weights; one that would pass ``most`` times
    its size stays there and the rest is shared anew.  One row per source, so that the windows
    over all sources see no documents.
    """
    by_name, everything = W.orderBy(F.col("source").asc_nulls_last()), W.partitionBy(F.lit(0))
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    s = s.withColumn("source_no", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", kinds[F.col("source_no") % len(weights)])
    s = s.withColumn("full", F.lit(float(most)) * F.col("source_size"))
    s = s.withColumn("level", F.col("full") / F.col("weight"))
    before = W.orderBy("level", "source_no").rowsBetween(W.unboundedPreceding, -1)
    # With every source held to its level or less, does the mix still fit?
    s = s.withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    held = F.coalesce(F.sum("full").over(before), F.lit(0.0)) + F.col("level") * rest
    s = s.withColumn("capped", held <= F.col("total"))
    given = F.sum(F.when(F.col("capped"), F.col("full")).otherwise(0.0)).over(everything)
    open_ = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("full")).otherwise(
        F.least(F.col("full"), (F.col("total") - given) * F.col("weight") / open_))
    return s.select("source_no", "source", "source_size", target.alias("target"))


def lined_up(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``source_no``, ``source_size``, ``target`` and ``at``, the word of its source at which a document begins.

    The line is cut into 4,096 parts by the leading bits of the key; parts are summed first, and
    running sums go over one part at a time, so that a hot source is shared out.
    """
    part = F.shiftrightunsigned("key", 52)
    rows = sized.withColumn("part", part)
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("words"))
    ahead = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"),
                       F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    inside = (W.partitionBy("source", "part").orderBy("key", "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.withColumn("inside", F.sum("size").over(inside) - F.col("size"))
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    named = sources.withColumnRenamed("source", "s2")
    return (rows.join(named, F.col("source").eqNullSafe(F.col("s2")))
            .select("doc_id", "key", "source", "size", "source_no", "source_size", "target",
                    (F.col("ahead") + F.col("inside")).alias("at")))


def _permuted(place: np.ndarray, n: int, seed: tuple) -> np.ndarray:
    """The block at each place of a pseudo-random order of ``n`` blocks (a Feistel network)."""
    if n < 2:
        return place.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(seed).integers(0, 1 << 63, 4).astype(np.uint64)
    out = place.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        left, right = x >> np.uint64(half), x & mask
        for key in keys:
            left, right = right, left ^ (common.mixed(right ^ key) & mask)
        out[todo] = (left << np.uint64(half)) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def _left_part(quota: np.ndarray, left: int, seed: tuple) -> np.ndarray:
    """A multivariate hypergeometric draw of ``left`` of the block copies of ``quota``.

    Copies are drawn in runs of a power of two of them, the smallest with which the runs can be drawn: single copies below
    ``_DRAWABLE``.  One run is broken up and drawn with what the runs leave over, so that the draw is met to the copy.
    """
    total, size = int(quota.sum()), 1
    while int((quota // size).sum()) >= _DRAWABLE:
        size *= 2
    runs, rest = quota // size, quota % size
    if size == 1:
        return np.random.default_rng(seed).multivariate_hypergeometric(runs, left, method="marginals")
    largest = int(runs.argmax())
    runs[largest] -= 1
    rest[largest] += size
    over = int(rest.sum())
    # Both share the draw as they share the node; single copies make up for what is no whole run.
    number = (left * int(runs.sum()) + total // 2) // total
    single = left - number * size
    number += (single > over) - (single < 0)
    drawn = size * np.random.default_rng(seed).multivariate_hypergeometric(runs, number, method="marginals")
    return drawn + _left_part(rest, left - number * size, (*seed, size))


class _Quotas:
    """Block copies of every source, and which blocks they are."""

    def __init__(self, sizes: list[int], goals: list[int], block: int, numbers: np.ndarray):
        self.block, self.numbers = block, numbers
        size, goal = np.array(sizes, np.int64), np.array(goals, np.int64)
        self.full, self.tail = size // block, size % block
        self.all = self.full + (self.tail > 0)
        self.rounds = np.where(size > 0, goal // np.maximum(size, 1), 0)
        rest = goal - self.rounds * size
        self.more, self.part = rest // block, rest % block
        self.units = self.rounds * self.all + self.more + (self.part > 0)

    def blocks(self, s: int, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block and words of it that each unit of source ``s`` takes."""
        block, words = np.zeros(len(units), np.int64), np.full(len(units), self.block, np.int64)
        whole = self.rounds[s] * self.all[s]
        for turn in range(int(self.rounds[s]) + 1):
            there = (units >= whole) if turn == self.rounds[s] else (units // max(1, self.all[s]) == turn)
            if turn < self.rounds[s]:
                block[there] = _permuted(units[there] - turn * self.all[s], int(self.all[s]), (SEED, int(self.numbers[s]), turn))
                words[there & (block == self.full[s])] = self.tail[s]
                continue
            place = units[there] - whole
            chosen = np.full(len(place), self.full[s])
            inside = place < self.full[s]
            chosen[inside] = _permuted(place[inside], int(self.full[s]), (SEED, int(self.numbers[s]), turn))
            block[there] = chosen
            words[there] = np.where(place == self.more[s], self.part[s], self.block)
        return block, words


def draws(spark: SparkSession, sources: DataFrame, block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """``(shard, position, source_no, block, words)``: what each output shard draws; ``position`` shuffles a shard.

    Sources are a table: groups of ``GROUP`` of them have a tree each, and a row per group and shard goes to the tasks with the
    quotas of the group.  Every row walks down from the root on its own; a node's draw follows from its seed, so
    that all shards agree.
    """
    common.ready(spark)
    rows = sources.select("source_no", "source_size", F.round("target").cast("bigint").alias("goal"))
    listed = F.array_sort(F.collect_list(F.struct("source_no", "source_size", "goal"))).alias("quotas")
    grouped = rows.groupBy(F.floor(F.col("source_no") / GROUP).alias("group")).agg(listed)
    # No source has more copies than this, and shards are counted by it.
    copies = F.ceil(F.col("goal") / block) + F.floor(F.col("goal") / F.greatest("source_size", F.lit(1))) + 1
    total = rows.where("source_size > 0 AND goal > 0").agg(F.sum(copies)).first()[0] or 0
    shards = -(-total // shard_blocks)

    # A row goes to the tasks for each group and some shards in a row.
    span = max(1, min(256, shards // (4 * common.partitions(spark))))

    def draw(batches):
        known: dict[tuple, np.ndarray] = {}
        for batch in batches:
            for first, group, listed in zip(*(batch.column(i).to_pylist() for i in range(3))):
                numbers = np.array([q["source_no"] for q in listed], np.int32)
                quotas = _Quotas([q["source_size"] for q in listed], [q["goal"] for q in listed], block, numbers)
                for shard in range(first, min(first + span, shards)):
                    low, high, quota, begin = 0, shards, quotas.units, np.zeros(len(numbers), np.int64)
                    while high - low > 1:
                        middle, seed = (low + high) // 2, (SEED, low, high, group)
                        if seed not in known:
                            if len(known) > 64:
                                known.clear()
                            known[seed] = _left_part(quota, int(quota.sum()) * (middle - low) // (high - low), seed)
                        left = known[seed]
                        if shard < middle:
                            high, quota = middle, left
                        else:
                            low, quota, begin = middle, quota - left, begin + left
                    parts = [(s, *quotas.blocks(s, np.arange(begin[s], begin[s] + quota[s]))) for s in np.flatnonzero(quota).tolist()]
                    if not parts:
                        continue
                    number = np.concatenate([np.full(len(b), numbers[s], np.int32) for s, b, _ in parts])
                    place = np.random.default_rng((SEED, shards, shard, group)).integers(0, 1 << 62, len(number))
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(np.full(len(number), shard, np.int64)), "position": pa.array(place),
                        "source_no": pa.array(number),
                        "block": pa.array(np.concatenate([b for _, b, _ in parts])),
                        "words": pa.array(np.concatenate([w for _, _, w in parts]))})

    first = F.explode(F.sequence(*(F.lit(n).cast("bigint") for n in (0, max(0, shards - 1), span))))
    slots = grouped.where(F.lit(shards > 0)).select(first.alias("first"), "group", "quotas")
    return slots.repartition(min(max(1, -(-shards // span)), 4 * common.partitions(spark)), "first", "group").mapInArrow(
        draw, "shard bigint, position bigint, source_no int, block bigint, words bigint")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST,
        block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(lined, pieces)``.

    ``lined`` has one row per document with ``size``, ``source_size``, ``target`` and ``at``.
    ``pieces`` has ``(shard, position, doc_id, key, source_no, at, size, start_word, n_words)``:
    word ranges of documents in the order of the mix.  A source gives its target rounded to a
    word; a document is taken at most ``most`` times.  Null and empty texts have size 0 and are
    never taken, a null source is a source of its own, repeated rows count as often as they
    stand, an empty table gives empty results.  Other columns are not read.
    """
    steps = common.Steps(docs.sparkSession, "mixing")
    sized = steps.keep(docs.select("doc_id", "source", row_key().alias("key"),
                                   word_count(F.col("text")).alias("size")), "sized")
    sources = steps.keep(targets(sized, weights, share, most), "sources")
    lined = steps.keep(lined_up(sized, sources), "lined")
    steps.drop("sized")
    last = F.floor((F.col("at") + F.col("size") - 1) / block)
    spans = lined.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), last)))
    begin = F.greatest("at", F.col("block") * block)
    end = F.least(F.col("at") + F.col("size"), F.col("block") * block + F.col("words"))
    # Spark takes the draws for as small as the shard numbers that they come from; they grow with the mix.
    drawn = draws(docs.sparkSession, sources, block).hint("merge")
    pieces = (spans.join(drawn, ["source_no", "block"])
              .where(end > begin)
              .select("shard", "position", "doc_id", "key", "source_no", "at", "size",
                      (begin - F.col("at")).alias("start_word"), (end - begin).alias("n_words")))
    return lined, pieces


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: a row per piece with all columns of ``docs``, ``text`` cut to its words.

    A whole document keeps its text as it is.  ``n_chars``, where there is one, follows the text.  Rows stand in the order of the mix:
    output shards follow each other over the partitions, and the pieces of a shard stand in its shuffled order.
    """
    spark = docs.sparkSession
    lined, pieces = mix(docs)

    @F.arrow_udf("string")
    def cut(text: pa.Array, start: pa.Array, count: pa.Array) -> pa.Array:
        out, begins, counts = [], start.to_numpy(), count.to_numpy()
        for row, offsets, data in common.slices(text):
            _, starts, ends, first = common.words(offsets, data)
            here = np.arange(row, row + len(offsets) - 1)
            low = first[:-1] + begins[here]
            for a, b in zip(starts[low].tolist(), ends[low + counts[here] - 1].tolist()):
                out.append(data[a:b].tobytes().decode())
        return pa.array(out, pa.string())

    mine, key, number, size, start, count, shard, position = common.unused(
        docs, "own_key", "piece_key", "piece_id", "piece_size", "piece_start", "piece_words", "piece_shard", "piece_position")
    pieces = common.Steps(spark, "mix").keep(pieces, "pieces")
    parts = 4 * common.partitions(spark)
    last = pieces.agg(F.max("shard")).first()[0] or 0
    own = docs.withColumn(mine, row_key())
    # Of rows that stand several times each has pieces of its own, and one of the rows gives the text of all.  Whether there are
    # such rows is seen from the keys; only then do texts go through a shuffle for it.
    if not lined.groupBy("key", "doc_id").count().where("count > 1").isEmpty():
        own = own.dropDuplicates([mine, "doc_id"])
    wanted = pieces.select(F.col("key").alias(key), F.col("doc_id").alias(number), F.col("size").alias(size),
                           F.col("start_word").alias(start), F.col("n_words").alias(count),
                           F.col("shard").alias(shard), F.col("position").alias(position))
    both = own.join(wanted, (F.col(mine) == F.col(key)) & F.col("doc_id").eqNullSafe(F.col(number)))
    part = F.when(F.col(count) < F.col(size), cut("text", start, count)).otherwise(F.col("text"))
    both = both.withColumn("text", part)
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.length("text").cast("bigint"))
    # Shards are equally large, so that as many of them go to each partition.
    place = (F.col(shard) * parts / (last + 1)).cast("int")
    return both.repartitionById(parts, place).sortWithinPartitions(shard, position, key, start).select(*docs.columns)


def taken(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs``."""
    lined, pieces = mix(docs)
    words = pieces.groupBy("source_no", "at").agg(F.sum("n_words").alias("words"))
    # A document without words begins where the next one does.
    key = F.when(F.col("size") > 0, F.col("at"))
    return (lined.withColumn("place", key)
            .join(words.select(F.col("source_no").alias("n"), F.col("at").alias("a"), "words"),
                  (F.col("source_no") == F.col("n")) & (F.col("place") == F.col("a")), "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken")))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return taken(common.table(spark, folder, "documents"))
