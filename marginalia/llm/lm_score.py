"""Cross-entropy difference: how much more a text is like the target than like the corpus.

Two bigram models over one vocabulary, of the same order and smoothing: one from the target
documents, one from all documents.  Every word and every bigram has counts of its own.  A
document's score is the mean difference of the two losses over its tokens; it is low where the
target model predicts the text better.  A model never counts the document that it scores: the
document's own counts are taken off before its losses, in the target model where it is a target,
in the other one always.

Texts are read once and written as chunks of word numbers.  Each chunk sends every word and bigram
it holds once, with its counts, to the bucket of its hash; buckets add the counts up and send the
sums back to the chunks.  So a frequent bigram comes once per chunk, and no table of counts is
ever in one place.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common

# Weight of the unigram model in a bigram's count.
PRIOR = 50.0
# Bytes of text and rows that make a chunk (one text is never cut), tokens for each bucket of keys.
CHUNK_BYTES = 8 * common.SLICE_BYTES
CHUNK_ROWS = 100_000
BUCKET = 1 << 20

_BORDER = np.uint64(0x5851F42D4C957F2D)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_CHUNK = ("chunk bigint, ids array<bigint>, lengths array<bigint>, n_tokens bigint, n_texts bigint, "
          "words binary, tokens binary")
_KEYS = "bucket bigint, chunk bigint, kind int, keys binary, checks binary, counts binary"
_SUMS = "bucket bigint, chunk bigint, kind int, sums binary, words bigint"
_SCORES = "doc_id bigint, n_tokens bigint, target_loss double, background_loss double, score double"


def _batch(schema: str, *columns) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
             "double": pa.float64()}
    names, types = zip(*(field.split() for field in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types)], list(names))


def _bytes(values: np.ndarray) -> bytes:
    """Numbers with the first bytes of all of them in front, then the second ones, and so on, compressed."""
    values = np.ascontiguousarray(values).reshape(-1)
    flat = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()
    return len(flat).to_bytes(8, "little") + (pa.compress(flat, codec="zstd", asbytes=True) if flat else b"")


def _numbers(content: bytes, kind: type) -> np.ndarray:
    size = int.from_bytes(content[:8], "little")
    if not size:
        return np.zeros(0, kind)
    flat = np.frombuffer(pa.decompress(content[8:], size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1).view(kind)


def chunks(docs: DataFrame) -> DataFrame:
    """Ids and lengths of texts in order, their distinct word hashes ascending, and the number of each token."""
    def read(batches):
        task, number = TaskContext.get().partitionId(), 0
        ids, hashes, lengths, held, rows = [], [], [], 0, 0

        def chunk():
            words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            length = np.concatenate(lengths)
            return _batch(_CHUNK, [(task << 32) + number], [[i for part in ids for i in part]], [length],
                          [len(tokens)], [int((length > 0).sum())],
                          [_bytes(np.diff(words, prepend=np.uint64(0)))], [_bytes(tokens.astype(np.uint32))])

        for batch in batches:
            for row, offsets, data in common.slices(batch.column(1)):
                found, _, _, first = common.words(offsets, data, fold=True)
                ids.append(batch.column(0).slice(row, len(first) - 1).to_pylist())
                hashes.append(found)
                lengths.append(np.diff(first))
                held, rows = held + len(data), rows + len(first) - 1
                if held >= CHUNK_BYTES or rows >= CHUNK_ROWS:
                    yield chunk()
                    number += 1
                    ids, hashes, lengths, held, rows = [], [], [], 0, 0
        if rows:
            yield chunk()

    return docs.select("doc_id", "text").mapInArrow(read, _CHUNK)


class _Chunk:
    """The distinct words and bigrams of a chunk; a text begins after a border, which is the word after the last."""

    def __init__(self, words: bytes, tokens: bytes, lengths: list[int]):
        self.words = np.cumsum(_numbers(words, np.uint64), dtype=np.uint64)
        self.tokens = _numbers(tokens, np.uint32).astype(np.int64)
        self.length = np.array(lengths, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        size = len(self.words)
        self.before = np.empty(len(self.tokens), np.int64)
        self.before[1:] = self.tokens[:-1]
        self.before[self.first[:-1][self.length > 0]] = size
        pairs, self.pair = np.unique(self.before * (size + 1) + self.tokens, return_inverse=True)
        hashes = np.append(self.words, _BORDER)
        ahead, word = hashes[pairs // (size + 1)], hashes[pairs % (size + 1)]
        self.keys = common.mixed(ahead * _FACTOR + word)
        # Two bigrams are one only where these are equal too.
        self.checks = (common.mixed(word * _FACTOR + ahead) & np.uint64(0xFFFF)).astype(np.uint16)
        self.order = np.argsort(self.keys, kind="stable")

    def counts(self, target: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of words and of bigrams in key order, in all texts and in those at ``target``; words also as first of two."""
        wanted = np.zeros(len(self.length), bool)
        wanted[target] = True
        wanted = np.repeat(wanted, self.length)
        size = len(self.words)
        single = [np.bincount(of[chosen], minlength=size + 1)[:size]
                  for of in (self.tokens, self.before) for chosen in (slice(None), wanted)]
        both = [np.bincount(self.pair[chosen], minlength=len(self.keys))[self.order] for chosen in (slice(None), wanted)]
        return np.array(single), np.array(both)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys, so that keys in order are in the order of their buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def keyed(flagged: DataFrame, buckets: int) -> DataFrame:
    """A row for each chunk, bucket and kind (0 words, 1 bigrams) with the keys in order and their counts."""
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                one = _Chunk(row["words"], row["tokens"], row["lengths"])
                single, both = one.counts(row["target"] or [])
                for kind, keys, checks, counts in ((0, one.words, np.zeros(len(one.words), np.uint16), single),
                                                   (1, one.keys[one.order], one.checks[one.order], both)):
                    where = bucket_of(keys, buckets)
                    edges = np.flatnonzero(np.diff(where, prepend=-1, append=buckets))
                    parts = [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]
                    if parts:
                        yield _batch(_KEYS, [int(where[p.start]) for p in parts], [row["chunk"]] * len(parts),
                                     [kind] * len(parts), [_bytes(np.diff(keys[p], prepend=np.uint64(0))) for p in parts],
                                     [_bytes(checks[p]) for p in parts], [_bytes(counts[:, p]) for p in parts])

    return flagged.select("chunk", "lengths", "words", "tokens", "target").mapInArrow(send, _KEYS)


def summed(key: np.ndarray, check: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
    """For each entry the sum of the counts of all entries with the same key and check; number of different ones."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if (same & (check[order][1:] != check[order][:-1])).any():
        order = np.lexsort((check, key))
        same = (key[order][1:] == key[order][:-1]) & (check[order][1:] == check[order][:-1])
    begins = np.flatnonzero(np.concatenate([[True], ~same]))
    out = np.empty_like(counts)
    for n, to in zip(counts, out):
        to[order] = np.repeat(np.add.reduceat(n[order], begins), np.diff(begins, append=len(key)))
    return out, len(begins)


def _sums(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # A bucket has about BUCKET tokens' keys, and each key once for each chunk.
    held = {0: [], 1: []}
    for batch in batches:
        for row in batch.to_pylist():
            keys = np.cumsum(_numbers(row["keys"], np.uint64), dtype=np.uint64)
            counts = _numbers(row["counts"], np.int64).reshape(-1, len(keys))
            held[row["kind"]].append((row["chunk"], keys, _numbers(row["checks"], np.uint16), counts))
    for kind, parts in held.items():
        if not parts:
            continue
        sums, different = summed(*(np.concatenate([p[i] for p in parts], axis=-1) for i in (1, 2, 3)))
        ends = np.cumsum([len(p[1]) for p in parts])
        yield _batch(_SUMS, [key[0].as_py()] * len(parts), [p[0] for p in parts], [kind] * len(parts),
                     [_bytes(s) for s in np.split(sums, ends[:-1], axis=1)],
                     [different if kind == 0 else 0] + [0] * (len(parts) - 1))


def own_counts(row: np.ndarray, item: np.ndarray) -> np.ndarray:
    """For each entry how often its item stands in its row."""
    _, at, n = np.unique(row * (item.max(initial=0) + 1) + item, return_inverse=True, return_counts=True)
    return n[at]


def losses(both: np.ndarray, ahead: np.ndarray, ones: np.ndarray, total: np.ndarray, size: int) -> np.ndarray:
    """Loss of each token in nats: bigram counts over a unigram prior, which knows every word."""
    single = (ones + 1.0) / (total + size + 1.0)
    return -np.log((both + PRIOR * single) / (ahead + PRIOR))


def lm_scores(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, target_loss, background_loss, score)``, one row per row of ``docs``.

    ``targets`` names the target documents by ``doc_id``.  Losses are nats per token, ``score`` is
    the target's less the background's.  Null and empty texts have no tokens: losses and score are
    0.  Each row is scored by the counts of the other rows, so that targets and other texts compare
    and a text that stands twice is told from one that stands once.  Repeated rows count as often as
    they stand, null ids are no targets, without targets the target model knows the vocabulary alone.  Vocabulary and counts are those of all documents:
    words are told apart by a hash of 64 bits, bigrams by one of 80.  Other columns are not read;
    an empty table gives none.
    """
    spark = common.ready(docs.sparkSession)
    steps = common.Steps(spark, "lm")
    found = steps.keep(chunks(docs), "chunks")
    ids = targets.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("_id")).distinct()
    # Ids and chunks meet their targets by a shuffle at every size, so that the plan does not turn with it.
    rows = found.select("chunk", F.posexplode(F.arrays_zip("ids", "lengths")).alias("at", "row"))
    flags = steps.keep(
        rows.join(ids.hint("merge"), F.col("row.ids") == F.col("_id")).groupBy("chunk").agg(
            F.collect_list("at").alias("target"), F.sum("row.lengths").alias("n_tokens"),
            F.count_if(F.col("row.lengths") > 0).alias("n_texts")), "flags")
    # Tokens and texts with any, of all documents and of the targets.
    totals = [tuple(n or 0 for n in table.agg(F.sum("n_tokens"), F.sum("n_texts")).first()) for table in (found, flags)]
    buckets = max(1, -(-totals[0][0] // BUCKET))
    flagged = found.join(flags.select("chunk", "target").hint("merge"), "chunk", "left")
    sums = steps.keep(keyed(flagged, buckets).groupBy("bucket").applyInArrow(_sums, _SUMS), "sums")
    size = sums.agg(F.sum("words")).first()[0] or 0

    def score(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        parts = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        single, both = (np.concatenate([np.zeros((n, 0), np.int64)] + [
            _numbers(r["sums"], np.int64).reshape(n, -1) for r in parts if r["kind"] == kind], axis=1)
            for kind, n in ((0, 4), (1, 2)))
        for row in left.to_pylist():
            one, mean = _Chunk(row["words"], row["tokens"], row["lengths"]), []
            text = np.repeat(np.arange(len(one.length)), one.length)
            own = [own_counts(text, items) for items in (one.pair, one.before, one.tokens)]
            counted = {0: np.ones(len(one.length), bool), 1: np.zeros(len(one.length), bool)}
            counted[1][row["target"] or []] = True
            for model in (1, 0):
                total, texts = totals[model]
                pair = np.empty(len(one.order), np.int64)
                pair[one.order] = both[model]
                off = counted[model][text]
                loss = losses(pair[one.pair] - off * own[0],
                              np.append(single[2 + model], texts)[one.before] - off * own[1],
                              single[model][one.tokens] - off * own[2], total - off * one.length[text], size)
                sums = np.concatenate([[0.0], np.cumsum(loss)])
                mean.append((sums[one.first[1:]] - sums[one.first[:-1]]) / np.maximum(one.length, 1))
            out.append(_batch(_SCORES, row["ids"], one.length, *mean, mean[0] - mean[1]))
        return pa.Table.from_batches(out, _batch(_SCORES, [], [], [], [], []).schema)

    return (flagged.select("chunk", "ids", "lengths", "words", "tokens", "target").groupBy("chunk")
            .cogroup(sums.select("bucket", "chunk", "kind", "sums").groupBy("chunk")).applyInArrow(score, _SCORES))


def query(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents that ``labels`` marks as good."""
    good = common.table(spark, folder, "labels").where("quality = 1")
    return lm_scores(common.table(spark, folder, "documents"), good)
