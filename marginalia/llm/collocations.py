"""Phrase collocations from a weighted de Bruijn graph of words.

Every word position gives the longest gram that begins there: four words, or what its piece still
holds.  Four words are an edge between two overlapping nodes of three; a shorter gram is a piece end.
Edges are added up once.  All shorter counts follow from the flow: a phrase occurs as often as the
edges that begin with it, plus the piece ends that do.  A node with one edge in and one edge out that
both carry its whole flow lies inside a unary path and is compacted away: it is no phrase by itself.

No phrase holds a pair of words that is rarer than the phrase itself must be.  So pairs are counted first, by a
40-bit key, and a piece also ends within every pair that is rarer: that takes nothing from any phrase's flow and most edges
out of the shuffle.  Which pairs are frequent is known from a bitmap of fixed size; pairs that share a bit with a
frequent one are merely not cut.

Words travel in blocks of byte planes, grams combined within a chunk first: the most usual words of a sample as short codes, all
others as 55-bit hashes.  A node
and its edges meet in one bucket; nodes with very many different successors are known from
a sample and have their edges spread over all buckets, with their flow added up at the end.  The sample
decides where rows go and nothing else.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.llm import common

LONGEST = 4
# Least count of a phrase, share of a longer phrase that makes it a part, factor of scores, rows per language.
LEAST = 30
SHARE = 80
SCALE = 2_000_000
MOST = 2000
# Words combined at once in a task, bytes of text per bucket, bytes of text in the sample, successors in one
# chunk that make a node hot, hot nodes at most (the most split ones are taken).
CHUNK = 1 << 19
BUCKET_BYTES = 8 << 20
SAMPLE_BYTES = 32 << 20
HOT = 64
HOT_NODES = 4096
# Bits of the map of frequent pairs: eight megabytes, whatever the input.
MAP_BITS = 26
_PAIR_BITS = 40
# Words with a short code, at most.
CODES = (1 << 16) - 1

_FACTOR = np.uint64(0xD6E8FEB86659FD93)
# Hashes of words have this bit, codes have not.
_HASHED = np.uint64(1 << 55)
# What ends a piece, and what else parts words.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?\n\x0b\x0c\r"]] = True
_PARTS = _ENDS.copy()
_PARTS[[*b" \t"]] = True

_GRAMS, _PAIRS, _WORDS, _TOTAL = 0, 1, 2, 3
_BLOCK = "bucket int, kind int, lang string, data binary, text binary"
_FLAT = "lang string, w1 bigint, w2 bigint, w3 bigint, w4 bigint, f bigint, word string"


def _key(*columns: np.ndarray) -> np.ndarray:
    key = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        key = common.mixed(key * _FACTOR + column)
    return key


def _lang_key(lang: str) -> np.uint64:
    data = np.frombuffer(lang.encode(), np.uint8).astype(np.uint64)
    key = np.full(1, len(data), np.uint64)
    for byte in data:
        key = common.mixed(key * _FACTOR + byte)
    return key[0]


def _packed(columns: list[np.ndarray]) -> bytes:
    """Numbers as planes of bytes: equal leading bytes of sorted columns lie side by side and compress."""
    rows = np.stack([np.asarray(c, np.uint64) for c in columns])
    return np.ascontiguousarray(rows.astype("<u8").view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1)).tobytes()


def _unpacked(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(columns, 8, -1).transpose(0, 2, 1)
    return np.ascontiguousarray(planes).view("<u8").reshape(columns, -1)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["bucket", "kind", "lang", "data", "text"])


def _gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> bytes:
    """The bytes of the ranges in a row."""
    where = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    return data[where].tobytes()


def _split(offsets: np.ndarray, data: np.ndarray):
    """The same texts in windows of about ``SLICE_BYTES``; only a single long text is cut, and only at piece ends."""
    if len(offsets) > 2 or len(data) <= 2 * common.SLICE_BYTES:
        yield offsets, data
        return
    ends, low = np.flatnonzero(_ENDS[data]), 0
    while low < len(data):
        at = np.searchsorted(ends, low + common.SLICE_BYTES)
        high = int(ends[at]) + 1 if at < len(ends) else len(data)
        yield np.array([0, high - low]), data[low:high]
        low = high


class _Codes:
    """Numbers of words: a code for usual ones, a hash for all others."""

    def __init__(self, hashes: list[int], texts: list[str]):
        order = np.argsort(np.array(hashes, np.uint64))
        self.hashes = np.array(hashes, np.uint64)[order]
        self.texts = [texts[i] for i in order]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = (hashes & (_HASHED - np.uint64(1))) | _HASHED
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, out), len(self.hashes) - 1)
            known = self.hashes[at] == out
            # Zero stands for no word.
            out[known] = at[known].astype(np.uint64) + np.uint64(1)
        return out

    def text(self, number: int) -> str:
        return self.texts[number - 1]


class _Chunk:
    """Words of texts in a row: number, bytes, language, and how many words their piece still holds."""

    def __init__(self, codes: _Codes):
        self.codes, self.parts, self.count, self.bytes = codes, [], 0, 0

    def add(self, offsets: np.ndarray, data: np.ndarray, langs: np.ndarray) -> None:
        data = common._FOLD[data]
        hashes, starts, ends, first = common.words(offsets, data, blank=_PARTS)
        if not len(hashes):
            return
        seen = np.cumsum(_ENDS[data])
        last = np.ones(len(hashes), bool)
        last[:-1] = seen[starts[1:]] > seen[ends[:-1] - 1]
        rows = first[1:][(first[1:] > 0) & (first[1:] < len(hashes))]
        last[rows - 1] = True
        stop = np.flatnonzero(last)
        left = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(len(hashes)) + 1
        lang = langs[common.owners(first)]
        self.parts.append((self.codes(hashes), starts + self.bytes, ends - starts, np.minimum(left, LONGEST), lang, data))
        self.count, self.bytes = self.count + len(hashes), self.bytes + len(data)

    def pairs(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the distinct pairs of neighbours in a piece, ascending, and their counts."""
        hashes, _, _, left, lang, _ = (np.concatenate(c) for c in zip(*self.parts))
        at = np.flatnonzero(left > 1)
        return np.unique(_pair_keys(_lang_keys(names)[lang[at]], hashes[at], hashes[at + 1]), return_counts=True)

    def languages(self, names: list[str], frequent: np.ndarray):
        """``(name, grams, counts, words)`` per language: distinct longest grams of two words and more, cut at rare pairs, and
        for distinct words their hash, count and text."""
        hashes, starts, lengths, left, lang, data = (np.concatenate(c) for c in zip(*self.parts))
        self.parts = []
        on = left > 1
        at = np.flatnonzero(on)
        on[at] = _in_map(frequent, _pair_keys(_lang_keys(names)[lang[at]], hashes[at], hashes[at + 1]))
        left = 1 + on.astype(np.int64)
        for i in range(1, LONGEST - 1):
            later = np.zeros(len(on), bool)
            later[:-i] = on[i:]
            left += later & (left == i + 1)
        grams = [hashes]
        for i in range(1, LONGEST):
            later = np.zeros(len(hashes), np.uint64)
            later[:-i] = hashes[i:]
            later[left <= i] = 0
            grams.append(later)
        for number in np.unique(lang).tolist():
            mine = slice(None) if len(names) == 1 else lang == number
            columns = [g[(left > 1) if len(names) == 1 else mine & (left > 1)] for g in grams]
            # Grams of equal key side by side; should different ones share a key they just stay uncombined.
            order = np.argsort(_key(*columns))
            columns = [c[order] for c in columns]
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            begin = np.flatnonzero(new)
            words, at, counts = np.unique(hashes[mine], return_index=True, return_counts=True)
            yield (names[number], [c[begin] for c in columns], np.diff(begin, append=len(order)),
                   (words, counts, starts[mine][at], lengths[mine][at], data))


def _lang_keys(names: list[str]) -> np.ndarray:
    return np.array([_lang_key(name) for name in names], np.uint64)


def _pair_keys(lang: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _key(lang, first, second) >> np.uint64(64 - _PAIR_BITS)


def _in_map(frequent: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    bits = (8 * len(frequent)).bit_length() - 1
    bit = (pairs >> np.uint64(_PAIR_BITS - bits)).astype(np.int64)
    return (frequent[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)


def _chunks(batches, codes: _Codes, size: int):
    """Chunks of about ``size`` words, with the names of their languages."""
    chunk, names = _Chunk(codes), {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for row, offsets, data in common.slices(batch.column(1)):
            number = [names.setdefault("und" if v is None else v, len(names)) for v in langs[row:row + len(offsets) - 1]]
            for window in _split(offsets, data):
                chunk.add(*window, np.array(number))
                if chunk.count >= size:
                    yield chunk, list(names)
                    # A long text goes on in the next chunk under the same number.
                    chunk = _Chunk(codes)
            if not chunk.count:
                names = {}
    if chunk.count:
        yield chunk, list(names)


def _nodes(lang: str, grams: list[np.ndarray]) -> np.ndarray:
    """What edges of one node share."""
    return _key(np.full(len(grams[0]), _lang_key(lang)), *grams[:LONGEST - 1])


def _placed(number: np.ndarray, order_by: np.ndarray, buckets: int):
    """``(bucket, rows)`` for each bucket, rows ordered by their first word."""
    bucket = (number % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((order_by, bucket))
    edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for low, high in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
        yield int(bucket[order[low]]), order[low:high]


def _sample(texts: DataFrame, size: int) -> DataFrame:
    every = max(1, -(-size // SAMPLE_BYTES))
    return texts.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(every)) == 0).select("lang", "text")


def usual_words(texts: DataFrame, size: int) -> _Codes:
    """Codes for the ``CODES`` most frequent words of a sample of about ``SAMPLE_BYTES``."""
    def words(batches):
        none = _Codes([], [])
        for chunk, _ in _chunks(batches, none, CHUNK):
            hashes, starts, lengths, _, _, data = (np.concatenate(c) for c in zip(*chunk.parts))
            found, at, counts = np.unique(hashes, return_index=True, return_counts=True)
            twice = counts > 1
            text = [data[a:a + n].tobytes().decode() for a, n in zip(starts[at][twice].tolist(), lengths[at][twice].tolist())]
            yield pa.RecordBatch.from_pydict({
                "hash": pa.array(found[twice].view(np.int64)), "n": pa.array(counts[twice]), "word": pa.array(text, pa.string())})

    found = (_sample(texts, size).mapInArrow(words, "hash bigint, n bigint, word string").groupBy("hash")
             .agg(F.sum("n").alias("n"), F.max("word").alias("word")).orderBy(F.desc("n"), "hash").limit(CODES).collect())
    return _Codes([r["hash"] for r in found], [r["word"] for r in found])


def frequent_pairs(texts: DataFrame, size: int, least: int, codes: _Codes) -> np.ndarray:
    """A bitmap with the leading bits of the keys of all pairs that occur ``least`` times.

    Buckets are ranges of keys; each gives its stretch of the map, so what reaches the driver is the map.
    """
    buckets = max(4 * common.partitions(texts.sparkSession), -(-size // BUCKET_BYTES))
    span = max(8, -(-(1 << MAP_BITS) // buckets) // 8 * 8)

    def combine(batches):
        for chunk, names in _chunks(batches, codes, CHUNK):
            keys, counts = chunk.pairs(names)
            bucket = (keys >> np.uint64(_PAIR_BITS - MAP_BITS)).astype(np.int64) // span
            edges = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
            rows = [(int(bucket[low]), _PAIRS, None, _packed([keys[low:high], counts[low:high]]), None)
                    for low, high in zip(edges, [*edges[1:], len(keys)])]
            if rows:
                yield _batch(rows)

    def stretch(table: pa.Table) -> pa.Table:
        keys, counts = np.concatenate([_unpacked(d.as_py(), 2) for d in table.column(3)], axis=1)
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        begin = np.flatnonzero(np.diff(keys, prepend=keys[0] - np.uint64(1)))
        keys = keys[begin][np.add.reduceat(counts, begin) >= least]
        bucket = table.column(0)[0].as_py()
        bits = np.zeros(span, np.uint8)
        bits[(keys >> np.uint64(_PAIR_BITS - MAP_BITS)).astype(np.int64) - bucket * span] = 1
        return pa.table({"first": pa.array([bucket * span // 8]), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    out = np.zeros((1 << MAP_BITS) // 8 + span, np.uint8)
    found = texts.select("lang", "text").mapInArrow(combine, _BLOCK).groupBy("bucket").applyInArrow(stretch, "first bigint, bits binary")
    for r in found.collect():
        out[r["first"]:r["first"] + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out[:(1 << MAP_BITS) // 8]


def _hot_nodes(texts: DataFrame, size: int, frequent: np.ndarray, codes: _Codes) -> np.ndarray:
    """Nodes that a sample of about ``SAMPLE_BYTES`` shows with very many successors; at most ``HOT_NODES``."""
    def busy(batches):
        for chunk, names in _chunks(batches, codes, CHUNK):
            for lang, grams, _, _ in chunk.languages(names, frequent):
                node, successors = np.unique(_nodes(lang, grams)[grams[-1] > 0], return_counts=True)
                hot = successors >= HOT
                yield pa.RecordBatch.from_pydict({"node": pa.array(node[hot].view(np.int64)), "n": pa.array(successors[hot])})

    found = (_sample(texts, size).mapInArrow(busy, "node bigint, n bigint").groupBy("node").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "node").limit(HOT_NODES).collect())
    return np.array([r["node"] for r in found], np.int64).view(np.uint64)


def flows(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``(lang, w1, w2, w3, w4, f, word)``: every phrase of one to four words that occurs ``least`` times, and its count.

    Words are numbers, 0 behind the last; ``word`` has the text of single words.  A row without words has the number
    of all words of its language.  Null texts are empty, a null language is ``und``, repeated rows count as often as they
    stand, an empty table gives no rows.  Long texts are worked on in windows that end where a piece does.
    """
    spark = docs.sparkSession
    steps = common.Steps(spark, "collocations")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * common.partitions(spark), -(-size // BUCKET_BYTES))
    codes = usual_words(docs, size)
    frequent = frequent_pairs(docs, size, least, codes)
    hot = _hot_nodes(docs, size, frequent, codes)

    def combine(batches):
        """Distinct grams and words of each chunk, to the buckets of their nodes."""
        for chunk, names in _chunks(batches, codes, CHUNK):
            for lang, grams, counts, (words, times, starts, lengths, data) in chunk.languages(names, frequent):
                node = _nodes(lang, grams)
                spread = np.isin(node, hot)
                node[spread] = _key(node[spread], grams[-1][spread])
                rows = [(bucket, _GRAMS, lang, _packed([c[at] for c in (*grams, counts)]), None)
                        for bucket, at in _placed(node, grams[0], buckets)]
                number = _key(np.full(len(words), _lang_key(lang)), words)
                # The text of a word with a code is known.
                lengths[words < _HASHED] = 0
                rows += [(bucket, _WORDS, lang, _packed([words[at], times[at], lengths[at]]),
                          _gathered(data, starts[at], lengths[at])) for bucket, at in _placed(number, words, buckets)]
                yield _batch(rows)

    def grouped(table: pa.Table, kind: int, columns: int) -> dict[str, list]:
        """Blocks of a kind by language."""
        out: dict[str, list] = {}
        for row in table.to_batches():
            for k, lang, data, text in zip(*(row.column(i).to_pylist() for i in (1, 2, 3, 4))):
                if k == kind:
                    out.setdefault(lang, []).append((_unpacked(data, columns), text))
        return out

    def edges(table: pa.Table) -> pa.Table:
        """Whole counts of edges, flow of nodes, and what the nodes of a bucket give to the flow of pairs."""
        bucket, rows = table.column(0)[0].as_py(), []
        for lang, blocks in grouped(table, _GRAMS, LONGEST + 1).items():
            *grams, counts = np.concatenate([b for b, _ in blocks], axis=1)
            order = np.lexsort(grams[::-1])
            grams, counts = [g[order] for g in grams], counts[order]
            out, new = [], np.zeros(len(order), bool)
            new[:1] = True
            for k in range(1, LONGEST + 1):
                new[1:] |= grams[k - 1][1:] != grams[k - 1][:-1]
                if k < 2:
                    continue
                begin = np.flatnonzero(new & (grams[k - 1] > 0))
                if not len(begin):
                    continue
                # Sums end at the next change, also where that has no k-th word.
                stops = np.append(np.flatnonzero(new), len(order))
                ahead = np.concatenate([np.zeros(1, np.uint64), np.cumsum(counts)])
                flow = ahead[stops[np.searchsorted(stops, begin) + 1]] - ahead[begin]
                if k == 2:
                    number = _key(np.full(len(begin), _lang_key(lang)), grams[0][begin], grams[1][begin])
                    rows += [(to, _PAIRS, lang, _packed([grams[0][begin][at], grams[1][begin][at], flow[at]]), None)
                             for to, at in _placed(number, grams[0][begin], buckets)]
                    continue
                keep = flow >= least
                if k == LONGEST - 1 and len(hot):
                    keep |= np.isin(_nodes(lang, [g[begin] for g in grams]), hot)
                begin, flow = begin[keep], flow[keep]
                none = np.zeros(len(begin), np.uint64)
                out.append([*[g[begin] for g in grams[:k]], *[none] * (LONGEST - k), flow])
            if out:
                rows.append((bucket, _GRAMS, lang, _packed([np.concatenate(c) for c in zip(*out)]), None))
        for lang, blocks in grouped(table, _WORDS, 3).items():
            words, times, lengths = np.concatenate([b for b, _ in blocks], axis=1)
            text = np.frombuffer(b"".join([t for _, t in blocks]), np.uint8)
            starts = np.cumsum(lengths).astype(np.int64) - lengths.astype(np.int64)
            order = np.argsort(words, kind="stable")
            begin = np.flatnonzero(np.diff(words[order], prepend=np.uint64(0)))
            flow = np.add.reduceat(times[order], begin)
            at = order[begin][flow >= least]
            rows.append((bucket, _TOTAL, lang, _packed([times.sum(keepdims=True)]), None))
            if len(at):
                rows.append((bucket, _WORDS, lang, _packed([words[at], flow[flow >= least], lengths[at]]),
                             _gathered(text, starts[at], lengths[at].astype(np.int64))))
        return pa.Table.from_batches([_batch(rows)])

    def flat(lang: str, columns: list[np.ndarray], flow: np.ndarray, text=None) -> pa.RecordBatch:
        none = np.zeros(len(flow), np.uint64)
        columns = [*columns, *[none] * (LONGEST - len(columns))]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(flow), pa.string()), *[pa.array(np.asarray(c, np.uint64).view(np.int64)) for c in columns],
             pa.array(np.asarray(flow, np.uint64).view(np.int64)), pa.array(text or [None] * len(flow), pa.string())],
            ["lang", "w1", "w2", "w3", "w4", "f", "word"])

    def pairs(table: pa.Table) -> pa.Table:
        """Flow of pairs; all else passes through."""
        out = [pa.RecordBatch.from_pylist([], schema=flat("", [], np.zeros(0)).schema)]
        for lang, blocks in grouped(table, _PAIRS, 3).items():
            first, second, flow = np.concatenate([b for b, _ in blocks], axis=1)
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            new = np.ones(len(order), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
            begin = np.flatnonzero(new)
            flow = np.add.reduceat(flow[order], begin)
            at = begin[flow >= least]
            out.append(flat(lang, [first[at], second[at]], flow[flow >= least]))
        for lang, blocks in grouped(table, _GRAMS, LONGEST + 1).items():
            for block, _ in blocks:
                out.append(flat(lang, list(block[:-1]), block[-1]))
        for lang, blocks in grouped(table, _TOTAL, 1).items():
            out.append(flat(lang, [], np.concatenate([b[0] for b, _ in blocks])))
        for lang, blocks in grouped(table, _WORDS, 3).items():
            for (words, flow, lengths), text in blocks:
                ends = np.cumsum(lengths).tolist()
                spelled = [text[e - n:e].decode() if n else codes.text(w) for w, e, n in zip(words.tolist(), ends, lengths.tolist())]
                out.append(flat(lang, [words], flow, spelled))
        return pa.Table.from_batches(out)

    blocks = docs.select("lang", "text").mapInArrow(combine, _BLOCK).groupBy("bucket").applyInArrow(edges, _BLOCK)
    found = steps.keep(blocks.groupBy("bucket").applyInArrow(pairs, _FLAT), "flows")
    key = ["lang", "w1", "w2", "w3", "w4"]
    return found.groupBy(*key).agg(F.sum("f").alias("f"), F.max("word").alias("word")).where((F.col("f") >= least) | (F.col("w1") == 0))


_WORDS_OF = [f"w{i}" for i in range(1, LONGEST + 1)]


def _gram(begin: int, end: int):
    """Words ``begin`` to ``end`` of a row's phrase as a phrase of its own."""
    named = [F.col(w) for w in _WORDS_OF[begin:end]] + [F.lit(0).cast("bigint")] * (LONGEST - end + begin)
    return [column.alias(w) for column, w in zip(named, _WORDS_OF)]


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, most: int = MOST) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``most`` best phrases of each language.

    A phrase of two to four words that occurs ``a >= least`` times has the score of its weakest cut, floor(2000000 * a / (l + r)).
    Phrases that a longer one holds, which occurs at least ``share`` percent as often, are left out.  Ties go by count, then by
    the phrase's bytes.  Nulls, repeated rows and empty tables are as :func:`flows` says; other columns are not read.
    """
    steps = common.Steps(docs.sparkSession, "phrases")
    key = ["lang", *_WORDS_OF]
    # Flows are few: a phrase is among them only if it occurs ``least`` times.
    counts = steps.keep(flows(docs, least), "counts")
    length = sum((F.col(w) != 0).cast("int") for w in _WORDS_OF)
    phrases = counts.where("w2 <> 0").select(*key, F.col("f").alias("a"), length.alias("k"))

    # A phrase inside a longer one; a node whose edge in and edge out carry all its flow falls here too.
    def inside(k: int, size: int):
        return [F.struct(*_gram(i, i + size)) for i in range(k - size + 1)]

    parts = F.when(F.col("k") == 4, F.array(*inside(4, 3), *inside(4, 2))).otherwise(F.array(*inside(3, 2)))
    held = (phrases.where("k > 2").select("lang", "a", F.explode(parts).alias("g")).select("lang", "g.*", "a")
            .groupBy(*key).agg(F.max("a").alias("longer")))
    whole = F.col("a").cast("decimal(20,0)")
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= whole * share
    open_ = phrases.join(held, key, "left").where(F.col("longer").isNull() | ~covered).drop("longer")

    cuts = F.when(F.col("k") == 2, F.array(*[F.struct(F.lit(j).alias("cut"), F.struct(*_gram(0, j)).alias("left"),
                                                       F.struct(*_gram(j, 2)).alias("right")) for j in (1,)]))
    for k in (3, 4):
        cuts = cuts.when(F.col("k") == k, F.array(*[F.struct(
            F.lit(j).alias("cut"), F.struct(*_gram(0, j)).alias("left"), F.struct(*_gram(j, k)).alias("right")) for j in range(1, k)]))
    cut = open_.select(*key, "a", F.explode(cuts).alias("c")).select(*key, "a", "c.cut", "c.left", "c.right")
    for side in ("left", "right"):
        part = counts.where("w1 <> 0").select(F.col("lang").alias("_lang"), *[F.col(w).alias(f"_{w}") for w in _WORDS_OF],
                                              F.col("f").alias(side[0]))
        same = F.col("lang") == F.col("_lang")
        for w in _WORDS_OF:
            same &= F.col(f"{side}.{w}") == F.col(f"_{w}")
        cut = cut.join(part, same).drop("_lang", *[f"_{w}" for w in _WORDS_OF])
    score = F.expr(f"cast(a AS decimal(20,0)) * {SCALE} div cast(l + r AS decimal(20,0))").cast("bigint")
    weakest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m")
    scored = cut.groupBy(*key, "a").agg(weakest).select(*key, "a", "m.l", "m.r", "m.score")

    # Only what can be among the best is spelled; all that tie with the last of them are.
    place = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = scored.withColumn("place", F.rank().over(place)).where(F.col("place") <= most)
    names = counts.where("w1 <> 0 AND w2 = 0").select(F.col("lang").alias("_lang"), F.col("w1").alias("_w"), "word")
    for i, w in enumerate(_WORDS_OF):
        best = best.join(names.withColumnRenamed("word", f"word{i}"), (F.col("lang") == F.col("_lang")) & (F.col(w) == F.col("_w")),
                         "left").drop("_lang", "_w")
    best = best.withColumn("phrase", F.concat_ws(" ", *[f"word{i}" for i in range(LONGEST)]))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= most)
    total = counts.where("w1 = 0").select(F.col("lang").alias("_lang"), F.col("f").alias("n"))
    return (best.join(total, F.col("lang") == F.col("_lang"))
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(common.table(spark, folder, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, p FROM (
    SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\n\x0B\f\r]')) AS p FROM documents)),
listed AS (SELECT lang, [w FOR w IN string_split_regex(p, '[ \t]+') IF w <> ''] AS ws FROM pieces),
positions AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM listed),
grams AS (
  SELECT lang, g, count(*) AS f FROM (
    SELECT lang, array_to_string(ws[i:i + k - 1], ' ') AS g FROM positions, (SELECT unnest([1, 2, 3, 4]) AS k) AS ks
    WHERE i + k - 1 <= len(ws)) AS spelled GROUP BY lang, g),
totals AS (SELECT lang, count(*) AS n FROM positions GROUP BY lang),
candidates AS (
  SELECT lang, g, f AS a, string_split(g, ' ') AS ws FROM grams WHERE f >= 30 AND contains(g, ' ')),
cuts AS (
  SELECT lang, g, a, k, array_to_string(ws[1:k], ' ') AS first, array_to_string(ws[k + 1:len(ws)], ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM candidates) AS c),
scored AS (
  SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM cuts c JOIN grams x ON x.lang = c.lang AND x.g = c.first JOIN grams y ON y.lang = c.lang AND y.g = c.rest),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(ws[s:s + m - 1], ' ') AS g FROM
    (SELECT lang, a, ws, m, unnest(range(1, len(ws) - m + 2)) AS s FROM candidates, (SELECT unnest([2, 3]) AS m) AS ms
     WHERE m < len(ws)) AS p),
longer AS (SELECT lang, g, max(a) AS longest FROM inner_parts GROUP BY lang, g),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN longer o ON o.lang = w.lang AND o.g = w.g
  WHERE o.longest IS NULL OR 100::HUGEINT * o.longest < 80::HUGEINT * w.a),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS place FROM kept)
SELECT r.lang, place AS "rank", g AS phrase, a, l, r.r, n, score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE place <= 2000
"""
