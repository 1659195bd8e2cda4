"""Best-fit packing with a certificate: repack only where a lower bound leaves a gap.

Every partition packs its pieces best-fit decreasing and compares its bins with the lower bound
that dual-feasible functions give.  Partitions with a gap put the documents of their loosest
bins up for exchange; exchanged documents meet in partitions of bounded size and are packed again,
as long as that saves bins.
"""

import json
import re
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marginalia.llm import common

END = 1
CAPACITY = 4096
# Pieces that one partition packs, times as many that meet in an exchange, bins given up for each gap.
PIECES = 20_000
MEET = 16
LOOSE = 12
# Exchanges at most; the number of the round stands above 56 bits of a sequence's number.
ROUNDS = 100
# Words whose ids a worker remembers; the older half goes when it is full.
REMEMBERED = 600_000

# ``str.split`` also splits at these, which are no blanks of the tokenizer.
_ODD = "\x1c\x1d\x1e\x1f"
# Marks without an apostrophe, which may begin a contraction.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
# Workers live on from task to task, and so do the words they have seen.
_KNOWN: dict[str, "_Words"] = {}


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write bytes as: printable ones as they are."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class _Seen(dict):
    """Ids by word; words that are not there come from the generation before, or are made."""

    def __init__(self, made, before: dict):
        super().__init__()
        self.made, self.before = made, before

    def __missing__(self, word: str) -> bytes:
        found = dict.get(self.before, word)
        if found is None:
            found = self.made(word)
        self[word] = found
        return found


class _Words:
    """Ids of texts as little-endian 32-bit bytes, word by word.

    A tokenizer that turns blanks into word borders handles each word by itself, so the ids of a
    text are those of its words in a row.  Words in Latin-1 go straight to the model; others, and
    such that may hold a special token, through the whole tokenizer.
    """

    def __init__(self, tokenizer: Tokenizer, pattern: str):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.split, self.letters = regex.compile(pattern), _byte_letters()
        self.seen = _Seen(self._made, {})

    def _made(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(word.lower())])
        if "<|" in word or not word.isprintable() or not _latin(word):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        # Most words with marks are letters and then marks, which the pattern parts just so.
        core = word.rstrip(_MARKS)
        if core.isalpha() and len(core) < len(word):
            parts = [core.lower(), word[len(core):]]
        else:
            parts = self.split.findall(word.lower())
        if len(parts) > 1:
            return b"".join([self.seen[p] for p in parts])
        if not parts:
            return b""
        letters = parts[0] if parts[0].isascii() else parts[0].encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])

    def __call__(self, text: str) -> bytes:
        if "<|" not in text and _latin(text):
            text = text.lower()
        odd = any(c in text for c in _ODD)
        split = [w for w in re.split("[ \t-\r]+", text) if w] if odd else text.split()
        found = b"".join(map(self.seen.__getitem__, split))
        if len(self.seen) > REMEMBERED // 2:
            self.seen.before = {}
            self.seen = _Seen(self._made, self.seen)
        return found


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _ids(path: str):
    """A function from a text to its ids as bytes."""
    if path not in _KNOWN:
        tokenizer = Tokenizer.from_file(path)
        made = json.loads(tokenizer.to_str())
        steps = [s.get("type") for s in (made.get("normalizer") or {}).get("normalizers", [])]
        cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
        by_word = (steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
                   and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed"
                   and not cuts[1]["add_prefix_space"] and not cuts[1]["use_regex"])
        if by_word:
            _KNOWN[path] = _Words(tokenizer, cuts[0]["pattern"]["Regex"])
        else:
            _KNOWN[path] = lambda text: np.array(
                tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    return _KNOWN[path]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)``: the token ids of whole texts in pieces that fit.

    A document is its ids and the id 1, so null and empty texts give one piece of one id.
    ``ids`` holds unsigned 32-bit numbers, little-endian.  Only documents beyond ``capacity`` are
    cut.  Repeated rows give repeated pieces; ids may be null.  Other columns are not read.
    """
    def cut(batches):
        ids = _ids(path)
        step = 4 * capacity
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            rows, held = [], 0
            for key, text in zip(keys, texts):
                content = ids(text.as_py() or "") + END.to_bytes(4, "little")
                for i, at in enumerate(range(0, len(content), step)):
                    part = content[at:at + step]
                    rows.append((key, i, at // 4, len(part) // 4, part))
                held += len(content)
                if held > 8 * common.SLICE_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
            if rows:
                yield _batch(rows)

    return docs.select("doc_id", "text").mapInArrow(
        cut, "doc_id bigint, piece int, start bigint, length bigint, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
    names = ["doc_id", "piece", "start", "length", "ids"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit for lengths in the given order: bin and offset of each, and the room of each bin."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    room: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # the different rooms there are, ascending
    for i, length in enumerate(lengths.tolist()):
        at = bisect_left(rooms, length)
        if at < len(rooms):
            left = rooms[at]
            held = by_room[left]
            number = held.pop()
            if not held:
                del by_room[left], rooms[at]
        else:
            number, left = len(room), capacity
            room.append(capacity)
        bins[i], offsets[i] = number, capacity - left
        left -= length
        room[number] = left
        if left:
            if left in by_room:
                by_room[left].append(number)
            else:
                by_room[left] = [number]
                insort(rooms, left)
    return bins, offsets, np.array(room, np.int64)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces need at least, from how many there are of each length 0..capacity.

    The largest sum over two families of dual-feasible functions: one drops pieces shorter than
    ``k`` and counts those longer than ``capacity - k`` as whole bins; the other rounds
    ``(m + 1) * length / capacity`` down to steps of ``1 / m``, and leaves exact multiples alone.
    """
    counts = counts.astype(np.int64)
    length = np.arange(capacity + 1, dtype=np.int64)
    mass = np.cumsum(counts * length)
    number = np.cumsum(counts)
    best = -(-int(mass[-1]) // capacity)
    k = np.arange(1, capacity // 2 + 1)
    whole = number[-1] - number[capacity - k]
    middle = mass[capacity - k] - mass[k - 1]
    best = max(best, int((whole + -(-middle // capacity)).max()))
    for m in range(1, 33):
        scaled = (m + 1) * length
        exact = scaled % capacity == 0
        # In units of 1 / (m * (m + 1)).
        value = np.where(exact, scaled // capacity * m, scaled // capacity * (m + 1))
        best = max(best, -(-int((counts * value).sum()) // (m * (m + 1))))
    return best


_PLACED = "doc_id bigint, piece int, length bigint, copy bigint, grp bigint, bin bigint, offset bigint, gap bigint, loose boolean"


def _packed(capacity: int, last: bool):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "copy"], ascending=[False, True, True, True],
                                ignore_index=True)
        lengths = rows["length"].to_numpy()
        bins, offsets, room = best_fit(lengths, capacity)
        # The last bin of a partition is a gap too where its share of a bin could lie elsewhere.
        gap = len(room) - lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        loosest = np.argsort(-room, kind="stable")[:LOOSE * (gap + 1)]
        loose = np.zeros(len(room), bool)
        if not last:
            loose[loosest] = room[loosest] > 0
        return rows.assign(bin=bins, offset=offsets, gap=gap, loose=loose[bins])

    return pack


def placed(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Places ``(doc_id, piece, length, copy)`` rows: adds ``sequence_id`` and ``offset``.

    ``copy`` tells repeated rows apart.  Round 0 deals pieces evenly to partitions of about
    ``PIECES``; in each further round the pieces of the loosest bins are dealt anew to partitions
    of about ``MEET * PIECES``.  A partition whose bins reach its bound has closed all but its last
    bins; ``gap`` is what it could still save.  Where lengths keep the bound out of reach, most
    bins stay loose: then rounds end as soon as one saves no bins, and the bins before it stand.
    So no partition grows with the input, and no exchange makes the packing worse.
    """
    steps = common.Steps(lengths.sparkSession, "packing")
    rows, groups, entered = lengths, max(1, -(-lengths.count() // PIECES)), None
    done, number, before = [], 0, None
    while True:
        last = groups == 1 or number == ROUNDS
        # Other pieces meet in each round, also in as many partitions as before.
        deal = common.spread(F.struct("doc_id", "piece", "copy", F.lit(number)), groups).cast("bigint")
        packed = rows.select("doc_id", "piece", "length", "copy", deal.alias("grp")).groupBy("grp").applyInPandas(
            _packed(capacity, last), _PLACED)
        packed = steps.keep(packed, f"round-{number}")
        counted = packed.groupBy("grp", "bin").agg(F.count("*").alias("n"), F.first("loose").alias("loose"))
        bins, loose, pieces_left = counted.agg(F.count("*"), F.count_if("loose"),
                                               F.sum(F.when(F.col("loose"), F.col("n")))).first()
        if entered is not None and bins >= entered:
            done.append(before.where("loose"))
            break
        sequence = F.col("bin") + F.col("grp") * F.lit(1 << 32) + F.lit(number << 56)
        packed = packed.select("doc_id", "piece", "length", "copy", sequence.alias("sequence_id"), "offset", "loose")
        done.append(packed.where("NOT loose"))
        if not loose:
            break
        before, entered, rows = packed, loose, packed.where("loose")
        groups, number = -(-pieces_left // (MEET * PIECES)), number + 1
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.drop("loose")


def certificate(result: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row ``(sequences, bound)``: bins used, and bins that any packing needs.

    Lengths are counted first, so that the bound is worked out from ``capacity`` numbers.
    """
    counted = result.groupBy("length").count()
    bins = result.agg(F.countDistinct("sequence_id").alias("sequences"))

    def bound(batches):
        counts = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            counts[batch.column(0).to_numpy()] += batch.column(1).to_numpy()
        yield pa.RecordBatch.from_pydict({"bound": pa.array([lower_bound(counts, capacity)], pa.int64())})

    # Two tables of one row each.
    return bins.withColumn("k", F.lit(0)).join(
        counted.coalesce(1).mapInArrow(bound, "bound bigint").withColumn("k", F.lit(0)), "k").drop("k")


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` for all documents.

    The token ids are made once; only lengths and checksums are kept for the packing.  Null and
    empty texts are one id long, repeated rows are packed as often as they stand, and an empty
    table gives an empty result.  Other columns are not read.
    """
    path = path or str(public_tokenizers.path("word_bpe_49k.json"))
    steps = common.Steps(docs.sparkSession, "pieces")
    found = pieces(docs, path, capacity).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
        F.monotonically_increasing_id().alias("copy"))
    found = steps.keep(found, "pieces")
    where = placed(found.select("doc_id", "piece", "length", "copy"), capacity)
    return found.join(where.select("copy", "sequence_id", "offset"), "copy").drop("copy")


def sequences(docs: DataFrame, result: DataFrame, path: str | None = None,
              capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, ids as 32-bit numbers in bytes.

    A sequence has at most ``capacity`` pieces, so its list is bounded.
    """
    path = path or str(public_tokenizers.path("word_bpe_49k.json"))
    content = pieces(docs, path, capacity).select("doc_id", "piece", "ids", F.crc32("ids").alias("ids_crc32"))
    content = content.dropDuplicates(["doc_id", "piece", "ids_crc32"]).select(
        F.col("doc_id").alias("d"), F.col("piece").alias("p"), F.col("ids_crc32").alias("c"), "ids")
    same = (F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("piece") == F.col("p"))
            & (F.col("ids_crc32") == F.col("c")))
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("h"))))
    return (result.join(content, same).groupBy("sequence_id").agg(parts.alias("parts"))
            .select("sequence_id", F.unhex(F.array_join(F.col("parts.h"), "")).alias("ids")))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return pack(common.table(spark, folder, "documents"))
