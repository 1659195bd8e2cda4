"""Tokens of sentences and what follows from them, as arrays over an Arrow batch.

An expression on the elements of an array is interpreted node by node for each element.  Here a batch of
sentences is one array of characters, and all tokens of it are found, placed and tagged at once.  What counts as a letter, a digit or a
capital is asked of the engine's regexes once per session, so that both agree on every character.
"""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginalia.session import shipped

# What makes a token a word, and a word a name.
WORD_SIGN = r"[\p{L}\p{N}_]"
CAPITAL = r"^\p{Lu}"
# Kinds of characters: blank, word sign, capital among them, any other.
OTHER, BLANK, WORD, CAPITAL_WORD = range(4)

TOKEN_TYPE = "array<struct<start:bigint,end:bigint,text:string>>"
TAGGED_TYPE = "array<struct<start:bigint,end:bigint,text:string,tag:string>>"
PHRASE_TYPE = "array<struct<start:bigint,end:bigint,head:string,head_no:bigint>>"
DOCUMENT_PHRASE_TYPE = "array<struct<sent_no:bigint,start:bigint,end:bigint,text:string,head:string,head_no:bigint>>"
GRAM_TYPE = "array<struct<i:int,n:int,start:bigint,end:bigint,key:string>>"

# Of tokens and the kinds of their first characters: names of tags, and the number of each token's.
Tags = Callable[[pa.Array, np.ndarray], tuple[list[str], np.ndarray]]

_RANGES: dict[str, bytes] = {}
_TABLE: dict[bytes, np.ndarray] = {}


def kind_ranges(spark: SparkSession) -> bytes:
    """First character, last character and kind of every stretch of word signs of one kind, as the engine sees them."""
    key = spark.sparkContext.applicationId
    if key not in _RANGES:
        char = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
        found = (spark.range(0, 0x110000).where(~F.col("id").between(0xD800, 0xDFFF))
                 .select("id", char.alias("c")).where(F.col("c").rlike(WORD_SIGN))
                 .select("id", F.col("c").rlike(CAPITAL).alias("capital")).toArrow())
        at = found["id"].to_numpy()
        kind = np.where(found["capital"].to_numpy(), CAPITAL_WORD, WORD)
        order = np.argsort(at)
        at, kind = at[order], kind[order]
        new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(kind) != 0)])
        last = np.r_[new[1:], len(at)] - 1
        _RANGES[key] = np.stack([at[new], at[last], kind[new]], 1).astype("<i4").tobytes()
    return _RANGES[key]


def kind_table(ranges: bytes) -> np.ndarray:
    """The kind of every character, from :func:`kind_ranges`."""
    if ranges not in _TABLE:
        table = np.zeros(0x110000, np.uint8)
        for first, last, kind in np.frombuffer(ranges, "<i4").reshape(-1, 3).tolist():
            table[first:last + 1] = kind
        table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = BLANK
        _TABLE[ranges] = table
    return _TABLE[ranges]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of texts in UTF-8; null texts are empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, where, content = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(content, np.uint8)[offsets[0]:offsets[-1]] if content else np.zeros(0, np.uint8)
    return offsets - offsets[0], data


def _flags(chars: str) -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[[ord(c) for c in chars]] = True
    return flags


_BLANKS, _STOPS = _flags(" \t\n\x0b\f\r"), _flags(".!?")


class Texts:
    """The characters of a batch: their ``kind``, the bytes each begins at, and ``edges``, the first character of each row."""

    def __init__(self, texts: pa.Array, table: np.ndarray):
        offsets, self.data = _bytes_of(texts)
        self.lead = None
        if len(self.data) and self.data.max() > 127:
            try:
                chars = np.frombuffer(self.data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
            except UnicodeDecodeError:
                # Broken bytes read as the replacement character, as the engine has it.
                clean = [self.data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
                offsets, self.data = _bytes_of(pa.array(clean, pa.large_string()))
                chars = np.frombuffer("".join(clean).encode("utf-32-le"), "<u4")
            self.kind = table[chars]
            self.lead = np.append(np.flatnonzero((self.data & 0xC0) != 0x80), len(self.data))
            self.edges = np.searchsorted(self.lead, offsets)
        else:
            self.kind, self.edges = table[self.data], offsets

    def at(self, places: np.ndarray) -> np.ndarray:
        """The byte a character begins at."""
        return places if self.lead is None else self.lead[places]

    def is_any(self, flags: np.ndarray) -> np.ndarray:
        """Which characters are among some of ASCII."""
        return flags[self.data if self.lead is None else self.data[self.lead[:-1]]]

    def cut(self, low: np.ndarray, high: np.ndarray) -> pa.Array:
        """The texts of places."""
        return _cut(self.data, self.at(low), self.at(high))

    def paragraphs(self) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the runs without newlines of all rows."""
        line = ~self.is_any(_flags("\n"))
        goes_on = np.zeros(len(line) + 1, bool)
        goes_on[1:-1] = line[1:] & line[:-1]
        goes_on[self.edges] = False
        return np.flatnonzero(line & ~goes_on[:-1]), np.flatnonzero(line & ~goes_on[1:]) + 1

    def row_of(self, places: np.ndarray) -> np.ndarray:
        """The row of characters."""
        return np.searchsorted(self.edges, places, "right") - 1

    def sentences(self) -> np.ndarray:
        """Where the sentences of all rows begin: with a run without newlines, and behind stops and the blanks after them."""
        n = len(self.kind)
        newline, stop, blank = self.is_any(_flags("\n")), self.is_any(_STOPS), self.kind == BLANK
        opens = np.zeros(n, bool)
        opens[self.edges[:-1][self.edges[:-1] < n]] = True
        opens[1:] |= newline[:-1]
        # The last character before that is no blank of its run.
        seen = np.full(n, -1)
        if n:
            seen[1:] = np.maximum.accumulate(np.where(~blank | newline | (blank & opens), np.arange(n), -1))[:-1]
        behind = np.zeros(n, bool)
        behind[seen >= 0] = stop[seen[seen >= 0]]
        on = np.zeros(n, bool)
        on[1:] = stop[1:] & stop[:-1]
        return np.flatnonzero(~newline & (opens | (~blank & ~on & behind)))


def _cut(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    where = np.zeros(len(begin) + 1, np.int64)
    np.cumsum(end - begin, out=where[1:])
    return _strings(where, data[np.repeat(begin - where[:-1], end - begin) + np.arange(where[-1])])


def _strings(where: np.ndarray, content: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.string(), len(where) - 1, [None, pa.py_buffer(where.astype(np.int32)), pa.py_buffer(content)])


class Words:
    """Tokens of a batch: places ``low, high`` among its characters, ``row``, ``kind`` of the first character and ``text``."""

    def __init__(self, texts: Texts):
        kind, edges = texts.kind, texts.edges
        blank, word = kind == BLANK, kind >= WORD
        # A word sign goes on with the word before it, unless a row begins here.
        same = np.zeros(len(kind) + 1, bool)
        same[1:-1] = word[1:] & word[:-1]
        same[edges] = False
        self.low = np.flatnonzero(~blank & ~same[:-1])
        self.high = np.flatnonzero(~blank & ~same[1:]) + 1
        self.first_of_row = np.searchsorted(self.low, edges)
        counts = np.diff(self.first_of_row)
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.kind = kind[self.low]
        where = np.zeros(len(self.low) + 1, np.int64)
        np.cumsum(texts.at(self.high) - texts.at(self.low), out=where[1:])
        # Tokens are all that is not blank, in order; blanks have one byte.
        self.text = _strings(where, texts.data[~_BLANKS[texts.data]])

    def tags(self, first: np.ndarray, tags_of: "Tags", name: str, other: str) -> tuple[list[str], np.ndarray]:
        """Names of tags, and the number of each token's; see :func:`tagged_arrays`."""
        coded = self.text.dictionary_encode()
        kinds = np.zeros(len(coded.dictionary), np.uint8)
        numbers = coded.indices.to_numpy()
        kinds[numbers] = self.kind
        names, found = tags_of(coded.dictionary, kinds)
        codes = found[numbers]
        codes[first & (codes == names.index(name))] = names.index(other)
        return names, codes


def _placed(texts: Texts, words: Words, start: pa.Array) -> dict[str, pa.Array]:
    base = pc.fill_null(start, 0).to_numpy(zero_copy_only=False) - texts.edges[:-1]
    gone = start.is_null().to_numpy(zero_copy_only=False)[words.row] if start.null_count else None
    base = base[words.row]
    return {"start": pa.array(base + words.low, mask=gone), "end": pa.array(base + words.high, mask=gone), "text": words.text}


def _listed(first_of_row: np.ndarray, columns: dict[str, pa.Array], nothing: pa.Array | None) -> pa.Array:
    """One array of structs per row; null where ``nothing`` is null."""
    items = pa.StructArray.from_arrays(list(columns.values()), list(columns))
    mask = nothing.is_null() if nothing is not None and nothing.null_count else None
    return pa.ListArray.from_arrays(pa.array(first_of_row.astype(np.int32)), items, mask=mask)


def token_arrays(spark: SparkSession) -> Callable[[Column, Column], Column]:
    """Function of a sentence's text and start: array of ``{start,end,text}``."""
    ranges = kind_ranges(shipped(spark))

    @F.arrow_udf(TOKEN_TYPE)
    def tokens(text: pa.Array, start: pa.Array) -> pa.Array:
        texts = Texts(text, kind_table(ranges))
        words = Words(texts)
        return _listed(words.first_of_row, _placed(texts, words, start), text)

    return tokens


def tagged_arrays(spark: SparkSession, tags_of: Tags, name: str, other: str) -> Callable[[Column, Column], Column]:
    """As :func:`token_arrays`, with ``tag``: each distinct token of a batch is tagged once.

    ``tags_of`` gets tokens and the kinds of their first characters; the first token of a sentence has ``other`` in place of ``name``.
    """
    ranges = kind_ranges(shipped(spark))

    @F.arrow_udf(TAGGED_TYPE)
    def tagged(text: pa.Array, start: pa.Array) -> pa.Array:
        texts = Texts(text, kind_table(ranges))
        words = Words(texts)
        first = np.zeros(len(words.low) + 1, bool)
        first[words.first_of_row] = True
        names, codes = words.tags(first[:-1], tags_of, name, other)
        tag = pa.array(names, pa.string()).take(pa.array(codes))
        return _listed(words.first_of_row, {**_placed(texts, words, start), "tag": tag}, text)

    return tagged


def _items(toks: pa.ListArray) -> tuple[np.ndarray, pa.StructArray]:
    """Number of the first item of each row, with one more at the end, and the items; null rows have none."""
    items, counts = toks.flatten(), pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(counts)]), items


def _phrases(unit: np.ndarray, codes: np.ndarray, names: list, nouns, inside, alone) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First, last and head token of the phrases; a run stays within a unit."""
    n = len(codes)
    flags = lambda holds: np.array([holds(tag) for tag in names], bool)[codes]
    noun, single = flags(lambda tag: tag in nouns), flags(lambda tag: tag == alone)
    part = noun | flags(lambda tag: tag in inside)
    goes_on = np.zeros(n + 1, bool)
    goes_on[1:n] = part[1:] & part[:-1] & (unit[1:] == unit[:-1])
    low = np.flatnonzero((part | single) & ~goes_on[:n])
    high = np.flatnonzero((part | single) & ~goes_on[1:])
    # The last noun at or before the end of a run.
    seen = np.maximum.accumulate(np.where(noun, np.arange(n), -1)) if n else np.zeros(0, np.int64)
    head = np.where(single[low], low, seen[high])
    kept = head >= low
    return low[kept], high[kept], head[kept]


def phrase_arrays(spark: SparkSession, nouns: tuple[str, ...], inside: tuple[str, ...], alone: str) -> Callable[[Column], Column]:
    """Function of ``toks``: array of ``{start,end,head,head_no}``.

    A phrase is a run of tags ``inside`` with one of ``nouns`` among them, the last of which is its head, or one token tagged ``alone``.
    """
    shipped(spark)

    @F.arrow_udf(PHRASE_TYPE)
    def phrases(toks: pa.Array) -> pa.Array:
        first, items = _items(toks)
        coded = items.field("tag").dictionary_encode()
        names = [*coded.dictionary.to_pylist(), None]
        codes = pc.fill_null(coded.indices, len(names) - 1).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        low, high, head = _phrases(row, codes, names, nouns, inside, alone)
        of = lambda name, places: items.field(name).take(pa.array(places))
        return _listed(np.searchsorted(low, first), {
            "start": of("start", low), "end": of("end", high), "head": of("text", head),
            "head_no": pa.array(head - first[row[head]] + 1)}, toks)

    return phrases


def document_phrase_arrays(spark: SparkSession, tags_of: Tags, name: str, other: str,
                           nouns: tuple[str, ...], inside: tuple[str, ...], alone: str) -> Callable[[Column], Column]:
    """Function of a document's text: array of ``{sent_no,start,end,text,head,head_no}`` through all its sentences, in order.

    Sentences, tags and phrases are those of the functions above, for a document without stored layers.
    """
    ranges = kind_ranges(shipped(spark))

    @F.arrow_udf(DOCUMENT_PHRASE_TYPE)
    def phrases(text: pa.Array) -> pa.Array:
        texts = Texts(text, kind_table(ranges))
        words, sents = Words(texts), texts.sentences()
        unit = np.searchsorted(sents, words.low, "right") - 1
        # Tokens come in order, so those of a sentence are one stretch.
        first = np.ones(len(unit), bool)
        first[1:] = unit[1:] != unit[:-1]
        names, codes = words.tags(first, tags_of, name, other)
        low, high, head = _phrases(unit, codes, names, nouns, inside, alone)
        row, of_sentence = words.row[low], np.flatnonzero(first)
        ahead = np.searchsorted(sents, texts.edges[:-1])
        tok_no = head - of_sentence[np.searchsorted(of_sentence, head, "right") - 1] + 1
        return _listed(np.searchsorted(low, words.first_of_row), {
            "sent_no": pa.array(unit[low] - ahead[row]), "start": pa.array(words.low[low] - texts.edges[row]),
            "end": pa.array(words.high[high] - texts.edges[row]), "text": texts.cut(words.low[low], words.high[high]),
            "head": words.text.take(pa.array(head)), "head_no": pa.array(tok_no)}, text)

    return phrases


# Texts whose rows are made at once, so that the columns beside them stay small; one text is never cut.
PIECE_BYTES = 1 << 20


def _pieces(batches, column: str):
    """Batches of about ``PIECE_BYTES`` of texts in ``column``."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        row, done = 0, 0
        while row < batch.num_rows:
            last = max(row + 1, int(np.searchsorted(ends, done + PIECE_BYTES, "right")))
            yield batch.slice(row, last - row)
            row, done = last, int(ends[last - 1])


def _batch(keys: dict[str, pa.Array], row: np.ndarray, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    row = pa.array(row)
    held = {name: key.take(row) for name, key in keys.items()}
    return pa.RecordBatch.from_arrays([*held.values(), *columns.values()], [*held, *columns])


def token_rows(sents: DataFrame) -> DataFrame:
    """``doc_id, sent_no, tok_no, start, end, text`` of rows ``doc_id, sent_no, start, text``; one row a token."""
    ranges = kind_ranges(shipped(sents.sparkSession))

    def rows(batches):
        for batch in _pieces(batches, "text"):
            texts = Texts(batch.column("text"), kind_table(ranges))
            words = Words(texts)
            number = np.arange(len(words.low)) - words.first_of_row[:-1][words.row] + 1
            yield _batch({name: batch.column(name) for name in ("doc_id", "sent_no")}, words.row,
                         {"tok_no": pa.array(number), **_placed(texts, words, batch.column("start"))})

    sents = sents.select("doc_id", F.col("sent_no").cast("bigint").alias("sent_no"), F.col("start").cast("bigint").alias("start"), "text")
    kept = StructType([sents.schema["doc_id"], sents.schema["sent_no"]])
    return sents.mapInArrow(rows, StructType([*kept, *_fields("tok_no bigint, start bigint, end bigint, text string")]))


def _fields(ddl: str) -> list:
    return StructType.fromDDL(ddl).fields


def layer_rows(df: DataFrame, sets: dict[str, str], step: int, tags_of: Tags, name: str, other: str) -> DataFrame:
    """``doc_id, set, ann_id, start, end, type``: one row for each paragraph, sentence, token and tag that is asked for.

    ``sets`` names the sets ``par, sent, token, pos``, of which ``df`` has a flag each under that name.  Its rows are
    documents ``doc_id, text``, or, with a column ``sent_no``, sentences ``doc_id, sent_no, start, end, text`` and no
    flag ``par``.  Tags are those of :func:`tagged_arrays`; a token's id is its number in the sentence plus ``step`` times that of the sentence.
    """
    ranges, whole = kind_ranges(shipped(df.sparkSession)), "sent_no" not in df.columns

    def rows(batches):
        for batch in _pieces(batches, "text"):
            column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
            keys = {"doc_id": batch.column("doc_id")}

            def out(layer, row, ann_id, start, end, kind, chosen):
                at = slice(None) if chosen.all() else np.flatnonzero(chosen)
                ids, kind = row[at], kind if isinstance(kind, str) else pa.array(kind[1], pa.string()).take(pa.array(kind[0][at]))
                return _batch(keys, ids, {
                    "set": pa.repeat(sets[layer], len(ids)), "ann_id": pa.array(ann_id[at]), "start": pa.array(start[at]),
                    "end": pa.array(end[at]), "type": pa.repeat(kind, len(ids)) if isinstance(kind, str) else kind})

            texts = Texts(batch.column("text"), kind_table(ranges))
            edge = texts.edges[:-1]
            if whole:
                low, high = texts.paragraphs()
                row = texts.row_of(low)
                if column("par").any():
                    number = np.arange(len(low)) - np.searchsorted(low, edge)[row]
                    yield out("par", row, number, low - edge[row], high - edge[row], "paragraph", column("par")[row])
                if not column("sent").any() and not column("token").any() and not column("pos").any():
                    continue
                begin = texts.sentences()
                # A sentence ends where the next one of its paragraph begins, or with the paragraph.
                stops = np.union1d(begin, high)
                row, stop = texts.row_of(begin), stops[np.searchsorted(stops, begin, "right")]
                base = -edge
                sent_no = np.arange(len(begin)) - np.searchsorted(begin, edge)[row]
                start, end = begin - edge[row], stop - edge[row]
            else:
                row, sent_no, start, end = np.arange(batch.num_rows), column("sent_no"), column("start"), column("end")
                base = start - edge
            if column("sent").any():
                yield out("sent", row, sent_no, start, end, "sentence_split", column("sent")[row])
            if not column("token").any() and not column("pos").any():
                continue
            words = Words(texts)
            unit = np.searchsorted(begin, words.low, "right") - 1 if whole else words.row
            first = np.ones(len(unit), bool)
            first[1:] = unit[1:] != unit[:-1]
            opening = np.flatnonzero(first)
            number = np.arange(len(unit)) - np.repeat(opening, np.diff(np.r_[opening, len(unit)])) + 1
            place = [words.row, sent_no[unit] * step + number, words.low + base[words.row], words.high + base[words.row]]
            if column("token").any():
                yield out("token", *place, "token", column("token")[words.row])
            if column("pos").any():
                names, codes = words.tags(first, tags_of, name, other)
                yield out("pos", *place, (codes, names), column("pos")[words.row])

    return df.mapInArrow(rows, StructType([df.schema["doc_id"], *_fields(
        "set string, ann_id bigint, start bigint, end bigint, type string")]))


def gram_arrays(spark: SparkSession, lengths: list[int]) -> Callable[[Column], Column]:
    """Function of ``toks``: array of ``{i,n,start,end,key}``, the runs of ``n`` tokens from the ``i``-th on, for each of ``lengths``.

    ``key`` has the tokens in lower case with a space between two.
    """
    shipped(spark)

    @F.arrow_udf(GRAM_TYPE)
    def grams(toks: pa.Array) -> pa.Array:
        first, items = _items(toks)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        coded = pc.fill_null(items.field("text"), "").dictionary_encode()
        low = pa.array([text.lower() + " " for text in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
        offsets, data = _bytes_of(low)
        begins = [np.flatnonzero(np.arange(len(row)) + n <= first[1:][row]) for n in lengths]
        size = np.repeat(lengths, [len(at) for at in begins])
        at = np.concatenate(begins)
        order = np.argsort(row[at], kind="stable")
        at, size = at[order], size[order]
        place = {"i": pa.array((at - first[row[at]]).astype(np.int32)), "n": pa.array(size.astype(np.int32)),
                 "start": items.field("start").take(pa.array(at)), "end": items.field("end").take(pa.array(at + size - 1)),
                 "key": _cut(data, offsets[at], offsets[at + size] - 1)}
        return _listed(np.searchsorted(row[at], np.arange(len(first))), place, toks)

    return grams


def spelled_arrays(spark: SparkSession) -> Callable[[Column, Column, Column], Column]:
    """Function of a text, its start and an array of ``{start,end}`` in it: array of ``{start,end,text}``."""
    ranges = kind_ranges(shipped(spark))

    @F.arrow_udf(TOKEN_TYPE)
    def spelled(text: pa.Array, start: pa.Array, places: pa.Array) -> pa.Array:
        texts = Texts(text, kind_table(ranges))
        first, items = _items(places)
        row = np.repeat(np.arange(len(first) - 1), np.diff(first))
        edge, limit = texts.edges[:-1][row], texts.edges[1:][row]
        base = edge - pc.fill_null(start, 0).to_numpy(zero_copy_only=False)[row]
        place = lambda name: pc.fill_null(items.field(name), 0).to_numpy(zero_copy_only=False) + base
        low = np.clip(place("start"), edge, limit)
        cut = texts.cut(low, np.maximum(low, np.clip(place("end"), edge, limit)))
        known = pc.and_(items.field("start").is_valid(), items.field("end").is_valid())
        return _listed(first, {"start": items.field("start"), "end": items.field("end"),
                               "text": pc.if_else(known, cut, pa.scalar(None, pa.string()))}, places)

    return spelled
