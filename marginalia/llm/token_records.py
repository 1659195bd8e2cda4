"""Token ids as length-delimited binary records with a separate offset index.

A record file is a row of frames.  A frame is the payload's length (unsigned 64 bits), the masked
CRC-32C of those eight bytes, the payload, and the masked CRC-32C of the payload: the framing that
record readers of training programs take.  A payload is a header of 16 bytes (the document's id, a flag
for a null id, the bytes per token, six zeros) and the token ids as unsigned numbers, of 16 bits where all
of the record fit and of 32 bits elsewhere; all numbers are little-endian.
The index beside a file has three unsigned 64-bit numbers per record: where its frame begins, how
long its payload is, and how many tokens of the file come before it.  So a reader can fetch any
record by itself, in any order.

A task writes one file under a name of its own; the manifest lists the files of the tasks that
ended well.  What a lost or doubled attempt leaves behind is in no manifest and never read.
"""

import io
import uuid

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marginalia.llm import common
from marginalia.llm.packing import _ids as token_ids

END = 2
# A file holds about this many bytes of ids, and tasks read files in blocks.
FILE_BYTES = 128 << 20
BLOCK_BYTES = 4 << 20
SEED = 41

HEADER = 16
_FRAME = 16  # length, its checksum, the payload's checksum
_MANIFEST = "shard int, file string, records bigint, tokens bigint, bytes bigint"
_RECORD = "doc_id bigint, start bigint, ids binary"

# --- masked CRC-32C --------------------------------------------------------------------------

# Fixed values of the checksum and its mask.
_POLYNOMIAL = 0x82F63B78
_MASK = 0xA282EAD8
_CHUNK = 64


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """What one byte, and what two bytes at once, do to a state."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = (one >> np.uint32(1)) ^ np.where(one & np.uint32(1), np.uint32(_POLYNOMIAL), np.uint32(0))
    two = np.arange(65536, dtype=np.uint32)
    for _ in range(2):
        two = (two >> np.uint32(8)) ^ one[two & np.uint32(255)]
    return one, two


_ONE, _TWO = _tables()
# Entry k moves a state past 2^k zero bytes, as a table for each byte of the state.
_PAST: list[np.ndarray] = []


def _moved(table: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = table[0][state & np.uint32(255)]
    for i in (1, 2, 3):
        out = out ^ table[i][(state >> np.uint32(8 * i)) & np.uint32(255)]
    return out


def _past_zeros(state: np.ndarray, count: np.ndarray) -> np.ndarray:
    """States after ``count`` zero bytes each."""
    state, count, k = state.copy(), count.astype(np.int64), 0
    while (count >> k).any():
        if len(_PAST) <= k:
            bytes_ = np.arange(256, dtype=np.uint32)
            each = [bytes_ << np.uint32(8 * i) for i in range(4)]
            last = (lambda s: (s >> np.uint32(8)) ^ _ONE[s & np.uint32(255)]) if k == 0 else (
                lambda s: _moved(_PAST[k - 1], _moved(_PAST[k - 1], s)))
            _PAST.append(np.stack([last(s) for s in each]))
        chosen = (count >> k & 1).astype(bool)
        state[chosen] = _moved(_PAST[k], state[chosen])
        k += 1
    return state


def masked_crc(parts: list[bytes]) -> np.ndarray:
    """The masked CRC-32C of each part, all parts side by side.

    A checksum is linear: from a zero state, zeros in front change nothing.  So parts are filled up in
    front to whole chunks, all chunks go through the tables together, and each result is moved past the
    bytes behind its chunk.
    """
    if not parts:
        return np.zeros(0, np.uint32)
    length = np.array([len(p) for p in parts], np.int64)
    chunks = np.maximum(1, -(-length // _CHUNK))
    zeros = bytes(_CHUNK)
    data = b"".join([piece for part, n in zip(parts, chunks.tolist())
                     for piece in (zeros[:n * _CHUNK - len(part)], part)])
    columns = np.ascontiguousarray(np.frombuffer(data, "<u2").reshape(-1, _CHUNK // 2).T)
    state = np.zeros(columns.shape[1], np.uint32)
    for column in columns:
        state = _TWO[(state ^ column) & np.uint32(0xFFFF)] ^ (state >> np.uint32(16))
    last = np.cumsum(chunks)
    behind = np.repeat(last, chunks) - 1 - np.arange(len(state))
    state = np.bitwise_xor.reduceat(_past_zeros(state, behind * _CHUNK), last - chunks)
    crc = ~(state ^ _past_zeros(np.full(len(parts), 0xFFFFFFFF, np.uint32), length))
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK)


# --- files -----------------------------------------------------------------------------------

def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path, for a plain path as well as for a URI of any store pyarrow knows."""
    for local in ("file://", "file:"):
        if folder.startswith(local):
            folder = folder[len(local):]
            break
    return fs.FileSystem.from_uri(folder)


def _framed(keys: list, widths: list[int], ids: list[bytes]) -> list[bytes]:
    """Frames of documents."""
    payloads = [(key or 0).to_bytes(8, "little", signed=True) + bytes((key is None, width, 0, 0, 0, 0, 0, 0)) + part
                for key, width, part in zip(keys, widths, ids)]
    sizes = [len(p).to_bytes(8, "little") for p in payloads]
    heads, tails = masked_crc(sizes).astype("<u4").tobytes(), masked_crc(payloads).astype("<u4").tobytes()
    return [size + heads[4 * i:4 * i + 4] + payload + tails[4 * i:4 * i + 4]
            for i, (size, payload) in enumerate(zip(sizes, payloads))]


def _payloads(frames: list[bytes], where: str) -> list[bytes]:
    """The payloads of whole frames, with both checksums compared."""
    sizes, payloads = [f[:8] for f in frames], [f[12:-4] for f in frames]
    heads = np.frombuffer(b"".join([f[8:12] for f in frames]), "<u4")
    tails = np.frombuffer(b"".join([f[-4:] for f in frames]), "<u4")
    if (masked_crc(sizes) != heads).any() or (masked_crc(payloads) != tails).any():
        raise ValueError(f"damaged record in {where}")
    return payloads


def _rows(payloads: list[bytes], start: list[int]) -> pa.RecordBatch:
    keys = [None if p[8] else int.from_bytes(p[:8], "little", signed=True) for p in payloads]
    ids = [np.frombuffer(p, f"<u{p[9]}", offset=HEADER).astype("<u4").tobytes() for p in payloads]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(start, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "start", "ids"])


def _frames(stream, where: str):
    """Lists of whole frames of about ``BLOCK_BYTES`` each, read once from front to end."""
    left = b""
    while True:
        block = stream.read(BLOCK_BYTES)
        data, at, out = left + block, 0, []
        while len(data) - at >= 12:
            size = int.from_bytes(data[at:at + 8], "little")
            end = at + size + _FRAME
            if end > len(data) and size > BLOCK_BYTES:
                # Nothing is read ahead for a length that its own checksum does not confirm.
                if masked_crc([data[at:at + 8]])[0] != int.from_bytes(data[at + 8:at + 12], "little"):
                    raise ValueError(f"damaged length in {where}")
                data += stream.read(end - len(data))
            if end > len(data):
                break
            out.append(data[at:end])
            at = end
        left = data[at:]
        if out:
            yield out
        if not block:
            if left:
                raise ValueError(f"file ends within a record: {where}")
            return


# --- writing ---------------------------------------------------------------------------------

def _encoded(batches, path: str, end: int):
    """``(doc_id, width, ids)``: the ids of whole texts and the end id, ``width`` bytes each; null texts are empty."""
    ids = token_ids(path)
    for batch in batches:
        keys, rows, held = batch.column(0).to_pylist(), [], 0
        for key, text in zip(keys, batch.column(1)):
            found = np.frombuffer(ids(text.as_py() or "") + end.to_bytes(4, "little"), "<u4")
            width = 2 if found.max() < 1 << 16 else 4
            rows.append((key, width, found.astype(f"<u{width}").tobytes()))
            held += len(rows[-1][2])
            if held > BLOCK_BYTES:
                yield _encoded_batch(rows)
                rows, held = [], 0
        if rows:
            yield _encoded_batch(rows)


def _encoded_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["doc_id", "width", "ids"])


def write_records(docs: DataFrame, folder: str, path: str, end: int = END, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the documents' ids to record files in ``folder``, in ascending order of ids; returns the manifest.

    Null and empty texts are records of the end id alone.  Null ids come last; rows that share an id
    follow each other in the order of a hash of their texts, so that one id on many rows is shared out
    over files.  An empty table gives no files.  Other columns are not read.  The manifest is also
    written, as Parquet: ``shard, file, records, tokens, bytes, first``, where ``first`` is the number of tokens in
    the files before.  Texts are put in order first, so that they are encoded once, where they are written.
    """
    spark = docs.sparkSession
    steps = common.Steps(spark, "records")
    # Ids take about half of the bytes of their text.
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(common.partitions(spark), -(-total // (2 * file_bytes)))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie")]

    def write(batches):
        store, where = _place(folder)
        shard, name = TaskContext.get().partitionId(), None
        records = tokens = at = 0
        for batch in _encoded(batches, path, end):
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                widths = part.column(1).to_pylist()
                frames = _framed(part.column(0).to_pylist(), widths, part.column(2).to_pylist())
                if name is None:
                    name = f"part-{shard:06d}-{uuid.uuid4().hex}"
                    store.create_dir(where, recursive=True)
                    out, index = (store.open_output_stream(f"{where}/{name}.{kind}") for kind in ("rec", "idx"))
                size = np.array([len(f) for f in frames], np.int64)
                count = (size - _FRAME - HEADER) // np.array(widths)
                lines = np.stack([at + np.cumsum(size) - size, size - _FRAME, tokens + np.cumsum(count) - count], axis=1)
                out.write(b"".join(frames))
                index.write(lines.astype("<u8").tobytes())
                records, tokens, at = records + len(frames), tokens + int(count.sum()), at + int(size.sum())
        if name is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "file": [name], "records": [records], "tokens": [tokens], "bytes": [at]})

    tied = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    written = steps.keep(tied.repartitionByRange(files, *order).sortWithinPartitions(*order)
                         .select("doc_id", "text").mapInArrow(write, _MANIFEST), "written")
    # One row per file goes through this window.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    manifest = written.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


# --- reading ---------------------------------------------------------------------------------

def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest with a partition per file, so that files are read side by side."""
    manifest = spark.read.parquet(f"{folder}/manifest").select("shard", "file", "records", "tokens", "bytes", "first")
    return manifest.repartition(max(1, manifest.count()))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """``(doc_id, start, ids)`` of every record: each file from front to end, with all checksums compared."""
    common.ready(spark)

    def read(batches):
        store, where = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                name, start, seen = f"{where}/{row['file']}.rec", row["first"], 0
                with store.open_input_stream(name) as stream:
                    for frames in _frames(stream, name):
                        payloads = _payloads(frames, name)
                        count = np.array([(len(p) - HEADER) // p[9] for p in payloads], np.int64)
                        yield _rows(payloads, (start + np.cumsum(count) - count).tolist())
                        start, seen = start + int(count.sum()), seen + len(frames)
                if seen != row["records"]:
                    raise ValueError(f"{name} has {seen} records, the manifest says {row['records']}")

    return _listed(spark, folder).mapInArrow(read, _RECORD)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``(file, at, length, start)`` of every record, from the index files alone."""
    common.ready(spark)

    def read(batches):
        store, where = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_stream(f"{where}/{row['file']}.idx") as stream:
                    while lines := stream.read(24 << 14):
                        at, length, start = np.frombuffer(lines, "<u8").reshape(-1, 3).T.astype(np.int64)
                        yield pa.RecordBatch.from_pydict({
                            "file": pa.array([row["file"]] * len(at)), "at": pa.array(at), "length": pa.array(length),
                            "start": pa.array(start + row["first"])})

    return _listed(spark, folder).mapInArrow(read, "file string, at bigint, length bigint, start bigint")


def read_shuffled(spark: SparkSession, folder: str, seed: int = SEED) -> DataFrame:
    """``(doc_id, start, ids)`` of every record in an order that follows from ``seed``.

    Index lines are shuffled, not records: each task fetches its records by place, those of one batch
    file by file in ascending places.
    """
    def fetch(batches):
        store, where = _place(folder)
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                files, at, length, start = (c.to_pylist() for c in batch.slice(low, 1024).columns[:4])
                frames, open_name, source = [b""] * len(at), None, io.BytesIO()
                for i in sorted(range(len(at)), key=lambda j: (files[j], at[j])):
                    if files[i] != open_name:
                        source.close()
                        open_name, source = files[i], store.open_input_file(f"{where}/{files[i]}.rec")
                    source.seek(at[i])
                    frames[i] = source.read(length[i] + _FRAME)
                source.close()
                yield _rows(_payloads(frames, folder), start)

    key = F.xxhash64("file", "at", F.lit(seed))
    lines = read_index(spark, folder).withColumn("key", key)
    return lines.repartitionByRange(common.partitions(spark), "key").sortWithinPartitions("key").mapInArrow(fetch, _RECORD)


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents")
    out = common.Steps(spark, "token-files").folder
    write_records(docs, out, public_tokenizers.path("word_bpe_49k.json"))
    return read_records(spark, out).select(
        "doc_id", "start", F.expr("length(ids) div 4").cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
