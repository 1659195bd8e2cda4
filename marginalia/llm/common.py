"""Helpers of the operators: written steps, word hashes over Arrow buffers, components."""

import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.session import prepare, shipped, write_step

# The blanks of the contracts, space and 0x09 to 0x0D.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# Texts are worked on in slices of about this many bytes, so that the arrays
# beside a slice stay small; one text is never cut.
SLICE_BYTES = 1 << 20

_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def ready(spark: SparkSession) -> SparkSession:
    """Set what right results depend on, and send the package to the Python workers once."""
    return prepare(shipped(spark))


class Steps:
    """Tables written to the shared folder, where a lost executor does not take them along.

    The folder is the one that ``spark.checkpoint.dir`` names.  Only where that is unset, in
    local sessions such as tests, one temporary folder per session stands in for it.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = ready(spark)
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            context = spark.sparkContext
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            if context.applicationId not in _LOCAL:
                _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="marginalia-")
            root = _LOCAL[context.applicationId]
        self.folder = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.held: set[str] = set()

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        path = f"{self.folder}/{name}"
        write_step(df, path)
        self.held.add(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete written tables that no later step reads."""
        for name in names:
            self.held.discard(name)
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def only(self, *names: str) -> None:
        """Delete all written tables but those named."""
        self.drop(*sorted(self.held - set(names)))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names with as many underscores in front as it takes to clash with no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def runs_of_key(batches, column: str):
    """Of batches sorted by ``column`` one table after the other for each of its values; one of them is in memory."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(column).to_numpy()
        edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for low, high in zip(edges[:-1], edges[1:]):
            if held and keys[low] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[low]
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- words of whole texts, as arrays ---------------------------------------------------------

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32  # A-Z
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS = [np.ones(0, np.uint64), np.ones(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES)
        for i, step in enumerate((_STEP, _BACK)):
            grown = np.full(size, step, np.uint64)
            grown[0] = 1
            _POWERS[i] = np.cumprod(grown)
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def slices(column: pa.Array):
    """``(first row, offsets, bytes)`` of the texts in pieces of about ``SLICE_BYTES``.

    Null texts are empty.  ``offsets`` has one entry more than the piece has rows.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, where, content = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(content, np.uint8) if content else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1)
        yield row, offsets[row:last + 1] - offsets[row], data[offsets[row]:offsets[last]]
        row = last


def words(offsets: np.ndarray, data: np.ndarray, fold: bool = False, blank: np.ndarray = _BLANK):
    """``(hashes, starts, ends, first)``: a hash and byte range per word, and the number
    of the first word of each row (with one entry more than there are rows).  ``blank`` has
    a flag for each byte that parts words."""
    if fold:
        data = _FOLD[data]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, np.zeros(len(offsets), np.int64)
    word = ~blank[data]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    begins, stops = word.copy(), word.copy()
    begins[1:] &= ~word[:-1]
    begins[edges] = word[edges]
    stops[:-1] &= ~word[1:]
    stops[edges - 1] = word[edges - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    power, back = _powers(n)
    values = _BYTE[data] * power[:n]
    total = np.cumsum(values, dtype=np.uint64)
    hashes = mixed((total[ends - 1] - total[starts] + values[starts]) * back[starts])
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def runs_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` neighbouring entries."""
    count = max(0, len(hashes) - n + 1)
    run = np.zeros(count, np.uint64)
    for i in range(n):
        run = run * np.uint64(0xD6E8FEB86659FD93) + hashes[i:i + count]
    return mixed(run)


class Ranges:
    """Hashes of any ranges of entries, each from two sums."""

    def __init__(self, hashes: np.ndarray):
        power, self.back = _powers(len(hashes) + 1)
        self.total = np.concatenate([[np.uint64(0)], np.cumsum(hashes * power[:len(hashes)], dtype=np.uint64)])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.total[end] - self.total[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def owners(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


# --- components ------------------------------------------------------------------------------

def components(edges: DataFrame, steps: Steps, name: str) -> DataFrame:
    """``(node, component)`` for all nodes of ``edges (a, b)``; a component is its smallest node.

    Alternates two star steps until nothing changes: every node hands its neighbours its smallest
    neighbour.  A round writes one table, and the number of rounds grows with the logarithm of
    the longest path.  Hub nodes meet in plain equi-joins, which AQE splits where they are skewed.
    """
    def to_smallest(links: DataFrame) -> DataFrame:
        # a > b; each neighbour of a, and a itself, goes to a's smallest neighbour.
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        rest = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return rest.union(least.select("a", F.col("m").alias("b"))).distinct()

    def to_larger(links: DataFrame) -> DataFrame:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return (both.where("b > a").join(least, "a")
                .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())

    def state(links: DataFrame):
        row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return row[0], row[1]

    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    links = steps.keep(links, f"{name}-0")
    seen, number = state(links), 0
    while seen[0]:
        number += 1
        links = steps.keep(to_smallest(to_larger(links)), f"{name}-{number}")
        steps.drop(f"{name}-{number - 1}")
        now = state(links)
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def spread(value: Column, parts: int) -> Column:
    """A number from 0 to ``parts - 1`` that follows from ``value``."""
    return F.pmod(F.xxhash64(value, F.lit(17)), F.lit(parts)).cast("int")
