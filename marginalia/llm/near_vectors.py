"""Near duplicates of vectors by Euclidean p-stable hashing.

On unit vectors a cosine is a distance.  Each hash table quantises ``k`` random projections into
one bucket; vectors that share a bucket of any table are compared exactly, in double precision.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common

THRESHOLD = 0.9
# Share of the pairs right at the threshold that the tables are to find; nearer pairs are found more often.
RECALL = 0.95
# Unrelated vectors that a bucket may hold on average, width of a quantised projection.
STRANGERS = 50
WIDTH = 2.5
# Vectors of a bucket that one task compares with each other; larger buckets are cut into pieces.
PIECE = 1024
SEED = 29


def same_cell(distance: float, width: float = WIDTH) -> float:
    """Probability that one projection puts two points at this distance into one cell."""
    ratio = width / distance
    tail = 0.5 * math.erfc(ratio / math.sqrt(2))
    return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))


def sizes(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Projections a table and number of tables for so many vectors."""
    near, far = same_cell(math.sqrt(2 - 2 * threshold)), same_cell(math.sqrt(2))
    k = max(2, math.ceil(math.log(max(vectors / STRANGERS, 1)) / -math.log(far)))
    return k, math.ceil(math.log(1 - recall) / math.log1p(-near ** k))


class _Tables:
    """Bucket keys of unit vectors; every length of vector has projections of its own."""

    def __init__(self, k: int, tables: int):
        self.k, self.tables, self.planes = k, tables, {}

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """One row of keys per vector, one column per table."""
        dim = unit.shape[1]
        if dim not in self.planes:
            rng = np.random.default_rng((SEED, dim))
            self.planes[dim] = (rng.normal(size=(dim, self.k * self.tables)), rng.uniform(0, WIDTH, self.k * self.tables))
        plane, shift = self.planes[dim]
        cell = np.floor((unit @ plane + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), self.tables, self.k)
        key = np.broadcast_to(np.arange(self.tables, dtype=np.uint64) + np.uint64(dim << 20), cell.shape[:2])
        for i in range(self.k):
            key = common.mixed(key * np.uint64(0xD6E8FEB86659FD93) + cell[:, :, i])
        return key.view(np.int64)


def _unit(rows: list[bytes], kind: str) -> np.ndarray:
    v = np.stack([np.frombuffer(r, kind) for r in rows]).astype(float)
    # Large components are brought down first, so that no square overflows.
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _checked(vectors: DataFrame) -> tuple[DataFrame, str]:
    """``(vec_id, vector)``: the vector's numbers as bytes, null where it links with nothing; and their kind, which is that of the table."""
    given = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind, column = ("<f4", "array<float>") if given == "float" else ("<f8", "array<double>")

    def check(batches):
        for batch in batches:
            out = []
            for v in batch.column(1).to_pylist():
                a = np.array(v, kind) if v and None not in v else np.zeros(0, kind)
                # Adding zero turns minus zero into zero.
                out.append((a + np.zeros(1, kind)).tobytes() if len(a) and np.isfinite(a).all() and a.any() else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "vector"])

    return vectors.select("vec_id", F.col("embedding").cast(column)).mapInArrow(check, "vec_id bigint, vector binary"), kind


def _smallest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest of ``n`` nodes that each one reaches by the links ``a, b``."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[a], least[b])
        np.minimum.at(least, a, low)
        np.minimum.at(least, b, low)
        # A node's smallest hears of it too, so that long chains take few rounds.
        np.minimum.at(least, before, least.copy())
        least = least[least]
        if (least == before).all():
            return least


def _compared(k: int, tables: int, threshold: float, kind: str):
    def compare(batches):
        hashing = _Tables(k, tables)
        for unit in common.runs_of_key(batches, "unit"):
            if unit.num_rows < 2:
                continue
            unit = unit.sort_by("node")
            node, copies, side = (unit.column(c).to_numpy() for c in ("node", "copies", "side"))
            table, links = unit.column("tab")[0].as_py(), np.zeros(len(node), np.int64)
            v = _unit(unit.column("vector").to_pylist(), kind)
            keys = hashing.keys(v)
            rows_at, columns_at = (np.flatnonzero(side <= 0), np.flatnonzero(side >= 0))
            near = v[rows_at] @ v[columns_at].T >= threshold
            x, y = np.nonzero(near)
            a, b = rows_at[x], columns_at[y]
            # Within one piece each pair comes once; a pair that an earlier table found is that one's.
            once = (side[a] != side[b]) | (node[a] < node[b])
            a, b = a[once], b[once]
            fresh = np.ones(len(a), bool)
            for t in range(table):
                fresh &= keys[a, t] != keys[b, t]
            a, b = a[fresh], b[fresh]
            if not len(a):
                continue
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            # The smallest neighbour alone would lose a node's other links: all of a unit's links go into its components.
            least = node[_smallest(len(node), a, b)]
            hit = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(node[hit]), pa.array(least[hit]), pa.array(links[hit])], ["a", "b", "links"])

    return compare


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Linked are pairs that share a bucket and whose cosine reaches ``threshold``; no other pair
    is.  Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows with a null id; vectors of different lengths do not link.  Equal vectors
    are compared as one and counted as many.  An empty table gives none.  Other columns are not read.

    The number of tables follows from the number of vectors.  Buckets of any size are compared
    in full: those beyond ``PIECE`` vectors piece against piece; a task streams its units of two pieces one by one.
    """
    spark = vectors.sparkSession
    steps = common.Steps(spark, "vectors")
    tasks = 4 * common.partitions(spark)
    checked, kind = _checked(vectors)
    own = steps.keep(checked, "checked")
    usable = own.where("vector IS NOT NULL AND vec_id IS NOT NULL")
    classes = (usable.groupBy("vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("head"))
               .withColumn("node", F.monotonically_increasing_id()))
    classes = steps.keep(classes, "classes")
    k, tables = sizes(classes.count(), threshold, recall)

    def bucketed(batches):
        hashing = _Tables(k, tables)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                rows = part.column(1).to_pylist()
                for dim in sorted({len(r) for r in rows}):
                    chosen = np.array([i for i, r in enumerate(rows) if len(r) == dim])
                    keys = hashing.keys(_unit([rows[i] for i in chosen], kind))
                    node = part.column(0).to_numpy()[chosen]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.ravel()), pa.array(np.repeat(node, tables)),
                         pa.array(np.tile(np.arange(tables, dtype=np.int32), len(chosen)))], ["key", "node", "tab"])

    keyed = steps.keep(classes.select("node", "vector").mapInArrow(bucketed, "key bigint, node bigint, tab int"), "keyed")
    shared = keyed.groupBy("key").count().where("count > 1").select("key", F.ceil(F.col("count") / PIECE).alias("pieces"))
    piece = F.pmod(F.xxhash64("node"), F.col("pieces"))
    placed = keyed.join(shared, "key").withColumn("piece", piece)
    # Piece i meets itself and every later piece; side tells the two apart.
    other = F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)
    placed = placed.withColumn("other", F.explode(other))
    low, high = F.least("piece", "other"), F.greatest("piece", "other")
    side = F.when(F.col("other") == F.col("piece"), 0).when(F.col("piece") < F.col("other"), -1).otherwise(1)
    units = (placed.select("node", "tab", side.alias("side"), F.xxhash64("key", low, high).alias("unit"))
             .join(classes.select("node", "vector", "copies"), "node"))
    found = (units.repartition(tasks, "unit").sortWithinPartitions("unit")
             .mapInArrow(_compared(k, tables, threshold, kind), "a bigint, b bigint, links bigint"))
    found = steps.keep(found, "found")
    groups = common.components(found.select("a", "b"), steps, "linked")
    counted = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    heads = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = heads.groupBy("component").agg(F.min("head").alias("component_id"))
    by_vector = (heads.join(smallest, "component").join(counted, "node", "left")
                 .select(F.col("vector").alias("v"), "component_id",
                         (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n")))
    key = F.when(F.col("vec_id").isNotNull(), F.col("vector"))
    return (own.withColumn("key", key).join(by_vector, F.col("key") == F.col("v"), "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(common.table(spark, folder, "embeddings"))
