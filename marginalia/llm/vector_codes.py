"""Vector codes by product quantisation, with Lloyd's rounds over cover trees.

Vectors become integers and are cut into equal parts; each part position has a codebook of its own.
Every partition builds cover trees over chunks of its vectors once, one tree per part position, and
writes them with the points in tree order, so that the points of a subtree lie side by side and
running sums give its count and its sum.  In a round a node whose nearest entry is nearer than all
others by more than twice the node's radius takes its whole subtree along (triangle inequality); only
ambiguous nodes hand over to their children, and ambiguous leaves compare their points exactly.
Squared distances are integers throughout; square roots only decide, with a margin, whether a subtree
may go as a whole.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common

# Part positions, entries of a codebook, rounds, steps of a unit.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
STEPS = 256
# Vectors of a chunk, points up to which a node is a leaf, rows that share the sums of a label.
CHUNK = 4096
LEAF = 48
SALTS = 32

_TREES = "n int, points binary, place binary, nodes binary, radius binary"


def part_size(length: int) -> int:
    return -(-length // PARTS)


def bound(length: int) -> int:
    """The largest component whose errors, summed over ``length`` components, stay within 64 bits."""
    return 1 << ((62 - max(1, length).bit_length()) // 2 - 1)


def _whole(vectors: DataFrame) -> DataFrame:
    return vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(
        "embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")


def _quantised(rows: list, size: int) -> np.ndarray:
    """Integer components of vectors, filled up with zeros to ``PARTS * size``; one block per part position."""
    most = float(bound(PARTS * size))
    out = np.zeros((len(rows), PARTS * size))
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    out = np.clip(np.floor(out * STEPS), -most, most).astype(np.int64)
    return np.ascontiguousarray(out.reshape(len(rows), PARTS, size).transpose(1, 0, 2))


# --- cover trees -----------------------------------------------------------------------------

def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges in a row."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def cover_forest(points: np.ndarray, first: np.ndarray, leaf: int):
    """Cover trees over the points from each of ``first`` to the next; ``first`` ends with the number of points.

    Gives ``(place, nodes, radius)``: the order of the points, ``begin, end, child, children`` of each node in that
    order, and its squared radius.  A node's centre is its first point; it is also its first child's.  The
    centres of children are more than half of the node's radius apart, and every point of the node is within that of one; it
    goes to the nearest.  The nodes of one level of all trees are made together.
    """
    place = np.arange(len(points))
    points = points.astype(np.float64)
    begin, end = first[:-1], first[1:]
    gap = points - np.repeat(points[begin], end - begin, axis=0)
    apart = (gap * gap).sum(1)
    nodes, radii, made = [], [], 0
    while len(begin):
        size = end - begin
        radius = np.maximum.reduceat(apart, begin) if len(nodes) == 0 else np.maximum.reduceat(
            apart[_ranges(begin, size)], np.cumsum(size) - size)
        level = np.stack([begin, end, np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)])
        nodes.append(level)
        radii.append(radius)
        made += len(begin)
        open_ = np.flatnonzero((size > leaf) & (radius > 0))
        if not len(open_):
            break
        at = _ranges(begin[open_], size[open_])
        cluster = np.repeat(np.arange(len(open_)), size[open_])
        near, own, x = apart[at], np.zeros(len(at), np.int64), points[at]
        limit, rest, number = radius[open_] / 4, np.arange(len(at)), 0
        while len(rest):
            # The farthest point of each node that is not covered yet becomes a centre.
            starts = np.flatnonzero(np.diff(cluster[rest], prepend=-1))
            count = np.diff(starts, append=len(rest))
            far = np.maximum.reduceat(near[rest], starts)
            going = far > limit[cluster[rest[starts]]]
            if not going.all():
                rest = rest[np.repeat(going, count)]
                starts, count, far = np.cumsum(count[going]) - count[going], count[going], far[going]
                if not len(rest):
                    break
            number += 1
            hit = np.flatnonzero(near[rest] == np.repeat(far, count))
            owner = np.repeat(np.arange(len(count)), count)[hit]
            centre = hit[np.flatnonzero(np.diff(owner, prepend=-1))]
            gap = x[rest] - np.repeat(x[rest[centre]], count, axis=0)
            gap = (gap * gap).sum(1)
            closer = gap < near[rest]
            moved = rest[closer]
            near[moved], own[moved] = gap[closer], number
        order = np.lexsort((near, own, cluster))
        place[at], points[at], apart[at] = place[at][order], x[order], near[order]
        cluster, own = cluster[order], own[order]
        starts = np.flatnonzero((np.diff(cluster, prepend=-1) != 0) | (np.diff(own, prepend=-1) != 0))
        begin, end = at[starts], at[np.append(starts[1:], len(at)) - 1] + 1
        children = np.bincount(cluster[starts], minlength=len(open_))
        level[2, open_], level[3, open_] = made + np.cumsum(children) - children, children
    return place, np.concatenate(nodes, axis=1), np.concatenate(radii)


class _Trees:
    """A chunk's trees: points and running sums in tree order."""

    def __init__(self, row: dict, size: int):
        self.n = row["n"]
        self.points = np.frombuffer(row["points"], "<i4").reshape(PARTS * self.n, size).astype(np.int64)
        self.place = np.frombuffer(row["place"], "<i4")
        self.nodes = np.frombuffer(row["nodes"], "<i4").reshape(4, -1).astype(np.int64)
        self.radius = np.sqrt(np.frombuffer(row["radius"], "<f8"))
        self.sums = np.concatenate([np.zeros((1, size), np.int64), np.cumsum(self.points, axis=0)])

    def assigned(self, books: np.ndarray, counts: np.ndarray | None = None, sums: np.ndarray | None = None) -> np.ndarray:
        """The entry of every point, in tree order; adds to ``counts`` and ``sums`` of entries where they are given."""
        label = np.zeros(PARTS * self.n, np.int64)
        entries = books.shape[1]
        todo = np.arange(PARTS)
        while len(todo):
            begin, end, child, children = self.nodes[:, todo]
            part = begin // self.n
            distance = _distances(self.points[begin], part, books)
            best = distance.argmin(1)
            root = np.sqrt(distance)
            one = root[np.arange(len(todo)), best]
            root[np.arange(len(todo)), best] = np.inf
            two, radius = root.min(1), self.radius[todo]
            whole = two - one - 2 * radius > 1e-9 * (one + radius + 1)
            b, e = begin[whole], end[whole]
            label[_ranges(b, e - b)] = np.repeat(best[whole], e - b)
            if counts is not None:
                to = part[whole] * entries + best[whole]
                np.add.at(counts, to, e - b)
                np.add.at(sums, to, self.sums[e] - self.sums[b])
            leaf = ~whole & (children == 0)
            at = _ranges(begin[leaf], (end - begin)[leaf])
            if len(at):
                label[at] = _distances(self.points[at], at // self.n, books).argmin(1)
                if counts is not None:
                    to = at // self.n * entries + label[at]
                    np.add.at(counts, to, 1)
                    np.add.at(sums, to, self.points[at])
            todo = _ranges(child[~whole], children[~whole])
        return label


def _distances(points: np.ndarray, part: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Squared distances of points, ordered by part position, to all entries of their codebook."""
    size, out = points.shape[1], np.empty((len(points), books.shape[1]), np.int64)
    edges = np.searchsorted(part, np.arange(PARTS + 1))
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(books).max(initial=0)))
    for p in range(PARTS):
        for low in range(edges[p], edges[p + 1], 8192):
            x, c = points[low:min(low + 8192, edges[p + 1])], books[p]
            if 4 * size * most * most < 1 << 53:
                # All sums of these products are whole numbers that a double holds exactly.
                x, c = x.astype(np.float64), c.astype(np.float64)
                found = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
            else:
                found = sum((x[:, None, i] - c[None, :, i]) ** 2 for i in range(size))
            out[low:low + len(x)] = found
    return out


# --- Lloyd's rounds --------------------------------------------------------------------------

def vector_codes(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, label, code, error)`` for the kept rows of ``vectors``, and the codebooks.

    Left out are vectors that are null or hold null or non-finite components.  Codebooks start as the parts of
    the ``entries`` smallest ids; null ids come last, rows that share an id follow each other by their vectors, and of fewer
    rows there are as many entries.  Vectors shorter than the longest, and parts that are not full, count as filled up with zeros.  Components
    are held within :func:`bound`, so that errors fit 64 bits.  Of entries equally near the lower index counts.  An empty table
    gives no rows and empty codebooks.  Other columns are not read.
    """
    spark = vectors.sparkSession
    steps = common.Steps(spark, "codes")
    kept = _whole(vectors)
    size = part_size(kept.agg(F.max(F.size("embedding"))).first()[0] or 1)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).collect()
    books = _quantised([r["embedding"] for r in first], size)
    label_type = kept.schema["label"].dataType.simpleString()

    def grow(batches):
        keys, labels, rows = [], [], []

        def chunk():
            points = _quantised(rows, size).reshape(-1, size)
            place, nodes, radius = cover_forest(points, np.arange(PARTS + 1) * len(rows), LEAF)
            return pa.RecordBatch.from_arrays(
                [pa.array([len(rows)], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (
                    points[place].astype("<i4"), place.astype("<i4"), nodes.astype("<i4"), radius.astype("<f8"))],
                 pa.array([keys], pa.list_(pa.int64())), pa.array([labels], pa.list_(kind))],
                ["n", "points", "place", "nodes", "radius", "keys", "labels"])

        for batch in batches:
            kind = batch.column(1).type
            keys += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            rows += batch.column(2).to_pylist()
            while len(rows) >= CHUNK:
                later = keys[CHUNK:], labels[CHUNK:], rows[CHUNK:]
                keys, labels, rows = keys[:CHUNK], labels[:CHUNK], rows[:CHUNK]
                yield chunk()
                keys, labels, rows = later
        if rows:
            yield chunk()

    schema = f"{_TREES}, keys array<bigint>, labels array<{label_type}>"
    trees = steps.keep(kept.mapInArrow(grow, schema), "trees")
    names = ["n", "points", "place", "nodes", "radius"]

    for _ in range(rounds if len(first) else 0):
        def added(batches, books=books):
            counts = np.zeros(PARTS * books.shape[1], np.int64)
            sums = np.zeros((len(counts), size), np.int64)
            for batch in batches:
                for row in batch.to_pylist():
                    _Trees(row, size).assigned(books, counts, sums)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))], ["entry", "n", "sums"])

        # One row per entry comes back: parts times entries, whatever the number of vectors.
        found = trees.select(*names).mapInArrow(added, "entry bigint, n bigint, sums array<bigint>").groupBy("entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(size)]).alias("sums")).collect()
        books = books.reshape(-1, size).copy()
        for r in found:
            books[r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
        books = books.reshape(PARTS, -1, size)

    def coded(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tree = _Trees(row, size)
                label = tree.assigned(books)
                part = np.repeat(np.arange(PARTS), tree.n)
                gap = tree.points - books[part, label]
                owner = tree.place % tree.n
                code, error = np.zeros((tree.n, PARTS), np.uint8), np.zeros(tree.n, np.int64)
                code[owner, part] = label
                np.add.at(error, owner, (gap * gap).sum(1))
                text = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["keys"], pa.int64()), pa.array(row["labels"], batch.schema.field("labels").type.value_type),
                     pa.array([text[i:i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    out = trees.mapInArrow(coded, f"vec_id bigint, label {label_type}, code string, error bigint")
    return steps.keep(out, "codes"), books


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part position, entry and place, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``, the errors of all rows with the same label; null labels are one.

    Sums meet the rows in ``SALTS`` copies, so that a label on many rows is shared out.
    """
    sums = (codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
            .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    salted = codes.withColumn("_own", common.spread(F.struct("vec_id", "code"), SALTS))
    same = F.col("label").eqNullSafe(F.col("_label")) & (F.col("_own") == F.col("_salt"))
    return salted.join(sums.hint("merge"), same).drop("_label", "_salt", "_own")


def query(spark: SparkSession, folder: str) -> DataFrame:
    codes, books = vector_codes(common.table(spark, folder, "embeddings"))
    return with_label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _round(number: int) -> str:
    """One round: nearest entries, then new entries."""
    return f"""
near{number} AS (
  SELECT vec_id, p, arg_min(e, d * 64 + e) AS e FROM (
    SELECT vec_id, p, e, list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)]) AS d
    FROM parts JOIN book{number} USING (p)) AS pairs GROUP BY vec_id, p),
moved{number} AS (
  SELECT p, e, i, sum(x[i])::BIGINT AS s, count(*) AS n
  FROM parts JOIN near{number} USING (vec_id, p), (SELECT unnest(range(1, size + 1)) AS i FROM width) AS places GROUP BY p, e, i),
mean{number} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS m FROM moved{number} GROUP BY p, e),
book{number + 1} AS (
  SELECT p, e, coalesce(m, c) AS c FROM book{number} LEFT JOIN mean{number} USING (p, e))"""


SQL = f"""
WITH kept AS (
  SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
width AS (SELECT max(len(v)) // 16 AS size FROM kept),
parts AS (
  SELECT vec_id, p, v[p * size + 1:(p + 1) * size] AS x FROM kept, width, (SELECT unnest(range(0, 16)) AS p) AS ps),
book0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
{_round(0)},
{_round(1)},
last AS (
  SELECT vec_id, p, min(d * 64 + e) AS best FROM (
    SELECT vec_id, p, e, list_sum([(x[i] - c[i]) * (x[i] - c[i]) FOR i IN range(1, len(x) + 1)]) AS d
    FROM parts JOIN book2 USING (p)) AS pairs GROUP BY vec_id, p),
codes AS (
  SELECT vec_id, string_agg(printf('%02x', (best % 64)::INT), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error
  FROM last GROUP BY vec_id),
digest AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM codes JOIN kept USING (vec_id), digest
"""
