"""N-gram Jaccard join with prefix trees.

The shingles of a text are 64-bit hashes in ascending order, the global order of all sets.  Two
sets whose Jaccard similarity reaches the threshold differ in a bounded number of shingles.  Hash
space is cut into more parts than that, so that the pair agrees in all of some part: a key is
made of each part, and sets that share a key are tied together.  There are spare parts, so that a
linking pair agrees in several; parts that hold frequent shingles only, or none, say little and are
left out of a set that has no more of them than are spare.  Whatever links lies in one block of tied
sets.  In a block the sets are stored in a trie; each set walks it level by level, carries
the overlap that paths share, and leaves a subtree once the remaining lengths cannot reach the
overlap that a link needs.
"""

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common

# Sets that one trie holds; larger blocks are joined piece by piece.
TRIE = 512
# Ratio of the largest to the smallest set size of a level.
LEVEL = Fraction(7, 5)
# Keys that a task sorts at once; the arrays beside them take about ten times their bytes.
HELD = 1_000_000
# Shingles that count as frequent, at most, and documents of one task that must hold them.
FREQUENT = 1 << 20
TOGETHER = 4


# --- sets ------------------------------------------------------------------------------------

def shingle_sets(offsets: np.ndarray, data: np.ndarray, n: int) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text; a shorter text is one shingle as a whole."""
    hashes, _, _, first = common.words(offsets, data, fold=True)
    runs = common.runs_of(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            out.append(common.runs_of(hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(runs[:0])
    return out


def _signature(members: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    a = common.mixed(members + np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)
    b = common.mixed(members ^ np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def signed(docs: DataFrame, n: int) -> DataFrame:
    """``(doc_id, place, n_shingles, sig, sig2)``; sets without shingles have null signatures, ``place`` is a hash of the text."""
    def sign(batches):
        for batch in batches:
            for row, offsets, data in common.slices(batch.column(1)):
                sets = shingle_sets(offsets, data, n)
                pairs = [_signature(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(sets)), batch.column(2).slice(row, len(sets)),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
                    ["doc_id", "place", "n_shingles", "sig", "sig2"])

    return docs.select("doc_id", "text", F.xxhash64("text").alias("place")).mapInArrow(
        sign, "doc_id bigint, place bigint, n_shingles bigint, sig bigint, sig2 bigint")


# --- ties ------------------------------------------------------------------------------------

class _Levels:
    """Size classes of sets, and the number of parts for pairs whose smaller set is in a class."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.begins = [1]

    def of(self, size: int) -> int:
        while self.begins[-1] <= size:
            self.begins.append(max(self.begins[-1] + 1, int(self.begins[-1] * LEVEL)))
        return int(np.searchsorted(self.begins, size, "right")) - 1

    def differences(self, level: int) -> int:
        """Most shingles in which a linking pair differs, its smaller set being of this level."""
        small = self.begins[level + 1] - 1
        both = small + int(small / self.t)
        return int((1 - self.t) / (1 + self.t) * both)

    def keys(self, members: np.ndarray, frequent: np.ndarray) -> list[np.ndarray]:
        """Keys of a set: for its own level, and for a level below in which it may have partners.

        A linking pair agrees in one part more than are spare.  Whether a part is weak follows from
        its content, so where a set leaves out no more weak parts than are spare, the pair still
        agrees in a part that both make a key of.  Any choice of ``frequent`` is right.
        """
        size, out = len(members), []
        own = self.of(size)
        # A partner's size is at least t times this one's.
        lowest = self.of(max(1, -(-size * self.t.numerator // self.t.denominator)))
        value = common.mixed(members + np.uint64(0xA0761D6478BD642F))
        total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
        rare = np.concatenate([[0], np.cumsum(~_among(members, frequent))])
        for level in range(lowest, own + 1):
            differ = self.differences(level)
            if not differ:
                continue  # such pairs are equal sets
            spare = differ // 4 + 4
            parts = differ + 1 + spare
            part = ((members >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            edge = np.searchsorted(part, np.arange(parts + 1))
            content = total[edge[1:]] - total[edge[:-1]]
            strong = rare[edge[1:]] > rare[edge[:-1]]
            if parts - int(strong.sum()) > spare:
                strong[:] = True
            number = np.flatnonzero(strong).astype(np.uint64)
            out.append(common.mixed(content[strong] ^ common.mixed(number + np.uint64(level + 1) * np.uint64(1 << 32))))
        return out


def _among(members: np.ndarray, listed: np.ndarray) -> np.ndarray:
    if not len(listed):
        return np.zeros(len(members), bool)
    return listed[np.minimum(np.searchsorted(listed, members), len(listed) - 1)] == members


def frequent_shingles(docs: DataFrame, n: int) -> np.ndarray:
    """Shingles of passages that many documents share, ascending; ``FREQUENT`` of them at most.

    All documents count.  A task hands on what ``TOGETHER`` of its documents hold.
    """
    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, offsets, data in common.slices(batch.column(0)):
                held += shingle_sets(offsets, data, n)
            size = sum(map(len, held))
            if size > 3_000_000:
                yield _often(held)
                held = []
        if held:
            yield _often(held)

    found = (docs.select("text").mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle")
             .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "shingle").limit(FREQUENT).select("shingle").toArrow())
    return np.sort(found["shingle"].to_numpy().view(np.uint64))


def _often(sets: list[np.ndarray]) -> pa.RecordBatch:
    shingle, n = np.unique(np.concatenate(sets), return_counts=True)
    often = n >= TOGETHER
    return pa.RecordBatch.from_arrays([pa.array(shingle[often].view(np.int64)), pa.array(n[often].astype(np.int64))],
                                      ["shingle", "n"])


def _runs(batches):
    """Ties of sorted ``(key, sig)`` rows: each row to the first one with its key."""
    last_key, last_sig = None, None
    for batch in batches:
        key, sig = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        tie = batch.column(2)
        done = np.asarray(tie.is_valid())
        if done.any():
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(done)), tie.filter(pa.array(done))], ["a", "b"])
        key, sig = key[~done], sig[~done]
        if not len(key):
            continue
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        head = sig[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        if last_key is not None and key[0] == last_key:
            head[:int(np.argmax(new[1:])) + 1 if new[1:].any() else len(key)] = last_sig
        last_key, last_sig = key[-1], head[-1]
        tied = head != sig
        if tied.any():
            yield pa.RecordBatch.from_arrays([pa.array(sig[tied]), pa.array(head[tied])], ["a", "b"])


def ties(docs: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """``(a, b)`` signatures of sets that share a key.

    A task ties the sets that it reads to the first one of each key itself and hands on that one
    only, so that a key reaches the shuffle once per ``HELD`` keys of a task however many sets have it.
    """
    spark = docs.sparkSession
    listed = spark.sparkContext.broadcast(frequent_shingles(docs, n))

    def make(batches):
        levels, keys, sigs, held = _Levels(threshold), [], [], 0
        for batch in batches:
            for _, offsets, data in common.slices(batch.column(1)):
                for members in shingle_sets(offsets, data, n):
                    found = levels.keys(members, listed.value) if len(members) else []
                    if found:
                        sig = _signature(members)[0]
                        keys += found
                        sigs += [np.full(sum(map(len, found)), sig, np.int64)]
                        held += len(sigs[-1])
                if held > HELD:
                    yield from _first_of_each(keys, sigs)
                    keys, sigs, held = [], [], 0
        yield from _first_of_each(keys, sigs)

    found = docs.select("doc_id", "text").mapInArrow(make, "key bigint, sig bigint, tie bigint")
    return found.repartition("key").sortWithinPartitions("key").mapInArrow(_runs, "a bigint, b bigint").distinct()


def _first_of_each(keys: list[np.ndarray], sigs: list[np.ndarray]):
    if not keys:
        return
    key, sig = np.concatenate(keys).view(np.int64), np.concatenate(sigs)
    order = np.lexsort((sig, key))
    key, sig = key[order], sig[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    head = sig[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
    tied = np.unique(np.stack([sig[~new], head[~new]], 1), axis=0)
    tied = tied[tied[:, 0] != tied[:, 1]]
    step, key, sig = 100_000, key[new], sig[new]
    for at in range(0, len(key), step):
        k = key[at:at + step]
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(sig[at:at + step]), pa.nulls(len(k), pa.int64())],
                                         ["key", "sig", "tie"])
    if len(tied):
        # A tie travels with a key of its own, to any task.
        yield pa.RecordBatch.from_arrays([pa.array(common.mixed(tied[:, 0].view(np.uint64)).view(np.int64)),
                                          pa.array(tied[:, 0]), pa.array(tied[:, 1])], ["key", "sig", "tie"])


# --- tries -----------------------------------------------------------------------------------

class Trie:
    """A radix tree over ascending sets.  Nodes stand breadth first; the children of a node are
    neighbours.  A node has the shingles of its edge as a range of ``tokens``, the number of
    shingles up to its end, and the smallest and largest size of the sets below it."""

    def __init__(self, sets: list[np.ndarray]):
        shingles, ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.count = len(shingles)
        edges = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
        self.sets = [ids[a:b] for a, b in zip(edges[:-1], edges[1:])]
        order = sorted(range(len(sets)), key=lambda i: self.sets[i].astype(">u4").tobytes())
        ordered = [self.sets[i] for i in order]
        shared = [0] + [_common(a, b) for a, b in zip(ordered[:-1], ordered[1:])] + [0]
        self.tokens = np.concatenate(ordered)
        where = np.concatenate([[0], np.cumsum([len(s) for s in ordered])])
        # A node is a range of sorted sets and the depth up to which they agree.
        level, nodes = [(0, len(ordered), 0)], []
        while level:
            nodes.append(level)
            below = []
            for low, high, depth in level:
                if high - low == 1:
                    continue
                at = low
                for cut in [i for i in range(low + 1, high) if shared[i] == depth] + [high]:
                    deep = len(ordered[at]) if cut - at == 1 else min(shared[at + 1:cut])
                    below.append((at, cut, deep))
                    at = cut
            level = below
        flat = [node for level in nodes for node in level]
        sizes = np.array([len(s) for s in ordered])
        self.depth = np.array([d for _, _, d in flat])
        self.small = np.minimum.reduceat(sizes, [a for a, _, _ in flat]) if len(flat) == 1 else \
            np.array([sizes[a:b].min() for a, b, _ in flat])
        self.large = np.array([sizes[a:b].max() for a, b, _ in flat])
        self.leaf = np.array([order[a] if b - a == 1 else -1 for a, b, _ in flat])
        kids = [sum(1 for i in range(a + 1, b) if shared[i] == d) + 1 if b - a > 1 else 0 for a, b, d in flat]
        self.kids = np.array(kids)
        self.first = 1 + np.concatenate([[0], np.cumsum(kids)[:-1]])
        above = np.zeros(len(flat), np.int64)
        for i, (k, f) in enumerate(zip(kids, self.first.tolist())):
            above[f:f + k] = self.depth[i]
        base = where[[a for a, _, _ in flat]]
        self.begin, self.end = base + above, base + self.depth
        self.last = np.where(self.depth > 0, self.tokens[np.maximum(self.end - 1, 0)], -1)

    def links(self, number: int, threshold: Fraction) -> np.ndarray:
        """All sets of the trie that link with set ``number``."""
        own = self.sets[number]
        size = len(own)
        flags = np.zeros(self.count, bool)
        flags[own] = True
        total = np.concatenate([[0], np.cumsum(flags[self.tokens])])
        node = np.zeros(1, np.int64)
        overlap = np.array([total[self.end[0]] - total[self.begin[0]]])
        up, down = threshold.numerator, threshold.denominator
        found = []
        while len(node):
            # What the walked path leaves of this set, and of the longest set below the node.
            rest = size - np.searchsorted(own, self.last[node], "right")
            most = overlap + np.minimum(rest, self.large[node] - self.depth[node])
            # |x & y| * (up + down) >= up * (|x| + |y|), at least for the shortest set below.
            alive = most * (up + down) >= up * (size + self.small[node])
            node, overlap = node[alive], overlap[alive]
            ends = self.leaf[node] >= 0
            found.append(self.leaf[node[ends]])
            node, overlap = node[~ends], overlap[~ends]
            kids = self.kids[node]
            if not len(node):
                break
            shift = np.repeat(self.first[node] - np.concatenate([[0], np.cumsum(kids)[:-1]]), kids)
            node = shift + np.arange(len(shift))
            overlap = np.repeat(overlap, kids) + total[self.end[node]] - total[self.begin[node]]
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def _common(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    return int(differ[0]) if len(differ) else n


def linked_sets(sets: list[np.ndarray], threshold: Fraction) -> np.ndarray:
    """For each set the smallest number of a set that links reach within ``sets``."""
    trie, label = Trie(sets), np.arange(len(sets))
    for number in range(len(sets)):
        near = np.unique(label[trie.links(number, threshold)])
        if len(near) > 1:
            label[np.isin(label, near)] = near[0]
    return label


# --- blocks ----------------------------------------------------------------------------------

def _joined(threshold: Fraction):
    def join(batches):
        for unit in common.runs_of_key(batches, "unit"):
            node = unit.column("node").to_numpy()
            node, first = np.unique(node, return_index=True)
            members = unit.column("members").take(pa.array(first)).to_pylist()
            label = linked_sets([np.frombuffer(m, "<u8") for m in members], threshold)
            far = label != np.arange(len(node))
            if far.any():
                yield pa.RecordBatch.from_arrays([pa.array(node[far]), pa.array(node[label[far]])], ["a", "b"])

    return join


def _links(units: DataFrame, threshold: Fraction, tasks: int) -> DataFrame:
    """Links ``(a, b)`` that connect what links within each unit; a task streams its units, of about two tries of sets each.

    The links are few beside the sets, so they are brought together: a file each of so many tasks would hold next to nothing.
    """
    return (units.repartition(tasks, "unit").sortWithinPartitions("unit")
            .mapInArrow(_joined(threshold), "a bigint, b bigint").repartition("a"))


def near_groups(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``; see :func:`grouped`."""
    return grouped(docs, n, threshold).select("doc_id", "n_shingles", "component_id")


def grouped(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5), steps: common.Steps | None = None) -> DataFrame:
    """``(doc_id, n_shingles, sig, sig2, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links reach.  Null and empty texts and such
    of blanks have no shingles and link with nothing.  A set is known by its signature ``sig, sig2``, never by an id: equal
    sets are one node, and texts that share an id are nodes of their own; ids are looked up at the end.  A row with a null id
    gets the component of its equals if one of them has an id, else null.  Other columns are not read, an empty table gives none.

    Exact: no pair of different sets that links is missed.  Blocks of more than ``TRIE`` sets are
    cut into pieces, and each piece is joined together with the first one.  Where that has
    tied most of a block into one component, only sets outside it still have to meet
    every piece; no pairs are written, just one link for each tied set.

    What is written on the way goes as soon as nothing reads it; ``steps`` holds what the result is read from, for a caller that writes it.
    """
    spark = docs.sparkSession
    steps = steps or common.Steps(spark, "jaccard")
    tasks = 4 * common.partitions(spark)
    own = steps.keep(signed(docs, n), "signed")
    tied = steps.keep(ties(docs, n, threshold), "ties")
    blocks = steps.keep(common.components(tied, steps, "tied"), "blocks")
    steps.only("signed", "blocks")
    heads = (own.where("sig IS NOT NULL AND doc_id IS NOT NULL").groupBy("sig", "sig2")
             .agg(F.min(F.struct("doc_id", "place")).alias("m"))
             .select("sig", "sig2", F.col("m.doc_id").alias("head"), F.col("m.place").alias("place")))
    heads = steps.keep(heads, "heads")
    # Sets in blocks; a block with a single set that has an id has nothing to join.
    inside = heads.join(blocks.withColumnRenamed("node", "sig"), "sig").select("sig", "sig2", "head", "place", "component")
    sizes = inside.groupBy("component").agg(F.count("*").alias("sets")).where("sets > 1")
    inside = steps.keep(inside.join(sizes, "component"), "inside")
    steps.drop("blocks")

    def shingled(batches):
        for batch in batches:
            for row, offsets, data in common.slices(batch.column(1)):
                sets = shingle_sets(offsets, data, n)
                signs = [_signature(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(4).slice(row, len(sets)), batch.column(2).slice(row, len(sets)),
                     batch.column(3).slice(row, len(sets)),
                     pa.array([s.astype("<u8").tobytes() if s2 == (a, b) else None for s, s2, a, b in zip(
                         sets, signs, batch.column(4).slice(row, len(sets)).to_pylist(),
                         batch.column(5).slice(row, len(sets)).to_pylist())], pa.binary())],
                    ["node", "component", "sets", "members"])

    wanted = inside.select(F.col("head").alias("_id"), F.col("place").alias("_place"), "component", "sets", "sig", "sig2")
    # Texts meet the chosen ids by a shuffle at every size, so that the plan does not turn with it.
    own_place = (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_place"))
    members = (docs.select("doc_id", "text").join(wanted.hint("merge"), own_place)
               .select("doc_id", "text", "component", "sets", "sig", "sig2")
               .mapInArrow(shingled, "node bigint, component bigint, sets bigint, members binary")
               # Another text may have the same id and hash.
               .where("members IS NOT NULL"))
    members = steps.keep(members, "members")
    steps.drop("inside")

    pieces = F.ceil(F.col("sets") / TRIE)
    piece = F.pmod(F.xxhash64("node"), pieces)
    with_piece = members.withColumn("piece", F.when(F.col("sets") <= TRIE, F.lit(0)).otherwise(piece))
    # The first piece of a large block goes to all of its pieces.
    target = F.when((F.col("sets") > TRIE) & (F.col("piece") == 0), F.sequence(F.lit(0).cast("bigint"), pieces - 1)).otherwise(
        F.array(F.col("piece").cast("bigint")))
    units = with_piece.select("node", "members", F.explode(target).alias("to"), "component") \
        .select("node", "members", F.xxhash64("component", "to").alias("unit"))
    links = steps.keep(_links(units, threshold, tasks), "links-0")

    large = steps.keep(with_piece.where(F.col("sets") > TRIE).select("node", "component", "piece", "sets"), "large")
    if large.limit(1).count():
        # Which component does each set of a large block belong to so far?
        reached = common.components(links, steps, "reached").withColumnRenamed("component", "group")
        state = large.join(reached, "node", "left").withColumn("group", F.coalesce("group", "node"))
        groups = state.groupBy("component", "group").count()
        most = groups.groupBy("component").agg(F.max(F.struct("count", "group")).alias("m"))
        outside = (state.join(most.select("component", F.col("m.group").alias("main")), "component")
                   .where("group <> main").select("node", "component", "sets"))
        outside = steps.keep(outside, "outside")
        left = outside.groupBy("component").agg(F.count("*").alias("left"))
        chunks = F.ceil(F.col("left") / TRIE)
        # Every piece of the block meets every chunk of the sets outside.
        big = with_piece.where(F.col("sets") > TRIE).join(left, "component")
        all_pieces = (big.select("node", "members", "component", F.col("piece").cast("bigint").alias("to"),
                                 F.explode(F.sequence(F.lit(0).cast("bigint"), chunks - 1)).alias("chunk")))
        every = (members.join(outside.select("node"), "node", "left_semi").join(left, "component")
                 .select("node", "members", "component",
                         F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("sets") / TRIE) - 1)).alias("to"),
                         F.pmod(F.xxhash64("node", F.lit(3)), chunks).alias("chunk")))
        units = all_pieces.union(every).select("node", "members", F.xxhash64("component", "to", "chunk").alias("unit"))
        links = links.union(steps.keep(_links(units, threshold, tasks), "links-1"))

    steps.drop("members")
    found = steps.keep(common.components(links, steps, "linked"), "found")
    steps.only("signed", "heads", "found")
    # A component has the smallest id of its sets.
    named = (heads.join(found, F.col("sig") == F.col("node")).groupBy("component").agg(F.min("head").alias("component_id")))
    by_set = (found.join(named, "component").select("node", "component_id"))
    by_set = heads.join(by_set, F.col("sig") == F.col("node"), "left").select(
        F.col("sig").alias("s"), F.col("sig2").alias("s2"), F.coalesce("component_id", "head").alias("component_id"))
    return (own.join(by_set, (F.col("sig") == F.col("s")) & (F.col("sig2") == F.col("s2")), "left")
            .select("doc_id", "n_shingles", "sig", "sig2",
                    F.when(F.col("sig").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def without_near_copies(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` with one document of each near-duplicate group, the one with the smallest id.

    Of texts of a group that share this id, the one with the smallest signature stays, and with it every row that repeats its id and its
    set.  An id that stands at several texts goes only where the text does.  Rows with a null id stay: they stand for
    nothing and nothing stands for them.
    """
    spark = docs.sparkSession
    steps = common.Steps(spark, "near-copies")
    found = grouped(docs, n, threshold, steps).where("doc_id IS NOT NULL")
    found = steps.keep(found.groupBy("doc_id", "sig", "sig2").agg(F.min("component_id").alias("component_id")), "sets")
    steps.only("sets")
    stays = (found.where("doc_id = component_id AND sig IS NOT NULL").groupBy("component_id")
             .agg(F.min(F.struct("sig", "sig2")).alias("first")).withColumnRenamed("component_id", "doc"))
    # Only a component's own id can stand at sets that stay beside others that go.
    judged = found.join(stays, F.col("doc_id") == F.col("doc"), "left")
    goes = F.col("sig").isNotNull() & ((F.col("doc_id") != F.col("component_id")) | (F.struct("sig", "sig2") != F.col("first")))
    judged = judged.select("doc_id", "sig", "sig2", goes.alias("goes"))
    ids = steps.keep(judged.groupBy("doc_id").agg(F.bool_and("goes").alias("all_go"), F.bool_or("goes").alias("some_go"))
                     .where("some_go"), "ids")
    gone, = common.unused(docs, "gone_id")
    left = docs.join(ids.where("all_go").select(F.col("doc_id").alias(gone)), F.col("doc_id") == F.col(gone), "left_anti")
    mixed = ids.where("NOT all_go").select(F.col("doc_id").alias(gone))
    if mixed.isEmpty():
        return left

    @F.arrow_udf("struct<sig: bigint, sig2: bigint>")
    def signature(text: pa.Array) -> pa.Array:
        sets = [s for _, offsets, data in common.slices(text) for s in shingle_sets(offsets, data, n)]
        pairs = [_signature(s) if len(s) else (None, None) for s in sets]
        return pa.StructArray.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], ["sig", "sig2"])

    # Rows of ids that stay with one text and go with another are told apart by their sets.
    sig, = common.unused(docs, "gone_sig")
    part = left.join(mixed, F.col("doc_id") == F.col(gone), "left_semi").withColumn(sig, signature("text"))
    out = judged.where("goes").select(F.col("doc_id").alias(gone), F.col("sig").alias("_s"), F.col("sig2").alias("_s2"))
    part = part.alias("own").join(out.alias("out"), (F.col("own.doc_id") == F.col(f"out.{gone}")) & (F.col(f"own.{sig}.sig") == F.col("out._s"))
                                  & (F.col(f"own.{sig}.sig2") == F.col("out._s2")), "left_anti")
    return left.join(mixed, F.col("doc_id") == F.col(gone), "left_anti").unionByName(part.select(*docs.columns))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(common.table(spark, folder, "documents"), 3, Fraction(9, 10))
