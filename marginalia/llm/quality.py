"""Quality: attention-based multiple-instance learning over the passages of a document.

A document is a bag of passages and only the bag has a label.  Each passage is encoded from its
characters and words; gated attention weighs the encodings, and a linear layer scores their
weighted mean.  Encoder, attention and scorer are learned together.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common, labelled

PASSAGE_WORDS = 128
HIDDEN, GATE = 32, 16
# Documents of each class to fit on.
EACH = 3000
EPOCHS = 25
# Folds, held-out fold and bar of the contract.
FOLDS, HELD, BAR = 4, 2, 0.7

# Character classes: every ASCII mark by itself; other bytes by kind.
_CLASS = np.zeros(256, np.int64)
for _byte in range(256):
    _char = chr(_byte)
    _CLASS[_byte] = (0 if _byte >= 128 else 1 if _char.islower() else 2 if _char.isupper() else 3 if _char.isdigit()
                     else 4 if _char.isspace() else 5 if _byte < 33 else 6 + (_byte - 33) % 47)
CLASSES = 53
PAIRS = 64
LENGTHS = 16
FEATURES = CLASSES + PAIRS + LENGTHS + 4


def encode(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and the number of the first passage of each text.

    A text has a passage for each ``PASSAGE_WORDS`` words, and one at least.
    """
    hashes, starts, ends, first = common.words(offsets, data)
    counts = np.maximum(1, -(-np.diff(first) // PASSAGE_WORDS))
    begin = np.concatenate([[0], np.cumsum(counts)])
    total = int(begin[-1])
    row = common.owners(first)
    passage = begin[row] + (np.arange(len(hashes)) - first[row]) // PASSAGE_WORDS
    out = np.zeros((total, FEATURES))
    words = np.bincount(passage, minlength=total)
    if len(data):
        # A byte belongs to the passage of the word it is in or behind; what stands before the
        # first word of a text, to that text's first passage.
        word_of = np.searchsorted(starts, np.arange(len(data)), "right") - 1 if len(starts) else np.full(len(data), -1)
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        inside = (word_of >= 0) & (word_of >= first[text_of])
        owner = begin[text_of]
        owner[inside] = passage[word_of[inside]]
        chars = np.bincount(owner, minlength=total)
        kinds = _CLASS[data]
        out[:, :CLASSES] = np.bincount(owner * CLASSES + kinds, minlength=total * CLASSES).reshape(total, CLASSES)
        pair = (data[:-1].astype(np.int64) * 31 + data[1:]) * 0x9E37 >> 7 & (PAIRS - 1)
        one_text = text_of[:-1] == text_of[1:]
        out[:, CLASSES:CLASSES + PAIRS] = np.bincount(
            (owner[:-1] * PAIRS + pair)[one_text], minlength=total * PAIRS).reshape(total, PAIRS)
        out[:, :CLASSES + PAIRS] /= np.maximum(chars, 1)[:, None]
    if len(hashes):
        length = np.minimum(ends - starts, LENGTHS) - 1
        at = CLASSES + PAIRS
        out[:, at:at + LENGTHS] = np.bincount(
            passage * LENGTHS + length, minlength=total * LENGTHS).reshape(total, LENGTHS)
        out[:, at:at + LENGTHS] /= np.maximum(words, 1)[:, None]
        for i, n in enumerate((1, 2, 3)):
            run = common.runs_of(hashes, n)
            # Runs lie within one text, and belong to the passage they begin in.
            one_text = row[:len(run)] == row[n - 1:n - 1 + len(run)]
            run, where = run[one_text], passage[:len(run)][one_text]
            if not len(run):
                continue
            order = np.lexsort((run, where))
            new = np.ones(len(run), bool)
            new[1:] = (run[order][1:] != run[order][:-1]) | (where[order][1:] != where[order][:-1])
            distinct = np.bincount(where[order][new], minlength=total)
            out[:, at + LENGTHS + i] = distinct / np.maximum(np.bincount(where, minlength=total), 1)
    out[:, -1] = np.log1p(words)
    return out, begin


class Model:
    """Weights of the network; ``forward`` gives a logit per bag."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.w = {"enc": rng.normal(0, FEATURES ** -0.5, (FEATURES, HIDDEN)), "enc0": np.zeros(HIDDEN),
                  "v": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
                  "att": rng.normal(0, GATE ** -0.5, GATE), "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "out0": np.zeros(1)}

    def forward(self, x: np.ndarray, begin: np.ndarray):
        w = self.w
        x = np.clip((x - self.mean) / self.spread, -8, 8)
        h = np.tanh(x @ w["enc"] + w["enc0"])
        tanh, gate = np.tanh(h @ w["v"]), 1 / (1 + np.exp(-(h @ w["u"])))
        raw = (tanh * gate) @ w["att"]
        bag = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
        share = np.exp(raw - np.maximum.reduceat(raw, begin[:-1])[bag])
        share /= np.add.reduceat(share, begin[:-1])[bag]
        mean = np.add.reduceat(share[:, None] * h, begin[:-1])
        return mean @ w["out"] + w["out0"][0], (x, h, tanh, gate, share, bag, mean)

    def slopes(self, x: np.ndarray, begin: np.ndarray, y: np.ndarray, weigh: np.ndarray) -> dict[str, np.ndarray]:
        logit, (x, h, tanh, gate, share, bag, mean) = self.forward(x, begin)
        w = self.w
        error = (1 / (1 + np.exp(-logit)) - y) * weigh
        on_mean = error[:, None] * w["out"]
        on_share = (h * on_mean[bag]).sum(1)
        level = np.add.reduceat(share * on_share, begin[:-1])
        on_raw = share * (on_share - level[bag])
        on_product = on_raw[:, None] * w["att"]
        on_tanh, on_gate = on_product * gate * (1 - tanh ** 2), on_product * tanh * gate * (1 - gate)
        on_h = share[:, None] * on_mean[bag] + on_tanh @ w["v"].T + on_gate @ w["u"].T
        on_in = on_h * (1 - h ** 2)
        return {"enc": x.T @ on_in, "enc0": on_in.sum(0), "v": h.T @ on_tanh, "u": h.T @ on_gate,
                "att": (tanh * gate).T @ on_raw, "out": mean.T @ error, "out0": np.array([error.sum()])}


def fit(bags: list[np.ndarray], y: np.ndarray) -> Model:
    """Adam over small batches of bags; both classes weigh the same.

    Without documents of both classes the model gives every text the share of good ones.
    """
    model, n, good = Model(), len(y), int(y.sum())
    if not 0 < good < n:
        model.w = {k: np.zeros_like(v) for k, v in model.w.items()}
        share = (good + 0.5) / (n + 1)
        model.w["out0"][0] = np.log(share / (1 - share))
        return model
    everything = np.concatenate(bags)
    model.mean, model.spread = everything.mean(0), everything.std(0) + 1e-4
    weigh = np.where(y == 1, n / 2 / good, n / 2 / (n - good))
    first = {k: np.zeros_like(v) for k, v in model.w.items()}
    second = {k: np.zeros_like(v) for k, v in model.w.items()}
    rng, step = np.random.default_rng(5), 0
    for _ in range(EPOCHS):
        order = rng.permutation(n)
        for at in range(0, n, 128):
            chosen = order[at:at + 128]
            x = np.concatenate([bags[i] for i in chosen])
            begin = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            slope = model.slopes(x, begin, y[chosen], weigh[chosen] / len(chosen))
            step += 1
            for k, g in slope.items():
                g = g + 1e-4 * model.w[k]
                first[k], second[k] = 0.9 * first[k] + 0.1 * g, 0.999 * second[k] + 0.001 * g * g
                model.w[k] -= 3e-3 * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, each: int = EACH) -> Model:
    """Fit on at most ``each`` labelled documents per class (the documented bound), whole texts."""
    common.ready(docs.sparkSession)

    def features(batches):
        for batch in batches:
            keys, y = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row, offsets, data in common.slices(batch.column(1)):
                x, begin = encode(offsets, data)
                x = x.astype("<f4")
                count = len(begin) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row:row + count], pa.int64()),
                     pa.array([x[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])], pa.binary()),
                     pa.array(y[row:row + count], pa.int32())], ["doc_id", "passages", "y"])

    found = labelled.sample(docs, labels, "quality", FOLDS, HELD, each).mapInArrow(
        features, "doc_id bigint, passages binary, y int").toArrow()
    # The order of rows must not depend on the order of tasks.
    rows = sorted(zip(found["doc_id"].to_pylist(), found["passages"].to_pylist(), found["y"].to_pylist()))
    bags = [np.frombuffer(r[1], "<f4").reshape(-1, FEATURES).astype(float) for r in rows]
    return fit(bags, np.array([r[2] for r in rows], float))


def score(model: Model, text: Column) -> Column:
    """Probability that a text is good; null and empty texts are one passage without words."""
    @F.arrow_udf("double")
    def apply(column: pa.Array) -> pa.Array:
        logits = [np.zeros(0)]
        for _, offsets, data in common.slices(column):
            x, begin = encode(offsets, data)
            logits.append(model.forward(x, begin)[0])
        return pa.array(1 / (1 + np.exp(-np.clip(np.concatenate(logits), -500, 500))))

    return apply(text)


def quality(docs: DataFrame, labels: DataFrame, each: int = EACH) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row and whole text of ``docs``.

    Only ``text`` makes the score.  Null and empty texts are bags of one passage without words,
    repeated rows have equal scores, a null id is in the fold of the empty text, an empty table
    has no rows, and without labels of both classes all texts score the same.  Other columns are
    not read.
    """
    return labelled.scored(docs, score(train(docs, labels, each), F.col("text")), FOLDS, HELD, BAR)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return quality(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))
