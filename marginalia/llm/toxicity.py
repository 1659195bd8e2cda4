"""Toxicity: a linear model on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the different n-grams of its lower-cased characters, hashed to
``2 ** BITS`` places.  A place is scaled by the log ratio of the shares of toxic and other documents that
hold it; logistic regression on the scaled features gives the weights.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common, labelled

SIZES = (4, 5, 6)
BITS = 20
# Documents of each class to fit on, documents that must hold an n-gram, ratio below which it is left out.
EACH = 2000
SEEN = 4
LEAST_RATIO = 2.0
ROUNDS = 80
# Folds, held-out fold and bar of the contract.
FOLDS, HELD, BAR = 5, 0, 0.5
_SCALE = 2.0


def places(text: str, last: np.ndarray) -> np.ndarray:
    """The different feature places of a text; ``last`` is scratch space, one number per place."""
    chars = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found = []
    for size in SIZES:
        count = max(0, len(chars) - size + 1)
        gram = np.full(count, size, np.uint64)
        for i in range(size):
            gram = gram * np.uint64(0xD6E8FEB86659FD93) + chars[i:i + count]
        gram = (gram ^ (gram >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        found.append((gram >> np.uint64(64 - BITS)).astype(np.int64))
    every = np.concatenate(found)
    # Of equal places the last one writes; it alone reads its own number back.
    number = np.arange(len(every), dtype=last.dtype)
    last[every] = number
    return every[last[every] == number]


def fit(samples: list[np.ndarray], y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weight of every place (ratio times learned weight) and the intercept.

    Without documents of both classes the model knows only the share of toxic ones.
    """
    n, toxic = len(y), int(y.sum())
    if not 0 < toxic < n:
        share = (toxic + 0.5) / (n + 1)
        return np.zeros(1 << BITS), float(np.log(share / (1 - share)))
    bad = np.zeros(1 << BITS)
    good = np.zeros(1 << BITS)
    for here, is_bad in zip(samples, y):
        (bad if is_bad else good)[here] += 1
    ratio = np.log((bad + 1) / (toxic + 2) * (n - toxic + 2) / (good + 1))
    ratio[(bad + good < SEEN) | (np.abs(ratio) < LEAST_RATIO)] = 0
    kept = [here[ratio[here] != 0] for here in samples]
    place = np.concatenate(kept).astype(np.int32)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(k) for k in kept])
    value = (ratio[place] / _SCALE).astype(np.float32)
    # Both classes weigh the same.
    weigh = np.where(y == 1, 0.5 / toxic, 0.5 / (n - toxic))
    w, bias = np.zeros(1 << BITS), 0.0
    first, second = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, ROUNDS + 1):
        logit = np.bincount(row, weights=value * w[place], minlength=n) + bias
        error = (1 / (1 + np.exp(-logit)) - y) * weigh
        slope = np.append(np.bincount(place, weights=value * error[row], minlength=len(w)) + 1e-4 * w, error.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        move = 0.05 * first / (1 - 0.9 ** step) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    return w * ratio / _SCALE, float(bias)


def train(docs: DataFrame, labels: DataFrame, each: int = EACH) -> tuple[np.ndarray, float]:
    """Fit on at most ``each`` labelled documents per class (the documented bound), whole texts.

    Tasks turn texts into feature places, so that the driver gets at most ``2 ** BITS`` numbers
    per document and never the texts.
    """
    common.ready(docs.sparkSession)

    def features(batches):
        last = np.zeros(1 << BITS, np.int32)
        for batch in batches:
            rows = [places(t or "", last).astype("<i4").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)],
                                             ["doc_id", "places", "y"])

    found = labelled.sample(docs, labels, "toxic", FOLDS, HELD, each).mapInArrow(
        features, "doc_id bigint, places binary, y int").toArrow()
    # The order of rows must not depend on the order of tasks.
    rows = sorted(zip(found["doc_id"].to_pylist(), found["places"].to_pylist(), found["y"].to_pylist()))
    return fit([np.frombuffer(r[1], "<i4") for r in rows], np.array([r[2] for r in rows], float))


def score(model: tuple[np.ndarray, float], text: Column) -> Column:
    """Probability that a text is toxic; null and empty texts get what the intercept says."""
    weights, bias = model[0].astype(np.float32), model[1]

    @F.arrow_udf("double")
    def apply(column: pa.Array) -> pa.Array:
        last = np.zeros(1 << BITS, np.int32)
        logits = [bias + float(weights[places(t.as_py() or "", last)].sum(dtype=np.float64)) for t in column]
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, float), -500, 500))))

    return apply(text)


def toxicity(docs: DataFrame, labels: DataFrame, each: int = EACH) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row and whole text of ``docs``.

    Only ``text`` makes the score.  Null and empty texts have the score of no evidence, repeated
    rows equal scores, a null id is in the fold of the empty text, an empty table has no rows,
    and without labels of both classes all texts score the same.  Other columns are not read.
    """
    return labelled.scored(docs, score(train(docs, labels, each), F.col("text")), FOLDS, HELD, BAR)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(common.table(spark, folder, "documents"), common.table(spark, folder, "labels"))
