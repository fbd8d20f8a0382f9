"""Quality classifier: Naive Bayes support vectors.

Binary n-gram indicators are scaled by their class log-count ratios, rows are
scaled to length one, and a linear hinge-loss model is fitted by dual
coordinate descent.  Indicators are word n-grams, n-grams of word shapes
together with the power of two of their share of the text, and the share of
word n-grams that the text repeats.  Margins become probabilities by a logistic
fit on rows that the descent has not seen.

The fit takes at most ``SAMPLE`` labelled documents and ``SAMPLE_INDICATORS``
indicators of them, chosen by a hash of doc_id; all whole texts are scored.

Edge cases: null and empty texts have an indicator of their own and a score; a
training table without both classes gives every text the share of label 1 (0.5
if there are no labels); conflicting labels of a doc_id are averaged; of rows
that share a doc_id one teaches; repeated rows are scored one by one; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Most labelled rows that the fit takes.
SAMPLE = 8_000
#: Most indicators (of 4 bytes) that come to the driver, in hash order of their documents.
SAMPLE_INDICATORS = 1 << 25
DIMENSIONS = 1 << 18
COST = 1.0
EPOCHS = 12
SMOOTHING = 1.0
#: Predicted 1 from this score.
THRESHOLD = 0.3

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("0")
_SHAPE[65:91] = ord("A")
_SHAPE[97:123] = ord("a")
_SHAPE[128:] = ord("a")


@dataclass
class Model:
    weights: np.ndarray  # float32, of the scaled indicators' product with the ratios
    ratios: np.ndarray
    slope: float
    intercept: float
    constant: float | None = None


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with runs of a character class cut to one character."""
    kind = _SHAPE[data]
    first = np.zeros(len(data), bool)
    first[starts] = True
    inside = np.zeros(len(data) + 1, np.int64)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside)[:-1] > 0
    changed = np.ones(len(data), bool)
    changed[1:] = kind[1:] != kind[:-1]
    keep = inside & (first | changed)
    place = np.concatenate([[0], np.cumsum(keep)])
    return common.span_hashes(kind[keep], place[starts], place[ends])


def indicators(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, indicator) without repeats, ordered by row."""
    n = len(offsets) - 1
    starts, ends, rows = common.word_spans(data, offsets, common.NON_SPACE)
    words = common.row_counts(rows, n)
    size = np.floor(np.log2(words + 1)).astype(np.uint64)
    found = [(np.arange(n), common.mix(size + common.U64(1 << 40)))]
    plain = common.span_hashes(common.LOWER[data], starts, ends)
    shape = _shapes(data, starts, ends)
    for k in (1, 2):
        at, grams = common.gram_hashes(plain, rows, k)
        found.append((rows[at], grams))
    for k in (1, 2, 3):
        at, grams = common.gram_hashes(shape, rows, k)
        key, counts = _distinct(rows[at], grams)
        share = np.clip(np.floor(np.log2(counts / words[key[0]])), -8, 0) + 8
        found.append((key[0], common.mix(key[1] ^ (share.astype(np.uint64) << common.U64(32)))))
    for k in (1, 3):
        at, grams = common.gram_hashes(plain, rows, k)
        (of, _), counts = _distinct(rows[at], grams)
        windows = common.row_counts(rows[at], n)
        once = common.row_counts(of[counts == 1], n)
        share = np.where(windows > 0, 10 * (1 - once / np.maximum(windows, 1)), 11).astype(np.uint64)
        found.append((np.arange(n), common.mix(share + common.U64((k << 48) + 1))))
    of = np.concatenate([f[0] for f in found]).astype(np.int64)
    which = (np.concatenate([f[1] for f in found]) % common.U64(DIMENSIONS)).astype(np.int64)
    keys = np.unique(of * DIMENSIONS + which)
    return keys // DIMENSIONS, keys % DIMENSIONS


def _distinct(rows: np.ndarray, grams: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    order = np.lexsort([grams, rows])
    rows, grams = rows[order], grams[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (grams[1:] != grams[:-1])
    at = np.flatnonzero(new)
    return (rows[at], grams[at]), np.diff(np.concatenate([at, [len(rows)]]))


def _descent(rows: list[np.ndarray], signs: np.ndarray, ratios: np.ndarray, cost: float, epochs: int) -> np.ndarray:
    """Weights of the hinge-loss model, by dual coordinate descent over rows of length one."""
    values = [r / max(np.sqrt((r * r).sum()), 1e-12) for r in (ratios[x] for x in rows)]
    weights, dual = np.zeros(len(ratios)), np.zeros(len(rows))
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            x, v = rows[i], values[i]
            gradient = signs[i] * (weights[x] @ v) - 1
            new = min(max(dual[i] - gradient, 0.0), cost)  # rows have length one
            if new != dual[i]:
                weights[x] += (new - dual[i]) * signs[i] * v
                worst = max(worst, abs(new - dual[i]))
                dual[i] = new
        if worst < 1e-3:
            break
    return weights


def _logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept by Newton steps, with a weak pull of the slope to 1."""
    theta = np.array([1.0, 0.0])
    x = np.column_stack([margins, np.ones(len(margins))])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        gradient = x.T @ (p - labels) + np.array([1e-2 * (theta[0] - 1), 1e-3 * theta[1]])
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(hessian, gradient)
        theta -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> Model:
    if not len(rows) or labels.min() == labels.max():
        nothing = np.zeros(1, np.float32)
        return Model(nothing, nothing, 1.0, 0.0, float(labels.mean()) if len(rows) else 0.5)

    def part(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = [np.full(DIMENSIONS, SMOOTHING), np.full(DIMENSIONS, SMOOTHING)]
        for i in at:
            counts[int(labels[i])][rows[i]] += 1
        ratios = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        return ratios, _descent([rows[i] for i in at], 2 * labels[at] - 1, ratios, cost, epochs)

    folds, margins = np.arange(len(rows)) % 3, np.zeros(len(rows))
    for k in range(3):
        train = np.flatnonzero(folds != k)
        if labels[train].min() == labels[train].max():
            continue
        ratios, weights = part(train)
        for i in np.flatnonzero(folds == k):
            margins[i] = _margin(rows[i], ratios, weights)
    slope, intercept = _logistic(margins, labels)
    ratios, weights = part(np.arange(len(rows)))
    return Model((weights * ratios).astype(np.float32), ratios.astype(np.float32), slope, intercept)


def _margin(row: np.ndarray, ratios: np.ndarray, weights: np.ndarray) -> float:
    v = ratios[row]
    return float(weights[row] @ v) / max(float(np.sqrt((v * v).sum())), 1e-12)


def score_chunk(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    if model.constant is not None:
        return np.full(n, model.constant)
    rows, which = indicators(data, offsets)
    margin = common.row_counts(rows, n, model.weights[which])
    length = np.sqrt(common.row_counts(rows, n, model.ratios[which].astype(np.float64) ** 2))
    z = model.slope * margin / np.maximum(length, 1e-12) + model.intercept
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` whose doc_id is ``allowed``."""
    spark = docs.sparkSession
    common.small_batches(spark)
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & allowed).groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.avg(label).alias("__label"))
    chosen = known.orderBy(F.xxhash64("__id", F.lit(1)), "__id").limit(sample).collect()  # bounded by ``sample``
    if not chosen:
        return fit([], np.zeros(0))
    small = F.broadcast(spark.createDataFrame(chosen, known.schema))
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), "text").join(small, "__id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                of, which = indicators(data, offsets)
                ends = np.searchsorted(of, np.arange(j - i), side="right")
                sets = [which[a:b].astype("<i4").tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                yield pa.RecordBatch.from_arrays([batch["__id"].slice(i, j - i), batch["__label"].slice(i, j - i), pa.array(sets, pa.binary())], names=["id", "label", "which"])

    sets = rows.mapInArrow(run, "id long, label double, which binary").groupBy("id").agg(F.first("label").alias("label"), F.min("which").alias("which"))
    sets = common.stored(sets, "quality-sample")
    sizes = {r.id: r.n for r in sets.select("id", (F.length("which") / 4).cast("long").alias("n")).collect()}  # at most ``sample``
    total, taken = 0, []
    for r in chosen:
        total += sizes.get(r["__id"], 0)
        if total > SAMPLE_INDICATORS:
            break
        taken.append(r["__id"])
    if len(taken) < len(chosen):
        sets = sets.join(F.broadcast(spark.createDataFrame([(i,) for i in taken], "id long")), "id", "left_semi")
    found = sorted((r.id, bytes(r.which), r.label) for r in sets.collect())
    return fit([np.frombuffer(r[1], "<i4") for r in found], np.array([r[2] >= 0.5 for r in found], np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for each document."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), pa.array(score_chunk(shared.value, data, offsets))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
