"""Language identification: multinomial naive Bayes over hashed character n-grams.

The log-probability matrix (languages by buckets) is broadcast, and texts are
scored in numpy as sums of its rows.

The fit takes at most ``SAMPLE`` documents of each language, chosen by a hash;
all whole texts are scored.

Edge cases: null texts and texts without a letter get ``und`` and score 0, as
does every text if nothing could be learned; null languages teach nothing;
ties go to the language that sorts first; repeated rows are scored one by one
and of rows that share doc_id and lang the fit takes one text, the first in order;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Most documents of a language that the fit takes.
SAMPLE = 1_000
#: Sampled rows up to which they are broadcast.
BROADCAST_ROWS = 300_000
#: Documents of a language, for each that is wanted, among which one task chooses.
OVERSAMPLE = 4
#: Tasks that count a language's sample.
SHARES = 8
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
SMOOTHING = 0.5


@dataclass
class Model:
    languages: list[str]
    log_probability: np.ndarray  # float32, languages x buckets


def _folding() -> np.ndarray:
    """Lower case of letters up to U+024F; white space, digits and marks of ASCII become a space."""
    table = np.arange(0x250, dtype=np.uint32)
    for c in range(0x250):
        low = chr(c).lower()
        table[c] = ord(low) if len(low) == 1 else c
        if c < 0x80 and not chr(c).isalpha():
            table[c] = 32
    return table


_FOLD = _folding()


def grams(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) for the n-grams of each order; none crosses a row."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), "<u4")
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    bounds = heads[offsets]
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    points = np.where(points < 0x250, _FOLD[np.minimum(points, 0x24F)], points).astype(np.uint64)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32) | (rows[1:] != rows[:-1])
    points, rows = points[keep], rows[keep]
    for n in ORDERS:
        if len(points) < n:
            return
        last = len(points) - n + 1
        key = np.full(last, n, np.uint64)
        for k in range(n):
            key = key * common.U64(1_000_003) + points[k : k + last]
        at = rows[:last] == rows[n - 1 :]
        yield rows[:last][at], (common.mix(key[at]) % common.U64(BUCKETS)).astype(np.int64)


def train(docs: DataFrame, allowed: Column, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` documents of each ``lang`` that are ``allowed``."""
    common.small_batches(docs.sparkSession)
    ids = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & allowed).select(F.col("doc_id").cast("long").alias("doc_id"), "lang").distinct()
    ids = ids.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(2)).alias("hash"))
    # a common language is thinned where it lies: only the lowest hashes, a few
    # times as many as are wanted, go to the task that chooses among them
    counts = common.stored(ids.groupBy("lang").agg(F.count("*").alias("n")), "language-counts")
    if counts.count() <= BROADCAST_ROWS:
        counts = F.broadcast(counts)
    place = F.col("hash") / 2.0**64 + 0.5  # even in 0 to 1
    ids = ids.join(counts, "lang").where(place * F.col("n") <= OVERSAMPLE * sample)
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    ids = ids.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= sample).select("doc_id", "lang")
    ids = common.stored(ids, "language-sample")
    if ids.count() <= BROADCAST_ROWS:  # ``sample`` for each language
        ids = F.broadcast(ids)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").join(ids, ["doc_id", "lang"])
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(SHARES)))

    def count(table: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS, np.int64)
        for _, _, data, offsets in common.text_chunks(table["text"]):
            for _, buckets in grams(data, offsets):
                total += np.bincount(buckets, minlength=BUCKETS)
        return pa.table({"lang": table["lang"].slice(0, 1), "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    found = rows.groupBy("lang", "share").applyInArrow(count, "lang string, counts binary").collect()  # at most SHARES rows a language
    languages = sorted({r.lang for r in found})
    counts = np.full((len(languages), BUCKETS), SMOOTHING)
    for r in found:
        counts[languages.index(r.lang)] += np.frombuffer(bytes(r.counts), "<i8")
    logs = np.log(counts) - np.log(counts.sum(1, keepdims=True))
    return Model(languages, logs.astype(np.float32))


def score_chunk(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language and its posterior probability."""
    n = len(offsets) - 1
    total = np.zeros((len(model.languages), n))  # the prior is even, as the sample is
    for rows, buckets in grams(data, offsets):
        for k in range(len(model.languages)):
            total[k] += np.bincount(rows, weights=model.log_probability[k][buckets], minlength=n)
    total -= total.max(0)
    odds = np.exp(total)
    return total.argmax(0), odds.max(0) / odds.sum(0)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score for each document."""
    common.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                letters = np.array(batch["letters"].slice(i, j - i).to_pylist(), bool)
                names, score = ["und"] * (j - i), np.zeros(j - i)
                if model.languages:
                    best, probability = score_chunk(model, data, offsets)
                    names = [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                    score = np.where(letters, probability, 0.0)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", letters).mapInArrow(run, "doc_id long, lang_pred string, score double")
