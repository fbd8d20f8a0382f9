"""Licence scan by diagonal voting.

The rolling hashes of all word k-grams of all texts are joined in Spark to the
positions of the notices' k-grams.  Matches vote for the diagonal (position in
the text less position in the notice), neighbouring diagonals are merged, and
the spans that they mark are verified word by word.  The table of notices is
small and fixed, so it is broadcast; the candidates are broadcast only when
their counted number allows it.

Edge cases: null and empty texts have no words and no labels; texts shorter
than a k-gram have only their phrases; repeated rows get equal results;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .license_texts import NOTICES, PHRASES

K = 4
#: Diagonals at most this far apart are merged.
NEIGHBOURS = 3
#: Share of a notice's words that a verified span holds in order.
COVERAGE = 0.8
#: Candidate rows up to which they are broadcast (about 100 bytes each).
BROADCAST_ROWS = 300_000


def _words(text: bytes) -> list[bytes]:
    data = common.LOWER[np.frombuffer(text, np.uint8)]
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]), common.ALNUM_LOWER)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts, ends, strict=True)]


def _hashes(text: bytes) -> np.ndarray:
    data = common.LOWER[np.frombuffer(text, np.uint8)]
    starts, ends, _ = common.word_spans(data, np.array([0, len(data)]), common.ALNUM_LOWER)
    return common.span_hashes(data, starts, ends)


def notice_grams(notices: list[tuple[str, str]], k: int = K) -> list[tuple[int, int, int]]:
    """(hash, notice, position) of each k-gram of the notices."""
    out = []
    for number, (_, text) in enumerate(notices):
        hashes = _hashes(text.encode())
        at, grams = common.gram_hashes(hashes, np.zeros(len(hashes), np.int64), k)
        out += [(h, number, int(p)) for p, h in zip(at, grams.view(np.int64).tolist(), strict=True)]
    return out


def candidates(docs: DataFrame, notices: list[tuple[str, str]], k: int = K) -> DataFrame:
    """(k1, k2, notice, first, last) of merged diagonals."""
    spark = docs.sparkSession
    k1, k2 = common.row_key(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                data = common.LOWER[data]
                starts, ends, rows = common.word_spans(data, offsets, common.ALNUM_LOWER)
                at, grams = common.gram_hashes(common.span_hashes(data, starts, ends), rows, k)
                bounds = np.concatenate([[0], np.cumsum(np.bincount(rows[at], minlength=j - i))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(grams.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch["k1"].slice(i, j - i), batch["k2"].slice(i, j - i), lists], names=["k1", "k2", "grams"])

    grams = docs.select(k1.alias("k1"), k2.alias("k2"), "text").mapInArrow(run, "k1 long, k2 long, grams array<long>").select("k1", "k2", F.posexplode("grams").alias("at", "gram"))
    table = spark.createDataFrame(notice_grams(notices, k), "gram long, notice int, place int")
    votes = grams.join(F.broadcast(table), "gram").groupBy("k1", "k2", "notice", (F.col("at") - F.col("place")).alias("diagonal")).agg(F.min("at").alias("first"), (F.max("at") + k - 1).alias("last"))
    along = Window.partitionBy("k1", "k2", "notice").orderBy("diagonal")
    new = (F.col("diagonal") - F.coalesce(F.lag("diagonal").over(along), F.lit(-(1 << 30))) > NEIGHBOURS).cast("int")
    merged = votes.withColumn("new", new).withColumn("run", F.sum("new").over(along)).groupBy("k1", "k2", "notice", "run")
    return merged.agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("run")


def phrase_places(words: list[bytes], phrases: dict[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    """(first word, label) of all places of the phrases."""
    out = []
    for phrase, label in phrases.items():
        rare, at = phrase[-1], -1
        size = len(phrase)
        while True:
            try:
                at = words.index(rare, at + 1)
            except ValueError:
                break
            if at >= size - 1 and tuple(words[at - size + 1 : at + 1]) == phrase:
                out.append((at - size + 1, label))
    return sorted(out)


def best_run(blocks: list, most: float) -> list:
    """The neighbouring blocks with the most words that lie within ``most``
    words of the text; the shortest stretch, then the first, on ties."""
    best, key, size, j = [], (0, 0), 0, 0
    for i, last in enumerate(blocks):
        size += last.size
        while blocks[j].b < last.b + last.size - most:
            size -= blocks[j].size
            j += 1
        new = (size, blocks[j].b - last.b - last.size)
        if j <= i and new > key:
            best, key = blocks[j : i + 1], new
    return best


def verify(words: list[bytes], found: list[tuple[int, int, int]], notices: list[tuple[str, list[bytes]]], coverage: float = COVERAGE) -> list[tuple[str, int, int, float]]:
    """(label, first word, last word, share) of spans that hold enough of a
    notice in order; of spans that overlap, the one with the largest share."""
    spans = []
    for number, first, last in found:
        label, text = notices[number]
        low = max(0, first - len(text))
        high = min(len(words), max(last + 1, first + len(text)) + NEIGHBOURS)
        high = min(high, low + 4 * len(text) + (last - first))
        blocks = [b for b in SequenceMatcher(None, text, words[low:high], autojunk=False).get_matching_blocks() if b.size]
        # stray words before or after the notice would stretch the span
        blocks = best_run(blocks, len(text) / coverage)
        share = sum(b.size for b in blocks) / len(text)
        if share >= coverage:
            spans.append((label, low + blocks[0].b, low + blocks[-1].b + blocks[-1].size - 1, share))
    out: list[tuple[str, int, int, float]] = []
    for span in sorted(set(spans), key=lambda s: (-s[3], s[1] - s[2], s[1], s[0])):
        if all(span[2] < s[1] or span[1] > s[2] or span[0] == s[0] for s in out):
            out.append(span)
    return sorted(out, key=lambda s: (s[1], s[2], s[0]))


def scan(docs: DataFrame, notices: list[tuple[str, str]] = NOTICES, phrases: dict[str, str] = PHRASES) -> DataFrame:
    """doc_id, n_words, bases array of (word, label), spans array of (label,
    first, last, share) of each document."""
    common.small_batches(docs.sparkSession)
    found = common.stored(candidates(docs, notices), "license-candidates")
    grouped = found.groupBy("k1", "k2").agg(F.collect_set(F.struct("notice", "first", "last")).alias("found"))
    if found.count() <= BROADCAST_ROWS:
        grouped = F.broadcast(grouped)
    texts = [(label, _words(text.encode())) for label, text in notices]
    wanted = {tuple(p.encode().split()): label for p, label in phrases.items()}
    base_type = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
    span_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("share", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                data = common.LOWER[data]
                starts, ends, rows = common.word_spans(data, offsets, common.ALNUM_LOWER)
                bounds = np.searchsorted(rows, np.arange(j - i + 1))
                raw, bases, spans = data.tobytes(), [], []
                hits = batch["found"].slice(i, j - i).to_pylist()
                for r in range(j - i):
                    text = raw[offsets[r] : offsets[r + 1]]
                    if hits[r] is None and not any(p[-1] in text for p in wanted):
                        bases.append([])
                        spans.append([])
                        continue
                    a, b = bounds[r], bounds[r + 1]
                    words = [raw[x:y] for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
                    bases.append([{"word": w, "label": label} for w, label in phrase_places(words, wanted)])
                    at = sorted((h["notice"], h["first"], h["last"]) for h in hits[r] or [])
                    spans.append([dict(zip(("label", "first", "last", "share"), s, strict=True)) for s in verify(words, at, texts)])
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(i, j - i), pa.array(np.diff(bounds).astype(np.int64)), pa.array(bases, base_type), pa.array(spans, span_type)], names=["doc_id", "n_words", "bases", "spans"])

    k1, k2 = common.row_key(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", k1.alias("k1"), k2.alias("k2")).join(grouped, ["k1", "k2"], "left").select("doc_id", "text", "found")
    schema = "doc_id long, n_words long, bases array<struct<word:long,label:string>>, spans array<struct<label:string,first:long,last:long,share:double>>"
    return rows.mapInArrow(run, schema)
