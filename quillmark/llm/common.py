"""Helpers shared by the training-data operators: text buffers, rolling
hashes in numpy, shared storage, and distributed connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import shared_folder

#: Bytes of text that are hashed at a time; bounds a Python worker's memory.
CHUNK_BYTES = 1 << 20
#: Rows of text in one Arrow batch.
ARROW_ROWS = 512

U64 = np.uint64
_GOLDEN = U64(0x9E3779B97F4A7C15)
_MIX1 = U64(0xBF58476D1CE4E5B9)
_MIX2 = U64(0x94D049BB133111EB)
_STEP = U64(0x100000001B3)


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in batches of at most ``ARROW_ROWS`` rows.

    A plan reads this setting of the session when it runs, which is after an
    operator has returned, so it can't be put back; it is only ever lowered,
    and all operators here lower it to the same number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Tables written inside open scopes, and where stored tables lie.
_SCOPES: list[list[str]] = []
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here,
    and a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quillmark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PLACES[out] = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more; other tables stay."""
    if path := _PLACES.pop(df, None):
        _delete(df.sparkSession, path)


def settled(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The stored result of ``make``; tables that it stored on the way are
    deleted once the result is written, and only then."""
    _SCOPES.append([])
    try:
        out = stored(make(), name)
    finally:
        made = _SCOPES.pop()
        if _SCOPES:
            _SCOPES[-1].extend(made)
    path = _PLACES[out]
    for old in made:
        if old != path:
            _delete(out.sparkSession, old)
    return out


def row_key(df: DataFrame) -> tuple[Column, Column]:
    """Two columns that identify a document row by value.  Rows that agree in
    both are repeats of one another and get equal decisions."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return (
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
        F.xxhash64(F.col("text").isNull(), text, F.length(text)),
    )


# --- text buffers ---------------------------------------------------------


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, UTF-8 bytes, offsets) of runs of rows
    with at most ``limit`` bytes, or of a single longer row.  Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offset_buffer, data_buffer = column.buffers()
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def byte_table(delimiters: str | bytes | range | list[int]) -> np.ndarray:
    """True for the bytes that belong to words."""
    table = np.ones(256, bool)
    for b in delimiters.encode() if isinstance(delimiters, str) else delimiters:
        table[b] = False
    return table


#: Words of ``[^\x20\x09-\x0D]+``.
NON_SPACE = byte_table([0x20, *range(0x09, 0x0E)])
#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z).
ALNUM_LOWER = byte_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Lower-cases A-Z and leaves other bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and row of all words; none crosses a row."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    word = is_word[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.empty_like(word)
    before[0] = False
    before[1:] = word[:-1]
    after = np.empty_like(word)
    after[-1] = False
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + _GOLDEN
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of byte spans in order, a block at a time."""
    out = np.empty(len(starts), U64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, side="right")))
        s, e = starts[i:j], ends[i:j]
        lengths = e - s
        first = np.cumsum(lengths) - lengths
        within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        powers = np.multiply.accumulate(np.concatenate([[U64(1)], np.full(max(int(lengths.max()) - 1, 0), _STEP, U64)]).astype(U64))
        values = (data[np.repeat(s, lengths) + within].astype(U64) + U64(1)) * powers[within]
        out[i:j] = mix(np.add.reduceat(values, first) ^ lengths.astype(U64))
        i = j
    return out


def gram_hashes(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every window of ``n`` words that
    stays inside a row."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    last = len(hashes) - n + 1
    total = np.zeros(last, U64)
    for k in range(n):
        total = total * _STEP + hashes[k : k + last]
    at = np.flatnonzero(rows[:last] == rows[n - 1 :])
    return at, mix(total[at] ^ U64(n))


def row_counts(rows: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights=weights, minlength=n)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a byte-aligned array over each row."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


# --- connected components -------------------------------------------------


def connected_components(edges: DataFrame, name: str = "components", most_rounds: int = 40) -> DataFrame:
    """(node, component) for each end of the edges (u, v); component is the
    smallest node that can be reached.

    Alternates large-star and small-star steps over edge tables in the shared
    folder until every node has one edge, to a node that has none of its own;
    an edge leads to the smaller node, so that is the smallest.  Steps aggregate
    before they join, so that a hub is one row on one side of a join that AQE
    can split; nothing but a number comes to the driver.  Tables of earlier
    rounds are deleted."""
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    pairs = stored(pairs, f"{name}-0")
    for round_ in range(1, most_rounds + 1):
        if _are_stars(pairs):
            roots = pairs.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        before, pairs = pairs, stored(small, f"{name}-{round_}")
        forget(before)
    raise RuntimeError("connected components did not settle")


def _are_stars(pairs: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u."""
    ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(pairs.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    worst = nodes.agg(F.max(F.col("up") * (F.col("down") + 1))).first()[0]
    return (worst or 0) <= 1
