"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments.  Of two that differ in at most four bits,
some segment differs in a few at most: in one with three segments, in two with
two.  The Hamming ball around each segment is enumerated and looked up in that
segment's table; a match counts when the complete distance holds.  With two
segments the ball of radius two is met from both sides, by balls of radius one
in the table and in the look-up, so that a fingerprint makes 66 rows on each
side instead of 1,058.  ``layout`` takes what makes fewer rows and candidates
for the number of different fingerprints: three segments up to some millions,
two segments of 32 bits beyond.  Both find every link.

Dense groups are first chained inside exact segment buckets and collapsed, and
the balls then report only links between different collapsed groups: every
link is used, but a group of thousands of close texts never becomes all its
pairs.  Buckets that hold one collapsed group only are left out for its own
members, and large ones are dealt in blocks of bounded size.

Edge cases: null and empty texts have fingerprint zero, which links like any
other; equal fingerprints are one node whatever their number; rows with a null
doc_id keep a row and take the smallest doc_id of their group, if any; extra
columns are ignored, and pass through ``drop_near_duplicates`` whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

SHINGLE = 4
SEED = 42
DISTANCE = 4
#: (shift, bits) of the segments, radius of the table's balls and of the look-up's.
THREE = (((0, 22), (22, 21), (43, 21)), 0, 1)
TWO = (((0, 32), (32, 32)), 1, 1)
#: Members of a bucket that one block holds.
BLOCK = 4096
_BLOCK = 1 << 16


def fingerprint(text: bytes) -> int:
    """Of lower-cased UTF-8 text, as an unsigned number."""
    import xxhash

    words = text.split()  # bytes: at white space of ASCII
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(SHINGLE, len(words))
    a, b = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(a), _BLOCK):
        hashes = np.array([digest(joined[x:y], SEED) for x, y in zip(a[i : i + _BLOCK], b[i : i + _BLOCK], strict=True)], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(a), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2 (the row's key), fp (the fingerprint's 64 bits as a signed long)."""
    common.small_batches(docs.sparkSession)
    k1, k2 = common.row_key(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                raw = common.LOWER[data].tobytes()
                found = np.array([fingerprint(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64)
                yield pa.RecordBatch.from_arrays([*(batch[c].slice(i, j - i) for c in ("doc_id", "k1", "k2")), pa.array(found.view(np.int64))], names=["doc_id", "k1", "k2", "fp"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), "text").mapInArrow(run, "doc_id long, k1 long, k2 long, fp long")


def layout(n: int) -> tuple[tuple[tuple[int, int], ...], int, int]:
    """Segments and radii for ``n`` different fingerprints: rows of the table
    and of the look-up and the candidates expected of even fingerprints."""

    def cost(segments: tuple[tuple[int, int], ...], held: int, asked: int) -> float:
        points = [(1 + bits * held, 1 + bits * asked, bits) for _, bits in segments]
        return sum(t + q + n * t * q / 2**bits for t, q, bits in points)

    return min((THREE, TWO), key=lambda x: cost(*x))


def _ball(segments: tuple[tuple[int, int], ...], radius: int) -> str:
    """SQL that makes a row for each segment and each point of the ball around
    it, a mask to flip."""
    rows = []
    for seg, (shift, bits) in enumerate(segments):
        flips = [0, *(1 << b for b in range(bits))] if radius else [0]
        rows += [f"struct({seg} as seg, {shift} as shift, {(1 << bits) - 1}L as ones, {flip}L as flip)" for flip in flips]
    return f"inline(array({', '.join(rows)}))"


#: A segment's table key: its number above the 32 bits that it has at most.
_KEY = "(shiftleft(cast(seg as bigint), 33) | (shiftrightunsigned({fp}, shift) & ones ^ flip))"


def _keyed(nodes: DataFrame, segments: tuple[tuple[int, int], ...], radius: int, *names: str) -> DataFrame:
    """``names`` of nodes (fp, ...) and key, for each point of their balls."""
    return nodes.selectExpr("*", _ball(segments, radius)).selectExpr(*names, f"{_KEY.format(fp='fp')} as key")


def fingerprint_components(nodes: DataFrame, shape: tuple | None = None) -> DataFrame:
    """(fp, root) for distinct fingerprints ``nodes`` (fp): root is the
    smallest fingerprint reachable by links."""
    near = f"bit_count(fp ^ {{}}) <= {DISTANCE}"
    segments, held, asked = shape or layout(nodes.count())
    bucket = Window.partitionBy("key").orderBy("fp")
    chains = _keyed(nodes, segments, 0, "fp").select("fp", F.lag("fp").over(bucket).alias("a"), F.lag("fp", 2).over(bucket).alias("b"), F.first("fp").over(bucket).alias("c"))
    chains = chains.select("fp", F.explode(F.array("a", "b", "c")).alias("other"))
    chains = chains.where("other is not null and other <> fp and " + near.format("other")).select(F.col("fp").alias("u"), F.col("other").alias("v"))
    first = common.connected_components(chains, "simhash-chains")
    nodes = common.stored(nodes.join(first, nodes["fp"] == first["node"], "left").select("fp", F.coalesce("component", "fp").alias("part")), "simhash-parts")

    table = _keyed(nodes, segments, held, "fp as t_fp", "part as t_part", "fp").select("t_fp", "t_part", "key")
    probes = _keyed(nodes, segments, asked, "fp", "part")
    sizes = table.groupBy("key").agg(F.count("*").alias("n"), F.min("t_part").alias("low"), F.max("t_part").alias("high")).where(F.col("n") > BLOCK)
    large = common.stored(sizes.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"), F.when(F.col("low") == F.col("high"), F.col("low")).alias("only")), "simhash-large")
    on = F.expr("fp < t_fp and part <> t_part and " + near.format("t_fp"))
    if large.limit(1).count():
        deal = lambda rows, block: rows.join(large, "key", "left").withColumn("block", block)
        table = deal(table, F.when(F.col("blocks").isNull(), 0).otherwise(F.expr("pmod(xxhash64(t_fp), blocks)")).cast("int")).drop("blocks", "only")
        probes = deal(probes, F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).when(F.col("part").eqNullSafe(F.col("only")), F.expr("cast(array() as array<int>)")).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))).drop("blocks", "only")
        on = (probes["block"] == table["block"]) & on
    links = probes.join(table.hint("shuffle_hash"), (probes["key"] == table["key"]) & on)
    second = common.connected_components(links.select(F.col("part").alias("u"), F.col("t_part").alias("v")), "simhash-links")
    return nodes.join(second, nodes["part"] == second["node"], "left").select("fp", F.coalesce("component", "part").alias("root"))


def _roots(prints: DataFrame) -> DataFrame:
    """(fp, least, root) of the different fingerprints of ``prints`` (doc_id, fp)."""
    nodes = common.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    return common.settled(lambda: fingerprint_components(nodes.select("fp")).join(nodes, "fp"), "simhash-roots")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id reachable) of each document."""
    prints = common.stored(fingerprints(docs).select("doc_id", "fp"), "simhash-prints")
    roots = _roots(prints)
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    found = roots.join(smallest, "root").select("fp", "component_id")
    return prints.join(found, "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group with the columns it came with: the row with
    the smallest doc_id (rows without one come last), of those with the same
    doc_id the one whose text hashes lowest, of repeated rows one.  Rows that
    share a doc_id but not their text are decided each by its text."""
    a, b, n = common.fresh(docs, "k1", "k2", "n")
    prints = common.stored(fingerprints(docs), "simhash-prints")
    rows = prints.join(_roots(prints).select("fp", "root"), "fp").select("root", F.struct(F.col("doc_id").isNull().alias("last"), "k1", "k2").alias("at"))
    best = common.stored(rows.groupBy("root").agg(F.min("at").alias("at")).select(F.col("at.k1").alias(a), F.col("at.k2").alias(b)), "simhash-best")
    k1, k2 = common.row_key(docs)
    names = [common.quoted(c) for c in docs.columns]
    kept = docs.withColumns({a: k1, b: k2}).join(best, [a, b], "left_semi")
    repeated = prints.groupBy("k1", "k2").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("k1").alias(a), F.col("k2").alias(b))
    repeated = common.stored(repeated, "simhash-repeated")
    if not repeated.limit(1).count():
        return kept.select(*names)
    again = kept.join(repeated, [a, b], "left_semi")
    plain = [common.quoted(f.name) for f in docs.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    order = Window.partitionBy(a, b).orderBy(F.xxhash64(*plain))
    again = again.withColumn(n, F.row_number().over(order)).where(F.col(n) == 1)
    return kept.join(repeated, [a, b], "left_anti").select(*names).unionByName(again.select(*names))
