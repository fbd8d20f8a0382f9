"""Embedding near-duplicates by spherical-cap filters.

A filter is a direction of a random product code: the rotated space is cut
into blocks, each block has a small random code, and a filter takes one code
word of each.  A vector is list-decoded to all filters whose inner product
with it exceeds a threshold, without looking at the others.  Vectors meet in
filters, and pairs are verified by their cosine in double precision.  The
number of filters and the threshold, from the exact distribution of an inner
product in that dimension, follow the number of different vectors, so that a
filter holds a bounded number of unrelated ones.  Codes are added until, of
drawn pairs just at the cosine, at most ``MISS`` meet in no filter; a random
rotation makes this hold for any pair, and closer ones are missed less.

Words and vectors are rounded to integers whose products and sums are exact in
double precision, so that a vector has the same filters wherever it is decoded.
Many codes in which a vector passes one filter on average need about half as
many rows as few codes in which it passes several.

Equal vectors are one class.  A filter with many members is cut into blocks,
and each pair of blocks is a task of bounded size.  A pair is counted only in
the first of the filters that it shares, for which the members that have a
verified pair are decoded again; components take one edge for each member, not
all pairs.

Edge cases: vectors that are null, zero, or hold null or non-finite components,
and rows with a null vec_id, link with nothing; vectors of different lengths
never link; repeated rows count as other vectors; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

COSINE = 0.95
#: Unrelated vectors that a filter is meant to hold.
TARGET_BUCKET = 128
#: Filters that a vector is meant to pass, in each of the independent codes.
TARGET_PASSED = 1
#: Share of pairs just at the cosine that may meet in no filter, at every size.
MISS = 0.005
#: Drawn pairs on which the codes are measured.
SAMPLE = 4000
#: Codes that may be needed, by what the first one misses; beyond, filters are made wider.
MOST_CODES = 48
#: Dimensions that a block has at least.
LEAST_BLOCK = 8
#: Code words of a block from which there is one block more, and where there can't be.
MOST_WORDS, LAST_WORDS = 256, 4096
#: What unit vectors and code words are multiplied with before they are rounded.
SCALE = 1 << 20
#: Members of a filter that one block of a task holds.
BLOCK = 1024
ROWS = 4096
#: Vectors that are decoded together, each against all words of a block.
DECODED = 1024


def threshold(dimension: int, share: float) -> float:
    """The inner product that ``share`` of all unit vectors exceed with a given one."""
    if dimension == 1 or share >= 0.5:
        return 0.0
    angle = np.linspace(0, np.pi / 2, 200_001)
    density = np.sin(angle) ** (dimension - 2)
    within = np.concatenate([[0], np.cumsum(density[1:] + density[:-1])])
    return float(np.cos(np.interp(share, within / (2 * within[-1]), angle)))


def sample_pairs(n: int, dimension: int, cosine: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors at the cosine (in one dimension, equal ones)."""
    rng = np.random.default_rng([20_412, dimension, seed])
    a = _unit(rng.standard_normal((n, dimension)))
    if dimension == 1:
        return a, a
    w = rng.standard_normal((n, dimension))
    return a, cosine * a + np.sqrt(1 - cosine**2) * _unit(w - (w * a).sum(1, keepdims=True) * a)


def apart(a: np.ndarray, b: np.ndarray, number: int, p: dict) -> np.ndarray:
    """The pairs (a[i], b[i]) that share no filter of a code."""
    met = [np.zeros(0, np.int64)]
    for i in range(0, len(a), 500):
        (ra, fa), (rb, fb) = (list_decode(x[i : i + 500], number, p) for x in (a, b))
        shared = np.intersect1d(np.rec.fromarrays([ra, fa]), np.rec.fromarrays([rb, fb]))
        met.append(i + np.unique(shared["f0"]))
    return np.setdiff1d(np.arange(len(a)), np.concatenate(met))


def plan(n: int, dimension: int, cosine: float = COSINE) -> dict:
    """The code for ``n`` different vectors of a dimension."""
    most_blocks = max(1, dimension // LEAST_BLOCK)
    share = max(TARGET_BUCKET / max(n, 32), TARGET_PASSED / LAST_WORDS**most_blocks)
    while True:
        share = min(share, 0.25)
        filters = max(16, ceil(TARGET_PASSED / share))
        blocks = min(2, most_blocks)
        while ceil(filters ** (1 / blocks)) > MOST_WORDS and blocks < most_blocks:
            blocks += 1
        words = ceil(filters ** (1 / blocks))
        p = {"blocks": blocks, "words": words, "codes": 0, "threshold": threshold(dimension, TARGET_PASSED / words**blocks)}
        a, b = sample_pairs(SAMPLE, dimension, cosine)
        while len(a) + 2 * len(a) ** 0.5 > MISS * SAMPLE:  # two standard errors
            left = apart(a, b, p["codes"], p)
            a, b, p["codes"] = a[left], b[left], p["codes"] + 1
            if p["codes"] == 1 and share < 0.25 and len(a) > MISS ** (1 / MOST_CODES) * SAMPLE:
                break
        else:
            return p
        share *= 2


@lru_cache(64)
def code(dimension: int, number: int, blocks: int, words: int) -> list[np.ndarray]:
    """The words of each block, rotated back into the whole space; from a fixed seed."""
    rng = np.random.default_rng([20_411, dimension, number])
    rotation, _ = np.linalg.qr(rng.standard_normal((dimension, dimension)))
    books = []
    for part in np.array_split(np.arange(dimension), blocks):
        book = rng.standard_normal((words, len(part)))
        book = book / np.linalg.norm(book, axis=1, keepdims=True) * np.sqrt(len(part) / dimension)
        books.append(np.rint(SCALE * (rotation[:, part] @ book.T)))
    return books


def list_decode(unit: np.ndarray, number: int, p: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) for all filters that a unit vector exceeds, of ``DECODED``
    vectors at most; a partial choice is extended only while the best of the
    rest can reach the threshold."""
    n, dimension = unit.shape
    books, one = code(dimension, number, p["blocks"], p["words"]), float(SCALE) ** 2
    whole, threshold = np.rint(SCALE * unit), np.rint(p["threshold"] * one)
    scores = [whole @ book for book in books]
    best = np.array([s.max(1) for s in scores])
    rest = np.concatenate([np.cumsum(best[::-1], 0)[::-1][1:], np.zeros((1, n))])
    rows, total, ids = np.arange(n), np.zeros(n), np.full(n, number, np.int64)
    for b, s in enumerate(scores):
        order = np.argsort(-s, axis=1, kind="stable")
        ranked = np.take_along_axis(s, order, 1)
        line = (4 * one * np.arange(n)[:, None] - ranked).ravel()  # ascending over all rows
        need = threshold - total - rest[b][rows]
        counts = np.searchsorted(line, 4 * one * rows - np.clip(need, -1.5 * one, 1.5 * one), side="right") - rows * s.shape[1]
        at = np.repeat(np.arange(len(rows)), counts)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
        chosen = order[rows[at], rank]
        total, ids, rows = total[at] + s[rows[at], chosen], ids[at] * p["words"] + chosen, rows[at]
    return rows, ids


def all_filters(unit: np.ndarray, p: dict) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all codes, by row, then filter; filters of vectors of
    other dimensions are other ones."""
    who, ids = [], []
    for i in range(0, len(unit), DECODED):
        for k in range(p["codes"]):
            rows, found = list_decode(unit[i : i + DECODED], k, p)
            who.append(rows + i)
            ids.append(found)
    if not who:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, which = np.concatenate(who), np.concatenate(ids) * 65_537 + unit.shape[1]
    order = np.lexsort([which, at])
    return at[order], which[order]


def _matrix(raws: list[bytes], kind: str) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By dimension: the rows and their unit vectors in double precision."""
    lengths = np.array([len(r) for r in raws])
    out = {}
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        x = np.frombuffer(b"".join(raws[i] for i in rows), kind).reshape(len(rows), -1).astype(np.float64)
        out[int(size) // np.dtype(kind).itemsize] = rows, _unit(x)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def memberships(classes: DataFrame, plans: dict[int, dict], kind: str, light: bool) -> DataFrame:
    """A row for each class and filter that it exceeds; ``light``: only the
    filter.  ``plans`` has the dimensions of at least two classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, DECODED) for b in batches for i in range(0, b.num_rows, DECODED)):
            raws = batch["raw"].to_pylist()
            for dimension, (rows, unit) in _matrix(raws, kind).items():
                if dimension not in plans:
                    continue
                who, ids = all_filters(unit, plans[dimension])
                if light:
                    yield pa.RecordBatch.from_arrays([pa.array(ids)], names=["filter"])
                    continue
                for a in range(0, len(who), ROWS):
                    take = pa.array(rows[who[a : a + ROWS]])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a : a + ROWS]), *(batch[c].take(take) for c in ("rep", "n", "raw"))], names=["filter", "rep", "n", "raw"])

    return classes.select("rep", "n", "raw").mapInArrow(run, "filter long" if light else "filter long, rep long, n long, raw binary")


def close_members(unit: np.ndarray, side: np.ndarray, cross: bool, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The members that have a verified pair, and which pairs of these are."""
    close = unit @ unit.T >= cosine
    close &= (side[:, None] != side[None, :]) if cross else True
    np.fill_diagonal(close, False)
    members = np.flatnonzero(close.any(1))
    return members, close[np.ix_(members, members)]


def links_and_roots(reps: np.ndarray, counts: np.ndarray, close: np.ndarray, filters: list[np.ndarray], here: int) -> tuple[np.ndarray, np.ndarray]:
    """(links that are counted in this filter, local root) of members and their pairs."""
    below = [x[x < here] for x in filters]
    union = np.unique(np.concatenate(below))
    counted = close
    if len(union):
        marks = np.zeros((len(reps), len(union)), np.float32)
        for i, x in enumerate(below):
            marks[i, np.searchsorted(union, x)] = 1
        counted = close & (marks @ marks.T == 0)
    a, b = np.nonzero(close)
    order = np.argsort(reps, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))  # the smallest rep is the root
    label = place.copy()
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        label = label[order[label]]
        if (label == before).all():
            break
    return counted @ counts, reps[order[label]]


def verified(members: DataFrame, plans: dict[int, dict], kind: str, cosine: float) -> DataFrame:
    """node, links, root from members dealt and sorted by (filter, bi, bj)."""

    def flush(table: pa.Table) -> Iterator[tuple]:
        keys = np.column_stack([table[c].to_numpy() for c in ("filter", "bi", "bj")])
        cuts = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1, [len(keys)]])
        reps, counts, side = (table[c].to_numpy() for c in ("rep", "n", "side"))
        raws, groups = table["raw"].to_pylist(), []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a > 1:
                unit = _unit(np.frombuffer(b"".join(raws[a:b]), kind).reshape(b - a, -1).astype(np.float64))
                who, close = close_members(unit, side[a:b], bool(keys[a, 1] != keys[a, 2]), cosine)
                if len(who):
                    groups.append((a + who, close))
        if not groups:
            return
        # a member's filters are those that it was dealt by: decoding is exact
        different, first = np.unique(reps[np.concatenate([g[0] for g in groups])], return_index=True)
        at, filters = np.concatenate([g[0] for g in groups])[first], {}
        for dimension, (rows, unit) in _matrix([raws[i] for i in at], kind).items():
            who, ids = all_filters(unit, plans[dimension])
            filters |= dict(zip(different[rows].tolist(), np.split(ids, np.searchsorted(who, np.arange(1, len(rows)))), strict=True))
        for who, close in groups:
            links, roots = links_and_roots(reps[who], counts[who], close, [filters[r] for r in reps[who].tolist()], int(keys[who[0], 0]))
            yield reps[who], links, roots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def out(table: pa.Table) -> Iterator[pa.RecordBatch]:
            for node, links, root in flush(table):
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(links, pa.int64()), pa.array(root, pa.int64())], names=["node", "links", "root"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            first, last = (tuple(held[c][i].as_py() for c in ("filter", "bi", "bj")) for i in (0, held.num_rows - 1))
            if first == last:
                continue
            same = np.ones(held.num_rows, bool)
            for c, v in zip(("filter", "bi", "bj"), last, strict=True):
                same &= held[c].to_numpy() == v
            start = int(np.argmax(same))
            yield from out(held.slice(0, start))
            held = held.slice(start)
        if held is not None:
            yield from out(held)

    return members.mapInArrow(run, "node long, links long, root long")


def raw_bytes(ids: pa.Array, lists: pa.ListArray, kind: str) -> pa.Array:
    """The components of each vector as bytes; null where a vector links with nothing."""
    values, offsets = lists.values, lists.offsets.to_numpy().astype(np.int64)
    x = values.fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    of = lambda marks: np.diff(np.concatenate([[0], np.cumsum(marks)])[offsets])
    ok = (of(~np.isfinite(x)) == 0) & (of(x != 0) > 0) & ids.is_valid().to_numpy(False) & lists.is_valid().to_numpy(False)
    width = np.dtype(kind).itemsize
    x = np.where(np.isfinite(x), x, 0).astype(kind) + np.dtype(kind).type(0)  # no negative zeros
    places = (offsets * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ids), [pa.array(ok).buffers()[1], pa.py_buffer(places.tobytes()), pa.py_buffer(x.tobytes())])


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding)."""
    double = "double" in vectors.schema["embedding"].dataType.simpleString()
    kind = "<f8" if double else "<f4"
    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch["vec_id"], raw_bytes(batch["vec_id"], batch["embedding"], kind)], names=["vec_id", "raw"])

    rows = common.stored(vectors.select(vectors["vec_id"].cast("long").alias("vec_id"), "embedding").mapInArrow(raw, "vec_id long, raw binary"), "caps-rows")
    classes = common.stored(rows.where("raw is not null").groupBy("raw").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n")), "caps-classes")
    lengths = classes.groupBy((F.length("raw") / np.dtype(kind).itemsize).cast("int").alias("dimension")).count().where("count > 1").collect()
    plans = {r["dimension"]: plan(r["count"], r["dimension"], cosine) for r in lengths}
    sizes = memberships(classes, plans, kind, light=True).groupBy("filter").count()
    large = common.stored(sizes.where(F.col("count") > BLOCK).select("filter", F.ceil(F.col("count") / BLOCK).cast("int").alias("parts")), "caps-large")
    members = memberships(classes, plans, kind, light=False)
    if large.limit(1).count():
        members = members.join(large, "filter", "left").withColumn("side", F.when(F.col("parts").isNull(), 0).otherwise(F.expr("pmod(xxhash64(rep), parts)")).cast("int"))
        other = F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1)))
        members = members.withColumn("other", other).withColumns({"bi": F.least("side", "other"), "bj": F.greatest("side", "other")}).drop("other", "parts")
    else:
        members = members.withColumns({"side": F.lit(0), "bi": F.lit(0), "bj": F.lit(0)})
    dealt = members.repartition("filter", "bi", "bj").sortWithinPartitions("filter", "bi", "bj")
    found = common.stored(verified(dealt, plans, kind, cosine), "caps-found")
    links = found.groupBy(F.col("node").alias("rep")).agg(F.sum("links").alias("links"))
    parts = common.connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), "caps").select(F.col("node").alias("rep"), "component")
    info = classes.join(links, "rep", "left").join(parts, "rep", "left")
    info = info.select("raw", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(info, "raw", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
