"""Best-fit packing of token sequences by sums of squares.

Documents are encoded and cut into pieces; a piece goes where the sum over
gaps of the squared number of open sequences with that gap becomes smallest,
and of equally good places into the fullest.  Groups of a bounded number of
pieces are packed independently, each in falling or shuffled order, whichever
needs fewer sequences; each leaves a few sequences partly filled, and these are
packed again together in fewer groups, until one group holds them all or
little is gained.

Edge cases: null and empty texts are a document of the closing id alone; texts
of any length are cut; repeated rows and null doc_ids are packed like others;
other columns than doc_id and text are left behind by ``pack_documents`` and come
along in ``pack_pieces`` whatever their names; an empty table gives an empty
result.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

CAPACITY = 4096
CLOSING_ID = 1
#: Pieces that one task packs.
GROUP = 50_000
#: Sequences filled to this share stay as they are in later rounds.
FULL = 0.995
#: Times that a group's loosely filled sequences are placed anew.
REPAIRS = 3
#: Words whose ids a worker remembers.
MEMORY = 600_000

_EXOTIC = re.compile("[\u0130\u0250-\U0010ffff]")
#: Bytes of text that are encoded together.
TOGETHER = 1 << 18


class WordIds:
    """Ids of words.  The tokenizer lower-cases, drops white space and never
    joins across it, so the stretches of a text between white space are encoded
    one by one and remembered.  When the memory is full, new ones are encoded
    anew each time; it is emptied when most words of a batch are new."""

    def __init__(self, path: str, memory: int = MEMORY):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.memory, self.known = memory, {}

    def encode(self, texts: list[bytes], closing: int) -> list[bytes]:
        """Ids of texts in UTF-8 and the closing id, as little-endian unsigned
        32-bit integers."""
        lists = [t.lower().split() for t in texts]
        words = list(set().union(*lists))
        here = dict(zip(words, map(self.known.get, words), strict=True))  # small, so that lookups stay in a CPU's cache
        missing = [w for w, ids in here.items() if ids is None]
        if len(self.known) + len(missing) > self.memory and 2 * len(missing) > len(words):
            self.known = {}  # the texts have changed
        learned: dict[bytes, bytes] = {}
        for i in range(0, len(missing), 20_000):
            self._learn(missing[i : i + 20_000], learned)
        here.update(learned)
        if len(self.known) + len(learned) <= self.memory:
            self.known.update(learned)
        last = int(closing).to_bytes(4, "little")
        return [b"".join(map(here.__getitem__, w)) + last for w in lists]

    def _learn(self, words: list[bytes], known: dict[bytes, bytes]) -> None:
        texts = b" ".join(words).decode("utf-8", "replace").split(" ")
        # letters up to U+024F stay letters in lower case: one match and one word
        # end, and a comma or full stop after them is a match of its own
        marked = [t[-1] in ",." and t[:-1].isalpha() for t in texts]
        plain = [m or t.isalpha() for m, t in zip(marked, texts, strict=True)]
        if _EXOTIC.search(" ".join(texts)):
            plain = [p and not _EXOTIC.search(t) for p, t in zip(plain, texts, strict=True)]
        other = list(compress(zip(words, texts, strict=True), [not p for p in plain]))
        if any(plain):
            joined = " ".join(f"{t[:-1]} {t[-1]}" if m else t for m, t in compress(zip(marked, texts, strict=True), plain))
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            stops = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            last = np.cumsum(np.array(list(compress(marked, plain)), np.int64) + 1) - 1
            if len(stops) == last[-1] + 1:
                raw, cuts = ids.tobytes(), [0, *stops[last].tolist()]
                known.update(zip(compress(words, plain), [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))
            else:
                other = list(zip(words, texts, strict=True))
        for (word, _), found in zip(other, self.tokenizer.encode_batch_fast([t for _, t in other], add_special_tokens=False), strict=True):
            known[word] = np.array(found.ids, "<u4").tobytes()


_LOADED: dict[str, WordIds] = {}


def encode(path: str, texts: list[bytes], closing: int = CLOSING_ID) -> list[bytes]:
    """Ids of texts by the tokenizer in a file, which a process loads once."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path].encode(texts, closing)


def encode_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, closing: int = CLOSING_ID) -> DataFrame:
    """doc_id, piece, start, length, ids (binary) of each piece of each document."""
    common.small_batches(docs.sparkSession)
    names = ["doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"], TOGETHER):
                raw, out = data.tobytes(), []
                coded = encode(tokenizer_path, [raw[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)], closing)
                for doc_id, ids in zip(batch["doc_id"].slice(i, j - i).to_pylist(), coded, strict=True):
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((doc_id, k, at // 4, len(part) // 4, part))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, piece int, start long, length long, ids binary")


def place(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The sequence of each item, taken in the order given."""
    open_ = np.zeros(capacity + 1, np.int64)  # sequences by gap; full and new ones don't count
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, n = np.empty(len(lengths), np.int64), 0
    for i, size in enumerate(lengths.tolist()):
        if open_[size]:
            gap = size  # an exact fit always lowers the sum, by the most if many wait
            best = 1 - 2 * open_[size]
        else:
            gap, best = capacity, (2 * open_[capacity - size] + 1 if size < capacity else 0)
        # leaving gap g for gap g - size changes the sum by 2 * (open[g - size] - open[g]) + 2
        change = np.where(open_[size + 1 : capacity] > 0, 2 * (open_[1 : capacity - size] - open_[size + 1 : capacity]) + 2, 1 << 60)
        if len(change):
            at = int(change.argmin())
            if change[at] < best or (gap == capacity and change[at] <= best):
                gap = size + 1 + at
        if gap == capacity:
            bin_, n = n, n + 1
        else:
            bin_ = by_gap[gap].pop()
            open_[gap] -= 1
        where[i] = bin_
        left = gap - size
        if left:
            by_gap[left].append(bin_)
            open_[left] += 1
    return where


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of the pieces of a group: the better of falling and
    shuffled order, after which what lies in loosely filled sequences is placed
    anew as long as that saves some."""
    n = len(lengths)
    rng = np.random.default_rng(n)
    where = None
    for order in (np.argsort(-lengths, kind="stable"), rng.permutation(n)):
        tried = _placed(lengths, order, capacity)
        if where is None or tried.max(initial=-1) < where.max(initial=-1):
            where = tried
    for round_ in range(REPAIRS):
        filled = np.bincount(where, weights=lengths)
        loose = np.flatnonzero(filled < capacity * (1 - 0.0005 * (round_ + 1)))
        items = np.flatnonzero(np.isin(where, loose))
        falling = np.argsort(-lengths[items], kind="stable")
        blurred = np.argsort(-(lengths[items] + rng.integers(0, max(capacity // 8, 1), len(items))), kind="stable")
        tries = [_placed(lengths[items], order, capacity) for order in (falling, rng.permutation(len(items)), blurred)]
        best = min(tries, key=lambda w: w.max(initial=-1))
        if best.max(initial=-1) + 1 < len(loose):
            where[items] = best + where.max() + 1
            where = np.unique(where, return_inverse=True)[1]
    order = np.argsort(where, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    starts = np.flatnonzero(np.diff(where[order], prepend=-1))
    offset = np.empty(n, np.int64)
    offset[order] = before - np.repeat(before[starts], np.diff(np.append(starts, n)))
    return where, offset


def _placed(lengths: np.ndarray, order: np.ndarray, capacity: int) -> np.ndarray:
    where = np.empty(len(lengths), np.int64)
    where[order] = place(lengths[order], capacity)
    return where


def _assign(items: DataFrame, capacity: int, groups: int, level: int) -> DataFrame:
    """uid, length, sequence_id, offset, filled of items (uid, length); filled
    is the length of all that lies in an item's sequence."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        lengths = table["length"].to_numpy()
        where, offset = pack_group(lengths, capacity)
        filled = np.bincount(where, weights=lengths).astype(np.int64)
        # level, group and number within the group in one long
        base = (level << 56) | (table["group"][0].as_py() << 24)
        return pa.table({"uid": table["uid"], "length": table["length"], "sequence_id": pa.array(base + where), "offset": pa.array(offset), "filled": pa.array(filled[where])})

    dealt = items.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)).cast("long"))
    return dealt.groupBy("group").applyInArrow(pack, "uid long, length long, sequence_id long, offset long, filled long")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (length and whatever they carry) with sequence_id and offset.
    Only numbers and lengths go through the packing tasks; the pieces, which
    are numbered once and written, join their places at the end."""
    (uid,) = common.fresh(pieces, "uid")
    whole = common.stored(pieces.withColumn(uid, F.monotonically_increasing_id()), "pack-pieces")
    rest, done = whole.select(F.col(uid).alias("uid"), "length"), None
    n = rest.count()
    for level in range(8):
        groups = max(1, -(-n // group))
        placed = common.stored(_assign(rest, capacity, groups, level), f"pack-{level}")
        full = F.col("filled") >= int(FULL * capacity)
        left = 0 if groups == 1 else placed.where(~full).count()
        if left > 0.7 * n or level == 7:  # little to gain by another round
            left = 0
        settled = (placed.where(full) if left else placed).select("uid", "sequence_id", "offset")
        done = settled if done is None else done.unionByName(settled)
        if not left:
            break
        rest, n = placed.where(~full).select("uid", "length"), left
    return whole.join(done.withColumnRenamed("uid", uid), uid).drop(uid)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, closing: int = CLOSING_ID) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of each piece."""
    return pack_pieces(encode_pieces(docs, tokenizer_path, capacity, closing), capacity)
