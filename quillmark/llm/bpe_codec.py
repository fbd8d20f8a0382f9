"""Byte-level BPE encoding and decoding with the tiktoken library.

The rank file is local.  Long texts are cut at places that no match of the
split pattern can span, so that the library's regex engine never sees more
than a bounded stretch; ids are those of the uncut text.

Edge cases: null and empty texts give no ids and no bytes; white space runs of
any length, letters without a break, repeated rows and extra columns are
handled row by row; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common

#: Characters after which a cut is looked for.
CUT_CHARS = 20_000
#: White space runs from this length are taken as a piece without the regex.
LONG_RUN = 2_000

_LOADED: dict[tuple[str, str], object] = {}


def load_encoding(rank_path: str, pattern: str):
    """The encoding of a rank file; loaded once in a process."""
    key = (rank_path, pattern)
    if key not in _LOADED:
        import tiktoken

        with open(rank_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
        _LOADED[key] = tiktoken.Encoding("local_ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[key]


#: A place before white space that follows something else: matches hold white
#: space only at their start, and look ahead no further than one character.
_CUT = regex.compile(r"(?<=\S)(?=\s)")
_RUN = regex.compile(r"\s{%d,}+" % LONG_RUN)


def pieces(text: str) -> Iterator[tuple[str, bool]]:
    """(stretch, whether it is one match of the pattern) in order; the matches
    inside the stretches are the matches of the whole text."""
    at = 0
    for run in _RUN.finditer(text):
        # the run is one match up to its last character, which goes with what follows
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from _cut(text, at, run.start())
        yield text[run.start() : end], True
        at = end
    yield from _cut(text, at, len(text))


def _cut(text: str, at: int, end: int) -> Iterator[tuple[str, bool]]:
    while end - at > CUT_CHARS:
        found = _CUT.search(text, at + CUT_CHARS, end)
        if not found:
            break
        yield text[at : found.start()], False
        at = found.start()
    if at < end:
        yield text[at:end], False


def encode(encoding, text: str) -> list[int]:
    if len(text) <= LONG_RUN:
        return encoding.encode_ordinary(text)
    ids: list[int] = []
    for stretch, single in pieces(text):
        ids += encoding._encode_single_piece(stretch) if single else encoding.encode_ordinary(stretch)
    return ids


def decode(encoding, ids: list[int]) -> bytes:
    """Raw bytes: ids need not join to valid UTF-8."""
    return encoding.decode_bytes(ids)


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, ids: bool = True, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens; ``ids``: the ids as little-endian unsigned 32-bit
    integers; ``digests``: SHA-256 of those and of the decoded bytes."""
    common.small_batches(docs.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    schema = "doc_id long, n_tokens long"
    if ids:
        fields.append(("ids", pa.binary()))
        schema += ", ids binary"
    if digests:
        fields += [("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        schema += ", ids_sha256 string, decoded_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_path, pattern)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                found = encode(encoding, text.as_py() or "")
                raw = np.asarray(found, "<u4").tobytes()
                row = [doc_id, len(found)]
                if ids:
                    row.append(raw)
                if digests:
                    row += [hashlib.sha256(raw).hexdigest(), hashlib.sha256(decode(encoding, found)).hexdigest()]
                rows.append(tuple(row))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """doc_id, decoded (raw bytes) of rows with ``ids`` as written above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(rank_path, pattern)
        for batch in batches:
            out = [decode(encoding, np.frombuffer(raw or b"", "<u4").tolist()) for raw in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")
