"""Repetition coverage rules.

Rolling hashes of several n-gram lengths, computed with numpy over whole
buffers of text, measure how many characters of a document lie inside n-grams
and lines that the document repeats.

Edge cases: null and empty texts have no words and fail the base rule; very
long texts are a chunk of their own; repeated rows are judged one by one;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SYMBOLS = b"#*$%&|<>"
#: Most characters, as a share of those in words, inside duplicated n-grams.
DUPLICATE_GRAMS = {5: 0.30, 7: 0.28, 10: 0.26}
#: Most characters, as a share of those in words, in lines that repeat earlier ones.
DUPLICATE_LINE_CHARS = 0.25
#: Most lines that repeat earlier ones, as a share of lines with a word.
DUPLICATE_LINES = 0.40
#: Most symbols for each word.
SYMBOLS_PER_WORD = 0.20
LEAST_WORDS = 50

COLUMNS = [
    ("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"),
    ("n_lines", "long"), ("dup_line_chars", "long"), *((f"dup{n}_chars", "long") for n in DUPLICATE_GRAMS), ("base_failed", "boolean"), ("kept", "boolean"),
]

_IS_SYMBOL = ~common.byte_table(SYMBOLS)


def covered_words(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Whether each word lies in a window of ``n`` words found twice or more in its row."""
    covered = np.zeros(len(hashes) + 1, np.int64)
    at, grams = common.gram_hashes(hashes, rows, n)
    if len(at):
        grams = common.mix(grams ^ common.mix(rows[at].astype(common.U64)))
        order = np.argsort(grams, kind="stable")
        ranked = grams[order]
        same = ranked[1:] == ranked[:-1]
        twice = np.zeros(len(at), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = at[order[twice]]
        covered[found] += 1
        covered[found + n] -= 1
    return np.cumsum(covered)[:-1] > 0


def repeated_lines(text: bytes) -> tuple[int, int, int]:
    """Lines with a word, those equal to an earlier line, and the latter's characters outside white space."""
    seen: set[bytes] = set()
    n = repeats = chars = 0
    for line in text.split(b"\n"):
        if words := line.split():
            n += 1
            if line in seen:
                repeats += 1
                chars += len(b"".join(words).decode("utf-8", "replace"))
            else:
                seen.add(line)
    return n, repeats, chars


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    starts, ends, rows = common.word_spans(data, offsets, common.NON_SPACE)
    heads = (data & 0xC0) != 0x80
    head_total = np.concatenate([[0], np.cumsum(heads)])
    chars = head_total[ends] - head_total[starts]
    out = {"n_words": common.row_counts(rows, n), "word_chars": common.row_counts(rows, n, chars).astype(np.int64), "n_symbols": common.row_sums(_IS_SYMBOL[data], offsets)}
    hashes = common.span_hashes(data, starts, ends)
    out["n_repeat_words"] = common.row_counts(rows, n, covered_words(hashes, rows, 3)).astype(np.int64)
    for length in DUPLICATE_GRAMS:
        out[f"dup{length}_chars"] = common.row_counts(rows, n, covered_words(hashes, rows, length) * chars).astype(np.int64)
    raw = data.tobytes()
    lines = np.array([repeated_lines(raw[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64).reshape(n, 3)
    out["n_lines"], out["n_dup_lines"], out["dup_line_chars"] = lines.T
    return out


def judge(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    bad = (m["dup_line_chars"] > DUPLICATE_LINE_CHARS * m["word_chars"]) | (m["n_dup_lines"] > DUPLICATE_LINES * m["n_lines"]) | (m["n_symbols"] > SYMBOLS_PER_WORD * m["n_words"])
    for n, share in DUPLICATE_GRAMS.items():
        bad |= m[f"dup{n}_chars"] > share * m["word_chars"]
    return m | {"base_failed": failed, "kept": ~failed & ~bad}


def score_rules(docs: DataFrame, keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """``keep`` (default doc_id) of every document with its measures and
    verdict, whose names begin with ``prefix``."""
    keep = ["doc_id"] if keep is None else keep
    common.small_batches(docs.sparkSession)
    carried = [f"c{i}" for i in range(len(keep))]  # whatever the columns' names
    schema = ", ".join([f"{c} {docs.schema[name].dataType.simpleString()}" for c, name in zip(carried, keep, strict=True)] + [f"m_{c} {t}" for c, t in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in common.text_chunks(batch["text"]):
                found = judge(measure(data, offsets))
                kept = [batch[c].slice(i, j - i) for c in carried]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(found[c], pa.bool_() if t == "boolean" else pa.int64()) for c, t in COLUMNS)], names=[*carried, *(f"m_{c}" for c, _ in COLUMNS)])

    rows = docs.select(*(common.quoted(name).alias(c) for c, name in zip(carried, keep, strict=True)), docs["text"].alias("text")).mapInArrow(run, schema)
    return rows.select(*(F.col(c).alias(name) for c, name in zip(carried, keep, strict=True)), *(F.col(f"m_{c}").alias(prefix + c) for c, _ in COLUMNS))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents whose verdict is to keep, with the columns they came with."""
    prefix = "__"
    while any(prefix + c in docs.columns for c, _ in COLUMNS):
        prefix += "_"
    return score_rules(docs, docs.columns, prefix).where(f"{prefix}kept").select(*map(common.quoted, docs.columns))
