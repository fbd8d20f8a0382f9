"""Personal data by bootstrapped contextual extraction.

Seed entities are what the fixed patterns find, and long tokens of mixed
letters and digits with the entropy of a key (kind ``secret``).  The words and
marks around a seed are lexical patterns; what stands in the same surroundings
elsewhere is an instance of them.  An occurrence has up to three patterns: the
two words before it, the word before it if marks (``=``, ``:``, a quote) lie
between, and the word before with what follows.  Spark scores the graph of
patterns and instances in rounds: a pattern is as good as its instances, an
instance as good as its best pattern, seeds being certain.  Patterns of high
confidence and enough support then mark identifier-like strings that the fixed
patterns don't know: numbers, addresses, tokens.  A token that looks like a key
counts as personal data only where such a pattern holds it, so that checksums
in running text stay.

Edge cases: null and empty texts have no spans; long runs of digits or marks
cost linear time, address parts of any length are read as numbers; repeated
rows get equal spans; extra columns pass through ``redact`` whatever their
names and are ignored elsewhere; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone", "secret")
SECRET = 4
ROUNDS = 3
#: Confidence and number of different seeds from which a pattern discovers.
CONFIDENCE = 0.75
SUPPORT = 4
#: What an instance keeps of its best pattern's confidence.
DECAY = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: A run of digits, with the rest of an address if it follows: a run that
#: doesn't begin an address holds none that begins later in it.
_IP = re.compile(r"[0-9]+(\.[0-9]+\.[0-9]+\.[0-9]+)?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER_LIKE = re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){5,}")
_AT_LIKE = re.compile(r"[^\s@<>\"]{1,64}(?:@|\(at\)|\[at\])[^\s@<>\"]{2,}")
_DIGIT = re.compile(r"[0-9]")
#: Tokens that may be keys, and the length and bits a character of those that are seeds.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{12,}+")
LONGEST_TOKEN, KEY_LENGTH, KEY_BITS, TOKEN_BITS = 200, 24, 3.0, 2.5
#: Characters around an occurrence that its patterns may take.
AROUND = 80
_PARTS = re.compile(r"[^\W_]+|[^\w\s]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def _byte(digits: str) -> bool:
    plain = digits.lstrip("0")
    return len(plain) <= 3 and int(plain or "0") <= 255


def _entropy(token: str) -> float:
    """Bits a character."""
    n = len(token)
    return -sum(c / n * log2(c / n) for c in Counter(token).values())


def tokens(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, kind) of tokens of letters and digits with the entropy of a
    key: SECRET if they are long enough to be seeds, else -1."""
    for m in _TOKEN.finditer(text):
        token = m[0]
        if len(token) > LONGEST_TOKEN or not _DIGIT.search(token) or not any(c.isalpha() for c in token):
            continue
        bits, mixed = _entropy(token), min(sum(c.isdigit() for c in token), sum(c.isalpha() for c in token)) >= 4
        if bits >= TOKEN_BITS:
            yield m.start(), m.end(), SECRET if len(token) >= KEY_LENGTH and bits >= KEY_BITS and mixed else -1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        end = at + 1
        if start < at and (found := _DOMAIN.match(text, end)):
            yield start, found.end()
            free = end = found.end()
        at = text.find("@", end)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start."""
    out = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if m[1] and all(_byte(p) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def patterns(text: str, start: int, end: int) -> list[str]:
    """The lexical patterns of a place: two words before it, the word before it
    with marks between, the word before it and what follows."""
    before = _PARTS.findall(text[max(0, start - AROUND) : start].lower())
    after = _PARTS.findall(text[end : end + AROUND].lower())[:1]
    words = [i for i, part in enumerate(before) if part.isalnum()]
    out = []
    if len(words) > 1:
        out.append(" ".join(["two", *before[words[-2] :]]))
    if words:
        last = " ".join(before[words[-1] :])
        if words[-1] < len(before) - 1 and any(m in "=:\"'`<>" for m in before[words[-1] + 1 :]):
            out.append(f"key {last}")
        if after:
            out.append(f"around {last} _ {after[0]}")
    return out


def occurrences(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[list[str], str, int, int, int]]:
    """(patterns, instance, kind or -1, start, end) of seeds and of other
    identifier-like strings that touch no seed."""
    found = [(a, b, k) for k, a, b in spans]
    taken = sorted((a, b) for a, b, _ in found)
    if "@" in text or "[at]" in text or "(at)" in text:
        found += [(m.start(), m.end(), -1) for m in _AT_LIKE.finditer(text)]
    if _DIGIT.search(text):
        found += [(m.start(), m.end(), -1) for m in _NUMBER_LIKE.finditer(text)]
        found += [(a, b, k) for a, b, k in tokens(text)]
    out, i, end = [], 0, 0
    for a, b, k in sorted(found, key=lambda f: (f[0], -f[2], -f[1])):
        if k in (-1, SECRET):
            while i < len(taken) and taken[i][1] <= a:
                i += 1
            if (i < len(taken) and taken[i][0] < b) or a < end:
                continue
            end = b
        if around := patterns(text, a, b):
            out.append((around, text[a:b], k, a, b))
    return out


def extract(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, base array of (kind, start, end), found array of
    occurrences of each document."""
    common.small_batches(docs.sparkSession)
    k1, k2 = common.row_key(docs)
    base_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    found_type = pa.list_(pa.struct([("patterns", pa.list_(pa.string())), ("instance", pa.string()), ("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for value in batch["text"]:
                text = value.as_py() or ""
                spans = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans])
                found.append([dict(zip(("patterns", "instance", "kind", "start", "end"), o, strict=True)) for o in occurrences(text, spans)])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["k1"], batch["k2"], pa.array(base, base_type), pa.array(found, found_type)], names=["doc_id", "k1", "k2", "base", "found"])

    schema = "doc_id long, k1 long, k2 long, base array<struct<kind:int,start:long,end:long>>, found array<struct<patterns:array<string>,instance:string,kind:int,start:long,end:long>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"), "text").mapInArrow(run, schema)


def score_patterns(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, kind, confidence, seeds) from occurrences (pattern, instance, kind)."""
    kinds = range(len(KINDS))
    edges = common.stored(found.groupBy("pattern", F.xxhash64("instance").alias("instance")).agg(F.max("kind").alias("seed")), "pii-edges")
    seed = edges.groupBy("instance").agg(*(F.max((F.col("seed") == k).cast("double")).alias(f"s{k}") for k in kinds))
    scores = seed
    for round_ in range(rounds):
        joined = edges.join(scores, "instance")
        patterns = joined.groupBy("pattern").agg(*((F.sum(f"s{k}") / (F.count("*") + 1)).alias(f"c{k}") for k in kinds), *(F.sum((F.col("seed") == k).cast("int")).alias(f"n{k}") for k in kinds))
        patterns = common.stored(patterns, f"pii-patterns-{round_}")
        if round_ + 1 < rounds:
            best = edges.join(patterns, "pattern").groupBy("instance").agg(*(F.max(f"c{k}").alias(f"c{k}") for k in kinds))
            scores = seed.join(best, "instance").select("instance", *(F.greatest(f"s{k}", F.when(F.col(f"c{k}") >= 0.5, DECAY * F.col(f"c{k}")).otherwise(0.0)).alias(f"s{k}") for k in kinds))
            scores = common.stored(scores, f"pii-scores-{round_}")
    rows = F.array(*(F.struct(F.lit(k).alias("kind"), F.col(f"c{k}").alias("confidence"), F.col(f"n{k}").alias("seeds")) for k in kinds))
    return patterns.select("pattern", F.array_max(F.transform(rows, lambda r: F.struct(r["confidence"].alias("confidence"), r["seeds"].alias("seeds"), r["kind"].alias("kind")))).alias("best")).select("pattern", "best.*")


def find_spans(docs: DataFrame) -> DataFrame:
    """doc_id, k1, k2, base and spans: arrays of (kind, start, end) in code
    points, end exclusive, by kind, then start; spans holds base and what the
    patterns discover."""
    rows = common.stored(extract(docs), "pii-rows")
    found = rows.select("k1", "k2", F.explode("found").alias("o")).select("k1", "k2", F.explode("o.patterns").alias("pattern"), "o.instance", "o.kind", "o.start", "o.end")
    good = common.settled(lambda: score_patterns(found), "pii-patterns").where((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= SUPPORT)).select("pattern", "confidence", F.col("kind").alias("known"))
    hits = found.where(f"kind in (-1, {SECRET})").join(good, "pattern").where(f"kind = -1 or known = {SECRET}")
    # a place that patterns of several kinds hold takes the surest, on ties the earlier kind
    hits = hits.groupBy("k1", "k2", "start", "end").agg(F.max(F.struct("confidence", (-F.col("known")).alias("kind"))).alias("best"))
    more = hits.groupBy("k1", "k2").agg(F.collect_set(F.struct((-F.col("best.kind")).alias("kind"), "start", "end")).alias("more"))
    spans = F.array_sort(F.array_union("base", F.coalesce("more", F.expr("array()").cast("array<struct<kind:int,start:long,end:long>>"))))
    return rows.join(more, ["k1", "k2"], "left").select("doc_id", "k1", "k2", F.array_sort("base").alias("base"), spans.alias("spans"))


def replace_spans(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span (overlapping ones as one) as its kind in brackets."""
    out, at = [], 0
    for start, end, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; n_chars, if there, follows."""
    a, b, held = common.fresh(docs, "k1", "k2", "spans")
    found = common.stored(find_spans(docs).where(F.size("spans") > 0).select(F.col("k1").alias(a), F.col("k2").alias(b), F.col("spans").alias(held)).dropDuplicates([a, b]), "pii-spans")
    k1, k2 = common.row_key(docs)
    carried = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns' names
    text = carried[docs.columns.index("text")]
    rows = docs.withColumns({a: k1, b: k2}).join(found, [a, b], "left")
    rows = rows.select(*(common.quoted(name).alias(c) for c, name in zip(carried, docs.columns, strict=True)), F.col(held).alias("held"))
    schema = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(carried, docs.schema, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t.as_py() if not s.is_valid or not t.is_valid else replace_spans(t.as_py(), [(x["kind"], x["start"], x["end"]) for x in s.as_py()])
                for t, s in zip(batch[text], batch["held"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch[text].type) if c == text else batch[c] for c in carried], names=carried)

    out = rows.mapInArrow(run, schema).select(*(F.col(c).alias(name) for c, name in zip(carried, docs.columns, strict=True)))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
