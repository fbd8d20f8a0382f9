"""Codec, packing, quality rules, language and quality models against plain versions."""

import base64
import hashlib
import itertools
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from quillmark.llm import bpe_codec, language_id, packing, quality_classifier, quality_rules, queries

SF = "/root/testdata/sf0.001"


def plain_bpe(ranks, piece):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1))
        if rank == 1 << 40:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_bpe_against_plain_merges(spark, docs):
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    got = {r.doc_id: r for r in queries.op3_byte_bpe(spark, SF).collect()}
    known = {}
    for r in docs.collect():
        pieces = [p.encode() for p in regex.findall(public_tokenizers.PATTERN, r.text or "")]
        known |= {p: plain_bpe(ranks, p) for p in set(pieces) - set(known)}
        ids = [i for p in pieces for i in known[p]]
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


@pytest.mark.parametrize("text", ["a  b" * 9_000, " " * 300_000 + "x", "q" * 50_000 + "\n" * 4_000 + " end", "\t" * 2_500, "é 語　" * 9_000, "don't " * 9_000 + " " * 2_001 + "'s"])
def test_long_texts_are_cut_where_no_match_spans(text):
    matches = [m for stretch, single in bpe_codec.pieces(text) for m in ([stretch] if single else regex.findall(public_tokenizers.PATTERN, stretch))]
    assert matches == regex.findall(public_tokenizers.PATTERN, text)
    encoding = bpe_codec.load_encoding(queries.RANKS, public_tokenizers.PATTERN)
    assert bpe_codec.decode(encoding, bpe_codec.encode(encoding, text)).decode() == text


def test_codec_round_trip_of_odd_rows(odd, empty):
    coded = bpe_codec.encode_documents(odd, queries.RANKS, public_tokenizers.PATTERN)
    back = bpe_codec.decode_documents(coded, queries.RANKS, public_tokenizers.PATTERN)
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in back.collect()) == Counter((r.doc_id, r.text or "") for r in odd.collect())
    assert bpe_codec.encode_documents(empty, queries.RANKS, public_tokenizers.PATTERN).count() == 0


def test_raw_bytes_decode_to_part_of_a_character():
    encoding = bpe_codec.load_encoding(queries.RANKS, public_tokenizers.PATTERN)
    ids = bpe_codec.encode(encoding, "😀")
    assert b"".join(bpe_codec.decode(encoding, [i]) for i in ids) == "😀".encode()


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        assert 0 < r.length <= capacity
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_against_the_tokenizer(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.PIECES)
    tokenizer.encode_special_tokens = True
    rows = queries.op4_best_fit_packing(spark, SF).collect()
    n = check_packing(rows, 4096)
    total = sum(r.length for r in rows)
    assert n <= -(-total // 4096) * 1.01 + 1
    pieces = defaultdict(dict)
    for r in rows:
        pieces[r.doc_id][r.piece] = r
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        parts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        mine = pieces[r.doc_id]
        assert [(mine[k].start, mine[k].length, mine[k].ids_crc32) for k in range(len(mine))] == [(k * 4096, len(p), zlib.crc32(struct.pack(f"<{len(p)}I", *p))) for k, p in enumerate(parts)]


@pytest.mark.parametrize("text", ["It's A.B, c. d,\ne., f", "İstanbul Å̊ K ﬁ ½ ², x.\n", "a b c\x1cd é.", "ǅungla ªº ß ŉ ſt éa, éa. ×. ÷, µ ŉx. ĳ Ω é. éa, ÀÈ. ", "<|endoftext|> we'll, they've. 3.14, 1,000 x."])
def test_remembered_words_equal_whole_texts(text):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.PIECES)
    tokenizer.encode_special_tokens = True
    ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert packing.encode(queries.PIECES, [text.encode()])[0] == struct.pack(f"<{len(ids)}I", *ids)


def test_packing_odd_rows_and_rounds(spark, odd, empty):
    rows = packing.pack_documents(odd, queries.PIECES).collect()
    check_packing(rows, 4096)
    assert sum(r.piece == 0 for r in rows) == odd.count()
    assert packing.pack_documents(empty, queries.PIECES).count() == 0
    pieces = spark.range(3000).selectExpr("id as doc_id", "0 as piece", "0L as start", "1 + (id * 7919) % 997 as length", "id as extra")
    packed = packing.pack_pieces(pieces, 1000, 200)
    rows = packed.collect()
    assert sorted(r.extra for r in rows) == list(range(3000))
    total = sum(r.length for r in rows)
    assert check_packing(rows, 1000) <= 1.05 * total / 1000 + 2  # even lengths in small groups are the hard case


def plain_rules(text):
    text = text or ""
    words = [m for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    tokens = [m[0] for m in words]

    def covered(n):
        counts = Counter(tuple(tokens[i : i + n]) for i in range(len(tokens) - n + 1))
        return {i + k for i in range(len(tokens) - n + 1) if counts[tuple(tokens[i : i + n])] > 1 for k in range(n)}

    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, repeats = set(), []
    for x in lines:
        repeats += [x] if x in seen else []
        seen.add(x)
    out = {"n_words": len(tokens), "word_chars": sum(map(len, tokens)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(repeats), "n_repeat_words": len(covered(3))}
    failed = len(tokens) < 50 or 100 * len(covered(3)) > 50 * len(tokens)
    bad = sum(len(re.sub(r"[\x20\x09-\x0D]", "", x)) for x in repeats) > 0.25 * out["word_chars"] or len(repeats) > 0.4 * len(lines) or out["n_symbols"] > 0.2 * len(tokens)
    for n, share in ((5, 0.30), (7, 0.28), (10, 0.26)):
        bad = bad or sum(len(tokens[i]) for i in covered(n)) > share * out["word_chars"]
    return out | {"base_failed": failed, "kept": not failed and not bad}


def test_quality_rules_against_plain(spark, docs, odd, empty):
    for table in (docs, odd):
        got = Counter(tuple(r[c] for c in ("doc_id", *plain_rules(""))) for r in quality_rules.score_rules(table).collect())
        assert got == Counter((r.doc_id, *plain_rules(r.text).values()) for r in table.collect())
    assert quality_rules.score_rules(empty).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_language_is_right_on_held_out_rows(spark, docs, odd, empty):
    rows = queries.op9_language_id(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.98
    model = language_id.train(docs, F.lit(True))
    found = language_id.predict(odd, model).collect()
    assert len(found) == odd.count() and {r.lang_pred for r in found if r.doc_id in (1, 2, 3, 9, 11)} == {"und"}
    assert {r.score for r in found if r.lang_pred == "und"} == {0.0} and all(0 <= r.score <= 1 for r in found)
    nothing = language_id.train(empty, F.lit(True))
    assert {(r.lang_pred, r.score) for r in language_id.predict(odd, nothing).collect()} == {("und", 0.0)}


def test_language_sample_is_that_of_the_lowest_hashes(spark, docs, monkeypatch):
    few = language_id.train(docs, F.lit(True), sample=5)
    lowest = docs.where("lang is not null").select("doc_id", "lang", "text", F.expr("row_number() over (partition by lang order by xxhash64(doc_id, 2))").alias("n")).where("n <= 5")
    plain = language_id.train(lowest, F.lit(True))
    assert few.languages == plain.languages and (few.log_probability == plain.log_probability).all()
    monkeypatch.setattr(language_id, "OVERSAMPLE", 10**9)
    whole = language_id.train(docs, F.lit(True), sample=5)
    assert (few.log_probability == whole.log_probability).all()


def test_quality_is_right_on_held_out_rows(spark, docs, odd, empty):
    rows = queries.op1_quality_classifier(spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null"), "doc_id").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad)) > 0.9
    labels = spark.createDataFrame([(4, 1), (5, 0), (8, None), (10, 1)], "doc_id long, quality int")
    model = quality_classifier.train(odd, labels, "quality", F.lit(True))
    found = quality_classifier.score(odd, model).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    nothing = quality_classifier.train(odd, labels.limit(0), "quality", F.lit(True))
    assert {r.score for r in quality_classifier.score(odd, nothing).collect()} == {0.5}
    assert quality_classifier.score(empty, model).count() == 0


# --- models against plain versions -----------------------------------------

STEP, BELOW = 0x100000001B3, (1 << 64) - 1


def plain_mix(x):
    x = x + 0x9E3779B97F4A7C15 & BELOW
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & BELOW
    x = (x ^ x >> 27) * 0x94D049BB133111EB & BELOW
    return x ^ x >> 31


def plain_word(word):
    return plain_mix(sum((b + 1) * pow(STEP, i, 1 << 64) for i, b in enumerate(word)) & BELOW ^ len(word))


def plain_grams(words, n):
    out = []
    for i in range(len(words) - n + 1):
        total = 0
        for w in words[i : i + n]:
            total = total * STEP + w & BELOW
        out.append(plain_mix(total ^ n))
    return out


def plain_shape(word):
    kind = lambda b: b"0" if 48 <= b < 58 else b"A" if 65 <= b < 91 else b"a" if 97 <= b < 123 or b > 127 else bytes([b])
    return b"".join(k for k, _ in itertools.groupby(map(kind, word)))


def plain_indicators(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    plain, shape = [plain_word(w.lower()) for w in words], [plain_word(plain_shape(w)) for w in words]
    out = {plain_mix(int(math.log2(len(words) + 1)) + (1 << 40))} | {g for n in (1, 2) for g in plain_grams(plain, n)}
    for n in (1, 2, 3):
        for g, c in Counter(plain_grams(shape, n)).items():
            out.add(plain_mix(g ^ max(math.floor(math.log2(c / len(words))), -8) + 8 << 32))
    for n in (1, 3):
        grams = Counter(plain_grams(plain, n))
        share = int(10 * (1 - sum(c == 1 for c in grams.values()) / grams.total())) if grams else 11
        out.add(plain_mix(share + (n << 48) + 1))
    return sorted({x % quality_classifier.DIMENSIONS for x in out})


def plain_classifier(texts, labels):
    """A function that scores a text: dense naive Bayes ratios, dual coordinate
    descent and a logistic fit of margins from three folds."""
    size, sets = quality_classifier.DIMENSIONS, [plain_indicators(t) for t in texts]
    columns = {c: i for i, c in enumerate(sorted(set().union(*sets)))}
    x = np.zeros((len(sets), len(columns)))
    for row, found in zip(x, sets, strict=True):
        row[[columns[c] for c in found]] = 1
    y = np.array(labels, float)

    def descent(at):
        counts = [x[at][y[at] == c].sum(0) for c in (0, 1)]
        totals = [c.sum() + size for c in counts]
        ratio = np.log((counts[1] + 1) / totals[1]) - np.log((counts[0] + 1) / totals[0])
        unseen = math.log(1 / totals[1]) - math.log(1 / totals[0])
        z = x[at] * ratio
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        sign, w, dual, rng = 2 * y[at] - 1, np.zeros(x.shape[1]), np.zeros(len(at)), np.random.default_rng(7)
        for _ in range(12):
            worst = 0.0
            for i in rng.permutation(len(at)):
                new = min(max(dual[i] - (sign[i] * (w @ z[i]) - 1), 0.0), 1.0)
                w += (new - dual[i]) * sign[i] * z[i]
                worst, dual[i] = max(worst, abs(new - dual[i])), new
            if worst < 1e-3:
                break
        return ratio, unseen, w

    def margin(found, ratio, unseen, w):
        values = [(ratio[columns[c]], w[columns[c]]) if c in columns else (unseen, 0.0) for c in found]
        return sum(r * v for r, v in values) / max(math.sqrt(sum(r * r for r, _ in values)), 1e-12)

    margins = np.zeros(len(sets))
    for k in range(3):
        fold = descent(np.flatnonzero(np.arange(len(sets)) % 3 != k))
        for i in range(k, len(sets), 3):
            margins[i] = margin(sets[i], *fold)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * margins + b)))
        gradient = np.array([margins @ (p - y) + 1e-2 * (a - 1), (p - y).sum() + 1e-3 * b])
        v = p * (1 - p)
        hessian = np.array([[(v * margins**2).sum() + 1e-2, (v * margins).sum()], [(v * margins).sum(), v.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.linalg.solve(hessian, gradient)
    whole = descent(np.arange(len(sets)))
    return lambda text: 1 / (1 + math.exp(-(a * margin(plain_indicators(text), *whole) + b)))


def test_quality_scores_against_a_dense_plain_model(spark):
    short = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) < 900")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality is not null").collect()}
    rows = sorted((r.doc_id, r.text) for r in short.collect() if r.doc_id in labels)[:240]
    frame = spark.createDataFrame([*rows, (10**6, None), (10**6 + 1, "")], "doc_id long, text string")
    model = quality_classifier.train(frame, spark.createDataFrame(list(labels.items()), "doc_id long, quality int"), "quality", F.lit(True))
    score = plain_classifier([t for _, t in rows], [labels[i] for i, _ in rows])
    got = {r.doc_id: r.score for r in quality_classifier.score(frame, model).collect()}
    assert len({labels[i] for i, _ in rows}) == 2
    for i, text in [*rows, (10**6, None), (10**6 + 1, "")]:
        assert abs(got[i] - score(text)) < 1e-3


def plain_folded(text):
    out = []
    for c in text or "":
        low = c.lower() if ord(c) < 0x250 and len(c.lower()) == 1 else c
        low = " " if ord(c) < 0x80 and not c.isalpha() else low
        if low != " " or not out or out[-1] != " ":
            out.append(low)
    return "".join(out)


def plain_buckets(text):
    text = plain_folded(text)
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            key = n
            for c in text[i : i + n]:
                key = key * 1_000_003 + ord(c) & BELOW
            yield plain_mix(key) % language_id.BUCKETS


def test_language_scores_against_dictionaries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 4000").limit(200)
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = defaultdict(Counter)
    for i, text, lang in rows:
        if lang is not None and i % 3:
            counts[lang].update(plain_buckets(text))
    totals = {k: c.total() + 0.5 * language_id.BUCKETS for k, c in counts.items()}
    model = language_id.train(frame, F.col("doc_id") % 3 != 0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(frame, model).collect()}
    for i, text, _ in rows:
        if not regex.search(r"\p{L}", text or ""):
            assert got[i] == ("und", 0.0)
            continue
        logs = {k: sum(math.log((c[b] + 0.5) / totals[k]) for b in plain_buckets(text)) for k, c in counts.items()}
        best = max(sorted(logs), key=logs.get)
        assert got[i][0] == best and abs(got[i][1] - 1 / sum(math.exp(v - logs[best]) for v in logs.values())) < 1e-3


def test_samples_are_bounded_in_bytes_and_take_an_id_once(spark, monkeypatch):
    rows = [(i, f"good words of text {i}" if i % 2 else f"BAD ### {i} !!!") for i in range(40)]
    docs = spark.createDataFrame([*rows, *[(1, "good words of text 1")] * 300], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    whole = quality_classifier.train(docs, labels, "quality", F.lit(True))
    once = quality_classifier.train(docs.distinct(), labels, "quality", F.lit(True))
    assert (whole.weights == once.weights).all()
    monkeypatch.setattr(quality_classifier, "SAMPLE_INDICATORS", 300)
    few = quality_classifier.train(docs, labels, "quality", F.lit(True))
    assert 0 < (few.weights != 0).sum() < (whole.weights != 0).sum()
