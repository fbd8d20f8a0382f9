"""Licence scan, personal data, near-duplicates and line dedup against plain versions."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quillmark.llm import cap_filters, common, license_scan, line_dedup, pii, queries, simhash

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def test_license_base_against_plain(spark, docs):
    got = {r.doc_id: r for r in queries.op5_license_scan(spark, SF).collect()}
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    some = 0
    for r in docs.collect():
        words = WORD.findall(lower(r.text))
        at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        mine, labels = got[r.doc_id], sorted({label for _, label in at})
        assert (mine.n_words, mine.n_base, mine.first_word, mine.last_word) == (len(words), len(at), min(at)[0] if at else None, max(at)[0] if at else None)
        assert mine.base_labels == ",".join(labels) and set(labels) <= set(mine.labels.split(",")) | {""} and 0 <= mine.score <= 1
        some += bool(at)
    assert some


def test_license_notices_are_found_with_changed_words(spark, odd, empty):
    text = dict((label, t) for label, t in license_scan.NOTICES)
    filler = "some words stand here before and after the notice "
    rows = [(1, filler + text["gpl-3"] + " " + filler), (2, filler + text["bsd"].replace("source and binary", "any") + filler), (3, filler * 4), (4, "the gnu general public license"), (5, filler + text["isc"] * 2)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: {s["label"] for s in r.spans} for r in license_scan.scan(frame).collect()}
    assert found == {1: {"gpl-3"}, 2: {"bsd"}, 3: set(), 4: set(), 5: {"isc"}}
    assert license_scan.scan(odd).count() == odd.count() and license_scan.scan(empty).count() == 0


@pytest.mark.parametrize("before", ["This file is part of FooBar. It was written in order to show how a small parser of tables can be made with few lines.", "Some other words."])
def test_license_notices_are_found_after_stray_words(before):
    notices = [(label, license_scan._words(t.encode())) for label, t in license_scan.NOTICES]
    number = max(i for i, (label, _) in enumerate(notices) if label == "gpl-3")
    text = license_scan.NOTICES[number][1]
    changed = re.sub("(?i)this program", "FooBar", text, count=1)
    assert changed != text
    words = license_scan._words(f"{before} {changed} And more words of this file.".encode())
    start, size = len(license_scan._words(before.encode())), len(license_scan._words(changed.encode()))
    found = license_scan.verify(words, [(number, start + 4, start + size - 1)], notices)
    assert [s[0] for s in found] == ["gpl-3"] and found[0][3] >= 0.9 and found[0][2] - found[0][1] < len(notices[number][1]) / 0.8


def plain_share(words, text):
    """The largest share of a notice's words that stand in order within a
    stretch of words no longer than the notice may be."""
    size, need = int(len(text) / license_scan.COVERAGE), Counter(text)
    best = 0.0
    for i in range(max(1, len(words) - size + 1)):
        part = words[i : i + size]
        if (need & Counter(part)).total() >= license_scan.COVERAGE * len(text):
            best = max(best, sum(b.size for b in SequenceMatcher(None, text, part, autojunk=False).get_matching_blocks()) / len(text))
    return best


def test_license_spans_against_all_windows(spark):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "this", "software", "license", "to"]
    prose = lambda n: [str(w) for w in rng.choice(vocabulary, n)]
    notices = [(label, WORD.findall(lower(t))) for label, t in license_scan.NOTICES]
    rows = []
    for i in range(48):
        words = list(notices[i % len(notices)][1])
        rate = (0.0, 0.04, 0.08, 0.3)[i // len(notices) % 4]
        for at in np.flatnonzero(rng.random(len(words)) < rate):
            words[at] = f"changed{at}"
        rows.append((i, " ".join([*prose(20), *words, *prose(15)])))
    rows.append((100, " ".join(prose(200))))
    found = {r.doc_id: {s["label"] for s in r.spans} for r in license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sure = 0
    for i, text in rows:
        shares = defaultdict(float)
        for label, notice in notices:
            shares[label] = max(shares[label], plain_share(WORD.findall(text), notice))
        must = {label for label, x in shares.items() if x >= 0.84}
        may = {label for label, x in shares.items() if x >= license_scan.COVERAGE - 0.01}
        overlapping = len(may) > 1  # the notice with the largest share stands for those that overlap
        assert found[i] <= may and (bool(found[i] & must) if overlapping and must else must <= found[i])
        sure += bool(must)
    assert sure >= 24 and found[100] == set()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def ok(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == "ip":
            return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits)))
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    return [(k, m.start(), m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if ok(kind, m[0])]


def test_personal_data_base_against_plain(spark, docs):
    got = {r.doc_id: r for r in queries.op6_pii(spark, SF).collect()}
    for r in docs.collect():
        spans = plain_spans(r.text)
        text = ",".join(f"{list(PATTERNS)[k]}:{a}:{b}" for k, a, b in spans)
        mine = got[r.doc_id]
        assert mine.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [sum(s[0] == k for s in spans) for k in range(4)]
        assert set(filter(None, text.split(","))) <= set(mine.spans.split(","))


@pytest.mark.parametrize("seed", range(40))
def test_personal_data_patterns_on_random_marks(seed):
    rng = np.random.default_rng(seed)
    for _ in range(60):
        text = "".join(rng.choice(list("ab1234567890..@@+-_ ()é"), 60))
        assert pii.base_spans(text) == plain_spans(text)


def test_address_parts_of_any_length(odd):
    got = {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.base] for r in pii.find_spans(odd).collect() if r.doc_id is not None}
    assert got[12] == [(1, 0, 5_007)] and got[13] == []


def plain_tokens(text):
    for m in re.finditer(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{12,}", text):
        digits, letters = (sum(getattr(c, f)() for c in m[0]) for f in ("isdigit", "isalpha"))
        bits = sum(-c / len(m[0]) * math.log2(c / len(m[0])) for c in Counter(m[0]).values())
        if len(m[0]) <= 200 and digits and letters and bits >= 2.5:
            yield m.start(), m.end(), 4 if len(m[0]) >= 24 and bits >= 3 and min(digits, letters) >= 4 else -1


def plain_surroundings(text, a, b):
    part = r"[^\W_]+|[^\w\s]"
    before, after = re.findall(part, text[max(0, a - 80) : a].lower()), re.findall(part, text[b : b + 80].lower())
    words = [i for i, x in enumerate(before) if x.isalnum()]
    if len(words) > 1:
        yield " ".join(("two", *before[words[-2] :]))
    if words and set(before[words[-1] + 1 :]) & set("=:\"'`<>"):
        yield " ".join(("key", *before[words[-1] :]))
    if words and after:
        yield " ".join(("around", *before[words[-1] :], "_", after[0]))


def plain_discovery(rows, rounds=3):
    """Base spans and what the pattern graph adds, for rows (id, text) with different ids."""
    places, seeds_of = [], defaultdict(lambda: defaultdict(lambda: -1))
    for i, text in rows:
        text = text or ""
        base = plain_spans(text)
        covered = lambda a, b, base=base: any(a < e and s < b for _, s, e in base)
        loose = [(m.start(), m.end(), -1) for m in re.finditer(r"[^\s@<>\"]{1,64}(?:@|\(at\)|\[at\])[^\s@<>\"]{2,}", text)]
        loose += [(m.start(), m.end(), -1) for m in re.finditer(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){5,}", text)] + list(plain_tokens(text))
        end, found = 0, [(s, e, k) for k, s, e in base]
        for a, b, k in sorted(loose, key=lambda f: (f[0], -f[2], -f[1])):
            if not covered(a, b) and a >= end:
                found.append((a, b, k))
                end = b
        for a, b, k in found:
            for p in plain_surroundings(text, a, b):
                places.append((i, a, b, k, p))
                seeds_of[p][text[a:b]] = max(seeds_of[p][text[a:b]], k)
    instances = defaultdict(list)
    for p, members in seeds_of.items():
        for x in members:
            instances[x].append(p)
    certain = {x: [float(any(seeds_of[p][x] == k for p in ps)) for k in range(5)] for x, ps in instances.items()}
    score = certain
    for _ in range(rounds):
        sure = {p: [sum(score[x][k] for x in members) / (len(members) + 1) for k in range(5)] for p, members in seeds_of.items()}
        score = {x: [max(certain[x][k], *(0.9 * sure[p][k] if sure[p][k] >= 0.5 else 0.0 for p in ps)) for k in range(5)] for x, ps in instances.items()}
    out = {i: set(plain_spans(text)) for i, text in rows}
    best = defaultdict(list)
    for i, a, b, k, p in places:
        confidence, seeds, kind = max((sure[p][c], sum(v == c for v in seeds_of[p].values()), c) for c in range(5))
        if confidence >= 0.75 and seeds >= 4 and (k == -1 or k == kind == 4):
            best[i, a, b].append((confidence, -kind))
    for (i, a, b), found in best.items():
        out[i].add((-max(found)[1], a, b))
    return {i: sorted(spans) for i, spans in out.items()}


def spans_of(frame):
    return {r.doc_id: [(s["kind"], s["start"], s["end"]) for s in r.spans] for r in pii.find_spans(frame).collect()}


def test_patterns_discover_unseen_identifiers(spark, odd, empty):
    rows = [(i, f"please ring us at +1 (555) 010-{1000 + i} today") for i in range(12)]
    rows += [(50, "you may ring us at 555 010 7788 today"), (51, "the year 1999 and 2024 555 010 7788"), (52, None)]
    rows += [(60 + i, f'mark {i} token = "{hashlib.sha1(bytes([i])).hexdigest()}" here') for i in range(6)]
    rows += [(70, 'token = "abc123def456ghi" of a user'), (71, f"commit {hashlib.sha1(b'x').hexdigest()} of the code"), (72, "the file build-2024-version12 is old")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = spans_of(frame)
    assert found == plain_discovery(rows)
    assert found[50] == [(3, 19, 31)] and found[51] == [] and found[52] == []
    assert found[60] == [(4, 16, 56)] and found[70] == [(4, 9, 24)] and found[71] == [] and found[72] == []
    texts = {r.doc_id: r.text for r in pii.redact(frame).collect()}
    assert texts[50] == "you may ring us at <PHONE> today" and texts[3] == "please ring us at <PHONE> today" and texts[52] is None
    assert texts[60] == 'mark 0 token = "<SECRET>" here'
    assert pii.redact(odd).columns == odd.columns and pii.redact(odd).count() == odd.count() and pii.redact(empty).count() == 0


def test_discovery_on_the_tables_against_plain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = spans_of(docs)
    assert found == plain_discovery(rows)
    keys = {i: [(4, *m.span(1)) for m in re.finditer(r'token = "([0-9a-f]{40})"', text or "")] for i, text in rows}
    assert sum(map(len, keys.values())) > 5 and all(set(spans) <= set(found[i]) for i, spans in keys.items())


def components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_simhash(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    kinds = sorted({p for _, p in prints})
    part = components(kinds, [(a, b) for a in kinds for b in kinds if a < b and (a ^ b).bit_count() <= 4])
    least = {}
    for i, p in prints:
        if i is not None:
            least[part[p]] = min(i, least.get(part[p], i))
    return Counter((i, f"{p:016x}", least.get(part[p])) for i, p in prints)


def test_simhash_against_all_pairs(spark, docs, odd, empty):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in queries.op10_simhash(spark, SF).collect())
    assert got == plain_simhash([(r.doc_id, r.text) for r in docs.collect()])
    got = Counter((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in simhash.near_duplicates(odd).collect())
    assert got == plain_simhash([(r.doc_id, r.text) for r in odd.collect()])
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for (_, _, c) in plain_simhash([(r.doc_id, r.text) for r in odd.collect()])} - {None})


@pytest.mark.parametrize(("seed", "shape", "block"), [(0, simhash.THREE, 4096), (1, simhash.TWO, 4096), (2, simhash.THREE, 3), (3, simhash.TWO, 3)])
def test_fingerprints_at_the_distance(spark, monkeypatch, seed, shape, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(seed)
    prints = [int(x) for x in rng.integers(0, 2**63, 60)]
    for p in prints[:40]:
        for d in (3, 4, 5, 4):
            flip = sum(1 << int(b) for b in rng.choice(64, d, replace=False))
            prints.append(p ^ flip)
    # many that share whole segments, close to one another and not
    hot = int(rng.integers(0, 2**63))
    prints += [hot ^ (int(x) << 22) for x in rng.integers(0, 2**41, 60)] + [hot ^ (1 << i) ^ (1 << j) for i in range(40, 50) for j in range(i)]
    kinds = sorted({p % 2**64 for p in prints})
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    want = components(kinds, [(a, b) for a in kinds for b in kinds if a < b and (a ^ b).bit_count() <= 4])
    rows = simhash.fingerprint_components(spark.createDataFrame([(signed(k),) for k in kinds], "fp long"), shape).collect()
    group = {r.fp % 2**64: r.root for r in rows}
    assert len(group) == len(kinds)
    by = defaultdict(set)
    for k in kinds:
        by[group[k]].add(want[k])
    assert all(len(v) == 1 for v in by.values()) and len(by) == len(set(want.values()))


def test_layout_follows_the_number_of_fingerprints():
    assert simhash.layout(0) == simhash.layout(100_000) == simhash.THREE and simhash.layout(10**9) == simhash.TWO


def test_near_duplicates_are_dropped_by_row(spark):
    text, other = "one two three four five six seven eight nine ten", "an old map of the town by the river shows every bridge"
    rows = [(1, text, "a"), (1, other, "b"), (2, other, "c"), (None, text, "d"), (None, "words of nobody that stand alone here", "e"), (3, "ties of a row", "f"), (3, "ties of a row", "f")]
    out = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, mark string"))
    assert sorted(r.mark for r in out.collect()) == ["a", "b", "e", "f"]


def plain_vectors(rows, cosine=0.95):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)]
    linked, count = [], Counter()
    for x in range(len(good)):
        for y in range(x):
            (i, a), (j, b) = good[x], good[y]
            if len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                linked.append((i, j))
                count[x] += 1
                count[y] += 1
    part = components(sorted({i for i, _ in rows if i is not None}), linked)
    at = iter(range(len(good)))
    ids = {id(v): next(at) for _, v in good}
    del ids
    out, k = Counter(), 0
    for i, v in rows:
        ok = i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)
        out[i, count[k] if ok else 0, part.get(i)] += 1
        k += bool(ok)
    return out


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(64) for _ in range(n)]
    for k in range(n // 4):
        rows.append(rows[k] + rng.standard_normal(64) * rng.choice([0.0, 0.1, 0.25, 0.3, 0.33]))
    hot = rng.standard_normal(64)
    rows += [hot + rng.standard_normal(64) * 0.1 for _ in range(60)] + [hot] * 20
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("block", [1024, 16])
def test_cap_filters_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(cap_filters, "BLOCK", block)
    rows = vectors(block, 500)
    rows += [(9001, None), (9002, []), (9003, [0.0] * 64), (9004, [float("nan")] * 64), (9005, [1.0] * 32), (9006, [2.0] * 32), (None, [1.0] * 64), (9007, [None, 1.0])]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, raw string, n int")
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in cap_filters.near_duplicates(frame).collect())
    want = plain_vectors(rows)
    missing = sum((want - got).values())
    assert missing <= 0.01 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in cap_filters.near_duplicates(frame).where("vec_id is not null").collect())
    assert cap_filters.near_duplicates(frame.limit(0)).count() == 0


def test_cap_filters_find_pairs_among_20_000(spark):
    rng = np.random.default_rng(7)
    a, b = cap_filters.sample_pairs(1000, 64, 0.952, seed=5)
    x = np.concatenate([a, b, rng.standard_normal((18_000, 64))])
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in cap_filters.near_duplicates(frame).where("vec_id < 2000").collect()}
    assert sum(got[i] == got[i + 1000] == (1, i) for i in range(1000)) >= 990


@pytest.mark.parametrize(("n", "dimension"), [(500, 64), (50_000, 64), (100_000, 64), (1_000_000, 64), (100_000_000, 64), (1_000_000, 3), (1_000_000, 8), (1_000_000, 16), (100_000_000, 16), (100_000, 384), (1_000_000, 384)])
def test_cap_filters_recall_at_planned_sizes(n, dimension):
    p = cap_filters.plan(n, dimension)
    a, b = cap_filters.sample_pairs(2000, dimension, 0.95, seed=1)
    for k in range(p["codes"]):
        left = cap_filters.apart(a, b, k, p)
        a, b = a[left], b[left]
    assert len(a) <= 0.01 * 2000


@pytest.mark.parametrize(("n", "dimension"), [(20_000, 16), (3_000, 8), (1_000, 384)])
def test_cap_filters_in_other_dimensions(spark, n, dimension):
    rng = np.random.default_rng(dimension)
    a, b = cap_filters.sample_pairs(n // 10, dimension, 0.951, seed=3)
    x = np.concatenate([a, b, rng.standard_normal((n - 2 * (n // 10), dimension))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = sum(int((unit[i : i + 1000] @ unit.T >= 0.95).sum()) for i in range(0, n, 1000)) - n
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    found = sum(r.n_links for r in cap_filters.near_duplicates(frame).collect())
    assert links >= n // 10 and 0.99 * links <= found <= links + 2


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200, 260)] + [(500, i) for i in range(501, 700)] + [(7, 7), (3, 9), (9, 3)]
    got = {r.node: r.component for r in common.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = components(sorted({n for e in edges for n in e}), edges)
    assert got == {n: c for n, c in want.items() if n != 7}


def spark_hashes(line):
    """The two hashes that break ties among lines."""
    one = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    found = (xxhash.xxh64_intdigest(line.encode(), seed) for seed in (42, one))
    return tuple(h - 2**64 if h >= 2**63 else h for h in found)


def plain_templates(docs_of, min_docs=2):
    """{line: template} of lines (tuples of tokens, with the documents that
    hold them) that have one, and the leaves of the tree."""
    leaf, shape = defaultdict(set), {}
    for t in docs_of:
        leaf[len(t), t[:4]].add(t)
    for key, lines in leaf.items():
        support = Counter((p, x) for t in lines for p, x in enumerate(t))
        for t in lines:
            made = t if len(lines) == 1 else tuple(x if support[p, x] >= max(2, 0.05 * len(lines)) else "<*>" for p, x in enumerate(t))
            kept = sum(x != "<*>" for x in made)
            if len(lines) == 1 or (kept >= 2 and kept >= 0.7 * sum(x != "<*>" for x in t)):
                shape[t] = (key, made)
    return shape, leaf


def plain_near(docs_of, leaf, min_docs=2):
    """{line: first document of its group} of lines that fall to a heavier one."""
    fall = {}
    weight = {t: (len(d), *spark_hashes(" ".join(t))) for t, d in docs_of.items()}
    for lines in (x for x in leaf.values() if len(x) > 1):
        places = defaultdict(set)
        for t in lines:
            for q in range(4):
                if part := tuple((p, x) for p, x in enumerate(t) if 4 * p // len(t) == q):
                    places[q, part].add(t)
        for t in lines:
            options = [max(same, key=weight.get) for (q, part), same in places.items() if t in same and len(same) > 1]
            good = []
            for to in set(options) - {t}:
                kept = sum(x == y != "<*>" for x, y in zip(t, to, strict=True))
                if kept >= 2 and kept >= 0.7 * sum(x != "<*>" for x in t):
                    good.append(to)
            if good:
                fall[t] = max(good, key=weight.get)
    groups = defaultdict(set)
    for t, to in fall.items():
        groups[to] |= {t, to}
    out = defaultdict(list)
    for members in groups.values():
        if sum(len(docs_of[t]) for t in members) >= min_docs:
            for t in members:
                out[t].append(min(d for x in members for d in docs_of[x]))
    return {t: min(d) for t, d in out.items()}


def plain_line_dedup(rows, min_docs=2, near=False, short=False):
    """rows: (doc_id, text) with different doc_ids."""

    def read(line):
        """A line's tokens, masked if it has a template, else as they stand."""
        raw = tuple(x for x in re.split(r"[\x20\x09-\x0D]+", line) if x)
        t = tuple("<*>" if re.search("[0-9]", x) else x for x in raw)
        return (t, True) if len(t) >= 3 and sum(x != "<*>" for x in t) >= 2 else (raw, False)

    docs_of, few = defaultdict(set), defaultdict(set)
    for i, text in rows:
        for t, long in map(read, (text or "").split("\n")):
            (docs_of if long else few)[t].add(i)
    shape, leaf = plain_templates(docs_of, min_docs)
    templates, first = defaultdict(list), {}
    for t, template in shape.items():
        templates[template].append(t)
    for lines in templates.values():
        if sum(len(docs_of[t]) for t in lines) >= min_docs:
            for t in lines:
                first[t] = min(d for x in lines for d in docs_of[x])
    more = [{t: min(d) for t, d in docs_of.items() if len(d) >= min_docs}, plain_near(docs_of, leaf, min_docs) if near else {}]
    for t, d in (item for found in more for item in found.items()):
        first[t] = min(d, first.get(t, d))
    again = {t: min(d) for t, d in few.items() if t and len(d) >= min_docs} if short else {}
    out = {}
    for i, text in rows:
        if text is None:
            out[i] = (None, 0)
            continue
        seen, kept, n = set(), [], 0
        for line in text.split("\n"):
            t, long = read(line)
            known = first if long else again
            if t in known and (known[t] != i or (t, long) in seen):
                n += 1
            else:
                kept.append(line)
            seen.add((t, long))
        out[i] = ("\n".join(kept), n)
    return out


@pytest.mark.parametrize("more", [False, True])
def test_line_dedup_against_plain(spark, docs, odd, empty, more):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows += [(90_001, "user 17 logged in from host alpha\nclean line of its own"), (90_002, "user 18 logged in from host beta\nuser 3 logged in from host gamma"), (90_003, "user 99 logged in from host alpha\n\n"), (90_004, None), (90_005, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.dedup_lines(frame, near=more, short=more).collect()}
    want = plain_line_dedup(rows, near=more, short=more)
    assert got == want and sum(n for _, n in want.values()) > 0
    out = line_dedup.dedup_lines(odd, near=more, short=more)
    assert out.columns == [*odd.columns, "n_lines_", "n_dropped_"] and out.count() == odd.count()
    assert Counter((r.doc_id, r.n_lines, r["__drop"], r["a.b"]) for r in out.collect()) == Counter((r.doc_id, r.n_lines, r["__drop"], r["a.b"]) for r in odd.collect())
    assert line_dedup.dedup_lines(empty, near=more, short=more).count() == 0


def test_templates_do_not_depend_on_copies(spark, docs):
    """More copies of a corpus under new ids have the same templates."""
    lines = [f"host {h} of site {t} was seen at the gate by {w}" for h in ("alpha", "beta", "gamma") for t in ("one", "two") for w in ("ann", "bob", "eve", "ian", "joe")]
    few = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    many = few.withColumn("doc_id", F.explode(F.array(*(F.col("doc_id") + 1_000_000 * k for k in range(7)))))
    groups = []
    for table in (few, many):
        hashes = line_dedup.line_hashes(table).where("tokens >= 3 and constants >= 2")
        shapes = line_dedup.templates(table, hashes)[1].select("h1", "h2", "leaf", "template").collect()
        by = defaultdict(set)
        for r in shapes:
            by[r.leaf, r.template].add((r.h1, r.h2))
        groups.append(sorted(map(sorted, by.values())))
    assert groups[0] == groups[1] and max(map(len, groups[0])) > 1


def test_line_dedup_generalises_at_any_size(spark):
    names, towns = ([f"{x}{chr(97 + i // 10)}{chr(97 + i % 10)}" for i in range(50)] for x in ("name", "town"))
    rows = [(i, f"the guest at the desk is {names[i // 50]} who came from {towns[i % 50]} today") for i in range(2500)]
    line = "a footer that many pages of the same site carry at their very end"
    rows += [(3000 + i, f"own words number{chr(97 + i)} here\n{line}") for i in range(9)]
    rows += [(4000, line.replace("site", "house")), (4001, line.replace("pages", "leaves")), (4002, "a footer that many people have never read to the end of it all")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), near=True).collect()}
    assert sum(got[i].n_dropped for i in range(2500)) == 2499 and got[0].n_dropped == 0
    assert [got[i].n_dropped for i in range(3000, 3009)] == [0] + [1] * 8
    assert [got[i].n_dropped for i in (4000, 4001, 4002)] == [1, 1, 0]


def test_lines_that_recur_as_they_stand_need_no_template(spark):
    lines = ["one two three four are all that these share", "one two three four then come quite other words"]
    rows = [(i, lines[0]) for i in range(4)] + [(9, lines[1])]
    got = {r.doc_id: r.n_dropped for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 9: 0}


def test_line_dedup_drops_short_exact_repeats(spark):
    rows = [(1, "Les.\nPage 4\n\n中文没有空格的一段话"), (2, "Les.\n\n Page  4\nPage 5\n7 8 9 1"), (3, "Les.\nLes.\n中文没有空格的一段话\n7 8 9 2"), (4, "Lis.\nPage 6")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), short=True)
    assert {r.doc_id: (r.text, r.n_dropped) for r in out.collect()} == {1: (rows[0][1], 0), 2: ("\nPage 5\n7 8 9 1", 2), 3: ("7 8 9 2", 3), 4: (rows[3][1], 0)}
    assert not re.search("Python|Pandas|Arrow", out._jdf.queryExecution().executedPlan().toString())


def test_line_dedup_runs_no_python(spark, docs):
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
