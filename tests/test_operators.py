"""Small cases written by hand, properties, and sources."""

import http.server
import itertools
import json
import re
import threading
from collections import Counter, defaultdict
from difflib import SequenceMatcher

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from quillmark.functions import paths, providers, text
from quillmark.operators import codeblocks, figures, hierarchy, judged, layout, merge, packing, patterns, structure
from quillmark.plans import search, stages
from quillmark.sources import corpus
from quillmark.streaming import ingest


def lines_of(spark, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return corpus.text_lines(docs)


def text_of(lines):
    return {r.book: r.text for r in corpus.reassembled(lines).collect()}


def test_strip_follows_unicode_white_space(spark):
    marks = ["\x1c", "\x1f", "\x85", "\xa0", " ", "　", "\t", " ", "\n", "\r"]
    rows = spark.createDataFrame([(m + "x y" + m,) for m in marks], "x string").select(text.strip("x").alias("s"))
    assert {r.s for r in rows.collect()} == {"x y"}


def test_toc_equals_a_stack(spark):
    rng = np.random.default_rng(3)
    levels = rng.integers(1, 7, 200).tolist()
    found = structure.toc(lines_of(spark, "\n".join("#" * k + f" t{i}" for i, k in enumerate(levels, 1))), 6)
    stack, want = [], []
    for i, k in enumerate(levels, 1):
        while stack and levels[stack[-1] - 1] >= k:
            stack.pop()
        want.append(stack[-1] if stack else 0)
        stack.append(i)
    assert [r.parent for r in found.orderBy("ordinal").collect()] == want


def plain_fences(body):
    """(role, in_code) of each line."""
    out, opener = [], ""
    for line in body:
        m = re.match(r" {0,3}(`{3,}|~{3,})", line)
        if m and not opener:
            opener = m[1]
            out.append(("open", True))
        elif m and m[1][0] == opener[0] and len(m[1]) >= len(opener):
            opener = ""
            out.append(("close", True))
        else:
            out.append((None, bool(opener)))
    return out


def test_typed_fences(spark):
    body = "````\n```\ncode\n````\ntext\n~~~\n```\n~~~\n```py\nx\n``` y\n```\nend\n    ```\n  ~~~"
    found = {r.line_no: (r.role, r.in_code) for r in codeblocks.typed_fences(lines_of(spark, body)).collect()}
    assert [found[i] for i in sorted(found)] == plain_fences(body.split("\n"))
    assert [found[i][0] for i in (1, 2, 4, 6, 7, 8, 9, 11, 12, 14, 15)] == ["open", None, "close", "open", None, "close", "open", "close", "open", None, None]
    rng = np.random.default_rng(8)
    bodies = [[str(x) for x in rng.choice(["```", "````", "~~~", "~~~~ z", "  ``` js", "    ```", "", "a b"], 30)] for _ in range(6)]
    lines = lines_of(spark, *map("\n".join, bodies))
    got = {(r.book, r.line_no): (r.role, r.in_code) for r in codeblocks.typed_fences(lines).collect()}
    assert got == {(str(i), k): x for i, body in enumerate(bodies) for k, x in enumerate(plain_fences(body), 1)}


PROSE = "This is a long sentence of plain English prose that is certainly not code at all here"


def test_checks_follow_typed_fences(spark):
    body = f"    ```\n{PROSE} outside\n~~~\n{PROSE} inside\n```\n    ```\nvalue = compute(a, b);\n~~~ end\nreturn compute(first, second);\n```\nopen"
    marked = codeblocks.typed_fences(lines_of(spark, body))
    assert [r.line_no for r in codeblocks.prose_in_code(marked).collect()] == [4]
    assert [r.line_no for r in codeblocks.code_outside(marked).collect()] == [9]
    assert [(r.line_no, r.content) for r in codeblocks.unclosed(marked).collect()] == [(10, "```")]
    assert {(r.line_no, r.confidence) for r in codeblocks.indented_fences(marked).collect()} == {(1, "LOW"), (6, "MEDIUM")}
    shown = codeblocks.surrounding(lines_of(spark, body), codeblocks.prose_in_code(marked), 1).first().around
    assert shown.split("\n") == ["        3: ~~~", f">>>     4: {(PROSE + ' inside')[:70]}", "        5: ```"]


def test_repair_closes_and_takes_prose_out(spark):
    body = f"```\nx = 1;\n{PROSE}\n{PROSE} again\ny = 2;"
    assert text_of(codeblocks.repaired(lines_of(spark, body)))["0"] == f"```\nx = 1;\n```\n{PROSE}\n{PROSE} again\n```\ny = 2;\n```"
    single = f"```\nx = 1;\n{PROSE}\ny = 2;\n```"
    assert text_of(codeblocks.repaired(lines_of(spark, single)))["0"] == single
    # both fences of a single line pair up with the one above
    assert text_of(codeblocks.repaired(lines_of(spark, f"```py\n{PROSE}\ny = 2;\n```")))["0"] == f"```\n{PROSE}\ny = 2;\n```"
    assert f"```\n{PROSE}\n```" in text_of(codeblocks.repaired(lines_of(spark, single), "wrap"))["0"]
    assert text_of(codeblocks.repaired(lines_of(spark, "plain text\n```\n```")))["0"] == "plain text\n```\n```"
    assert text_of(codeblocks.repaired(lines_of(spark, "a\n     ``` \nb")))["0"] == "a\n```\nb"
    none = codeblocks.repaired(lines_of(spark, body), accept=lambda found: found.where("type = 'unclosed_block'"))
    assert text_of(none)["0"] == body + "\n```"


def test_adjacent_fences_equal_a_greedy_scan(spark):
    rng = np.random.default_rng(5)
    for _ in range(8):
        body = [str(x) for x in rng.choice(["```", "~~~", "", "a"], 40)]
        want, i = [], 0
        while i < len(body):
            j = i + 1
            while j < len(body) and not body[j]:
                j += 1
            if body[i] in ("```", "~~~") and j < len(body) and body[j] == body[i]:
                i = j + 1
            else:
                want.append(body[i])
                i += 1
        assert text_of(codeblocks.without_adjacent_fences(lines_of(spark, "\n".join(body)))).get("0", "").split("\n") == (want or [""])


def test_blank_runs_and_enrichment_are_idempotent(spark):
    lines = lines_of(spark, "a\n\n\n\n\nb\n![x](p/one.png)\nc")
    once = patterns.compressed_blanks(lines)
    assert text_of(once) == text_of(patterns.compressed_blanks(once)) == {"0": "a\n\n\nb\n![x](p/one.png)\nc"}
    described = spark.createDataFrame([("0", "one.png", "T", "S" * 1300, ["k", " ", "m "], "read")], "book string, basename string, title string, summary string, keywords array<string>, ocr_text string")
    first = stages.enrich(lines, described)
    assert text_of(first) == text_of(stages.enrich(first, described))
    got = text_of(first)["0"]
    assert "*Keywords:* k, m\n\n*OCR excerpt:* read\n<!-- /figure-enrich -->\nc" in got and "S" * 1200 + "…" in got
    assert text_of(figures.without_blocks(first)) == text_of(lines)


def test_inline_titles(spark):
    titles = {"Rules": True, "Example 1": True, "Note:": True, "Notes a b": False, "Return Value": True, "Rulesets": False, "": False}
    rows = spark.createDataFrame([(t,) for t in titles], "title string").select("title", hierarchy.inline_title(F.col("title")).alias("i")).collect()
    assert {r.title: r.i for r in rows} == titles


def test_similar_lines(spark):
    body = "\n".join(f"Company confidential report number {w}" for w in ("one", "two", "six", "ten", "one", "two", "six", "ten")) + "\nnothing like it"
    found = patterns.similar_lines(lines_of(spark, body)).collect()
    assert [(r["count"], r.text) for r in found] == [(8, "Company confidential report number one")]


# --- the strip stage in plain Python ---------------------------------------


def plain_detect(lines):
    """[text, kind, count, confidence, variants] of the four detectors, one for each text."""
    total, stripped = len(lines), [x.strip() for x in lines]
    counts, found = Counter(x for x in stripped if len(x) > 3), []
    for text, n in counts.items():
        if n >= max(5, total // 100):
            found.append([text, "exact", n, min(0.9, 0.4 + n / total * 50 + n / 100 * 0.3), []])
    groups = defaultdict(list)
    for x in stripped:
        norm = re.sub(r"\b[ivxlcdmIVXLCDM]+\b", "{ROMAN}", re.sub(r"\b\d{1,4}\b", "{NUM}", x))
        if len(x) > 3 and norm != x:
            groups[norm].append(x)
    for texts in groups.values():
        n = len(texts)
        if n >= max(5, total // 100):
            found.append([texts[0], "normalized", n, min(0.85, 0.35 + n / total * 50 + n / 100 * 0.3), sorted(set(texts[:10]))])
    every = Counter(x for x in stripped if x)
    some = [t for t, n in every.items() if n >= 2 and 10 < len(t) < 200]
    used = set()
    for i, a in enumerate(some):
        if a not in used:
            members = [a, *(b for b in some[i + 1 :] if b not in used and SequenceMatcher(None, a, b).ratio() >= 0.75)]
            used |= set(members)
            n = sum(every[t] for t in members)
            if len(members) > 1 and n >= 5:
                found.append([max(members, key=every.get), "similar", n, min(0.8, 0.3 + n / total * 5), sorted(members)])
    tails = defaultdict(list)
    for x in stripped:
        if m := re.match(r"([ivxlcdmIVXLCDM]+|\d{1,4})\s+(.{10,80})$", x):
            tails[re.sub(r"\d+", "{N}", m[2])].append((x, m[2]))
    for pairs in tails.values():
        if len(pairs) >= 5:
            found.append([Counter(t for _, t in pairs).most_common(1)[0][0], "footer", len(pairs), min(0.8, 0.4 + len(pairs) / total * 30), sorted({x for x, _ in pairs[:20]})])
    best = {}
    for f in found:
        key = f[0].strip().lower()
        if key not in best or f[3] > best[key][3]:
            best[key] = f
    return sorted(best.values(), key=lambda f: (f[3], f[2]), reverse=True)


def plain_classify(f):
    text, kind, n, sure, variants = f
    any_ = lambda found: any(regex.search(p, text) for p in found)
    header = 15 < len(text) < 200 and (re.match(r"#{1,3}\s+.{15,}$", text) or (n >= 10 and text[-1] not in ".?!。？！" and (text[0].isupper() or text[0] == "#")))
    kind, more = ("page_number", 0.25) if any_(patterns.PAGE_NUMBER) else ("header", 0.15) if header else ("watermark", 0.2) if any_(patterns.WATERMARK) else ("footer", 0.15) if any_(patterns.FOOTER) else ("unknown", 0)
    content = len(text) > 300 or len(re.split(r"[.!?]\s+[A-Z]", text)) > 2 or (any_(patterns.STARTERS) and not re.match(r"#{1,3}\s+.{15,}$", text))
    return [text, "content", n, 0.0, variants] if content else [text, kind, n, min(1.0, sure + more), variants]


def plain_removal(lines, found):
    """(line or None, reason) for each line."""
    known = {v.strip() for f in found for v in [f[0], *f[4]]}
    loose = lambda t: r"\s+".join(map(re.escape, t.split(" ")))
    typed = [f for f in found if f[1] in ("footer", "header", "watermark")]
    whole = [re.compile(rf"\s*{loose(f[0].strip())}\s*$", re.I) for f in typed]
    inline = [re.compile(rf"([ivxlcdmIVXLCDM]+|\d{{1,4}})?\s*{loose(f[0].strip())}\s*", re.I) for f in typed if f[1] == "footer" and len(f[0].strip()) > 20]
    cores = [re.sub(r"\d+", "", re.sub(r"^[ivxlcdmIVXLCDM\d]+\s*", "", f[0].strip())) for f in found if f[1] == "footer"]
    cores, pages = [c.lower() for c in cores if len(c) > 15], any(f[1] == "page_number" for f in found)

    def judge(line):
        s = line.strip()
        if not s or s.startswith("```"):
            return line, None
        if s in known:
            return None, "exact_match"
        if any(p.match(s) for p in whole):
            return None, "regex_pattern"
        if pages and len(s) <= 5 and re.fullmatch(r"[ivxlcdmIVXLCDM]+|\d{1,4}", s):
            return None, "page_number"
        for p in inline:
            if m := p.match(s):
                rest = s[m.end() :].strip()
                return (" " * (len(line) - len(line.lstrip())) + rest, "inline_footer_partial") if len(rest) > 10 else (None, "inline_footer_removed")
        norm = re.sub(r"\s+", " ", re.sub(r"\d+", "", s).lower())
        if len(s) < 200 and max((SequenceMatcher(None, c, norm).ratio() for c in cores), default=0) >= 0.8:
            if len(s) > 80 and any(v in s and len(s.replace(v, "").strip()) > 10 for v in known):
                return line, None
            return None, "similarity_match"
        return line, None

    return [judge(x) for x in lines]


def plain_strip(lines):
    found = [f for f in map(plain_classify, plain_detect(lines)) if f[1] != "content" and f[3] >= 0.35]
    judged = plain_removal(lines, found)
    reasons, lines = Counter(r for _, r in judged if r), [x for x, _ in judged if x is not None]
    out, code = [], False
    for x in lines:  # furniture inside code
        s = x.strip()
        code ^= s.startswith("```")
        words = set(re.findall("[a-z]+", s.lower()))
        hit = code and not s.startswith("```") and len(s) >= 5
        if hit and any(re.match(p, s) for p in patterns.CODE_PAGE_NUMBER):
            reasons["page_number*"] += 1
        elif hit and any(re.search(p, s) for p in patterns.CODE_FURNITURE):
            reasons["header_footer_pattern"] += 1
        elif hit and any(len(words & set(g)) >= n for g, n in patterns.KEYWORD_GROUPS) and not any(re.search(p, s) for p in patterns.STRONG_CODE):
            reasons["keyword_group"] += 1
        else:
            out.append(x)
    lines, out, code, i = out, [], False, 0
    while i < len(lines):  # blocks that only blanks part
        s = lines[i].strip()
        if s.startswith("```"):
            j = i + 1
            while code and j < len(lines) and not lines[j].strip():
                j += 1
            if code and j < len(lines) and lines[j].strip() == "```":
                i = j + 1
                continue
            code = not code
        out.append(lines[i])
        i += 1
    row = re.compile(r"\s*\|.*\|\s*$")
    kept = []
    for i, x in enumerate(out):  # blanks between rows of a table
        above = next((y for y in reversed(out[:i]) if y.strip()), "")
        below = next((y for y in out[i + 1 :] if y.strip()), "")
        if x.strip() or not (row.match(above) and row.match(below)):
            kept.append(x)
    out, blanks = [], 0
    for x in kept:
        blanks = 0 if x.strip() else blanks + 1
        if blanks <= 2:
            out.append(x)
    return out, reasons


@pytest.fixture(scope="module")
def shelf(spark):
    """Lines of the composed books, and each book's lines."""
    lines = corpus.books(spark, "/root/testdata/sf0.001").cache()
    by = defaultdict(list)
    for r in lines.orderBy("book", "line_no").collect():
        by[r.book].append(r.line)
    return lines, dict(by)


def test_detection_against_plain(shelf):
    lines, by = shelf
    got = defaultdict(set)
    for r in patterns.detect(lines).collect():
        got[r.book].add((r.text, r.pattern_type, r["count"], round(r.confidence, 6), tuple(r.variants)))
    want = {b: {(t, k, n, round(c, 6), tuple(v)) for t, k, n, c, v in plain_detect(x)} for b, x in by.items()}
    assert {b: got[b] for b in by} == want
    assert patterns.similar_lines(lines).count() > 0 and {"exact", "normalized", "footer"} <= {k for x in want.values() for _, k, *_ in x}


def test_strip_stage_against_plain(shelf):
    lines, by = shelf
    want = {b: plain_strip(x) for b, x in by.items()}
    got = text_of(patterns.clean(lines))
    assert got == {b: "\n".join(x) for b, (x, _) in want.items()}
    reasons = sum((r for _, r in want.values()), Counter())
    audit = Counter()
    for r in patterns.audit(lines).where("stage <> 'merge'").collect():
        audit[r.reason + "*" * (r.stage == "cleanup" and r.reason == "page_number")] += 1
    assert audit == reasons and {"exact_match", "similarity_match", "inline_footer_partial"} <= set(reasons)


def test_hand_written_strip_stage(spark):
    footer = "Copyright © the friends of old maps and charts"
    pages = [f"own words of page {chr(97 + i)} that differ\n{footer}" for i in range(8)]
    long = f"a long line that holds {footer.lower()} in full and goes on after that for more than eighty characters"
    near = "Copyright © the friend of old maps and chart"
    body = "\n".join([*pages, f"12 {footer} and then own words follow", f"  {footer} end", near, long, "```", "x = 1;", "Copyright © 2021 by all", "y = 2;", "``` x", "", "```", "z = 3;", "```"])
    found = {r.line_no: r.reason for r in patterns.audit(lines_of(spark, body)).collect()}
    assert found == {2 * i: "exact_match" for i in range(1, 9)} | {17: "inline_footer_partial", 18: "inline_footer_removed", 19: "similarity_match", 23: "header_footer_pattern", 25: "code_block_merge", 26: "code_block_merge", 27: "code_block_merge"}
    got = text_of(patterns.clean(lines_of(spark, body)))["0"].split("\n")
    assert got[8:] == ["and then own words follow", long, "```", "x = 1;", "y = 2;", "z = 3;", "```"]
    doubtful = lines_of(spark, "\n".join([*pages, "Copyright maps of friends, the old"]))
    cleaned = patterns.removable(patterns.classify(patterns.detect(doubtful)))
    rows = patterns.similarity(patterns.removal(doubtful, cleaned), cleaned, judged.furniture_lines(judged.line_prompts(doubtful).withColumn("answer", F.lit("footer"))))
    last = rows.where("line_no = 17").first()
    assert 0.5 <= last.ratio < 0.8 and last.reason == "similarity_match+confirmed"


def plain_page_blocks(text):
    """Neighbouring blocks joined from the end, on the whole text."""
    block = re.compile(r"```(\w*)\n(.*?)```", re.S)
    found = list(block.finditer(text))
    i = len(found) - 1
    while i > 0:
        a, b = found[i - 1], found[i]
        if not text[a.end() : b.start()].strip() and (a[1] == b[1] or not a[1] or not b[1]):
            text = text[: a.start()] + f"```{a[1] or b[1]}\n" + a[2].rstrip("\n") + "\n" + b[2].lstrip("\n") + "```" + text[b.end() :]
            found = list(block.finditer(text))
        i = min(i - 1, len(found) - 1)
    return text


@pytest.mark.parametrize("seed", range(4))
def test_page_blocks_against_plain(spark, seed):
    rng = np.random.default_rng(seed)
    bodies = []
    for _ in range(12):
        parts = []
        for _ in range(6):
            parts += [f"```{rng.choice(['', 'c', 'py'])}", f"code {rng.integers(9)}", "```", *rng.choice(["", "", "text"], rng.integers(0, 3))]
        bodies.append("\n".join(map(str, parts)))
    got = text_of(layout.merged_blocks(lines_of(spark, *bodies)))
    assert got == {str(i): plain_page_blocks(x) for i, x in enumerate(bodies)}


@pytest.mark.parametrize("seed", range(5))
def test_packing_is_best_by_brute_force(seed):
    rng = np.random.default_rng(seed)
    sizes, most = rng.integers(1, 8, 9).tolist(), 10
    ends = np.cumsum([0, *sizes]).tolist()
    found = packing.pack([(a, b, f"t{i}") for i, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True))], most)
    assert [f[1] for f in found] == [0, *[f[2] for f in found[:-1]]] and found[-1][2] == ends[-1]
    options = []
    for n in range(len(sizes)):
        for cut in itertools.combinations(range(1, len(sizes)), n):
            bounds = [0, *cut, len(sizes)]
            groups = [ends[b] - ends[a] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            if max(groups) <= most:
                options.append((len(groups), -min(groups)))
    assert (len(found), -min(f[2] - f[1] for f in found)) == min(options)


def test_split_points_and_strategies(spark):
    assert packing.split_point(0, 10, [2, 4, 6, 9]) == 4 and packing.split_point(0, 9, []) == 4
    sizes = spark.createDataFrame([("b", 30)], "book string, total_pages int")
    outline = spark.createDataFrame([("b", 1, 0, "one", 2), ("b", 2, 1, "one.a", 8), ("b", 3, 0, "two", 12), ("b", 4, 0, "two again", 12), ("b", 5, 0, "three", 25), ("b", 6, 0, "four", 27)], "book string, ord int, depth int, title string, page int")
    for strategy in ("fixed", "chapters", "chapter_first", "outline"):
        got = sorted((r.start_page, r.end_page) for r in packing.split(outline, sizes, 10, strategy).collect())
        assert all(0 < b - a <= 10 for a, b in got) and all(x[1] == y[0] for x, y in zip(got[:-1], got[1:], strict=True)), strategy
        assert got[-1][1] == 30
    with pytest.raises(ValueError):
        packing.split(outline, sizes, 0)


def test_titles_of_ranges(spark):
    sizes = spark.createDataFrame([("b", 30)], "book string, total_pages int")
    outline = spark.createDataFrame([("b", 1, 0, " ", 3), ("b", 2, 1, "x", 5), ("b", 3, 1, "y", 9), ("b", 4, 0, "two", 12), ("b", 5, 0, "three", 26), ("b", 6, 0, "four", 26)], "book string, ord int, depth int, title string, page int")
    got = {(r.start_page, r.end_page): r.title for r in packing.chapter_first(outline.where("ord <> 5"), sizes, 8).collect()}
    assert got == {(0, 3): "文前", (3, 9): "? — ? … x（2 节）", (9, 12): "? — y", (12, 20): "two — two（段 1）", (20, 26): "two — two（段 2）", (26, 30): "four"}
    got = {(r.start_page, r.end_page): r.title for r in packing.outline_smart(outline, sizes, 9).collect()}
    assert got == {(0, 5): "开头 … ?（2 节）", (5, 12): "x … y（2 节）", (12, 21): "two（段 1）", (21, 30): "two（段 2） … three（2 节）"}
    pages = spark.createDataFrame([("b", k, 10) for k in range(30)], "book string, page int, bytes int")
    halves = packing.by_size(spark.createDataFrame([("b", "t", 0, 9)], "book string, title string, start_page int, end_page int"), pages, packing.bookmarks(outline, sizes), 45)
    assert {(r.start_page, r.end_page): r.title for r in halves.collect()} == {(0, 3): "t（子段·前）", (3, 5): "t（子段·后）（子段·前）", (5, 9): "t（子段·后）（子段·后）"}


def test_missing_parts_and_manifests_are_errors(spark, tmp_path):
    parts = spark.createDataFrame([("m", 1, "m_pt001", "t")], "base_stem string, part_no int, stem string, title string")
    with pytest.raises(Exception, match="no text for part"):
        merge.checked_parts(parts, spark.createDataFrame([], "stem string, text string")).collect()
    (tmp_path / "m.json").write_text(json.dumps({"base_stem": "m", "parts": [{"stem": "m_pt001", "title": "t"}]}))
    assert [r.stem for r in corpus.manifest_json(spark, str(tmp_path / "m.json")).collect()] == ["m_pt001"]
    (tmp_path / "bad.json").write_text(json.dumps({"base_stem": "", "parts": []}))
    with pytest.raises(Exception, match="base_stem or parts"):
        corpus.manifest_json(spark, str(tmp_path / "bad.json")).collect()


def test_files_are_read(spark, tmp_path):
    (tmp_path / "a.md").write_text("# x\ny")
    assert corpus.markdown_files(spark, str(tmp_path / "a.md")).first().text == "# x\ny"
    png = b"\x89PNG\r\n\x1a\n" + b"\0\0\0\rIHDR" + (3).to_bytes(4, "big") + (5).to_bytes(4, "big")
    (tmp_path / "p.png").write_bytes(png)
    row = corpus.image_files(spark, str(tmp_path / "p.png")).first()
    assert (row.basename, row.size_bytes, row.width, row.height) == ("p.png", len(png), 3, 5)


def test_providers_and_answers(spark):
    assert providers.extract_json('```json\n{"a": {"b": 1}} trailing') == {"a": {"b": 1}} and providers.extract_json("none {") is None
    assert providers.summary_of({"摘要": "d" * 200, "Keywords": "a, b，c"}) == ("d" * 100, ["a", "b", "c"])
    assert providers.summary_of({"Summary": 7, "关键词": [" x ", "", 3, 4, 5, 6]}) == ("7", ["x", "3", "4", "5"]) and providers.summary_of({"tags": "a"}) == ("", [])
    record = providers.figure_record({"confidence": "7", "keywords": "k", "diagram_semantics": {"nodes": "n", "edges": ["e"]}, "page": 3})
    assert record["confidence"] == 1.0 and record["keywords"] == [] and record["title"] == "unknown" and record["page"] == 3
    assert record["diagram_semantics"] == {"participants": [], "interactions": [], "nodes": [], "edges": ["e"], "components": [], "relations": []}
    assert providers.figure_record("x")["confidence"] == 0.0
    assert providers.model_json('so: {"a": {"b": 2}} .') == {"a": {"b": 2}}
    for bad in ("[1]", "nothing", ""):
        with pytest.raises(ValueError):
            providers.model_json(bad)
    text = lambda message: providers.answer_text({"choices": [message]})
    assert text({"message": {"content": [{"type": "text", "text": "a"}, {"text": "b"}, {"image": 1}]}}) == "a\nb" and text({"text": " c "}) == "c" and text({"message": {"content": None, "text": "d"}}) == "d"
    assert text({"message": {"reasoning_content": "e"}}) == "e" and providers.answer_text({}) == ""
    assert providers.retry_delay(50) == 60 and providers.retry_delay(1, 120, 502) == 60 and providers.retry_delay(1, 60, 429, "900") == 300 and providers.retry_delay(0, 60, 429, "x") <= 1.5
    prompt = providers.figure_prompt({"image_id": 'f"1', "document_context": "around"})
    assert '- image_id: "f\\"1"' in prompt and "around" in prompt and "diagram_semantics" in prompt

    class Loud:
        def generate(self, prompt, *_, **__):
            return prompt.upper()

    prompts = spark.createDataFrame([("a",), ("a",), ("b",)], "prompt string")
    known = providers.answers(prompts.where("prompt = 'a'"), Loud)
    assert sorted((r.prompt, r.answer) for r in providers.answers(prompts, providers.Offline, known).collect()) == [("a", "A"), ("b", "")]


def test_models_are_asked_again_with_rising_temperature(spark):
    class Slow:
        def generate(self, prompt, system="", temperature=None, max_tokens=0, images=()):
            return f'{{"summary": "at {temperature}"}}' if temperature > 0.2 else "what?"

    parts = spark.createDataFrame([("b", "c1", "t", "w" * 60), ("b", "c2", "t", " short ")], "book string, id string, title string, content string")
    got = {r.id: (r.summary, r.keywords) for r in judged.summaries(parts, Slow).collect()}
    assert got == {"c1": ("at 0.3", []), "c2": ("", [])}
    assert {r.summary for r in judged.summaries(parts, providers.Offline).collect()} == {""}


def test_http_models_against_a_local_server():
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            asked.append((self.path, body))
            code = 503 if len(asked) == 1 else 400 if body["model"] == "bad" else 200
            self.send_response(code)
            if code == 503:
                self.send_header("Retry-After", "0")
            self.end_headers()
            self.wfile.write(json.dumps({"response": " local "} if "generate" in self.path else {"choices": [{"message": {"content": "hi"}}]}).encode())

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    url = f"http://127.0.0.1:{server.server_port}"
    try:
        assert providers.HttpChat(url, "m").generate("p", "s", 0.2, images=("data:image/png;base64,AA",)) == "hi" and len(asked) == 2
        assert asked[1][0] == "/v1/chat/completions" and asked[1][1]["messages"][1]["content"][1]["image_url"] == {"url": "data:image/png;base64,AA"}
        assert providers.HttpChat(url + "/v1", "bad").generate("p") == "" and len(asked) == 3
        assert providers.client({"api": "local", "url": url, "model": "m"}).generate("p", images=("data:x;base64,QQ",)) == "local" and asked[3][1]["images"] == ["QQ"]
    finally:
        server.shutdown()
    assert isinstance(providers.client(), providers.Offline)
    with pytest.raises(ValueError):
        providers.client(api="other")


def test_options_and_responses():
    assert providers.conversion_options({"table_mode": "fast"}) == providers.CONVERSION | {"table_mode": "fast"}
    for bad in ({"table_mode": "slow"}, {"pages": 3}, {"timeout": 0}):
        with pytest.raises(ValueError):
            providers.conversion_options(bad)
    assert providers.responds(providers.Recorded(lambda prompt: "yes")) and not providers.responds(providers.Offline())


def test_settings_come_from_the_nearest_file(tmp_path):
    for name, model in (("a", "one"), ("b", "two")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "quillmark.conf").write_text(f"[llm]\nmodel = {model}\n")
    found = providers.config([tmp_path / "none", tmp_path / "b", tmp_path / "a"])
    assert found == {"model": "two"} and providers.setting(None, found, "model", "x") == "two" and providers.setting("y", found, "model", "x") == "y" and providers.setting(None, found, "url", "x") == "x"


def test_model_decisions(spark):
    found = spark.createDataFrame([("b", "t1", "unknown", 0.4, 1), ("b", "t2", "unknown", 0.5, 2), ("b", "t3", "header", 0.9, 3), ("b", "t4", "unknown", 0.36, 4)], "book string, text string, pattern_type string, confidence double, place int")
    prompt = judged.pattern_prompts(found).first().prompt
    assert prompt.endswith('1. "t1"\n2. "t2"\n3. "t4"')
    answers = spark.createDataFrame([("b", 'sure {"1": "Header", "2": "CONTENT", "9": "FOOTER"}')], "book string, answer string")
    got = {r.text: (r.pattern_type, round(r.confidence, 6)) for r in judged.validated(found, answers).collect()}
    assert got == {"t1": ("header", 0.6), "t2": ("content", 0.2), "t3": ("header", 0.9), "t4": ("unknown", 0.36)}
    choices = spark.createDataFrame([("b", 1, "n"), ("b", 3, "Q")], "book string, place int, choice string")
    assert [r.text for r in judged.confirmed(found, choices).collect()] == ["t2"]
    words = spark.createDataFrame([("x FOOTER y",), ("page_number",), (None,), ("hm",)], "a string").select(judged.line_class(F.col("a")).alias("c"))
    assert [r.c for r in words.collect()] == ["footer", "page_number", "content", "content"]
    lines = lines_of(spark, "# 1.1 Scope\n# Odd words\n# 1.2 Next")
    prompts = judged.heading_prompts(structure.headings(lines))
    assert [(r.line_no, r.prompt.rsplit("from ", 1)[1]) for r in prompts.collect()] == [(2, "4 to 6 only.")]
    levels = judged.judged_levels(structure.headings(lines), spark.createDataFrame([("0", 2, "H2")], "book string, line_no int, answer string"))
    assert {r.line_no: (r.new_level, r.method) for r in levels.collect()} == {1: (3, "rule"), 2: (4, "llm"), 3: (3, "rule")}
    marked = codeblocks.typed_fences(lines_of(spark, f"```\n{PROSE[:70]}\nx"))
    issues = judged.issue_prompts(lines_of(spark, f"```\n{PROSE[:70]}\nx"), codeblocks.issues(marked)).collect()
    assert [(r.line_no, r.type) for r in issues] == [(2, "prose_in_code")] and ">>>     2: This" in issues[0].prompt


def test_paths(spark):
    cases = [
        ("/srv/out/a.png", "../out/a.png"), ("<b c.png>", None), ("<./b c.png>", "b c.png"), ("./a/../b.png", "b.png"), ("x/y.png", None), ("https://x/y.png", None), ("#a", None), ("", None), ("data:x", None),
        ("/srv/docs", "."), ("/srv/docs/i/k.png", "i/k.png"), ("../docs/z.png", "z.png"), ("/../a", "../../a"),
    ]
    rows = spark.createDataFrame([(a,) for a, _ in cases], "x string")
    assert [r.p for r in rows.select(paths.relative_path(F.col("x"), F.lit("/srv/docs")).alias("p")).collect()] == [b for _, b in cases]
    within = rows.select(paths.inside(F.col("x"), F.lit("/srv/docs")).alias("p")).collect()
    assert within[10].p == "i/k.png" and within[0].p == "/srv/out/a.png" and within[9].p == "/srv/docs"
    lines = lines_of(spark, "a ![x](/srv/out/a.png) ![x](b.png) ![x](/srv/out/a.png) z ![](<c.png>)")
    got = figures.relative_links(lines, "/srv/docs").first()
    assert (got.line, got.found, got.changed) == ("a ![x](../out/a.png) ![x](b.png) ![x](../out/a.png) z ![](<c.png>)", 4, 2)
    texts = spark.createDataFrame([("/a/output/b/c",), ("none",)], "x string")
    assert [r.a for r in texts.select(text.after_output(F.col("x")).alias("a")).collect()] == ["b/c", None]
    cut = texts.select(text.truncate(F.col("x"), 8).alias("a"), text.squeeze(F.lit(" a\r\nb  \t c\n\n\n\nd ")).alias("b")).first()
    assert (cut.a, cut.b) == ("/a/ou...", "a\nb c\n\nd")


def test_merged_paths_by_hand(spark):
    mapping = spark.createDataFrame(
        [("m", 1, "m_1", 1, "m_1_images/a.png", "m_images/m_1_a.png"), ("m", 1, "m_1", 2, "m_1_images/b.png", "m_images/m_1_b.png"), ("m", 2, "m_2", 1, "m_2_artifacts/a.png", "m_images/m_2_a.png"), ("m", 2, "m_2", 2, "m_2_artifacts/z.png", "m_images/m_2_z.png")],
        "base_stem string, part_no int, stem string, place int, old string, new string",
    )
    given = [(1, "./m_1_images/a.png", "m_images/m_1_a.png"), (1, "b.png", "m_images/m_1_b.png"), (1, "gone/other.png", "gone/other.png"), (1, "else/z.png", "else/z.png"), (2, "else\\z.png", None), (2, "x/a.png", "m_images/m_1_a.png"), (2, None, "m_images/m_2_a.png"), (2, " ", "m_images/m_2_z.png"), (2, "", None)]
    order = {1: 0, 2: 0}
    rows = []
    for part, path, _ in given:
        rows.append(("m", part, f"m_{part}", order[part], path))
        order[part] += 1
    rows[4], rows[8] = ("m", 2, "m_2", 8, "else/z.png"), ("m", 2, "m_2", 9, "")
    records = spark.createDataFrame(rows, "base_stem string, part_no int, stem string, ord int, image_path string")
    got = {(r.part_no, r.ord): r.new_path for r in merge.resolved_paths(records, mapping).collect()}
    assert got == {(1, 0): "m_images/m_1_a.png", (1, 1): "m_images/m_1_b.png", (1, 2): "gone/other.png", (1, 3): "else/z.png", (2, 1): "m_images/m_1_a.png", (2, 2): "m_images/m_2_z.png", (2, 3): " ", (2, 8): "m_images/m_2_z.png", (2, 9): ""}
    assert merge.merged_images(records.withColumn("image_id", F.lit("f"))).first().image_id == "m_1__f"


def test_edges_and_contexts_by_hand(spark):
    items = [("b", i, "TEXT", x, None, p, 50.0, t, 500.0, b, o, 1000.0) for i, (x, p, t, b, o) in enumerate([("at", 1, 80.0, 90.0, "TOPLEFT"), ("in", 1, 79.9, 90.0, "TOPLEFT"), ("low", 1, 500.0, 920.1, "TOPLEFT"), ("edge", 1, 500.0, 920.0, "TOPLEFT"), ("up", 1, 920.1, 900.0, "BOTTOMLEFT"), ("x", 1, 1.0, 2.0, "TOPLEFT")])]
    frame = spark.createDataFrame(items, "book string, ord int, label string, text string, level int, page_no int, l double, t double, r double, b double, origin string, page_height double")
    assert {r.text for r in layout.edge_items(frame).collect()} == {"in", "low", "up"}
    texts = spark.createDataFrame([("0", "Page 1 of"), ("0", "12 ab")], "book string, text string")
    assert text_of(layout.without_edge_texts(lines_of(spark, "Page 22 of\nPage of\n7 ab\nab\n3 abc"), texts))["0"] == "Page of\n7 ab\nab\n3 abc"
    lines = lines_of(spark, "# One #\n## Two §\nabc   \n![x](i/f.png)\nafter  \n")
    assert figures.breadcrumbs(lines).first().trail == "One > Two"
    assert figures.figure_context(lines, 6, 3).first().asDict() == {"book": "0", "line_no": 4, "href": "i/f.png", "basename": "f.png", "context_before": "§\nabc", "context_after": "aft"}
    made = layout.image_index(frame.withColumn("label", F.lit("PICTURE")).withColumn("prov", F.expr("array(struct(cast(null as int) as page_no, cast(null as struct<l:double,t:double,r:double,b:double>) as bbox), struct(4 as page_no, struct(0D as l, 2D as t, 3D as r, 0D as b) as bbox))"))).orderBy("image_id").first()
    assert (made.image_id, made.page_no, made.area, made.caption, made.image_path) == ("fig_0000", 4, 6.0, None, None)


def test_files_and_sinks(spark, tmp_path):
    lines = lines_of(spark, "# a\n\nb ", "c")
    corpus.write_markdown(lines, str(tmp_path / "md"))
    made = {p.parent.name: p.read_text() for p in (tmp_path / "md").glob("book=*/*.txt")}
    assert made == {"book=0": "# a\n\nb \n", "book=1": "c\n"}
    (tmp_path / "i.json").write_text(json.dumps([{"image_id": "f1", "bbox": {"l": 1, "t": 2, "r": 3, "b": 4}, "prov": [{"page_no": 2}]}, {"image_id": "f2"}]))
    assert [(r.ord, r.image_id, r.prov and r.prov[0].page_no) for r in corpus.images_json(spark, str(tmp_path / "i.json")).collect()] == [(0, "f1", 2), (1, "f2", None)]
    (tmp_path / "bad.json").write_text("{}")
    with pytest.raises(Exception, match="not an array"):
        corpus.images_json(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "figs").mkdir()
    for name, row in (("one", {"image_id": "a", "image_path": "/srv/out/a.png"}), ("report", {"image_id": "b"}), ("two", {"title": "none"})):
        (tmp_path / "figs" / f"{name}.json").write_text(json.dumps(row))
    assert [r.image_id for r in corpus.figures_json(spark, str(tmp_path / "figs")).collect()] == ["a"]
    corpus.rewritten_records(spark, str(tmp_path / "figs"), str(tmp_path / "new"), "image_id string, image_path string, more array<struct<export_path:string>>", "/srv/docs")
    assert {r.image_path for r in spark.read.json(str(tmp_path / "new")).collect()} == {"../out/a.png", None}
    corpus.write_audit(patterns.audit(lines), str(tmp_path / "audit"))
    corpus.write_json(lines, str(tmp_path / "side"), "book")
    assert spark.read.json(str(tmp_path / "side")).count() == 4
    corpus.move(spark, str(tmp_path / "side"), str(tmp_path / "old" / "side"))
    assert spark.read.json(str(tmp_path / "old" / "side")).count() == 4
    mapping = spark.createDataFrame([("i.json", "x/m_i.json"), ("none", "x/none")], "old string, new string")
    assert {r.old: r.ok for r in corpus.copied(mapping, str(tmp_path), str(tmp_path / "out")).collect()} == {"i.json": True, "none": False}
    url = spark.createDataFrame([("a.JPG", b"x"), ("b", b"y")], "p string, c binary").select(corpus.data_url(F.col("p"), F.col("c")).alias("u")).collect()
    assert [r.u for r in url] == ["data:image/jpeg;base64,eA==", "data:image/png;base64,eQ=="]


def test_image_headers(spark, tmp_path):
    heads = {
        "a.gif": b"GIF89a" + (7).to_bytes(2, "little") + (9).to_bytes(2, "little"), "b.bmp": b"BM" + b"\0" * 16 + (11).to_bytes(4, "little") + (13).to_bytes(4, "little"),
        "c.jpg": b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + (17).to_bytes(2) + (19).to_bytes(2), "d.txt": b"nothing",
    }
    for name, content in heads.items():
        (tmp_path / name).write_bytes(content)
    got = {r.basename: (r.width, r.height) for r in corpus.image_files(spark, str(tmp_path)).collect()}
    assert got == {"a.gif": (7, 9), "b.bmp": (11, 13), "c.jpg": (19, 17), "d.txt": (None, None)}


def test_conversion_and_every_stage(spark, tmp_path):
    page = "Running head\n# 1. Part {0}\nwords of page {0}\n![x](/srv/out/fig_{0}.png)"
    files = spark.createDataFrame([("b", "\f".join(page.format(k) for k in range(1, 6)).encode()), ("c", b"\xff# x")], "book string, content binary")
    made = stages.converted(files, rebuild=1)
    lines = text_of(made["lines"])["b"].split("\n")
    assert "Running head" not in lines and lines[0] == "# 1. Part 1" and lines.count("<!-- image -->") == 5
    assert [r.image_id for r in made["images"].where("book = 'b'").orderBy("image_id").collect()] == [f"fig_{k:04d}" for k in range(5)]

    class Broken:
        def items(self, content):
            raise RuntimeError("no layout")

    assert [(r.label, r.text) for r in providers.scan_layout(files, Broken).where("book = 'b'").collect()] == [("ERROR", "no layout")]
    read = providers.read_images(spark.createDataFrame([("p", b"x")], "path string, content binary"))
    assert read.first().asDict() == {"path": "p", "ocr_text": "unknown", "ocr_error": None}
    books = lines_of(spark, "\n".join(page.format(k).replace("Running head", "") for k in range(1, 4)))
    images = spark.createDataFrame([("0", k, f"fig_{k}", 5000, 100.0, None) for k in range(3)], "book string, ord int, image_id string, size_bytes long, area double, pixels long")
    out = stages.every_stage(books, images, folder="/srv/docs")
    assert out["images"].count() == 3 and "](../out/fig_2.png)" in text_of(out["clean"])["0"] and out["context"].count() == 3
    assert json.loads(out["index"].first()["index"])["metadata"]["total_chunks"] == 3 and json.loads(out["index_h2"].first()["index"])["metadata"]["depth"] == 2
    log = stages.timed(spark, {"good": lambda: books, "bad": lambda: books.select("nothing"), "never": lambda: books}, stop=True).collect()
    assert [(r.step, r.ok) for r in log] == [("good", True), ("bad", False)]
    assert stages.precheck(spark, {"there": str(tmp_path), "gone": str(tmp_path / "x")}, {"key": ""}) == [f"input gone: {tmp_path / 'x'}", "setting key"]
    calls = packing.exported(spark.createDataFrame([("s", "s.pdf", 1, 4)], "stem string, pdf string, page_start_1based int, page_end_1based_inclusive int"), "a.pdf", "out", lambda call: 0 if call == ["qpdf", "a.pdf", "--pages", "a.pdf", "1-4", "--", "out/s.pdf"] else 1)
    assert calls.first().ok


def test_partitions_do_not_matter(spark):
    lines = corpus.books(spark, "/root/testdata/sf0.001").cache()
    one, many = (text_of(stages.clean_lines(lines.repartition(n))) for n in (1, 8))
    assert one == many


def test_stream_indexes_new_documents(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.createDataFrame([(1, "# a\nb\n## c\nd")], "doc_id long, text string").write.parquet(source)
    for _ in range(2):
        ingest.index_stream(ingest.stream_documents(spark, source), target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 2
    spark.createDataFrame([(2, "# e")], "doc_id long, text string").write.mode("append").parquet(source)
    ingest.index_stream(ingest.stream_documents(spark, source), target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 3


def test_nearest_vectors_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 3)
    monkeypatch.setattr(search, "VECTORS", 7)
    monkeypatch.setattr(search, "TOGETHER", 2)
    rng = np.random.default_rng(5)
    good = {i: rng.standard_normal(8) for i in range(60)} | {i: np.ones(8) for i in range(60, 75)}
    rows = [(i, v.tolist()) for i, v in good.items()] + [(100, None), (101, []), (102, [0.0] * 8), (103, [float("nan")] * 8), (104, [None, 1.0]), (105, [1.0] * 5), (None, None)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in search.nearest(frame.where("vec_id % 5 = 0").selectExpr("vec_id as query_id", "embedding as query"), frame, 6).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    unit = {i: v / np.linalg.norm(v) for i, v in good.items()}
    want = {q: dict(enumerate(sorted(unit, key=lambda i: (-round(float(unit[q] @ unit[i]), 9), i))[:6], 1)) for q in unit if q % 5 == 0}
    assert got == want | {105: {1: 105}}
    assert search.nearest(frame.limit(0).selectExpr("vec_id as query_id", "embedding as query"), frame).count() == 0


def test_hybrid_search(spark):
    keyword = spark.createDataFrame([(1, "a", 1.0), (1, "b", 0.5)], "query_id int, id string, score double")
    vector = spark.createDataFrame([(1, "b", 1.0), (1, "c", 0.2)], "query_id int, id string, score double")
    assert [r.id for r in search.hybrid(keyword, vector).orderBy("rank").collect()] == ["b", "a", "c"]
