"""Repeated page furniture: detection, classification and removal."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.storage import checkpointed
from ..functions.text import any_of, lstrip, normalised, strip
from .structure import fence_mask

LEAST = 5
HIGH, MEDIUM = 0.6, 0.35
CLUSTER = 0.75
CANDIDATES = 500
SIMILAR, DOUBTFUL = 0.80, 0.50

# Fixed values of the rules.
PAGE_NUMBER = [
    r"(?i)^[ivxlcdm]+$", r"^\d{1,4}$", r"(?i)^page\s+\d+", r"^-\s*\d+\s*-$", r"^\d+\s*/\s*\d+$",
    r"^第\s*\d+\s*页", r"(?i)^seite\s+\d+", r"(?i)^p[aáÁ]gina\s+\d+",
]
HEADER = r"^#{1,3}\s+.{15,}$"
FOOTER = ["[©®™]", r"(^|[^0-9\p{L}_])\d{4}([^0-9\p{L}_].*[^0-9\p{L}_]|[^0-9\p{L}_])\d{4}($|[^0-9\p{L}_])", r"(?i)all\s+rights?\s+reserved", "版权|著作权|保留.*权利"]
PREFIXED = r"^([ivxlcdmIVXLCDM]+|\d{1,4})\s+(.{10,80})$"
WATERMARK = [r"(?i)(licensed|authorized)\s+(use|to)", r"(?i)downloaded\s+(on|from|at)", r"(?i)restrictions?\s+apply"]
SENTENCE_ENDS = "[.?!。？！]$"
STARTERS = [
    r"(?i)^(the|this|these|those|a|an|in|on|at|for|with|by|from)\s+", r"(?i)^(if|when|while|although|because|since|after|before)\s+",
    r"(?i)^(note|example|figure|table|see|refer)\s*[:\-]?\s*\d*",
]
CODE_PAGE_NUMBER = [r"^\s*\d{1,4}\s*$", r"^\s*\d{1,4}\.\s*$", r"(?i)^\s*[ivxlcdm]+\s*$", r"^\s*-\s*\d+\s*-\s*$", r"(?i)^\s*page\s+\d+\s*$"]
CODE_FURNITURE = [
    r"(?i)copyright\s*[©®]\s*\d{4}", r"[©®]\s*\d{4}", r"(?i)downloaded\s+on\s+\w+\s+\d+,?\s*\d{4}\s+at\s*\d+:\d+",
    r"(?i)(university|college|institute).*downloaded", r"(?i)authorized.*university",
]
STRONG_CODE = [r"[;{}()\[\]]", ":=|<=|=>", r'"\s*&\s*', r"^\s*(--|//|#)"]
KEYWORD_GROUPS = [
    (["authorized", "licensed", "use", "limited"], 3), (["authorized", "licensed", "university"], 3), (["downloaded", "from", "utc", "restrictions"], 3),
    (["restrictions", "apply"], 2), (["ieee", "standard", "for"], 3), (["ieee", "standard", "test", "access"], 4), (["ieee", "standard", "boundary", "scan"], 4),
    (["standard", "for", "test", "access", "port"], 5), (["standard", "boundary", "scan", "architecture"], 4), (["standard", "for", "systemverilog"], 3),
    (["standard", "unified", "hardware", "design"], 4),
]


def _totals(lines: DataFrame) -> DataFrame:
    return lines.groupBy("book").agg(F.count("*").alias("total"))


def exact_frequency(lines: DataFrame) -> DataFrame:
    """Lines that repeat: longer than 3, at least max(5, total / 100) times."""
    rows = lines.select("book", "line_no", strip("line").alias("text")).where(F.length("text") > 3)
    groups = rows.groupBy("book", "text").agg(F.count("*").alias("count"), F.min("line_no").alias("first_line")).join(_totals(lines), "book")
    groups = groups.where(F.col("count") >= F.greatest(F.lit(LEAST), F.expr("total div 100")))
    confidence = F.least(F.lit(0.9), 0.4 + F.col("count") / F.col("total") * 50 + F.col("count") / 100 * 0.3)
    return groups.select("book", F.lit(0).alias("seq"), "text", F.lit("exact").alias("pattern_type"), "count", confidence.alias("confidence"), "first_line", F.array().cast("array<string>").alias("variants"))


def positions(lines: DataFrame, found: DataFrame) -> DataFrame:
    """book, text, line_numbers of found texts."""
    rows = lines.select("book", "line_no", strip("line").alias("text")).join(found.select("book", "text"), ["book", "text"])
    return rows.groupBy("book", "text").agg(F.array_sort(F.collect_list("line_no")).alias("line_numbers"))


def _first_texts(rows: DataFrame, groups: DataFrame, text: str, most: int) -> DataFrame:
    """book, norm, variants: the different ones of a group's first texts.  Only
    groups that count are looked at again."""
    nth = F.row_number().over(Window.partitionBy("book", "norm").orderBy("line_no"))
    some = rows.join(groups.select("book", "norm"), ["book", "norm"], "left_semi").withColumn("nth", nth).where(F.col("nth") <= most)
    return some.groupBy("book", "norm").agg(F.array_sort(F.collect_set(text)).alias("variants"))


def normalised_frequency(lines: DataFrame) -> DataFrame:
    """Lines that repeat but for numbers, at least max(5, total / 100) times;
    variants: different ones of the first ten."""
    rows = lines.select("book", "line_no", strip("line").alias("text")).where(F.length("text") > 3).withColumn("norm", normalised(F.col("text"))).where("norm <> text")
    groups = rows.groupBy("book", "norm").agg(F.count("*").alias("count"), F.min("line_no").alias("first_line"), F.min_by("text", "line_no").alias("text")).where(F.col("count") >= LEAST)
    groups = groups.join(_totals(lines), "book").where(F.col("count") >= F.expr("total div 100"))
    confidence = F.least(F.lit(0.85), 0.35 + F.col("count") / F.col("total") * 50 + F.col("count") / 100 * 0.3)
    out = groups.join(_first_texts(rows, groups, "text", 10), ["book", "norm"])
    return out.select("book", F.lit(1).alias("seq"), "text", F.lit("normalized").alias("pattern_type"), "count", confidence.alias("confidence"), "first_line", "variants")


def similar_lines(lines: DataFrame) -> DataFrame:
    """Clusters of similar lines: greedy leaders among at most 500 lines of a
    book, so a group is bounded (Ratcliff-Obershelp, 0.75)."""
    rows = lines.select("book", "line_no", strip("line").alias("text")).groupBy("book", "text").agg(F.count("*").alias("count"), F.min("line_no").alias("first_line"))
    ok = (F.length("text") > 10) & (F.length("text") < 200)
    several = rows.withColumn("many", F.sum((ok & (F.col("count") >= 2)).cast("int")).over(windows.whole()))
    rank = F.row_number().over(windows.whole().orderBy(F.desc("count"), "first_line"))
    top = several.withColumn("rank", rank).where(ok & F.when(F.col("many") > CANDIDATES, F.col("rank") <= CANDIDATES).otherwise(F.col("count") >= 2))
    top = top.withColumn("place", F.when(F.col("many") > CANDIDATES, F.col("rank")).otherwise(F.col("first_line")))

    def cluster(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place")
        texts, leaders, of = frame["text"].tolist(), [], []
        counts = np.array([np.bincount(np.frombuffer(t.encode("utf-32-le"), "<u4") % 64, minlength=64) for t in texts], np.int16)
        lengths, matcher = np.array([len(t) for t in texts]), SequenceMatcher(None)
        for i, text in enumerate(texts):
            matcher.set_seq2(text)  # what is learned of the second text is kept
            # characters in common bound what two texts can agree in
            common = np.minimum(counts[leaders], counts[i]).sum(1) if leaders else []
            for j, n in zip(leaders, common, strict=True):
                if 2 * n >= CLUSTER * (lengths[i] + lengths[j]):
                    matcher.set_seq1(texts[j])
                    if matcher.ratio() >= CLUSTER:
                        of.append(j)
                        break
            else:
                leaders.append(i)
                of.append(i)
        return pd.DataFrame({"book": frame["book"], "text": texts, "count": frame["count"], "first_line": frame["first_line"], "cluster": of})

    members = top.groupBy("book").applyInPandas(cluster, "book string, text string, count long, first_line int, cluster int")
    sizes = members.groupBy("book", "cluster").agg(
        F.sum("count").alias("count"), F.count("*").alias("lines"), F.max_by("text", F.struct("count", -F.col("first_line"))).alias("text"), F.min("first_line").alias("first_line"), F.array_sort(F.collect_list("text")).alias("variants")
    ).where((F.col("count") >= LEAST) & (F.col("lines") >= 2)).join(_totals(lines), "book")
    return sizes.select("book", F.lit(2).alias("seq"), "text", F.lit("similar").alias("pattern_type"), "count", F.least(F.lit(0.8), 0.3 + F.col("count") / F.col("total") * 5).alias("confidence"), "first_line", "variants")


def prefixed_footers(lines: DataFrame) -> DataFrame:
    """Page number and a repeating rest; the most frequent rest represents (first on ties)."""
    rows = lines.select("book", "line_no", strip("line").alias("full")).where(F.col("full").rlike(PREFIXED))
    rows = rows.withColumn("text", F.regexp_extract("full", PREFIXED, 2)).withColumn("norm", F.regexp_replace("text", r"\d+", "{N}"))
    texts = rows.groupBy("book", "norm", "text").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    best = texts.groupBy("book", "norm").agg(F.sum("n").alias("count"), F.max_by("text", F.struct("n", -F.col("first"))).alias("text"), F.min("first").alias("first_line"))
    groups = best.where(F.col("count") >= LEAST).join(_totals(lines), "book")
    out = groups.join(_first_texts(rows, groups, "full", 20), ["book", "norm"])
    return out.select("book", F.lit(3).alias("seq"), "text", F.lit("footer").alias("pattern_type"), "count", F.least(F.lit(0.8), 0.4 + F.col("count") / F.col("total") * 30).alias("confidence"), "first_line", "variants")


def deduplicated(found: DataFrame) -> DataFrame:
    """The pattern of each lower-cased text with the highest confidence, the
    earlier detector on ties."""
    best = Window.partitionBy("book", F.lower(strip("text"))).orderBy(F.desc("confidence"), "seq", "first_line", "text")
    return found.withColumn("n", F.row_number().over(best)).where("n = 1").drop("n")


def ordered(found: DataFrame) -> DataFrame:
    """Patterns with ``place``: by confidence and count, falling, then by detector."""
    order = Window.partitionBy("book").orderBy(F.desc("confidence"), F.desc("count"), "seq", "first_line", "text")
    return found.withColumn("place", F.row_number().over(order))


def detect(lines: DataFrame, similar: bool = True) -> DataFrame:
    """Patterns of all detectors (``similar``: with that of similar lines, which
    compares in Python), one for each text, with their place."""
    parts = [exact_frequency(lines), normalised_frequency(lines), *([similar_lines(lines)] if similar else []), prefixed_footers(lines)]
    return ordered(deduplicated(reduce(lambda a, b: a.unionByName(b), parts)))


def page_number(x: Column) -> Column:
    return any_of(x, PAGE_NUMBER)


def likely_header(x: Column, count: Column) -> Column:
    frequent = (count >= 10) & ~x.rlike(SENTENCE_ENDS) & x.rlike(r"^(\p{Lu}|#)")
    return (F.length(x) > 15) & (F.length(x) < 200) & (x.rlike(HEADER) | frequent)


def likely_content(x: Column) -> Column:
    """Text rather than furniture: long, several sentences, or a usual opening."""
    return (F.length(x) > 300) | (F.size(F.split(x, r"[.!?]\s+[A-Z]")) > 2) | (any_of(x, STARTERS) & ~x.rlike(HEADER))


def classify(found: DataFrame) -> DataFrame:
    """The kind by the first rule that holds (else unknown), with its bonus; content gets confidence 0."""
    x, c = strip("text"), F.col("confidence")
    kinds = [("page_number", page_number(x), 0.25), ("header", likely_header(x, F.col("count")), 0.15), ("watermark", any_of(x, WATERMARK), 0.20), ("footer", any_of(x, FOOTER), 0.15)]
    kind, bonus = F.lit("unknown"), F.lit(0.0)
    for name, rule, more in reversed(kinds):
        kind, bonus = F.when(rule, name).otherwise(kind), F.when(rule, more).otherwise(bonus)
    out = found.withColumns({"pattern_type": kind, "confidence": F.least(F.lit(1.0), c + bonus)})
    content = likely_content(x)
    return out.withColumns({"confidence": F.when(content, 0.0).otherwise(F.col("confidence")), "pattern_type": F.when(content, "content").otherwise(F.col("pattern_type"))})


def removable(found: DataFrame) -> DataFrame:
    return found.where((F.col("pattern_type") != "content") & (F.col("confidence") >= MEDIUM))


def _spaced(x: Column) -> Column:
    """Case and spaces that flexible matching ignores; digits must agree."""
    return F.regexp_replace(F.lower(x), r"\s+", " ")


def removal(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Lines with ``reason`` (null: kept): exact text or variant, text but for
    case and spaces, page number, inline footer (the first by place).  ``line``
    is what stays."""
    exact = found.select("book", strip("text").alias("s")).union(found.select("book", F.explode("variants").alias("v")).select("book", strip("v").alias("s"))).distinct().withColumn("exact", F.lit(True))
    typed = found.where(F.col("pattern_type").isin("footer", "header", "watermark"))
    loose = typed.select("book", _spaced(strip("text")).alias("k")).distinct().withColumn("loose", F.lit(True))
    footer = F.when((F.col("pattern_type") == "footer") & (F.length(strip("text")) > 20), F.struct("place", _spaced(strip("text")).alias("f")))
    known = found.groupBy("book").agg(F.max(F.col("pattern_type") == "page_number").alias("pages"), F.transform(F.array_sort(F.collect_list(footer)), lambda x: x["f"]).alias("footers"))
    rows = lines.withColumn("s", strip("line")).withColumn("k", _spaced(F.col("s")))
    rows = rows.join(exact, ["book", "s"], "left").join(loose, ["book", "k"], "left").join(known, "book", "left")
    rows = rows.withColumn("bare", F.regexp_replace("k", r"^([ivxlcdm]+|\d{1,4})?\s*", ""))
    rows = rows.withColumn("hit", F.when(F.size("footers") > 0, F.get(F.filter("footers", lambda f: F.startswith("bare", f) | F.startswith("k", f)), F.lit(0))))
    lead = F.length("k") - F.when(F.startswith("k", "hit"), F.length("k")).otherwise(F.length("bare"))
    rows = rows.withColumn("rest", F.when(F.col("hit").isNotNull(), strip(F.substr(F.regexp_replace("s", r"\s+", " "), lead + F.length("hit") + F.lit(1)))))
    kept = (F.col("s") == "") | F.startswith("s", F.lit("```"))
    reason = (
        F.when(kept, F.lit(None)).when(F.col("exact"), "exact_match").when(F.col("loose"), "regex_pattern")
        .when(F.col("pages") & F.col("s").rlike(r"^([ivxlcdmIVXLCDM]+|\d{1,4})$") & (F.length("s") <= 5), "page_number")
        .when(F.col("rest").isNotNull() & (F.length("rest") <= 10), "inline_footer_removed").when(F.col("rest").isNotNull(), "inline_footer_partial")
    )
    rows = rows.withColumn("reason", reason)
    indent = F.repeat(F.lit(" "), F.length("line") - F.length(lstrip("line")))
    line = F.when(F.col("reason") == "inline_footer_partial", F.concat(indent, F.col("rest"))).otherwise(F.col("line"))
    return rows.select("book", "doc_id", "line_no", line.alias("line"), "reason")


def similarity(rows: DataFrame, found: DataFrame, between: DataFrame | None = None) -> DataFrame:
    """``removal``'s rows with ratio, the likeness of a line that stayed to the
    nearest footer's core.  From 0.80 the line goes, unless it is long and holds
    a known text with more beside it; from 0.50 a model's word decides
    (``between``: book, line_no of lines that it takes for furniture)."""
    core = F.lower(F.regexp_replace(F.regexp_replace(strip("text"), r"^[ivxlcdmIVXLCDM\d]+\s*", ""), r"\d+", ""))
    cores = found.where("pattern_type = 'footer'").select("book", core.alias("core")).where("length(core) > 15").groupBy("book").agg(F.array_sort(F.collect_set("core")).alias("cores"))
    texts = found.select("book", strip("text").alias("v")).union(found.select("book", F.explode("variants").alias("v")).select("book", strip("v")))
    texts = texts.where("v <> ''").groupBy("book").agg(F.array_sort(F.collect_set("v")).alias("texts"))
    out = rows.join(cores, "book", "left").withColumn("s", strip("line"))
    open_ = F.col("reason").isNull() & (F.col("s") != "") & ~F.startswith("s", F.lit("```")) & (F.length("s") < 200)
    out = out.withColumn("norm", F.when(open_ & F.col("cores").isNotNull(), F.regexp_replace(F.lower(F.regexp_replace("s", r"\d+", "")), r"\s+", " ")))
    # twice the shorter length bounds what two texts can have in common
    bound = SIMILAR if between is None else DOUBTFUL
    near = F.filter("cores", lambda c: 2 * F.least(F.length("norm"), F.length(c)) >= bound * (F.length("norm") + F.length(c)))
    out = out.withColumn("near", F.when(F.col("norm").isNotNull(), near)).withColumn("compared", F.coalesce(F.size("near") > 0, F.lit(False)))

    @F.pandas_udf("double")
    def ratio(norm: pd.Series, near: pd.Series) -> pd.Series:
        out, matcher = [], SequenceMatcher(None)
        for x, cs in zip(norm, near, strict=True):
            matcher.set_seq2(x)
            best = 0.0
            for c in cs:
                matcher.set_seq1(c)
                if matcher.quick_ratio() >= max(bound, best):
                    best = max(best, matcher.ratio())
            out.append(best)
        return pd.Series(out, dtype="float64")

    # only the lines that are compared go through Python
    pairs = out.where("compared").select("book", "norm", "near").distinct().withColumn("ratio", ratio("norm", "near")).select("book", "norm", "ratio")
    out = out.join(pairs, ["book", "norm"], "left").withColumn("ratio", F.when(F.col("compared"), F.col("ratio")))
    long = out.where(f"ratio >= {SIMILAR} and length(s) > 80").join(texts, "book")
    beside = F.exists("texts", lambda v: F.contains("s", v) & (F.length(strip(F.replace("s", v, F.lit("")))) > 10))
    spared = long.where(beside).select("book", "line_no", F.lit(True).alias("spared"))
    out = out.join(spared, ["book", "line_no"], "left")
    reason = F.when((F.col("ratio") >= SIMILAR) & F.col("spared").isNull(), "similarity_match")
    if between is not None:
        out = out.join(between.select("book", "line_no", F.lit(True).alias("asked")), ["book", "line_no"], "left")
        reason = reason.when((F.col("ratio") >= DOUBTFUL) & (F.col("ratio") < SIMILAR) & F.col("asked"), "similarity_match+confirmed")
    return out.select("book", "doc_id", "line_no", "line", F.coalesce(reason, F.col("reason")).alias("reason"), "ratio")


def code_furniture(lines: DataFrame) -> DataFrame:
    """Lines inside code with ``reason`` if they are page furniture."""
    marked = fence_mask(lines).withColumn("s", strip("line"))
    inside = F.col("in_code") & ~F.col("is_fence") & (F.length("s") >= 5)
    words = F.array_distinct(F.regexp_extract_all(F.lower("s"), F.lit("([a-z]+)"), F.lit(1)))
    # bound to a name, so that a filter on the reason doesn't read the words anew for each group
    grouped = F.exists(F.array(words), lambda w: reduce(lambda a, b: a | b, (F.size(F.array_intersect(w, F.array(*map(F.lit, group)))) >= least for group, least in KEYWORD_GROUPS)))
    s = F.col("s")
    reason = F.when(any_of(s, CODE_PAGE_NUMBER), "page_number").when(any_of(s, CODE_FURNITURE), "header_footer_pattern").when(~any_of(s, STRONG_CODE) & grouped, "keyword_group")
    return marked.withColumn("reason", F.when(inside, reason)).select("book", "doc_id", "line_no", "line", "reason")


def _neighbours(lines: DataFrame) -> DataFrame:
    """With s and the nearest non-blank lines before and after."""
    rows = lines.withColumn("s", strip("line"))
    full = F.when(F.col("s") != "", F.col("s"))
    return rows.withColumns({"above": windows.last_known(full), "below": windows.next_known(full)})


def merged_code_blocks(lines: DataFrame) -> DataFrame:
    """Lines with ``gone``: a closing fence, blanks and a bare opening fence in a row."""
    rows = _neighbours(fence_mask(lines)).withColumn("nth", F.sum(F.col("is_fence").cast("int")).over(windows.so_far()))
    even, after_fence = (F.col("nth") > 0) & (F.col("nth") % 2 == 0), F.startswith("above", F.lit("```"))
    closing = F.col("is_fence") & even & (F.col("below") == "```")
    opening = (F.col("s") == "```") & (F.col("nth") % 2 == 1) & after_fence
    between = (F.col("s") == "") & even & after_fence & (F.col("below") == "```")
    return rows.withColumn("gone", F.coalesce(closing | opening | between, F.lit(False))).select("book", "doc_id", "line_no", "line", "gone")


def merged_tables(lines: DataFrame) -> DataFrame:
    """Lines with ``gone``: blanks between table rows."""
    row = r"^\|.*\|$"
    gone = (F.col("s") == "") & F.col("above").rlike(row) & F.col("below").rlike(row)
    return _neighbours(lines).withColumn("gone", F.coalesce(gone, F.lit(False))).select("book", "doc_id", "line_no", "line", "gone")


def compressed_blanks(lines: DataFrame, most: int = 2) -> DataFrame:
    """Lines without blanks beyond ``most`` in a row."""
    rows = lines.withColumn("blank", strip("line") == "").withColumn("island", F.sum((~F.col("blank")).cast("int")).over(windows.so_far()))
    nth = F.row_number().over(Window.partitionBy("book", "island", "blank").orderBy("line_no"))
    return rows.withColumn("nth", nth).where(~F.col("blank") | (F.col("nth") <= most)).select("book", "doc_id", "line_no", "line")


def clean(lines: DataFrame, similar: bool = True) -> DataFrame:
    """All stages: detect, classify, remove, code furniture, merges, blanks.
    Line numbers stay those of the input.  ``similar``: with the detector of
    similar lines and the removal of lines similar to a footer."""
    return staged(lines, similar)["clean"]


def staged(lines: DataFrame, similar: bool = True) -> dict[str, DataFrame]:
    """What each stage leaves or takes out: found, removed (with reason),
    furniture (with reason), merged_code, merged_tables and clean."""
    lines = checkpointed(lines)
    found = checkpointed(removable(classify(detect(lines, similar))))
    first = removal(lines, found)
    first = checkpointed(similarity(first, found).drop("ratio") if similar else first)
    code = code_furniture(first.where("reason is null or reason = 'inline_footer_partial'").drop("reason"))
    blocks = merged_code_blocks(code.where("reason is null").drop("reason"))
    tables = merged_tables(blocks.where("not gone").drop("gone"))
    return {
        "found": found, "removed": first.where("reason is not null"), "furniture": code.where("reason is not null"), "merged_code": blocks.where("gone"),
        "merged_tables": tables.where("gone"), "clean": compressed_blanks(tables.where("not gone").drop("gone")),
    }


def audit(lines: DataFrame, similar: bool = True) -> DataFrame:
    """stage, book, line_no, line, reason of what the stages take out."""
    stages = staged(lines, similar)
    shown = {"removed": ("removed", None), "furniture": ("cleanup", None), "merged_code": ("merge", "code_block_merge"), "merged_tables": ("merge", "table_merge_empty")}
    parts = []
    for name, (stage, reason) in shown.items():
        rows = stages[name].withColumn("reason", F.lit(reason)) if reason else stages[name]
        parts.append(rows.select(F.lit(stage).alias("stage"), "book", "line_no", "line", "reason"))
    return reduce(DataFrame.unionByName, parts)


def clean_stats(lines: DataFrame, cleaned: DataFrame) -> DataFrame:
    before, after = _totals(lines), cleaned.groupBy("book").agg(F.count("*").alias("final"))
    out = before.join(after, "book", "left").select("book", F.col("total").alias("original"), F.coalesce("final", F.lit(0)).alias("final"))
    return out.withColumn("removed", F.col("original") - F.col("final")).withColumn("reduction", F.round(100 * F.col("removed") / F.col("original"), 6))


