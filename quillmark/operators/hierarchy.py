"""Heading levels from numbering, inline sections and context."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.text import any_of, strip
from .structure import headings

# Fixed values of the rules.
INLINE_TITLES = [
    "rules", "rule", "permissions", "permission", "recommendations", "recommendation", "requirements", "requirement", "notes", "note", "warnings", "warning",
    "examples", "example", "exceptions", "exception", "constraints", "constraint", "definitions", "definition", "objectives", "objective", "procedures", "procedure",
    "options", "option", "general", "overview", "background", "rationale", "discussion", "description", "syntax", "semantics", "inputs", "outputs", "parameters", "return value",
]
PAGE_HEADINGS = [
    r"(?i)^ieee\s+std\s+[\d.\-]+", r"(?i)^iso\s+[\d.\-]+", r"(?i)^iso/iec\s+[\d.\-]+", r"(?i)^[a-z]+\s+standard\s+for", r"^\d+$", r"(?i)^page\s+\d+", r"^-\s*\d+\s*-$",
    "(?i)standard for", r"(?i)^ieee\s+", "(?i)^iso",
]
DOCUMENT_TITLES = ["standard for", "ieee standard", "iso standard", "specification", "draft", "revision"]
TOP_SECTIONS = ["abstract", "foreword", "introduction", "scope", "normative references", "terms and definitions", "bibliography", "annex", "important notice", "acknowledgments", "overview"]
#: (pattern, level, confidence), first match wins; numbering is group 1.
NUMBERINGS = [
    (r"^(\d+\.\d+\.\d+\.\d+\.\d+)\s+.+$", 6, 0.95), (r"^(\d+\.\d+\.\d+\.\d+)\s+.+$", 5, 0.95), (r"^(\d+\.\d+\.\d+)\s+.+$", 4, 0.95), (r"(?i)^([a-z]\.\d+\.\d+)\s+.+$", 4, 0.90),
    (r"^(\d+\.\d+)\s+.+$", 3, 0.95), (r"(?i)^([a-z]\.\d+)\s+.+$", 3, 0.90), (r"^(\d+\.)\s+.+$", 2, 0.95), (r"(?i)^(?:annex\s+)?([a-z]\.)\s+.+$", 2, 0.90),
]
FIGURE = r"(?i)^(figure|table|example)\s+\d+"


def numbered(found: DataFrame) -> DataFrame:
    """Headings with rule_level (-1: none), numbering and confidence from their titles."""
    title = F.col("title")
    level, number, sure = F.lit(-1), F.lit(""), F.when(title.rlike(FIGURE), 0.5).otherwise(0.0)
    for pattern, at, confidence in reversed(NUMBERINGS):
        hit = title.rlike(pattern)
        level, number, sure = F.when(hit, at).otherwise(level), F.when(hit, F.regexp_extract(title, pattern, 1)).otherwise(number), F.when(hit, confidence).otherwise(sure)
    return found.withColumns({"rule_level": level, "numbering": number, "confidence": sure})


def polluted(found: DataFrame) -> DataFrame:
    """With occurrences, and polluted: repeats, after the first, of titles that look like page headers."""
    same = Window.partitionBy("book", F.lower(strip("title")))
    rows = found.withColumns({"occurrences": F.count("*").over(same), "nth": F.row_number().over(same.orderBy("line_no"))})
    return rows.withColumn("polluted", (F.col("occurrences") > 1) & any_of(F.col("title"), PAGE_HEADINGS) & (F.col("nth") > 1)).drop("nth")


def inline_title(title):
    """Whether a title names an unnumbered part of a section."""
    norm = strip(F.regexp_replace(F.lower(strip(title)), "[:;.,]+$", ""))
    word, names = F.regexp_extract(norm, r"^(\S+)", 1), INLINE_TITLES
    rest = strip(F.substr(norm, F.length(word) + F.lit(1)))
    plain = lambda x: x.isin(names) | F.regexp_replace(x, "s+$", "").isin(names)
    return plain(norm) | (plain(word) & ((rest == "") | rest.rlike("^[a-z0-9]+$")))


def skeleton(found: DataFrame) -> DataFrame:
    """With the nearest numbered heading before and after (level, numbering)."""
    rows = polluted(numbered(found)).withColumn("is_rule", (F.col("confidence") > 0.8) & ~F.col("polluted"))
    mark = F.when(F.col("is_rule"), F.struct(F.col("rule_level").alias("level"), "numbering"))
    rows = rows.withColumns({"before": windows.last_known(mark), "after": windows.next_known(mark), "idx": F.row_number().over(windows.order()) - 1})
    return rows.withColumns({"prev_level": F.col("before.level"), "prev_numbering": F.col("before.numbering"), "next_level": F.col("after.level"), "next_numbering": F.col("after.numbering")}).drop("before", "after")


def levels(found: DataFrame, base: int = 1) -> DataFrame:
    """Headings with new_level, method (rule, inline, context) and confidence."""
    rows = skeleton(found).withColumn("inline", inline_title(F.col("title")))
    title, under = F.lower("title"), F.coalesce(F.col("prev_level") + 1, F.lit(base))
    has = lambda names: any_of(title, names)
    early = (F.col("idx") == 0) | ((F.col("idx") < 3) & F.col("prev_level").isNull())
    child = F.when(F.col("prev_level").isNotNull(), F.least(under, F.lit(6))).otherwise(F.when(F.col("idx") == 0, base).otherwise(base + 1))
    context = F.when(has(DOCUMENT_TITLES), F.when(early, base).otherwise(F.greatest(under, F.lit(base + 1)))).when(has(TOP_SECTIONS), F.least(F.greatest(under, F.lit(base + 1)), F.lit(6))).otherwise(child)
    sure = F.when(has(DOCUMENT_TITLES), 0.7).when(has(TOP_SECTIONS), 0.6).when(F.col("prev_level").isNotNull(), 0.5).otherwise(0.3)
    within = F.coalesce(F.least(F.col("prev_level") + 1, F.lit(6)), F.lit(base + 1))
    method = F.when(F.col("polluted"), "removed").when(F.col("is_rule"), "rule").when(F.col("inline"), "inline").otherwise("context")
    rows = rows.withColumn("method", method)
    pick = lambda rule, inline, other: F.when(F.col("method") == "rule", rule).when(F.col("method") == "inline", inline).when(F.col("method") == "context", other)
    new = F.when(F.col("method") != "removed", F.least(pick(F.col("rule_level"), within, context), F.lit(6)))
    trust = pick(F.col("confidence"), F.when(F.col("prev_level").isNull(), 0.6).otherwise(0.85), sure)
    parent = F.when(F.col("method") == "inline", F.col("prev_numbering"))
    return rows.withColumns({"new_level": F.coalesce(new, F.col("level")), "confidence": F.coalesce(trust, F.lit(0.0)), "parent_section": parent})


def rewritten(lines: DataFrame, base: int = 1) -> DataFrame:
    """Lines with headings at their new levels; a removed heading takes one
    following blank with it."""
    marks = levels(headings(lines), base).select("book", "line_no", "new_level", "title", "polluted")
    rows = lines.join(marks, ["book", "line_no"], "left").withColumn("polluted", F.coalesce("polluted", F.lit(False)))
    rows = rows.withColumn("skip", F.coalesce(F.lag("polluted").over(windows.order()), F.lit(False)) & (strip("line") == ""))
    line = F.when(F.col("new_level").isNotNull(), F.concat(F.repeat(F.lit("#"), F.col("new_level")), F.lit(" "), F.col("title"))).otherwise(F.col("line"))
    return rows.where("not polluted and not skip").select("book", "doc_id", "line_no", line.alias("line"))


def hierarchy_stats(found: DataFrame) -> DataFrame:
    """book, total, fixed, and headings by method."""
    n = lambda c: F.sum(c.cast("long"))
    rows = levels(found)
    return rows.groupBy("book").agg(F.count("*").alias("total"), n((F.col("new_level") != F.col("level")) & ~F.col("polluted")).alias("fixed"), *(n(F.col("method") == m).alias(m) for m in ("rule", "inline", "context", "removed")))
