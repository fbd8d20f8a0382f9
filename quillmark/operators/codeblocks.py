"""Code block checks and repairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.storage import checkpointed
from ..functions.text import any_of, count_chars, rstrip, strip, truncate

# Fixed values of the rules.
PROSE = [
    r"^#{1,6}\s+\w", r"^[A-Z][a-z].{50,}", r"^\|[^|]+\|[^|]+\|", r"^!\[.*\]\(.*\)", r"^\[.*\]\(.*\)$", r"^[-*]\s+[A-Z][a-z].{30,}", r"^\d+\.\s+[A-Z][a-z].{20,}", r"^>\s+[A-Z]",
]
NOT_PROSE = [r"^\s*--", r"^\s*//", r'^\s*"', ";$", r"\{$"]
STRONG = [";", "{", "}", ":=", "<=", "=>", "()", "[]", "->"]
CODE = [
    r"(?i)\b(entity|architecture|port|signal|begin|end\s+\w+|process|component)\b", r"(?i)\b(module|endmodule|wire|reg|assign|always|input|output|inout)\b",
    r"(?i)\b(interface|endinterface|class|endclass|function|endfunction|task|endtask)\b", r"\b(void|int|char|return|struct|typedef|#include|#define)\b",
    r"\b(def\s+\w+|class\s+\w+|import\s+\w+|from\s+\w+\s+import)\b", r":=|<=|=>|==|!=|\+=|-=|\*=|/=|&&|\|\|", r"\w+\s*\([^)]*\)\s*[;{]?$", r'"\s*&\s*$', r'^\s*".*"\s*&',
    r"^\s*(--|//|#([^#]|$)|/\*)", r"(?i)^\s*attribute\s+\w+",
]
MATHS = "MAX|MIN|CLAMP|ABS|ROUND|FLOOR|CEIL"
GAP = 2
#: Characters of an issue's line that are shown.
CONTENT, PROSE_CONTENT = 80, 100


def strong_syntax(x: Column) -> Column:
    out = F.lit(False)
    for s in STRONG:
        out = out | F.contains(x, F.lit(s))
    return out


def pseudo_code(x: Column) -> Column:
    """Formulas of specifications, which look like prose."""
    assigned = x.rlike(r"[A-Za-z_][\w.]*\s*=\s*") & (count_chars(x, "=*()") >= 3)
    return (F.length(x) >= 8) & (x.rlike(rf"(?i)^({MATHS}|MOD|LOG2)\s*\(") | x.rlike(rf"(?i)=\s*({MATHS})\s*\(") | assigned | (count_chars(x, "=*()[]") >= 5) | x.rlike(r"(?i)^where\s*:"))


def narrative(x: Column) -> Column:
    low = F.lower(x)
    the = F.startswith(x, F.lit("The ")) & (F.contains(low, F.lit("are blended")) | F.contains(low, F.lit("value is true when")) | F.contains(low, F.lit("algorithm adjusts")))
    return (F.length(x) >= 40) & (F.startswith(low, F.lit("in addition to responding")) | (F.contains(low, F.lit("referred to as")) & F.contains(x, F.lit("`"))) | the)


def is_prose(x: Column) -> Column:
    """Whether a stripped line is prose that doesn't belong in code."""
    out = (F.length(x) < 15) | pseudo_code(x) | narrative(x) | any_of(x, NOT_PROSE)
    sentence = x.rlike(r"^\p{Lu}") & (F.length(x) > 60) & (F.size(F.split(x, r"\s+")) > 8)
    return ~out & ~strong_syntax(x) & (any_of(x, PROSE) | sentence)


def is_code(x: Column) -> Column:
    return any_of(x, CODE)


def prose_confidence(x: Column) -> Column:
    return F.when(x.rlike(r"^#{1,6}\s") | F.startswith(x, F.lit("|")), "HIGH").when((F.length(x) > 80) & (F.size(F.split(x, r"\s+")) > 10), "MEDIUM").otherwise("LOW")


def _roles(fences: DataFrame) -> DataFrame:
    """book, line_no, role of fences (book, line_no, run): open, close, or null
    where a fence is content.  Where all fences of a book are alike they
    alternate; the others are folded in order, a book at a time."""
    alike = fences.withColumns({"alike": F.min("run").over(windows.whole()) == F.max("run").over(windows.whole()), "nth": F.row_number().over(windows.order())})
    plain = alike.where("alike").select("book", "line_no", F.when(F.col("nth") % 2 == 1, "open").otherwise("close").alias("role"))

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        frame, opener, roles = frame.sort_values("line_no"), "", []
        for run in frame["run"]:
            if not opener:
                opener = run
                roles.append("open")
            elif run[0] == opener[0] and len(run) >= len(opener):
                opener = ""
                roles.append("close")
            else:
                roles.append(None)
        return frame.assign(role=roles)[["book", "line_no", "role"]]

    mixed = alike.where("not alike").select("book", "line_no", "run").groupBy("book").applyInPandas(fold, "book string, line_no int, role string")
    return plain.unionByName(mixed)


def typed_fences(lines: DataFrame) -> DataFrame:
    """Lines with s (stripped), fence, indented, role and in_code by typed
    fences: up to 3 spaces, 3 or more of one mark; a closer has the opener's
    mark and at least its length, whatever follows."""
    rows = lines.withColumns({"s": strip("line"), "run": F.regexp_extract("line", "^ {0,3}(`{3,}|~{3,})", 1)})
    roles = _roles(rows.where("run <> ''").select("book", "line_no", "run"))
    rows = rows.join(roles, ["book", "line_no"], "left").withColumns({"fence": F.col("run") != "", "indented": F.col("line").rlike("^( {4,}|\t+)(`{3,}|~{3,})")})
    depth = F.sum(F.when(F.col("role") == "open", 1).when(F.col("role") == "close", -1).otherwise(0)).over(windows.so_far())
    return rows.withColumn("in_code", (depth > 0) | (F.coalesce("role", F.lit("")) == "close")).drop("run")


def indented_fences(marked: DataFrame) -> DataFrame:
    """book, line_no, confidence of fences behind four spaces or a tab, by the code around them."""
    code = F.coalesce(is_code(F.col("s")), F.lit(False))
    rows = marked.withColumn("code", code).withColumns({"up": F.lag("code").over(windows.order()), "down": F.lead("code").over(windows.order())}).where("indented")
    n = F.coalesce("up", F.lit(False)).cast("int") + F.coalesce("down", F.lit(False)).cast("int")
    return rows.select("book", "doc_id", "line_no", F.when(n == 2, "HIGH").when(n == 1, "MEDIUM").otherwise("LOW").alias("confidence"), F.substring(rstrip("line"), 1, CONTENT).alias("content"))


def prose_in_code(marked: DataFrame) -> DataFrame:
    """book, line_no, confidence of prose inside code."""
    rows = marked.where("in_code and not fence and not indented").where(is_prose(F.col("s")))
    return rows.select("book", "doc_id", "line_no", prose_confidence(F.col("s")).alias("confidence"), F.substring("s", 1, PROSE_CONTENT).alias("content"))


def code_outside(marked: DataFrame) -> DataFrame:
    """book, line_no of code outside of code blocks (candidates, all of medium confidence)."""
    rows = marked.where("not in_code and not fence and not indented")
    rows = rows.where(is_code(F.col("s")) & (F.length("s") > 15) & (count_chars(F.col("s"), "|") < 2))
    return rows.select("book", "doc_id", "line_no", F.lit("MEDIUM").alias("confidence"), F.substring("s", 1, PROSE_CONTENT).alias("content"))


def unclosed(marked: DataFrame) -> DataFrame:
    """book, line_no of the opener of a block that never ends."""
    last = marked.where("role is not null").groupBy("book").agg(F.max(F.struct("line_no", "role", "line")).alias("m")).where("m.role = 'open'")
    return last.select("book", "m.line_no", F.lit("HIGH").alias("confidence"), F.substring(rstrip("m.line"), 1, CONTENT).alias("content"))


def issues(marked: DataFrame, outside: bool = False) -> DataFrame:
    """book, line_no, type, confidence, content of all issues; code outside of
    blocks, which is often right, only where asked for."""
    kinds = {"indented_fence": indented_fences(marked), "prose_in_code": prose_in_code(marked), "unclosed_block": unclosed(marked)}
    if outside:
        kinds["code_outside"] = code_outside(marked)
    parts = [f.select("book", "line_no", F.lit(k).alias("type"), "confidence", "content") for k, f in kinds.items()]
    return reduce(DataFrame.unionByName, parts)


def verified(found: DataFrame, answers: DataFrame, threshold: str = "MEDIUM") -> DataFrame:
    """Issues at the threshold or above, and of the others those that a model
    holds to be real (book, line_no, type, is_issue, confidence: more than half)."""
    rank = lambda x: F.when(x == "HIGH", 3).when(x == "MEDIUM", 2).otherwise(1)
    real = answers.where("is_issue and confidence > 0.5").select("book", "line_no", "type").distinct()
    sure = rank(F.col("confidence")) >= rank(F.lit(threshold))
    return found.where(sure).unionByName(found.where(~sure).join(real, ["book", "line_no", "type"], "left_semi").select(found.columns))


def issue_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("type", "confidence").agg(F.count("*").alias("n"))


def shown(found: DataFrame, most: int = 30) -> DataFrame:
    """The first issues of each book, cut short, as a report shows them."""
    order = Window.partitionBy("book").orderBy("line_no", "type")
    return found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).drop("nth").withColumn("content", truncate(F.col("content")))


def prose_groups(found: DataFrame, gap: int = GAP) -> DataFrame:
    """book, first_line, last_line, n of prose issues at most ``gap`` lines apart."""
    new = (F.col("line_no") - F.coalesce(F.lag("line_no").over(windows.order()), F.lit(-10)) > gap).cast("int")
    rows = found.withColumn("new", new).withColumn("group", F.sum("new").over(windows.so_far()))
    return rows.groupBy("book", "group").agg(F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"), F.count("*").alias("n"))


def surrounding(lines: DataFrame, found: DataFrame, radius: int = 2) -> DataFrame:
    """book, line_no, around: lines near an issue with their numbers, its own
    marked, 70 characters of each."""
    near = found.select("book", F.col("line_no").alias("at")).withColumn("line_no", F.explode(F.sequence(F.col("at") - radius, F.col("at") + radius)))
    mark = F.when(F.col("line_no") == F.col("at"), ">>>").otherwise("   ")
    rows = near.join(lines, ["book", "line_no"]).withColumn("shown", F.format_string("%s %5d: %s", mark, "line_no", F.substring(rstrip("line"), 1, 70)))
    sorted_ = F.array_sort(F.collect_list(F.struct("line_no", "shown")))
    return rows.groupBy("book", "at").agg(sorted_.alias("x")).select("book", F.col("at").alias("line_no"), F.array_join(F.transform("x", lambda s: s["shown"]), "\n").alias("around"))


def without_adjacent_fences(lines: DataFrame) -> DataFrame:
    """Lines without pairs of bare fences (a mark and one word at most) of one
    kind that only blanks part, from the left."""
    s = strip("line")
    kind = F.when(s != "", F.substring(F.regexp_extract(s, r"^(`{3,}|~{3,})[\p{L}\p{N}_]*$", 1), 1, 1))  # null: blank
    rows = lines.withColumn("kind", kind)
    rows = rows.withColumns({"above": windows.last_known("kind"), "below": windows.next_known("kind")})
    fence, starts = F.col("kind") != "", F.coalesce("above", F.lit("")) != F.col("kind")
    rows = rows.withColumn("nth", F.sum(fence.cast("int")).over(windows.so_far()))
    rows = rows.withColumn("start", F.last(F.when(fence & starts, F.col("nth")), True).over(windows.so_far()))
    # place within the run of fences of one kind; an odd one has a partner if such a fence comes next
    place = F.col("nth") - F.col("start")
    first = F.coalesce(fence & (place % 2 == 0) & (F.col("below") == F.col("kind")), F.lit(False))
    second = F.coalesce(fence & (place % 2 == 1), F.lit(False))
    between = F.col("kind").isNull() & (F.col("above") != "") & (place % 2 == 0) & (F.col("below") == F.col("above"))
    return rows.where(~(first | second | F.coalesce(between, F.lit(False)))).select(*lines.columns)


def repaired(lines: DataFrame, single_lines: str = "compat", accept: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Indented fences moved left, prose groups taken out of code, open blocks
    closed, adjacent fences removed.  ``single_lines``: compat puts both fences
    before a group of one line, where they vanish; wrap treats it like others.  ``accept`` filters issues
    (a provider's judgement); the default accepts all.  Books without issues
    stay as they are."""
    marked = typed_fences(lines)
    if accept:
        marked = checkpointed(marked)
        found = accept(issues(marked)).groupBy("book", "line_no").agg(F.collect_set("type").alias("types"))
        marked = marked.join(found, ["book", "line_no"], "left")
        of = lambda kind: F.coalesce(F.array_contains("types", kind), F.lit(False))
        marked = marked.withColumns({"left": of("indented_fence"), "prose": of("prose_in_code"), "unclosed": of("unclosed_block")})
    else:
        last = F.max(F.when(F.col("role").isNotNull(), F.struct("line_no", "role"))).over(windows.whole())
        prose = F.col("in_code") & ~F.col("fence") & ~F.col("indented") & is_prose(F.col("s"))
        marked = marked.withColumns({"left": F.col("indented"), "prose": F.coalesce(prose, F.lit(False)), "last": last})
        marked = marked.withColumn("unclosed", F.coalesce((F.col("last.role") == "open") & (F.col("last.line_no") == F.col("line_no")), F.lit(False)))
    at = F.when(F.col("prose"), F.col("line_no"))
    rows = marked.withColumns({"up": windows.last_known(at), "down": windows.next_known(at)})
    starts = F.col("prose") & (F.col("line_no") - F.coalesce("up", F.lit(-10)) > GAP)
    stops = F.col("prose") & (F.coalesce("down", F.lit(1 << 30)) - F.col("line_no") > GAP)
    alone = starts & stops if single_lines == "compat" else F.lit(False)
    ever = lambda x: F.max(x).over(windows.whole())
    rows = rows.withColumns({"starts": starts, "alone": alone, "stops": stops & ~alone, "touched": ever(F.col("left") | F.col("prose") | F.col("unclosed")), "closes": ever(F.col("unclosed")) & (F.col("line_no") == ever(F.col("line_no")))})
    line = F.when(F.col("left"), strip("line")).otherwise(F.col("line"))
    added = lambda x: F.when(x, F.lit("```"))
    # a group of one line gets both fences before it; they go again as a pair, or with a fence above
    parts = F.array_compact(F.array(added(F.col("starts")), added(F.col("alone")), line, added(F.col("stops")), added(F.col("closes"))))
    rows = rows.select("book", "doc_id", "line_no", "touched", F.posexplode(parts).alias("part", "line"))
    order = Window.partitionBy("book").orderBy("line_no", "part")
    rows = checkpointed(rows.select("book", "doc_id", "touched", F.row_number().over(order).alias("line_no"), "line"))
    left = without_adjacent_fences(rows.where("touched")).unionByName(rows.where("not touched"))
    return left.select("book", "doc_id", F.row_number().over(windows.order()).alias("line_no"), "line")
