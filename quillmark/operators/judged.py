"""Decisions that a model takes where the rules are unsure.

Each comes as prompts (a table with the keys of what is asked) and as the
reading of answers (the same keys and the answer), so that answers can be kept,
recorded or made up; without an answer the rule's decision stands."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import providers, windows
from ..functions.text import strip
from . import codeblocks, hierarchy, patterns, structure

CLASSES = ("HEADER", "FOOTER", "PAGE_NUMBER", "WATERMARK")
#: Attempts at a summary and their temperatures.
TEMPERATURES = (0.15, 0.30, 0.35)
SHORT = 50


def ask(prompts: DataFrame, provider: Callable[[], providers.TextModel], known: DataFrame | None = None, **more) -> DataFrame:
    """``prompts`` with their answers."""
    return prompts.join(providers.answers(prompts, provider, known, **more).select("prompt", "answer"), "prompt", "left")


def doubtful(found: DataFrame) -> DataFrame:
    """Patterns of middling confidence with ``key``, their number in the order of patterns, as text."""
    order = F.row_number().over(windows.whole().orderBy("place"))
    rows = found.where((F.col("confidence") >= patterns.MEDIUM) & (F.col("confidence") < patterns.HIGH))
    return rows.withColumn("key", order.cast("string"))


def pattern_prompts(found: DataFrame) -> DataFrame:
    """book, prompt: one for all doubtful patterns of a book."""
    shown = F.struct(F.col("key").cast("int").alias("n"), F.concat("key", F.lit('. "'), F.substring("text", 1, 100), F.lit('"')).alias("line"))
    rows = doubtful(found).groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(shown)), lambda x: x["line"]), "\n").alias("lines"))
    text = "Lines that repeat in a document. Say for each number whether it is HEADER, FOOTER, PAGE_NUMBER, WATERMARK or CONTENT, as a JSON object from number to word.\n"
    return rows.select("book", F.concat(F.lit(text), "lines").alias("prompt"))


def validated(found: DataFrame, answers: DataFrame) -> DataFrame:
    """Patterns with the doubtful ones as answers (book, answer: JSON from key
    to class) have it: furniture gains 0.2, content loses 0.3, both get that type."""
    read = F.from_json(F.regexp_extract("answer", r"(?s)\{.*\}", 0), "map<string,string>")
    given = answers.select("book", F.explode(read).alias("key", "class")).withColumn("class", F.upper("class"))
    keys = doubtful(found).select("book", "place", "key").join(given, ["book", "key"]).select("book", "place", "class")
    rows = found.join(keys, ["book", "place"], "left")
    known, content = F.col("class").isin(*CLASSES), F.col("class") == "CONTENT"
    confidence = F.when(known, F.least(F.lit(1.0), F.col("confidence") + 0.2)).when(content, F.greatest(F.lit(0.0), F.col("confidence") - 0.3)).otherwise(F.col("confidence"))
    kind = F.when(known, F.lower("class")).when(content, "content").otherwise(F.col("pattern_type"))
    return rows.withColumns({"confidence": confidence, "pattern_type": kind}).drop("class").select(found.columns)


def confirmed(found: DataFrame, choices: DataFrame) -> DataFrame:
    """Patterns that a person kept: choices (book, place, choice) n leaves one
    out, q it and all later ones."""
    stop = choices.where("lower(choice) = 'q'").groupBy("book").agg(F.min("place").alias("stop"))
    no = choices.where("lower(choice) = 'n'").select("book", "place").distinct()
    return found.join(no, ["book", "place"], "left_anti").join(stop, "book", "left").where("stop is null or place < stop").select(found.columns)


def line_prompts(lines: DataFrame) -> DataFrame:
    """book, line_no, prompt for lines of their own."""
    text = "Is this line of a document HEADER, FOOTER, PAGE_NUMBER, WATERMARK or CONTENT? Answer with the word only.\n"
    return lines.select("book", "line_no", F.concat(F.lit(text), F.substring(strip("line"), 1, 150)).alias("prompt"))


def line_class(answer: Column) -> Column:
    """The first class that an answer names, in small letters; content if none."""
    out, upper = F.lit("content"), F.upper(F.coalesce(answer, F.lit("")))
    for name in reversed((*CLASSES, "CONTENT")):
        out = F.when(F.contains(upper, F.lit(name)), name.lower()).otherwise(out)
    return out


def furniture_lines(answers: DataFrame) -> DataFrame:
    """book, line_no of answers (book, line_no, answer) that name furniture."""
    return answers.where(line_class(F.col("answer")) != "content").select("book", "line_no")


def issue_prompts(lines: DataFrame, found: DataFrame) -> DataFrame:
    """book, line_no, type, prompt for issues of low confidence."""
    low = found.where("confidence = 'LOW'")
    around = codeblocks.surrounding(lines, low.select("book", "line_no").distinct(), 3)
    text = F.concat(F.lit("Is this a real fault of the kind "), "type", F.lit('? Answer with a JSON object {"is_issue": true or false, "confidence": 0 to 1}.\n'), "around")
    return low.join(around, ["book", "line_no"]).select("book", "line_no", "type", text.alias("prompt"))


def issue_answers(answers: DataFrame) -> DataFrame:
    """book, line_no, type, is_issue, confidence of answers; one that can't be
    read counts as no issue."""
    read = F.from_json(F.regexp_extract("answer", r"(?s)\{.*\}", 0), "is_issue boolean, confidence double")
    rows = answers.withColumn("read", read)
    return rows.select("book", "line_no", "type", F.coalesce("read.is_issue", F.lit(False)).alias("is_issue"), F.coalesce("read.confidence", F.lit(0.0)).alias("confidence"))


def heading_prompts(found: DataFrame, base: int = 1) -> DataFrame:
    """book, line_no, prompt for headings that neither number nor usual title settles."""
    rows = hierarchy.levels(found, base)
    shown = F.concat(F.when(F.col("method").isin("rule", "inline"), F.concat(F.lit("H"), F.col("new_level").cast("string"))).otherwise("?"), F.lit(" "), "title")
    all_ = rows.groupBy("book").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", shown.alias("x")))), lambda s: s["x"]), "\n").alias("all"))
    least = F.coalesce(F.col("prev_level") + 1, F.lit(base))
    text = F.concat(F.lit("Headings of a document with their levels:\n"), "all", F.lit("\n\nWhich level has the heading: "), "title", F.lit("\nAnswer with a number from "), least.cast("string"), F.lit(" to 6 only."))
    return rows.where("method = 'context'").join(all_, "book").select("book", "line_no", text.alias("prompt"))


def judged_levels(found: DataFrame, answers: DataFrame, base: int = 1) -> DataFrame:
    """Levels where answers (book, line_no, answer) name one for headings that
    the rules can't settle: no less than one below the numbered heading before,
    no more than 6, with confidence 0.75; an answer without a level leaves the
    context's."""
    level = F.nullif(F.regexp_extract("answer", "[1-6]", 0), F.lit("")).cast("int")
    rows = hierarchy.levels(found, base).join(answers.select("book", "line_no", level.alias("said")), ["book", "line_no"], "left")
    takes = (F.col("method") == "context") & F.col("said").isNotNull()
    new = F.least(F.greatest("said", F.coalesce(F.col("prev_level") + 1, F.lit(base))), F.lit(6))
    return rows.withColumns({"new_level": F.when(takes, new).otherwise(F.col("new_level")), "confidence": F.when(takes, 0.75).otherwise(F.col("confidence")), "method": F.when(takes, "llm").otherwise(F.col("method"))}).drop("said")


def summary_prompts(parts: DataFrame, most: int | None = None) -> DataFrame:
    """book, id, prompt for chunks long enough for a summary."""
    content = F.col("content") if most is None else F.when(F.length("content") > most, F.concat(F.substring("content", 1, most), F.lit("\n...[truncated]"))).otherwise(F.col("content"))
    text = F.concat(F.lit('Summarise the section in one sentence and give up to five keywords, as a JSON object {"summary": "", "keywords": []}.\n\nTitle: '), "title", F.lit("\n\n"), content)
    return parts.where(F.length(strip("content")) >= SHORT).select("book", "id", text.alias("prompt"))


def has_summary(answer: str) -> bool:
    return bool(providers.summary_of(providers.extract_json(answer) or {})[0])


def summaries(parts: DataFrame, provider: Callable[[], providers.TextModel], known: DataFrame | None = None, most: int | None = None) -> DataFrame:
    """book, id, summary, keywords of chunks: a model's, asked up to three times;
    empty for short chunks and where no attempt gives a summary."""
    asked = ask(summary_prompts(parts, most), provider, known, temperatures=TEMPERATURES, accept=has_summary)

    @F.udf("summary string, keywords array<string>")
    def read(answer: str):
        return providers.summary_of(providers.extract_json(answer or "") or {})

    found = asked.withColumn("x", read("answer")).select("book", "id", "x.summary", "x.keywords")
    none = F.array().cast("array<string>")
    return parts.select("book", "id").join(found, ["book", "id"], "left").select("book", "id", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("keywords", none).alias("keywords"))


def offline_summaries(parts: DataFrame) -> DataFrame:
    """The same by rule: the first sentence or line, and the words by count."""
    words = structure.chunk_keywords(parts).groupBy("book", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda s: s["keyword"]).alias("keywords"))
    body = strip(F.regexp_replace("content", r"^[^\n]*\n?", ""))
    first = F.substring(strip(F.regexp_extract(body, r"^([^\n.!?。！？]*[.!?。！？]?)", 1)), 1, 100)
    summary = F.when(F.length(strip("content")) >= SHORT, first).otherwise("")
    return parts.join(words, ["book", "id"], "left").select("book", "id", summary.alias("summary"), F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords"))
