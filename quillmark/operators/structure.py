"""Code masks, headings, chunks, tables of contents, keyword index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.text import strip


#: Most bytes of a book for each depth of its index.
DEPTHS = ((50 * 1024, 4), (200 * 1024, 3))
DEEPEST = 2
KEYWORDS = 5


def fence_mask(lines: DataFrame) -> DataFrame:
    """With is_fence and in_code: lines that begin with three backticks toggle."""
    fence = F.startswith(strip("line"), F.lit("```"))
    return lines.withColumn("is_fence", fence).withColumn("in_code", F.col("is_fence") | (F.sum(F.col("is_fence").cast("int")).over(windows.so_far()) % 2 == 1))


def headings(lines: DataFrame, depth: int = 6) -> DataFrame:
    """book, line_no, level, title of headings outside code."""
    found = fence_mask(lines).where("not in_code").withColumn("s", strip("line")).where(F.col("s").rlike(r"^#{1,6}\s+.+$"))
    found = found.select("book", "doc_id", "line_no", F.length(F.regexp_extract("s", r"^(#{1,6})\s", 1)).alias("level"), strip(F.regexp_extract("s", r"^#{1,6}\s+(.+)$", 1)).alias("title"))
    return found.where(F.col("level") <= depth)


def depth_of(lines: DataFrame, given: int | None = None) -> DataFrame:
    """book, size, depth of the index: the one given (1 to 6), else what a book's size asks for."""
    if given is not None and not 1 <= given <= 6:
        raise ValueError("depth must be from 1 to 6")
    size = (F.sum(F.octet_length("line") + 1) - 1).alias("size")
    depth = F.lit(DEEPEST)
    for most, level in reversed(DEPTHS):
        depth = F.when(F.col("size") < most, level).otherwise(depth)
    return lines.groupBy("book").agg(size).withColumn("depth", depth if given is None else F.lit(given))


def _chunk_lines(lines: DataFrame, depth: int) -> DataFrame:
    marks = headings(lines, depth or 6).select("book", "line_no", "level", "title")
    if depth is None:
        marks = marks.join(depth_of(lines).select("book", "depth"), "book").where("level <= depth").drop("depth")
    joined = lines.join(marks, ["book", "line_no"], "left")
    return joined.withColumn("ordinal", F.count("level").over(windows.so_far())).withColumn("last_line", F.max("line_no").over(windows.whole()))


def chunks(lines: DataFrame, depth: int | None = 4) -> DataFrame:
    """A chunk from each heading to the next; lines before the first belong to
    none.  ``depth``: that of the headings; None: what each book's size asks for."""
    rows = _chunk_lines(lines, depth).where("ordinal > 0")
    parts = rows.groupBy("book", "ordinal").agg(
        F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"), F.max("level").alias("level"), F.max("title").alias("title"),
        F.count("*").alias("line_count"), (F.sum(F.length("line") + 1) - F.max((F.col("line_no") == F.col("last_line")).cast("int"))).alias("char_count"),
        F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x"),
    )
    content = F.array_join(F.transform("x", lambda s: s["line"]), "\n")
    parts = parts.withColumn("content", content).drop("x").withColumn("id", F.format_string("chunk_%03d", "ordinal"))
    cut = strip(F.replace(F.substring("content", 1, 200), F.lit("\n"), F.lit(" ")))
    preview = F.concat(cut, F.when(F.length("content") > 200, "...").otherwise(""))
    return parts.withColumn("content_preview", preview)


def toc(lines: DataFrame, depth: int = 4) -> DataFrame:
    """book, ordinal, level, title, parent: the nearest earlier heading of a
    smaller level, 0 at the root."""
    rows = headings(lines, depth).withColumn("ordinal", F.row_number().over(windows.order()))
    last = {k: F.coalesce(F.max(F.when(F.col("level") == k, F.col("ordinal"))).over(windows.before()), F.lit(0)) for k in range(1, 6)}
    rows = rows.withColumns({f"l{k}": c for k, c in last.items()})
    parent: Column = F.lit(0)
    for k in range(2, 7):
        parent = F.when(F.col("level") == k, F.greatest(*(F.col(f"l{j}") for j in range(1, k)), F.lit(0))).otherwise(parent)
    return rows.select("book", "ordinal", "level", "title", parent.alias("parent"))


def children(lines: DataFrame, depth: int = 4) -> DataFrame:
    """book, parent, children in order."""
    return toc(lines, depth).groupBy("book", "parent").agg(F.array_sort(F.collect_list("ordinal")).alias("children"))


def chunk_keywords(parts: DataFrame, most: int = KEYWORDS) -> DataFrame:
    """book, id, keyword, rank: the offline extractor, words of four letters or
    more by count, then alphabet."""
    words = parts.select("book", "id", F.explode(F.regexp_extract_all(F.lower("content"), F.lit("([a-z]{4,})"), F.lit(1))).alias("keyword"))
    counts = words.groupBy("book", "id", "keyword").count()
    rank = F.row_number().over(Window.partitionBy("book", "id").orderBy(F.desc("count"), "keyword"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= most).select("book", "id", "keyword", "rank")


def keyword_index(keywords: DataFrame) -> DataFrame:
    """book, keyword, ids: which chunks have a keyword, in order."""
    return keywords.groupBy("book", F.lower("keyword").alias("keyword")).agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("ids"))


def index_stats(parts: DataFrame, keywords: DataFrame) -> DataFrame:
    """book, chunks, keywords, empty (chunks too short for a summary)."""
    short = F.sum((F.length(strip("content")) < 50).cast("long"))
    return parts.groupBy("book").agg(F.count("*").alias("chunks"), short.alias("empty")).join(keywords.groupBy("book").agg(F.countDistinct("keyword").alias("keywords")), "book", "left").fillna(0, ["keywords"])


def index_json(lines: DataFrame, depth: int = 4, summaries: DataFrame | None = None) -> DataFrame:
    """book, index (JSON): chunks, contents, keyword index and counts of a book.
    ``summaries`` (book, id, summary, keywords) come from a model or a rule; by
    default chunks have no summary and the words of the offline extractor."""
    parts = chunks(lines, depth)
    words = chunk_keywords(parts)
    if summaries is None:
        by_chunk = words.groupBy("book", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "keyword"))), lambda s: s["keyword"]).alias("keywords")).withColumn("summary", F.lit(""))
    else:
        by_chunk = summaries.select("book", "id", "summary", "keywords")
        words = by_chunk.select("book", "id", F.explode("keywords").alias("keyword"))
    fields = ["id", "title", "level", "start_line", "end_line", "line_count", "char_count", "content_preview", "summary", "keywords"]
    none = F.array().cast("array<string>")
    rows = parts.join(by_chunk, ["book", "id"], "left").withColumns({"summary": F.coalesce("summary", F.lit("")), "keywords": F.coalesce("keywords", none)})
    made = rows.groupBy("book").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("chunks"), F.count("*").alias("total_chunks"), F.sum((F.col("summary") == "").cast("long")).alias("without_summary"))
    sizes = lines.groupBy("book").agg(F.count("*").alias("total_lines"))
    tree = toc(lines, depth).groupBy("book").agg(F.array_sort(F.collect_list(F.struct("ordinal", "parent", "level", "title"))).alias("toc"))
    terms = keyword_index(words).groupBy("book").agg(F.array_sort(F.collect_list(F.struct("keyword", F.split("ids", ",").alias("ids")))).alias("terms"), F.count("*").alias("total_keywords"))
    out = made.join(sizes, "book").join(tree, "book", "left").join(terms, "book", "left")
    meta = F.struct(F.lit(depth).alias("depth"), "total_lines", "total_chunks", F.coalesce("total_keywords", F.lit(0).cast("long")).alias("total_keywords"), "without_summary")
    terms_of = F.map_from_entries(F.coalesce("terms", F.expr("cast(array() as array<struct<keyword:string,ids:array<string>>>)")))
    return out.select("book", F.to_json(F.struct(meta.alias("metadata"), "chunks", "toc", terms_of.alias("keyword_index"))).alias("index"))
