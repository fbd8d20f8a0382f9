"""Page ranges of a split: half-open, 0-based.

outline(book, ord, depth, title, page); sizes(book, total_pages)."""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip


# Fixed formats of titles.
FRONT, BEGINNING, FROM_PAGE, SECTION, MERGED, CHAPTER, FIRST_HALF, SECOND_HALF = "文前", "开头", "第 {0} 页起", "{0}（段 {1}）", "{0} … {1}（{2} 节）", "{0} — {1}", "（子段·前）", "（子段·后）"


def fixed_ranges(sizes: DataFrame, most: int) -> DataFrame:
    """Ranges of ``most`` pages."""
    if most <= 0:
        raise ValueError("most must be positive")
    rows = sizes.where("total_pages > 0").select("book", "total_pages", F.posexplode(F.sequence(F.lit(0), F.col("total_pages") - 1, F.lit(most))).alias("ord", "start_page"))
    rows = rows.withColumn("end_page", F.least(F.col("start_page") + most, "total_pages"))
    return rows.select("book", (F.col("ord") + 1).alias("ord"), F.format_string("fixed pages %d-%d", F.col("start_page") + 1, "end_page").alias("title"), "start_page", "end_page")


def chapters(outline: DataFrame) -> DataFrame:
    """The top level, or its children where it has 3 entries at most and more children."""
    n = lambda d: F.sum((F.col("depth") == d).cast("int")).over(Window.partitionBy("book"))
    rows = outline.withColumns({"tops": n(0), "subs": n(1)})
    return rows.where("depth = case when tops <= 3 and subs > 3 then 1 else 0 end").drop("tops", "subs")


def chapter_ranges(found: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """From each chapter to the next, cut into ``(part n)`` beyond ``most``;
    empty ranges are left out, and so are pages before the first chapter."""
    spans = _spans(found, sizes)
    rows = spans.select("book", "ord", "title", "end_page", F.posexplode(F.sequence("start_page", F.col("end_page") - 1, F.lit(most))).alias("part", "from_page"), (F.col("end_page") - F.col("start_page") > most).alias("cut"))
    title = F.when(F.col("cut"), F.concat("title", F.lit(" (part "), (F.col("part") + 1).cast("string"), F.lit(")"))).otherwise(F.col("title"))
    return rows.select("book", "ord", "part", title.alias("title"), F.col("from_page").alias("start_page"), F.least(F.col("from_page") + most, "end_page").alias("end_page"))


def _spans(found: DataFrame, sizes: DataFrame) -> DataFrame:
    order = Window.partitionBy("book").orderBy("ord")
    rows = found.join(sizes, "book").withColumn("end_page", F.coalesce(F.lead("page").over(order), F.col("total_pages")))
    return rows.select("book", "ord", "title", F.col("page").alias("start_page"), "end_page").where("end_page > start_page")


def bookmarks(outline: DataFrame, sizes: DataFrame) -> DataFrame:
    """book, page, title: the first title of each page, pages clamped to the book."""
    rows = outline.join(sizes, "book").where("total_pages > 0").withColumn("page", F.greatest(F.lit(0), F.least("page", F.col("total_pages") - 1)))
    return rows.groupBy("book", "page").agg(F.min_by(_named("title"), "ord").alias("title"))


def _named(title: str) -> Column:
    return F.coalesce(F.nullif(strip(title), F.lit("")), F.lit("?"))


def atomic_ranges(outline: DataFrame, regions: DataFrame, sizes: DataFrame, whole: bool = False) -> DataFrame:
    """Ranges between the bookmarks of each region (book, region, start_page,
    end_page); what comes before a region's first bookmark is a range too,
    named after its page (``whole``: the beginning of the book by a name of its own)."""
    marks = bookmarks(outline, sizes).join(regions, "book").where("page >= start_page and page < end_page").select("book", "region", "start_page", "end_page", "page", "title")
    lead = regions.join(marks.select("book", "region", F.col("page").alias("start_page")), ["book", "region", "start_page"], "left_anti")
    before, after = FROM_PAGE.split("{0}")
    name = F.concat(F.lit(before), (F.col("start_page") + 1).cast("string"), F.lit(after))
    name = F.when(F.col("start_page") == 0, BEGINNING).otherwise(name) if whole else name
    marks = marks.unionByName(lead.select("book", "region", "start_page", "end_page", F.col("start_page").alias("page"), name.alias("title")))
    order = Window.partitionBy("book", "region").orderBy("page")
    return marks.withColumn("stop", F.coalesce(F.lead("page").over(order), F.col("end_page"))).select("book", "region", F.col("page").alias("start_page"), F.col("stop").alias("end_page"), "title")


def pack(pieces: list[tuple[int, int, str]], most: int) -> list[tuple[str, int, int]]:
    """Contiguous groups of at most ``most`` pages: as few as can be, then the
    smallest as large as can be, then the last as short as can be.  Pieces
    beyond ``most`` are cut first."""
    atoms = [(a, min(a + most, end), title if end - start <= most else SECTION.format(title, k + 1)) for start, end, title in pieces for k, a in enumerate(range(start, end, most))]
    ends = [0]
    for start, end, _ in atoms:
        ends.append(ends[-1] + end - start)
    best: list[tuple[int, int, int]] = [(0, -(10**9), -1)]  # groups, minus the smallest, cut
    for j in range(1, len(atoms) + 1):
        first = bisect.bisect_left(ends, ends[j] - most, 0, j)
        options = ((best[i][0] + 1, max(best[i][1], ends[i] - ends[j]), -i) for i in range(first, j))
        groups, smallest, cut = min(options)
        best.append((groups, smallest, -cut))
    out, j = [], len(atoms)
    while j > 0:
        i = best[j][2]
        title = atoms[i][2] if j - i == 1 else MERGED.format(atoms[i][2], atoms[j - 1][2], j - i)
        out.append((title, atoms[i][0], atoms[j - 1][1]))
        j = i
    return out[::-1]


def packed_ranges(atoms: DataFrame, most: int) -> DataFrame:
    """Best packing of each region's atomic ranges; a group is a region's
    bookmarks, which a book's pages bound."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("start_page")
        found = pack(list(zip(frame["start_page"].tolist(), frame["end_page"].tolist(), frame["title"].tolist(), strict=True)), most)
        return pd.DataFrame([(frame["book"].iloc[0], frame["region"].iloc[0], k + 1, t, a, b) for k, (t, a, b) in enumerate(found)], columns=["book", "region", "ord", "title", "start_page", "end_page"])

    return atoms.groupBy("book", "region").applyInPandas(run, "book string, region int, ord int, title string, start_page int, end_page int")


def chapter_first(outline: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """Front matter, then whole chapters that fit, others packed from their bookmarks."""
    spans = _spans(chapters(outline), sizes).withColumns({"region": F.col("ord").cast("int"), "title": _named("title")})
    front = spans.groupBy("book").agg(F.min("start_page").alias("end_page")).where("end_page > 0").select("book", F.lit(-1).alias("region"), F.lit(FRONT).alias("title"), F.lit(0).alias("start_page"), "end_page")
    regions = spans.select("book", "region", "title", "start_page", "end_page").unionByName(front)
    fits = regions.where(F.col("end_page") - F.col("start_page") <= most).select("book", "region", F.lit(1).alias("ord"), "title", "start_page", "end_page")
    large = regions.where(F.col("end_page") - F.col("start_page") > most)
    packed = packed_ranges(atomic_ranges(outline, large.drop("title"), sizes), most).join(large.select("book", "region", F.col("title").alias("chapter")), ["book", "region"])
    between = CHAPTER.removeprefix("{0}").removesuffix("{1}")
    return fits.unionByName(packed.withColumn("title", F.concat("chapter", F.lit(between), "title")).drop("chapter"))


def outline_smart(outline: DataFrame, sizes: DataFrame, most: int) -> DataFrame:
    """The whole book packed from its bookmarks."""
    return packed_ranges(atomic_ranges(outline, sizes.select("book", F.lit(0).alias("region"), F.lit(0).alias("start_page"), F.col("total_pages").alias("end_page")), sizes, whole=True), most)


def split_point(start: int, end: int, pages: list[int]) -> int:
    """The bookmark nearest the middle (the first on ties), else the middle."""
    middle = (start + end) // 2
    inside = [p for p in pages if start < p < end]
    return min(inside, key=lambda p: abs(p - middle)) if inside else middle


def by_size(ranges: DataFrame, page_bytes: DataFrame, marks: DataFrame, most_bytes: int) -> DataFrame:
    """Ranges halved at bookmarks until their pages' bytes fit; single pages stay."""
    sizes = page_bytes.groupBy("book").agg(F.array_sort(F.collect_list(F.struct("page", "bytes"))).alias("sizes"))
    pages = marks.groupBy("book").agg(F.array_sort(F.collect_set("page")).alias("pages"))
    rows = ranges.join(sizes, "book").join(pages, "book", "left")

    def run(frames):
        for frame in frames:
            out = []
            for book, title, start, end, size, at in frame[["book", "title", "start_page", "end_page", "sizes", "pages"]].itertuples(index=False):
                size, at = {s["page"]: s["bytes"] for s in size}, [] if at is None else list(at)
                before = list(itertools.accumulate((size.get(p, 0) for p in range(start, end)), initial=0))
                todo = [(title, start, end)]
                while todo:
                    name, a, b = todo.pop()
                    if b - a > 1 and before[b - start] - before[a - start] > most_bytes:
                        middle = split_point(a, b, at)
                        todo += [(name + SECOND_HALF, middle, b), (name + FIRST_HALF, a, middle)]
                    elif b > a:
                        out.append((book, name, a, b))
            yield pd.DataFrame(out, columns=["book", "title", "start_page", "end_page"])

    return rows.select("book", "title", "start_page", "end_page", "sizes", "pages").mapInPandas(run, "book string, title string, start_page int, end_page int")


def split(outline: DataFrame, sizes: DataFrame, most: int, strategy: str = "chapter_first") -> DataFrame:
    """Ranges by a strategy: fixed, chapters, chapter_first or outline."""
    if most <= 0:
        raise ValueError("most must be positive")
    made = {"fixed": lambda: fixed_ranges(sizes, most), "chapters": lambda: chapter_ranges(chapters(outline), sizes, most), "chapter_first": lambda: chapter_first(outline, sizes, most), "outline": lambda: outline_smart(outline, sizes, most)}
    return made[strategy]()


def manifest(ranges: DataFrame) -> DataFrame:
    """book, part_no, stem, pdf, title and 1-based inclusive pages of each range."""
    order = Window.partitionBy("book").orderBy("start_page")
    rows = ranges.withColumn("part_no", F.row_number().over(order))
    rows = rows.withColumn("stem", F.format_string("%s_pt%03d", "book", "part_no"))
    return rows.select("book", "part_no", "stem", F.concat("stem", F.lit(".pdf")).alias("pdf"), "title", (F.col("start_page") + 1).alias("page_start_1based"), F.col("end_page").alias("page_end_1based_inclusive"))


def export_command(source: str, target: str, first: int, last: int) -> list[str]:
    """The call of qpdf that writes pages first to last (from 1, inclusive)."""
    return ["qpdf", source, "--pages", source, f"{first}-{last}", "--", target]


def exported(parts: DataFrame, source: str, folder: str, run: Callable[[list[str]], int]) -> DataFrame:
    """stem, ok of a manifest's parts, written in parallel by ``run`` (a
    command to its exit status)."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            calls = zip(frame["stem"], frame["pdf"], frame["page_start_1based"], frame["page_end_1based_inclusive"], strict=True)
            yield pd.DataFrame([(stem, run(export_command(source, f"{folder}/{pdf}", a, b)) == 0) for stem, pdf, a, b in calls], columns=["stem", "ok"])

    return parts.select("stem", "pdf", "page_start_1based", "page_end_1based_inclusive").mapInPandas(write, "stem string, ok boolean")
