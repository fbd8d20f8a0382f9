"""Layout items: text at page edges, exports and counts.

items(book, ord, label, text, level, page_no, l, t, r, b, origin, page_height)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.text import strip

MARGIN, LEAST_PAGES, PAGE_SHARE, PAGE_HEIGHT = 0.08, 3, 0.1, 842.0
FURNITURE = ("PAGE_HEADER", "PAGE_FOOTER")
PLACEHOLDER = "<!-- image -->"


def edge_items(items: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Items in the outer share of their page, measured from their origin's side."""
    height = F.coalesce(F.nullif("page_height", F.lit(0.0)), F.lit(PAGE_HEIGHT))
    up = F.when(F.upper("origin") == "BOTTOMLEFT", (F.col("t") > height * (1 - margin)) | (F.col("b") < height * margin)).otherwise((F.col("t") < height * margin) | (F.col("b") > height * (1 - margin)))
    return items.withColumn("text", strip("text")).where((F.length("text") >= 2) & up)


def edge_texts(items: DataFrame, margin: float = MARGIN, least: int = LEAST_PAGES, share: float = PAGE_SHARE) -> DataFrame:
    """book, text, pages of edge texts on enough pages."""
    pages = items.groupBy("book").agg(F.countDistinct("page_no").alias("total"))
    found = edge_items(items, margin).groupBy("book", "text").agg(F.countDistinct("page_no").alias("pages")).join(pages, "book")
    return found.where(F.col("pages") >= F.greatest(F.lit(least), F.floor(F.col("total") * share))).drop("total")


def without_edge_texts(lines: DataFrame, texts: DataFrame) -> DataFrame:
    """Lines that equal none of the texts, also without digits where more than 3 characters are left."""
    bare = lambda x: F.regexp_replace(x, r"\p{Nd}+", "")
    rows = lines.withColumn("s", strip("line")).withColumn("k", bare("s"))
    exact = texts.select("book", F.col("text").alias("s")).distinct()
    loose = texts.select("book", bare("text").alias("k")).where(F.length("k") > 3).distinct()
    return rows.join(exact, ["book", "s"], "left_anti").join(loose, ["book", "k"], "left_anti").select("book", "doc_id", "line_no", "line")


def label_stats(items: DataFrame) -> DataFrame:
    """book, label, level (0 unless a heading), n."""
    level = F.when(F.col("label").isin("SECTION_HEADER", "TITLE"), F.coalesce("level", F.lit(1))).otherwise(0)
    return items.groupBy("book", "label", level.alias("level")).agg(F.count("*").alias("n"))


def image_index(items: DataFrame) -> DataFrame:
    """Pictures in order as image records (fig_0000 first): page and box are the
    first known of its provenances, captions are joined by line; caption is null
    without any, image_path where the picture could not be saved.

    items may have prov (array of page_no, bbox), captions (array) and
    image_path; without them the page and box are the item's own."""
    order = Window.partitionBy("book").orderBy("ord")
    rows = items.where("label = 'PICTURE'").withColumn("n", F.row_number().over(order) - 1)
    box = F.when(F.col("l").isNotNull(), F.struct("l", "t", "r", "b"))
    prov = F.col("prov") if "prov" in items.columns else F.array(F.struct("page_no", box.alias("bbox")))
    rows = rows.withColumn("prov", prov)
    first = lambda field: F.get(F.filter(F.transform("prov", lambda p: p[field]), lambda x: x.isNotNull()), F.lit(0))
    rows = rows.withColumns({"page": first("page_no"), "bbox": first("bbox")})
    caption = F.nullif(F.array_join(F.filter("captions", lambda c: F.length(c) > 0), "\n"), F.lit("")) if "captions" in items.columns else F.lit(None).cast("string")
    path = F.col("image_path") if "image_path" in items.columns else F.lit(None).cast("string")
    area = F.abs(F.col("bbox.r") - F.col("bbox.l")) * F.abs(F.col("bbox.t") - F.col("bbox.b"))
    return rows.select("book", F.format_string("fig_%04d", "n").alias("image_id"), "label", F.col("page").alias("page_no"), "bbox", area.alias("area"), "text", caption.alias("caption"), path.alias("image_path"), "prov")


def merged_blocks(lines: DataFrame) -> DataFrame:
    """Lines with neighbouring code blocks of one language as one, as a page
    break leaves them: what parts them is blank, and a block without a language
    joins any.  Joined from the end, the earlier block's language counts first.
    A run of neighbours is one array; blocks begin and end on lines of their own."""
    s = strip("line")
    word = F.regexp_extract(s, r"^```([\p{L}\p{N}_]*)$", 1)
    rows = lines.withColumns({"s": s, "fence": F.startswith(s, F.lit("```"))}).withColumn("nth", F.sum(F.col("fence").cast("int")).over(windows.so_far()))
    rows = rows.withColumns({"opens": F.col("fence") & (F.col("nth") % 2 == 1), "closes": F.col("fence") & (F.col("nth") % 2 == 0)})
    full = F.when(F.col("s") != "", F.struct("opens", "closes"))
    rows = rows.withColumns({"above": windows.last_known(full), "below": windows.next_known(full)})
    block = F.when(F.col("opens"), F.struct(F.col("line_no").alias("at"), word.alias("language"), F.coalesce(F.col("above.closes"), F.lit(False)).alias("near")))
    blocks = rows.where("opens").select("book", block.alias("b")).select("book", "b.*")
    order = Window.partitionBy("book").orderBy("at")
    runs = blocks.withColumn("run", F.sum((~F.col("near")).cast("int")).over(order)).groupBy("book", "run").agg(F.array_sort(F.collect_list(F.struct("at", "language"))).alias("blocks"))

    def step(acc: Column, block: Column) -> Column:
        """acc: the blocks joined to their predecessor so far, from the end, and
        the language of what follows (null at the end)."""
        now, mine = acc["now"], block["language"]
        fits = now.isNotNull() & ((now == mine) | (now == "") | (mine == ""))
        return F.struct(
            F.when(fits, F.concat(acc["joined"], F.array(acc["at"]))).otherwise(acc["joined"]).alias("joined"), F.when(fits & (mine == ""), now).otherwise(mine).alias("now"),
            block["at"].alias("at"), F.when(fits, acc["heads"]).otherwise(F.concat(acc["heads"], F.when(now.isNotNull(), F.array(F.struct(acc["at"].alias("at"), now.alias("language")))).otherwise(F.slice(acc["heads"], 1, 0)))).alias("heads"),
        )

    start = F.expr("struct(cast(array() as array<int>) as joined, cast(null as string) as now, 0 as at, cast(array() as array<struct<at:int,language:string>>) as heads)")
    made = runs.where(F.size("blocks") > 1).select("book", F.aggregate(F.reverse("blocks"), start, step, lambda acc: F.struct(acc["joined"].alias("joined"), F.concat(acc["heads"], F.array(F.struct(acc["at"].alias("at"), acc["now"].alias("language")))).alias("heads"))).alias("m"))
    joined = made.select("book", F.explode("m.joined").alias("line_no")).withColumn("goes", F.lit(True))
    heads = made.select("book", F.explode("m.heads").alias("h")).select("book", F.col("h.at").alias("line_no"), F.col("h.language").alias("language"))
    rows = rows.join(joined, ["book", "line_no"], "left").join(heads, ["book", "line_no"], "left")
    # a closing fence and blanks go if the opener that follows goes; so do the blanks beside them
    after = F.when(F.col("opens"), F.coalesce("goes", F.lit(False)))
    rows = rows.withColumns({"coming": windows.next_known(after)})
    gap = F.col("closes") | ((F.col("s") == "") & (F.col("nth") % 2 == 0) & (F.col("nth") > 0))
    gone = F.coalesce("goes", F.lit(False)) | (gap & F.coalesce("coming", F.lit(False)) & (F.col("closes") | F.coalesce(F.col("above.closes"), F.lit(False))))
    rows = rows.withColumn("gone", gone)
    line = F.when(F.col("opens") & F.col("language").isNotNull(), F.concat(F.lit("```"), "language")).otherwise(F.col("line"))
    return rows.where("not gone").select(*[c if c != "line" else line.alias("line") for c in lines.columns])


def markdown(items: DataFrame, furniture: bool = False, images: str = "placeholder") -> DataFrame:
    """book, line_no, line: items as Markdown, without page headers and footers.
    ``images``: placeholder, or referenced (a link to image_path where known)."""
    rows = items if furniture else items.where(~F.col("label").isin(*FURNITURE))
    picture = F.lit(PLACEHOLDER)
    if images == "referenced" and "image_path" in items.columns:
        picture = F.coalesce(F.concat(F.lit("![Image]("), F.col("image_path"), F.lit(")")), picture)
    title = F.concat(F.repeat(F.lit("#"), F.coalesce("level", F.lit(1))), F.lit(" "), F.col("text"))
    parts = (
        F.when(F.col("label").isin("SECTION_HEADER", "TITLE"), F.array(title)).when(F.col("label") == "PICTURE", F.array(picture))
        .when(F.col("label") == "CODE", F.concat(F.array(F.lit("```")), F.split("text", "\n"), F.array(F.lit("```")))).when(F.col("label") == "FORMULA", F.array(F.concat(F.lit("$$"), F.col("text"), F.lit("$$"))))
        .when(F.col("label") == "LIST_ITEM", F.array(F.concat(F.lit("- "), F.col("text")))).otherwise(F.split("text", "\n"))
    )
    rows = rows.select("book", "ord", F.posexplode(parts).alias("p", "line"))
    return rows.select("book", F.row_number().over(Window.partitionBy("book").orderBy("ord", "p")).alias("line_no"), "line")
