"""Figures: links, pairing, filters, context and enrichment blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows
from ..functions.paths import inside, relative_path
from ..functions.text import after_output, basename, rstrip, squeeze, strip, without_mark

LINK = r"!\[[^\]]*\]\(([^)]+)\)"
MARKED = r"!\[([^\]]*)\]\(([^)]+)\)"
OPENERS = r"^<!-- figure-enrich(:| -->)"
OPENER, CLOSER = "<!-- figure-enrich -->", "<!-- /figure-enrich -->"
LEAST_BYTES = 3072
BEFORE_CHARS, AFTER_CHARS, CONTEXT_CHARS = 2000, 1500, 6000


def image_links(lines: DataFrame, first_only: bool = False, suffixes: tuple[str, ...] = (), cut_title: bool = True) -> DataFrame:
    """book, line_no, ordinal, href, basename of local image links in order.
    ``first_only``: one a line; ``suffixes``: only these; ``cut_title``: up to white space."""
    rows = lines.select("book", "line_no", F.posexplode(F.regexp_extract_all("line", F.lit(LINK), F.lit(1))).alias("p", "href"))
    href = F.regexp_extract(strip("href"), r"^(\S+)", 1) if cut_title else strip("href")
    rows = rows.withColumn("href", F.regexp_replace(href, "^<|>$", "")).where(~F.col("href").rlike("(?i)^(https?|data|ftp|file|mailto):"))
    if first_only:
        rows = rows.where("p = 0")
    if suffixes:
        rows = rows.where(F.lower(F.regexp_extract("href", r"(\.[^./]+)$", 1)).isin(*suffixes))
    order = Window.partitionBy("book").orderBy("line_no", "p")
    return rows.withColumn("ordinal", F.row_number().over(order)).select("book", "line_no", "ordinal", "href", basename(F.col("href")).alias("basename"))


def paired(links: DataFrame, records: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Links with image records (book, ord, image_id, ...) at the same place in
    their orders; the longer side's rest is left out.  ``existing`` (basename):
    only links whose file is there count, which moves all later pairs."""
    if existing is not None:
        links = links.join(existing.select("basename").distinct(), "basename", "left_semi").withColumn("ordinal", F.row_number().over(Window.partitionBy("book").orderBy("ordinal")))
    numbered = records.withColumn("ordinal", F.row_number().over(Window.partitionBy("book").orderBy("ord"))).drop("ord")
    return links.join(numbered, ["book", "ordinal"])


def mismatched(links: DataFrame, records: DataFrame) -> DataFrame:
    """book, links, records where the two counts differ."""
    a, b = links.groupBy("book").agg(F.count("*").alias("links")), records.groupBy("book").agg(F.count("*").alias("records"))
    return a.join(b, "book", "full").fillna(0, ["links", "records"]).where("links <> records")


def bbox_area(box: Column) -> Column:
    return F.abs(box["r"] - box["l"]) * F.abs(box["t"] - box["b"])


def evaluated(images: DataFrame, least_bytes: int = LEAST_BYTES, least_area: float = 0, least_pixels: int = 0) -> DataFrame:
    """Images (size_bytes, area, pixels) with drop_reasons and keep; sizes that aren't known drop nothing."""
    reasons = F.array_compact(F.array(
        F.when(F.col("size_bytes") < least_bytes, F.lit(f"size_bytes < {least_bytes}")), F.when((F.lit(least_area) > 0) & (F.col("area") < least_area), F.lit("bbox_area < min")),
        F.when((F.lit(least_pixels) > 0) & (F.col("pixels") < least_pixels), F.lit("pixels < min")),
    ))
    return images.withColumn("drop_reasons", F.array_join(reasons, "; ")).withColumn("keep", F.col("drop_reasons") == "")


def filter_summary(checked: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """book, matched, kept, dropped; with ``records`` also json, how many there were to match."""
    if records is not None:
        total = records.groupBy("book").agg(F.count("*").alias("json"))
        return total.join(filter_summary(checked), "book", "left").fillna(0, ["matched", "kept", "dropped"])
    return checked.groupBy("book").agg(F.count("*").alias("matched"), F.sum(F.col("keep").cast("long")).alias("kept"), F.sum((~F.col("keep")).cast("long")).alias("dropped"))


def breadcrumbs(lines: DataFrame) -> DataFrame:
    """book, line_no, trail at image lines: titles of the headings they stand
    under, joined; code is not left out here, and lines aren't stripped on the left."""
    rows = lines.withColumn("line", rstrip("line")).withColumn("level", F.length(F.regexp_extract("line", r"^(#{1,6})\s+.+$", 1)))
    rows = rows.withColumn("title", without_mark(F.regexp_extract("line", r"^#{1,6}\s+(.+)$", 1)))
    last = {f"h{k}": F.last(F.when(F.col("level") == k, F.struct("line_no", "title")), True).over(windows.before()) for k in range(1, 7)}
    rows = rows.withColumns(last).where(F.col("line").rlike(LINK))
    # a level's heading counts if it is later than every shallower one
    trail = []
    for k in range(1, 7):
        above = F.greatest(F.lit(0), F.lit(0), *(F.coalesce(F.col(f"h{j}.line_no"), F.lit(0)) for j in range(1, k)))
        trail.append(F.when(F.col(f"h{k}.line_no") > above, F.col(f"h{k}.title")))
    return rows.select("book", "line_no", F.array_join(F.array_compact(F.array(*trail)), " > ").alias("trail"))


def figure_context(lines: DataFrame, before: int = BEFORE_CHARS, after: int = AFTER_CHARS) -> DataFrame:
    """book, line_no, basename, context_before (the last characters of all
    earlier lines without images), context_after (the first ones up to the next image).

    Only the lines that can reach into a window of characters are collected."""
    links = image_links(lines, first_only=True).select("book", F.col("line_no").alias("at"), "href", "basename")
    rows = lines.withColumn("line", rstrip("line")).withColumn("image", F.col("line").rlike(LINK)).withColumn("segment", F.sum(F.col("image").cast("int")).over(windows.order().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    text = rows.where("not image").withColumn("upto", F.sum(F.length("line") + 1).over(windows.order().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    joined = lambda x: F.array_join(F.transform(F.array_sort(x), lambda s: s["line"]), "\n")
    marks = rows.where("image").select("book", F.col("line_no").alias("at"), "segment")
    whole = text.groupBy("book", "segment").agg(F.max("upto").alias("upto"))
    # characters before each image: the running length at the end of earlier segments
    reach = marks.join(whole.withColumn("next", F.col("segment") + 1).select("book", F.col("next").alias("segment"), "upto"), ["book", "segment"], "left")
    reach = reach.withColumn("upto", F.coalesce("upto", F.max("upto").over(Window.partitionBy("book").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    block = 1 << 12
    near = text.withColumn("cell", F.floor(F.col("upto") / block)).select("book", "cell", "upto", "line_no", "line")
    wanted = reach.withColumn("cell", F.explode(F.sequence(F.floor((F.col("upto") - before - 1) / block), F.floor(F.col("upto") / block))))
    # a line that begins before the window but reaches into it has its end inside it
    past = wanted.withColumnRenamed("upto", "limit").join(near, ["book", "cell"]).where("line_no < at and upto <= limit").where(F.col("upto") > F.col("limit") - before - 1)
    past = past.groupBy("book", "at").agg(joined(F.collect_list(F.struct("line_no", "line"))).alias("x")).select("book", "at", F.substr(F.col("x"), F.greatest(F.length("x") - before + 1, F.lit(1))).alias("context_before"))
    start = Window.partitionBy("book", "segment").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    follow = text.where("segment > 0").withColumn("sofar", F.coalesce(F.sum(F.length("line") + 1).over(start), F.lit(0))).where(F.col("sofar") < after)
    follow = follow.groupBy("book", "segment").agg(joined(F.collect_list(F.struct("line_no", "line"))).alias("x")).select("book", "segment", F.substring("x", 1, after).alias("context_after"))
    out = links.join(marks, ["book", "at"]).join(past, ["book", "at"], "left").join(follow, ["book", "segment"], "left")
    return out.select("book", F.col("at").alias("line_no"), "href", "basename", strip(F.coalesce("context_before", F.lit(""))).alias("context_before"), strip(F.coalesce("context_after", F.lit(""))).alias("context_after"))


def last_wins(rows: DataFrame, order: str) -> DataFrame:
    """One row for each basename, the last by ``order``."""
    best = Window.partitionBy("book", "basename").orderBy(F.desc(order))
    return rows.withColumn("n", F.row_number().over(best)).where("n = 1").drop("n")


def record_paths(records: DataFrame, output: str | None = None) -> DataFrame:
    """Records with image_path relative to the output folder: what follows the
    first ``/output/``, or where ``output`` names the folder, the path within it;
    other paths stay."""
    path = F.col("image_path")
    new = F.coalesce(after_output(path), path) if output is None else inside(path, F.lit(output))
    return records.withColumn("image_path", new)


def ocr_records(read: DataFrame) -> DataFrame:
    """book, ord, basename, ocr_text, ocr_error of read images (book, ord, path,
    ocr_text, ocr_error), with white space evened out."""
    return read.select("book", "ord", basename(F.col("path")).alias("basename"), squeeze(F.col("ocr_text")).alias("ocr_text"), "ocr_error")


def document_context(trail: Column, before: Column, after: Column, most: int = CONTEXT_CHARS) -> Column:
    """Headings and text around a figure for a describing model; a mark tells where it was cut."""
    part = lambda name, x: F.when(F.length(x) > 0, F.concat(F.lit(name), x))
    text = F.concat_ws("\n\n", part("Headings: ", trail), part("[Before the figure in Markdown]\n", strip(before)), part("[After the figure in Markdown]\n", strip(after)))
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("\n... [context truncated]"))).otherwise(text)


def describe_input(kept: DataFrame, context: DataFrame, ocr: DataFrame, most: int = CONTEXT_CHARS) -> DataFrame:
    """Kept figures with section, document_context and ocr text for a describing model."""
    c = last_wins(context, "line_no").select("book", "basename", "trail", "context_before", "context_after")
    o = last_wins(ocr, "ord").select("book", "basename", "ocr_text", "ocr_error")
    rows = kept.join(c, ["book", "basename"], "left").join(o, ["book", "basename"], "left")
    text = document_context(F.col("trail"), F.col("context_before"), F.col("context_after"), most)
    read = F.when(F.length("ocr_error") > 0, F.concat(F.lit("ocr_failed: "), "ocr_error")).when(F.length(strip(F.coalesce("ocr_text", F.lit("")))) == 0, "unknown").otherwise(F.col("ocr_text"))
    section = F.coalesce(F.nullif(F.element_at(F.split("trail", " > "), -1), F.lit("")), F.lit("unknown"))
    return rows.withColumns({"section": section, "document_context": text, "ocr": read})


def enrichment_block(title: Column, summary: Column, keywords: Column, ocr: Column, most: int = 1200, most_keywords: int = 10, most_ocr: int = 500) -> Column:
    """The lines that are put after a figure, as an array."""
    cut = lambda x, n: F.when(F.length(x) > n, F.concat(F.regexp_replace(F.substring(x, 1, n), r"\s+$", ""), F.lit("…"))).otherwise(x)
    name = F.coalesce(F.nullif(strip(F.coalesce(title, F.lit(""))), F.lit("")), F.lit("unknown"))
    words = F.filter(F.transform(F.slice(F.coalesce(keywords, F.array().cast("array<string>")), 1, most_keywords), strip), lambda k: k != "")
    lines = F.array(F.lit(OPENER), F.concat(F.lit("**Figure (enriched):** "), name), F.lit(""), cut(strip(F.coalesce(summary, F.lit(""))), most), F.lit(""), F.concat(F.lit("*Keywords:* "), F.array_join(words, ", ")))
    read = strip(F.coalesce(ocr, F.lit("")))
    extra = F.when((read != "") & (read != "unknown"), F.array(F.lit(""), F.concat(F.lit("*OCR excerpt:* "), cut(read, most_ocr)))).otherwise(F.array().cast("array<string>"))
    text = F.concat(lines, extra, F.array(F.lit(CLOSER)))
    return F.split(F.array_join(text, "\n"), "\n")


def without_blocks(lines: DataFrame) -> DataFrame:
    """Lines without enrichment blocks that follow an image line."""
    s = strip("line")
    opens = s.rlike(OPENERS) & F.lag(F.col("line").rlike(LINK)).over(windows.order())
    event = F.when(opens, "open").when(s == CLOSER, "close")
    rows = lines.withColumn("event", event)
    rows = rows.withColumn("state", F.last("event", True).over(windows.order().rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("earlier", F.last("event", True).over(windows.before()))
    inside = (F.col("state") == "open") | ((F.col("event") == "close") & (F.col("earlier") == "open"))
    return rows.where(~F.coalesce(inside, F.lit(False))).select("book", "doc_id", "line_no", "line")


def injected(lines: DataFrame, figures: DataFrame) -> DataFrame:
    """Lines with the blocks of ``figures`` (book, basename, block array) after
    their image lines; earlier blocks go even where none replaces them."""
    base = without_blocks(lines)
    links = image_links(base, first_only=True).select("book", "line_no", "basename")
    rows = base.join(links.join(figures, ["book", "basename"]).select("book", "line_no", "block"), ["book", "line_no"], "left")
    parts = F.concat(F.array(F.col("line")), F.coalesce("block", F.array().cast("array<string>")))
    rows = rows.select("book", "doc_id", "line_no", F.posexplode(parts).alias("p", "line"))
    order = Window.partitionBy("book").orderBy("line_no", "p")
    return rows.withColumn("n", F.row_number().over(order)).select("book", "doc_id", F.col("n").alias("line_no"), "line")


def relative_links(lines: DataFrame, folder: str | Column) -> DataFrame:
    """Lines whose image links are relative to ``folder`` (that of the text, an
    absolute path), and the numbers of links found and changed."""
    folder = F.lit(folder) if isinstance(folder, str) else folder
    rows = lines.withColumn("links", F.regexp_extract_all("line", F.lit(MARKED), F.lit(0)))
    href = lambda x: F.regexp_extract(x, MARKED, 2)
    made = lambda x: F.coalesce(F.concat(F.lit("!["), F.regexp_extract(x, MARKED, 1), F.lit("]("), relative_path(href(x), folder), F.lit(")")), x)
    rows = rows.withColumn("pairs", F.transform("links", lambda x: F.struct(x.alias("old"), made(x).alias("new"))))

    def step(acc: Column, pair: Column) -> Column:
        """One link further: what stands before it and the new link are done, what follows is the rest."""
        at = F.position(pair["old"], acc["rest"])
        done = F.concat(acc["done"], F.substr(acc["rest"], F.lit(1), at - 1), pair["new"])
        return F.struct(done.alias("done"), F.substr(acc["rest"], at + F.length(pair["old"])).alias("rest"))

    text = F.aggregate("pairs", F.struct(F.lit("").alias("done"), F.col("line").alias("rest")), step, lambda acc: F.concat(acc["done"], acc["rest"]))
    changed = F.size(F.filter("pairs", lambda p: p["old"] != p["new"]))
    return rows.withColumns({"found": F.size("links"), "changed": changed, "line": F.when(F.size("links") > 0, text).otherwise(F.col("line"))}).drop("links", "pairs")
