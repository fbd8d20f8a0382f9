"""Queries over the composed books and the plain tables, one for each operator."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import providers
from .functions.storage import checkpointed
from .operators import codeblocks, figures, hierarchy, judged, layout, merge, packing, patterns, structure
from .plans import search, stages
from .sources.corpus import books, documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def over_lines(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: f(books(spark, sf_dir))


def over_stored(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    """For operators that read their lines several times."""
    QUERIES[name] = lambda spark, sf_dir: f(checkpointed(books(spark, sf_dir)))


def r6(x: str) -> Column:
    return F.round(x, 6).alias(x)


_CHUNK = ["book", "id", "title", "level", "start_line", "end_line", "line_count", "char_count", "content_preview"]
_FOUND = lambda d: d.select("book", "text", "pattern_type", "count", r6("confidence"), "first_line", F.array_join("variants", "\n").alias("variants"))

over_lines("lines_explode", lambda d: d.select("book", "line_no", "doc_id", "line"))
over_lines("fence_mask", lambda d: structure.fence_mask(d).select("book", "line_no", "is_fence", "in_code"))
over_lines("headings", lambda d: structure.headings(d).select("book", "line_no", "level", "title"))
over_lines("chunks_h4", lambda d: structure.chunks(d, 4).select(*_CHUNK))
over_lines("chunks_h2", lambda d: structure.chunks(d, 2).select(*_CHUNK))
over_stored("chunks_auto", lambda d: structure.chunks(d, None).select(*_CHUNK))
over_lines("toc_parent", structure.toc)
over_lines("toc_children", lambda d: structure.children(d).select("book", "parent", F.array_join(F.transform("children", lambda x: x.cast("string")), ",").alias("children")))
over_lines("breadcrumb", figures.breadcrumbs)
over_lines("keyword_index", lambda d: structure.keyword_index(structure.chunk_keywords(structure.chunks(d))))
over_lines("index_stats", lambda d: (lambda c: structure.index_stats(c, structure.chunk_keywords(c)))(structure.chunks(d)))
over_stored("index_json", structure.index_json)
over_lines("depth_selector", structure.depth_of)
over_lines("exact_frequency", lambda d: _FOUND(patterns.exact_frequency(d)))
over_lines("exact_positions", lambda d: patterns.positions(d, patterns.exact_frequency(d)).select("book", "text", F.array_join(F.transform("line_numbers", lambda x: x.cast("string")), ",").alias("line_numbers")))
over_lines("normalized_frequency", lambda d: _FOUND(patterns.normalised_frequency(d)))
over_lines("prefix_footers", lambda d: _FOUND(patterns.prefixed_footers(d)))
over_lines("similar_lines", lambda d: _FOUND(patterns.similar_lines(d)))
over_stored("pattern_detect", lambda d: _FOUND(patterns.detect(d)))
over_stored("pattern_dedupe", lambda d: _FOUND(patterns.detect(d, similar=False)))
over_stored("pattern_order", lambda d: patterns.detect(d, similar=False).select("book", "place", "text"))
over_stored("pattern_classify", lambda d: _FOUND(patterns.classify(patterns.detect(d, similar=False))))
over_stored("line_removal", lambda d: patterns.removal(d, patterns.removable(patterns.classify(patterns.detect(d, similar=False)))).where("reason is not null").select("book", "line_no", "line", "reason"))
over_lines("removal_counts", lambda d: patterns.audit(d).groupBy("stage", "reason").agg(F.count("*").alias("n")))
over_lines("similar_footer_removal", lambda d: patterns.staged(d)["removed"].where("reason = 'similarity_match'").select("book", "line_no", "line"))
over_lines("incode_cleanup", lambda d: patterns.code_furniture(d).where("reason is not null").select("book", "line_no", "line", "reason"))
over_lines("merge_code_blocks", lambda d: patterns.merged_code_blocks(d).where("gone").select("book", "line_no"))
over_lines("merge_tables", lambda d: patterns.merged_tables(d).where("gone").select("book", "line_no"))
over_lines("merge_page_blocks", lambda d: layout.merged_blocks(d).select("book", "line_no", "line"))
over_lines("blank_compress", lambda d: patterns.compressed_blanks(d).select("book", "line_no", "line"))
over_lines("strip_pipeline", lambda d: patterns.clean(d).select("book", "line_no", "line"))
over_stored("strip_stats", lambda d: patterns.clean_stats(d, patterns.clean(d)))
over_lines("heading_numbering", lambda d: hierarchy.numbered(structure.headings(d)).select("book", "line_no", "rule_level", "numbering", "confidence"))
over_lines("header_pollution", lambda d: hierarchy.polluted(structure.headings(d)).select("book", "line_no", "occurrences", "polluted"))
over_lines("skeleton_interval", lambda d: hierarchy.skeleton(structure.headings(d)).select("book", "line_no", "is_rule", "prev_level", "prev_numbering", "next_level", "next_numbering"))
over_lines("inline_sections", lambda d: structure.headings(d).select("book", "line_no", hierarchy.inline_title(F.col("title")).alias("inline")))
over_lines("heading_levels", lambda d: hierarchy.levels(structure.headings(d)).select("book", "line_no", "new_level", "method", "confidence"))
over_lines("hierarchy_rewrite", lambda d: hierarchy.rewritten(d).select("book", "line_no", "line"))
over_lines("hierarchy_stats", lambda d: hierarchy.hierarchy_stats(structure.headings(d)))
over_lines("typed_fences", lambda d: codeblocks.typed_fences(d).select("book", "line_no", "in_code", "role"))


def over_marked(name: str, f: Callable[[DataFrame], DataFrame]) -> None:
    over_lines(name, lambda d: f(codeblocks.typed_fences(d)))


over_marked("indented_fences", lambda m: codeblocks.indented_fences(m).select("book", "line_no", "confidence"))
over_marked("prose_in_code", lambda m: codeblocks.prose_in_code(m).select("book", "line_no", "confidence"))
over_marked("code_outside", lambda m: codeblocks.code_outside(m).select("book", "line_no"))
over_marked("prose_groups", lambda m: codeblocks.prose_groups(codeblocks.prose_in_code(m)).select("book", "first_line", "last_line", "n"))
over_marked("unclosed_blocks", lambda m: codeblocks.unclosed(m).select("book", "line_no", "confidence"))
over_marked("issue_counts", lambda m: codeblocks.issue_counts(codeblocks.issues(checkpointed(m))))
over_marked("issue_report", lambda m: codeblocks.shown(codeblocks.issues(checkpointed(m))).select("book", "line_no", "type", "content"))
over_marked("surrounding_lines", lambda m: codeblocks.surrounding(m, codeblocks.prose_in_code(m)))
over_lines("fence_pair_cleanup", lambda d: codeblocks.without_adjacent_fences(d).select("book", "line_no", "line"))
over_lines("codeblock_repair", lambda d: codeblocks.repaired(d).select("book", "line_no", "line"))
over_lines("image_links", figures.image_links)
over_lines("figure_context", figures.figure_context)
over_lines("relative_links", lambda d: figures.relative_links(d.withColumn("line", F.replace(F.col("line"), F.lit("](out/"), F.lit("](/srv/output/./"))), "/srv/docs").where("found > 0").select("book", "line_no", "line", "found", "changed"))


def _answers(rows: DataFrame, answer: Column) -> DataFrame:
    """Made-up answers, as a table of recorded ones would hold them."""
    return rows.withColumn("answer", answer)


@query
def pattern_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checkpointed(patterns.classify(patterns.detect(checkpointed(books(spark, sf_dir)), similar=False)))
    words = F.when(F.col("count") % 3 == 0, "FOOTER").when(F.col("count") % 3 == 1, "content").otherwise("maybe")
    given = judged.doubtful(found).groupBy("book").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", words)))).alias("json"))
    answers = given.select("book", F.concat(F.lit("```json\n"), "json", F.lit("\n```")).alias("answer"))
    return _FOUND(judged.validated(found, answers))


@query
def line_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = books(spark, sf_dir)
    said = F.when(F.col("line_no") % 4 == 0, "It is a FOOTER.").when(F.col("line_no") % 4 == 1, "page_number").when(F.col("line_no") % 4 == 2, "no idea")
    return judged.furniture_lines(_answers(lines, said))


@query
def issue_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checkpointed(codeblocks.issues(checkpointed(codeblocks.typed_fences(books(spark, sf_dir)))))
    said = F.when(F.col("line_no") % 2 == 0, 'Yes: {"is_issue": true, "confidence": 0.9}').when(F.col("line_no") % 3 == 0, '{"is_issue": true, "confidence": 0.5}').otherwise("unsure")
    answers = judged.issue_answers(_answers(found.where("confidence = 'LOW'"), said))
    return codeblocks.verified(found, answers).select("book", "line_no", "type", "confidence")


@query
def heading_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checkpointed(structure.headings(books(spark, sf_dir)))
    said = F.when(F.col("line_no") % 5 == 0, "none").otherwise(F.concat(F.lit("H"), (F.col("line_no") % 6 + 1).cast("string")))
    return judged.judged_levels(found, _answers(found, said).select("book", "line_no", "answer")).select("book", "line_no", "new_level", "method", "confidence")


@query
def chunk_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that answers with the first words of the title and three keywords."""
    parts = checkpointed(structure.chunks(books(spark, sf_dir)))

    def answer(prompt: str) -> str:
        title = prompt.split("Title: ", 1)[1].split("\n", 1)[0]
        return json.dumps({"摘要": f" About {title}", "keywords": "one， two,three"}, ensure_ascii=False)

    found = judged.summaries(parts, lambda: providers.Recorded(answer))
    return found.select("book", "id", "summary", F.array_join("keywords", ",").alias("keywords"))


@query
def offline_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged.offline_summaries(checkpointed(structure.chunks(books(spark, sf_dir))))
    return found.select("book", "id", F.array_join("keywords", ",").alias("keywords"))


def _book(docs: DataFrame) -> Column:
    return F.concat_ws("-", "source", (F.col("doc_id") / 4000).cast("long").cast("string"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An image record for each document."""
    docs = documents(spark, sf_dir)
    return docs.select(_book(docs).alias("book"), F.col("doc_id").alias("ord"), F.concat(F.lit("rec_"), F.col("doc_id").cast("string")).alias("image_id"), F.col("n_chars").alias("size_bytes"), (F.col("doc_id") % 700).cast("double").alias("area"), F.when(F.col("doc_id") % 3 == 0, F.col("doc_id") % 500).alias("pixels"))


@query
def image_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures.paired(figures.image_links(books(spark, sf_dir)), _records(spark, sf_dir)).select("book", "ordinal", "basename", "image_id")


@query
def image_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures.mismatched(figures.image_links(books(spark, sf_dir)), _records(spark, sf_dir))


@query
def image_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures.evaluated(_records(spark, sf_dir), least_area=100, least_pixels=50).select("book", "image_id", "drop_reasons", "keep")


@query
def image_filter_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = _records(spark, sf_dir)
    return figures.filter_summary(figures.evaluated(figures.paired(figures.image_links(books(spark, sf_dir)), records), least_area=100, least_pixels=50), records)


@query
def image_pairing_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of every seventh link are missing, which moves all later pairs."""
    links = figures.image_links(books(spark, sf_dir))
    there = links.select("basename", F.regexp_extract("basename", "[0-9]+", 0).cast("long").alias("n"))
    there = there.select(F.when(F.col("n") % 7 != 0, F.col("basename")).alias("basename"))
    return figures.paired(links, _records(spark, sf_dir), there).select("book", "ordinal", "basename", "image_id")


@query
def describe_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = books(spark, sf_dir)
    context = figures.figure_context(lines, 200, 150).join(figures.breadcrumbs(lines), ["book", "line_no"])
    kept = figures.image_links(lines).select("book", "ordinal", "basename")
    said = F.when(F.col("ordinal") % 3 == 1, F.concat(F.lit("\r\n read \t "), "basename")).when(F.col("ordinal") % 3 == 2, " \n")
    read = kept.select("book", F.col("ordinal").alias("ord"), F.concat(F.lit("out/"), "basename").alias("path"), said.alias("ocr_text"), F.when(F.col("ordinal") % 5 == 0, "no reader").alias("ocr_error"))
    ocr = figures.ocr_records(read)
    return figures.describe_input(kept, context, ocr, 300).select("book", "basename", "section", "document_context", "ocr")


@query
def figure_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that reads the image_id off the prompt and gives too high a
    confidence; it fails for every fifth figure."""

    def answer(prompt: str) -> str:
        name = prompt.split('- image_id: "', 1)[1].split('"', 1)[0]
        return "no" if int(name.removeprefix("rec_")) % 5 == 0 else 'Here: {"title": "T ' + name + '", "confidence": "7", "keywords": "none"} .'

    records = _records(spark, sf_dir).select("image_id", F.concat("image_id", F.lit(".png")).alias("image_path"), F.lit("").alias("image_url"), F.lit("s").alias("section"))
    found = providers.describe(records, lambda: providers.Recorded(answer))
    return found.select("image_id", "ok", F.get_json_object("record", "$.title").alias("title"), F.get_json_object("record", "$.confidence").cast("double").alias("sure"), F.get_json_object("record", "$.summary").alias("summary"), F.get_json_object("record", "$.image_path").alias("image_path"))


@query
def record_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute paths in two folders, by the marker and by the folder's name."""
    folder = F.when(F.col("ord") % 2 == 0, "/srv/output/./a/").otherwise("/data/out/")
    records = _records(spark, sf_dir).select("image_id", F.concat(folder, "image_id").alias("image_path"))
    marked = figures.record_paths(records).withColumnRenamed("image_path", "by_marker")
    return marked.join(figures.record_paths(records, "/data"), "image_id")


@query
def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.batch_report(_records(spark, sf_dir).withColumn("ok", F.col("ord") % 5 != 0))


@query
def enrich_inject(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = books(spark, sf_dir)
    links = figures.image_links(lines).withColumn("basename", F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("other_"), "basename")).otherwise(F.col("basename")))
    block = figures.enrichment_block(F.col("basename"), F.lit(" a figure "), F.array(F.lit("one"), F.lit(" two ")), F.lit("unknown"))
    return figures.injected(lines, links.select("book", "basename", block.alias("block"))).select("book", "line_no", "line")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return docs.groupBy(_book(docs).alias("book")).agg((F.count("*") * 3).cast("int").alias("total_pages"))


def _outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An entry for each document, three pages apart; each seventh is a chapter."""
    docs = documents(spark, sf_dir)
    rows = docs.select(_book(docs).alias("book"), "doc_id").withColumn("ord", F.row_number().over(Window.partitionBy("book").orderBy("doc_id")))
    return rows.select("book", "ord", F.when(F.col("ord") % 7 == 1, 0).otherwise(1).alias("depth"), F.concat(F.lit("part "), F.col("ord").cast("string")).alias("title"), (3 * (F.col("ord") - 1) + F.when(F.col("ord") % 7 == 1, 1).otherwise(0)).cast("int").alias("page"))


@query
def fixed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fixed_ranges(_sizes(spark, sf_dir), 20)


@query
def chapter_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.chapter_ranges(packing.chapters(_outline(spark, sf_dir)), _sizes(spark, sf_dir), 8)


@query
def bookmark_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.bookmarks(_outline(spark, sf_dir).withColumn("page", F.col("page") * 2), _sizes(spark, sf_dir))


@query
def atomic_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    regions = _sizes(spark, sf_dir).select("book", F.lit(0).alias("region"), F.lit(2).alias("start_page"), F.col("total_pages").alias("end_page"))
    return packing.atomic_ranges(_outline(spark, sf_dir), regions, _sizes(spark, sf_dir))


@query
def packed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.outline_smart(_outline(spark, sf_dir), _sizes(spark, sf_dir), 20)


@query
def chapter_first_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.chapter_first(_outline(spark, sf_dir), _sizes(spark, sf_dir), 10)


@query
def size_bounded_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes, outline = _sizes(spark, sf_dir), _outline(spark, sf_dir)
    pages = sizes.select("book", F.explode(F.sequence(F.lit(0), F.col("total_pages") - 1)).alias("page")).withColumn("bytes", 1000 + F.col("page") % 7 * 500)
    ranges = packing.fixed_ranges(sizes, 50)
    return packing.by_size(ranges, pages, packing.bookmarks(outline, sizes), 30_000)


@query
def split_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.manifest(packing.fixed_ranges(_sizes(spark, sf_dir), 20))


@query
def resumed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = packing.manifest(packing.fixed_ranges(_sizes(spark, sf_dir), 20))
    done = parts.select(F.when(F.col("part_no") % 2 == 1, F.col("stem")).alias("stem"))
    return stages.resumed(parts, 2, done).select("book", "part_no", "stem")


@query
def merge_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    parts = docs.select(_book(docs).alias("base_stem"), F.col("doc_id").alias("part_no"), F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("title"), "text")
    return merge.merged_text(parts)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three parts of each book, in two folders."""
    docs = documents(spark, sf_dir)
    part, i = F.col("doc_id") % 3 + 1, F.col("doc_id")
    stem = F.concat(_book(docs), F.lit("_pt00"), part.cast("string"))
    name = F.when(i % 11 == 0, F.concat(F.lit("cover"), i.cast("string"), F.lit(".png"))).otherwise(F.concat(F.lit("image_"), F.lpad((i % 40).cast("string"), 6, "0"), F.lit("_"), i.cast("string"), F.lit(".png")))
    folder = F.when(i % 2 == 0, "images").otherwise("artifacts")
    return docs.select(_book(docs).alias("base_stem"), part.cast("int").alias("part_no"), stem.alias("stem"), F.concat(stem, F.lit("_"), folder, F.lit("/"), name).alias("path"), folder.alias("folder"), i.alias("doc_id"))


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("stem").orderBy("path")
    return merge.copy_map(_files(spark, sf_dir).withColumn("rank", F.row_number().over(order)))


@query
def artifact_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.deduplicated_artifacts(_files(spark, sf_dir)).select("stem", "idx", "path", "rank")


@query
def richer_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.richer_folder(_files(spark, sf_dir))


@query
def path_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that are exact, with dots, bare names, in other folders, unknown, and blank."""
    i, name = F.col("doc_id"), F.element_at(F.split("path", "/"), -1)
    path = (
        F.when(i % 6 == 0, F.concat(F.lit("./"), "path")).when(i % 6 == 1, name).when(i % 6 == 2, F.concat(F.lit("old/place/"), name))
        .when(i % 6 == 3, F.concat(F.lit("gone/"), i.cast("string"))).when(i % 6 == 4, F.lit("  ")).otherwise(F.col("path"))
    )
    records = _files(spark, sf_dir).select("base_stem", "part_no", "stem", F.col("doc_id").alias("ord"), path.alias("image_path"))
    return merge.resolved_paths(records, _mapping(spark, sf_dir)).select("stem", "ord", "new_path")


@query
def path_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of Markdown, and some as tags with more dots in front or backslashes."""
    link = F.when(F.col("doc_id") % 8 == 0, F.concat(F.lit('<img alt="" src=".././'), "path", F.lit('">')))
    link = link.when(F.col("doc_id") % 8 == 4, F.concat(F.lit('<img alt="" src=".\\'), F.replace("path", F.lit("/"), F.lit("\\")), F.lit('">'))).otherwise(F.concat(F.lit("![x](./"), "path", F.lit(")")))
    texts = _files(spark, sf_dir).groupBy("base_stem").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", link.alias("link")))), lambda x: x["link"]), "\n").alias("text"))
    return merge.rewritten_paths(texts, _mapping(spark, sf_dir))


@query
def merged_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _files(spark, sf_dir)
    return merge.merged_images(docs.select("stem", "doc_id", F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.concat(F.lit("fig_"), F.col("doc_id").cast("string"))).alias("image_id"))).select("doc_id", "image_id", "source_part_stem")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as a file: its text under a heading, and a page with a
    table, a picture and a second heading."""
    docs = documents(spark, sf_dir).where("doc_id is not null")
    i = F.col("doc_id").cast("string")
    text = F.concat(F.lit("# Title "), i, F.lit("\n\n"), F.coalesce("text", F.lit("")), F.lit("\f| a | b |\n![x](y.png)\n##  Part "), i)
    return docs.select(i.alias("book"), F.encode(text, "UTF-8").alias("content"))


@query
def layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.scan_layout(_pages(spark, sf_dir), rebuild=100).select("book", "ord", "label", "text", "level", "page_no")


@query
def outline_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return providers.scan_outline(_pages(spark, sf_dir))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An item for each document: three a page, with page furniture at the edges."""
    docs = documents(spark, sf_dir)
    i = F.col("doc_id")
    label = F.when(i % 10 == 0, "PICTURE").when(i % 10 == 1, "SECTION_HEADER").when(i % 10 == 2, "PAGE_FOOTER").otherwise("TEXT")
    return docs.select(
        _book(docs).alias("book"), i.alias("ord"), label.alias("label"), F.when(i % 10 == 2, "All rights reserved 12").otherwise(F.substring("text", 1, 20)).alias("text"), F.when(i % 10 == 1, (i % 3 + 1).cast("int")).alias("level"),
        (i / 60).cast("int").alias("page_no"), F.lit(50.0).alias("l"), (i % 84 * 10).cast("double").alias("t"), F.lit(500.0).alias("r"), (i % 84 * 10 + 9).cast("double").alias("b"), F.lit("TOPLEFT").alias("origin"), F.lit(842.0).alias("page_height"),
    )


@query
def edge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.edge_texts(_items(spark, sf_dir), least=1)


@query
def edge_text_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = books(spark, sf_dir)
    texts = lines.where("line like '%All rights reserved'").select("book", F.when(F.col("doc_id") % 2 == 0, F.col("line")).otherwise(F.concat("line", F.lit(" of it"))).alias("text"))
    return layout.without_edge_texts(lines, texts).select("book", "line_no", "line")


@query
def label_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.label_stats(_items(spark, sf_dir))


@query
def image_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _items(spark, sf_dir).withColumn("captions", F.when(F.col("ord") % 20 == 0, F.array("text", F.lit(""), F.lit("b"))).otherwise(F.array().cast("array<string>")))
    return layout.image_index(items).select("book", "image_id", "page_no", "area", "caption", F.to_json("bbox").alias("bbox"))


@query
def layout_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.markdown(_items(spark, sf_dir))


@query
def hybrid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of chunk titles against the chunks of the same book, and closeness of their places."""
    words = structure.chunk_keywords(structure.chunks(books(spark, sf_dir)))
    keyword = words.select(F.concat_ws(":", "book", "keyword").alias("query_id"), "id", (1 / F.col("rank")).alias("score"))
    vector = words.select(F.concat_ws(":", "book", "keyword").alias("query_id"), "id", (1 / (1 + F.col("rank") % 3)).alias("score"))
    return search.hybrid(keyword, vector).select("query_id", "id", "rank", F.round("score", 6).alias("score"))


@query
def vector_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    stated = vectors.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return search.nearest(stated, vectors).select("query_id", "vec_id", "rank")
