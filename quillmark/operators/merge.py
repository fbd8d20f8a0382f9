"""Merging of split parts: text, assets, paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import basename, strip


def checked_parts(parts: DataFrame, texts: DataFrame) -> DataFrame:
    """Manifest parts (base_stem, part_no, stem, title) with their texts; a missing part is an error when read."""
    rows = parts.join(texts, "stem", "left")
    return rows.withColumn("text", F.when(F.col("text").isNotNull(), F.col("text")).otherwise(F.raise_error(F.concat(F.lit("no text for part "), "stem"))))


def merged_text(parts: DataFrame) -> DataFrame:
    """base_stem, text: parts (base_stem, part_no, title, text) in order, each
    behind ``<!-- split part i/N: title -->``."""
    of = Window.partitionBy("base_stem")
    rows = parts.withColumns({"i": F.row_number().over(of.orderBy("part_no")), "n": F.count("*").over(of)})
    piece = F.concat(F.lit("<!-- split part "), F.col("i").cast("string"), F.lit("/"), F.col("n").cast("string"), F.lit(": "), F.col("title"), F.lit(" -->\n\n"), F.col("text"))
    rows = rows.groupBy("base_stem").agg(F.array_sort(F.collect_list(F.struct("i", piece.alias("piece")))).alias("x"))
    return rows.select("base_stem", F.array_join(F.transform("x", lambda s: s["piece"]), "\n\n").alias("text"))


def deduplicated_artifacts(files: DataFrame) -> DataFrame:
    """stem, path, rank of files: the first by name for each image index, in
    order; files without an index last."""
    number = F.regexp_extract(basename(F.col("path")), r"_(\d+)(_[^/]*|\.[^/]*)$", 1)
    rows = files.withColumn("idx", F.nullif(number, F.lit("")).cast("int"))
    known = rows.where("idx is not null").groupBy("stem", "idx").agg(F.min("path").alias("path"))
    rest = rows.where("idx is null").select("stem", F.lit(None).cast("int").alias("idx"), "path")
    order = Window.partitionBy("stem").orderBy(F.col("idx").asc_nulls_last(), "path")
    return known.unionByName(rest).withColumn("rank", F.row_number().over(order))


def richer_folder(files: DataFrame) -> DataFrame:
    """stem, folder, n: the folder with more image files (the first by name on ties)."""
    counts = files.groupBy("stem", "folder").agg(F.count("*").alias("n"))
    return counts.groupBy("stem").agg(F.max_by(F.struct("folder", "n"), F.struct("n", F.col("folder") == "images", F.col("folder"))).alias("b")).select("stem", "b.*")


def copy_map(files: DataFrame) -> DataFrame:
    """base_stem, part_no, stem, place, old, new: where each part's asset goes
    in the one merged folder; files (base_stem, part_no, stem, rank, path)."""
    new = F.concat(F.col("base_stem"), F.lit("_merged_images/"), F.concat_ws("_", "stem", basename(F.col("path"))))
    return files.select("base_stem", "part_no", "stem", F.col("rank").alias("place"), F.col("path").alias("old"), new.alias("new"))


def bare_path(x: Column) -> Column:
    """With slashes, without any leading dots and slashes."""
    return F.regexp_replace(F.replace(x, F.lit("\\"), F.lit("/")), "^[./]+", "")


def resolved_paths(records: DataFrame, mapping: DataFrame) -> DataFrame:
    """Records (base_stem, part_no, stem, ord, image_path) with new_path: by the
    bare path, for a bare name in the stem's folders, else by the name in the
    first part, up to their own, that holds it.  A blank path takes the file at
    the record's place among its part's; one that nothing resolves stays."""
    path = F.col("image_path")
    rows = records.withColumns({"plain": bare_path(path), "name": basename(path), "blank": F.length(strip(F.coalesce(path, F.lit("")))) == 0})
    alone = ~F.contains("plain", F.lit("/"))
    tries = [F.col("plain"), *(F.when(alone, F.concat("stem", F.lit(f"_{folder}/"), "plain")) for folder in ("images", "artifacts"))]
    exact = mapping.groupBy("base_stem", F.col("old").alias("key")).agg(F.max_by("new", "part_no").alias("new"))
    for i, key in enumerate(tries):
        rows = rows.withColumn("key", F.when(~F.col("blank"), key)).join(exact.withColumnRenamed("new", f"f{i}"), ["base_stem", "key"], "left").drop("key")
    first = F.min_by(F.struct("part_no", "new"), F.struct("part_no", "place")).alias("end")
    ends = mapping.where(F.contains("old", F.lit("/"))).groupBy("base_stem", basename(F.col("old")).alias("name")).agg(first)
    places = mapping.select("base_stem", "part_no", "place", F.col("new").alias("by_place"))
    rows = rows.join(ends, ["base_stem", "name"], "left")
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("base_stem", "part_no").orderBy("ord"))).join(places, ["base_stem", "part_no", "place"], "left")
    by_end = F.when(~F.col("blank") & (F.col("end.part_no") <= F.col("part_no")), F.col("end.new"))
    new = F.coalesce(*(F.col(f"f{i}") for i in range(len(tries))), by_end, F.when(F.col("blank"), F.col("by_place")), path)
    return rows.withColumn("new_path", new).select(*records.columns, "new_path")


def path_variants(x: Column) -> Column:
    """The ways in which a text may have a path, the longest first."""
    x = F.replace(x, F.lit("\\"), F.lit("/"))
    dotted = F.concat(F.lit("./"), x)
    return F.when(F.startswith(x, F.lit("./")), F.array(dotted, x, F.substring(x, 3, 1 << 30))).otherwise(F.array(dotted, x))


def rewritten_paths(texts: DataFrame, mapping: DataFrame) -> DataFrame:
    """base_stem, text with old paths replaced, the longest first, then those of
    ``<img src>``, which may have other dots and slashes in front.  A text's
    mapping is bounded by the files of its parts."""
    one = mapping.select("base_stem", F.explode(path_variants(F.col("old"))).alias("old"), "new")
    pairs = one.groupBy("base_stem").agg(F.array_sort(F.collect_list(F.struct((-F.length("old")).alias("order"), "old", "new"))).alias("pairs"))
    tags = mapping.groupBy("base_stem", "old").agg(F.max_by("new", "part_no").alias("new")).groupBy("base_stem").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("tags"))
    rows = texts.join(pairs, "base_stem", "left").join(tags, "base_stem", "left")
    rows = rows.withColumn("text", F.when(F.col("pairs").isNull(), F.col("text")).otherwise(F.aggregate("pairs", F.col("text"), lambda acc, p: F.replace(acc, p["old"], p["new"]))))
    # pieces between tags, and the sources of the tags
    mark = r"(?i)(<img[^>]+src=[\"'])([^\"']+)([\"'])"
    sources = F.regexp_extract_all("text", F.lit(mark), F.lit(2))
    made = F.aggregate(sources, F.col("text"), lambda acc, x: F.when(F.element_at("tags", bare_path(x)).isNull(), acc).otherwise(F.replace(F.replace(acc, F.concat(F.lit('"'), x, F.lit('"')), F.concat(F.lit('"'), F.element_at("tags", bare_path(x)), F.lit('"'))), F.concat(F.lit("'"), x, F.lit("'")), F.concat(F.lit("'"), F.element_at("tags", bare_path(x)), F.lit("'")))))
    return rows.withColumn("text", F.when(F.col("tags").isNull(), F.col("text")).otherwise(made)).select(*texts.columns)


def merged_images(records: DataFrame) -> DataFrame:
    """Image records of parts as one list; ids get their part's stem, blank ones stay."""
    named = F.length(F.coalesce("image_id", F.lit(""))) > 0
    return records.withColumn("image_id", F.when(named, F.concat_ws("__", "stem", "image_id")).otherwise(F.col("image_id"))).withColumn("source_part_stem", F.col("stem"))
