"""Sources and sinks of line tables.

The unit is ``lines(book, doc_id, line_no, line)``; line_no is 1-based within a
book.  ``composed`` makes books with headings, fences, tables, figures and
page furniture from the documents table: a book is a run of documents of one
source (at most ``BOOK_IDS`` consecutive ids), so its windows stay bounded.
"""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.paths import rewritten_keys

#: Ids of one source that make a book.
BOOK_IDS = 4000
FENCE = "```"
_TAIL = 1_000_000_000

IMAGES = "image_id string, label string, page_no int, bbox struct<l:double,t:double,r:double,b:double>, text string, caption string, image_path string, prov array<struct<page_no:int,bbox:struct<l:double,t:double,r:double,b:double>>>"
MANIFEST = "base_stem string, source_pdf string, max_pages int, max_part_kb int, parts array<struct<stem:string,pdf:string,title:string,page_start_1based:int,page_end_1based_inclusive:int>>"
FIGURES = "image_id string, doc_id string, page int, section string, image_type string, title string, summary string, keywords array<string>, entities array<string>, retrieval_text string, ocr_text string, confidence double, image_path string"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def composed(docs: DataFrame) -> DataFrame:
    """The books that the documents make, as lines."""
    book = F.concat_ws("-", "source", (F.col("doc_id") / BOOK_IDS).cast("long").cast("string"))
    parts = docs.where("doc_id is not null and source is not null").select(book.alias("book"), "doc_id", "lang", "source", F.split(F.coalesce("text", F.lit("")), "\n").alias("body"))
    parts = parts.withColumn("part_no", F.row_number().over(Window.partitionBy("book").orderBy("doc_id")).cast("string"))
    t, n, i = F.substring(F.get("body", F.lit(0)), 1, 24), F.size("body"), F.col("doc_id")

    def row(slot: int, line, when=None):
        made = F.struct(F.lit(slot).cast("long").alias("slot"), line.alias("line"))
        return F.array(made) if when is None else F.when(when, F.array(made)).otherwise(F.expr("cast(array() as array<struct<slot:bigint,line:string>>)"))

    text = lambda *xs: F.concat(*(x if not isinstance(x, str) else F.lit(x) for x in xs))
    p = F.col("part_no")
    heading = (
        F.when(i % 6 == 0, text("## ", p, ". ", t)).when(i % 6 == 1, text("## ", p, ".1 ", t)).when(i % 6 == 2, text("## ", p, ".1.1 ", t))
        .when(i % 6 == 3, F.lit("## Rules")).when(i % 12 == 10, text("## Overview of ", t, " #")).when(i % 6 == 4, text("## Overview of ", t)).otherwise(text("## A.", p, " ", t))
    )
    code = (i % 5 == 0) & (n >= 3)
    again, furniture, tildes = code & (i % 15 == 5), code & (i % 10 == 0), i % 12 == 7
    draft = F.element_at(F.array(*map(F.lit, ("first", "third", "sixth", "tenth"))), (F.col("part_no").cast("int") % 4 + 1))
    slots = F.concat(
        row(0, text("## IEEE Standard for ", F.col("book"), " interfaces")), row(1, F.lit("")), row(2, heading), row(3, F.lit("")),
        F.transform("body", lambda x, k: F.struct((100 + 10 * (k + 1)).cast("long").alias("slot"), x.alias("line"))),
        row(119, F.lit(FENCE), code), row(131, F.lit(FENCE), code), row(125, p, (i % 10 == 0) & (n >= 3)),
        row(126, text("Copyright © 2024 by ", p), furniture), row(127, text("Page ", p), furniture), row(128, text("authorized licensed use limited to member ", p), furniture),
        row(132, F.lit(""), again), row(133, F.lit(FENCE), again), row(134, text("value", p, " = compute(a, b);"), again), row(135, text("This is a sentence of plain prose that stands alone in the code of part ", p), again), row(136, F.lit(FENCE), again),
        row(_TAIL - 10, F.lit("~~~~ text"), tildes), row(_TAIL - 9, text("This is a sentence of plain prose that stands in a block of tildes of part ", p), tildes),
        row(_TAIL - 8, text("And this is a second sentence of plain prose in the same block of part ", p), tildes), row(_TAIL - 7, F.lit(FENCE), tildes), row(_TAIL - 6, F.lit("~~~"), tildes), row(_TAIL - 5, F.lit("~~~~~ end"), tildes),
        row(_TAIL, F.lit("| id | lang |"), i % 5 == 1), row(_TAIL + 1, F.lit(""), i % 5 == 1), row(_TAIL + 2, text("| ", i.cast("string"), " | ", F.col("lang"), " |"), i % 5 == 1),
        row(_TAIL + 10, text("![fig](out/", F.col("book"), "_images/fig_", i.cast("string"), ".png)"), i % 4 == 0),
        row(_TAIL + 20, F.lit("    " + FENCE), i % 11 == 0),
        row(_TAIL + 31, F.lit(""), i % 7 == 0), row(_TAIL + 32, F.lit(""), i % 7 == 0), row(_TAIL + 33, F.lit(""), i % 7 == 0),
        row(_TAIL + 35, text("Copyrght 2023 2024 ", F.col("book"), " All rights reserved by ", p), i % 9 == 2), row(_TAIL + 30, F.lit(FENCE), i % 97 == 5), row(_TAIL + 37, text("  ", p, " Copyright 2023 2024 ", F.col("book"), " All rights reserved", F.when(i % 14 == 3, " and this stays in the text").otherwise(" short")), (i % 14).isin(3, 10)),
        row(_TAIL + 36, text("Working draft of the ", draft, " part")),
        row(_TAIL + 40, text(p, " Copyright 2023 2024 ", F.col("book"), " All rights reserved")), row(_TAIL + 41, p),
    )
    order = Window.partitionBy("book").orderBy("doc_id", "slot")
    return parts.select("book", "doc_id", F.explode(slots).alias("s")).select("book", "doc_id", "s.slot", "s.line").withColumn("line_no", F.row_number().over(order)).drop("slot")


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composed(documents(spark, sf_dir))


def text_lines(docs: DataFrame) -> DataFrame:
    """A document as its own book: line ends are made LF once, here."""
    text = F.regexp_replace(F.col("text"), "\r\n?", "\n")
    return docs.where("text is not null").select(F.col("doc_id").cast("string").alias("book"), "doc_id", F.posexplode(F.split(text, "\n")).alias("p", "line")).select("book", "doc_id", (F.col("p") + 1).alias("line_no"), "line")


def markdown_files(spark: SparkSession, path: str) -> DataFrame:
    """Markdown files as (path, text)."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def images_json(spark: SparkSession, path: str) -> DataFrame:
    """path and image records of image index files in their order; a file that
    holds no array is an error."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.trim("value").alias("value"))
    kind = f"array<struct<{IMAGES.replace(' string', ':string').replace(' int', ':int').replace(' struct', ':struct').replace(' array', ':array')}>>"
    read = F.when(F.startswith("value", F.lit("[")), F.from_json("value", kind)).otherwise(F.raise_error(F.concat(F.lit("not an array: "), "path")).cast(kind))
    return rows.select("path", F.posexplode(read).alias("ord", "x")).select("path", "ord", "x.*")


def figures_json(spark: SparkSession, path: str) -> DataFrame:
    """Figure descriptions; rows without image_id, dotfiles and reports are left out."""
    rows = spark.read.schema(FIGURES).option("multiLine", True).json(path).withColumn("file", F.col("_metadata.file_name"))
    return rows.where("image_id is not null and file not like '.%' and file not like '%report%'")


def manifest_json(spark: SparkSession, path: str) -> DataFrame:
    """Parts of split manifests; those without a stem or parts are errors."""
    rows = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    ok, kind = (F.length("base_stem") > 0) & (F.size("parts") > 0), rows.schema["parts"].dataType
    checked = rows.withColumn("parts", F.when(ok, F.col("parts")).otherwise(F.raise_error(F.lit("manifest without base_stem or parts")).cast(kind)))
    return checked.select("base_stem", F.posexplode("parts").alias("p", "part")).select("base_stem", (F.col("p") + 1).alias("part_no"), "part.*")


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """path, basename, size_bytes, and width and height by the headers of PNG,
    GIF, BMP and JPEG files (the latter's first frame in 64 KiB)."""
    rows = spark.read.format("binaryFile").load(path).withColumn("x", F.hex(F.substring("content", 1, 1 << 16)))
    part = lambda at, n: F.substring("x", 2 * at + 1, 2 * n)
    number = lambda h: F.conv(h, 16, 10).cast("int")
    turned = lambda h: F.array_join(F.reverse(F.regexp_extract_all(h, F.lit("(..)"), F.lit(1))), "")
    png, gif, bmp = F.startswith("x", F.lit("89504E470D0A1A0A")), F.startswith("x", F.lit("47494638")), F.startswith("x", F.lit("424D"))
    # segments of a JPEG up to its frame: marker, length, then precision, height, width
    frame = F.regexp_extract("x", "^FFD8(?:..)*?FFC[0-2](?:....)(?:..)(....)(....)", 1), F.regexp_extract("x", "^FFD8(?:..)*?FFC[0-2](?:....)(?:..)(....)(....)", 2)
    jpeg = F.startswith("x", F.lit("FFD8")) & (frame[0] != "")
    size = lambda a, b, c, d: F.when(png, number(part(a, 4))).when(gif, number(turned(part(b, 2)))).when(bmp, number(turned(part(c, 4)))).when(jpeg, number(d))
    return rows.select("path", F.element_at(F.split("path", "/"), -1).alias("basename"), F.col("length").alias("size_bytes"), size(16, 6, 18, frame[1]).alias("width"), size(20, 8, 22, frame[0]).alias("height"))


def data_url(path, content):
    """Image bytes as a data URL; the type follows the extension, PNG otherwise."""
    kind = F.lower(F.regexp_extract(path, r"\.([^.]+)$", 1))
    mime = F.when(kind.isin("jpg", "jpeg"), "image/jpeg").when(kind.isin("gif", "webp", "bmp"), F.concat(F.lit("image/"), kind)).otherwise("image/png")
    return F.concat(F.lit("data:"), mime, F.lit(";base64,"), F.base64(content))


def reassembled(lines: DataFrame) -> DataFrame:
    """book, text: lines joined in order."""
    return lines.groupBy("book").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("x")).select("book", F.array_join(F.transform("x", lambda s: F.coalesce(s["line"], F.lit(""))), "\n").alias("text"))


def write_markdown(lines: DataFrame, path: str) -> None:
    """Markdown files, a folder ``book=...`` for each; Spark's commit replaces
    the whole target or nothing."""
    reassembled(lines).repartition("book").write.mode("overwrite").partitionBy("book").text(path)


def write_audit(audit: DataFrame, path: str) -> None:
    """What stages took out, with reasons, by stage."""
    audit.write.mode("overwrite").partitionBy("stage").parquet(path)


def write_json(rows: DataFrame, path: str, by: str | None = None) -> None:
    """Sidecars, indexes and reports: a line of JSON for each row, in a folder
    for each value of ``by`` if given."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def rewritten_records(spark: SparkSession, source: str, target: str, schema: str, folder: str) -> None:
    """Records of JSON files with their paths (PATH_KEYS, at any depth) relative
    to ``folder``, written to ``target``; a target is never its own source."""
    rows = spark.read.schema(schema).option("multiLine", True).json(source)
    whole = F.struct(*rows.columns)
    made = rows.select(rewritten_keys(whole, StructType(rows.schema.fields), F.lit(folder)).alias("x")).select("x.*")
    made.write.mode("overwrite").json(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """A folder under another name, as one step: archives and replaced outputs."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path(target).getParent())
    if not system.rename(path(source), path(target)):
        raise OSError(f"can't move {source} to {target}")


def copied(mapping: DataFrame, source: str, target: str, copy: Callable[[str, str], None] = shutil.copy2) -> DataFrame:
    """old, new, ok, error of assets copied from ``source`` to ``target`` in
    parallel; ``copy`` takes two paths that workers can reach."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for old, new in zip(frame["old"], frame["new"], strict=True):
                try:
                    os.makedirs(os.path.dirname(os.path.join(target, new)), exist_ok=True)
                    copy(os.path.join(source, old), os.path.join(target, new))
                    rows.append((old, new, True, None))
                except OSError as error:
                    rows.append((old, new, False, str(error)))
            yield pd.DataFrame(rows, columns=["old", "new", "ok", "error"])

    return mapping.select("old", "new").mapInPandas(run, "old string, new string, ok boolean, error string")
