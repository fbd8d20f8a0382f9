"""The stages as composed plans, and timed runs of them."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import providers
from ..functions.storage import checkpointed
from ..operators import codeblocks, figures, hierarchy, patterns, structure
from ..operators import layout as layout_ops


def clean_lines(lines: DataFrame, base: int = 1, similar: bool = True) -> DataFrame:
    """Page furniture out, headings at their levels, code blocks repaired."""
    rows = checkpointed(patterns.clean(lines, similar))
    return codeblocks.repaired(checkpointed(hierarchy.rewritten(rows, base)))


def enrich(lines: DataFrame, described: DataFrame) -> DataFrame:
    """Blocks after figures; described (book, basename, title, summary, keywords, ocr_text)."""
    block = figures.enrichment_block(F.col("title"), F.col("summary"), F.col("keywords"), F.col("ocr_text"))
    return figures.injected(lines, described.select("book", "basename", block.alias("block")))


def dual_index(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The index at depth 4 and at depth 2."""
    return structure.index_json(lines, 4), structure.index_json(lines, 2)


def timed(spark: SparkSession, steps: dict[str, Callable[[], DataFrame]], stop: bool = False) -> DataFrame:
    """Runs each step to the end; step, seconds, ok, error.  ``stop``: none
    after one that failed."""
    out = []
    for name, step in steps.items():
        began, error = time.time(), None
        try:
            step().write.format("noop").mode("overwrite").save()
        except Exception as failed:  # noqa: BLE001  the log has the failure, later steps still run
            error = str(failed)[:2000]
        out.append((name, round(time.time() - began, 3), error is None, error))
        if error and stop:
            break
    return spark.createDataFrame(out, "step string, seconds double, ok boolean, error string")


def precheck(spark: SparkSession, inputs: dict[str, str], settings: dict[str, str] | None = None) -> list[str]:
    """What is missing: inputs (name: path) that don't exist, settings without a value."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = lambda x: path(x).getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(x))
    return [f"input {name}: {x}" for name, x in inputs.items() if not there(x)] + [f"setting {name}" for name, x in (settings or {}).items() if not x]


def resumed(parts: DataFrame, start: int = 1, done: DataFrame | None = None) -> DataFrame:
    """Parts from number ``start`` on (from 1), without those whose stem is done."""
    rows = parts.where(F.col("part_no") >= start)
    return rows if done is None else rows.join(done.select("stem").distinct(), "stem", "left_anti")


def batch_report(results: DataFrame) -> DataFrame:
    """total, succeeded, failed, status (0 if all succeeded) of results (ok)."""
    rows = results.agg(F.count("*").alias("total"), F.coalesce(F.sum(F.col("ok").cast("long")), F.lit(0)).alias("succeeded"))
    return rows.select("total", "succeeded", (F.col("total") - F.col("succeeded")).alias("failed"), F.when(F.col("succeeded") == F.col("total"), 0).otherwise(1).alias("status"))


def converted(files: DataFrame, layout: Callable[[], providers.Layout] = providers.PlainPages, margin_least: int = 3, rebuild: int = 0) -> dict[str, DataFrame]:
    """Files (book, content) as lines of Markdown without page headers and
    footers, with code blocks that pages part joined; image records; counts."""
    items = checkpointed(providers.scan_layout(files, layout, rebuild))
    lines = layout_ops.markdown(items).withColumn("doc_id", F.lit(None).cast("long"))
    lines = layout_ops.without_edge_texts(lines, layout_ops.edge_texts(items, least=margin_least))
    return {"lines": layout_ops.merged_blocks(lines), "images": layout_ops.image_index(items), "stats": layout_ops.label_stats(items)}


def every_stage(lines: DataFrame, images: DataFrame | None = None, described: DataFrame | None = None, folder: str = "/", base: int = 1) -> dict[str, DataFrame]:
    """Clean lines, headings and code blocks; links relative to the folder;
    filtered images; figure context; enriched lines; the index at two depths."""
    cleaned = checkpointed(clean_lines(lines, base))
    linked = checkpointed(figures.relative_links(cleaned, folder).select("book", "doc_id", "line_no", "line"))
    out = {"clean": linked, "context": figures.figure_context(linked), "trails": figures.breadcrumbs(linked)}
    if images is not None:
        out["images"] = figures.evaluated(figures.paired(figures.image_links(linked), images))
    enriched = checkpointed(enrich(linked, described)) if described is not None else linked
    deep, flat = dual_index(enriched)
    return out | {"enriched": enriched, "index": deep, "index_h2": flat}
