"""A corpus pipeline over ``documents``: quality rules, line dedup, SimHash
near-dedup, personal data, best-fit packing.  Belongs to quillmark.llm."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from quillmark.llm import common, line_dedup, packing, pii, quality_rules, simhash
from quillmark.llm.queries import PIECES


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null and empty texts have no words and go; each of repeated rows is judged
    alike; extra columns pass whatever their names; an empty table stays empty."""
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines whose template recurs across documents, rare variants of such
    lines, and short lines that recur exactly go; documents stay.

    Null texts stay null; a text may become empty; blank lines stay; rows that
    repeat another row (doc_id and text) are cut alike, in the order of doc_id
    with null first; extra columns pass whatever their names (n_chars follows
    the text); an empty table stays empty."""
    return line_dedup.dedup_lines(docs, near=True, short=True, counts=False)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the row with the
    smallest doc_id, null last.

    Null, empty and blank texts are near-duplicates of one another; of repeated
    rows one stays; rows that share a doc_id but not their text are decided by
    text; extra columns pass whatever their names; an empty table stays empty."""
    return simhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind.

    Null and empty texts stay; texts and runs of any length are read whole;
    repeated rows are changed alike; extra columns pass whatever their names
    (n_chars follows the text); an empty table stays empty."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and places in sequences.

    Null texts count as empty and give a piece of the closing id; texts beyond
    a sequence are cut; each of repeated rows is packed; other columns than
    doc_id and text are left behind; an empty table gives no pieces."""
    return packing.pack_documents(docs, PIECES)


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("simhash_near_dedup", near_copies), ("pii", personal_data), ("best_fit_packing", pack)]

#: Fingerprints and tokens are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        before, docs = docs, common.settled(partial(stage, spark, docs, sf_dir), f"pipeline-{name}")
        common.forget(before)
    return docs
