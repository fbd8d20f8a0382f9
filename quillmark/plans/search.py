"""Search over chunks: keyword and vector scores, top k."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP_K, VECTOR, KEYWORD = 5, 0.6, 0.4
#: Queries and vectors of a task, and queries that it scores together.
QUERIES, VECTORS, TOGETHER = 8192, 8192, 1024
#: Decimals of a score; vectors that agree in them are tied.
DECIMALS = 9

_VALID = "exists({0}, x -> x <> 0) and not exists({0}, x -> x is null or isnan(x) or abs(x) = double('inf'))"


def _dealt(rows: DataFrame, key: str, vector: str, mine: str, parts: int, other: str, others: int) -> DataFrame:
    """Rows in ``parts`` blocks of their own, with a copy for each of the others' blocks."""
    block = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    valid = rows.where(_VALID.format(vector)).select(key, vector, F.size(vector).alias("dim"), block.alias(mine))
    return valid.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _units(table: pa.Table, column: str, dim: int) -> np.ndarray:
    x = table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(queries: DataFrame, vectors: DataFrame, k: int = TOP_K) -> DataFrame:
    """query_id, vec_id, score, rank of the k nearest of all ``vectors``
    (vec_id, embedding) to each of ``queries`` (query_id, query) by cosine,
    ties by vec_id.

    A task scores a block of queries against a block of vectors and passes on k
    rows a query, so that neither side is broadcast or collected.  Vectors that
    are null, empty or zero, or hold null or non-finite components, and those
    of another length than the query, are near nothing."""
    q_parts, v_parts = (max(1, -(-rows.count() // most)) for rows, most in ((queries, QUERIES), (vectors, VECTORS)))
    asked = _dealt(queries, "query_id", "query", "qb", q_parts, "vb", v_parts)
    rows = _dealt(vectors, "vec_id", "embedding", "vb", v_parts, "qb", q_parts)
    schema = f"query_id {queries.schema['query_id'].dataType.simpleString()}, vec_id {vectors.schema['vec_id'].dataType.simpleString()}, score double"

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [pa.table({"query_id": left["query_id"].slice(0, 0), "vec_id": right["vec_id"].slice(0, 0), "score": pa.array([], pa.float64())})]
        if left.num_rows and right.num_rows:
            right = right.sort_by("vec_id")
            dim = left["dim"][0].as_py()
            mine, theirs = _units(left, "query", dim), _units(right, "embedding", dim)
            for i in range(0, len(mine), TOGETHER):
                scores = np.round(mine[i : i + TOGETHER] @ theirs.T, DECIMALS)
                least = np.partition(scores, -k, axis=1)[:, -k] if k < len(theirs) else np.full(len(scores), -2.0)
                at, which = np.nonzero(scores >= least[:, None])
                order = np.lexsort([which, -scores[at, which], at])
                at, which = at[order], which[order]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                at, which = at[place < k], which[place < k]
                found.append(pa.table({"query_id": left["query_id"].take(pa.array(at + i)), "vec_id": right["vec_id"].take(pa.array(which)), "score": pa.array(scores[at, which])}))
        return pa.concat_tables(found)

    keys = ["dim", "qb", "vb"]
    scored = asked.groupBy(*keys).cogroup(rows.groupBy(*keys)).applyInArrow(best, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "vec_id", "score", "rank")


def hybrid(keyword: DataFrame, vector: DataFrame, k: int = TOP_K) -> DataFrame:
    """query_id, id, score, rank from scores (query_id, id, score) of both kinds."""
    rows = keyword.select("query_id", "id", (KEYWORD * F.col("score")).alias("score")).unionByName(vector.select("query_id", "id", (VECTOR * F.col("score")).alias("score")))
    best = rows.groupBy("query_id", "id").agg(F.sum("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)
