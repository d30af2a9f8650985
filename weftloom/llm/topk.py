"""Operator 10: exact top-k inner products by columnar branch and bound.

Queries and candidates are cut into parts of bounded size and meet cell by cell. In a cell the candidates lie in
vertical layout, dimension by dimension. Scores are accumulated one block of dimensions after another, those of the greatest
mass first; what the remaining dimensions can add is bounded by the product of the remaining norms, and candidates that can no longer
reach a query's k-th best score are compacted away before the next block.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

SCALE = 1024
CANDIDATE_PART, QUERY_PART = 32_768, 8_192  # vectors
BLOCK_DIMENSIONS, BLOCK_CANDIDATES, BLOCK_QUERIES = 16, 4_096, 64
_EXACT = 1 << 53


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` with components floor(1024 x); vectors that are null or hold null or non-finite components are left out."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    e = F.col(embedding)
    whole = F.transform(e, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    return vectors.where(F.col(vec_id).isNotNull() & e.isNotNull() & F.forall(e, finite)).select(
        F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v")
    )


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, one per row, ordered by id; shorter vectors are filled up with zeros."""
    table = table.sort_by("vec_id").combine_chunks()
    ids = table.column("vec_id").to_numpy()
    column = table.column("v").combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return ids, out


def best_in_cell(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Yield (query id, candidate ids, scores) of each query vector's k best in the cell, ties to smaller ids."""
    for query_id, rows, scores in _best_rows(ids, vectors, query_ids, queries, k):
        yield query_id, ids[rows], scores


def best_by_id(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """As ``best_in_cell`` for query ids that stand together: a candidate row counts once for an id, with its best score over the id's vectors."""
    found = _best_rows(ids, vectors, query_ids, queries, k)
    for query_id, group in itertools.groupby(found, lambda x: x[0]):
        rows, scores = next(group)[1:]
        for _, more, other in group:
            rows, scores = np.concatenate([rows, more]), np.concatenate([scores, other])
            order = np.argsort(-scores, kind="stable")
            rows, scores = rows[order], scores[order]
            first = np.sort(np.unique(rows, return_index=True)[1])
            rows, scores = rows[first], scores[first]
            best = np.lexsort((ids[rows], -scores))[:k]
            rows, scores = rows[best], scores[best]
        yield query_id, ids[rows], scores


def _best_rows(ids, vectors, query_ids, queries, k):
    width = max(vectors.shape[1], queries.shape[1])
    vectors, queries = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (vectors, queries))
    top = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, width)
    if top >= _EXACT:  # beyond the doubles' exact range: whole numbers, without bounds
        yield from _best_of_large(ids, vectors, query_ids, queries, k)
        return
    order = np.argsort(-(vectors.astype(float) ** 2).sum(axis=0) * (queries.astype(float) ** 2).sum(axis=0), kind="stable")
    columns, queries = np.ascontiguousarray(vectors.T[order].astype(float)), queries[:, order].astype(float)
    blocks = [slice(i, i + BLOCK_DIMENSIONS) for i in range(0, width, BLOCK_DIMENSIONS)]
    left = lambda squares: np.sqrt(np.stack([squares[:, b.stop :].sum(axis=1) for b in blocks])) if blocks else squares
    query_left, candidate_left = left(queries**2), left((columns**2).T)
    for at in range(0, len(query_ids), BLOCK_QUERIES):
        some = queries[at : at + BLOCK_QUERIES]
        best = [(np.empty(0, np.int64), np.empty(0)) for _ in some]
        for start in range(0, len(ids), BLOCK_CANDIDATES):
            stop = min(len(ids), start + BLOCK_CANDIDATES)
            alive = [np.flatnonzero(ids[start:stop] != query_id) + start for query_id in query_ids[at : at + len(some)]]
            partial = [np.zeros(len(x)) for x in alive]
            for b, block in enumerate(blocks):
                if b == 0:  # all candidates are there yet: one product for all queries
                    product = some[:, block] @ columns[block, start:stop]
                for q in range(len(some)):
                    if not len(alive[q]):
                        continue
                    gained = product[q, alive[q] - start] if b == 0 else some[q, block] @ columns[block, alive[q]]
                    partial[q] = partial[q] + gained
                    if len(best[q][1]) == k:
                        bound = partial[q] + query_left[b, at + q] * candidate_left[b, alive[q]] * (1 + 1e-9) + 1e-3
                        reach = bound >= best[q][1][-1]
                        alive[q], partial[q] = alive[q][reach], partial[q][reach]
            for q in range(len(some)):
                pool, scores = np.concatenate([best[q][0], alive[q]]), np.concatenate([best[q][1], partial[q]])
                first = np.lexsort((ids[pool], -scores))[:k]
                best[q] = pool[first], scores[first]
        for query_id, (pool, scores) in zip(query_ids[at : at + len(some)].tolist(), best):
            yield query_id, pool, scores.astype(np.int64)


def _best_of_large(ids, vectors, query_ids, queries, k):
    limit = (1 << 63) - 1
    for query_id, query in zip(query_ids.tolist(), queries.tolist()):
        scores = [sum(a * b for a, b in zip(query, vector)) for vector in vectors.tolist()]
        rows = sorted((i for i in range(len(ids)) if ids[i] != query_id), key=lambda i: (-scores[i], ids[i]))[:k]
        yield query_id, np.array(rows, np.int64), np.array([max(-limit, min(limit, scores[i])) for i in rows], np.int64)


def exact_top_k(candidates: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` best candidates by integer inner product, its own id left out.

    Queries are the rows of ``candidates`` where ``is_query`` holds. Vectors that are null, or hold a null or a non-finite
    component, and rows without an id take no part; missing components of a shorter vector count as zero; a candidate row
    that is repeated counts each time. A query id with several vectors asks with all of them: each candidate row counts once, with its
    best score; its vectors are searched in one row of cells. Ties go to the smaller id, and scores beyond 64 bits are cut to that range. An empty table, or one without queries, gives no rows.
    """
    spark = candidates.sparkSession
    numbers = integer_vectors(candidates, vec_id, embedding)
    asked = integer_vectors(candidates.where(is_query), vec_id, embedding).dropDuplicates(["vec_id", "v"])
    n, m = numbers.count(), asked.count()
    deal = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidate_parts, query_parts = max(-(-n // CANDIDATE_PART), min(deal, n // 1024 + 1)), -(-m // QUERY_PART)
    if not m:
        query_parts = 1
    part = lambda parts, *by: F.pmod(F.xxhash64(*by), F.lit(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = numbers.withColumn("cp", part(candidate_parts, "vec_id", "v")).withColumn("qp", every(query_parts))
    right = asked.withColumn("qp", part(query_parts, "vec_id")).withColumn("cp", every(candidate_parts))

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        query, found, score = [], [], []
        if len(left) and len(right):
            for query_id, ids, scores in best_by_id(*_matrix(left), *_matrix(right), k):
                query.append(np.full(len(ids), query_id))
                found.append(ids)
                score.append(scores)
        joined = lambda parts: pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())
        return pa.table({"query_id": joined(query), "vec_id": joined(found), "score": joined(score)})

    cells = left.groupBy("cp", "qp").cogroup(right.groupBy("cp", "qp")).applyInArrow(
        cell, "query_id long, vec_id long, score long"
    )
    best_first = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
