"""Similarity ranking and top-k."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnloom.functions.text import levenshtein_similarity


def similarity_verdict(pairs: DataFrame, group: str, similar: float = 0.85, enough: float = 0.7, most_failed: float = 0.5) -> DataFrame:
    """group, n_similar, n_different, n_failed, verdict of pairs (group, gold, other) by Levenshtein similarity of whole texts.

    A pair without gold text failed and one without other text differs (NULL or empty). Uncertain where more than
    most_failed of the pairs failed or none can be compared; else TlsClientOk where at least `enough` of the others are similar.
    """
    failed = F.coalesce(F.col("gold") == "", F.lit(True))
    alike = ~failed & F.coalesce((F.col("other") != "") & (levenshtein_similarity(F.col("gold"), F.col("other")) >= similar), F.lit(False))
    counts = pairs.groupBy(group).agg(F.count_if(alike).alias("n_similar"), F.count_if(~failed & ~alike).alias("n_different"), F.count_if(failed).alias("n_failed"))
    compared = F.col("n_similar") + F.col("n_different")
    verdict = (
        F.when((F.col("n_failed") / (compared + F.col("n_failed")) > most_failed) | (compared == 0), "Uncertain")
        .when(F.col("n_similar") >= enough * compared - 1e-9, "TlsClientOk")
        .otherwise("ChromeCdpRequired")
    )
    return counts.withColumn("verdict", verdict)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a norm is 0."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, 0.0).otherwise(dot(a, b) / norms)


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int, block: int = 2048, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, vec_id, distance, rank: the k nearest vectors (squared L2) of each query row, exactly.

    Queries are a stated set against all rows, taken in blocks of bounded size; each batch of vectors keeps its k best
    per query before anything is shuffled. Ties go to the lower id. Rows with NULL, or another length than the
    query's, are skipped; the query itself is not its own neighbour.
    """
    out, buffer = None, []

    def search(rows: list) -> DataFrame:
        ids = np.array([r[0] for r in rows], np.int64)
        q = np.array([r[1] for r in rows], np.float64)
        shared = vectors.sparkSession.sparkContext.broadcast((ids, q, (q * q).sum(1)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            qid, qv, qn = shared.value
            for batch in batches:
                rows_ = [(i, v) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if v is not None and len(v) == qv.shape[1] and None not in v]
                if not rows_:
                    continue
                vid = np.array([i for i, _ in rows_], np.int64)
                x = np.array([v for _, v in rows_], np.float64)
                d = np.maximum(qn[:, None] + (x * x).sum(1)[None, :] - 2 * qv @ x.T, 0.0)
                d[qid[:, None] == vid[None, :]] = np.inf
                m = min(k, len(vid))
                rounded = np.round(d, 9)
                worst = np.partition(rounded, m - 1, axis=1)[:, m - 1 : m]
                q, v = np.nonzero((rounded <= worst) & np.isfinite(d))  # the m nearest and what ties with the last of them
                order = np.lexsort((vid[v], rounded[q, v], q))
                q, v = q[order], v[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, v = q[place < m], v[place < m]
                yield pa.RecordBatch.from_arrays([pa.array(qid[q]), pa.array(vid[v]), pa.array(d[q, v])], ["query_id", "vec_id", "distance"])

        return vectors.select(F.col(vec_id).cast("bigint"), embedding).where(f"{vec_id} is not null").mapInArrow(run, "query_id bigint, vec_id bigint, distance double")

    for row in queries.select(F.col(vec_id).cast("bigint"), embedding).where(f"{vec_id} is not null and {embedding} is not null").toLocalIterator():
        buffer.append((row[0], row[1]))
        if len(buffer) == block:
            out = search(buffer) if out is None else out.unionAll(search(buffer))
            buffer = []
    if buffer:
        out = search(buffer) if out is None else out.unionAll(search(buffer))
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, vec_id bigint, distance double, rank int")
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 9), "vec_id")
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def term_cosine(rows: DataFrame, text: Column, query: str) -> DataFrame:
    """rows with `score`: cosine between the counts of the query's terms in a text and in the query itself."""
    terms = sorted({t for t in query.lower().split() if t})
    own = [float(query.lower().split().count(t)) for t in terms]
    counts = F.array(*(F.size(F.split(F.lower(text), "(?i)\\Q" + t + "\\E", -1)).cast("double") - 1 for t in terms))
    return rows.withColumn("score", cosine(counts, F.array(*(F.lit(x) for x in own))))


def suffixed_names(rows: DataFrame, name: str, order: list[str]) -> DataFrame:
    """rows with `unique_name`: the first of each name keeps it, the next become name_2, name_3, …; beyond 999 name_x."""
    w = Window.partitionBy(name).orderBy(*order)
    n = F.row_number().over(w)
    return rows.withColumn("unique_name", F.when(n == 1, F.col(name)).when(n <= 999, F.concat(F.col(name), F.lit("_"), n.cast("string"))).otherwise(F.concat(F.col(name), F.lit("_x"))))
