"""Exact top-k search by multi-resolution segment statistics.

Vectors become integers, floor(64 * x). A vector's components are cut into a few segments; each
segment is described by its mean and its deviation (the length of what is left without the mean).
For two vectors these give a lower bound of their squared distance,

    d2 >= sum over segments of width * (mean - mean')^2 + (dev - dev')^2,

and with the known lengths an upper bound of their inner product, (|q|^2 + |c|^2 - d2) / 2. The
bound is computed on 4 segments, then on 16 for the survivors, and only what survives both is
scored exactly. The threshold is the k-th exact score among the most promising candidates.

Queries and candidates meet in blocks: (query block, candidate strip) is the key, so a task holds
at most ``BLOCK`` queries and ``BLOCK`` candidates however large the table is. Each strip hands on
its k best per query, and a window ranks them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import kernel
from .tables import ship, table

BLOCK = 4096
RESOLUTIONS = (4, 16)
#: Below this squared length all inner products fit in 64 bits, and components in 32.
LARGEST = float(1 << 62)


def _integers(scale: float):
    def run(batches):
        for b in batches:
            ids = np.asarray(b.column("id").fill_null(0))
            known = np.asarray(b.column("id").is_valid())
            vectors, query = b.column("vector"), np.asarray(b.column("query"))
            out = {"id": [], "query": [], "dim": [], "v": []}
            for i in range(len(b)):
                v = vectors[i]
                if not known[i] or not v.is_valid or v.values.null_count:
                    continue
                x = np.asarray(v.values, dtype=np.float64)
                if not np.all(np.isfinite(x)):
                    continue
                with np.errstate(over="ignore"):
                    x = np.floor(x * scale)
                    length = float(x @ x)
                if not length < LARGEST:
                    raise ValueError(f"vector {int(ids[i])} is too long for exact 64-bit inner products")
                out["id"].append(int(ids[i]))
                out["query"].append(bool(query[i]))
                out["dim"].append(len(x))
                out["v"].append(x.astype(np.int32).tobytes())
            yield kernel.rows(
                id=pa.array(out["id"], pa.int64()), query=pa.array(out["query"], pa.bool_()),
                dim=pa.array(out["dim"], pa.int32()), v=kernel.binaries(out["v"]),
            )

    return run


def statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per segment sqrt(width) * mean and deviation, so that bounds are plain inner products."""
    means, deviations = [], []
    for part in np.array_split(np.arange(x.shape[1]), min(segments, x.shape[1])):
        seg = x[:, part]
        m = seg.mean(axis=1)
        means.append(m * math.sqrt(len(part)))
        deviations.append(np.sqrt(np.maximum(0, ((seg - m[:, None]) ** 2).sum(axis=1))))
    return np.stack(means, 1), np.stack(deviations, 1)


def lower_bound(q: np.ndarray, c: np.ndarray, segments: int) -> np.ndarray:
    """Lower bounds of all squared distances between the rows of q and c."""
    (mq, dq), (mc, dc) = statistics(q, segments), statistics(c, segments)
    a, b = np.hstack([mq, dq]), np.hstack([mc, dc])
    return (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * (a @ b.T)


def best_of_block(q_ids, q, c_ids, c, k):
    """(query row, candidate id, score) of each query's k best within a block of candidates."""
    size = max(1, int(np.abs(q).max(initial=0))) * max(1, int(np.abs(c).max(initial=0))) * max(1, q.shape[1])
    exact = np.float64 if size < 2**52 else np.int64
    order = np.argsort(c_ids, kind="stable")  # ties go to smaller ids
    c_ids, c = c_ids[order], c[order]
    fq, fc = q.astype(np.float64), c.astype(np.float64)
    slack = 1e-9 * size + 0.5  # rounding of the bounds; scores are whole numbers
    norm_c = (fc**2).sum(1)
    rows, ids, scores = [], [], []
    for lo in range(0, len(q), 256):
        part = fq[lo : lo + 256]
        norms = (part**2).sum(1)[:, None] + norm_c[None, :]
        own = q_ids[lo : lo + 256, None] == c_ids[None, :]
        alive = ~own
        floor = np.full(len(part), -np.inf)
        for segments in RESOLUTIONS if q.shape[1] else ():
            most = np.where(alive, (norms - lower_bound(part, fc, segments)) / 2, -np.inf)
            if most.shape[1] > k:
                seeds = np.argpartition(-most, k - 1, axis=1)[:, :k]
                sure = np.einsum("qd,qkd->qk", part, fc[seeds])
                sure[~np.take_along_axis(alive, seeds, 1)] = -np.inf
                floor = np.maximum(floor, sure.min(1))
            alive &= most >= (floor - slack)[:, None]
        for i in range(len(part)):
            left = np.flatnonzero(alive[i])
            score = (c[left].astype(exact) @ q[lo + i].astype(exact)).astype(np.int64)
            top = np.lexsort((c_ids[left], -score))[:k]
            rows.append(np.full(len(top), lo + i))
            ids.append(c_ids[left][top])
            scores.append(score[top])
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(rows), join(ids), join(scores)


def _search(k: int):
    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        def matrix(t, dim):
            t = t.filter(pa.compute.equal(t["dim"], dim))
            raw = b"".join(t["v"].to_pylist())
            return np.asarray(t["id"]), np.frombuffer(raw, np.int32).reshape(len(t), dim).astype(np.int64), t

        found = {"query_id": [], "query_key": [], "vec_id": [], "score": []}
        for dim in sorted(set(queries["dim"].to_pylist())):
            q_ids, q, own = matrix(queries, dim)
            c_ids, c, _ = matrix(candidates, dim)
            if len(c):
                row, ids, score = best_of_block(q_ids, q, c_ids, c, k)
                found["query_id"].append(q_ids[row])
                found["query_key"].append(np.asarray(own["query_key"])[row])
                found["vec_id"].append(ids)
                found["score"].append(score)
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in found.items()})

    return run


def top_k(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, k: int = 20, scale: float = 64.0) -> DataFrame:
    """Each query's k highest integer inner products among all other rows.

    Returns query_id, rank (from 1), vec_id, score; ties go to the smaller vec_id; fewer rows if
    there are fewer candidates. A row whose id or vector is null, or that has a null or non-finite
    component takes no part. A vector so long that an inner product could leave 64 bits stops the
    search. Rows with the query's id
    are its own and no candidates. Vectors of other lengths don't compare. Repeated rows are
    candidates one by one; repeated query rows with equal vectors are answered once, with other
    vectors each for itself. Empty input gives no rows.
    """
    ship(vectors.sparkSession)
    whole = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
    ).mapInArrow(_integers(scale), "id long, query boolean, dim int, v binary")
    counts = whole.agg(F.count("*").alias("n"), F.count_if("query").alias("q")).first()
    strips, blocks = max(1, -(-counts.n // BLOCK)), max(1, -(-counts.q // BLOCK))
    spread = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = whole.select("id", "dim", "v", spread(1, strips).alias("strip"), every(blocks).alias("block"))
    queries = (
        whole.where("query").select("id", "dim", "v", F.xxhash64("v").alias("query_key"))
        .dropDuplicates(["id", "query_key", "v"])
        .select("*", spread(2, blocks).alias("block"), every(strips).alias("strip"))
    )
    found = (
        queries.groupBy("block", "strip").cogroup(candidates.groupBy("block", "strip"))
        .applyInArrow(_search(k), "query_id long, query_key long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


NAME = "op3_segment_top_k"
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 20 == 0)
