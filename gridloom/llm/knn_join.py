"""Exact top-k search by inner product: a Voronoi join.

Pivots (k-means over a bounded sample; any choice gives the same result) divide vectors and queries into
groups. A group's summary is its pivot p, its radius r, its greatest norm m and the k + 1 vectors next to the
pivot. From the summaries alone, which are bounded by the number of pivots, each query q gets

- a score that it is sure to reach k times: the k-th best of its scores with the summaries' vectors, and
- for each group an upper bound of its scores there: the lesser of q.p + r|q| and m|q|.

A query goes to the groups whose bound reaches its sure score. Large groups are divided into cells of vectors,
and many queries into blocks of neighbouring groups; a cell is replicated to just those blocks that hold a
query which needs its group. Each meeting of a cell and a block is solved in one task of bounded size.

Scores are inner products of integers, floor(256 * x) of each component, and exact while they stay below
2**53. Edge cases: vectors that are null or hold null or non-finite components take no part; only vectors
of the same length are compared. Ties go to the smaller vec_id. A query's candidates are all rows with
another vec_id; equal rows of a query are searched once, unlike ones are ranked together, repeated
candidates count each. Rows with a null vec_id take no part. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import read, spool

LOW = -np.inf


@dataclass(frozen=True)
class Search:
    k: int = 5
    scale: int = 256
    #: Vectors that pivots are fitted on, and pivots.
    sample: int = 4096
    pivots: int = 64
    #: Vectors of a cell and queries of a block, about.
    cell: int = 20_000
    block: int = 10_000


def _matrix(column) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def integers(vectors: DataFrame, scale: int) -> DataFrame:
    """(vec_id, x) with integer components, of the rows that take part."""
    sound = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.coalesce(sound, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: F.floor(c.cast("double") * scale).cast("double")).alias("x"))


def fit_pivots(x: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """k-means centres, from evenly spread starts."""
    centres = x[np.linspace(0, len(x) - 1, min(n, len(x))).astype(int)]
    for _ in range(rounds):
        own = nearest(x, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1)[None, :] - 2 * x @ centres.T, axis=1)


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k greatest scores with ties to smaller ids; ids ascend."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        over = np.flatnonzero(scores > least)
        at = np.concatenate([over, np.flatnonzero(scores == least)[: k - len(over)]])
    else:
        at = np.arange(len(scores))
    return sorted(((int(scores[i]), int(ids[i])) for i in at), key=lambda r: (-r[0], r[1]))


def _grouped(shared):
    """Rows (grp, vec_id, x, far, norm): a vector's nearest pivot, its distance from it, and its norm."""

    def run(batches):
        centres = shared.value
        for batch in batches:
            x = _matrix(batch.column("x"))
            if len(x):
                group = nearest(x, centres)
                far, norm = np.linalg.norm(x - centres[group], axis=1), np.linalg.norm(x, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), batch.column("vec_id"), batch.column("x"), pa.array(far), pa.array(norm)], ["grp", "vec_id", "x", "far", "norm"])

    return run


@dataclass(frozen=True)
class Summary:
    """What is known of all groups: pivots, radii, greatest norms, sizes; and some vectors of each, with their ids."""

    centres: np.ndarray
    far: np.ndarray
    norm: np.ndarray
    count: np.ndarray
    ids: np.ndarray
    x: np.ndarray

    def sure(self, q: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
        """A score that each query, of the id in own, reaches k times at least."""
        scores = np.where(self.ids[None, :] == own[:, None], LOW, q @ self.x.T)
        if scores.shape[1] < k:
            return np.full(len(q), LOW)
        return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]

    def most(self, q: np.ndarray) -> np.ndarray:
        """An upper bound of each query's scores in each group."""
        size, middle = np.linalg.norm(q, axis=1)[:, None], q @ self.centres.T
        slack = size * self.far[None, :]
        bound = np.minimum(middle + slack + 1e-6 * (1 + slack + np.abs(middle)), size * self.norm[None, :] * (1 + 1e-9) + 1e-6)
        return np.where(self.count[None, :] > 0, bound, LOW)


def _needs(shared, first: dict, total: int, blocks: int, k: int):
    """Rows (grp, block, vec_id, x, least) of queries, for each group that may hold one of their k best."""

    def run(batches):
        summary = shared.value
        for batch in batches:
            q, ids = _matrix(batch.column("x")), batch.column("vec_id").to_numpy()
            start = np.array([first[g] for g in batch.column("grp").to_pylist()], float).reshape(-1, 2)
            place = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(float) / 2.0**31
            block = np.minimum((start[:, 0] + place * start[:, 1]) * blocks // total, blocks - 1).astype(np.int64)
            for i in range(0, len(q), 2000):
                least = summary.sure(q[i : i + 2000], ids[i : i + 2000], k)
                at, group = np.nonzero((summary.most(q[i : i + 2000]) >= least[:, None]) & (summary.count > 0))
                rows = pa.array(at + i)
                yield pa.RecordBatch.from_arrays([pa.array(group.astype(np.int32)), pa.array(block[at + i]), batch.column("vec_id").take(rows), batch.column("x").take(rows), pa.array(least[at])], ["grp", "block", "vec_id", "x", "least"])

    return run


def _solve(k: int):
    def run(queries, data):
        out = []
        if queries.num_rows and data.num_rows:
            data = data.sort_by("vec_id")
            q, x = _matrix(queries.column("x").combine_chunks()), _matrix(data.column("x").combine_chunks())
            qs, ids, least = queries.column("vec_id").to_numpy(), data.column("vec_id").to_numpy(), queries.column("least").to_numpy()
            for i in range(0, len(q), 64):
                scores = q[i : i + 64] @ x.T
                good = (scores >= least[i : i + 64, None]) & (ids[None, :] != qs[i : i + 64, None])
                for query, own, fits in zip(qs[i : i + 64], scores, good, strict=True):
                    at = np.flatnonzero(fits)
                    out += [(int(query), vec, score) for score, vec in _top(own[at], ids[at], k)]
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def top_k(vectors: DataFrame, queries: DataFrame, how: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k best rows of vectors; both (vec_id, embedding)."""
    spark = vectors.sparkSession
    data = integers(vectors, how.scale)
    asked = integers(queries, how.scale).distinct()
    out = None
    lengths = [r["n"] for r in integers(queries, how.scale).select(F.size("x").alias("n")).distinct().collect()]
    for n in sorted(lengths):
        found = _one_length(spark, data.where(F.size("x") == n), asked.where(F.size("x") == n), n, how)
        if found is not None:
            out = found if out is None else out.union(found)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.k).select("query_id", "rank", "vec_id", "score")


def summarise(grouped: DataFrame, centres: np.ndarray, k: int) -> Summary:
    """The summaries of a grouped table: as many rows as pivots, and k + 1 times as many vectors."""
    n, dim = centres.shape
    far, norm, count = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    for r in grouped.groupBy("grp").agg(F.max("far").alias("far"), F.max("norm").alias("norm"), F.count("*").alias("n")).collect():
        far[r["grp"]], norm[r["grp"]], count[r["grp"]] = r["far"], r["norm"], r["n"]
    near = Window.partitionBy("grp").orderBy("far", "vec_id")
    close = grouped.select("grp", "far", "vec_id", "x").withColumn("i", F.row_number().over(near)).where(F.col("i") <= k + 1).select("vec_id", "x").collect()
    return Summary(centres, far, norm, count, np.array([r["vec_id"] for r in close], np.int64), np.array([r["x"] for r in close], float).reshape(len(close), dim))


def _one_length(spark, data: DataFrame, asked: DataFrame, n: int, how: Search) -> DataFrame | None:
    sample = data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(how.sample).select("x").collect()
    if not sample:
        return None
    centres = fit_pivots(np.array([r["x"] for r in sample], float).reshape(len(sample), n), min(how.pivots, max(1, len(sample) // 16)))
    schema, known = "grp int, vec_id long, x array<double>, far double, norm double", spark.sparkContext.broadcast(centres)
    grouped = spool(data.mapInArrow(_grouped(known), schema), "vectors")
    dealt = spool(asked.mapInArrow(_grouped(known), schema).select("grp", "vec_id", "x"), "queries")
    summary = summarise(grouped, centres, how.k)
    first, total = {}, 0
    for r in sorted(dealt.groupBy("grp").agg(F.count("*").alias("n")).collect()):
        first[r["grp"]] = (total, r["n"])
        total += r["n"]
    blocks = -(-total // how.block)
    needs = spool(dealt.mapInArrow(_needs(spark.sparkContext.broadcast(summary), first, total, blocks, how.k), "grp int, block long, vec_id long, x array<double>, least double"), "needs")
    cells = F.element_at(F.array(*[F.lit(max(1, round(int(c) / how.cell))) for c in summary.count]), F.col("grp") + 1)
    every = F.explode(F.sequence(F.lit(0), cells - 1)).alias("cell")
    meetings = needs.groupBy("grp", "block").agg(F.first("grp").alias("g"), F.first("block").alias("b")).select(F.col("g").alias("grp"), F.col("b").alias("block")).select("grp", "block", every)
    copies = grouped.select("grp", F.pmod(F.xxhash64("vec_id"), cells).cast("int").alias("cell"), "vec_id", "x").join(meetings, ["grp", "cell"])
    spread = needs.select("grp", every, "block", "vec_id", "x", "least")
    keys = ["grp", "cell", "block"]
    return spread.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(_solve(how.k), "query_id long, vec_id long, score long")


def op8_voronoi_knn(spark, sf_dir):
    """The 5 best rows for every vector whose id is divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
q AS (SELECT DISTINCT vec_id, x FROM v WHERE vec_id % 50 = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.x, d.x) AS BIGINT) AS score
  FROM q JOIN v d ON q.vec_id <> d.vec_id AND len(q.x) = len(d.x)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
