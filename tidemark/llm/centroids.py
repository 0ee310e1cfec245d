"""K-means in whole numbers with an incremental distance matrix.

Every vector keeps its exact dot product with every centroid. When a centroid moves, only the components
that changed are multiplied, and the change is added to the kept product; the squared distance is
``|x|^2 - 2 x.c + |c|^2``, so the nearest centroid is an argmin over the kept products. All of it is in
64-bit integers, so the order of the work cannot change a result.

The table of vectors and products is written anew after each move (and the one before deleted): a lost
executor repeats its part of one step, and at most two such tables exist. The driver holds the centroids
and, for each, the summed components of its vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import finite
from tidemark.plans.scratch import drop_path, written_at

BOUND = 1 << 26  # components below it: sums of 64 products of differences stay below 2^63
STATE = "vec_id bigint, x array<int>, norm bigint, dots array<bigint>, cluster int, distance bigint"
RESULT = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"


def _numbers(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows, -1)


def _lists(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel(), kind))


def _moved(state: DataFrame, old: np.ndarray, new: np.ndarray) -> DataFrame:
    """The state after centroids moved: products changed by the nonzero components of the moves only."""
    moves = [(c, np.flatnonzero(new[c] - old[c]), (new[c] - old[c])[np.flatnonzero(new[c] - old[c])]) for c in range(len(new))]
    norms = (new * new).sum(1)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, dots = _numbers(batch.column(1), batch.num_rows), _numbers(batch.column(3), batch.num_rows).copy()
            norm = batch.column(2).to_numpy()
            for c, at, move in moves:
                if len(at):
                    dots[:, c] += x[:, at] @ move
            far = norm[:, None] - 2 * dots + norms
            nearest = far.argmin(1)  # the first of equal ones
            columns = [batch.column(0), batch.column(1), batch.column(2), _lists(dots, pa.int64()), pa.array(nearest, pa.int32()), pa.array(far[np.arange(len(far)), nearest])]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "x", "norm", "dots", "cluster", "distance"])

    return state.mapInArrow(step, STATE)


def _centers(state: DataFrame, old: np.ndarray) -> np.ndarray:
    """Floor of the mean of each cluster's vectors; a centroid without vectors stays."""
    k, width = old.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, width), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                cluster, x = batch.column(0).to_numpy(), _numbers(batch.column(1), batch.num_rows)
                counts += np.bincount(cluster, minlength=k)
                for c in range(k):
                    sums[c] += x[cluster == c].sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k), pa.int32()), pa.array(counts), _lists(sums, pa.int64())], names=["cluster", "n", "s"])

    parts = state.select("cluster", "x").mapInArrow(add, "cluster int, n bigint, s array<bigint>")
    exact = [F.sum(F.col("s")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(width)]
    new = old.copy()
    for row in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).filter("n > 0").collect():
        new[row["cluster"]] = [int(row[f"s{j}"]) // row["n"] for j in range(width)]
    return new


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, salt: str = "3:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """K-means over floor(scale x component): vec_id, cluster, distance (squared), cluster_inertia, inertia
    and centroid_sha256 of every vector of exactly ``width`` components.

    The first centroids are the ``k`` vectors with the smallest sha256 of salt and id. Each round assigns
    and replaces every centroid that has vectors by the floor of their mean; a last assignment follows.
    A round that moves nothing ends the search, as all later ones would repeat it.

    Defined results: null vectors, those of another length and those with null or non-finite components
    are left out; equal distances go to the smaller centroid; rows with a repeated id count one by one
    (equal hashes: the smaller vector comes first), and a row without id takes part but starts a centroid
    only if there are fewer than ``k`` others; fewer than ``k`` vectors give as many centroids; an empty
    table gives an empty table; other columns are not read. A component of 65,536 or more in size raises
    an error, since its distances would not be exact in 64 bits.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.filter(finite("v") & (F.size("v") == width))
    large = F.exists("v", lambda c: F.abs(c * scale) >= BOUND)
    whole = F.transform("v", lambda c: F.floor(c * scale).cast("int"))
    rows = rows.select("vec_id", F.when(large, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(whole).alias("x"))
    first = rows.orderBy(F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256).asc_nulls_last(), "x").limit(k)
    centers = np.array([r["x"] for r in first.collect()], np.int64)
    if not len(centers):
        return spark.createDataFrame([], RESULT)
    norm = F.aggregate("x", F.lit(0).cast("bigint"), lambda total, c: total + c.cast("bigint") * c)
    none = F.array_repeat(F.lit(0).cast("bigint"), len(centers))
    start = rows.select("vec_id", "x", norm.alias("norm"), none.alias("dots"))
    state, path = written_at(_moved(start, np.zeros_like(centers), centers))
    for _ in range(rounds):
        new = _centers(state, centers)
        if (new == centers).all():
            break
        before = path
        state, path = written_at(_moved(state, centers, new))
        drop_path(spark, before)
        centers = new
    inertia = [Decimal(0)] * len(centers)
    for row in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect():
        inertia[row["cluster"]] = row["s"]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    of = lambda values: F.array(*[F.lit(v) for v in values])[F.col("cluster")]
    return state.select(
        "vec_id",
        "cluster",
        "distance",
        of([int(i) for i in inertia]).cast("bigint").alias("cluster_inertia"),
        F.lit(int(sum(inertia))).cast("bigint").alias("inertia"),
        of(hashes).alias("centroid_sha256"),
    )


def _oracle(rounds: int = 10) -> str:
    steps = [
        """v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, x) - 1 AS cluster, x FROM v
  QUALIFY cluster < 8)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, any_value(vec_id) AS vec_id, min((list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, c.x) + list_inner_product(c.x, c.x))::BIGINT * 8 + c.cluster) AS m
  FROM v CROSS JOIN c{i} c GROUP BY rid)""")
        if i < rounds:
            steps.append(f"""s{i} AS MATERIALIZED (
  SELECT m % 8 AS cluster, j, sum(v.x[j]::BIGINT) AS s, count(*) AS n FROM a{i} JOIN v USING (rid) CROSS JOIN range(1, 65) t(j) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT cluster, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY j) AS x FROM s{i} GROUP BY cluster
  UNION ALL SELECT cluster, x FROM c{i} WHERE cluster NOT IN (SELECT cluster FROM s{i}))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, (m % 8)::INT AS cluster, (m // 8)::BIGINT AS distance, sum(m // 8) OVER (PARTITION BY m % 8)::BIGINT AS cluster_inertia,
  sum(m // 8) OVER ()::BIGINT AS inertia, sha256(array_to_string(list_transform(c.x, lambda x: x::BIGINT), ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON c.cluster = m % 8"""


ORACLE = _oracle()
