"""Exact top-k by inner product: a Voronoi join.

A few pivots are taken from the data. Data and queries go to the cell of their nearest pivot; each cell is
summed up by its number of vectors and its radius. For a group of queries (those of one cell) the
summaries bound the inner products with every data cell from below and above. The lower bounds give a
score that k vectors reach for certain, so only data cells whose upper bound reaches it are sent to the
group. The group is solved locally in blocks of bounded size, and the blocks' best are merged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.vectors import finite, matrix, pack
from tidemark.plans.scratch import written

PIVOTS = 16
QUERY_BLOCK = 512
DATA_BLOCK = 4096


def _routes(pivots: np.ndarray, data: dict, asked: dict, k: int) -> list[tuple[int, int]]:
    """(query cell, data cell) pairs that may hold a result. data, asked: cell -> (number, radius)."""
    norms = np.sqrt((pivots**2).sum(1))
    routes = []
    for q, (_, radius) in asked.items():
        bounds = []
        for c, (number, reach) in data.items():
            middle = float(pivots[q] @ pivots[c])
            slack = norms[q] * reach + radius * norms[c] + radius * reach
            slack += 1e-9 * (abs(middle) + slack) + 1e-6
            bounds.append((middle - slack, middle + slack, c, number - (c == q)))
        sure, threshold = 0, -np.inf
        for low, _, _, number in sorted(bounds, reverse=True):
            sure += number
            if sure >= k:
                threshold = low
                break
        routes += [(q, c) for _, high, c, _ in bounds if high >= threshold]
    return routes


def top_k(df: DataFrame, asked: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, pivots: int = PIVOTS) -> DataFrame:
    """The ``k`` highest inner products of each query (rows of ``df`` where ``asked`` holds) with all other
    rows, components taken as floor(scale x component): query_id, rank (from 1), vec_id, score.

    Ties go to the smaller id; all candidates are returned if there are fewer than k. Defined results:
    vectors that are null, empty or hold null or non-finite components take no part, nor do rows without
    id, nor vectors of another length than the most frequent one (ties: the shorter); rows with the
    query's id are not its candidates; repeated candidate rows count one by one, repeated queries once;
    an empty table gives an empty table.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    rows = rows.filter(F.col("id").isNotNull() & finite("v"))
    rows = rows.select("id", "asked", F.transform("v", lambda x: F.floor(x * scale).cast("bigint")).alias("v"))
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))).alias("most"))
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    usual = lengths.orderBy(F.desc("n"), "d").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    width, most = usual["d"], usual["most"]
    dtype = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
    kind = dtype if most * most * width < 1 << 53 else "<i8"  # exact in doubles, or else in 64-bit integers
    rows = rows.filter(F.size("v") == width)
    centers = np.array([r[0] for r in rows.orderBy(F.md5(F.col("id").cast("string")), "id").limit(pivots).select("v").collect()], np.float64)

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if len(part):
                x = np.array(part["v"].tolist(), np.float64)
                far = (x**2).sum(1)[:, None] - 2 * x @ centers.T + (centers**2).sum(1)
                cell = far.argmin(1)
                gap = np.sqrt(((x - centers[cell]) ** 2).sum(1))
                yield pd.DataFrame({"id": part["id"], "asked": part["asked"], "cell": cell, "gap": gap, "v": pack(part["v"], dtype if kind != "<i8" else "<i8")})

    placed = written(rows.mapInPandas(place, "id bigint, asked boolean, cell int, gap double, v binary"))
    held = placed.groupBy("cell").agg(F.count_distinct("id").alias("n"), F.count("*").alias("rows"), F.max("gap").alias("gap")).collect()
    asking = placed.filter("asked").groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("gap")).collect()
    if not asking:
        return spark.createDataFrame([], schema)
    routes = _routes(centers, {r["cell"]: (r["n"], r["gap"]) for r in held}, {r["cell"]: (r["n"], r["gap"]) for r in asking}, k)
    sizes = {r["cell"]: r["rows"] for r in held}
    plan = []
    for r in asking:
        cells = [c for q, c in routes if q == r["cell"]]
        blocks = (-(-r["n"] // QUERY_BLOCK), -(-sum(sizes[c] for c in cells) // DATA_BLOCK))
        plan += [(r["cell"], c, *blocks) for c in cells]
    plan = spark.createDataFrame(plan, "grp int, cell int, nq bigint, nd bigint")  # at most pivots x pivots rows
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    groups = plan.select("grp", "nq", "nd").distinct()
    queries = placed.filter("asked").dropDuplicates(["id"]).join(F.broadcast(groups), F.col("cell") == F.col("grp"))
    queries = queries.withColumns({"qb": F.pmod(F.xxhash64("id"), F.col("nq")), "db": spread("nd")}).select("grp", "qb", "db", "id", "v")
    data = placed.select("id", "cell", "v").join(F.broadcast(plan), "cell")
    data = data.withColumns({"db": F.pmod(F.xxhash64(F.lit(1), "id"), F.col("nd")), "qb": spread("nq")}).select("grp", "qb", "db", "id", "v")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        q, x, out = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1], []
        if len(q) and len(x):
            x = x.sort_values("id", kind="stable")
            ids = x["id"].to_numpy()
            scores = matrix(q["v"], kind) @ matrix(x["v"], kind).T
            for i, mine in enumerate(q["id"]):
                score = scores[i]
                other = np.flatnonzero(ids != mine)
                if len(other) > k:
                    edge = np.partition(score[other], len(other) - k)[len(other) - k]
                    other = other[score[other] >= edge]
                best = other[np.argsort(-score[other], kind="stable")[:k]]
                out += [(mine, int(ids[j]), int(score[j])) for j in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    both = queries.withColumn("side", F.lit(0)).unionByName(data.withColumn("side", F.lit(1)))
    found = both.groupBy("grp", "qb", "db").applyInPandas(solve, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.x, d.x)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
