"""Near-duplicate vectors by NN-descent.

Equal vectors of a label are one class with a count. The neighbour graph starts from hash tables (signs of
random projections; blocks of bounded size are compared in full) and is refined by neighbours of
neighbours: the vectors that meet at a common neighbour are compared, and each keeps its nearest. Only
neighbours closer than ``LOOSE`` are kept, since others do not lead to links. A list that is full of
links is saturated: it is enlarged to all of its component, compared in tiles. An audit
compares a bounded sample of vectors with all vectors; if too many links are missing, more tables follow,
and if they are still missing after the last, the search fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.vectors import finite, matrix, pack
from tidemark.plans.scratch import written

LOOSE = 0.9
LISTED = 16  # neighbours of a list
TABLES = 8
BLOCK = 256
TILE = 512
AUDIT = 200  # vectors of the audit
RECALL = 0.97
ROUNDS = 8

_PAIRS = "a bigint, b bigint, sim double"


def _cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x @ y.T) / np.sqrt((x**2).sum(1))[:, None] / np.sqrt((y**2).sum(1))


def _near(ids: np.ndarray, x: np.ndarray, least: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (a, b, sim) of a block with a cosine of at least ``least``, of each vector its ``most`` nearest."""
    sims = _cosines(x, x)
    np.fill_diagonal(sims, -2)
    if len(x) > most + 1:
        edge = np.partition(sims, len(x) - most, axis=1)[:, len(x) - most]
        keep = (sims >= edge[:, None]) & (sims >= least)
    else:
        keep = sims >= least
    i, j = np.nonzero(keep | keep.T)
    up = ids[i] < ids[j]
    return ids[i[up]], ids[j[up]], sims[i[up], j[up]]


def _pairs(ids: np.ndarray, x: np.ndarray, least: float, most: int) -> pd.DataFrame:
    return pd.DataFrame(dict(zip(("a", "b", "sim"), _near(ids, x, least, most))))


def _tables(classes: DataFrame, bits: int, first: int) -> DataFrame:
    """Pairs found by TABLES hash tables, in one shuffle. Rows are range-partitioned by (table, label, length,
    code, projection), so a code that many vectors share is spread over tasks and cut into blocks of neighbours."""

    def code(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            units = {d: (rows, matrix(part.loc[rows, "v"], "<f4")) for d, rows in part.groupby("d").groups.items()}
            for seed in range(first, first + TABLES):
                out = part.assign(seed=seed, code=0, at=0.0)
                for d, (rows, x) in units.items():
                    planes = np.random.default_rng([seed, int(d)]).standard_normal((int(d), bits + 1))
                    seen = (x / np.sqrt((x**2).sum(1))[:, None]) @ planes
                    out.loc[rows, "code"] = (seen[:, :-1] > 0) @ (1 << np.arange(bits))
                    out.loc[rows, "at"] = seen[:, -1]
                yield out

    def compare(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for part in parts:
            part = part if rest is None else pd.concat([rest, part], ignore_index=True)
            key = part[["seed", "label", "d", "code"]].to_numpy()
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1 if len(part) else np.zeros(0, int)
            edges = [0, *cuts.tolist(), len(part)]
            for n, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
                last = n == len(edges) - 2
                while hi - lo >= BLOCK or (hi > lo and not last):
                    end = min(hi, lo + BLOCK)
                    yield _pairs(part["node"].to_numpy()[lo:end], matrix(part["v"][lo:end], "<f4"), LOOSE, LISTED)
                    lo = end
                rest = part.iloc[lo:hi] if last else rest
        if rest is not None and len(rest):
            yield _pairs(rest["node"].to_numpy(), matrix(rest["v"], "<f4"), LOOSE, LISTED)

    coded = classes.select("node", "label", "d", "v").mapInPandas(
        code, "node bigint, label bigint, d int, v binary, seed int, code bigint, at double"
    )
    n = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["seed", "label", "d", "code", "at"]
    sorted_rows = coded.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return sorted_rows.mapInPandas(compare, _PAIRS)


def _nearest(pairs: DataFrame) -> DataFrame:
    """Lists (u, v, sim) of the LISTED nearest neighbours of each node, from pairs that may repeat."""
    both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"), "sim").unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v"), "sim"))
    nth = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return both.withColumn("nth", nth).filter(F.col("nth") <= LISTED).drop("nth")


def _meetings(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs that meet at a common neighbour: of each node its list and the nearest of those that list it."""
    nth = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("sim"), "u"))
    listed_by = lists.withColumn("nth", nth).filter(F.col("nth") <= LISTED).select(F.col("v").alias("at"), F.col("u").alias("node"))
    members = lists.select(F.col("u").alias("at"), F.col("v").alias("node")).unionByName(listed_by)
    members = members.join(classes.select("node", "v"), "node").select("at", "node", "v")

    def pairs_of(part: pd.DataFrame, edges: list[int]) -> pd.DataFrame:
        """The pairs of each meeting point; edges[i] to edges[i + 1] are the rows of one."""
        nodes, found = part["node"].to_numpy(), []
        for lo, hi in zip(edges[:-1], edges[1:]):
            ids, rows = np.unique(nodes[lo:hi], return_index=True)
            found.append(_near(ids, matrix(part["v"].iloc[lo + rows], "<f4"), LOOSE, LISTED))
        columns = [np.concatenate(c) for c in zip(*found)]
        return pd.DataFrame(dict(zip(("a", "b", "sim"), columns))).drop_duplicates(["a", "b"])

    def meet(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None  # the rows of the last meeting point, which may go on in the next batch
        for part in parts:
            part = part if rest is None else pd.concat([rest, part], ignore_index=True)
            if not len(part):
                continue
            at = part["at"].to_numpy()
            edges = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist()]
            if len(edges) > 1:
                yield pairs_of(part, edges)
            rest = part.iloc[edges[-1] :]
        if rest is not None:
            yield pairs_of(rest, [0, len(rest)])

    # at most 2 x LISTED rows for each meeting point
    return members.repartition("at").sortWithinPartitions("at").mapInPandas(meet, _PAIRS)


def _tiles(classes: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """(node, others): the rows that each node of the saturated components (node, root) is linked to. All
    vectors of a component are compared in tiles of TILE; a tile sends one count for each node, not its pairs."""
    sizes = members.groupBy("root").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    rows = members.join(sizes, "root").join(classes.select("node", "v", "number"), "node").withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")))
    left = rows.withColumn("s", F.explode(F.expr("sequence(t, tiles - 1)"))).select("root", F.col("t").alias("i"), F.col("s").alias("j"), "node", "v", "number")
    right = rows.withColumn("s", F.explode(F.expr("sequence(0L, t)"))).select("root", F.col("s").alias("i"), F.col("t").alias("j"), "node", "v", "number")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if not len(x) or not len(y):
            return pd.DataFrame({"node": [], "others": []}, dtype="int64")
        a, b = x["node"].to_numpy(), y["node"].to_numpy()
        near = (_cosines(matrix(x["v"], "<f4"), matrix(y["v"], "<f4")) >= least) & (a[:, None] != b[None, :])
        counts = [pd.DataFrame({"node": a, "others": near @ y["number"].to_numpy()})]
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:  # else both sides are the same vectors
            counts.append(pd.DataFrame({"node": b, "others": x["number"].to_numpy() @ near}))
        return pd.concat(counts)

    both = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    counted = both.groupBy("root", "i", "j").applyInPandas(compare, "node bigint, others bigint")
    return counted.groupBy("node").agg(F.sum("others").alias("others"))


def _audit(classes: DataFrame, links: DataFrame, tiled: DataFrame, least: float) -> tuple[float, DataFrame]:
    """Recall over a bounded sample of vectors, and the links that brute force finds besides. Known are ``links``
    and the pairs of one component of ``tiled`` (node, root)."""
    sample = classes.orderBy(F.xxhash64(F.lit(9), "node"), "node").limit(AUDIT).select("node", "label", "d", "v").toPandas()
    groups = {k: (g["node"].to_numpy(), matrix(g["v"], "<f4")) for k, g in sample.groupby(["label", "d"])}

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for k, rows in part.groupby(["label", "d"]).groups.items():
                if k in groups:
                    ids, x = groups[k]
                    mine = part.loc[rows, "node"].to_numpy()
                    sims = _cosines(x, matrix(part.loc[rows, "v"], "<f4"))
                    i, j = np.nonzero((sims >= least) & (ids[:, None] != mine[None, :]))
                    yield pd.DataFrame({"q": ids[i], "a": np.minimum(ids[i], mine[j]), "b": np.maximum(ids[i], mine[j])})

    truth = written(classes.select("node", "label", "d", "v").mapInPandas(search, "q bigint, a bigint, b bigint"))
    known = links.select("a", "b").withColumn("known", F.lit(True))
    seen = truth.join(known, ["a", "b"], "left")
    for side in "ab":
        seen = seen.join(tiled.select(F.col("node").alias(side), F.col("root").alias(f"r{side}")), side, "left")
    seen = written(seen.select("a", "b", F.coalesce("known", F.col("ra") == F.col("rb"), F.lit(False)).alias("known")))
    total, found = seen.agg(F.count("*"), F.count_if("known")).first()
    return (found / total if total else 1.0), seen.filter("not known").select("a", "b").distinct()


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.98,
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept.

    Vectors of equal, non-null label are linked if their cosine in double precision is at least ``least``
    (which is above LOOSE). n_links counts the other rows that a row is linked to; component_id is the smallest
    id reachable by links. Defined results: a vector that is null, empty, zero or holds null or
    non-finite components, and a row with a null label, links with nothing and is its own component;
    vectors of different length are not linked; repeated rows are linked with each other; a null id takes
    part, gets the smallest id it reaches, and is kept only if there is none; an empty table gives an empty table.
    """
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<float>").alias("v"))
    usable = F.col("label").isNotNull() & finite("v") & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))

    def encode(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part.assign(v=pack(part["v"], "<f4"))

    coded = rows.filter("usable").select("row", "vec_id", "label", F.size("v").alias("d"), F.transform("v", lambda x: x + F.lit(0.0).cast("float")).alias("v"))
    coded = written(coded.mapInPandas(encode, "row bigint, vec_id bigint, label bigint, d int, v binary"))
    classes = coded.groupBy("label", "d", "v").agg(F.min("row").alias("node"), F.min("vec_id").alias("first_id"), F.count("*").alias("number"))
    classes = written(classes)
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    bits = max(1, min(40, ceil(log2(max(largest, 2) / (BLOCK / 4)))) if largest > BLOCK / 4 else 1)

    pairs, seed = classes.sparkSession.createDataFrame([], _PAIRS), 0
    for _ in range(4):
        pairs = pairs.unionByName(_tables(classes, bits, seed))
        seed += TABLES
        pairs = written(pairs.groupBy("a", "b").agg(F.first("sim").alias("sim")))
        count = pairs.count()
        for _ in range(ROUNDS):
            lists = written(_nearest(pairs))
            pairs = written(pairs.unionByName(_meetings(lists, classes)).groupBy("a", "b").agg(F.first("sim").alias("sim")))
            before, count = count, pairs.count()
            if count <= 1.001 * before:
                break
        links = pairs.filter(F.col("sim") >= least)
        nth = _nearest(links).groupBy("u").agg(F.count("*").alias("n"))
        roots = components(links)
        full = nth.filter(F.col("n") >= LISTED).select(F.col("u").alias("node")).join(roots, "node").select("root").distinct()
        tiled = written(roots.join(full, "root", "left_semi"))
        recall, checked = _audit(classes, links, tiled, least)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"near_duplicates: the audit finds a recall of {recall:.3f} after {seed} hash tables, below {RECALL}")
    if recall < 1:
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(checked))
    numbers = classes.select("node", "number")
    # tiles count all links of their components, so only the links of the other ones and of the audit are added
    few = links.join(tiled, F.col("a") == F.col("node"), "left_anti").select("a", "b").unionByName(checked)
    each = few.select(F.col("a").alias("u"), F.col("b").alias("node")).unionByName(few.select(F.col("b").alias("u"), F.col("a").alias("node")))
    linked = each.join(numbers, "node").select(F.col("u").alias("node"), F.col("number").alias("others"))
    linked = linked.unionByName(_tiles(classes, tiled, least)).groupBy("node").agg(F.sum("others").alias("others"))
    named = classes.join(roots, "node", "left").join(linked, "node", "left")
    least_id = named.filter("root is not null").groupBy("root").agg(F.min("first_id").alias("least"))
    named = named.join(least_id, "root", "left").select(
        "label", "d", "v", (F.col("number") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("least", "first_id").alias("component_id")
    )
    good = coded.join(named, ["label", "d", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = good.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
