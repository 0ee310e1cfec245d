"""Best-fit packing with conflicts.

Texts are packed into bins of a fixed number of words. A text longer than a bin gives full bins and a
rest, so nothing is cut off. The rests are packed by best fit, longest first: bins are kept in order of
their residual room, each with a bitmap of the duplicate clusters and bitmaps of the sources it holds
(one bitmap for each document a source may have in a bin). The search starts at the tightest bin with
room and goes on to its successors until one is compatible, else a bin is opened.

The rows are dealt by a hash into groups of about ``GROUP`` rests, each packed in one task, so memory
and the length of a search are bounded and a cluster or source of any size is spread over all groups.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.mixing import WORD
from tidemark.plans.scratch import written

CAPACITY = 2048
PER_SOURCE = 2
GROUP = 4096


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) of each item, placed in the given order. Sources and clusters are small numbers,
    -1 for a cluster that conflicts with nothing."""
    order: list[tuple[int, int]] = []  # (residual, bin), sorted
    held: list[list[int]] = []  # of each bin: its clusters, then the sources it holds 1, 2, ... times
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters):
        mine, twin = 1 << source, (1 << cluster) if cluster >= 0 else 0
        at = bisect_left(order, (size, -1))
        while at < len(order):
            maps = held[order[at][1]]
            if not (maps[0] & twin or maps[per_source] & mine):
                break
            at += 1
        if at < len(order):
            room, n = order.pop(at)
        else:
            room, n = capacity, len(held)
            held.append([0] * (per_source + 1))
        maps = held[n]
        maps[0] |= twin
        for level in range(1, per_source + 1):
            if not maps[level] & mine:
                maps[level] |= mine
                break
        if room > size:
            insort(order, (room - size, n))
        placed.append((n, capacity - room))
    return placed


def text_cluster(text_col: str) -> Column:
    """A cluster for each distinct word sequence (exact copies, whatever their white space)."""
    return F.md5(F.trim(F.regexp_replace(F.col(text_col).cast("string"), r"[\x20\x09-\x0D]+", " ")))


def pack(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cluster: Column | None = None,
    capacity: int = CAPACITY, per_source: int = PER_SOURCE, group: int = GROUP,
) -> DataFrame:
    """One row for each piece: doc_id, piece (from 0), first_word, words, bin, offset.

    A bin holds at most ``capacity`` words, at most one document of a cluster (exact copies unless a
    column is given) and at most ``per_source`` of a source; only rests share bins. ``bin`` is text,
    unique in the result. Defined results: a null or empty text has no words and no piece; null sources
    are one source; a null cluster conflicts with nothing; repeated rows are exact copies, so they never
    share a bin; ties of length are placed in the order of id; an empty table gives no piece. Other
    columns are not read.
    """
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")
    twin = (text_cluster(text_col) if cluster is None else cluster).cast("string")
    items = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null")).alias("source"), twin.alias("cluster"), words.alias("n"),
    ).filter("n > 0")
    items = written(items)
    full = F.floor(F.col("n") / capacity).cast("int")
    whole = items.filter(F.col("n") >= capacity).withColumn("piece", F.explode(F.sequence(F.lit(0), full - 1)))
    whole = whole.select(
        "doc_id", "piece", (F.col("piece").cast("bigint") * capacity).alias("first_word"), F.lit(capacity).cast("bigint").alias("words"),
        F.concat(F.lit("whole-"), F.col("row"), F.lit("-"), F.col("piece")).alias("bin"), F.lit(0).cast("bigint").alias("offset"),
    )
    rest = items.filter(F.col("n") % capacity > 0).withColumns({"words": F.col("n") % capacity, "piece": full})
    groups = max(1, -(-rest.count() // group))
    rest = rest.withColumn("part", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["words", "doc_id", "row"], ascending=[False, True, True], kind="stable")
        codes = [pd.factorize(pdf[c])[0].tolist() for c in ("source", "cluster")]
        placed = best_fit(pdf["words"].tolist(), *codes, capacity, per_source)
        part = int(pdf["part"].iloc[0])
        return pdf[["doc_id", "piece", "n", "words"]].assign(
            first_word=pdf["n"] - pdf["words"], bin=[f"{part}-{n}" for n, _ in placed], offset=[at for _, at in placed]
        )[["doc_id", "piece", "first_word", "words", "bin", "offset"]]

    schema = "doc_id bigint, piece int, first_word bigint, words bigint, bin string, offset bigint"
    return rest.groupBy("part").applyInPandas(place, schema).unionByName(whole)
