"""Near-duplicate texts by bottom-k sketches of one hash function.

1. Every row becomes the set of its distinct word shingles (hashed to 63 bits); its sketch is the k
   smallest hashes. Rows with the same set are one class from here on, so exact copies cost one row.
2. Inverted lists of the retained values generate overlaps. Two sets of the asked similarity share at
   least ``o`` retained values (exact for sets that fit the sketch; else ``o`` is so low that a pair
   misses it with a chance below 1e-7). So they share one of the ``k - o + 1`` rarest values of each,
   and only those are kept: values of common passages drop out, as do classes without enough company.
3. A list of up to ``SHORT`` classes gives all its pairs. Classes that are in a longer list get the lists
   of their full sets in the same way, with the exact overlap. In a large group of loose copies most
   members then are in short lists of rare values only, so the group does not cost a comparison of all
   with all.
4. A list that is still long is worked off by pivots: its most central class (the one whose values are
   the most frequent) meets all others, then leaves. A list whose rest lies in one component by then is
   done, otherwise classes outside its largest component follow as pivots. So copies of one text give a
   star, no pair that could change a component is left out, and none is capped.
5. The union sketch estimates the similarity of a pair and drops the clearly different ones. The rest
   is decided on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.flat import mix, shingle_sets
from tidemark.plans.scratch import written

SHORT = 16
HOME = 64
SPLIT = 512  # rows of a long list that one task compares with the pivots
WIDE = 192  # values of the sketch that is compared when many pairs of a long list meet
MISS = 1e-7
BITS = 25  # of the fixed-size bitmap that spares most texts the shuffle to the exact check


def least_overlap(k: int, percent: int) -> int:
    """The largest overlap of two k-sketches that a linked pair misses with a chance below MISS."""
    p, chance, o = percent / 100, 0.0, 0
    while o < k:
        chance += comb(k, o) * p**o * (1 - p) ** (k - o)
        if chance >= MISS:
            break
        o += 1
    return max(o, 1)


def _sketches(df: DataFrame, id_col: str, text_col: str, width: int, k: int, whole: bool = False) -> DataFrame:
    """(doc_id, n, node, sketch) of every row; with ``whole`` the sketch is the full set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes, nodes, parts, ends = [], [], [], [0]
            for _, found in shingle_sets(batch.column(1), width):
                sizes.append(len(found))
                mark = (mix(found.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(found))) >> np.uint64(1)
                nodes.append(int(mark) if len(found) else None)
                parts.append(found if whole else found[:k])
                ends.append(ends[-1] + len(parts[-1]))
            values = pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), lists],
                names=["doc_id", "n", "node", "sketch"],
            )

    ids = F.col(id_col).cast("bigint").alias("doc_id")
    return df.select(ids, F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id bigint, n bigint, node bigint, sketch array<bigint>"
    )


def _possible(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``texts`` whose doc_id may be among ``ids``: a bitmap of fixed size (at most 4 MB) is
    broadcast, whatever the number of ids; a null id always passes."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITS))
    bitmap = (
        ids.select(slot.alias("slot"))
        .groupBy(F.expr("bitmap_bucket_number(slot)").alias("bucket"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits"))
    )
    byte = F.expr("cast(conv(hex(substring(bits, cast(bitmap_bit_position(slot) div 8 as int) + 1, 1)), 16, 10) as int)")
    return (
        texts.withColumn("slot", slot)
        .withColumn("bucket", F.expr("bitmap_bucket_number(slot)"))
        .join(F.broadcast(bitmap), "bucket")
        .filter(F.getbit(byte, F.expr("cast(bitmap_bit_position(slot) % 8 as int)")) == 1)
        .select("doc_id", "text")
    )


def _linked(shared: Column, a: str, b: str, percent: int) -> Column:
    return 100 * shared >= percent * (F.col(a) + F.col(b) - shared)


def _likely(pairs: DataFrame, classes: DataFrame, k: int, o: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sketches leave a link possible."""
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("node").alias(side), F.col("n").alias(f"n{side}"), F.col("sketch").alias(f"s{side}")), side)
    pairs = pairs.filter((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    small = F.greatest("na", "nb") <= k  # the sketches are the sets
    likely = F.when(small, _linked(F.size(F.array_intersect("sa", "sb")), "na", "nb", percent)).otherwise(both >= o)
    return written(pairs.filter(likely).select("a", "b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, decided on the full sets.

    The pairs of a neighbourhood are decided together (a pair goes to the least candidate of its smaller
    node), so in a group of copies a set travels once for all pairs; a neighbourhood of more than HOME
    nodes is cut into tiles of that many by that many.
    """
    sides = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("node"), F.col("a").alias("other")))
    homes = sides.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")).withColumnRenamed("node", "a")
    pairs = written(pairs.join(homes, "a").select("root", "a", "b"))
    nodes = pairs.select("root", F.explode(F.array("a", "b")).alias("node")).distinct()
    tiles = nodes.groupBy("root").agg(F.ceil(F.count("*") / HOME).alias("tiles"))
    tile = [F.pmod(F.xxhash64(side), F.col("tiles")).alias(f"t{side}") for side in "ab"]
    pairs = written(pairs.join(tiles, "root").select("root", *tile, "a", "b"))
    ends = [pairs.select("root", "ta", "tb", F.col(side).alias("node")) for side in "ab"]
    members = ends[0].unionByName(ends[1]).distinct().join(sets.select("node", "sketch"), "node")
    members = members.withColumns({"b": F.lit(0).cast("bigint"), "asks": F.lit(False)})  # no nulls: ids stay whole numbers
    asking = pairs.withColumnRenamed("a", "node").withColumns({"sketch": F.array().cast("array<bigint>"), "asks": F.lit(True)})
    rows = members.unionByName(asking)

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        held, asked = pdf[~pdf["asks"]], pdf[pdf["asks"]]
        known = dict(zip(held["node"], held["sketch"]))
        out = []
        for a, b in zip(asked["node"], asked["b"]):
            x, y = known[a], known[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    out.append((a, b))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("root", "ta", "tb").applyInPandas(decide, "a bigint, b bigint")


def _lists(sets: DataFrame, overlap: Column) -> DataFrame:
    """Inverted lists (v, node, n, rare, central, length, pivot) of ``sets`` (node, n, sketch) with two
    nodes or more. ``overlap`` is the number of values that a linked pair shares at least; so a node needs
    only its ``values - overlap + 1`` rarest ones, and values of its own count among these. ``rare`` is
    the number of its values that at most SHORT nodes have."""
    posts = sets.select("node", F.explode("sketch").alias("v"))
    often = posts.groupBy("v").agg(F.count("*").alias("often")).filter("often > 1")
    mine = Window.partitionBy("node")
    lists = posts.join(often, "v").withColumns(
        {
            "nth": F.row_number().over(mine.orderBy("often", "v")),
            "company": F.count("*").over(mine),
            "central": F.sum("often").over(mine),
            "frequent": F.count_if(F.col("often") > SHORT).over(mine),
        }
    )
    lists = lists.join(sets.select("node", "n", overlap.alias("o")), "node").filter("nth <= company - o + 1")
    lists = written(lists.select("v", "node", "n", (F.col("n") - F.col("frequent")).alias("rare"), "central"))
    top = F.max(F.struct("central", "node", "n", "rare")).alias("pivot")
    length = lists.groupBy("v").agg(F.count("*").alias("length"), top).filter("length > 1")
    return written(lists.join(length, "v"))


def _short_pairs(lists: DataFrame) -> DataFrame:
    short = lists.filter(F.col("length") <= SHORT).select("v", "node")
    return short.select("v", F.col("node").alias("a")).join(short.select("v", F.col("node").alias("b")), "v").filter("a < b").select("a", "b").distinct()


def _may_link(a: str, b: str, percent: int) -> Column:
    """Whether two nodes that meet in a long list can be linked. All rare values of such nodes are in
    short lists, whose pairs have been tested; so the pair shares none of them, and at best all others."""
    common = F.least(F.col(f"{a}.n") - F.col(f"{a}.rare"), F.col(f"{b}.n") - F.col(f"{b}.rare"))
    return _linked(common, f"{a}.n", f"{b}.n", percent)


def _roots(df: DataFrame, classes: DataFrame, id_col: str, text_col: str, width: int, k: int, percent: int) -> DataFrame:
    o = least_overlap(k, percent)
    exact = F.floor((percent * F.col("n") + 99) / 100)
    lists = _lists(classes, F.when(F.col("n") * 100 <= k * percent, exact).otherwise(o))
    pairs = _likely(_short_pairs(lists), classes, k, o, percent)
    dense = written(lists.filter(F.col("length") > SHORT).select("node").distinct())
    wanted = written(dense.unionByName(pairs.select(F.col("a").alias("node"))).unionByName(pairs.select(F.col("b").alias("node"))).distinct())

    ids = classes.join(wanted, "node", "left_semi").select("doc_id")
    texts = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = _possible(texts, ids).alias("t").join(ids.alias("i"), F.col("t.doc_id").eqNullSafe(F.col("i.doc_id")), "left_semi")
    sets = _sketches(texts, "doc_id", "text", width, k, whole=True).select("node", "n", "sketch")
    sets = written(sets.join(wanted, "node", "left_semi").dropDuplicates(["node"]))

    lists = _lists(sets.join(dense, "node", "left_semi"), exact)
    long = lists.filter(F.col("length") > SHORT).withColumn("me", F.struct("node", "n", "rare"))
    pair = [F.least("me.node", "pivot.node").alias("a"), F.greatest("me.node", "pivot.node").alias("b")]
    stars = long.filter((F.col("node") != F.col("pivot.node")) & _may_link("me", "pivot", percent)).select(pair)
    more = _short_pairs(lists).unionByName(stars).distinct().join(pairs, ["a", "b"], "left_anti")
    pairs = pairs.unionByName(_likely(more, classes, k, o, percent))
    roots = components(written(_confirmed(pairs, sets, percent)))

    rest, pivots, full = long.filter(F.col("node") != F.col("pivot.node")).select("v", "node", "me", "central"), 64, False
    while True:
        rest = rest.drop("root", "main", "spread").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        sizes = rest.groupBy("v", "root").agg(F.count("*").alias("size")).groupBy("v")
        main = sizes.agg(F.max_by("root", F.struct("size", "root")).alias("main"), F.count("*").alias("kinds"), F.ceil(F.sum("size") / SPLIT).alias("spread"))
        main = main.filter("kinds > 1").select("v", "main", "spread")
        rest = written(rest.join(main, "v"))
        if rest.isEmpty():
            return roots
        if not full:  # few rows are left: they carry their lists and a wider sketch from here on
            places = rest.groupBy("node").agg(F.collect_set("v").alias("places"))
            wide = sets.select("node", F.slice("sketch", 1, WIDE).alias("set"))
            rest = written(rest.join(places, "node").join(wide, "node"))
            full = True
        by_list = Window.partitionBy("v").orderBy(F.col("root") == F.col("main"), F.desc("central"), "node")
        nth = rest.select("v", "node", "root", "main", "central").withColumn("nth", F.row_number().over(by_list))
        used = written(nth.filter(F.col("nth") <= pivots).select("v", "node"))
        top = rest.join(used, ["v", "node"], "left_semi").select(
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("spread") - 1)).alias("part"), F.col("v").alias("w"), F.col("me").alias("pivot"), F.col("root").alias("pivot_root"), F.col("places").alias("pivot_places"), F.col("set").alias("pivot_set")
        )
        meet = (F.col("v") == F.col("w")) & (F.pmod(F.xxhash64("node"), F.col("spread")) == F.col("part")) & (F.col("root") != F.col("pivot_root")) & _may_link("me", "pivot", percent)
        once = F.col("v") == F.array_min(F.array_intersect("places", "pivot_places"))  # of all lists they share
        shared = F.size(F.array_intersect("set", "pivot_set"))
        whole = F.greatest("me.n", "pivot.n") <= WIDE
        likely = F.when(whole, _linked(shared, "me.n", "pivot.n", percent)).otherwise(shared >= least_overlap(WIDE, percent))
        pairs = written(rest.join(top, meet & once & likely).select(pair).distinct())
        if not pairs.isEmpty():
            stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            roots = components(stars.unionByName(_confirmed(pairs, sets, percent)))
        rest = rest.join(used, ["v", "node"], "left_anti")
        pivots *= 16


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, k: int = 32
) -> DataFrame:
    """One row per row of ``df``: doc_id, n_shingles, component_id, kept.

    Rows are linked if their sets of ``width``-word shingles have a Jaccard similarity of at least
    ``percent``/100. component_id is the smallest doc_id reachable by links. Words are runs of other
    characters than ASCII white space, A-Z lower-cased. Defined results: a null or empty text has
    n_shingles 0, links with nothing and is its own component; a text with fewer words than ``width``
    is one shingle; repeated rows share a component and are both marked kept if their id is the
    smallest; a null id takes part by its text, gets the smallest id it reaches (null if there is
    none) and is kept only in the latter case. Other columns of ``df`` are not touched. An empty
    table gives an empty table.
    """
    rows = written(_sketches(df, id_col, text_col, width, k))
    classes = written(
        rows.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    )
    roots = _roots(df, classes, id_col, text_col, width, k, percent)
    named = classes.select("node", "doc_id").join(roots, "node", "left")
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    names = named.join(least, "root", "left").select("node", F.coalesce("least", "doc_id").alias("component_id"))
    out = rows.drop("sketch").join(names, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
