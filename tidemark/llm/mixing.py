"""Mixing of sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, repeated as often as needed. A copy of a
document gets the virtual finish time (words of its source up to its end) / (target words of the
source), so all sources reach time 1 when they have given their targets, and a mix cut anywhere before
holds the sources in their target proportions. The copies are range-sorted by that time and the mix is
truncated at the total budget.

Since a source's order is a hash and words flow evenly in virtual time, equal ranges of the hash, and of
the time, hold about equal numbers of rows. The running sums use these ranges: sums for each range, a
window over the (few) ranges, then a window inside each range. So a source with a third of all rows is
spread over as many tasks as there are ranges, and nothing is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import written

WEIGHTS = (5, 2, 1)  # of the sources in order of their names, repeating
BUDGET = 1.5  # words of the mix by words of the sources
REPEATS = 2  # how often a document may occur
WORD = r"[^\x20\x09-\x0D]+"


def _targets(sizes: DataFrame, weights: tuple, budget: float, repeats: int) -> DataFrame:
    """One row for each source: nth, source, source_size, target (double).

    The budget is shared by weight; a source stops at ``repeats`` times its size and its excess is shared
    again. That is a common level: target = least(cap, level x weight), found from the sources sorted by
    cap / weight. The windows run over one row for each source.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    nth = F.row_number().over(by_name)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((nth - 1) % len(weights) + 1).cast("int"))
    caps = sums.select("source", "source_size", nth.alias("nth"), weight.alias("weight"))
    caps = caps.withColumn("cap", (repeats * F.col("source_size")).cast("double")).withColumn("fills", F.col("cap") / F.col("weight"))
    by_fill = Window.orderBy("fills", "nth")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    after = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.lit(budget) * F.sum("source_size").over(whole)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    caps = caps.withColumn("level", level)
    # the first source, by fill, that does not reach its cap sets the level of all after it
    level = F.min(F.when(F.col("fills") > F.col("level"), F.struct("fills", "nth", "level"))).over(whole)["level"]
    target = F.when(level.isNull(), F.col("cap")).otherwise(F.least("cap", level * F.col("weight")))
    return caps.select("nth", "source", "source_size", target.alias("target"))


def _before(df: DataFrame, groups: list[str], bucket: str, order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows of the same groups that come before, by (bucket, order)."""
    sums = df.groupBy(*groups, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*groups, bucket, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, [*groups, bucket])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside")
    )


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple = WEIGHTS, budget: float = BUDGET, repeats: int = REPEATS, seed: str = "mix",
) -> DataFrame:
    """The mix, one row for each copy of a document, and one for each document that it does not hold.

    Columns: row (a number for each row of ``df``), doc_id, copy (from 0), size (words), source,
    source_size, target, virtual_finish, taken (words of the copy that the mix takes) and position (words of the mix
    before it; null if nothing is taken). Sorting by position gives the mix. Words are runs of other
    characters than ASCII white space. The last copy that a source begins before virtual time 1 is taken
    in part, so that each source gives its target, rounded down; the sum never exceeds the budget.
    Defined results: null sources are one source, sorted last; null and empty texts have size 0, of which
    nothing is taken; repeated rows are documents of their own; a table without words has targets 0; an
    empty table gives an empty mix. The order is the MD5 sum of seed and id, ties by size, so reruns agree.
    """
    spark = df.sparkSession
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("order")
    words = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    sizes = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words, order)
    sizes = written(sizes)
    targets = written(_targets(sizes, weights, budget, repeats))
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    span = F.floor(F.conv(F.substring("order", 1, 7), 16, 10).cast("bigint") * ranges / (1 << 28))
    rows = _before(rows.withColumn("span", span), ["nth"], "span", ["order", "size", "row"], "size", "first")
    copies = rows.withColumn("copy", F.explode(F.array(*[F.lit(i) for i in range(repeats)])))
    begins = F.col("first") + F.col("copy") * F.col("source_size")
    taken = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target").cast("bigint") - begins)).cast("bigint")
    copies = copies.withColumn("taken", taken).filter("taken > 0 or copy = 0")
    finish = F.when(F.col("target") > 0, (begins + F.col("size")) / F.col("target"))
    copies = copies.withColumn("virtual_finish", finish).withColumn("at", F.least(F.col("virtual_finish"), F.lit(1.0)))
    copies = copies.withColumn("span", F.when(F.col("taken") > 0, F.floor(F.col("at") * ranges)).otherwise(F.pmod(F.xxhash64("row"), F.lit(ranges)) + ranges + 1))
    copies = _before(copies, [], "span", ["at", "nth", "order", "row"], "taken", "position")
    position = F.when(F.col("taken") > 0, F.col("position").cast("bigint")).alias("position")
    return copies.select("row", "doc_id", F.col("copy").cast("int").alias("copy"), "size", "source", "source_size", "target", "virtual_finish", "taken", position)


def by_document(copies: DataFrame) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (summed over its copies)."""
    out = copies.groupBy("row", "doc_id", "size", "source_size", "target").agg(F.sum("taken").alias("taken"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source IS NULL, encode(source))) - 1) % 3 + 1]::DOUBLE AS weight,
    row_number() OVER (ORDER BY source IS NULL, encode(source)) AS nth
  FROM sizes GROUP BY source
), caps AS (
  SELECT *, (2 * source_size)::DOUBLE AS cap, (2 * source_size)::DOUBLE / weight AS fills FROM sums
), levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY fills, nth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY fills, nth ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM caps
), targets AS (
  SELECT source, source_size, coalesce(least(cap, weight * (SELECT level FROM levels WHERE fills > level ORDER BY fills, nth LIMIT 1)), cap) AS target FROM levels
), queued AS (
  SELECT s.*, t.source_size, t.target,
    sum(size) OVER (PARTITION BY s.source ORDER BY ord, size ROWS UNBOUNDED PRECEDING) - size AS first
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (greatest(0, least(size, floor(target) - first)) + greatest(0, least(size, floor(target) - first - source_size)))::BIGINT AS taken
FROM queued
"""
