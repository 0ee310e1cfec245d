"""Chat formatting of logged conversations, after the collapse of cumulative snapshots.

A log often holds a conversation several times, each time with the turns so far. A running hash over the
turns (position, role and text; a sum of two 64-bit hashes of each) marks every prefix. A conversation whose whole hash is
a proper prefix of another goes by an anti-join; of equal conversations the smallest id stays. What is
left is rendered. All work is DataFrame functions.

The running sums are taken in chunks of CHUNK turn numbers, so a very long conversation is spread over
tasks, and the rendered text comes in parts of at most CHUNK turns, so no unbounded group is gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 64
HEAD, MIDDLE, TAIL = "<|im_start|>", "\n", "<|im_end|>\n"


def _numbered(turns: DataFrame) -> DataFrame:
    """Turns with their position (from 1) and the running hash (h1, h2) of the conversation so far."""
    order = ["turn", "role", "text"]
    order = [F.asc_nulls_first(c) for c in order]
    turns = turns.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 62)).cast("bigint")))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(*order)
    chunks = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(chunks), F.lit(0))
    starts = turns.groupBy("conv_id", "chunk").agg(F.count("*").alias("n")).withColumn("start", before("n"))
    at = turns.withColumn("nth", F.row_number().over(inside)).join(starts.select("conv_id", "chunk", "start"), ["conv_id", "chunk"])
    at = at.withColumn("position", F.col("start") + F.col("nth"))
    said = F.concat_ws("\x1f", F.coalesce("role", F.lit("")), F.coalesce("text", F.lit("")))
    for n in (1, 2):
        at = at.withColumn(f"e{n}", F.xxhash64(F.lit(n), "position", said).cast("decimal(20,0)"))
    sums = at.groupBy("conv_id", "chunk").agg(F.sum("e1").alias("s1"), F.sum("e2").alias("s2"))
    sums = sums.select("conv_id", "chunk", before("s1").alias("b1"), before("s2").alias("b2"))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = at.withColumns({"r1": F.sum("e1").over(running), "r2": F.sum("e2").over(running)}).join(sums, ["conv_id", "chunk"])
    return at.select("conv_id", "position", "role", "text", (F.col("b1") + F.col("r1")).alias("h1"), (F.col("b2") + F.col("r2")).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id and n_turns of the conversations that stay; ``turns`` as from _numbered."""
    lengths = turns.groupBy("conv_id").agg(F.max("position").alias("n_turns"))
    marked = turns.select("conv_id", "position", "h1", "h2").join(lengths, "conv_id")
    ends = marked.filter("position = n_turns").groupBy("n_turns", "h1", "h2").agg(F.min("conv_id").alias("conv_id"))
    prefixes = marked.filter("position < n_turns").select(F.col("position").alias("n_turns"), "h1", "h2").distinct()
    return ends.join(prefixes, ["n_turns", "h1", "h2"], "left_anti").select("conv_id", "n_turns")


def render(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each part of a conversation that stays: conv_id, part (from 0), n_turns (of the
    conversation), text (its turns, each as head, role, line feed, text, tail).

    Defined results: rows without a conversation id belong to none and are left out; turns are ordered by
    number, role and text, nulls first, and repeated rows are turns of their own; null roles and texts are
    rendered (and compared) as empty; a conversation is a prefix by what its turns say, not by their
    numbers; an empty table gives an empty table. Other columns are not read.
    """
    turns = df.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    turns = _numbered(turns)
    kept = turns.join(maximal(turns), "conv_id")
    line = F.concat(F.lit(HEAD), F.coalesce("role", F.lit("")), F.lit(MIDDLE), F.coalesce("text", F.lit("")), F.lit(TAIL))
    parts = kept.withColumns({"part": F.floor((F.col("position") - 1) / CHUNK), "line": line})
    parts = parts.groupBy("conv_id", "part", "n_turns").agg(F.array_sort(F.collect_list(F.struct("position", "line"))).alias("lines"))
    return parts.select("conv_id", "part", "n_turns", F.array_join("lines.line", "").alias("text"))


ORACLE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS position,
    count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM conversations WHERE conv_id IS NOT NULL
), prefixes AS (
  SELECT conv_id, position, n_turns, md5(string_agg(md5(role || chr(31) || text), ',') OVER (PARTITION BY conv_id ORDER BY position)) AS h FROM turns
), ends AS (
  SELECT n_turns, h, min(conv_id) AS conv_id FROM prefixes WHERE position = n_turns GROUP BY n_turns, h
), kept AS (
  SELECT e.conv_id FROM ends e
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p WHERE p.position = e.n_turns AND p.h = e.h AND p.position < p.n_turns)
)
SELECT conv_id, (position - 1) // {CHUNK} AS part, n_turns,
  string_agg('{HEAD}' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY position) AS text
FROM turns WHERE conv_id IN (SELECT conv_id FROM kept) GROUP BY conv_id, part, n_turns
"""
