"""Exact ranks and quantiles that never put one group, or one value, into one task.

Equal values are counted first (partial counts before the shuffle), so a hot value becomes one row.
The counted values are then range partitioned by (group, value). Each range partition numbers its own
rows, and a table with one row per (range partition, group) carries the offsets.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scalar_stats import attach_row
from tidemark.plans.scratch import written

FROM_START = Window.unboundedPreceding
SKETCH_ACCURACY = 10_000


def ranked_counts(
    df: DataFrame,
    value: str,
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per (group, distinct non-null value) in sorted position.

    Returns ``by``, ``value``, ``n`` rows with that value, ``n_before`` rows with a smaller value in
    the group, ``n_total`` rows in the group, and each extra aggregate in ``sums``.
    """
    extras = [agg.alias(name) for name, agg in (sums or {}).items()]
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg(F.count(F.lit(1)).alias("n"), *extras)
    )
    return rank_counted(counts, value, by, list(sums or {}))


def rank_counted(counts: DataFrame, value: str, by: Sequence[str], extras: Sequence[str] = ()) -> DataFrame:
    """:func:`ranked_counts` for a table that already has one row per (group, value) with ``n``."""
    by = list(by)
    placed = written(counts.repartitionByRange(*by, value).withColumn("_part", F.spark_partition_id()))

    inside = Window.partitionBy("_part", *by).orderBy(value).rowsBetween(FROM_START, -1)
    numbered = placed.withColumn("_inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))

    heads = placed.groupBy("_part", *by).agg(F.sum("n").alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(FROM_START, -1)
    # one row per range partition and group; written, so that its true size decides how it is joined
    offsets = written(heads.select(
        F.col("_part").alias("_o_part"),
        *[F.col(k).alias(f"_o_{k}") for k in by],
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("n_total"),
    ))
    same = (F.col("_part") == F.col("_o_part")) & same_keys(by, "_o_")
    return numbered.join(offsets, same, "inner").select(
        *by,
        value,
        "n",
        (F.col("_offset") + F.col("_inside")).alias("n_before"),
        "n_total",
        *extras,
    )


def same_keys(by: Sequence[str], prefix: str) -> Column:
    """Equality of the keys with their prefixed copies; null keys are one group."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in by], F.lit(True))


def join_group_stats(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add one row of statistics per group to the rows of the group.

    The statistics are written first, so they are broadcast only if the written size allows it; a
    larger table is joined by shuffle, where hot groups are split at run time.
    """
    return _join_written(df, written(stats) if by else stats, by)


def _join_written(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    """:func:`join_group_stats` with statistics that are written already."""
    if not by:
        return attach_row(df, stats).select(*df.columns, "_stats.*")
    side = stats.withColumnsRenamed({k: f"_g_{k}" for k in by})
    return df.join(side, same_keys(by, "_g_")).drop(*[f"_g_{k}" for k in by])


def average_rank() -> Column:
    """Mean position of the tied rows of one ``ranked_counts`` row, counting from 1."""
    return F.col("n_before") + (F.col("n") + 1) / F.lit(2.0)


def quantiles_of_ranked(ranked: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolation quantiles per group from a ``ranked_counts`` table, one column per name."""
    picks, results = [], []
    for name, q in probs.items():
        position = (F.col("n_total") - 1) * F.lit(float(q))
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            holds = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"_{name}_{side}"))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((lo + (hi - lo) * (position - F.floor(position))).alias(name))
    grouped = ranked.groupBy(*by).agg(F.max("n_total").alias("n_total"), *picks)
    return grouped.select(*by, *results)


def quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    accuracy: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation per group.

    Exact by default: the table is narrowed down first (``narrowed_quantiles``); only if a bracket misses
    its rank is it ranked as a whole. With ``accuracy`` the sketch of ``percentile_approx`` is used alone:
    one scan, and a rank error of at most rows / accuracy, up to whole ranks.
    """
    if accuracy is not None:
        sketch = F.percentile_approx(value, list(probs.values()), accuracy).alias("_sketch")
        rough = df.groupBy(*by).agg(sketch)
        return rough.select(*by, *[F.col("_sketch")[i].cast("double").alias(name) for i, name in enumerate(probs)])
    exact = narrowed_quantiles(df, value, probs, by)
    return exact if exact is not None else quantiles_of_ranked(ranked_counts(df, value, by), value, probs, by)


def narrowed_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame | None:
    """Exact quantiles from two scans and a shuffle of about one row in a thousand.

    A sketch per group brackets each quantile. The second scan counts the rows below each bracket and
    keeps only the values inside, already counted; those are ranked. If a bracket turns out not to
    hold its rank, the result is None and the caller ranks the whole table.
    """
    by = list(by)
    margin = 2 / SKETCH_ACCURACY
    cuts = [c for q in probs.values() for c in (max(0.0, q - margin), min(1.0, q + margin))]
    known = df.select(*by, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    brackets = known.groupBy(*by).agg(F.percentile_approx("_v", cuts, SKETCH_ACCURACY).alias("_cuts"))
    brackets = written(brackets)

    ends = [(F.col("_cuts")[2 * i], F.col("_cuts")[2 * i + 1]) for i in range(len(probs))]
    inside = reduce(lambda a, b: a | b, [F.col("_v").between(lo, hi) for lo, hi in ends])
    # rows outside every bracket share the null value, so each task sends one row per group for them
    counted = written(
        _join_written(known, brackets, by)
        .groupBy(*by, F.when(inside, F.col("_v")).alias("_value"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col("_v") < lo).alias(f"_below{i}") for i, (lo, _) in enumerate(ends)],
        )
    )

    lows = _join_written(counted, brackets, by)
    limits = []
    for i, (name, q) in enumerate(probs.items()):
        lo, hi = ends[i]
        kept = F.col("_value")
        limits += [
            F.sum(f"_below{i}").alias(f"_below{i}"),
            F.coalesce(F.sum(F.when(kept < lo, F.col("n"))), F.lit(0)).alias(f"_kept_below{i}"),
            F.coalesce(F.sum(F.when(kept.between(lo, hi), F.col("n"))), F.lit(0)).alias(f"_held{i}"),
        ]
    totals = written(lows.groupBy(*by).agg(F.sum("n").alias("_total"), *limits))
    holds = F.lit(True)
    for i, q in enumerate(probs.values()):
        position = (F.col("_total") - 1) * F.lit(float(q))
        first, end = F.col(f"_below{i}"), F.col(f"_below{i}") + F.col(f"_held{i}")
        holds = holds & (first <= F.floor(position)) & (F.ceil(position) < end)
    if not totals.filter(~holds).isEmpty():
        return None

    candidates = counted.filter(F.col("_value").isNotNull()).select(*by, "_value", "n")
    ranked = _join_written(rank_counted(candidates, "_value", by).drop("n_total"), totals, by)
    picks, results = [], []
    for i, (name, q) in enumerate(probs.items()):
        position = (F.col("_total") - 1) * F.lit(float(q))
        before = F.col("n_before") + F.col(f"_below{i}") - F.col(f"_kept_below{i}")
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            mine = (before <= rank) & (rank < before + F.col("n"))
            picks.append(F.max(F.when(mine, F.col("_value"))).alias(f"_{name}_{side}"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return ranked.groupBy(*by).agg(F.max("_total").alias("_total"), *picks).select(*by, *results)


def long_format(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of (``keep``, variable, value); all measured columns as double."""
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("value")) for c in cols])
    return df.select(*keep, F.inline(cells))
