"""Window features on series of unbounded length.

A daily series is short: one row per date, so ``Window.partitionBy(series)`` holds at most as many
rows as the calendar has days. A raw series (readings, events) has no such bound, and one series may
hold a third of the table. These plans give the same values as the plain window without placing a
series in one task:

1. ``index_rows`` range partitions by (series, order), writes the table, and numbers all rows.
2. Rows are cut into chunks of equal length. Each chunk also receives a copy of the rows just outside
   it (its halo), as many as the widest frame reaches.
3. The window runs per (chunk, series), and the halo copies are dropped.

Unbounded carries (forward fill, interpolation) pass one value per (chunk, series) instead of a halo.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.plans.scratch import written

POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above this bit
MAX_CHUNK = 1_000_000
MIN_CHUNK = 1_000
CHUNKS_PER_PARTITION = 4


def place_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The table in (keys, order) range partitions, written, with the position of each row within
    its partition in ``_id``."""
    return written(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_id", F.monotonically_increasing_id())
    )


def number_rows(placed: DataFrame) -> DataFrame:
    """Replace ``_id`` by ``_rn``, the position over the whole table."""
    part = F.shiftright("_id", POSITION_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition, so both the ordered window and the broadcast stay small
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    local = F.col("_id").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_rn", F.col("_offset") + local)
        .drop("_part", "_offset", "_id")
    )


def index_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``_rn``: the 0-based position of each row in (keys, order) over the whole table.

    ``order`` must be unique within a series; add an id column to it if timestamps repeat.
    """
    return number_rows(place_rows(df, keys, order))


def chunk_length(placed: DataFrame, reach: int, chunk_rows: int | None) -> int:
    """Rows per chunk: a few chunks per shuffle partition, at most ``MAX_CHUNK``, at least the reach."""
    if chunk_rows is None:
        partitions = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunk_rows = min(MAX_CHUNK, max(placed.count() // (CHUNKS_PER_PARTITION * partitions), MIN_CHUNK))
    return max(chunk_rows, reach, 1)


def _whole(size: int) -> Column:
    """The chunk of a row, by whole-number division."""
    return F.expr(f"_rn div {int(size)}")


def over_chunks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    build: Callable[[WindowSpec], Sequence[Column]],
    back: int,
    ahead: int = 0,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Append the columns of ``build(window)``, whose frames reach at most ``back`` rows behind and
    ``ahead`` rows past the current row."""
    placed = place_rows(df, keys, order)
    size = chunk_length(placed, max(back, ahead), chunk_rows)
    home = _whole(size)
    spot = F.col("_rn") % size
    targets = F.array(
        home,
        F.when(spot >= size - back, home + 1),
        F.when(spot < ahead, home - 1),
    )
    spread = (
        number_rows(placed)
        .withColumn("_home", home)
        .withColumn("_chunk", F.explode(F.array_compact(targets)))
    )
    window = Window.partitionBy("_chunk", *keys).orderBy("_rn")
    return (
        spread.select(*df.columns, "_home", "_chunk", *build(window))
        .filter(F.col("_home") == F.col("_chunk"))
        .drop("_home", "_chunk")
    )


def _carry(chunked: DataFrame, keys: Sequence[str], known: Column, name: str, reverse: bool = False) -> DataFrame:
    """Add the nearest known struct at or before each row (at or after it, if reversed), within the
    chunk or carried over from the chunks passed. One carried value per (chunk, series)."""

    def direction(col: str) -> Column:
        return F.col(col).desc() if reverse else F.col(col).asc()

    edge = F.min(known) if reverse else F.max(known)
    edges = chunked.groupBy("_chunk", *keys).agg(edge.alias("_edge"))
    passed = Window.partitionBy(*keys).orderBy(direction("_chunk")).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        F.col("_chunk").alias("_c_chunk"),
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.last("_edge", True).over(passed).alias("_carried"),
    )
    so_far = Window.partitionBy("_chunk", *keys).orderBy(direction("_rn")).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_chunk") == F.col("_c_chunk")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    local = chunked.withColumn("_local", F.last(known, True).over(so_far))
    return local.join(carried, same, "left").select(
        *chunked.columns, F.coalesce("_local", "_carried").alias(name)
    )


def _chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk_rows: int | None) -> DataFrame:
    placed = place_rows(df, keys, order)
    size = chunk_length(placed, 1, chunk_rows)
    return number_rows(placed).withColumn("_chunk", _whole(size))


def _known(col: str) -> Column:
    return F.when(F.col(col).isNotNull(), F.struct(F.col("_rn").alias("pos"), F.col(col).alias("value")))


def forward_fill_long(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, chunk_rows: int | None = None
) -> DataFrame:
    """Replace nulls of ``col`` by the last earlier value of the series, however far back it lies."""
    found = _carry(_chunked(df, keys, order, chunk_rows), keys, _known(col), "_prev")
    return found.withColumn(col, F.col("_prev.value")).select(*df.columns)


def interpolate_long(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, chunk_rows: int | None = None
) -> DataFrame:
    """Linear interpolation by row position; leading nulls stay, trailing nulls take the last value."""
    found = _carry(_chunked(df, keys, order, chunk_rows), keys, _known(col), "_prev")
    found = _carry(found, keys, _known(col), "_next", reverse=True)
    return found.withColumn(col, lerp_between("_prev", "_next", F.col("_rn"))).select(*df.columns)


def lerp_between(prev: str, nxt: str, position: Column) -> Column:
    """Value at ``position`` on the line between two (pos, value) structs; flat after the last one."""
    gap = F.col(f"{nxt}.pos") - F.col(f"{prev}.pos")
    share = F.try_divide((position - F.col(f"{prev}.pos")).cast("double"), gap.cast("double"))
    rise = F.col(f"{nxt}.value") - F.col(f"{prev}.value")
    return F.when(
        F.col(prev).isNotNull(),
        F.col(f"{prev}.value") + F.coalesce(rise * share, F.lit(0.0)),
    )
