"""Ordered calculations over a series without putting the whole series in one task.

A window without a partition key runs in a single task, and one with a hot entity
nearly so. Here a series is cut into blocks and only one summary row per block is
ever brought together:

* ``with_row_index``: rows per block -> running offsets -> row number within the block;
* ``over_previous_rows``: equal blocks of the index, each with a copy of the last rows
  of the block before it;
* ``forward_fill``: last known value per block, carried into the following blocks.

``entity`` columns (mine, equipment, ...) hold separate series; none means one series.
The order column must be unique within a series, as dates are in the daily table. Rows
without an order value have no place in their series: they are kept, with NULL results,
and spread over ``LOOSE`` groups so that many of them are no hot spot.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 4096
LOOSE = 1024


def _loose(order: Column, *columns: str) -> Column:
    """0 for rows with a place, else one of many groups."""
    return F.when(order.isNull(), F.pmod(F.xxhash64(F.spark_partition_id(), *columns), F.lit(LOOSE)) + 1).otherwise(F.lit(0))


def month_block(order: str = "date") -> Column:
    """Default block: the calendar month, at most 31 rows of a daily series."""
    return F.trunc(order, "MM")


def with_row_index(
    df: DataFrame,
    order: str = "date",
    entity: Sequence[str] = (),
    name: str = "time_index",
    block: Column | None = None,
) -> DataFrame:
    """Add the 0-based position by ``order``. ``block`` must not decrease with ``order``."""
    blocked = df.withColumn("_block", month_block(order) if block is None else block)
    earlier = Window.partitionBy(*entity).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.where(F.col(order).isNotNull()).groupBy(*entity, "_block")
        .agg(F.count("*").alias("_rows"))
        .select(*entity, "_block", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        _at_block(with_block_rows(df, order, entity, block), offsets, entity)
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .select(*df.columns, name)
    )


def with_block_rows(
    df: DataFrame, order: str = "date", entity: Sequence[str] = (), block: Column | None = None
) -> DataFrame:
    """Add ``_block``, ``_loose`` and the 0-based position ``_row`` within the block, NULL without an order value."""
    blocked = df.withColumn("_block", month_block(order) if block is None else block)
    within = Window.partitionBy(*entity, "_block", "_loose").orderBy(order)
    spread = blocked.withColumn("_loose", _loose(F.col(order), *df.columns))
    return spread.withColumn("_row", F.when(F.col(order).isNotNull(), F.row_number().over(within) - 1))


def _at_block(rows: DataFrame, blocks: DataFrame, entity: Sequence[str]) -> DataFrame:
    """Rows with the values of their block; an entity may be missing."""
    named = blocks.select(*[F.col(c).alias(f"_at_{c}" if c in (*entity, "_block") else c) for c in blocks.columns])
    same = rows["_block"] == named["_at__block"]
    for name in entity:
        same = same & rows[name].eqNullSafe(named[f"_at_{name}"])
    return rows.join(named, same, "left")


def over_previous_rows(
    df: DataFrame,
    columns: Callable[[WindowSpec], dict[str, Column]],
    lookback: int,
    entity: Sequence[str] = (),
    index: str = "time_index",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add window columns that look at most ``lookback`` rows back.

    ``columns`` gets the window to use. Blocks have the same number of rows whatever
    the gaps between dates, and the copied rows are dropped after the calculation.
    """
    if lookback > block_rows:
        raise ValueError("a block must hold at least the rows looked back on")
    home = F.floor(F.col(index) / block_rows)
    also_next = F.col(index) % block_rows >= block_rows - lookback
    blocks = F.when(also_next, F.array(home, home + 1)).otherwise(F.array(home))
    window = Window.partitionBy(*entity, "_block", "_loose").orderBy(index)
    placed = F.col(index).isNotNull()
    spread = df.withColumn("_loose", _loose(F.col(index), *df.columns)).withColumn("_block", F.explode(blocks))
    return (
        spread.select("*", *[F.when(placed, column).alias(name) for name, column in columns(window).items()])
        .where(F.col("_block").eqNullSafe(home))
        .drop("_block", "_loose")
    )


def forward_fill(
    df: DataFrame,
    defaults: dict[str, float],
    order: str = "date",
    entity: Sequence[str] = (),
    block: Column | None = None,
) -> DataFrame:
    """Replace NULL by the last known value before it, and by the default where none is.

    Nothing is before a row without an order value, so it gets the default.
    """
    names = list(defaults)
    blocked = df.withColumn("_block", month_block(order) if block is None else block)
    last_known = [
        F.max_by(name, F.when(F.col(name).isNotNull(), F.col(order))).alias(f"_last_{name}") for name in names
    ]
    earlier = Window.partitionBy(*entity).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.where(F.col(order).isNotNull()).groupBy(*entity, "_block")
        .agg(*last_known)
        .select(
            *entity, "_block",
            *[F.last(f"_last_{name}", ignorenulls=True).over(earlier).alias(f"_carry_{name}") for name in names],
        )
    )
    so_far = (
        Window.partitionBy(*entity, "_block", "_loose")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = F.col(order).isNotNull()
    seen = {
        f"_seen_{name}": F.when(placed, F.last(name, ignorenulls=True).over(so_far)).otherwise(F.col(name))
        for name in names
    }
    joined = _at_block(blocked.withColumn("_loose", _loose(F.col(order), *df.columns)).withColumns(seen), carried, entity)
    filled = {
        name: F.coalesce(F.col(f"_seen_{name}"), F.col(f"_carry_{name}"), F.lit(default))
        for name, default in defaults.items()
    }
    return joined.withColumns(filled).select(*df.columns)
