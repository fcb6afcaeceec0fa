"""Global ranks and running totals that never gather all rows in one task.

A window without partition keys sorts the whole table in one task. Here rows are
range-partitioned by the full ordering (ties split by the last key), so no task
holds more than its share even when one score covers a third of the rows. The
placed rows are checkpointed once: positions then stay fixed if an executor is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

# monotonically_increasing_id keeps the partition in the upper bits, the row below.
_ROW_BITS = 33


def with_global_rank(df: DataFrame, order_by: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 0-based position of every row; ``order_by`` must end in a unique key."""
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_position", F.monotonically_increasing_id())
        .checkpoint()
    )
    placed = placed.withColumn("_part", F.shiftright("_position", _ROW_BITS))
    starts = _starts(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), ["_n"])
    row = F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_n_before") + row)
        .drop("_part", "_position", "_n_before")
    )


def with_running_totals(
    df: DataFrame, order_by: Sequence[Column], measures: Sequence[str]
) -> DataFrame:
    """Add ``cum_<measure>``: totals up to and including each row of a keyed table."""
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()).checkpoint()
    )
    starts = _starts(placed.groupBy("_part").agg(*[F.sum(m).alias(m) for m in measures]), measures)
    upto = (
        Window.partitionBy("_part")
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = placed.join(F.broadcast(starts), "_part")
    for m in measures:
        out = out.withColumn(f"cum_{m}", F.col(f"{m}_before") + F.sum(m).over(upto))
    return out.drop("_part", *[f"{m}_before" for m in measures])


def with_group_totals(
    df: DataFrame, group: Sequence[str], order_by: Sequence[Column], measures: Sequence[str]
) -> DataFrame:
    """Add ``cum_<measure>``: totals of a group's rows up to and including each row.

    Rows are range-partitioned by group and order, so a group of any size is spread over as
    many tasks as it fills; ``order_by`` must be unique within a group. A partition continues
    at most one group begun before it: the totals carried over are one row per partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    group = list(group)
    by = [F.col(g) for g in group]
    placed = df.repartitionByRange(*by, *order_by).withColumn("_part", F.spark_partition_id()).checkpoint()
    sums = placed.groupBy("_part", *group).agg(*[F.sum(m).alias(m) for m in measures])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        "_part", *group, *[F.sum(m).over(earlier).alias(f"{m}_before") for m in measures]
    ).where(F.col(f"{measures[0]}_before").isNotNull())
    upto = (
        Window.partitionBy("_part", *group)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = placed.join(F.broadcast(carried), ["_part", *group], "left")
    for m in measures:
        out = out.withColumn(f"cum_{m}", F.coalesce(f"{m}_before", F.lit(0)) + F.sum(m).over(upto))
    return out.drop("_part", *[f"{m}_before" for m in measures])


def ntile_of(rank: Column, n: Column, tiles: int) -> Column:
    """1-based tile of a 0-based rank; the first n mod tiles tiles get one row more."""
    small = F.floor(n / tiles)
    larger = n % tiles
    in_larger = larger * (small + 1)
    tile = F.when(rank < in_larger, F.floor(rank / (small + 1))).otherwise(
        larger + F.floor((rank - in_larger) / F.greatest(small, F.lit(1)))
    )
    return (tile + 1).cast("int")


def top_k(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int) -> DataFrame:
    """First k rows per key with their 1-based rank.

    The rank filter lets Spark cut every key to k rows before the shuffle, so a hot
    key sends k rows per task, not all of them.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _starts(parts: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Totals of all earlier partitions: one row per partition, so one small window."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(
        "_part",
        *[
            F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"{m}_before")
            for m in measures
        ],
    )
