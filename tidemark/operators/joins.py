"""Joins of many rows to one row per key that keep a hot key out of a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import keep


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that hold more rows than an even share of a shuffle partition.

    There are fewer of them than shuffle partitions, whatever the data, so they are safe
    to broadcast. The count is partially aggregated, so a hot key costs one row per task.
    """
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    counts = keep(rows.dropna(subset=list(keys)).groupBy(*keys).count(), "key-counts")
    total = counts.agg(F.sum("count")).first()[0] or 0
    return counts.where(F.col("count") > total / parts).select(*keys)


def join_to_one(many: DataFrame, one: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """``many`` joined on ``keys`` to ``one``, which has at most one row per key.

    Rows of hot keys meet a broadcast of the few rows of ``one`` that have these keys; all
    others are shuffled. ``many`` is read three times: pass a stored table. ``how`` is
    inner or left; a null key matches nothing.
    """
    keys = list(keys)
    hot = keep(hot_keys(many, keys), "hot-keys")
    rest = many.join(F.broadcast(hot), keys, "left_anti").join(one, keys, how)
    if hot.isEmpty():
        return rest
    few = one.join(F.broadcast(hot), keys, "left_semi")
    crowded = many.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(few), keys, how)
    return rest.unionByName(crowded)
