"""Exact quantiles of many columns in two scans, without gathering a column in one place.

``percentile`` and ``median`` keep every distinct value of a column in one buffer. Here the
first scan takes a mergeable KLL sketch of every column, which gives each a bracket of values
around the wanted rank. The second scan counts all columns at once: the rows below the
bracket, and how often each value inside it occurs. Few counted values are read off on the
driver; more of them stay a table, whose running totals point out the wanted rows. A bracket
that missed its rank (the sketch is random) is opened and counted again: results never
depend on the sketch.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranking import with_group_totals
from tidemark.scratch import discard, keep

BRACKET_LIMIT = 50_000  # counted values per column that may reach the driver
SKETCH = 2048  # size of a sketch; its ranks are off by 0.24 % at 99 % confidence
MARGIN = 0.006  # share of the rows a bracket reaches to either side
LOTS = 256  # sketches are merged in as many tasks before the last one


@dataclass
class _Search:
    """Where the wanted ranks of one column lie: inside [low, high]."""

    column: str
    first: int  # 0-based ranks around the wanted position
    second: int
    weight: float  # how far the position lies from first to second
    rows: int  # that the bracket may hold
    low: float | None = None  # None: open
    high: float | None = None


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probability: float = 0.5,
    bracket_limit: int = BRACKET_LIMIT,
    counts: Mapping[str, int] | None = None,
) -> dict[str, float | None]:
    """The quantile of each column, interpolated linearly; None for an all-null column.

    ``counts`` are the numbers of non-null values, if already known: columns of at most
    ``bracket_limit`` values then need no sketch.
    """
    if not columns:
        return {}
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sketched = [c for c in columns if counts is None or counts[c] > bracket_limit]
    counts, brackets = dict(counts or {}), {}
    if sketched:
        found = _sketch(values, sketched, probability)
        for i, c in enumerate(sketched):
            counts[c], brackets[c] = found[f"n{i}"], found[f"b{i}"]
    result: dict[str, float | None] = dict.fromkeys(columns)
    searches = []
    for c in columns:
        if not counts[c]:
            continue
        position = (counts[c] - 1) * probability
        search = _Search(c, math.floor(position), math.ceil(position), position % 1, counts[c])
        if counts[c] > bracket_limit and brackets.get(c):
            search.low, search.high = brackets[c]
            search.rows = math.ceil(counts[c] * 4 * MARGIN)
        searches.append(search)
    while searches:
        found = _count(values, searches, bracket_limit)
        for s in searches:
            if s.column in found:
                low, high = found[s.column]
                result[s.column] = low if low == high else low + (high - low) * s.weight
        searches = [s for s in searches if s.column not in found]
        for s in searches:
            if s.low is None:
                raise RuntimeError(f"the values of {s.column} changed between two scans")
            s.low, s.high, s.rows = None, None, counts[s.column]
    return result


def exact_median(
    df: DataFrame, columns: Sequence[str], counts: Mapping[str, int] | None = None
) -> dict[str, float | None]:
    return exact_quantiles(df, columns, 0.5, counts=counts)


def _sketch(values: DataFrame, columns: Sequence[str], probability: float) -> dict:
    """Non-null counts and brackets, in one scan: sketches are merged by lots, then at once."""
    partial = [F.count(c).alias(f"n{i}") for i, c in enumerate(columns)]
    partial += [F.kll_sketch_agg_double(c, F.lit(SKETCH)).alias(f"s{i}") for i, c in enumerate(columns)]
    lots = values.withColumn("_lot", F.spark_partition_id() % LOTS).groupBy("_lot").agg(*partial)
    merged = lots.agg(
        *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.kll_merge_agg_double(f"s{i}", F.lit(SKETCH)).alias(f"s{i}") for i in range(len(columns))],
    )
    ranks = F.array(F.lit(max(0.0, probability - MARGIN)), F.lit(min(1.0, probability + MARGIN)))
    picked = []
    for i in range(len(columns)):
        # A sketch of nothing, or of NaN only, has no quantiles.
        held = F.kll_sketch_get_n_double(f"s{i}") > 0
        picked.append(F.when(held, F.kll_sketch_get_quantile_double(f"s{i}", ranks)).alias(f"b{i}"))
    found = merged.select(*[F.coalesce(f"n{i}", F.lit(0)).alias(f"n{i}") for i in range(len(columns))], *picked)
    return found.first().asDict()


def _entry(s: _Search) -> Column:
    """A value inside the bracket as it is, one below it as null, all others not at all."""
    value = F.col(s.column)
    if s.low is None:
        taken, below = value.isNotNull(), F.lit(False)
    else:
        taken, below = value <= s.high, value < s.low
    entry = F.struct(F.lit(s.column).alias("name"), F.when(~below, value).alias("value"))
    return F.when(taken, F.array(entry)).otherwise(F.array().cast("array<struct<name: string, value: double>>"))


def _count(values: DataFrame, searches: list[_Search], limit: int) -> dict[str, tuple[float, float]]:
    """The values at both ranks of every search whose bracket holds them."""
    entries = F.flatten(F.array(*[_entry(s) for s in searches]))
    counted = values.select(F.inline(entries)).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    if all(s.rows <= limit for s in searches):
        rows = sorted(((r["name"], r["value"], r["n"]) for r in counted.collect()), key=_nulls_first)
        seen, at = [], {}
        for name, value, n in rows:
            at[name] = at.get(name, 0) + n
            seen.append((name, value, n, at[name]))
        return _read_off(seen, searches)
    kept = keep(counted, "quantile-counts")
    totals = with_group_totals(kept, ["name"], [F.col("value").asc_nulls_first()], ["n"])
    wanted = F.lit(False)
    for s in searches:
        wanted |= (F.col("name") == s.column) & (F.col("cum_n") > s.first) & (F.col("cum_n") - F.col("n") <= s.second)
    rows = [(r["name"], r["value"], r["n"], r["cum_n"]) for r in totals.where(wanted).collect()]
    discard(kept)
    return _read_off(rows, searches)


def _nulls_first(row: tuple) -> tuple:
    """The order of Spark: null, then numbers, then NaN."""
    name, value, _ = row
    kind = 0 if value is None else 2 if math.isnan(value) else 1
    return name, kind, value if kind == 1 else 0.0


def _read_off(rows: list[tuple], searches: list[_Search]) -> dict[str, tuple[float, float]]:
    """The value whose rows, of ``n`` up to ``end``, cover each wanted rank."""
    out = {}
    for s in searches:
        own = [(value, end - n, end) for name, value, n, end in rows if name == s.column and value is not None]
        ends = [[v for v, start, end in own if start <= rank < end] for rank in (s.first, s.second)]
        if all(ends):
            out[s.column] = (ends[0][0], ends[1][0])
    return out
