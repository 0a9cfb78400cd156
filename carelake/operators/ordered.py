"""Ordered per-key calculations that hold up when one key owns a large share of the rows.

A plain window over a key sorts all rows of that key in one task. Keys with more than `hot_rows` rows are
therefore cut into ranges of the order columns that hold about `hot_rows` rows each: the window runs per (key, range), and
one small row per range carries the state across its borders, as in a prefix scan. Borders are quantiles of a sample taken
by hash, so they follow the rows wherever these crowd, and a re-run task finds the same ones. All other keys keep the plain
window, so data without hot keys pays one count per key on top of a single shuffle.

Rows that are equal in all order columns stay in one range. Order columns must not be NULL. Keys may be: rows without a
key are one group, which is cut like any other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000

#: Sampled rows for each range of a hot key.
SAMPLED = 32

_HOT = "_hot"
_SLICE = "_slice"
_POS = "_pos"
_EDGE = "_edge"


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than `hot_rows` rows and their `_rows`: at most one key per `hot_rows` rows of input, so the list is
    small enough to replicate. The count is exact, which keeps a re-run task on the same ranges."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.filter(F.col("_rows") > hot_rows)


def _borders(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> DataFrame:
    """Per hot key the order values at which its ranges begin, the first one left out: one per `hot_rows` rows."""
    hot = hot_keys(df, keys, hot_rows).withColumn("_ranges", F.ceil(F.col("_rows") / max(hot_rows, 1)).cast("int"))
    drawn = F.pmod(F.xxhash64(*keys, *order), F.lit(1 << 30)) / float(1 << 30)
    sample = df.select(*keys, *order).join(F.broadcast(hot), list(keys)).where(drawn < SAMPLED * F.col("_ranges") / F.col("_rows"))
    ranked = sample.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(*order))).alias("_sample"), F.max("_ranges").alias("_ranges"))
    cut = F.transform(F.sequence(F.lit(1), F.col("_ranges")), lambda i: F.get(
        "_sample", F.floor(i * F.size("_sample") / F.col("_ranges")).cast("int")))
    # A hot key of which nothing was drawn is one range.
    found = hot.select(*keys).join(ranked.select(*keys, F.array_distinct(F.array_compact(cut)).alias(_HOT)), list(keys), "left")
    return found


def _range_of(borders: Column, rank: Column) -> Column:
    """Number of borders up to the rank, by binary search."""
    steps = F.array(*[F.lit(1 << bit) for bit in range(24, -1, -1)])
    passed = lambda at, step: (at + step <= F.size(borders)) & (F.get(borders, at + step - 1) <= rank)
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(passed(at, step), at + step).otherwise(at))


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int) -> tuple[DataFrame, list[str]]:
    """Rows with the range of hot keys (NULL for all others), and the names of key columns that are never NULL."""
    names = [f"_key{i}" for i in range(len(keys))]
    known = df.withColumns({
        n: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")) for n, k in zip(names, keys)})
    borders = _borders(known, names, order, hot_rows).withColumn("_is_hot", F.lit(True))
    marked = known.join(F.broadcast(borders), names, "left")
    place = F.when(F.col("_is_hot"), F.coalesce(_range_of(F.col(_HOT), F.struct(*order)), F.lit(0)))
    return marked.withColumn(_SLICE, place).drop(_HOT, "_is_hot"), names


def _sorted(order: Sequence[str], forward: bool) -> list[Column]:
    return [F.col(c).asc() if forward else F.col(c).desc() for c in order]


def _neighbour(df, keys, order, values: Mapping[str, str], forward: bool, hot_rows: int) -> DataFrame:
    ranked, keys = _sliced(df, keys, order, hot_rows)
    inside = Window.partitionBy(*keys, _SLICE).orderBy(*_sorted(order, forward))
    sources = list(dict.fromkeys(values.values()))
    pack = F.struct(*[F.col(c) for c in sources])
    rank = F.struct(*[F.col(c) for c in order])

    border = F.max_by(pack, rank) if forward else F.min_by(pack, rank)
    along = Window.partitionBy(*keys).orderBy(F.col(_SLICE).asc() if forward else F.col(_SLICE).desc())
    edges = (
        ranked.filter(F.col(_SLICE).isNotNull())
        .groupBy(*keys, _SLICE)
        .agg(border.alias(_EDGE))
        .withColumn(_EDGE, F.lag(_EDGE).over(along))
    )
    out = ranked.withColumn(_POS, F.row_number().over(inside))
    for name, source in values.items():
        out = out.withColumn(name, F.lag(source).over(inside))
    out = out.join(edges, [*keys, _SLICE], "left")
    for name, source in values.items():
        out = out.withColumn(name, F.when(F.col(_POS) == 1, F.col(f"{_EDGE}.{source}")).otherwise(F.col(name)))
    return out.drop(_SLICE, _POS, _EDGE, *keys)


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    values: Mapping[str, str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `{new: source}` columns holding the source column of the preceding row of the key."""
    return _neighbour(df, keys, order, values, True, hot_rows)


def next_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                values: Mapping[str, str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add `{new: source}` columns holding the source column of the following row of the key."""
    return _neighbour(df, keys, order, values, False, hot_rows)


def _running(df, keys, order, value: Column, name: str, fold, merge, hot_rows: int) -> DataFrame:
    ranked, keys = _sliced(df, keys, order, hot_rows)
    ranked = ranked.withColumn(name, value)
    inside = (
        Window.partitionBy(*keys, _SLICE).orderBy(*_sorted(order, True)).rowsBetween(Window.unboundedPreceding, 0)
    )
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ranked.filter(F.col(_SLICE).isNotNull())
        .groupBy(*keys, _SLICE)
        .agg(fold(name).alias(_EDGE))
        .withColumn(_EDGE, fold(_EDGE).over(before))
    )
    local = ranked.withColumn(name, fold(name).over(inside))
    return (
        local.join(carried, [*keys, _SLICE], "left")
        .withColumn(name, merge(F.col(name), F.col(_EDGE)))
        .drop(_SLICE, _EDGE, *keys)
    )


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  value: Column, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Cumulative sum of `value` along `order`, current row included."""
    return _running(df, keys, order, value, name, F.sum,
                    lambda here, earlier: here + F.coalesce(earlier, F.lit(0)), hot_rows)


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                value: Column, name: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Largest `value` seen so far along `order`, current row included."""
    return _running(df, keys, order, value, name, F.max, lambda here, earlier: F.greatest(here, earlier),
                    hot_rows)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by `order`.

    An aggregate, not a `row_number` window: partial results shrink a hot key before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    rank = F.struct(*[F.col(c) for c in order])
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)
