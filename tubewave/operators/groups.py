"""Work on whole groups of rows, such as the boxes of one image or the flaws of one scan.

Groups of usual size meet in one task after a single shuffle, and many of them are worked on at once on arrays. Groups above
``CROWD`` rows are set apart first, so that none of them is gathered: operators take them another way.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: Rows up to which a group is worked on as a whole.
CROWD = 512
#: Rows of a task of the shuffle, rows that are worked on together, and pairs that are formed together.
TASK_ROWS, TOGETHER, PAIRS = 1_000_000, 16_384, 500_000

Rows = dict[str, np.ndarray]


def has_keys(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def crowds(frames: list[DataFrame], keys: list[str]) -> tuple[DataFrame | None, int]:
    """Keys with more than ``CROWD`` rows in all frames together, as a written table (None without any), and the rows of all."""
    rows = reduce(DataFrame.unionAll, [f.select(*keys) for f in frames]).where(has_keys(keys))
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, most = counted.agg(F.sum("_rows"), F.max("_rows")).first()
    if not total or most <= CROWD:
        return None, total or 0
    return cut_lineage(counted.where(F.col("_rows") > CROWD).select(*keys), "crowds"), total


def gathered(rows: DataFrame, keys: list[str], order: list[str | Column], total: int) -> DataFrame:
    """Rows of one key side by side and in order; as many tasks as ``total`` rows need."""
    usual = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-total // TASK_ROWS)
    dealt = rows.repartition(*keys) if needed <= usual else rows.repartition(needed, *keys)
    return dealt.sortWithinPartitions(*keys, *order)


def by_groups(keys: list[str], solve: Callable[[pa.Table, np.ndarray], pa.Table]):
    """Arrow function that passes sorted rows on in whole groups, many at once, with the places at which groups begin (and the end)."""

    def edges(table: pa.Table) -> np.ndarray:
        new = np.zeros(table.num_rows, bool)
        new[0] = True
        for k in keys:
            column = table.column(k).combine_chunks()
            new[1:] |= pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)), True).to_numpy(zero_copy_only=False)
        return np.append(np.flatnonzero(new), table.num_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) < TOGETHER:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            at = edges(table)
            held = table.slice(int(at[-2])).to_batches()
            if len(at) > 2:
                yield from solve(table.slice(0, int(at[-2])).combine_chunks(), at[:-1]).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield from solve(table, edges(table)).combine_chunks().to_batches()

    return run


def numbers(table: pa.Table, names: list[str]) -> Rows:
    """Columns as arrays that may be changed; NULL is NaN in numbers."""
    found = {}
    for name in names:
        column = table.column(name)
        plain = pa.types.is_floating(column.type) or pa.types.is_integer(column.type)
        values = column.to_numpy() if plain else np.array(column.to_pylist() + [None], dtype=object)[:-1]
        found[name] = values.copy()
    return found


def pairs_between(first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places ``i, j`` of all pairs of row ``i`` with rows ``first[i]`` to ``last[i]`` (exclusive), in order, some ``PAIRS`` at a time.

    The rows of one ``i`` are never parted.
    """
    many = np.maximum(last - first, 0)
    lo, upto = 0, np.cumsum(many)
    while lo < len(many):
        done = upto[lo - 1] if lo else 0
        hi = max(int(np.searchsorted(upto, done + PAIRS, side="right")), lo + 1)
        part = many[lo:hi]
        i = np.repeat(np.arange(lo, hi), part)
        yield i, np.arange(len(i)) - np.repeat(np.cumsum(part) - part, part) + first[i]
        lo = hi


def pairs_within(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs ``i < j`` of one group."""
    return pairs_between(np.arange(1, at[-1] + 1), np.repeat(at[1:], np.diff(at)))


#: Which pairs of rows ``i`` and ``j`` (arrays of places) join.
Pairs = Callable[[Rows, np.ndarray, np.ndarray], np.ndarray]
#: Work on groups in which rows join: columns as arrays that may be changed in place, begins and ends of the groups; returns a mask of rows that stay.
GroupWork = Callable[[Rows, np.ndarray, np.ndarray], np.ndarray]


def each(work: Callable[[Rows], np.ndarray]) -> GroupWork:
    """Work on one group after the other; ``work`` returns the places of the rows that stay."""

    def run(rows: Rows, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        stays = np.ones(len(next(iter(rows.values()))), bool)
        for lo, hi in zip(begins.tolist(), ends.tolist()):
            kept = work({c: v[lo:hi] for c, v in rows.items()})
            stays[lo:hi] = False
            stays[lo + kept] = True
        return stays

    return run


def work_on_groups(rows: DataFrame, keys: list[str], order: list[str | Column], used: list[str], changed: list[str], joins: Pairs, work: GroupWork, total: int) -> DataFrame:
    """The rows that ``work`` leaves of each group, with their changed columns. Groups in which no two rows join stay as they are.

    ``joins`` uses numbers only.
    """

    plain = [c for c in used if isinstance(rows.schema[c].dataType, T.NumericType)]

    def solve(table: pa.Table, at: np.ndarray) -> pa.Table:
        arrays = numbers(table, plain)
        sizes = np.diff(at)
        group = np.repeat(np.arange(len(sizes)), sizes)
        met = np.zeros(len(sizes), bool)
        for i, j in pairs_within(at):
            met[group[i[joins(arrays, i, j)]]] = True
        if not met.any():
            return table
        some = table.filter(pa.array(met[group])).combine_chunks()
        arrays = numbers(some, used)
        ends = np.cumsum(sizes[met])
        stays = work(arrays, ends - sizes[met], ends)
        for name in changed:
            field = some.schema.field(name)
            values = arrays[name]
            some = some.set_column(some.schema.get_field_index(name), field, pa.array(values if values.dtype != object else values.tolist(), field.type))
        return pa.concat_tables([table.filter(pa.array(~met[group])), some.filter(pa.array(stays))])

    dealt = gathered(rows, keys, order, total)
    return dealt.mapInArrow(by_groups(keys, solve), dealt.schema)
