"""Sets of boxes that overlap: connected components over tables, and work on each set apart from all others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .matching import GEOMETRY, HAS_AREA, Grid, pairs_of, runs_of

#: Links up to which one task finishes a graph.
ONE_TASK = 500_000


def _smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links and the smallest node each is connected with by them."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(nodes))
    while True:
        ours, theirs = label[left], label[right]
        if np.array_equal(ours, theirs):
            return nodes, nodes[label]
        low = np.minimum(ours, theirs)
        # the labels are hooked as well as the nodes, so whole trees move at once
        for at in (ours, theirs, left, right):
            np.minimum.at(label, at, low)
        while not np.array_equal(up := label[label], label):
            label = up


def connected_sets(links: DataFrame) -> DataFrame:
    """``node, set`` for every node of ``links`` (longs ``a``, ``b``): the smallest node it is connected with.

    Each level contracts what the links of a task connect; what is left is a link between two results wherever a node was met
    by several tasks. Links are dealt by ranges of their smaller end, so neighbours in the numbering meet, a hub is cut
    into several ranges, and every node with a smaller neighbour is contracted: nodes at least halve from level to level.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    levels: list[DataFrame] = []

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
        if parts:
            nodes, roots = _smallest(*(np.concatenate(side) for side in zip(*parts)))
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])

    while True:
        links = cut_lineage(links.distinct(), "links")
        if links.isEmpty():
            break
        dealt = links.coalesce(1) if links.count() <= ONE_TASK else links.repartitionByRange("a", "b")
        roots = cut_lineage(dealt.mapInArrow(contract, "node long, root long"), "roots")
        label = roots.groupBy("node").agg(F.min("root").alias("label"))
        levels.append(label)
        links = roots.join(label, "node").where("root <> label").select(F.col("label").alias("a"), F.col("root").alias("b"))
    if not levels:
        return links.select(F.col("a").alias("node"), F.col("b").alias("set"))
    found = levels[0].select("node", F.col("label").alias("set"))
    for level in levels[1:]:
        found = found.join(level.select(F.col("node").alias("set"), "label"), "set", "left").select("node", F.coalesce("label", "set").alias("set"))
    return found


Corners = tuple[Column, Column, Column, Column]


def _boxes(rows: DataFrame, keys: list[str], corners: Corners, told: list[Column]) -> DataFrame:
    x1, y1, x2, y2 = (c.cast("double") for c in corners)
    named = rows.select(*keys, *[c.alias(g) for c, g in zip((x1, y1, x2 - x1, y2 - y1), GEOMETRY)], *[c.alias(f"_t{k}") for k, c in enumerate(told)])
    totals = [f(f"_t{k}").alias(f"_{name}{k}") for k in range(len(told)) for name, f in (("least", F.min), ("most", F.max))]
    own = [c for t in range(len(told)) for c in (f"_least{t}", f"_most{t}")]
    boxes = named.where(HAS_AREA).groupBy(*keys, *GEOMETRY).agg(F.count(F.lit(1)).alias("n"), *totals)
    return boxes.select(*keys, *GEOMETRY, "n", F.struct(F.lit(0).alias("_order"), *own).alias("first"))


def overlap_sets(rows: DataFrame, keys: list[str], corners: Corners, grid: Grid, least: float = 0.0, out: str = "_set") -> DataFrame:
    """Rows with the number of their set: rows of one key whose boxes overlap with an IoU above 0 (at least ``least``), directly or through others.

    NULL for rows that overlap no other one. Copies are one box until the end.
    """
    runs = runs_of(None, _boxes(rows, keys, corners, []), keys, grid)
    pairs = pairs_of(runs, keys, grid, least).select(F.col("a_place").alias("a"), F.col("b_place").alias("b"))
    found = runs.join(connected_sets(pairs), F.col("place") == F.col("node"), "left").where("node IS NOT NULL OR n > 1")
    found = found.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[F.col(g).alias(f"_{g}") for g in GEOMETRY], F.coalesce("set", "place").alias(out))
    x1, y1, x2, y2 = (c.cast("double") for c in corners)
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)] + [c == F.col(f"_{g}") for c, g in zip((x1, y1, x2 - x1, y2 - y1), GEOMETRY)]
    return rows.join(found, on, "left").drop(*[f"_k{i}" for i in range(len(keys))], *[f"_{g}" for g in GEOMETRY])


def meeting_sets(rows: DataFrame, keys: list[str], corners: Corners, grid: Grid, set_column: str) -> DataFrame:
    """``a, b``: sets of which boxes overlap or are copies of each other."""
    runs = runs_of(None, _boxes(rows, keys, corners, [F.col(set_column)]), keys, grid)
    pairs = pairs_of(runs, keys, grid).select(F.col("a_first._least0").alias("a"), F.col("b_first._least0").alias("b"))
    copies = runs.select(F.col("first._least0").alias("a"), F.col("first._most0").alias("b"))
    return pairs.union(copies).where("a <> b").distinct()


def settled(rows: DataFrame, keys: list[str], corners: Corners, grid: Grid, order: str, used: list[str], changed: list[str], work: SetWork) -> DataFrame:
    """Work on overlapping sets whose boxes grow, repeated until no grown boxes of different sets meet.

    Grown boxes cover all that they were on the way, so sets whose results stay apart cannot have influenced one another.
    Sets that met are worked on anew, as one, from their original rows; the others are not touched again.
    """
    apart = F.coalesce("_set", -1 - F.monotonically_increasing_id())
    fresh = cut_lineage(overlap_sets(rows, keys, corners, grid).select(*rows.columns, apart.alias("_own"), F.col("_set").alias("_work")), "sets")
    done = cut_lineage(work_on_sets(fresh, "_work", order, used, changed, work), "settled")
    while True:
        met = connected_sets(meeting_sets(done, keys, corners, grid, "_own"))
        if met.isEmpty():
            return done.select(*rows.columns)
        met = cut_lineage(met, "met")
        moved = F.coalesce("set", "_own")
        fresh = fresh.join(met, F.col("_own") == F.col("node"), "left").select(*rows.columns, moved.alias("_own"), F.col("set").alias("_work"))
        fresh = cut_lineage(fresh, "sets")
        again = work_on_sets(fresh.where("_work IS NOT NULL"), "_work", order, used, changed, work)
        done = cut_lineage(done.join(met, F.col("_own") == F.col("node"), "left_anti").unionByName(again), "settled")


#: Work on one set: columns as arrays that may be changed in place, in the given order; returns the places of the rows that stay.
SetWork = Callable[[dict[str, np.ndarray]], np.ndarray]


def work_on_sets(rows: DataFrame, set_column: str, order: str, used: list[str], changed: list[str], work: SetWork) -> DataFrame:
    """The rows that ``work`` leaves of each set, with their changed columns; rows without a set (NULL) stay as they are.

    Many sets come in an Arrow batch; only pieces of the set that is still open are held, and joined once when it ends.
    """
    several = rows.where(F.col(set_column).isNotNull()).repartition(set_column).sortWithinPartitions(set_column, order)

    def solve(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        numbers = table.column(set_column).to_numpy()
        arrays = {}
        for name in used:
            column = table.column(name)
            plain = pa.types.is_floating(column.type) or pa.types.is_integer(column.type)
            values = column.to_numpy() if plain else np.array(column.to_pylist() + [None], dtype=object)[:-1]
            arrays[name] = values.copy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(numbers)) + 1, [len(numbers)]))
        kept = [lo + work({c: v[lo:hi] for c, v in arrays.items()}) for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist())]
        for name in changed:
            field = table.schema.field(name)
            values = arrays[name]
            table = table.set_column(table.schema.get_field_index(name), field, pa.array(values if values.dtype != object else values.tolist(), field.type))
        return table.take(pa.array(np.sort(np.concatenate(kept)))).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column(batch.schema.get_field_index(set_column)).to_numpy()
            first = int(np.searchsorted(numbers, numbers[-1]))  # of the last set
            ended = held and (first > 0 or held[-1].column(batch.schema.get_field_index(set_column))[0].as_py() != numbers[0])
            if first > 0:
                yield solve(pa.Table.from_batches([*held, batch.slice(0, first)]))
                held = []
            elif ended:
                yield solve(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(first))
        if held:
            yield solve(pa.Table.from_batches(held))

    return several.mapInArrow(run, several.schema).unionByName(rows.where(F.col(set_column).isNull()))
