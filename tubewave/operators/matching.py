"""Overlap matching between predicted and reported flaws.

Boxes of identical geometry are collapsed to one, so a group of copies costs one row. Boxes of both sides
are then sorted along a space-filling curve over position and size, and cut into short runs. Only the
extents of runs are joined: an upper bound of the IoU that two runs can reach decides, before any pair of boxes
is formed, which runs are opened. In a crowd the bound is tested against what neighbours on the curve already reach.
Scans of usual size need none of this: both sides meet in one shuffle and each scan is matched as a whole (``groups``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import iou
from ..session import cut_lineage
from . import groups

GEOMETRY = ["x", "y", "w", "h"]
#: Boxes of a run, and runs of one cell that meet in one task; more runs of a cell are salted.
RUN, CELL_RUNS = 32, 512
#: Neighbours on the curve, before and behind, that give a first lower bound of a box's best IoU.
NEAR = 2
#: Bounds are widened by this share, so that rounding never prunes a pair.
SLACK = 1e-9


@dataclass(frozen=True)
class BoxColumns:
    """Which columns of a table form a box: rotary start, axial start, width, length."""

    x: str = "rotary_start"
    y: str = "axial_start"
    w: str = "width"
    h: str = "length"

    def names(self) -> list[str]:
        return [self.x, self.y, self.w, self.h]


@dataclass(frozen=True)
class Grid:
    """Cell sizes in the unit of each axis: cells many times larger than usual boxes, within which runs are formed."""

    x: float = 120.0
    y: float = 200.0


HAS_AREA = "w > 0 AND h > 0 AND NOT isnan(w) AND NOT isnan(h) AND NOT isnan(x) AND NOT isnan(y)"


def all_boxes(df: DataFrame, keys: list[str], box: BoxColumns, first: Column) -> DataFrame:
    """The geometry of every row that has an area, with ``first``."""
    geometry = [F.col(c).cast("double").alias(g) for c, g in zip(box.names(), GEOMETRY)]
    return df.select(*keys, *geometry, first.alias("first")).where(HAS_AREA)


def distinct_boxes(df: DataFrame, keys: list[str], box: BoxColumns, order: str, payload: list[str], extra: float = 0.0) -> DataFrame:
    """One row per distinct geometry with an area: its number of copies and the first copy in ``order``."""
    geometry = [F.col(c).cast("double").alias(g) for c, g in zip(box.names(), GEOMETRY)]
    rows = df.groupBy(*keys, *geometry).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col(order).alias("_order"), *payload)).alias("first"))
    if extra:
        rows = rows.withColumn("w", F.col("w") + extra).withColumn("h", F.col("h") + extra)
    return rows.where(HAS_AREA)


#: The seven bits of a number with three free bits between any two, as a literal array.
_SPREAD = "array(" + ", ".join(f"{sum((v >> k & 1) << 4 * k for k in range(7))}L" for v in range(128)) + ")"


def _spread(value: Column) -> Column:
    """The 14 bits of a value with three free bits between any two."""
    low, high = (F.get(F.expr(_SPREAD), part.cast("int")) for part in (value.bitwiseAND(F.lit(127)), F.shiftright(value, 7)))
    return low.bitwiseOR(F.shiftleft(high, 28))


def _curve(grid: Grid) -> tuple[Column, Column, Column]:
    """Cell of a box's middle on both axes, and the place of its position in the cell and its size on a curve."""
    place = {"x": (F.col("x") + F.col("w") / 2) / grid.x, "y": (F.col("y") + F.col("h") / 2) / grid.y}
    cells = {axis: F.floor(value) for axis, value in place.items()}
    inner = [F.floor((place[axis] - cells[axis]) * 16383) for axis in ("x", "y")]
    sizes = [F.greatest(F.lit(0).cast("long"), F.least(F.lit(16383).cast("long"), F.floor((F.log2(size) + 16) * 512))) for size in ("w", "h")]
    code = F.lit(0).cast("long")
    for k, value in enumerate([*inner, *sizes]):
        code = code.bitwiseOR(F.shiftleft(_spread(value), k))
    return cells["y"], cells["x"], code


def _reach(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """IoU of boxes row by row (columns x, y, w, h)."""
    ends = [np.minimum(left[:, k] + left[:, k + 2], right[:, k] + right[:, k + 2]) - np.maximum(left[:, k], right[:, k]) for k in (0, 1)]
    shared = np.maximum(ends[0], 0.0) * np.maximum(ends[1], 0.0)
    return shared / (left[:, 2] * left[:, 3] + right[:, 2] * right[:, 3] - shared)


def _mark(group_columns: int):
    """Numbers the runs of sorted rows and, for rows of the first side, looks at neighbours of the second one.

    Rows arrive as group columns, x, y, w, h, side. Adds ``place`` (a number by side), ``run`` (place of its first row) and ``reached``
    (best IoU with the near rows of the other side, 0 for rows of the second side). A run lies within one group. Of copies that
    follow each other only the first row is passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        seen, begun = [0, 0], [0, 0]  # rows of each side so far, and its first row in the open group
        last: list | None = None  # group of the last row
        tail = np.zeros((0, 4))  # last rows of the second side in that group
        before_this: list | None = None  # group, box and side of the row before
        for whole in batches:
            if not whole.num_rows:
                continue
            told = [whole.column(k) for k in range(group_columns + 5)]
            fresh = np.zeros(whole.num_rows, bool)
            for column in told:
                fresh[1:] |= pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, whole.num_rows - 1)), True).to_numpy(zero_copy_only=False)
            fresh[0] = [column[0].as_py() for column in told] != before_this
            before_this = [column[whole.num_rows - 1].as_py() for column in told]
            batch = whole.filter(pa.array(fresh))
            n = batch.num_rows
            if not n:
                continue
            groups = [batch.column(k) for k in range(group_columns)]
            new = np.zeros(n, bool)
            for column in groups:
                new[1:] |= pc.fill_null(pc.not_equal(column.slice(1), column.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
            here = [column[0].as_py() for column in groups]
            new[0] = here != last
            last = [column[n - 1].as_py() for column in groups]
            if new[0]:
                tail = tail[:0]
            number = np.cumsum(new)
            boxes = np.stack([batch.column(group_columns + k).to_numpy(zero_copy_only=False) for k in range(4)], axis=1)
            side = batch.column(group_columns + 4).to_numpy(zero_copy_only=False)
            runs, places = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for s in (0, 1):
                at = np.flatnonzero(side == s)
                count = np.arange(seen[s], seen[s] + len(at))
                # where the group of each row of this side begins, counted in rows of this side
                before = np.concatenate(([0], np.cumsum(side == s)))[:-1] + seen[s]
                starts = np.where(new, before, -1)
                if not new[0]:
                    starts[0] = begun[s]
                starts = np.maximum.accumulate(starts)
                own = starts[at]
                places[at] = base + count
                runs[at] = base + own + (count - own) // RUN * RUN
                seen[s] += len(at)
                begun[s] = int(starts[-1])
            right = np.flatnonzero(side == 1)
            near = np.concatenate([tail, boxes[right]])
            group = np.concatenate([np.full(len(tail), number[0]), number[right]])
            reached = np.zeros(n)
            left = np.flatnonzero(side == 0)
            where = np.searchsorted(right, left) + len(tail)
            for step in range(-NEAR, NEAR):
                other = where + step
                fits = (other >= 0) & (other < len(near))
                fits[fits] = group[other[fits]] == number[left[fits]]
                reached[left[fits]] = np.maximum(reached[left[fits]], _reach(boxes[left[fits]], near[other[fits]]))
            tail = near[group == number[-1]][-NEAR:]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs), pa.array(places), pa.array(reached)], [*batch.schema.names, "run", "place", "reached"])

    return run


def runs_of(left: DataFrame | None, right: DataFrame, keys: list[str], grid: Grid, copies: list[Column] | None = None) -> DataFrame:
    """Boxes of both sides (0 and 1) with their runs and first bounds, as a written table.

    Copies of a box follow each other on the curve, the first one in front (by ``first._order``, or as ``copies`` orders them),
    and leave one row (two, where a range of the sort ends between them).
    """
    both = right.withColumn("side", F.lit(1))
    if left is not None:
        both = left.withColumn("side", F.lit(0)).unionByName(both)
    cy, cx, code = _curve(grid)
    rest = [c for c in ("n", "first") if c in right.columns]
    order = [*keys, "_cy", "_cx", "_code", "side", *GEOMETRY, *(copies or [F.col("first._order")])]
    sided = both.select(*keys, cy.alias("_cy"), cx.alias("_cx"), *GEOMETRY, "side", *rest, code.alias("_code"))
    ranged = sided.repartitionByRange(*order).sortWithinPartitions(*order).drop("_code")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)
    return cut_lineage(ranged.mapInArrow(_mark(len(keys) + 2), f"{fields}, run long, place long, reached double"), "runs")


_EXTENT = ["x0", "x1", "y0", "y1", "w", "h", "area"]


def _extent() -> dict[str, Column]:
    """Extent of a single box in the terms of the extent of a run."""
    x, y, w, h = (F.col(c) for c in GEOMETRY)
    return {"x0": x, "x1": x + w, "y0": y, "y1": y + h, "w": w, "h": h, "area": w * h}


def _run_extents(boxes: DataFrame, keys: list[str], grid: Grid, prefix: str) -> DataFrame:
    """Extent of each run: outermost ends, largest sizes, smallest area and smallest first bound, once for each cell it touches."""
    own = _extent()
    found = {"x0": F.min, "y0": F.min, "area": F.min}
    runs = boxes.groupBy(*keys, "run").agg(*[found.get(c, F.max)(own[c]).alias(c) for c in _EXTENT], F.min("reached").alias("reached"))
    ends = {f"_{a}{k}": F.floor(F.col(f"{a}{k}") / step) for a, step in (("x", grid.x), ("y", grid.y)) for k in (0, 1)}
    cells = runs.withColumns(ends).withColumn("_cx", F.explode(F.sequence("_x0", "_x1"))).withColumn("_cy", F.explode(F.sequence("_y0", "_y1")))
    named = [F.col(c).alias(f"{prefix}{c}") for c in ["run", "reached", *_EXTENT]]
    return cells.select(*keys, "_cx", "_cy", *named, F.col("_x0").alias(f"{prefix}cx"), F.col("_y0").alias(f"{prefix}cy"))


def _may_reach(a: dict[str, Column], b: dict[str, Column], least: Column) -> Column:
    """Whether boxes of two runs can overlap with an IoU of ``least``.

    ``shared >= least * (area + area - shared)`` with the largest overlap and the smallest areas of the runs. The overlap stands in
    it once and nothing is divided, so that the condition stays small enough to be compiled within a join.
    """
    dx = F.least(F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]), a["w"], b["w"])
    dy = F.least(F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]), a["h"], b["h"])
    shared = F.greatest(dx, F.lit(0.0)) * F.greatest(dy, F.lit(0.0))
    return shared * (1 + SLACK) * (1 + least) >= least * (a["area"] + b["area"])


def _at_least(reached: Column, least: float) -> Column:
    """What a pair has to reach: above zero at any rate."""
    return F.greatest(reached, F.lit(max(least, 1e-300)))


def _named(prefix: str) -> dict[str, Column]:
    return {c: F.col(f"{prefix}{c}") for c in _EXTENT}


def _run_pairs(left: DataFrame, right: DataFrame, keys: list[str], grid: Grid, least: float, both: bool) -> DataFrame:
    """Pairs of runs that may hold pairs of boxes worth forming, each once, with the extent of the second run.

    Runs meet in a cell. A cell with many runs is salted: its left runs are dealt out, its right runs repeated.
    """
    a, b = _run_extents(left, keys, grid, "a_"), _run_extents(right, keys, grid, "b_")
    cell = [*keys, "_cx", "_cy"]
    salts = b.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / CELL_RUNS).alias("_salts"))
    a = a.join(salts, cell).withColumn("_salt", F.pmod(F.xxhash64("a_run"), F.col("_salts"))).drop("_salts")
    b = b.join(salts, cell).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))).drop("_salts")
    first = (F.col("_cx") == F.greatest("a_cx", "b_cx")) & (F.col("_cy") == F.greatest("a_cy", "b_cy"))
    worth = _may_reach(_named("a_"), _named("b_"), _at_least(F.col("a_reached"), least))
    if not both:
        worth = worth & (F.col("a_run") <= F.col("b_run"))
    return a.join(b, [*cell, "_salt"]).where(first & worth).select("a_run", "b_run", *[f"b_{c}" for c in _EXTENT])


def _side(prefix: str) -> dict[str, Column]:
    return {g: F.col(f"{prefix}{g}") for g in GEOMETRY}


def _box_pairs(left: DataFrame, right: DataFrame, runs: DataFrame, keys: list[str], least: float, once: bool = False) -> DataFrame:
    """Pairs of boxes of the given runs that reach ``least`` and the first bound of the left one (but for rounding), with their ``iou``.

    ``once``: both sides are the same rows, and of both orders of a pair only one is formed.
    """
    extent = _extent()
    kept = [c for c in [*GEOMETRY, "n", "first", "place", "run"] if c in left.columns]
    a = left.select(*keys, _at_least(F.col("reached"), least).alias("_least"), *[F.col(c).alias(f"a_{c}") for c in kept], *[e.alias(f"a_{c}_") for c, e in extent.items()])
    b = right.select(*[F.col(c).alias(f"b_{c}") for c in [*GEOMETRY, "n", "first", "place", "run"] if c in right.columns], *[e.alias(f"b_{c}_") for c, e in extent.items()])
    one, other = ({c: F.col(f"{p}_{c}_") for c in _EXTENT} for p in ("a", "b"))
    open_ = a.join(runs, "a_run").where(_may_reach(one, _named("b_"), F.col("_least"))).drop(*[f"b_{c}" for c in _EXTENT])
    pairs = open_.join(b, "b_run").where(_may_reach(one, other, F.col("_least")))
    if once:
        pairs = pairs.where((F.col("a_run") < F.col("b_run")) | (F.col("a_place") < F.col("b_place")))
    pairs = pairs.withColumn("iou", iou(_side("a_"), _side("b_")))
    return pairs.drop("_least", "a_run", "b_run", *[f"{p}_{c}_" for p in ("a", "b") for c in _EXTENT])


def overlapping_pairs(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    box: BoxColumns = BoxColumns(),
    order: str = "ind_num",
    left_payload: list[str] = (),
    right_payload: list[str] = (),
    grid: Grid = Grid(),
    inclusive: bool = False,
    least: float = 0.0,
) -> DataFrame:
    """Pairs of distinct overlapping geometries with their IoU (at least ``least``) and first copies.

    ``inclusive`` treats ends as pixels that belong to the box: sizes count one more.
    """
    extra = 1.0 if inclusive else 0.0
    a = distinct_boxes(left, keys, box, order, list(left_payload), extra)
    b = distinct_boxes(right, keys, box, order, list(right_payload), extra)
    a_runs, b_runs = runs_of(None, a, keys, grid), runs_of(None, b, keys, grid)
    pairs = _box_pairs(a_runs, b_runs, _run_pairs(a_runs, b_runs, keys, grid, least, True), keys, least)
    return _less(pairs.where(F.col("iou") >= least), extra).drop("a_place", "b_place")


def pairs_of(runs: DataFrame, keys: list[str], grid: Grid, least: float = 0.0) -> DataFrame:
    """Pairs of boxes of one table of runs with an IoU of at least ``least`` (and above 0), each formed once."""
    return _box_pairs(runs, runs, _run_pairs(runs, runs, keys, grid, least, False), keys, least, once=True).where(F.col("iou") >= least)


def pairs_within(
    df: DataFrame, keys: list[str], box: BoxColumns = BoxColumns(), order: str = "ind_num", grid: Grid = Grid(), inclusive: bool = False, least: float = 0.0
) -> DataFrame:
    """Pairs of distinct overlapping geometries of one table, each formed once; ``a`` is the one whose first copy comes first."""
    extra = 1.0 if inclusive else 0.0
    crowded, total = groups.crowds([df], keys)
    if crowded is None:
        return _less(_pairs_of_groups(df, keys, box, order, extra, least, total), extra)
    pairs = pairs_of(runs_of(None, distinct_boxes(df.join(crowded, keys, "left_semi"), keys, box, order, [], extra), keys, grid), keys, grid, least)
    sides = ["n", "first", *GEOMETRY]
    swap = F.col("a_first._order") > F.col("b_first._order")
    turned = [F.when(swap, F.col(f"{q}{c}")).otherwise(F.col(f"{p}{c}")).alias(f"{p}{c}") for p, q in (("a_", "b_"), ("b_", "a_")) for c in sides]
    usual = _pairs_of_groups(df.join(crowded, keys, "left_anti"), keys, box, order, extra, least, total)
    return _less(pairs.select(*keys, *turned, "iou").unionByName(usual), extra)


def _pairs_of_groups(df: DataFrame, keys: list[str], box: BoxColumns, order: str, extra: float, least: float, total: int) -> DataFrame:
    """Pairs within groups of usual size, each of which is in one task after a single shuffle."""
    geometry = [F.col(c).cast("double").alias(g) for c, g in zip(box.names(), GEOMETRY)]
    rows = df.where(groups.has_keys(keys)).select(*keys, *geometry, F.struct(F.col(order).alias("_order")).alias("first"))
    if extra:
        rows = rows.withColumn("w", F.col("w") + extra).withColumn("h", F.col("h") + extra)
    dealt = groups.gathered(rows.where(HAS_AREA), keys, ["first"], total)
    sides = ["n", "first", *GEOMETRY]
    counted = dealt.withColumn("n", F.lit(0).cast("long"))
    schema = counted.select(*keys, *[F.col(c).alias(f"{p}{c}") for p in ("a_", "b_") for c in sides], F.lit(0.0).alias("iou")).schema

    def solve(table: pa.Table, at: np.ndarray) -> pa.Table:
        boxes = groups.numbers(table, GEOMETRY)
        group = np.repeat(np.arange(len(at) - 1), np.diff(at))
        values = [group, *boxes.values()]
        ranked = np.lexsort(values[::-1])  # stable: the first copy in order is in front
        new = np.append(True, np.any([v[ranked][1:] != v[ranked][:-1] for v in values], axis=0))
        begins = np.flatnonzero(new)
        first, many = ranked[begins], np.diff(np.append(begins, len(ranked)))
        many = many[np.argsort(first)]
        first = np.sort(first)
        one = table.take(pa.array(first)).append_column("n", pa.array(many, pa.int64()))
        square = np.stack([boxes[g][first] for g in GEOMETRY], axis=1)
        found: list[tuple[np.ndarray, ...]] = []
        for i, j in groups.pairs_within(np.searchsorted(group[first], np.arange(len(at)))):
            reached = _reach(square[i], square[j])
            fits = reached >= max(least, 1e-300)
            found.append((i[fits], j[fits], reached[fits]))
        i, j, reached = (np.concatenate(part) for part in zip(*found))
        a, b = one.take(pa.array(i)), one.take(pa.array(j))
        columns = [a.column(k) for k in keys] + [side.column(c) for side in (a, b) for c in sides]
        return pa.Table.from_arrays([*columns, pa.array(reached)], schema.names)

    return dealt.mapInArrow(groups.by_groups(keys, solve), schema)


def _less(pairs: DataFrame, extra: float) -> DataFrame:
    sizes = {f"{p}{c}": F.col(f"{p}{c}") - extra for p in ("a_", "b_") for c in ("w", "h")} if extra else {}
    return pairs.withColumns(sizes) if sizes else pairs


def _places(boxes: dict[str, np.ndarray], at: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For rows of the first side, place of the row of the second one with the highest IoU (-1: none), that IoU and the first of the second side.

    Rows are in order, those of the first side in front within their group.
    """
    n, sizes = len(side), np.diff(at)
    middle = at[:-1] + np.add.reduceat((side == 0).astype(np.int64), at[:-1])
    begins, ends = np.repeat(middle, sizes), np.repeat(at[1:], sizes)
    best, place = np.zeros(n), np.full(n, -1, np.int64)
    geometry = np.stack([boxes[g] for g in GEOMETRY], axis=1)
    sized = (boxes["w"] > 0) & (boxes["h"] > 0) & ~np.isnan(boxes["x"]) & ~np.isnan(boxes["y"])
    for i, j in groups.pairs_between(np.where((side == 0) & sized, begins, ends), ends):
        fits = sized[j]
        i, j = i[fits], j[fits]
        reached = _reach(geometry[i], geometry[j])
        fits = reached >= max(least, 1e-300)
        i, j, reached = i[fits], j[fits], reached[fits]
        np.maximum.at(best, i, reached)
        top = reached == best[i]
        left, first = np.unique(i[top], return_index=True)
        place[left] = j[top][first]
    return place, best, np.where((side == 0) & (begins < ends), begins, -1)


def _match_groups(left: DataFrame, right: DataFrame, keys: list[str], box: BoxColumns, first: Column, least: float, fallback: bool, total: int) -> DataFrame:
    """Rows of groups of usual size with their match: both sides meet in one shuffle, and each group is matched as a whole."""
    own = [f for f in left.schema.fields if f.name not in keys]
    geometry = [F.col(c).cast("double").alias(g) for c, g in zip(box.names(), GEOMETRY)]
    # doubles of the box travel once
    known = {c: g for c, g in zip(box.names(), GEOMETRY) if left.schema[c].dataType.simpleString() == "double"}
    told = [f.name for f in own if f.name not in known]
    rest = F.struct(*told) if told else F.struct(F.lit(0).alias("_none"))
    b = right.where(groups.has_keys(keys)).select(*keys, F.lit(1).cast("byte").alias("_side"), *geometry, first.alias("_right"))
    b = b if fallback else b.where(HAS_AREA)
    a = left.where(groups.has_keys(keys)).select(*keys, F.lit(0).cast("byte").alias("_side"), *geometry, rest.alias("_left"))
    both = a.withColumn("_right", F.lit(None).cast(b.schema["_right"].dataType)).unionByName(b.withColumn("_left", F.lit(None).cast(a.schema["_left"].dataType)))
    dealt = groups.gathered(both, keys, ["_side", "_right"], total)

    def solve(table: pa.Table, at: np.ndarray) -> pa.Table:
        side = table.column("_side").to_numpy()
        place, reached, one = _places(groups.numbers(table, GEOMETRY), at, side, least)
        if fallback:
            reached, place = np.where(place >= 0, reached, 0.0), np.where(place >= 0, place, one)
        ours = np.flatnonzero(side == 0)
        place = place[ours]
        match = table.column("_right").combine_chunks().take(pa.array(place, mask=place < 0))
        out = table.take(pa.array(ours)).drop_columns(["_side", "_right"])
        return out.append_column("iou", pa.array(reached[ours], mask=place < 0)).append_column("match", match)

    kept = dealt.drop("_side", "_right").schema.add("iou", "double").add("match", b.schema["_right"].dataType)
    found = dealt.mapInArrow(groups.by_groups(keys, solve), kept)
    columns = [F.col(c) if c in keys else F.col(known[c]).alias(c) if c in known else F.col("_left")[c].alias(c) for c in left.columns]
    return found.select(*columns, "iou", "match")


def _match(
    left: DataFrame, right: DataFrame, keys: list[str], box: BoxColumns, order: str, payload: list[str], min_iou: float, grid: Grid, fallback: bool
) -> DataFrame:
    """Groups of usual size are matched as a whole, crowds by runs; rows without a key match nothing."""
    first = F.struct(F.col(order).alias("_order"), *payload)
    crowded, total = groups.crowds([left, right], keys)
    if crowded is None:
        usual = _match_groups(left, right, keys, box, first, min_iou, fallback, total)
    else:
        usual = _match_groups(left.join(crowded, keys, "left_anti"), right.join(crowded, keys, "left_anti"), keys, box, first, min_iou, fallback, total)
    found = [usual]
    if crowded is not None:
        a, b = left.join(crowded, keys, "left_semi"), right.join(crowded, keys, "left_semi")
        dense = _match_by_runs(a, b, keys, box, order, payload, min_iou, grid)
        if fallback:
            one = b.groupBy(*keys).agg(F.min(first).alias("_first"))
            dense = dense.join(one, keys, "left").withColumn("match", F.coalesce("match", "_first"))
            dense = dense.withColumn("iou", F.when(F.col("match").isNotNull(), F.coalesce("iou", F.lit(0.0)))).drop("_first")
        found.append(dense)
    none = left.where(~groups.has_keys(keys))
    found.append(none.withColumn("iou", F.lit(None).cast("double")).withColumn("match", F.lit(None).cast(usual.schema["match"].dataType)))
    return reduce(DataFrame.unionByName, [f.select(*left.columns, "iou", "match") for f in found])


def _match_by_runs(left: DataFrame, right: DataFrame, keys: list[str], box: BoxColumns, order: str, payload: list[str], min_iou: float, grid: Grid) -> DataFrame:
    b = all_boxes(right, keys, box, F.struct(F.col(order).alias("_order"), *payload))
    a = all_boxes(left, keys, box, F.lit(None).cast(b.schema["first"].dataType))
    marked = runs_of(a, b, keys, grid)
    lefts, rights = marked.where("side = 0").drop("first"), marked.where("side = 1")
    pairs = _box_pairs(lefts, rights, _run_pairs(lefts, rights, keys, grid, min_iou, True), keys, min_iou)
    geometry = [f"a_{g}" for g in GEOMETRY]
    best = pairs.groupBy(*keys, *geometry).agg(F.min(F.struct((-F.col("iou")).alias("neg_iou"), F.col("b_first"))).alias("_best"))
    best = best.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *geometry, (-F.col("_best.neg_iou")).alias("iou"), F.col("_best.b_first").alias("match")
    ).where(F.col("iou") >= min_iou)
    on = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    on += [F.col(c).cast("double") == F.col(f"a_{g}") for c, g in zip(box.names(), GEOMETRY)]
    return left.join(best, on, "left").drop(*[f"_k{i}" for i in range(len(keys))], *geometry)


def best_match(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    box: BoxColumns = BoxColumns(),
    order: str = "ind_num",
    payload: list[str] = (),
    min_iou: float = 0.0,
    grid: Grid = Grid(),
) -> DataFrame:
    """Every left row with the overlapping right row of highest IoU.

    Adds ``iou`` and a struct ``match`` (``_order`` and the payload columns), both NULL where nothing
    overlaps with at least ``min_iou``. Equal IoU goes to the right row that comes first in ``order``.
    Rows without a key, without an area or with missing or NaN geometry overlap with nothing.
    """
    return _match(left, right, keys, box, order, list(payload), min_iou, grid, False)


def best_match_or_first(
    left: DataFrame, right: DataFrame, keys: list[str], box: BoxColumns = BoxColumns(), order: str = "ind_num", payload: list[str] = (), grid: Grid = Grid()
) -> DataFrame:
    """As ``best_match``, but a left row without any overlap is paired with the first right row of its scan.

    This is the argmax of the full IoU matrix: a row of zeros points at the first column.
    """
    return _match(left, right, keys, box, order, list(payload), 0.0, grid, True)


def false_calls(predicted: DataFrame, matched_reported: DataFrame, keys: list[str], order: str = "ind_num") -> DataFrame:
    """Predicted rows that no reported row points at."""
    hit = matched_reported.where(F.col("match").isNotNull()).select(*keys, F.col("match._order").alias(order))
    return predicted.join(hit, [*keys, order], "left_anti")
