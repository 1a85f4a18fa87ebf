"""Merging of overlapping boxes and flaws.

The outcome of these merges depends on the order in which pairs are met, but boxes influence one another only if
they overlap, directly or through others. Such sets are connected components of the overlap graph (``overlap_graph``);
each is handled by one small function, and no large image or scan is gathered in one task. Images and scans of usual size
are worked on as a whole after one shuffle (``groups``), which is what the sets stand for in a crowd.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import groups
from .matching import HAS_AREA, Grid, pairs_of, runs_of
from .overlap_graph import Corners, connected_sets, overlap_sets, settled, work_on_sets

Rows = dict[str, np.ndarray]
#: Which of the given rows join row ``i``.
Joins = Callable[[Rows, int, np.ndarray], np.ndarray]

#: Cells for boxes in pixels and for flaws in millimetres and degrees.
PIXELS, FLAWS = Grid(4096.0, 4096.0), Grid()


def _shared(rows: Rows, i: int, others: np.ndarray, axes: list[tuple[str, str]], extra: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common area (or length) of row ``i`` with others, its own and theirs; ``extra`` counts end pixels."""
    shared, own, theirs = np.ones(len(others)), np.ones(len(others)), np.ones(len(others))
    for lo, hi in axes:
        a, b = rows[lo], rows[hi]
        shared = shared * np.maximum(np.minimum(b[i], b[others]) - np.maximum(a[i], a[others]) + extra, 0.0)
        own, theirs = own * (b[i] - a[i] + extra), theirs * (b[others] - a[others] + extra)
    return shared, own, theirs


def _unite(axes: list[tuple[str, str]], joins: Joins, second_on_tie: bool) -> Callable[[Rows], np.ndarray]:
    """Work on a set: unite the first pair that joins until none does; the row with the higher confidence goes on with the united extent.

    Pairs wait in a heap in the order of their rows. A pair is looked at again when its turn comes, and a grown row brings its
    new partners, so the first joining pair is found without starting over.
    """

    def work(rows: Rows) -> np.ndarray:
        n = len(rows["conf"])
        conf, here = rows["conf"], np.ones(n, bool)
        waiting: list[tuple[int, int]] = []

        def meet(i: int, others: np.ndarray) -> None:
            for j in others[joins(rows, i, others)].tolist():
                heappush(waiting, (min(i, j), max(i, j)))

        for i in range(n - 1):
            meet(i, np.arange(i + 1, n))
        while waiting:
            i, j = heappop(waiting)
            if not (here[i] and here[j] and joins(rows, i, np.array([j]))[0]):
                continue
            keep, drop = (j, i) if conf[j] > conf[i] or (second_on_tie and conf[j] == conf[i]) else (i, j)
            for lo, hi in axes:
                rows[lo][keep], rows[hi][keep] = min(rows[lo][i], rows[lo][j]), max(rows[hi][i], rows[hi][j])
            here[drop] = False
            others = np.flatnonzero(here)
            meet(keep, others[others != keep])
        return np.flatnonzero(here)

    return work


#: Rows of a group up to which pairs of many groups are united side by side.
SMALL = 32


def _unite_groups(axes: list[tuple[str, str]], joins: Joins, second_on_tie: bool) -> groups.GroupWork:
    """As ``_unite`` for many groups: in each round every small group unites its first pair that joins."""
    one_by_one = groups.each(_unite(axes, joins, second_on_tie))

    def work(rows: Rows, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        small = ends - begins <= SMALL
        here = one_by_one(rows, begins[~small], ends[~small])
        if not small.any():
            return here
        conf, upto = rows["conf"], np.zeros(len(here), np.int64)
        sizes = (ends - begins)[small]
        places = np.repeat(begins[small] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        upto[places] = np.repeat(ends[small], sizes)
        i, j = (np.concatenate(side) for side in zip(*groups.pairs_between(np.arange(1, len(here) + 1), upto)))
        while len(i):
            at = np.flatnonzero(joins(rows, i, j))
            first = at[np.diff(upto[i[at]], prepend=-1) != 0]  # the first pair of each group
            a, b = i[first], j[first]
            second = (conf[b] > conf[a]) | (second_on_tie & (conf[b] == conf[a]))
            keep, drop = np.where(second, b, a), np.where(second, a, b)
            for lo, hi in axes:
                rows[lo][keep], rows[hi][keep] = np.minimum(rows[lo][a], rows[lo][b]), np.maximum(rows[hi][a], rows[hi][b])
            here[drop] = False
            open_ = np.zeros(len(here) + 1, bool)
            open_[upto[a]] = True
            go_on = open_[upto[i]] & here[i] & here[j]
            i, j = i[go_on], j[go_on]
        return here

    return work


def _by_groups(
    rows: DataFrame, keys: list[str], corners: Corners, order: list, used: list[str], changed: list[str], joins: groups.Pairs, work: groups.GroupWork,
    crowd: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Groups of usual size worked on as a whole, larger ones by ``crowd``; rows without a key or an area stay as they are."""
    x1, y1, x2, y2 = (c.cast("double") for c in corners)
    w, h = x2 - x1, y2 - y1
    known = groups.has_keys(keys) & (w > 0) & (h > 0) & ~(F.isnan(w) | F.isnan(h) | F.isnan(x1) | F.isnan(y1))
    boxes, flat = rows.where(known), rows.where(~F.coalesce(known, F.lit(False)))
    crowded, total = groups.crowds([boxes], keys)
    if crowded is None:
        return groups.work_on_groups(boxes, keys, order, used, changed, joins, work, total).unionByName(flat)
    usual, dense = (boxes.join(crowded, keys, how).select(*rows.columns) for how in ("left_anti", "left_semi"))
    return groups.work_on_groups(usual, keys, order, used, changed, joins, work, total).unionByName(crowd(dense).select(*rows.columns)).unionByName(flat)


def merge_frame_boxes(boxes: DataFrame, keys: list[str], threshold: float, same_class: bool) -> DataFrame:
    """Unite boxes of one frame whose 1-D IoU along x exceeds the threshold (columns x1, x2, cls, conf, box_id).

    United intervals cover nothing but their parts, so the sets found first stay apart.
    """
    axes = [("x1", "x2")]

    def joins(rows: Rows, i: int, others: np.ndarray) -> np.ndarray:
        shared, own, theirs = _shared(rows, i, others, axes)
        return (shared > 0) & (shared > threshold * (own + theirs - shared))

    group = [*keys, "cls"] if same_class else keys
    corners, used, changed = (F.col("x1"), F.lit(0.0), F.col("x2"), F.lit(1.0)), ["x1", "x2", "conf"], ["x1", "x2"]

    def crowd(rows: DataFrame) -> DataFrame:
        return work_on_sets(overlap_sets(rows, group, corners, PIXELS), "_set", "box_id", used, changed, _unite(axes, joins, False))

    return _by_groups(boxes, group, corners, ["box_id"], used, changed, joins, _unite_groups(axes, joins, False), crowd)


_SQUARE = [("x1", "x2"), ("y1", "y2")]


def _corners(extra: float = 0.0):
    return F.col("x1"), F.col("y1"), F.col("x2") + extra, F.col("y2") + extra


def merge_tile_boxes(boxes: DataFrame, keys: list[str], iou_limit: float, share_limit: float) -> DataFrame:
    """Unite boxes of one class that overlap across tiles (pixel corners x1, y1, x2, y2 that belong to the box).

    They join when their IoU or the share of either box that is covered reaches its limit; boxes of another class never do.
    """

    def joins(rows: Rows, i: int, others: np.ndarray) -> np.ndarray:
        shared, own, theirs = _shared(rows, i, others, _SQUARE, 1.0)
        return (shared / (own + theirs - shared) >= iou_limit) | (shared / np.minimum(own, theirs) >= share_limit)

    used, changed = ["x1", "y1", "x2", "y2", "conf"], ["x1", "y1", "x2", "y2"]
    group, corners = [*keys, "cls"], _corners(1.0)

    def crowd(rows: DataFrame) -> DataFrame:
        return settled(rows, group, corners, PIXELS, "box_id", used, changed, _unite(_SQUARE, joins, True))

    return _by_groups(boxes, group, corners, ["box_id"], used, changed, joins, _unite_groups(_SQUARE, joins, True), crowd)


def unite_v_and_mr(boxes: DataFrame, keys: list[str], threshold: float = 0.1) -> DataFrame:
    """Unite overlapping V and MR boxes of an image (by class name); other classes pass through."""

    def joins(rows: Rows, i: int, others: np.ndarray) -> np.ndarray:
        shared, own, theirs = _shared(rows, i, others, _SQUARE)
        area = own + theirs - shared
        return (area > 0) & (shared >= threshold * area) & (shared > 0)

    used, changed = ["x1", "y1", "x2", "y2", "conf"], ["x1", "y1", "x2", "y2"]
    both = F.col("cls").isin("V", "MR")

    def crowd(rows: DataFrame) -> DataFrame:
        return settled(rows, keys, _corners(), PIXELS, "box_id", used, changed, _unite(_SQUARE, joins, False))

    united = _by_groups(boxes.where(both), keys, _corners(), ["box_id"], used, changed, joins, _unite_groups(_SQUARE, joins, False), crowd)
    return united.unionByName(boxes.where(~F.coalesce(both, F.lit(False))))


#: Rounds in which boxes without a better rival are kept, before the rest is walked through in order.
ROUNDS = 8


def suppress_overlaps(boxes: DataFrame, keys: list[str], threshold: float, confidence: float, inclusive: bool = True, grid: Grid = PIXELS) -> DataFrame:
    """Non-maximum suppression within each class (columns x1, y1, x2, y2, cls, score, box_id).

    A box goes if a better one that stays overlaps it by more than the threshold; equal scores go by the larger id. Copies of
    one box leave the best copy, before boxes are compared; boxes without an area overlap nothing and stay. Only pairs above the threshold are formed. In each round the
    boxes that no open pair beats stay and remove what they beat, as joins; long chains of ever better boxes that are
    left after some rounds are walked through from the best box downwards, each connected set by itself.
    """
    group, extra = [*keys, "cls"], 1.0 if inclusive else 0.0

    def rivals(rows: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shared, areas, same = 1.0, [1.0, 1.0], True
        for lo, hi in _SQUARE:
            start, size = rows[lo], rows[hi] + extra - rows[lo]
            end = start + size
            shared = shared * np.maximum(np.minimum(end[i], end[j]) - np.maximum(start[i], start[j]), 0.0)
            areas = [areas[0] * size[i], areas[1] * size[j]]
            same = same & (start[i] == start[j]) & (size[i] == size[j])
        return same | (shared / (areas[0] + areas[1] - shared) > threshold)

    def work(rows: Rows, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        stays = np.ones(len(rows["x1"]), bool)
        found = [(i[hit], j[hit]) for i, j in groups.pairs_within(np.append(begins, ends[-1])) for hit in [rivals(rows, i, j)]]
        better, worse = (np.concatenate(side) for side in zip(*found))
        while len(better):
            beaten = np.zeros(len(stays), bool)
            beaten[worse] = True
            stays[worse[~beaten[better]]] = False
            open_ = stays[better] & stays[worse]
            better, worse = better[open_], worse[open_]
        return stays

    good = boxes.where(F.col("score") > confidence)
    order, used = [F.desc("score"), F.desc("box_id")], ["x1", "y1", "x2", "y2"]
    return _by_groups(good, group, _corners(extra), order, used, [], rivals, work, lambda rows: _suppress_by_runs(rows, group, threshold, extra, grid))


def _suppress_by_runs(good: DataFrame, group: list[str], threshold: float, extra: float, grid: Grid) -> DataFrame:
    x1, y1, x2, y2 = (c.cast("double") for c in _corners(extra))
    sized = good.select(*group, x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h"), F.struct(*good.columns).alias("first"))
    runs = runs_of(None, sized.where(HAS_AREA), group, grid, [F.desc("first.score"), F.desc("first.box_id")])
    a, b = (F.struct(f"{p}_first.score", f"{p}_first.box_id", F.col(f"{p}_place").alias("place")) for p in ("a", "b"))
    pairs = pairs_of(runs, group, grid, threshold).where(F.col("iou") > threshold).select(F.greatest(a, b).alias("p"), F.least(a, b).alias("q"))
    pairs = cut_lineage(pairs.selectExpr("p.place AS better", "p.score", "p.box_id", "q.place AS worse"), "rivals")
    gone: DataFrame | None = None
    for _ in range(ROUNDS):
        if pairs.isEmpty():
            break
        stay = pairs.select("better").join(pairs.select(F.col("worse").alias("better")), "better", "left_anti").distinct()
        beaten = cut_lineage(pairs.join(stay, "better", "left_semi").select("worse").distinct(), "beaten")
        gone = beaten if gone is None else gone.unionByName(beaten)
        pairs = cut_lineage(pairs.join(beaten, "worse", "left_anti").join(beaten.withColumnRenamed("worse", "better"), "better", "left_anti"), "rivals")
    else:
        if not pairs.isEmpty():
            gone = gone.unionByName(_beaten_in_order(pairs))
    kept = runs if gone is None else runs.join(gone, F.col("place") == F.col("worse"), "left_anti")
    flat = sized.where(f"NOT coalesce({HAS_AREA}, FALSE)").select("first.*")
    return kept.select("first.*").unionByName(flat)


def _beaten_in_order(pairs: DataFrame) -> DataFrame:
    """``worse`` of all pairs whose better box stays, pair by pair from the best box of a connected set downwards."""
    sets = connected_sets(pairs.select(F.col("better").alias("a"), F.col("worse").alias("b")))
    ordered = pairs.join(sets, F.col("better") == F.col("node")).select("set", "better", "score", "box_id", "worse")
    ordered = ordered.repartition("set").sortWithinPartitions("set", F.desc("score"), F.desc("box_id"), F.desc("better")).select("set", "better", "worse")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, gone = None, set()
        for batch in batches:
            out = []
            for number, better, worse in zip(*(column.to_pylist() for column in batch.columns)):
                if number != open_:
                    open_, gone = number, set()
                if better not in gone and worse not in gone:
                    gone.add(worse)
                    out.append(worse)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["worse"])

    return ordered.mapInArrow(run, "worse long")


NOTE_OVERLAPPED = "Note 1 - overlapped"


def unite_overlapping_flaws(flaws: DataFrame, keys: list[str], threshold: float = 0.5, grid: Grid = FLAWS) -> DataFrame:
    """Overlapping flaws become one with all their categories; the survivor has the higher confidence.

    Needs x_start, y_start, x_end, y_end, flaw_type, confidence, flaw_id and possible_category (array). Pairs with an IoU of
    at least ``threshold`` are taken in the order of their ids, as long as both flaws are there: the survivor (the later one
    on equal confidence) becomes a note and both get the categories and types of the pair, each once and in that order.
    """
    axes = [("x_start", "x_end"), ("y_start", "y_end")]

    def work(rows: Rows) -> np.ndarray:
        n = len(rows["confidence"])
        here = np.ones(n, bool)
        kinds, names = rows["flaw_type"], rows["possible_category"]
        for i in range(n - 1):
            later = np.arange(i + 1, n)
            shared, own, theirs = _shared(rows, i, later, axes)
            area = own + theirs - shared
            reached = (area > 0) & (shared / np.where(area > 0, area, 1.0) >= threshold)
            for j in later[reached].tolist():
                if here[i] and here[j]:
                    told = [*(names[i] or []), *(names[j] or []), kinds[i], kinds[j]]
                    names[i] = names[j] = list(dict.fromkeys(t for t in told if t != NOTE_OVERLAPPED))
                    stays, goes = (i, j) if rows["confidence"][i] > rows["confidence"][j] else (j, i)
                    kinds[stays], here[goes] = NOTE_OVERLAPPED, False
        return np.flatnonzero(here)

    corners = tuple(F.col(c) for c in ("x_start", "y_start", "x_end", "y_end"))
    listed = flaws.withColumn("possible_category", F.coalesce("possible_category", F.array().cast("array<string>")))
    used, changed = ["x_start", "y_start", "x_end", "y_end", "flaw_type", "confidence", "possible_category"], ["flaw_type", "possible_category"]

    def joins(rows: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shared, own, theirs = _shared(rows, i, j, axes)
        return shared >= threshold * (1 - 1e-9) * (own + theirs - shared)

    def crowd(rows: DataFrame) -> DataFrame:
        return work_on_sets(overlap_sets(rows, keys, corners, grid, threshold * (1 - 1e-9)), "_set", "flaw_id", used, changed, work)

    return _by_groups(listed, keys, corners, ["flaw_id"], used, changed, joins, groups.each(work), crowd)


def representative_levels(boxes: DataFrame, keys: list[str], reach: int = 5, ends: int = 3) -> DataFrame:
    """Group boxes of about the same height and keep the leftmost of each group.

    Needs middle_y, first_y, last_y, left_x and box_id. A box joins the first group, in order of
    middle_y, whose members all lie within ``reach`` of it and whose first and last rows differ by at
    most ``ends``. Boxes that may share a group overlap when middle and first row are given those widths.
    """
    limits = {"middle_y": reach, "first_y": ends, "last_y": ends}

    def work(rows: Rows) -> np.ndarray:
        values = np.stack([rows[c].astype(float) for c in limits], axis=1)
        wide = np.array(list(limits.values()), float)
        low, high = np.zeros((0, 3)), np.zeros((0, 3))
        leftmost: list[int] = []
        for at in np.argsort(rows["middle_y"], kind="stable").tolist():
            own = values[at]
            near = np.flatnonzero(((own - low <= wide) & (high - own <= wide)).all(axis=1))
            if len(near):
                g = int(near[0])
                low[g], high[g] = np.minimum(low[g], own), np.maximum(high[g], own)
                if rows["left_x"][at] < rows["left_x"][leftmost[g]]:
                    leftmost[g] = at
            else:
                low, high = np.vstack([low, own]), np.vstack([high, own])
                leftmost.append(at)
        return np.array(leftmost, np.int64)

    middle, first = F.col("middle_y").cast("double"), F.col("first_y").cast("double")
    corners, used = (middle, first, middle + (reach + 0.5), first + (ends + 0.5)), ["middle_y", "first_y", "last_y", "left_x"]

    def joins(rows: Rows, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.all([np.abs(rows[c][i] - rows[c][j]) <= limit for c, limit in limits.items()], axis=0)

    def crowd(rows: DataFrame) -> DataFrame:
        return work_on_sets(overlap_sets(rows, keys, corners, PIXELS), "_set", "box_id", used, [], work)

    return _by_groups(boxes, keys, corners, ["box_id"], used, [], joins, groups.each(work), crowd)


def merge_across_zero(flaws: DataFrame, keys: list[str], axial_tol: float, rotary_tol: float) -> DataFrame:
    """Unite flaws that were split where the rotary angle wraps from 360 to 0.

    Two flaws of one type belong together when one starts at 0, the other ends at 360 and their axial
    starts and ends agree within a tolerance. Only scans with a scrape at the boundary are looked at.
    Partners are mutual: each is the first possible partner of the other. The deeper one survives, on
    equal or missing depth the one at 0; extent is united and confidence averaged.
    """
    known = groups.has_keys(keys)
    crowded, total = groups.crowds([flaws], keys)
    usual = flaws if crowded is None else flaws.join(crowded, keys, "left_anti").select(*flaws.columns)
    found = _across_zero_in_groups(usual.where(known), keys, axial_tol, rotary_tol, total)
    if crowded is not None:
        found = found.unionByName(_across_zero_by_joins(flaws.join(crowded, keys, "left_semi").select(*flaws.columns), keys, axial_tol, rotary_tol))
    return found.unionByName(flaws.where(~known).withColumn("merged_id", F.lit(None).cast(flaws.schema["ind_num"].dataType)))


#: Columns that change where flaws are united across 0 degrees.
UNITED = ["axial_start", "length", "rotary_start", "width", "confidence"]


def _firsts(values: list[np.ndarray], rows: np.ndarray) -> np.ndarray:
    """The first of the given rows for each combination of values."""
    ranked = rows[np.lexsort([v[rows] for v in values][::-1])]
    new = np.append(True, np.any([v[ranked][1:] != v[ranked][:-1] for v in values], axis=0))
    return np.sort(ranked[new[: len(ranked)]])


def _across_zero_in_groups(flaws: DataFrame, keys: list[str], axial_tol: float, rotary_tol: float, total: int) -> DataFrame:
    """Scans of usual size, each of which is in one task after a single shuffle, ordered by ``ind_num``."""
    start_zero = F.col("rotary_start") <= rotary_tol
    end = F.col("rotary_start") + F.col("width")
    told = {"_zero": start_zero, "_full": F.abs(end - 360) <= rotary_tol, "_scrape": (start_zero | (end >= 360 - rotary_tol)) & F.contains("flaw_type", F.lit("Scrape"))}
    flagged = flaws.withColumns({c: F.col(c).cast("double") for c in UNITED}).withColumns({c: F.coalesce(v, F.lit(False)) for c, v in told.items()})
    dealt = groups.gathered(flagged, keys, ["ind_num"], total)
    flags = list(told)
    schema = dealt.drop(*flags).schema.add("merged_id", flaws.schema["ind_num"].dataType)

    def solve(table: pa.Table, at: np.ndarray) -> pa.Table:
        n, sizes = table.num_rows, np.diff(at)
        group = np.repeat(np.arange(len(sizes)), sizes)
        zero, full, scrape = (table.column(c).to_numpy() for c in flags)
        ids, kinds = table.column("ind_num").combine_chunks(), table.column("flaw_type").combine_chunks()
        kind = pc.fill_null(pc.dictionary_encode(kinds).indices, -1).to_numpy(zero_copy_only=False)
        values = groups.numbers(table, [*UNITED, "depth"])
        missing = {c: table.column(c).is_null().to_numpy() for c in values}
        axial_end = values["axial_start"] + values["length"]
        # flaws of one id are side by side: number of the id, and the rows it covers
        new = np.append(True, pc.fill_null(pc.not_equal(ids.slice(1), ids.slice(0, n - 1)), True).to_numpy(zero_copy_only=False) | (np.diff(group) != 0))
        number, starts = np.cumsum(new) - 1, np.append(np.flatnonzero(new), n)
        able = np.logical_or.reduceat(scrape, at[:-1])[group] & (kind >= 0) & ids.is_valid().to_numpy(zero_copy_only=False)
        extent = [group, kind, values["axial_start"], axial_end]
        ends = [np.zeros(n, bool), np.zeros(n, bool)]
        for mark, side in zip(ends, (zero, full)):
            mark[_firsts(extent, np.flatnonzero(able & side))] = True
        pairs = []
        for i, j in groups.pairs_between(np.where(ends[0], at[:-1][group], n), np.where(ends[0], at[1:][group], 0)):
            near = ends[1][j] & (kind[i] == kind[j]) & (number[i] != number[j])
            i, j = i[near], j[near]
            near = (np.abs(extent[2][i] - extent[2][j]) <= axial_tol) & (np.abs(axial_end[i] - axial_end[j]) <= axial_tol)
            pairs.append((kind[i[near]], number[i[near]], number[j[near]]))
        k, a, b = (np.concatenate(part) for part in zip(*pairs))
        mutual = np.ones(len(k), bool)
        for own, other in ((a, b), (b, a)):
            _, place = np.unique(np.stack([k, own]), axis=1, return_inverse=True)
            first = np.full(len(k), n)
            np.minimum.at(first, place.reshape(-1), other)
            mutual &= other == first[place.reshape(-1)]
        a, b = np.unique(np.stack([k, a, b])[:, mutual], axis=1)[1:]
        # every flaw of one id with every flaw of the other
        many = (starts[a + 1] - starts[a]) * (starts[b + 1] - starts[b])
        pair = np.repeat(np.arange(len(a)), many)
        step = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        a, b = a[pair], b[pair]
        x, y = starts[a] + step // (starts[b + 1] - starts[b]), starts[b] + step % (starts[b + 1] - starts[b])
        depth, unknown = values["depth"], missing["depth"]
        deeper = (depth[y] > depth[x]) | (np.isnan(depth[y]) & ~np.isnan(depth[x]))
        b_wins = np.where(unknown[x] | unknown[y], unknown[x] & ~unknown[y], deeper)
        wins, loses = np.where(b_wins, b, a), np.where(b_wins, a, b)
        by_winner = np.argsort(wins, kind="stable")
        x, y, wins, loses = x[by_winner], y[by_winner], wins[by_winner], loses[by_winner]
        start, rotary, width, confidence = (values[c] for c in ("axial_start", "rotary_start", "width", "confidence"))
        least = np.fmin(start[x], start[y])
        united = {
            "axial_start": least, "length": np.fmax(axial_end[x], axial_end[y]) - least, "rotary_start": rotary[y],
            "width": 360 - rotary[y] + rotary[x] + width[x], "confidence": (confidence[x] + confidence[y]) / 2,
        }
        known = {c: np.ones(len(x), bool) for c in UNITED}
        known["confidence"] = ~(missing["confidence"][x] | missing["confidence"][y])
        known["rotary_start"] = ~missing["rotary_start"][y]
        known["width"] = known["rotary_start"] & ~(missing["rotary_start"][x] | missing["width"][x])
        kept = np.flatnonzero(~np.isin(number, loses))
        low, high = np.searchsorted(wins, number[kept]), np.searchsorted(wins, number[kept], side="right")
        times = np.maximum(high - low, 1)
        rows = np.repeat(kept, times)
        place = np.repeat(low, times) + np.arange(len(rows)) - np.repeat(np.cumsum(times) - times, times)
        changed = np.repeat(high > low, times)
        place = np.where(changed, place, 0)
        out = table.take(pa.array(rows)).drop_columns(flags)
        for c in UNITED if len(x) else []:
            new_one = changed & known[c][place]
            column = pa.array(np.where(new_one, united[c][place], values[c][rows]), pa.float64(), mask=missing[c][rows] & ~new_one)
            out = out.set_column(out.schema.get_field_index(c), out.schema.field(c), column)
        loser = starts[loses][place] if len(x) else np.zeros(len(rows), np.int64)
        return out.append_column("merged_id", ids.take(pa.array(loser, mask=~changed)))

    return dealt.mapInArrow(groups.by_groups(keys, solve), schema)


def _across_zero_by_joins(flaws: DataFrame, keys: list[str], axial_tol: float, rotary_tol: float) -> DataFrame:
    """Scans of any size: extents at both ends meet in cells along the axis."""
    start_zero = F.col("rotary_start") <= rotary_tol
    end_full = F.col("rotary_start") + F.col("width") >= 360 - rotary_tol
    scrapes = flaws.where((start_zero | end_full) & F.contains("flaw_type", F.lit("Scrape"))).select(*keys).distinct()
    at_edge = flaws.join(scrapes, keys, "left_semi").withColumn("axial_end", F.col("axial_start") + F.col("length"))
    on = [*keys, "flaw_type"]

    def side(condition, prefix: str) -> DataFrame:
        """Distinct axial extents at one side with their first flaw."""
        return at_edge.where(condition).groupBy(*on, F.col("axial_start").alias(f"{prefix}_s"), F.col("axial_end").alias(f"{prefix}_e")).agg(
            F.min("ind_num").alias(f"{prefix}_ind")
        )

    a = side(start_zero, "a").withColumn("_cell", F.floor(F.col("a_s") / axial_tol))
    b = side(F.abs(F.col("rotary_start") + F.col("width") - 360) <= rotary_tol, "b")
    b = b.withColumn("_cell", F.explode(F.sequence(F.floor((F.col("b_s") - axial_tol) / axial_tol), F.floor((F.col("b_s") + axial_tol) / axial_tol))))
    close = (F.abs(F.col("a_s") - F.col("b_s")) <= axial_tol) & (F.abs(F.col("a_e") - F.col("b_e")) <= axial_tol)
    pairs = a.join(b, [*on, "_cell"]).where(close & (F.col("a_ind") != F.col("b_ind"))).select(*on, "a_ind", "b_ind")
    first_b = pairs.groupBy(*on, "a_ind").agg(F.min("b_ind").alias("b_ind"))
    first_a = pairs.groupBy(*on, "b_ind").agg(F.min("a_ind").alias("a_ind"))
    mutual = first_b.join(first_a, [*on, "a_ind", "b_ind"])

    facts = ["depth", "axial_start", "axial_end", "rotary_start", "width", "confidence"]
    rows = flaws.withColumn("axial_end", F.col("axial_start") + F.col("length"))
    left = rows.select(*keys, F.col("ind_num").alias("a_ind"), F.struct(*facts).alias("a"))
    right = rows.select(*keys, F.col("ind_num").alias("b_ind"), F.struct(*facts).alias("b"))
    both = mutual.join(left, [*keys, "a_ind"]).join(right, [*keys, "b_ind"])
    b_wins = F.coalesce(F.col("b.depth") > F.col("a.depth"), F.col("a.depth").isNull() & F.col("b.depth").isNotNull())
    start, end = F.least("a.axial_start", "b.axial_start"), F.greatest("a.axial_end", "b.axial_end")
    merged = both.select(
        *keys,
        F.when(b_wins, F.col("b_ind")).otherwise(F.col("a_ind")).alias("ind_num"),
        F.when(b_wins, F.col("a_ind")).otherwise(F.col("b_ind")).alias("merged_id"),
        F.struct(
            start.alias("axial_start"), (end - start).alias("length"), F.col("b.rotary_start").alias("rotary_start"),
            (360 - F.col("b.rotary_start") + F.col("a.rotary_start") + F.col("a.width")).alias("width"),
            ((F.col("a.confidence") + F.col("b.confidence")) / 2).alias("confidence"),
        ).alias("_m"),
    )
    kept = flaws.join(merged.select(*keys, F.col("merged_id").alias("ind_num")), [*keys, "ind_num"], "left_anti")
    joined = kept.join(merged, [*keys, "ind_num"], "left")
    return joined.select(
        *[F.coalesce(F.col(f"_m.{c}"), F.col(c)).alias(c) if c in UNITED else F.col(c) for c in flaws.columns], "merged_id"
    )


def usable_detections(boxes: DataFrame, confidence: float = 0.10, spaghetti: float = 0.5, shift: int = 10) -> DataFrame:
    """Detections worth measuring: confident enough for their class, 'default' boxes moved to the right."""
    enough = (F.col("conf") >= confidence) & ~((F.lower("cls") == "spaghetti") & (F.col("conf") < spaghetti))
    return boxes.where(enough).withColumn("x1", F.when(F.col("cls") == "default", F.col("x1") + shift).otherwise(F.col("x1")))


def measured_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Measured position per box by class, from its rows (y, max_x, max_value) and extent (x1, x2).

    V: the middle row, moved to the left quarter when it lies in the right half. MR: mean of the middle
    half of the rows. Spaghetti: largest position not above its upper fence. Others: largest position.
    A box has at most as many rows as its image, so its rows fit one array.
    """
    lines = F.sort_array(F.collect_list(F.struct("y", "max_x", "max_value")))
    per = rows.groupBy(*keys, "box_id", "cls", "x1", "x2").agg(lines.alias("r"))
    n = F.size("r")
    mid = F.get("r", F.floor(n / 2).cast("int"))
    quarter = F.floor(n / 4).cast("int")
    middle = F.slice("r", quarter + 1, n - 2 * quarter)
    mean = F.aggregate(middle, F.lit(0.0), lambda acc, e: acc + e["max_x"]) / F.size(middle)
    closest = F.array_min(F.transform(middle, lambda e: F.struct(F.abs(e["max_x"] - mean).alias("d"), e["y"].alias("y"))))["y"]
    ordered_x = F.array_sort(F.transform("r", lambda e: e["max_x"]))
    q1, q3 = F.get(ordered_x, quarter), F.get(ordered_x, F.floor(3 * n / 4).cast("int"))
    below = F.filter("r", lambda e: e["max_x"] <= q3 + (q3 - q1))

    def largest(values):
        best = F.array_max(F.transform(values, lambda e: F.struct(e["max_x"].alias("x"), (-e["y"]).alias("neg"))))
        return F.struct(best["x"].cast("double").alias("x"), (-best["neg"]).alias("y"))

    width = F.col("x2") - F.col("x1")
    v_x = F.when(mid["max_x"] > F.col("x1") + width / 2, F.col("x1") + width / 4).otherwise(mid["max_x"].cast("double"))
    place = (
        F.when(F.col("cls") == "V", F.struct(v_x.alias("x"), mid["y"].alias("y")))
        .when(F.col("cls") == "MR", F.struct(mean.alias("x"), closest.alias("y")))
        .when(F.col("cls") == "Spaghetti", largest(below))
        .otherwise(largest(F.col("r")))
    )
    return per.withColumn("p", place).select(*keys, "box_id", "cls", F.col("p.x").alias("x"), F.col("p.y").alias("y"), n.alias("n_rows"))


def deepest_box(measured: DataFrame, keys: list[str]) -> DataFrame:
    """The box of each image whose measured position lies farthest; the first one on equal positions."""
    rank = F.struct((-F.col("x")).alias("neg"), F.col("box_id"))
    best = measured.groupBy(*keys).agg(F.min_by(F.struct("box_id", "cls", "x", "y"), rank).alias("b"), F.count(F.lit(1)).alias("total_bboxes"))
    return best.select(*keys, "b.*", "total_bboxes")


def box_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Width, height, area, longer side and mean row maximum of each box."""
    return rows.groupBy(*keys, "box_id", "cls", "x1", "x2").agg(
        (F.max("y") - F.min("y") + 1).alias("height"), F.avg("max_value").alias("avg_value"), F.count(F.lit(1)).alias("n_rows")
    ).withColumn("width", F.abs(F.col("x2") - F.col("x1"))).withColumn("area", F.col("width") * F.col("height")).withColumn(
        "length", F.greatest("width", "height")
    )


def class_counts(boxes: DataFrame, keys: list[str]) -> DataFrame:
    """Boxes per class of each image as a map (the number of classes is small)."""
    counts = boxes.groupBy(*keys, "cls").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return counts.groupBy(*keys).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("cls", "n")))).alias("counts"))


def tiles(images: DataFrame, keys: list[str], height: str, width: str, size: int, step: int) -> DataFrame:
    """Origins of overlapping square tiles that cover each image.

    Tiles start at multiples of ``step``; a last one is flush with the edge. An image shorter than a tile
    has one tile along that side, which ends with the image.
    """

    def origins(extent: str):
        last = F.greatest(F.col(extent) - size, F.lit(0))
        return F.array_union(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"), F.lit(step).cast("bigint")), F.array(last.cast("bigint")))

    grid = images.select(*keys, F.explode(origins(height)).alias("tile_y"), origins(width).alias("_x"))
    return grid.select(*keys, "tile_y", F.explode("_x").alias("tile_x"))


def tile_origins(start: str, end: str, last: str, size: int, step: int):
    """Origins of the tiles that hold a part of an extent along one side; ``last`` is the largest origin of the image."""
    first = F.greatest(F.floor((F.col(start) - size) / step) + 1, F.lit(0)) * step
    final = F.least(F.floor(F.col(end) / step) * step, F.floor(F.col(last) / step) * step)
    none = F.array().cast("array<bigint>")
    inner = F.when(final >= first, F.sequence(first, final, F.lit(step).cast("bigint"))).otherwise(none)
    flush = F.when((F.col(end) >= F.col(last)) & (F.col(start) < F.col(last) + size), F.array(F.col(last).cast("bigint"))).otherwise(none)
    return F.array_union(inner, flush)


def boxes_on_tiles(boxes: DataFrame, keys: list[str], size: int, step: int) -> DataFrame:
    """Boxes cut to every tile they touch and moved to tile coordinates.

    Tiles start at multiples of ``step``, so the tiles of a box are computed, not searched. ``last_x``
    and ``last_y`` are the largest tile origins of the image (0 for an image shorter than a tile); the
    tile there is flush with the edge.
    """

    spread = boxes.withColumn("tile_y", F.explode(tile_origins("y1", "y2", "last_y", size, step))).withColumn(
        "tile_x", F.explode(tile_origins("x1", "x2", "last_x", size, step))
    )
    cut = {
        "tx1": F.greatest(F.col("x1") - F.col("tile_x"), F.lit(0)), "tx2": F.least(F.col("x2") - F.col("tile_x"), F.lit(size)),
        "ty1": F.greatest(F.col("y1") - F.col("tile_y"), F.lit(0)), "ty2": F.least(F.col("y2") - F.col("tile_y"), F.lit(size)),
    }
    return spread.withColumns(cut).where("tx2 > tx1 AND ty2 > ty1").select(*keys, "box_id", "tile_x", "tile_y", *cut)
