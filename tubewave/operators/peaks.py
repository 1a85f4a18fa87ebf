"""Peaks of sample arrays by height, distance, prominence and width, for whole batches of A-scans at once."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PeakRule:
    """What a peak has to have, looked at in this order; NULL asks for nothing."""

    height: float | None = None
    #: Least distance in samples; of nearer peaks the highest stays, of equal ones the later.
    distance: int | None = None
    prominence: float | None = None
    #: Least width at half the prominence.
    width: float | None = None


def _summits(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Middle of every run of equal values that is higher than the runs before and behind it in its row."""
    starts = np.flatnonzero(np.concatenate(([True], (values[1:] != values[:-1]) | (row[1:] != row[:-1]))))
    ends = np.concatenate((starts[1:], [len(values)])) - 1
    own, of = values[starts], row[starts]
    rises = np.zeros(len(starts), bool)
    rises[1:] = (of[1:] == of[:-1]) & (own[1:] > own[:-1])
    falls = np.zeros(len(starts), bool)
    falls[:-1] = (of[:-1] == of[1:]) & (own[:-1] > own[1:])
    top = rises & falls
    return (starts[top] + ends[top]) // 2


def _apart(place: np.ndarray, height: np.ndarray, row: np.ndarray, distance: int) -> np.ndarray:
    """Which peaks stay when, from the highest down, each removes those nearer than ``distance``.

    In rounds: a peak that no open nearer peak beats stays and removes its neighbours. Peaks are two samples apart at
    least, so half the distance is the number of neighbours to look at.
    """
    n = len(place)
    open_, stays = np.ones(n, bool), np.zeros(n, bool)
    pairs = []
    for k in range(1, (distance + 1) // 2 + 1):
        if k < n:
            near = np.flatnonzero((row[k:] == row[:-k]) & (place[k:] - place[:-k] < distance))
            pairs.append((near, near + k))
    if not pairs:
        return open_
    left, right = (np.concatenate(side) for side in zip(*pairs))
    first_wins = height[left] > height[right]
    better, worse = np.where(first_wins, left, right), np.where(first_wins, right, left)
    while open_.any():
        beaten = np.zeros(n, bool)
        beaten[worse[open_[better] & open_[worse]]] = True
        won = open_ & ~beaten
        stays |= won
        open_ &= ~won
        for a, b in ((left, right), (right, left)):
            open_[b[won[a]]] = False
    return stays


def _side(values: np.ndarray, bounds: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest value, and its place, on the way from each peak to the next higher value or the end of its row."""
    top = values[place]
    low, base, at = top.copy(), place.copy(), place.copy()
    active = np.arange(len(place))
    while active.size:
        at[active] += step
        active = active[(at[active] >= bounds[active, 0]) & (at[active] < bounds[active, 1])]
        here = values[at[active]]
        active, here = active[here <= top[active]], here[here <= top[active]]
        lower = here < low[active]
        low[active[lower]], base[active[lower]] = here[lower], at[active[lower]]
    return low, base


def _crossing(values: np.ndarray, place: np.ndarray, stop: np.ndarray, level: np.ndarray, step: int) -> np.ndarray:
    """Where the signal falls to ``level`` between each peak and ``stop``, interpolated between two samples."""
    at = place.copy()
    active = np.arange(len(place))
    while active.size:
        active = active[(at[active] != stop[active]) & (values[at[active]] > level[active])]
        at[active] += step
    below = values[at] < level
    inner = np.where(below, at - step, at)
    rise = np.where(below, values[inner] - values[at], 1.0)
    return at - step * np.where(below, (level - values[at]) / rise, 0.0)


FIELDS = ["place", "height", "prominence", "width", "left_base", "right_base"]


def batch_peaks(values: np.ndarray, offsets: np.ndarray, rule: PeakRule) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row and properties of all peaks of the arrays that ``offsets`` cut from ``values``; places count from the start of the array."""
    values = values.astype(float)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = _summits(values, row) if len(values) else np.zeros(0, np.int64)
    if rule.height is not None:
        at = at[values[at] >= rule.height]
    if rule.distance is not None:
        at = at[_apart(at, values[at], row[at], rule.distance)]
    bounds = np.stack([offsets[row[at]], offsets[row[at] + 1]], axis=1)
    (left, left_base), (right, right_base) = (_side(values, bounds, at, step) for step in (-1, 1))
    prominence = values[at] - np.maximum(left, right)
    good = np.ones(len(at), bool) if rule.prominence is None else prominence >= rule.prominence
    level = values[at] - prominence / 2
    # to nine digits, so that a width that equals the limit is not lost to rounding
    width = np.round(_crossing(values, at, right_base, level, 1) - _crossing(values, at, left_base, level, -1), 9)
    if rule.width is not None:
        good &= width >= rule.width
    start = bounds[:, 0]
    found = [at - start, values[at], prominence, width, left_base - start, right_base - start]
    return row[at][good], {name: column[good] for name, column in zip(FIELDS, found)}


def sample_peaks(ascans: DataFrame, keep: list[str], rule: PeakRule, samples: str = "samples") -> DataFrame:
    """Columns ``keep`` and ``peaks``, an array of peaks from left to right, of every A-scan; no row leaves its task.

    A missing or empty array has no peaks; missing samples count as 0.
    """
    kinds = {"place": pa.int32(), "left_base": pa.int32(), "right_base": pa.int32()}
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ascans.select(*keep).schema.fields)
    peak = "struct<place: int, height: double, prominence: double, width: double, left_base: int, right_base: int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keep))
            sizes = [len(v) if v.is_valid else 0 for v in lists] if lists.null_count else np.diff(lists.offsets.to_numpy())
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
            values = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            row, found = batch_peaks(np.nan_to_num(values, nan=0.0), offsets, rule)
            structs = pa.StructArray.from_arrays([pa.array(found[f]).cast(kinds.get(f, pa.float64())) for f in FIELDS], FIELDS)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.ListArray.from_arrays(pa.array(edges), structs)], [*keep, "peaks"])

    return ascans.select(*keep, samples).mapInArrow(run, f"{own}, peaks array<{peak}>")


def choose_peak(peaks: Column, choice: str, before: Column | None = None) -> Column:
    """One peak of an array: the ``highest`` (first of equal ones), the ``first`` or the ``last``; only those left of ``before`` if given."""
    asked = F.filter(peaks, lambda p: p["place"] < before) if before is not None else peaks
    if choice == "highest":
        best = F.array_max(F.transform(asked, lambda p: F.struct(p["height"].alias("height"), (-p["place"]).alias("at"), p.alias("peak"))))
        return best["peak"]
    return F.get(asked, F.lit(0) if choice == "first" else F.size(asked) - 1)
