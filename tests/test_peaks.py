"""Peaks by height, distance, prominence and width against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tubewave.operators.peaks import FIELDS, PeakRule, batch_peaks, choose_peak, sample_peaks


def peaks_by_hand(x, rule):
    found = []
    i = 1
    while i < len(x) - 1:
        j = i
        while j + 1 < len(x) and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j + 1 < len(x) and x[j + 1] < x[i] and (rule.height is None or x[i] >= rule.height):
            found.append((i + j) // 2)
        i = j + 1
    if rule.distance is not None:
        kept = []
        for p in sorted(found, key=lambda p: (x[p], p), reverse=True):
            if all(abs(p - q) >= rule.distance for q in kept):
                kept.append(p)
        found = sorted(kept)
    out = []
    for p in found:
        left = right = p
        ends = []
        for step in (-1, 1):
            at, base = p, p
            while 0 <= at + step < len(x) and x[at + step] <= x[p]:
                at += step
                base = at if x[at] < x[base] else base
            ends.append(base)
        prominence = x[p] - max(x[ends[0]], x[ends[1]])
        level = x[p] - prominence / 2
        while left > ends[0] and x[left] > level:
            left -= 1
        while right < ends[1] and x[right] > level:
            right += 1
        l = left + (level - x[left]) / (x[left + 1] - x[left]) if x[left] < level else left
        r = right - (level - x[right]) / (x[right - 1] - x[right]) if x[right] < level else right
        if (rule.prominence is None or prominence >= rule.prominence) and (rule.width is None or round(r - l, 9) >= rule.width):
            out.append((p, x[p], prominence, round(r - l, 9), *ends))
    return out


RULES = [PeakRule(), PeakRule(height=4), PeakRule(distance=5), PeakRule(prominence=3), PeakRule(width=2.0), PeakRule(3, 4, 2, 1.1), PeakRule(distance=1), PeakRule(distance=100)]


@pytest.mark.parametrize("rule", RULES)
def test_peaks_of_batches(rule):
    rng = np.random.default_rng(8)
    rows = [rng.integers(0, rng.integers(2, 9), n).astype(float) for n in [0, 1, 2, 3, *rng.integers(3, 60, 200)]]
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
    row, found = batch_peaks(np.concatenate(rows), offsets, rule)
    got = [[] for _ in rows]
    for k, *values in zip(row.tolist(), *(found[f].tolist() for f in FIELDS)):
        got[k].append(tuple(values))
    for own, x in zip(got, rows):
        np.testing.assert_allclose(np.array(own).reshape(-1, 6), np.array(peaks_by_hand(x, rule)).reshape(-1, 6))


def test_peaks_of_odd_arrays(spark):
    rows = [(1, [0, 5, 0, 9, 0, 7, 7, 0]), (2, None), (3, []), (4, [3]), (5, [0, None, 4, 1])]
    df = spark.createDataFrame(rows, "id int, samples array<int>")
    found = sample_peaks(df, ["id"], PeakRule(height=1))
    got = {r.id: [(p.place, p.height) for p in r.peaks] for r in found.collect()}
    assert got == {1: [(1, 5.0), (3, 9.0), (5, 7.0)], 2: [], 3: [], 4: [], 5: [(2, 4.0)]}
    one = found.select("id", *[choose_peak(F.col("peaks"), c, b)["place"].alias(n) for n, c, b in (("f", "first", None), ("l", "last", None), ("h", "highest", None), ("b", "highest", F.lit(3)))])
    assert {(r.f, r.l, r.h, r.b) for r in one.where("id < 3").collect()} == {(1, 5, 3, 1), (None, None, None, None)}
