"""Groups of usual size take one shuffle; crowds beside them take another way to the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tubewave.operators import groups, matching, merging

SCHEMA = "scan_id long, ind_num string, rotary_start double, axial_start double, width double, length double"


def shuffles(df):
    return sum(line.split("(")[0].split()[-1].startswith("Exchange") for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line)


def flaws(spark, seed, n=160):
    """Scans of many sizes with copies, boxes without an area, missing and NaN geometry and rows without a scan."""
    rng = np.random.default_rng(seed)
    rows = [
        (int(rng.integers(0, 5) ** 2 // 2), f"{k:03d}", *(float(v) / 2 for v in rng.integers(0, 30, 2)), *(float(v) / 2 for v in rng.integers(1, 12, 2))) for k in range(n)
    ]
    rows += [(0, f"c{k}", 5.0, 5.0, 4.0, 3.0) for k in range(20)]
    rows += [(1, "flat", 1.0, 1.0, 0.0, 2.0), (1, "a null", 1.0, None, 5.0, 2.0), (1, "nan", 1.0, 1.0, float("nan"), 2.0), (None, "none", 5.0, 5.0, 4.0, 3.0), (77 + seed, "alone", 5.0, 5.0, 4.0, 3.0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("fallback", [False, True])
@pytest.mark.parametrize("together, pairs", [(16_384, 500_000), (7, 5)])
def test_usual_groups_and_crowds_are_matched_alike(spark, monkeypatch, fallback, together, pairs):
    left, right = flaws(spark, 1), flaws(spark, 2)
    monkeypatch.setattr(groups, "TOGETHER", together)
    monkeypatch.setattr(groups, "PAIRS", pairs)
    fn = matching.best_match_or_first if fallback else matching.best_match
    found = []
    for crowd in (10_000, 60, 0):
        monkeypatch.setattr(groups, "CROWD", crowd)
        rows = fn(left, right, ["scan_id"], payload=["width"], **({} if fallback else {"min_iou": 0.2})).collect()
        found.append(sorted((str(r.scan_id), r.ind_num, str(r.axial_start), r.match and tuple(r.match), r.iou and round(r.iou, 12)) for r in rows))
    assert len(found[0]) == left.count()
    assert found[0] == found[1] == found[2]


def test_a_match_of_usual_scans_takes_one_shuffle(spark):
    left, right = flaws(spark, 1), flaws(spark, 2)
    assert shuffles(matching.best_match(left.coalesce(1), right.coalesce(1), ["scan_id"])) <= 3  # two of them deal the rows of the test


def boxes(spark, seed, n=150):
    """Images of many sizes, some crowded and one with a class only, copies, equal confidences, boxes without an area or an image."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({
        "image_id": rng.choice([0, 0, 0, 1, 1, 2, 3, 4, 5, 6], n), "box_id": [f"{k:04d}" for k in rng.permutation(n)], "cls": rng.choice(["V", "MR", "Spaghetti"], n),
        "conf": rng.integers(0, 10, n) / 10, "x1": rng.integers(0, 200, n) * 1.0, "y1": rng.integers(0, 90, n) * 1.0,
    })
    pdf["x2"], pdf["y2"] = pdf["x1"] + rng.integers(0, 40, n), pdf["y1"] + rng.integers(1, 25, n)
    pdf.loc[rng.random(n) < 0.1, ["image_id", "x1", "y1", "x2", "y2"]] = [0, 10.0, 10.0, 30.0, 30.0]
    df = spark.createDataFrame(pdf.astype({"image_id": "int64"}))
    return df.withColumn("image_id", F.when(F.col("box_id") > "0003", F.col("image_id"))).withColumn("x1", F.when(F.col("box_id") != "0007", F.col("x1"))).repartition(3)


def levels(df):
    named = df.select("image_id", "box_id", F.floor((F.col("y1") + F.col("y2")) / 2).alias("middle_y"), F.col("y1").alias("first_y"), F.col("y2").alias("last_y"), F.col("x1").alias("left_x"))
    return merging.representative_levels(named, ["image_id"])


def overlapped(df):
    named = df.select("image_id", F.col("box_id").alias("flaw_id"), F.col("cls").alias("flaw_type"), F.col("conf").alias("confidence"), F.col("x1").alias("x_start"),
                      F.col("x2").alias("x_end"), F.col("y1").alias("y_start"), F.col("y2").alias("y_end"), F.array("cls").alias("possible_category"))
    return merging.unite_overlapping_flaws(named, ["image_id"], 0.3, merging.PIXELS)


MERGES = {
    "frame": lambda df: merging.merge_frame_boxes(df, ["image_id"], 0.25, True),
    "frame of any class": lambda df: merging.merge_frame_boxes(df, ["image_id"], 0.25, False),
    "tile": lambda df: merging.merge_tile_boxes(df, ["image_id"], 0.3, 0.9),
    "suppressed": lambda df: merging.suppress_overlaps(df.withColumnRenamed("conf", "score"), ["image_id"], 0.3, 0.1),
    "suppressed without end pixels": lambda df: merging.suppress_overlaps(df.withColumnRenamed("conf", "score"), ["image_id"], 0.3, 0.0, inclusive=False),
    "v and mr": lambda df: merging.unite_v_and_mr(df, ["image_id"], 0.1),
    "flaws": overlapped,
    "levels": levels,
}


@pytest.mark.parametrize("merge", MERGES)
def test_usual_groups_and_crowds_merge_alike(spark, monkeypatch, merge):
    df = boxes(spark, 5)
    found = []
    for crowd, small, together in ((10_000, 32, 16_384), (10_000, 0, 9), (20, 32, 40), (0, 32, 16_384)):
        monkeypatch.setattr(groups, "CROWD", crowd)
        monkeypatch.setattr(groups, "TOGETHER", together)
        monkeypatch.setattr(merging, "SMALL", small)
        found.append(sorted(str(tuple(r)) for r in MERGES[merge](df).collect()))
    assert all(rows == found[0] for rows in found[1:])
    assert 0 < len(found[0]) < df.count()


@pytest.mark.parametrize("merge", MERGES)
def test_a_merge_of_usual_groups_takes_one_shuffle(spark, merge):
    assert shuffles(MERGES[merge](boxes(spark, 5).coalesce(1))) <= 3  # the rows of the test are dealt once for each time they are read


def test_usual_groups_and_crowds_have_the_same_pairs(spark, monkeypatch):
    df = flaws(spark, 3)
    found = []
    for crowd, inclusive in ((10_000, True), (30, True), (0, True), (10_000, False), (0, False)):
        monkeypatch.setattr(groups, "CROWD", crowd)
        rows = matching.pairs_within(df, ["scan_id"], inclusive=inclusive, least=0.2).collect()
        found.append((inclusive, sorted((r.scan_id, r.a_first._order, r.b_first._order, r.a_n, r.b_n, round(r.iou, 9), r.a_w, r.b_h) for r in rows)))
    assert found[0] == found[1] == found[2] and found[3] == found[4] and found[0][1] and found[0][1] != found[3][1]


def test_usual_scans_and_crowds_unite_alike_across_zero(spark, monkeypatch):
    """Ids that occur twice, missing depths and confidences, scans without a scrape and rows without a scan or a class."""
    rng = np.random.default_rng(8)
    n = 260
    some = lambda values, share: [None if rng.random() < share else v for v in values]
    rows = zip(
        some([int(v) for v in rng.integers(0, 9, n)], 0.03), [f"{v:03d}" for v in rng.integers(0, 150, n)], some([str(v) for v in rng.choice(["Scrape", "CC", "Debris"], n)], 0.03),
        some([float(v) for v in rng.integers(0, 60, n)], 0.02), [float(v) for v in rng.integers(1, 4, n)], [float(v) for v in rng.choice([0.5, 100.0, 355.0], n)],
        some([5.0] * n, 0.02), some([float(v) / 10 for v in rng.integers(0, 4, n)], 0.2), some([float(v) / 10 for v in rng.integers(0, 10, n)], 0.1),
    )
    df = spark.createDataFrame(list(rows), "scan_id long, ind_num string, flaw_type string, axial_start double, length double, rotary_start double, width double, depth double, confidence double")
    found = []
    for crowd, together in ((10_000, 16_384), (10_000, 20), (28, 16_384), (0, 16_384)):
        monkeypatch.setattr(groups, "CROWD", crowd)
        monkeypatch.setattr(groups, "TOGETHER", together)
        found.append(sorted(str(tuple(r)) for r in merging.merge_across_zero(df, ["scan_id"], 5.0, 1.0).collect()))
    assert found[3] == found[0] == found[1] == found[2] and sum("'" in r.rsplit(",", 1)[-1] for r in found[0]) > 5
    monkeypatch.setattr(groups, "CROWD", 512)
    assert shuffles(merging.merge_across_zero(df.coalesce(1), ["scan_id"], 5.0, 1.0)) <= 1


def test_a_median_is_sorted_once_a_row(spark):
    """The level of a mirrored signal is no part of what is computed for each sample."""
    from tubewave.functions import samples as sm

    df = spark.createDataFrame([([1, 5, 250, 3],), ([],), (None,)], "samples array<int>")
    mirrored = df.select(sm.inverted(F.col("samples"), sm.array_median(F.col("samples"))).alias("s"))
    assert mirrored._jdf.queryExecution().optimizedPlan().toString().count("array_sort") == 1
    assert [r.s for r in mirrored.collect()] == [[7.0, 3.0, 0.0, 5.0], [], None]
    cleared = df.select(sm.without_first_echo(F.col("samples"), F.lit(1), F.lit(3), sm.array_median(F.col("samples"))).alias("s"))
    assert [r.s for r in cleared.collect()] == [[1.0, 4.0, 4.0, 3.0], [], None]
