"""Operators against brute force on small tables, with hot groups and chunk borders."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tubewave.operators import learning, matching, merging, ordered, projections, ranking, store
from tubewave.operators.ordered import Series
from tubewave.operators.quantiles import exact_quantiles
from tubewave.operators.statistics import histogram

rng = np.random.default_rng(11)


def random_boxes(spark, n, hot=0.4):
    """A third and more of all boxes in one scan, many of them exact copies."""
    scan = np.where(rng.random(n) < hot, 0, rng.integers(1, 6, n))
    pdf = pd.DataFrame(
        {"scan_id": scan, "ind_num": [f"{i:04d}" for i in range(n)], "rotary_start": rng.integers(0, 60, n) / 2, "axial_start": rng.integers(0, 60, n) / 2,
         "width": rng.integers(2, 40, n) / 2, "length": rng.integers(2, 30, n) / 2}
    )
    copies = rng.random(n) < 0.3
    pdf.loc[copies, ["scan_id", "rotary_start", "axial_start", "width", "length"]] = [0, 5.0, 5.0, 4.0, 3.0]
    pdf["scan_id"] = pdf["scan_id"].astype("int64")
    return pdf, spark.createDataFrame(pdf)


def brute_iou(a, b):
    w = min(a.rotary_start + a.width, b.rotary_start + b.width) - max(a.rotary_start, b.rotary_start)
    h = min(a.axial_start + a.length, b.axial_start + b.length) - max(a.axial_start, b.axial_start)
    shared = max(w, 0) * max(h, 0)
    return shared / (a.width * a.length + b.width * b.length - shared)


@pytest.mark.parametrize("run, cell_runs, cell", [(32, 512, 120.0), (3, 2, 120.0), (2, 1, 7.0)])
@pytest.mark.parametrize("fallback", [False, True])
def test_best_match(spark, monkeypatch, fallback, run, cell_runs, cell):
    """Runs of any length, salted cells and cells smaller than boxes do not change a match."""
    monkeypatch.setattr(matching, "RUN", run)
    monkeypatch.setattr(matching, "CELL_RUNS", cell_runs)
    left, left_df = random_boxes(spark, 150)
    right, right_df = random_boxes(spark, 150)
    fn = matching.best_match_or_first if fallback else matching.best_match
    got = {(r.scan_id, r.ind_num): (r.match._order if r.match else None, r.iou) for r in fn(left_df, right_df, ["scan_id"], grid=matching.Grid(cell, cell)).collect()}
    assert len(got) == len(left)
    for a in left.itertuples():
        pairs = [(-brute_iou(a, b), b.ind_num) for b in right[right.scan_id == a.scan_id].itertuples()]
        best = min(pairs) if pairs else None
        if best and (best[0] < 0 or fallback):
            assert got[(a.scan_id, a.ind_num)][0] == best[1]
            assert got[(a.scan_id, a.ind_num)][1] == pytest.approx(-best[0])
        else:
            assert got[(a.scan_id, a.ind_num)][0] is None


def test_iou_is_symmetric_and_bounded(spark):
    _, a = random_boxes(spark, 60)
    rows = matching.overlapping_pairs(a, a, ["scan_id"]).collect()
    value = {(r.scan_id, r.a_first._order, r.b_first._order): r.iou for r in rows}
    assert all(0 < v <= 1 for v in value.values())
    assert all(value[(s, b, a)] == pytest.approx(v) for (s, a, b), v in value.items())
    once = {(r.scan_id, r.a_first._order, r.b_first._order): r.iou for r in matching.pairs_within(a, ["scan_id"]).collect()}
    assert once == {(s, a, b): v for (s, a, b), v in value.items() if a < b}
    high = {(r.scan_id, r.a_first._order, r.b_first._order) for r in matching.pairs_within(a, ["scan_id"], least=0.3).collect()}
    assert high == {pair for pair, v in once.items() if v >= 0.3}


@pytest.mark.parametrize("width", [0.5, 3.0, 1000.0])
def test_exact_quantiles(spark, width):
    pdf = pd.DataFrame({"k": rng.choice(["a", "a", "b", "c"], 500), "v": rng.normal(0, 5, 500).round(1)})
    got = {r.k: r for r in exact_quantiles(spark.createDataFrame(pdf), ["k"], "v", {"q01": 0.01, "q5": 0.5, "q9": 0.9}, width).collect()}
    for key, group in pdf.groupby("k"):
        for name, q in (("q01", 0.01), ("q5", 0.5), ("q9", 0.9)):
            assert got[key][name] == pytest.approx(np.quantile(group.v, q))


@pytest.fixture(scope="module")
def series(spark):
    pdf = pd.DataFrame({"k": np.repeat([0, 1, 2], [200, 30, 1]), "t": np.concatenate([np.arange(200) * 3, np.arange(30), [5]]), "v": rng.integers(0, 6, 231).astype(float)})
    pdf["gap"] = pdf["v"].where(rng.random(231) < 0.4)
    pdf["k"] = pdf["k"].astype("int64")
    return spark.createDataFrame(pdf).withColumn("gap", F.when(~F.isnan("gap"), F.col("gap")))


@pytest.mark.parametrize("chunk", [7, 50, 10_000])
def test_chunks_do_not_change_results(spark, series, chunk):
    """Every ordered operator gives the same with chunks of any width as with one plain window."""
    plain, cut = Series(["k"], ["t"], None), Series(["k"], ["t"], chunk)
    high = F.col("v") > 2
    for work in (
        lambda s: ordered.running(series, s, {"x": F.col("v"), "n": F.lit(1)}),
        lambda s: ordered.known(series, s, {"a": F.col("gap")}, {"b": F.col("gap")}),
        lambda s: ordered.adjacent(series, s, {"a": F.col("gap")}, {"b": F.col("gap")}),
        lambda s: ordered.runs(series, s, high),
        lambda s: ordered.islands(series, s, high, 2),
        lambda s: ordered.interpolate(series, s, "gap", "x"),
        lambda s: ordered.bridge_mask(series, s, "v", high, "x"),
        lambda s: ordered.longest_changes(series, s, "v"),
        lambda s: ordered.interval_islands(series.withColumn("e", F.col("t") + F.col("v")), s, "t", "e"),
    ):
        want, got = work(plain), work(cut)
        assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_interpolation_leaves_no_inner_gap(spark, series):
    filled = ordered.interpolate(series, Series(["k"], ["t"], 20), "gap", "x").where("k < 2")
    assert filled.where("x IS NULL").count() == 0
    one = filled.where("k = 1").orderBy("t").toPandas()
    np.testing.assert_allclose(one.x, pd.Series(one.gap).astype(float).interpolate(limit_direction="both"))


def test_islands_cover_the_condition(spark, series):
    found = ordered.islands(series, Series(["k"], ["t"], 10), F.col("v") > 2, 1)
    assert found.agg(F.sum("length")).first()[0] == series.where("v > 2").count()


def box_rows(n, seed=3):
    r = np.random.default_rng(seed)
    x, y = r.integers(0, 300, n).astype(float), r.integers(0, 300, n).astype(float)
    return pd.DataFrame(
        {"image_id": np.where(r.random(n) < 0.5, 0, r.integers(1, 4, n)).astype("int64"), "box_id": [f"{i:03d}" for i in range(n)], "cls": r.choice(["V", "MR"], n),
         "conf": r.integers(1, 10, n) / 10, "x1": x, "y1": y, "x2": x + r.integers(5, 60, n), "y2": y + r.integers(5, 60, n)}
    )


def brute_unite(rows, axes, joins, second_on_tie):
    rows = [dict(r) for r in rows]
    while True:
        for i in range(len(rows)):
            for j in range(i + 1, len(rows)):
                if joins(rows[i], rows[j]):
                    a, b = rows[i], rows[j]
                    keep, drop = (j, i) if b["conf"] > a["conf"] or (second_on_tie and a["conf"] == b["conf"]) else (i, j)
                    for lo, hi in axes:
                        rows[keep][lo], rows[keep][hi] = min(a[lo], b[lo]), max(a[hi], b[hi])
                    del rows[drop]
                    break
            else:
                continue
            break
        else:
            return rows


def as_set(rows, columns):
    return sorted(tuple(r[c] for c in columns) for r in rows)


def test_tile_boxes_merge_as_in_one_list(spark):
    pdf = box_rows(120)

    def joins(a, b):
        w = max(min(a["x2"], b["x2"]) - max(a["x1"], b["x1"]) + 1, 0)
        h = max(min(a["y2"], b["y2"]) - max(a["y1"], b["y1"]) + 1, 0)
        size = [(r["x2"] - r["x1"] + 1) * (r["y2"] - r["y1"] + 1) for r in (a, b)]
        return w * h / (sum(size) - w * h) >= 0.3 or w * h / min(size) >= 0.9

    got = [r.asDict() for r in merging.merge_tile_boxes(spark.createDataFrame(pdf), ["image_id"], 0.3, 0.9).collect()]
    want = [r for _, g in pdf.groupby(["image_id", "cls"]) for r in brute_unite(g.to_dict("records"), [("x1", "x2"), ("y1", "y2")], joins, True)]
    assert as_set(got, pdf.columns) == as_set(want, pdf.columns)
    again = merging.merge_tile_boxes(spark.createDataFrame(pd.DataFrame(got)[pdf.columns]), ["image_id"], 0.3, 0.9)
    assert again.count() == len(got)


def test_frame_boxes_merge_by_tie_rule(spark):
    rows = [(0, "a", "V", 0.5, 0.0, 10.0), (0, "b", "V", 0.5, 2.0, 12.0), (0, "c", "MR", 0.9, 0.0, 10.0), (0, "d", "V", 0.1, 40.0, 50.0)]
    df = spark.createDataFrame(rows, "image_id BIGINT, box_id STRING, cls STRING, conf DOUBLE, x1 DOUBLE, x2 DOUBLE")
    same = {r.box_id: (r.x1, r.x2) for r in merging.merge_frame_boxes(df, ["image_id"], 0.25, True).collect()}
    assert same == {"a": (0.0, 12.0), "c": (0.0, 10.0), "d": (40.0, 50.0)}
    every = {r.box_id: (r.x1, r.x2) for r in merging.merge_frame_boxes(df, ["image_id"], 0.25, False).collect()}
    assert every == {"c": (0.0, 12.0), "d": (40.0, 50.0)}


def test_suppression_matches_greedy_choice(spark):
    pdf = pd.concat([box_rows(150, 5), box_rows(150, 5).assign(box_id=[f"x{i}" for i in range(150)], conf=lambda d: d.conf - 0.05)])
    got = merging.suppress_overlaps(spark.createDataFrame(pdf.rename(columns={"conf": "score"})), ["image_id"], 0.45, 0.1)
    want = []
    for _, g in pdf[pdf.conf > 0.1].groupby(["image_id", "cls"]):
        left = sorted(g.to_dict("records"), key=lambda r: (r["conf"], r["box_id"]), reverse=True)
        while left:
            top, *rest = left
            want.append((top["image_id"], top["box_id"]))
            left = []
            for r in rest:
                w = max(min(top["x2"], r["x2"]) - max(top["x1"], r["x1"]) + 1, 0)
                h = max(min(top["y2"], r["y2"]) - max(top["y1"], r["y1"]) + 1, 0)
                area = sum((q["x2"] - q["x1"] + 1) * (q["y2"] - q["y1"] + 1) for q in (top, r))
                if w * h / (area - w * h) <= 0.45:
                    left.append(r)
    assert sorted((r.image_id, r.box_id) for r in got.collect()) == sorted(want)


def test_overlapping_flaws_keep_the_later_on_ties(spark):
    rows = [(1, "a", "CC", 0.5, 0.0, 10.0, 0.0, 10.0), (1, "b", "Debris", 0.5, 0.0, 10.0, 0.0, 10.0), (1, "c", "CC", 0.9, 50.0, 60.0, 50.0, 60.0)]
    df = spark.createDataFrame(rows, "scan_id BIGINT, flaw_id STRING, flaw_type STRING, confidence DOUBLE, x_start DOUBLE, x_end DOUBLE, y_start DOUBLE, y_end DOUBLE")
    out = {r.flaw_id: r for r in merging.unite_overlapping_flaws(df.withColumn("possible_category", F.array("flaw_type")), ["scan_id"]).collect()}
    assert set(out) == {"b", "c"}
    assert out["b"].flaw_type == "Note 1 - overlapped" and list(out["b"].possible_category) == ["CC", "Debris"]


def test_levels_keep_the_leftmost(spark):
    rows = [(0, "a", 10, 5, 15, 7.0), (0, "b", 13, 6, 16, 3.0), (0, "c", 14, 20, 30, 1.0), (0, "d", 40, 35, 45, 2.0)]
    df = spark.createDataFrame(rows, "image_id BIGINT, box_id STRING, middle_y INT, first_y INT, last_y INT, left_x DOUBLE")
    assert sorted(r.box_id for r in merging.representative_levels(df, ["image_id"]).collect()) == ["b", "c", "d"]


def test_histogram_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.25, 0.5, 1.0, 1.1)], "v DOUBLE")
    assert {r.bin: r.n for r in histogram(df, [], "v", 0.0, 1.0, 4).collect()} == {0: 1, 1: 1, 2: 1, 3: 1}


def test_depth_choice(spark):
    rows = [(1, 0.9, 10, 5, 5), (1, 0.5, 100, 6, 6), (1, 0.6, 90, 20, 20), (2, 0.3, 50, 1, 1)]
    df = spark.createDataFrame(rows, "k INT, depth DOUBLE, amp INT, frame INT, cell INT")
    out = {r.k: (r.depth, r.by_amplitude) for r in ranking.pick_depth(df, ["k"], "depth", "amp", "frame", "cell").collect()}
    assert out == {1: (0.5, True), 2: (0.3, False)}


def test_nested_documents_split_large_parents(spark):
    parents = spark.range(3).withColumnRenamed("id", "scan_id")
    children = spark.range(100).select((F.col("id") % 2).alias("scan_id"), F.col("id").alias("flaw"))
    docs = projections.nested_documents(parents, children, "scan_id", "flaws", limit=10).collect()
    found = sorted(f.flaw for d in docs if d.flaws for f in d.flaws)
    assert found == list(range(100))
    assert max(len(d.flaws) for d in docs if d.flaws) < 30
    assert [d.part for d in docs if d.scan_id == 2] == [0]


def test_tier_and_upsert(spark):
    a = spark.createDataFrame([("x", 1.0, None), ("y", None, None)], "id STRING, pred_depth DOUBLE, first_peak DOUBLE").withColumn("echo_removed", F.lit(1.3))
    b = spark.createDataFrame([("x", 9.0), ("y", 2.0)], "id STRING, pred_depth DOUBLE").withColumns({"first_peak": F.lit(None).cast("double"), "echo_removed": F.lit(9.9)})
    out = {r.id: (r.probe, r.final_depth) for r in store.debris_final_depth(a, b, ["id"]).collect()}
    assert out == {"x": ("NB1", 1.3), "y": ("NB2", 2.0)}
    old = spark.createDataFrame([(1, "a", "k"), (2, "b", None)], "id INT, v STRING, w STRING")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", "n")], "id INT, v STRING, w STRING")
    assert {r.id: (r.v, r.w) for r in store.upsert(old, new, ["id"]).collect()} == {1: ("a", "k"), 2: ("b", "z"), 3: ("c", "n")}


def test_flag_model_learns_a_threshold(spark):
    n = 400
    pdf = pd.DataFrame({"depth": rng.random(n), "kind": rng.choice(["a", "b"], n), "depth_nb1": 0.2, "depth_nb2": 0.1})
    pdf["depth_diff"] = np.where(pdf.depth > 0.5, 0.1, 0.0)
    ready = learning.training_set(spark.createDataFrame(pdf))
    model = learning.train_flag_model(ready, ["depth"], ["kind"], trees=10, depth=3)
    scored = learning.flag_probability(model, ready, ["depth"], ["kind"]).toPandas()
    assert ((scored.probability >= 0.5).astype(int) == scored.flagged).mean() > 0.97


def test_tiles_cover_small_and_odd_images(spark):
    images = spark.createDataFrame([("odd", 340, 510), ("small", 200, 900), ("exact", 256, 256)], "image STRING, h BIGINT, w BIGINT")
    found = {}
    for r in merging.tiles(images, ["image"], "h", "w", 256, 128).collect():
        found.setdefault(r.image, set()).add((r.tile_y, r.tile_x))
    assert found["odd"] == {(y, x) for y in (0, 84) for x in (0, 128, 254)}
    assert found["small"] == {(0, x) for x in (0, 128, 256, 384, 512, 640, 644)} and found["exact"] == {(0, 0)}


def test_resampling_keeps_positions_of_one_frame(spark):
    cells = spark.createDataFrame([("s", 0, 0, 1.0), ("s", 0, 1, 5.0), ("s", 1, 0, 3.0)], "scan STRING, frame BIGINT, rotary_idx INT, amp DOUBLE")
    rows = projections.resample_axial(cells.withColumn("pitch", F.lit(0.45)), ["scan"], "pitch", "amp").collect()
    assert {(r.frame, r.rotary_idx) for r in rows} == {(0, 0), (0, 1), (1, 0), (1, 1), (2, 0)}  # frame 2 only draws on a frame without position 1
    assert {r.amp for r in rows if r.rotary_idx == 1} == {5.0}


def test_stored_model_judges_as_the_trained_one(spark, tmp_path):
    n = 300
    pdf = pd.DataFrame({"flaw_type": rng.choice(["CC", "Debris", "FBBPF"], n), "axial_start": rng.random(n), "rotary_start": rng.random(n), "width": rng.uniform(1, 3, n)})
    pdf["length"] = np.where(pdf.flaw_type == "CC", pdf.width * 5, pdf.width)
    pdf["kind"] = rng.choice(["a", "b"], n)
    ready = learning.differentiation_features(spark.createDataFrame(pdf), 0.0)
    trained = learning.train_classes(ready, "flaw_type", ["CC", "Debris"], learning.SHAPE_FEATURES, ["kind"], {"CC": 0.6, "Debris": 0.4}, trees=10, depth=3)
    trained.save(spark, str(tmp_path / "model"))
    trained.save(spark, str(tmp_path / "model"))  # replaces what was there
    loaded = learning.StoredModel.load(spark, str(tmp_path / "model"))
    assert (loaded.numeric, loaded.categorical, loaded.classes, loaded.thresholds) == (trained.numeric, trained.categorical, trained.classes, trained.thresholds)
    odd = spark.createDataFrame([("CC", None, 0.5, 2.0, 10.0, "new"), ("CC", 0.5, 0.5, 2.0, 2.0, None)], "flaw_type string, axial_start double, rotary_start double, width double, length double, kind string")
    rows = ready.select("flaw_type", "axial_start", "rotary_start", "width", "length", "kind").unionByName(odd)
    features = learning.differentiation_features(rows, 0.0)
    one, two = trained.apply(features).toPandas(), loaded.apply(features).toPandas()
    np.testing.assert_array_equal(one.p_cc, two.p_cc)
    np.testing.assert_allclose(two.p_cc + two.p_debris, 1)
    assert ((two.p_cc > 0.5) == (two.length > 2 * two.width))[two.flaw_type != "FBBPF"].mean() > 0.97
    judged = learning.differentiate_by(loaded, odd, 0.0).toPandas()
    assert list(judged.possible_category[0]) == ["CC"] and list(judged.possible_category[1]) == ["CC", "Debris"]
