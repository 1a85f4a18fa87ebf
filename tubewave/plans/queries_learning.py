"""Classifier rules, training tables, scoring and the end-to-end flows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learning, scoring, tiling
from ..operators.tiling import Model
from ..session import scratch_path
from . import fixtures as fx
from . import flows
from .fixtures import with_tables
from .queries_matching import REPORTED_METRICS_SQL, reported_metrics
from .queries_merging import AREA_OF, AREA_SHARED, UNION_SQL, recursive, unite_sql
from .registry import query


@query(
    "differentiation_rules_e11",
    with_tables(
        "predicted",
        """, p AS (SELECT scan_id, ind_num, regexp_replace(flaw_type, '^BM_| \\(M\\)$', '', 'g') AS t, confidence AS p_cc, 1 - confidence AS p_debris, length, width FROM predicted)
SELECT scan_id, ind_num, round((length - 0.5) / width, 6) AS lw_ratio,
  CASE WHEN t = 'CC' AND p_debris >= 0.4 THEN 'CC,Debris' WHEN t = 'Debris' AND p_cc >= 0.6 THEN 'Debris,CC' ELSE t END AS cats,
  CASE WHEN (t = 'CC' AND p_debris >= 0.4) OR (t = 'Debris' AND p_cc >= 0.6) THEN 'Warning: Differentiation between CC and Debris is inconclusive.' END AS note1 FROM p""",
    ),
)
def differentiation_rules(spark, sf_dir):
    flaws = fx.predicted(spark, sf_dir).select(
        "scan_id", "ind_num", F.regexp_replace("flaw_type", r"^BM_| \(M\)$", "").alias("flaw_type"), F.col("confidence").alias("p_cc"),
        (1 - F.col("confidence")).alias("p_debris"), "length", "width",
    )
    out = learning.differentiate(learning.differentiation_features(flaws, 0.5), 0.4, 0.6)
    return out.select("scan_id", "ind_num", F.round("lw_ratio", 6).alias("lw_ratio"), F.array_join("possible_category", ",").alias("cats"), "note1")


@query(
    "flag_rules_e12",
    with_tables(
        "predicted",
        """SELECT scan_id, ind_num, depth IS NULL OR confidence >= 0.8 AS flagged, CASE WHEN depth IS NULL THEN 'nan (2)' WHEN confidence >= 0.8 THEN CAST(depth AS VARCHAR) || ' (2)' ELSE CAST(depth AS VARCHAR) END AS depth_out,
  CASE flaw_type WHEN 'CC' THEN 4 WHEN 'Debris' THEN 7 ELSE 38 END AS type_code FROM predicted""",
    ),
)
def flag_rules(spark, sf_dir):
    rows = learning.flag_cases(fx.predicted(spark, sf_dir), "confidence", 0.8)
    codes = spark.createDataFrame([("CC", 4), ("Debris", 7)], "value STRING, code INT")
    coded = learning.encode(rows, "flaw_type", codes, learning.UNSEEN_CODES["channel"])
    return coded.select("scan_id", "ind_num", "flagged", "depth_out", F.col("flaw_type_code").alias("type_code"))


@query(
    "training_features_e13",
    with_tables(
        "predicted, reported",
        f"""{REPORTED_METRICS_SQL}
SELECT scan_id, ind_num, flaw_type, width_diff AS metrics_width_diff, length_diff AS metrics_length_diff, position_x_diff AS metrics_position_x_diff,
  position_y_diff AS metrics_position_y_diff, abs(depth_diff) AS depth_diff FROM metrics WHERE is_predicted AND depth_diff IS NOT NULL AND depth_diff <> 0""",
    ),
)
def training_features(spark, sf_dir):
    names = ["scan_id", "ind_num", "flaw_type", "is_predicted", "width_diff", "length_diff", "position_x_diff", "position_y_diff", "depth_diff"]
    return learning.training_features(reported_metrics(spark, sf_dir, names)).drop("is_predicted")


@query(
    "training_set_e14",
    with_tables(
        "deltas",
        """, c AS (SELECT category, row_number() OVER (ORDER BY category) - 1 AS code FROM (SELECT DISTINCT category FROM deltas))
SELECT scan_id, ind_num, CAST(depth_nb1 IS NOT NULL OR depth_nb2 IS NOT NULL AS INTEGER) AS nb_used,
  round(CASE WHEN depth_nb1 IS NOT NULL AND depth_nb2 IS NOT NULL THEN depth_nb1 - depth_nb2 WHEN depth_nb1 IS NOT NULL THEN depth_nb1 ELSE -depth_nb2 END, 6) AS nb_delta,
  CAST(delta2 > 0.038 OR delta2 < -0.03 AS INTEGER) AS target, CAST(code AS INTEGER) AS category_code FROM deltas JOIN c USING (category) WHERE delta2 IS NOT NULL""",
    ),
)
def training_set(spark, sf_dir):
    rows = fx.deltas(spark, sf_dir)
    ready = learning.training_set(rows.drop("flagged"), "delta2")
    coded = learning.encode(ready, "category", learning.sorted_codes(rows, "category"), -1)
    return coded.select("scan_id", "ind_num", "nb_used", F.round("nb_delta", 6).alias("nb_delta"), F.col("flagged").alias("target"), "category_code")


@query("flag_model_e15_e12")
def flag_model(spark, sf_dir):
    """Train the forest on the whole table and score it."""
    ready = learning.training_set(fx.deltas(spark, sf_dir).drop("flagged"), "delta2")
    numeric, categorical = ["depth", "nb_delta", "delta1"], ["category"]
    model = learning.train_flag_model(ready, numeric, categorical, trees=20, depth=5)
    scored = learning.flag_probability(model, ready, numeric, categorical)
    return learning.flag_cases(scored, "probability", 0.5).groupBy("category", "flagged").agg(F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_probability"))


@query("stored_differentiation_e11_e15")
def stored_differentiation(spark, sf_dir):
    """Learn crevice flaws and debris from all reported flaws, store the model, load it and judge all predicted flaws with it."""
    plain = F.regexp_replace("flaw_type", r"^BM_| \(M\)$", "")
    reported = learning.differentiation_features(fx.reported(spark, sf_dir).withColumn("flaw_type", plain), 0.5)
    folder = scratch_path(spark, "differentiation-model")
    trained = learning.train_classes(reported, "flaw_type", ["CC", "Debris"], learning.SHAPE_FEATURES, [], {"CC": 0.45, "Debris": 0.45}, trees=20, depth=5)
    trained.save(spark, folder)
    judged = learning.differentiate_by(learning.StoredModel.load(spark, folder), fx.predicted(spark, sf_dir).withColumn("flaw_type", plain), 0.5)
    return judged.select("scan_id", "ind_num", "flaw_type", F.array_join("possible_category", "|").alias("categories"), "note1", F.round("p_cc", 6).alias("p_cc"), F.round("p_debris", 6).alias("p_debris"))


@query("scored_frames_e9")
def scored_frames(spark, sf_dir):
    images = scoring.frame_images(fx.ascans(spark, sf_dir), ["scan_id", "probe", "frame"], "rotary_idx", "samples")
    return scoring.score_images(images, ["scan_id", "probe", "frame"], lambda: scoring.BrightRegion(0.6), ["G4"], 96)


@query("vision_depth_e6")
def vision_depth(spark, sf_dir):
    return flows.vision_depth(fx.grid_flaws(spark, sf_dir), fx.ascans(spark, sf_dir), lambda: scoring.BrightSpot(8), 96)


def bright_models() -> list[Model]:
    """Stand-ins for the two detectors: the second looks at smaller tiles, calls everything another kind and needs large maps."""
    first = Model(lambda: scoring.BrightSpot(6), ("CC",), image=96, tile=32, step=16)
    second = Model(lambda: scoring.BrightSpot(2), ("Debris",), image=48, tile=16, step=8, confidence=0.1, renamed="Others", rows=3, columns=31)
    return [first, second]


def shape_probabilities(flaws):
    """Stand-in for the classifier: long and narrow flaws look like crevice flaws."""
    p = F.col("lw_ratio") / (1 + F.col("lw_ratio"))
    return flaws.withColumn("p_cc", p).withColumn("p_debris", 1 - p)


@query("analysis_flow_e10")
def analysis_flow(spark, sf_dir):
    return flows.analyse(fx.ascans(spark, sf_dir), bright_models(), probabilities=shape_probabilities, limits=(0.6, 0.2), confidence=0.1)


# a map of each scan and probe with three channels: largest, first and last sample of every position
MAPS_SQL = """, maps AS (SELECT scan_id, probe, dense_rank() OVER (PARTITION BY scan_id, probe ORDER BY frame) - 1 AS y, rotary_idx - min(rotary_idx) OVER (PARTITION BY scan_id, probe) AS x,
  list_max(samples)::DOUBLE AS a, samples[1]::DOUBLE AS b, samples[-1]::DOUBLE AS c FROM ascans),
ext AS (SELECT scan_id, probe, max(y) + 1 AS h, max(x) + 1 AS w FROM maps GROUP BY 1, 2),
ty AS (SELECT scan_id, probe, h, w, unnest(list_distinct(list_append(range(0, greatest(h - {size}, 0) + 1, {step}), greatest(h - {size}, 0)))) AS tile_y FROM ext),
t AS (SELECT *, unnest(list_distinct(list_append(range(0, greatest(w - {size}, 0) + 1, {step}), greatest(w - {size}, 0)))) AS tile_x FROM ty),
p AS (SELECT t.*, y - tile_y AS py, x - tile_x AS px, least(h, {size}) AS th, least(w, {size}) AS tw, a, b, c FROM t JOIN maps m ON m.scan_id = t.scan_id AND m.probe = t.probe
  AND y >= tile_y AND y < tile_y + {size} AND x >= tile_x AND x < tile_x + {size})"""
CHANNELS = ["a", "b", "c"]


def peak_lines(spark, sf_dir):
    maps = fx.ascans(spark, sf_dir).select(
        "scan_id", "probe", "frame", "rotary_idx", F.array_max("samples").alias("a"), F.get("samples", F.lit(0)).alias("b"), F.element_at("samples", -1).alias("c")
    )
    return tiling.map_lines(maps, flows.MAP, "frame", "rotary_idx", CHANNELS)


@query(
    "map_tiles_x12_e9",
    with_tables(
        "ascans",
        MAPS_SQL.format(size=24, step=10) + """
SELECT scan_id, probe, tile_y, tile_x, any_value(th)::INTEGER AS height, any_value(tw)::INTEGER AS width, sum(a + b + c) AS total,
  sum(a * (3 * (py * tw + px) + 1) + b * (3 * (py * tw + px) + 2) + c * (3 * (py * tw + px) + 3)) AS weighted FROM p GROUP BY 1, 2, 3, 4""",
    ),
)
def map_tiles(spark, sf_dir):
    """Tiles with three channels; sums over all pixels, plain and by place, tell that each stands where it belongs."""
    tiles = tiling.cut_tiles(peak_lines(spark, sf_dir), flows.MAP, CHANNELS, 24, 10)
    by_place = F.transform("pixels", lambda v, i: v * (i + 1))
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return tiles.select(*flows.MAP, "tile_y", "tile_x", "height", "width", add(F.col("pixels")).alias("total"), add(by_place).alias("weighted"))


@query(
    "tile_detections_e9_x12_m3",
    recursive(with_tables(
        "ascans",
        MAPS_SQL.format(size=24, step=12) + """, bright AS (SELECT scan_id, probe, lpad(tile_y::VARCHAR, 8, '0') || '-' || lpad(tile_x::VARCHAR, 8, '0') || '-00000' AS box_id, 'Debris' AS cls,
  round(least(avg(a / 255), 1), 9) AS conf, (min(px) + any_value(tile_x))::DOUBLE AS x1, (min(py) + any_value(tile_y))::DOUBLE AS y1, (max(px) + any_value(tile_x))::DOUBLE AS x2,
  (max(py) + any_value(tile_y))::DOUBLE AS y2 FROM p WHERE a / 255 >= 0.65 GROUP BY scan_id, probe, tile_y, tile_x)"""
        + unite_sql(
            "bright", "scan_id, probe",
            f"({AREA_SHARED} / {UNION_SQL} >= 0.3 OR {AREA_SHARED} / least({AREA_OF.replace('{b}', 'u')}, {AREA_OF.replace('{b}', 'v')}) >= 0.9)".replace("{e}", "1"), "v.conf >= u.conf",
        )
        + " SELECT scan_id, probe, box_id, cls, round(conf, 6) AS conf, x1, y1, x2, y2 FROM united",
    )),
)
def tile_detections(spark, sf_dir):
    """One channel, tiles as large as the detector's image: a box around bright pixels of each tile, united across tiles."""
    model = Model(lambda: scoring.BrightRegion(0.65), ("Debris",), image=24, tile=24, step=12)
    boxes = tiling.detect_on_tiles(peak_lines(spark, sf_dir), flows.MAP, ["a"], model)
    return boxes.select(*flows.MAP, "box_id", "cls", F.round("conf", 6).alias("conf"), "x1", "y1", "x2", "y2")
