"""Regions of interest, axes, box geometry, sample projections and flaw selections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, text
from ..functions import samples as sm
from ..operators import projections as pj
from . import fixtures as fx
from .fixtures import with_tables
from .registry import query


@query(
    "region_of_interest_p1",
    with_tables(
        "ascans",
        """SELECT scan_id, probe, frame, rotary_idx, len(samples[9:32])::INTEGER AS n, list_sum(samples[9:32])::DOUBLE AS total FROM ascans
WHERE frame BETWEEN 2 AND 5 AND rotary_idx BETWEEN 10 AND 40""",
    ),
)
def region_of_interest(spark, sf_dir):
    roi = pj.region(fx.ascans(spark, sf_dir), (2, 5), (10, 40), (8, 31))
    return roi.select("scan_id", "probe", "frame", "rotary_idx", F.size("samples").alias("n"), sm.total(F.col("samples")).alias("total"))


@query(
    "nearest_axis_index_p2",
    with_tables(
        "series",
        """, a AS (SELECT scan_id, full_value AS pos, min(frame) AS idx FROM series GROUP BY 1, 2),
t AS (SELECT scan_id, frame AS target_id, full_value * 1.01 + 0.013 AS target FROM series)
SELECT scan_id, target_id, arg_min(idx, struct_pack(d := abs(pos - target), i := idx)) AS idx FROM t JOIN a USING (scan_id) GROUP BY 1, 2""",
    ),
)
def nearest_axis_index(spark, sf_dir):
    rows = fx.series(spark, sf_dir)
    targets = rows.select("scan_id", F.col("frame").alias("target_id"), (F.col("full_value") * 1.01 + 0.013).alias("target"))
    axis = rows.select("scan_id", F.col("full_value").alias("pos"), F.col("frame").alias("idx"))
    return pj.nearest_index(targets, axis, ["scan_id"], "target", "pos", "idx", 20.0).drop("target")


@query(
    "range_checks_p3",
    """WITH r AS (SELECT o_orderkey AS scan_id, o_custkey % 300 AS first, o_custkey % 300 + o_custkey % 260 AS last,
  o_custkey % 310 AS a, o_custkey % 290 + 20 AS b FROM orders)
SELECT scan_id, CASE WHEN a > b THEN 'start behind end' WHEN a < first OR b > last THEN 'outside the scan'
  WHEN last - first > 225 THEN 'scan longer than 225 mm' END AS problem FROM r""",
)
def range_checks(spark, sf_dir):
    key = F.col("o_custkey")
    problem = pj.range_problem(key % 310, key % 290 + 20, key % 300, key % 300 + key % 260)
    return fx.given(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scan_id"), problem.alias("problem"))


@query(
    "rotary_axis_p4",
    with_tables(
        "ascans",
        """SELECT scan_id, frame, rotary_idx, round((1e-1 * (rotary_idx + 3580)) % 360, 4) AS rotary_deg,
  round(8e-1 * frame + 900, 4) AS time_us FROM ascans""",
    ),
)
def rotary_axis(spark, sf_dir):
    return fx.ascans(spark, sf_dir).select(
        "scan_id", "frame", "rotary_idx", F.round(pj.rotary_angle(F.col("rotary_idx"), F.lit(3580)), 4).alias("rotary_deg"),
        F.round(0.8 * F.col("frame") + 900.0, 4).alias("time_us"),
    )


@query(
    "scans_by_fields_p5",
    with_tables("scans", "SELECT scan_id, scan_name FROM scans WHERE scan_year = 1998 AND scan_unit = 3"),
)
def scans_by_fields(spark, sf_dir):
    return fx.scans(spark, sf_dir).where(pj.equals_all({"scan_year": 1998, "scan_unit": 3})).select("scan_id", "scan_name")


@query(
    "flexible_query_p6",
    with_tables(
        "scans, reported",
        """SELECT scan_id, scan_name FROM scans s WHERE scan_station = 'Darlington' AND scan_unit IN (1, 2, 5)
AND EXISTS (SELECT 1 FROM reported r WHERE r.scan_id = s.scan_id AND (contains(lower(flaw_type), 'debris') OR contains(lower(flaw_type), 'bm_'))
  AND length = 1.4)""",
    ),
)
def flexible_query(spark, sf_dir):
    return pj.flexible_query(
        fx.scans(spark, sf_dir), fx.reported(spark, sf_dir),
        {"scan_station": "Darlington", "scan_unit": [1, 2, 5]}, {"flaw_type": ["Debris", "BM_"], "length": 1.4},
    ).select("scan_id", "scan_name")


@query(
    "query_presets_p7",
    with_tables(
        "scans, reported",
        """SELECT 'debris' AS preset, count(*)::BIGINT AS n FROM scans s WHERE EXISTS (SELECT 1 FROM reported r WHERE r.scan_id = s.scan_id
  AND contains(lower(flaw_type), 'debris'))
UNION ALL SELECT 'CC', count(*) FROM scans s WHERE EXISTS (SELECT 1 FROM reported r WHERE r.scan_id = s.scan_id AND contains(lower(flaw_type), 'cc'))
UNION ALL SELECT 'all', count(*) FROM scans s WHERE EXISTS (SELECT 1 FROM reported r WHERE r.scan_id = s.scan_id)
UNION ALL SELECT 'D19811', count(*) FROM scans s WHERE raw_outage = 'D19811' AND EXISTS (SELECT 1 FROM reported r WHERE r.scan_id = s.scan_id)""",
    ),
)
def query_presets(spark, sf_dir):
    scans = fx.scans(spark, sf_dir).withColumn("outage_number", F.col("raw_outage"))
    flaws = fx.reported(spark, sf_dir)
    out = None
    for name in ("debris", "CC", "all", "D19811"):
        p = pj.preset(name)
        n = pj.flexible_query(scans, flaws, p["scan"], p["flaw"]).agg(F.lit(name).alias("preset"), F.count(F.lit(1)).alias("n"))
        out = n if out is None else out.unionByName(n)
    return out


@query(
    "flaws_of_type_p8_p9",
    with_tables("predicted", "SELECT scan_id, ind_num, confidence FROM predicted WHERE flaw_type = 'Debris' AND confidence >= 0.5"),
)
def flaws_of_type(spark, sf_dir):
    rows = fx.predicted(spark, sf_dir).where((F.col("flaw_type") == "Debris") & (F.col("confidence") >= 0.5))
    return rows.select("scan_id", "ind_num", "confidence")


@query(
    "class_confidence_p10",
    with_tables(
        "predicted",
        """SELECT scan_id, ind_num, flaw_type FROM predicted WHERE confidence >= CASE WHEN contains(flaw_type, 'BM_') THEN 0.7
  WHEN contains(flaw_type, 'Debris') THEN 0.3 WHEN contains(flaw_type, 'CC') THEN 0.5 ELSE -1e300 END""",
    ),
)
def class_confidence(spark, sf_dir):
    limit = pj.class_threshold(F.col("flaw_type"), [("BM_", 0.7), ("Debris", 0.3), ("CC", 0.5)])
    return fx.predicted(spark, sf_dir).where(F.col("confidence") >= limit).select("scan_id", "ind_num", "flaw_type")


@query(
    "box_bounds_p11_p12",
    with_tables(
        "boxes",
        """, c AS (SELECT *, x - w / 2 AS l, x + w / 2 AS r, y - h / 2 AS t, y + h / 2 AS b FROM boxes)
SELECT image_id, box_id, CAST(greatest(floor(greatest(least(l * img_w, img_w), 0.0)), 0) AS BIGINT) AS x1,
  CAST(greatest(floor(greatest(least(t * img_h, img_h), 0.0)), 0) AS BIGINT) AS y1,
  CAST(least(ceil(greatest(least(r * img_w, img_w), 0.0) - 1), img_w) AS BIGINT) AS x2,
  CAST(least(ceil(greatest(least(b * img_h, img_h), 0.0) - 1), img_h) AS BIGINT) AS y2,
  round(greatest(l, 0.0), 6) AS u1, round(greatest(b, 0.0), 6) AS u4, round(w * img_w, 4) AS w_px, round(h * img_h, 4) AS h_px FROM c""",
    ),
)
def box_bounds(spark, sf_dir):
    c = [F.col(n) for n in ("x", "y", "w", "h", "img_w", "img_h")]
    x1, y1, x2, y2 = geometry.pixel_bounds(*c)
    u = geometry.unit_bounds(*c)
    return fx.boxes(spark, sf_dir).select(
        "image_id", "box_id", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"), F.round(u[0], 6).alias("u1"),
        F.round(u[3], 6).alias("u4"), F.round(c[2] * c[4], 4).alias("w_px"), F.round(c[3] * c[5], 4).alias("h_px"),
    )


@query(
    "box_to_flaw_p13_p14",
    with_tables(
        "boxes, axis",
        """, c AS (SELECT image_id, box_id, CAST(greatest(floor(greatest(least((x - w / 2) * img_w, img_w), 0.0)), 0) AS BIGINT) AS x1,
  CAST(greatest(floor(greatest(least((y - h / 2) * 180, 180), 0.0)), 0) AS BIGINT) AS y1,
  CAST(least(ceil(greatest(least((x + w / 2) * img_w, img_w), 0.0) - 1), img_w) AS BIGINT) AS x2,
  CAST(least(ceil(greatest(least((y + h / 2) * 180, 180), 0.0) - 1), 180) AS BIGINT) AS y2 FROM boxes)
SELECT image_id, box_id, y1 + 1 AS frame_start, y2 + 1 AS frame_end, round(t.axial_mm, 4) AS axial_start, round(b.axial_mm - t.axial_mm, 4) AS length,
  round((1e-1 * (x1 + 3000)) % 360, 4) AS rotary_start,
  round(CASE WHEN (1e-1 * (x2 + 3000)) % 360 > (1e-1 * (x1 + 3000)) % 360 THEN (1e-1 * (x2 + 3000)) % 360 - (1e-1 * (x1 + 3000)) % 360
    ELSE 360 - (1e-1 * (x1 + 3000)) % 360 + (1e-1 * (x2 + 3000)) % 360 END, 4) AS width
FROM c JOIN axis t ON t.idx = y1 JOIN axis b ON b.idx = y2""",
    ),
)
def box_to_flaw(spark, sf_dir):
    bounds = geometry.pixel_bounds(*[F.col(n) for n in ("x", "y", "w", "h", "img_w")], F.lit(180))
    rows = fx.boxes(spark, sf_dir).select("image_id", "box_id", *[b.alias(n) for b, n in zip(bounds, ("x1", "y1", "x2", "y2"))])
    axis = fx.axis(spark, sf_dir)
    top = axis.select(F.col("idx").alias("y1"), F.col("axial_mm").alias("top"))
    bottom = axis.select(F.col("idx").alias("y2"), F.col("axial_mm").alias("bottom"))
    start, end = pj.rotary_angle(F.col("x1"), F.lit(3000)), pj.rotary_angle(F.col("x2"), F.lit(3000))
    return rows.join(top, "y1").join(bottom, "y2").select(
        "image_id", "box_id", (F.col("y1") + 1).alias("frame_start"), (F.col("y2") + 1).alias("frame_end"),
        F.round("top", 4).alias("axial_start"), F.round(F.col("bottom") - F.col("top"), 4).alias("length"),
        F.round(start, 4).alias("rotary_start"), F.round(geometry.wrapped_extent(start, end), 4).alias("width"),
    )


@query(
    "overlay_rows_p15_p17",
    with_tables(
        "predicted, scans",
        """SELECT p.scan_id, s.scan_name, s.scan_unit, printf('%s %s [D]', p.ind_num, p.flaw_type) AS label, CAST(floor(p.axial_start) AS BIGINT) AS frame_start,
  CAST(ceil(p.axial_start + p.length) AS BIGINT) AS frame_end, p.depth AS flaw_depth, p.confidence FROM predicted p JOIN scans s USING (scan_id)""",
    ),
)
def overlay_rows(spark, sf_dir):
    return fx.predicted(spark, sf_dir).join(fx.scans(spark, sf_dir), "scan_id").select(
        "scan_id", "scan_name", "scan_unit", F.format_string("%s %s [D]", "ind_num", "flaw_type").alias("label"),
        F.floor("axial_start").alias("frame_start"), F.ceil(F.col("axial_start") + F.col("length")).alias("frame_end"),
        F.col("depth").alias("flaw_depth"), "confidence",
    )


@query(
    "sizing_input_p16",
    with_tables(
        "predicted, axis, scans",
        """, a AS (SELECT round(rotary_deg, 1) AS deg, min(idx) AS idx FROM axis GROUP BY 1)
SELECT p.scan_id, p.ind_num, a.idx AS ro_start, CAST(a.idx + p.width * 10 AS BIGINT) AS ro_end,
  substr(s.scan_station, 1, 1) || s.scan_year || s.scan_unit || '1' AS outage
FROM predicted p JOIN a ON a.deg = round(p.rotary_start, 1) JOIN scans s USING (scan_id)""",
    ),
)
def sizing_input(spark, sf_dir):
    tenth = fx.axis(spark, sf_dir).groupBy(F.round("rotary_deg", 1).alias("deg")).agg(F.min("idx").alias("ro_start"))
    rows = fx.predicted(spark, sf_dir).withColumn("deg", F.round("rotary_start", 1))
    return rows.join(tenth, "deg").join(fx.scans(spark, sf_dir), "scan_id").select(
        "scan_id", "ind_num", "ro_start", (F.col("ro_start") + F.col("width") * 10).cast("bigint").alias("ro_end"),
        text.outage_number(F.col("scan_station"), F.col("scan_year"), F.col("scan_unit")).alias("outage"),
    )


@query(
    "eight_bit_p18",
    with_tables(
        "ascans",
        """SELECT scan_id, probe, frame, rotary_idx, list_sum([greatest(least((((x - 128) * 16) >> (CASE WHEN frame < 4 THEN 2 ELSE 3 END)) + 128, 255), 0)
  FOR x IN samples])::DOUBLE AS total FROM ascans""",
    ),
)
def eight_bit(spark, sf_dir):
    twelve = F.transform("samples", lambda x: (x - 128) * 16 + 2048)
    eight = sm.to_eight_bit(twelve, F.when(F.col("frame") < 4, "APC").otherwise("NB1"))
    return fx.ascans(spark, sf_dir).select("scan_id", "probe", "frame", "rotary_idx", sm.total(eight).alias("total"))


@query(
    "inverted_signal_p19_p20",
    with_tables(
        "ascans",
        """, m AS (SELECT *, list_median(samples) AS med, len(samples) AS n FROM ascans)
SELECT scan_id, probe, frame, rotary_idx, med::DOUBLE AS med,
  list_sum([greatest(least(2 * med - x, 255.0), 0.0) FOR x IN samples])::DOUBLE AS inverted,
  round(20 * med + list_sum(samples[21:]), 4)::DOUBLE AS echo_removed FROM m""",
    ),
)
def inverted_signal(spark, sf_dir):
    rows = fx.ascans(spark, sf_dir).withColumn("med", sm.array_median(F.col("samples")))
    med = F.col("med")
    return rows.select(
        "scan_id", "probe", "frame", "rotary_idx", "med", sm.total(sm.inverted(F.col("samples"), med)).alias("inverted"),
        F.round(sm.total(sm.without_first_echo(F.col("samples"), F.lit(0), F.lit(20), med)), 4).alias("echo_removed"),
    )


MAP_SQL = """, m AS (SELECT scan_id, probe, frame, rotary_idx, list_max([abs(x - 128) FOR x IN samples])::DOUBLE AS amp,
  list_position(samples, list_max(samples)) - 1 AS tof FROM ascans)"""


def feature_map(spark, sf_dir):
    """Peak amplitude and its time per position."""
    return fx.ascans(spark, sf_dir).select(
        "scan_id", "probe", "frame", "rotary_idx",
        F.array_max(F.transform("samples", lambda x: F.abs(x - 128))).cast("double").alias("amp"),
        sm.first_argmax(F.col("samples")).alias("tof"),
    )


@query(
    "normalised_map_p21",
    with_tables(
        "ascans",
        f"""{MAP_SQL}
SELECT scan_id, probe, frame, rotary_idx, round(CASE WHEN hi <> lo THEN (amp - lo) / (hi - lo) * 255 END, 4) AS amp255 FROM
 (SELECT *, min(amp) OVER p AS lo, max(amp) OVER p AS hi FROM m WINDOW p AS (PARTITION BY scan_id, probe))""",
    ),
)
def normalised_map(spark, sf_dir):
    scaled = pj.normalise(feature_map(spark, sf_dir), ["scan_id", "probe"], "amp", "amp255")
    return scaled.select("scan_id", "probe", "frame", "rotary_idx", F.round("amp255", 4).alias("amp255"))


@query(
    "resampled_map_p22",
    with_tables(
        "ascans",
        f"""{MAP_SQL},
f AS (SELECT scan_id, frame, rotary_idx, max(amp) AS amp FROM m GROUP BY ALL),
n AS (SELECT scan_id, max(frame) + 1 AS n FROM f GROUP BY 1),
t AS (SELECT scan_id, n, unnest(range(CAST(round_even(n * 0.5 / 0.3, 0) AS BIGINT))) AS t, CAST(round_even(n * 0.5 / 0.3, 0) AS BIGINT) AS mm FROM n),
p AS (SELECT *, greatest(least((t + 0.5) * n / mm - 0.5, n - 1.0), 0.0) AS pos FROM t),
q AS (SELECT scan_id, t, CAST(floor(pos) AS BIGINT) AS lo, least(CAST(floor(pos) AS BIGINT) + 1, n - 1) AS hi, pos - floor(pos) AS share FROM p)
SELECT g.scan_id, g.t AS frame, g.rotary_idx, round(coalesce(a.amp * (1 - share) + b.amp * share, a.amp, b.amp), 4) AS amp
FROM (SELECT DISTINCT q.*, f.rotary_idx FROM q JOIN f ON f.scan_id = q.scan_id AND f.frame IN (lo, hi)) g
LEFT JOIN f a ON a.scan_id = g.scan_id AND a.frame = lo AND a.rotary_idx = g.rotary_idx
LEFT JOIN f b ON b.scan_id = g.scan_id AND b.frame = hi AND b.rotary_idx = g.rotary_idx""",
    ),
)
def resampled_map(spark, sf_dir):
    frames = feature_map(spark, sf_dir).groupBy("scan_id", "frame", "rotary_idx").agg(F.max("amp").alias("amp"))
    out = pj.resample_axial(frames.withColumn("pitch", F.lit(0.5)), ["scan_id"], "pitch", "amp")
    return out.select("scan_id", "frame", "rotary_idx", F.round("amp", 4).alias("amp"))


@query(
    "flaw_window_p23_p24",
    with_tables(
        "ascans, grid_flaws",
        """, w AS (SELECT *, greatest(rotary_start - (rotary_end - rotary_start), 0) AS c0, least(rotary_end + (rotary_end - rotary_start), 64) AS c1,
  frame_start + (frame_end - frame_start) // 2 AS mid FROM grid_flaws),
e AS (SELECT w.scan_id, w.probe, w.flaw_id, CAST(floor(quantile_cont(list_position(a.samples, list_max(a.samples)) - 1, 0.5)) AS BIGINT) AS m
  FROM (SELECT *, unnest([frame_start, mid, frame_end]) AS f FROM w) w JOIN ascans a ON a.scan_id = w.scan_id AND a.probe = w.probe
  AND a.frame = w.f AND a.rotary_idx = w.c0 GROUP BY ALL)
SELECT w.scan_id, w.probe, w.flaw_id, min(e.m) - 50 AS t0, min(e.m) + 250 AS t1, count(*)::BIGINT AS n_ascans,
  round(sum(list_sum([CASE WHEN x / 255.0 * 100 < 40 THEN 0.0 WHEN x / 255.0 * 100 > 55 THEN 100.0
   ELSE (x / 255.0 * 100 - 40) / 15 * 100 END FOR x IN a.samples[greatest(m - 50, 0) + 1:m + 251]])), 2) AS windowed
FROM w JOIN e ON e.scan_id = w.scan_id AND e.probe = w.probe AND e.flaw_id = w.flaw_id
JOIN ascans a ON a.scan_id = w.scan_id AND a.probe = w.probe AND a.frame BETWEEN frame_start AND frame_end AND a.rotary_idx BETWEEN c0 AND c1 - 1
GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3"),
    ),
)
def flaw_window(spark, sf_dir):
    """Neighbourhood of each flaw in rotary and time, windowed to the visible amplitudes."""
    keys = ["scan_id", "probe"]
    c0, c1 = pj.widened_rotary(F.col("rotary_start"), F.col("rotary_end"), F.lit(64))
    flaws = fx.grid_flaws(spark, sf_dir).withColumn("c0", c0).withColumn("c1", c1)
    ascans = fx.ascans(spark, sf_dir)
    probe_frames = F.array("frame_start", F.col("frame_start") + F.expr("(frame_end - frame_start) DIV 2"), "frame_end")
    corners = flaws.select(*keys, "flaw_id", F.col("c0").alias("rotary_idx"), F.explode(probe_frames).alias("frame"))
    echo = corners.join(ascans, [*keys, "frame", "rotary_idx"]).groupBy(*keys, "flaw_id").agg(
        F.floor(F.percentile(sm.first_argmax(F.col("samples")), F.lit(0.5))).alias("m")
    )
    cells = pj.flaw_cells(flaws.join(echo, [*keys, "flaw_id"]), ascans, keys, ["flaw_id", "c0", "c1", "m"])
    inside = cells.where((F.col("rotary_idx") >= F.col("c0")) & (F.col("rotary_idx") < F.col("c1")))
    window = sm.amplitude_window(sm.time_slice(F.col("samples"), F.col("m") - 50, F.col("m") + 250))
    return inside.groupBy(*keys, "flaw_id").agg(
        (F.min("m") - 50).alias("t0"), (F.min("m") + 250).alias("t1"), F.count(F.lit(1)).alias("n_ascans"),
        F.round(F.sum(sm.total(window)), 2).alias("windowed"),
    )


@query(
    "masked_surface_p25",
    with_tables(
        "ascans, grid_flaws",
        f"""{MAP_SQL}
SELECT g.scan_id, g.probe, g.flaw_id, count(*)::BIGINT AS n, round(avg(tof), 6) AS mean_tof FROM grid_flaws g JOIN m ON m.scan_id = g.scan_id AND m.probe = g.probe
 AND m.frame BETWEEN frame_start - 3 AND frame_end + 2 AND m.rotary_idx BETWEEN rotary_start - 7 AND rotary_end + 6
WHERE NOT (m.frame BETWEEN frame_start - 1 AND frame_end AND m.rotary_idx BETWEEN rotary_start - 3 AND rotary_end + 2) GROUP BY 1, 2, 3""",
    ),
)
def masked_surface(spark, sf_dir):
    """Ring of map cells around each flaw: buffer masked out, boundary kept."""
    flaws = fx.grid_flaws(spark, sf_dir)
    reach = flaws.withColumn("f0", F.greatest(F.col("frame_start") - 3, F.lit(0))).withColumn("f1", F.col("frame_end") + 2)
    keys = ["scan_id", "probe"]
    cols = ["flaw_id", "frame_start", "frame_end", "rotary_start", "rotary_end"]
    cells = pj.flaw_cells(reach, feature_map(spark, sf_dir), keys, cols, ("f0", "f1"))
    ring = F.col("rotary_idx").between(F.col("rotary_start") - 7, F.col("rotary_end") + 6)
    core = F.col("frame").between(F.col("frame_start") - 1, F.col("frame_end")) & F.col("rotary_idx").between(
        F.col("rotary_start") - 3, F.col("rotary_end") + 2
    )
    return cells.where(ring & ~core).groupBy(*keys, "flaw_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("tof"), 6).alias("mean_tof")
    )


@query(
    "axial_range_p27_p28",
    with_tables(
        "predicted, scans",
        """, f AS (SELECT scan_id, min(axial_start) AS axial_first, max(axial_start) AS axial_last, count(DISTINCT axial_start)::BIGINT AS num_frames,
  count(DISTINCT rotary_start)::BIGINT AS num_rotary FROM predicted WHERE axial_start BETWEEN 10 AND 120 GROUP BY 1)
SELECT f.scan_id, s.scan_station, axial_first, axial_last, num_frames, num_rotary, printf('%s_A%d-%d', s.scan_name, 10, 120) AS save_name
FROM f JOIN scans s USING (scan_id)""",
    ),
)
def axial_range(spark, sf_dir):
    cut = fx.predicted(spark, sf_dir).where(F.col("axial_start").between(10, 120)).groupBy("scan_id").agg(
        F.min("axial_start").alias("axial_first"), F.max("axial_start").alias("axial_last"),
        F.countDistinct("axial_start").alias("num_frames"), F.countDistinct("rotary_start").alias("num_rotary"),
    )
    return cut.join(fx.scans(spark, sf_dir), "scan_id").select(
        "scan_id", "scan_station", "axial_first", "axial_last", "num_frames", "num_rotary",
        F.format_string("%s_A%d-%d", "scan_name", F.lit(10), F.lit(120)).alias("save_name"),
    )


@query(
    "where_to_look_p29",
    with_tables(
        "predicted, reported",
        """, s AS (SELECT scan_id, ind_num, depth, depth_text, CASE WHEN substr(ind_num, 1, 1) IN ('1', '2') THEN NULL ELSE CAST(axial_start AS BIGINT) END AS ax,
  CASE WHEN substr(ind_num, 1, 1) = '1' THEN CAST(width AS BIGINT) END AS fwg_ax, CAST(length * 10 AS BIGINT) AS frames FROM predicted)
SELECT s.scan_id, s.ind_num, coalesce(ax - 1, fwg_ax - 1, frames // 2) AS frame, r.flaw_type AS matched_type,
  coalesce(s.depth, TRY_CAST(split_part(r.depth_text, ' ', 1) AS DOUBLE)) AS shown_depth
FROM s LEFT JOIN reported r ON r.scan_id = s.scan_id AND r.ind_num = s.ind_num AND r.length > 1.2""",
    ),
)
def where_to_look(spark, sf_dir):
    first = F.substring("ind_num", 1, 1)
    spots = fx.predicted(spark, sf_dir).select(
        "scan_id", "ind_num", "depth", F.when(~first.isin("1", "2"), F.round("axial_start").cast("bigint")).alias("ax"),
        F.when(first == "1", F.col("width").cast("bigint")).alias("fwg_ax"), F.round(F.col("length") * 10).cast("bigint").alias("frames"),
    )
    rep = fx.reported(spark, sf_dir).where("length > 1.2").select(
        "scan_id", "ind_num", F.col("flaw_type").alias("matched_type"), text.to_number(text.first_token(F.col("depth_text"))).alias("rd")
    )
    return spots.join(rep, ["scan_id", "ind_num"], "left").select(
        "scan_id", "ind_num", F.coalesce(F.col("ax") - 1, F.col("fwg_ax") - 1, F.expr("frames DIV 2")).alias("frame"),
        "matched_type", F.coalesce("depth", "rd").alias("shown_depth"),
    )


@query(
    "nested_documents_p30",
    with_tables(
        "reported, scans",
        """SELECT s.scan_id, s.scan_name, 0 AS part, count(r.ind_num)::INTEGER AS n_flaws, coalesce(round(sum(r.length), 4), 0.0) AS total_length
FROM scans s LEFT JOIN reported r USING (scan_id) GROUP BY 1, 2""",
    ),
)
def nested_documents(spark, sf_dir):
    docs = pj.nested_documents(fx.scans(spark, sf_dir), fx.reported(spark, sf_dir), "scan_id", "reported_flaws")
    flaws = F.coalesce("reported_flaws", F.array().cast(docs.schema["reported_flaws"].dataType))
    lengths = F.transform(flaws, lambda f: f["length"])
    return docs.select("scan_id", "scan_name", "part", F.size(flaws).alias("n_flaws"), F.round(sm.total(lengths), 4).alias("total_length"))
