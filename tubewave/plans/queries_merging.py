"""Merging of boxes and flaws, tiles, and the measuring row of a box."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry
from ..operators import merging, pairing
from . import fixtures as fx
from .fixtures import with_tables
from .registry import query


def corner_boxes(spark, sf_dir, scale: float = 1.0):
    x1, y1, x2, y2 = geometry.box_corners(*[F.col(c) for c in ("x", "y", "w", "h")])
    return fx.boxes(spark, sf_dir).select(
        "image_id", "box_id", "cls", F.col("conf"), (x1 * 1000 * scale).alias("x1"), (y1 * 600 * scale).alias("y1"),
        (x2 * 1000 * scale).alias("x2"), (y2 * 600 * scale).alias("y2"),
    )


@query(
    "interval_iou_m1",
    with_tables(
        "boxes",
        """, c AS (SELECT image_id, box_id, x - w / 2 AS a1, x + w / 2 AS a2, y AS b1, y + 0.3 AS b2 FROM boxes)
SELECT image_id, box_id, round(CASE WHEN least(a2, b2) - greatest(a1, b1) > 0 THEN (least(a2, b2) - greatest(a1, b1))
  / ((a2 - a1) + (b2 - b1) - (least(a2, b2) - greatest(a1, b1))) ELSE 0.0 END, 6) AS iou FROM c""",
    ),
)
def interval_iou(spark, sf_dir):
    a1, a2 = F.col("x") - F.col("w") / 2, F.col("x") + F.col("w") / 2
    value = geometry.iou_1d(a1, a2, F.col("y"), F.col("y") + 0.3)
    return fx.boxes(spark, sf_dir).select("image_id", "box_id", F.round(value, 6).alias("iou"))


# SQL that plays a merge on lists: ``b`` holds the boxes of a group in order, each step changes the first pair that joins.
CORNERS_SQL = """, corners AS (SELECT image_id, box_id, cls, conf, (x - w / 2) * 1000 AS x1, (y - h / 2) * 600 AS y1, (x + w / 2) * 1000 AS x2, (y + h / 2) * 600 AS y2 FROM boxes)"""
PAIRS_OF_LIST = "flatten(list_transform(range(1, len(b)), lambda i_: list_transform(range(i_ + 1, len(b) + 1), lambda j_: {'i': i_, 'j': j_})))"


def unite_sql(source: str, group: str, joins: str, second_wins: str) -> str:
    """Recursive SQL of uniting boxes; ``joins`` and ``second_wins`` speak of two boxes ``u`` and ``v``."""
    pair = lambda text: text.replace("u.", "b[p_.i].").replace("v.", "b[p_.j].")
    both = lambda text: text.replace("u.", "u_.").replace("v.", "v_.")
    return f""", steps AS (
  SELECT {group}, list({{'box_id': box_id, 'cls': cls, 'conf': conf, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY box_id) AS b, 0 AS n FROM {source} GROUP BY {group}
  UNION ALL
  SELECT {group}, list_filter(list_transform(b, lambda x, k: CASE WHEN k = keep THEN {{'box_id': x.box_id, 'cls': x.cls, 'conf': x.conf, 'x1': least(u_.x1, v_.x1), 'y1': least(u_.y1, v_.y1),
    'x2': greatest(u_.x2, v_.x2), 'y2': greatest(u_.y2, v_.y2)}} WHEN k <> gone THEN x END), lambda x: x IS NOT NULL), n + 1
  FROM (SELECT *, CASE WHEN {both(second_wins)} THEN j ELSE i END AS keep, CASE WHEN {both(second_wins)} THEN i ELSE j END AS gone
    FROM (SELECT {group}, b, n, f.i AS i, f.j AS j, b[f.i] AS u_, b[f.j] AS v_
      FROM (SELECT {group}, b, n, list_filter({PAIRS_OF_LIST}, lambda p_: {pair(joins)})[1] AS f FROM steps) WHERE f IS NOT NULL))
), united AS (SELECT {group}, unnest(arg_max(b, n), recursive := true) FROM steps GROUP BY {group})"""


X_SHARED = "(least(u.x2, v.x2) - greatest(u.x1, v.x1))"
AREA_SHARED = "(greatest(least(u.x2, v.x2) - greatest(u.x1, v.x1) + {e}, 0.0) * greatest(least(u.y2, v.y2) - greatest(u.y1, v.y1) + {e}, 0.0))"
AREA_OF = "(({b}.x2 - {b}.x1 + {e}) * ({b}.y2 - {b}.y1 + {e}))"
UNION_SQL = f"({AREA_OF.replace('{b}', 'u')} + {AREA_OF.replace('{b}', 'v')} - {AREA_SHARED})"
SHOWN_SQL = "round(x1, 6) AS x1, round(x2, 6) AS x2, round(y1, 6) AS y1, round(y2, 6) AS y2"


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def shown(df, *columns: str):
    return df.select("image_id", "box_id", "cls", "conf", *[F.round(c, 6).alias(c) for c in columns])


@query(
    "merged_frame_boxes_m2",
    recursive(with_tables("boxes", CORNERS_SQL + unite_sql(
        "corners", "image_id, cls", f"{X_SHARED} > 0 AND {X_SHARED} > 0.25 * ((u.x2 - u.x1) + (v.x2 - v.x1) - {X_SHARED})", "v.conf > u.conf",
    ) + " SELECT image_id, box_id, cls, conf, round(x1, 6) AS x1, round(x2, 6) AS x2 FROM united".replace("cls,", "united.cls,"))),
)
def merged_frame_boxes(spark, sf_dir):
    boxes = corner_boxes(spark, sf_dir).drop("y1", "y2")
    return shown(merging.merge_frame_boxes(boxes, ["image_id"], 0.25, same_class=True), "x1", "x2")


@query(
    "merged_tile_boxes_m3",
    recursive(with_tables("boxes", CORNERS_SQL + ", whole AS (SELECT image_id, box_id, cls, conf, floor(x1) AS x1, floor(y1) AS y1, floor(x2) AS x2, floor(y2) AS y2 FROM corners)" + unite_sql(
        "whole", "image_id, cls",
        f"({AREA_SHARED} / {UNION_SQL} >= 0.3 OR {AREA_SHARED} / least({AREA_OF.replace('{b}', 'u')}, {AREA_OF.replace('{b}', 'v')}) >= 0.9)".replace("{e}", "1"), "v.conf >= u.conf",
    ) + f" SELECT image_id, box_id, united.cls, conf, {SHOWN_SQL} FROM united")),
)
def merged_tile_boxes(spark, sf_dir):
    boxes = corner_boxes(spark, sf_dir)
    whole = boxes.select("image_id", "box_id", "cls", "conf", *[F.floor(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    return shown(merging.merge_tile_boxes(whole, ["image_id"], 0.3, 0.9), "x1", "x2", "y1", "y2")


NMS_SQL = CORNERS_SQL + f""", walk AS (
  SELECT image_id, cls, list({{'box_id': box_id, 'score': conf, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY conf DESC, box_id DESC) AS b, 0 AS n,
    list({{'box_id': box_id, 'score': conf, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}}) FILTER (FALSE) AS kept FROM corners WHERE conf > 0.1 GROUP BY image_id, cls
  UNION ALL
  SELECT image_id, cls, b, n + 1, CASE WHEN len(list_filter(coalesce(kept, []), lambda u_: {AREA_SHARED} / {UNION_SQL} > 0.45)) = 0 THEN list_append(kept, b[n + 1]) ELSE kept END
  FROM walk WHERE n < len(b)
), stayed AS (SELECT image_id, cls, unnest(kept, recursive := true) FROM walk WHERE n = len(b))
SELECT image_id, box_id, cls, score, {SHOWN_SQL} FROM stayed""".replace("{e}", "1").replace("u.", "u_.").replace("v.", "b[n + 1].")


@query("suppressed_boxes_m4", recursive(with_tables("boxes", NMS_SQL)))
def suppressed_boxes(spark, sf_dir):
    boxes = corner_boxes(spark, sf_dir).withColumnRenamed("conf", "score")
    kept = merging.suppress_overlaps(boxes, ["image_id"], 0.45, 0.1)
    return kept.select("image_id", "box_id", "cls", "score", *[F.round(c, 6).alias(c) for c in ("x1", "x2", "y1", "y2")])


FLAW_IOU_SQL = f"({AREA_SHARED} / {UNION_SQL})".replace("{e}", "0")
FLAWS_SQL = f""", f AS (SELECT scan_id, ind_num AS flaw_id, flaw_type, confidence, rotary_start AS x1, rotary_start + width AS x2, axial_start AS y1, axial_start + length AS y2 FROM predicted),
lists AS (SELECT scan_id, list({{'flaw_id': flaw_id, 'flaw_type': flaw_type, 'confidence': confidence, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} ORDER BY flaw_id) AS b FROM f GROUP BY scan_id),
walk AS (
  SELECT scan_id, list_filter({PAIRS_OF_LIST}, lambda p_: {FLAW_IOU_SQL.replace('u.', 'b[p_.i].').replace('v.', 'b[p_.j].')} >= 0.5) AS e, 0 AS n,
    list_transform(b, lambda x: {{'flaw_id': x.flaw_id, 'flaw_type': x.flaw_type, 'confidence': x.confidence, 'names': [x.flaw_type], 'here': TRUE}}) AS b FROM lists
  UNION ALL
  SELECT scan_id, e, n + 1, CASE WHEN b[e[n + 1].i].here AND b[e[n + 1].j].here THEN list_transform(b, lambda x, k: CASE WHEN k = e[n + 1].i OR k = e[n + 1].j THEN
      {{'flaw_id': x.flaw_id, 'flaw_type': CASE WHEN (k = e[n + 1].i) = (b[e[n + 1].i].confidence > b[e[n + 1].j].confidence) THEN 'Note 1 - overlapped' ELSE x.flaw_type END,
        'confidence': x.confidence, 'names': list_sort(list_distinct(list_filter(list_concat(b[e[n + 1].i].names, b[e[n + 1].j].names, [b[e[n + 1].i].flaw_type, b[e[n + 1].j].flaw_type]),
          lambda t: t <> 'Note 1 - overlapped'))), 'here': (k = e[n + 1].i) = (b[e[n + 1].i].confidence > b[e[n + 1].j].confidence)}} ELSE x END) ELSE b END
  FROM walk WHERE n < len(e)
), left_over AS (SELECT scan_id, unnest(b, recursive := true) FROM walk WHERE n = len(e))
SELECT scan_id, flaw_id, flaw_type, confidence, array_to_string(list_sort(names), '|') AS categories FROM left_over WHERE here"""


@query("overlapping_flaws_m5", recursive(with_tables("predicted", FLAWS_SQL)))
def overlapping_flaws(spark, sf_dir):
    flaws = fx.predicted(spark, sf_dir).select(
        "scan_id", F.col("ind_num").alias("flaw_id"), "flaw_type", "confidence", F.col("rotary_start").alias("x_start"),
        (F.col("rotary_start") + F.col("width")).alias("x_end"), F.col("axial_start").alias("y_start"),
        (F.col("axial_start") + F.col("length")).alias("y_end"), F.array("flaw_type").alias("possible_category"),
    )
    united = merging.unite_overlapping_flaws(flaws, ["scan_id"], 0.5)
    return united.select("scan_id", "flaw_id", "flaw_type", "confidence", F.array_join(F.array_sort("possible_category"), "|").alias("categories"))


EDGE_SQL = """, e AS (SELECT scan_id, ind_num, CASE WHEN contains(flaw_type, 'Debris') THEN 'Scrape' ELSE 'CC' END AS flaw_type, axial_start, length,
  CASE WHEN CAST(rotary_start * 100 AS BIGINT) % 2 = 0 THEN 0.5e0 ELSE 360 - width END AS rotary_start, width, depth, confidence FROM predicted),
g AS (SELECT *, axial_start + length AS axial_end FROM e WHERE scan_id IN (SELECT scan_id FROM e WHERE flaw_type = 'Scrape' AND (rotary_start <= 1 OR rotary_start + width >= 359))),
a AS (SELECT scan_id, flaw_type, axial_start AS s, axial_end AS e, min(ind_num) AS ind FROM g WHERE rotary_start <= 1 GROUP BY ALL),
b AS (SELECT scan_id, flaw_type, axial_start AS s, axial_end AS e, min(ind_num) AS ind FROM g WHERE abs(rotary_start + width - 360) <= 1 GROUP BY ALL),
p AS (SELECT a.scan_id, a.flaw_type, a.ind AS a_ind, b.ind AS b_ind FROM a JOIN b ON a.scan_id = b.scan_id AND a.flaw_type = b.flaw_type
  AND abs(a.s - b.s) <= 5 AND abs(a.e - b.e) <= 5 AND a.ind <> b.ind),
fb AS (SELECT scan_id, flaw_type, a_ind, min(b_ind) AS b_ind FROM p GROUP BY ALL), fa AS (SELECT scan_id, flaw_type, b_ind, min(a_ind) AS a_ind FROM p GROUP BY ALL),
m AS (SELECT fb.scan_id, fb.a_ind, fb.b_ind FROM fb JOIN fa USING (scan_id, flaw_type, a_ind, b_ind)),
r AS (SELECT m.scan_id, coalesce(y.depth > x.depth, x.depth IS NULL AND y.depth IS NOT NULL) AS b_wins, a_ind, b_ind,
  least(x.axial_start, y.axial_start) AS axial_start, greatest(x.axial_start + x.length, y.axial_start + y.length) - least(x.axial_start, y.axial_start) AS length,
  y.rotary_start, 360 - y.rotary_start + x.rotary_start + x.width AS width, (x.confidence + y.confidence) / 2 AS confidence
  FROM m JOIN e x ON x.scan_id = m.scan_id AND x.ind_num = a_ind JOIN e y ON y.scan_id = m.scan_id AND y.ind_num = b_ind),
k AS (SELECT *, CASE WHEN b_wins THEN b_ind ELSE a_ind END AS ind_num, CASE WHEN b_wins THEN a_ind ELSE b_ind END AS merged_id FROM r)
SELECT e.scan_id, e.ind_num, round(coalesce(k.axial_start, e.axial_start), 6) AS axial_start, round(coalesce(k.length, e.length), 6) AS length,
  round(coalesce(k.rotary_start, e.rotary_start), 6) AS rotary_start, round(coalesce(k.width, e.width), 6) AS width,
  round(coalesce(k.confidence, e.confidence), 6) AS confidence, k.merged_id
FROM e LEFT JOIN k USING (scan_id, ind_num) WHERE NOT EXISTS (SELECT 1 FROM k z WHERE z.scan_id = e.scan_id AND z.merged_id = e.ind_num)"""


@query("merged_across_zero_m6", with_tables("predicted", EDGE_SQL))
def merged_across_zero(spark, sf_dir):
    even = F.round(F.col("rotary_start") * 100).cast("bigint") % 2 == 0
    flaws = fx.predicted(spark, sf_dir).select(
        "scan_id", "ind_num", F.when(F.contains("flaw_type", F.lit("Debris")), "Scrape").otherwise("CC").alias("flaw_type"), "axial_start",
        "length", F.when(even, F.lit(0.5)).otherwise(360 - F.col("width")).alias("rotary_start"), "width", "depth", "confidence",
    )
    out = merging.merge_across_zero(flaws, ["scan_id"], 5.0, 1.0)
    shown = ["axial_start", "length", "rotary_start", "width", "confidence"]
    return out.select("scan_id", "ind_num", *[F.round(c, 6).alias(c) for c in shown], "merged_id")


@query(
    "united_v_mr_m7",
    recursive(with_tables("boxes", CORNERS_SQL + ", v_and_mr AS (SELECT * FROM corners WHERE cls IN ('V', 'MR'))" + unite_sql(
        "v_and_mr", "image_id", f"({AREA_SHARED} > 0 AND {AREA_SHARED} >= 0.1 * {UNION_SQL})".replace("{e}", "0"), "v.conf > u.conf",
    ) + f""" SELECT image_id, box_id, cls, conf, {SHOWN_SQL} FROM united
  UNION ALL SELECT image_id, box_id, cls, conf, {SHOWN_SQL} FROM corners WHERE cls NOT IN ('V', 'MR')""")),
)
def united_v_mr(spark, sf_dir):
    return shown(merging.unite_v_and_mr(corner_boxes(spark, sf_dir), ["image_id"], 0.1), "x1", "x2", "y1", "y2")


LEVELS_SQL = CORNERS_SQL + """, l AS (SELECT image_id, box_id, floor((y1 + y2) / 2) AS m, floor(y1) AS f, floor(y2) AS e, x1 AS left_x FROM corners),
walk AS (
  SELECT image_id, list({'box_id': box_id, 'm': m, 'f': f, 'e': e, 'left_x': left_x} ORDER BY m, box_id) AS b, 0 AS n,
    list({'box_id': box_id, 'left_x': left_x, 'm': [m, m], 'f': [f, f], 'e': [e, e]}) FILTER (FALSE) AS g FROM l GROUP BY image_id
  UNION ALL
  SELECT image_id, b, n + 1, CASE WHEN spot IS NULL THEN list_append(g, {'box_id': x.box_id, 'left_x': x.left_x, 'm': [x.m, x.m], 'f': [x.f, x.f], 'e': [x.e, x.e]})
    ELSE list_transform(g, lambda y, k: CASE WHEN k = spot THEN {'box_id': CASE WHEN x.left_x < y.left_x THEN x.box_id ELSE y.box_id END, 'left_x': least(x.left_x, y.left_x),
      'm': [least(y.m[1], x.m), greatest(y.m[2], x.m)], 'f': [least(y.f[1], x.f), greatest(y.f[2], x.f)], 'e': [least(y.e[1], x.e), greatest(y.e[2], x.e)]} ELSE y END) END
  FROM (SELECT image_id, b, n, g, b[n + 1] AS x, list_filter(range(1, coalesce(len(g), 0) + 1), lambda k: b[n + 1].m - g[k].m[1] <= 5 AND g[k].m[2] - b[n + 1].m <= 5
    AND b[n + 1].f - g[k].f[1] <= 3 AND g[k].f[2] - b[n + 1].f <= 3 AND b[n + 1].e - g[k].e[1] <= 3 AND g[k].e[2] - b[n + 1].e <= 3)[1] AS spot FROM walk WHERE n < len(b))
), groups AS (SELECT image_id, unnest(list_transform(g, lambda y: y.box_id)) AS box_id FROM walk WHERE n = len(b))
SELECT image_id, box_id, m::BIGINT AS middle_y, round(left_x, 6) AS left_x FROM groups JOIN l USING (image_id, box_id)"""


@query("box_levels_m8", recursive(with_tables("boxes", LEVELS_SQL)))
def box_levels(spark, sf_dir):
    boxes = corner_boxes(spark, sf_dir).select(
        "image_id", "box_id", F.floor((F.col("y1") + F.col("y2")) / 2).alias("middle_y"), F.floor("y1").alias("first_y"),
        F.floor("y2").alias("last_y"), F.col("x1").alias("left_x"),
    )
    return merging.representative_levels(boxes, ["image_id"]).select("image_id", "box_id", "middle_y", F.round("left_x", 6).alias("left_x"))


ROWS_SQL = """, p AS (SELECT *, row_number() OVER (PARTITION BY image_id, box_id ORDER BY y) - 1 AS i, count(*) OVER (PARTITION BY image_id, box_id) AS n FROM box_rows),
sx AS (SELECT image_id, box_id, max_x, row_number() OVER (PARTITION BY image_id, box_id ORDER BY max_x) - 1 AS i FROM box_rows),
q AS (SELECT p.image_id, p.box_id, max(CASE WHEN sx.i = n // 4 THEN sx.max_x END) AS q1, max(CASE WHEN sx.i = 3 * n // 4 THEN sx.max_x END) AS q3
  FROM (SELECT DISTINCT image_id, box_id, n FROM p) p JOIN sx USING (image_id, box_id) GROUP BY 1, 2),
m AS (SELECT p.image_id, p.box_id, any_value(cls) AS cls, any_value(n) AS n, any_value(x1) AS x1, any_value(x2) AS x2, max(CASE WHEN i = n // 2 THEN max_x END) AS mid,
  avg(CASE WHEN i >= n // 4 AND i < n - n // 4 THEN max_x END) AS mean_mid, max(max_x) AS hi, max(CASE WHEN max_x <= q3 + (q3 - q1) THEN max_x END) AS fenced
  FROM p JOIN q USING (image_id, box_id) GROUP BY 1, 2),
x AS (SELECT image_id, box_id, cls, n, CASE cls WHEN 'V' THEN CASE WHEN mid > x1 + (x2 - x1) / 2 THEN x1 + (x2 - x1) / 4 ELSE mid END WHEN 'MR' THEN mean_mid
  WHEN 'Spaghetti' THEN fenced ELSE hi END::DOUBLE AS x FROM m)"""


@query(
    "measured_boxes_m9",
    with_tables("box_rows", f"""{ROWS_SQL} SELECT image_id, box_id, cls, n::INTEGER AS n_rows, round(x, 6) AS x FROM x"""),
)
def measured_boxes(spark, sf_dir):
    return merging.measured_rows(fx.box_rows(spark, sf_dir), ["image_id"]).select("image_id", "box_id", "cls", "n_rows", F.round("x", 6).alias("x"))


@query(
    "deepest_box_m9_a19",
    with_tables(
        "box_rows",
        f"""{ROWS_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY x DESC, box_id) AS rk, count(*) OVER (PARTITION BY image_id) AS total FROM x),
me AS (SELECT image_id, box_id, (max(y) - min(y) + 1) AS height, avg(max_value) AS avg_value, any_value(x2) - any_value(x1) AS width FROM box_rows GROUP BY 1, 2)
SELECT image_id, box_id, cls, round(x, 6) AS x, total::BIGINT AS total_bboxes, (height * width)::BIGINT AS area, greatest(height, width)::BIGINT AS length,
  round(avg_value, 6) AS avg_value FROM t JOIN me USING (image_id, box_id) WHERE rk = 1""",
    ),
)
def deepest_box(spark, sf_dir):
    rows = fx.box_rows(spark, sf_dir)
    best = merging.deepest_box(merging.measured_rows(rows, ["image_id"]), ["image_id"]).drop("y")
    metrics = merging.box_metrics(rows, ["image_id"]).select("image_id", "box_id", "area", "length", F.round("avg_value", 6).alias("avg_value"))
    return best.join(metrics, ["image_id", "box_id"]).withColumn("x", F.round("x", 6))


@query(
    "usable_detections_m10",
    with_tables(
        "boxes",
        """SELECT image_id, box_id, cls, round((x - w / 2) * 1000 + CASE WHEN cls = 'MR' THEN 10 ELSE 0 END, 4) AS x1 FROM boxes
WHERE conf >= 0.1 AND NOT (cls = 'Spaghetti' AND conf < 0.5)""",
    ),
)
def usable_detections(spark, sf_dir):
    boxes = corner_boxes(spark, sf_dir).withColumn("cls", F.when(F.col("cls") == "MR", "default").otherwise(F.col("cls")))
    out = merging.usable_detections(boxes)
    return out.select("image_id", "box_id", F.when(F.col("cls") == "default", "MR").otherwise(F.col("cls")).alias("cls"), F.round("x1", 4).alias("x1"))


@query(
    "class_counts_a20",
    with_tables(
        "boxes",
        """, c AS (SELECT image_id, cls, count(*) AS n FROM boxes GROUP BY 1, 2)
SELECT image_id, string_agg(cls || '=' || n, ';' ORDER BY cls) AS counts FROM c GROUP BY 1""",
    ),
)
def class_counts(spark, sf_dir):
    counts = merging.class_counts(fx.boxes(spark, sf_dir), ["image_id"])
    text = F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ";")
    return counts.select("image_id", text.alias("counts"))


@query(
    "boxes_on_tiles_j13_x12",
    with_tables(
        "boxes",
        """, c AS (SELECT image_id, box_id, (x - w / 2) * 1000 AS x1, (x + w / 2) * 1000 AS x2, (y - h / 2) * 600 AS y1, (y + h / 2) * 600 AS y2 FROM boxes),
ty AS (SELECT range AS tile_y FROM range(0, 401, 100)), tx AS (SELECT range AS tile_x FROM range(0, 801, 100))
SELECT image_id, box_id, tile_x, tile_y, round(greatest(x1 - tile_x, 0), 4) AS tx1, round(least(x2 - tile_x, 200), 4) AS tx2, round(greatest(y1 - tile_y, 0), 4) AS ty1,
  round(least(y2 - tile_y, 200), 4) AS ty2, round(greatest(x1 - tile_x, 0) + tile_x, 4) AS map_x1 FROM c, tx, ty
WHERE least(x2 - tile_x, 200) > greatest(x1 - tile_x, 0) AND least(y2 - tile_y, 200) > greatest(y1 - tile_y, 0)""",
    ),
)
def boxes_on_tiles(spark, sf_dir):
    boxes = corner_boxes(spark, sf_dir).withColumn("last_x", F.lit(800)).withColumn("last_y", F.lit(400))
    cut = merging.boxes_on_tiles(boxes, ["image_id"], 200, 100)
    back = F.round(F.col("tx1") + F.col("tile_x"), 4).alias("map_x1")
    return cut.select("image_id", "box_id", "tile_x", "tile_y", *[F.round(c, 4).alias(c) for c in ("tx1", "tx2", "ty1", "ty2")], back)


@query(
    "tile_origins_x12",
    with_tables(
        "scans",
        """, i AS (SELECT scan_id, 200 + scan_unit * 40 AS h, 500 + scan_unit * 10 AS w FROM scans),
t AS (SELECT scan_id, unnest(list_distinct(list_append(range(0, greatest(h - 256, 0) + 1, 128), greatest(h - 256, 0)))) AS tile_y, w FROM i)
SELECT scan_id, tile_y, unnest(list_distinct(list_append(range(0, greatest(w - 256, 0) + 1, 128), greatest(w - 256, 0)))) AS tile_x FROM t""",
    ),
)
def tile_origins(spark, sf_dir):
    images = fx.scans(spark, sf_dir).select(
        "scan_id", (200 + F.col("scan_unit") * 40).cast("bigint").alias("h"), (500 + F.col("scan_unit") * 10).cast("bigint").alias("w")
    )
    return merging.tiles(images, ["scan_id"], "h", "w", 256, 128)


@query(
    "scan_pairs_j14",
    with_tables(
        "scans",
        """, k AS (SELECT *, regexp_replace(scan_name, 'Type [AD]', '') AS pair FROM (SELECT scan_id, scan_name, scan_unit FROM scans
  UNION ALL SELECT -scan_id - 1, replace(scan_name, 'Type A', 'Type D'), scan_unit FROM scans WHERE contains(scan_name, 'Type A')))
SELECT a.scan_id AS scan_a, d.scan_id AS scan_d FROM k a LEFT JOIN k d ON d.pair = a.pair AND contains(d.scan_name, 'Type D') WHERE contains(a.scan_name, 'Type A')""",
    ),
)
def scan_pairs(spark, sf_dir):
    scans = fx.scans(spark, sf_dir).select("scan_id", "scan_name", "scan_unit")
    type_d = scans.where(F.contains("scan_name", F.lit("Type A"))).select(
        (-F.col("scan_id") - 1).alias("scan_id"), F.replace("scan_name", F.lit("Type A"), F.lit("Type D")).alias("scan_name"), "scan_unit"
    )
    return pairing.pair_scans(scans.unionByName(type_d))
