"""Matching of predicted with reported flaws and the statistics built on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import matching, statistics
from ..session import cut_lineage
from .fixtures import predicted, reported, with_tables
from .registry import query

KEYS = ["scan_id"]

# SQL building blocks shared by several checks.
IOU_SQL = """
greatest(least(p.rotary_start + p.width, r.rotary_start + r.width) - greatest(p.rotary_start, r.rotary_start), 0.0)
* greatest(least(p.axial_start + p.length, r.axial_start + r.length) - greatest(p.axial_start, r.axial_start), 0.0)
"""
PAIRS_SQL = f"""
shared AS (SELECT p.scan_id, p.ind_num AS p_ind, r.ind_num AS r_ind, {IOU_SQL} AS shared,
  p.width * p.length AS p_area, r.width * r.length AS r_area FROM predicted p JOIN reported r USING (scan_id)),
pairs AS (SELECT scan_id, p_ind, r_ind, shared / (p_area + r_area - shared) AS iou FROM shared)
"""
P_BEST_SQL = """
p_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scan_id, p_ind ORDER BY iou DESC, r_ind) AS rn
  FROM pairs WHERE iou >= 0.2) WHERE rn = 1)
"""
R_BEST_SQL = """
r_best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scan_id, r_ind ORDER BY iou DESC, p_ind) AS rn
  FROM pairs WHERE iou > 0) WHERE rn = 1)
"""


BOX = matching.BoxColumns().names()


def matched_predicted(spark, sf_dir, columns, payload):
    """Predicted boxes, with further columns, and the reported flaw that each overlaps most, with its payload."""
    flaws = predicted(spark, sf_dir).select(*KEYS, *BOX, *columns)
    return matching.best_match(flaws, reported(spark, sf_dir), KEYS, payload=payload, min_iou=0.2)


def matched_reported(spark, sf_dir, columns, payload):
    """Reported boxes, with further columns, and the predicted flaw that each overlaps most, with its payload."""
    flaws = reported(spark, sf_dir).select(*KEYS, *BOX, *columns)
    return matching.best_match(flaws, predicted(spark, sf_dir), KEYS, payload=payload)


@query(
    "depth_agreement_by_type",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL}, {P_BEST_SQL},
errors AS (SELECT r.flaw_type, round(
    TRY_CAST(trim(replace(replace(split_part(r.depth_text, '(', 1), '<', ''), '*', '')) AS DOUBLE)
  - TRY_CAST(trim(replace(replace(split_part(p.depth_text, '(', 1), '<', ''), '*', '')) AS DOUBLE), 4) AS err
  FROM p_best b JOIN predicted p ON p.scan_id = b.scan_id AND p.ind_num = b.p_ind
  JOIN reported r ON r.scan_id = b.scan_id AND r.ind_num = b.r_ind),
levels AS (SELECT flaw_type, err FROM errors UNION ALL SELECT 'ALL', err FROM errors)
SELECT flaw_type, round(avg(abs(err)), 9) AS mean_abs, 2 * round(stddev_pop(err), 9) AS two_sigma,
  round(avg(err), 9) AS mean, round(quantile_cont(err, 0.5), 9) AS median, count(*)::BIGINT AS n
FROM levels WHERE err IS NOT NULL GROUP BY flaw_type""",
    ),
)
def depth_agreement_by_type(spark, sf_dir):
    matched = matched_predicted(spark, sf_dir, ["depth_text"], ["flaw_type", "depth_text"]).where("match IS NOT NULL")
    errors = matched.select(
        F.col("match.flaw_type").alias("flaw_type"),
        F.round(text.parse_measure(F.col("match.depth_text")) - text.parse_measure(F.col("depth_text")), 4).alias("err"),
    )
    # two columns that quantiles and moments read several times
    return statistics.error_statistics(cut_lineage(errors, "errors"), "flaw_type", "err")


@query(
    "predicted_to_reported_j1",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL}, {P_BEST_SQL}
SELECT scan_id, p_ind AS ind_num, r_ind AS reported_id, round(iou, 6) AS iou FROM p_best""",
    ),
)
def predicted_to_reported(spark, sf_dir):
    return matched_predicted(spark, sf_dir, ["ind_num"], []).where("match IS NOT NULL").select(
        "scan_id", "ind_num", F.col("match._order").alias("reported_id"), F.round("iou", 6).alias("iou")
    )


DEPTH_DIFF_SQL = """
CASE WHEN r.depth_text LIKE '%<%' THEN CASE WHEN p.num < 0.1 THEN 0.0 ELSE p.num - 0.1 END
     WHEN r.depth_text LIKE '%>%' THEN NULL
     ELSE TRY_CAST(trim(r.depth_text) AS DOUBLE) - p.num END
"""
PLAIN_TYPE_SQL = (
    "CASE WHEN contains({b}, '(') THEN trim(split_part({b}, '(', 1)) ELSE {b} END".replace(
        "{b}", "regexp_replace(regexp_replace(upper({t}), '^BM_', ''), '^EM_', '')"
    )
)
REPORTED_METRICS_SQL = f""", {PAIRS_SQL}, {R_BEST_SQL},
pnum AS (SELECT *, TRY_CAST(trim(split_part(depth_text, '(', 1)) AS DOUBLE) AS num FROM predicted),
metrics AS (SELECT r.scan_id, r.ind_num, coalesce(b.p_ind, 'NA') AS pred_ind_num, b.p_ind IS NOT NULL AS is_predicted,
  round(b.iou, 6) AS iou, r.flaw_type, r.depth_text AS depth_reported, p.depth_text AS pred_depth,
  {PLAIN_TYPE_SQL.replace('{t}', 'r.flaw_type')} = {PLAIN_TYPE_SQL.replace('{t}', 'p.flaw_type')} AS is_classified_correct,
  round(abs(r.width - p.width), 6) AS width_diff, round(abs(r.length - p.length), 6) AS length_diff,
  round(abs(r.rotary_start - p.rotary_start), 6) AS position_x_diff,
  round(abs(r.axial_start - p.axial_start), 6) AS position_y_diff,
  CASE WHEN b.p_ind IS NOT NULL THEN round({DEPTH_DIFF_SQL}, 6) END AS depth_diff
  FROM reported r LEFT JOIN r_best b ON b.scan_id = r.scan_id AND b.r_ind = r.ind_num
  LEFT JOIN pnum p ON p.scan_id = b.scan_id AND p.ind_num = b.p_ind)
"""


#: Differences between a reported flaw and its prediction, and the column they compare.
BOX_DIFFERENCES = {"width_diff": "width", "length_diff": "length", "position_x_diff": "rotary_start", "position_y_diff": "axial_start"}


def reported_metrics(spark, sf_dir, names=None):
    """Every reported flaw with its best prediction and the differences between the two; only columns of the wanted ones travel."""
    m = F.col("match")
    shown = {
        "scan_id": F.col("scan_id"),
        "ind_num": F.col("ind_num"),
        "pred_ind_num": F.coalesce(m["_order"], F.lit("NA")),
        "is_predicted": m.isNotNull(),
        "iou": F.round("iou", 6),
        "flaw_type": F.col("flaw_type"),
        "depth_reported": F.col("depth_text"),
        "pred_depth": m["depth_text"],
        "is_classified_correct": text.plain_flaw_type(F.col("flaw_type")) == text.plain_flaw_type(m["flaw_type"]),
        **{name: F.round(F.abs(F.col(c) - m[c]), 6) for name, c in BOX_DIFFERENCES.items()},
        "depth_diff": F.when(m.isNotNull(), F.round(text.depth_difference(F.col("depth_text"), m["depth_text"]), 6)),
    }
    wanted = list(shown) if names is None else names
    payload = ["depth_text", *[c for name, c in BOX_DIFFERENCES.items() if name in wanted], *(["flaw_type"] if "is_classified_correct" in wanted else [])]
    return matched_reported(spark, sf_dir, ["ind_num", "flaw_type", "depth_text"], payload).select(*[shown[n].alias(n) for n in wanted])


@query(
    "reported_to_predicted_j2_f5_f6",
    with_tables("predicted, reported", f"{REPORTED_METRICS_SQL} SELECT * FROM metrics"),
)
def reported_to_predicted(spark, sf_dir):
    return reported_metrics(spark, sf_dir)


@query(
    "label_to_best_prediction_j3",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL},
best AS (SELECT *, row_number() OVER (PARTITION BY scan_id, r_ind ORDER BY iou DESC, p_ind) AS rn FROM pairs)
SELECT scan_id, r_ind AS ind_num, p_ind AS pred_ind_num, round(iou, 6) AS iou, iou > 0.1 AS detected
FROM best WHERE rn = 1""",
    ),
)
def label_to_best_prediction(spark, sf_dir):
    flaws = reported(spark, sf_dir).select(*KEYS, *BOX, "ind_num")
    matched = matching.best_match_or_first(flaws, predicted(spark, sf_dir), KEYS)
    return matched.where("match IS NOT NULL").select(
        "scan_id",
        "ind_num",
        F.col("match._order").alias("pred_ind_num"),
        F.round("iou", 6).alias("iou"),
        (F.col("iou") > 0.1).alias("detected"),
    )


@query(
    "false_calls_j4",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL}, {R_BEST_SQL}
SELECT scan_id, ind_num, flaw_type AS pred_flaw_type, depth_text AS pred_depth, axial_start, rotary_start, length, width
FROM predicted p WHERE NOT EXISTS (SELECT 1 FROM r_best b WHERE b.scan_id = p.scan_id AND b.p_ind = p.ind_num)""",
    ),
)
def false_call_table(spark, sf_dir):
    extra = matching.false_calls(predicted(spark, sf_dir), matched_reported(spark, sf_dir, [], []), KEYS)
    return extra.select(
        "scan_id", "ind_num", F.col("flaw_type").alias("pred_flaw_type"), F.col("depth_text").alias("pred_depth"),
        "axial_start", "rotary_start", "length", "width",
    )


@query(
    "overcalls_f15",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL}, {R_BEST_SQL},
extra AS (SELECT depth_text, split_part(depth_text, ' ', 1) AS head FROM predicted p
  WHERE NOT EXISTS (SELECT 1 FROM r_best b WHERE b.scan_id = p.scan_id AND b.p_ind = p.ind_num)),
reasons AS (SELECT CASE WHEN depth_text IS NULL THEN 'null' WHEN contains(depth_text, '<') THEN 'low'
  WHEN TRY_CAST(head AS DOUBLE) < 0.1 THEN 'low' WHEN TRY_CAST(depth_text AS DOUBLE) IS NULL THEN 'text'
  ELSE 'valid' END AS reason FROM extra)
SELECT reason, count(*)::BIGINT AS n FROM reasons GROUP BY reason""",
    ),
)
def overcalls(spark, sf_dir):
    extra = matching.false_calls(predicted(spark, sf_dir), matched_reported(spark, sf_dir, [], []), KEYS)
    reason = text.overcall_reason(F.lit(len(extra.columns)), F.col("depth_text"))
    return extra.select(reason.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "flaw_deltas_j5",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL}, {P_BEST_SQL}
SELECT p.scan_id, p.ind_num, p.flaw_type, r.flaw_type AS reported_type, round(p.axial_start - r.axial_start, 6) AS axial_delta,
  round(p.rotary_start - r.rotary_start, 6) AS rotary_delta, round(p.length - r.length, 6) AS length_delta,
  round(p.width - r.width, 6) AS width_delta, b.p_ind IS NOT NULL AS detected
FROM predicted p LEFT JOIN p_best b ON b.scan_id = p.scan_id AND b.p_ind = p.ind_num
LEFT JOIN reported r ON r.scan_id = b.scan_id AND r.ind_num = b.r_ind""",
    ),
)
def flaw_deltas(spark, sf_dir):
    rep = reported(spark, sf_dir).alias("r")
    pred = matched_predicted(spark, sf_dir, ["ind_num", "flaw_type"], []).withColumn("reported_id", F.col("match._order")).alias("p")
    joined = pred.join(rep, (F.col("p.scan_id") == F.col("r.scan_id")) & (F.col("p.reported_id") == F.col("r.ind_num")), "left")
    deltas = {"axial_delta": "axial_start", "rotary_delta": "rotary_start", "length_delta": "length", "width_delta": "width"}
    return joined.select(
        "p.scan_id", "p.ind_num", "p.flaw_type", F.col("r.flaw_type").alias("reported_type"),
        *[F.round(F.col(f"p.{c}") - F.col(f"r.{c}"), 6).alias(n) for n, c in deltas.items()],
        F.col("reported_id").isNotNull().alias("detected"),
    )


@query(
    "reported_detection_j6",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL}, {P_BEST_SQL}
SELECT r.scan_id, r.ind_num, count(b.p_ind)::BIGINT AS n_predictions, count(b.p_ind) > 0 AS detected,
  coalesce(bool_or({PLAIN_TYPE_SQL.replace('{t}', 'r.flaw_type')} = {PLAIN_TYPE_SQL.replace('{t}', 'p.flaw_type')}), FALSE)
  AS classified
FROM reported r LEFT JOIN p_best b ON b.scan_id = r.scan_id AND b.r_ind = r.ind_num
LEFT JOIN predicted p ON p.scan_id = b.scan_id AND p.ind_num = b.p_ind GROUP BY r.scan_id, r.ind_num""",
    ),
)
def reported_detection(spark, sf_dir):
    hits = (
        matched_predicted(spark, sf_dir, ["flaw_type"], ["flaw_type"])
        .where("match IS NOT NULL")
        .groupBy("scan_id", F.col("match._order").alias("ind_num"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(text.plain_flaw_type(F.col("flaw_type")) == text.plain_flaw_type(F.col("match.flaw_type"))).alias("same"),
        )
    )
    return reported(spark, sf_dir).select("scan_id", "ind_num").join(hits, ["scan_id", "ind_num"], "left").select(
        "scan_id", "ind_num", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_predictions"),
        F.col("n").isNotNull().alias("detected"), F.coalesce("same", F.lit(False)).alias("classified"),
    )


@query(
    "result_table_join_j7",
    with_tables(
        "predicted, reported",
        """SELECT p.scan_id, p.ind_num, p.flaw_type, p.depth AS depth_a, r.depth AS depth_b
FROM predicted p LEFT JOIN reported r USING (scan_id, ind_num)""",
    ),
)
def result_table_join(spark, sf_dir):
    keep = reported(spark, sf_dir).select("scan_id", "ind_num", F.col("depth").alias("depth_b"))
    return predicted(spark, sf_dir).join(keep, ["scan_id", "ind_num"], "left").select(
        "scan_id", "ind_num", "flaw_type", F.col("depth").alias("depth_a"), "depth_b"
    )


@query(
    "overlapping_pairs_j12_q1",
    with_tables(
        "reported",
        """, u AS (SELECT scan_id, rotary_start AS x, axial_start AS y, width AS w, length AS h, count(*) AS n,
  min(ind_num) AS id FROM reported GROUP BY ALL),
shared AS (SELECT a.scan_id, a.id AS a_id, b.id AS b_id, a.n AS a_n, b.n AS b_n,
  greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x) + 1, 0.0)
  * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y) + 1, 0.0) AS s,
  (a.w + 1) * (a.h + 1) AS aa, (b.w + 1) * (b.h + 1) AS ba,
  least(a.x + a.w, b.x + b.w) > greatest(a.x, b.x) AND least(a.y + a.h, b.y + b.h) > greatest(a.y, b.y) AS touch
  FROM u a JOIN u b ON a.scan_id = b.scan_id AND a.id < b.id)
SELECT scan_id, a_id, b_id, a_n::BIGINT AS a_n, b_n::BIGINT AS b_n, round(s / (aa + ba - s), 6) AS iou
FROM shared WHERE touch AND s / (aa + ba - s) >= 0.5""",
    ),
)
def overlapping_pairs(spark, sf_dir):
    flaws = reported(spark, sf_dir)
    pairs = matching.pairs_within(flaws, KEYS, inclusive=True, least=0.5)
    touch = F.lit(True)
    for axis, size in (("x", "w"), ("y", "h")):
        end = F.least(F.col(f"a_{axis}") + F.col(f"a_{size}"), F.col(f"b_{axis}") + F.col(f"b_{size}"))
        touch = touch & (end > F.greatest(f"a_{axis}", f"b_{axis}"))
    return pairs.where(touch).select(
        "scan_id", F.col("a_first._order").alias("a_id"), F.col("b_first._order").alias("b_id"), "a_n", "b_n",
        F.round("iou", 6).alias("iou"),
    )
