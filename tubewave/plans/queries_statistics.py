"""Counts, error statistics, histograms, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import projections as pj
from ..operators import statistics as st
from ..operators.quantiles import exact_quantiles
from . import fixtures as fx
from .fixtures import with_tables
from .queries_matching import PAIRS_SQL, REPORTED_METRICS_SQL, reported_metrics
from .registry import query


@query(
    "store_totals_a1_a3",
    with_tables(
        "scans, predicted, reported",
        """SELECT (SELECT count(*) FROM scans)::BIGINT AS n_scans, (SELECT count(*) FROM predicted)::BIGINT AS n_flaws,
  (SELECT count(*) FROM reported)::BIGINT AS n_reported, count(DISTINCT scan_unit)::BIGINT AS units, count(DISTINCT scan_station)::BIGINT AS stations,
  count(DISTINCT scan_year)::BIGINT AS years, count(DISTINCT raw_outage)::BIGINT AS outages FROM scans""",
    ),
)
def store_totals(spark, sf_dir):
    scans = fx.scans(spark, sf_dir)
    names = {"scan_unit": "units", "scan_station": "stations", "scan_year": "years", "raw_outage": "outages"}
    # the four attributes have few combinations: count those first
    few = scans.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    facts = few.agg(F.sum("n").alias("n_scans"), *[F.countDistinct(c).alias(n) for c, n in names.items()])
    return facts.select(
        "n_scans", fx.predicted(spark, sf_dir).select(F.count(F.lit(1))).scalar().alias("n_flaws"),
        fx.reported(spark, sf_dir).select(F.count(F.lit(1))).scalar().alias("n_reported"), *names.values(),
    )


@query(
    "flaw_types_a2",
    with_tables("predicted, reported", "SELECT flaw_type FROM predicted UNION SELECT flaw_type FROM reported UNION SELECT 'CC' FROM reported"),
)
def flaw_types(spark, sf_dir):
    """Types of predicted and reported flaws together with their possible categories."""
    pred = fx.predicted(spark, sf_dir).select("flaw_type").distinct()
    rep = fx.reported(spark, sf_dir).select(F.explode(F.array("flaw_type", F.lit("CC"))).alias("flaw_type")).distinct()
    return pred.union(rep).distinct()


@query(
    "category_counts_a5",
    with_tables(
        "deltas",
        """, c AS (SELECT CASE WHEN lower(category) = 'd' THEN 'd' WHEN lower(category) IN ('v', 'mv') THEN 'v' WHEN lower(category) = 's' THEN 's'
  WHEN lower(category) = 'm' THEN 'm' WHEN category = '7' THEN '7' ELSE 'combined' END AS grp, category FROM deltas),
u AS (SELECT 'folded' AS form, grp AS category FROM c UNION ALL SELECT 'plain', category FROM c),
n AS (SELECT form, category, count(*)::BIGINT AS n FROM u GROUP BY 1, 2)
SELECT form, category, n, round(100.0 * n / sum(n) OVER (PARTITION BY form), 4)::DOUBLE AS percent FROM n""",
    ),
)
def category_counts(spark, sf_dir):
    low = F.lower("category")
    folded = (
        F.when(low == "d", "d").when(low.isin("v", "mv"), "v").when(low == "s", "s").when(low == "m", "m").when(low == "7", "7")
        .otherwise("combined")
    )
    plain = fx.deltas(spark, sf_dir).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    fold = plain.groupBy(folded.alias("category")).agg(F.sum("n").alias("n"))
    shared = [st.share_of_total(df).withColumn("form", F.lit(name)) for df, name in ((fold, "folded"), (plain, "plain"))]
    return shared[0].unionByName(shared[1]).select("form", "category", "n", "percent")


@query(
    "delta_moments_a6",
    with_tables(
        "deltas",
        """, l AS (SELECT category, 'delta1' AS metric, delta1 AS v FROM deltas WHERE NOT flagged AND category <> 's'
  UNION ALL SELECT category, 'delta2', delta2 FROM deltas WHERE NOT flagged AND category <> 's'),
a AS (SELECT * FROM l UNION ALL SELECT 'ALL', metric, v FROM l)
SELECT category, metric, count(v)::BIGINT AS n, round(avg(v), 9) AS mean, round(stddev_pop(v), 9) AS sigma,
  round(round(avg(v), 9) - 2 * round(stddev_pop(v), 9), 9) AS low_2s, round(round(avg(v), 9) + 2 * round(stddev_pop(v), 9), 9) AS high_2s
FROM a WHERE v IS NOT NULL GROUP BY 1, 2""",
    ),
)
def delta_moments(spark, sf_dir):
    kept = fx.deltas(spark, sf_dir).where("NOT flagged AND category <> 's'")
    return st.moments_by_group(kept, "category", ["delta1", "delta2"])


@query(
    "delta_by_year_and_channel_a7",
    with_tables(
        "deltas, scans",
        """, j AS (SELECT CAST(s.scan_year AS VARCHAR) AS y, s.scan_channel AS c, delta2 AS v FROM deltas JOIN scans s USING (scan_id) WHERE delta2 IS NOT NULL),
u AS (SELECT 'year' AS level, y AS name, v FROM j UNION ALL SELECT 'channel', c, v FROM j)
SELECT level, name, count(*)::BIGINT AS n, round(avg(v), 9) AS mean, round(stddev_samp(v), 9) AS sd, round(quantile_cont(v, 0.25), 9) AS q25,
  round(quantile_cont(v, 0.5), 9) AS q50, round(quantile_cont(v, 0.75), 9) AS q75 FROM u GROUP BY 1, 2""",
    ),
)
def delta_by_year_and_channel(spark, sf_dir):
    scans = fx.scans(spark, sf_dir).select("scan_id", F.col("scan_year").cast("string").alias("year"), F.col("scan_channel").alias("channel"))
    joined = fx.deltas(spark, sf_dir).select("scan_id", "delta2").join(scans, "scan_id")
    counts = st.counted(joined, ["year", "channel"], "delta2")
    pairs = F.expr("stack(2, 'year', year, 'channel', channel) AS (level, name)")
    long = counts.select(pairs, "delta2", "n").groupBy("level", "name", "delta2").agg(F.sum("n").alias("n"))
    stats = long.groupBy("level", "name").agg(*st.weighted_moments("delta2"))
    q = exact_quantiles(long, ["level", "name"], "delta2", {"q25": 0.25, "q50": 0.5, "q75": 0.75}, 0.01, frequency="n")
    return stats.join(q, ["level", "name"]).select(
        "level", "name", "n", "mean", F.col("sd_samp").alias("sd"), *[F.round(c, 9).alias(c) for c in ("q25", "q50", "q75")]
    )


@query(
    "delta_histogram_a8",
    with_tables(
        "deltas",
        """SELECT category, CAST(CASE WHEN delta2 = 0.08 THEN 34 ELSE floor((delta2 - -0.07::DOUBLE) / (0.08::DOUBLE - -0.07::DOUBLE) * 35) END AS BIGINT) AS bin,
  count(*)::BIGINT AS n FROM deltas WHERE delta2 BETWEEN -0.07 AND 0.08 GROUP BY 1, 2""",
    ),
)
def delta_histogram(spark, sf_dir):
    return st.histogram(fx.deltas(spark, sf_dir), ["category"], "delta2", -0.07, 0.08, 35)


@query(
    "clipped_histogram_a8",
    with_tables(
        "deltas",
        """SELECT CAST(CASE WHEN depth >= 0.5 THEN 39 ELSE floor((depth - 0.1::DOUBLE) / (0.5::DOUBLE - 0.1::DOUBLE) * 40) END AS BIGINT) AS bin,
  count(*)::BIGINT AS n, sum(CASE WHEN depth > 0.5 THEN 1 ELSE 0 END)::BIGINT AS n_over FROM deltas WHERE depth >= 0.1 GROUP BY 1""",
    ),
)
def clipped_histogram(spark, sf_dir):
    return st.clipped_histogram(fx.deltas(spark, sf_dir), "depth", 0.1, 0.5, 40)


@query(
    "trim_to_spread_a9",
    with_tables(
        "deltas",
        """, f AS (SELECT count(delta2) AS total, avg(delta2) AS mean, stddev_pop(delta2) AS sigma FROM deltas),
z AS (SELECT round(abs((delta2 - mean) / sigma), 9) AS z, delta2 AS v FROM deltas, f WHERE delta2 IS NOT NULL),
g AS (SELECT z, count(*) AS n, sum(v) AS s, sum(v * v) AS ss FROM z GROUP BY z),
p AS (SELECT z, n, sum(n) OVER w AS upto, sum(s) OVER w AS s, sum(ss) OVER w AS ss FROM g WINDOW w AS (ORDER BY z)),
st AS (SELECT range AS step, floor((total - 1) * (99.0::DOUBLE - 0.1::DOUBLE * range) / 100) AS k, total FROM range(990), f),
t AS (SELECT st.step, upto AS kept, 2 * sqrt(greatest(ss / upto - (s / upto) * (s / upto), 0)) AS two_sigma, st.total FROM st
  JOIN p ON st.k >= p.upto - p.n AND st.k < p.upto)
SELECT round(99 - 0.1::DOUBLE * step, 1) AS percentile, kept::BIGINT AS kept, round(two_sigma, 6) AS two_sigma,
  round(100 * (1 - kept::DOUBLE / total), 6) AS removed_percent FROM t WHERE kept < 10 OR two_sigma <= 0.025 OR step = 989 ORDER BY step LIMIT 1""",
    ),
)
def trim_to_spread(spark, sf_dir):
    return st.trim_to_spread(fx.deltas(spark, sf_dir), "delta2", 0.025)


@query(
    "outlier_scans_a10",
    with_tables(
        "deltas",
        """SELECT scan_id, 0 AS part, count(*)::INTEGER AS n, string_agg(ind_num, ',' ORDER BY ind_num) AS inds FROM deltas
WHERE category IN ('V', 'MV', 'M') AND (delta2 IS NULL OR abs(delta2) > 0.03) GROUP BY 1""",
    ),
)
def outlier_scans(spark, sf_dir):
    outliers = fx.deltas(spark, sf_dir).where(
        F.col("category").isin("V", "MV", "M") & (F.col("delta2").isNull() | (F.abs("delta2") > 0.03))
    )
    flaws = outliers.select("scan_id", "ind_num", "delta2")
    docs = pj.nested_documents(flaws.select("scan_id").distinct(), flaws, "scan_id", "outliers")
    inds = F.transform("outliers", lambda o: o["ind_num"])
    return docs.select("scan_id", "part", F.size("outliers").alias("n"), F.array_join(inds, ",").alias("inds"))


@query(
    "evaluation_summary_a11",
    with_tables(
        "predicted, reported",
        f""", {PAIRS_SQL},
best AS (SELECT *, row_number() OVER (PARTITION BY scan_id, r_ind ORDER BY iou DESC, p_ind) AS rn FROM pairs),
e AS (SELECT r.flaw_type, r.width > 11 AS disposition, b.iou > 0.1 AS detected, r.flaw_type = p.flaw_type AS correct, p.length - r.length AS length_error,
  p.width - r.width AS width_error, round((p.axial_start - r.axial_start) / 0.3) AS start_px, p.depth - r.depth AS depth_error
  FROM best b JOIN reported r ON r.scan_id = b.scan_id AND r.ind_num = b.r_ind JOIN predicted p ON p.scan_id = b.scan_id AND p.ind_num = b.p_ind WHERE rn = 1)
SELECT flaw_type, count(*)::BIGINT AS n, count(*) FILTER (disposition)::BIGINT AS n_disposition, count(*) FILTER (NOT detected)::BIGINT AS n_undetected,
  count(*) FILTER (detected AND NOT disposition AND correct)::BIGINT AS n_correct,
  round(avg(CASE WHEN detected AND NOT disposition THEN CASE WHEN abs(start_px) <= 4 THEN 1.0 ELSE 0.0 END END), 6)::DOUBLE AS start_within_4px,
  round(avg(CASE WHEN detected AND NOT disposition THEN CASE WHEN abs(width_error) <= 0.4 THEN 1.0 ELSE 0.0 END END), 6)::DOUBLE AS width_within,
  round(avg(CASE WHEN detected AND NOT disposition THEN CASE WHEN abs(depth_error) <= 0.034 THEN 1.0 WHEN depth_error IS NOT NULL THEN 0.0 END END), 6)::DOUBLE AS depth_within,
  round(avg(CASE WHEN detected AND NOT disposition THEN length_error END), 6) AS mean_length_error
FROM e GROUP BY 1""",
    ),
)
def evaluation_summary(spark, sf_dir):
    from ..operators import matching

    payload = ["flaw_type", "length", "width", "axial_start", "depth"]
    flaws = fx.reported(spark, sf_dir).select("scan_id", "flaw_type", "depth", *matching.BoxColumns().names())
    m = matching.best_match_or_first(flaws, fx.predicted(spark, sf_dir), ["scan_id"], payload=payload)
    p = F.col("match")
    e = m.where("match IS NOT NULL").select(
        "flaw_type", (F.col("width") > 11).alias("disposition"), (F.col("iou") > 0.1).alias("detected"),
        (F.col("flaw_type") == p["flaw_type"]).alias("correct"), (p["length"] - F.col("length")).alias("length_error"),
        (p["width"] - F.col("width")).alias("width_error"),
        F.round((p["axial_start"] - F.col("axial_start")) / 0.3).alias("start_px"), (p["depth"] - F.col("depth")).alias("depth_error"),
    )
    judged = F.col("detected") & ~F.col("disposition")

    def within(c: str, tolerance: float):
        return F.round(F.avg(F.when(judged, (F.abs(c) <= tolerance).cast("double"))), 6)

    return e.groupBy("flaw_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("disposition").alias("n_disposition"), F.count_if(~F.col("detected")).alias("n_undetected"),
        F.count_if(judged & F.col("correct")).alias("n_correct"), within("start_px", 4).alias("start_within_4px"),
        within("width_error", 0.4).alias("width_within"), within("depth_error", 0.034).alias("depth_within"),
        F.round(F.avg(F.when(judged, F.col("length_error"))), 6).alias("mean_length_error"),
    )


@query(
    "depth_records_f16_a5",
    with_tables(
        "predicted, reported, scans",
        f"""{REPORTED_METRICS_SQL}
SELECT m.scan_id, m.ind_num, m.pred_ind_num, 2000 + CAST(substr(s.raw_outage, 2, 2) AS INTEGER) AS year, s.scan_channel AS channel,
  contains(coalesce(m.pred_depth, ''), '(2)') OR contains(coalesce(m.pred_depth, ''), 'See note_2') AS flagged, -m.depth_diff AS depth2_delta
FROM metrics m JOIN scans s USING (scan_id) WHERE s.raw_outage LIKE 'D%' AND m.pred_depth IS NOT NULL""",
    ),
)
def depth_records(spark, sf_dir):
    scans = fx.scans(spark, sf_dir).where(F.col("raw_outage").startswith("D")).select(
        "scan_id", text.outage_year(F.col("raw_outage")).alias("year"), F.col("scan_channel").alias("channel")
    )
    names = ["scan_id", "ind_num", "pred_ind_num", "pred_depth", "depth_diff"]
    metrics = reported_metrics(spark, sf_dir, names).where(F.col("pred_depth").isNotNull() & (F.col("pred_depth") != text.SEE_CATEGORIES))
    return metrics.join(scans, "scan_id").select(
        "scan_id", "ind_num", "pred_ind_num", "year", "channel", text.is_flagged_text(F.col("pred_depth")).alias("flagged"),
        (-F.col("depth_diff")).alias("depth2_delta"),
    )


@query(
    "column_profile_a21",
    with_tables(
        "deltas",
        """, l AS (SELECT 'category' AS c, category AS v FROM deltas UNION ALL SELECT 'delta2', CAST(delta2 AS VARCHAR) FROM deltas
  UNION ALL SELECT 'depth_nb1', CAST(depth_nb1 AS VARCHAR) FROM deltas),
d AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS rk FROM (SELECT DISTINCT c, v FROM l WHERE v IS NOT NULL))
SELECT l.c AS "column", count(l.v)::BIGINT AS non_null, (count(*) - count(l.v))::BIGINT AS nulls, round(100.0 * (count(*) - count(l.v)) / count(*), 4)::DOUBLE
  AS null_percent, count(DISTINCT l.v)::BIGINT AS distinct_values, (SELECT string_agg(v, ', ' ORDER BY v) FROM d WHERE d.c = l.c AND rk <= 5) AS samples
FROM l GROUP BY l.c""",
    ),
)
def column_profile(spark, sf_dir):
    return st.column_profile(fx.deltas(spark, sf_dir), ["category", "delta2", "depth_nb1"])


@query(
    "describe_target_a22",
    with_tables(
        "deltas",
        """SELECT count(delta2)::BIGINT AS n, round(avg(delta2), 9) AS mean, round(stddev_samp(delta2), 9) AS sd, min(delta2) AS min,
  round(quantile_cont(delta2, 0.25), 9) AS q25, round(quantile_cont(delta2, 0.5), 9) AS q50, round(quantile_cont(delta2, 0.75), 9) AS q75, max(delta2) AS max,
  count(*) FILTER (delta2 > 0)::BIGINT AS positive, count(*) FILTER (delta2 < 0)::BIGINT AS negative, count(*) FILTER (delta2 = 0)::BIGINT AS zero FROM deltas""",
    ),
)
def describe_target(spark, sf_dir):
    rows = fx.deltas(spark, sf_dir)
    signs = rows.agg(
        F.count_if(F.col("delta2") > 0).alias("positive"), F.count_if(F.col("delta2") < 0).alias("negative"),
        F.count_if(F.col("delta2") == 0).alias("zero"),
    )
    return st.describe_column(rows, "delta2", 0.01).select("*", *[signs.select(c).scalar().alias(c) for c in signs.columns])


@query(
    "correlations_a23",
    with_tables(
        "deltas",
        """SELECT 'delta1' AS a, 'delta2' AS b, round(corr(delta1, delta2), 3) AS corr FROM deltas
UNION ALL SELECT 'delta1', 'depth', round(corr(delta1, depth), 3) FROM deltas UNION ALL SELECT 'delta1', 'depth_nb2', round(corr(delta1, depth_nb2), 3) FROM deltas
UNION ALL SELECT 'delta2', 'depth', round(corr(delta2, depth), 3) FROM deltas UNION ALL SELECT 'delta2', 'depth_nb2', round(corr(delta2, depth_nb2), 3) FROM deltas
UNION ALL SELECT 'depth', 'depth_nb2', round(corr(depth, depth_nb2), 3) FROM deltas""",
    ),
)
def correlations(spark, sf_dir):
    return st.correlations(fx.deltas(spark, sf_dir), ["delta1", "delta2", "depth", "depth_nb2"])


@query(
    "target_distribution_a24_e14",
    with_tables(
        "deltas",
        """SELECT count(*) FILTER (delta2 > 0.038)::BIGINT AS over, count(*) FILTER (delta2 < -0.03)::BIGINT AS under,
  count(*) FILTER (delta2 BETWEEN -0.03 AND 0.038)::BIGINT AS between_thresholds, round(avg(delta2), 6) AS mean, round(stddev_pop(delta2), 6) AS sigma,
  round(greatest(count(*) FILTER (delta2 BETWEEN -0.03 AND 0.038), count(*) FILTER (delta2 > 0.038 OR delta2 < -0.03))::DOUBLE
   / least(count(*) FILTER (delta2 BETWEEN -0.03 AND 0.038), count(*) FILTER (delta2 > 0.038 OR delta2 < -0.03)), 6) AS imbalance,
  count(*) FILTER (abs(delta2 - 0.038) <= 0.01)::BIGINT AS near_over, count(*) FILTER (abs(delta2 - -0.03) <= 0.01)::BIGINT AS near_under FROM deltas""",
    ),
)
def target_distribution(spark, sf_dir):
    v = F.col("delta2")
    over, under = F.count_if(v > 0.038), F.count_if(v < -0.03)
    between, flagged = F.count_if(v.between(-0.03, 0.038)), F.count_if((v > 0.038) | (v < -0.03))
    return fx.deltas(spark, sf_dir).agg(
        over.alias("over"), under.alias("under"), between.alias("between_thresholds"), F.round(F.avg(v), 6).alias("mean"),
        F.round(F.stddev_pop(v), 6).alias("sigma"), F.round(F.greatest(between, flagged) / F.least(between, flagged), 6).alias("imbalance"),
        F.count_if(F.abs(v - 0.038) <= 0.01).alias("near_over"), F.count_if(F.abs(v - -0.03) <= 0.01).alias("near_under"),
    )


@query(
    "wavegroup_report_a12",
    with_tables(
        "wave_boxes",
        """, r AS (SELECT *, row_number() OVER (PARTITION BY scan_id, frame, cls ORDER BY conf DESC, box_id) AS rk,
  count(*) OVER (PARTITION BY scan_id, frame, cls) AS n FROM wave_boxes),
p AS (SELECT scan_id, frame, max(CASE WHEN cls = 'G2' THEN box_start END) AS g2_start, max(CASE WHEN cls = 'G2' THEN box_end END) AS g2_end,
  max(CASE WHEN cls = 'G3' THEN box_start END) AS g3_start, max(CASE WHEN cls = 'G3' THEN box_end END) AS g3_end,
  max(CASE WHEN cls = 'G4' THEN box_start END) AS g4_start, max(CASE WHEN cls = 'G4' THEN box_end END) AS g4_end, max(n) > 1 AS repeating_labels
  FROM r WHERE rk = 1 GROUP BY 1, 2)
SELECT scan_id, frame, g2_start, g2_end, g3_start, g3_end, g4_start, g4_end, g2_start IS NULL AS missing_g2, g3_start IS NULL AS missing_g3,
  g4_start IS NULL AS missing_g4, repeating_labels, g2_end IS NULL OR g3_end IS NULL OR g4_end IS NULL OR g2_end > g3_end OR g3_end > g4_end AS labels_not_in_order FROM p""",
    ),
)
def wavegroup_report(spark, sf_dir):
    from ..operators import wavegroups

    boxes = fx.wave_boxes(spark, sf_dir)
    return wavegroups.search_report(boxes.select("scan_id", "frame").distinct(), boxes)
