"""Ordered operators: gaps, runs, neighbours, outliers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import ordered
from ..operators.ordered import Series
from ..operators.quantiles import exact_quantiles
from .fixtures import predicted, series, with_tables
from .registry import query

# Rows per chunk. Small enough that the given tables span several chunks.
CHUNK = 4000
S = Series(["scan_id"], ["frame"], CHUNK)


@query(
    "frame_lag_w1",
    with_tables(
        "series",
        """SELECT scan_id, frame, round(full_value - lag(full_value) OVER (PARTITION BY scan_id ORDER BY frame), 4) AS diff,
  round((full_value - lag(full_value) OVER (PARTITION BY scan_id ORDER BY frame)
   + lag - lag(lag) OVER (PARTITION BY scan_id ORDER BY frame)
   + 2 * lag - lag(2 * lag) OVER (PARTITION BY scan_id ORDER BY frame)) / 3, 4) AS avg_lag FROM series""",
    ),
)
def frame_lag(spark, sf_dir):
    before = ordered.adjacent(
        series(spark, sf_dir), S, previous={"p1": F.col("full_value"), "p2": F.col("lag"), "p3": 2 * F.col("lag")}
    )
    d1, d2, d3 = F.col("full_value") - F.col("p1"), F.col("lag") - F.col("p2"), 2 * F.col("lag") - F.col("p3")
    return before.select("scan_id", "frame", F.round(d1, 4).alias("diff"), F.round((d1 + d2 + d3) / 3, 4).alias("avg_lag"))


@query(
    "gap_interpolation_w2",
    with_tables(
        "series",
        """, n AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM series),
k AS (SELECT *, CASE WHEN value IS NOT NULL THEN n END AS kn FROM n),
b AS (SELECT *, last_value(kn IGNORE NULLS) OVER p AS an, last_value(value IGNORE NULLS) OVER p AS av,
  first_value(kn IGNORE NULLS) OVER f AS bn, first_value(value IGNORE NULLS) OVER f AS bv FROM k
  WINDOW p AS (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT scan_id, frame, round(CASE WHEN an IS NULL OR bn IS NULL THEN coalesce(av, bv) WHEN bn = an THEN av
  ELSE av + (bv - av) * (CAST(n - an AS DOUBLE) / (bn - an)) END, 4) AS filled FROM b""",
    ),
)
def gap_interpolation(spark, sf_dir):
    filled = ordered.interpolate(series(spark, sf_dir), S, "value", "filled")
    return filled.select("scan_id", "frame", F.round("filled", 4).alias("filled"))


@query(
    "masked_bridge_w3",
    with_tables(
        "series",
        """, n AS (SELECT *, value IS NULL AS mask, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM series),
o AS (SELECT *, mask AND NOT coalesce(lag(mask) OVER (PARTITION BY scan_id ORDER BY frame), FALSE) AS opens FROM n),
b AS (SELECT *, last_value(CASE WHEN opens THEN n END IGNORE NULLS) OVER p AS an,
  last_value(CASE WHEN opens THEN full_value END IGNORE NULLS) OVER p AS av,
  first_value(CASE WHEN NOT mask THEN n END IGNORE NULLS) OVER f AS bn,
  first_value(CASE WHEN NOT mask THEN full_value END IGNORE NULLS) OVER f AS bv FROM o
  WINDOW p AS (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY scan_id ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT scan_id, frame, round(CASE WHEN mask AND bn IS NOT NULL
  THEN av + (bv - av) * CAST(n - an AS DOUBLE) / (bn - an) ELSE full_value END, 4) AS bridged FROM b""",
    ),
)
def masked_bridge(spark, sf_dir):
    out = ordered.bridge_mask(series(spark, sf_dir), S, "full_value", F.col("value").isNull(), "bridged")
    return out.select("scan_id", "frame", F.round("bridged", 4).alias("bridged"))


@query(
    "missing_runs_w4",
    with_tables(
        "series",
        """, n AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM series),
m AS (SELECT *, n - row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS g FROM n WHERE value IS NULL)
SELECT scan_id, min(frame) AS first, max(frame) AS last, count(*)::BIGINT AS length FROM m GROUP BY scan_id, g HAVING count(*) >= 2""",
    ),
)
def missing_runs(spark, sf_dir):
    return ordered.islands(series(spark, sf_dir), S, F.col("value").isNull(), 2)


@query(
    "consecutive_mask_w5",
    with_tables(
        "series",
        """, n AS (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n, count(*) OVER (PARTITION BY scan_id) AS total
  FROM series),
f AS (SELECT *, sum(CASE WHEN full_value > 20 THEN 1 ELSE 0 END) OVER (PARTITION BY scan_id ORDER BY n ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)
  >= 3 AS full_win FROM n),
e AS (SELECT scan_id, bool_or(full_win) FILTER (n = 1) AS head, bool_or(full_win) FILTER (n = total) AS tail FROM f GROUP BY scan_id)
SELECT scan_id, frame, full_win OR coalesce(lag(full_win) OVER w, tail) OR coalesce(lead(full_win) OVER w, head) AS kept
FROM f JOIN e USING (scan_id) WINDOW w AS (PARTITION BY scan_id ORDER BY n)""",
    ),
)
def consecutive_mask(spark, sf_dir):
    n = ordered.numbered(series(spark, sf_dir), S, "n").withColumn("hot", F.col("full_value") > 20)
    return ordered.consecutive_mask(n, ["scan_id"], "n", "hot", 3, 16, "kept").select("scan_id", "frame", "kept")


@query(
    "longest_changes_w6",
    with_tables(
        "series",
        """, n AS (SELECT scan_id, frame, lag - lag(lag) OVER (PARTITION BY scan_id ORDER BY frame) AS d,
  row_number() OVER (PARTITION BY scan_id ORDER BY frame) AS n FROM series),
st AS (SELECT *, sign(d) AS s FROM n WHERE d <> 0),
b AS (SELECT *, CASE WHEN s = lag(s) OVER (PARTITION BY scan_id ORDER BY n) THEN 0 ELSE 1 END AS brk FROM st),
g AS (SELECT *, sum(brk) OVER (PARTITION BY scan_id ORDER BY n) AS run FROM b),
r AS (SELECT scan_id, s, run, count(*) AS len, min(n) AS start FROM g GROUP BY ALL),
t AS (SELECT *, row_number() OVER (PARTITION BY scan_id, s ORDER BY len DESC, start) AS rk FROM r)
SELECT u.scan_id, coalesce(a.len, 0)::BIGINT AS largest_increase, coalesce(b.len, 0)::BIGINT AS largest_decrease,
  coalesce(a.start, 0) < coalesce(b.start, 0) AS increase_first
FROM (SELECT DISTINCT scan_id FROM series) u LEFT JOIN t a ON a.scan_id = u.scan_id AND a.s > 0 AND a.rk = 1
LEFT JOIN t b ON b.scan_id = u.scan_id AND b.s < 0 AND b.rk = 1""",
    ),
)
def longest_changes(spark, sf_dir):
    return ordered.longest_changes(series(spark, sf_dir), S, "lag")


@query(
    "jump_mask_w8",
    with_tables(
        "series",
        """, d AS (SELECT *, frame // 64 AS fr, coalesce(abs(lag - lag(lag) OVER w) >= 6, FALSE) OR coalesce(abs(lag - lead(lag) OVER w) >= 6, FALSE) AS jump
  FROM series WINDOW w AS (PARTITION BY scan_id ORDER BY frame)),
u AS (SELECT *, full_value - lag(full_value) OVER (PARTITION BY fr ORDER BY frame) >= 100 AS rise FROM d),
u2 AS (SELECT *, CASE WHEN rise AND frame = min(CASE WHEN rise THEN frame END) OVER (PARTITION BY fr) THEN NULL ELSE full_value END AS v FROM u),
f AS (SELECT *, lead(v) OVER (PARTITION BY fr ORDER BY frame) - v <= -100 AS fall FROM u2)
SELECT scan_id, frame, jump, CASE WHEN fall AND frame = min(CASE WHEN fall THEN frame END) OVER (PARTITION BY fr) THEN NULL ELSE v END
  AS steady FROM f""",
    ),
)
def jump_mask(spark, sf_dir):
    """Jumps along each scan, and abrupt steps within frames of 64 positions."""
    marked = ordered.jump_mask(series(spark, sf_dir), S, "lag", 6).withColumn("fr", F.expr("frame DIV 64"))
    return ordered.drop_abrupt(marked, ["fr"], "frame", "full_value", 100.0, "steady").select("scan_id", "frame", "jump", "steady")


@query(
    "neighbours_at_maximum_w9_j15",
    with_tables(
        "series",
        """, w AS (SELECT *, lag(cls, 1) OVER w AS c_p1, lag(cls, 2) OVER w AS c_p2, lead(cls, 1) OVER w AS c_n1, lead(cls, 2) OVER w AS c_n2,
  lag(full_value, 1) OVER w - full_value AS d_p1, lead(full_value, 2) OVER w - full_value AS d_n2,
  row_number() OVER (PARTITION BY scan_id ORDER BY full_value DESC, frame) AS rk
  FROM series WINDOW w AS (PARTITION BY scan_id ORDER BY frame))
SELECT scan_id, frame, cls, c_p1, c_p2, c_n1, c_n2, round(d_p1, 4) AS d_p1, round(d_n2, 4) AS d_n2 FROM w WHERE rk = 1""",
    ),
)
def neighbours_at_maximum(spark, sf_dir):
    n = ordered.numbered(series(spark, sf_dir), S, "n")
    around = ordered.with_halo(
        n, ["scan_id"], "n", 2, 64,
        lambda w: {
            "c_p1": F.lag("cls", 1).over(w), "c_p2": F.lag("cls", 2).over(w),
            "c_n1": F.lead("cls", 1).over(w), "c_n2": F.lead("cls", 2).over(w),
            "d_p1": F.round(F.lag("full_value", 1).over(w) - F.col("full_value"), 4),
            "d_n2": F.round(F.lead("full_value", 2).over(w) - F.col("full_value"), 4),
        },
    )
    names = ["frame", "cls", "c_p1", "c_p2", "c_n1", "c_n2", "d_p1", "d_n2"]
    top = around.groupBy("scan_id").agg(
        F.max_by(F.struct(*names), F.struct("full_value", (-F.col("frame")).alias("neg"))).alias("m")
    )
    return top.select("scan_id", "m.*")


@query(
    "outlier_nulling_w10",
    with_tables(
        "series",
        """, q AS (SELECT scan_id, quantile_cont(full_value, 0.25) AS q1, quantile_cont(full_value, 0.75) AS q3 FROM series GROUP BY 1),
a AS (SELECT s.*, full_value >= q3 + 1.5 * (q3 - q1) OR full_value <= q1 - 1.5 * (q3 - q1) AS anomaly FROM series s JOIN q USING (scan_id))
SELECT scan_id, frame, CASE WHEN anomaly THEN NULL ELSE full_value END AS start,
  CASE WHEN anomaly THEN NULL ELSE full_value + lag END AS "end", anomaly FROM a""",
    ),
)
def outlier_nulling(spark, sf_dir):
    rows = series(spark, sf_dir)
    q = exact_quantiles(rows, ["scan_id"], "full_value", {"q1": 0.25, "q3": 0.75}, 5.0)
    spread = F.col("q3") - F.col("q1")
    v = F.col("full_value")
    flagged = rows.join(q, "scan_id").withColumn("anomaly", (v >= F.col("q3") + 1.5 * spread) | (v <= F.col("q1") - 1.5 * spread))
    keep = ~F.col("anomaly")
    return flagged.select(
        "scan_id", "frame", F.when(keep, v).alias("start"), F.when(keep, v + F.col("lag")).alias("end"), "anomaly"
    )


@query(
    "wavegroup_overlap_w15",
    with_tables(
        "series",
        """, g AS (SELECT scan_id, frame, full_value AS s3, full_value + 20 AS e3, full_value + lag AS s4, full_value + 25 AS e4 FROM series)
SELECT scan_id, frame, round(CASE WHEN least(e3, e4) - greatest(s3, s4) > 0 THEN (least(e3, e4) - greatest(s3, s4)) / (e4 - s4) ELSE 0.0 END, 6)
  AS overlap FROM g""",
    ),
)
def wavegroup_overlap(spark, sf_dir):
    v = F.col("full_value")
    s3, e3, s4, e4 = v, v + 20, v + F.col("lag"), v + 25
    shared = F.least(e3, e4) - F.greatest(s3, s4)
    share = F.when(shared > 0, shared / (e4 - s4)).otherwise(0.0)
    return series(spark, sf_dir).select("scan_id", "frame", F.round(share, 6).alias("overlap"))


@query(
    "indication_numbers_w16",
    with_tables(
        "predicted",
        """, p AS (SELECT scan_id, ind_num AS flaw_id, CASE flaw_type WHEN 'FBBPF' THEN 'MP' WHEN 'BM_FBBPF' THEN 'BM' ELSE 'Ind' END AS prefix
  FROM predicted)
SELECT scan_id, flaw_id, prefix || ' ' || row_number() OVER (PARTITION BY scan_id, prefix ORDER BY flaw_id) AS ind_num FROM p""",
    ),
)
def indication_numbers(spark, sf_dir):
    prefix = F.when(F.col("flaw_type") == "FBBPF", "MP").when(F.col("flaw_type") == "BM_FBBPF", "BM").otherwise("Ind")
    rows = predicted(spark, sf_dir).select(
        "scan_id", F.col("ind_num").alias("flaw_id"), prefix.alias("prefix"),
        F.split("ind_num", "-").getItem(0).cast("int").alias("line"),
    )
    # flaws are listed in the order of their id, whose leading number cuts a long list into chunks
    n = ordered.numbered(rows, Series(["scan_id", "prefix"], ["line", "flaw_id"], 1), "n")
    return n.select("scan_id", "flaw_id", F.concat_ws(" ", "prefix", F.col("n").cast("string")).alias("ind_num"))


@query(
    "same_place_sequence_w17",
    with_tables(
        "series",
        """, b AS (SELECT *, CASE WHEN abs(lag - lag(lag) OVER (PARTITION BY scan_id ORDER BY frame)) <= 2 THEN 0 ELSE 1 END AS brk FROM series),
g AS (SELECT *, sum(brk) OVER (PARTITION BY scan_id ORDER BY frame) AS run FROM b),
r AS (SELECT scan_id, run, count(*) AS length, min(frame) AS first, arg_max(frame, struct_pack(v := full_value, f := -frame)) AS frame_deepest,
  arg_max(lag, struct_pack(v := full_value, f := -frame)) AS place FROM g GROUP BY ALL)
SELECT scan_id, length::BIGINT AS length, first, frame_deepest, place FROM
 (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY length DESC, first DESC) AS rk FROM r) WHERE rk = 1 AND length >= 3""",
    ),
)
def same_place_sequence(spark, sf_dir):
    """Longest stretch of frames whose peak stays in place; the last of equally long stretches wins."""
    n = ordered.adjacent(series(spark, sf_dir), S, previous={"before": F.col("lag")})
    brk = F.when(F.abs(F.col("lag") - F.col("before")) <= 2, 0).otherwise(1)
    deep = F.struct("full_value", (-F.col("frame")).alias("neg"))
    stretches = ordered.running(n, S, {"run": brk}).groupBy("scan_id", "run").agg(
        F.count(F.lit(1)).alias("length"), F.min("frame").alias("first"),
        F.max_by(F.struct("frame", "lag"), deep).alias("deepest"),
    )
    best = stretches.groupBy("scan_id").agg(F.max(F.struct("length", "first", "deepest")).alias("b"))
    return best.where("b.length >= 3").select(
        "scan_id", "b.length", "b.first", F.col("b.deepest.frame").alias("frame_deepest"), F.col("b.deepest.lag").alias("place")
    )


@query(
    "reference_position_w7",
    with_tables(
        "ascans",
        """, p AS (SELECT scan_id, probe, frame, rotary_idx, list_max([abs(x - 128) FOR x IN samples]) >= 22 AS ok FROM ascans),
b AS (SELECT *, CASE WHEN ok = lag(ok) OVER w THEN 0 ELSE 1 END AS brk FROM p WINDOW w AS (PARTITION BY scan_id, probe, frame ORDER BY rotary_idx)),
g AS (SELECT *, sum(brk) OVER (PARTITION BY scan_id, probe, frame ORDER BY rotary_idx) AS run FROM b),
r AS (SELECT scan_id, probe, frame, run, min(rotary_idx) AS first, max(rotary_idx) AS last, count(*) AS n FROM g WHERE ok GROUP BY ALL),
l AS (SELECT scan_id, probe, frame, max(rotary_idx) AS last_idx FROM p GROUP BY ALL)
SELECT l.scan_id, l.probe, l.frame, coalesce(min(first) FILTER (n >= 10), min(first) FILTER (r.last = last_idx), 0)::BIGINT AS reference_loc
FROM l LEFT JOIN r USING (scan_id, probe, frame) GROUP BY ALL""",
    ),
)
def reference_position(spark, sf_dir):
    from ..operators import signal
    from .fixtures import ascans

    valid = F.array_max(F.transform("samples", lambda x: F.abs(x - 128))) >= 22
    return signal.reference_positions(ascans(spark, sf_dir).withColumn("ok", valid), "ok", 10)
