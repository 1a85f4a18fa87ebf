"""Depth sizing: flaw cells, neighbours, alignment, scrape and profile statistics, dispatch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking, signal, sizing
from ..operators import projections as pj
from ..operators.signal import FRAME
from ..session import scratch_path
from ..sources import results
from . import fixtures as fx
from .fixtures import with_tables
from .queries_signal import first_references
from .registry import query

FLAW = ["scan_id", "flaw_id"]


def rounded(df, names, digits=6):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(
    "positions_in_flaws_j8",
    with_tables(
        "grid_flaws",
        """SELECT DISTINCT scan_id, probe, f.frame, r.rotary_idx FROM grid_flaws g, LATERAL (SELECT unnest(range(frame_start, frame_end + 1)) AS frame) f,
  LATERAL (SELECT unnest(range(rotary_start, rotary_end + 1)) AS rotary_idx) r""",
    ),
)
def positions_in_flaws(spark, sf_dir):
    return sizing.flaw_positions(fx.grid_flaws(spark, sf_dir))


@query(
    "clean_neighbours_j9",
    with_tables(
        "ascans, grid_flaws",
        """, c AS (SELECT scan_id, probe, frame, rotary_idx FROM ascans a WHERE NOT EXISTS (SELECT 1 FROM grid_flaws g WHERE g.scan_id = a.scan_id AND g.probe = a.probe
  AND a.frame BETWEEN frame_start AND frame_end AND a.rotary_idx BETWEEN rotary_start AND rotary_end)),
n AS (SELECT g.scan_id, g.probe, c.frame, g.flaw_id, c.rotary_idx, CASE WHEN c.rotary_idx < rotary_start - 1 THEN 'left' ELSE 'right' END AS side,
  CASE WHEN c.rotary_idx < rotary_start - 1 THEN rotary_start - c.rotary_idx ELSE c.rotary_idx - rotary_end END AS dist
  FROM grid_flaws g JOIN c ON c.scan_id = g.scan_id AND c.probe = g.probe AND c.frame BETWEEN frame_start AND frame_end
  WHERE c.rotary_idx < rotary_start - 1 OR c.rotary_idx > rotary_end + 1),
r AS (SELECT *, row_number() OVER (PARTITION BY scan_id, probe, frame, flaw_id, side ORDER BY dist) AS rk FROM n)
SELECT scan_id, probe, frame, flaw_id, side, CAST(rk - 1 AS INTEGER) AS step, rotary_idx FROM r WHERE rk <= 3""",
    ),
)
def clean_neighbours(spark, sf_dir):
    return sizing.clean_neighbours(fx.grid_flaws(spark, sf_dir), fx.ascans(spark, sf_dir), 3, buffer=1)


@query(
    "peak_behind_reference_j10",
    with_tables(
        "ascans",
        """, p AS (SELECT *, [i FOR i IN range(1, 63) IF samples[i + 1] > samples[i] AND samples[i + 1] > samples[i + 2] AND samples[i + 1] >= 130] AS peaks FROM ascans)
SELECT scan_id, probe, frame, rotary_idx, CAST(coalesce(list_max([i FOR i IN peaks IF i > list_position(samples, list_max(samples)) - 1]), list_max(peaks)) AS INTEGER) AS flaw_peak FROM p""",
    ),
)
def peak_behind_reference(spark, sf_dir):
    from ..functions import samples as sm

    peaks = F.transform(ranking.top_peaks(F.col("samples"), 64, 130), lambda e: e["index"])
    found = sizing.last_peak_right_of(peaks, sm.first_argmax(F.col("samples")))
    return fx.ascans(spark, sf_dir).select(*FRAME, "rotary_idx", found.alias("flaw_peak"))


@query(
    "balanced_references_w14",
    with_tables(
        "cells",
        """, s AS (SELECT frame AS fr, rotary_idx AS x, coalesce(depth, 0.2) * 100 AS v FROM cells),
f AS (SELECT DISTINCT frame AS fr, 28 AS fs, 34 AS fe, 31 AS fp FROM cells),
o AS (SELECT s.fr, (x - 31)::DOUBLE AS xx, v FROM s WHERE NOT x BETWEEN 28 AND 34),
m AS (SELECT fr, count(*)::DOUBLE AS s0, sum(xx) AS s1, sum(xx ** 2) AS s2, sum(xx ** 3) AS s3, sum(xx ** 4) AS s4, sum(v) AS t0, sum(v * xx) AS t1, sum(v * xx * xx) AS t2 FROM o GROUP BY 1),
d AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS base FROM m),
k AS (SELECT fr, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / base AS c0,
  (s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / base AS c1,
  (s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / base AS c2 FROM d),
z AS (SELECT s.fr, x, v - (c0 + c1 * (x - 31) + c2 * (x - 31) * (x - 31)) AS flat, min(x) OVER (PARTITION BY s.fr) AS lo, max(x) OVER (PARTITION BY s.fr) AS hi FROM s JOIN k USING (fr)),
y AS (SELECT *, greatest(lo, 13) AS ls, least(hi + 1, 49) AS re FROM z),
l AS (SELECT *, avg(CASE WHEN x < ls OR x > re THEN flat END) OVER (PARTITION BY fr) AS lev, least(31 - ls, re - 31) AS ideal FROM y),
c AS (SELECT fr, x, CASE WHEN x >= ls AND x < 28 THEN 'l' WHEN x >= 34 AND x < re THEN 'r' END AS side,
  round(abs(flat - lev) + 0.7::DOUBLE * abs((CASE WHEN x < 28 THEN x - ls ELSE x - 34 END) - ideal), 9) AS score FROM l)
SELECT fr AS frame, arg_min(x, struct_pack(s := score, p := x)) FILTER (side = 'l') AS left_ref, arg_min(x, struct_pack(s := score, p := x)) FILTER (side = 'r') AS right_ref
FROM c WHERE side IS NOT NULL GROUP BY 1""",
    ),
)
def balanced_references(spark, sf_dir):
    cells = fx.cells(spark, sf_dir).select("frame", F.col("rotary_idx").alias("x"), (F.coalesce("depth", F.lit(0.2)) * 100).alias("v"))
    flaws = cells.select("frame").distinct().select(
        "frame", F.lit("f").alias("flaw_id"), F.lit(31).alias("flaw_position"), F.lit(28).alias("flaw_start"), F.lit(34).alias("flaw_end")
    )
    return sizing.balanced_references(cells, flaws, ["frame"], "x", "v").drop("flaw_id")


@query(
    "deepest_cell_a13_a25",
    with_tables(
        "cells",
        """, r AS (SELECT *, row_number() OVER (PARTITION BY scan_id, flaw_id ORDER BY depth DESC NULLS LAST, frame, rotary_idx) AS rk FROM cells),
a AS (SELECT scan_id, flaw_id, min(amp) AS min_amp, max(amp) AS max_amp, count(*)::BIGINT AS n_cells, round(100.0 * count(*) FILTER (depth IS NULL) / count(*), 6)::DOUBLE AS missing_percent FROM cells GROUP BY 1, 2)
SELECT scan_id, flaw_id, depth AS max_depth, CASE WHEN depth IS NOT NULL THEN frame END AS frame, CASE WHEN depth IS NOT NULL THEN rotary_idx END AS rotary_idx,
  CASE WHEN depth IS NOT NULL THEN amp END AS amp_at_max, min_amp, max_amp, n_cells, missing_percent FROM r JOIN a USING (scan_id, flaw_id) WHERE rk = 1""",
    ),
)
def deepest_cell(spark, sf_dir):
    return rounded(sizing.deepest_cell(fx.cells(spark, sf_dir), FLAW), ["missing_percent"])


@query(
    "near_maximum_a14",
    with_tables(
        "cells",
        """, m AS (SELECT *, max(depth) OVER (PARTITION BY scan_id, flaw_id) AS top FROM cells)
SELECT scan_id, flaw_id, count(*) FILTER (depth >= top - 0.01::DOUBLE)::BIGINT AS n_hundredth, round(count(*) FILTER (depth >= top - 0.01::DOUBLE)::DOUBLE / count(*), 6) AS share_hundredth,
  count(*) FILTER (depth >= top - 0.1::DOUBLE)::BIGINT AS n_tenth, round(count(*) FILTER (depth >= top - 0.1::DOUBLE)::DOUBLE / count(*), 6) AS share_tenth FROM m GROUP BY 1, 2""",
    ),
)
def near_maximum(spark, sf_dir):
    return rounded(sizing.near_maximum(fx.cells(spark, sf_dir), FLAW), ["share_hundredth", "share_tenth"])


@query(
    "top_percent_a15",
    with_tables(
        "cells",
        """, q AS (SELECT scan_id, flaw_id, quantile_cont(depth, 0.99) AS lim FROM cells GROUP BY 1, 2)
SELECT scan_id, flaw_id, round(quantile_cont(depth, 0.5), 6) AS bottom FROM cells JOIN q USING (scan_id, flaw_id) WHERE depth >= lim GROUP BY 1, 2""",
    ),
)
def top_percent(spark, sf_dir):
    return rounded(sizing.top_percent_median(fx.cells(spark, sf_dir), FLAW, "depth", 0.05), ["bottom"])


SURFACE_SQL = {
    "iqr": "SELECT scan_id, quantile_cont(amp, 0.25) - 1.5 * (quantile_cont(amp, 0.75) - quantile_cont(amp, 0.25)) AS lo, quantile_cont(amp, 0.75) + 1.5 * (quantile_cont(amp, 0.75) - quantile_cont(amp, 0.25)) AS hi FROM s GROUP BY 1",
    "percentile_2": "SELECT scan_id, quantile_cont(amp, 0.02) AS lo, quantile_cont(amp, 0.98) AS hi FROM s GROUP BY 1",
    "std": "SELECT scan_id, avg(amp) - 3 * stddev_pop(amp) AS lo, avg(amp) + 3 * stddev_pop(amp) AS hi FROM s GROUP BY 1",
}


@query(
    "surface_time_a16",
    with_tables(
        "cells",
        ", s AS (SELECT scan_id, amp FROM cells WHERE amp <> 0), "
        + ", ".join(f"{n} AS ({q})" for n, q in SURFACE_SQL.items())
        + " SELECT scan_id, method, surface FROM (SELECT scan_id, 'none' AS method, quantile_cont(amp, 0.5)::DOUBLE AS surface FROM s GROUP BY 1"
        + "".join(f" UNION ALL SELECT scan_id, '{n}', quantile_cont(amp, 0.5)::DOUBLE FROM s JOIN {n} USING (scan_id) WHERE amp BETWEEN lo AND hi GROUP BY 1" for n in SURFACE_SQL)
        + ")",
    ),
)
def surface_time(spark, sf_dir):
    rows = fx.cells(spark, sf_dir)
    out = None
    for method in ("none", "iqr", "percentile_2", "std"):
        part = sizing.surface_time(rows, ["scan_id"], "amp", method, 8.0).withColumn("method", F.lit(method))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "scrape_depth_a17_e4",
    with_tables(
        "cells",
        """, f AS (SELECT scan_id, frame, max(amp) AS bottom FROM cells WHERE flaw_id IN ('click', 'view') GROUP BY 1, 2),
s AS (SELECT scan_id, frame, quantile_cont(amp, 0.5) AS surface FROM cells WHERE flaw_id NOT IN ('click', 'view') AND amp <> 0 GROUP BY 1, 2),
l AS (SELECT scan_id, round((bottom - surface) * 0.0057::DOUBLE, 6) AS d FROM f JOIN s USING (scan_id, frame)),
q AS (SELECT scan_id, quantile_cont(d, 0.99) AS lim FROM l GROUP BY 1)
SELECT scan_id, round(quantile_cont(d, 0.5), 6) AS depth FROM l JOIN q USING (scan_id) WHERE d >= lim GROUP BY 1""",
    ),
)
def scrape_depth(spark, sf_dir):
    rows = fx.cells(spark, sf_dir)
    inside = F.col("flaw_id").isin("click", "view")
    return rounded(sizing.scrape_depth(rows.where(inside), rows.where(~inside), ["scan_id"], "frame", "amp", 0.0057, "none", 0.2), ["depth"])


@query(
    "profile_summary_a18",
    with_tables(
        "cells",
        """, f AS (SELECT scan_id, flaw_id, frame, max(depth) AS d FROM cells GROUP BY 1, 2, 3 HAVING max(depth) IS NOT NULL)
SELECT scan_id, flaw_id, round(avg(d), 9) AS mean_depth, round(stddev_pop(d), 9) AS depth_std, count(*)::BIGINT AS frames_analyzed, max(d) AS max_depth,
  arg_max(frame, struct_pack(d := d, f := -frame)) AS max_frame, round(stddev_pop(d) / avg(d), 9) AS depth_cv FROM f GROUP BY 1, 2""",
    ),
)
def profile_summary(spark, sf_dir):
    return rounded(sizing.profile_summary(fx.cells(spark, sf_dir), FLAW), ["mean_depth", "depth_std", "depth_cv"], 9)


@query(
    "line_changes_a26",
    with_tables(
        "ascans",
        """, c AS (SELECT scan_id, probe, frame, rotary_idx, list_max([abs(x - 128) FOR x IN samples]) AS v FROM ascans),
n AS (SELECT *, v - lag(v) OVER w AS d, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY scan_id, probe, frame ORDER BY rotary_idx)),
st AS (SELECT *, sign(d) AS s FROM n WHERE d <> 0),
b AS (SELECT *, CASE WHEN s = lag(s) OVER w THEN 0 ELSE 1 END AS brk FROM st WINDOW w AS (PARTITION BY scan_id, probe, frame ORDER BY n)),
g AS (SELECT *, sum(brk) OVER (PARTITION BY scan_id, probe, frame ORDER BY n) AS run FROM b),
r AS (SELECT scan_id, probe, frame, s, run, count(*) AS len FROM g GROUP BY ALL),
u AS (SELECT scan_id, probe, frame, max(CASE WHEN s > 0 THEN len ELSE 0 END) AS inc, max(CASE WHEN s < 0 THEN len ELSE 0 END) AS dec FROM r GROUP BY ALL),
l AS (SELECT scan_id, probe, frame, max(v) - min(v) AS rng, avg(v) AS mean, count(*) AS n FROM c GROUP BY ALL),
k AS (SELECT a.scan_id, a.probe, a.frame, corr(a.v, b.v) AS cr FROM c a JOIN c b ON b.scan_id = a.scan_id AND b.probe = a.probe AND b.frame = a.frame - 2 AND b.rotary_idx = a.rotary_idx GROUP BY 1, 2, 3)
SELECT l.scan_id, l.probe, max(rng) AS largest_range, CAST(arg_max(l.frame // 2, struct_pack(r := rng, f := -l.frame)) AS BIGINT) AS largest_range_line, round(avg(rng), 6) AS mean_range, round(avg(mean), 6) AS mean_value,
  round(max(coalesce(inc, 0) * 100.0 / n), 6)::DOUBLE AS increase_percent, round(max(coalesce(dec, 0) * 100.0 / n), 6)::DOUBLE AS decrease_percent, round(avg(cr), 6) AS mean_line_correlation, round(min(cr), 6) AS min_line_correlation
FROM l LEFT JOIN u USING (scan_id, probe, frame) LEFT JOIN k USING (scan_id, probe, frame) GROUP BY 1, 2""",
    ),
)
def line_changes(spark, sf_dir):
    """Frames of one probe alternate with those of the other, so its lines are every second frame."""
    cells = fx.ascans(spark, sf_dir).select(
        "scan_id", "probe", F.expr("frame DIV 2").alias("line"), "rotary_idx", F.array_max(F.transform("samples", lambda x: F.abs(x - 128))).alias("v")
    )
    out = sizing.line_changes(cells, ["scan_id", "probe"], "line", "rotary_idx", "v")
    return rounded(out, ["mean_range", "mean_value", "increase_percent", "decrease_percent", "mean_line_correlation", "min_line_correlation"])


@query(
    "depth_flags_a27",
    with_tables(
        "cells",
        """, p AS (SELECT *, abs(depth - lag(depth) OVER (PARTITION BY scan_id, flaw_id, frame ORDER BY rotary_idx)) AS jump FROM cells),
f AS (SELECT scan_id, flaw_id, frame, max(depth) AS mx, coalesce(sum(CASE WHEN jump >= 0.2 THEN jump END), 0) AS steep, count(*) FILTER (depth > 0.6) AS above FROM p GROUP BY 1, 2, 3),
t AS (SELECT *, max(mx) OVER (PARTITION BY scan_id, flaw_id) AS top FROM f)
SELECT scan_id, flaw_id, round(sum(steep), 6) AS steep_sum, round(100.0 * count(*) FILTER (mx < 0.1) / count(*), 6)::DOUBLE AS below_reportable_percent,
  round(100.0 * count(*) FILTER (mx >= top - 0.05::DOUBLE) / count(*), 6)::DOUBLE AS near_max_percent, sum(above)::BIGINT AS n_above FROM t GROUP BY 1, 2""",
    ),
)
def depth_flags(spark, sf_dir):
    out = sizing.depth_flags(fx.cells(spark, sf_dir), FLAW, 0.2, 0.1, 0.05, 0.6)
    return rounded(out, ["steep_sum", "below_reportable_percent", "near_max_percent"])


@query(
    "flaw_amplitude_a31",
    with_tables(
        "ascans, grid_flaws",
        """SELECT g.scan_id, g.probe, g.flaw_id, max(list_max(samples)) AS max_amp, max(least(greatest(2 * 128 - list_min(samples), 0), 255)) AS inverted_amp FROM grid_flaws g JOIN ascans a
  ON a.scan_id = g.scan_id AND a.probe = g.probe AND a.frame BETWEEN frame_start AND frame_end AND a.rotary_idx BETWEEN rotary_start AND rotary_end GROUP BY 1, 2, 3""",
    ),
)
def flaw_amplitude(spark, sf_dir):
    keys = ["scan_id", "probe"]
    cells = pj.flaw_cells(fx.grid_flaws(spark, sf_dir), fx.ascans(spark, sf_dir), keys, ["flaw_id", "rotary_start", "rotary_end"])
    inside = cells.where(F.col("rotary_idx").between(F.col("rotary_start"), F.col("rotary_end")))
    mirrored = F.least(F.greatest(F.lit(256) - F.array_min("samples"), F.lit(0)), F.lit(255))
    return inside.groupBy(*keys, "flaw_id").agg(F.max(F.array_max("samples")).alias("max_amp"), F.max(mirrored).alias("inverted_amp"))


@query("aligned_depth_j11_x13_e1")
def aligned_depth(spark, sf_dir):
    """Cells of every flaw against their most similar clean neighbours, then the deepest cell per flaw."""
    cells = sizing.size_by_alignment(fx.grid_flaws(spark, sf_dir), fx.ascans(spark, sf_dir), 2, 16)
    return sizing.deepest_cell(cells, ["scan_id", "probe", "flaw_id"])


@query("debris_depth_e2")
def debris_depth(spark, sf_dir):
    return sizing.debris_depth(fx.grid_flaws(spark, sf_dir), fx.ascans(spark, sf_dir), 2, 16, 16, 160)


CC_SQL = """, fp AS (SELECT scan_id, probe, frame, rotary_idx, flip, list_min([i FOR i IN range(1, 63) IF s[i + 1] >= 140 AND s[i + 1] > s[i] AND s[i + 1] >= s[i + 2]]) AS pk
  FROM (SELECT *, FALSE AS flip, samples AS s FROM ascans UNION ALL SELECT *, TRUE, [256 - x FOR x IN samples] FROM ascans)),
c AS (SELECT scan_id, probe, frame, rotary_idx FROM ascans a WHERE NOT EXISTS (SELECT 1 FROM grid_flaws g WHERE g.scan_id = a.scan_id AND g.probe = a.probe
  AND a.frame BETWEEN frame_start AND frame_end AND a.rotary_idx BETWEEN rotary_start AND rotary_end)),
n AS (SELECT g.scan_id, g.probe, c.frame, g.flaw_id, c.rotary_idx, c.rotary_idx < rotary_start AS low_side, row_number() OVER (PARTITION BY g.scan_id, g.probe, c.frame, g.flaw_id,
  c.rotary_idx < rotary_start ORDER BY abs(c.rotary_idx - CASE WHEN c.rotary_idx < rotary_start THEN rotary_start ELSE rotary_end END)) AS rk
  FROM grid_flaws g JOIN c ON c.scan_id = g.scan_id AND c.probe = g.probe AND c.frame BETWEEN frame_start AND frame_end WHERE NOT c.rotary_idx BETWEEN rotary_start AND rotary_end),
sd AS (SELECT n.scan_id, n.probe, n.frame, n.flaw_id, flip, low_side, avg(pk) AS a FROM n JOIN fp USING (scan_id, probe, frame, rotary_idx) WHERE rk <= 3 GROUP BY ALL),
su AS (SELECT scan_id, probe, frame, flaw_id, flip, avg(a) AS surface FROM sd GROUP BY ALL),
ce AS (SELECT g.scan_id, g.probe, g.flaw_id, fp.flip, CASE WHEN surface IS NOT NULL AND pk IS NOT NULL THEN greatest(round((surface - pk) * 0.008 * 0.71, 4), 0.0) END AS d
  FROM grid_flaws g JOIN fp ON fp.scan_id = g.scan_id AND fp.probe = g.probe AND fp.frame BETWEEN frame_start AND frame_end AND fp.rotary_idx BETWEEN rotary_start AND rotary_end
  LEFT JOIN su ON su.scan_id = g.scan_id AND su.probe = g.probe AND su.frame = fp.frame AND su.flaw_id = g.flaw_id AND su.flip = fp.flip),
a AS (SELECT scan_id, probe, flaw_id, flip, max(d) AS d, count(*) FILTER (d IS NULL) * 100.0 / count(*) AS m FROM ce GROUP BY ALL)
SELECT scan_id, probe, flaw_id, CASE WHEN (p.d IS NULL OR p.m > 50) AND f.d IS NOT NULL THEN f.d ELSE p.d END::DOUBLE AS depth, (p.d IS NULL OR p.m > 50) AND f.d IS NOT NULL AS flipped,
  round(least(p.m, f.m), 6)::DOUBLE AS missing_percent FROM (SELECT * FROM a WHERE NOT flip) p JOIN (SELECT * FROM a WHERE flip) f USING (scan_id, probe, flaw_id)"""


@query("cc_depth_e3_x14", with_tables("ascans, grid_flaws", CC_SQL))
def cc_depth(spark, sf_dir):
    return rounded(sizing.cc_depth(fx.grid_flaws(spark, sf_dir), fx.ascans(spark, sf_dir), 3, 140, 50.0), ["missing_percent"])


# reference points beside each flaw as in W14, for flaws anywhere in a turn
ALTERNATIVE_SQL = """, s AS (SELECT scan_id, probe, frame AS fr, rotary_idx AS x, list_max(samples)::DOUBLE AS v,
  list_transform(list_sort(list_transform([i FOR i IN range(1, 63) IF samples[i + 1] > samples[i] AND samples[i + 1] > samples[i + 2] AND samples[i + 1] >= 130],
    lambda i: {'n': -samples[i + 1], 'i': i}))[1:3], lambda e: e.i) AS pk FROM ascans),
f AS (SELECT scan_id, probe, flaw_id, unnest(range(frame_start, frame_end + 1)) AS fr, rotary_start AS fs, rotary_end AS fe, (rotary_start + rotary_end) // 2 AS fp FROM grid_flaws),
j AS (SELECT f.*, x, v, pk, (x - (fs + fe) / 2.0)::DOUBLE AS xx, NOT x BETWEEN fs AND fe AS o FROM f JOIN s USING (scan_id, probe, fr)),
m AS (SELECT scan_id, probe, fr, flaw_id, count(*) FILTER (o)::DOUBLE AS s0, sum(xx) FILTER (o) AS s1, sum(xx ** 2) FILTER (o) AS s2, sum(xx ** 3) FILTER (o) AS s3, sum(xx ** 4) FILTER (o) AS s4,
  sum(v) FILTER (o) AS t0, sum(v * xx) FILTER (o) AS t1, sum(v * xx * xx) FILTER (o) AS t2, greatest(min(x), any_value(fs) - 15) AS ls, least(max(x) + 1, any_value(fe) + 15) AS re FROM j GROUP BY 1, 2, 3, 4),
d AS (SELECT *, s0 * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) AS base FROM m),
k AS (SELECT scan_id, probe, fr, flaw_id, ls, re, (t0 * (s2 * s4 - s3 * s3) - s1 * (t1 * s4 - s3 * t2) + s2 * (t1 * s3 - s2 * t2)) / base AS c0,
  (s0 * (t1 * s4 - s3 * t2) - t0 * (s1 * s4 - s3 * s2) + s2 * (s1 * t2 - t1 * s2)) / base AS c1,
  (s0 * (s2 * t2 - t1 * s3) - s1 * (s1 * t2 - t1 * s2) + t0 * (s1 * s3 - s2 * s2)) / base AS c2 FROM d),
z AS (SELECT j.*, ls, re, v - (c0 + c1 * xx + c2 * xx * xx) AS flat FROM j JOIN k USING (scan_id, probe, fr, flaw_id)),
l AS (SELECT *, avg(CASE WHEN x < ls OR x > re THEN flat END) OVER (PARTITION BY scan_id, probe, fr, flaw_id) AS lev, least(fp - ls, re - fp) AS ideal FROM z),
c AS (SELECT *, CASE WHEN x >= ls AND x < fs THEN 'l' WHEN x >= fe AND x < re THEN 'r' END AS side FROM l),
b AS (SELECT *, round(abs(flat - lev) + 0.7::DOUBLE * abs((CASE side WHEN 'l' THEN x - ls ELSE x - fe END) - ideal), 9) AS score FROM c WHERE side IS NOT NULL),
g AS (SELECT scan_id, probe, fr, flaw_id, arg_min(x, struct_pack(s := score, p := x)) FILTER (side = 'l') AS lref, arg_min(x, struct_pack(s := score, p := x)) FILTER (side = 'r') AS rref FROM b GROUP BY 1, 2, 3, 4),
u AS (SELECT scan_id, probe, fr, flaw_id, avg(list_max(pk)) AS surface FROM j JOIN g USING (scan_id, probe, fr, flaw_id) WHERE x = lref OR x = rref GROUP BY 1, 2, 3, 4),
h AS (SELECT scan_id, probe, flaw_id, fr, x, coalesce(list_max(list_filter(pk, lambda i: i > surface)), list_max(pk)) - surface AS lag FROM j JOIN u USING (scan_id, probe, fr, flaw_id) WHERE x BETWEEN fs AND fe)
SELECT scan_id, probe, flaw_id, lag, fr AS frame, x AS rotary_idx FROM (SELECT *, row_number() OVER (PARTITION BY scan_id, probe, flaw_id ORDER BY lag DESC, fr, x) AS rk FROM h WHERE lag IS NOT NULL) WHERE rk = 1"""


@query("alternative_depth_e5", with_tables("ascans, grid_flaws", ALTERNATIVE_SQL))
def alternative_depth(spark, sf_dir):
    """Last flaw peak behind the surface peak, the surface taken at balanced reference points."""
    ascans = fx.ascans(spark, sf_dir)
    peaks = F.transform(ranking.top_peaks(F.col("samples"), 3, 130), lambda e: e["index"])
    rows = ascans.select(*FRAME, "rotary_idx", F.array_max("samples").cast("double").alias("v"), peaks.alias("peaks"))
    flaws = fx.grid_flaws(spark, sf_dir).select(
        "scan_id", "probe", "flaw_id", F.explode(F.sequence("frame_start", "frame_end")).alias("frame"), F.col("rotary_start").alias("flaw_start"),
        F.col("rotary_end").alias("flaw_end"), F.expr("(rotary_start + rotary_end) DIV 2").alias("flaw_position"),
    )
    refs = sizing.balanced_references(rows.select(*FRAME, "rotary_idx", "v"), flaws, FRAME, "rotary_idx", "v")
    surface = refs.join(rows, FRAME).where((F.col("rotary_idx") == F.col("left_ref")) | (F.col("rotary_idx") == F.col("right_ref")))
    level = surface.groupBy(*FRAME, "flaw_id").agg(F.avg(F.array_max("peaks")).alias("surface_peak"))
    cells = flaws.join(rows, FRAME).where(F.col("rotary_idx").between(F.col("flaw_start"), F.col("flaw_end"))).join(level, [*FRAME, "flaw_id"])
    lag = sizing.last_peak_right_of(F.col("peaks"), F.col("surface_peak")) - F.col("surface_peak")
    return cells.withColumn("lag", lag).where("lag IS NOT NULL").groupBy("scan_id", "probe", "flaw_id").agg(
        F.max_by(F.struct("lag", "frame", "rotary_idx"), F.struct("lag", (-F.col("frame")).alias("f"), (-F.col("rotary_idx")).alias("r"))).alias("b")
    ).select("scan_id", "probe", "flaw_id", "b.*")


@query(
    "sizing_dispatch_e7_e8",
    with_tables(
        "predicted",
        """, t AS (SELECT *, replace(flaw_type, ' (M)', '') AS cls FROM predicted)
SELECT scan_id, ind_num, CASE cls WHEN 'CC' THEN 'pc_cc' WHEN 'Debris' THEN NULL WHEN 'FBBPF' THEN 'nb_fbbpf' WHEN 'BM_FBBPF' THEN 'nb_fbbpf' ELSE 'nb_other' END AS method,
  CASE cls WHEN 'CC' THEN NULL WHEN 'Debris' THEN 'pc_cc' WHEN 'FBBPF' THEN 'pc_other' WHEN 'BM_FBBPF' THEN 'pc_cc' ELSE 'pc_other' END AS second_method,
  CASE WHEN width > 8 THEN coalesce(depth, length) ELSE coalesce(length, depth) END AS note1_depth FROM t""",
    ),
)
def sizing_dispatch(spark, sf_dir):
    first, second = sizing.dispatch(F.replace("flaw_type", F.lit(" (M)"), F.lit("")))
    depths = F.create_map(F.lit("CC"), F.col("depth"), F.lit("Debris"), F.col("length"))
    order = F.when(F.col("width") > 8, F.array(F.lit("CC"), F.lit("Debris"))).otherwise(F.array(F.lit("Debris"), F.lit("CC")))
    return fx.predicted(spark, sf_dir).select(
        "scan_id", "ind_num", first.alias("method"), second.alias("second_method"), sizing.category_depth(order, depths).alias("note1_depth")
    )


@query(
    "sizing_tables_s16",
    with_tables(
        "cells",
        """SELECT scan_id, flaw_id, count(depth)::BIGINT AS n_cells, max(depth) AS max_depth, count(*) FILTER (depth IS NULL)::BIGINT AS n_rejects FROM cells GROUP BY 1, 2""",
    ),
)
def sizing_tables(spark, sf_dir):
    """Cells, statistics and rejects written as tables and read back."""
    folder = scratch_path(spark, "sizing")
    rows = fx.cells(spark, sf_dir).withColumn("error", F.when(F.col("depth").isNull(), "no depth"))
    results.write_sizing_tables(rows, FLAW, folder)
    stats, rejects = (spark.read.parquet(f"{folder}/{t}") for t in ("depth_stats", "rejects"))
    failed = rejects.groupBy(*FLAW).agg(F.count(F.lit(1)).alias("n_rejects"))
    out = stats.select(*FLAW, "n_cells", "max_depth").join(failed, FLAW, "full")
    return out.select(*FLAW, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_cells", "n_rejects")], "max_depth")
