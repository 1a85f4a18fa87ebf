"""A-scan operators: echoes, correlation, lags, time of flight, smoothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import samples as sm
from ..operators import peaks, signal, wavegroups
from ..operators.ordered import Series
from ..operators.signal import FRAME
from . import fixtures as fx
from .fixtures import with_tables
from .registry import query

KEYS = [*FRAME, "rotary_idx"]
def centred(name):
    return F.transform(name, lambda x: (x - 128).cast("double"))


FIRST_SQL = """f AS (SELECT scan_id, probe, frame, min(rotary_idx) AS r0 FROM ascans GROUP BY 1, 2, 3),
p AS (SELECT a.scan_id, a.probe, a.frame, a.rotary_idx, [CAST(x - 128 AS DOUBLE) FOR x IN r.samples] AS t, [CAST(x - 128 AS DOUBLE) FOR x IN a.samples] AS u
  FROM ascans a JOIN f USING (scan_id, probe, frame) JOIN ascans r ON r.scan_id = a.scan_id AND r.probe = a.probe AND r.frame = a.frame AND r.rotary_idx = f.r0)"""
COR_SQL = """CASE WHEN list_dot_product(t[{t}], t[{t}]) * list_dot_product(u[{u}], u[{u}]) > 0 THEN list_dot_product(t[{t}], u[{u}])
  / sqrt(list_dot_product(t[{t}], t[{t}]) * list_dot_product(u[{u}], u[{u}])) ELSE 0.0 END"""


def first_references(ascans):
    return ascans.groupBy(*FRAME).agg(F.min("rotary_idx").alias("reference_loc"))


def with_reference(ascans):
    """Each A-scan with the one at the reference position of its frame."""
    first = ascans.groupBy(*FRAME).agg(F.min_by("samples", "rotary_idx").alias("reference"))
    return ascans.join(first, FRAME)


@query(
    "strongest_echo_x1",
    with_tables(
        "ascans",
        """, m AS (SELECT *, [abs(x - 128) FOR x IN samples] AS dev FROM ascans),
a AS (SELECT *, list_position(dev, list_max(dev)) - 1 AS p0 FROM m),
b AS (SELECT *, greatest(p0 - 10, 0) AS lo, least(p0 + 10, 63) AS hi FROM a),
c AS (SELECT *, hi + 1 - list_position(list_reverse(samples[lo + 2:hi + 1]), list_max(samples[lo + 2:hi + 1])) AS peak FROM b)
SELECT scan_id, probe, frame, rotary_idx, CAST(peak AS INTEGER) AS peak_index, dev[peak + 1] AS peak_value, CAST(greatest(peak - 10, 0) AS INTEGER) AS start,
  CAST(least(peak + 10, 63) AS INTEGER) AS stop, round(list_avg(dev[greatest(peak - 10, 0) + 1:least(peak + 10, 63)]), 4) AS avg FROM c WHERE dev[peak + 1] >= 10""",
    ),
)
def strongest_echo(spark, sf_dir):
    found = signal.detect_echoes(fx.ascans(spark, sf_dir), 1, 10, 20).select(*KEYS, F.explode("echoes").alias("e"))
    return found.select(*KEYS, F.col("e.peak_index").cast("int").alias("peak_index"), F.col("e.peak_value").cast("bigint").alias("peak_value"), F.col("e.start").cast("int").alias("start"), F.col("e.stop").cast("int").alias("stop"), F.round(F.col("e.avg").cast("double"), 4).alias("avg"))


@query("echo_candidates_x1_x2")
def echo_candidates(spark, sf_dir):
    return signal.detect_echoes(fx.ascans(spark, sf_dir), 2, 10, 20).select(*KEYS, F.explode("echoes").alias("e")).select(*KEYS, "e.*")


@query("frame_wavegroups_x3")
def frame_wavegroups(spark, sf_dir):
    return signal.frame_wavegroups(fx.ascans(spark, sf_dir), 2, 10, 20)


@query(
    "correlations_x5",
    with_tables(
        "ascans",
        f""", {FIRST_SQL}
SELECT scan_id, probe, frame, rotary_idx, round({COR_SQL.format(t='1:64', u='1:64')}, 6) AS cor0, round({COR_SQL.format(t='1:61', u='4:64')}, 6) AS cor3,
  round({COR_SQL.format(t='6:64', u='1:59')}, 6) AS cor_minus5 FROM p""",
    ),
)
def correlations(spark, sf_dir):
    rows = with_reference(fx.ascans(spark, sf_dir))
    t, u = centred("reference"), centred("samples")
    cors = {"cor0": 0, "cor3": 3, "cor_minus5": -5}
    return rows.select(*KEYS, *[F.round(signal.correlation_at(t, u, F.lit(lag)), 6).alias(n) for n, lag in cors.items()])


@query(
    "best_lag_x6",
    with_tables(
        "ascans",
        f""", {FIRST_SQL},
l AS (SELECT *, unnest([4, 3, 2, 1, 0, -1, -2, -3, -4]) AS lag FROM p),
c AS (SELECT scan_id, probe, frame, rotary_idx, lag, round({COR_SQL.format(t='greatest(-lag, 0) + 1:64 - greatest(lag, 0)', u='greatest(lag, 0) + 1:64 - greatest(-lag, 0)')}, 12) AS cor FROM l)
SELECT scan_id, probe, frame, rotary_idx, CAST(arg_max(lag, struct_pack(c := cor, l := lag)) AS INTEGER) AS lag, round(max(cor), 6) AS cor FROM c GROUP BY 1, 2, 3, 4""",
    ),
)
def best_lag(spark, sf_dir):
    rows = with_reference(fx.ascans(spark, sf_dir))
    best = signal.best_lag(centred("reference"), centred("samples"), -4, 4)
    return rows.select(*KEYS, best.alias("b")).select(*KEYS, F.col("b.lag").alias("lag"), F.round("b.cor", 6).alias("cor"))


def tracked(spark, sf_dir, reach: int = 6):
    ascans = fx.ascans(spark, sf_dir)
    return signal.track_frame_lags(ascans, first_references(ascans), reach)


@query("tracked_lags_x7")
def tracked_lags(spark, sf_dir):
    return tracked(spark, sf_dir)


@query("time_of_flight_x8")
def time_of_flight(spark, sf_dir):
    ascans = fx.ascans(spark, sf_dir)
    tof = signal.time_of_flight(signal.frame_wavegroups(ascans, 2, 10, 20), first_references(ascans), tracked(spark, sf_dir), 0.0057)
    return tof.join(signal.flatten_frames(tof, "tof_samples"), KEYS)


@query(
    "lag_to_flight_time_x8",
    with_tables(
        "series",
        """, f AS (SELECT frame // 64 AS fr, arg_min(lag, frame) AS lag0, min(frame) AS first, arg_min(CAST(floor(full_value) AS BIGINT), frame) AS peak FROM series GROUP BY 1)
SELECT s.frame, CASE WHEN s.frame = f.first THEN f.peak + f.lag0 ELSE f.peak + f.lag0 + s.lag END AS tof_samples FROM series s JOIN f ON f.fr = s.frame // 64""",
    ),
)
def lag_to_flight_time(spark, sf_dir):
    """The same arithmetic on lags taken from the event table, frames of 64 positions."""
    rows = fx.series(spark, sf_dir).select(
        F.lit(0).alias("scan_id"), F.lit("NB1").alias("probe"), F.expr("frame DIV 64").alias("frame"), F.col("frame").alias("rotary_idx"),
        "lag", F.lit(1.0).alias("cor"), F.floor("full_value").alias("peak_index"),
    )
    refs = rows.groupBy(*FRAME).agg(F.min("rotary_idx").alias("reference_loc"))
    tof = signal.time_of_flight(rows, refs, rows.drop("peak_index"), 0.0057)
    return tof.select(F.col("rotary_idx").alias("frame"), "tof_samples")


@query(
    "slice_bounds_x9",
    with_tables(
        "series",
        """SELECT scan_id, frame // 5 AS fr, CAST(coalesce(round_even(min(value), 0), 0) AS BIGINT) AS lower, CAST(coalesce(round_even(max(value + lag), 0), 0) AS BIGINT) AS upper
FROM series GROUP BY 1, 2""",
    ),
)
def slice_bounds(spark, sf_dir):
    slices = fx.series(spark, sf_dir).select(
        "scan_id", F.expr("frame DIV 5").alias("frame"), (F.col("frame") % 5).alias("slice"), F.col("value").alias("start"), (F.col("value") + F.col("lag")).alias("end")
    )
    return wavegroups.frame_bounds(slices).withColumnRenamed("frame", "fr")


@query(
    "rotary_bands_x10",
    with_tables(
        "ascans",
        """, s AS (SELECT *, count(*) OVER (PARTITION BY scan_id, probe, frame) // 5 AS band FROM ascans)
SELECT scan_id, probe, frame, rotary_idx // band AS slice, count(*)::BIGINT AS n FROM s WHERE band > 0 AND rotary_idx // band < 5 GROUP BY 1, 2, 3, 4""",
    ),
)
def rotary_bands(spark, sf_dir):
    bands = wavegroups.rotary_bands(fx.ascans(spark, sf_dir), FRAME, 5)
    return bands.groupBy(*FRAME, "slice").agg(F.count(F.lit(1)).alias("n"))


@query(
    "imputed_slices_x11",
    with_tables(
        "series",
        """, s AS (SELECT scan_id * 5 + frame % 5 AS sid, frame, CASE WHEN full_value + lag > 120 THEN NULL ELSE value END AS v FROM series),
q AS (SELECT sid, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM s GROUP BY 1),
a AS (SELECT s.sid, frame, CASE WHEN v >= q3 + 1.5 * (q3 - q1) OR v <= q1 - 1.5 * (q3 - q1) THEN NULL ELSE v END AS v FROM s JOIN q USING (sid)),
n AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY frame) AS n FROM a), k AS (SELECT *, CASE WHEN v IS NOT NULL THEN n END AS kn FROM n),
b AS (SELECT *, last_value(kn IGNORE NULLS) OVER p AS an, last_value(v IGNORE NULLS) OVER p AS av, first_value(kn IGNORE NULLS) OVER f AS bn, first_value(v IGNORE NULLS) OVER f AS bv
  FROM k WINDOW p AS (PARTITION BY sid ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY sid ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT sid, frame, round(CASE WHEN an IS NULL OR bn IS NULL THEN coalesce(av, bv) WHEN bn = an THEN av ELSE av + (bv - av) * (CAST(n - an AS DOUBLE) / (bn - an)) END, 4) AS filled,
  v IS NULL AS imputed FROM b""",
    ),
)
def imputed_slices(spark, sf_dir):
    rows = fx.series(spark, sf_dir).select(
        (F.col("scan_id") * 5 + F.col("frame") % 5).alias("sid"), "frame", F.col("value").alias("start"), (F.col("full_value") + F.col("lag")).alias("end")
    )
    out = wavegroups.impute_slices(rows, ["sid"], limit=120.0, chunk=4000, width=5.0)
    return out.select("sid", "frame", F.round("filled", 4).alias("filled"), "imputed")


@query("smoothed_lags_w11_w12_w13")
def smoothed_lags(spark, sf_dir):
    lags = tracked(spark, sf_dir)
    mask = signal.indication_mask(lags, 4, 2.0, 2.0, 3, 3, 21, 0.4)
    marked = lags.join(mask, KEYS)
    return marked.join(signal.flatten_frames(marked, "lag", "indication", 5, 31), KEYS)


@query("chatter_a29_x17")
def chatter(spark, sf_dir):
    """Largest and mean chatter per frame from the smoother of two lag series."""
    a = tracked(spark, sf_dir)
    b = tracked(spark, sf_dir, 3).select(*KEYS, F.col("lag").alias("backup_lag"))
    both = a.join(b, KEYS).withColumn("in_flaw", F.lit(False))
    flat = signal.smoother_lags(both, "lag", "backup_lag", 3, 21, 3, 2.0, "in_flaw")
    peaks = signal.chatter_peaks(flat, "flat_lag", 0.5, 1.0)
    return peaks.groupBy(*FRAME).agg(F.max("peak").alias("largest"), F.avg("peak").alias("mean"), F.count(F.lit(1)).alias("n"))


@query(
    "reflection_tests_x15_a28",
    with_tables(
        "ascans",
        """, f AS (SELECT scan_id, probe, frame, arg_min(samples, rotary_idx) AS ref FROM ascans GROUP BY 1, 2, 3),
m AS (SELECT a.scan_id, a.probe, a.frame, a.rotary_idx, list_max(ref[11:41]) AS smax, list_min(ref[11:41]) AS smin, list_max(samples[11:41]) AS fmax, list_min(samples[11:41]) AS fmin,
  list_stddev_pop(samples[41:]) AS sd FROM ascans a JOIN f USING (scan_id, probe, frame)),
d AS (SELECT *, greatest(smax - fmax, fmin - smin) AS diff, greatest(fmax::DOUBLE / smax, smin::DOUBLE / (fmin + 1)) AS ratio FROM m),
r AS (SELECT *, diff >= 20 AS open_surface, sd >= 10 AND CASE WHEN smax < 220 AND smin > 30 THEN ratio < CASE WHEN sd > 1.6 THEN 1.01 ELSE 0.95 END ELSE diff >= CASE WHEN sd > 1.6 THEN 0 ELSE 15 END END AS reflection FROM d),
w AS (SELECT *, open_surface OR coalesce(lag(open_surface) OVER w, FALSE) OR coalesce(lead(open_surface) OVER w, FALSE) AS near_open FROM r WINDOW w AS (PARTITION BY scan_id, probe, frame ORDER BY rotary_idx))
SELECT scan_id, probe, frame, count(*) FILTER (reflection)::BIGINT AS n_reflections, count(*) FILTER (reflection AND NOT near_open)::BIGINT AS n_kept, count(*) FILTER (open_surface)::BIGINT AS n_open,
  max(diff) AS max_diff FROM w GROUP BY 1, 2, 3""".replace("list_stddev_pop(samples[41:])", "list_aggregate(samples[41:], 'stddev_pop')"),
    ),
)
def reflection_tests(spark, sf_dir):
    from ..operators import reflections

    rows = with_reference(fx.ascans(spark, sf_dir))
    tested = reflections.first_echo_tests(rows, 10, 40, diff_limit=15, ratio_limit=0.95, std_limit=10, open_limit=20)
    return reflections.count_reflections(reflections.away_from_open_surface(tested, FRAME), FRAME)


@query(
    "row_maxima_x16",
    with_tables(
        "ascans, grid_flaws",
        """, m AS (SELECT a.*, list_position(samples, list_max(samples)) - 1 AS hi, list_position(samples, list_min(samples)) - 1 AS lo FROM ascans a
  WHERE NOT EXISTS (SELECT 1 FROM grid_flaws g WHERE g.scan_id = a.scan_id AND g.probe = a.probe AND a.frame BETWEEN frame_start AND frame_end AND a.rotary_idx BETWEEN rotary_start AND rotary_end)),
e AS (SELECT *, abs(samples[hi + 1] - 128) >= abs(samples[lo + 1] - 128) AS crest FROM m),
x AS (SELECT *, CASE WHEN crest THEN hi ELSE lo + list_position([v > 128 FOR v IN samples[lo + 1:]], TRUE) - 1 END AS pos FROM e)
SELECT scan_id, probe, frame, count(pos)::BIGINT AS n, round(avg(pos), 6) AS mean_pos FROM x GROUP BY 1, 2, 3""",
    ),
)
def row_maxima(spark, sf_dir):
    """Mean first-echo position of the rows outside every box; after a trough the next sample above the level."""
    from ..operators import sizing

    ascans = fx.ascans(spark, sf_dir)
    inside = sizing.flaw_positions(fx.grid_flaws(spark, sf_dir))
    clean = ascans.join(inside, KEYS, "left_anti")
    return clean.select(*FRAME, sizing.echo_position(F.col("samples"), 128).alias("pos")).groupBy(*FRAME).agg(
        F.count("pos").alias("n"), F.round(F.avg("pos"), 6).alias("mean_pos")
    )


@query(
    "simple_maps_a30",
    with_tables(
        "ascans",
        """, d AS (SELECT *, [abs(x - 128) FOR x IN samples] AS dev FROM ascans)
SELECT scan_id, probe, frame, rotary_idx, list_max(dev)::DOUBLE AS amp, round(list_avg(dev), 4) AS average_amplitude,
  round(list_sum(dev) - (dev[1] + dev[-1]) / 2, 4)::DOUBLE AS area_under_curve FROM d""",
    ),
)
def simple_maps(spark, sf_dir):
    rows = fx.ascans(spark, sf_dir).withColumn("dev", F.transform("samples", lambda x: F.abs(x - 128)))
    dev = F.col("dev")
    return rows.select(
        *KEYS, F.array_max(dev).cast("double").alias("amp"), F.round(sm.total(dev) / F.size(dev), 4).alias("average_amplitude"),
        F.round(sm.trapezoid(dev), 4).alias("area_under_curve"),
    )

@query(
    "rescored_frames_x10",
    with_tables(
        "series",
        """, r AS (SELECT scan_id, frame, value IS NULL AS missing_g4, full_value / 100 AS overlap FROM series),
m AS (SELECT *, sum(CASE WHEN missing_g4 IS DISTINCT FROM before THEN 1 ELSE 0 END) OVER (PARTITION BY scan_id ORDER BY frame) AS run
  FROM (SELECT *, lag(missing_g4) OVER (PARTITION BY scan_id ORDER BY frame) AS before FROM r)),
n AS (SELECT *, row_number() OVER (PARTITION BY scan_id, run ORDER BY frame) AS k FROM m)
SELECT scan_id, frame, missing_g4, overlap FROM n WHERE (missing_g4 AND (k - 1) % 3 = 0) OR overlap > 0.9""",
    ),
)
def rescored_frames(spark, sf_dir):
    """Frames for a second round: every third one of a run without the last echo group, and those with much overlap."""
    report = fx.series(spark, sf_dir).select("scan_id", "frame", F.col("value").isNull().alias("missing_g4"), (F.col("full_value") / 100).alias("overlap"))
    return wavegroups.rescore_frames(report, Series(["scan_id"], ["frame"], 500), 3, 0.9).select("scan_id", "frame", "missing_g4", "overlap")


PEAKS_SQL = """, a AS (SELECT scan_id, probe, frame, rotary_idx, samples AS s, len(samples) AS n FROM ascans),
u AS (SELECT *, list_transform(list_filter(list_transform(list_filter(range(2, n), lambda i: s[i] > s[i - 1] AND s[i] >= 135),
    lambda i: {'i': i, 'j': list_filter(range(i, n), lambda j: s[j + 1] <> s[i])[1]}), lambda t: t.j IS NOT NULL AND s[t.j + 1] < s[t.i]), lambda t: (t.i + t.j - 2) // 2) AS p FROM a),
o AS (SELECT *, list_transform(list_reverse_sort(list_transform(p, lambda x: {'h': s[x + 1], 'p': x})), lambda x: [x.p]) AS q FROM u WHERE len(p) > 0),
k AS (SELECT *, unnest(list_reduce(q, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: abs(y - x[1]) < 6)) = 0 THEN list_concat(acc, x) ELSE acc END)) AS place FROM o),
b AS (SELECT *, s[place + 1] AS top, list_min(s[coalesce(list_max(list_filter(range(0, place), lambda y: s[y + 1] > s[place + 1])) + 1, 0) + 1 : place + 1]) AS lo,
  list_min(s[place + 1 : coalesce(list_min(list_filter(range(place + 1, n), lambda y: s[y + 1] > s[place + 1])) - 1, n - 1) + 1]) AS hi FROM k),
m AS (SELECT *, (top - greatest(lo, hi))::DOUBLE AS prominence, top - (top - greatest(lo, hi)) / 2.0 AS level FROM b),
e AS (SELECT *, list_max(list_filter(range(0, place), lambda y: s[y + 1] <= level)) AS l, list_min(list_filter(range(place + 1, n), lambda y: s[y + 1] <= level)) AS r FROM m WHERE prominence >= 25),
w AS (SELECT *, round(r - (level - s[r + 1]) / (s[r] - s[r + 1]) - (l + (level - s[l + 1]) / (s[l + 2] - s[l + 1])), 9)::DOUBLE AS width FROM e)"""


@query(
    "prominent_peaks_x4",
    with_tables("ascans", PEAKS_SQL + """
SELECT scan_id, probe, frame, rotary_idx, place::INTEGER AS place, top::DOUBLE AS height, prominence, round(width, 6)::DOUBLE AS width FROM w WHERE width >= 1.2"""),
)
def prominent_peaks(spark, sf_dir):
    """Peaks of at least a height, a distance to higher ones, a prominence and a width, with these properties."""
    found = peaks.sample_peaks(fx.ascans(spark, sf_dir), [*FRAME, "rotary_idx"], PEAKS)
    each = found.select(*FRAME, "rotary_idx", F.explode("peaks").alias("p"))
    return each.select(*FRAME, "rotary_idx", "p.place", "p.height", "p.prominence", F.round("p.width", 6).alias("width"))


#: What a peak of an echo has to have.
PEAKS = peaks.PeakRule(height=135, distance=6, prominence=25, width=1.2)


@query(
    "chosen_peaks_x14",
    with_tables("ascans", PEAKS_SQL + """, g AS (SELECT scan_id, probe, frame, rotary_idx, min(place) AS first_place, max(place) AS last_place, arg_max(place, (top, -place)) AS highest_place,
  max(CASE WHEN place < 30 THEN place END) AS last_before FROM w WHERE width >= 1.2 GROUP BY 1, 2, 3, 4)
SELECT a.scan_id, a.probe, a.frame, a.rotary_idx, first_place::INTEGER AS first_place, last_place::INTEGER AS last_place, highest_place::INTEGER AS highest_place,
  last_before::INTEGER AS last_before FROM a LEFT JOIN g USING (scan_id, probe, frame, rotary_idx)"""),
)
def chosen_peaks(spark, sf_dir):
    """The surface peak of every A-scan by each rule of choice; NULL where no peak qualifies."""
    found = peaks.sample_peaks(fx.ascans(spark, sf_dir), [*FRAME, "rotary_idx"], PEAKS)
    rules = {"first_place": ("first", None), "last_place": ("last", None), "highest_place": ("highest", None), "last_before": ("last", F.lit(30))}
    return found.select(*FRAME, "rotary_idx", *[peaks.choose_peak(F.col("peaks"), rule, limit)["place"].alias(name) for name, (rule, limit) in rules.items()])
