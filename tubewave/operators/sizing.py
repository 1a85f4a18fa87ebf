"""Depth sizing of flaws from their cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels, text
from ..functions import samples as sm
from .ordered import Series, adjacent, drop_abrupt, longest_changes
from .quantiles import exact_quantiles
from .signal import FRAME, detect_echoes, sample_matrix


def flaw_positions(flaws: DataFrame) -> DataFrame:
    """Every (frame, rotary position) that lies in any flaw, once. Flaws are unrolled, never range-joined."""
    frames = flaws.withColumn("frame", F.explode(F.sequence(F.col("frame_start").cast("bigint"), F.col("frame_end").cast("bigint"))))
    cells = frames.select(*FRAME, F.explode(F.sequence(F.col("rotary_start").cast("bigint"), F.col("rotary_end").cast("bigint"))).alias("rotary_idx"))
    return cells.distinct()


def echo_position(samples: Column, level: int) -> Column:
    """Position of the largest deviation; when that is a trough, of the next sample above the level (NULL without one)."""
    hi = F.array_position(samples, F.array_max(samples)) - 1
    lo = F.array_position(samples, F.array_min(samples)) - 1
    crest = F.abs(F.array_max(samples) - level) >= F.abs(F.array_min(samples) - level)
    after = F.transform(samples, lambda x, i: (x > level) & (i >= lo))
    up = F.array_position(after, F.lit(True)) - 1
    return F.when(crest, hi).when(up >= 0, up)


def clean_neighbours(flaws: DataFrame, positions: DataFrame, per_side: int, buffer: int = 0) -> DataFrame:
    """Nearest positions on both sides of each flaw and frame that lie in no flaw.

    ``positions`` lists the usable positions of every frame. The clean ones of a frame (at most one turn)
    become one array that all flaws of the frame share, so no flaw is paired with a whole frame of rows.
    """
    clean = positions.select(*FRAME, "rotary_idx").join(flaw_positions(flaws), [*FRAME, "rotary_idx"], "left_anti")
    arrays = clean.groupBy(*FRAME).agg(F.sort_array(F.collect_list("rotary_idx")).alias("_clean"))
    frames = flaws.select(
        *[k for k in FRAME if k != "frame"], "flaw_id", "rotary_start", "rotary_end",
        F.explode(F.sequence(F.col("frame_start").cast("bigint"), F.col("frame_end").cast("bigint"))).alias("frame"),
    )
    joined = frames.join(arrays, FRAME)
    below = F.filter("_clean", lambda p: p < F.col("rotary_start") - buffer)
    above = F.filter("_clean", lambda p: p > F.col("rotary_end") + buffer)
    left = F.slice(F.reverse(below), 1, per_side)
    right = F.slice(above, 1, per_side)

    def sided(values: Column, name: str) -> Column:
        return F.transform(values, lambda p, i: F.struct(i.alias("step"), F.lit(name).alias("side"), p.alias("rotary_idx")))

    both = F.concat(sided(left, "left"), sided(right, "right"))
    return joined.select(*FRAME, "flaw_id", F.explode(both).alias("n")).select(*FRAME, "flaw_id", "n.*")


def last_peak_right_of(peaks: Column, reference: Column) -> Column:
    """The last peak behind the reference, else the last peak of all."""
    return F.coalesce(F.array_max(F.filter(peaks, lambda p: p > reference)), F.array_max(peaks))


def balanced_references(series: DataFrame, flaws: DataFrame, keys: list[str], pos: str, value: str, search: int = 15, weight: float = 0.7) -> DataFrame:
    """Reference points left and right of a flaw in a series with a curved trend.

    The trend is the quadratic through everything outside the flaw, from sums that aggregate map-side.
    Near the flaw each point is scored by its distance from the mean level and from the ideal offset.
    """
    joined = series.join(flaws, keys)
    x = F.col(pos).cast("double") - (F.col("flaw_start") + F.col("flaw_end")) / 2
    rows = joined.withColumn("_x", x).withColumn("_out", ~F.col(pos).between(F.col("flaw_start"), F.col("flaw_end")))
    group = [*keys, "flaw_id", "flaw_position", "flaw_start", "flaw_end"]

    def total(expr: Column, name: str) -> Column:
        return F.sum(F.when(F.col("_out"), expr)).alias(name)

    sums = rows.groupBy(*group).agg(
        *[total(F.pow("_x", F.lit(k)), f"s{k}") for k in range(5)], *[total(F.pow("_x", F.lit(k)) * F.col(value), f"t{k}") for k in range(3)],
        F.min(pos).alias("_lo"), F.max(pos).alias("_hi"),
    )
    s0, s1, s2, s3, s4, t0, t1, t2 = (F.col(c) for c in ("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2"))

    def det(a, b, c, d, e, f, g, h, i):
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    base = det(s0, s1, s2, s1, s2, s3, s2, s3, s4)
    fit = sums.withColumns(
        {
            "_c0": det(t0, s1, s2, t1, s2, s3, t2, s3, s4) / base,
            "_c1": det(s0, t0, s2, s1, t1, s3, s2, t2, s4) / base,
            "_c2": det(s0, s1, t0, s1, s2, t1, s2, s3, t2) / base,
            "_ls": F.greatest(F.col("_lo"), F.col("flaw_start") - search),
            "_re": F.least(F.col("_hi") + 1, F.col("flaw_end") + search),
        }
    ).drop("s0", "s1", "s2", "s3", "s4", "t0", "t1", "t2")
    flat = rows.drop("_out").join(fit, group).withColumn(
        "_flat", F.col(value) - (F.col("_c0") + F.col("_c1") * F.col("_x") + F.col("_c2") * F.col("_x") * F.col("_x"))
    )
    far = (F.col(pos) < F.col("_ls")) | (F.col(pos) > F.col("_re"))
    level = flat.groupBy(*group).agg(F.avg(F.when(far, F.col("_flat"))).alias("_level"))
    ideal = F.least(F.col("flaw_position") - F.col("_ls"), F.col("_re") - F.col("flaw_position"))
    left = (F.col(pos) >= F.col("_ls")) & (F.col(pos) < F.col("flaw_start"))
    right = (F.col(pos) >= F.col("flaw_end")) & (F.col(pos) < F.col("_re"))
    offset = F.when(left, F.col(pos) - F.col("_ls")).otherwise(F.col(pos) - F.col("flaw_end"))
    score = F.round(F.abs(F.col("_flat") - F.col("_level")) + weight * F.abs(offset - ideal), 9)
    scored = flat.join(level, group).where(left | right).withColumn("_score", F.struct(score.alias("s"), F.col(pos).alias("p")))
    return scored.groupBy(*keys, "flaw_id").agg(
        F.min(F.when(left, F.col("_score")))["p"].alias("left_ref"), F.min(F.when(right, F.col("_score")))["p"].alias("right_ref")
    )


def deepest_cell(cells: DataFrame, keys: list[str], depth: str = "depth", amp: str = "amp") -> DataFrame:
    """Largest depth of a flaw with its first location and the amplitude there, and the size of its surroundings."""
    rank = F.when(F.col(depth).isNotNull(), F.struct(F.col(depth), (-F.col("frame")).alias("f"), (-F.col("rotary_idx")).alias("r")))
    top = cells.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(depth).alias("max_depth"), "frame", "rotary_idx", F.col(amp).alias("amp_at_max")), rank).alias("_t"),
        F.min(amp).alias("min_amp"), F.max(amp).alias("max_amp"), F.count(F.lit(1)).alias("n_cells"),
        (F.count_if(F.col(depth).isNull()) * 100 / F.count(F.lit(1))).alias("missing_percent"),
    )
    return top.select(*keys, "_t.*", "min_amp", "max_amp", "n_cells", "missing_percent")


def near_maximum(cells: DataFrame, keys: list[str], depth: str = "depth") -> DataFrame:
    """Number and share of cells within 0.01 and 0.1 mm of the deepest one.

    Depths are counted by value first, so the second pass over the maximum is over few rows.
    """
    counts = cells.groupBy(*keys, depth).agg(F.count(F.lit(1)).alias("_n"))
    top = counts.groupBy(*keys).agg(F.max(depth).alias("_max"), F.sum("_n").alias("_all"))
    joined = counts.join(top, keys)

    def near(by: float) -> Column:
        return F.coalesce(F.sum(F.when(F.col(depth) >= F.col("_max") - by, F.col("_n"))), F.lit(0))

    return joined.groupBy(*keys, "_all").agg(near(0.01).alias("n_hundredth"), near(0.1).alias("n_tenth")).select(
        *keys, "n_hundredth", (F.col("n_hundredth") / F.col("_all")).alias("share_hundredth"), "n_tenth", (F.col("n_tenth") / F.col("_all")).alias("share_tenth")
    )


def top_percent_median(cells: DataFrame, keys: list[str], value: str, width: float, percent: float = 0.99, largest: bool = True) -> DataFrame:
    """Median of the top (or bottom) percent of a flaw's values; NULLs do not count."""
    q = percent if largest else 1 - percent
    limit = exact_quantiles(cells, keys, value, {"_limit": q}, width)
    side = F.col(value) >= F.col("_limit") if largest else F.col(value) <= F.col("_limit")
    return exact_quantiles(cells.join(limit, keys).where(side), keys, value, {"bottom": 0.5}, width)


def surface_time(cells: DataFrame, keys: list[str], value: str, method: str, width: float) -> DataFrame:
    """Median of the non-zero surface values without outliers (``percentile_p``, ``iqr``, ``std`` or ``none``)."""
    rows = cells.where(F.col(value) != 0)
    if method.startswith("percentile"):
        p = int(method.split("_")[1]) / 100
        limits = exact_quantiles(rows, keys, value, {"_lo": p, "_hi": 1 - p}, width)
    elif method == "iqr":
        q = exact_quantiles(rows, keys, value, {"_q1": 0.25, "_q3": 0.75}, width)
        reach = 1.5 * (F.col("_q3") - F.col("_q1"))
        limits = q.select(*keys, (F.col("_q1") - reach).alias("_lo"), (F.col("_q3") + reach).alias("_hi"))
    elif method == "std":
        m = rows.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
        limits = m.select(*keys, (F.col("_m") - 3 * F.col("_s")).alias("_lo"), (F.col("_m") + 3 * F.col("_s")).alias("_hi"))
    elif method == "none":
        return exact_quantiles(rows, keys, value, {"surface": 0.5}, width)
    else:
        raise ValueError(f"unknown outlier method {method}")
    kept = rows.join(limits, keys).where(F.col(value).between(F.col("_lo"), F.col("_hi")))
    return exact_quantiles(kept, keys, value, {"surface": 0.5}, width)


def scrape_depth(flaw: DataFrame, surface: DataFrame, keys: list[str], line: str, value: str, factor: float, method: str, width: float, shear: bool = False) -> DataFrame:
    """Depth of a scrape: per line the extreme of the flaw against the surface there, then the top of all lines.

    ``line`` is the frame for axial and the rotary position for circumferential scrapes; shear probes see
    a depth as a shorter time.
    """
    extreme = F.min(value) if shear else F.max(value)
    bottoms = flaw.groupBy(*keys, line).agg(extreme.alias("_bottom"))
    surfaces = surface_time(surface, [*keys, line], value, method, width)
    diff = (F.col("surface") - F.col("_bottom")) if shear else (F.col("_bottom") - F.col("surface"))
    lines = bottoms.join(surfaces, [*keys, line]).withColumn("line_depth", F.round(diff * factor, 6))
    return top_percent_median(lines, keys, "line_depth", width).withColumnRenamed("bottom", "depth")


def profile_summary(cells: DataFrame, keys: list[str], depth: str = "depth") -> DataFrame:
    """Spread of the depth profile of a flaw over its frames."""
    frames = cells.groupBy(*keys, "frame").agg(F.max(depth).alias("_d")).where("_d IS NOT NULL")
    stats = frames.groupBy(*keys).agg(
        F.avg("_d").alias("mean_depth"), F.stddev_pop("_d").alias("depth_std"), F.count(F.lit(1)).alias("frames_analyzed"),
        F.max("_d").alias("max_depth"), F.max_by("frame", F.struct("_d", (-F.col("frame")).alias("neg"))).alias("max_frame"),
    )
    return stats.withColumn("depth_cv", F.when(F.col("mean_depth") != 0, F.col("depth_std") / F.col("mean_depth")))


def line_changes(cells: DataFrame, keys: list[str], line: str, along: str, value: str) -> DataFrame:
    """How a peak feature changes along the lines of a flaw.

    Per line: range, mean, longest rise and fall as a share of the line; per flaw: the largest and the
    mean range, its line, and the mean correlation of each line with the one before.
    """
    known_cells = cells.where(F.col(value).isNotNull()).withColumn("_line", F.col(line))
    group = [*keys, "_line"]
    ranges = known_cells.groupBy(*group).agg(
        (F.max(value) - F.min(value)).alias("_range"), F.avg(value).alias("_mean"), F.count(F.lit(1)).alias("_n")
    )
    steps = longest_changes(known_cells.select(*group, along, value), Series(group, [along], None), value)
    shifted = known_cells.select(*keys, (F.col("_line") + 1).alias("_line"), along, F.col(value).alias("_before"))
    pairs = known_cells.select(*group, along, value).join(shifted, [*group, along])
    linked = pairs.groupBy(*group).agg(F.when(F.count(F.lit(1)) > 1, F.corr(value, "_before")).alias("_corr"))
    lines = ranges.join(steps, group).join(linked, group, "left")
    rank = F.struct("_range", (-F.col("_line")).alias("neg"))
    corr = F.when(~F.isnan("_corr"), F.col("_corr"))
    return lines.groupBy(*keys).agg(
        F.max("_range").alias("largest_range"), F.max_by("_line", rank).alias("largest_range_line"), F.avg("_range").alias("mean_range"),
        F.avg("_mean").alias("mean_value"), F.max(F.col("largest_increase") * 100 / F.col("_n")).alias("increase_percent"),
        F.max(F.col("largest_decrease") * 100 / F.col("_n")).alias("decrease_percent"), F.avg(corr).alias("mean_line_correlation"), F.min(corr).alias("min_line_correlation"),
    )


def depth_flags(cells: DataFrame, keys: list[str], gradient: float, reportable: float, near: float, limit: float, depth: str = "depth") -> DataFrame:
    """Signs of an unreliable depth map: steep steps, shallow frames, cells near and above limits."""
    line = [*keys, "frame"]
    steps = adjacent(cells, Series(line, ["rotary_idx"], None), previous={"_p": F.col(depth)})
    jump = F.abs(F.col(depth) - F.col("_p"))
    frames = steps.groupBy(*line).agg(
        F.max(depth).alias("_max"), F.coalesce(F.sum(F.when(jump >= gradient, jump)), F.lit(0.0)).alias("_steep"), F.count(depth).alias("_n"),
        F.count_if(F.col(depth) > limit).alias("_above"),
    )
    top = frames.groupBy(*keys).agg(F.max("_max").alias("_top"))
    joined = frames.join(top, keys)
    return joined.groupBy(*keys).agg(
        F.sum("_steep").alias("steep_sum"), (F.count_if(F.col("_max") < reportable) * 100 / F.count(F.lit(1))).alias("below_reportable_percent"),
        (F.count_if(F.col("_max") >= F.col("_top") - near) * 100 / F.count(F.lit(1))).alias("near_max_percent"), F.sum("_above").alias("n_above"),
    )


# Sizing methods by class, first and second choice.
DISPATCH = [
    ("CC", "pc_cc", None),
    ("Debris", None, "pc_cc"),
    ("FBBPF", "nb_fbbpf", "pc_other"),
    ("BM_FBBPF", "nb_fbbpf", "pc_cc"),
]
OTHER_METHODS = ("nb_other", "pc_other")


def dispatch(flaw_type: Column) -> tuple[Column, Column]:
    """Primary and secondary sizing method of a class; scrapes and unknown classes use the map-based one."""
    first, second = F.lit(OTHER_METHODS[0]), F.lit(OTHER_METHODS[1])
    for name, primary, secondary in reversed(DISPATCH):
        first = F.when(flaw_type == name, F.lit(primary)).otherwise(first)
        second = F.when(flaw_type == name, F.lit(secondary)).otherwise(second)
    return first, second


def category_depth(categories: Column, depths: Column) -> Column:
    """First known depth in the order of the possible categories."""
    return F.get(F.filter(F.transform(categories, lambda c: F.try_element_at(depths, c)), lambda d: d.isNotNull()), F.lit(0))


PAIR_RESULT = "cost DOUBLE, lag INT, flaw_amp INT, surface_amp INT"


#: Rows of pairs that are sorted by size together, and cells of their alignment tables that are filled together.
TOGETHER, CELLS = 8192, 1_000_000


def align_pairs(pairs: DataFrame, block: int = 64) -> DataFrame:
    """Time-warping alignment of each row's ``flaw`` and ``surface`` window.

    Adds the alignment cost, and the offset and height of the highest flaw sample matched with the surface
    peak (``surface_peak``, an index into its window). One row in, one row out. The work is large for few bytes, so the rows
    are dealt to several tasks a core, and pairs of equal sizes are aligned side by side, some ``CELLS`` at a time.
    """
    kept = [c for c in pairs.columns if c not in ("flaw", "surface")]
    schema = pairs.select(*kept).schema
    target = T.StructType([*schema.fields, *T.StructType.fromDDL(PAIR_RESULT).fields])

    def several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= TOGETHER:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in several(batches):
            flaw, surface = batch.column("flaw"), batch.column("surface")
            sizes = np.stack([np.asarray(flaw.value_lengths()), np.asarray(surface.value_lengths())], axis=1)
            peaks = batch.column("surface_peak").to_numpy(zero_copy_only=False)
            result = np.zeros((batch.num_rows, 4))
            for size in np.unique(sizes, axis=0):
                rows = np.flatnonzero((sizes == size).all(axis=1))
                many = max(block, CELLS // int(np.prod(size + 1)))
                for part in np.array_split(rows, max(1, -(-len(rows) // many))):
                    a = sample_matrix(surface.take(pa.array(part))).astype(float)
                    b = sample_matrix(flaw.take(pa.array(part))).astype(float)
                    table = kernels.dtw_table(a, b)
                    at, each = kernels.dtw_matches(table, b, peaks[part]), np.arange(len(part))
                    result[part] = np.stack([np.sqrt(table[:, -1, -1]), at - peaks[part], b[each, at], a[each, peaks[part]]], axis=1)
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(result[:, 0]), *[pa.array(result[:, i].astype(np.int32)) for i in (1, 2, 3)]]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in target])

    spark = pairs.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return pairs.select(*kept, "flaw", "surface").repartition(tasks).mapInArrow(run, target)


def size_by_alignment(
    flaws: DataFrame, ascans: DataFrame, per_side: int, echo_width: int, buffer: int = 0, max_step: float = 0.3, cap_mm: float | None = None, invert: bool = False
) -> DataFrame:
    """Depth of every cell of a flaw against its most similar clean neighbour.

    Cells and neighbours are cut to their first echo, aligned pairwise (at most 2 * per_side pairs per
    cell), the neighbour of least cost gives the lag and the lag the depth; abrupt steps are removed.
    """
    data = ascans.withColumn("samples", sm.inverted(F.col("samples"), sm.array_median(F.col("samples"))).cast("array<int>")) if invert else ascans
    frames = flaws.select(
        *[k for k in FRAME if k != "frame"], "flaw_id", "rotary_start", "rotary_end",
        F.explode(F.sequence(F.col("frame_start").cast("bigint"), F.col("frame_end").cast("bigint"))).alias("frame"),
    )
    echo = detect_echoes(data, 1, 0, echo_width, signed=True).where(F.size("echoes") > 0).withColumn("e", F.get("echoes", F.lit(0)))
    windows = echo.join(data, [*FRAME, "rotary_idx"]).select(
        *FRAME, "rotary_idx", F.col("e.start").cast("int").alias("start"), F.col("e.peak_index").cast("int").alias("peak"), F.col("e.peak_value").alias("amp"),
        F.slice("samples", F.col("e.start") + 1, F.col("e.stop") - F.col("e.start")).alias("window"),
    ).where(F.size("window") > 0)
    cells = frames.join(windows, FRAME).where(F.col("rotary_idx").between(F.col("rotary_start"), F.col("rotary_end")))
    cells = cells.select(*FRAME, "flaw_id", "rotary_idx", F.col("start").alias("flaw_from"), "amp", F.col("window").alias("flaw"))
    around = clean_neighbours(flaws, ascans, per_side, buffer)
    surfaces = around.join(windows, [*FRAME, "rotary_idx"]).select(
        *FRAME, "flaw_id", "step", "side", F.col("rotary_idx").alias("surface_rotary"), F.col("start").alias("surface_from"),
        F.greatest(F.least(F.col("peak") - F.col("start"), F.size("window") - 1), F.lit(0)).alias("surface_peak"), F.col("window").alias("surface"),
    )
    aligned = align_pairs(cells.join(surfaces, [*FRAME, "flaw_id"]))
    best = aligned.groupBy(*FRAME, "flaw_id", "rotary_idx").agg(
        F.min_by(
            F.struct("cost", (F.col("lag") + F.col("flaw_from") - F.col("surface_from")).alias("lag"), F.col("flaw_amp").alias("amp"), "surface_rotary"),
            F.struct("cost", "step", "side"),
        ).alias("b")
    ).select(*FRAME, "flaw_id", "rotary_idx", "b.*")
    depth = best.withColumn("raw_depth", text.samples_to_mm(F.col("lag"), cap_mm))
    return drop_abrupt(depth, [*FRAME, "flaw_id"], "rotary_idx", "raw_depth", max_step, "depth")


def lowered_threshold(cells: DataFrame, keys: list[str], start: int, step: int = 2, lowest: int = 134) -> DataFrame:
    """Cells that pass an amplitude threshold which is lowered, frame by frame, until something passes.

    The threshold a frame ends at follows from its largest amplitude, so nothing has to be tried.
    """
    top = cells.groupBy(*keys).agg(F.max("amp").alias("_top"))
    down = F.greatest(F.ceil((F.lit(start) - F.col("_top")) / step), F.lit(0)) * step
    limit = F.lit(start) - down
    return cells.join(top, keys).withColumn("threshold", limit).where((F.col("threshold") >= lowest) & (F.col("amp") >= F.col("threshold"))).drop("_top")


def debris_depth(flaws: DataFrame, ascans: DataFrame, per_side: int, echo_width: int, echo_stop: int, threshold: int) -> DataFrame:
    """Depth of debris flaws from the plain, the echo-removed and the inverted signal of both normal-beam probes."""
    med = sm.array_median(F.col("samples"))
    removed = ascans.withColumn("samples", sm.without_first_echo(F.col("samples"), F.lit(0), F.lit(echo_stop), med).cast("array<int>"))
    keys = ["scan_id", "probe", "flaw_id"]

    def deepest(data: DataFrame, name: str, **options) -> DataFrame:
        cells = lowered_threshold(size_by_alignment(flaws, data, per_side, echo_width, **options), [*FRAME, "flaw_id"], threshold)
        return cells.groupBy(*keys).agg(F.max("depth").alias(name))

    plain = deepest(ascans, "pred_depth")
    return flaws.select(*keys).join(plain, keys, "left").join(deepest(removed, "echo_removed"), keys, "left").join(
        deepest(ascans, "inverted", invert=True), keys, "left"
    )


def cc_depth(flaws: DataFrame, ascans: DataFrame, per_side: int, amplitude: int, max_missing: float, cap_mm: float | None = None) -> DataFrame:
    """Depth of crevice flaws from shear probes: first peak of a cell against the first peaks next to the flaw.

    Both polarities are computed; the flipped one is used where the plain one leaves too many cells
    without a depth. Depth uses the mean of the two sides.
    """
    keys = ["scan_id", "probe", "flaw_id"]
    around = clean_neighbours(flaws, ascans, per_side)
    frames = flaws.select(
        "scan_id", "probe", "flaw_id", "rotary_start", "rotary_end",
        F.explode(F.sequence(F.col("frame_start").cast("bigint"), F.col("frame_end").cast("bigint"))).alias("frame"),
    )

    def one(flip: bool) -> DataFrame:
        signal = F.transform("samples", lambda x: F.lit(256) - x) if flip else F.col("samples")
        first = ascans.select(*FRAME, "rotary_idx", first_peak(signal, amplitude).alias("at"))
        sides = around.join(first, [*FRAME, "rotary_idx"]).groupBy(*FRAME, "flaw_id", "side").agg(F.avg("at").alias("_side"))
        surface = sides.groupBy(*FRAME, "flaw_id").agg(F.avg("_side").alias("_surface"))
        cells = frames.join(first, FRAME).where(F.col("rotary_idx").between(F.col("rotary_start"), F.col("rotary_end"))).join(surface, [*FRAME, "flaw_id"], "left")
        depth = text.samples_to_mm(F.col("_surface") - F.col("at"), cap_mm)
        return cells.withColumn("depth", depth).groupBy(*keys).agg(
            F.max("depth").alias("depth"), (F.count_if(F.col("depth").isNull()) * 100 / F.count(F.lit(1))).alias("missing")
        )

    plain = one(False).withColumnsRenamed({"depth": "_d", "missing": "_m"})
    flipped = one(True).withColumnsRenamed({"depth": "_fd", "missing": "_fm"})
    retry = F.col("_d").isNull() | (F.col("_m") > max_missing)
    return flaws.select(*keys).join(plain, keys, "left").join(flipped, keys, "left").select(
        *keys, F.when(retry & F.col("_fd").isNotNull(), F.col("_fd")).otherwise(F.col("_d")).alias("depth"), (retry & F.col("_fd").isNotNull()).alias("flipped"),
        F.least("_m", "_fm").alias("missing_percent"),
    )


def first_peak(samples: Column, amplitude: int) -> Column:
    """Position of the first local maximum of at least an amplitude."""

    def is_peak(x: Column, i: Column) -> Column:
        before, after = F.get(samples, i - 1), F.get(samples, i + 1)
        return F.coalesce((x >= amplitude) & (x > before) & (x >= after), F.lit(False))

    at = F.array_position(F.transform(samples, is_peak), F.lit(True)) - 1
    return F.when(at >= 0, at)
