"""End-to-end flows: from A-scans to sized flaws."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import samples as sm
from ..functions import text
from ..operators import learning, merging, ranking, scoring, signal, sizing, tiling
from ..operators import projections as pj
from ..operators.ordered import Series, numbered
from ..operators.scoring import Detector
from ..operators.signal import FRAME
from ..operators.tiling import Model
from ..session import cut_lineage

MORPHOLOGY = ["V", "7", "default", "MR", "Spaghetti"]


def feature_maps(ascans: DataFrame, echo_width: int, threshold: float, reach: int, factor: float, steady: int = 10) -> DataFrame:
    """All maps of a scan, one row per position: wavegroup, lag, correlation, time of flight and its flattened form."""
    groups = signal.frame_wavegroups(ascans, 2, threshold, echo_width)
    references = signal.reference_positions(groups.withColumn("_ok", F.col("peak_index") != 0), "_ok", steady)
    lags = signal.track_frame_lags(ascans, references, reach)
    tof = signal.time_of_flight(groups, references, lags, factor)
    flat = signal.flatten_frames(tof, "tof_samples").withColumn("tof_flat", F.col("flat") * factor).drop("flat")
    return groups.join(tof, [*FRAME, "rotary_idx"]).join(flat, [*FRAME, "rotary_idx"])


#: Maps that a detector sees as channels of one image: flattened time of flight (turned over), echo amplitude, correlation.
CHANNELS = ["tof_turned", "avg", "cor"]
MAP = ["scan_id", "probe"]


def three_channels(maps: DataFrame) -> DataFrame:
    """Values of the three channels at every position of a map, each stretched to 0..255 over its map."""
    scaled = maps
    for value, out in (("tof_flat", "_tof"), ("avg", "_avg"), ("cor", "_cor")):
        scaled = pj.normalise(scaled, MAP, value, out)
    return scaled.select(*FRAME, "rotary_idx", (255 - F.col("_tof")).alias("tof_turned"), F.col("_avg").alias("avg"), F.col("_cor").alias("cor"))


#: Prefix of the numbers of a flaw type; all others are indications.
PREFIXES = {"FBBPF": "MP", "BM_FBBPF": "BM"}


def number_flaws(flaws: DataFrame) -> DataFrame:
    """``ind_num``: flaws of a scan numbered by prefix, in the order of their first frame."""
    prefix = F.coalesce(*[F.when(F.col("flaw_type") == kind, name) for kind, name in PREFIXES.items()], F.lit("Ind"))
    order = Series(["scan_id", "_prefix"], ["frame_start", "rotary_start", "flaw_id"], 1000)
    counted = numbered(flaws.withColumn("_prefix", prefix), order, "_number")
    return counted.withColumn("ind_num", F.concat_ws(" ", "_prefix", F.col("_number").cast("string"))).drop("_prefix", "_number")


def detect_flaws(maps: DataFrame, models: list[Model], confidence: float, probabilities: Callable[[DataFrame], DataFrame] | None = None, limits: tuple[float, float] = (0.5, 0.5)) -> DataFrame:
    """Numbered flaws on the maps of each scan and probe, as inclusive frame and rotary ranges.

    Each model looks at its own tiles of the three channels and unites its boxes across tiles. ``probabilities`` adds
    ``p_cc`` and ``p_debris`` from length, width and their ratio; doubtful flaws get two categories and a note. Overlapping flaws
    become one with all their categories, weak ones go, the rest is numbered.
    """
    lines = cut_lineage(tiling.map_lines(three_channels(maps), MAP, "frame", "rotary_idx", CHANNELS), "lines")
    boxes = None
    for number, model in enumerate(models):
        own = tiling.detect_on_tiles(lines, MAP, CHANNELS, model).withColumn("box_id", F.concat(F.lit(f"{number}-"), "box_id"))
        boxes = own if boxes is None else boxes.unionByName(own)
    placed = tiling.boxes_to_ranges(boxes, lines, MAP, "frame").withColumnsRenamed({"cls": "flaw_type", "conf": "confidence"})
    flaws = placed.withColumn("flaw_id", F.concat_ws("-", "probe", "box_id")).drop("box_id")
    sized = flaws.withColumn("length", F.col("frame_end") - F.col("frame_start") + 1).withColumn("width", F.col("rotary_end") - F.col("rotary_start") + 1)
    if probabilities is None:
        told = sized.withColumn("possible_category", F.array("flaw_type")).withColumn("note1", F.lit(None).cast("string"))
    else:
        told = learning.differentiate(probabilities(learning.differentiation_features(sized, 0.0)), *limits).drop("p_cc", "p_debris", "diff_length", "lw_ratio")
    corners = {"x_start": F.col("rotary_start"), "x_end": F.col("rotary_end") + 1, "y_start": F.col("frame_start"), "y_end": F.col("frame_end") + 1}
    united = merging.unite_overlapping_flaws(told.withColumns({n: c.cast("double") for n, c in corners.items()}), MAP).drop(*corners)
    return number_flaws(united.where(F.col("confidence") >= confidence))


def vision_depth(flaws: DataFrame, ascans: DataFrame, make_detector: Callable[[], Detector], size: int, before: int = 50, after: int = 250, far: float = 0.4) -> DataFrame:
    """Depth from the shape of the echo: detect it on the windowed frame, measure it against the mean first echo.

    Per flaw and frame: cut the neighbourhood, window the amplitudes, detect, clean up, pick the measuring
    row; per flaw: depths far from the deepest few become their median, and one is chosen by amplitude.
    """
    keys = ["scan_id", "probe", "flaw_id"]
    turn = ascans.groupBy("scan_id", "probe").agg((F.max("rotary_idx") + 1).alias("_turn"))
    c0, c1 = pj.widened_rotary(F.col("rotary_start"), F.col("rotary_end"), F.col("_turn"))
    wide = flaws.join(turn, ["scan_id", "probe"]).withColumn("c0", c0).withColumn("c1", c1)
    cells = pj.flaw_cells(wide, ascans, ["scan_id", "probe"], ["flaw_id", "c0", "c1"]).where("rotary_idx >= c0 AND rotary_idx < c1")
    echo = cells.where("rotary_idx = c0").groupBy(*keys).agg(F.floor(F.avg(sm.first_argmax(F.col("samples")))).cast("int").alias("_echo"))
    cut = cells.join(echo, keys).withColumn("_from", F.greatest(F.col("_echo") - before, F.lit(0)))
    cut = cut.withColumn("part", sm.time_slice(F.col("samples"), F.col("_from"), F.col("_echo") + after))
    # the windows, boxes and measured rows are each needed several times: written once, not computed again
    cut = cut_lineage(cut.select(*keys, "frame", "rotary_idx", "c0", "part", F.transform(sm.amplitude_window(F.col("part")), lambda v: v * 2.55).alias("line")))
    frames = [*keys, "frame"]
    boxes = cut_lineage(scoring.score_images(scoring.frame_images(cut, frames, "rotary_idx", "line"), frames, make_detector, MORPHOLOGY, size))
    usable = merging.usable_detections(boxes.withColumn("box_id", F.col("box_no").cast("string")).drop("box_no"))
    single = merging.suppress_overlaps(usable.withColumnRenamed("conf", "score"), frames, 0.45, 0.0)
    lines = cut.select(*frames, (F.col("rotary_idx") - F.col("c0")).alias("y"), "part")
    spread = single.withColumn("y", F.explode(F.sequence(F.floor("y1"), F.greatest(F.ceil("y2") - 1, F.floor("y1")))))
    measured = spread.join(lines, [*frames, "y"]).withColumn("_seg", sm.time_slice(F.col("part"), F.floor("x1").cast("int"), F.greatest(F.ceil("x2") - 1, F.floor("x1")).cast("int")))
    rows = cut_lineage(measured.where(F.size("_seg") > 0).select(
        *frames, "box_id", "cls", "x1", "x2", "y", (F.floor("x1") + sm.first_argmax(F.col("_seg"))).alias("max_x"), F.array_max("_seg").alias("max_value")
    ))
    best = merging.deepest_box(merging.measured_rows(rows, frames), frames)
    amp = rows.groupBy(*frames).agg(F.max("max_value").alias("max_amp"))
    outside = lines.join(rows.select(*frames, "y").distinct(), [*frames, "y"], "left_anti")
    surface = outside.groupBy(*frames).agg(F.avg(sizing.echo_position(F.col("part"), 128)).alias("_surface"))
    profile = best.join(amp, frames).join(surface, frames).withColumn("depth", text.samples_to_mm(F.col("x") - F.col("_surface"))).withColumn("cell", F.col("frame"))
    marked = ranking.drop_far_depths(profile, keys, "depth", "cell", far)
    near = marked.withColumn("depth", F.when(F.col("kept") | F.col("depth").isNull(), F.col("depth")).otherwise(F.col("reference")))
    return ranking.pick_depth(near, keys, "depth", "max_amp", "frame", "cell").select(*keys, "depth", "max_amp", F.col("frame").alias("max_depth_frame"), "by_amplitude")


def analyse(
    ascans: DataFrame, models: list[Model], echo_width: int = 16, per_side: int = 2, confidence: float = 0.0,
    probabilities: Callable[[DataFrame], DataFrame] | None = None, limits: tuple[float, float] = (0.5, 0.5), amplitude: int = 140,
) -> DataFrame:
    """A-scans to numbered and sized flaws, all scans in one job.

    Crevice flaws are sized by first peaks, all others by alignment with clean neighbours. The maps and the flaws are written
    once in between: detection and sizing both need them, and a lost executor then costs a re-read.
    """
    maps = cut_lineage(feature_maps(ascans, echo_width, 10, 6, text.MM_PER_SAMPLE * text.SOUND_FACTOR))
    found = cut_lineage(detect_flaws(maps, models, confidence, probabilities, limits), "flaws")
    keys = [*MAP, "flaw_id"]
    crevice = F.array_contains("possible_category", "CC")
    aligned = sizing.deepest_cell(sizing.size_by_alignment(found.where(~crevice), ascans, per_side, echo_width), keys)
    peaks = sizing.cc_depth(found.where(crevice), ascans, per_side, amplitude, 50.0)
    depth = aligned.select(*keys, F.col("max_depth").alias("depth"), F.lit("alignment").alias("method")).unionByName(peaks.select(*keys, "depth", F.lit("first peak").alias("method")))
    return found.join(depth, keys, "left")
