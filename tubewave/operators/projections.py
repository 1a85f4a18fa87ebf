"""Selections and derived columns over scans, A-scans, maps and flaws."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import samples as sm
from . import ordered
from .ordered import Series

DEGREES_PER_STEP = 0.1
MAX_AXIAL_RANGE_MM = 225


def region(ascans: DataFrame, frames: tuple[int, int] | None, rotary: tuple[int, int] | None, time: tuple[int, int] | None) -> DataFrame:
    """Inclusive index ranges on the three axes; ranges on the key columns reach the file scan."""
    out = ascans
    for name, bounds in (("frame", frames), ("rotary_idx", rotary)):
        if bounds is not None:
            check_range(*bounds)
            out = out.where(F.col(name).between(*bounds))
    if time is not None:
        check_range(*time)
        out = out.withColumn("samples", sm.time_slice(F.col("samples"), F.lit(time[0]), F.lit(time[1])))
    return out


def check_range(start: float, end: float) -> None:
    if start > end:
        raise ValueError(f"start {start} is behind end {end}")


def range_problem(start: Column, end: Column, first: Column, last: Column) -> Column:
    """Why a wanted axial range cannot be analysed, or NULL."""
    return (
        F.when(start > end, "start behind end")
        .when((start < first) | (end > last), "outside the scan")
        .when(last - first > MAX_AXIAL_RANGE_MM, "scan longer than 225 mm")
    )


def rotary_angle(index: Column, first: Column) -> Column:
    return F.pmod(F.lit(DEGREES_PER_STEP) * (index + first), F.lit(360.0))


def nearest_index(targets: DataFrame, axis: DataFrame, keys: list[str], target: str, position: str, index: str, chunk: float) -> DataFrame:
    """Index of the axis value closest to each target (the lower index on equal distance).

    Axis values and targets are merged into one ordered series, so the neighbours on both sides are
    found without comparing all targets with all axis values.
    """
    points = axis.groupBy(*keys, F.col(position).cast("double").alias("_at")).agg(F.min(index).alias("_idx"))
    merged = targets.withColumn("_at", F.col(target).cast("double")).withColumn("_is_axis", F.lit(0)).unionByName(
        points.withColumn("_is_axis", F.lit(1)), allowMissingColumns=True
    )
    point = F.when(F.col("_is_axis") == 1, F.struct("_at", "_idx"))
    s = Series(keys, ["_at", "_is_axis"], chunk)
    found = ordered.known(merged, s, past={"_lo": point}, future={"_hi": point}).where("_is_axis = 0")
    candidates = F.array_compact(F.array("_lo", "_hi"))
    ranked = F.transform(candidates, lambda c: F.struct(F.abs(c["_at"] - F.col("_at")).alias("d"), c["_idx"].alias("i")))
    return found.withColumn(index, F.array_min(ranked)["i"]).drop("_at", "_is_axis", "_idx", "_lo", "_hi")


def equals_all(filters: dict[str, Any]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in filters.items()], F.lit(True))


def scan_predicate(filters: dict[str, Any]) -> Column:
    """A list means membership, anything else equality."""
    parts = [F.col(k).isin(v) if isinstance(v, list) else F.col(k) == F.lit(v) for k, v in filters.items()]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def flaw_predicate(filters: dict[str, Any]) -> Column:
    """Text means contained text without regard to case, a list any of its texts, else equality; NULL never matches."""

    def part(name: str, wanted: Any) -> Column:
        c = F.col(name)
        if isinstance(wanted, str):
            return F.contains(F.lower(c), F.lit(wanted.lower()))
        if isinstance(wanted, list):
            return reduce(lambda a, b: a | b, [F.contains(F.lower(c), F.lit(w.lower())) for w in wanted], F.lit(False))
        return c == F.lit(wanted)

    return reduce(lambda a, b: a & b, [F.coalesce(part(k, v), F.lit(False)) for k, v in filters.items()], F.lit(True))


def flexible_query(scans: DataFrame, flaws: DataFrame | None, scan_filters: dict[str, Any] | None = None, flaw_filters: dict[str, Any] | None = None) -> DataFrame:
    """Whole scans that pass the scan filters and own at least one flaw that passes the flaw filters.

    Without a flaw table only the scan filters apply. Scans without any flaw never match a flaw query.
    """
    kept = scans.where(scan_predicate(scan_filters or {}))
    if flaws is None:
        return kept
    return kept.join(flaws.where(flaw_predicate(flaw_filters or {})).select("scan_id"), "scan_id", "left_semi")


# Named selections of scans.
PRESETS: dict[str, dict[str, dict[str, Any]]] = {
    "all": {"scan": {}, "flaw": {}},
    "val": {"scan": {"train_val": "val"}, "flaw": {}},
    "train": {"scan": {"train_val": "train"}, "flaw": {}},
    "debris": {"scan": {}, "flaw": {"flaw_type": "Debris"}},
    "FBBPF": {"scan": {}, "flaw": {"flaw_type": "FBBPF"}},
    "CC": {"scan": {}, "flaw": {"flaw_type": "CC"}},
}


def preset(name: str) -> dict[str, dict[str, Any]]:
    """Filters of a named selection; any other name is taken as an outage number."""
    return PRESETS.get(name, {"scan": {"outage_number": name}, "flaw": {}})


def class_threshold(flaw_type: Column, thresholds: list[tuple[str, float]]) -> Column:
    """Threshold of the first listed class contained in the type; unknown classes are always kept."""
    out = F.lit(float("-inf"))
    for name, limit in reversed(thresholds):
        out = F.when(F.contains(flaw_type, F.lit(name)), F.lit(float(limit))).otherwise(out)
    return out


def normalise(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Values stretched to 0..255 per group; a constant group has no scale and gives NULL."""
    bounds = df.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    scaled = F.when(span != 0, (F.col(value) - F.col("_lo")) / span * 255)
    return df.join(bounds, keys).withColumn(out, scaled).drop("_lo", "_hi")


def resample_axial(cmap: DataFrame, keys: list[str], pitch: str, value: str, target_mm: float = 0.3) -> DataFrame:
    """Map rows moved to another axial pitch, linear between the two nearest source frames.

    A position that only one of the two frames has takes the value of that one. Pixel centres are aligned, ends repeat the outermost frame. ``cmap`` has one row per key, frame and
    rotary position, frames counted from 0; every source frame is sent to the few targets it feeds.
    """
    length = cmap.groupBy(*keys).agg((F.max("frame") + 1).alias("_n"), F.max(pitch).alias("_pitch"))
    sized = length.withColumn("_m", F.bround(F.col("_n") * F.col("_pitch") / target_mm).cast("bigint")).where("_m > 0")
    ratio = F.col("_n") / F.col("_m")
    targets = sized.select(*keys, "_n", ratio.alias("_ratio"), F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("_t"))
    source = F.greatest(F.least((F.col("_t") + 0.5) * F.col("_ratio") - 0.5, (F.col("_n") - 1).cast("double")), F.lit(0.0))
    placed = targets.withColumn("_pos", source).withColumn("_lo", F.floor("_pos"))
    share = F.col("_pos") - F.col("_lo")
    feeds = F.array(
        F.struct(F.col("_lo").alias("frame"), (1 - share).alias("weight")),
        F.struct(F.least(F.col("_lo") + 1, F.col("_n") - 1).alias("frame"), share.alias("weight")),
    )
    plan = placed.select(*keys, "_t", F.explode(feeds).alias("f")).select(*keys, "_t", "f.frame", "f.weight")
    joined = cmap.join(plan, [*keys, "frame"])
    blended = joined.groupBy(*keys, F.col("_t").alias("frame"), "rotary_idx").agg(
        F.when(F.count(F.lit(1)) == 2, F.sum(F.col(value) * F.col("weight"))).otherwise(F.max(value)).alias(value)
    )
    return blended


def widened_rotary(start: Column, end: Column, size: Column) -> tuple[Column, Column]:
    """Range widened by its own length on both sides, kept on the map."""
    length = end - start
    return F.greatest(start - length, F.lit(0)), F.least(end + length, size)


def flaw_cells(flaws: DataFrame, cells: DataFrame, keys: list[str], flaw_columns: list[str], frames: tuple[str, str] = ("frame_start", "frame_end")) -> DataFrame:
    """Cells whose frame lies in a flaw: the flaw is unrolled to its frames, then joined by equality."""
    unrolled = flaws.select(
        *keys, *flaw_columns, F.explode(F.sequence(F.col(frames[0]).cast("bigint"), F.col(frames[1]).cast("bigint"))).alias("frame")
    )
    return unrolled.join(cells, [*keys, "frame"])


def nested_documents(parents: DataFrame, children: DataFrame, key: str, field: str, limit: int = 5000) -> DataFrame:
    """Parents with their children as an array of structs, in parts of about ``limit`` children.

    Most parents have one document. A parent with very many children gets numbered parts, so that no
    array grows without bound and nothing is cut off.
    """
    sizes = children.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    child_columns = [c for c in children.columns if c != key]
    parts = F.ceil(F.col("_n") / limit).cast("int")
    placed = children.join(sizes, key).withColumn("part", F.pmod(F.xxhash64(*child_columns), parts).cast("int"))
    arrays = placed.groupBy(key, "part").agg(F.sort_array(F.collect_list(F.struct(*child_columns))).alias(field))
    return parents.join(arrays, key, "left").withColumn("part", F.coalesce("part", F.lit(0)))
