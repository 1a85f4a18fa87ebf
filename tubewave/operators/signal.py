"""Operators over A-scans: tables with one row per (scan, probe, frame, rotary position) and its samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from . import ordered
from .ordered import Series

FRAME = ["scan_id", "probe", "frame"]


def frame_series() -> Series:
    """Rotary positions of one frame; a full turn has a few thousand of them, so it needs no chunks."""
    return Series(FRAME, ["rotary_idx"], None)


def reference_positions(df: DataFrame, valid: str, n_row: int) -> DataFrame:
    """Start of the first run of at least ``n_row`` valid positions of each frame.

    Without such a run it is the start of a run that reaches the end of the frame, else 0.
    """
    s = frame_series()
    in_runs = ordered.runs(df.select(*FRAME, "rotary_idx", valid), s, F.col(valid))
    stretches = in_runs.groupBy(*FRAME, "run", valid).agg(
        F.min("rotary_idx").alias("first"), F.max("rotary_idx").alias("last"), F.count(F.lit(1)).alias("n")
    )
    per_frame = stretches.groupBy(*FRAME).agg(
        F.min(F.when(F.col(valid) & (F.col("n") >= n_row), F.col("first"))).alias("steady"),
        F.max(F.struct("last", F.when(F.col(valid), F.col("first")).alias("first"))).alias("trailing"),
    )
    loc = F.coalesce("steady", "trailing.first", F.lit(0)).cast("bigint")
    return per_frame.select(*FRAME, loc.alias("reference_loc"))


def sample_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long lists as one matrix, without a copy per row."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1)


def per_frame(ascans: DataFrame, columns: list[str], out: str, work: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]]) -> DataFrame:
    """Apply array work to whole frames; ``samples`` arrives as a matrix, other columns as vectors.

    A frame is one turn of the probe, so its size is limited by the instrument.
    """
    kept = [*FRAME, "rotary_idx"]
    schema = ascans.select(*kept).schema
    target = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in schema], out])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rotary_idx")
        inputs = {c: sample_matrix(table[c]) if pa.types.is_list(table[c].type) else table[c].to_numpy() for c in columns}
        return pa.table({**{c: table[c] for c in kept}, **{k: pa.array(v) for k, v in work(inputs).items()}})

    return ascans.select(*kept, *columns).groupBy(*FRAME).applyInArrow(run, target)


WAVEGROUP = "start SMALLINT, stop SMALLINT, peak_index SMALLINT, peak_value SMALLINT, avg FLOAT, auc FLOAT"


def detect_echoes(ascans: DataFrame, count: int, threshold: float, width: int, level: int = 128, max_distance: int = 0, signed: bool = False) -> DataFrame:
    """Echo candidates of each A-scan as an array of structs, strongest first. Runs batch by batch without a shuffle."""
    kept = ascans.drop("samples")
    names = kept.columns
    target = T.StructType([*kept.schema.fields, T.StructField("echoes", T.ArrayType(T.StructType.fromDDL(WAVEGROUP)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            echoes: list = [None] * batch.num_rows
            lists = batch.column("samples")
            lengths = np.asarray(lists.value_lengths())
            for size in np.unique(lengths):
                rows = np.flatnonzero(lengths == size)
                found = kernels.echo_candidates(sample_matrix(lists.take(pa.array(rows))), count, threshold, width, level, max_distance, signed)
                for r, *fields in zip(rows, *(found[k] for k in ("start", "stop", "peak", "value", "average", "area"))):
                    valid = fields[2] >= 0
                    echoes[r] = [
                        {"start": int(a), "stop": int(b), "peak_index": int(c), "peak_value": int(d), "avg": e, "auc": f}
                        for a, b, c, d, e, f in zip(*(x[valid] for x in fields))
                    ]
            arrays = [batch.column(n) for n in names] + [pa.array(echoes, echo_type)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "echoes"])

    echo_type = pa.list_(
        pa.struct(
            [("start", pa.int16()), ("stop", pa.int16()), ("peak_index", pa.int16()), ("peak_value", pa.int16()), ("avg", pa.float32()), ("auc", pa.float32())]
        )
    )
    return ascans.select(*names, "samples").mapInArrow(run, target)


def frame_wavegroups(ascans: DataFrame, count: int, threshold: float, width: int, level: int = 128, max_distance: int = 0) -> DataFrame:
    """One wavegroup per A-scan: candidates, then the choice that is steady along the turn."""

    def work(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        found = kernels.echo_candidates(inputs["samples"], count, threshold, width, level, max_distance)
        pick = kernels.choose_echoes(found["peak"])
        rows = np.arange(len(pick))
        none = found["peak"][rows, pick] < 0

        def chosen(name: str, kind: type) -> np.ndarray:
            return np.where(none, 0, found[name][rows, pick]).astype(kind)

        fields = (("start", "start", np.int16), ("stop", "stop", np.int16), ("peak_index", "peak", np.int16), ("peak_value", "value", np.int16), ("avg", "average", np.float32), ("auc", "area", np.float32))
        return {out: chosen(name, kind) for out, name, kind in fields}

    return per_frame(ascans, ["samples"], WAVEGROUP, work)


def track_frame_lags(
    ascans: DataFrame, references: DataFrame, reach: int, min_points: int = 5, level: int = 128, start: int = 0, follow: bool = True
) -> DataFrame:
    """Lag and correlation of every A-scan against the reference position of its frame, tracked along the turn."""
    joined = ascans.join(references.select(*FRAME, "reference_loc"), FRAME)

    def work(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        scans = inputs["samples"].astype(float) - level
        at = int(np.clip(np.searchsorted(inputs["place"], inputs["reference_loc"][0]), 0, len(scans) - 1))
        cors = kernels.all_lag_correlations(scans[at], scans)
        lags, values = kernels.track_lags(cors, reach, min_points, start, follow)
        return {"lag": lags.astype(np.int32), "cor": values.astype(np.float32)}

    return per_frame(joined.withColumn("place", F.col("rotary_idx")), ["samples", "place", "reference_loc"], "lag INT, cor FLOAT", work)


def time_of_flight(wavegroups: DataFrame, references: DataFrame, lags: DataFrame, factor: float) -> DataFrame:
    """Time of flight per position from the reference echo and the lags.

    The first position carries the reference peak and its own lag; every other one adds its lag to that.
    """
    peak = wavegroups.join(references, FRAME).where(F.col("rotary_idx") == F.col("reference_loc")).select(*FRAME, F.col("peak_index").alias("_peak"))
    first = lags.groupBy(*FRAME).agg(F.min_by("lag", "rotary_idx").alias("_lag0"), F.min("rotary_idx").alias("_first"))
    base = F.col("_peak").cast("int") + F.col("_lag0")
    tof = F.when(F.col("rotary_idx") == F.col("_first"), base).otherwise(base + F.col("lag"))
    return lags.join(peak, FRAME).join(first, FRAME).select(
        *FRAME, "rotary_idx", "lag", "cor", tof.alias("tof_samples"), F.round(tof * F.lit(factor), 6).alias("tof")
    )


def flatten_frames(df: DataFrame, value: str, mask: str | None = None, order: int = 5, window: int = 0) -> DataFrame:
    """Value minus its smooth trend along the turn; masked positions do not shape the trend."""

    def work(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        v = inputs[value].astype(float)
        clean = kernels.bridge(v, inputs[mask].astype(bool)) if mask else v
        return {"flat": v - kernels.savgol(clean, window or kernels.default_window(len(v)), order)}

    return per_frame(df, [value, *([mask] if mask else [])], "flat DOUBLE", work)


def indication_mask(df: DataFrame, jump: float, sigmas: float, trend_sigmas: float, rounds: int, order: int, window: int, max_share: float) -> DataFrame:
    """Positions with low correlation or at a jump of the lag (columns lag and cor)."""

    def work(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        low = kernels.low_correlation(inputs["cor"].astype(float), sigmas, trend_sigmas, rounds, order, window, max_share)
        step = np.abs(np.diff(inputs["lag"])) >= jump
        low[:-1] |= step
        low[1:] |= step
        return {"indication": low}

    return per_frame(df, ["lag", "cor"], "indication BOOLEAN", work)


def smoother_lags(df: DataFrame, first: str, second: str, order: int, window: int, rounds: int, sigmas: float, mask: str) -> DataFrame:
    """Of two lag series the one that rises less along the turn, minus the tube surface."""

    def work(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        a, b = inputs[first].astype(float), inputs[second].astype(float)
        pick = a if len(a) < 2 or np.gradient(a).sum() <= np.gradient(b).sum() else b
        surface = kernels.smooth_without_troughs(pick, sigmas, rounds, order, window, inputs[mask].astype(bool))
        return {"flat_lag": pick - surface}

    return per_frame(df, [first, second, mask], "flat_lag DOUBLE", work)


def chatter_peaks(df: DataFrame, value: str, height: float, width: float) -> DataFrame:
    """Peaks of both signs of a flattened series along the turn, with their absolute height."""

    def work(inputs: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        v = inputs[value].astype(float)
        size = np.full(len(v), np.nan)
        for signed in (v, -v):
            at = kernels.wide_peaks(signed, height, width)
            size[at] = signed[at]
        return {"peak": size}

    peaks = per_frame(df, [value], "peak DOUBLE", work)
    return peaks.where(~F.isnan("peak"))


def correlation_at(reference, samples, lag):
    """Normalised correlation of two equally long sample arrays at one lag (columns, any sign)."""
    n = F.size(samples)
    width = F.greatest(n - F.abs(lag), F.lit(0))
    t = F.slice(reference, (F.greatest(-lag, F.lit(0)) + 1).cast("int"), width.cast("int"))
    u = F.slice(samples, (F.greatest(lag, F.lit(0)) + 1).cast("int"), width.cast("int"))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)

    norm = F.sqrt(dot(t, t) * dot(u, u))
    return F.when(norm > 0, dot(t, u) / norm).otherwise(0.0)


def best_lag(reference, samples, low: int, high: int):
    """Lag of the highest correlation and that correlation; equal ones in the preferred order of lags."""
    order = [int(v) for v in kernels.lag_order(low, high)]
    scored = F.transform(
        F.array(*[F.struct(F.lit(-i).alias("rank"), F.lit(v).alias("lag")) for i, v in enumerate(order)]),
        lambda e: F.struct(F.round(correlation_at(reference, samples, e["lag"]), 12).alias("cor"), e["rank"].alias("rank"), e["lag"].alias("lag")),
    )
    return F.array_max(scored)
