"""Sample arrays of one A-scan as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MEDIAN_LEVEL = 128
DAQ_LEVEL = 2048
# Bits dropped when 12-bit samples become 8-bit ones.
DAQ_SHIFT = {"APC": 2, "CPC": 2, "NB1": 3, "NB2": 3}


def to_eight_bit(samples: Column, probe: Column) -> Column:
    """12-bit samples around 2048 to 8-bit ones around 128, clipped."""

    def scaled(shift: int) -> Column:
        return F.transform(
            samples, lambda x: F.greatest(F.least(F.shiftright(x - DAQ_LEVEL, shift) + MEDIAN_LEVEL, F.lit(255)), F.lit(0))
        )

    return F.when(probe.isin("APC", "CPC"), scaled(DAQ_SHIFT["APC"])).otherwise(scaled(DAQ_SHIFT["NB1"]))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for a row, also where ``body`` uses it several times or for each element of an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def array_median(samples: Column) -> Column:
    n = F.size(samples)
    places = ((n - 1) / 2).cast("int"), (n / 2).cast("int")
    return bound(F.array_sort(samples), lambda ordered: (F.get(ordered, places[0]) + F.get(ordered, places[1])) / 2.0)


def inverted(samples: Column, level: Column) -> Column:
    """Signal mirrored at a level, kept in 0..255."""
    return bound(level, lambda mirror: F.transform(samples, lambda x: F.greatest(F.least(2 * mirror - x, F.lit(255.0)), F.lit(0.0))))


def without_first_echo(samples: Column, start: Column, stop: Column, level: Column) -> Column:
    """Samples from ``start`` up to ``stop`` replaced by a level."""
    return bound(level, lambda put: F.transform(samples, lambda x, i: F.when((i >= start) & (i < stop), put).otherwise(x.cast("double"))))


def time_slice(samples: Column, first: Column, last: Column) -> Column:
    """Samples of an inclusive index range, cut at the ends of the array."""
    start = F.greatest(first, F.lit(0))
    return F.slice(samples, (start + 1).cast("int"), F.greatest(F.least(last, F.size(samples) - 1) - start + 1, F.lit(0)).cast("int"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def trapezoid(values: Column) -> Column:
    """Area under unit-spaced samples."""
    n = F.size(values)
    ends = (F.get(values, F.lit(0)) + F.get(values, n - 1)) / 2.0
    return F.when(n > 1, total(values) - ends).otherwise(0.0)


def first_argmax(values: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def amplitude_window(samples: Column, low: float = 40.0, high: float = 55.0) -> Column:
    """8-bit samples as 0..100, stretched between two limits and saturated outside them."""

    def windowed(x: Column) -> Column:
        v = x / 255.0 * 100
        return F.when(v < low, 0.0).when(v > high, 100.0).otherwise((v - low) / (high - low) * 100)

    return F.transform(samples, windowed)
