"""Box geometry as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_1d(start_a: Column, end_a: Column, start_b: Column, end_b: Column, inclusive: bool = False) -> Column:
    """Length shared by two intervals, never negative; ``inclusive`` counts end pixels."""
    extra = 1 if inclusive else 0
    shared = F.least(end_a, end_b) - F.greatest(start_a, start_b) + F.lit(extra)
    return F.greatest(shared, F.lit(0.0))


def iou_1d(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Overlap of two intervals relative to their union; zero when they do not touch."""
    shared = overlap_1d(start_a, end_a, start_b, end_b)
    union = (end_a - start_a) + (end_b - start_b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def iou(a: dict[str, Column], b: dict[str, Column], inclusive: bool = False) -> Column:
    """Overlap of two boxes given as ``x, y, w, h`` columns (origin and extent).

    ``inclusive`` treats coordinates as pixels whose end belongs to the box.
    """
    extra = 1 if inclusive else 0
    dx = F.least(a["x"] + a["w"], b["x"] + b["w"]) - F.greatest(a["x"], b["x"]) + F.lit(extra)
    dy = F.least(a["y"] + a["h"], b["y"] + b["h"]) - F.greatest(a["y"], b["y"]) + F.lit(extra)
    shared = F.greatest(dx, F.lit(0.0)) * F.greatest(dy, F.lit(0.0))
    area_a = (a["w"] + extra) * (a["h"] + extra)
    area_b = (b["w"] + extra) * (b["h"] + extra)
    union = area_a + area_b - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def unwrap_rotary(start: Column, reference: Column) -> Column:
    """Rotary start moved by a full turn when that brings it closer to ``reference``."""
    turned = start + 360.0
    back = start - 360.0
    return (
        F.when(F.abs(turned - reference) < F.abs(start - reference), turned)
        .when(F.abs(back - reference) < F.abs(start - reference), back)
        .otherwise(start)
    )


def wrapped_extent(start: Column, end: Column) -> Column:
    """Angular extent from start to end, continued through 360 when the end is not ahead."""
    return F.when(end > start, end - start).otherwise(F.lit(360.0) - start + end)


def nearest_boundary(angle: Column) -> Column:
    """0 or 360, whichever the angle is closer to."""
    return F.when(F.pmod(angle, F.lit(360.0)) < 180, F.lit(0)).otherwise(F.lit(360))


def box_corners(x: Column, y: Column, w: Column, h: Column) -> list[Column]:
    """Centre and size to left, top, right, bottom."""
    return [x - w / 2, y - h / 2, x + w / 2, y + h / 2]


def pixel_bounds(
    x: Column, y: Column, w: Column, h: Column, img_w: Column, img_h: Column, as_range: bool = False
) -> list[Column]:
    """Relative box to whole pixels that certainly contain it: floor the start, ceil the end, stay in the image."""
    last = F.lit(0.0 if as_range else 1.0)

    def clip(value: Column, size: Column) -> Column:
        return F.greatest(F.least(value, size.cast("double")), F.lit(0.0))

    left, top, right, bottom = box_corners(x, y, w, h)
    start_x = F.greatest(F.floor(clip(left * img_w, img_w)), F.lit(0))
    start_y = F.greatest(F.floor(clip(top * img_h, img_h)), F.lit(0))
    end_x = F.least(F.ceil(clip(right * img_w, img_w) - last), img_w.cast("bigint"))
    end_y = F.least(F.ceil(clip(bottom * img_h, img_h) - last), img_h.cast("bigint"))
    return [start_x, start_y, end_x, end_y]


def unit_bounds(x: Column, y: Column, w: Column, h: Column, img_w: Column, img_h: Column) -> list[Column]:
    """Corners of a relative box, clipped to the image size but left in relative units."""
    left, top, right, bottom = box_corners(x, y, w, h)

    def clip(value: Column, size: Column) -> Column:
        return F.greatest(F.least(value, size.cast("double")), F.lit(0.0))

    return [clip(left, img_w), clip(top, img_h), clip(right, img_w), clip(bottom, img_h)]
