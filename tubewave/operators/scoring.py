"""Batch scoring of images with a detector supplied by the user.

A detector is made once per Python worker and called with whole batches: it gets an array
(image, row, column and, for maps of several channels, channel) of letterboxed pixels in 0..1 and returns one array of rows
(x1, y1, x2, y2, confidence, class id) per image, in letterboxed pixels.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Detector = Callable[[np.ndarray], list[np.ndarray]]

# Grey level of the padding and the pixel range.
PAD_LEVEL = 114
PIXEL_MAX = 255.0


def stretch(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear resize with aligned pixel centres."""

    def places(n: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pos = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        low = np.floor(pos).astype(int)
        return low, np.minimum(low + 1, n - 1), pos - low

    r0, r1, rw = places(image.shape[0], height)
    c0, c1, cw = places(image.shape[1], width)
    rows = image[r0] * (1 - rw)[:, None] + image[r1] * rw[:, None]
    return rows[:, c0] * (1 - cw) + rows[:, c1] * cw


def letterbox(image: np.ndarray, size: int) -> tuple[np.ndarray, float, int, int]:
    """Image (with or without channels) scaled into a square and centred on padding; also the scale and the left and top padding."""
    height, width = image.shape[:2]
    scale = size / max(height, width)
    new_h, new_w = max(1, round(height * scale)), max(1, round(width * scale))
    left, top = (size - new_w) // 2, (size - new_h) // 2
    box = np.full((size, size, *image.shape[2:]), float(PAD_LEVEL))
    plain = image.astype(float)
    scaled = np.stack([stretch(plain[..., c], new_h, new_w) for c in range(image.shape[2])], axis=-1) if image.ndim == 3 else stretch(plain, new_h, new_w)
    box[top : top + new_h, left : left + new_w] = scaled
    return box, scale, left, top


#: Images that are handed to a detector at a time.
IMAGES_A_CALL = 32


def score_images(images: DataFrame, keys: list[str], make_detector: Callable[[], Detector], classes: list[str], size: int) -> DataFrame:
    """Boxes found on each image (columns ``pixels`` row by row, ``height``, ``width``), in image pixels.

    With a column ``channels`` above 1 the pixels of a place follow each other and the detector gets a fourth axis. Boxes are
    clipped to their image; ``box_no`` numbers them by class and confidence.
    """
    target = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in images.select(*keys).schema], "box_no INT, cls STRING, conf DOUBLE, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE"])
    depth = F.col("channels") if "channels" in images.columns else F.lit(1)

    def score(detector: Detector, batch: pa.RecordBatch) -> pa.RecordBatch:
        pixels, heights, widths, channels = batch.columns[len(keys) :]
        boxed, extents = [], []
        for k, (h, w, c) in enumerate(zip(heights.to_pylist(), widths.to_pylist(), channels.to_pylist())):
            plain = pixels[k].values.to_numpy(zero_copy_only=False)
            boxed.append(letterbox(plain.reshape((h, w) if c == 1 else (h, w, c)), size))
            extents.append((w, h))
        found = detector(np.stack([b[0] for b in boxed]) / PIXEL_MAX)
        rows = np.concatenate([np.reshape(r, (-1, 6)) for r in found]).astype(float)
        of = np.repeat(np.arange(len(found)), [len(r) for r in found])
        order = np.lexsort((-rows[:, 4], rows[:, 5], of))
        rows, of = rows[order], of[order]
        no = np.arange(len(of)) - np.searchsorted(of, of)
        scale, left, top = (np.array([b[n] for b in boxed], float)[of] for n in (1, 2, 3))
        wide, high = np.array(extents, float).reshape(-1, 2)[of].T
        corners = [np.clip((rows[:, n] - pad) / scale, 0, limit) for n, pad, limit in ((0, left, wide), (1, top, high), (2, left, wide), (3, top, high))]
        names = [classes[int(c)] for c in rows[:, 5]]
        taken = batch.select(keys).take(pa.array(of))
        columns = [*taken.columns, pa.array(no.astype(np.int32)), pa.array(names, pa.string()), pa.array(rows[:, 4]), *[pa.array(c) for c in corners]]
        return pa.RecordBatch.from_arrays(columns, [*keys, "box_no", "cls", "conf", "x1", "y1", "x2", "y2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        detector = make_detector()
        for batch in batches:
            for start in range(0, batch.num_rows, IMAGES_A_CALL):
                yield score(detector, batch.slice(start, IMAGES_A_CALL))

    return images.select(*keys, "pixels", "height", "width", depth.alias("channels")).mapInArrow(run, target)


def frame_images(cells: DataFrame, keys: list[str], row: str, line: str) -> DataFrame:
    """Images from rows of equally long arrays (``line``); their number is limited by one turn of the probe."""
    lines = F.sort_array(F.collect_list(F.struct(F.col(row).alias("r"), F.col(line).alias("line"))))
    packed = cells.groupBy(*keys).agg(lines.alias("_l"))
    pixels = F.flatten(F.transform("_l", lambda e: e["line"]))
    height = F.size("_l")
    return packed.select(*keys, pixels.alias("pixels"), height.alias("height"), F.floor(F.size(pixels) / height).cast("int").alias("width"), F.get("_l", F.lit(0))["r"].alias("first_row"))


def _one_channel(image: np.ndarray) -> np.ndarray:
    return image.mean(axis=2) if image.ndim == 3 else image


class BrightRegion:
    """A detector without a model: one box around the pixels above a level. Stands in where no weights exist."""

    def __init__(self, level: float, cls: int = 0):
        self.level, self.cls = level, cls

    def __call__(self, images: np.ndarray) -> list[np.ndarray]:
        out = []
        for image in images:
            bright = _one_channel(image) >= self.level
            if not bright.any():
                out.append(np.zeros((0, 6)))
                continue
            rows, columns = np.flatnonzero(bright.any(axis=1)), np.flatnonzero(bright.any(axis=0))
            box = [columns[0], rows[0], columns[-1] + 1, rows[-1] + 1, min(1.0, float(_one_channel(image)[bright].mean())), self.cls]
            out.append(np.array([box], float))
        return out


class BrightSpot:
    """A detector without a model: one box of fixed reach around the brightest pixel."""

    def __init__(self, reach: int, cls: int = 0):
        self.reach, self.cls = reach, cls

    def __call__(self, images: np.ndarray) -> list[np.ndarray]:
        out = []
        for image in map(_one_channel, images):
            row, column = np.unravel_index(int(image.argmax()), image.shape)
            r = self.reach
            out.append(np.array([[column - r, row - r, column + r + 1, row + r + 1, float(image.max()), self.cls]], float))
        return out
