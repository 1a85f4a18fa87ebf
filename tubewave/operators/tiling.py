"""Overlapping tiles of maps: cut from rows of the map, scored one tile a row, and the way back to the map."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import merging, scoring
from .ordered import Series, numbered

#: Frames of a chunk in which rows of a map are numbered.
FRAMES_A_CHUNK = 1000


def map_lines(maps: DataFrame, keys: list[str], row: str, column: str, channels: list[str]) -> DataFrame:
    """One row for each row of a map: its number ``y`` from 0, the value of ``row``, ``first_column``, and a line of each channel.

    ``channels`` are columns of ``maps``. Every row of the map is as wide as the columns that occur in it; a position
    or value that is missing is 0. A row is one turn of the probe, which the instrument limits; no map is gathered.
    """
    reach = maps.groupBy(*keys).agg(F.min(column).alias("first_column"), F.max(column).alias("_last"))
    rows = maps.select(*keys, row).distinct().join(reach, keys)
    places = rows.select(*keys, row, "first_column", F.explode(F.sequence("first_column", "_last")).alias(column))
    filled = places.join(maps.select(*keys, row, column, *channels), [*keys, row, column], "left")
    turn = F.sort_array(F.collect_list(F.struct(column, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in channels])))
    turns = filled.groupBy(*keys, row, "first_column").agg(turn.alias("_turn"))
    wide = turns.select(*keys, row, "first_column", *[F.col(f"_turn.{c}").alias(c) for c in channels])
    return numbered(wide, Series(keys, [row], FRAMES_A_CHUNK), "y").withColumn("y", F.col("y") - 1)


def cut_tiles(lines: DataFrame, keys: list[str], channels: list[str], size: int, step: int) -> DataFrame:
    """Tiles of ``size`` pixels a side, one a row: ``tile_y, tile_x, height, width, channels, pixels`` (by row, column, channel).

    Tiles start at multiples of ``step``, the last one along a side is flush with the edge; a map smaller than a tile is one
    smaller tile. Each row of the map computes the tiles it belongs to and sends its part of the line to each of them, so
    a group holds the rows of one tile and nothing else.
    """
    extent = lines.groupBy(*keys).agg((F.max("y") + 1).alias("_rows"), F.max(F.size(channels[0])).alias("_columns"))
    last_y, last_x = (F.greatest(F.col(c) - size, F.lit(0)).cast("bigint") for c in ("_rows", "_columns"))
    sized = lines.join(extent, keys).withColumn("_ly", last_y).withColumn("_lx", last_x)
    across = F.array_union(F.sequence(F.lit(0).cast("bigint"), F.col("_lx"), F.lit(step).cast("bigint")), F.array("_lx"))
    spread = sized.withColumn("tile_y", F.explode(merging.tile_origins("y", "y", "_ly", size, step))).withColumn("tile_x", F.explode(across))
    parts = [F.slice(c, (F.col("tile_x") + 1).cast("int"), size).alias(c) for c in channels]
    cut = spread.select(*keys, "tile_y", "tile_x", F.struct("y", *parts).alias("row"))
    tiles = cut.groupBy(*keys, "tile_y", "tile_x").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    line = lambda r: F.flatten(F.transform(F.arrays_zip(*[r[c].alias(c) for c in channels]), lambda z: F.array(*[z[c] for c in channels])))
    return tiles.select(
        *keys, "tile_y", "tile_x", F.size("rows").alias("height"), F.size(F.get("rows", F.lit(0))[channels[0]]).alias("width"),
        F.lit(len(channels)).alias("channels"), F.flatten(F.transform("rows", line)).alias("pixels"),
    )


@dataclass(frozen=True)
class Model:
    """A detector with the tiles it looks at: made once per Python worker, fed with images of ``image`` pixels a side."""

    make: Callable[[], scoring.Detector]
    classes: tuple[str, ...]
    image: int
    tile: int
    step: int
    #: Least confidence of a box, and what boxes are called whatever their class (NULL: by class).
    confidence: float = 0.0
    renamed: str | None = None
    #: A map has to have more rows and columns than these to be looked at.
    rows: int = 0
    columns: int = 0


def detect_on_tiles(lines: DataFrame, keys: list[str], channels: list[str], model: Model, iou: float = 0.3, share: float = 0.9) -> DataFrame:
    """Boxes ``box_id, cls, conf, x1, y1, x2, y2`` on maps, in whole pixels that belong to the box, united across tiles.

    Large enough maps are cut to tiles, each tile is scored by itself, its boxes move to the map by the origin of the tile,
    and boxes of one class that overlap on the map are united (ids follow the order of tiles). Confidences count to nine digits,
    so that the order in which a detector adds pixels decides no tie.
    """
    large = lines.groupBy(*keys).agg(F.max("y").alias("_y"), F.max(F.size(channels[0])).alias("_x")).where((F.col("_y") + 1 > model.rows) & (F.col("_x") > model.columns))
    tiles = cut_tiles(lines.join(large, keys, "left_semi"), keys, channels, model.tile, model.step)
    place = [*keys, "tile_y", "tile_x"]
    found = scoring.score_images(tiles, place, model.make, list(model.classes), model.image).where(F.col("conf") >= model.confidence)
    number = [F.lpad(F.col(c).cast("string"), n, "0") for c, n in (("tile_y", 8), ("tile_x", 8), ("box_no", 5))]
    left, top = F.floor(F.col("x1") + F.col("tile_x")), F.floor(F.col("y1") + F.col("tile_y"))
    right, bottom = F.ceil(F.col("x2") + F.col("tile_x")) - 1, F.ceil(F.col("y2") + F.col("tile_y")) - 1
    placed = found.select(
        *keys, F.concat_ws("-", *number).alias("box_id"), (F.lit(model.renamed) if model.renamed else F.col("cls")).alias("cls"), F.round("conf", 9).alias("conf"),
        left.cast("double").alias("x1"), top.cast("double").alias("y1"), F.greatest(left, right).cast("double").alias("x2"), F.greatest(top, bottom).cast("double").alias("y2"),
    )
    return merging.merge_tile_boxes(placed, keys, iou, share)


def boxes_to_ranges(boxes: DataFrame, lines: DataFrame, keys: list[str], row: str) -> DataFrame:
    """Boxes with the first and last value of ``row`` and of the column of the map that they cover."""
    rows = lines.select(*keys, F.col("y").alias("_at"), F.col(row).alias("_row"), "first_column")
    first, last = rows.withColumnsRenamed({"_at": "_top", "_row": f"{row}_start"}), rows.withColumnsRenamed({"_at": "_bottom", "_row": f"{row}_end"}).drop("first_column")
    placed = boxes.withColumn("_top", F.col("y1").cast("bigint")).withColumn("_bottom", F.col("y2").cast("bigint"))
    joined = placed.join(first, [*keys, "_top"]).join(last, [*keys, "_bottom"])
    at: Callable[[str], Column] = lambda c: (F.col("first_column") + F.col(c)).cast("bigint")
    return joined.withColumn("rotary_start", at("x1")).withColumn("rotary_end", at("x2")).drop("_top", "_bottom", "first_column", "x1", "y1", "x2", "y2")
