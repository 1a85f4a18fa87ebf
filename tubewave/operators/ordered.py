"""Ordered operators over series of any length.

A series is split into chunks of its order column. What a row needs from outside its chunk is a small
summary per chunk, computed with a map-side aggregate and handed on along the chunks; the rows
themselves are only ever sorted inside one chunk. A series that holds a third of all rows is therefore
spread over many tasks. Every operator makes one such summary, so it reads its input twice: cut the
lineage first where the input is costly. A series whose length is limited by the instrument, such as
one turn of a probe, needs no chunks (``chunk=None``): a plain window does, and the input is read once.
Key columns must not be NULL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    """``order`` sorts the rows of one key; its first column is numeric and is cut into chunks of a width."""

    keys: list[str]
    order: list[str]
    chunk: float | None = 100_000.0

    def chunk_of(self) -> Column:
        return F.lit(0) if self.chunk is None else F.floor(F.col(self.order[0]) / self.chunk)

    def position(self) -> Column:
        return F.struct(*self.order)

    def inside(self) -> Window:
        keys = self.keys if self.chunk is None else [*self.keys, "_chunk"]
        return Window.partitionBy(*keys).orderBy(*self.order)

    def upto(self) -> Window:
        return self.inside().rowsBetween(Window.unboundedPreceding, 0)

    def onward(self) -> Window:
        return self.inside().rowsBetween(0, Window.unboundedFollowing)

    def along(self) -> Window:
        return Window.partitionBy(*self.keys).orderBy("_chunk")

    def chunks_before(self) -> Window:
        return self.along().rowsBetween(Window.unboundedPreceding, -1)

    def chunks_after(self) -> Window:
        return self.along().rowsBetween(1, Window.unboundedFollowing)


Columns = dict[str, Column]


def _hand_on(rows: DataFrame, s: Series, totals: Columns, stages: list[Columns], keep: list[str]) -> DataFrame:
    """Give each row what its chunk receives from the chunks around it.

    ``totals`` sum up a chunk, ``stages`` are computed from them along the chunks, ``keep`` names what the
    rows get. Without chunks there is nothing to receive and the columns are NULL.
    """
    if s.chunk is None:
        return rows.withColumns({c: F.lit(None) for c in keep})
    summary = rows.groupBy(*s.keys, "_chunk").agg(*[c.alias(n) for n, c in totals.items()])
    for stage in stages:
        summary = summary.withColumns(stage)
    return rows.join(summary.select(*s.keys, "_chunk", *keep), [*s.keys, "_chunk"])


def _clean(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c == "_chunk" or c.startswith("__")])


def running(df: DataFrame, s: Series, sums: Columns) -> DataFrame:
    """Inclusive running sums along the series."""
    rows = df.withColumn("_chunk", s.chunk_of()).withColumns({f"__x_{n}": c for n, c in sums.items()})
    totals = {f"__t_{n}": F.sum(f"__x_{n}") for n in sums}
    stage = {f"__c_{n}": F.sum(f"__t_{n}").over(s.chunks_before()) for n in sums}
    joined = _hand_on(rows, s, totals, [stage], list(stage))
    zero = F.lit(0)
    return _clean(joined.withColumns({n: F.coalesce(F.sum(f"__x_{n}").over(s.upto()), zero) + F.coalesce(f"__c_{n}", zero) for n in sums}))


def numbered(df: DataFrame, s: Series, name: str = "pos") -> DataFrame:
    """Dense numbering from 1 along the series."""
    return running(df, s, {name: F.lit(1)}).withColumn(name, F.col(name).cast("bigint"))


def interval_islands(df: DataFrame, s: Series, start: str, end: str, gap: float = 0.0, out: str = "island") -> DataFrame:
    """Mark groups of intervals that are separated from all others by more than ``gap``, by the start of their first.

    ``s`` has to order the rows by ``start``. Intervals of different groups do not touch, nor do the
    intervals that result from uniting intervals within a group.
    """
    before = s.inside().rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("_chunk", s.chunk_of()).withColumn("__reach", F.max(end).over(before))
    rows = rows.withColumn("__opens", F.col("__reach").isNull() | (F.col(start) > F.col("__reach") + gap))
    totals = {"__end": F.max(end), "__open": F.max(F.when(F.col("__opens"), F.col(start)))}
    stages = [
        {"__past": F.max("__end").over(s.chunks_before())},
        {"__true": F.when(F.col("__past").isNull() | (F.col("__open") > F.col("__past") + gap), F.col("__open"))},
        {"__island": F.last("__true", ignorenulls=True).over(s.chunks_before())},
    ]
    joined = _hand_on(rows, s, totals, stages, ["__past", "__island"])
    opens = F.col("__opens") & (F.col("__past").isNull() | (F.col(start) > F.col("__past") + gap))
    mine = F.last(F.when(opens, F.col(start)), ignorenulls=True).over(s.upto())
    return _clean(joined.withColumn(out, F.coalesce(mine, F.col("__island")).cast("double")))


def known(df: DataFrame, s: Series, past: Columns | None = None, future: Columns | None = None) -> DataFrame:
    """Last non-NULL value at or before each row and first non-NULL value at or after it."""
    past, future = past or {}, future or {}
    rows = df.withColumn("_chunk", s.chunk_of()).withColumns({f"__x_{n}": c for n, c in {**past, **future}.items()})

    def where_known(n: str) -> Column:
        return F.when(F.col(f"__x_{n}").isNotNull(), s.position())

    totals = {f"__t_{n}": F.max_by(f"__x_{n}", where_known(n)) for n in past} | {f"__t_{n}": F.min_by(f"__x_{n}", where_known(n)) for n in future}
    stage = {f"__c_{n}": F.last(f"__t_{n}", ignorenulls=True).over(s.chunks_before()) for n in past}
    stage |= {f"__c_{n}": F.first(f"__t_{n}", ignorenulls=True).over(s.chunks_after()) for n in future}
    joined = _hand_on(rows, s, totals, [stage], list(stage))
    found = {n: F.coalesce(F.last(f"__x_{n}", ignorenulls=True).over(s.upto()), F.col(f"__c_{n}")) for n in past}
    found |= {n: F.coalesce(F.first(f"__x_{n}", ignorenulls=True).over(s.onward()), F.col(f"__c_{n}")) for n in future}
    return _clean(joined.withColumns(found))


def adjacent(df: DataFrame, s: Series, previous: Columns | None = None, following: Columns | None = None) -> DataFrame:
    """Values of the row before and of the row after (NULL at the ends of the series)."""
    previous, following = previous or {}, following or {}
    # wrapped in a struct so that a NULL value differs from a missing row
    rows = df.withColumn("_chunk", s.chunk_of()).withColumns({f"__x_{n}": F.struct(c.alias("v")) for n, c in {**previous, **following}.items()})
    totals = {f"__t_{n}": F.max_by(f"__x_{n}", s.position()) for n in previous} | {f"__t_{n}": F.min_by(f"__x_{n}", s.position()) for n in following}
    stage = {f"__c_{n}": F.lag(f"__t_{n}").over(s.along()) for n in previous} | {f"__c_{n}": F.lead(f"__t_{n}").over(s.along()) for n in following}
    joined = _hand_on(rows, s, totals, [stage], list(stage))
    found = {n: F.coalesce(F.lag(f"__x_{n}").over(s.inside()), F.col(f"__c_{n}"))["v"] for n in previous}
    found |= {n: F.coalesce(F.lead(f"__x_{n}").over(s.inside()), F.col(f"__c_{n}"))["v"] for n in following}
    return _clean(joined.withColumns(found))


def with_halo(df: DataFrame, keys: list[str], pos: str, reach: int, size: int, columns: Callable[[Window], dict[str, Column]]) -> DataFrame:
    """Window columns that look at most ``reach`` positions away in a densely numbered series.

    Rows near the edge of a block of ``size`` positions are copied to the neighbouring block; the copies
    are dropped again after the window ran. One shuffle, no join.
    """
    if size <= reach:
        raise ValueError("a block has to be larger than the reach of the window")
    p = F.col(pos)
    blocks = F.sequence(F.floor((p - reach) / size), F.floor((p + reach) / size))
    spread = df.withColumn("_block", F.explode(blocks))
    window = Window.partitionBy(*keys, "_block").orderBy(pos)
    return spread.withColumns(columns(window)).where(F.col("_block") == F.floor(p / size)).drop("_block")


def runs(df: DataFrame, s: Series, state: Column, run: str = "run") -> DataFrame:
    """Number the maximal runs of equal ``state`` along the series."""
    rows = df.withColumn("_chunk", s.chunk_of()).withColumn("__state", F.struct(state.alias("v")))
    before = F.lag("__state").over(s.inside())
    changed = F.when(before.isNull() | before.eqNullSafe(F.col("__state")), 0).otherwise(1)
    rows = rows.withColumn("__changed", changed)
    totals = {
        "__changes": F.sum("__changed"), "__head": F.min_by("__state", s.position()), "__tail": F.max_by("__state", s.position())
    }
    stages = [
        {"__edge": F.when(F.lag("__tail").over(s.along()).eqNullSafe(F.col("__head")), 0).otherwise(1)},
        {"__base": F.coalesce(F.sum(F.col("__changes") + F.col("__edge")).over(s.chunks_before()), F.lit(0)) + F.col("__edge")},
    ]
    joined = _hand_on(rows, s, totals, stages, ["__base"])
    return _clean(joined.withColumn(run, F.coalesce("__base", F.lit(1)) + F.sum("__changed").over(s.upto())))


def islands(df: DataFrame, s: Series, condition: Column, min_length: int) -> DataFrame:
    """Runs of at least ``min_length`` rows where the condition holds: first, last and number of rows."""
    first = s.order[0]
    numbered_runs = runs(df.withColumn("_holds", F.coalesce(condition, F.lit(False))), s, F.col("_holds"))
    return (
        numbered_runs.where("_holds")
        .groupBy(*s.keys, "run")
        .agg(F.min(first).alias("first"), F.max(first).alias("last"), F.count(F.lit(1)).alias("length"))
        .where(F.col("length") >= min_length)
        .drop("run")
    )


def _placed(n: Column, v: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), v.alias("v"))


def interpolate(df: DataFrame, s: Series, value: str, out: str, ends: bool = True) -> DataFrame:
    """Fill NULL values linearly between their known neighbours, by number of rows between them.

    With ``ends`` the rows before the first and after the last known value take that value.
    """
    v = F.col(value).cast("double")
    rows = df.withColumn("_chunk", s.chunk_of()).withColumn("__row", F.row_number().over(s.inside()))
    is_known = F.when(F.col(value).isNotNull(), s.position())
    here = _placed(F.col("__row"), v)
    totals = {"__rows": F.count(F.lit(1)), "__last": F.max_by(here, is_known), "__first": F.min_by(here, is_known)}

    def shifted(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), _placed(F.col("__offset") + F.col(c)["n"], F.col(c)["v"]))

    stages = [
        {"__offset": F.coalesce(F.sum("__rows").over(s.chunks_before()), F.lit(0))},
        {
            "__past": F.last(shifted("__last"), ignorenulls=True).over(s.chunks_before()),
            "__next": F.first(shifted("__first"), ignorenulls=True).over(s.chunks_after()),
        },
    ]
    joined = _hand_on(rows, s, totals, stages, ["__offset", "__past", "__next"])
    joined = joined.withColumn("__n", F.coalesce("__offset", F.lit(0)) + F.col("__row"))
    at = F.when(F.col(value).isNotNull(), _placed(F.col("__n"), v))
    both = joined.withColumns(
        {
            "__a": F.coalesce(F.last(at, ignorenulls=True).over(s.upto()), F.col("__past")),
            "__b": F.coalesce(F.first(at, ignorenulls=True).over(s.onward()), F.col("__next")),
        }
    )
    a, b = F.col("__a"), F.col("__b")
    share = (F.col("__n") - a["n"]) / (b["n"] - a["n"])
    inner = F.when(b["n"] > a["n"], a["v"] + (b["v"] - a["v"]) * share).otherwise(a["v"])
    edge = F.coalesce(a["v"], b["v"]) if ends else F.lit(None).cast("double")
    return _clean(both.withColumn(out, F.when(a.isNotNull() & b.isNotNull(), inner).otherwise(edge)))


def bridge_mask(df: DataFrame, s: Series, value: str, mask: Column, out: str) -> DataFrame:
    """Replace each masked run by the line from its own first value to the first value after it.

    A run that reaches the end of the series keeps its values.
    """
    v = F.col(value).cast("double")
    masked = F.col("__mask")
    rows = df.withColumn("_chunk", s.chunk_of()).withColumn("__mask", F.coalesce(mask, F.lit(False)))
    rows = rows.withColumns({"__row": F.row_number().over(s.inside()), "__before": F.lag("__mask").over(s.inside())})
    here = _placed(F.col("__row"), v)
    # whether the first row of a chunk opens a run is decided from the end of the chunk before
    opens_inside = masked & (F.col("__row") > 1) & ~F.coalesce("__before", F.lit(False))
    totals = {
        "__rows": F.count(F.lit(1)), "__head": F.min_by(F.struct(masked.alias("m"), v.alias("v")), s.position()), "__tail": F.max_by("__mask", s.position()),
        "__open": F.max_by(here, F.when(opens_inside, s.position())), "__clear": F.min_by(here, F.when(~masked, s.position())),
    }
    stages = [
        {"__offset": F.coalesce(F.sum("__rows").over(s.chunks_before()), F.lit(0)), "__tail_before": F.lag("__tail").over(s.along())},
        {
            "__opened": F.when(F.col("__open").isNotNull(), _placed(F.col("__offset") + F.col("__open")["n"], F.col("__open")["v"])).when(
                F.col("__head")["m"] & ~F.coalesce("__tail_before", F.lit(False)), _placed(F.col("__offset") + 1, F.col("__head")["v"])
            ),
            "__cleared": F.when(F.col("__clear").isNotNull(), _placed(F.col("__offset") + F.col("__clear")["n"], F.col("__clear")["v"])),
        },
        {
            "__past": F.last("__opened", ignorenulls=True).over(s.chunks_before()),
            "__next": F.first("__cleared", ignorenulls=True).over(s.chunks_after()),
        },
    ]
    joined = _hand_on(rows, s, totals, stages, ["__offset", "__tail_before", "__past", "__next"])
    joined = joined.withColumn("__n", F.coalesce("__offset", F.lit(0)) + F.col("__row"))
    now = _placed(F.col("__n"), v)
    opens = masked & ~F.coalesce("__before", "__tail_before", F.lit(False))
    both = joined.withColumns(
        {
            "__a": F.coalesce(F.last(F.when(opens, now), ignorenulls=True).over(s.upto()), F.col("__past")),
            "__b": F.coalesce(F.first(F.when(~masked, now), ignorenulls=True).over(s.onward()), F.col("__next")),
        }
    )
    a, b = F.col("__a"), F.col("__b")
    line = a["v"] + (b["v"] - a["v"]) * (F.col("__n") - a["n"]) / (b["n"] - a["n"])
    return _clean(both.withColumn(out, F.when(masked & b.isNotNull(), line).otherwise(v)))


def longest_changes(df: DataFrame, s: Series, value: str) -> DataFrame:
    """Longest consecutive increase and decrease per series and whether the increase comes first.

    Equal neighbours neither extend nor break a run. The first of equally long runs counts.
    """
    steps = adjacent(df, s, previous={"_before": F.col(value)}).withColumn("_sign", F.signum(F.col(value) - F.col("_before")))
    stretch = runs(steps.where("_sign <> 0"), s, F.col("_sign")).groupBy(*s.keys, "run", "_sign").agg(
        F.count(F.lit(1)).alias("len"), F.min(s.order[0]).alias("start")
    )
    longest = F.struct("len", (-F.col("start")).alias("neg"))
    per = stretch.groupBy(*s.keys).agg(
        F.max(F.when(F.col("_sign") > 0, longest)).alias("up"), F.max(F.when(F.col("_sign") < 0, longest)).alias("down")
    )
    none = F.lit(0)
    up, down = -F.col("up.neg"), -F.col("down.neg")
    return df.select(*s.keys).distinct().join(per, s.keys, "left").select(
        *s.keys,
        F.coalesce(F.col("up.len"), none).cast("bigint").alias("largest_increase"),
        F.coalesce(F.col("down.len"), none).cast("bigint").alias("largest_decrease"),
        # a missing run counts as one that starts before everything
        F.coalesce(up < down, up.isNull() & down.isNotNull()).alias("increase_first"),
    )


def jump_mask(df: DataFrame, s: Series, value: str, threshold: float, out: str = "jump") -> DataFrame:
    """Both rows on either side of a step of at least ``threshold``."""
    n = adjacent(df, s, previous={"_p": F.col(value)}, following={"_f": F.col(value)})

    def far(other: str) -> Column:
        return F.coalesce(F.abs(F.col(value) - F.col(other)) >= threshold, F.lit(False))

    return n.withColumn(out, far("_p") | far("_f")).drop("_p", "_f")


def drop_abrupt(df: DataFrame, keys: list[str], order: str, value: str, max_diff: float, out: str) -> DataFrame:
    """NULL the row after the first rise and the row before the first fall of at least ``max_diff``.

    Works on the positions of one frame, whose number is limited, with windows over one partitioning. As
    in the sequence of these two steps, the fall is looked for after the rise was removed.
    """
    along = Window.partitionBy(*keys).orderBy(order)
    whole = Window.partitionBy(*keys)
    at = F.col(order)
    rise = F.min(F.when(F.col(value) - F.col("_p") >= max_diff, at)).over(whole)
    fall = F.min(F.when(F.col("_f") - F.col("_v") <= -max_diff, at)).over(whole)
    risen = df.withColumn("_p", F.lag(value).over(along)).withColumn("_rise", rise)
    risen = risen.withColumn("_v", F.when(at.eqNullSafe(F.col("_rise")), None).otherwise(F.col(value)))
    fallen = risen.withColumn("_f", F.lead("_v").over(along)).withColumn("_fall", fall)
    return fallen.withColumn(out, F.when(at.eqNullSafe(F.col("_fall")), None).otherwise(F.col("_v"))).drop("_p", "_rise", "_v", "_f", "_fall")


def consecutive_mask(df: DataFrame, keys: list[str], pos: str, flag: str, width: int, block: int, out: str) -> DataFrame:
    """Rows whose centred window of ``width`` flags is all true, widened by one row on each side.

    ``pos`` numbers the rows densely from 1; widening wraps around the ends of the series.
    """
    value = F.col(flag).cast("int")
    full = with_halo(
        df, keys, pos, width, block,
        lambda w: {"_full": F.coalesce(F.sum(value).over(w.rowsBetween(-(width // 2), (width - 1) // 2)), F.lit(0)) >= width},
    )
    ends = full.groupBy(*keys).agg(F.min_by("_full", pos).alias("_head"), F.max_by("_full", pos).alias("_tail"))
    wide = with_halo(
        full, keys, pos, 1, block, lambda w: {"_before": F.lag("_full").over(w), "_after": F.lead("_full").over(w)}
    )
    joined = wide.join(ends, keys)
    grown = F.col("_full") | F.coalesce("_before", "_tail") | F.coalesce("_after", "_head")
    return joined.withColumn(out, grown).drop("_full", "_before", "_after", "_head", "_tail")
