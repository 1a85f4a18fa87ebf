"""Repair of conversation structure: the cheapest edits after which roles alternate, found by divide and conquer in linear space."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Costs of the edits; a truncated row that is not deleted adds ``TRUNCATED``.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows of a conversation that are solved together; a longer one is cut into such stretches, which hand costs along.
STRETCH = 65_536

# States: nothing yet, a system turn first, after a user turn, after an assistant turn.
_INITIAL = {"s": 0, "u": 1, "a": 2}
_AFTER_INITIAL = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}
_NEXT = [2, 2, 3, 2]  # the state after a user or assistant turn that fits
_ROLE = {2: "user", 3: "assistant"}
_END = {0: "", 1: "II", 2: "I", 3: ""}
MUST_GO, SHORT = 4, 8  # flags of a row's code, beside the class of its role: s, u, a or another

_NEVER = 1 << 60
#: Costs of being in each of the four states, and the order of the least edits that lead there.
Vector = tuple[tuple[int, ...], tuple[int, ...]]


def _options(code: int, state: int) -> Iterator[tuple[int, int, str]]:
    """State after a row, cost and edits of each way to get past it, insertions before it included."""
    extra = TRUNCATED if code & SHORT else 0
    inserted, cost = "", 0
    for _ in range(3):
        yield state, cost + DELETE, f"{inserted}D"
        if not code & MUST_GO:
            yield _NEXT[state], cost + REROLE + extra, f"{inserted}R"
            kept = _AFTER_INITIAL.get((state, code & 3))
            if kept is not None:
                yield kept, cost + extra, f"{inserted}K"
        state, inserted, cost = _NEXT[state], f"{inserted}I", cost + INSERT


@lru_cache(maxsize=None)
def step(code: int) -> tuple[tuple[tuple[int, str], ...], ...]:
    """For each state before and after a row: the least cost and, among such edits, the first ones in ASCII order."""
    best = [[(_NEVER, "")] * 4 for _ in range(4)]
    for state in range(4):
        for after, cost, edits in _options(code, state):
            best[state][after] = min(best[state][after], (cost, edits))
    return tuple(map(tuple, best))


def _ordered(names: list) -> list[int]:
    """Places of the names in sorted order."""
    place = {name: k for k, name in enumerate(sorted(set(names)))}
    return [place[name] for name in names]


@lru_cache(maxsize=None)
def _row_matrix(code: int) -> tuple[tuple[tuple[int, ...], ...], tuple[tuple[int, ...], ...]]:
    return tuple(tuple(c for c, _ in row) for row in step(code)), tuple(tuple(_ordered([e for _, e in row])) for row in step(code))


def advance(vector: Vector, costs, orders) -> Vector:
    """The vector behind a row or a stretch, given its costs from state to state and, for each start, the order of its edits.

    Edits up to a row differ between states and none starts with another's, so they are ordered by where they come from,
    and only those of one origin by what is added. That keeps the ASCII-least edits with four numbers.
    """
    before, rank = vector
    ways = [min((before[s] + costs[s][t], rank[s], orders[s][t]) for s in range(4)) for t in range(4)]
    return tuple(min(w[0], _NEVER) for w in ways), tuple(_ordered([w[1:] if w[0] < _NEVER else (9, 9) for w in ways]))


def retreat(costs, after: tuple[int, ...]) -> tuple[int, ...]:
    """Least costs from each state before a row or a stretch to the end."""
    return tuple(min(_NEVER, *(costs[s][t] + after[t] for t in range(4))) for s in range(4))


def _least(cost: tuple[int, ...]) -> tuple[int, ...]:
    """Costs less their minimum: few different vectors occur, so each step is computed once and looked up from then on."""
    low = min(cost)
    return tuple(c - low if c < _NEVER else _NEVER for c in cost)


@lru_cache(maxsize=1 << 16)
def _forward(vector: Vector, code: int) -> tuple[Vector, int]:
    """The vector behind a row less its minimum, and that minimum."""
    cost, rank = advance(vector, *_row_matrix(code))
    return (_least(cost), rank), min(cost)


@lru_cache(maxsize=1 << 16)
def _backward(after: tuple[int, ...], code: int) -> tuple[int, ...]:
    return _least(retreat(_row_matrix(code)[0], after))


def _only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else _NEVER for s in range(4))


def forward(codes: bytes, start: int) -> tuple[Vector, int]:
    """The vector behind the rows, less a constant that is returned with it."""
    vector, total = (_only(start), (0, 0, 0, 0)), 0
    for code in codes:
        vector, low = _forward(vector, code)
        total += low
    return vector, total


def crossing(before: Vector, after: tuple[int, ...]) -> int:
    """The state in which the cheapest edits cross; among several the one with the first edits before it."""
    return min(range(4), key=lambda s: (before[0][s] + after[s], before[1][s]))


def edits_between(codes: bytes, start: int, stop: int) -> list[str]:
    """Edits of each row from state ``start`` to ``stop``: halves meet in the crossing state and are solved in the same way."""
    if len(codes) == 1:
        return [step(codes[0])[start][stop][1]]
    half = len(codes) // 2
    after = _only(stop)
    for code in reversed(codes[half:]):
        after = _backward(after, code)
    meet = crossing(forward(codes[:half], start)[0], after)
    return edits_between(codes[:half], start, meet) + edits_between(codes[half:], meet, stop)


def stretch_matrix(codes: bytes) -> tuple[list[list[int]], list[list[int]]]:
    """Costs of a stretch from state to state, and for each start the order of its edits."""
    ways = [forward(codes, start) for start in range(4)]
    return [[c + total if c < _NEVER else _NEVER for c in vector[0]] for vector, total in ways], [list(vector[1]) for vector, _ in ways]


_END_COST = tuple(len(_END[s]) * INSERT for s in range(4))


def border_states(matrices: list[tuple[list[list[int]], list[list[int]]]]) -> list[int]:
    """States before the first, between all and behind the last stretch of a conversation."""
    after = [_END_COST]
    for costs, _ in reversed(matrices):
        after.append(retreat(costs, after[-1]))
    after.reverse()
    states, vector = [0], (_only(0), (0, 0, 0, 0))
    for (costs, orders), rest in zip(matrices, after[1:], strict=True):
        vector = advance(vector, costs, orders)
        states.append(crossing(vector, rest))
    return states


def _illegal(codes: bytes) -> int:
    """Neighbours whose roles may not follow each other."""
    return sum((a & 3, b & 3) not in {(0, 1), (1, 2), (2, 1)} for a, b in zip(codes, codes[1:]))


def _told(codes: bytes, state: int, edits: list[str]) -> tuple[list[str], int]:
    """The role that each edit gives (``u``, ``a``; ``-`` for rows kept or deleted), and what all edits cost."""
    roles, cost = [], 0
    for code, own in zip(codes, edits, strict=True):
        given = ""
        for edit in own:
            if edit == "I" or edit == "R":
                state = _NEXT[state]
                given += "ua"[state - 2]
            else:
                given += "-"
                if edit == "K":
                    state = _AFTER_INITIAL[state, code & 3]
            cost += {"I": INSERT, "R": REROLE, "D": DELETE, "K": 0}[edit]
            if edit in "KR" and code & SHORT:
                cost += TRUNCATED
        roles.append(given)
    return roles, cost


@lru_cache(maxsize=1 << 14)
def solve(codes: bytes, start: int = 0, stop: int | None = None, last: bool = True) -> tuple[list[str], list[str], int]:
    """Edits and roles of each row of a stretch, and their cost; what is inserted at the end belongs to the last row."""
    if stop is None:
        stop = crossing(forward(codes, start)[0], _END_COST)
    edits = edits_between(codes, start, stop)
    if last:
        edits[-1] += _END[stop]
    return edits, *_told(codes, start, edits)


_SPACE = " \t\n\x0b\x0c\r"


def _digest(role: Column, text: Column) -> Column:
    size = F.coalesce(F.char_length(role).cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(size, F.lit(":"), F.coalesce(role, F.lit("")), F.coalesce(text, F.lit("")))))


def mark_turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, same, place, fault, code`` of every row: its place in the order of its conversation and its first fault.

    Rows go by turn, a missing one first; rows of one turn by role and a digest of their content, so equal rows are neighbours.
    A row is ``blank`` (no sign but white space, or NULL), else a ``duplicate`` (role and text stand earlier in the
    conversation), else ``truncated`` (does not end with ``.``, ``!`` or ``?``), else NULL. A missing role is none of the known ones;
    rows without a conversation form one of their own. Texts are not moved, only their digests of 128 bits.

    Ranges of the whole order go to tasks, so a conversation of any length is spread over them.
    """
    role, body = F.col(role), F.rtrim(F.coalesce(F.col(text), F.lit("")), F.lit(_SPACE))
    kind = F.substring(role, 1, 1)
    light = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), role.alias("role"), _digest(role, F.col(text)).alias("same"),
        (body == "").alias("blank"), (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("short"), F.monotonically_increasing_id().alias("tie"),
        F.coalesce(F.when(kind == "s", 0).when(kind == "u", 1).when(kind == "a", 2), F.lit(3)).alias("kind"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc("same"), F.asc("tie")]
    # the running number tells equal rows apart only where ranges are cut
    ranged = light.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()).drop("tie")
    ranged = cut_lineage(ranged, "turns")
    first = ranged.groupBy(F.col("conv").alias("of"), F.col("same").alias("is")).agg(F.min("place").alias("first"))
    told = ranged.join(first, F.col("conv").eqNullSafe(F.col("of")) & (F.col("same") == F.col("is")))
    fault = F.when(F.col("blank"), "blank").when(F.col("place") > F.col("first"), "duplicate").when(F.col("short"), "truncated")
    code = F.col("kind") + F.when(fault.isin("blank", "duplicate"), MUST_GO).when(fault == "truncated", SHORT).otherwise(0)
    return cut_lineage(told.select("conv", "turn", "role", "same", "place", fault.alias("fault"), code.alias("code")), "marked")


def _codes(column: pa.Array) -> list[bytes]:
    return [bytes(c - 48 for c in text.encode()) for text in column.to_pylist()]


def repair_turns(marked: DataFrame) -> DataFrame:
    """``conv, stretch, first, edits, roles, cost, illegal`` for stretches of the rows of ``mark_turns``.

    ``edits`` holds a text for each row, ``first`` the place of the first one: ``I`` for turns inserted before (or at the very end)
    and ``K``, ``R`` or ``D`` for the row that is kept, gets another role or is deleted. All edits of a conversation cost the least
    after which it is empty or an optional system turn and pairs of user and assistant turns; among such edits they come first in
    ASCII order. ``roles`` has what inserted and changed rows become. ``illegal`` counts neighbours in the input whose roles may not
    follow each other, the one across the start of a stretch included.

    A stretch has at most ``STRETCH`` rows, a byte each. Longer conversations hand on the costs of each stretch from
    state to state, forwards and backwards; where both meet, the states at its ends are fixed, and stretches are solved apart.
    """
    conv = marked.schema["conv"].dataType.simpleString()
    line = F.array_sort(F.collect_list(F.struct("place", "code")))
    cut = marked.groupBy("conv", F.expr(f"place DIV {STRETCH}").alias("stretch")).agg(F.min("place").alias("first"), line.alias("line"))
    codes = F.array_join(F.transform("line", lambda x: F.char(x["code"] + 48)), "")
    cut = cut_lineage(cut.select("conv", "stretch", "first", codes.alias("codes")), "stretches")
    several = cut.groupBy(F.col("conv").alias("of")).agg(F.count("*").alias("n")).where("n > 1").select("of")
    parts = cut.join(several, F.col("conv").eqNullSafe(F.col("of")), "left_semi")

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _codes(batch.column(2))
            both = [stretch_matrix(c) for c in own]
            flat = pa.array([sum(costs + orders, []) for costs, orders in both], pa.list_(pa.int64()))
            ends = [pa.array([c[k] & 3 for c in own], pa.int32()) for k in (0, -1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat, *ends], ["of", "part", "numbers", "head", "tail"])

    def borders(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        rows = [np.reshape(n, (2, 4, 4)).tolist() for n in table.column("numbers").to_pylist()]
        states = border_states([(r[0], r[1]) for r in rows])
        heads, tails = table.column("head").to_pylist(), table.column("tail").to_pylist()
        across = [0, *(_illegal(bytes(pair)) for pair in zip(tails, heads[1:]))]
        last = [False] * (len(rows) - 1) + [True]
        columns = [table.column("of"), table.column("part"), *(pa.array(c, pa.int32()) for c in (states[:-1], states[1:], across)), pa.array(last)]
        return pa.table(columns, names=["of", "part", "start", "stop", "across", "last"])

    told = parts.select("conv", "stretch", "codes").mapInArrow(matrices, f"of {conv}, part long, numbers array<long>, head int, tail int")
    known = told.groupBy("of").applyInArrow(borders, f"of {conv}, part long, start int, stop int, across int, last boolean")
    every = cut.join(known, F.col("conv").eqNullSafe(F.col("of")) & (F.col("stretch") == F.col("part")), "left").drop("of", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _codes(batch.column(3))
            starts, stops, across, last = (batch.column(k).to_pylist() for k in range(4, 8))
            done = [solve(c, s or 0, t, w is not False) for c, s, t, w in zip(own, starts, stops, last, strict=True)]
            bad = [_illegal(c) + (a or 0) for c, a in zip(own, across, strict=True)]
            texts = [pa.array([d[k] for d in done], pa.list_(pa.string())) for k in (0, 1)]
            numbers = [pa.array(values, pa.int64()) for values in ([d[2] for d in done], bad)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *texts, *numbers], ["conv", "stretch", "first", "edits", "roles", "cost", "illegal"])

    return cut_lineage(every.mapInArrow(run, f"conv {conv}, stretch long, first long, edits array<string>, roles array<string>, cost long, illegal long"), "edits")


def edit_log(rows: DataFrame, marked: DataFrame, solved: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each edit: ``conv, place, step, edit, turn, was, role, text, fault``, in the order of ``conv, place, step``.

    ``was`` is the role before, ``role`` the one after the edit; deleted rows keep their text so that the log tells what went;
    inserted turns have an empty text. The repaired conversation is what is left without ``D``.
    """
    each = solved.select("conv", "first", F.posexplode(F.arrays_zip("edits", "roles")).alias("at", "own"))
    letter = lambda name: F.regexp_extract_all(F.col(f"own.{name}"), F.lit("."), F.lit(0))
    each = each.select("conv", (F.col("first") + F.col("at")).alias("place"), letter("edits").alias("edit"), letter("roles").alias("given"))
    each = each.select("conv", "place", F.posexplode(F.arrays_zip("edit", "given")).alias("step", "own")).select("conv", "place", "step", "own.*")
    given = F.when(F.col("given") == "u", "user").when(F.col("given") == "a", "assistant")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    turns = none(marked.schema["turn"].dataType, "turn")
    new = each.where("edit = 'I'").select("conv", "place", "step", "edit", turns, none("string", "was"), given.alias("role"), F.lit("").alias("text"), none("string", "fault"))
    # the same content of a conversation travels once
    texts = rows.select(F.col(conv).alias("of"), _digest(F.col(role), F.col(text)).alias("is"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = texts.groupBy("of", "is").agg(F.first("text").alias("text"))
    old = each.where("edit <> 'I'").drop("conv").join(marked.withColumnRenamed("role", "was"), "place")
    old = old.join(texts, F.col("conv").eqNullSafe(F.col("of")) & (F.col("same") == F.col("is")))
    return old.select("conv", "place", "step", "edit", "turn", "was", F.coalesce(given, "was").alias("role"), "text", "fault").unionByName(new)


def structure(marked: DataFrame) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated``: turns that are missing between the first and the last one, and rows by fault."""
    number = lambda fault: F.count(F.when(F.col("fault") == fault, 1)).alias(fault)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return marked.groupBy("conv").agg(F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *map(number, ("blank", "duplicate", "truncated")))
