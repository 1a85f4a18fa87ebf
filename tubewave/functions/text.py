"""Text, name and unit functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wording written to and read from reports.
REPORTABLE_DEPTH = 0.1
REPORTABLE_EXTENT = 1.5
FLAG_SUFFIX = "(2)"
BELOW_DEPTH = "< 0.1"
BELOW_DEPTH_FLAGGED = "< 0.1 (2)"
BELOW_EXTENT = "< 1.5"
FLAGGED_MISSING = "nan (2)"
SEE_NOTE = "See note_2"
NOTE1_BELOW = "< 0.1 (1)"
NOTE1_BELOW_FLAGGED = "< 0.1 (1)(2)"
SEE_CATEGORIES = "see possible category flaw depth"
MM_PER_SAMPLE = 0.008
SOUND_FACTOR = 0.710
STATIONS = {"D": "Darlington", "P": "Pickering"}
STATION_FOLDER = "Scan Data - "
CHANNEL_LABELS = [
    ("ID1 NB", "ID1 NB"),
    ("ID2 NB", "ID2 NB"),
    ("Circ Shear P/C", "Circ Shear P/C"),
    ("Axial Shear P/C", "Axial Shear P/C"),
    ("ID NB", "ID1 NB"),
]
LABEL_PROBE = {"ID1 NB": "NB1", "ID2 NB": "NB2", "Circ Shear P/C": "CPC", "Axial Shear P/C": "APC"}


def to_number(text: Column) -> Column:
    return text.try_cast("double")


def parse_measure(text: Column) -> Column:
    """Number in a measured-value text: what precedes '(' without '<' and '*'; NULL when not a number."""
    head = F.split(text, r"\(").getItem(0)
    return to_number(F.trim(F.regexp_replace(head, "[<*]", "")))


def first_token(text: Column) -> Column:
    return F.split(F.ltrim(text), " ").getItem(0)


def depth_text(depth: Column) -> Column:
    """Depth text for a report; small depths read '< 0.1', flagged missing ones refer to the note."""
    number = to_number(first_token(depth))
    flagged = F.contains(depth, F.lit(" "))
    return (
        F.when(depth == FLAGGED_MISSING, SEE_NOTE)
        .when((number < REPORTABLE_DEPTH) & flagged, BELOW_DEPTH_FLAGGED)
        .when(number < REPORTABLE_DEPTH, BELOW_DEPTH)
        .otherwise(depth)
    )


def extent_text(value: Column) -> Column:
    return F.when(value < REPORTABLE_EXTENT, F.lit(BELOW_EXTENT)).otherwise(value.cast("string"))


def category_depth_text(depths: Column) -> Column:
    """One text for a map category -> depth text; NULL for an empty or missing map."""
    values = F.map_values(depths)
    small = F.forall(values, lambda v: to_number(first_token(v)) < REPORTABLE_DEPTH)
    flagged = F.exists(values, lambda v: F.contains(v, F.lit(FLAG_SUFFIX)))
    return F.when(
        F.size(values) > 0,
        F.when(small & flagged, NOTE1_BELOW_FLAGGED).when(small, NOTE1_BELOW).otherwise(SEE_CATEGORIES),
    )


def map_sentence(values: Column) -> Column:
    """'key: value.' for every entry, joined by blanks."""
    parts = F.transform(F.map_entries(values), lambda e: F.concat(e["key"], F.lit(": "), e["value"], F.lit(".")))
    return F.array_join(parts, " ")


def depth_difference(reported: Column, predicted: Column) -> Column:
    """Reported minus predicted depth; for a reported '<' text only what exceeds 0.1 counts."""
    pred = to_number(F.trim(F.split(predicted, r"\(").getItem(0)))
    below = F.when(pred < REPORTABLE_DEPTH, F.lit(0.0)).otherwise(pred - REPORTABLE_DEPTH)
    return (
        F.when(F.contains(reported, F.lit("<")), below)
        .when(F.contains(reported, F.lit(">")), F.lit(None).cast("double"))
        .otherwise(to_number(F.trim(reported)) - pred)
    )


def plain_flaw_type(flaw_type: Column) -> Column:
    """Upper-case type without the BM_/EM_ prefix and without a bracketed suffix."""
    bare = F.regexp_replace(F.regexp_replace(F.upper(flaw_type), "^BM_", ""), "^EM_", "")
    return F.when(F.contains(bare, F.lit("(")), F.trim(F.split(bare, r"\(").getItem(0))).otherwise(bare)


def category_label(counts: Column) -> Column:
    """Short label of a class-count map (map order is the order in which classes were seen)."""
    names = F.map_keys(counts)
    n = F.size(names)

    def has(name: str) -> Column:
        return F.array_contains(names, name)

    initials = F.array_join(F.transform(F.array_sort(names), lambda k: F.substring(k, 1, 1)), "+")
    others = F.array_join(F.transform(F.filter(names, lambda k: k != "V"), lambda k: F.substring(k, 1, 1)), "+")
    return (
        F.when(counts.isNull() | (n <= 0), "dnd")
        .when(has("Spaghetti"), "s")
        .when(has("V") & has("default") & (n == 2), "V+d")
        .when(has("V") & has("MR") & (n == 2), "V+M")
        .when(has("V") & (n > 1), F.concat(F.lit("V+"), others))
        .when(F.exists(names, lambda k: k.startswith("MR")), "M")
        .when(has("V") & (F.element_at(counts, F.lit("V")) == 1), "V")
        .when(has("V") & (F.element_at(counts, F.lit("V")) > 1), "MV")
        .otherwise(initials)
    )


def outage_year(outage: Column) -> Column:
    """Year of an outage number that starts with D: its first two adjacent digits in the 2000s."""
    text = F.trim(outage)
    digits = F.regexp_extract(F.substring(text, 2, 1000), r"(\d\d)", 1)
    return F.when(text.startswith("D") & (digits != ""), F.lit(2000) + digits.cast("int"))


def outage_number(station: Column, year: Column, unit: Column) -> Column:
    """Station initial, year, unit and the fixed trailing 1."""
    return F.concat(F.substring(station, 1, 1), year.cast("string"), unit.cast("string"), F.lit("1"))


def channel_folder(channel: Column) -> Column:
    """Channel as letter and two digits: 'D-6 x' and 'D-06' both give D06."""
    head = F.split(channel, " ").getItem(0)
    bare = F.regexp_replace(head, "-", "")
    return F.when(F.length(bare) == 2, F.concat(F.substring(head, 1, 1), F.lit("0"), F.substring(head, 3, 1))).otherwise(bare)


def scan_file_path(outage: Column, channel: Column, file_name: Column, root: str) -> tuple[Column, Column]:
    """Paths of the Type A and the Type D file of a data-map row; NULL for an unknown station."""
    initial = F.substring(outage, 1, 1)
    station = F.when(initial == "D", STATIONS["D"]).when(initial == "P", STATIONS["P"])
    folder = channel_folder(channel)
    base = F.concat(F.lit(f"{root}/{STATION_FOLDER}"), station, F.lit("/"), outage, F.lit("/"), folder, F.lit("/"))
    # one outage was recorded in the other format, except for one channel
    is_daq = (outage == "P2251") & (folder != "N09")
    name_a = F.replace(file_name, F.lit("BSCAN Type D"), F.lit("BSCAN Type A"))
    path_a = F.concat(base, name_a, F.when(is_daq, ".daq").otherwise(".anf"))
    path_d = F.when(~is_daq, F.concat(base, file_name, F.lit(".anf")))
    return path_a, path_d


def file_name_facts(file_name: Column) -> Column:
    """Station, outage and channel from the words of a scan file name."""
    words = F.split(F.trim(file_name), r"\s+")
    n = F.size(words)

    def word(i: int) -> Column:
        return F.element_at(words, i)

    def bare_channel(w: Column) -> Column:
        return F.substring(F.regexp_replace(w, "^-+|-+$", ""), 1, 3)

    is_d = F.contains(file_name, F.lit("Type D"))
    station = F.when(
        is_d, F.when(F.contains(word(5), F.lit(STATIONS["D"])), STATIONS["D"]).otherwise(STATIONS["P"])
    ).otherwise(F.when(word(2).startswith("D"), STATIONS["D"]).otherwise(STATIONS["P"]))
    year = F.element_at(F.split(word(-3), "-"), -1)
    unit = F.element_at(F.split(F.when(n == 11, word(7)).otherwise(word(6)), "-"), -1)
    built = F.concat(F.substring(station, 1, 1), F.right(year, F.lit(2)), unit, F.lit("1"))
    outage = (
        F.when(~is_d, word(2)).when(n == 9, word(4)).when(built == "D2111", F.lit("D2011")).otherwise(built)
    )
    channel = (
        F.when(~is_d, bare_channel(word(3)))
        .when(n == 9, bare_channel(word(5)))
        .otherwise(F.substring(F.regexp_replace(word(4), "-", ""), 1, 3))
    )
    return F.struct(station.alias("station"), outage.alias("outage"), channel.alias("channel"))


def scan_type(name: Column) -> Column:
    return F.regexp_extract(name, r"Type (\w+)", 1)


def scan_pitch(raw: Column, extension: Column) -> Column:
    """Axial pitch in mm: tenths in .anf headers, already mm in .daq ones."""
    return F.when(extension == "daq", raw).otherwise(F.round(raw, 1) / 10)


def quoted_path(text: Column) -> Column:
    return F.regexp_extract(text, "'([^']*)'", 1)


def overcall_reason(n_fields: Column, depth: Column) -> Column:
    """Why a false call is left out of the overcall table, or 'valid'."""
    head = F.split(depth, " ").getItem(0)
    number = to_number(depth)
    head_number = F.when(F.regexp_like(head, F.lit(r"^\d*\.?\d+$|^\d+\.$")), to_number(head))
    return (
        F.when(n_fields <= 3, "too few fields")
        .when(depth.isNull(), "null")
        .when(F.contains(depth, F.lit("<")), "low")
        .when(coalesce_lt(head_number, REPORTABLE_DEPTH), "low")
        .when(number.isNull(), "text")
        .otherwise("valid")
    )


def coalesce_lt(value: Column, limit: float) -> Column:
    return F.coalesce(value < limit, F.lit(False))


def is_flagged_text(depth: Column) -> Column:
    return F.contains(depth, F.lit(FLAG_SUFFIX)) | F.contains(depth, F.lit(SEE_NOTE))


def numbers_in(text: Column) -> Column:
    """All numbers among the words of a text; other words are skipped."""
    return F.filter(F.transform(F.split(text, r"\s+"), to_number), lambda v: v.isNotNull())


def frame_number(name: Column) -> Column:
    return F.split(name, "_").getItem(1).cast("int")


def until_nul(text: Column) -> Column:
    return F.split(text, "\\x00").getItem(0)


def drop_empty(values: Column) -> Column:
    return F.filter(values, lambda v: (v != "") & (v != "0"))


def na_text(value: Column) -> Column:
    return F.when(value.isNull() | F.isnan(value), F.lit("NA")).otherwise(value.cast("string"))


def clean_label(label: Column) -> Column:
    """Vendor channel label reduced to the expected label it contains."""
    out = F.lit(None).cast("string")
    for part, clean in reversed(CHANNEL_LABELS):
        out = F.when(F.contains(label, F.lit(part)), F.lit(clean)).otherwise(out)
    return F.coalesce(out, label)


def label_probes(label: Column, type_d: Column) -> Column:
    """Probe names behind a clean label; a Type D normal-beam label serves both normal-beam probes."""
    single = F.lit("NA")
    for name, probe in LABEL_PROBE.items():
        single = F.when(label == name, F.lit(probe)).otherwise(single)
    both = type_d & label.isin("ID1 NB", "ID2 NB")
    return F.when(both, F.array(F.lit("NB1"), F.lit("NB2"))).otherwise(F.array(single))


def samples_to_mm(samples: Column, cap_mm: float | None = None, factor: float = SOUND_FACTOR) -> Column:
    """Time samples to depth in mm, four decimals, not below zero."""
    mm = F.greatest(F.round(samples * MM_PER_SAMPLE * factor, 4), F.lit(0.0))
    capped = mm if cap_mm is None else F.least(mm, F.lit(cap_mm))
    # greatest and least pass over NULL, but an unknown lag has no depth
    return F.when(samples.isNotNull(), capped)


def mm_to_samples(mm: Column, factor: float = SOUND_FACTOR) -> Column:
    return mm / factor / MM_PER_SAMPLE


def nice_number(value: Column, rounded: bool = False) -> Column:
    """Next value of the 1-2-5 series, or the nearest one."""
    magnitude = F.pow(F.lit(10.0), F.floor(F.log10(value)))
    part = value / magnitude
    if rounded:
        step = F.when(part < 1.5, 1.0).when(part < 3, 2.0).when(part < 7, 5.0).otherwise(10.0)
    else:
        step = F.when(part <= 1, 1.0).when(part <= 2, 2.0).when(part <= 5, 5.0).otherwise(10.0)
    return step * magnitude


# Tick refinements tried in this order.
TICK_FACTORS = [1.0, 0.5, 0.25, 0.2, 0.1, 0.05, 0.025, 0.01]


def with_nice_axis(df: DataFrame, start: str, end: str, min_ticks: int = 10) -> DataFrame:
    """Adds axis ``first``, ``last`` and ``tick`` width so that at least ``min_ticks`` ticks fit.

    Each step is a column of its own, so that no step's expression is repeated inside the next.
    """
    a, b = F.col(start), F.col(end)
    rows = df.withColumn("_width", F.abs(b - a))
    rows = rows.withColumn("_part", nice_number(F.col("_width")) / (min_ticks - 1))
    rows = rows.withColumn("_base", nice_number(F.col("_part"), rounded=True))
    ticks = F.transform(F.array(*[F.lit(f) for f in TICK_FACTORS]), lambda f: f * F.col("_base"))
    fine = F.filter(ticks, lambda t: F.floor(F.col("_width") / t) + 1 >= min_ticks)
    rows = rows.withColumn("_tick", F.get(fine, F.lit(0)))
    flat, forced = F.col("_width") == 0, F.col("_tick").isNull()
    return (
        rows.withColumn("first", F.when(flat | forced, a).otherwise(F.floor(a / F.col("_tick")) * F.col("_tick")))
        .withColumn("last", F.when(flat | forced, b).otherwise(F.ceil(b / F.col("_tick")) * F.col("_tick")))
        .withColumn("tick", F.when(flat, 0.0).when(forced, F.col("_width") / (min_ticks - 1)).otherwise(F.col("_tick")))
        .drop("_width", "_part", "_base", "_tick")
    )
