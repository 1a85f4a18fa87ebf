"""Personal data in texts, and terms that give it away.

Everything here is DataFrame functions. Base spans (mail addresses, network addresses, card and phone numbers) come from
patterns. Then the corpus is asked which terms near a protected value reveal it: a term discloses a value if it carries
nearly all of the information that the value itself carries.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import own_name

#: Order of kinds at the same start.
KINDS = ["email", "ip", "card", "phone", "term"]
# The named patterns in forms that never go back: a match can only start where a run of its first class starts or where the
# last match ended, and what follows is taken as a whole, so texts of any length take linear time.
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text has at least if it has a match: saves the other passes over most texts.
_HINTS = {"email": "@", "phone": "+"}
_HINT_PATTERNS = {"ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}"}

#: A term: any word, in any case and at any place. Scripts without spaces give runs between other characters.
TERM = r"\p{L}[\p{L}\p{M}\p{N}]*+"
#: Words that may be names: met with a capital, or without case.
NAMED = r"^[\p{Lu}\p{Lt}\p{Lo}]"
#: Matches whose places are summed up at a time.
BLOCK = 128
#: Characters to either side of a protected value in which terms count as its context.
CONTEXT = 120
#: Texts without the value that are added to those a term was counted in: what few texts show is trusted less, words that
#: never look like a name least.
UNSEEN_NAMED, UNSEEN = 1, 3
#: Characters of a text that are looked through at a time.
PIECE = 4096
#: Bits of the first test of a term for each telling term, digests that it looks at, and bits of one of its parts.
TERM_BITS, TERM_DIGESTS, PART_BITS = 16, 4, 1 << 15
#: Shares of the value's information from which a term is generalised, and from which it is removed.
GENERALISED, REMOVED = 0.8, 0.95


def _blocks(matches: Column, gaps: Column) -> Column:
    """Matches and the lengths of the gaps before them, in blocks of ``BLOCK``."""
    numbers = F.when(F.size(matches) > 0, F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    part = lambda values, number: F.slice(values, number * BLOCK + 1, F.lit(BLOCK))
    return F.transform(numbers, lambda number: F.arrays_zip(part(matches, number).alias("value"), F.slice(part(gaps, number), F.lit(1), F.size(part(matches, number))).alias("gap")))


def _places(blocks: Column, wanted: Callable[[Column], Column] | None = None) -> Column:
    """Matches with their places, ``array<struct<start, end, value>>`` in code points, from blocks of matches and gaps.

    Appending copies an array, so places are summed up within blocks and the blocks are put together at the end; matches that
    are not ``wanted`` only count for the places of the others.
    """
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + pair["gap"]
        end = start + F.length(pair["value"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        longer = F.concat(state["out"], F.array(one))
        return F.struct(end.alias("at"), (longer if wanted is None else F.when(wanted(pair["value"]), longer).otherwise(state["out"])).alias("out"))

    def block(state: Column, own: Column) -> Column:
        inner = F.aggregate(own, F.struct(state["at"].alias("at"), none.alias("out")), step)
        return F.aggregate(F.array(inner), state, lambda old, new: F.struct(new["at"].alias("at"), F.concat(old["out"], F.array(new["out"])).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,end:int,value:string>>>").alias("out"))
    return F.aggregate(blocks, start, block, lambda state: F.flatten(state["out"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return F.length(_digits(value)).between(12, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _shaped(found: Column, place: int, kind: str) -> Column:
    valid = F.filter(found, lambda m: _valid(kind, m["value"]))
    fields = lambda m: [m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind"), m["value"].alias("value")]
    return F.transform(valid, lambda m: F.struct(*fields(m)))


def with_base_spans(docs: DataFrame, text: Column, spans: str, terms: str | None = None, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """``docs`` with base spans, ``array<struct<start, place, end, kind, value>>`` by start and kind, and on demand the
    places of ``wanted`` terms. Each pattern reads a text twice at most, and only if the text has what every match needs."""
    names = [f"_{spans}_{kind}" for kind in KINDS]
    kinds = KINDS[:4] + (["term"] if terms else [])
    raw = {}
    for kind, name in zip(kinds, names, strict=False):
        pattern = PATTERNS.get(kind, TERM)
        hint = F.locate(_HINTS[kind], text) > 0 if kind in _HINTS else text.rlike(_HINT_PATTERNS[kind]) if kind in _HINT_PATTERNS else F.lit(True)
        raw[f"{name}_m"] = F.when(hint, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))
    found = docs.withColumns(raw)
    gaps = {}
    for kind, name in zip(kinds, names, strict=False):
        lengths = F.transform(F.split(text, PATTERNS.get(kind, TERM), -1), F.length)
        gaps[f"{name}_g"] = F.when(F.size(f"{name}_m") > 0, lengths).otherwise(F.array().cast("array<int>"))
    found = found.withColumns(gaps)
    blocks = {f"{name}_b": _blocks(F.col(f"{name}_m"), F.col(f"{name}_g")) for name in names[: len(kinds)]}
    found = found.withColumns(blocks)
    places = {name: _places(F.col(f"{name}_b"), wanted if kind == "term" else None) for kind, name in zip(kinds, names, strict=False)}
    shaped = [_shaped(places[name], place, kind) for place, (kind, name) in enumerate(zip(KINDS[:4], names, strict=False))]
    out = {spans: F.array_sort(F.concat(*shaped))} | ({terms: places[names[4]]} if terms else {})
    return found.withColumns(out).drop(*raw, *gaps, *blocks)


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _contexts(docs: DataFrame) -> DataFrame:
    """``key, value, words`` of each protected value in ``key, body``: the whole words within ``CONTEXT`` characters of it.

    A context is cut from the pieces of the text that it touches, so a text with many values is not read from its start for each.
    """
    letters = r"[\p{L}\p{M}\p{N}]"
    pieces = F.when(F.size("spans") > 0, F.regexp_extract_all(F.col("body"), F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)))

    def shown(span: Column) -> Column:
        first, last = F.greatest(span["start"] - CONTEXT - 1, F.lit(0)), span["end"] + CONTEXT + 1
        at = (first / PIECE).cast("int")
        touched = F.when(F.size("pieces") > 0, F.slice("pieces", at + 1, (last / PIECE).cast("int") - at + 1))
        part = F.substring(F.array_join(touched, ""), first - at * PIECE + 1, last - first)
        part = F.when(span["start"] > CONTEXT, F.regexp_replace(part, f"^{letters}++", "")).otherwise(part)
        part = F.when(F.length("body") >= last, F.regexp_replace(part, f"(?<!{letters}){letters}++$", "")).otherwise(part)
        value = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(F.lower(span["value"]))
        words = F.array_distinct(F.regexp_extract_all(part, F.lit(TERM), F.lit(0)))
        return F.struct(F.md5(F.concat(span["kind"], F.lit(":"), value)).alias("value"), words.alias("words"))

    read = with_base_spans(docs, F.col("body"), "spans").withColumn("pieces", pieces)
    # for explode(), Spark would add a filter that computes the spans once more and the patterns once a block
    return read.select("key", F.explode_outer(F.transform("spans", shown)).alias("c")).where("c IS NOT NULL").select("key", "c.value", "c.words")


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """``term, share`` of terms, in lower case, that reveal a protected value.

    ``docs`` has ``key, body``; equal keys are one text. With the counts of texts that show value c, term t and both,
    PMI(c; t) = log(N n(c,t) / (n(c) n(t))) is compared with IC(c) = log(N / n(c)); their ratio is the share. ``UNSEEN_NAMED``
    or ``UNSEEN`` is added to n(t), so one text is evidence, but less than several.
    """
    contexts = cut_lineage(_contexts(docs), "contexts")
    words = contexts.select("key", "value", F.explode("words").alias("word"))
    near = words.groupBy(F.lower("word").alias("term"), "value", "key").agg(F.max(F.col("word").rlike(NAMED)).alias("named"))
    both = near.groupBy("value", "term").agg(F.count("*").alias("n_both"), F.max("named").alias("named"))
    values = contexts.select("value", "key").distinct().groupBy("value").agg(F.count("*").alias("n_value"))
    # of values met in equally many texts, the one seen most often with a term tells most
    pairs = both.join(values, "value").groupBy("term", "n_value").agg(F.max("n_both").alias("n_both"), F.max("named").alias("named"))
    texts = docs.groupBy("key").agg(F.first("body").alias("body"))
    terms = texts.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("body"), F.lit(TERM), F.lit(0)))).alias("term"))
    counted = terms.groupBy("term").agg(F.count("*").alias("n_term"))
    total = F.lit(float(max(docs.where("body != ''").select("key").distinct().count(), 2)))
    named = F.max("named").over(Window.partitionBy("term"))
    found = pairs.withColumn("named", named).join(counted, "term").where(F.col("n_value") < total)
    n_term = F.col("n_term") + F.when(F.col("named"), UNSEEN_NAMED).otherwise(UNSEEN)
    share = F.log(total * F.col("n_both") / (F.col("n_value") * n_term)) / F.log(total / F.col("n_value"))
    return found.groupBy("term").agg(F.max(share).alias("share")).where(F.col("share") >= GENERALISED)


def _among(terms: DataFrame) -> Callable[[Column], Column]:
    """A test that holds for every term of ``terms`` and for about one other word in four hundred.

    It takes ``TERM_BITS`` bits a term, so it does not fill up as terms become more. Bits are set where the terms are; the driver gets
    them by parts of ``PART_BITS``. A byte holds seven bits: it is an ASCII character then, which Spark reads as a number.
    """
    n_parts = max(-(-terms.count() * TERM_BITS // PART_BITS), 1)
    place = lambda term, k: F.pmod(F.xxhash64(term, F.lit(k)), F.lit(n_parts * PART_BITS))
    places = terms.select(F.explode(F.array(*[place(F.col("term"), k) for k in range(TERM_DIGESTS)])).alias("at"))
    parts = places.groupBy(F.expr(f"at DIV {PART_BITS}").alias("part")).agg(F.bitmap_construct_agg(F.col("at") % PART_BITS).alias("bits"))
    bits = np.zeros(n_parts * PART_BITS, np.uint8)
    for r in parts.collect():  # 4 kB for each 2,048 terms
        bits[r.part * PART_BITS : (r.part + 1) * PART_BITS] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")
    held = F.lit(bytes(np.packbits(np.pad(bits, (0, -len(bits) % 7)).reshape(-1, 7), axis=1, bitorder="little").ravel()))

    def among(term: Column) -> Column:
        found = F.lit(True)
        for k in range(TERM_DIGESTS):
            at = place(term, k)
            seven = F.ascii(F.substring(held, (F.floor(at / 7) + 1).cast("int"), F.lit(1)).cast("string"))
            found = found & (F.getbit(seven, (at % 7).cast("int")) == 1)
        return found

    return among


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``spans``, ``array<struct<start, place, end, kind, share>>`` by start and kind.

    Base kinds have a NULL ``share``; spans of kind ``term`` are all places, in any case, of words that disclose a protected
    value of the corpus, unless they touch a base span. NULL and empty texts have no spans. Rows with equal texts get equal spans and
    count as one text in the statistics, so neither copies nor NULL or repeated keys matter. A column of ``docs`` named
    ``spans`` gets underscores in front.

    Values meet terms only within ``CONTEXT`` characters, so a text gives pairs in proportion to its length. Added spans come
    back by a join on the digest of the text; Spark broadcasts them if their measured size allows it.
    """
    if "spans" in docs.columns:
        docs = docs.withColumnRenamed("spans", own_name("spans", docs.columns))
        text = docs.columns[-1] if text == "spans" else text
    key, base, extra = (own_name(name, docs.columns) for name in ("_key", "_base", "_added"))
    body = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(text_key(body).alias("key"), body.alias("body"))
    telling = cut_lineage(disclosing_terms(texts), "telling-terms")
    among = _among(telling)
    words = with_base_spans(texts, F.col("body"), "spans", "terms", lambda word: among(F.lower(word))).select("key", F.explode_outer("terms").alias("t")).where("t IS NOT NULL")
    places = words.select("key", "t.start", "t.end", F.lower("t.value").alias("term")).distinct()
    one = F.struct("start", F.lit(4).alias("place"), "end", F.lit("term").alias("kind"), "share")
    added = cut_lineage(places.join(telling, "term").groupBy("key").agg(F.collect_list(one).alias(extra)).withColumnRenamed("key", key), "added-spans")
    shaped = F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"), s["kind"].alias("kind"), F.lit(None).cast("double").alias("share")))
    clear = F.filter(extra, lambda t: ~F.exists(base, lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return (
        with_base_spans(docs.withColumn(key, text_key(body)), body, base).join(added, key, "left")
        .withColumn("spans", F.when(F.col(extra).isNull(), shaped).otherwise(F.array_sort(F.concat(shaped, clear))))
        .select(*docs.columns, "spans")
    )


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """``find_personal_data`` with ``clean_text``: values are replaced by their kind, telling terms generalised or removed.

    Overlapping spans are replaced as one, by the kind of the first. A NULL text stays NULL. A column named ``clean_text``
    gets underscores in front.
    """
    if "clean_text" in docs.columns:
        docs = docs.withColumnRenamed("clean_text", own_name("clean_text", docs.columns))
        text = docs.columns[-1] if text == "clean_text" else text
    found = find_personal_data(docs, text)
    body = F.col(text if text != "spans" else "_spans")

    def step(state: Column, span: Column) -> Column:
        label = F.when(span["share"] >= REMOVED, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        inside = span["start"] < state["at"]
        between = F.substring(body, state["at"] + 1, span["start"] - state["at"])
        out = F.when(inside, state["out"]).otherwise(F.concat(state["out"], F.array(between, label)))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate("spans", start, step, lambda state: F.concat(F.array_join(state["out"], ""), F.substring(body, state["at"] + 1, F.length(body))))
    return found.withColumn("clean_text", F.when(F.size("spans") == 0, body).otherwise(clean))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
