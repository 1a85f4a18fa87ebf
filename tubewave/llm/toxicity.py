"""Toxicity scores from a weighted lexicon, matched by an Aho-Corasick automaton over folded text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, own_name, slices, texts_of, with_schema

#: Most labelled rows that weights are learned from.
TRAINING_ROWS = 20_000
#: Most terms of a learned lexicon; the strongest stay.
MOST_TERMS = 20_000
#: Distinct labelled texts a term must occur in, least weight (log ratio of rates), letters of a word beginning.
LEAST_TEXTS, LEAST_WEIGHT, BEGINNINGS = 5, 1.5, range(4, 9)
#: Harmless phrases around lexicon words.
EXCEPTIONS = ("trash can", "trash bag", "clown fish", "idiot proof", "pathetic fallacy", "moron river")

# Letters of other scripts that look like Latin ones, and digits and signs written in their place. l and i
# are one letter after folding, because 1 stands for either.
_ALIKE = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "l": "i",
}
_FOLD: dict[int, str | None] = {ord(k): v for k, v in _ALIKE.items()}
_FOLD |= {0xFF41 + k: chr(97 + k).translate({108: "i"}) for k in range(26)}  # full-width letters
_FOLD |= dict.fromkeys((0x00AD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))  # invisible signs
_WORD = re.compile(r"[^\W_]+")


def fold(text: str) -> list[str]:
    """Words of a text in lower case, with look-alike letters, digits and signs replaced."""
    return _WORD.findall(text.lower().translate(_FOLD))


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, as the automaton matches them: words are written between two spaces each."""
    return [f" {word} ", *(f" {word[:n]}" for n in BEGINNINGS if n <= len(word))]


@dataclass
class Lexicon:
    """Weights of terms, phrases that count nothing, and the logistic curve from weights and length to a score."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.0)

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.weights.items():
            found.add_word(term, weight)
        for phrase in self.exceptions:
            found.add_word(f" {'  '.join(fold(phrase))} ", 0.0)
        if len(found):
            found.make_automaton()
        return found


def features(text: str, automaton) -> tuple[float, int, int]:
    """Sum of the weights of the longest terms from left to right, their number, number of words."""
    words = fold(text)
    if not words or not len(automaton):
        return 0.0, 0, len(words)
    hits = [w for _, w in automaton.iter_long(f" {'  '.join(words)} ") if w]
    return sum(hits), len(hits), len(words)


def _inputs(total: np.ndarray, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
    length = np.maximum(words, 1)
    return np.column_stack([np.ones(len(total)), np.log1p(100 * total / length), np.log1p(total), np.log1p(hits) - np.log1p(length)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with ``score`` (0 to 1), ``n_hits`` and ``n_terms_words`` (words of the folded text).

    NULL and empty texts score like a text without hits. Each row is scored on its own, without a shuffle; columns with one
    of the new names get underscores in front.
    """
    new = ["score", "n_hits", "n_terms_words"]
    for name in new:
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, own_name(name, [*docs.columns, *new]))
            text = own_name(name, docs.columns) if text == name else text
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # at most MOST_TERMS short terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        automaton, curve = shared.value.automaton(), np.array(shared.value.curve)
        for batch in slices(batches, text):
            found = np.array([features(body.decode(), automaton) for body in texts_of(batch, text)], dtype=float).reshape(-1, 3)
            score = _sigmoid(_inputs(*found.T) @ curve)
            own = [pa.array(score), pa.array(found[:, 1].astype(np.int64)), pa.array(found[:, 2].astype(np.int64))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *own], [*batch.schema.names, *new])

    return docs.mapInArrow(run, with_schema(docs, "score double, n_hits long, n_terms_words long"))


def training_rows(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """``text, toxic`` of at most ``rows`` labelled rows, those with the smallest hashes of their key; of several labels of a
    key the largest counts, and of texts that open with the same 60 characters one row stays."""
    chosen = labels.where(f"`{label}` IS NOT NULL AND `{key}` IS NOT NULL").groupBy(key).agg(F.max(label).cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64(key), key).limit(rows)
    found = docs.select(key, text).join(F.broadcast(chosen), key).where(f"`{text}` IS NOT NULL")  # `rows` rows at most
    opening = found.groupBy(F.substring(text, 1, 60)).agg(F.min_by(F.struct(F.col(text).alias("text"), "toxic"), F.struct(key, text)).alias("one"))
    return opening.select("one.text", "one.toxic")


def fit_lexicon(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", rows: int = TRAINING_ROWS) -> Lexicon:
    """A lexicon learned from labelled rows; without toxic and clean rows an empty one.

    Terms are words and beginnings of words. Their weight is the log ratio of the mean rates (occurrences a word of a text)
    in toxic and clean texts. Rates are summed in tasks and added up by term; the driver gets the selected terms, at most
    ``MOST_TERMS``, and three numbers for each of the at most ``rows`` training rows, to which the curve is fitted.
    """
    sample = training_rows(docs, labels, key, text, label, rows)
    from ..session import cut_lineage

    sample = cut_lineage(sample, "labelled")
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Lexicon()

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin("toxicity")
        for frame in frames:
            sums: dict[str, list[float]] = {}
            for body, toxic in zip(frame["text"], frame["toxic"], strict=True):
                for term, rate in _rates(fold(body)).items():
                    own = sums.setdefault(term, [0.0, 0.0, 0])
                    own[toxic] += rate
                    own[2] += toxic
            yield pd.DataFrame([(t, *v) for t, v in sums.items()], columns=["term", "clean", "toxic", "texts"])

    least = 2e-4
    weight = F.log((F.col("toxic") / sizes[1] + least) / (F.col("clean") / sizes[0] + least))
    counted = sample.mapInPandas(count, "term string, clean double, toxic double, texts long").groupBy("term").agg(*(F.sum(c).alias(c) for c in ("clean", "toxic", "texts")))
    strong = counted.where(F.col("texts") >= LEAST_TEXTS).withColumn("weight", F.round(weight, 4)).where(F.col("weight") >= LEAST_WEIGHT)
    chosen = strong.orderBy(F.desc(F.col("weight") * F.log1p("texts")), "term").limit(MOST_TERMS).collect()
    lexicon = Lexicon({r.term: r.weight for r in chosen})
    automaton = sample.sparkSession.sparkContext.broadcast(lexicon)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = automaton.value.automaton()
        for frame in frames:
            found = [features(body, terms) for body in frame["text"]]
            yield pd.DataFrame(found, columns=["total", "hits", "words"]).assign(toxic=frame["toxic"].to_numpy())

    known = sample.mapInPandas(measure, "total double, hits long, words long, toxic int").toPandas()
    return Lexicon(lexicon.weights, lexicon.exceptions, _fit_curve(_inputs(*(known[c].to_numpy(float) for c in ("total", "hits", "words"))), known["toxic"].to_numpy(float)))


def _rates(words: list[str]) -> dict[str, float]:
    rates: dict[str, float] = {}
    for word in words:
        for term in terms_of(word):
            rates[term] = rates.get(term, 0) + 1
    return {term: n / len(words) for term, n in rates.items()}


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps."""
    order = np.lexsort((*x.T, y))  # the same sums whatever the order of the rows
    x, y, beta = x[order], y[order], np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ beta)
        gradient = x.T @ (y - p) - ridge * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), gradient)
        beta += step
        if math.sqrt(float(step @ step)) < 1e-8:
            break
    return tuple(float(b) for b in beta)


def is_toxic(score: float, threshold: float = 0.3) -> bool:
    return score >= threshold


def hits_of(text: str, lexicon: Lexicon) -> Iterable[tuple[int, float]]:
    """Ends (in the folded, spaced text) and weights of the matched terms, for looking into single texts."""
    automaton = lexicon.automaton()
    return [(end, w) for end, w in automaton.iter_long(f" {'  '.join(fold(text))} ") if w] if len(automaton) else []
