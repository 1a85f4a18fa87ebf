"""Benchmark decontamination with a suffix automaton over the words of all test items."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import begin, keeps, own_name, sha256_hex, slices, texts_of, with_schema

#: Words of a window; an item with fewer words is one window.
WINDOW = 10
#: Most words of all items together for which one automaton is broadcast (about 0.5 kB a word in a task).
AUTOMATON_WORDS = 200_000

# A word is a run of bytes other than ASCII signs and controls: A-Z count as a-z, letters beyond ASCII stay as they are.
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """Generalised suffix automaton: every path from the root spells a run of words of some item."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        items = [(name, [self.ids.setdefault(w, len(self.ids) + 1) for w in words]) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        #: Items that have the window (of full length) that ends in this state.
        self.windows: dict[int, set[str]] = {}
        #: Items shorter than a window that end in this state, with their length.
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            if len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                self.short.setdefault(state, []).append((len(words), name))
                continue
            for state, length in self._walk(words):
                if length >= window:
                    self.windows.setdefault(self._of_window(state), set()).add(name)
        self.fewest = min([window, *(n for own in self.short.values() for n, _ in own)])
        # the nearest state on the way to the root, itself included, in which a short item ends
        self.near_short = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.near_short[state] = state if state in self.short else self.near_short[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        old = nxt[last].get(word)
        if old is not None:
            if length[old] == length[last] + 1:
                return old
            return self._split(last, word, old)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        while last >= 0 and word not in nxt[last]:
            nxt[last][word] = new
            last = link[last]
        if last >= 0:
            old = nxt[last][word]
            link[new] = old if length[old] == length[last] + 1 else self._split(last, word, old)
        return new

    def _split(self, last: int, word: int, old: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[old]))
        length.append(length[last] + 1)
        link.append(link[old])
        link[old] = copy
        while last >= 0 and nxt[last].get(word) == old:
            nxt[last][word] = copy
            last = link[last]
        return copy

    def _walk(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """State and length of the longest run of words that ends here and occurs in an item."""
        nxt, link, length = self.next, self.link, self.length
        state = size = 0
        for word in words:
            while state and word not in nxt[state]:
                state = link[state]
                size = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                size += 1
            yield state, size

    def _of_window(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def matches(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and the items whose windows occur."""
        get = self.ids.get
        known = np.array([get(w, 0) for w in words], dtype=np.int64)
        hit = np.zeros(len(words), dtype=bool)
        found: set[str] = set()
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known > 0, [0]))))
        for start, stop in edges.reshape(-1, 2):
            if stop - start < self.fewest:
                continue
            for at, (state, size) in enumerate(self._walk(known[start:stop].tolist()), start):
                if size >= self.window:
                    hit[at + 1 - size : at + 1] = True
                    found |= self.windows[self._of_window(state)]
                state = self.near_short[state]
                while state > 0:
                    for n, name in self.short[state]:
                        if n <= size:
                            hit[at + 1 - n : at + 1] = True
                            found.add(name)
                    state = self.near_short[self.link[state]]
        return hit, found


@lru_cache(maxsize=2)
def _automaton(items: tuple[tuple[str, bytes], ...], window: int) -> Automaton:
    return Automaton([(name, words_of(text)) for name, text in items], window)


keeps("decontaminate", _automaton.cache_clear)


def without_words(text: bytes, hit: np.ndarray) -> str:
    """The text without the words that were hit and what stands between two of them; a line break or space stays at the seam."""
    kept, at = [], 0
    spans = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit, [0])).astype(np.int8)))
    for first, stop in edges.reshape(-1, 2):
        kept.append(text[at : spans[first][0]])
        at = spans[stop - 1][1]
    kept.append(text[at:])
    return b"".join(kept).decode()


ADDED = "n_words long, n_hit long, n_items long, items_sha256 string, items array<string>, clean_text string"


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, clean: bool = True) -> DataFrame:
    """All rows of ``docs`` with ``n_words, n_hit, n_items, items_sha256, items, clean_text``.

    A word is hit if it lies in an occurrence of ``window`` consecutive words of an item, or of a whole item of fewer
    words. ``items`` are the distinct ids (as texts, sorted) of items with an occurring window. ``clean_text`` lacks the hit
    words (NULL if ``clean`` is off or nothing was hit). A NULL or empty text has no words; a NULL item id is the empty text;
    an item without words has no window; an empty benchmark hits nothing. Repeated rows are treated alike, and columns of
    ``docs`` with one of the new names get underscores in front.

    The words of all items are counted first. Up to ``AUTOMATON_WORDS`` one automaton goes to every task and documents are
    streamed through it without a shuffle. A larger benchmark is dealt into automata of that size, and the windows of the
    documents find their automaton by an equality join on window digests (``_by_digest``).
    """
    new = [part.split()[0] for part in ADDED.split(", ")]
    for name in new:
        if name in docs.columns:
            docs = docs.withColumnRenamed(name, own_name(name, [*docs.columns, *new]))
            text = own_name(name, docs.columns) if text == name else text
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("body")).where("body IS NOT NULL")
    if _count_words(items) > AUTOMATON_WORDS:
        return _by_digest(docs, items, text, window, clean)
    rows = spark.sparkContext.broadcast(tuple(sorted({(r.item, r.body.encode()) for r in items.collect()})))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("decontaminate")
        automaton = _automaton(rows.value, window)
        for batch in slices(batches, text):
            out = []
            for body in texts_of(batch, text):
                words = words_of(body)
                hit, found = automaton.matches(words)
                out.append(_row(body, len(words), hit, found, clean))
            yield _append(batch, out)

    return docs.mapInArrow(run, with_schema(docs, ADDED))


def _row(body: bytes, n_words: int, hit: np.ndarray, found: Iterable[str], clean: bool) -> tuple:
    names = sorted(found)
    n_hit = int(hit.sum())
    return n_words, n_hit, len(names), sha256_hex(",".join(names)), names, without_words(body, hit) if clean and n_hit else None


def _append(batch: pa.RecordBatch, rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.string()]
    columns = [pa.array([row[k] for row in rows], kind) for k, kind in enumerate(kinds)]
    names = [part.split()[0] for part in ADDED.split(", ")]
    return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *names])


def _count_words(items: DataFrame) -> int:
    """An upper bound of the words: half the bytes, words being split by one sign at least."""
    return items.agg(F.coalesce(F.sum(F.expr("octet_length(body) DIV 2 + 1")), F.lit(0))).first()[0]


def window_digests(words: list[bytes], sizes: Iterable[int]) -> list[tuple[int, int, int]]:
    """Signed 64-bit digest, start and length of every run of words of the given lengths."""
    runs = [(n, s) for n in sizes for s in range(len(words) - n + 1)]
    return [(xxhash.xxh3_64_intdigest(b" ".join(words[s : s + n]), n) - (1 << 63), s, n) for n, s in runs]


def _by_digest(docs: DataFrame, items: DataFrame, text: str, window: int, clean: bool) -> DataFrame:
    """The same result for a benchmark of any size: windows of documents and items meet by digest, in shuffled joins."""
    from ..session import cut_lineage

    digests = "body binary, digest long, start int, size int"

    def windows(column: str, extra: str | None, sizes: list[int] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, column, 1 << 18):
                names = batch.column(extra).to_pylist() if extra else [None] * batch.num_rows
                rows = []
                for body, name in zip(texts_of(batch, column), names, strict=True):
                    words = words_of(body)
                    wanted = sizes if sizes is not None else [min(window, len(words))] if words else []
                    key = name.encode() if extra else xxhash.xxh3_128_digest(body)
                    rows += [(key, *w) for w in window_digests(words, wanted)]
                kinds = [("body", pa.binary()), ("digest", pa.int64()), ("start", pa.int32()), ("size", pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], [n for n, _ in kinds])

        return run

    known = cut_lineage(items.mapInArrow(windows("body", "item", None), digests).select(F.col("body").cast("string").alias("item"), "digest", "size").distinct(), "item-windows")
    sizes = [r.size for r in known.select("size").distinct().collect()]  # at most `window` numbers
    found = docs.select(text).distinct().mapInArrow(windows(text, None, sizes), digests).join(known, ["digest", "size"])
    key, places, named = (own_name(name, docs.columns) for name in ("_body", "_ranges", "_items"))
    ranges = found.groupBy("body").agg(F.collect_set(F.struct("start", "size")).alias(places), F.collect_set("item").alias(named))
    body_key = F.pandas_udf(lambda s: s.map(lambda t: xxhash.xxh3_128_digest((t or "").encode())), "binary")
    columns = docs.columns
    joined = docs.withColumn(key, body_key(F.col(text))).join(ranges.withColumnRenamed("body", key), key, "left").drop(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            rows = []
            for body, ranges, names in zip(texts_of(batch, text), batch.column(places).to_pylist(), batch.column(named).to_pylist(), strict=True):
                n = len(words_of(body))
                hit = np.zeros(n, dtype=bool)
                for r in ranges or []:
                    hit[r["start"] : r["start"] + r["size"]] = True
                rows.append(_row(body, n, hit, names or [], clean))
            yield _append(batch.select(columns), rows)

    return joined.mapInArrow(run, with_schema(docs, ADDED))
