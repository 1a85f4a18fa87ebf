"""Conversation repair, exact top-k and importance resampling against brute force, and their odd inputs."""

import hashlib
import heapq
import math
import random
import zlib
from itertools import pairwise

import numpy as np
import pytest

from tubewave.llm import turn_repair
from tubewave.llm.bit_slices import Slices, top_k
from tubewave.llm.queries import repaired_conversations
from tubewave.llm.resampling import gram_buckets, numbered, resample
from tubewave.llm.turn_repair import border_states, edit_log, mark_turns, repair_turns, solve, stretch_matrix, structure

TURN = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}


def cheapest_edits(codes):
    """Dijkstra over (rows done, state) by cost, then edits in ASCII order."""
    heap, best = [(0, "", 0, 0)], {}
    while heap:
        cost, edits, row, state = heapq.heappop(heap)
        if (row, state) in best:
            continue
        best[row, state] = (cost, edits)
        after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        heapq.heappush(heap, (cost + 3, edits + "I", row, after))
        if row == len(codes):
            continue
        code = codes[row]
        extra = 3 if code & turn_repair.SHORT else 0
        heapq.heappush(heap, (cost + 4, edits + "D", row + 1, state))
        if not code & turn_repair.MUST_GO:
            heapq.heappush(heap, (cost + 3 + extra, edits + "R", row + 1, after))
            if (state, code & 3) in TURN:
                heapq.heappush(heap, (cost + extra, edits + "K", row + 1, TURN[state, code & 3]))
    return min(best[len(codes), state] for state in (0, 3) if (len(codes), state) in best)


def random_codes(rng, most):
    wide = [c + f for c in range(4) for f in (0, turn_repair.MUST_GO, turn_repair.SHORT)]
    return bytes(rng.choice(wide) if rng.random() < 0.5 else rng.choice([0, 1, 2]) for _ in range(rng.randint(1, most)))


def test_halves_give_the_cheapest_edits():
    rng = random.Random(1)
    for _ in range(1500):
        codes = random_codes(rng, 14)
        edits, _, cost = solve(codes)
        assert (cost, "".join(edits)) == cheapest_edits(codes)


def test_stretches_give_the_same_edits_as_the_whole():
    rng = random.Random(2)
    for _ in range(500):
        codes = random_codes(rng, 20)
        cuts = sorted({0, len(codes), *(rng.randint(0, len(codes)) for _ in range(3))})
        parts = [codes[a:b] for a, b in pairwise(cuts)]
        states = border_states([stretch_matrix(p) for p in parts])
        edits = "".join("".join(solve(p, states[k], states[k + 1], k == len(parts) - 1)[0]) for k, p in enumerate(parts))
        assert edits == cheapest_edits(codes)[1]


SPACES = " \t\n\x0b\x0c\r"


def repaired_by_hand(rows):
    """Faults, edits and digest of the rows (turn, role, text) of one damaged conversation, in the stated order."""
    def key(r):
        return (r[0] is not None, r[0] or 0), r[1], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()

    rows, seen, codes, faults = sorted(rows, key=key), set(), [], []
    for _, role, text in rows:
        code = {"s": 0, "u": 1, "a": 2}.get(role[:1], 3)
        body = text.rstrip(SPACES)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        codes.append(code + {None: 0, "truncated": turn_repair.SHORT}.get(fault, turn_repair.MUST_GO))
        faults.append(fault)
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit = cheapest_edits(codes) if rows else (0, "")
    lines, state, at = [], 0, 0
    for edit in audit:
        if edit in "IR":
            state = {0: 2, 1: 2, 2: 3, 3: 2}[state]
            lines.append(f"{'user' if state == 2 else 'assistant'}:{rows[at][2] if edit == 'R' else ''}")
        elif edit == "K":
            state = TURN[state, codes[at] & 3]
            lines.append(f"{rows[at][1]}:{rows[at][2]}")
        at += edit != "I"
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairwise(rows))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged_by_hand(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
    text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
    return [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)


@pytest.fixture
def short_stretches(monkeypatch):
    monkeypatch.setattr(turn_repair, "STRETCH", 4)


def test_conversations_equal_repair_by_hand(spark, short_stretches):
    """NULLs in every column, ties, repeated rows, empty texts, a conversation of many stretches, one that is dropped whole."""
    rng = random.Random(5)
    words = ["Yes.", "No", "", " \t", "Why?", None, "Same text here.", "cut off", "é!", "a" * 5000 + "."]
    rows = [(rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0, 1, 2, 3, 4, 9]), rng.choice(["system", "user", "assistant", "tool", "", None]), rng.choice(words)) for _ in range(200)]
    rows += [(77, t, ["user", "assistant"][t % 2], f"turn {t}.") for t in range(150)] + [(77, 5, "user", "again")] * 3
    gone = next(c for c in range(100, 1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Alone."))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for conv, *rest in rows:
        want.setdefault(conv, []).extend(damaged_by_hand(conv, *rest))
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r.conv_id: tuple(r[c] for c in columns) for r in repaired_conversations(df).collect()}
    assert got == {conv: repaired_by_hand(own) for conv, own in want.items()}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_edit_log_and_empty_conversations(spark):
    rows = spark.createDataFrame([("x", 1, "assistant", "Hi.", "extra")], "id string, n int, who string, body string, conv string")
    names = {"conv": "id", "turn": "n", "role": "who", "text": "body"}
    marked = mark_turns(rows, **names)
    log = edit_log(rows, marked, repair_turns(marked), **names).orderBy("place", "step").collect()
    assert [(r.edit, r.was, r.role, r.text) for r in log] == [("I", None, "user", ""), ("K", "assistant", "assistant", "Hi.")]
    none = rows.where("false")
    marked = mark_turns(none, **names)
    assert structure(marked).count() == repair_turns(marked).count() == edit_log(none, marked, repair_turns(marked), **names).count() == 0


def test_bitmaps_select_what_sorting_selects():
    rng = np.random.default_rng(0)
    for _ in range(150):
        n, d, span, k = rng.integers(1, 300), rng.integers(0, 7), rng.integers(1, 40), int(rng.integers(1, 25))
        values, query = rng.integers(-span, span + 1, (n, d)), rng.integers(-span, span + 1, d).tolist()
        found, score = Slices(values).top(query, k)
        full = values @ np.array(query, np.int64) if d else np.zeros(n, np.int64)
        want = np.lexsort((np.arange(n), -full))[:k]
        own = np.lexsort((found, -score))
        assert found[own].tolist() == want.tolist() and score[own].tolist() == full[want].tolist()


@pytest.mark.parametrize("block, chunk", [(32_768, 1_024), (7, 3)])
def test_top_k_of_odd_vectors(spark, block, chunk):
    """Ties, copies, repeated rows, several lengths, NULL ids, unusable vectors; blocks of any size give the same rows."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 4).round(1).tolist()) for i in range(60)] + [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(60, 100)]
    rows += [(100, [1.0, 2.0]), (101, [3.0, -1.0]), (120, []), (121, []), (None, [0.5, 0.5, 0.5, 0.4]), (20, [0.1, 0.1, 0.1, 0.1])]
    good = list(rows)
    rows += [rows[3], (140, None), (160, [float("nan")] * 4), (180, [None, 1.0, 1.0, 1.0]), (200, [float("inf"), 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    whole = {(i, tuple(math.floor(64 * float(np.float32(x))) for x in v)) for i, v in good}
    want = []
    for q, a in whole:
        if q is not None and q % 20 == 0:
            near = [(-sum(x * y for x, y in zip(a, b)), i is None, i or 0) for i, b in whole if i != q and len(a) == len(b)]
            want += [(q, rank, None if none else i, -s) for rank, (s, none, i) in enumerate(sorted(near)[:5], 1)]
    got = top_k(df, df.where("vec_id % 20 = 0"), k=5, block_rows=block, chunk_queries=chunk)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert top_k(df.where("false"), df, k=5).count() == top_k(df, df.where("false"), k=5).count() == 0
    with pytest.raises(ValueError):
        top_k(df.selectExpr("vec_id", "array(1e300D) AS embedding"), df)


def grams_by_hand(text, least, most, buckets):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text or "").split(" ")
    words = [w for w in words if w]
    runs = [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]
    return len(words), sorted(zlib.crc32(r.encode()) % buckets for r in runs)


@pytest.mark.parametrize("most", [1, 2, 3])
def test_overlapped_scan_finds_all_runs(most):
    rng = random.Random(7)
    for text in ["", " ", "One", " a  b ", "x.y-z", "Été DÉJÀ vu", "\u0085a b", *("".join(rng.choices("aB .é7\n", k=rng.randint(0, 40))) for _ in range(300))]:
        words, found = gram_buckets(text.encode(), 1, most, 997)
        assert (words, sorted(found.tolist())) == grams_by_hand(text, 1, most, 997)


def resampled_by_hand(docs, items, percent, least_words, most, buckets):
    own = [(i, *grams_by_hand(t, 1, most, buckets)) for i, t in docs]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for _, _, grams in own:
        np.add.at(s, grams, 1)
    for text in items:
        np.add.at(t, grams_by_hand(text, 1, most, buckets)[1], 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + buckets) / ((s[b] + 1) * (t.sum() + buckets)))) for b in range(buckets)]
    rows = []
    for i, words, grams in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in grams)
        rows.append((i, words, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    long_enough = sorted((r for r in rows if r[1] >= least_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    ranks = {}
    for rank, r in enumerate(long_enough[: percent * len(long_enough) // 100], 1):
        ranks.setdefault(r, []).append(rank)
    return [(*r, own.pop(0) if (own := ranks.get(r)) else None) for r in rows]


@pytest.mark.parametrize("most", [1, 2])
def test_resampling_equals_resampling_by_hand(spark, most):
    """NULL and empty texts, NULL ids, repeated rows, clashing columns, a text of 100,000 words."""
    rng = random.Random(11)
    docs = [(i, " ".join(rng.choices(["red", "Green", "blue", "é", "seven", "odd"], k=rng.randint(0, 12)))) for i in range(150)]
    docs += [(500, None), (501, ""), (None, "red green blue seven"), (7, docs[7][1]), (502, "long word " * 50_000)]
    items = ["seven odd seven", None, "", "red"]
    df = spark.createDataFrame([(i, t, "kept", 5) for i, t in docs], "doc_id long, text string, score string, grams int")
    target = spark.createDataFrame([(t,) for t in items], "text string")
    got = resample(df, target, keep=["doc_id", "score", "grams"], percent=30, least_words=3, most=most, buckets=101)
    assert got.columns == ["doc_id", "_score", "_grams", "n_words", "n_features", "weight", "score", "rank"]
    assert {(r["_score"], r["_grams"]) for r in got.collect()} == {("kept", 5)}
    rows = [tuple(r) for r in got.drop("_score", "_grams").collect()]
    assert sorted(rows, key=repr) == sorted(resampled_by_hand(docs, items, 30, 3, most, 101), key=repr)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = docs.where("false")
    assert resample(none, docs).count() == 0
    row = resample(docs, none, percent=100, least_words=1, buckets=10).first()
    assert (row.n_features, row["rank"]) == (3, 1)


def test_numbers_run_through_all_ranges(spark):
    rows = spark.range(1000).selectExpr("id", "id % 7 AS g").repartition(5)
    from pyspark.sql import functions as F

    got = numbered(rows, [F.desc("g"), F.asc("id")], "n").orderBy("n").collect()
    assert [(r.g, r.id) for r in got] == sorted(((i % 7, i) for i in range(1000)), key=lambda p: (-p[0], p[1]))
    assert [r.n for r in got] == list(range(1, 1001))
