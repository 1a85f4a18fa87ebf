"""Near-duplicate links against all pairs, helper columns that clash, and the stages of the pipeline."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest

from tubewave.llm import decontaminate as decontamination
from tubewave.llm import common, jaccard, tokens
from tubewave.llm.decontaminate import decontaminate
from tubewave.llm.jaccard import similar_documents
from tubewave.llm.sanitise import sanitise
from tubewave.llm.substrings import remove_repeats


def sets_of(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())


def linked(docs, size, share):
    """Size of the set and smallest key reachable by links, by comparing all pairs."""
    own = {key: sets_of(text, size) for key, text in docs}
    parent = {key: key for key in own}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(own), 2):
        if own[a] and own[b] and share[1] * len(own[a] & own[b]) >= share[0] * len(own[a] | own[b]):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {key: (len(own[key]), find(key)) for key in own}


@pytest.mark.parametrize("trees, size, share", [(3, 3, (90, 100)), (3, 5, (80, 100)), (500, 3, (50, 100))])
def test_links_equal_all_pairs(spark, monkeypatch, trees, size, share):
    """Copies, chains of near copies and common words; clusters of many small trees and of one."""
    monkeypatch.setattr(jaccard, "TREE_SETS", trees)
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(40)]
    docs, key = [(0, None), (1, ""), (2, "One"), (3, "one"), (4, "one two")], 10
    for _ in range(8):
        words = rng.choices(vocabulary, k=rng.randint(4, 60))
        for _ in range(rng.randint(1, 9)):  # each a little further from the first
            words = [rng.choice(vocabulary) if rng.random() < 0.03 else w for w in words]
            docs.append((key, " ".join(words)))
            key += 1
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_documents(df, size=size, share=share).collect()}
    assert got == linked(docs, size, share)


@pytest.mark.parametrize("size, share", [(5, (80, 100)), (3, (90, 100))])
def test_common_passages_link_nothing(spark, monkeypatch, size, share):
    """Only texts that may be similar travel to trees, not all that have a passage in common."""
    rng = random.Random(3)
    passage = " ".join(f"common{k}" for k in range(12))
    docs = [(k, " ".join(f"v{rng.randrange(10**6)}" for _ in range(rng.randint(25, 40))) + " " + passage) for k in range(300)]
    docs += [(300, docs[7][1] + " tail"), (301, docs[7][1])]
    sent = []
    links = jaccard._tree_links
    monkeypatch.setattr(jaccard, "_tree_links", lambda bodies, *rest: sent.append(bodies.count()) or links(bodies, *rest))
    got = {r.doc_id: r.component_id for r in similar_documents(spark.createDataFrame(docs, "doc_id long, text string"), size=size, share=share).collect()}
    assert got == {k: 7 if k >= 300 else k for k in range(302)}
    assert sent == [2]


def test_counted_shingles_come_back_as_they_were():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)) for n in (1, 5, 700)]
    sets += [sets[2][:300], np.array([0, (1 << 64) - 1], np.uint64)]
    back = [(e, n) for at, blob in jaccard.counted_blobs(np.arange(len(sets)), sets, 8) for e, n in zip(*map(np.ndarray.tolist, jaccard.read_blob(blob))) if e >> 32 == at]
    assert sorted(back) == sorted((int(e) >> 24, k) for k, own in enumerate(sets) for e in own)


@pytest.mark.parametrize("share", [(90, 100), (80, 100)])
def test_heads_come_from_packed_blobs(share):
    """What slices have more than once comes back packed, one blob a base, and gives the heads that a plain count gives."""
    rng = np.random.default_rng(5)
    pool = np.unique(rng.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2))
    bases = [[np.sort(rng.choice(pool, rng.integers(1, 90), replace=False)) for _ in range(30)] for _ in range(3)]
    bases[2] += [np.array([k], np.uint64) for k in (1 << 40, 1 << 50)]  # met once
    sliced = defaultdict(list)
    for base, sets in enumerate(bases):
        for at, blob in jaccard.counted_blobs(np.arange(len(sets)), sets, 4):
            sliced[at].append((base, *jaccard.read_blob(blob)))
    back = defaultdict(list)
    for told in sliced.values():
        named = np.concatenate([np.full(len(e), base) for base, e, _ in told])
        found = jaccard.repeated_blobs(named, *(np.concatenate([one[k] for one in told]) for k in (1, 2)))
        assert len({base for base, _ in found}) == len(found)
        for base, blob in found:
            back[base].append(blob)
    cut = [[[int(e) >> 24 for e in own] for own in sets] for sets in bases]
    times = Counter(e for sets in cut for own in sets for e in own)
    for base, sets in enumerate(cut):
        wanted = set()
        for k, own in enumerate(sets):
            head = sorted(own, key=lambda e: (times[e], e))[: len(own) + 1 - -(-share[0] * len(own) // share[1])]
            wanted |= {(k, e) for e in head if times[e] > 1}
        of, tokens = jaccard.head_elements(np.array([len(own) for own in sets]), back[base], share)
        assert set(zip(of.tolist(), tokens.tolist())) == wanted and len(of) == len(wanted)


def test_workers_forget_what_other_operators_keep():
    """A worker serves all stages of the pipeline in turn: the words of packing must not stay while sets are compared."""
    path = public_tokenizers.path("word_bpe_49k.json")
    common.begin("tokens")
    tokens.encoder(path, "dropped").encode([b"some words"])
    jaccard.shingles(b"some other words", 2)
    common.begin("tokens")
    assert tokens.encoder.cache_info().currsize == 1 and not jaccard._digests
    jaccard.shingles(b"some other words", 2)
    common.begin("jaccard")
    assert tokens.encoder.cache_info().currsize == 0 and jaccard._digests


def test_helper_columns_may_clash(spark, monkeypatch):
    text = "Mail Qorvexa at qorvexa@example.org about " + " ".join(f"word{k}" for k in range(60))
    rows = [(1, text, 1, 2, 3, 4, 5, 6), (2, text, 1, 2, 3, 4, 5, 6)]
    for names in (["of", "first", "gone", "_copy", "_of", "_row"], ["_added", "_base", "_key", "spans", "key", "clean_text"], ["_ranges", "_items", "_body", "items", "digest", "size"]):
        df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in names))
        kept = remove_repeats(df).collect()
        assert sorted((r.doc_id, r.n_removed) for r in kept) == [(1, 0), (2, len(text.split()))]
        assert "qorvexa@" not in sanitise(df).where("doc_id = 1").first()["clean_text"]
        items = spark.createDataFrame([(7, " ".join(f"word{k}" for k in range(20)))], "item_id long, text string")
        for most in (200_000, 1):
            monkeypatch.setattr(decontamination, "AUTOMATON_WORDS", most)
            assert {r.n_hit for r in decontaminate(df, items).collect()} == {20}


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Documents with NULLs, copies, near copies, a benchmark passage, personal data, toxic texts and columns of clashing names."""
    rng = random.Random(3)
    words = [f"word{k}" for k in range(300)]
    clean = [" ".join(rng.choices(words, k=40)) for _ in range(60)]
    bad = [f"{' '.join(rng.choices(words, k=12))} vilest scumbag {' '.join(rng.choices(words, k=3))}" for _ in range(30)]
    item = " ".join(f"exam{k}" for k in range(15))
    docs = [(k, t) for k, t in enumerate(clean)] + [(100 + k, t) for k, t in enumerate(bad)]
    docs += [(200, clean[0]), (201, clean[1] + " more"), (202, f"Before it {item} after it"), (203, item), (204, None), (205, ""), (206, "Write to ann@example.org today")]
    folder = str(tmp_path_factory.mktemp("corpus"))
    columns = "doc_id long, text string, lang string, source string, n_chars long, row int, spans string"
    df = spark.createDataFrame([(k, t, "en", "web", len(t) if t else None, k, "kept") for k, t in docs], columns)
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k >= 100)) for k in [*range(60), *range(100, 130)]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, spark.read.parquet(f"{folder}/documents.parquet")


def test_stages_take_effect_and_keep_the_rest(spark, corpus):
    folder, docs = corpus
    stages = dict(corpus_pipeline.STAGES)
    clean_ids = {*range(60), *range(200, 207)}

    def run(name):
        out = stages[name](spark, docs, folder)
        assert out.columns == docs.columns
        return {r.doc_id: r for r in out.collect()}

    calm = set(run("toxicity"))
    assert clean_ids <= calm and len(calm & set(range(100, 130))) <= 3
    single = run("ngram_jaccard")
    assert {0, 1, 204, 205} <= set(single) and not {200, 201} & set(single)
    free = run("benchmark_decontamination")
    assert free[202].text == "Before it  after it" and free[202].n_chars == len(free[202].text) and 203 not in free and free[5] == docs.where("doc_id = 5").first()
    private = run("pii")
    assert "[EMAIL]" in private[206].text and private[206].spans == "kept" and set(private) == {r.doc_id for r in docs.collect()}
    pieces = stages["packing"](spark, docs, folder)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_stages_take_an_empty_table(spark, corpus):
    folder, docs = corpus
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0, name
