"""What runs inside tasks, against brute force: automaton, tree, coder, page scan, windows, tokens."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tubewave.llm.components import union_find
from tubewave.llm.decontaminate import Automaton, without_words, words_of
from tubewave.llm.html_text import DEFAULT_WEIGHTS, main_text
from tubewave.llm.jaccard import PrefixTree, class_parts, least_overlap, shingles, signatures, size_class
from tubewave.llm.packing import Windows
from tubewave.llm.substrings import minimisers
from tubewave.llm.token_coder import decode_blocks, encode_blocks
from tubewave.llm.tokens import REMEMBERED_PIECES, REMEMBERED_WORDS, Encoder, encoder
from tubewave.llm.toxicity import Lexicon, features, fold
from tubewave.llm.vectors import Rotation, unit


def brute_matches(words, items, window):
    hit, found = [False] * len(words), set()
    for name, item in items:
        n = min(window, len(item))
        for s in range(len(item) - n + 1 if n else 0):
            for at in range(len(words) - n + 1):
                if words[at : at + n] == item[s : s + n]:
                    found.add(name)
                    hit[at : at + n] = [True] * n
    return hit, found


def test_automaton_finds_what_comparison_finds():
    rng = random.Random(3)
    for _ in range(300):
        letters = [b"a", b"b", b"c"][: rng.randint(1, 3)]
        items = [(str(k), rng.choices(letters, k=rng.randint(0, 9))) for k in range(rng.randint(0, 4))]
        words = rng.choices([*letters, b"x"], k=rng.randint(0, 40))
        hit, found = Automaton(items, 4).matches(words)
        assert (hit.tolist(), found) == brute_matches(words, items, 4)


def test_removed_words_leave_the_rest():
    text = "Eins zwei, drei (vier) fünf!".encode()
    assert words_of(text) == [b"eins", b"zwei", b"drei", b"vier", "fünf".encode()]
    assert without_words(text, np.array([False, True, True, False, False])) == "Eins  (vier) fünf!"


@pytest.mark.parametrize("share", [(90, 100), (80, 100), (50, 100)])
def test_tree_joins_what_all_pairs_join(share):
    rng = np.random.default_rng(5)
    for _ in range(40):
        base = rng.choice(200, 30, replace=False)
        sets = []
        for _ in range(rng.integers(2, 25)):
            own = base.copy() if rng.random() < 0.7 else rng.choice(200, rng.integers(1, 40), replace=False)
            own[: rng.integers(0, 6)] = rng.integers(200, 260)
            sets.append(np.unique(own).astype(np.uint64))
        find, unite = union_find(len(sets))
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                both = len(np.intersect1d(a, b))
                if share[1] * both >= share[0] * (len(a) + len(b) - both):
                    unite(i, j)
                    assert both >= least_overlap(len(a), len(b), share)
        own_find, own_unite = union_find(len(sets))
        for i, j in PrefixTree(sets).links(share, list(range(len(sets)))):
            own_unite(i, j)
        assert [own_find(i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]


def test_shingles_of_short_and_spaced_texts():
    assert len(shingles(b"", 3)[1]) == len(shingles(b" \t\n", 3)[1]) == 0
    assert len(shingles(b"a", 3)[1]) == len(shingles(b"a b", 3)[1]) == len(shingles(b"a b c", 3)[1]) == 1
    assert shingles(b"A  b\x0bC", 3)[0] == shingles(b"a b c", 3)[0]
    assert shingles("a b".encode(), 3)[0] != shingles(b"a b", 3)[0]
    assert len(shingles(b"x x x x x x", 3)[1]) == 1


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 65535), max_size=600), st.integers(1, 200))
def test_coder_round_trip(ids, block):
    assert decode_blocks(encode_blocks(np.array(ids, np.uint32), block)).tolist() == ids


def test_coder_blocks_are_independent_and_checked():
    ids = np.arange(5000) * 7 % 300
    whole, alone = encode_blocks(ids, 1000), encode_blocks(ids[2000:3000], 1000)
    assert alone in whole and len(whole) < 2 * len(ids)
    damaged = bytearray(whole)
    damaged[len(whole) // 2] ^= 5
    with pytest.raises(ValueError):
        decode_blocks(bytes(damaged))
    with pytest.raises(ValueError):
        encode_blocks(np.array([70000]))


TEXTS = ["", " ", "a  b\n\n c  \n", "x y z  q", "don't it's\tthe\nx", "é a <|endoftext|> b", "a\n b c\x1cd\x0bf", "İ ΣΑΣ 12 3,4...", "a\0b c", "w" * 500 + " w"]


@pytest.mark.parametrize("name,spaces", [("word_bpe_49k.json", "dropped"), ("byte_bpe_50k.json", "kept")])
def test_word_by_word_ids_are_those_of_the_whole(name, spaces):
    texts = [t.encode() for t in TEXTS]
    path = public_tokenizers.path(name)
    assert encoder(path, spaces).encode(texts) == encoder(path, "whole").encode(texts) == encoder(path, spaces).encode(texts)


def test_windows_keep_every_id_once():
    rng = random.Random(1)
    for most in (1, 3):
        windows, docs = Windows(64, most), [bytes(rng.randbytes(4 * rng.choice([1, 5, 63, 64, 65, 200]))) for _ in range(60)]
        for k, ids in enumerate(docs):
            windows.add(k, 0, ids, len(ids) // 4)
            assert len(windows.open) <= most
        windows.close()
        pieces = [p for own in windows.take() for p in own if sum(len(q[2]) for q in own) // 4 in (1, 2, 4, 8, 16, 32, 64)]
        for k, ids in enumerate(docs):
            assert b"".join(p[2] for p in sorted((p for p in pieces if p[0] == k), key=lambda p: p[1])) == ids


def test_minimisers_cover_every_window_and_travel_with_it():
    rng = random.Random(2)
    words = [rng.choice([b"a", b"b", b"cc", b"d"]) for _ in range(300)]
    low, first, n = minimisers(words, 20, 4)
    assert first.tolist() == np.cumsum([0, *n[:-1]]).tolist() and n.sum() == 281
    of = np.repeat(low, n)
    shifted = minimisers(words[37:], 20, 4)
    assert np.repeat(shifted[0], shifted[2]).tolist() == of[37:].tolist()
    assert len(minimisers(words[:19], 20, 4)[0]) == 0 and len(minimisers(words[:20], 20, 4)[0]) == 1


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("plain &lt; words", "plain < words"),
        ("<nav>a b c d</nav><article><h1>T&amp;i</h1><p>one <b>two\n three</b><br>four<p>five</article><footer>x y z</footer>", "T&i\n\none two three four\n\nfive"),
        ("<article><p>one two</p><script>var a='</p>'</script><form>f f</form><aside>s</aside><div class='ad'>buy</div><p>end</article><div id=comments><p>nice</div>", "one two\n\nend"),
        ("<nav>never closed<article><p>text here</p></article>", "text here"),
        ("<article><header><h1>Title</h1><p>by line</p></header><p>word</p></article>", "Title\n\nword"),
        ("<body><div class=cookie-notice>we use cookies</div><p>first words of it</p><p>and more words</p><div class=sidebar>other</div>", "first words of it\n\nand more words"),
        ("<style>p{}</style><!-- c --><p>cut off &am", "cut off &am"),
    ],
)
def test_main_text(page, text):
    assert main_text(page, DEFAULT_WEIGHTS) == text


@pytest.mark.parametrize(
    "page,text",
    [
        ('<article><p>one</p><svg class="i"/><p>two three</p></article>', "one\n\ntwo three"),
        ("<article><p>one</p><math/><iframe src='x'/><canvas/><p>two</p><p>x is <math><mi>y</mi></math></p></article>", "one\n\ntwo\n\nx is y"),
        ("<article><p>one</p><button>b<p>two</p></article>", "one\n\nb\n\ntwo"),
        ("<article><p>one</p><div><select><option>b</div><p>two</p><select><option>c</select><p>three</article>", "one\n\ntwo\n\nthree"),
        ("<article><p>one</p><button-row><p>two</p></button-row><video-player></video-player><p>three</p></article>", "one\n\ntwo\n\nthree"),
        ("<article><p>one</p><svg><title>t</title><text>s</text></svg><noscript>n</noscript><button>b</button><template>t<template>u</template>v</template><p>two</p></article>", "one\n\ntwo"),
        ("<article><!--><p>one</p><script src='a'/><p>two</p><script>x<y</script ><style-x>three</style-x></article>", "one\n\ntwo\n\nthree"),
    ],
)
def test_elements_end_where_they_end(page, text):
    assert main_text(page, DEFAULT_WEIGHTS) == text


def test_folding_and_longest_terms():
    assert fold("1D10T, сlown Ｌoser b­ad") == fold("idiot clown loser bad")
    terms = Lexicon({" idiot": 1.0, " idiot ": 2.0, " bad ": 0.5}).automaton()
    assert features("Idiot idiots BAD badly", terms) == (3.5, 3, 4)
    assert features("idiot proof and trash can", Lexicon({" idiot ": 2.0, " trash ": 1.0}).automaton()) == (0, 0, 5)
    assert features("", terms) == (0.0, 0, 0) and features("x", Lexicon(exceptions=()).automaton()) == (0.0, 0, 1)


def test_rotation_keeps_distances_and_units():
    x = np.random.default_rng(0).normal(size=(50, 20))
    turned = np.concatenate(Rotation(x).blocks(x), axis=1)
    assert np.allclose(turned @ turned.T, x @ x.T)
    assert unit([0.0, 0.0]) is None and unit([None, 1.0]) is None and unit([float("inf")]) is None and unit(None) is None and unit([]) is None
    assert np.allclose(unit([1e300, 1e300]), [2**-0.5] * 2)


def test_checksums_are_of_little_endian_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    assert zlib.crc32(encoder(path, "dropped").encode([b"one"])[0]) == zlib.crc32(np.array(encoder(path, "whole").tokenizer.encode("one", add_special_tokens=False).ids, "<u4").tobytes())
    assert re.fullmatch(rb"(....)*", encoder(path, "dropped").encode([b"one two"])[0], re.S)


ODD_TEXTS = [
    "It's THEY'll don't 'S ,'s x'", "12 3a4 a1b2 3.14", "stra\u00dfe \u00dcBER \u00ff\u0178 2\u00d73\u00f74 \u00aa\u00ba\u00b5", "e\u0301t\u00e9 \u00e9 \u0301x cafe\u0301s", "\u03a3\u03a3 \u03c2 \u0130I\u0131 \ufb01n \u017f",
    "a\xa0b\x85c\u2028d\u3000e f\x1cg \x00h\x01 \x7f", "\u2018it\u2019s\u2019 \u2014\u2026", "\u6f22\u5b57 \u3042a \U0001f642ok", "<|endoftext|> x<|startoftext|>", "\t\r\n\x0b\x0c ", "", "ab" * 500 + "!" * 500 + "\u2014",
]


def test_cut_pieces_are_those_of_the_tokenizer():
    own = Encoder(public_tokenizers.path("word_bpe_49k.json"), "dropped")
    rng = random.Random(7)
    texts = [*ODD_TEXTS, *("".join(rng.choice("".join(ODD_TEXTS[:-1])) for _ in range(rng.randint(1, 30))) for _ in range(3000))]
    wanted = [np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes() for text in texts]
    for _ in range(2):  # new, then remembered
        assert own.encode([text.encode() for text in texts]) == wanted


def test_words_of_known_pieces_are_not_encoded_again():
    own = Encoder(public_tokenizers.path("word_bpe_49k.json"), "dropped")
    words = [before + form(word) + after for word in ("one", "two", "\u00e9t\u00e9") for form in (str.lower, str.title, str.upper) for before in ("", '"', "(") for after in ("", ",", ".", "'s", "?!")]
    own.encode([" ".join(words).encode()])
    assert len(words) == 135 and len(own.known) == 9  # three words, quote, bracket and four endings


def test_pieces_take_less_memory_than_words():
    """What packing remembers adds to the memory of an executor that ran all other stages before."""
    own = Encoder(public_tokenizers.path("word_bpe_49k.json"), "dropped")
    assert own.most == REMEMBERED_PIECES <= REMEMBERED_WORDS // 2 and Encoder(public_tokenizers.path("byte_bpe_50k.json"), "kept").most == REMEMBERED_WORDS
    own.most = 50
    for k in range(0, 600, 30):
        text = " ".join(f"w{'abcdefghij'[n // 100]}{'abcdefghij'[n // 10 % 10]}{'abcdefghij'[n % 10]}" for n in range(k, k + 30))
        assert own.encode([text.encode()]) == [np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
        assert len(own.known) <= 50 + 30


@pytest.mark.parametrize("share", [(90, 100), (80, 100)])
def test_similar_sets_have_a_signature_in_common(share):
    rng = np.random.default_rng(6)
    for n in [*range(1, 60), 100, 300, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2))
            b = np.concatenate([a[rng.permutation(len(a))[: len(a) - rng.integers(0, n // 8 + 1)]], rng.integers(0, 1 << 63, rng.integers(0, n // 8 + 1), np.uint64)])
            b = np.unique(b)
            both = len(np.intersect1d(a, b))
            if share[1] * both >= share[0] * (len(a) + len(b) - both):
                assert set(signatures(a, share).tolist()) & set(signatures(b, share).tolist()), (n, len(a), len(b), both)


def test_size_classes_follow_one_another():
    for share in ((90, 100), (80, 100)):
        for n in range(1, 3000):
            number, last = size_class(n, share)
            assert n <= last and size_class(last, share)[0] == number and size_class(n * share[1] // share[0], share)[0] <= number + 1
            assert class_parts(last, share)[0] > 2 * last * (share[1] - share[0]) // (share[1] + share[0])
