"""Token ids of whole texts, with a bounded memory of words that were encoded before."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np

from .common import keeps

#: Most words, or pieces where words are cut, that a Python worker remembers (about 0.2 kB each); the memory starts afresh beyond it.
REMEMBERED_WORDS, REMEMBERED_PIECES = 1_200_000, 600_000
_TWO_SPACES = re.compile(r"\s\s")

#: The form of tokenizer whose pieces are cut here: lower case, then contractions, runs of letters, single digits and runs of other
#: characters, each encoded on its own.
_CUT_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT_PIECES = [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Python cuts words of ASCII and the letters of Latin-1: they are composed already, and the lower case of each is one letter.
#: Words with any other character go through the tokenizer as they are.
_SPACES, _PLAIN, _LETTERS = r"\t-\r ", "!-~À-ÖØ-öø-ÿ", "a-zß-öø-ÿ"
_OTHER_WORD = re.compile(rf"(?<![^{_SPACES}])([{_PLAIN}]*+[^{_SPACES}{_PLAIN}][^{_SPACES}]*+)")
_PIECE = re.compile(rf"[{_LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{_SPACES}0-9{_LETTERS}]+")


def _cuts(path: str) -> bool:
    """Whether the tokenizer has the form that is cut here."""
    with open(path, encoding="utf-8") as file:
        form = json.load(file)
    steps = [(form[name] or {}).get(own) for name, own in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
    return steps == [_CUT_NORMALIZER, _CUT_PIECES] and form["model"]["type"] == "BPE" and bool(form["model"]["end_of_word_suffix"])


class Encoder:
    """Ids of texts as little-endian 32-bit numbers in bytes.

    ``spaces`` says what the tokenizer does with white space: ``dropped`` (words never touch one another, so each word is
    encoded on its own; of a known form of tokenizer, each piece of a word), ``kept`` (byte-level, a single space goes into the
    token of the word after it: a new piece starts before every space or line break that stands alone; texts with neighbouring
    white space are encoded in one go), or ``whole`` (nothing is known; texts are encoded in one go).
    """

    def __init__(self, path: str, spaces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # the names of special tokens in a text are ordinary text
        self.split = {"dropped": bytes.split, "kept": self._spaced, "whole": lambda text: [text]}[spaces]
        self.most = REMEMBERED_WORDS
        if spaces == "dropped" and _cuts(path):
            self.split, self.most = self._cut, REMEMBERED_PIECES
            # the same model, with pieces between line breaks
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split("\n", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
            suffix, vocabulary = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab(with_added_tokens=False)
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[number for token, number in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes | str, bytes] = {}  # by word, or by piece as text

    @staticmethod
    def _spaced(text: bytes) -> list[bytes]:
        if not text or b"\0" in text or _TWO_SPACES.search(text.decode()):
            return [text]
        return text.replace(b" ", b"\0 ").replace(b"\n", b"\0\n").split(b"\0")

    @staticmethod
    def _cut(text: bytes) -> list[bytes | str]:
        out: list[bytes | str] = []
        for k, part in enumerate(_OTHER_WORD.split(text.decode())):
            if k % 2:
                out.append(part.encode())
            else:
                out += _PIECE.findall(part.lower())
        return out

    def _learn(self, words: list[bytes]) -> None:
        found = [one.ids for one in self.tokenizer.encode_batch_fast([word.decode() for word in words], add_special_tokens=False)]
        self._remember(words, np.fromiter(chain.from_iterable(found), "<u4"), np.cumsum([len(ids) for ids in found]))

    def _learn_pieces(self, pieces: list[str]) -> None:
        ids = np.array(self.model.encode_batch_fast(["\n".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        self._remember(pieces, ids, np.flatnonzero(self.ends[ids]) + 1)  # the last token of a piece, and no other, is one that ends words

    def _remember(self, words: list[bytes] | list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        flat = ids.tobytes()
        self.known.update(zip(words, (flat[start:stop] for start, stop in pairwise([0, *(4 * ends).tolist()])), strict=True))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        parts = [self.split(text) for text in texts]
        known = self.known
        if len(known) > self.most:
            known.clear()
        found = [list(map(known.get, own)) for own in parts]
        gaps = [k for k, ids in enumerate(found) if None in ids]
        fresh = list({word for k in gaps for word, ids in zip(parts[k], found[k], strict=True) if ids is None})
        if words := [word for word in fresh if isinstance(word, bytes)]:
            self._learn(words)
        if pieces := [word for word in fresh if isinstance(word, str)]:
            self._learn_pieces(pieces)
        for k in gaps:
            found[k] = [known[word] if ids is None else ids for word, ids in zip(parts[k], found[k], strict=True)]
        for word in fresh:
            if len(word) > 64:
                del known[word]
        return list(map(b"".join, found))


@lru_cache(maxsize=2)
def encoder(path: str, spaces: str) -> Encoder:
    return Encoder(path, spaces)


keeps("tokens", encoder.cache_clear)
