"""Encoding whole texts with a public tokenizer, remembering the ids of units that texts are made of.

Both known pre-tokenizers look at no more than a word and the white space before it, so a text may be cut
where a non-space meets a single white space followed by a non-space, and where a letter meets a full stop
or comma, without changing its ids. Letters that normalizing turns into a letter and a mark are no such place: the mark
belongs to the full stop. The ids of such units repeat all over a corpus; each worker keeps them
in a bounded cache and asks the tokenizer for the rest in one call.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np

from martloom.llm.support import LOWER

# Pre-tokenizers whose units are known.
SPACED, UNSPACED = "spaced", "unspaced"
LATIN = re.compile(r"[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+")
CACHE_UNITS = 1_200_000


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class CachedEncoder:
    """Ids of whole texts, equal to those of `Tokenizer.encode(text, add_special_tokens=False)`."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        before = json.dumps(described.get("pre_tokenizer"))
        ending = described["model"].get("end_of_word_suffix") or ""
        self.mode = None
        if described["pre_tokenizer"].get("type") == "ByteLevel" and described.get("normalizer") is None and not ending:
            self.mode = SPACED
        elif ending and "Removed" in before and "Lowercase" in json.dumps(described.get("normalizer")):
            self.mode = UNSPACED
        size = self.tokenizer.get_vocab_size()
        self.vocabulary = size
        self.cache: dict[str | bytes, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if self.mode is None:
            return self._plain(texts)
        if len(self.cache) > CACHE_UNITS:
            self.cache.clear()
        get = self.cache.get
        units = [self._units(t) for t in texts]
        found = [list(map(get, u)) for u in units]
        missing = [[k for k, ids in enumerate(f) if ids is None] if None in f else [] for f in found]
        self._learn({u[k] for u, holes in zip(units, missing) for k in holes})
        for f, u, holes in zip(found, units, missing):
            for k in holes:
                f[k] = get(u[k])
        return [b"".join(f) for f in found]

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _units(self, text: str) -> list[str] | list[bytes]:
        """Cut `text` at places where no id can change. Units joined again give the text (spaced mode); where
        white space and case go anyway, units are lower-case words as bytes, but for names of special tokens."""
        if self.mode == UNSPACED:
            raw = text.encode()
            return (raw if b"<|" in raw else raw.translate(LOWER)).split()
        if text.replace("\n", " ").split(" ") != text.split():  # runs of white space, or other kinds of it
            return re.split(r"(?<=\S)(?=\s\S)", text) if text else []
        marked = text.replace("\n", " \n").split(" ")
        return [marked[0], *(u if u[0] == "\n" else " " + u for u in marked[1:])]

    def _learn(self, units: set) -> None:
        """Ids of units not known yet: a full stop or comma at the end is looked up on its own."""
        cache, raw = self.cache, self.mode == UNSPACED
        new = {u.decode() for u in units} if raw else units
        tails = [u for u in new if len(u) > 1 and u[-1] in ".," and _stays_letter(u[-2])]
        cores = {u[:-1] for u in tails}
        cores.update(new.difference(tails), (".", ",") if tails else ())
        plain, words = [], []
        for u in cores:
            if (u.encode() if raw else u) not in cache:
                (words if LATIN.fullmatch(u) and (raw or u[0] in " \n") else plain).append(u)
        for start in range(0, len(plain), 1000):
            part = plain[start : start + 1000]
            self._keep(part, self._plain(part))
        self._learn_words(words)
        for u in tails:
            key = u.encode() if raw else u
            cache[key] = cache[key[:-1]] + cache[key[-1:]]

    def _keep(self, units: list[str], ids: list[bytes]) -> None:
        self.cache.update(zip([u.encode() for u in units] if self.mode == UNSPACED else units, ids))

    def _learn_words(self, words: list[str]) -> None:
        """Latin words, alone or after one blank or line feed: the pre-tokens are known, so they go to the
        tokenizer's model directly."""
        model = self.tokenizer.model.tokenize
        learned = []
        for word in words:
            if self.mode == UNSPACED:
                tokens = model(_printable(word.lower()))
            elif word[0] == "\n":
                tokens = model(_printable("\n")) + model(_printable(word[1:]))
            else:
                tokens = model(_printable(word))
            learned.append(array("I", [t.id for t in tokens]).tobytes())
        self._keep(words, learned)


@lru_cache(maxsize=10_000)
def _stays_letter(character: str) -> bool:
    """Whether it is a letter and ends in one when composed and lower-cased, which a capital I with a dot does not."""
    return character.isalpha() and unicodedata.normalize("NFC", character).lower()[-1].isalpha()


def _byte_names() -> dict[int, str]:
    """How byte-level tokenizers write bytes: printable Latin-1 characters stand for themselves, the others for
    characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


BYTE_NAMES = _byte_names()


def _printable(word: str) -> str:
    """A word as the model of a byte-level tokenizer sees it."""
    return word.encode().decode("latin-1").translate(BYTE_NAMES)


@lru_cache(maxsize=2)
def encoder(path: str) -> CachedEncoder:
    """One encoder for each worker process and file."""
    return CachedEncoder(path)
