"""Per-word encoding with a public tokenizer, cached in the Python worker.

The vocabulary ``word_bpe_49k.json`` drops white space, and neither its
normaliser (NFC, lower case), its split pattern, its merges nor its added
tokens reach across white space.  The ids of a text are therefore the ids of
its white-space separated words, one after the other, and a word need be
encoded only once per worker.

A word that is met for the first time is taken apart, in ways that leave the
ids as they are: a full stop or comma behind a letter is a pre-token of its
own; below U+0250 (without U+0130) a letter is its own composed form and has
one lower-case letter, so such words are kept in lower case, and if they are
letters only they are one pre-token, which the model can encode directly.
The added tokens are matched in the text as it stands, so a word that holds
one in any case is encoded whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

from .worker import cache

# str.split() also cuts at these four, which the tokenizer does not take as white space
_SEPARATORS = re.compile("[\x1c-\x1f]")
_WORD = re.compile(r"[^\t-\r \x85\xa0  -     　]+")
_SPACE = re.compile(r"[\t-\r ]")
_UNUSUAL = re.compile("[\u0130\u0250-\U0010ffff]")

CHUNK_CHARS = 1 << 18  # text held as a word list at a time
CACHE_WORDS = 450_000  # words in each of a worker's two generations of cached words
CACHED_CHARS = 64  # longer words are encoded each time

_tokenizers: dict[str, object] = {}


def tokenizer(path: str):
    """The tokenizer of a worker, loaded once, without truncation or padding."""
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        loaded.no_truncation()
        loaded.no_padding()
        _tokenizers[path] = loaded
    return _tokenizers[path]


def split_words(text: str) -> list[str]:
    return _WORD.findall(text) if _SEPARATORS.search(text) else text.split()


def chunks(text: str) -> Iterator[str]:
    """The text in runs of about CHUNK_CHARS, cut at white space only."""
    start = 0
    while len(text) - start > CHUNK_CHARS:
        cut = _SPACE.search(text, start + CHUNK_CHARS)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


#: Byte-level alphabet: bytes without a printable Latin-1 character are moved to U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_LEVEL = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_PROBES = ("the", "station", "être", "größe", "señor", "ąćęłńœ")


class WordCache(dict):
    """word -> value, where ``value(ids)`` is what is kept of the word's ids; values add up.

    When CACHE_WORDS have come in, they become the old generation, from which
    words are taken over as they occur again; the rest goes."""

    def __init__(self, path: str, value: Callable[[list[int]], object], known: dict | None = None):
        super().__init__(known or {})
        self.value, self.known, self.old = value, known or {}, {}
        self.tokenizer = tokenizer(path)
        self.direct = False
        self.added = [t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = os.path.commonprefix(self.added)
        if type(self.tokenizer.model).__name__ == "BPE":
            self.model = self.tokenizer.model
            self.direct = all(self._model_ids(w) == self._ids(w) for w in _PROBES)

    def _ids(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _model_ids(self, word: str) -> list[int]:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LEVEL)
        return [t.id for t in self.model.tokenize(word)]

    def __missing__(self, word: str):
        value = self.old.get(word)
        if value is None:
            core, usual = word, word.isascii() or not _UNUSUAL.search(word)
            if len(word) > 1 and word[-1] in ".," and word[-2].isalpha() and word[-2] != "\u0130" and is_normalized("NFC", word[-2]):
                core = word[:-1]  # a letter that NFC takes apart ends in a mark, which parts the stop differently
            if usual and core != (low := core.lower()):
                if self.mark in low and any(x in low for x in self.added):
                    usual = False
                else:
                    core = low
            if core is not word and core != word:
                value = self[core]
                if len(core) < len(word):
                    value = value + self[word[-1]]
            else:
                value = self.value(self._model_ids(word) if usual and self.direct and word.isalpha() else self._ids(word))
        if len(word) <= CACHED_CHARS:
            self[word] = value
        return value

    def values_of(self, text: str) -> Iterator[list]:
        """The values of the words of ``text``, a list for each chunk."""
        for chunk in chunks(text):
            if len(self) > CACHE_WORDS + len(self.known):
                self.old = dict(self)
                self.clear()
                self.update(self.known)
            yield list(map(self.__getitem__, split_words(chunk)))


def _cache(key: tuple, path: str, value: Callable[[list[int]], object], known: dict | None = None) -> WordCache:
    held = cache("words")
    if key not in held:
        held.clear()
        held[key] = WordCache(path, value, known)
    return held[key]


def length_cache(path: str, known: dict[str, int] | None = None, version: object = 0) -> WordCache:
    """Token counts by word; ``known`` (a broadcast table) is never evicted."""
    return _cache(("length", path, version), path, len, known)


def _little_endian(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


def id_cache(path: str) -> WordCache:
    """Ids by word, as little-endian unsigned 32-bit bytes."""
    return _cache(("ids", path), path, _little_endian)
