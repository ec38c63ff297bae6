"""Encode whole texts with a public tokenizer, remembering the ids of words.

The tokenizer cuts a text into words before it merges, so a text's ids are its
words' ids joined, and a word's are its pre-tokens'.  Distinct ones are encoded once
by the ``tokenizers`` library and kept in bounded per-worker caches as
little-endian unsigned 32-bit payloads.

A text or word of common characters only (printable ASCII, line feeds, letters of
Latin-1) is cut into the tokenizer's own pre-tokens by an equal pattern, many
at a time, and each distinct pre-token goes through the library's merge model
once; any other word goes through the whole library.

Two ways to cut, both exact for the tokenizer kind they are for:

* ``words``: the tokenizer drops white space; cut at ASCII white space.
* ``spaced``: byte-level, a space belongs to the word after it; cut before each
  single space between two other characters.  A text with neighbouring white
  space or separators U+001C..U+001F is encoded whole by the library.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from string import ascii_letters

import numpy as np
import pyarrow as pa

from .common import trim_worker

MAX_CACHED, MAX_MERGED = 150_000, 220_000
MISS_BLOCK = 4096
# The pre-token patterns of the two kinds, for common characters
# (where letters, digits and white space are these classes).
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_COMMON = re.compile(f"[\\n -~{_LETTERS}]+")
_PRETOKENS = {
    "words": re.compile(f"[{_LETTERS}]+|\0|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\\s{_LETTERS}0-9\0]+"),
    "spaced": re.compile(f" ?[{_LETTERS}]+|\0|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\\s{_LETTERS}0-9\0]+|\\s+(?![^\\s\0])|\\s+"),
}
_MARK, _MARK_ID = "\0", b"\xff" * 4  # no common character, no id
# a part beside whose cut white space may go on, or with a separator in it
_HARD = re.compile(r"^ \s|^(?! )\s|\s\Z|[\x1c-\x1f]")
_encoders: dict[tuple[str, str], "WordCache"] = {}


class Merged(dict):
    """Payloads of pre-tokens; a new one's come from the library's merge model,
    where each byte stands as a character of its own (``stand``). Once
    there are over ``MAX_MERGED``, the first three quarters stay: frequent ones
    are met early, and a task's cache ends with it."""

    def __init__(self, tokenize: Callable, stand: dict) -> None:
        self.tokenize, self.stand, self.space = tokenize, stand, stand.get(ord(" "), " ")
        self.letters = all(stand.get(ord(c), c) == c for c in ascii_letters)
        self[_MARK] = _MARK_ID

    def __missing__(self, pretoken: str) -> bytes:
        if self.letters and pretoken.isascii() and pretoken.replace(" ", "", 1).isalpha():
            stands = pretoken.replace(" ", self.space)
        else:
            stands = pretoken.translate(self.stand)
        found = self[pretoken] = array("I", [t.id for t in self.tokenize(stands)]).tobytes()
        return found

    def trim(self) -> None:
        if len(self) > MAX_MERGED:
            early = dict(islice(self.items(), 3 * MAX_MERGED // 4))
            self.clear()
            self.update(early)


class WordCache:
    def __init__(self, path: str, cut: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cut = cut
        self.known: dict[str | bytes, bytes | None] = {}
        chars = [chr(c) for c in (10, *range(32, 127), *range(0xC0, 0x100)) if _COMMON.fullmatch(chr(c))]
        plain = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.merged = Merged(self.tokenizer.model.tokenize,
                             str.maketrans({c: "".join(t for t, _ in plain(c)) for c in chars if plain(c)}))

    def _forget(self, needed: set) -> None:
        """Keep only the words in use once there are too many."""
        if len(self.known) > MAX_CACHED:
            self.known = {w: self.known[w] for w in needed if w in self.known}

    def _encoded(self, strings: list[str]) -> list[bytes]:
        """The ids of each string, as a word of its own."""
        got = self.tokenizer.encode(strings, is_pretokenized=True, add_special_tokens=False)
        if None in got.word_ids:
            return [self.whole(s) for s in strings]
        payload = np.array(got.ids, "<u4").tobytes()
        ends = (4 * np.searchsorted(np.array(got.word_ids, np.int64), np.arange(len(strings) + 1))).tolist()
        return [payload[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_all(self, words: Iterable) -> None:
        texts = {w: w.decode() if isinstance(w, bytes) else w for w in words}
        plain = [w for w, t in texts.items() if _COMMON.fullmatch(t) and "<|" not in t]
        rest = list(texts.keys() - set(plain))
        for i in range(0, len(rest), MISS_BLOCK):
            some = rest[i:i + MISS_BLOCK]
            self.known.update(zip(some, self._encoded([texts[w] for w in some]), strict=True))
        for i in range(0, len(plain), MISS_BLOCK):
            self._learn_plain(plain[i:i + MISS_BLOCK], texts)

    def _learn_plain(self, words: list, texts: dict) -> None:
        self.known.update(zip(words, self._plain([texts[w] for w in words]), strict=True))

    def _plain(self, strings: list[str]) -> list[bytes]:
        """The ids of strings of common characters: all are cut into pre-tokens as
        one string, in which a mark that none of them holds ends each."""
        one = _MARK.join(strings) + _MARK
        found = _PRETOKENS[self.cut].findall(one.lower() if self.cut == "words" else one)
        self.merged.trim()
        payload = b"".join(map(self.merged.__getitem__, found))
        ends = (4 * np.flatnonzero(np.frombuffer(payload, "<u4") == 0xFFFFFFFF)).tolist()
        return [payload[a:b] for a, b in zip([0, *[e + 4 for e in ends]], ends)]

    def payloads(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers. Texts of
        common characters only are cut as a whole, others by words."""
        plain = [i for i, t in enumerate(texts) if (not t or _COMMON.fullmatch(t)) and "<|" not in t]
        if not plain:
            return self._by_words(texts)
        out: list = [None] * len(texts)
        for i, payload in zip(plain, self._plain([texts[i] for i in plain]), strict=True):
            out[i] = payload
        rest = [i for i, p in enumerate(out) if p is None]
        for i, payload in zip(rest, self._by_words([texts[i] for i in rest]) if rest else [], strict=True):
            out[i] = payload
        return out

    def _by_words(self, texts: list[str]) -> list[bytes]:
        if self.cut == "words":
            parts = [t.encode().split() for t in texts]
            needed = set().union(*parts)
            self._forget(needed)
            self._learn_all(needed.difference(self.known))
            get = self.known.__getitem__
            return [b"".join(map(get, p)) for p in parts]
        parts = [t.replace(" ", "\0 ").split("\0") if "\0" not in t else None for t in texts]
        needed = set().union(*[p for p in parts if p])
        self._forget(needed)
        new = needed.difference(self.known)
        for w in [w for w in new if _HARD.search(w)]:
            self.known[w] = None
            new.discard(w)
        self._learn_all(new)
        get, out = self.known.__getitem__, []
        for t, p in zip(texts, parts, strict=True):
            found = [None] if p is None else list(map(get, p))
            out.append(self.whole(t) if None in found else b"".join(found))
        return out


def encoder(path: str, cut: str) -> WordCache:
    """The worker's encoder for a tokenizer file (made once per worker)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, cut) not in _encoders:
        _encoders[path, cut] = WordCache(path, cut)
    return _encoders[path, cut]


def forget() -> None:
    """Free the worker's encoders when a task ends."""
    _encoders.clear()
    trim_worker()


def blocks(texts: pa.Array, chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) in runs of about ``chars`` characters; null: empty.
    Only one run's texts are Python strings at a time."""
    start, held, n = 0, [], 0
    for at in range(0, len(texts), 64):
        for t in texts.slice(at, 64).to_pylist():
            held.append(t or "")
            n += len(held[-1])
            if n >= chars:
                yield start, held
                start, held, n = start + len(held), [], 0
    if held:
        yield start, held
