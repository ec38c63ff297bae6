"""Secret scans: fixed patterns plus dictionary-primed compression novelty.

Base patterns report assignments, access keys and long hex runs.  The method
adds strings in a sensitive context (a word like "key" or "auth" shortly before)
that no base pattern covers: a candidate's novelty is the number of bytes that
zstandard, primed with a dictionary of common identifiers and the text around
the candidate, needs in addition when the candidate follows its surroundings,
per character.  Words and identifiers compress against those; random strings
don't, and are reported as ``novel``: they need ``NOVELTY`` bytes a character,
or, of a small alphabet, a little over the entropy of that alphabet.
Short surroundings are filled up with fixed text, so that zstandard codes them
as it does long ones.  A candidate with the structure of an identifier is none: its
parts (cut at case changes, digits and signs) that stand in the dictionary or as
words nearby are free, and ``UNKNOWN`` of its characters must lie in other parts;
several long parts need more novelty.  Letters of one case alone, under ``LONG_WORD``
of them, look like rare words and need ``RARE`` bytes a character, so most random
ones of that kind are missed.

Every run of candidate characters is measured at most twice (whole, and after the
last sensitive word inside it), and found with the nearest sensitive word before it
by position, so the time is linear in the text.

Spans are code points, the end exclusive.  Defined results: a null text is
empty and has no spans; repeated rows repeat their spans; the whole text is
scanned, however long.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right

import pandas as pd
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "novel")
# The base patterns.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+", re.A)
HEX = re.compile(r"[0-9a-f]{24,}", re.A)  # the runs of 24 and more are those of [0-9a-f]+ that long
# Words that make what follows sensitive, and shapes of candidates.
CONTEXT = re.compile(r"key|auth|bearer|credential|private|passphrase|pwd|secret|token|signature|session", re.A | re.I)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~.-]{16,}", re.A)
SHORTEST = 16  # characters of a candidate
REACH, AROUND, NOVELTY, LONG = 48, 400, 0.8, 64
UNKNOWN, LONG_WORD, RARE, LONG_PART = 0.4, 32, 0.95, 5
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|[^A-Za-z0-9]+", re.A)
LETTERS = re.compile(r"[A-Za-z]+", re.A)
IDENTIFIERS = " ".join("""
access account address admin alpha api app application args array assert async auth authentication authorization await backend base
bearer bool boolean break buffer build bytes cache call check checksum callback case catch char class client code column commit config
configuration connect connection const constructor content context continue cookie copy count create credential data database date debug default define
delete description dict digest document domain double else email encode endpoint enum environment error event except
export false field file filter final finally float format from function get global hash header host html http https
identifier implements import include index info init input insert instance integer interface json key label lambda
length level library license limit list local location logger login long main manager map max message min method model module name
namespace new none null number object option output package parameter parse password path payload pool port private
property protected protocol public query queue random read record refresh region register release remote request
response result retries retry return role root row schema script secret select self send server service services session set setting sha signature
size source sql start state static status storage stream string struct super switch sync system table tag target task
temp template test text thread time timeout timestamp title token true type union update upload url user username utf
util value variable vector version view virtual void while window write xml yaml example com www org net localhost
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789
""".split()).encode()
_words = IDENTIFIERS.split()
_KNOWN = {w.decode() for w in _words}
FILLER = b" ".join(_words[i * 89 % len(_words)] for i in range(300))[:2 * AROUND]
_ALPHABETS = [(re.compile(p), n) for p, n in (("[a-z]", 26), ("[A-Z]", 26), ("[0-9]", 10))]
_HEX = re.compile("[0-9a-f]+|[0-9A-F]+")


def needed(candidate: str) -> float:
    """Marginal bytes a character from which a candidate counts as random.
    Identifiers come near the entropy of their alphabet when they are short."""
    if _HEX.fullmatch(candidate) and any(c.isdigit() for c in candidate):
        return math.log2(16) / 8 * 1.1
    if candidate.isalpha() and candidate.upper() in (candidate, candidate.swapcase()):
        return RARE if len(candidate) < LONG_WORD else math.log2(26) / 8 * 1.05
    size = sum(n for p, n in _ALPHABETS if p.search(candidate)) + len({c for c in candidate if not c.isalnum()})
    return min(NOVELTY, math.log2(size) / 8 * (1.2 if len(candidate) < LONG else 1.05))


class Novelty:
    """Marginal compressed bytes of a candidate beside its surroundings."""

    def __init__(self) -> None:
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=primed, write_checksum=False,
                                                   write_content_size=False)

    def __call__(self, before: str, candidate: str, after: str) -> float:
        # copies of the candidate must not vouch for it
        around = (before + after).replace(candidate, "").encode("utf-8", "replace")
        around = FILLER[:max(0, len(FILLER) - len(around))] + around
        alone = len(self.compressor.compress(around))
        return (len(self.compressor.compress(around + b" " + candidate.encode())) - alone) / len(candidate)


_novelty: list[Novelty] = []


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and kind."""
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def unknown_share(candidate: str, around: str) -> tuple[float, bool]:
    """The share of a candidate's characters in parts that are no known word and
    no short number; whether it is made of several long parts."""
    near, size = {w.lower() for w in LETTERS.findall(around)}, 0
    parts = PART.findall(candidate)
    for p in parts:
        low = p.lower()
        known = low in _KNOWN or low.removesuffix("s") in _KNOWN or (len(low) > 3 and low in near)
        if p.isalnum() and not known and not (p.isdigit() and len(p) <= 4):
            size += len(p)
    letters = [len(p) for p in parts if p.isalpha()]
    return size / len(candidate), len(letters) > 1 and sum(letters) / len(letters) >= LONG_PART


def is_novel(before: str, candidate: str, after: str) -> bool:
    """Whether a candidate is random beside what stands around it."""
    if candidate.isdigit():
        return False
    mixed_hex = _HEX.fullmatch(candidate) and any(c.isdigit() for c in candidate)  # has no words
    unknown, long_parts = (1, False) if mixed_hex else unknown_share(candidate, before + " " + after)
    if unknown < UNKNOWN:
        return False
    if not _novelty:
        _novelty.append(Novelty())
    return _novelty[0](before, candidate, after) >= max(needed(candidate), RARE if long_parts else 0)


def _candidates(text: str) -> list[tuple[int, int]]:
    """Runs that follow a sensitive word, and what follows the last such word
    inside a run."""
    words = [m.span() for m in CONTEXT.finditer(text)]
    out, ends = [], [b for _, b in words]
    if not words:
        return out
    for m in CANDIDATE.finditer(text):
        a, b = m.span()
        k = bisect_right(ends, a)
        if k and a - ends[k - 1] <= REACH:
            out.append((a, b))
        last = bisect_right(ends, b - SHORTEST)
        if last > k and words[last - 1][1] > a:
            out.append((ends[last - 1], b))
    return out


def novel_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Incompressible candidates in sensitive contexts, apart from ``taken``."""
    joined: list[list[int]] = []  # the taken spans, joined where they overlap
    for x, y, _ in sorted(taken):
        if joined and x < joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], y)
        else:
            joined.append([x, y])
    starts, out, end = [x for x, _ in joined], [], -1
    for a, b in _candidates(text):
        k = bisect_left(starts, b)
        if a < end or (k and joined[k - 1][1] > a):
            continue
        if is_novel(text[max(0, a - AROUND):a], text[a:b], text[b:b + AROUND]):
            out.append((a, b, "novel"))
            end = b
    return out


def find(text: str | None) -> list[tuple[int, int, str]]:
    base = base_spans(text or "")
    return sorted(base + novel_spans(text or "", base), key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str | None, mark: str = "[REDACTED]") -> str | None:
    """The text with every span replaced by ``mark`` (joined where they meet)."""
    if not text:
        return text
    out, end = [], 0
    for a, b, _ in find(text):
        if a >= end:
            out += [text[end:a], mark]
        end = max(end, b)
    return "".join([*out, text[end:]])


def spans(text: Column | str) -> Column:
    """Spans of a text column, by start and then kind."""
    @F.pandas_udf("array<struct<start:long,end:long,kind:string>>")
    def found(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [{"start": a, "end": b, "kind": k} for a, b, k in find(t)])

    return found(text)


def redacted(text: Column | str) -> Column:
    """A text column with its spans replaced."""
    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(redact)

    return clean(text)


def as_text(found: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(found: Column) -> list[Column]:
    """Counts, digest of the base spans and all spans, from a spans column."""
    def number(kind: str) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = as_text(F.filter(found, lambda s: s["kind"] != "novel"))
    return [number("assign"), number("access"), number("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"),
            as_text(found).alias("spans"), number("novel")]
