"""SentencePiece encoding and decoding with an Aho-Corasick driven Viterbi.

All pieces of the model stand in one automaton.  A single pass over the text
yields, at each position, the pieces that end there (following output links);
each relaxes the best segmentation up to there:

* ``unigram`` models: the highest sum of piece scores wins, the longest last
  piece on ties; a character without a piece costs ``UNKNOWN_PENALTY`` more
  than any piece.
* ``bpe`` models: scores are merge ranks, whose sum says nothing.  The best
  segmentation of a prefix is the one that merging gives; its last piece is the
  only one that ends there, follows the best segmentation before it, and whose
  pair with the piece before survives merging (remembered by pair).

Both give the ids of the model's own encoder.  Characters without a piece fall
back to their UTF-8 byte pieces.  White space is marked and a mark put in front,
as the model asks.  No piece of such a model reaches over a mark, so a text is
cut before its marks, each distinct part segmented once and remembered in a
bounded per-worker cache.

Short words of Latin-1 and the pieces' most frequent characters are segmented by merges
many at a time: the automaton stands in arrays (next state, longest piece that
ends there, next shorter one), and all words take a character a step, with the
same relaxing; what merging keeps apart is remembered in an array too.

Decoding joins pieces and bytes and turns marks back into spaces.  Defined
results: a null or empty text has no ids and decodes to an empty text; a mark
U+2581 in a text decodes as a space; repeated rows give equal ids.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from .token_cache import blocks

MARK = "▁"
UNKNOWN_PENALTY = 10.0
_PARTS = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
MAX_PARTS, MAX_PAIRS = 120_000, 400_000
# words segmented together, their characters and length at most, slots for pairs (a power of two)
MANY, CHARS, SHORT, SLOTS = 8192, 127, 48, 1 << 20
_codecs: dict[tuple[str, str], "PieceCodec"] = {}


class ManyWords:
    """A codec's automaton as arrays over Latin-1 and the ``CHARS`` most frequent
    characters of its pieces: ``by_merges`` for many words, a character of each a step."""

    def __init__(self, codec: "PieceCodec") -> None:
        self.survives, self.byte_ids = codec._survives, codec.byte_ids
        pieces = [(i, p) for i, p in enumerate(codec.piece_of) if p in codec.score_of]
        seen = Counter(chain.from_iterable(p for _, p in pieces))
        at = {c: i for i, c in enumerate(dict.fromkeys([*map(chr, range(9, 256)), *[c for c, _ in seen.most_common(CHARS)]]))}
        self.common = re.compile(f"[{re.escape(''.join(at))}]{{1,{SHORT}}}")
        self.index = np.zeros(max(map(ord, at)) + 1, np.int32)
        self.index[[ord(c) for c in at]] = list(at.values())
        self.size = np.ones(len(codec.piece_of) + 1, np.int32)  # the last: an unknown character
        children: list[dict[int, int]] = [{}]
        own: dict[int, int] = {}
        for i, piece in pieces:
            if at.keys() >= set(piece):
                node = 0
                for c in piece:
                    if at[c] not in children[node]:
                        children[node][at[c]] = len(children)
                        children.append({})
                    node = children[node][at[c]]
                own[node], self.size[i] = i, len(piece)
        self.next = np.zeros((len(children), len(at)), np.int32)
        self.longest = np.full(len(children), -1, np.int32)
        self.shorter = np.full(len(codec.piece_of), -1, np.int32)
        left = deque([(0, 0)])  # states in breadth and the state of their longest proper suffix
        while left:
            node, suffix = left.popleft()
            row = self.next[suffix].copy()
            left.extend((child, int(row[c]) if node else 0) for c, child in children[node].items())
            row[list(children[node])] = list(children[node].values())
            self.next[node] = row
            self.longest[node] = own.get(node, self.longest[suffix])
            if node in own:
                self.shorter[own[node]] = self.longest[suffix]
        self.pairs, self.kept = np.full(SLOTS, -1, np.int64), np.zeros(SLOTS, bool)

    def _survive(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging keeps the two pieces of each pair apart."""
        keys = (left.astype(np.int64) + 1) << 32 | right
        slots = (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).view(np.int64) & SLOTS - 1
        out, new = self.kept[slots], np.flatnonzero(self.pairs[slots] != keys)
        if len(new):
            some, first, back = np.unique(keys[new], return_index=True, return_inverse=True)
            found = np.array([self.survives((k >> 32) - 1, k & 0xFFFFFFFF) for k in some.tolist()])
            out[new] = found[back]
            at = slots[new[first]]
            self.pairs[at] = some
            # of keys that share a slot one stands there, with its own answer
            won = self.pairs[at] == some
            self.kept[at[won]] = found[won]
        return out

    def _with_bytes(self, word: str, pieces: list[int]) -> bytes:
        """The payload of a word's pieces, -1: bytes of an unknown character."""
        out, at = [], 0
        for p in pieces:
            out += [p] if p >= 0 else [self.byte_ids[b] for b in word[at].encode()]
            at += int(self.size[p])
        return np.array(out, "<u4").tobytes()

    def ids(self, words: list[str]) -> list[bytes]:
        """The payload of each word (of characters in ``common``)."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        sizes = np.array([len(words[i]) for i in order])
        codes = self.index[np.frombuffer("".join([words[i] for i in order]).encode("utf-32-le"), "<u4")]
        starts = np.cumsum(sizes) - sizes
        last = np.full((len(words), sizes[0] + 1), -1, np.int32)  # the piece that ends there
        states = np.zeros(len(words), np.int32)
        for end in range(1, sizes[0] + 1):
            n = int(np.searchsorted(-sizes, -end, "right"))  # words that go on so far
            states = self.next[states[:n], codes[starts[:n] + end - 1]]
            piece = self.longest[states]
            rows = np.flatnonzero(piece >= 0)
            piece = piece[rows]
            while len(rows):
                kept = self._survive(last[rows, end - self.size[piece]], piece)
                last[rows[kept], end] = piece[kept]
                rows, piece = rows[~kept], self.shorter[piece[~kept]]
                rows, piece = rows[piece >= 0], piece[piece >= 0]
        rows, at, steps = np.arange(len(words)), sizes, []
        counts, known = np.zeros(len(words), np.int64), np.ones(len(words), bool)
        while len(rows):
            piece = last[rows, at]
            steps.append((rows, piece))
            counts[rows] += 1
            known[rows[piece < 0]] = False
            at = at - self.size[piece]
            rows, at = rows[at > 0], at[at > 0]
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]), "<i4")
        for t, (rows, piece) in enumerate(steps):
            flat[ends[rows] - 1 - t] = piece
        payload, out = flat.tobytes(), [b""] * len(words)
        for i, a, b, ok in zip(order, (ends - counts).tolist(), ends.tolist(), known.tolist()):
            out[i] = payload[4 * a:4 * b] if ok else self._with_bytes(words[i], flat[a:b].tolist())
        return out


class PieceCodec:
    def __init__(self, path: str, kind: str) -> None:
        self.segment = {"bpe": self.by_merges, "unigram": self.by_scores}[kind]
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        self.score_of: dict[str, float] = {}
        self.piece_of: list[str] = []
        self.pairs: dict[int, bool] = {}
        lowest, crossing = 0.0, False
        for i in range(sp.vocab_size()):
            piece, score = sp.id_to_piece(i), sp.get_score(i)
            self.piece_of.append(piece)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.automaton.add_word(piece, (len(piece), score, i))
                self.score_of[piece] = score
                self.bytes_of.append(piece.replace(MARK, " ").encode())
                lowest = min(lowest, score)
                crossing |= MARK in piece.lstrip(MARK)
        self.automaton.make_automaton()
        self.unknown, self.crossing = lowest - UNKNOWN_PENALTY, crossing
        self.known: dict[str, bytes] = {}
        self.many = ManyWords(self) if kind == "bpe" and not crossing else None

    def by_scores(self, part: str) -> list[int]:
        """Ids of the segmentation with the best sum of scores."""
        n = len(part)
        best: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        done = 0

        def close(upto: int) -> None:
            # a position that no piece has reached takes its character as unknown
            nonlocal done
            while done < upto:
                done += 1
                score = best[done - 1] + self.unknown
                if best[done] is None or score > best[done]:
                    best[done], back[done] = score, (done - 1, -1)

        for end, (size, score, piece) in self.automaton.iter(part):
            close(end)
            start, total = end + 1 - size, best[end + 1 - size] + score
            if best[end + 1] is None or total > best[end + 1] or (
                    total == best[end + 1] and start < back[end + 1][0]):
                best[end + 1], back[end + 1] = total, (start, piece)
        close(n)
        return self._ids(part, back)

    def _merged(self, text: str) -> list[str]:
        """A short text after all merges, the best score first, leftmost on ties."""
        parts = list(text)
        while len(parts) > 1:
            ranked = [(-self.score_of[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:]))
                      if x + y in self.score_of]
            if not ranked:
                break
            i = min(ranked)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _survives(self, left: int, right: int) -> bool:
        """Whether merging keeps these two pieces apart (left < 0: an end)."""
        found = self.pairs.get(left << 32 | right)
        if found is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            both = ([self.piece_of[left]] if left >= 0 else []) + [self.piece_of[right]]
            found = self.pairs[left << 32 | right] = self._merged("".join(both)) == both
        return found

    def by_merges(self, part: str) -> list[int]:
        """Ids of the segmentation that merging gives."""
        n = len(part)
        back: list[tuple[int, int] | None] = [(0, -1)] + [None] * n
        done = 0
        for end, (size, _, piece) in self.automaton.iter(part):
            while done < end:  # no piece ends there: the character is unknown
                done += 1
                back[done] = back[done] or (done - 1, -1)
            if back[end + 1] is None and self._survives(back[end + 1 - size][1], piece):
                back[end + 1] = (end + 1 - size, piece)
        while done < n:
            done += 1
            back[done] = back[done] or (done - 1, -1)
        return self._ids(part, back)

    def _ids(self, part: str, back: list) -> list[int]:
        n, out = len(part), []
        while n:
            start, piece = back[n]
            out += [piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(part[start:n].encode())]
            n = start
        return out[::-1]

    def parts(self, text: str) -> list[str]:
        """A text cut so that no piece reaches over a cut; each part stands for
        itself after one mark."""
        if not text:
            return []
        if self.crossing:
            return [text.replace(" ", MARK)]
        if "  " in text or MARK in text or text[0] == " ":
            return [p[1:] for p in _PARTS.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def _learn(self, parts: list[str]) -> None:
        """Segment new parts: short ones of common characters many at a time."""
        known = self.known
        if self.many:
            fits = self.many.common.fullmatch
            short = [p for p in parts if fits(MARK + p)]
            for i in range(0, len(short), MANY):
                some = short[i:i + MANY]
                known.update(zip(some, self.many.ids([MARK + p for p in some]), strict=True))
        for part in parts:
            if part not in known:
                known[part] = np.array(self.segment(MARK + part), "<u4").tobytes()

    def payloads(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.parts(t) for t in texts]
        needed = set().union(*cut)
        if len(self.known) > MAX_PARTS:
            self.known = {p: self.known[p] for p in needed.intersection(self.known)}
        self._learn(list(needed.difference(self.known)))
        get = self.known.__getitem__
        return [b"".join(map(get, parts)) for parts in cut]

    def text(self, payload: bytes) -> str:
        joined = b"".join(map(self.bytes_of.__getitem__, np.frombuffer(payload, "<u4").tolist()))
        return joined.decode("utf-8", "replace")[1:]


def codec(path: str, kind: str) -> PieceCodec:
    """The worker's codec for a model file (made once per worker)."""
    if (path, kind) not in _codecs:
        _codecs[path, kind] = PieceCodec(path, kind)
    return _codecs[path, kind]


def encode(docs: DataFrame, model: str, kind: str = "bpe", text: str = "text", decoded: bool = False) -> DataFrame:
    """All columns of ``docs`` with ``ids``, a little-endian unsigned 32-bit
    payload; with ``decoded`` also the text that these ids decode to."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, kind)
        for b in batches:
            at = b.schema.get_field_index(text)
            for start, some in blocks(b.column(at)):
                ids = c.payloads(some)
                out = b.slice(start, len(ids)).append_column("ids", pa.array(ids, pa.binary()))
                if decoded:
                    out = out.append_column("decoded", pa.array([c.text(p) for p in ids], pa.string()))
                yield out

    extra = [StructField("ids", BinaryType())] + [StructField("decoded", StringType())] * decoded
    return docs.mapInArrow(work, StructType([*docs.schema, *extra]))


def decode(encoded: DataFrame, model: str, kind: str = "bpe", ids: str = "ids") -> DataFrame:
    """All columns of ``encoded`` with ``decoded``, the text of its ids."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model, kind)
        for b in batches:
            at = b.schema.get_field_index(ids)
            yield b.append_column("decoded", pa.array([c.text(p) for p in b.column(at).to_pylist()], pa.string()))

    return encoded.mapInArrow(work, StructType([*encoded.schema, StructField("decoded", StringType())]))
