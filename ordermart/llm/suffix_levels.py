"""Removal of bytes that repeat an earlier document, by a family of sparse
suffix arrays.

A byte goes if a ``WINDOW``-byte string over it also starts in a document with a
smaller id.  A window is represented by its anchor: of its first ``ANCHORS``
positions, the one whose following bytes hash lowest (ties: leftmost).  Equal
windows have equal anchors, so the suffixes at anchors are all that must be
indexed.  Windows that follow each other with one anchor are a run; a run is known by
its suffix (a hash of ``SEED`` bytes from the anchor on) and by the whole string
that its windows cover.

1. Chunks.  Documents are laid together into chunks of a few MB, compressed.
2. Batches.  Each chunk's suffixes are sorted into an array, each distinct
   (suffix, run) once with the smallest id; the arrays are dealt by ranges of the
   suffix hash.
3. Levels.  In each range, the batches enter a logarithmic family one by one: a new
   array is level 0, and two levels of equal rank merge into one of the next.
   Every batch is then scanned against what the levels hold.  A run that an
   earlier document holds whole is settled; a suffix that stands in several
   different runs is open.
4. Windows.  Runs at open suffixes are compared window by window in the same way,
   so matches that begin or end inside a run are exact as well.
5. The covered bytes are cut out, by chunk.

Arrays are ordered by hashes of the suffixes' first bytes, not by the bytes: the
same runs of equal suffixes result, with half the bytes to move.  Hashes
have 64 bits beside those of the range (windows and suffixes alike).

A hot passage is one entry a chunk.  A task holds one chunk, cut into segments, or
the arrays of one range (about ``RANGE_ENTRIES`` entries).

Defined results: a null text is empty; texts shorter than a window keep all; a
document without an id keeps all and removes nothing; rows with equal ids do not
remove each other; an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage, trim_worker
from .shingles import mix

WINDOW, SEED = 50, 20
ANCHORS = WINDOW - SEED + 1
GRAM = 8
CHUNK_BYTES, SEGMENT = 4 << 20, 1 << 18
RANGE_ENTRIES = 1_500_000
ENTRIES_A_BYTE = 2 / (ANCHORS + 1)
_BASE = 0x9E3779B97F4A7C15
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(SEGMENT * 2 - 1)
CHUNK, ARRAYS, ANSWERS, RESULT = range(4)
ROWS = "kind int, chunk long, part int, doc_id long, n_bytes long, n_removed long, n_spans long, sha string, a binary, b binary, c binary"
SCHEMA = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t])
                    for n, t in (c.split() for c in ROWS.split(", "))])


def packed(values: np.ndarray, rising: bool = False) -> bytes:
    """64-bit integers as compressed byte planes; ``rising``: by differences."""
    v = np.ascontiguousarray(values).view(np.uint64)
    v = np.diff(v, prepend=np.uint64(0)) if rising else v
    return zstandard.compress(v.view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(payload: bytes, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(payload), np.uint8).reshape(8, -1)
    v = np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64)
    return np.cumsum(v, dtype=np.uint64) if rising else v


def _row(kind: int, chunk: int, part: int | None = None, a: bytes | None = None, b: bytes | None = None,
         c: bytes | None = None, result: tuple = (None,) * 5) -> tuple:
    return (kind, chunk, part, *result, a, b, c)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)


def _sent(rows: Iterator[tuple], size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size."""
    held, n = [], 0
    for r in rows:
        held.append(r)
        n += 100 + sum(len(x) for x in r[-3:] if x)
        if n >= size:
            yield _batch(held)
            held, n = [], 0
    if held:
        yield _batch(held)
    trim_worker()


class Hashes:
    """Hashes of any ranges of a piece of text of bounded length."""

    def __init__(self, data: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            base = np.full(len(data) + 1, _BASE, np.uint64)
            base[0] = 1
            back = np.full(len(data) + 1, pow(_BASE, -1, 2**64), np.uint64)
            back[0] = 1
            self.inverse = np.cumprod(back, dtype=np.uint64)
            self.sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(mix(data + np.uint64(1)) * np.cumprod(base, dtype=np.uint64)[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def _grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as an integer (zeros at the end)."""
    padded = np.concatenate([data, np.zeros(GRAM, np.uint8)])
    return np.ndarray(len(data), "<u8", padded.tobytes(), strides=(1,))


def anchors(data: np.ndarray, n: int) -> np.ndarray:
    """The anchor of each of the first ``n`` windows of a segment."""
    with np.errstate(over="ignore"):
        rank = _grams(data[:n + ANCHORS + GRAM])[:n + ANCHORS - 1] * _SPREAD
        rank = ((rank ^ (rank >> np.uint64(29))) * _SPREAD & ~_LOW) | np.arange(len(rank), dtype=np.uint64)
    width = 1
    while 2 * width <= ANCHORS:
        rank = np.minimum(rank[:len(rank) - width], rank[width:])
        width *= 2
    return (np.minimum(rank[:n], rank[ANCHORS - width:ANCHORS - width + n]) & _LOW).astype(np.int64)


class Text:
    """A chunk's documents, one byte apart from each other."""

    def __init__(self, ids: list[int | None], raws: list[bytes]) -> None:
        self.ids, self.raws = ids, raws
        sizes = np.array([len(r) for r in raws], np.int64)
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.data = np.frombuffer(b"\n".join(raws), np.uint8)
        told = sorted({i for i in ids if i is not None})
        place = {i: k for k, i in enumerate(told)}
        self.sorted_ids = np.array(told, np.int64)
        self.rank = np.array([-1 if i is None else place[i] for i in ids], np.int64)

    def pack(self) -> tuple[bytes, bytes]:
        told = np.array([i is not None for i in self.ids], np.uint64)
        ids = np.array([i or 0 for i in self.ids], np.int64).view(np.uint64)
        sizes = (self.ends - self.starts).astype(np.uint64)
        return packed(np.concatenate([told, ids, sizes])), zstandard.compress(self.data.tobytes(), 3)

    @staticmethod
    def unpack(head: bytes, body: bytes) -> "Text":
        told, ids, sizes = unpacked(head).reshape(3, -1)
        raw = zstandard.decompress(body)
        ends = np.cumsum(sizes.astype(np.int64) + 1) - 1
        cut = [raw[e - s:e] for s, e in zip(sizes.tolist(), ends.tolist())]
        return Text([i if t else None for i, t in zip(ids.view(np.int64).tolist(), told.tolist())], cut)

    def segments(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(offset, bytes, window starts in it), in order; documents without
        an id have no windows."""
        for at in range(0, len(self.data), SEGMENT):
            mark = np.zeros(SEGMENT + 1, np.int8)
            a = np.searchsorted(self.ends, at, "right")
            b = np.searchsorted(self.starts, at + SEGMENT)
            for i in range(a, b):
                lo, hi = max(self.starts[i], at), min(self.ends[i] - WINDOW + 1, at + SEGMENT)
                if lo < hi and self.rank[i] >= 0:
                    mark[lo - at] += 1
                    mark[hi - at] -= 1
            starts = np.flatnonzero(np.cumsum(mark[:-1]))
            if len(starts):
                yield at, self.data[at:at + SEGMENT + 2 * WINDOW + ANCHORS], starts

    def runs(self) -> dict[str, np.ndarray]:
        """Runs of windows with one anchor: first and last window, hashes of
        the suffix and of the run, document."""
        found = []
        for at, data, starts in self.segments():
            anchor = anchors(data, int(starts[-1]) + 1)[starts]
            first = np.flatnonzero(np.diff(anchor, prepend=-1))
            low, high, anchor = starts[first], starts[np.append(first[1:], len(starts)) - 1], anchor[first]
            h = Hashes(data)
            suffix = h(anchor, anchor + SEED)
            with np.errstate(over="ignore"):
                whole = mix(h(low, high + WINDOW) + (anchor - low).astype(np.uint64))
            found.append((low + at, high + at, suffix, whole))
        cols = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2
        doc = np.searchsorted(self.ends, cols[0], "right")
        return {"low": cols[0], "high": cols[1], "suffix": cols[2], "whole": cols[3], "doc": doc}

    def windows(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, hash, other hash) of all windows of some runs, in order."""
        start = np.repeat(low, high - low + 1) + _steps(high - low + 1)
        one, two = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
        for at in range(0, len(self.data), SEGMENT):
            a, b = np.searchsorted(start, [at, at + SEGMENT])
            if a == b:
                continue
            data, here = self.data[at:at + SEGMENT + 2 * WINDOW], start[a:b] - at
            one[a:b] = Hashes(data)(here, here + WINDOW)
            grams = _grams(data)
            with np.errstate(over="ignore"):
                for k in (*range(0, WINDOW - GRAM, GRAM), WINDOW - GRAM):
                    two[a:b] = (two[a:b] ^ grams[here + k]) * _SPREAD
                    two[a:b] ^= two[a:b] >> np.uint64(31)
        return start, one, mix(two)


def _steps(sizes: np.ndarray) -> np.ndarray:
    """0, 1, .. within each of some runs."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class Array:
    """A chunk's sorted distinct entries (range, key), each with its smallest
    document; ``at`` leads from the given rows to entries."""

    def __init__(self, deal: np.ndarray, key: np.ndarray, rank: np.ndarray, parts: int) -> None:
        part = ((deal & np.uint64(0xFFFFFFFF)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((rank, key, part))
        p, k = part[order], key[order]
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(p) != 0) | (k[1:] != k[:-1])
        first = np.flatnonzero(new)
        self.at = np.empty(len(order), np.int64)
        self.at[order] = np.cumsum(new) - 1
        self.part, self.key, self.low = p[first], k[first], rank[order][first]

    def bounds(self) -> list[tuple[int, int, int]]:
        """(range, first entry, end) of the ranges that have entries."""
        edge = np.flatnonzero(np.diff(self.part, prepend=-1))
        return [(int(self.part[a]), int(a), int(b)) for a, b in zip(edge, np.append(edge[1:], len(self.part)))]

    def rows(self, chunk: int, text: Text) -> Iterator[tuple]:
        for part, a, b in self.bounds():
            yield _row(ARRAYS, chunk, part, packed(self.key[a:b], rising=True), packed(text.sorted_ids[self.low[a:b]]))

    def answered(self, answers: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Per entry: held by an earlier document elsewhere; suffix open."""
        known, opened = np.zeros(len(self.key), bool), np.zeros(len(self.key), bool)
        first = {part: a for part, a, _ in self.bounds()}
        for part, one, two in answers:
            known[first[part] + unpacked(one, rising=True).astype(np.int64)] = True
            opened[first[part] + unpacked(two, rising=True).astype(np.int64)] = True
        return known, opened


def suffix_array(text: Text, parts: int) -> tuple[dict[str, np.ndarray], Array]:
    runs = text.runs()
    top = np.uint64(0xFFFFFFFF00000000)
    key = (runs["suffix"] & top) | (runs["whole"] >> np.uint64(32))
    return runs, Array(runs["suffix"], key, text.rank[runs["doc"]], parts)


def window_array(text: Text, low: np.ndarray, high: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, Array]:
    start, one, two = text.windows(low, high)
    doc = np.searchsorted(text.ends, start, "right")
    return start, doc, Array(two, one, text.rank[doc], parts)


class Levels:
    """A logarithmic family of sorted arrays (key, smallest id): level i stands
    for 2 ** i batches; adding one merges levels as a binary counter carries."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, np.ndarray] | None] = []

    @staticmethod
    def merged(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        key, low = np.concatenate([one[0], two[0]]), np.concatenate([one[1], two[1]])
        order = np.argsort(key, kind="stable")  # two rising runs: one merge
        key, low = key[order], low[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.minimum.reduceat(low, first) if len(key) else low

    def add(self, key: np.ndarray, low: np.ndarray) -> None:
        now = key, low
        for i, level in enumerate(self.levels):
            if level is None:
                self.levels[i] = now
                return
            now, self.levels[i] = self.merged(level, now), None
        self.levels.append(now)

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """All levels as one array."""
        out = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for level in self.levels:
            out = self.merged(out, level) if level else out
        return out


def scanned(arrays: list[tuple[int, bytes, bytes]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For the batches of one range, (chunk, entries that an earlier document
    holds, entries of open suffixes that no earlier document holds)."""
    levels = Levels()
    for _, key, low in arrays:
        levels.add(unpacked(key, rising=True), unpacked(low).view(np.int64))
    keys, lows = levels.whole()
    suffix = keys >> np.uint64(32)
    same = np.append(suffix[1:] == suffix[:-1], False)
    opened = same | np.append(False, same[:-1])
    for chunk, key, low in arrays:
        at = np.searchsorted(keys, unpacked(key, rising=True))
        earlier = lows[at] < unpacked(low).view(np.int64)
        ask = opened[at] & ~earlier
        if earlier.any() or ask.any():
            yield chunk, np.flatnonzero(earlier), np.flatnonzero(ask)


def _exchange(arrays: DataFrame) -> DataFrame:
    """Answers to the arrays of all chunks, range by range."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers() -> Iterator[tuple]:
            now, held = None, []

            def done() -> Iterator[tuple]:
                for chunk, known, ask in scanned(held):
                    yield _row(ANSWERS, chunk, now, packed(known, rising=True), packed(ask, rising=True))

            for b in batches:
                for part, chunk, key, low in zip(*[c.to_pylist() for c in b.columns]):
                    if part != now:
                        yield from done()
                        now, held = part, []
                    held.append((chunk, key, low))
            yield from done()

        return _sent(answers())

    return (arrays.select("part", "chunk", "a", "b").repartition("part")
            .sortWithinPartitions("part", "chunk").mapInArrow(work, ROWS))


def _with_answers(chunks: DataFrame, answers: DataFrame, fn: Callable[[int, Text, bytes | None, list], Iterator[tuple]]) -> DataFrame:
    """``fn(chunk, text, extra, answers)`` for every chunk."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            told: dict[int, list] = {}
            for b in batches:
                for i in range(b.num_rows):
                    kind, chunk, part, a, x, c = (b.column(k)[i].as_py() for k in range(6))
                    if kind == ANSWERS:  # they come before their chunk
                        told.setdefault(chunk, []).append((part, a, x))
                    else:
                        yield from fn(chunk, Text.unpack(a, x), c, told.pop(chunk, []))

        return _sent(rows())

    cols = ["kind", "chunk", "part", "a", "b", "c"]
    both = answers.select(*cols).unionByName(chunks.filter(F.col("kind") == CHUNK).select(*cols))
    return both.repartition("chunk").sortWithinPartitions("chunk", F.desc("kind")).mapInArrow(work, ROWS)


def _cut(text: Text, i: int, covered: np.ndarray) -> tuple:
    """The result row of a document from the covered bytes of its chunk."""
    raw = text.raws[i]
    mask = covered[text.starts[i]:text.ends[i]]
    n = int(mask.sum())
    if not n:
        return text.ids[i], len(raw), 0, 0, hashlib.sha256(raw).hexdigest()
    spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
    kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
    return text.ids[i], len(raw), n, spans, hashlib.sha256(kept).hexdigest()


def _covered(text: Text, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which bytes of a chunk lie in the windows from ``low`` to ``high``."""
    size = len(text.data) + 1
    return np.cumsum(np.bincount(low, minlength=size) - np.bincount(high + WINDOW, minlength=size))[:-1] > 0


def _chunks(docs: DataFrame, key: str, text: str, chunk_bytes: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            chunk, ids, raws, size = TaskContext.get().partitionId() << 32, [], [], 0

            def whole() -> tuple:
                head, body = Text(ids, raws).pack()
                return (CHUNK, chunk, None, None, size, None, None, None, head, body, None)

            for b in batches:
                for at in range(0, b.num_rows, 64):
                    for i, raw in zip(b.column(0).slice(at, 64).to_pylist(), b.column(1).slice(at, 64).to_pylist()):
                        ids.append(i)
                        raws.append(raw or b"")
                        size += len(raws[-1]) + 1
                        if size >= chunk_bytes:
                            yield whole()
                            chunk, ids, raws, size = chunk + 1, [], [], 0
            if ids:
                yield whole()

        return _sent(rows())

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("binary").alias("text")).mapInArrow(work, ROWS)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    spark = docs.sparkSession
    chunks = stage(_chunks(docs, key, text, chunk_bytes), "chunks")
    size = chunks.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    parts = max(shuffle_partitions(spark), int(size * ENTRIES_A_BYTE / RANGE_ENTRIES) + 1)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for i in range(b.num_rows):
                    t = Text.unpack(b.column(1)[i].as_py(), b.column(2)[i].as_py())
                    yield from suffix_array(t, parts)[1].rows(b.column(0)[i].as_py(), t)

        return _sent(rows())

    def settle(chunk: int, t: Text, _: bytes | None, answers: list) -> Iterator[tuple]:
        """Results of documents without open runs; the others, with their
        settled and open runs, as a chunk."""
        runs, array = suffix_array(t, parts)
        known, opened = array.answered(answers)
        settled = (t.rank[runs["doc"]] > array.low[array.at]) | known[array.at]
        ask = opened[array.at] & ~settled
        covered = _covered(t, runs["low"][settled], runs["high"][settled])
        later = np.zeros(len(t.ids), bool)
        later[runs["doc"][ask]] = True
        for i in np.flatnonzero(~later).tolist():
            yield _row(RESULT, chunk, result=_cut(t, i, covered))
        if later.any():
            some = np.flatnonzero(later)
            rest = Text([t.ids[i] for i in some], [t.raws[i] for i in some])
            move = np.zeros(len(t.ids), np.int64)
            move[some] = rest.starts - t.starts[some]
            pick = [np.flatnonzero(m & later[runs["doc"]]) for m in (settled, ask)]
            ranges = [x for p in pick for x in (runs["low"][p] + move[runs["doc"][p]], runs["high"][p] - runs["low"][p])]
            head, body = rest.pack()
            yield _row(CHUNK, chunk, None, head, body, packed(np.concatenate([[len(pick[0]), len(pick[1])], *ranges]).astype(np.int64)))

    def ranges_of(extra: bytes) -> list[np.ndarray]:
        """First window and length of the settled runs, then of the open ones."""
        values = unpacked(extra).view(np.int64)
        n, m = values[:2].tolist()
        return np.split(values[2:], [n, 2 * n, 2 * n + m])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for b in batches:
                for i in range(b.num_rows):
                    chunk, head, body, extra = (c[i].as_py() for c in b.columns)
                    t, (_, _, low, size) = Text.unpack(head, body), ranges_of(extra)
                    yield from window_array(t, low, low + size, parts)[2].rows(chunk, t)

        return _sent(rows())

    def finish(chunk: int, t: Text, extra: bytes | None, answers: list) -> Iterator[tuple]:
        low, size, ask_low, ask_size = ranges_of(extra)
        start, doc, array = window_array(t, ask_low, ask_low + ask_size, parts)
        hit = (t.rank[doc] > array.low[array.at]) | array.answered(answers)[0][array.at]
        covered = _covered(t, np.concatenate([low, start[hit]]), np.concatenate([low + size, start[hit]]))
        for i in range(len(t.ids)):
            yield _row(RESULT, chunk, result=_cut(t, i, covered))

    arrays = chunks.select("chunk", "a", "b").mapInArrow(index, ROWS)
    settled = stage(_with_answers(chunks, _exchange(arrays), settle), "settled")
    windows = settled.filter(F.col("kind") == CHUNK).select("chunk", "a", "b", "c").mapInArrow(compare, ROWS)
    rest = _with_answers(settled, _exchange(windows), finish)
    out = [F.col("doc_id").alias(key), "n_bytes", "n_removed", "n_spans", F.col("sha").alias("kept_sha256")]
    return settled.filter(F.col("kind") == RESULT).select(*out).unionByName(rest.select(*out))
