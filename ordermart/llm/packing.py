"""Harmonic packing of tokenized documents into sequences of ``capacity`` ids.

A piece of length x belongs to class j = floor(capacity / x); a bin of class j
takes exactly j pieces, whatever their lengths, so bins are filled one after
another without looking at what else is there, and each worker fills its own.

Cuts keep the padding small: a document first gives full sequences, then a
piece that would waste over 1/``tolerance`` of its class's share is cut at the
largest share of the next class.  At most j - 1 pieces a class are left over
in a worker; these meet by class in groups of ``FAN`` workers, and again, until
one group is left.  What remains then is under j pieces a class, whatever the
input, and is laid together first-fit by one task.

Defined results: a null text is empty and gives one piece with the end id;
repeated rows are packed as often as they occur; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .token_cache import blocks, encoder, forget

CAPACITY = 2048
TOLERANCE = 16
FAN = 256
PIECES = ("doc_id long, start long, length long, doc_tokens long, ids binary, "
          "bin_class int, worker long, sequence_id long, offset long, closed boolean")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
                    ("ids", pa.binary()), ("bin_class", pa.int32()), ("worker", pa.int64()),
                    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("closed", pa.bool_())])
OUT_ROWS = 2000


def cut_lengths(n: int, capacity: int = CAPACITY, tolerance: int = TOLERANCE) -> list[int]:
    """Lengths of the pieces of a document of ``n`` ids, in order."""
    out = [capacity] * (n // capacity)
    left = n % capacity
    while left:
        share = capacity // (capacity // left)
        if (share - left) * tolerance <= share:
            out.append(left)
            break
        part = capacity // (capacity // left + 1)
        out.append(part)
        left -= part
    return out


class Filler:
    """Open bins of one task; ``add`` returns rows of bins that got full.
    ``group`` is the group of workers whose pieces are being laid."""

    def __init__(self, task: int, level: int, capacity: int, group: int) -> None:
        self.group, self.capacity = group, capacity
        self.next_id = (level << 56) | (task << 32)
        self.open: dict[int, list[tuple]] = {}

    def _placed(self, rows: list[tuple], closed: bool) -> list[tuple]:
        at, out = 0, []
        for r in rows:
            out.append((*r, self.group, self.next_id, at, closed))
            at += r[2]
        self.next_id += 1
        return out

    def add(self, row: tuple) -> list[tuple]:
        """``row``: doc_id, start, length, doc_tokens, ids, bin_class."""
        held = self.open.setdefault(row[5], [])
        held.append(row)
        if len(held) < row[5]:
            return []
        del self.open[row[5]]
        return self._placed(held, True)

    def rest(self) -> list[tuple]:
        """Rows of the bins that did not get full; none stays open."""
        left, self.open = self.open, {}
        return [x for j in sorted(left) for x in self._placed(left[j], False)]

    def first_fit(self) -> list[tuple]:
        """The pieces left over, longest first, each into the first bin with room."""
        bins: list[list] = []
        for r in sorted((r for rows in self.open.values() for r in rows), key=lambda r: (-r[2], r[0] or 0, r[1])):
            found = next((b for b in bins if b[0] >= r[2]), None)
            if found is None:
                bins.append(found := [self.capacity, []])
            found[0] -= r[2]
            found[1].append(r)
        return [x for _, rows in bins for x in self._placed(rows, True)]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), SCHEMA.types)], schema=SCHEMA)


def _sent(groups: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for rows in groups:
        held += rows
        if len(held) >= OUT_ROWS:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _pieces_of(docs: DataFrame, tokenizer: str, end_id: int, key: str, text: str, cut: str,
               capacity: int, tolerance: int) -> DataFrame:
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, bins = encoder(tokenizer, cut), Filler(TaskContext.get().partitionId(), 0, capacity, TaskContext.get().partitionId())

        def filled() -> Iterator[list[tuple]]:
            try:
                for batch in batches:
                    keys, texts = batch.column(0).to_pylist(), batch.column(1)
                    for first, some in blocks(texts):
                        for k, payload in zip(keys[first:], enc.payloads(some)):
                            payload += end
                            n, at = len(payload) // 4, 0
                            for size in cut_lengths(n, capacity, tolerance):
                                yield bins.add((k, at, size, n, payload[4 * at:4 * (at + size)], capacity // size))
                                at += size
            finally:
                forget()
            yield bins.rest()

        return _sent(filled())

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, PIECES)


def _refill(left: DataFrame, level: int, capacity: int) -> DataFrame:
    """Bins of left-over pieces, by class in groups of ``FAN`` workers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Filler(TaskContext.get().partitionId(), level, capacity, -1)

        def filled() -> Iterator[list[tuple]]:
            for batch in batches:
                for r in zip(*[c.to_pylist() for c in batch.columns]):
                    if r[6] != bins.group:  # the next group starts with empty bins
                        yield bins.rest()
                        bins.group = r[6]
                    yield bins.add(r[:6])
            yield bins.rest()

        return _sent(filled())

    rows = left.withColumn("worker", F.floor(F.col("worker") / F.lit(FAN)).cast("long"))
    keys = ["worker", "bin_class"]
    return (rows.repartition(*keys).sortWithinPartitions(*keys, F.desc("length"), "doc_id", "start")
            .mapInArrow(work, PIECES))


def pack(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text",
         cut: str = "words", capacity: int = CAPACITY, tolerance: int = TOLERANCE) -> DataFrame:
    """One row a piece: its ids (little-endian unsigned 32-bit), document and
    place (``sequence_id``, ``offset``).  Pieces are written once to the shared
    folder; only the left-over ones are dealt again."""
    pieces = _pieces_of(docs, tokenizer, end_id, key, text, cut, capacity, tolerance)
    pieces = stage(pieces, "pieces")
    done, left, level = [pieces.filter("closed")], pieces.filter(~F.col("closed")), 1
    workers = (left.agg(F.max("worker")).first()[0] or 0) + 1
    while True:
        workers = -(-workers // FAN)
        again = stage(_refill(left, level, capacity), f"pieces-{level}")
        done.append(again.filter("closed"))
        left, level = again.filter(~F.col("closed")), level + 1
        if workers == 1:
            break

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Filler(0, level, capacity, 0)
        for batch in batches:
            for r in zip(*[c.to_pylist() for c in batch.columns]):
                bins.open.setdefault(r[5], []).append(r[:6])
        return _sent(iter([bins.first_fit()]))

    # under j pieces of each class j are left (classes are floor(capacity / x))
    done.append(left.coalesce(1).mapInArrow(finish, PIECES))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out.select(F.col("doc_id").alias(key), "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
