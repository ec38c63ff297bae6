"""Token ids as binary shards with a minimal perfect hash index.

Documents are dealt by ranges of their id (ties spread by a text hash) and
sorted; each task tokenizes its rows and writes one shard file:

    payload   raw ids, ``width`` bytes each (2 while the vocabulary allows it)
    keys      signed 64-bit id of each stored row, ascending (0 for null ids)
    offsets   rows + 1 unsigned 64-bit positions into the payload, in ids
    bits      the hash levels: packed bit arrays, one after another
    slots     per distinct key: 32-bit fingerprint, first row, number of rows
    header    JSON (counts, width, level sizes), then its length in 8 bytes

The index is a cascade of bit arrays: a level keeps the keys that hash alone,
the others go to the next, smaller level; a key's slot is the rank of its bit.
A lookup therefore reads one bit in about two levels, compares the stored
fingerprint and has the row's range of ids: constant time, without the keys.

A shard is written under a temporary name and renamed, so a lost or repeated
task leaves a whole file or none.  Defined results: null texts are empty (only
the end id); repeated ids keep all their rows, in the order of a text hash, and
share one slot; null ids come first and are found by ``NULL_KEY``; empty tables
give no rows; other columns are not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_folder, shuffle_partitions
from .token_cache import blocks, encoder, forget

NULL_KEY = None
GAMMA = 2.0
READ_BYTES = 4_000_000
MANIFEST = "shard int, path string, n_rows long, n_ids long"


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of 64-bit values for each seed (splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys onto 0 .. n - 1."""

    def __init__(self, levels: list[np.ndarray]) -> None:
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            counts = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(counts + before - 1)
            before += int(counts[-1]) if len(counts) else 0

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels, left = [], keys.astype(np.uint64)
        while len(left):
            at = (mix(left, len(levels)) % np.uint64(max(1, int(GAMMA * len(left))))).astype(np.int64)
            hits = np.bincount(at, minlength=max(1, int(GAMMA * len(left))))
            levels.append(hits == 1)
            left = left[hits[at] > 1]
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where no level has its bit."""
        out, open_, left = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys.astype(np.uint64)
        for i, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mix(left, i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = ranks[at[hit]]
            open_, left = open_[~hit], left[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1 << 20) >> np.uint64(32)).astype("<u4")


def _open(folder: str):
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    return pafs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder)


class ShardWriter:
    def __init__(self, folder: str, shard: int, width: int) -> None:
        self.fs, base = _open(folder)
        self.fs.create_dir(base, recursive=True)
        self.final = f"{base}/shard-{shard:06d}.ids"
        self.temp = f"{base}/.shard-{shard:06d}-{uuid.uuid4().hex}"
        self.out, self.width = self.fs.open_output_stream(self.temp), width
        self.keys: list[int] = []
        self.counts: list[int] = []
        self.nulls = 0

    def add(self, key: int | None, payload: bytes) -> None:
        ids = np.frombuffer(payload, "<u4")
        if self.width == 2 and len(ids) and int(ids.max()) > 0xFFFF:
            raise ValueError("an id does not fit into 2 bytes")
        self.out.write(ids.astype("<u2").tobytes() if self.width == 2 else payload)
        self.nulls += key is None
        self.keys.append(0 if key is None else key)
        self.counts.append(len(ids))

    def close(self) -> tuple[int, int]:
        keys = np.array(self.keys, "<i8")
        offsets = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)]).astype("<u8")
        distinct, first, repeats = np.unique(keys[self.nulls:], return_index=True, return_counts=True)
        table = PerfectHash.build(distinct.view(np.uint64))
        at = table.slots(distinct.view(np.uint64))
        slots = np.zeros(len(distinct), np.dtype([("print", "<u4"), ("row", "<u4"), ("rows", "<u4")]))
        slots["print"][at] = fingerprint(distinct.view(np.uint64))
        slots["row"][at], slots["rows"][at] = first + self.nulls, repeats
        for part in (keys, offsets, *[np.packbits(x) for x in table.levels], slots):
            self.out.write(part.tobytes())
        head = json.dumps({"rows": len(keys), "nulls": self.nulls, "ids": int(offsets[-1]), "width": self.width,
                           "levels": [len(x) for x in table.levels], "slots": len(slots)}).encode()
        self.out.write(head + len(head).to_bytes(8, "little"))
        self.out.close()
        self.fs.move(self.temp, self.final)
        return len(keys), int(offsets[-1])


class Shard:
    """One shard file: its index in memory, its payload read on demand."""

    def __init__(self, path: str) -> None:
        fs, base = _open(path)
        self.file = fs.open_input_file(base)
        size = self.file.size()
        n = int.from_bytes(self.file.read_at(8, size - 8), "little")
        h = self.head = json.loads(self.file.read_at(n, size - 8 - n))
        at = h["ids"] * h["width"]
        tail = self.file.read_at(size - 8 - n - at, at)
        pos = 0

        def take(kind, count):
            nonlocal pos
            got = np.frombuffer(tail, kind, count, pos)
            pos += got.nbytes
            return got

        self.keys, self.offsets = take("<i8", h["rows"]), take("<u8", h["rows"] + 1).astype(np.int64)
        self.table = PerfectHash([np.unpackbits(take("u1", -(-m // 8)), count=m).astype(bool) for m in h["levels"]])
        self.slots = take(np.dtype([("print", "<u4"), ("row", "<u4"), ("rows", "<u4")]), h["slots"])

    def rows_of(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key (0 rows: not stored)."""
        asked = keys.astype(np.int64).view(np.uint64)
        at = self.table.slots(asked)
        found = at >= 0
        if len(self.slots):
            found &= self.slots["print"][at] == fingerprint(asked)
            return np.where(found, self.slots["row"][at], 0), np.where(found, self.slots["rows"][at], 0)
        return np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)

    def ids(self, row: int, end: int) -> np.ndarray:
        """Ids of rows row .. end - 1 as unsigned 32-bit integers."""
        w, a, b = self.head["width"], int(self.offsets[row]), int(self.offsets[end])
        return np.frombuffer(self.file.read_at((b - a) * w, a * w), f"<u{w}").astype("<u4")


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id",
                 text: str = "text", cut: str = "spaced", width: int = 2, shards: int | None = None) -> list:
    """Tokenize and write; returns the manifest rows, in shard order (one a
    shard, so bounded by the number of tasks)."""
    n = shards or shuffle_partitions(docs.sparkSession)
    rows = (docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
            .withColumn("tie", F.xxhash64("text"))
            .repartitionByRange(n, "key", "tie").sortWithinPartitions("key", "tie", "text")
            .select("key", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, out, enc = TaskContext.get().partitionId(), None, encoder(tokenizer, cut)
        try:
            for batch in batches:
                keys, texts = batch.column(0).to_pylist(), batch.column(1)
                for start, some in blocks(texts):
                    out = out or ShardWriter(folder, shard, width)
                    for k, payload in zip(keys[start:], enc.payloads(some)):
                        out.add(k, payload + end)
        finally:
            forget()
        if out:
            n_rows, n_ids = out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([f"{folder}/shard-{shard:06d}.ids"]),
                 pa.array([n_rows], pa.int64()), pa.array([n_ids], pa.int64())],
                names=["shard", "path", "n_rows", "n_ids"])

    return sorted(rows.mapInArrow(write, MANIFEST).collect())


def read_shards(spark: SparkSession, manifest: list, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of every stored row, each found by its key
    through the shard's hash index; ``start`` counts the ids of all rows before.
    ``ids`` is a little-endian unsigned 32-bit payload."""
    plan, start = [], 0
    for m in manifest:
        plan.append((m["path"], start))
        start += m["n_ids"]
    files = spark.createDataFrame(plan, "path string, base long").repartition(max(1, len(plan)), "path")
    schema = f"`{key}` long, start long, n_tokens long, ids binary"
    names = [key, "start", "n_tokens", "ids"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*[c.to_pylist() for c in batch.columns]):
                shard = Shard(path)
                nulls, rows = shard.head["nulls"], shard.head["rows"]
                first, many = shard.rows_of(shard.keys[nulls:])
                same = np.arange(nulls, rows) - first  # 0, 1, .. among the rows of a key
                if ((many < 1) | (same < 0) | (same >= many)).any():
                    raise ValueError(f"{path}: the index does not lead back to its rows")
                row = 0
                while row < rows:
                    end = max(row + 1, int(np.searchsorted(
                        shard.offsets, shard.offsets[row] + READ_BYTES // 4, "right")) - 1)
                    ids, lo = shard.ids(row, end), int(shard.offsets[row])
                    a, b = shard.offsets[row:end], shard.offsets[row + 1:end + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if r < nulls else int(shard.keys[r]) for r in range(row, end)], pa.int64()),
                         pa.array(a + base, pa.int64()), pa.array(b - a, pa.int64()),
                         pa.array([ids[x - lo:y - lo].tobytes() for x, y in zip(a, b)], pa.binary())], names=names)
                    row = end

    return files.mapInArrow(read, schema)


def tokenize_to_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, **how) -> DataFrame:
    """Write shards of ``docs`` and return their rows read back."""
    spark = docs.sparkSession
    manifest = write_shards(docs, folder or fresh_folder(spark, "ids"), tokenizer, end_id, **how)
    return read_shards(spark, manifest, how.get("key", "doc_id"))
