"""Near-duplicate documents by HyperMinHash sketches and exact confirmation.

The threshold, with the bands and the margin fitted to it, is a ``Likeness``.

1. Sketch.  A text's shingle hashes fall into ``registers`` buckets; a register
   keeps of its bucket's smallest value the number of leading zeros and
   ``MANTISSA`` bits after them.  Empty buckets borrow from a full one chosen by
   a fixed random order, alike in all texts.
2. Classes.  Texts with equal shingle sets are one class from here on.
3. Bands.  ``bands`` groups of ``rows`` registers are hashed.  Classes that share
   a band are joined to the band's smallest; the components of these joins are
   the clusters.  A pair at the threshold shares no band with a probability of
   (1 - threshold ** rows) ** bands: 2e-7 for ``AT_85``, 3e-7 for ``AT_80``.
4. Blocks.  A cluster is cut into blocks of a bounded number of classes and
   shingles, each pair of blocks is one unit of work.  There, the collision-corrected
   Jaccard estimate of the registers rules out what is ``margin`` below the
   threshold, and the links of the rest are confirmed on the full sets.  Only a
   star of each linked group leaves the task, never its pairs.
5. The components of these stars are the groups.

Work in a cluster grows with the square of its blocks; nothing is capped.
Repeated rows are dealt once.

Defined results: null and empty texts, and texts without words, have an empty
set and are linked with nothing; rows without an id have no component and are
kept; rows with the same id count as one document; repeated rows repeat their
result; an empty table gives no rows; ties do not matter (the smallest id stands
for a group).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unused_name
from .components import components
from .shingles import mix, shingle_sets
from .token_cache import blocks

MANTISSA, SEED = 10, 11
BLOCK_SHINGLES, BLOCK_CLASSES = 600_000, 768
BROADCAST_ROWS = 500_000
BLOCK_CHARS = 250_000  # of texts hashed at once


class Likeness(NamedTuple):
    """Linked: 100 * intersection >= percent * union."""

    percent: int
    bands: int
    rows: int
    margin: float

    @property
    def registers(self) -> int:
        return self.bands * self.rows


AT_85 = Likeness(85, bands=40, rows=7, margin=0.2)
AT_80 = Likeness(80, bands=50, rows=6, margin=0.2)


@lru_cache
def _tables(registers: int) -> tuple[np.ndarray, np.ndarray]:
    """Random orders in which empty registers borrow; factors of the bands."""
    rng = np.random.default_rng(SEED)
    order = rng.permuted(np.tile(np.arange(registers, dtype=np.int16), (registers, 1)), axis=1)
    return order, rng.integers(1, 2**63, registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(hashes: np.ndarray, like: Likeness = AT_85) -> np.ndarray:
    """Registers of a set of sorted 64-bit hashes (not empty)."""
    n = like.registers
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    low = np.minimum.reduceat(mix(hashes), first)
    zeros = np.clip(64 - np.frexp(low.astype(float))[1], 0, 62).astype(np.uint64)
    code = (zeros << np.uint64(MANTISSA)) | ((low << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA))
    out, full = np.zeros(n, np.uint16), bucket[first]
    out[full] = code
    if len(full) < n:
        empty = np.setdiff1d(np.arange(n), full, assume_unique=True)
        out[empty] = out[full[_tables(n)[0][np.ix_(empty, full)].argmin(1)]]
    return out


def band_keys(sketches: np.ndarray, like: Likeness = AT_85) -> np.ndarray:
    """One 64-bit key for each band of each sketch."""
    with np.errstate(over="ignore"):
        sums = (sketches.astype(np.uint64) + np.uint64(1)) * _tables(like.registers)[1]
        sums = sums.reshape(len(sketches), like.bands, like.rows).sum(2)
        return mix(sums + np.arange(like.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def collision_rate(n: float, m: float, registers: int) -> float:
    """Probability that a register of two disjoint sets of n and m is equal."""
    a, b = max(1.0, n / registers), max(1.0, m / registers)
    steps = np.arange(2 ** MANTISSA + 1) / 2 ** MANTISSA
    edges = np.exp2(-np.arange(1, 63))[:, None] * (1 + steps)
    inside = lambda k: (1 - edges[:, :-1]) ** k - (1 - edges[:, 1:]) ** k
    return float((inside(a) * inside(b)).sum())


_rates: dict[tuple[int, int, int], float] = {}


def estimated_jaccard(sketches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Jaccard estimates of all pairs of a block, corrected for collisions."""
    registers = sketches.shape[1]
    equal = np.stack([(sketches == s).sum(1) for s in sketches]) / registers
    code = np.round(2 * np.log2(np.maximum(sizes, 1))).astype(int)
    kinds = np.unique(code)
    rate = np.zeros((len(kinds), len(kinds)))
    for i, x in enumerate(kinds.tolist()):
        for j, y in enumerate(kinds.tolist()):
            if (x, y, registers) not in _rates:
                _rates[x, y, registers] = collision_rate(2 ** (x / 2), 2 ** (y / 2), registers)
            rate[i, j] = _rates[x, y, registers]
    at = np.searchsorted(kinds, code)
    expected = rate[np.ix_(at, at)]
    return (equal - expected) / (1 - expected)


def groups_of(linked: np.ndarray) -> np.ndarray:
    """Component number of each row of a symmetric boolean matrix."""
    label = np.arange(len(linked))
    while True:
        low = np.where(linked, label, len(linked)).min(1)
        low = np.minimum(low, label)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the pairwise intersections of some sets."""
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(values, return_inverse=True, return_counts=True)
    shared = times[at] > 1
    owner, at = owner[shared], at[shared]
    column = (np.cumsum(times > 1) - 1)[at]
    out, width = np.zeros((len(sets), len(sets))), 4096
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        have = np.zeros((len(sets), width), np.float32)
        have[owner[lo:hi], column[lo:hi] - a] = 1
        out += have @ have.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out.astype(np.int64)


def linked_stars(ids: np.ndarray, sets: list[np.ndarray], sketches: np.ndarray,
                 like: Likeness = AT_85) -> list[tuple[int, int]]:
    """(id, smallest id) of the linked groups of a block."""
    sizes = np.array([len(s) for s in sets])
    out = []
    likely = groups_of(estimated_jaccard(sketches, sizes) >= like.percent / 100 - like.margin)
    for g in np.flatnonzero(np.bincount(likely) > 1):
        rows = np.flatnonzero(likely == g)
        both = intersections([sets[i] for i in rows])
        union = sizes[rows][:, None] + sizes[rows][None, :] - both
        label = groups_of(100 * both >= like.percent * union)
        for x in np.flatnonzero(np.bincount(label) > 1):
            some = ids[rows[label == x]]
            out += [(int(i), int(some.min())) for i in some if i != some.min()]
    return out


def sketched(docs: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness = AT_85) -> DataFrame:
    """(id, n_shingles, digest of the set, band keys); digest null: empty."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, texts in blocks(b.column(1), BLOCK_CHARS):
                sets = shingle_sets(texts)
                full = [s for s in sets if len(s)]
                bands = iter(band_keys(np.stack([sketch(s, like) for s in full]), like).tolist() if full else [])
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(start, len(texts)), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                             pa.binary()),
                    pa.array([next(bands) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                    names=["id", "n_shingles", "digest", "bands"])

    return docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInArrow(
        work, "id long, n_shingles long, digest binary, bands array<long>")


def _bounded(df: DataFrame) -> DataFrame:
    """Hint a broadcast where a count shows that ``df`` is small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _clusters(classes: DataFrame) -> DataFrame:
    """(id, cluster) of classes that share a band with another class."""
    rows = classes.select("id", F.explode("bands").alias("band"))
    met = rows.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    glue = rows.join(met.select("band", "low"), "band").filter("id <> low").select("id", "low").distinct()
    return components(glue).select(F.col("node").alias("id"), F.col("root").alias("cluster"))


def _member_sets(docs: DataFrame, rows: DataFrame, classes: DataFrame, clusters: DataFrame, key: str, text: str,
                 like: Likeness) -> DataFrame:
    """(id, cluster, blocks, digest, hashes, sketch), once for each member class."""
    members = clusters.join(classes.select("id", "digest", "n_shingles"), "id")
    sizes = members.groupBy("cluster").agg(F.greatest(
        F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_CLASSES)).cast("int").alias("blocks"))
    twice = stage(rows.filter("digest is not null and id is not null").groupBy("id", "digest").count()
                  .filter("count > 1").select("id", "digest", F.lit(True).alias("again")), "repeated")
    members = stage(members.join(sizes, "cluster").join(twice, ["id", "digest"], "left")
                    .select("id", "cluster", "blocks", "digest", F.coalesce("again", F.lit(False)).alias("again")), "members")
    texts = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text")).join(_bounded(members), "id")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            digests = b.column(4).to_pylist()
            for start, some in blocks(b.column(1), BLOCK_CHARS):
                found = shingle_sets(some)
                # a repeated id may come with another text: not this class
                rows = [i for i, s in enumerate(found) if len(s)
                        and hashlib.blake2b(s.tobytes(), digest_size=16).digest() == digests[start + i]]
                take = pa.array([start + i for i in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([
                    *[b.column(c).take(take) for c in (0, 2, 3, 4)],
                    pa.array([found[i].tobytes() for i in rows], pa.binary()),
                    pa.array([sketch(found[i], like).tobytes() for i in rows], pa.binary())],
                    names=["id", "cluster", "blocks", "digest", "hashes", "sketch"])

    def whole(some: DataFrame) -> DataFrame:
        return some.select("id", "text", "cluster", "blocks", "digest").mapInArrow(
            sets, "id long, cluster long, blocks int, digest binary, hashes binary, sketch binary")

    if twice.isEmpty():
        return whole(texts)
    # repeated rows: one of them stands for the class
    return whole(texts.filter("not again")).unionByName(whole(texts.filter("again")).dropDuplicates(["id", "digest"]))


def _links(whole: DataFrame, like: Likeness) -> DataFrame:
    """Stars of confirmed links: (id, low)."""
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (whole.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("cluster", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                     "id", "hashes", "sketch"))
    unit = ["cluster", "x", "y"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def sent() -> Iterator[pa.RecordBatch]:
            found = linked_stars(np.array([r[0] for r in held]), [np.frombuffer(r[1], np.uint64) for r in held],
                                 np.stack([np.frombuffer(r[2], np.uint16) for r in held]), like) if len(held) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["id", "low"])

        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns]):
                if r[:3] != now:
                    yield from sent()
                    now, held = r[:3], []
                held.append(r[3:])
        yield from sent()

    return dealt.repartition(*unit).sortWithinPartitions(*unit).mapInArrow(compare, "id long, low long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness = AT_85) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row."""
    rows = stage(sketched(docs, key, text, like), "sketches")
    classes = stage(rows.filter("digest is not null and id is not null").groupBy("digest")
                    .agg(F.min("id").alias("id"), F.first("n_shingles").alias("n_shingles"),
                         F.first("bands").alias("bands")), "classes")
    clusters = _clusters(classes)
    groups = components(_links(_member_sets(docs, rows, classes, clusters, key, text, like), like))
    named = (classes.select("digest", F.col("id").alias("node")).join(groups, "node", "left")
             .select("digest", F.coalesce("root", "node").alias("component_id")))
    return (rows.select("id", "n_shingles", "digest").join(named, "digest", "left")
            .withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
            .select(F.col("id").alias(key), "n_shingles", "component_id",
                    F.col("id").eqNullSafe(F.col("component_id")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                         like: Likeness = AT_85) -> DataFrame:
    """``docs`` with one row of each group left, all columns as they are (any
    names may occur among them)."""
    mine = unused_name(docs, "near_id")
    found = stage(near_duplicates(docs, key, text, like).select(F.col(key).alias(mine), "kept"), "near")
    gone = found.filter(~F.col("kept")).select(mine).distinct()
    left = docs.join(_bounded(gone), docs[key] == F.col(mine), "left_anti")
    twice = stage(found.filter(F.col("kept") & F.col(mine).isNotNull()).groupBy(mine).count().filter("count > 1")
                  .select(mine), "twice")
    if twice.isEmpty():
        return left
    once = left.join(twice, left[key] == F.col(mine), "left_semi").dropDuplicates([key])
    return left.join(twice, left[key] == F.col(mine), "left_anti").unionByName(once)
