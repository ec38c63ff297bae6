"""Ranked lexical search by dense blocked matrix products.

Terms are the maximal runs of ASCII letters and digits and of characters beyond
ASCII, A-Z lower-cased.  The score of a document for an item sums, over the item's
terms with repeats, weight * impact, all in integers (see ``weight``, ``impacts``).

1. Blocks.  Every text is cut into terms once; a block of documents keeps, of the
   items' vocabulary only, the term numbers and counts (a sparse matrix), with
   the documents' lengths.  Counts of documents and terms are summed by Spark.
2. Tiles.  Items are laid into tiles, each with its own compact vocabulary: a
   dense matrix of weights (terms x items).  A tile of documents becomes a dense
   matrix of impacts (documents x terms) and one BLAS product in float64 gives all
   scores of the tile.  The terms of a tile are cut so that no partial sum can
   reach 2 ** 53: every product and sum is an exact integer; slices are added as
   64-bit integers.
3. Top k.  A task keeps the best k of each item, ties by the smaller id, and
   passes on only these; a window merges the tasks' lists.

Items are taken in batches of about ``BATCH_CHARS`` characters, whose vocabulary
goes to all tasks; each batch reads all documents.  A task holds one block, one
tile and k rows an item of the batch.

Defined results: a null or empty text has no terms; an item without terms, or
without an id, gets no rows; a document without an id counts in all statistics
but is not ranked; repeated rows of documents each take a rank, repeated rows of
items are one item; empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .token_cache import blocks

BATCH_CHARS, BLOCK_CHARS = 1_000_000, 1_000_000
TILE_ITEMS, TILE_TERMS, TILE_CELLS = 64, 4096, 1 << 20
EXACT = 2 ** 53
FULL_IMPACT = 1_000_000  # no impact is larger
_TERM_BYTES = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256)).lower()
BLOCK = ("kind int, term int, n long, docs long, ids binary, lengths binary, rows binary, terms binary, counts binary")
FOUND = "item int, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    """The terms of a whole text, in order."""
    return text.encode("utf-8", "replace").translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(length: int, n_docs: int, all_terms: int) -> int:
    """What the length of a document adds below its impacts."""
    return 100 - 25 + (25 * length * n_docs) // all_terms


def impacts(counts: np.ndarray, damp: np.ndarray) -> np.ndarray:
    """Impacts of terms by their counts and their documents' damping."""
    return (1_000_000_000 * counts) // (1000 * counts + 12 * damp)


@dataclass
class Tile:
    """Some items with the vocabulary they need."""

    items: np.ndarray  # numbers of the items
    terms: np.ndarray  # numbers of the terms, ascending
    weights: np.ndarray  # terms x items, float64 integers
    slices: list[int]  # bounds of runs of terms whose sums stay exact

    def scores(self, dense: np.ndarray) -> np.ndarray:
        """documents x items, from impacts (documents x terms)."""
        out = np.zeros((len(dense), len(self.items)), np.int64)
        for a, b in zip(self.slices[:-1], self.slices[1:]):
            out += (dense[:, a:b] @ self.weights[a:b]).astype(np.int64)
        return out


def exact_slices(weights: np.ndarray, largest: int = FULL_IMPACT, limit: int = EXACT) -> list[int]:
    """Bounds of the runs of terms in which no item's sum can reach ``limit``."""
    bounds, total = [0], np.zeros(weights.shape[1])
    for i, row in enumerate(weights):
        if (row * largest >= limit).any():
            raise ValueError("one term alone passes the exact range of float64")
        if (total + row * largest >= limit).any():
            bounds.append(i)
            total[:] = 0
        total += row * largest
    return [*bounds, len(weights)]


def tiles_of(items: list[Counter], weights: np.ndarray) -> list[Tile]:
    """Tiles of items (counters of term numbers) in order."""
    groups: list[tuple[list[int], set[int]]] = []
    for i, terms in enumerate(items):
        if not terms:
            continue
        if not groups or len(groups[-1][0]) >= TILE_ITEMS or len(groups[-1][1] | terms.keys()) > TILE_TERMS:
            groups.append(([], set()))
        groups[-1][0].append(i)
        groups[-1][1].update(terms)
    out = []
    for rows, used in groups:
        terms = np.array(sorted(used), np.int64)
        at = {t: k for k, t in enumerate(terms.tolist())}
        matrix = np.zeros((len(terms), len(rows)))
        for j, i in enumerate(rows):
            for t, times in items[i].items():
                matrix[at[t], j] = times * int(weights[t])
        out.append(Tile(np.array(rows), terms, matrix, exact_slices(matrix)))
    return out


class Best:
    """The best ``k`` (score, id) of each item, ties to the smaller id."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.floor = np.ones(n_items, np.int64)  # a lower score cannot get in
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, items: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        for j in np.flatnonzero((scores >= self.floor[items]).any(0)):
            item = int(items[j])
            rows = np.flatnonzero(scores[:, j] >= self.floor[item])
            s, d = scores[rows, j], ids[rows]
            if item in self.held:
                s, d = np.concatenate([self.held[item][0], s]), np.concatenate([self.held[item][1], d])
            order = np.lexsort((d, -s))[:self.k]
            self.held[item] = s[order], d[order]
            if len(order) == self.k:
                self.floor[item] = s[order[-1]]

    def rows(self) -> pa.RecordBatch:
        items = np.concatenate([np.full(len(s), i, np.int32) for i, (s, _) in self.held.items()])
        return pa.RecordBatch.from_arrays(
            [pa.array(items), pa.array(np.concatenate([d for _, d in self.held.values()])),
             pa.array(np.concatenate([s for s, _ in self.held.values()]))], names=["item", "doc_id", "score"])


def _counted(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str) -> DataFrame:
    """Blocks (kind 0) and, of each task, how many documents hold a term (1)."""
    names = [c.split()[0] for c in BLOCK.split(", ")]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 5]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, df = vocabulary.get, np.zeros(len(vocabulary), np.int64)
        for b in batches:
            for start, some in blocks(b.column(1), BLOCK_CHARS):
                lengths, found, rows = np.zeros(len(some), np.int64), [], []
                for i, t in enumerate(some):
                    terms = terms_of(t)
                    lengths[i] = len(terms)
                    known = [x for x in map(get, terms) if x is not None]
                    found.append(np.array(known, np.int64))
                    rows.append(len(known))
                cells = np.repeat(np.arange(len(some)), rows) * len(vocabulary) + np.concatenate(found)
                cells, counts = np.unique(cells, return_counts=True)
                row, term = np.divmod(cells, max(1, len(vocabulary)))
                df += np.bincount(term, minlength=len(df))
                ids = b.column(0).slice(start, len(some))
                told = ids.is_valid().to_numpy(zero_copy_only=False)
                keys = np.array([x or 0 for x in ids.to_pylist()], np.int64)
                # documents without an id are counted, not ranked
                mine = told[row]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((
                    0, None, int(lengths.sum()), int((lengths > 0).sum()), keys.tobytes(), lengths.tobytes(),
                    row[mine].astype(np.int32).tobytes(), term[mine].astype(np.int32).tobytes(),
                    counts[mine].astype(np.int64).tobytes()), types)], names=names)
        at = np.flatnonzero(df)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(at), np.int32)), pa.array(at.astype(np.int32)), pa.array(df[at]),
                 *[pa.nulls(len(at), t) for t in types[3:]]], names=names)

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(work, BLOCK)


def _best(counted: DataFrame, tiles: list[Tile], n_terms: int, n_items: int, n_docs: int, all_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best of every item."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k)
        place = np.full(n_terms, -1, np.int64)
        for b in batches:
            for ids, lengths, rows, terms, counts in zip(*[c.to_pylist() for c in b.columns]):
                ids, lengths, counts = (np.frombuffer(x, np.int64) for x in (ids, lengths, counts))
                rows, terms = (np.frombuffer(x, np.int32) for x in (rows, terms))
                damp = np.array([damping(n, n_docs, all_terms) for n in lengths.tolist()], np.int64)
                impact = impacts(counts, damp[rows]).astype(float)
                for tile in tiles:
                    place[tile.terms] = np.arange(len(tile.terms))
                    column = place[terms]
                    place[tile.terms] = -1
                    use = np.flatnonzero(column >= 0)
                    high = max(16, TILE_CELLS // len(tile.terms))
                    for a in range(0, len(ids), high):
                        lo, hi = np.searchsorted(rows[use], [a, a + high])
                        if lo == hi:
                            continue
                        cells = use[lo:hi]
                        dense = np.zeros((min(high, len(ids) - a), len(tile.terms)))
                        dense[rows[cells] - a, column[cells]] = impact[cells]
                        best.add(tile.items, tile.scores(dense), ids[a:a + high])
        if best.held:
            yield best.rows()

    return counted.filter("kind = 0").select("ids", "lengths", "rows", "terms", "counts").mapInArrow(work, FOUND)


def _ranked(docs: DataFrame, items: list[tuple[int, str]], k: int, key: str, text: str) -> DataFrame:
    """Ranks for one batch of items."""
    spark = docs.sparkSession
    said = [Counter(terms_of(t)) for _, t in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*said)))}
    counted = stage(_counted(docs, vocabulary, key, text), "term-blocks")
    n_docs, all_terms = counted.filter("kind = 0").agg(
        F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = {r["term"]: r["df"] for r in counted.filter("kind = 1").groupBy("term").agg(F.sum("n").alias("df")).collect()}
    weights = np.array([weight(n_docs, df.get(i, 0)) for i in range(len(vocabulary))], np.int64)
    # a term that no document holds adds nothing
    tiles = tiles_of([Counter({vocabulary[t]: n for t, n in c.items() if vocabulary[t] in df}) for c in said], weights)
    named = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(items)], "item int, item_id long")
    best = _best(counted, tiles, len(vocabulary), len(items), n_docs, all_terms, k)
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))


def rank(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text",
         item_key: str = "item_id", item_text: str = "text", batch_chars: int = BATCH_CHARS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    asked = (items.select(F.col(item_key).cast("long").alias("id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
             .filter(F.col("id").isNotNull()).distinct())
    chars = asked.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    batches = max(1, -(-chars // batch_chars))
    out = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for i in range(batches):
        mine = asked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(batches)) == i)
        some = sorted((r["id"], r["text"]) for r in mine.collect())
        if any(terms_of(t) for _, t in some):
            out = out.unionByName(stage(_ranked(docs, some, k, key, text), "ranked"))
    return out
