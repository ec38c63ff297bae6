"""Log-bilinear language model, trained with noise-contrastive estimation.

Units.  The most frequent ``N_WORDS`` tokens are units of their own; every
other word belongs to one of ``N_CLASSES`` units by its last letters.  The model
predicts the unit of a token from those before it:

    q = sum_j c_j * r[unit at distance j],   score(u) = q . t[u] + b[u]

and a matrix product over a batch, normalised over all units, gives the unit's
log-probability.  Within a unit a word has (count + 1) / mass, with one slot of
mass for unseen words, so the probabilities of all tokens add up to 1.

Learning.  Token counts are exact, over all training texts.  The vectors are
trained in numpy: the training texts are dealt by a hash of id and text into shards of
about ``SHARD_TOKENS`` tokens; a task walks over a shard in the order of that hash,
telling true units from noise units drawn by their frequency, and the shards'
parameters are averaged by tokens (first over a sixteenth, then over all).  So
the model depends on the texts, not on how the input is cut into files or tasks.
Fully equal rows share a shard.

Counts of the ``HEAD`` most frequent tokens go to the tasks (a fixed bound);
the others are joined: a text keeps its rare tokens, which meet their counts in
a shuffle by token and return as one sum a text.

Defined results: a null or empty text has one token, its end; repeated rows are
counted and scored as often as they occur; without any training text every
count is 0 and all units are equally likely a priori.  Other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .token_cache import blocks

N_WORDS, N_CLASSES, LAST_BYTES = 256, 128, 3
N_UNITS = N_WORDS + N_CLASSES
DIM, CONTEXT, NOISE, BATCH, FIRST_BATCH, RATE, SEED = 16, 3, 32, 4096, 256, 0.1, 1
HEAD, FLUSH = 200_000, 400_000
END = b""
SHARD_TOKENS = 2_000_000
SLICE = 16  # the first round learns from one in so many texts
BLOCK_CHARS = 400_000
ROWS = 256  # rows scored at a time: their scores stay in a core's cache
PARAMS = {"r": (N_UNITS + 1, DIM), "c": (CONTEXT, DIM), "t": (N_UNITS, DIM), "b": (N_UNITS,)}


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def words(text: str) -> list[bytes]:
    """Lower-cased (A-Z) words between ASCII white space, then the end."""
    return [*text.encode("utf-8", "replace").lower().split(), END]


def class_of(token: bytes) -> int:
    return zlib.crc32(token[-LAST_BYTES:]) % N_CLASSES


def count_tokens(train: DataFrame, text: str = "text") -> DataFrame:
    """(token, n) over all texts; counted in the tasks before the shuffle."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def sent() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                              pa.array(list(seen.values()), pa.int64())], names=["token", "n"])
            seen.clear()
            return out

        for b in batches:
            for _, texts in blocks(b.column(0), BLOCK_CHARS):
                for t in texts:
                    seen.update(words(t))
                if len(seen) > FLUSH:
                    yield sent()
        if seen:
            yield sent()

    return train.select(text).mapInArrow(work, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))


class Units:
    """Head tokens with their units and counts, and the mass of each class."""

    def __init__(self, head: list, totals: tuple[int, int], mass: dict[int, int]) -> None:
        self.n, self.v = totals
        self.at = {bytes(r["token"]): i for i, r in enumerate(head)}
        counts = np.array([r["n"] for r in head], float)
        own = np.arange(len(head)) < N_WORDS
        self.unit = np.array([i if i < N_WORDS else N_WORDS + class_of(bytes(r["token"]))
                              for i, r in enumerate(head)], np.int64)
        self.log_count = np.log10(counts + 1)
        masses = np.ones(N_UNITS)
        masses[:int(own.sum())] = counts[own] + 1
        for c, m in mass.items():
            masses[N_WORDS + c] = m + 1
        self.log_mass = np.log10(masses)
        self.prior = masses / masses.sum()

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        """Head index of each token, or -1 - class for the others."""
        out = np.fromiter(map(self.at.get, tokens, repeat(-1)), np.int64, len(tokens))
        others = np.flatnonzero(out < 0)
        out[others] = [-1 - class_of(tokens[i]) for i in others.tolist()]
        return out

    def units(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.unit):
            return N_WORDS - 1 - ids
        return np.where(ids >= 0, self.unit[np.maximum(ids, 0)], N_WORDS - 1 - ids)


def learn_units(counts: DataFrame) -> Units:
    """From staged counts: totals, the head and the mass of each class
    (``N_CLASSES`` rows).

    The head is cut between levels of the counts' logarithm (some hundred rows),
    so that at most ``HEAD`` tokens reach the driver, and no task sends more."""
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    level = F.floor(F.log2("n") * 16).cast("int")
    left, cut = HEAD, None
    for r in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        left -= r["count"]
        if left < 0:
            break
        cut = r["level"]
    head = counts.filter(level >= cut).collect() if cut is not None else []
    head.sort(key=lambda r: (-r["n"], bytes(r["token"])))
    last = F.when(F.octet_length("token") > LAST_BYTES, F.substring("token", -LAST_BYTES, LAST_BYTES))
    kind = F.crc32(F.coalesce(last, "token"))
    mass = {r["c"]: r["m"] for r in counts.groupBy((kind % N_CLASSES).cast("int").alias("c"))
            .agg(F.sum(F.col("n") + 1).alias("m")).collect()}
    for r in head[:N_WORDS]:
        mass[class_of(bytes(r["token"]))] -= r["n"] + 1
    return Units(head, (totals["n"] or 0, totals["v"]), mass)


def contexts(units: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Units at distance 1 .. CONTEXT before each token; ``N_UNITS`` before a
    text's first.  ``first``: index of the text's first token, for each token."""
    at = np.arange(len(units))
    out = np.full((CONTEXT, len(units)), N_UNITS, np.int64)
    for j in range(CONTEXT):
        ok = at - j - 1 >= first
        out[j, ok] = units[at[ok] - j - 1]
    return out


class Model:
    def __init__(self, params: dict[str, np.ndarray]) -> None:
        self.p = params

    @classmethod
    def initial(cls, units: Units) -> "Model":
        rng = np.random.default_rng(SEED)
        p = {k: (rng.normal(size=s) * 0.1).astype(np.float32) for k, s in PARAMS.items()}
        p["c"] = np.array([[1.0 / (j + 1)] * DIM for j in range(CONTEXT)], np.float32)
        p["b"] = np.log(units.prior).astype(np.float32)
        return cls(p)

    def predicted(self, ctx: np.ndarray) -> np.ndarray:
        q = self.p["r"][ctx[0]] * self.p["c"][0]
        for j in range(1, CONTEXT):
            q += self.p["r"][ctx[j]] * self.p["c"][j]
        return q

    def log_prob(self, units: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """Normalised natural log-probability of each unit in its context."""
        out, t = np.empty(len(units)), self.p["t"].T
        scores = np.empty((ROWS, N_UNITS), t.dtype)
        for a in range(0, len(units), ROWS):
            u = units[a:a + ROWS]
            s = np.matmul(self.predicted(ctx[:, a:a + ROWS]), t, out=scores[:len(u)])
            s += self.p["b"]
            top = s.max(1)
            own = s[np.arange(len(u)), u]
            s -= top[:, None]
            np.exp(s, out=s)
            out[a:a + ROWS] = own - top - np.log(s.sum(1))
        return out


class Trainer:
    """Noise-contrastive steps with Adagrad on a copy of a model's parameters."""

    def __init__(self, model: Model, prior: np.ndarray, seed: int) -> None:
        self.p = {k: v.copy() for k, v in model.p.items()}
        self.g2 = {k: np.full(v.shape, 1e-3, np.float32) for k, v in self.p.items()}
        self.rng, self.tokens, self.steps = np.random.default_rng(seed), 0, 0
        self.cum = np.cumsum(prior)
        self.log_noise = (np.log(prior) + np.log(NOISE)).astype(np.float32)

    def step(self, units: np.ndarray, ctx: np.ndarray) -> None:
        p, n = self.p, len(units)
        noise = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE) * self.cum[-1]), N_UNITS - 1)
        rows = [p["r"][ctx[j]] for j in range(CONTEXT)]
        q = sum(rows[j] * p["c"][j] for j in range(CONTEXT))
        true = (q * p["t"][units]).sum(1) + p["b"][units] - self.log_noise[units]
        false = q @ p["t"][noise].T + (p["b"][noise] - self.log_noise[noise])
        # gradient of the log-likelihood of "true" and "noise" labels
        up = 1 / (1 + np.exp(np.clip(true, -30, 30)))
        down = 1 / (1 + np.exp(np.clip(-false, -30, 30)))
        dq = up[:, None] * p["t"][units] - down @ p["t"][noise]
        by = lambda at, w, size: np.stack([np.bincount(at, w[:, d], size) for d in range(DIM)], 1)
        dt = by(units, up[:, None] * q, N_UNITS)
        np.add.at(dt, noise, -(down.T @ q))
        db = np.bincount(units, up, N_UNITS)
        np.add.at(db, noise, -down.sum(0))
        dc = np.stack([(dq * rows[j]).sum(0) for j in range(CONTEXT)])
        dr = sum(by(ctx[j], dq * p["c"][j], N_UNITS + 1) for j in range(CONTEXT))
        for k, g in (("r", dr), ("c", dc), ("t", dt), ("b", db)):
            g = (g / n).astype(np.float32)
            self.g2[k] += g * g
            p[k] += RATE * g / np.sqrt(self.g2[k])
        self.tokens += n
        self.steps += 1

    def walk(self, units: np.ndarray, ctx: np.ndarray) -> None:
        """Steps over a run of tokens; short ones at first, then ``BATCH``."""
        at = 0
        while at < len(units):
            end = at + min(BATCH, FIRST_BATCH * (1 + self.steps // 8))
            self.step(units[at:end], ctx[:, at:end])
            at = end


def _blocks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[list[bytes]], np.ndarray]]:
    """(first row, tokens of each text, first token index for each token)."""
    for start, texts in blocks(batch.column(column), BLOCK_CHARS):
        tokens = [words(t) for t in texts]
        sizes = np.array([len(t) for t in tokens])
        yield start, tokens, np.repeat(np.cumsum(sizes) - sizes, sizes)


def _dealt(train: DataFrame, shards: int, key: str, text: str) -> DataFrame:
    """The texts in shards, alike for any layout of the input."""
    at = F.xxhash64(F.col(key).cast("string"), F.col(text))
    return train.select(at.alias("at"), F.col(text).alias(text)).repartition(shards, "at").sortWithinPartitions("at")


def train_round(train: DataFrame, units: Units, model: Model, text: str = "text") -> Model:
    """One pass of every task over its texts; parameters averaged by tokens."""
    spark = train.sparkSession
    sent = spark.sparkContext.broadcast((units, model))  # head and parameters: fixed bounds
    sizes = {k: int(np.prod(s)) for k, s in PARAMS.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, start = sent.value
        trainer = Trainer(start, known.prior, SEED + TaskContext.get().partitionId())
        for b in batches:
            for _, tokens, first in _blocks(b, 0):
                u = known.units(known.ids([w for t in tokens for w in t]))
                trainer.walk(u, contexts(u, first))
        if trainer.tokens:
            flat = np.concatenate([trainer.p[k].ravel() for k in PARAMS]).astype(float) * trainer.tokens
            flat = np.append(flat, trainer.tokens)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat)],
                                             names=["at", "value"])

    rows = (train.select(text).mapInArrow(work, "at int, value double")
            .groupBy("at").agg(F.sum("value").alias("value")).collect())  # one row a parameter
    sent.destroy()
    if not rows:
        return model
    flat = np.zeros(len(rows))
    for r in rows:
        flat[r["at"]] = r["value"]
    flat, out, at = flat[:-1] / flat[-1], {}, 0
    for k, s in PARAMS.items():
        out[k] = flat[at:at + sizes[k]].reshape(s).astype(np.float32)
        at += sizes[k]
    return Model(out)


SCORED = ("key {kind}, held_out boolean, row_id long, n_tokens long, n_known long, log_counts double, "
          "log_model double, rare array<struct<token:binary,n:long>>")


def _lists(rare: list[Counter]) -> pa.ListArray:
    """One list of (token, n) a text."""
    offsets = np.cumsum([0, *map(len, rare)])
    pairs = pa.StructArray.from_arrays([pa.array([w for x in rare for w in x], pa.binary()),
                                        pa.array([k for x in rare for k in x.values()], pa.int64())], ["token", "n"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _score_known(docs: DataFrame, units: Units, model: Model, key: str, text: str) -> DataFrame:
    """What needs only the head: model score and count sums, and the rare tokens."""
    kind = docs.schema[key].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((units, model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lbl = sent.value
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for start, tokens, first in _blocks(b, 2):
                ids = known.ids([w for t in tokens for w in t])
                u = known.units(ids)
                scores = lbl.log_prob(u, contexts(u, first)) / np.log(10)
                scores -= known.log_mass[u] * (u >= N_WORDS)
                head = ids >= 0
                logs = np.where(head, known.log_count[np.maximum(ids, 0)], 0.0) if len(known.log_count) else np.zeros(len(ids))
                scores += logs * (u >= N_WORDS)
                at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])[:-1]
                rare = [Counter(compress(t, other)) for t, other in
                        zip(tokens, [x.tolist() for x in np.split(~head, at[1:])])]
                n = len(tokens)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(start, n), b.column(1).slice(start, n), pa.array(np.arange(row, row + n)),
                    pa.array([len(t) for t in tokens], pa.int64()), pa.array(np.add.reduceat(head.astype(np.int64), at)),
                    pa.array(np.add.reduceat(logs, at)), pa.array(np.add.reduceat(scores, at)),
                    _lists(rare)],
                    names=["key", "held_out", "row_id", "n_tokens", "n_known", "log_counts", "log_model", "rare"])
                row += n

    return docs.select(F.col(key).alias("key"), held_out(key).alias("held_out"), F.col(text).alias("text")).mapInArrow(
        work, SCORED.format(kind=kind))


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the documents that are not held out, score all of them."""
    train = docs.filter(~held_out(key))
    counts = stage(count_tokens(train, text), "counts")
    units = learn_units(counts)
    model = Model.initial(units)
    part = F.coalesce(F.pmod(F.xxhash64(key), F.lit(SLICE)), F.lit(0))
    shards = -(-units.n // SHARD_TOKENS) or 1
    for rows, n in ((train.filter(part == 0), -(-shards // SLICE)), (train, shards)):
        model = train_round(_dealt(rows, n, key, text), units, model, text)
    known = stage(_score_known(docs, units, model, key, text), "scored")
    rare = known.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.token", F.col("r.n").alias("times"))
    sums = (rare.join(counts, "token").groupBy("row_id")
            .agg(F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs")))
    rows = known.drop("rare").join(sums, "row_id", "left")
    logs = F.col("log_counts") + F.coalesce("rare_logs", F.lit(0.0))
    return rows.select(
        F.col("key").alias(key), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(units.n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(units.n + units.v + 1)))).alias("base_score"),
        (F.col("log_model") + F.coalesce("rare_logs", F.lit(0.0))).alias("score"))
