"""Winnowing fingerprints of documents, in native column expressions only.

Method: a text is cut into overlapping k-grams, each hashed to 32 bits.  Of
every window of ``w`` consecutive k-grams the smallest hash is chosen, the
rightmost on ties, and kept with its position.  Two texts that share a run of
at least ``k + w - 1`` units share a chosen hash (the match guarantee),
wherever the run stands in either text.

The units are words between white space.  A word of over ``LONG_WORD`` bytes
(text without white space) is cut: each run of ``PIECE`` of its UTF-8 bytes is
a unit.  What a word is cut into depends on that word alone, so the units of a
passage are the same in any text; ``PIECE + k + w - 2`` shared bytes of a long
word are k + w - 1 shared units.

A chosen k-gram is one long: hash in the upper 32 bits, ``MAX_POS - position``
(of its first unit) in the lower 31, so that the plain minimum of a window is already "smallest
hash, rightmost position".

Defined results: a null text counts as empty; an empty text, or one of white
space only, has an empty fingerprint; a text below k units is one gram of its
whole length; fewer than ``w`` grams form one window.  Likeness of two empty
fingerprints is 1.  Extra columns are ignored.  Equal texts have equal
fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions

K, W = 3, 6  # units
PIECE, LONG_WORD = 16, 24  # bytes
MAX_POS = 2**31 - 1
WHITE_SPACE = "[ \\t-\\r]+"


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a let-binding)."""
    return F.transform(F.array(value), body)[0]


def _packed(digest: Column, position: Column) -> Column:
    high = F.shiftleft(F.shiftrightunsigned(digest, 32), 31)
    return high + (F.lit(MAX_POS).cast("long") - position.cast("long"))


def pieces(word: Column) -> Column:
    """Hash of every run of ``PIECE`` bytes of a word that is that long."""
    def runs(data: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.octet_length(data) - F.lit(PIECE - 1)),
                           lambda i: F.xxhash64(F.substring(data, i, F.lit(PIECE))))

    return bind(word.cast("binary"), runs)


def units(words: Column) -> Column:
    """Hashes of words, of the pieces of long ones, in their order."""
    long = lambda w: F.octet_length(w) > F.lit(LONG_WORD)
    whole = F.transform(words, lambda w: F.xxhash64(w))
    cut = F.flatten(F.transform(words, lambda w: F.when(long(w), pieces(w)).otherwise(F.array(F.xxhash64(w)))))
    return F.when(F.exists(words, long), cut).otherwise(whole)


def word_grams(words: Column, k: int) -> Column:
    """Packed (hash, position) of every k-gram of the units of some words."""
    def grams(one: Column) -> Column:
        n = F.greatest(F.size(one) - F.lit(k - 1), F.lit(1))
        return F.transform(F.slice(one, F.lit(1), n), lambda x, i: _packed(
            F.xxhash64(x, *[F.get(one, i + F.lit(j)) for j in range(1, k)]), i))

    return bind(units(words), grams)


def window_minima(hashes: Column, w: int) -> Column:
    """Minimum of each window of ``w`` neighbours, from minima of ``step``
    neighbours (two short passes instead of w comparisons per window)."""
    step = max(s for s in range(1, w + 1) if w % s == 0 and s * s <= w)

    def least(xs: Column, x: Column, i: Column, offsets) -> Column:
        rest = [F.get(xs, i + F.lit(o)) for o in offsets if o]
        return F.least(x, *rest) if rest else x

    def second(m: Column) -> Column:
        n = F.greatest(F.size(hashes) - F.lit(w - 1), F.lit(1))
        return F.transform(F.slice(m, F.lit(1), n),
                           lambda x, i: least(m, x, i, range(0, w, step)))

    return bind(F.transform(hashes, lambda x, i: least(hashes, x, i, range(step))), second)


def winnow(text: Column, k: int = K, w: int = W) -> Column:
    """Chosen k-grams of a text as packed longs, in order of position."""
    text = F.coalesce(text, F.lit(""))

    def of(words: Column) -> Column:
        chosen = bind(word_grams(words, k), lambda h: F.array_distinct(window_minima(h, w)))
        return F.when(F.size(words) == 0, F.array().cast("array<bigint>")).otherwise(chosen)

    return bind(F.array_remove(F.split(text, WHITE_SPACE), F.lit("")), of)


def hashes(chosen: Column) -> Column:
    """Distinct hashes of chosen k-grams."""
    return F.array_distinct(F.transform(chosen, lambda v: F.shiftright(v, 31)))


def as_text(chosen: Column) -> Column:
    """``hash:position`` of each chosen k-gram (hex, decimal), comma-joined."""
    return F.array_join(F.transform(chosen, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, 31))), F.lit(":"),
        (F.lit(MAX_POS).cast("long") - v.bitwiseAND(F.lit(MAX_POS).cast("long"))).cast("string"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes, 0 to 1."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union == 0, F.lit(1.0)).otherwise(shared / union)


def _id_buckets(ids: DataFrame, key: str, n: int) -> Column:
    """Bucket number of ``key`` by sampled split points (ascending with the
    key); two-level search, so a row costs about 2 * sqrt(n) comparisons."""
    probs = [i / n for i in range(1, n)]
    cuts = sorted({int(x) for x in ids.stat.approxQuantile(key, probs, 1 / (4 * n))})
    if not cuts:
        return F.lit(0)
    size = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[i:i + size] for i in range(0, len(cuts), size)]
    below = lambda xs: F.size(F.filter(xs, lambda c: F.col(key) >= c))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    coarse = F.greatest(below(longs([g[0] for g in groups])) - F.lit(1), F.lit(0))
    fine = F.get(F.array(*[longs(g) for g in groups]), coarse)
    found = F.when(F.col(key).isNull(), F.lit(0)).otherwise(coarse * F.lit(size) + below(fine))
    return found.cast("int")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text",
              buckets: int | None = None) -> DataFrame:
    """(key, text, bucket, halo): rows dealt by ranges of ``key``, with the
    first row of the following range (descending key) added as ``halo``.

    The following row of any row is then the next one of its bucket, so no
    global sort into one task is needed.  Rows of equal key follow each other
    by text; null keys come last; the last row is followed by the first.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = buckets or max(64, 4 * shuffle_partitions(spark))
    bucket = _id_buckets(base.select("key"), "key", n)
    heads = (base.select("key", bucket.alias("bucket")).groupBy("bucket")
             .agg(F.max("key").alias("head")).orderBy(F.desc("bucket")).collect())  # <= n rows
    before = [r["bucket"] for r in heads[-1:] + heads[:-1]]
    edges = spark.createDataFrame([(r["head"], b) for r, b in zip(heads, before, strict=True)],
                                  "head long, bucket int")
    halo = (base.join(F.broadcast(edges), F.col("key").eqNullSafe(F.col("head")))
            .select("key", "text", "bucket", F.lit(True).alias("halo")))
    return base.select("key", "text", bucket.alias("bucket"), F.lit(False).alias("halo")).unionByName(halo)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        k: int = K, w: int = W, buckets: int | None = None) -> DataFrame:
    """Fingerprint each text and its edited text: the last floor(n/2) code
    points replaced by the first as many (or all) of the next document in
    descending key order; after the last comes the first.

    One shuffle of the texts by key range.  A halo row only lends its text and
    fingerprint to the row before it.
    """
    order = Window.partitionBy("bucket").orderBy(
        F.col("halo"), F.col("key").desc_nulls_last(), F.col("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = (with_next(docs, key, text, buckets)
            .withColumn("next_text", F.lead("text").over(order))
            .withColumn("fp", winnow(F.col("text"), k, w))
            .withColumn("own", hashes(F.col("fp")))
            .withColumn("next_own", F.lead("own").over(order))
            .filter(~F.col("halo")))
    edited = (rows.select(
        "key", "fp", "own", "next_own", n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - half),
                 F.substring("next_text", F.lit(1), half)).alias("edited"))
        .withColumn("edited_fp", winnow(F.col("edited"), k, w))
        .withColumn("edited_own", hashes(F.col("edited_fp"))))
    return edited.select(
        F.col("key").alias(key), "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"))
