"""Ranked search against a plain count of every term in every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from conftest import SF001
from ordermart.llm import lexical_rank as L
from ordermart.llm import queries

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    """(item, rank, doc, score) of each item; documents without an id only count."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, total = sum(1 for s in sizes if s), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in sorted(set((i, t or "") for i, t in items if i is not None)):
        scored = []
        for (d, c), size in zip(counts, sizes):
            if d is None or not size:
                continue
            m = 75 + (25 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d))
        out += [(item, i, d, -s) for i, (s, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in docs], "doc_id long, text string, item int, rank string, score int")
    i = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    return d.repartition(5), i


def random_text(rnd, n, words=60):
    return "".join(f"w{min(int(rnd.expovariate(0.08)), words)}" + rnd.choice([" ", ", ", ".\n", "-", "_"]) for _ in range(n))


@pytest.mark.parametrize("batch_chars", [10 ** 6, 200])
def test_against_brute_force(spark, batch_chars):
    rnd = random.Random(5)
    docs = [(i * 3, random_text(rnd, rnd.randint(1, 80))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(40)]  # ties beyond the best 20
    items = [(i, random_text(rnd, rnd.randint(1, 30))) for i in range(30)] + [(77, docs[7][1])]
    got = L.rank(*frames(spark, docs, items), batch_chars=batch_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(docs, items)


def test_tiles_and_slices(spark, monkeypatch):
    rnd = random.Random(6)
    docs = [(i, random_text(rnd, 40)) for i in range(150)]
    items = [(i, random_text(rnd, 20)) for i in range(25)]
    monkeypatch.setattr(L, "TILE_ITEMS", 3)
    monkeypatch.setattr(L, "TILE_CELLS", 500)
    assert sorted(tuple(r) for r in L.rank(*frames(spark, docs, items)).collect()) == brute(docs, items)
    weights = np.array([[5.0, 1.0], [4.0, 0.0], [3.0, 9.0]])
    assert L.exact_slices(weights, 1, 9.5) == [0, 2, 3] == L.exact_slices(weights, 1, 12)
    assert L.exact_slices(weights, 1, 13) == [0, 3]
    assert L.exact_slices(np.array([[5.0], [5.0], [5.0]]), 1, 9) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        L.exact_slices(weights, 1, 9)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " -- \t"), (4, "Ünï é日本 Z z Z9_z"), (None, "z é日本"), (5, "é日本"), (5, "é日本"), (6, "x" * 300000 + " z"),
            (7, "z " * 20000), (-8, "É日本 z")]
    items = [(1, None), (2, ""), (3, "z Z é日本"), (3, "z Z é日本"), (None, "z"), (4, "ÜNÏ ünï Ünï"), (5, "nowhere"), (6, "x" * 300000)]
    assert sorted(tuple(r) for r in L.rank(*frames(spark, docs, items)).collect()) == brute(docs, items)


def test_empty_tables(spark):
    d, i = frames(spark, [(1, "a b")], [(1, "a")])
    assert L.rank(d.limit(0), i).count() == 0 and L.rank(d, i.limit(0)).count() == 0


def test_query_on_the_given_tables(spark):
    read = lambda t, c: [tuple(r) for r in spark.read.parquet(f"{SF001}/{t}.parquet").select(c, "text").collect()]
    got = queries.op11_lexical_rank(spark, SF001).collect()
    assert sorted(tuple(r) for r in got) == brute(read("documents", "doc_id"), read("benchmark", "item_id"))
