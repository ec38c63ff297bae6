import math
import random

import pytest

from ordermart.llm import va_search


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q in {i for i, _ in ok if i % every == 0}:
        own = min(v for i, v in ok if i == q)
        found = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in ok if i != q and len(v) == len(own))
        out[q] = [(i, -s) for s, i in found[:k]]
    return {q: v for q, v in out.items() if v}


def test_top_k_against_brute_force(spark):
    from ordermart.llm.common import ship
    ship(spark)
    rnd = random.Random(4)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # one very common vector: ties by id
    rows += [(2000, None), (2010, [None] * 8), (2020, [float("nan")] * 8), (2030, [float("inf")] + [0.0] * 7),
             (None, [0.1] * 8), (2040, [1.0, 2.0]), (2050, [0.5, 1.0]), (2060, []), rows[20], rows[21], (40, [0.9] * 8)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, id int, block int")
    back = [(r.vec_id, r.embedding) for r in df.collect()]  # as 32-bit floats
    want = brute(back, 5, 10)
    for block_rows in (50, 16384):
        got = {}
        for r in sorted(va_search.search(df, 5, 10, block_rows=block_rows).collect(), key=lambda r: r["rank"]):
            got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert got == want
    assert va_search.search(df.limit(0), 5, 10).collect() == []


def test_bounds_hold():
    import numpy as np
    rng = np.random.default_rng(0)
    v = rng.integers(-300, 300, (500, 16))
    block = va_search.Block(np.arange(500), v)
    q = rng.integers(-300, 300, (20, 16))
    assert (block.bounds(q) >= q @ v.T).all()


def test_large_components(spark):
    """Exact far beyond the range of float64; an error before a score can wrap."""
    rnd = random.Random(8)
    rows = [(i, [rnd.choice([-1, 1]) * (1e6 + rnd.randint(0, 3)) for _ in range(32)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in va_search.search(df, 5, 10).collect())
    whole = {i: [int(256 * x // 1) for x in v] for i, v in rows}
    want = []
    for q in range(0, 60, 10):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scored, 1)]
    assert got == sorted(want)
    for big in (3e8, 1e30):
        with pytest.raises(ValueError):
            va_search.search(spark.createDataFrame([(0, [big] * 4)], "vec_id long, embedding array<double>"), 5, 10)
