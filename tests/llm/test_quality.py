import random

import numpy as np

from ordermart.llm import quality


def corpus(spark, n=600):
    rnd = random.Random(7)
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        w = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(30, 90))]
        text = " ".join(w) + "." if good else " ".join(x.upper() + "!!" for x in w) if i % 2 else " ".join(w[:1] * 60)
        rows.append((i, text))
        if i % 4:
            labels.append((i, int(good), 0))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    from ordermart.llm.common import ship
    ship(spark)
    docs, labels = corpus(spark)
    got = quality.classify(docs, labels).collect()
    held = [r for r in got if r.held_out]
    assert len(got) == 600 and len(held) > 100
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_odd_rows_and_missing_labels(spark, odd, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (7, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(odd, labels).collect()
    assert len(got) == odd.count()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
    same = {}
    for r in got:
        assert same.setdefault(r.doc_id, r.score) == r.score
    assert [r.score for r in quality.classify(odd, labels.limit(0)).collect()] == [0.5] * odd.count()
    assert quality.classify(nothing, labels).collect() == []


def test_isotonic_against_definition():
    rng = np.random.default_rng(1)
    for _ in range(30):
        w, v = rng.integers(1, 9, 20).astype(float), rng.random(20)
        fit = quality.isotonic(w, v)
        # min-max formula of the weighted isotonic regression
        mean = lambda a, b: np.average(v[a:b + 1], weights=w[a:b + 1])
        want = [max(min(mean(a, b) for b in range(i, 20)) for a in range(i + 1)) for i in range(20)]
        assert np.allclose(fit, want)
