import random

import numpy as np

import corpus_pipeline
from ordermart.llm import near_dups as N
from ordermart.llm.components import components
from ordermart.llm.shingles import shingle_sets


def brute_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def brute(rows, percent=85):
    """(size, component) of each (doc_id, text), by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low.get(find(i)) if d is not None else None, d is None or low[find(i)] == d)
                  for i, (d, _) in enumerate(rows) if d is not None)


def variants(seed, n, edits, size=160):
    rnd = random.Random(seed)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(size)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(size)] = f"e{rnd.random()}"
        out.append(" ".join(w))
    return out


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None)


def test_odd_rows(spark, odd, plain, nothing):
    assert result(N.near_duplicates(odd)) == brute(plain)
    assert N.near_duplicates(nothing).collect() == []
    left = N.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    ids = [r.doc_id for r in left.collect()]
    assert sorted(x for x in ids if x) == [1, 2, 3, 4, 5, 6, 7, 10, 11, 12, 13, 14, 15, 16] and None in ids


def test_groups_near_the_threshold(spark, monkeypatch):
    """Chains and outliers of many edits; blocks smaller than the groups."""
    texts = variants(1, 120, 9) + variants(2, 30, 4, 40) + variants(3, 12, 2, 12) + ["a b c d e f g", "a b c d e f g h", "A B", "a b"]
    rows = list(enumerate(texts, start=100))
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute(rows)
    assert len({c for _, _, c, _ in want}) > 20
    assert result(N.near_duplicates(df)) == want
    monkeypatch.setattr(N, "BLOCK_CLASSES", 7)
    monkeypatch.setattr(N, "BROADCAST_ROWS", 0)
    assert result(N.near_duplicates(df)) == want


def test_shingle_hashes_stand_for_shingles():
    texts = ["", " ", "one two three four five six", "One  two\nthree four FIVE six", "one two", "two one", "x", "a b c d e " * 50,
             "é ü ß ñ 日 本", "one two three four"]
    sets = shingle_sets(texts)
    for i, t in enumerate(texts):
        assert len(sets[i]) == len(brute_set(t))
        for j, u in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute_set(t) & brute_set(u))
    assert (shingle_sets(texts[2:3])[0] == sets[2]).all()  # alone as in company


def test_estimates_follow_the_jaccard():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    for n in (20, 300, 2000):
        for share in (0.0, 0.5, 0.85, 1.0):
            a = rng.permutation(pool)[:n]
            keep = int(round(2 * n * share / (1 + share)))
            b = np.concatenate([a[:keep], rng.permutation(np.setdiff1d(pool, a))[:n - keep]])
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = np.stack([N.sketch(np.sort(a)), N.sketch(np.sort(b))])
            assert abs(N.estimated_jaccard(s, np.array([n, n]))[0, 1] - true) < 0.15


def test_components_against_union_find(spark):
    rnd = random.Random(6)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def brute_groups(rows, percent):
    """Smallest id of each (doc_id, text)'s group, by all pairs."""
    sets = [brute_set(t) for _, t in rows]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, _) in enumerate(rows):
        for (e, _), b in zip(rows[:i], sets, strict=False):
            if 100 * len(sets[i] & b) >= percent * len(sets[i] | b):
                x, y = find(d), find(e)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


def test_threshold_is_an_argument(spark):
    """Copies between 0.80 and 0.85 are linked at 0.8 and by the pipeline's stage only."""
    rows = list(enumerate(variants(11, 60, 14) + variants(12, 40, 3, 60) + variants(13, 40, 5, 90), start=1))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    at80, at85 = brute_groups(rows, 80), brute_groups(rows, 85)
    assert len(set(at80.values())) < len(set(at85.values()))
    for like, want in ((N.AT_80, at80), (N.AT_85, at85)):
        assert {r.doc_id: r.component_id for r in N.near_duplicates(df, like=like).collect()} == want
    left = corpus_pipeline.near_dedup_stage(spark, df, "")
    assert {r.doc_id for r in left.collect()} == set(at80.values())


def test_pairs_at_the_thresholds_meet():
    for like in (N.AT_80, N.AT_85):
        assert (1 - (like.percent / 100) ** like.rows) ** like.bands < 5e-7


def test_repeated_rows_are_dealt_once(spark, monkeypatch):
    """One row ten thousand times beside near copies, and ids with two texts."""
    a, other = variants(21, 1, 0)[0], variants(22, 1, 0)[0]
    b, c = a + " b", a + " c"
    rows = [(5, a)] * 10_000 + [(6, b), (7, c), (7, c), (7, other), (8, other), (9, other + " end")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dealt, links = [], N._links
    monkeypatch.setattr(N, "_links", lambda whole, *rest: dealt.append(whole.count()) or links(whole, *rest))
    got = N.near_duplicates(df).groupBy("doc_id", "n_shingles", "component_id", "kept").count().collect()
    assert dealt == [5]  # classes of a, b, c, other and the longer other
    want = brute_groups([(5, a), (6, b), (7, c)], 85)
    assert want == {5: 5, 6: 5, 7: 5}
    assert {r.doc_id: r["count"] for r in got if r.doc_id in (5, 6)} == {5: 10_000, 6: 1}
    assert sum(r["count"] for r in got) == len(rows)
    assert all(r.component_id == 5 and r.kept == (r.doc_id == 5) for r in got)


def test_runs_of_few_words(spark):
    """Partitions whose texts hold 0 to 6 words in all."""
    for n in range(7):
        rows = [(1, " ".join("abcdef"[:n]))]
        got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got] == brute(rows)
    rows = [(1, "x y"), (2, "X  y"), (3, "p q r"), (4, "one"), (5, "")]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == brute(rows)


def test_drop_keeps_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(i, t, 1, 2, 3, 4) for i, t in ((1, text), (2, text), (3, "another text"), (3, "another text"), (4, None))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, gone int, again int, near_id int, NEAR_ID_ int")
    left = N.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3, 4]
