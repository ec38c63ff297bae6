"""Removed repeats against a plain table of all 50-byte strings."""

import hashlib
import random

import numpy as np
import pytest

from conftest import SF001
from ordermart.llm import queries
from ordermart.llm import suffix_levels as S

SCHEMA = "doc_id long, text string, chunk int, part int, a string, n_bytes int"


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each (doc_id, text)."""
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49 if d is not None else 0):
            s = raw[i:i + 50]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49 if d is not None else 0):
            if first[raw[i:i + 50]] < d:
                gone[i:i + 50] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, partitions=4, **how):
    df = spark.createDataFrame([(d, t, 1, 2, "a", 3) for d, t in rows], SCHEMA).repartition(partitions)
    assert sorted((tuple(r) for r in S.remove_repeats(df, **how).collect()), key=repr) == brute(rows)


def prose(rnd, n):
    return "".join(rnd.choice(["the ", "on ", "é", "ing ", "ta", "ro", "li. ", "日"]) for _ in range(n))


@pytest.mark.parametrize("seed", [1, 2])
def test_shared_passages(spark, seed):
    """Passages cut from each other at all kinds of places, many below, at and
    just above 50 bytes, in random order of ids, over several chunks."""
    rnd = random.Random(seed)
    texts = [prose(rnd, rnd.randint(0, 200)) for _ in range(40)]
    for _ in range(120):
        a, b = rnd.choice(texts), rnd.choice(texts)
        i, n = rnd.randint(0, max(0, len(a) - 1)), rnd.choice([20, 30, 44, 46, 48, 49, 50, 51, 60, 100, 300])
        j = rnd.randint(0, len(b))
        texts.append(b[:j][-rnd.randint(0, 150):] + a[i:i + n] + prose(rnd, rnd.randint(0, 12)))
    ids = rnd.sample(range(-500, 5000), len(texts))
    check(spark, list(zip(ids, texts)), chunk_bytes=6000)


def test_copies_lines_and_low_entropy(spark):
    rnd = random.Random(3)
    line = "This passage stands in very many of the documents, word by word. "
    texts = [prose(rnd, 30) + line + prose(rnd, 30) for _ in range(60)] + [line * 3] * 20
    texts += ["a" * n for n in (49, 50, 51, 200, 300)] + ["ab" * 60, "ba" * 60, "abc" * 50, "\n" * 120, " " * 75]
    check(spark, list(enumerate(texts)), chunk_bytes=3000)


def test_odd_rows(spark):
    rnd = random.Random(4)
    text = prose(rnd, 60)
    rows = [(1, None), (2, ""), (3, text), (3, text), (4, text), (None, text), (5, "x" + text[3:80]), (6, "short"), (2 ** 40, text + "é"),
            (-9, text[10:90])]
    check(spark, rows)


def test_long_text_in_segments(spark, monkeypatch):
    monkeypatch.setattr(S, "SEGMENT", 1024)
    monkeypatch.setattr(S, "_LOW", np.uint64(2047))
    rnd = random.Random(5)
    text = prose(rnd, 9000)
    parts = [S.Text([1, 2, 3], [text.encode(), text[700:9000].encode(), (prose(rnd, 10) + text[5000:5400]).encode()])]
    runs = parts[0].runs()
    assert (np.diff(runs["low"]) > 0).all() and int((runs["high"] - runs["low"] + 1).sum()) == sum(
        max(0, len(r) - 49) for r in parts[0].raws)
    check(spark, [(7, text), (2, text[700:9000]), (9, prose(rnd, 10) + text[5000:5400])])


def test_levels_merge_geometrically():
    rnd, family, all_keys = np.random.default_rng(1), S.Levels(), {}
    for i in range(1, 14):
        keys = np.unique(rnd.integers(0, 400, 50).astype(np.uint64))
        family.add(keys, np.full(len(keys), 100 - i))
        all_keys |= {int(k): 100 - i for k in keys}
        assert [x is not None for x in family.levels] == [c == "1" for c in reversed(f"{i:b}")]
    keys, low = family.whole()
    assert dict(zip(keys.tolist(), low.tolist())) == all_keys and (np.diff(keys.astype(np.int64)) > 0).all()


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert S.remove_repeats(df).count() == 0


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op12_suffix_dedup(spark, SF001).collect()), key=repr) == brute(rows)
