"""The conversation trie against a plain one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from conftest import SF001
from ordermart.llm import prefix_trie as T
from ordermart.llm import queries

SCHEMA = "conv_id long, turn int, role string, text string, path string, chars int, shard int, depth int"


def brute(rows):
    """Nodes of the trie of rebuilt conversations; rows: (conv, turn, role, text)."""
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    own = {c: [(r, x) for _, r, x in sorted(v)] for c, v in own.items()}
    nodes = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(c - 100 * int(c / 100))
        seq = own.get(base, [])[:h] + turns[h:]
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append((c, len(seq) == d))
    children = {}
    for k in nodes:
        if k:
            children.setdefault(k[:-1], []).append(k)

    def totals(k):
        leaves, saved = 0 if k in children else 1, (len(nodes[k]) - 1) * (len(k[-1][1]) if k else 0)
        for x in children.get(k, []):
            a, b = totals(x)
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    out = []
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, e in members if e))
        out.append((min(c for c, _ in members), len(k), min(c for c, _ in nodes[k[:-1]]) if k else None, len(members),
                    len(children.get(k, [])), *totals(k), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def table(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3) for r in rows], SCHEMA).repartition(4)


def random_rows(seed, convs, words, longest):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant"]), rnd.choice("abcdefgh"[:words]) * rnd.randint(1, 3))
            for c in rnd.sample(range(0, 4 * convs), convs) for t in range(rnd.randint(1, longest))]


@pytest.mark.parametrize("seed,convs,words,longest", [(1, 120, 2, 4), (2, 60, 1, 9), (3, 200, 4, 3)])
def test_against_brute_force(spark, seed, convs, words, longest):
    rows = random_rows(seed, convs, words, longest)
    got = T.conversation_trie(table(spark, rows), shard_rows=40).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_hot_path_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "ENDS_CHARS", 50)
    rows = [(c * 7, t, "user", "same text") for c in range(300) for t in range(4)]  # a hot path
    rows += [(5000, t, "user", f"turn {t}") for t in range(400)]  # a long conversation
    rows += [(-3, None, None, None), (-3, 1, "user", ""), (-250, 0, "user", "x"), (-250, 0, "user", "x"), (None, 0, "user", "no id"),
             (9_000_000_001, 0, "ü", "日本 𝄞"), (7001, 2, "a", "bc"), (7002, 2, "ab", "c")]
    got = T.conversation_trie(table(spark, rows), shard_rows=30).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_splitters_cut_a_hot_path(spark):
    rows = T.rebuilt(table(spark, [(c * 7, t, "user", "same text") for c in range(600) for t in range(6)]))
    bounds = T.splitters(rows, 8, 600)
    assert len(bounds) == 7 and len({p for p, _ in bounds}) < 7


def test_empty_table(spark):
    assert T.conversation_trie(table(spark, []).limit(0)).count() == 0


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_prefix_trie(spark, SF001)
    assert sorted((tuple(r) for r in got.select(*T.COLUMNS).collect()), key=repr) == brute(rows)
