import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ordermart.llm import id_shards, packing, token_cache
from ordermart.llm.common import fresh_folder
from ordermart.llm.token_cache import WordCache

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", " a", "a ", "a\n b", "a \n", "x\x1cy", "it's  'tis DON'T", "e\u0301\u0301 é", "a\u00a0 b",
       "a <|endoftext|> b", "x<|startoftext|>y", "日本 語", "A\0 B", "İI i̇", "\r\n a", "ſt 's", "×÷ ÿŸ µ", "a\n\n b\n"]


@pytest.mark.parametrize("path, cut", [(WORDS, "words"), (BYTES, "spaced")])
def test_cached_ids_are_the_library_ids(path, cut):
    rnd = random.Random(1)
    alphabet = "abcXYZ 's\n\t 0129.,!-éßÀ×日\x1c<|'"
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    got, library = WordCache(path, cut).payloads(texts), Tokenizer.from_file(path)
    for t, p in zip(texts, got, strict=True):
        assert np.frombuffer(p, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def ids_of(path, text, end):
    return [*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_shards_round_trip(spark, odd, plain):
    rows = id_shards.tokenize_to_shards(odd, BYTES, 2, shards=4).collect()
    assert len(rows) == len(plain)
    want = defaultdict(list)
    for i, t in plain:
        want[i].append(crc(ids_of(BYTES, t, 2)))
    got, at = defaultdict(list), 0
    for r in sorted(rows, key=lambda r: r.start):
        ids = np.frombuffer(r.ids, "<u4")
        assert (r.start, r.n_tokens) == (at, len(ids))
        at += len(ids)
        got[r.doc_id].append(zlib.crc32(r.ids))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start) if r.doc_id is not None]
    assert order == sorted(order)


def test_shard_lookup_and_absent_keys(spark, odd, nothing):
    manifest = id_shards.write_shards(odd, fresh_folder(spark, "t-ids"), BYTES, 2, shards=1)
    shard = id_shards.Shard(manifest[0]["path"])
    first, many = shard.rows_of(np.array([7, 8, 9, 10**12, -5, 77]))
    assert many.tolist() == [2, 1, 1, 0, 0, 0]
    for k, (a, n) in zip([7, 8], zip(first, many)):
        assert (shard.keys[a:a + n] == k).all()
    assert id_shards.tokenize_to_shards(nothing, BYTES, 2).collect() == []


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000, 20000):
        keys = np.unique(np.random.default_rng(n).integers(0, 2**63, n)).astype(np.uint64)
        slots = id_shards.PerfectHash.build(keys).slots(keys)
        assert sorted(slots.tolist()) == list(range(len(keys)))


def test_cut_lengths():
    for n in range(1, 9000):
        parts = packing.cut_lengths(n)
        assert sum(parts) == n and all(0 < p <= packing.CAPACITY for p in parts)


def test_pieces_cover_all_and_sequences_are_gapless(spark, odd, plain, monkeypatch):
    for fan in (2, 256):
        monkeypatch.setattr(packing, "FAN", fan)
        rows = packing.pack(odd.unionByName(odd).repartition(5), WORDS, 1).collect()
        want = defaultdict(list)
        for i, t in plain + plain:
            want[i].append(ids_of(WORDS, t, 1))
        pieces, places = defaultdict(list), defaultdict(list)
        for r in rows:
            assert len(r.ids) == 4 * r.length
            pieces[r.doc_id].append((r.start, r.ids))
            places[r.sequence_id].append((r.offset, r.length))
        for i, docs in want.items():  # repeated rows give repeated pieces
            assert b"".join(p for _, p in sorted(pieces[i])) == b"".join(
                np.array(sum([d[a:a + n] for d in docs], []), "<u4").tobytes()
                for a, n in zip(np.cumsum([0, *packing.cut_lengths(len(docs[0]))]), packing.cut_lengths(len(docs[0]))))
        for spans in places.values():
            at = 0
            for a, n in sorted(spans):
                assert a == at
                at += n
            assert at <= packing.CAPACITY
        total = sum(r.length for r in rows)
        assert len(places) <= -(-total // packing.CAPACITY) + 3
    assert packing.pack(odd.limit(0), WORDS, 1).collect() == []


def test_cut_texts_equal_the_library(monkeypatch):
    """Random texts of white space, signs, contractions, digits and letters, also
    beside texts of other scripts, with small caches."""
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from ordermart.llm import token_cache

    monkeypatch.setattr(token_cache, "MAX_MERGED", 300)
    monkeypatch.setattr(token_cache, "MAX_CACHED", 50)
    rnd = random.Random(12)
    parts = [" ", "  ", "\n", "\n\n", " \n ", "a", "the", "Über", "ñandú", "'s", "'ll", "'", "I'm", "42", "7", ".", "!?", "...", "--", "<", "|", "ÿ", "×", "~"]
    odd = ["日本", "\t", "€", " ", "<|endoftext|>", "\x1c", "😀", "ő", "\r\n", " "]
    for path, cut in (("byte_bpe_50k.json", "spaced"), ("word_bpe_49k.json", "words")):
        library, cache = Tokenizer.from_file(public_tokenizers.path(path)), token_cache.WordCache(public_tokenizers.path(path), cut)
        for _ in range(60):
            texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(12)]
            texts += ["".join(rnd.choice(parts + odd) for _ in range(rnd.randint(0, 30))) for _ in range(rnd.choice([0, 4]))]
            rnd.shuffle(texts)
            for t, payload in zip(texts, cache.payloads(texts), strict=True):
                assert memoryview(payload).cast("I").tolist() == library.encode(t, add_special_tokens=False).ids, (cut, t)


@pytest.mark.parametrize("path, cut", [(WORDS, "words"), (BYTES, "spaced")])
def test_frequent_pretokens_are_merged_once(path, cut, monkeypatch):
    """A full cache keeps what was met early, and ids stay the library's."""
    monkeypatch.setattr(token_cache, "MAX_MERGED", 400)
    cache, library, merged = WordCache(path, cut), Tokenizer.from_file(path), []
    tokenize = cache.merged.tokenize
    cache.merged.tokenize = lambda p: merged.append(p) or tokenize(p)
    frequent = " ".join(f"{a}{b}{c}" for a in ("th", "é", "Qu") for b in "aeiou" for c in ("n", "st", "\n"))
    for i in range(30):
        rare = " ".join("x" + "".join(chr(97 + (i * 50 + j) // 26 ** k % 26) for k in range(3)) for j in range(50))
        for t, p in zip(both := [frequent, rare], cache.payloads(both), strict=True):
            assert np.frombuffer(p, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids
    assert len(cache.merged) <= 500
    known = [p for p in merged if "x" not in p]
    assert len(known) == len(set(known)), "a frequent pre-token was merged again"
