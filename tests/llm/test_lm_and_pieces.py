import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from conftest import SF01
from ordermart.llm import lbl, pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def test_counts_and_base_scores(spark, odd, plain, nothing):
    got = lbl.score_documents(odd).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(t for i, x in plain if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted((i, held(i), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n,
                   sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens(x))) for i, x in plain if i is not None)
    rows = sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got if r.doc_id is not None)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    assert np.allclose([r[5] for r in rows], [w[5] for w in want])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lbl.score_documents(nothing).collect() == []


def test_context_beats_counts_on_held_out_texts(spark):
    rnd = random.Random(1)
    tongues = [[f"{p}{i}" for i in range(60)] for p in "abc"]
    docs = [(i, " ".join(rnd.choice(tongues[i % 3]) for _ in range(200))) for i in range(1500)]
    got = lbl.score_documents(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) + 0.05 * sum(r.n_tokens for r in held)


def test_scores_do_not_depend_on_the_layout(spark):
    """The same texts in 2, 16 and 64 partitions, in other orders, give one model
    that has learnt from the context."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    got = []
    for layout in (docs.repartition(2), docs.orderBy(F.desc("doc_id")).repartition(16), docs.repartition(64, "doc_id")):
        got.append({r.doc_id: r for r in lbl.score_documents(layout).collect()})
    ids = sorted(got[0])
    scores = [np.array([g[i].score for i in ids]) for g in got]
    assert all(np.allclose(scores[0], s, rtol=1e-6) for s in scores[1:])
    held = [got[0][i] for i in ids if got[0][i].held_out]
    gain = sum(r.score - r.base_score for r in held) / sum(r.n_tokens for r in held)
    assert gain > 0.05, gain


def test_rare_words_are_joined_exactly(spark, odd, plain, monkeypatch):
    want = {(r.doc_id, r.n_tokens): (r.n_known, r.base_score) for r in lbl.score_documents(odd).collect()}
    monkeypatch.setattr(lbl, "HEAD", 3)
    for r in lbl.score_documents(odd).collect():
        known, base = want[r.doc_id, r.n_tokens]
        assert r.n_known == known and math.isclose(r.base_score, base, rel_tol=1e-9)


def test_probabilities_add_up():
    head = [{"token": t.encode(), "n": n} for t, n in (("the", 9), ("of", 5), ("rare", 1))]
    units = lbl.Units(head, (15, 3), {})
    model = lbl.Model.initial(units)
    ctx = np.full((lbl.CONTEXT, lbl.N_UNITS), lbl.N_UNITS, np.int64)
    assert math.isclose(np.exp(model.log_prob(np.arange(lbl.N_UNITS), ctx)).sum(), 1, rel_tol=1e-5)


def test_log_probabilities_are_exact_in_little_memory():
    """Against float64, with scores that exp can take and with larger ones; a run
    of many tokens holds the scores of some rows only."""
    rnd = np.random.default_rng(3)
    units = rnd.integers(0, lbl.N_UNITS, 30_000)
    ctx = rnd.integers(0, lbl.N_UNITS + 1, (lbl.CONTEXT, len(units)))
    for scale in (0.3, 6.0):
        p = {k: (rnd.normal(size=s) * scale).astype(np.float32) for k, s in lbl.PARAMS.items()}
        tracemalloc.start()
        got = lbl.Model(p).log_prob(units, ctx)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        wide = lbl.Model({k: v.astype(float) for k, v in p.items()})
        s = wide.predicted(ctx[:, :2000]) @ wide.p["t"].T + wide.p["b"]
        top = s.max(1)
        want = s[np.arange(2000), units[:2000]] - top - np.log(np.exp(s - top[:, None]).sum(1))
        assert np.allclose(got[:2000], want, rtol=1e-5, atol=2e-3 if scale > 1 else 1e-5)
        assert np.isfinite(got).all() and peak < 3_000_000, peak


def test_head_ids_and_classes():
    units = lbl.Units([{"token": t, "n": 3} for t in (b"the", b"", b"of")], (9, 3), {})
    tokens = [b"of", b"rare", b"", b"the", b"x", b"rare"]
    assert units.ids(tokens).tolist() == [2, -1 - lbl.class_of(b"rare"), 1, 0, -1 - lbl.class_of(b"x"), -1 - lbl.class_of(b"rare")]
    assert units.ids([]).tolist() == []


def test_classes_agree_between_spark_and_numpy(spark):
    words = ["a", "ab", "abc", "abcd", "été", "日本語", "x" * 50]
    df = spark.createDataFrame([(w.encode(), 3) for w in words], "token binary, n long")
    mass = Counter()
    for w in words:
        mass[lbl.class_of(w.encode())] += 4
    saved, lbl.N_WORDS = lbl.N_WORDS, 0
    try:
        units = lbl.learn_units(df)
    finally:
        lbl.N_WORDS = saved
    assert all(math.isclose(10 ** units.log_mass[c], m + 1) for c, m in mass.items())


def texts():
    rnd = random.Random(2)
    alphabet = "abcdeéß日本𝄞\t\n.,'0123 ▁"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 30))) for _ in range(1500)] + [
        "", "▁a", "a▁b", "  ", "a  b", " a", " ", "\0", "<0x41>", "<s>", "</s>x", "<unk>", " " * 40 + "x", "the cat " * 500]


def test_bpe_ids_are_the_library_ids():
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.PieceCodec(MODEL, "bpe")
    some = texts()
    for t, p in zip(some, codec.payloads(some), strict=True):
        assert sp.encode(t) == np.frombuffer(p, "<u4").tolist(), repr(t)
        assert codec.text(p) == t.replace("▁", " ")


def test_many_words_at_once_are_the_library_ids(monkeypatch):
    """New words of common characters take a character a step together, also with
    few slots for pairs and small caches; only the others are segmented alone."""
    monkeypatch.setattr(pieces, "SLOTS", 64)
    monkeypatch.setattr(pieces, "MAX_PARTS", 500)
    monkeypatch.setattr(pieces, "MAX_PAIRS", 300)
    sp, codec = sentencepiece.SentencePieceProcessor(model_file=MODEL), pieces.PieceCodec(MODEL, "bpe")
    alone, by_merges = [], codec.segment
    codec.segment = lambda part: alone.append(part) or by_merges(part)
    rnd = random.Random(4)
    syllables = ["th", "er", "on", "tion", "é", "ñ", "Ü", "st", "ing", "a", "s", ".", "\n", "\t", "'", "42", "日", "ст", "z" * 20]
    some = [" ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(0, 6))) for _ in range(40)) for _ in range(200)]
    for at in range(0, len(some), 20):
        for t, p in zip(some[at:at + 20], codec.payloads(some[at:at + 20]), strict=True):
            assert sp.encode(t) == np.frombuffer(p, "<u4").tolist(), repr(t)
    assert alone and all("日" in w or len(w) > pieces.SHORT for w in alone)


def best_sum(codec, part):
    """Best sum of scores by trying every piece at every position."""
    best = [0.0] + [-math.inf] * len(part)
    for i in range(len(part)):
        for j in range(i + 1, min(len(part), i + 16) + 1):
            score = codec.score_of.get(part[i:j], codec.unknown if j == i + 1 else -math.inf)
            best[j] = max(best[j], best[i] + score)
    return best[-1]


def test_unigram_segmentation_has_the_best_score():
    codec = pieces.PieceCodec(MODEL, "unigram")
    for t in texts()[:400]:
        part = "▁" + t.replace(" ", "▁")
        total = sum(codec.score_of.get(codec.piece_of[i], 0.0) for i in codec.by_scores(part))
        unknown = sum(c not in codec.score_of for c in part)  # bytes stand for them
        assert math.isclose(total + codec.unknown * unknown, best_sum(codec, part), rel_tol=1e-9), repr(t)


def test_columns_on_odd_rows(spark, odd, nothing):
    kept = odd.drop("ids")
    got = pieces.decode(pieces.encode(kept, MODEL), MODEL).collect()
    assert len(got) == odd.count()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in got)
    assert pieces.encode(nothing.drop("ids"), MODEL).collect() == []
