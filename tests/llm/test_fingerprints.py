import hashlib
import random

from ordermart.llm import fingerprints as W


def follower(rows):
    """(doc_id, text, next text) in descending order, nulls last, first again."""
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    return [(a[0], a[1] or "", b[1] or "") for a, b in zip(order, order[1:] + order[:1])]


def test_edited_texts_follow_the_descending_order(odd, plain):
    for buckets in (2, 64):
        got = sorted((r.doc_id is None, r.doc_id, r.n_chars, r.edited_sha256)
                     for r in W.edited_fingerprints(odd, buckets=buckets).collect() if r.doc_id is not None)
        want = []
        for i, t, n in follower(plain):
            half = len(t) // 2
            edited = t[:len(t) - half] + n[:half]
            if i is not None:
                want.append((False, i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
        assert got == sorted(want)


def test_equal_texts_have_equal_fingerprints(odd):
    rows = {r.doc_id: r for r in W.edited_fingerprints(odd).collect()}
    assert rows[7].fingerprint == rows[8].fingerprint != rows[13].fingerprint
    assert rows[2].fingerprint == rows[3].fingerprint == rows[4].fingerprint == ""
    assert rows[6].fingerprint and rows[10].fingerprint
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows.values())
    assert rows[7].near_edited > 0.2 > rows[14].near_next
    # 9 is followed by 8, which shares all but the last word
    assert rows[9].near_next > 0.9


def test_winnowing_against_brute_force(spark):
    """Chosen hashes are those of the definition, rightmost on ties, and a
    shared run of k + w - 1 words leaves a shared hash."""
    texts = [" ".join(f"w{(i * j) % 7}" for i in range(40)) for j in range(1, 8)] + ["a b", "a b c", "q " * 30]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    fp = {r.i: r.fp for r in df.select("i", W.winnow(df.text).alias("fp")).collect()}
    one = df.select("i", W.word_grams(W.F.array_remove(W.F.split("text", " "), W.F.lit("")), W.K).alias("g"))
    for r in one.collect():
        grams = [(v >> 31, W.MAX_POS - (v & W.MAX_POS)) for v in r.g]
        want = []
        for a in range(max(1, len(grams) - W.W + 1)):
            best = min(grams[a:a + W.W], key=lambda g: (g[0], -g[1]))
            want += [best] if best not in want else []
        assert [(v >> 31, W.MAX_POS - (v & W.MAX_POS)) for v in fp[r.i]] == want


def test_empty_table_and_plan(spark, nothing, odd):
    assert W.edited_fingerprints(nothing).collect() == []
    plan = W.edited_fingerprints(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    assert "SinglePartition" not in plan


def test_a_single_row_follows_itself(spark):
    df = spark.createDataFrame([(5, "one two three four")], "doc_id long, text string")
    r = W.edited_fingerprints(df).first()
    assert r.near_next == 1.0


def test_unspaced_text_followed_by_prose(spark):
    """The kept half of a text without white space is found in the edited text,
    and a passage inside a long word beside any other text."""
    rnd = random.Random(4)
    unspaced = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789日本") for _ in range(4000))
    prose = " ".join(f"word{rnd.randint(0, 999)}" for _ in range(2500))
    code = "".join(rnd.choice("abcdef(){};=") for _ in range(60))
    rows = [(9, unspaced), (8, prose), (7, prose[:900] + " " + unspaced[100:140] + " tail"), (6, "x" + code + "y " + prose[900:]), (5, code)]
    got = {r.doc_id: r for r in W.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert 0.25 < got[9].near_edited < 0.75
    grams = {i: {g.split(":")[0] for g in r.fingerprint.split(",")} for i, r in got.items()}
    assert grams[9] & grams[7] and grams[6] & grams[5] and grams[8] & grams[6]
    assert not grams[9] & grams[8]


def test_shared_bytes_of_long_words_are_found(spark):
    """PIECE + k + w - 2 shared bytes within long words leave a shared hash."""
    rnd, n = random.Random(5), W.PIECE + W.K + W.W - 2
    noise = lambda m: "".join(rnd.choice("abcdefghijklmnop") for _ in range(m))
    rows = []
    for i in range(40):
        shared = noise(n)
        rows.append((i, noise(rnd.randint(2, 90)) + shared + noise(rnd.randint(2, 90)),
                     "some words " * rnd.randint(0, 30) + noise(rnd.randint(2, 90)) + shared + noise(9) + " end"))
    df = spark.createDataFrame(rows, "i int, a string, b string").repartition(2)
    found = df.select(*[W.hashes(W.winnow(W.F.col(c))).alias(c) for c in "ab"]).filter(W.F.arrays_overlap("a", "b"))
    assert found.count() == 40
