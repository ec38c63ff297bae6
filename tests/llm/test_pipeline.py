"""The pipeline's stages against brute force on a small table."""

from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from ordermart.llm import near_dups, quality, secrets
from ordermart.llm.common import ship
from llm.test_near_dups import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_each_stage_takes_effect(spark):
    ship(spark)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    best = docs.join(labels.filter("quality = 1"), "doc_id").orderBy("doc_id").select(*docs.columns).first()
    told = spark.createDataFrame([(9000, best.text[:900] + ' token = "abcdef0123456789"', "en", "src0", 3)], docs.schema)
    docs = docs.unionByName(told).cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "secrets", "packing"]
    results, now = {}, docs
    for name, step in corpus_pipeline.STAGES:
        now = corpus_pipeline.stage(step(spark, now, SF001), f"t-{name}")
        results[name] = now
        if name != "packing":
            assert now.columns == COLUMNS

    rows = {n: sorted(tuple(r) for r in df.select(*COLUMNS).collect()) for n, df in results.items() if n != "packing"}
    kept = {r.doc_id for r in quality.classify(docs, labels).filter("predicted = 1").select("doc_id").collect()}
    assert [r[0] for r in rows["quality"]] == sorted(kept) and 0 < len(kept) < docs.count()
    # unlabelled or well labelled documents that are not junk stay
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good - kept) <= 0.1 * len(good)

    pairs = [(r[0], r[1]) for r in rows["quality"]]
    first = [d for d, _, _, stays in brute(pairs, near_dups.AT_80.percent) if stays]
    assert [r[0] for r in rows["near_dedup"]] == sorted(first)

    changed = 0
    for before, after in zip(rows["near_dedup"], rows["secrets"], strict=True):
        assert after[1] == secrets.redact(before[1]) and after[0] == before[0] and after[2:4] == before[2:4]
        changed += after[1] != before[1]
        assert after[4] == (len(after[1]) if after[1] != before[1] else before[4])
        assert not secrets.base_spans(after[1])
    assert changed

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = defaultdict(list)
    for r in results["packing"].collect():
        pieces[r.doc_id].append((r.start, r.ids))
    want = {r[0]: [*library.encode(r[1], add_special_tokens=False).ids, 1] for r in rows["secrets"]}
    assert {k: np.frombuffer(b"".join(p for _, p in sorted(v)), "<u4").tolist() for k, v in pieces.items()} == want


def test_stages_on_odd_rows(spark, odd, nothing, tmp_path):
    five = odd.select(*COLUMNS)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (five, nothing.select(*COLUMNS)):
        now = docs
        for name, step in corpus_pipeline.STAGES:
            now = corpus_pipeline.stage(step(spark, now, str(tmp_path)), f"t-{name}")
        assert (now.count() > 0) == (docs is five)


def test_run_is_registered(spark):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert "pipeline" not in __spark_entry__.oracle_sql()
