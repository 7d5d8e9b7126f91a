import os
import sys

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from saletrace.llm import quality_rules, simhash
from saletrace.llm.common import read

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
import corpus_pipeline  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, make_docs, prose, odd_rows, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("tables"))
    item = prose(30, 5)
    rows = [(100 + i, prose(100, 100 + i), "en") for i in range(30)]
    rows += [(200, rows[0][1], "en"), (201, rows[0][1].upper(), "en"),
             (202, prose(60, 777) + " " + item + " " + prose(60, 778), "en"),
             (203, prose(60, 779) + " password=abcdef123 " + prose(10, 780), "en"),
             (204, "too short", "en"), (205, "again and again we say " * 30, "en")]
    make_docs(rows + odd_rows).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(r[0], 1, 0) for r in rows[:20]], "doc_id bigint, quality int, toxic int") \
        .write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string") \
        .write.parquet(f"{base}/benchmark.parquet")
    return base


def test_stages(spark, folder):
    docs = read(spark, folder, "documents")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stage(spark, seen[-1], folder))
    assert len(corpus_pipeline.STAGES) == 5
    assert all(d.columns == docs.columns for d in seen[:-1])
    ids = [[r.doc_id for r in d.select("doc_id").collect()] for d in seen]
    good, single, clean, masked, final = ids[1:]
    # quality: as brute force by the counts of each text
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    stats = [(i, dict(zip(quality_rules.FIELDS, quality_rules.text_stats(t or "")))) for i, t in texts]
    assert sorted(good) == sorted(i for i, s in stats if s["n_words"] >= 20
                                  and 100 * s["n_repeat_words"] <= 30 * s["n_words"])
    # near-duplicates: one row per group of fingerprints
    left = [(i, t) for i, t in texts if i in good]
    prints = {i: simhash.fingerprint(t or "") for i, t in left}
    for i in set(good):
        near = [j for j in prints if bin(prints[i] ^ prints[j]).count("1") <= 2]
        assert single.count(i) == (min(near) == i)
    assert 100 in single and 200 not in single and 201 not in single
    # benchmark, secrets, tokens
    assert set(single) - set(clean) == {202} and sorted(masked) == sorted(clean)
    text = {r.doc_id: r.text for r in seen[4].collect()}
    assert "password" not in text[203] and "[REDACTED]" in text[203]
    assert seen[4].filter("n_chars != length(text)").count() == 0
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in seen[5].collect():
        assert r.ids == exact.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)
    assert sorted(final) == sorted(masked)


def test_run_equals_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "n_tokens", "ids"] and out.count() > 20
