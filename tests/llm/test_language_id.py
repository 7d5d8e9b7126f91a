import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from saletrace.llm import language_id as lid


def test_viterbi_equals_all_paths():
    r = np.random.default_rng(0)
    scores = [r.normal(0, 3, (n, 3)).astype(np.float32) for n in (1, 2, 5, 7, 0, 6)]
    for s, path in zip(scores, lid.viterbi(scores, 2.5)):
        assert len(path) == len(s)
        if len(s):
            value = lambda p: sum(s[t, k] for t, k in enumerate(p)) - 2.5 * sum(
                a != b for a, b in zip(p, p[1:]))
            best = max(value(p) for p in itertools.product(range(3), repeat=len(s)))
            assert abs(value(path.tolist()) - best) < 1e-4


def test_scripts():
    assert [lid.script_of(w) for w in ("word", "слово", "λόγος", "语言", "ことば", "كلمة", "naïve")] \
        == ["Latin", "Cyrillic", "Greek", "Han", "Kana", "Arabic", "Latin"]


@pytest.fixture(scope="module")
def mixed(spark, make_docs):
    r = random.Random(1)
    vocab = {"aa": ["th", "ing", "er", "on"], "bb": ["sch", "ung", "ich", "ein"],
             "ru": ["ст", "ов", "ни", "пр"]}
    word = lambda x: "".join(r.choices(vocab[x], k=r.randint(1, 4)))
    text = lambda x, n: " ".join(word(x) for _ in range(n))
    rows = [(i, text(x, 60), x) for i, x in enumerate(["aa", "bb", "ru"] * 40)]
    return rows, text


def test_spans_of_mixed_text(spark, make_docs, mixed):
    rows, text = mixed
    model = lid.fit(make_docs(rows))
    a, b, c = text("aa", 50), text("bb", 30), text("ru", 12)
    x = f"{a}. {b}\n{c} 42"
    (lang, score, spans), = lid.label([x], model)
    assert lang == "aa" and 0 < score < 1
    assert [s[2] for s in spans] == ["aa", "bb", "ru"]
    assert abs(spans[1][0] - len(a) - 2) < 12 and abs(spans[2][0] - len(a) - len(b) - 3) < 12
    assert spans[0][0] == 0 and spans[-1][1] == len(x)
    # a lone foreign word does not cut the span
    assert len(next(iter(lid.label([f"{a} {text('bb', 1)} {text('aa', 30)}"], model)))[2]) == 1


def test_operator_on_odd_rows(spark, make_docs, mixed, odd_rows):
    rows, _ = mixed
    docs = make_docs(rows + odd_rows, clash=True)
    model = lid.fit(docs)
    out = lid.languages(docs, model)
    assert out.count() == len(rows) + len(odd_rows)
    got = {r.doc_id: r for r in out.filter("doc_id < 4 or doc_id is null").collect()}
    assert lid.languages(docs.limit(0), lid.fit(docs.limit(0))).count() == 0
    bare = docs.filter("doc_id = 8 and lang is null")
    none = lid.languages(bare, lid.fit(bare)).first()
    assert (none.lang_pred, none.score) == ("und", 0.0)
    empty = [r for r in out.collect() if r.lang_pred == "und"]
    assert len(empty) == sum(not any(c.isalpha() for c in t or "") for _, t in odd_rows)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(sf_small.replace("0.001", "0.01") + "/documents.parquet")
    model = lid.fit(docs)
    held = lid.languages(docs, model).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    # the labels of held-out rows are never read
    lost = docs.withColumn("lang", F.when(lid.fold(F.col("doc_id"), 4) != 2, F.col("lang")))
    assert np.array_equal(lid.fit(lost).logp, model.logp)


def test_rare_language_is_learned(spark, make_docs):
    """Few rows among many, more rows than the sample takes."""
    rows = [(k, "the house and the garden of the man", "en") for k in range(6000)]
    rows += [(10_000 + k, "das haus und der garten von dem mann", "de") for k in range(40)]
    docs = make_docs(rows)
    model = lid.fit(docs, sample=30)
    assert model.langs == ["de", "en"]
    counts = {"en": 5_000_000, "de": 3_000_000, "rare": 30, "few": 3000}
    rates = {x: lid._rate(n, counts, 8000) for x, n in counts.items()}
    assert rates["rare"] == 1 and 990 <= rates["few"] * 3000 <= 1010
    assert sum(rates[x] * n for x, n in counts.items()) <= 8000
    assert lid._rate(5, {"en": 7000, "de": 5}, 8000) == 1


def test_many_languages_and_a_long_text_among_short_ones():
    """150 languages; a text of 300,000 words is not padded with 127 others."""
    import tracemalloc

    import numpy as np

    from saletrace.llm import language_id
    r = np.random.default_rng(1)
    scores = []
    for n in (0, 1, 7, 40):
        s = r.normal(0, 0.1, (n, 150)).astype(np.float32)
        s[:, 140] += 50
        scores.append(s)
    paths = language_id.viterbi(scores)
    assert [set(p.tolist()) for p in paths] == [set(), {140}, {140}, {140}]
    scores = [r.normal(size=(n, 4)).astype(np.float32) for n in [300_000] + [20] * 127]
    tracemalloc.start()
    paths = language_id.viterbi(scores)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(p) for p in paths] == [len(s) for s in scores] and peak < 60_000_000
    alone = language_id.viterbi([scores[5]])
    assert (paths[5] == alone[0]).all()
