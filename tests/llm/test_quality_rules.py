import math
import random

import pytest
from pyspark.sql import functions as F

from saletrace.llm import quality_rules as q
from saletrace.llm import textstats


def naive_stats(text):
    text = text or ""
    white = " \t\n\r\x0b\x0c"
    words, now = [], ""
    for c in text + " ":
        if c in white:
            if now:
                words.append(now)
            now = ""
        else:
            now += c
    lines = [x for x in text.split("\n") if x.strip(white)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 2000 else set()
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_counts_equal_brute_force(odd_rows):
    r = random.Random(1)
    texts = [t for _, t in odd_rows if len(t or "") < 20_000]
    for _ in range(300):
        words = r.choices(["a", "bb", "ñ#", "<|>", "日本", "x\u00a0y", "z\u2028"], k=r.randint(0, 60))
        texts.append("".join(w + r.choice([" ", " ", "\n", "\t", "\r\n", "\x0b", "\n\n", "  "])
                             for w in words))
    for t in texts:
        got = dict(zip(textstats.FIELDS, textstats.text_stats(t or "")))
        assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"],
                got["n_repeat_words"]) == naive_stats(t), repr(t)


def test_binomial_bound():
    for k, n, d in ((0, 50, 0.05), (3, 200, 0.01), (40, 90, 0.1), (5, 5, 0.1), (0, 0, 0.1)):
        p = q.binomial_upper(k, n, d)
        if k >= n:
            assert p == 1
        else:
            tail = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
            assert tail == pytest.approx(d, rel=1e-6)


def labelled(prose, n):
    good = [(i, prose(80 + i % 50, i), "en" if i % 3 else "fr") for i in range(n)]
    junk = [(n + i, " ".join(w + "###" for w in prose(60, i).split()), "en") for i in range(200)]
    return good, junk


def test_risk_is_controlled(spark, make_docs, prose):
    good, junk = labelled(prose, 3000)
    docs = make_docs(good + junk)
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in good] + [(i, 0, 0) for i, *_ in junk],
                                   "doc_id bigint, quality int, toxic int")
    measured = q.measure(docs)
    cut = {r.stratum: r for r in q.fit_thresholds(measured, labels, alpha=0.02).collect()}
    assert set(cut) == {"en", "fr"} and all(r.bound <= 0.02 for r in cut.values())
    kept = {r.id: r.kept for r in q.judge(measured, q.fit_thresholds(measured, labels, 0.02)).collect()}
    assert sum(not kept[i] for i, *_ in good) <= 0.02 * len(good)
    assert not any(kept[i] for i, *_ in junk)
    # the certified rungs, by brute force on all labels: each one up to the
    # last holds at the level it was tested at
    stats = {r.id: (r.stratum, r.m) for r in
             measured.filter(~q.base_failed()).select("id", "stratum", q.metric_array().alias("m"))
             .collect()}
    for name, row in cut.items():
        own = [i for i, _, x in good if x == name and i in stats]
        wrong = sum(any(a > b for a, b in zip(stats[i][1], row.cutoffs)) for i in own)
        assert q.binomial_upper(wrong, len(own), row.level) == pytest.approx(row.bound)
        assert list(row.cutoffs) == q.ladder()[row.rung] and row.level >= 0.05 / 2


def test_ladder_is_nested():
    rungs = q.ladder()
    assert rungs[0] == [q.LOOSE[m] for m in q.METRICS]
    assert rungs[-1] == pytest.approx([q.STRICT[m] for m in q.METRICS])
    assert all(a >= b for x, y in zip(rungs, rungs[1:]) for a, b in zip(x, y))


def test_levels_are_handed_on():
    """311 documents cannot be certified at a quarter of the level, but can at
    the whole of it, which three finished strata hand over."""
    done, small = (500, [0] * 6), (311, [0] * 6)
    best = q.certify({"a": done, "b": done, None: done, "d": small}, 0.01, 0.05)
    assert {s: j for s, (j, *_) in best.items()} == {"a": 5, "b": 5, None: 5, "d": 5}
    assert best["d"][2] == pytest.approx(0.05)
    best = q.certify({"a": done, "b": (500, [0, 0, 9, 9, 9, 9]), "c": done, "d": small}, 0.01, 0.05)
    assert {s: j for s, (j, *_) in best.items()} == {"a": 5, "b": 1, "c": 5}
    assert q.certify({"d": (298, [0] * 6)}, 0.01, 0.05) == {}


def test_family_error_is_bounded():
    """Strata whose last rung rejects just over ``alpha``: it may be certified
    in any of them in at most ``delta`` of the trials."""
    r = random.Random(3)
    alpha, delta, trials, wrong = 0.02, 0.1, 400, 0
    for _ in range(trials):
        counts = {}
        for s in "abc":
            late = sum(r.random() < alpha * 1.001 for _ in range(400))
            counts[s] = (400, [0, late])
        wrong += any(j == 1 for j, *_ in q.certify(counts, alpha, delta).values())
    assert wrong <= trials * (delta + 3 * math.sqrt(delta * (1 - delta) / trials))


def test_null_language_is_its_own_stratum(spark, prose):
    rows = [(i, prose(60 + i % 9, i), None if i % 2 else "") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, *_ in rows], "doc_id bigint, quality int")
    measured = q.measure(docs)
    cut = q.fit_thresholds(measured, labels)
    assert {r.stratum for r in cut.collect()} <= {None, ""} and cut.count() == 2
    assert q.judge(measured, cut).count() == 800
    # levels of one stratum say nothing about the other
    only = q.judge(measured, cut.filter("stratum is null").withColumn(
        "cutoffs", F.expr("transform(cutoffs, x -> -1D)")))
    assert {(r.stratum, r.kept) for r in only.collect()} == {(None, False), ("", True)}


def test_operator_on_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, clash=True)
    labels = spark.createDataFrame([(6, 1, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (7, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    for use in (labels, labels.limit(0)):  # too few labels: the base rule alone
        out = q.quality_verdicts(docs, use).collect()
        assert len(out) == len(odd_rows)
        assert all(r.kept == (not r.base_failed) for r in out)
        kept = q.keep_good(docs, use)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(r.id for r in out if r.kept)
    assert q.quality_verdicts(docs.limit(0), labels).count() == 0
    assert q.keep_good(docs.limit(0), labels).count() == 0
