import numpy as np
from pyspark.sql import functions as F

from saletrace.llm import pu_quality as pu
from saletrace.llm.common import fold


def test_prior_of_a_known_mixture():
    r = np.random.default_rng(0)
    for prior in (0.3, 0.6, 0.85):
        pos = r.normal(2, 1, 6000)
        unl = np.where(r.random(6000) < prior, r.normal(2, 1, 6000), r.normal(-2, 1, 6000))
        assert abs(pu.estimate_prior(pos, unl) - prior) < 0.06


def test_risk_separates_without_negatives():
    r = np.random.default_rng(1)
    make = lambda n, at: r.normal(at, 1, (n, pu.N_FEATURES))
    pos, unl = make(3000, 0.5), np.concatenate([make(1800, 0.5), make(1200, -0.5)])
    n = pu.PuNetwork()
    n.scale(unl)
    n.train(pos, unl, 0.6)
    assert (n.raw(make(500, 0.5)) > 0).mean() > 0.9 and (n.raw(make(500, -0.5)) < 0).mean() > 0.9


def test_held_out_quality(spark, sf_small):
    base = sf_small.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    measured = pu.measure(docs)
    first = pu.score(measured, pu.fit(measured, labels))
    held = first.filter(fold(F.col("id"), 3) == 1).join(
        labels, first["id"] == labels["doc_id"]).toPandas()
    a, b = (held.score[held.quality == q].values for q in (1, 0))
    assert (a[:, None] > b[None, :]).mean() > 0.97
    # labels of held-out rows and labelled negatives are never read
    less = labels.filter((fold(F.col("doc_id"), 3) != 1) & (F.col("quality") == 1))
    known = labels.join(less, "doc_id", "left_anti").withColumn("quality", F.lit(0))
    again = pu.score(measured, pu.fit(measured, less.union(known.select(less.columns))))
    assert first.orderBy("id").collect() == again.orderBy("id").collect()


def test_operator_on_odd_rows(spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, clash=True)
    labels = spark.createDataFrame(
        [(2, 1, 0), (4, 1, 0), (4, 0, 0), (6, 1, 0), (None, 1, 0), (9, None, 0), (99, 1, 0)],
        "doc_id bigint, quality int, toxic int")
    for use in (labels, labels.limit(0)):
        out = pu.quality_scores(docs, use).collect()
        assert len(out) == len(odd_rows)
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.score for r in out} == {0.5}
    assert pu.quality_scores(docs.limit(0), labels).count() == 0
