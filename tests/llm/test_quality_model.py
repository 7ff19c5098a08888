"""Learning from positives and unlabelled texts: held-out accuracy and odd tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_model
from tidemark.llm.registry import table

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    weights, prior = quality_model.train(docs, labels)
    share = labels.agg(F.avg("quality")).first()[0]
    assert abs(prior - share) < 0.1
    rows = quality_model.score_quality(docs, weights).join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_prior_of_a_known_mixture():
    r = np.random.Generator(np.random.PCG64(5))
    p, n = r.normal(1, 1, (2000, 5)), r.normal(-1, 1, (600, 5))
    positive, unlabelled = p[:1000].astype(np.float32), np.concatenate([p[1000:], n]).astype(np.float32)
    prior = quality_model.class_prior(positive, r.permutation(unlabelled))
    # The classes overlap, so that the least ratio is an estimate.
    assert abs(prior - 1000 / 1600) < 0.12


def test_odd_tables(spark):
    rows = [(i, t, 0.5) for i, t in enumerate(["a b. " * 30, "", None, "x" * 300_000, "é", "a b. " * 30])] + [(None, "no id", 0.5), (0, "again", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1), (4, 0), (0, 1), (5, 1)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        weights, prior = quality_model.train(docs, known)
        scored = quality_model.score_quality(docs, weights).collect()
        assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored) and 0 < prior < 1
        assert {r.predicted for r in scored} <= {0, 1}
    assert quality_model.score_quality(docs.limit(0), weights).count() == 0
    quality_model.train(docs.limit(0), labels)


@pytest.mark.parametrize("doc_id", [0, 1, 7, 4711])
def test_fold(spark, doc_id):
    import zlib

    df = spark.createDataFrame([(doc_id,)], "doc_id long").select(quality_model.held_out().alias("h"))
    assert df.first().h == (zlib.crc32(str(doc_id).encode()) % 3 == 1)


def test_slopes_are_those_of_the_risk():
    r = np.random.Generator(np.random.PCG64(2))
    x, w = r.normal(size=(50, 6)), r.normal(size=6)
    _, gradient = quality_model.risk(x, w)
    for i, step in enumerate(np.eye(6) * 1e-5):
        numeric = (quality_model.risk(x, w + step)[0] - quality_model.risk(x, w - step)[0]) / 2e-5
        assert abs(numeric - gradient[i]) < 1e-7


def test_sums_are_those_of_all_rows(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) & 1 AS half").collect()
    x = np.stack([quality_model.features(row.text or "") for row in rows])
    r = np.random.Generator(np.random.PCG64(4))
    models = [r.normal(size=quality_model.N_FEATURES).astype(np.float32) for _ in range(2)]
    value, gradient = quality_model.risk(x, models[0])
    got = [quality_model.risk_everywhere(docs.repartition(n), models[0]) for n in (1, 7)]
    assert got[0][0] == got[1][0] and (got[0][1] == got[1][1]).all()
    assert abs(got[0][0] - value) < 1e-4 and np.abs(got[0][1] - gradient).max() < 1e-3
    scores = np.array([row @ models[1 - rows[i].half] for i, row in enumerate(x)])
    thresholds = np.array([-1.0, 0.0, 0.5])
    want = [len(x), *((scores >= t).sum() for t in thresholds)]
    assert quality_model.passing(docs.repartition(5), models, thresholds).tolist() == want


def test_correction_comes_to_rest_where_all_rows_do():
    """The sample lacks a kind of junk that the rest holds; the corrected fit finds it."""
    r = np.random.Generator(np.random.PCG64(8))
    one = lambda n, *c: np.concatenate([r.normal(c, 0.5, (n, 2)), np.ones((n, 1))], axis=1)
    positive, junk, rare = one(400, 1, 1), one(300, -1, 1), one(300, 1, -1)
    everything = np.concatenate([one(400, 1, 1), junk, rare])
    sample = np.concatenate([one(200, 1, 1), junk[:150], rare[:3]])
    w = quality_model.fit(positive, sample, 0.4)
    for _ in range(4):
        w = quality_model.fit(positive, sample, 0.4, 100, w, quality_model.risk(everything, w))
    straight = quality_model.fit(positive, everything, 0.4)
    agree = (everything @ w >= 0) == (everything @ straight >= 0)
    assert agree.mean() > 0.97 and (rare @ w < 0).mean() > 0.9


def test_a_small_sample_is_made_good(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    weights, _ = quality_model.train(docs, labels, quality_model.Sample(positives=200, unlabelled=100))
    rows = quality_model.score_quality(docs, weights).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9
