"""The classifier's risk on a small table, minimised in one place without Spark."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barpath.llm import quality


def plain_minimum(unlabelled, positive, prior):
    """Mean and scale of the unlabelled rows, and the weights of least risk, by Newton steps over whole matrices."""
    mean = unlabelled.mean(axis=0)
    spread = unlabelled.std(axis=0)
    scale = np.where(spread > 1e-9, spread, 1.0)
    design = lambda x: np.column_stack([np.clip((x - mean) / scale, -quality.CLAMP, quality.CLAMP), np.ones(len(x))])
    u, p = design(unlabelled), design(positive)
    risk = lambda w: np.logaddexp(0, u @ w).mean() - prior * (p @ w).mean() + quality.RIDGE / 2 * w @ w
    negative = lambda w: np.logaddexp(0, u @ w).mean() - prior * np.logaddexp(0, p @ w).mean()
    w = np.zeros(u.shape[1])
    for _ in range(200):
        q = 1 / (1 + np.exp(-u @ w))
        gradient = u.T @ q / len(u) - prior * p.mean(axis=0) + quality.RIDGE * w
        hessian = (u * (q * (1 - q))[:, None]).T @ u / len(u) + quality.RIDGE * np.eye(len(w))
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while risk(w - size * step) > risk(w) + 1e-15 and size > 1e-9:
            size /= 2
        w = w - size * step
    return mean, scale, w, risk, negative


@pytest.mark.parametrize("prior", [0.5, 0.7])
def test_fit_is_the_least_risk(spark, prior):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    prose = lambda: " ".join(word().capitalize() + rng.choice(["", "", ",", "."]) for _ in range(rng.randint(20, 80))) + "."
    junk = lambda: " ".join(word() + rng.choice(["", "!", "|", "#", " "]) for _ in range(rng.randint(5, 60)))
    texts = [(prose() if rng.random() < 0.7 else junk()) for _ in range(200)]
    good = [prose() if rng.random() < 0.9 else junk() for _ in range(60)]
    rows = [(t, False) for t in texts] + [(t, True) for t in good]
    sample = quality.with_features(spark.createDataFrame(rows, "text string, __good boolean")).select("__x", "__good").repartition(3)
    model = quality.fit(sample, prior, steps=60)
    as_stored = lambda xs: np.array([quality.features(t) for t in xs], dtype=np.float32).astype(float)
    mean, scale, w, risk, negative = plain_minimum(as_stored(texts), as_stored(good), prior)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    assert negative(model.weights) >= 0
    if negative(w) < 0:  # the least unbiased risk overfits: the fit stops where the part for negatives would go below zero
        assert prior == 0.7 and risk(model.weights) > risk(w)
        return
    assert prior == 0.5
    assert risk(model.weights) - risk(w) < 1e-5
    z = np.column_stack([np.clip((as_stored(texts) - mean) / scale, -quality.CLAMP, quality.CLAMP), np.ones(len(texts))])
    plain = 1 / (1 + np.exp(-z @ w))
    assert np.abs(model.score(as_stored(texts)) - plain).max() < 0.02
    assert ((plain >= quality.THRESHOLD) == (model.score(as_stored(texts)) >= quality.THRESHOLD)).mean() > 0.98
    assert sample.where(F.col("__good")).count() == 60
