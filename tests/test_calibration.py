"""Isotonic curves against the min-max formula, calibrated models, and attribution walks."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewright.models import isotonic
from casewright.models.baselines import Majority
from casewright.models.isotonic import Curve, isotonic_blocks, isotonic_curves
from casewright.models.validation import CalibratedModel, fit_calibrated
from casewright.operators import explain as X
from casewright.sources.artefacts import _pack, _unpack


def min_max(x, y):
    """The isotonic fit by its formula: largest lower, smallest upper mean around each value."""
    values = np.unique(x)
    total = np.array([y[x == v].sum() for v in values])
    weight = np.array([(x == v).sum() for v in values], dtype=float)
    t, w = np.concatenate([[0], np.cumsum(total)]), np.concatenate([[0], np.cumsum(weight)])
    fit = [
        max(min((t[k] - t[j]) / (w[k] - w[j]) for k in range(i + 1, len(t))) for j in range(i + 1))
        for i in range(len(values))
    ]
    return values, np.array(fit)


@pytest.fixture(scope="module")
def scores():
    rng = np.random.default_rng(4)
    n = 400
    x = np.round(rng.random(n), 2)
    x[:130] = 0.5  # a third of all rows share one score
    return pd.DataFrame({"g": rng.integers(0, 2, n), "x": x, "y": (rng.random(n) < x**2).astype(float)})


@pytest.mark.parametrize("bucket_rows,fanin,window_rows", [(5, 2, 7), (40, 3, 1000), (isotonic.BUCKET_ROWS, 16, 1000)])
def test_isotonic_blocks_by_formula(spark, scores, bucket_rows, fanin, window_rows):
    df = spark.createDataFrame(scores).repartition(3)
    curves = isotonic_curves(df, "x", "y", ["g"], bucket_rows=bucket_rows, fanin=fanin, window_rows=window_rows)
    assert set(curves) == {(0,), (1,)}
    for (g,), curve in curves.items():
        part = scores[scores.g == g]
        values, fit = min_max(part.x.to_numpy(), part.y.to_numpy())
        assert np.allclose(curve.at(values), fit, atol=1e-12)
        assert np.all(np.diff(curve.x) > 0) and np.all(np.diff(curve.y) >= 0)


def test_isotonic_leaves_out_rows_without_score_or_target(spark):
    rows = [(0, 0.1, 0.0), (0, None, 1.0), (0, float("nan"), 1.0), (0, 0.2, None), (0, 0.3, 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    assert isotonic_curves(df, "x", "y", ["g"]) == {(0,): Curve((0.1, 0.3), (0.0, 1.0))}
    assert isotonic_blocks(df.where("false"), "x", "y", ["g"]).count() == 0


def test_pooling_keeps_rising_blocks_apart():
    one = np.ones(4)
    at = np.arange(4.0)
    first, last, total, weight = isotonic.pooled(at, at, np.array([0.0, 2.0, 1.0, 3.0]), one)
    assert first.tolist() == [0, 1, 3] and last.tolist() == [0, 2, 3]
    assert (total / weight).tolist() == [0.0, 1.5, 3.0]


class Stated:
    """A scorer whose probabilities lie in a column of the table."""

    def score(self, df, out="proba"):
        return df.withColumn(out, F.col("p"))


def test_calibrated_scores(spark):
    curves = [Curve((0.0, 1.0), (0.0, 0.5)), Curve((0.2,), (0.4,)), Curve((), ())]
    model = CalibratedModel([(Stated(), curves), (Stated(), [Curve((), ())] * 3)], (1, 2, 3))
    df = spark.createDataFrame(
        [(1, [0.8, 0.1, 0.1]), (2, None), (3, [None, 0.5, 0.5])], "k int, p array<double>"
    )
    got = {r["k"]: r["proba"] for r in model.score(df).collect()}
    assert got[1] == pytest.approx([(0.5 + 1 / 3) / 2, (0.5 + 1 / 3) / 2, (0 + 1 / 3) / 2])
    assert got[2] is None and got[3] is None
    assert model.score(df.where("false")).count() == 0


def test_fit_calibrated_learns_each_fold_and_is_saved(spark):
    rng = np.random.default_rng(9)
    n = 600
    y = rng.integers(1, 4, n)
    p = rng.dirichlet([1, 1, 1], n)
    p[np.arange(n), y - 1] += 0.5
    p /= p.sum(1, keepdims=True)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(n), "y": y, "p": p.tolist()}))
    model = fit_calibrated(df, lambda rows: Stated(), "y", "k", classes=(1, 2, 3), k=3)
    assert len(model.members) == 3 and all(len(curve.x) > 2 for _, own in model.members for curve in own)
    scored = model.score(df).toPandas()
    proba = np.stack(scored["proba"])
    assert np.allclose(proba.sum(1), 1)
    truth = np.eye(3)[scored["y"] - 1]
    raw = np.stack(scored["p"])
    assert ((proba - truth) ** 2).sum() < ((raw - truth) ** 2).sum()
    # Curves survive storage; the member stands in for a fitted one.
    kept = CalibratedModel([(Majority((1, 2, 3), (0.5, 0.3, 0.2)), own) for _, own in model.members], (1, 2, 3))
    back = _unpack(_pack(kept, []), "")
    assert [list(own) for _, own in back.members] == [list(own) for _, own in kept.members]


# --- Attribution walks --------------------------------------------------------------------------


def plain_walk(x, background, order, expected):
    """One row, one feature a step, on whole copies of the background."""
    mixed = background.copy()
    gains, last = np.zeros(len(x)), expected(mixed).mean()
    for j in order:
        mixed[:, j] = x[j]
        now = expected(mixed).mean()
        gains[j], last = now - last, now
    return gains


@pytest.mark.parametrize("cells", [1, 50, X.WALK_CELLS])
def test_walks_equal_a_row_at_a_time(spark, monkeypatch, cells):
    monkeypatch.setattr(X, "WALK_CELLS", cells)
    rng = np.random.default_rng(2)
    d, n = 5, 60
    x, background, beta = rng.normal(size=(n, d)), rng.normal(size=(7, d)), rng.normal(size=d)

    def squashed(score):
        return 1 / (1 + np.exp(-score)) + 0.1 * score**2

    def expected(matrix):
        return squashed(matrix @ beta)

    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(n), "x": x.tolist()})).repartition(3)
    hashes = {r["k"]: r["h"] for r in df.select("k", F.xxhash64(F.lit(42), "k").alias("h")).collect()}
    general = {r["k"]: r for r in X.severity_attributions(df, "k", "x", background, expected).collect()}
    linear = {r["k"]: r for r in X.severity_attributions(df, "k", "x", background, squashed, weights=beta).collect()}
    assert set(general) == set(linear) == set(range(n))
    for k in range(n):
        order = X._walk_orders(42, np.array([hashes[k]]), d)[0]
        assert sorted(order) == list(range(d))
        want = (plain_walk(x[k], background, order, expected) + plain_walk(x[k], background, order[::-1], expected)) / 2
        for got in (general[k], linear[k]):
            assert np.allclose(got["values"], want, atol=1e-12)
            assert got["base"] + sum(got["values"]) == pytest.approx(got["prediction"], abs=1e-9)


def test_walk_orders_are_spread():
    orders = X._walk_orders(1, np.arange(-3000, 3000, dtype=np.int64), 4)
    first = np.bincount(orders[:, 0], minlength=4) / len(orders)
    assert np.allclose(first, 0.25, atol=0.03)
    assert len({tuple(o) for o in orders.tolist()}) == 24


def test_expected_class_is_that_of_the_probabilities():
    from casewright.models import ordered_logit as O

    score = np.concatenate([np.linspace(-45, 45, 2001), [-1e6, 1e6]])
    for cuts, values in (([-2.0, -1.0, 0.5, 2.0, 30.0], [1, 2, 3, 4, 5, 6]), ([0.3], [2.0, 7.5])):
        got = O.expected_classes(score, np.array(cuts), np.array(values, float))
        want = O.probabilities(score, np.array(cuts)) @ np.array(values, float)
        assert np.allclose(got, want, atol=1e-9) and got.min() >= values[0] and got.max() <= values[-1]
