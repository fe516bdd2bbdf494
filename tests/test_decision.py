from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.operators import decision as D
from casewright.operators import metrics as M


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(1)
    y = rng.random(2000) < 0.3
    p = np.clip(rng.normal(np.where(y, 0.65, 0.3), 0.18), 0, 1)
    rows = [(i, bool(a), float(b)) for i, (a, b) in enumerate(zip(y, p))]
    return spark.createDataFrame(rows, "k int, sev boolean, p double").cache()


def test_expected_cost_by_hand(spark):
    y = (1, 1, 0, 0)
    for pred, want in (((1, 0, 0, 0), 1.25), ((1, 1, 1, 0), 0.25)):
        df = spark.createDataFrame(list(zip(y, pred)), "y int, f int")
        got = D.expected_cost(df, F.col("y") == 1, F.col("f") == 1, 5.0).first()[0]
        assert got == want


def test_sweep_matches_a_pass_per_threshold(scores):
    pdf = scores.toPandas()
    sweep = {r["threshold"]: r for r in D.threshold_sweep(scores, F.col("sev"), "p").collect()}
    assert len(sweep) == 97
    for t in (0.02, 0.17, 0.5, 0.98):
        flagged = pdf.p >= t
        assert sweep[t]["false_negatives"] == (pdf.sev & ~flagged).sum()
        assert sweep[t]["false_positives"] == (~pdf.sev & flagged).sum()
        assert sweep[t]["progressed_share"] == pytest.approx(flagged.mean())


def test_threshold_falls_as_misses_cost_more(scores):
    sweep = D.threshold_sweep(scores, F.col("sev"), "p")
    points = {r["cost_ratio"]: r["threshold"] for r in D.operating_points(sweep).collect()}
    assert points[3.0] >= points[5.0] >= points[10.0]
    with pytest.raises(KeyError):
        D.select_operating_point(sweep, 7.0)


def test_tie_goes_to_the_higher_threshold(spark):
    df = spark.createDataFrame([(True, 0.9), (False, 0.1)], "sev boolean, p double")
    sweep = D.threshold_sweep(df, F.col("sev"), "p")
    assert D.select_operating_point(sweep, 5.0).threshold == 0.9


def test_capacity_recall_rises(scores):
    table = D.capacity_analysis(scores, F.col("sev"), "p", "k").orderBy("capacity_fraction")
    recall = [r["severe_recall"] for r in table.collect()]
    assert recall == sorted(recall)


def test_cost_aware_class(spark):
    rows = [
        ([0.05, 0.05, 0.60, 0.20, 0.06, 0.04],),
        ([0.05, 0.05, 0.10, 0.60, 0.10, 0.10],),
        ([0.70, 0.20, 0.05, 0.03, 0.01, 0.01],),
        ([0.10, 0.10, 0.28, 0.32, 0.10, 0.10],),
        ([0.15, 0.20, 0.21, 0.40, 0.02, 0.02],),
    ]
    df = spark.createDataFrame(rows, "proba array<double>")
    for t in (0.2, 0.5):
        made = D.cost_aware_columns(F.col("proba"), t)
        for r in df.select(*[c.alias(n) for n, c in made.items()]).collect():
            assert (r["adjusted"] >= 4) == r["progress"]
    made = D.cost_aware_columns(F.col("proba"), 0.5)
    got = [tuple(r) for r in df.select(made["argmax"], made["adjusted"]).collect()]
    assert got == [(3, 3), (4, 4), (1, 1), (4, 4), (4, 3)]


def test_metrics_by_hand(spark):
    y, pred = (1, 2, 3, 4, 5, 6, 4, 3), (1, 2, 4, 3, 5, 6, 4, 3)
    rows = [(a, b, [1 / 6] * 6) for a, b in zip(y, pred)]
    df = spark.createDataFrame(rows, "y int, pred int, proba array<double>")
    m = M.compute_metrics(df).first()
    assert (m["accuracy"], m["severe_missed"], m["non_severe_progressed"]) == (0.75, 1.0, 1.0)
    assert m["exact_or_adjacent"] == 1.0
    assert m["severe_brier"] == pytest.approx(0.25)
    assert m["severe_roc_auc"] == pytest.approx(0.5)
    # Kappa through the confusion matrix.
    o = np.zeros((6, 6))
    for a, b in zip(y, pred):
        o[a - 1, b - 1] += 1
    w = (np.arange(6)[:, None] - np.arange(6)[None, :]) ** 2
    e = np.outer(o.sum(1), o.sum(0)) / o.sum()
    assert m["qwk"] == pytest.approx(1 - (w * o).sum() / (w * e).sum())


def test_degenerate_groups(spark):
    df = spark.createDataFrame([("a", 2, 2), ("a", 2, 2), ("b", 5, 1)], "g string, y int, pred int")
    rows = {r["g"]: r for r in M.point_metrics(df, by=["g"]).collect()}
    assert rows["a"]["qwk"] is None and rows["a"]["severe_recall"] == 0.0
    assert rows["b"]["severe_missed"] == 1.0 and rows["b"]["recall_2"] is None
    assert M.confusion(df).count() == 6
