"""Distributed ranks and quantiles against brute force, with the bucketed way forced."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from casewright.operators import association as A
from casewright.operators import decision as D
from casewright.operators import metrics as M
from casewright.operators import prep, ranking

SMALL = 7  # window size that sends even tiny tables through the buckets


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3000
    value = np.round(rng.lognormal(0, 2, n), 3)
    value[: n // 3] = 1.5  # a third of all rows share one value
    value[-40:] = np.nan
    return pd.DataFrame(
        {
            "k": np.arange(n),
            "g": np.where(rng.random(n) < 0.8, "big", "small"),
            "v": value,
            "w": rng.integers(0, 3, n),
            "y": rng.integers(1, 7, n),
        }
    )


def to_spark(spark, frame):
    return spark.createDataFrame(frame).withColumn("v", F.nanvl("v", F.lit(None)))


@pytest.mark.parametrize("window_rows", [1, SMALL, 100, ranking.WINDOW_ROWS])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_cumulative(spark, frame, window_rows, by):
    df = to_spark(spark, frame)
    out = ranking.cumulative(df, "v", {"n": F.lit(1), "w": F.col("w")}, by, window_rows=window_rows)
    got = out.toPandas().sort_values([*by, "v"]).reset_index(drop=True)
    kept = frame.dropna(subset=["v"])
    want = kept.groupby([*by, "v"]).agg(n=("k", "size"), w=("w", "sum")).reset_index()
    groups = want.groupby(by) if by else [((), want)]
    before = pd.concat([g[["n", "w"]].cumsum() - g[["n", "w"]] for _, g in groups]).sort_index()
    assert (got["n"].to_numpy() == want["n"].to_numpy()).all()
    assert (got["n_before"].to_numpy() == before["n"].to_numpy()).all()
    assert (got["w_before"].to_numpy() == before["w"].to_numpy()).all()
    totals = got.groupby(by)["n_total"].max() if by else got["n_total"].max()
    assert totals.sum() == len(kept)


@pytest.mark.parametrize("window_rows", [SMALL, ranking.WINDOW_ROWS])
def test_quantiles(spark, frame, window_rows):
    probs = {"a": 0.0, "b": 0.05, "c": 0.5, "d": 0.951, "e": 1.0}
    df = to_spark(spark, frame)
    out = ranking.exact_quantiles(df, "v", probs, ["g"], window_rows=window_rows).collect()
    for row in out:
        want = frame.loc[frame.g == row["g"], "v"].quantile(list(probs.values()))
        assert np.allclose([row[n] for n in probs], want, rtol=0, atol=1e-9)


def test_result_does_not_depend_on_partitions(spark, frame):
    df = to_spark(spark, frame)
    runs = [
        sorted(
            tuple(r)
            for r in ranking.cumulative(
                df.repartition(p), "v", {"n": F.lit(1)}, ["g"], window_rows=SMALL
            ).collect()
        )
        for p in (1, 8)
    ]
    assert runs[0] == runs[1]


@pytest.mark.parametrize("band", [0.04, 1e-6])
def test_medians_with_and_without_a_useful_band(spark, frame, band):
    df = to_spark(spark, frame)
    masks = {"all": F.lit(1), "odd": F.col("k") % 2 == 1}
    out = {r["column"]: r for r in prep.medians(df, ["v", "y"], masks, band=band).collect()}
    odd = frame[frame.k % 2 == 1]
    for c in ("v", "y"):
        assert out[c]["all"] == pytest.approx(frame[c].median())
        assert out[c]["odd"] == pytest.approx(odd[c].median())


def test_auc_and_average_precision_by_brute_force(spark, frame):
    kept = frame.dropna(subset=["v"])
    positive = (kept.y >= 4).to_numpy()
    score = kept.v.to_numpy()
    pairs = score[positive][:, None] - score[~positive][None, :]
    auc = (np.sum(pairs > 0) + 0.5 * np.sum(pairs == 0)) / pairs.size
    ap, last = 0.0, 0.0
    for t in np.sort(np.unique(score))[::-1]:
        chosen = score >= t
        recall = (chosen & positive).sum() / positive.sum()
        ap += (recall - last) * (chosen & positive).sum() / chosen.sum()
        last = recall
    df = to_spark(spark, kept)
    for rows in (SMALL, ranking.WINDOW_ROWS):
        got = M.ranking_metrics(df, F.col("y") >= 4, "v", window_rows=rows).first()
        assert got["severe_roc_auc"] == pytest.approx(auc)
        assert got["severe_pr_auc"] == pytest.approx(ap)


def test_spearman_and_ks_by_brute_force(spark, frame):
    kept = frame.dropna(subset=["v"])
    df = to_spark(spark, frame)
    got = A.spearman(df, [("v", "y")], window_rows=SMALL).first()
    assert got["spearman"] == pytest.approx(kept["v"].rank().corr(kept["y"].rank()))
    a, b = frame[frame.g == "big"], frame[frame.g == "small"]
    grid = np.sort(kept.v.unique())
    curves = [
        np.searchsorted(np.sort(x.v.dropna()), grid, side="right") / x.v.notna().sum()
        for x in (a, b)
    ]
    ks = A.kolmogorov_smirnov(
        df.where("g = 'big'"), df.where("g = 'small'"), ["v"], window_rows=SMALL
    ).first()
    assert ks["statistic"] == pytest.approx(np.abs(curves[0] - curves[1]).max())


@pytest.mark.parametrize("heavy_share", [1e-3, 0.2, 1.1])
def test_spearman_matrix_by_brute_force(spark, frame, heavy_share):
    """Pairwise-complete ranks with differing null patterns; hot values looked up, joined, or both."""
    rng = np.random.default_rng(8)
    pdf = frame.assign(
        z=np.where(rng.random(len(frame)) < 0.3, np.nan, frame.v.fillna(0) + rng.normal(0, 5, len(frame))),
        one=1.0,
        none=np.nan,
    )
    names = ["v", "w", "y", "z", "one", "none"]
    df = spark.createDataFrame(pdf).withColumns({c: F.nanvl(c, F.lit(None)) for c in ("v", "none")}).repartition(3)
    got = A.spearman_matrix(df, names, window_rows=SMALL, heavy_share=heavy_share).collect()
    assert [(r["a"], r["b"]) for r in got] == [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    for r in got:
        both = pdf[[r["a"], r["b"]]].dropna()
        assert r["n"] == len(both)
        if "one" in (r["a"], r["b"]) or "none" in (r["a"], r["b"]):
            assert r["spearman"] is None
        else:
            assert r["spearman"] == pytest.approx(both[r["a"]].rank().corr(both[r["b"]].rank()), abs=1e-9)


def test_spearman_matrix_of_an_empty_table(spark, frame):
    got = A.spearman_matrix(to_spark(spark, frame).where("false"), ["v", "y"]).collect()
    assert [tuple(r) for r in got] == [("v", "y", 0, None)]


def test_variance_inflation_by_brute_force(spark, frame):
    pdf = frame.assign(z=frame.v.fillna(2.0) + frame.y, one=1.0)
    got = A.variance_inflation(to_spark(spark, pdf).repartition(5), {"v": 2.0, "w": 0.0, "y": 0.0, "z": 0.0, "one": 0.0})
    got = {r["column"]: r["vif"] for r in got.collect()}
    x = pdf[["v", "w", "y"]].fillna(2.0).to_numpy(float)
    w = x[:, 1]
    rest = pdf[["v", "y"]].fillna(2.0).to_numpy(float)
    left = w - rest @ np.linalg.lstsq(rest, w, rcond=None)[0]
    assert set(got) == {"v", "w", "y", "z"}  # z is v + y: the pseudo-inverse stays finite
    assert got["w"] == pytest.approx((w @ w) / (left @ left))


@pytest.mark.parametrize("window_rows", [SMALL, ranking.WINDOW_ROWS])
def test_capacity_with_a_hot_score(spark, frame, window_rows):
    kept = frame.dropna(subset=["v"])
    df = to_spark(spark, kept)
    fractions = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = D.capacity_analysis(
        df, F.col("y") >= 4, "v", "k", fractions=fractions, window_rows=window_rows
    )
    order = kept.sort_values(["v", "k"], ascending=[False, True])
    for row in got.collect():
        k = round(row["capacity_fraction"] * len(kept))
        chosen = order.head(k)
        assert row["cases_progressed"] == k
        assert row["severe_missed"] == (kept.y >= 4).sum() - (chosen.y >= 4).sum()
        assert row["implied_threshold"] == (chosen.v.iloc[-1] if k else 1.0)


def test_tails():
    from casewright.functions.tails import chi_square_tail, kolmogorov_tail

    # Textbook 5 % points.
    for dof, point in ((1, 3.841459), (2, 5.991465), (5, 11.070498), (10, 18.307038)):
        assert chi_square_tail(point, dof) == pytest.approx(0.05, abs=1e-6)
    assert kolmogorov_tail(1.358 / np.sqrt(500), 1000, 1000) == pytest.approx(0.05, abs=5e-4)


def test_spearman_matrix_deals_rows_to_tasks_of_bounded_size(spark, frame, monkeypatch):
    df = to_spark(spark, frame)
    dealt, plain = [], type(df).repartition
    monkeypatch.setattr(type(df), "repartition", lambda self, *a: dealt.append(a) or plain(self, *a))
    whole = A.spearman_matrix(df, ["v", "y"], heavy_share=1.0).collect()
    assert dealt == []
    parted = A.spearman_matrix(df, ["v", "y"], heavy_share=1.0, task_cells=50).collect()
    cells = frame[["v", "y"]].count().sum()
    assert dealt == [(-(-int(cells) // 50), "_id")] * 2
    assert [tuple(r)[:3] for r in parted] == [tuple(r)[:3] for r in whole]
    assert [r["spearman"] for r in parted] == pytest.approx([r["spearman"] for r in whole], abs=1e-12)
