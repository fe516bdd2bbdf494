"""Isotonic curves of many groups at once: violators are pooled per bucket, then across buckets.

The least-squares monotone curve is unique and does not depend on the order in
which adjacent violators are pooled.  So each bucket of neighbouring scores is
pooled on its own, and only the blocks left over are pooled again across
buckets, ``FANIN`` of them at a time.  Rows of equal score are summed first; a
score that a third of all rows share is one row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.operators.ranking import WINDOW_ROWS, cumulative
from casewright.session import ensure_staged

# Rows (before equal scores are summed) of one bucket, and buckets pooled together a round.
BUCKET_ROWS = 100_000
FANIN = 16


@dataclass(frozen=True)
class Curve:
    """Knots of a piecewise-linear curve, rising in ``x``; constant outside them."""

    x: tuple[float, ...]
    y: tuple[float, ...]

    def at(self, values: np.ndarray) -> np.ndarray:
        """Zero everywhere where there are no knots (nothing was learnt)."""
        return np.interp(values, self.x, self.y) if self.x else np.zeros_like(values)


def pooled(low: np.ndarray, high: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Adjacent blocks in order of score, merged until their means rise strictly."""
    size = len(low)
    first, last = np.empty(size), np.empty(size)
    t, w = np.empty(size), np.empty(size)
    top = -1
    for i in range(size):
        top += 1
        first[top], last[top], t[top], w[top] = low[i], high[i], total[i], weight[i]
        while top and t[top - 1] * w[top] >= t[top] * w[top - 1]:
            top -= 1
            last[top] = last[top + 1]
            t[top] += t[top + 1]
            w[top] += w[top + 1]
    end = top + 1
    return first[:end], last[:end], t[:end], w[:end]


def isotonic_blocks(
    df: DataFrame,
    x: str,
    y: str,
    by: Sequence[str],
    *,
    bucket_rows: int = BUCKET_ROWS,
    fanin: int = FANIN,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Blocks of each group's rising least-squares curve: ``(by, low, high, total, weight)``.

    Rows with a null or NaN score, or a null ``y``, are left out; a group without
    rows has no blocks.  ``by`` has few combinations (folds, classes).  With
    ``y`` of 0 and 1, n rows leave at most some n^(2/3) blocks, since the means of
    the blocks are different fractions whose denominators sum to n.
    """
    by = list(by)
    kept = df.where(F.col(x).isNotNull() & ~F.isnan(x) & F.col(y).isNotNull())
    rows = ensure_staged(kept.select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    longest = rows.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    cum = cumulative(rows, "x", {"w": F.lit(1), "t": F.col("y")}, by, window_rows=window_rows)
    blocks = cum.select(
        *by,
        F.floor(F.col("w_before") / bucket_rows).cast("bigint").alias("_bucket"),
        F.col("x").alias("low"),
        F.col("x").alias("high"),
        F.col("t").cast("double").alias("total"),
        F.col("w").cast("double").alias("weight"),
    )
    names = ["low", "high", "total", "weight"]
    schema = blocks.schema

    def pool(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values("low")
        merged = pooled(*[ordered[c].to_numpy() for c in names])
        out = pd.DataFrame(dict(zip(names, merged)))
        for i, c in enumerate([*by, "_bucket"]):
            out.insert(i, c, frame[c].iloc[0])
        return out

    buckets = max(1, math.ceil(longest / bucket_rows))
    while True:
        blocks = blocks.groupBy(*by, "_bucket").applyInPandas(pool, schema)
        if buckets == 1:
            return blocks.drop("_bucket")
        buckets = math.ceil(buckets / fanin)
        blocks = blocks.withColumn("_bucket", F.floor(F.col("_bucket") / fanin).cast("bigint"))


def isotonic_curves(df: DataFrame, x: str, y: str, by: Sequence[str], **options) -> dict[tuple, Curve]:
    """A curve per group: both ends of each block carry its mean, straight lines between blocks."""
    by = list(by)
    blocks = isotonic_blocks(df, x, y, by, **options)
    found: dict[tuple, list[tuple[float, float, float]]] = {}
    for row in blocks.select(*by, "low", "high", (F.col("total") / F.col("weight")).alias("mean")).collect():
        found.setdefault(tuple(row[c] for c in by), []).append((row["low"], row["high"], row["mean"]))
    return {group: _curve(parts) for group, parts in found.items()}


def _curve(parts: list[tuple[float, float, float]]) -> Curve:
    knots = list(_knots(sorted(parts)))
    return Curve(tuple(k[0] for k in knots), tuple(k[1] for k in knots))


def _knots(parts: list[tuple[float, float, float]]) -> Iterator[tuple[float, float]]:
    for low, high, mean in parts:
        yield low, mean
        if high > low:
            yield high, mean
