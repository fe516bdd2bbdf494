"""Floor models: the majority class and a one-feature lookup rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.functions.cells import number
from casewright.functions.probability import count_below
from casewright.operators.ranking import exact_quantiles

# Weight of the chosen class and of every other class.
CHOSEN, OTHER = 1.0, 0.02


def class_counts(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class, ascending; one row per class reaches the driver."""
    counted = df.where(F.col(label).isNotNull()).groupBy(label).count().collect()
    return {int(r[0]): int(r[1]) for r in sorted(counted)}


@dataclass(frozen=True)
class Majority:
    classes: tuple[int, ...]
    prior: tuple[float, ...]

    @property
    def winner(self) -> int:
        return self.classes[self.prior.index(max(self.prior))]

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        return df.withColumn(out, F.array(*[F.lit(p) for p in self.prior]))


def fit_majority(df: DataFrame, label: str) -> Majority:
    counts = class_counts(df, label)
    total = sum(counts.values())
    return Majority(tuple(counts), tuple(n / total for n in counts.values()))


@dataclass(frozen=True)
class OneFeatureRule:
    """Class by cut-points midway between consecutive class medians of one column.

    A class without any value of the column has no median and is not predicted.
    """

    feature: str
    classes: tuple[int, ...]
    cuts: tuple[float, ...]
    fallback: int
    predicted: tuple[int, ...]

    def predict(self):
        value = number(F.col(self.feature))
        if not self.predicted:
            return F.lit(self.fallback)
        labels = F.array(*[F.lit(c) for c in self.predicted])
        return F.when(value.isNull(), F.lit(self.fallback)).otherwise(
            F.get(labels, count_below(value, self.cuts))
        )

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        total = CHOSEN + OTHER * (len(self.classes) - 1)
        chosen = self.predict()
        parts = [
            F.when(chosen == c, F.lit(CHOSEN / total)).otherwise(F.lit(OTHER / total))
            for c in self.classes
        ]
        return df.withColumn(out, F.array(*parts))


def fit_one_feature_rule(df: DataFrame, feature: str, label: str) -> OneFeatureRule:
    narrow = df.select(label, number(F.col(feature)).alias("value")).where(
        F.col(label).isNotNull()
    )
    middle = {
        int(r[label]): r["m"]
        for r in exact_quantiles(narrow, "value", {"m": 0.5}, [label]).collect()
    }
    counts = class_counts(df, label)
    seen = [c for c in counts if middle.get(c) is not None]
    medians = [middle[c] for c in seen]
    cuts = tuple((a + b) / 2 for a, b in zip(medians, medians[1:]))
    most = max(counts, key=lambda c: (counts[c], -c))
    return OneFeatureRule(feature, tuple(counts), cuts, most, tuple(seen))

