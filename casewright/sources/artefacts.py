"""Persist and load a fitted model of any family with its decision rule."""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass, fields
from typing import Any

import numpy as np
from pyspark.ml.classification import LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import __version__
from casewright.models import baselines, boosting, families, forest, isotonic, ordered_logit, softmax
from casewright.models.validation import CalibratedModel
from casewright.operators.prep import Preprocessor
from casewright.session import small_table

KIND = "casewright.artefact"

# Records are kept field by field; models that Spark fitted have a folder each.
_RECORDS = {
    "OrderedScorer": ordered_logit.Scorer,
    "OrderedLogit": ordered_logit.OrderedLogit,
    "Preprocessor": Preprocessor,
    "Multinomial": families.Multinomial,
    "Forest": forest.Forest,
    "Boosted": boosting.Boosted,
    "Bins": boosting.Bins,
    "Softmax": softmax.Softmax,
    "SoftmaxScorer": softmax.SoftmaxScorer,
    "Tree": boosting.Tree,
    "FrankHall": families.FrankHall,
    "RegressionCuts": families.RegressionCuts,
    "Stacked": families.Stacked,
    "Curve": isotonic.Curve,
    "Majority": baselines.Majority,
    "OneFeatureRule": baselines.OneFeatureRule,
}
_FITTED = {
    c.__name__: c
    for c in (
        LogisticRegressionModel,
        RandomForestClassificationModel,
        IsotonicRegressionModel,
    )
}


@dataclass(frozen=True)
class Artefact:
    """What scoring needs: the fitted model, its threshold and the rule behind it."""

    scorer: families.Scorer
    family: str
    threshold: float
    cost_ratio: float
    severe_from: int
    regime: str
    version: str = __version__


def _pack(value: Any, fitted: list[Any]) -> Any:
    """``value`` as JSON content; models that Spark fitted are put in ``fitted``."""
    if type(value).__name__ in _FITTED:
        fitted.append(value)
        return {"fitted": type(value).__name__, "folder": len(fitted) - 1}
    if isinstance(value, CalibratedModel):
        return {"calibrated": _pack([value.members, value.classes], fitted)}
    for name, kind in _RECORDS.items():
        if type(value) is kind:
            return {"record": name, "fields": {f.name: _pack(getattr(value, f.name), fitted) for f in fields(value)}}
    if isinstance(value, np.ndarray):
        return {"array": base64.b64encode(value.tobytes()).decode(), "kind": value.dtype.str, "shape": list(value.shape)}
    if isinstance(value, dict):
        return {"map": [[k, _pack(v, fitted)] for k, v in value.items()]}
    if isinstance(value, (list, tuple)):
        return [_pack(v, fitted) for v in value]
    if value is None or isinstance(value, (str, bool, int, float)):
        return value
    raise TypeError(f"a model with a {type(value).__name__} cannot be saved")


def _unpack(content: Any, folder: str) -> Any:
    if isinstance(content, list):
        return tuple(_unpack(v, folder) for v in content)
    if not isinstance(content, dict):
        return content
    if "fitted" in content:
        return _FITTED[content["fitted"]].load(f"{folder}/{content['folder']}")
    if "array" in content:
        flat = np.frombuffer(base64.b64decode(content["array"]), content["kind"])
        return flat.reshape(content["shape"])
    if "calibrated" in content:
        return CalibratedModel(*_unpack(content["calibrated"], folder))
    if "map" in content:
        return {k: _unpack(v, folder) for k, v in content["map"]}
    values = {k: _unpack(v, folder) for k, v in content["fields"].items()}
    return _RECORDS[content["record"]](**values)


def save_artefact(spark: SparkSession, artefact: Artefact, path: str) -> None:
    """A Parquet row for model and rule, numbers at full precision; Spark's models beside it.

    Models lie in ``_fitted`` below the path, a name that table readers skip.
    """
    fitted: list[Any] = []
    rule = {f.name: getattr(artefact, f.name) for f in fields(artefact) if f.name != "scorer"}
    parts = {"scorer": _pack(artefact.scorer, fitted), "rule": rule}
    rows = [(KIND, name, json.dumps(value)) for name, value in parts.items()]
    table = small_table(spark, rows, "kind string, part string, content string")
    table.coalesce(1).write.mode("overwrite").parquet(path)
    for i, model in enumerate(fitted):
        model.write().overwrite().save(f"{path}/_fitted/{i}")


def load_artefact(spark: SparkSession, path: str) -> Artefact:
    """Read an artefact back; anything else at the path raises."""
    table = spark.read.parquet(path)
    if "kind" not in table.columns or table.where(F.col("kind") != KIND).limit(1).count():
        raise TypeError(f"{path} does not hold a model artefact")
    parts = {r["part"]: json.loads(r["content"]) for r in table.collect()}
    return Artefact(_unpack(parts["scorer"], f"{path}/_fitted"), **parts["rule"])


def table_digest(df: DataFrame) -> DataFrame:
    """Row count and an order-free digest: equal tables give equal values."""
    row_hash = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(row_hash.cast("decimal(38,0)")).cast("string").alias("digest"),
    )
