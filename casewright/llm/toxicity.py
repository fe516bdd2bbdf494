"""Counterfactual-regularised toxicity classifier (operator 10).

A logistic model on hashed text. Labelled texts that mention a group are also
read with every group term swapped for the next one of its list; the squared
difference of the two scores is a penalty of the fit, so a mention as such moves
the score as little as possible and the evidence has to come from other words.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import map_batches
from casewright.llm.hashed_text import Scorer, fit, labelled_slots, sigmoid

# Group terms that may be swapped within a line.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives"),
    ("deaf", "blind", "disabled"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)


# Log odds of every text where no label was given.
NO_EVIDENCE = -1.0


def swap_table(terms: Sequence[Sequence[str]]) -> dict[str, str]:
    return {a: line[(i + 1) % len(line)] for line in terms for i, a in enumerate(line)}


def swapper(table: Mapping[str, str]):
    """A function that swaps a text's group terms, or returns None if it has none."""
    if not table:
        return None
    pattern = re.compile(r"\b(" + "|".join(sorted(map(re.escape, table), key=len, reverse=True)) + r")\b", re.IGNORECASE)

    def swap(text: str) -> str | None:
        out, n = pattern.subn(lambda m: table[m[0].lower()], text)
        return out if n else None

    return swap


def logistic(z, y, params):
    z = z + params[0]
    p = sigmoid(z)
    loss = np.logaddexp(0, z) - y * z
    return float(loss.sum()), p - y, np.array([(p - y).sum()])


def _scored(value):
    def run(batch):
        weights, params = value.value
        score = Scorer(weights, False)
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            z = np.array([score(t) for t in part.column(2).to_pylist()]) + params[0]
            yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(sigmoid(z))], ["id", "held_out", "score"])

    return run


def _clean(value, place: int):
    def run(batch):
        weights, params = value.value
        score = Scorer(weights, False)
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            z = np.array([score(t) for t in part.column(place).to_pylist()]) + params[0]
            yield part.filter(pa.array(sigmoid(z) < 0.5))

    return run


def _learn(docs, labels, id_col, text_col, label_col, held_out, terms, sample, tie, passes, rate, penalty):
    """Broadcast weights, and whether there was anything to learn from."""
    held = F.coalesce(held_out, F.lit(False)) if held_out is not None else F.lit(False)
    rows = docs.select(F.col(id_col).alias("id"), held.alias("held_out"), F.col(text_col).alias("text"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where("y is not null").distinct()
    taught = rows.where(~F.col("held_out") & F.col("text").isNotNull()).join(marks, "id")
    design = labelled_slots(taught.select("id", "text", "y"), sample, signs=False, swap=swapper(swap_table(terms)))
    weights, params, trace = fit(design, logistic, [0.0], passes=passes, rate=rate, penalty=penalty, tie=tie)
    if not trace:
        params = np.array([NO_EVIDENCE])
    return rows, docs.sparkSession.sparkContext.broadcast((weights, params)), bool(trace)


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out=None,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    sample: int = 20_000,
    tie: float = 1.0,
    passes: int = 50,
    rate: float = 0.5,
    penalty: float = 1e-3,
) -> DataFrame:
    """``(id, held_out, score, predicted)``, one row per row of ``docs``.

    Learnt from at most about ``sample`` labelled rows (drawn by hash of the id)
    that ``held_out``, a column over the id, does not mark. Rows with a null
    label, id or text teach nothing; conflicting labels of an id each count.
    Null and empty texts get the score of no evidence. Without any label every
    score is that of ``NO_EVIDENCE`` and nothing is predicted toxic. Texts of any
    length are read whole. Repeated rows give repeated
    results. Other columns are not read.
    """
    rows, value, _ = _learn(
        docs, labels, id_col, text_col, label_col, held_out, terms, sample, tie, passes, rate, penalty
    )
    kind = dict(rows.dtypes)["id"]
    scored = map_batches(rows, _scored(value), f"id {kind}, held_out boolean, score double")
    return scored.select(
        F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    held_out=None,
    terms: Sequence[Sequence[str]] = IDENTITY_TERMS,
    sample: int = 20_000,
    tie: float = 1.0,
    passes: int = 50,
    rate: float = 0.5,
    penalty: float = 1e-3,
) -> DataFrame:
    """Rows of ``docs``, all their columns, with a score below 0.5; all without labels.

    Parameters and special cases as for ``toxicity_scores``; each row is judged
    by its own text, so ids do not matter.
    """
    _, value, learnt = _learn(
        docs, labels, id_col, text_col, label_col, held_out, terms, sample, tie, passes, rate, penalty
    )
    return map_batches(docs, _clean(value, docs.columns.index(text_col)), docs.schema) if learnt else docs
