"""Ordinal quality classifier: cumulative links on hashed text (operator 2).

Grades 0 .. g-1 share one weight vector; P(grade >= j) = sigmoid(score - cut_j)
with cuts in ascending order (the first, then positive gaps). The model gives
the expected grade and the probability of reaching a grade, by which documents
are selected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import map_batches
from casewright.llm.hashed_text import Scorer, fit, labelled_slots, sigmoid


def cuts_of(params: np.ndarray) -> np.ndarray:
    """Ascending cuts: the first parameter, then the others' exponentials as gaps."""
    return np.cumsum(np.r_[params[0], np.exp(params[1:])])


def cumulative(z, y, params):
    """Negative log likelihood of the grades, with derivatives by score and parameters."""
    cuts = cuts_of(params)
    above = sigmoid(z[:, None] - cuts)  # P(grade >= 1 .. g-1)
    full = np.concatenate([np.ones((len(z), 1)), above, np.zeros((len(z), 1))], 1)
    slope = full * (1 - full)
    row, grade = np.arange(len(z)), y.astype(int)
    mass = np.maximum(full[row, grade] - full[row, grade + 1], 1e-12)
    loss = -np.log(mass).sum()
    dz = -(slope[row, grade] - slope[row, grade + 1]) / mass
    # A cut lowers the probability of the grades from it on.
    dcut = np.zeros(len(cuts))
    np.add.at(dcut, grade[grade > 0] - 1, (slope[row, grade] / mass)[grade > 0])
    low = grade < len(cuts)
    np.add.at(dcut, grade[low], -(slope[row, grade + 1] / mass)[low])
    from_here = np.cumsum(dcut[::-1])[::-1]
    return float(loss), dz, np.r_[from_here[0], from_here[1:] * np.exp(params[1:])]


def _graded(value):
    def run(batch):
        weights, params = value.value
        score, cuts = Scorer(weights, True), cuts_of(params)
        for at in range(0, batch.num_rows, 2_000):
            part = batch.slice(at, 2_000)
            z = np.array([score(t) for t in part.column(1).to_pylist()])
            above = sigmoid(z[:, None] - cuts)
            tails = pa.ListArray.from_arrays(
                pa.array(np.arange(0, above.size + 1, len(cuts)), pa.int32()), pa.array(above.ravel())
            )
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(above.sum(1)), tails], ["id", "expected", "tails"])

    return run


def grade_documents(
    docs: DataFrame,
    grades: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    grade_col: str = "grade",
    n_grades: int = 3,
    reach: int = 1,
    least: float = 0.5,
    sample: int = 20_000,
    passes: int = 50,
    rate: float = 0.5,
    penalty: float = 1e-3,
) -> DataFrame:
    """``(id, expected_grade, tail_probability, tails, kept)``, one row per row of ``docs``.

    ``tail_probability`` is P(grade >= ``reach``), ``tails`` lists it for every
    grade from 1; ``kept`` is ``tail_probability >= least``. Learnt from at most
    about ``sample`` rated rows, drawn by hash of the id; ratings that are null
    or not 0 .. ``n_grades`` - 1 teach nothing, several ratings of an id each
    count. Null and empty texts get the grade of no evidence. Without any rating
    every tail is 0.5 or less and follows from the starting cuts. Repeated rows
    give repeated results. Other columns are not read.
    """
    if not 0 < reach < n_grades:
        raise ValueError("reach must be a grade above 0")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rated = grades.select(F.col(id_col).alias("id"), F.col(grade_col).alias("y"))
    rated = rated.where((F.col("y") >= 0) & (F.col("y") < n_grades)).distinct()
    taught = rows.where("text is not null").join(rated, "id").select("id", "text", "y")
    design = labelled_slots(taught, sample, signs=True)
    weights, params, _ = fit(design, cumulative, np.zeros(n_grades - 1), passes=passes, rate=rate, penalty=penalty)
    value = docs.sparkSession.sparkContext.broadcast((weights, params))
    kind = dict(rows.dtypes)["id"]
    graded = map_batches(rows, _graded(value), f"id {kind}, expected double, tails array<double>")
    tail = F.col("tails")[reach - 1]
    return graded.select(
        F.col("id").alias(id_col),
        F.col("expected").alias("expected_grade"),
        tail.alias("tail_probability"),
        "tails",
        (tail >= least).alias("kept"),
    )
