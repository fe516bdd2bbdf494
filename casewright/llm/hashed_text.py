"""Sparse linear models on hashed text, fitted in distributed passes.

A text is the set of its words, of the words' first four and five letters (so
inflections share evidence) and of the signs that end its tokens, hashed into
``DIM`` slots. The labelled rows behind a fit are bounded by a parameter, drawn
by hash, and staged as slots; each pass sends the weights out and brings back
one gradient per task of a fixed number of tasks. Steps are proximal AdaGrad
with an L1 penalty, which leaves a short list of weights.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import map_batches
from casewright.session import staged

DIM = 1 << 17
TASKS = 6
_BLANK = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
_SIGNS = bytes(c for c in range(128) if not chr(c).isalnum())


def slot(feature: bytes) -> int:
    return xxhash.xxh3_64_intdigest(feature) % DIM


def words_of(text: str | None) -> set[bytes]:
    """Distinct lower-cased words; ASCII signs part words."""
    return set((text or "").lower().encode().translate(_BLANK).split())


def endings_of(text: str | None) -> set[bytes]:
    """Runs of signs that end the text's tokens, of two signs or more or standing alone."""
    tokens = set((text or "").encode().split())
    ends = {t[len(t.rstrip(_SIGNS)) :] for t in tokens}
    return {e for e in ends if len(e) > 1} | {t for t in tokens if not t.strip(_SIGNS)}


def word_slots(word: bytes) -> list[int]:
    out = [slot(word)]
    if len(word) >= 5:
        out += [slot(b"<" + word[:4]), slot(b"<" + word[:5])]
    return out


def text_slots(text: str | None, signs: bool) -> np.ndarray:
    found = {s for w in words_of(text) for s in word_slots(w)}
    if signs:
        found |= {slot(b">" + e) for e in endings_of(text)}
    return np.array(sorted(found), np.int32)


class Scorer:
    """Linear scores of texts, remembering the weighted slots of words met before."""

    MEMORY = 500_000

    def __init__(self, weights: np.ndarray, signs: bool):
        self.weights, self.signs, self.seen = weights, signs, {}
        self.live = set(np.flatnonzero(weights).tolist())

    def _slots(self, feature: bytes, of) -> tuple:
        found = tuple(s for s in of(feature) if s in self.live)
        if len(self.seen) >= self.MEMORY:
            self.seen.clear()
        self.seen[feature] = found
        return found

    def __call__(self, text: str | None) -> float:
        slots: set[int] = set()
        seen = self.seen
        for word in words_of(text):
            found = seen.get(word)
            if found is None:
                found = self._slots(word, word_slots)
            if found:
                slots.update(found)
        if self.signs:
            for end in endings_of(text):
                slots.update(s for s in (slot(b">" + end),) if s in self.live)
        return float(self.weights[sorted(slots)].sum()) if slots else 0.0


def labelled_slots(
    rows: DataFrame, bound: int, *, signs: bool, swap: Callable[[str], str | None] | None = None, seed: int = 42
) -> DataFrame:
    """Staged ``(y, x, x2)`` of about ``bound`` labelled rows at most, drawn by hash.

    ``rows``: ``id``, ``text``, ``y``. ``x2`` are the slots of the text that
    ``swap`` returns (null where it returns none).
    """
    total = rows.count()
    if total > bound:
        part = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1_000_000))
        rows = rows.where(part < int(1_000_000 * bound / total))

    def run(batch):
        texts = batch.column(0).to_pylist()
        other = [swap(t) if swap and t else None for t in texts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(1),
                pa.array([text_slots(t, signs).tobytes() for t in texts], pa.binary()),
                pa.array([text_slots(t, signs).tobytes() if t is not None else None for t in other], pa.binary()),
            ],
            ["y", "x", "x2"],
        )

    made = map_batches(rows.select("text", F.col("y").cast("double").alias("y")), run, "y double, x binary, x2 binary")
    return staged(made.repartition(TASKS))


def _gradient(value, link, tie):
    def run(batches):
        weights, params = value.value
        grad, sums = np.zeros(DIM), None
        for batch in batches:
            y = batch.column(0).to_numpy()
            xs = [np.frombuffer(x, np.int32) for x in batch.column(1).to_pylist()]
            flat = np.concatenate(xs)
            row = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
            z = np.bincount(row, weights[flat], minlength=len(xs))
            loss, dz, dparams = link(z, y, params)
            # The score of the swapped text is to be the same: squared difference times ``tie``.
            pairs = [(i, np.frombuffer(x, np.int32)) for i, x in enumerate(batch.column(2).to_pylist()) if x is not None]
            for i, other in pairs:
                gap = z[i] - weights[other].sum()
                loss += tie * gap * gap
                dz[i] += 2 * tie * gap
                grad[other] -= 2 * tie * gap
            grad += np.bincount(flat, dz[row], minlength=DIM)
            now = np.r_[loss, len(y), dparams]
            sums = now if sums is None else sums + now
        if sums is not None:
            hit = np.flatnonzero(grad).astype(np.int32)
            cells = [hit.tobytes(), grad[hit].astype(np.float32).tobytes(), sums.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in cells], ["at", "grad", "sums"])

    return run


def fit(
    design: DataFrame, link, params: np.ndarray, *, passes: int, rate: float, penalty: float, tie: float = 0.0, polish: int = 15
):
    """Weights, link parameters and the mean loss of each pass.

    After ``passes`` under the penalty, ``polish`` more with a twentieth of it
    move the weights that are left, which the penalty had drawn to zero.
    ``link(z, y, params)`` returns the loss, its derivative by ``z`` and the sum
    of its derivatives by ``params``.
    """
    sc = design.sparkSession.sparkContext
    weights, square = np.zeros(DIM), np.full(DIM, 1e-8)
    params, params_square = np.asarray(params, float), np.full(len(params), 1e-8)
    trace = []
    live = np.ones(DIM, bool)
    for i in range(passes + polish):
        if i == passes:
            live, penalty = weights != 0, penalty / 20
        value = sc.broadcast((weights, params))
        parts = design.mapInArrow(_gradient(value, link, tie), "at binary, grad binary, sums binary").collect()  # a row a task
        value.unpersist()
        if not parts:
            break
        sums = np.sum([np.frombuffer(bytes(p["sums"])) for p in parts], axis=0)
        grad, n = np.zeros(DIM), sums[1]
        for p in parts:
            grad[np.frombuffer(bytes(p["at"]), np.int32)] += np.frombuffer(bytes(p["grad"]), np.float32)
        grad, dparams = np.where(live, grad, 0) / n, sums[2:] / n
        square, params_square = square + grad**2, params_square + dparams**2
        step = rate / np.sqrt(square)
        moved = weights - step * grad
        weights = np.sign(moved) * np.maximum(0.0, np.abs(moved) - step * penalty)
        params = params - rate * dparams / np.sqrt(params_square)
        trace.append(sums[0] / n)
    return weights, params, trace


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))
