"""Multinomial logistic regression, many fits (folds, repeats) in shared passes.

A pass over the coded design returns, per model and partition, the loss, its
gradient and, where a fit asks for it, its Hessian (a block for each two classes);
the sums are added in a tree and have the size of the coefficients squared, whatever
the rows. All models still moving share each pass and one matrix per block
(``Basis``). Damped Newton steps need dozens of passes from zero, as the classes of
a good model are nearly separable; so a large table starts from a fit of a part of
it, and folds start from the model of all rows and step with its Hessian: their
passes then sum gradients only, which is a small part of the work, and a fold asks
for a Hessian of its own where steps do not halve its gradient. Starts and steps
only change the way there: every fit ends on all its rows at the same tolerance.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.functions.cells import lookup
from casewright.models.ordered_logit import (
    Basis,
    Design,
    _blocks,
    _scaling,
    balanced,
    build_design,
    class_counts,
    start_designs,
    tree_sum,
)
from casewright.operators.features import FeatureSpec
from casewright.operators.prep import Preprocessor, fit_preprocessors
from casewright.session import ensure_staged, staged_view

HALVINGS = 40
# Lengths of a Newton step that one pass tries, by the loss alone.
LENGTHS = (1.0, 0.7, 0.5, 0.35, 0.25, 0.18, 0.12, 0.06, 0.03)


@dataclass(frozen=True)
class Softmax:
    """Coefficients (classes x columns) and intercepts, in class order."""

    names: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]
    classes: tuple[int, ...]
    n_iter: int = 0
    gradient_norm: float = 0.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return proportions(x @ np.array(self.weights).T + np.array(self.intercepts))


@dataclass(frozen=True)
class SoftmaxScorer:
    """A preprocessor, the code books its levels were read with, and a fitted model."""

    prep: Preprocessor
    model: Softmax
    books: tuple[tuple[str, ...], ...]

    def column(self) -> Column:
        prep, model = self.prep, self.model
        books = [list(b) for b in self.books]
        missing = F.lit(float("nan"))
        numbers = [F.coalesce(F.col(c).cast("double"), missing) for c in prep.numeric]
        codes = [
            F.when(F.col(c).isNull(), F.lit(-1.0)).otherwise(
                F.coalesce(lookup(F.col(c), {v: i for i, v in enumerate(b)}) if b else F.lit(None).cast("double"), F.lit(float(len(b))))
            )
            for c, b in zip(prep.nominal, books)
        ]
        # A level that no book holds has a code of its own and encodes to zeros.
        known = [[*b, _unseen(b)] for b in books]

        def run(numbers: pa.Array, levels: pa.Array) -> pa.Array:
            n = len(numbers)
            x = numbers.flatten().to_numpy(zero_copy_only=False).reshape(n, len(prep.numeric))
            v = levels.flatten().to_numpy(zero_copy_only=False).reshape(n, len(prep.nominal))
            out = model.probabilities(prep.matrix(x, v, known))
            places = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(places, out.ravel())

        arrays = [F.array(*cells).cast("array<double>") for cells in (numbers, codes)]
        return F.arrow_udf(run, "array<double>")(*arrays)

    def score(self, df: DataFrame, out: str = "proba") -> DataFrame:
        return df.withColumn(out, self.column())


def _unseen(book: Sequence[str]) -> str:
    """A text that is not in ``book``."""
    name = "(unseen)"
    while name in book:
        name += "'"
    return name


def proportions(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Task:
    """One fit of a shared series."""

    weights: dict[int, float]
    prep: Preprocessor
    mask: tuple[int, int] | None = None
    start: np.ndarray | None = None  # classes x (columns + 1)


def block_sums(
    theta: np.ndarray, x: np.ndarray, code: np.ndarray, w: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of a block; ``theta`` is classes x (columns + 1), the last for the intercept.

    Rows and columns of the Hessian go by class, then by column.
    """
    value, gradient, hessian = _sums(theta, np.hstack([x, np.ones((len(x), 1))]), code, w, True)
    return value, gradient, hessian


# Share of a row's weight below which its part of a Hessian block is left out.
FLAT = 1e-9


def _sums(
    theta: np.ndarray, x: np.ndarray, code: np.ndarray, w: np.ndarray, curved: bool
) -> tuple[float, np.ndarray, np.ndarray | None]:
    """As ``block_sums``, with the column of ones in ``x``; the Hessian only where ``curved``."""
    k, d = theta.shape
    scores = x @ theta.T
    top = scores.max(axis=1, keepdims=True)
    total = np.log(np.exp(scores - top).sum(axis=1)) + top[:, 0]
    rows = np.arange(len(code))
    value = float((w * (total - scores[rows, code])).sum())
    p = np.exp(scores - total[:, None])
    gap = p * w[:, None]
    gap[rows, code] -= w
    gradient = gap.T @ x
    if not curved:
        return value, gradient, None
    hessian = np.zeros((k, d, k, d))
    for a in range(k):
        for b in range(a, k):
            curve = p[:, a] * ((1.0 - p[:, a]) if a == b else p[:, b])
            bent = np.flatnonzero(curve > FLAT)
            half = x[bent] * np.sqrt(w[bent] * curve[bent])[:, None]
            hessian[a, :, b, :] = (half.T @ half) * (1.0 if a == b else -1.0)
            hessian[b, :, a, :] = hessian[a, :, b, :].T
    return value, gradient, hessian.reshape(k * d, k * d)


def _losses(theta: np.ndarray, step: np.ndarray, x: np.ndarray, code: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Loss of a block at every length of a step."""
    scores, moves, rows = x @ theta.T, x @ step.T, np.arange(len(code))
    out = []
    for length in LENGTHS:
        at = scores + length * moves
        top = at.max(axis=1)
        out.append(float((w * (np.log(np.exp(at - top[:, None]).sum(axis=1)) + top - at[rows, code])).sum()))
    return np.array(out)


def _turn(move: np.ndarray) -> np.ndarray:
    """Map of a class's coefficients and intercept to the columns of the basis, its ones last."""
    out = np.zeros((len(move), move.shape[1] + 1))
    out[:, :-1], out[-1, -1] = move, 1.0
    return out


def _pass(
    design: Design, tasks: Mapping[int, Task], paths: Sequence[_Path], basis: Basis, n_classes: int
) -> DataFrame:
    """What every path asks for, by the columns of ``basis``.

    Loss, gradient and, where asked for, upper half of the Hessian, or the losses along a step.
    """
    layout = design.layout
    work = []
    for i, t in tasks.items():
        path = paths[i]
        step = path.step @ path.turn.T if path.probe else None
        work.append((i, t.mask, t.weights, (path.at if path.probe else path.trial()) @ path.turn.T, step, path.ask))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            code, folds, numbers, levels = _blocks(batch, layout)
            code, x = code.astype(int), basis.block(numbers, levels)
            for i, mask, weights, at, step, bent in work:
                rows = slice(None) if mask is None else folds[:, mask[0]] != mask[1]
                w = np.array([weights.get(c, 0.0) for c in range(n_classes)])[code[rows]]
                if step is not None:
                    sums = _losses(at, step, x[rows], code[rows], w)
                else:
                    value, gradient, hessian = _sums(at, x[rows], code[rows], w, bent)
                    parts = [[value], gradient.ravel()]
                    if bent:
                        parts.append(hessian[np.triu_indices(gradient.size)])
                    sums = np.concatenate(parts)
                total[i] = total[i] + sums if i in total else sums
        pid = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {
                "model": pa.array(list(total), pa.int32()),
                "pid": pa.array([pid] * len(total), pa.int64()),
                "sums": pa.array([v.tobytes() for v in total.values()], pa.binary()),
            }
        )

    narrow = design.table.select("code", "folds", "numbers", "levels")
    return narrow.mapInArrow(run, "model int, pid bigint, sums binary")


@dataclass
class _Path:
    """State of one fit: the point reached, the step under trial and the Hessian that steps are made with."""

    ridge: np.ndarray
    at: np.ndarray
    turn: np.ndarray
    curve: np.ndarray | None = None
    lent: bool = False  # steps are made with a Hessian of another point
    value: float = np.inf
    slope: float = 0.0
    step: np.ndarray | None = None
    halvings: int = 0
    steps: int = 0
    norm: float = np.inf
    raw: np.ndarray | None = None  # the last Hessian, by the columns of the basis
    probe: bool = False  # the next pass tries the lengths of the step
    steady: bool = False  # the last step was best at its whole length
    own: bool = False  # the Hessian is that of the point reached

    def __post_init__(self) -> None:
        self.ask = not self.lent

    def trial(self) -> np.ndarray:
        return self.at if self.step is None else self.at + self.step

    def bend(self, raw: np.ndarray, share: float = 1.0) -> None:
        """Take a Hessian by the columns of the basis as the one to step with."""
        k, size = len(self.at), self.at.size
        turn = np.kron(np.eye(k), self.turn)
        curve = turn.T @ raw @ turn * share + np.diag(self.ridge.ravel())
        # Intercepts are free to move together: the loss is flat that way, and so is its gradient.
        free = np.flatnonzero(self.ridge.ravel() == 0)
        curve[np.ix_(free, free)] += np.trace(curve) / size
        self.curve = curve + np.eye(size) * 1e-12 * np.trace(curve) / size

    def take(self, sums: np.ndarray) -> None:
        """Accept the trial or halve it, then set the next step; or cut the step to its best length."""
        if self.probe:
            ways = [self.at + length * self.step for length in LENGTHS]
            best = int(np.argmin(sums + [0.5 * float((self.ridge * at**2).sum()) for at in ways]))
            self.step, self.slope = LENGTHS[best] * self.step, LENGTHS[best] * self.slope
            self.probe, self.steady = False, best == 0
            return
        theta, wide = self.trial(), len(self.at) * len(self.turn)
        value = float(sums[0]) + 0.5 * float((self.ridge * theta**2).sum())
        enough = self.value + 1e-4 * self.slope + 1e-13 * abs(self.value)
        if self.step is not None and value > enough and self.halvings < HALVINGS:
            self.halvings, self.step, self.slope, self.steady = self.halvings + 1, self.step / 2, self.slope / 2, False
            if not self.own and self.halvings > 1:  # a Hessian of another point does not fit here
                self.step, self.ask = None, True
            return
        gradient = sums[1 : 1 + wide].reshape(len(self.at), -1) @ self.turn + self.ridge * theta
        norm = float(np.abs(gradient).max())
        slow = not self.ask and norm > 0.5 * self.norm
        self.at, self.value, self.halvings, self.norm = theta, value, 0, norm
        self.steps += 1
        self.own = self.ask
        if self.ask:
            self.raw = np.zeros((wide, wide))
            self.raw[np.triu_indices(wide)] = sums[1 + wide :]
            self.raw += np.triu(self.raw, 1).T
            self.bend(self.raw)
        if slow:
            self.step, self.ask = None, True
            return
        self.ask = not self.lent
        self.step = -np.linalg.solve(self.curve, gradient.ravel()).reshape(theta.shape)
        self.slope = float((gradient * self.step).sum())
        self.probe = self.own and not self.steady


def fit_tasks(
    design: Design, tasks: Sequence[Task], classes: Sequence[int], *, c: float = 0.5, max_iter: int = 500, tol: float = 1e-9
) -> list[Softmax]:
    """Minimise the weighted loss plus ``|W|^2 / 2c`` for every task together.

    A fit stops when its largest gradient entry is below ``tol`` per unit of weight,
    or when no part of a step lowers the loss; the intercepts are not penalised
    and are centred.
    """
    k = len(classes)
    basis = Basis.of(design.layout, [t.prep for t in tasks])
    paths, masses = _paths(design, tasks, k, c, basis)
    _walk(design, tasks, paths, masses, basis, k, max_iter, tol)
    return [_model(t, path, m, classes) for t, path, m in zip(tasks, paths, masses)]


def _paths(design: Design, tasks: Sequence[Task], k: int, c: float, basis: Basis) -> tuple[list[_Path], list[float]]:
    paths, masses = [], []
    for t, row in zip(tasks, class_counts(design, k, [t.mask for t in tasks])):
        d = len(t.prep.names) + 1
        ridge = np.tile(np.concatenate([np.full(d - 1, 1.0 / c), [0.0]]), (k, 1))
        paths.append(_Path(ridge, np.zeros((k, d)) if t.start is None else t.start, _turn(basis.map(t.prep))))
        masses.append(sum(t.weights.get(j, 0.0) * n for j, n in enumerate(row)))
    return paths, masses


def _walk(design: Design, tasks: Sequence[Task], paths: Sequence[_Path], masses, basis: Basis, k: int, max_iter: int, tol: float) -> None:
    """Passes until every path has come to its end."""
    live = set(range(len(tasks)))
    while live:
        sums = tree_sum(_pass(design, {i: tasks[i] for i in sorted(live)}, paths, basis, k), direct=32)
        for i in sorted(live):
            path = paths[i]
            path.take(sums[i])
            if path.norm <= tol * masses[i] or path.steps > max_iter or path.halvings >= HALVINGS:
                live.discard(i)


def _model(task: Task, path: _Path, mass: float, classes: Sequence[int]) -> Softmax:
    weights, cuts = path.at[:, :-1], path.at[:, -1] - path.at[:, -1].mean()
    rows = tuple(tuple(float(v) for v in row) for row in weights)
    return Softmax(
        tuple(task.prep.names), rows, tuple(float(v) for v in cuts), tuple(classes), path.steps, path.norm / mass
    )


def _begin(design: Design, task: Task, classes: Sequence[int], c: float, max_iter: int) -> None:
    """Give the fit of all rows of a large table the optimum of a part of it as its start."""
    counts = class_counts(design, len(classes), [None])[0]
    for part, share, _ in start_designs(design, counts):
        found = fit_tasks(part, [replace(task)], classes, c=c / share, max_iter=max_iter, tol=1e-6)[0]
        task.start = np.column_stack([np.array(found.weights), found.intercepts])


def _carried(basis: Basis, path: _Path, whole: Preprocessor, prep: Preprocessor) -> np.ndarray:
    """Coefficients for the transform ``prep`` that score as ``path`` does for ``whole``."""
    known = dict(zip(whole.names, path.at[:, :-1].T))
    scales = {n: _scaling(prep, n)[1] / _scaling(whole, n)[1] for n in prep.numeric if n in whole.numeric}
    none = np.zeros(len(path.at))
    weights = np.array([known.get(n, none) * scales.get(n, 1.0) for n in prep.names]).reshape(-1, len(path.at))
    shift = basis.map(whole)[-1] @ path.at[:, :-1].T - basis.map(prep)[-1] @ weights
    return np.column_stack([weights.T, path.at[:, -1] + shift])


def _tasks(design: Design, preps: Sequence[Preprocessor], masks, n_classes: int, even: bool) -> list[Task]:
    tasks = []
    for prep, mask, row in zip(preps, masks, class_counts(design, n_classes, list(masks))):
        tasks.append(Task(balanced(row) if even else dict.fromkeys(range(n_classes), 1.0), prep, mask))
    return tasks


def fit_softmax(
    df: DataFrame, spec: FeatureSpec, label: str, classes: Sequence[int], *, even: bool = True, scaled: bool = True, **options
) -> SoftmaxScorer:
    """Impute, encode, scale (where ``scaled``) and fit on all rows; with ``even`` the classes weigh alike."""
    known = sorted(int(v) for v in classes)
    df = ensure_staged(df)
    df = staged_view(df.where(F.col(label).isNotNull()), df)
    prep = fit_preprocessors(df, spec, scaled=scaled)["all"]
    design = build_design(df, FeatureSpec(prep.numeric, prep.nominal), label, known, packed=True)
    tasks = _tasks(design, [prep], [None], len(known), even)
    _begin(design, tasks[0], known, options.get("c", 0.5), options.get("max_iter", 500))
    model = fit_tasks(design, tasks, known, **options)[0]
    return SoftmaxScorer(prep, model, tuple(tuple(b) for b in design.layout.books))


def cross_softmax(
    df: DataFrame,
    spec: FeatureSpec,
    label: str,
    key: str,
    folds: Sequence[str],
    k: int,
    classes: Sequence[int],
    *,
    even: bool = True,
    c: float = 0.5,
    max_iter: int = 500,
    tol: float = 1e-9,
) -> tuple[DataFrame, list[Softmax]]:
    """Out-of-fold ``(id, repeat, fold, y, proba)`` of every repeat and fold, and the fits."""
    known = sorted(int(v) for v in classes)
    df = ensure_staged(df)
    masks = [(r, f) for r in range(len(folds)) for f in range(k)]
    named = {f"m{r}_{f}": (F.col(folds[r]) != f) & F.col(label).isNotNull() for r, f in masks}
    whole, *preps = fit_preprocessors(df, spec, {"all": F.col(label).isNotNull(), **named}, scaled=True).values()
    design = build_design(df, spec, label, known, key=key, folds=folds, packed=True)
    basis = Basis.of(design.layout, [whole, *preps])
    start = _tasks(design, [whole], [None], len(known), even)
    _begin(design, start[0], known, c, max_iter)
    (pooled,), (every,) = _paths(design, start, len(known), c, basis)
    _walk(design, start, [pooled], [every], basis, len(known), max_iter, 1e-6)
    tasks = _tasks(design, preps, masks, len(known), even)
    for t in tasks:
        t.start = _carried(basis, pooled, whole, t.prep)
    paths, masses = _paths(design, tasks, len(known), c, basis)
    for path, mass in zip(paths, masses):
        path.lent, path.ask = True, False
        path.bend(pooled.raw, mass / every)
    _walk(design, tasks, paths, masses, basis, len(known), max_iter, tol)
    models = [_model(t, path, m, known) for t, path, m in zip(tasks, paths, masses)]
    return _score_folds(design, preps, models, masks, known), models


def _score_folds(design: Design, preps, models: Sequence[Softmax], masks, classes: Sequence[int]) -> DataFrame:
    layout, labels = design.layout, np.array(classes)
    basis = Basis.of(layout, preps)
    thetas = [np.column_stack([np.array(m.weights), m.intercepts]) @ _turn(basis.map(p)).T for p, m in zip(preps, models)]
    work = list(zip(masks, thetas))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, folds, numbers, levels = _blocks(batch, layout)
            x = basis.block(numbers, levels)
            for (repeat, fold), theta in work:
                rows = np.flatnonzero(folds[:, repeat] == fold)
                if not len(rows):
                    continue
                proba = proportions(x[rows] @ theta.T)
                places = np.arange(0, proba.size + 1, proba.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(pa.array(rows)),
                        pa.array(np.full(len(rows), repeat), pa.int32()),
                        pa.array(np.full(len(rows), fold), pa.int32()),
                        pa.array(labels[code[rows].astype(int)], pa.int32()),
                        pa.ListArray.from_arrays(places, proba.ravel()),
                    ],
                    names=["id", "repeat", "fold", "y", "proba"],
                )

    kind = dict(design.table.dtypes)["id"]
    return design.table.mapInArrow(run, f"id {kind}, repeat int, fold int, y int, proba array<double>")
