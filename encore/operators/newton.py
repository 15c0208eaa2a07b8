"""Many penalized logistic regressions over one table, fitted together.

A Newton step needs the gradient and the Gram matrix of the weighted rows. One pass over the
table sums both for every problem (class weights, penalty, left-out fold) that has not converged;
the driver solves small systems and sends the new coefficients. So a whole grid with its folds
costs as many scans as its slowest problem has steps, about ten, instead of one fit's scans each.

A task returns one block of sums per problem, of (features + 1) ** 2 numbers; blocks are added on
executors, so the driver gets one per problem.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The decrement of the loss, as a share of it, that the last step may still promise.
TOLERANCE = 1e-9
#: Bytes of one pass's sums that a task may hold.
MAX_BYTES = 256 << 20
#: Blocks that are added in one task before the rest.
FAN_IN = 32


@dataclass(frozen=True)
class Problem:
    """Minimizes sum(weight * log loss) + penalty / 2 * |coefficients|**2 over the rows outside
    a fold. The intercept is not penalized unless ``penalize_intercept``."""

    penalty: float
    weights: tuple[float, float] = (1.0, 1.0)
    left_out: int | None = None
    penalize_intercept: bool = False


@dataclass
class Fit:
    """Coefficients with the intercept last, after every step."""

    path: list[np.ndarray]
    converged: bool

    def after(self, steps: int) -> np.ndarray:
        return self.path[min(steps, len(self.path) - 1)]


def _batches(batches: Iterator[pa.RecordBatch], width: int):
    """(rows with a one appended, labels, folds) of each batch."""
    for batch in batches:
        if batch.num_rows:
            x = batch.column(0).flatten().to_numpy().reshape(-1, width)
            x = np.hstack([x, np.ones((len(x), 1))])
            fold = batch.column(2).to_numpy(zero_copy_only=False)
            yield x, batch.column(1).to_numpy(zero_copy_only=False), fold


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0, -z))


def _derivatives(problems, at, width: int):
    """One row per problem: loss, gradient and Gram matrix of a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        betas = at.value
        size = width + 1
        sums = {i: np.zeros(1 + size + size * size) for i in betas}
        for x, label, fold in _batches(batches, width):
            y = label == 1
            sign = np.where(y, 1.0, -1.0)
            for i, beta in betas.items():
                problem = problems[i]
                used = slice(None) if problem.left_out is None else fold != problem.left_out
                rows = x[used]
                weight = np.where(y[used], problem.weights[1], problem.weights[0])
                margin = sign[used] * (rows @ beta)
                p = _sigmoid(-margin)
                out = sums[i]
                out[0] += (weight * np.logaddexp(0, -margin)).sum()
                out[1 : 1 + size] -= rows.T @ (weight * sign[used] * p)
                scaled = rows * (weight * p * (1 - p))[:, None]
                out[1 + size :] += (scaled.T @ rows).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(sums), pa.int32()),
                pa.array([x.tobytes() for x in sums.values()], pa.binary()),
            ],
            ["problem", "sums"],
        )

    return run


def _added(group: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x.as_buffer()) for x in group.column("sums").combine_chunks()],
                   axis=0)
    return group.select(["problem"]).slice(0, 1).append_column(
        "sums", pa.array([total.tobytes()], pa.binary())
    )


def _pass(rows: DataFrame, problems, betas: dict[int, np.ndarray], width: int):
    """Sums of all rows per problem that has coefficients in ``betas``."""
    at = rows.sparkSession.sparkContext.broadcast(betas)
    blocks = rows.mapInArrow(_derivatives(problems, at, width), "problem int, sums binary")
    # Two levels, so that no task adds more than a bounded part of the blocks at once.
    blocks = blocks.withColumn("part", F.spark_partition_id() % FAN_IN)
    blocks = blocks.groupBy("problem", "part").applyInArrow(_added, "problem int, sums binary")
    found = blocks.groupBy("problem").applyInArrow(_added, "problem int, sums binary").collect()
    at.unpersist()
    return {r.problem: np.frombuffer(bytes(r.sums)) for r in found}


def _steps(problem: Problem, width: int, start: np.ndarray, limit: int):
    """A generator of points: is sent the sums at each, ends with its path when it converged.

    A step that raises the loss is halved, so the loss falls at every step that counts.
    """
    size = width + 1
    ridge = np.full(size, problem.penalty)
    if not problem.penalize_intercept:
        ridge[-1] = 0.0
    path, point, before, step = [start], start, np.inf, None
    while len(path) <= limit:
        sums = yield point
        loss = sums[0] + (ridge * point * point).sum() / 2
        if loss > before + 1e-12 * abs(before) and step is not None and np.abs(step).max() > 1e-12:
            step = step / 2
            point = path[-2] + step
            path[-1] = point
            continue
        gradient = sums[1 : 1 + size] + ridge * point
        gram = sums[1 + size :].reshape(size, size) + np.diag(ridge)
        try:
            step = -np.linalg.solve(gram, gradient)
        except np.linalg.LinAlgError:
            step = -np.linalg.lstsq(gram, gradient, rcond=None)[0]
        before = loss
        point = point + step
        path.append(point)
        if -(gradient @ step) / 2 <= TOLERANCE * max(1.0, abs(loss)):
            return path, True
    return path, False


def fit_together(
    rows: DataFrame,
    problems: Sequence[Problem],
    width: int,
    counts: Mapping[int | None, Mapping[float, int]],
    limit: int = 100,
) -> list[Fit]:
    """Fit all problems over ``rows(features array<double>, label double, fold int)``.

    ``counts`` has the rows per label outside each left-out fold (None: all rows). A problem that
    sees one class alone predicts it: zero coefficients and an infinite intercept; without rows,
    all coefficients are zero. ``limit`` bounds the steps; a step costs one scan for all problems
    together. More sums than MAX_BYTES a task are split over several scans a step.
    """
    each = 8 * (width + 2) ** 2
    at_once = max(1, MAX_BYTES // each)
    fits: dict[int, Fit] = {}
    running, points = {}, {}
    for i, problem in enumerate(problems):
        seen = {c: n for c, n in counts[problem.left_out].items() if n}
        start = np.zeros(width + 1)
        if len(seen) < 2:
            start[-1] = 0.0 if not seen else np.inf if 1.0 in seen else -np.inf
            fits[i] = Fit([start], True)
            continue
        running[i] = _steps(problem, width, start, limit)
        points[i] = next(running[i])
    while points:
        open_ = list(points)
        for a in range(0, len(open_), at_once):
            betas = {i: points[i] for i in open_[a : a + at_once]}
            for i, sums in _pass(rows, list(problems), betas, width).items():
                try:
                    points[i] = running[i].send(sums)
                except StopIteration as end:
                    fits[i] = Fit(*end.value)
                    del points[i]
    return [fits[i] for i in range(len(problems))]


def _scores(models, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_fold: dict[int, list[tuple[int, np.ndarray]]] = models.value
        for x, label, fold in _batches(batches, width):
            for one, fitted in by_fold.items():
                here = fold == one
                if not here.any():
                    continue
                for i, beta in fitted:
                    if np.isfinite(beta[-1]):
                        score = _sigmoid(x[here] @ beta)
                    else:
                        score = np.full(here.sum(), float(beta[-1] > 0))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(score), i, dtype=np.int32)),
                            pa.array(label[here]),
                            pa.array(score),
                        ],
                        ["problem", "label", "score"],
                    )

    return run


def held_out_scores(
    rows: DataFrame, fitted: Mapping[int, list[tuple[int, np.ndarray]]], width: int
) -> DataFrame:
    """(problem, label, score) of every row under the models of its fold, in one scan.

    ``fitted`` maps a fold to (number, coefficients) of the models that were fitted without it.
    """
    models = rows.sparkSession.sparkContext.broadcast(dict(fitted))
    return rows.mapInArrow(_scores(models, width), "problem int, label double, score double")
