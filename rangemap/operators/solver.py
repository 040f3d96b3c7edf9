"""Many L1-penalised logistic regressions at once, by Newton steps whose sums Spark gathers from all rows.

A pass over the rows adds up, for each problem, the loss along the last step, the gradient of all terms, and the Gram
matrix of the terms that are at work; rows of one problem may lie in any number of tasks. The sums have the size of a
problem's terms, not of its rows. They meet in two steps, so that no task adds up more than a share of the partial sums,
and the next step of each problem is found where its sums meet: coordinate descent and exact solves on the small matrix.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

#: Shares of a step at which the loss is known after a pass, and the decrease that is asked of them.
SHARES, ENOUGH = (1.0, 0.5, 0.25, 0.1, 0.03, 0.01), 0.1
#: Terms at work at first, and added where they violate optimality; smaller problems have all of theirs at work.
AT_ONCE, ADDED = 128, 64
PARTS = 16


@dataclass
class Problem:
    """Minimise sum(w loss) + sum(lam |coef|), the intercept free. mine: the rows that count, as indices into the values;
    design: the terms of these rows; heavy: the weight of class 0."""

    columns: list[str]
    mine: Callable[[dict[str, np.ndarray]], np.ndarray]
    design: Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]
    lam: np.ndarray
    heavy: float
    share: float  # of the weight that class 1 has
    state: State = field(init=False)

    def __post_init__(self):
        p = len(self.lam)
        beta = np.zeros(p + 1)
        beta[-1] = np.log(max(self.share, 1e-12) / max(1 - self.share, 1e-12))
        work = np.arange(p) if p <= AT_ONCE else np.zeros(0, np.int64)
        self.state = State(beta, np.zeros(p + 1), work)


@dataclass
class State:
    beta: np.ndarray  # the last is the intercept
    step: np.ndarray
    work: np.ndarray
    value: float = np.inf  # of the objective at beta
    expected: float = 0.0  # decrease by a whole step, to first order
    scale: float = 1.0  # of the dual point
    gap: float = np.inf  # between the objective and the dual's, relative
    confirming: bool = False
    done: bool = False


def sums(problem: Problem, x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What some rows add: losses along the step, the dual's value, gradient and Gram matrix after a whole step."""
    s = problem.state
    w = np.where(y == 1, 1.0, problem.heavy) * w
    here, along = x @ s.beta[:-1] + s.beta[-1], x @ s.step[:-1] + s.step[-1]
    losses = [float(w @ (np.logaddexp(0, here + t * along) - y * (here + t * along))) for t in (*SHARES, 0.0)]
    p = 1 / (1 + np.exp(-np.clip(here + along, -500, 500)))
    u = s.scale * p + (1 - s.scale) * y
    with np.errstate(divide="ignore", invalid="ignore"):
        dual = -float(w @ (np.where(u > 0, u * np.log(u), 0) + np.where(u < 1, (1 - u) * np.log1p(-u), 0)))
    r, h = w * (p - y), w * p * (1 - p)
    a = np.c_[x[:, s.work], np.ones(len(x))]
    return np.concatenate([losses, [dual], x.T @ r, [r.sum()], (a.T @ (a * h[:, None])).ravel()])


def quadratic(g: np.ndarray, gram: np.ndarray, beta: np.ndarray, lam: np.ndarray, rounds: int = 300) -> np.ndarray:
    """The d that minimises g d + d gram d / 2 + sum(lam |beta + d|)."""
    n = len(g)
    gram = gram + np.eye(n) * (1e-11 * max(np.trace(gram), 1e-300))
    curve = np.diag(gram).copy()
    z, r = beta.copy(), g.copy()
    close = 1e-11 * max(np.abs(g).max(initial=0.0), lam.max(initial=0.0), 1e-300)
    for _ in range(rounds):
        for j in range(n):
            wish = curve[j] * z[j] - r[j]
            new = np.sign(wish) * max(abs(wish) - lam[j], 0.0) / curve[j]
            if new != z[j]:
                r += gram[:, j] * (new - z[j])
                z[j] = new
        # With the signs as they are the rest is a linear system; go there until a sign would change.
        a = np.flatnonzero((z != 0) | (lam == 0))
        move = np.linalg.solve(gram[np.ix_(a, a)], -(r[a] + lam[a] * np.sign(z[a])))
        crossing = (lam[a] > 0) & (z[a] * (z[a] + move) < 0)
        t = min(1.0, np.min(-z[a][crossing] / move[crossing], initial=1.0))
        moved = z[a] + t * move
        moved[crossing & (np.abs(moved) < 1e-14 * np.maximum(np.abs(z[a]), 1e-300))] = 0.0
        z[a] = moved
        r = g + gram @ (z - beta)
        wrong = np.where(z != 0, np.abs(r + lam * np.sign(z)), np.maximum(np.abs(r) - lam, 0))
        if wrong.max(initial=0.0) <= close:
            break
    return z - beta


def advance(problem: Problem, total: np.ndarray, tolerance: float) -> State:
    """The state after a pass with these sums."""
    s, p, lam = problem.state, len(problem.lam), problem.lam
    penalty = lambda b: float(lam @ np.abs(b[:-1]))
    m = len(SHARES)
    values = [total[i] + penalty(s.beta + t * s.step) for i, t in enumerate((*SHARES, 0.0))]
    beta, work = s.beta, s.work
    if s.step.any():
        t = next((t for t, v in zip(SHARES, values, strict=False) if v <= values[m] + ENOUGH * t * s.expected), None)
        if t is None:  # rounding: nothing along the step is better
            return State(beta, np.zeros(p + 1), work, values[m], gap=s.gap, done=True)
        beta = beta + t * s.step
        if t < 1:  # gradient and Gram matrix are of another point
            return State(beta, np.zeros(p + 1), work, values[SHARES.index(t)])
    value, dual = values[0], total[m + 1]
    g = total[m + 2 : m + 3 + p]
    gram = total[m + 3 + p :].reshape(len(work) + 1, len(work) + 1)
    if s.confirming:
        gap = (value - dual) / max(abs(value), 1e-300)
        if gap <= tolerance or gap >= 0.5 * s.gap:
            return State(beta, np.zeros(p + 1), work, value, gap=gap, done=True)
        s = State(beta, np.zeros(p + 1), work, value, gap=gap)
    at = np.r_[work, p]
    both = np.r_[lam, 0.0]
    d = np.zeros(p + 1)
    d[at] = quadratic(g[at], gram, beta[at], both[at])
    expected = float(g @ d) + penalty(beta + d) - penalty(beta)
    # Without the curvature: twice the model's decrease at its minimum. A gap that was too wide asks for every step there is.
    if -expected > (1e-3 * tolerance if np.isinf(s.gap) else 1e-16) * abs(value):
        return State(beta, d, work, value, expected, gap=s.gap)
    outside = np.ones(p, bool)
    outside[work] = False
    missing = np.flatnonzero(outside & (np.abs(g[:-1]) > lam * (1 + 1e-9)))
    if len(missing):
        worst = missing[np.argsort(-(np.abs(g[missing]) / lam[missing]))]
        work = np.sort(np.r_[work[(beta[work] != 0)], worst[: AT_ONCE if not len(work) else ADDED]])
        return State(beta, np.zeros(p + 1), work, value, gap=s.gap)
    steep = np.abs(g[:-1]) > 0
    scale = min(1.0, float(np.min(lam[steep] / np.abs(g[:-1][steep]), initial=1.0)))
    return State(beta, np.zeros(p + 1), work, value, scale=scale, gap=s.gap, confirming=True)


_SCHEMA = "key int, part int, sums binary"


def _added(finish: Callable[[int, np.ndarray], bytes] | None):
    def run(table: pa.Table) -> pa.Table:
        key, part = table.column("key")[0].as_py(), table.column("part")[0].as_py()
        total = sum(np.frombuffer(b.as_buffer(), np.float64) for b in table.column("sums"))
        return pa.table({"key": pa.array([key], pa.int32()), "part": pa.array([part], pa.int32()), "sums": pa.array([total.tobytes() if finish is None else finish(key, total)], pa.binary())})

    return run


def values_of(batch: pa.RecordBatch, used: list[str]) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in used}


def added_up(rows: DataFrame, used: list[str], of: dict[int, Callable[[dict[str, np.ndarray]], np.ndarray | None]], finish: Callable[[int, np.ndarray], bytes] | None = None) -> dict[int, bytes]:
    """For each key the sum of its function's vectors over all batches of rows, in two steps, as bytes or as finish makes of
    it. What comes to the driver are as many values as keys."""

    def gathered(batches):
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            values = values_of(batch, used)
            for i, f in of.items():
                new = f(values)
                if new is not None:
                    found[i] = found[i] + new if i in found else new
        part = TaskContext.get().partitionId() % PARTS
        for i, v in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["key", "part", "sums"])

    shares = rows.select(*used).mapInArrow(gathered, _SCHEMA).groupBy("key", "part").applyInArrow(_added(None), _SCHEMA)
    met = shares.groupBy("key").applyInArrow(_added(finish), _SCHEMA)
    return {r.key: bytes(r.sums) for r in met.select("key", "sums").collect()}


def minimise(rows: DataFrame, problems: list[Problem], tolerance: float = 1e-7, passes: int = 200) -> list[State]:
    """The problems' last states. rows: class, sample_weight and the problems' columns; read once a pass, so write them first.
    A problem ends when the gap to its dual is below tolerance, relative to the objective, or no longer falls."""
    used = list(dict.fromkeys(["class", "sample_weight", *(c for q in problems for c in q.columns)]))

    def summing(q: Problem):
        def run(values):
            mine, total = q.mine(values), None
            for at in range(0, len(mine), 4096):  # a design matrix has at most so many rows
                some = mine[at : at + 4096]
                new = sums(q, q.design(values, some), values["class"][some].astype(float), values["sample_weight"][some].astype(float))
                total = new if total is None else total + new
            return total

        return run

    for _ in range(passes):
        todo = {i: q for i, q in enumerate(problems) if not q.state.done}
        if not todo:
            break
        finish = lambda key, total, todo=todo: pickle.dumps(advance(todo[key], total, tolerance))
        for i, state in added_up(rows, used, {i: summing(q) for i, q in todo.items()}, finish).items():
            problems[i].state = pickle.loads(state)
    return [q.state for q in problems]
