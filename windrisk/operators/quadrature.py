"""Adaptive quadrature over four positive parameters, evaluated by Spark tasks.

Everything happens in log space. A coarse scan finds the basins, a damped Newton search in each finds its mode, and the curvature
at the best mode gives the axes: z = mode + L u with L lower triangular, so that the first two parameters depend on the
first two axes only and one costly evaluation serves every node that shares them. Cells of that frame carry a Gauss-Legendre
rule of three nodes an axis (positive weights). Cells with visible weight are halved along their roughest axis until halving
changes the integral by less than a stated share. The rounds are bounded: it always ends, and reports its error estimate.
"""

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# log density in log space: (z1, z2, array of z3, array of z4) -> array; runs inside tasks.
LogDensity = Callable[[float, float, np.ndarray, np.ndarray], np.ndarray]
Limits = list[tuple[float, float]]

DIMS = 4
SCAN_POINTS = 10
LEAST_PARTS = 4  # cells an axis in the first mesh
NEWTON_STEPS = 60
# A density below this share of the top is out of sight; a face with more than EDGE of the mass is moved out.
KEEP = 1e-7
EDGE = 1e-4
# Halving goes on until all estimated changes together are below this share of the integral.
TOLERANCE = 2e-3
MOST_ROUNDS = 12
MOST_CELLS = 20_000
WIDEST = 3.0  # a flatter direction than this (standard deviation in log units) starts from this one

_GAUSS_X = np.array([-math.sqrt(0.6), 0.0, math.sqrt(0.6)])
_GAUSS_W = np.array([5.0, 8.0, 5.0]) / 18.0
_NODE = np.stack(np.meshgrid(*[np.arange(3)] * DIMS, indexing="ij"), axis=-1).reshape(-1, DIMS)
_NODE_X = _GAUSS_X[_NODE]
_NODE_W = _GAUSS_W[_NODE].prod(axis=1)
_LOW = [f"lo{k}" for k in range(DIMS)]
_HIGH = [f"hi{k}" for k in range(DIMS)]


@dataclass(frozen=True)
class Frame:
    """Origin and axes of the grid."""
    mode: np.ndarray
    axes: np.ndarray
    top: float


@dataclass(frozen=True)
class Quadrature:
    """Final cells, top of the log density over their nodes, and the estimated relative error of the integral."""
    frame: Frame
    cells: pd.DataFrame
    top: float
    error: float
    rounds: int


def _slices(spark: SparkSession, n: int, per_task: int = 1) -> int:
    return max(1, min(math.ceil(n / per_task), 4 * spark.sparkContext.defaultParallelism))


def _inside(z: np.ndarray, limits: Limits) -> np.ndarray:
    low, high = np.array(limits).T
    return ((z >= low) & (z <= high)).all(axis=-1)


def _density_at(log_density: LogDensity, z: np.ndarray, limits: Limits) -> np.ndarray:
    """Log density at every row of `z`, one call per distinct pair of the first two coordinates; minus infinity outside."""
    out = np.full(len(z), -np.inf)
    inside = np.flatnonzero(_inside(z, limits))
    if len(inside):
        _, where = np.unique(z[inside, :2], axis=0, return_inverse=True)
        order = inside[np.argsort(where, kind="stable")]
        for rows in np.split(order, np.cumsum(np.bincount(where.ravel()))[:-1]):
            out[rows] = log_density(z[rows[0], 0], z[rows[0], 1], z[rows, 2], z[rows, 3])
    return np.where(np.isnan(out), -np.inf, out)


def _starts(spark: SparkSession, log_density: LogDensity, box: Limits, points: int) -> np.ndarray:
    """Local maxima of a coarse grid over `box`, best first: the grid is `points`**4 numbers, whatever the data."""
    axes = [np.linspace(low, high, points) for low, high in box]
    inner = np.stack([g.ravel() for g in np.meshgrid(axes[2], axes[3], indexing="ij")], axis=1)

    def scan(batches):
        for batch in batches:
            pair = batch["id"].to_numpy()
            found = [log_density(axes[0][p // points], axes[1][p % points], inner[:, 0], inner[:, 1]) for p in pair]
            yield pd.DataFrame({"id": pair, "values": [np.asarray(v, dtype=float) for v in found]})

    pairs = spark.range(0, points * points, 1, _slices(spark, points * points))
    rows = pairs.mapInPandas(scan, "id long, values array<double>").collect()
    grid = np.stack([np.array(r["values"], dtype=float) for r in sorted(rows, key=lambda r: r["id"])]).reshape((points,) * DIMS)
    grid = np.where(np.isfinite(grid), grid, -np.inf)
    padded = np.pad(grid, 1, constant_values=-np.inf)
    peak = np.isfinite(grid)
    for shift in np.ndindex(*(3,) * DIMS):
        near = padded[tuple(slice(s, s + points) for s in shift)]
        # Of equal neighbours the first one counts, so that a plateau gives one start.
        if shift < (1,) * DIMS:
            peak &= grid > near
        elif shift > (1,) * DIMS:
            peak &= grid >= near
    at = np.argwhere(peak)
    if not len(at):
        return np.array([[(low + high) / 2.0 for low, high in box]])
    at = at[np.argsort(-grid[tuple(at.T)], kind="stable")]
    return np.array([[axes[k][i] for k, i in enumerate(node)] for node in at])


def _derivatives(value, z: np.ndarray, step: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Central differences: value, gradient, Hessian."""
    unit = step * np.eye(DIMS)
    offsets = [np.zeros(DIMS)] + [s * u for u in unit for s in (1, -1)]
    crossed = [(i, j) for i in range(DIMS) for j in range(i)]
    offsets += [s * unit[i] + t * unit[j] for i, j in crossed for s, t in ((1, 1), (1, -1), (-1, 1), (-1, -1))]
    f = np.nan_to_num(value(z + np.array(offsets)), neginf=-1e300)
    plus, minus = f[1:9:2], f[2:9:2]
    hessian = np.diag((plus - 2.0 * f[0] + minus) / step ** 2)
    for (i, j), (a, b, c, d) in zip(crossed, f[9:].reshape(-1, 4)):
        hessian[i, j] = hessian[j, i] = (a - b - c + d) / (4.0 * step ** 2)
    return f[0], (plus - minus) / (2.0 * step), hessian


def _climb(value, z: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Damped Newton search from `z`: mode, its value, Hessian there. Steps that do not rise are shortened; ends after NEWTON_STEPS."""
    damping, step = 1.0, 1e-3
    here, gradient, hessian = _derivatives(value, z, step)
    for _ in range(NEWTON_STEPS):
        if not (np.isfinite(gradient).all() and np.isfinite(hessian).all()):
            break
        bend = np.linalg.eigvalsh(-hessian)[0]
        move = np.linalg.solve(-hessian + (max(0.0, -bend) + damping) * np.eye(DIMS), gradient)
        move *= min(1.0, 1.0 / max(np.abs(move).max(), 1e-300))
        there = value((z + move)[None, :])[0]
        if there > here:
            z, damping = z + move, damping / 8.0
            here, gradient, hessian = _derivatives(value, z, step)
            if np.abs(move).max() < 1e-6:
                break
        else:
            damping *= 8.0
            if damping > 1e12:
                break
    return z, here, hessian


def _modes(spark: SparkSession, log_density: LogDensity, starts: np.ndarray, limits: Limits) -> list[tuple[np.ndarray, float, np.ndarray]]:
    """One search per start, each in a task of its own; modes best first."""
    def climb(batches):
        for batch in batches:
            for z in batch["z"]:
                mode, top, hessian = _climb(lambda zs: _density_at(log_density, np.atleast_2d(zs), limits), np.array(z, dtype=float))
                yield pd.DataFrame({"mode": [mode], "top": [float(top)], "hessian": [hessian.ravel()]})

    frame = spark.createDataFrame([(s.tolist(),) for s in starts], "z array<double>").repartition(_slices(spark, len(starts)))
    rows = frame.mapInPandas(climb, "mode array<double>, top double, hessian array<double>").collect()
    found = [(np.array(r.mode), r.top, np.array(r.hessian).reshape(DIMS, DIMS)) for r in rows if np.isfinite(r.top)]
    return sorted(found, key=lambda m: (-m[1], m[0].tolist()))


def _axes_of(hessian: np.ndarray) -> np.ndarray:
    """Lower triangular root of the inverse curvature; flat and rising directions get the widest scale."""
    hessian = np.where(np.isfinite(hessian), hessian, 0.0)
    values, vectors = np.linalg.eigh(-(hessian + hessian.T) / 2.0)
    spread = 1.0 / np.maximum(values, WIDEST ** -2)
    return np.linalg.cholesky(vectors @ np.diag(spread) @ vectors.T)


def _reach(value, frame: Frame, modes: list, limits: Limits) -> tuple[np.ndarray, np.ndarray]:
    """Box in frame coordinates that holds every visible mode and, from each, each axis as far as the density is visible."""
    low, high = np.zeros(DIMS), np.zeros(DIMS)
    floor = frame.top + math.log(KEEP)
    for mode, top, _ in modes:
        if top < floor:
            continue
        centre = np.linalg.solve(frame.axes, mode - frame.mode)
        for k in range(DIMS):
            for sign, ends in ((-1.0, low), (1.0, high)):
                far = 1.0
                while far < 4096.0 and value((mode + sign * far * frame.axes[:, k])[None, :])[0] > floor:
                    far *= 1.5
                ends[k] = sign * max(sign * ends[k], sign * centre[k] + far)
    return low, high


def _around_modes(cells: pd.DataFrame, frame: Frame, modes: list) -> pd.DataFrame:
    """Split cells near a mode until none is wider than 3 of that mode's standard deviations: nodes cannot step over a peak.

    Geometry only; a mode is near within 3 deviations, so it costs some hundred cells each.
    """
    inverse = np.linalg.inv(frame.axes)
    for mode, top, hessian in modes:
        if top < frame.top + math.log(KEEP):
            continue
        spread = np.sqrt(((inverse @ _axes_of(hessian)) ** 2).sum(axis=1))
        centre = inverse @ (mode - frame.mode)
        for k in range(DIMS):
            while True:
                low, high = cells[_LOW].to_numpy(), cells[_HIGH].to_numpy()
                near = ((low < centre + 3.0 * spread) & (high > centre - 3.0 * spread)).all(axis=1)
                wide = near & (high[:, k] - low[:, k] > 3.0 * spread[k])
                if not wide.any() or len(cells) + wide.sum() > MOST_CELLS:
                    break
                split = _halves(cells[wide].assign(axis=k)).drop(columns="parent")
                cells = pd.concat([cells.loc[~wide, _LOW + _HIGH], split], ignore_index=True)
    return cells


def _mesh(low: np.ndarray, high: np.ndarray, parts: int) -> pd.DataFrame:
    index = np.stack(np.meshgrid(*[np.arange(parts)] * DIMS, indexing="ij"), axis=-1).reshape(-1, DIMS)
    width = (high - low) / parts
    cells = pd.DataFrame(low + index * width, columns=_LOW)
    cells[_HIGH] = low + (index + 1) * width
    return cells


def _cell_nodes(cells: pd.DataFrame, frame: Frame, log_density: LogDensity, limits: Limits) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of every cell in log space (cells, 81, 4), log density and log of the cell's share of a node."""
    low, high = cells[_LOW].to_numpy(), cells[_HIGH].to_numpy()
    u = ((low + high) / 2.0)[:, None, :] + ((high - low) / 2.0)[:, None, :] * _NODE_X[None, :, :]
    # Products of the first two axes alone, so that equal pairs stay equal to the last bit.
    z = np.empty_like(u)
    for k in range(DIMS):
        z[..., k] = frame.mode[k] + sum(frame.axes[k, j] * u[..., j] for j in range(k + 1))
    value = _density_at(log_density, z.reshape(-1, DIMS), limits).reshape(len(cells), -1)
    return z, value, np.log((high - low).prod(axis=1))[:, None] + np.log(_NODE_W)[None, :]


def _evaluate(spark: SparkSession, cells: pd.DataFrame, frame: Frame, log_density: LogDensity, limits: Limits) -> pd.DataFrame:
    """Mass (relative to the frame's top) and roughest axis of every cell."""
    line = [[np.flatnonzero(_NODE[:, k] == i) for i in range(3)] for k in range(DIMS)]

    # In order of the first two axes, so that cells which share costly evaluations mostly share a task.
    table = cells[_LOW + _HIGH].rename_axis("cell").reset_index().sort_values(_LOW, kind="stable")

    def measure(batches):
        for ids in batches:
            batch = table.iloc[ids["id"].to_numpy()]
            _, value, share = _cell_nodes(batch, frame, log_density, limits)
            density = np.exp(value - frame.top)
            rough = np.stack([np.abs(density[:, a] - 2.0 * density[:, b] + density[:, c]).sum(axis=1) for a, b, c in line], axis=1)
            yield pd.DataFrame({"cell": batch["cell"], "mass": (density * np.exp(share)).sum(axis=1),
                                "axis": rough.argmax(axis=1).astype("int32"), "seen": value.max(axis=1)})

    ids = spark.range(0, len(cells), 1, _slices(spark, len(cells), 8))
    out = ids.mapInPandas(measure, "cell long, mass double, axis int, seen double").toPandas().sort_values("cell")
    return cells.assign(mass=out["mass"].to_numpy(), axis=out["axis"].to_numpy(), seen=out["seen"].to_numpy())


def _outer_mesh(spark, value, frame, modes, log_density, limits, parts) -> tuple[pd.DataFrame, np.ndarray]:
    """First mesh, its box moved out wherever a face still holds mass."""
    low, high = _reach(value, frame, modes, limits)
    for _ in range(MOST_ROUNDS):
        cells = _evaluate(spark, _mesh(low, high, parts), frame, log_density, limits)
        total, grown = cells["mass"].sum(), False
        for k in range(DIMS):
            width = high[k] - low[k]
            for column, ends, sign in ((_LOW[k], low, -1.0), (_HIGH[k], high, 1.0)):
                face = np.isclose(cells[column], ends[k])
                if total > 0 and cells["mass"][face].sum() > EDGE * total:
                    centre = [(a + b) / 2.0 for a, b in zip(low, high)]
                    centre[k] = ends[k]
                    if np.isfinite(cells["seen"][face]).any() and width < 4096.0:
                        ends[k] += sign * width / parts
                        grown = True
        if not grown:
            break
    return cells, total


def _halves(cells: pd.DataFrame) -> pd.DataFrame:
    """Both halves of every cell along its roughest axis; `parent` is the row of the cell."""
    low, high = cells[_LOW].to_numpy(), cells[_HIGH].to_numpy()
    rows, axis = np.arange(len(cells)), cells["axis"].to_numpy()
    middle = (low[rows, axis] + high[rows, axis]) / 2.0
    first_high, second_low = high.copy(), low.copy()
    first_high[rows, axis] = middle
    second_low[rows, axis] = middle
    out = pd.DataFrame(np.vstack([low, second_low]), columns=_LOW)
    out[_HIGH] = np.vstack([first_high, high])
    return out.assign(parent=np.tile(rows, 2))


def integrate(spark: SparkSession, log_density: LogDensity, box: Limits, limits: Limits, points: int) -> Quadrature:
    """Cells that integrate exp(log_density) over log space.

    `box` is what the scan covers, `limits` where the density counts at all, `points` the nodes an axis starts with.
    """
    modes = _modes(spark, log_density, _starts(spark, log_density, box, SCAN_POINTS), limits)
    if not modes:
        raise ValueError("the log posterior is not finite anywhere")
    frame = Frame(modes[0][0], _axes_of(modes[0][2]), modes[0][1])
    value = lambda z: _density_at(log_density, np.atleast_2d(z), limits)
    cells, total = _outer_mesh(spark, value, frame, modes, log_density, limits, max(LEAST_PARTS, math.ceil(points / 3)))
    close = _around_modes(cells[_LOW + _HIGH], frame, modes)
    if len(close) > len(cells):
        cells = _evaluate(spark, close, frame, log_density, limits)
        total = cells["mass"].sum()
    # Until a cell was halved once, its whole mass counts as uncertain.
    cells["error"] = cells["mass"]
    done, error, rounds = [], math.inf, 0
    for rounds in range(1, MOST_ROUNDS + 1):
        size = len(cells) + sum(map(len, done))
        open_cell = cells["error"] > TOLERANCE * total / max(size, 1)
        done.append(cells[~open_cell])
        cells = cells[open_cell].reset_index(drop=True)
        if cells.empty or size + len(cells) > MOST_CELLS:
            break
        halves = _evaluate(spark, _halves(cells), frame, log_density, limits)
        new = halves.groupby("parent")["mass"].sum().sort_index().to_numpy()
        change = np.abs(new - cells["mass"].to_numpy())
        cells = halves.assign(error=change[halves["parent"].to_numpy()] / 2.0).drop(columns="parent")
        total = cells["mass"].sum() + sum(d["mass"].sum() for d in done)
        error = (cells["error"].sum() + sum(d["error"].sum() for d in done)) / total
        if error <= TOLERANCE:
            break
    # Left to right in the frame, so that resampling in cell order is stratified.
    final = pd.concat([*done, cells], ignore_index=True).sort_values(_LOW).reset_index(drop=True)
    error = float(final["error"].sum() / final["mass"].sum())
    return Quadrature(frame, final, float(max(frame.top, final["seen"].max())), error, rounds)


def nodes(spark: SparkSession, found: Quadrature, log_density: LogDensity, limits: Limits, names: list[str]) -> DataFrame:
    """(pair, node, parameters, log_post, log_share): every node of every cell, lazily; weight = exp(log_post + log_share)."""
    frame = found.frame

    cells = found.cells[_LOW + _HIGH]

    def spell(batches):
        for ids in batches:
            batch = cells.iloc[ids["id"].to_numpy()]
            z, value, share = _cell_nodes(batch, frame, log_density, limits)
            per = len(_NODE)
            out = pd.DataFrame(np.exp(z.reshape(-1, DIMS)), columns=names)
            out.insert(0, "pair", np.repeat(ids["id"].to_numpy(), per))
            out.insert(1, "node", np.tile(np.arange(per), len(batch)))
            out = out.assign(log_post=value.ravel(), log_share=share.ravel())
            yield out[np.isfinite(out["log_post"])]

    columns = ", ".join(f"{n} double" for n in names)
    ids = spark.range(0, len(cells), 1, _slices(spark, len(cells), 8))
    return ids.mapInPandas(spell, f"pair long, node long, {columns}, log_post double, log_share double")
