"""Holt-Winters forecasts, one independent fit per series.

A group is one monthly series, so its size is bounded by the calendar; scale comes from the number
of series, which Spark spreads over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

SEASON = 12
HORIZON = 24
HOLDOUT = 0.1
SERIES_PER_TASK = 50
ACTUAL, HELD_OUT, FORECAST = "Actual", "Held-Out Forecast", "Forecast"

# Smoothing parameters tried first, and how the grid closes in on the best ones.
COARSE = np.round(np.arange(0.1, 1.0, 0.2), 10)
REFINEMENTS = (0.1, 0.05, 0.02)


def smooth(
    y: np.ndarray, alpha: np.ndarray, beta: np.ndarray, gamma: np.ndarray, multiplicative: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Run the recursion for many parameter sets at once.

    Starts from the first two seasons and returns level, trend, the last twelve seasonal terms and
    the squared error of the one-step forecasts.
    """
    first, second = y[:SEASON].mean(), y[SEASON : 2 * SEASON].mean()
    level = np.full(alpha.shape, first)
    trend = np.full(alpha.shape, (second - first) / SEASON)
    start = y[:SEASON] / first if multiplicative else y[:SEASON] - first
    seasonal = [np.full(alpha.shape, s) for s in start]
    error = np.zeros(alpha.shape)
    with np.errstate(all="ignore"):
        for value in y:
            s = seasonal.pop(0)
            ahead = level + trend
            error += (value - (ahead * s if multiplicative else ahead + s)) ** 2
            base = value / s if multiplicative else value - s
            new_level = alpha * base + (1 - alpha) * ahead
            new_trend = beta * (new_level - level) + (1 - beta) * trend
            season = value / ahead if multiplicative else value - ahead
            seasonal.append(gamma * season + (1 - gamma) * s)
            level, trend = new_level, new_trend
    return level, trend, np.array(seasonal), error


def project(
    level: float, trend: float, seasonal: np.ndarray, steps: int, multiplicative: bool
) -> np.ndarray:
    h = np.arange(1, steps + 1)
    season = seasonal[(h - 1) % SEASON]
    line = level + h * trend
    return line * season if multiplicative else line + season


def fit(y: np.ndarray, multiplicative: bool) -> tuple[float, float, float]:
    """Parameters with the smallest squared training error: a grid, then finer ones around it."""
    axes = [COARSE] * 3
    best = (0.5, 0.5, 0.5)
    for step in (None, *REFINEMENTS):
        if step is not None:
            offsets = np.array([-step, 0.0, step])
            axes = [np.unique(np.clip(np.round(p + offsets, 10), 0.0, 1.0)) for p in best]
        grid = np.stack(np.meshgrid(*axes, indexing="ij"), -1).reshape(-1, 3)
        error = smooth(y, *grid.T, multiplicative)[3]
        usable = np.where(np.isfinite(error), error, np.inf)
        best = tuple(float(p) for p in grid[int(np.argmin(usable))])
    return best


def start_states(y: np.ndarray, multiplicative: bool) -> np.ndarray:
    """Level, trend and seasons that ``smooth`` starts from."""
    first, second = y[:SEASON].mean(), y[SEASON : 2 * SEASON].mean()
    seasons = y[:SEASON] / first if multiplicative else y[:SEASON] - first
    return np.concatenate([[first, (second - first) / SEASON], seasons])


def one_step(y: np.ndarray, sets: np.ndarray, multiplicative: bool) -> tuple[np.ndarray, np.ndarray]:
    """Errors of the one-step forecasts and the states after them, for rows of parameters.

    A row holds alpha, beta, gamma, the start level and trend and the twelve start seasons.
    """
    alpha, beta, gamma, level, trend = sets[:, :5].T
    seasonal = list(sets[:, 5:].T)
    errors = np.empty((len(sets), len(y)))
    with np.errstate(all="ignore"):
        for i, value in enumerate(y):
            s, ahead = seasonal.pop(0), level + trend
            error = value - (ahead * s if multiplicative else ahead + s)
            errors[:, i] = error
            # what the level and the season take of the error
            shift, turn = (error / s, error / ahead) if multiplicative else (error, error)
            level = ahead + alpha * shift
            trend = trend + alpha * beta * shift
            seasonal.append(s + gamma * turn)
    return errors, np.column_stack([level, trend, *seasonal])


def fit_all(y: np.ndarray, multiplicative: bool, rounds: int = 200) -> np.ndarray:
    """Smoothing parameters in [0, 1] and start states with the least squared training error.

    Damped Gauss-Newton steps with the smoothing parameters projected into their bounds; those held
    at a bound stay out of the step. It starts from ``fit`` and from fixed guesses, keeps the best and
    only takes steps that lower the error, so it ends no higher than ``fit``.
    """
    states = start_states(y, multiplicative)
    guesses = [fit(y, multiplicative), (0.5, 0.1, 0.1), (0.1, 0.01, 0.01), (0.02, 0.0, 0.5)]
    found = [_descend(y, np.concatenate([g, states]), multiplicative, rounds) for g in guesses]
    return min(found, key=lambda pair: pair[0])[1]


def _descend(
    y: np.ndarray, point: np.ndarray, multiplicative: bool, rounds: int
) -> tuple[float, np.ndarray]:
    def squares(errors: np.ndarray) -> float:
        total = float(np.sum(errors**2))
        return total if np.isfinite(total) else np.inf

    error, damping = squares(one_step(y, point[None], multiplicative)[0][0]), 1e-3
    for _ in range(rounds):
        width = 1e-6 * np.maximum(1.0, np.abs(point))
        # differences are taken inwards, so that no parameter leaves its bounds
        width[:3] = np.where(point[:3] > 0.5, -width[:3], width[:3])
        errors = one_step(y, np.vstack([point, point + np.diag(width)]), multiplicative)[0]
        if not np.isfinite(errors).all():
            break
        slopes = (errors[1:] - errors[0]) / width[:, None]
        gradient = slopes @ errors[0]
        held = np.zeros(len(point), dtype=bool)
        held[:3] = ((point[:3] <= 0) & (gradient[:3] > 0)) | ((point[:3] >= 1) & (gradient[:3] < 0))
        free = slopes[~held]
        normal = free @ free.T
        scale = np.diag(np.maximum(np.diag(normal), 1e-12))
        lowered = False
        while damping < 1e12 and not lowered:
            step = np.zeros(len(point))
            step[~held] = np.linalg.lstsq(normal + damping * scale, -gradient[~held], rcond=None)[0]
            trial = point + step
            trial[:3] = np.clip(trial[:3], 0.0, 1.0)
            tried = squares(one_step(y, trial[None], multiplicative)[0][0])
            lowered = tried < error
            damping = max(damping / 5, 1e-12) if lowered else damping * 4
        if not lowered:
            break
        gain, point, error = error - tried, trial, tried
        if gain <= 1e-12 * error:
            break
    return error, point


def forecast_schema(series: DataFrame, keys: Sequence[str]) -> T.StructType:
    return T.StructType(
        [T.StructField(k, series.schema[k].dataType) for k in keys]
        + T.StructType.fromDDL(
            "month_end date, count double, type string, forecasted boolean, rmse double, "
            "alpha double, beta double, gamma double, seasonal string"
        ).fields
    )


def forecast(
    series: DataFrame,
    keys: Sequence[str] = (),
    parameters: tuple[float, float, float] | None = None,
    fit_states: bool = False,
) -> DataFrame:
    """Actual counts, the forecast of the held-out months and the forecast beyond.

    The last tenth of a series is held out. The season is additive as soon as one month has no
    count, otherwise multiplicative. Without two full training seasons, or with nothing to hold
    out, only the actual counts come back. ``parameters`` fixes (alpha, beta, gamma); ``fit_states``
    fits the states a series starts from as well, by ``fit_all``.
    """
    keys = list(keys)
    schema = forecast_schema(series, keys)

    def one_series(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("month_end")
        y = group["count"].to_numpy(dtype="float64")
        months = pd.to_datetime(group["month_end"])
        held = round(len(y) * HOLDOUT)
        train = y[: len(y) - held]
        forecasted = held > 0 and len(train) >= 2 * SEASON
        parts = [pd.DataFrame({"month_end": months, "count": y, "type": ACTUAL})]
        rmse, used, kind = None, (None, None, None), None
        if forecasted:
            multiplicative = bool((y >= 1).all())
            kind = "multiplicative" if multiplicative else "additive"
            if fit_states:
                point = fit_all(train, multiplicative)
                used = tuple(float(p) for p in point[:3])
                level, trend, *seasonal = one_step(train, point[None], multiplicative)[1][0]
            else:
                used = parameters or fit(train, multiplicative)
                states = smooth(train, *[np.array([p]) for p in used], multiplicative)[:3]
                level, trend, seasonal = states[0][0], states[1][0], states[2][:, 0]
            ahead = project(level, trend, np.array(seasonal), held + HORIZON, multiplicative)
            last = months.iloc[len(train) - 1]
            dates = pd.date_range(last + pd.offsets.MonthEnd(1), periods=len(ahead), freq="ME")
            rmse = float(round(np.sqrt(np.mean((y[len(train) :] - ahead[:held]) ** 2))))
            parts += [
                pd.DataFrame(
                    {"month_end": dates[:held], "count": ahead[:held], "type": HELD_OUT}
                ),
                pd.DataFrame({"month_end": dates, "count": ahead, "type": FORECAST}),
            ]
        out = pd.concat(parts, ignore_index=True)
        for key in keys:
            out[key] = group[key].iloc[0]
        out["month_end"] = out["month_end"].dt.date
        out["forecasted"], out["rmse"], out["seasonal"] = forecasted, rmse, kind
        out["alpha"], out["beta"], out["gamma"] = used
        return out[schema.names]

    if not keys:
        return series.groupBy().applyInPandas(one_series, schema)
    # a fit is much work on few bytes, so the rows must not be packed into few tasks by size
    n = series.select(*keys).distinct().count()
    spread = series.repartition(max(1, -(-n // SERIES_PER_TASK)), *keys)
    return spread.groupBy(*keys).applyInPandas(one_series, schema)
