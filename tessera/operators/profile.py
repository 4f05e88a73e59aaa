"""Logistic regression with profile-likelihood limits.

A limit of a coefficient is where the log-likelihood, maximised over all other coefficients, has
fallen by half the chi-square quantile.  At a limit two things hold: the log-likelihood has
that value, and its slope in every other coefficient is zero.  These are as many equations as
coefficients, and Newton's steps solve them from the log-likelihood, gradient and X'WX at the
present point.  The points of all coefficients and both sides go through the data together: one
pass per round sums these figures for each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import distributions as D


def _partial(batches, points: np.ndarray, centre: np.ndarray, scale: np.ndarray):
    """Sums of a partition for each point: log-likelihood, gradient, X'WX."""
    total = np.zeros((len(points), 1 + points.shape[1] + points.shape[1] ** 2))
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
        if not len(y):
            continue
        x = np.column_stack([np.ones(len(y)), *[(batch.column(1 + k).to_numpy(zero_copy_only=False) - centre[k]) / scale[k] for k in range(len(centre))]])
        for i, beta in enumerate(points):
            eta = x @ beta
            low = np.logaddexp(0, eta)
            mu = np.exp(eta - low)
            w = mu * np.exp(-low)
            total[i, 0] += (y * eta - low).sum()
            total[i, 1: 1 + len(beta)] += x.T @ (y - mu)
            total[i, 1 + len(beta):] += (x.T @ (x * w[:, None])).ravel()
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(points), dtype=np.int32), total.shape[1])),
                                      pa.array(np.tile(np.arange(total.shape[1], dtype=np.int32), len(points))), pa.array(total.ravel())],
                                     names=["point", "at", "value"])


class Likelihood:
    """The log-likelihood of a written table of a 0/1 label and features, standardised on the fly."""

    def __init__(self, rows: DataFrame, label: str, features: Sequence[str]):
        self.rows, self.p = rows.select(F.col(label).cast("double"), *[F.col(c).cast("double") for c in features]), len(features) + 1
        found = rows.agg(*[f(F.col(c).cast("double")).alias(f"{n}{k}") for k, c in enumerate(features) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()
        self.centre = np.array([found[f"m{k}"] or 0.0 for k in range(len(features))])
        scale = np.array([found[f"s{k}"] or 0.0 for k in range(len(features))])
        self.scale = np.where(scale > 0, scale, 1.0)

    def at(self, points: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Log-likelihood, gradient and information at each point, in one pass."""
        centre, scale, p = self.centre, self.scale, self.p
        sums = (self.rows.mapInArrow(lambda b: _partial(b, points, centre, scale), "point int, at int, value double")
                .groupBy("point", "at").agg(F.sum("value").alias("value")).collect())  # coefficients squared, per point
        out = np.zeros((len(points), 1 + p + p * p))
        for r in sums:
            out[r["point"], r["at"]] = r["value"]
        return [(o[0], o[1: 1 + p], o[1 + p:].reshape(p, p)) for o in out]


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray | None:
    try:
        step = np.linalg.solve(matrix, right)
    except np.linalg.LinAlgError:
        return None
    return step if np.isfinite(step).all() else None


def maximum(like: Likelihood, rounds: int = 50, tolerance: float = 1e-10):
    """(coefficients, log-likelihood, information) by Newton's method with halved steps; None if there is no maximum."""
    beta = np.zeros(like.p)
    value, slope, info = like.at(beta[None])[0]
    for _ in range(rounds):
        step = _solve(info, slope)
        if step is None or np.abs(beta).max() > 1e3:
            return None
        if slope @ step < tolerance * (1 + abs(value)):
            # Where classes separate, the likelihood flattens out with the weights instead of reaching a top.
            return (beta, value, info) if np.linalg.eigvalsh(info)[0] > 1e-6 else None
        # All halvings of the step go through the data at once; the longest that gains is taken.
        tries = [beta + step / 2 ** k for k in range(6)]
        found = like.at(np.array(tries))
        k = next((i for i, f in enumerate(found) if f[0] > value), None)
        if k is None:
            return beta, value, info
        beta, (value, slope, info) = tries[k], found[k]
    return None


def limits(like: Likelihood, best, level: float = 0.95, rounds: int = 40, tolerance: float = 1e-9) -> np.ndarray:
    """(coefficients, 2) limits; infinite where the likelihood does not fall far enough, NaN without convergence."""
    beta, peak, info = best
    p, half = like.p, D.norm_ppf(0.5 + level / 2) ** 2 / 2
    out = np.full((p, 2), np.nan)
    cover = np.linalg.inv(info)
    live, points = [], []
    for j in range(p):
        for side, sign in enumerate((-1.0, 1.0)):
            live.append((j, side))
            points.append(beta + sign * np.sqrt(2 * half / cover[j, j]) * cover[:, j])
    points = np.array(points)
    for _ in range(rounds):
        found, rest = like.at(points), []
        for i, ((j, side), (value, slope, inside)) in enumerate(zip(live, found, strict=True)):
            away, others = value - (peak - half), np.delete(slope, j)
            # The slope of the others, as the gain that one more Newton step would bring.
            part = np.delete(np.delete(inside, j, 0), j, 1)
            step = _solve(part, others) if len(others) else np.zeros(0)
            gain = abs(others @ step) if step is not None else np.inf
            if abs(away) < tolerance * max(half, 1) and gain < tolerance:
                out[j, side] = points[i, j]
                continue
            system = -inside.copy()
            system[j] = slope
            right = -slope.copy()
            right[j] = -away
            move = _solve(system, right)
            if move is None or abs(points[i, j] + move[j]) > 1e3:
                out[j, side] = np.inf * (1 if side else -1)
                continue
            # No step of more than a few standard errors, and none beyond the maximum.
            size = np.sqrt(np.diag(cover))
            move /= max(1.0, (np.abs(move) / (4 * size)).max())
            while (points[i, j] + move[j] - beta[j]) * (1 if side else -1) <= 0 and np.abs(move).max() > 1e-12:
                move /= 2
            rest.append((j, side, points[i] + move))
        if not rest:
            break
        live, points = [(j, s) for j, s, _ in rest], np.array([x for _, _, x in rest])
    return out


def profile_odds(rows: DataFrame, label: str, features: Sequence[str], level: float = 0.95) -> list[dict]:
    """term, log_odds, odds_ratio, std_error, conf_low, conf_high (odds ratios at the profile limits), p_value.

    ``rows`` must be written, as each round reads them once.  Rows with NULLs must be left out before.  Where the classes can be
    separated there is no maximum, and an error says so.
    """
    like = Likelihood(rows, label, features)
    best = maximum(like)
    if best is None:
        raise ValueError("no maximum likelihood estimate: the classes can be separated, or predictors are collinear")
    beta, _, info = best
    error, bound = np.sqrt(np.diag(np.linalg.inv(info))), limits(like, best, level)

    def odds(x):
        return float(np.exp(x)) if x < 709 else float("inf")
    out = []
    for k, name in enumerate(features, 1):
        unit = like.scale[k - 1]
        out.append({"term": name, "log_odds": float(beta[k] / unit), "odds_ratio": odds(beta[k] / unit), "std_error": float(error[k] / unit),
                    "conf_low": odds(bound[k, 0] / unit), "conf_high": odds(bound[k, 1] / unit),
                    "p_value": float(2 * (1 - D.norm_cdf(abs(beta[k] / error[k]))))})
    return out
