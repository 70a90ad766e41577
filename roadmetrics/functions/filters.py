"""Zero-phase and smoothing filters per series, in numpy (scipy's conventions, without scipy)."""

from __future__ import annotations

import math

import numpy as np

#: Values by which a series is extended at each end before it is filtered.
PAD = 9

def butter2(cutoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Second-order Butterworth low-pass for a cutoff in units of the Nyquist rate, by the bilinear transform."""
    w = math.tan(math.pi * cutoff / 2)
    norm = 1 + math.sqrt(2) * w + w * w
    b = np.array([1.0, 2.0, 1.0]) * (w * w / norm)
    return b, np.array([1.0, 2 * (w * w - 1) / norm, (1 - math.sqrt(2) * w + w * w) / norm])


def steady_state(b: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The filter's two states, per unit of a value that has always been the same."""
    second = b[2] - a[2] * b.sum() / a.sum()
    return np.array([b[1] - a[1] * b.sum() / a.sum() + second, second])


def block_pass(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the filter makes of x from a state, and the state after it.

    A block of rows maps the state before it to the state after it by an affine map. x is laid out as about as many
    blocks as a block has rows: all blocks are run at once from the zero state, the maps are composed over the blocks, and
    each block's answer to the state before it is added, so no loop is longer than the root of the length.
    """
    n = len(x)
    if not n:
        return np.empty(0), np.asarray(state, float)
    step = np.array([[-a[1], 1.0], [-a[2], 0.0]])
    width = math.isqrt(n - 1) + 1
    blocks = -(-n // width)
    rows = np.zeros((blocks, width))
    rows.ravel()[:n] = x
    left = n - (blocks - 1) * width  # rows in the last block
    out, z, answer = np.empty_like(rows), np.zeros((blocks, 2)), np.empty((width, 2))
    power, last_power = np.eye(2), None
    for i in range(width):
        answer[i] = power[0]
        v = rows[:, i]
        y = b[0] * v + z[:, 0]
        out[:, i] = y
        z = np.column_stack([b[1] * v - a[1] * y + z[:, 1], b[2] * v - a[2] * y])
        power = step @ power
        if i + 1 == left:
            last, last_power = z[-1].copy(), power
    before = np.empty((blocks, 2))
    at = np.asarray(state, float)
    for k in range(blocks):
        before[k] = at
        at = power @ at + z[k]
    return (out + before @ answer.T).ravel()[:n], last_power @ before[-1] + last


def _pass(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """One pass that starts in the steady state of the first value."""
    return block_pass(b, a, x, steady_state(b, a) * x[0])[0]


def lowpass(x: np.ndarray, cutoff_hz: float, rate_hz: float, least: int = 10) -> np.ndarray:
    """Forward and backward pass over the series with odd extensions of nine values. Series shorter than least, and
    cutoffs beyond the Nyquist rate, pass unchanged."""
    x = np.asarray(x, float)
    cutoff = cutoff_hz / (rate_hz / 2)
    if len(x) < max(least, 10) or cutoff >= 1 or cutoff <= 0:
        return x
    b, a = butter2(cutoff)
    wide = np.concatenate([2 * x[0] - x[PAD:0:-1], x, 2 * x[-1] - x[-2 : -PAD - 2 : -1]])
    return _pass(b, a, _pass(b, a, wide)[::-1])[::-1][PAD:-PAD]


def savgol(x: np.ndarray, window: int, order: int = 3) -> np.ndarray:
    """Least-squares polynomial smoothing; the ends take the fit of the first and last full window."""
    x = np.asarray(x, float)
    window += 1 - window % 2
    if len(x) < window or window <= order:
        return x
    half = window // 2
    at = np.arange(-half, half + 1)
    fit = np.linalg.pinv(np.vander(at, order + 1, increasing=True))
    out = np.convolve(x, fit[0][::-1], "same")
    for rows, start in ((slice(0, half), 0), (slice(len(x) - half, None), len(x) - window)):
        curve = fit @ x[start : start + window]
        where = np.arange(len(x))[rows] - start - half
        out[rows] = np.vander(where, order + 1, increasing=True) @ curve
    return out


def resample(t: np.ndarray, x: np.ndarray, rate_hz: float) -> tuple[np.ndarray, np.ndarray]:
    """Linear interpolation onto a uniform grid."""
    if len(t) < 2:
        return t, x
    grid = np.arange(t[0], t[-1], 1 / rate_hz)
    return grid, np.interp(grid, t, x)


def robust_jerk(t: np.ndarray, acc: np.ndarray, cutoff_hz: float = 3.0, most: float = 15.0, gap: float = 1.0) -> np.ndarray:
    """Jerk of a filtered acceleration series: central differences with the median step; zero around time gaps; values
    beyond most are NaN. The cutoff is kept below 99 % of the Nyquist rate."""
    t, acc = np.asarray(t, float), np.asarray(acc, float)
    if len(t) <= 2:
        return np.zeros(len(t))
    dt = np.diff(t)
    step = float(np.median(dt[dt > 0])) if (dt > 0).any() else 0.0
    if step <= 0:
        return np.zeros(len(t))
    jerk = np.gradient(lowpass(acc, min(cutoff_hz, 0.99 / (2 * step)), 1 / step), step)
    for i in np.flatnonzero(dt > gap):
        jerk[max(0, i - 2) : i + 3] = 0.0
    return np.where(np.abs(jerk) > most, np.nan, jerk)
