"""L-BFGS and its orthant-wise form (OWL-QN) as generators: each yields the point it
wants evaluated and is sent ``(value, gradient)``, so that one scan of the rows serves
many fits at once. Steps, line searches and stopping rules are those that Spark's own
estimators use, on vectors of a model's size."""

from __future__ import annotations

from collections.abc import Generator

import numpy as np

Point = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class _Failed(Exception):
    """A line search that gives up; the history is dropped once, then the fit ends."""


def _direction(grad, history):
    out = grad.copy()
    if history:
        step, change = history[0]
        sy = step @ change
        if sy < 0 or np.isnan(sy):
            raise _Failed
        diag = sy / (change @ change)
    else:
        diag = 1.0
    parts = []
    for step, change in history:
        rho = step @ change
        a = (step @ out) / rho
        if np.isnan(a):
            raise _Failed
        out -= a * change
        parts.append((a, rho))
    out *= diag
    for (step, change), (a, rho) in zip(reversed(history), reversed(parts)):
        out += (a - (change @ out) / rho) * step
    return -out


def _between(low, high):
    """Minimum of the cubic through two brackets ``(t, slope, value)``, kept off their ends."""
    d1 = low[1] + high[1] - 3 * (low[2] - high[2]) / (low[0] - high[0])
    d2 = np.sqrt(d1 * d1 - low[1] * high[1])
    width = high[0] - low[0]
    t = high[0] - width * (high[1] + d2 - d1) / (high[1] - low[1] + 2 * d2)
    return low[0] + 0.1 * width if t < low[0] + 0.1 * width else min(t, low[0] + 0.9 * width) if t == t else t


def _strong_wolfe(slope_at, t):
    """Step that meets the strong Wolfe conditions. ``slope_at(t)``: generator of a bracket."""
    c1, c2 = 1e-4, 0.9
    low = yield from slope_at(0.0)
    value, slope = low[2], low[1]
    if slope > 0:
        raise _Failed
    for i in range(10):
        c = yield from slope_at(t)
        if not np.isfinite(c[2]):
            t /= 2.0
            continue
        if c[2] > value + c1 * t * slope or (c[2] >= low[2] and i > 0):
            high = c
        elif abs(c[1]) <= c2 * abs(slope):
            return c[0]
        elif c[1] >= 0:
            low, high = c, low
        else:
            low, t = c, t * 1.5
            continue
        for _ in range(10):
            c = yield from slope_at(_between(high, low) if low[0] > high[0] else _between(low, high))
            if c[2] > value + c1 * c[0] * slope or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= c2 * abs(slope):
                    return c[0]
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _Failed
    raise _Failed


def _backtracking(slope_at, t, value, shrink):
    _, slope, start = yield from slope_at(0.0)
    c = yield from slope_at(t)
    c = (t, c[1], value)  # the first step is judged by the value without penalties
    for i in range(21):
        if c[2] > start + t * slope * 1e-4:
            by = shrink
        elif c[1] < 0.9 * slope:
            by = 2.1
        elif abs(c[1]) > -0.9 * slope:
            by = shrink
        else:
            return t
        if i >= 20 or not 1e-10 <= t * by <= 1e10:
            raise _Failed
        t *= by
        c = yield from slope_at(t)


def minimize(x: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10,
             l1: np.ndarray | None = None) -> Point:
    """Generator that ends with the point found. ``l1``: penalty of each coordinate's size."""
    known: list[tuple[np.ndarray, tuple]] = []

    def value_at(p):
        for q, got in known:
            if np.array_equal(p, q):
                return got
        got = yield p
        known.append((p.copy(), got))
        del known[:-3]
        return got

    def adjusted(p, value, grad):
        if l1 is None:
            return value, grad
        up, down = grad + l1, grad - l1
        at_zero = np.where(down > 0, down, np.where(up < 0, up, 0.0))
        out = np.where(l1 == 0, grad, np.where(p == 0, at_zero, grad + np.sign(p) * l1))
        return value + float(np.sum(np.abs(l1 * p))), out

    value, grad = yield from value_at(x)
    adj_value, adj_grad = adjusted(x, value, grad)
    first, i, history, values, failed = adj_value, 0, [], [np.inf], False
    while not (i >= max_iter
               or (len(values) >= 2 and abs(adj_value - max(values)) <= tol * first)
               or np.linalg.norm(adj_grad) <= max(tol * adj_value, 1e-8)):
        try:
            to = _direction(adj_grad, history)
            if l1 is None:
                move = lambda t: x + to * t
            else:
                to = np.where(to * adj_grad < 0, to, 0.0)
                side = np.where(x != 0, np.sign(x), np.sign(-adj_grad))

                def move(t):
                    p = x + to * t
                    return p * (np.sign(p) == side)

            def slope_at(t):
                p = move(t)
                v, g = yield from value_at(p)
                v, g = adjusted(p, v, g)
                return t, float(g @ to), v

            if l1 is None:
                step = yield from _strong_wolfe(slope_at, 1.0 / np.linalg.norm(to) if i == 0 else 1.0)
                if step * np.linalg.norm(grad) < 1e-10:
                    raise _Failed
            else:
                step = yield from _backtracking(slope_at, 0.5 / np.linalg.norm(grad) if i < 1 else 1.0, value,
                                                0.1 if i < 1 else 0.5)
            new = move(step)
            new_value, new_grad = yield from value_at(new)
            history = [(new - x, new_grad - grad), *history][:memory]
            values = [*values, new_value][-20:]
            x, value, grad = new, new_value, new_grad
            adj_value, adj_grad = adjusted(x, value, grad)
            i, failed = i + 1, False
        except _Failed:
            if failed:
                break
            failed, history = True, []
    return x
