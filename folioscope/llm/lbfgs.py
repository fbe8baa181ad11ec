"""A small limited-memory BFGS for the models that are fitted on the driver from a bounded sample."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int = 80, memory: int = 8) -> np.ndarray:
    """The point reached from ``x`` after at most ``steps`` iterations; ``f`` gives value and gradient."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, used = grad.copy(), []
        for s, y, rho in reversed(past):
            a = rho * s.dot(q)
            q -= a * y
            used.append(a)
        if past:
            s, y, _ = past[-1]
            q *= s.dot(y) / y.dot(y)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, y, rho), a in zip(past, reversed(used)):
            q += (a - rho * y.dot(q)) * s
        slope, t = -grad.dot(q), 1.0
        if slope >= 0:
            break
        for _ in range(25):
            new = x - t * q
            v, g = f(new)
            if v <= value + 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, y = new - x, g - grad
        if s.dot(y) > 1e-10:
            past = [*past[1 - memory :], (s, y, 1 / s.dot(y))]
        done = abs(value - v) < 1e-7 * max(1.0, abs(value))
        x, value, grad = new, v, g
        if done:
            break
    return x
