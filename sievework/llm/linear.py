"""Small linear models, fitted on the driver from bounded samples."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def minimise(gradient: Callable[[np.ndarray], np.ndarray], size: int, smoothness: float, rounds: int = 400) -> np.ndarray:
    """Accelerated gradient descent on a smooth convex loss from zero; it loses its momentum where that leads uphill."""
    at = ahead = np.zeros(size)
    k = 0
    for _ in range(rounds):
        slope = gradient(ahead)
        after = ahead - slope / smoothness
        k = 0 if slope @ (after - at) > 0 else k + 1
        ahead = after + k / (k + 3) * (after - at)
        at = after
    return at
