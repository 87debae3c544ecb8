"""Rounding for numpy values, the way SQL engines do it."""

from __future__ import annotations

import numpy as np


def round_half_up(values: np.ndarray, digits: int) -> np.ndarray:
    """Halves go away from zero."""
    scale = 10.0**digits
    return np.sign(values) * np.floor(np.abs(values) * scale + 0.5) / scale
