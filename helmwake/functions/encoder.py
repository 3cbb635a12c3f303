"""JSON of NumPy values."""

from __future__ import annotations

import json

import numpy as np


class PlainEncoder(json.JSONEncoder):
    """Writes NumPy arrays as lists and NumPy scalars as numbers."""

    def default(self, o):
        return o.tolist() if isinstance(o, (np.ndarray, np.generic)) else super().default(o)
