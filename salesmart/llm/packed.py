"""Arrays of whole numbers as binary values, one cell for an array (run inside tasks)."""

from __future__ import annotations

import numpy as np


def pack(numbers: np.ndarray) -> bytes:
    """Numbers not below 0 in as few bytes each as the largest needs, after the name of their type."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return kind.char.encode() + numbers.astype(kind).tobytes()


def unpack(data: bytes) -> np.ndarray:
    """The numbers of :func:`pack`, as 64-bit integers."""
    return np.frombuffer(data, np.dtype(chr(data[0])), offset=1).astype(np.int64)
