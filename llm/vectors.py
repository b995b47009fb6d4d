"""Fixed-width vectors packed into Arrow binary values."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def lists(column: pa.Array, dtype: type = np.float64) -> list[np.ndarray | None]:
    """The vectors of a list column; None for a null, and for one that holds a null or non-finite component."""
    column = column.cast(pa.large_list(pa.float64())) if not pa.types.is_null(column.type) else None
    if column is None:
        return []
    ends = column.offsets.to_numpy()
    values = column.values
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64)
    bad = ~np.isfinite(flat)
    if values.null_count:
        bad |= np.asarray(values.is_null())
    missing = np.asarray(column.is_null())
    wrong = np.concatenate([[0], np.cumsum(bad)])
    return [
        None if missing[i] or wrong[b] > wrong[a] else flat[a:b].astype(dtype)
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))
    ]


def matrix(data: bytes, dim: int, dtype: type = np.float64) -> np.ndarray:
    return np.frombuffer(data, dtype).reshape(-1, dim)
