"""Vectors of Arrow columns as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def matrices(column: pa.Array, rows: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and double-precision vectors, one matrix for each length of vector.

    Missing and empty vectors and those with missing or non-finite components are left out.
    """
    for at in range(0, len(column), rows):
        part = column.slice(at, rows)
        lengths = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
        for length in np.unique(lengths[lengths > 0]):
            own = np.flatnonzero(lengths == length)
            flat = part.take(pa.array(own)).flatten().cast(pa.float64(), safe=False)
            values = flat.to_numpy(zero_copy_only=False).reshape(len(own), int(length))
            good = np.isfinite(values).all(axis=1)
            if good.any():
                yield own[good] + at, values[good]
