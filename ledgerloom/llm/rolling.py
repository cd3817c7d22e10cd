"""Rolling hashes of byte strings in numpy. Sums and products wrap at 64 bits."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20240229)
#: A random value for each byte, so that the polynomial does not see the bytes themselves.
BYTES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_rng.integers(1, 2**62, dtype=np.uint64)) * 4 + 5
INVERSE = pow(BASE, -1, 1 << 64)
#: Odd multipliers for joining values.
JOIN = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Powers:
    """Powers of the base and its inverse, grown when needed."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = powers(BASE, size), powers(INVERSE, size)
        return self.up, self.down


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit counts."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray, up: np.ndarray) -> np.ndarray:
    """``out[i]``: hash sum of the first i bytes; the hash of bytes s to e is ``(out[e] - out[s]) * down[s]``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTES[data] * up[: len(data)], out=out[1:])
    return out
