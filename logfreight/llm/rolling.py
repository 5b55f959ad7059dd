"""Rolling hashes and window minima over arrays, without a loop over positions."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}
# Power tables up to this length are kept between calls.
_KEPT = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n > len(_POWERS["up"]):
        made = {}
        for kind, base in (("up", BASE), ("down", _INVERSE)):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            made[kind] = np.multiply.accumulate(table)
        if n <= _KEPT:
            _POWERS.update(made)
        return made["up"], made["down"]
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit integers, so that their order is as good as random."""
    x = values ^ (values >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(30)
    return x


def gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` symbols: polynomial, from running sums."""
    n = len(symbols)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((symbols.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * down[: n - k + 1])


def window_minima(keys: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` neighbours, by minima over widths that double."""
    n = len(keys)
    if n <= w:
        return keys.min(keepdims=True) if n else keys
    width = 1
    while 2 * width <= w:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    return np.minimum(keys[: n - w + 1], keys[w - width :]) if width < w else keys


def winnowed(hashes: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and position of the minimum of each window; of equal ones the rightmost.

    Minima are taken over the upper 32 bits of the hashes joined to the negated position.
    """
    low = np.uint64(0xFFFFFFFF)
    places = np.arange(len(hashes), dtype=np.uint64)
    keys = (hashes & ~low) | (low - places)
    chosen = window_minima(keys, w)
    if len(chosen) > 1:
        chosen = chosen[np.concatenate(([True], chosen[1:] != chosen[:-1]))]
    return (chosen >> np.uint64(32)).astype(np.uint32), (low - (chosen & low)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
