"""Word shingles of whole texts as 64-bit hashes, many documents at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1
_TABLE = np.random.default_rng(911).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    have = next(iter(_powers), 0)
    if have < size:
        size = max(size, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        up, down = np.full(size, _BASE), np.full(size, inverse)
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        _powers.clear()
        _powers[size] = (up, down)
    return next(iter(_powers.values()))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix64 finaliser, a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of ``data[starts:ends]`` for every pair, from prefix sums of one polynomial."""
    up, down = _power_table(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[data] * up[: len(data)])))
        return mix((sums[ends] - sums[starts]) * down[starts])


def word_shingles(texts: Iterable[str | None], words: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    Words are runs of bytes other than ASCII white space, with A-Z in lower case; a text with
    fewer than ``words`` of them has its whole sequence as the only shingle.
    """
    split = [t.encode().lower().split() if t else [] for t in texts]
    flat = [w for ws in split for w in ws]
    data = np.frombuffer(b" ".join(flat) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, flat), np.int64, len(flat)) + 1)
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1])) if len(ends) else ends
    at = np.cumsum([0] + [len(ws) for ws in split])
    full = span_hashes(data, starts[: max(0, len(starts) - words + 1)], ends[words - 1 :]) if len(flat) >= words else None
    for a, b in zip(at.tolist(), at[1:].tolist()):
        if b == a:
            yield np.empty(0, np.uint64)
        elif b - a < words:
            yield span_hashes(data[starts[a] : ends[b - 1]], np.array([0]), np.array([ends[b - 1] - starts[a]]))
        else:
            yield np.unique(full[a : b - words + 1])


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set of shingle hashes."""
    with np.errstate(over="ignore"):
        total = np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))], np.uint64)
    return int(mix(total).view(np.int64)[0])


def as_long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def blobs(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())
