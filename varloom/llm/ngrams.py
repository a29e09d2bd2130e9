"""Hashed character n-grams of whole texts, in numpy over code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[:48] = _FOLD[58:97] = _FOLD[123:] = 32  # of ASCII only letters and digits count
_STEP, _LAST = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Characters whose n-grams are made at once, so that memory doesn't follow a text's length.
PIECE = 1 << 19


def folded(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text; each run of other ASCII is one space, and a space stands at both ends."""
    a = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), "<u4").copy()
    low = a < 128
    a[low] = _FOLD[a[low]]
    space = a == 32
    a = a[~(space & np.concatenate([[False], space[:-1]]))]
    return a if len(a) > 1 else a[:0]


def gram_bins(a: np.ndarray, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Bins of all n-grams of these sizes, with repeats, part by part."""
    for at in range(0, len(a), PIECE):
        part = a[at : at + PIECE + max(sizes) - 1].astype(np.uint64)
        h = part.copy()
        for n in range(1, max(sizes) + 1):
            m = min(PIECE, len(a) - at - n + 1)  # n-grams that begin in this part
            if m <= 0:
                break
            if n > 1:
                h = h[: len(part) - n + 1] * _STEP
                h ^= h >> np.uint64(31)
                h += part[n - 1 :]
            if n in sizes:
                x = h[:m] + np.uint64(n)
                x ^= x >> np.uint64(32)
                x *= _LAST
                yield (x >> np.uint64(64 - bits)).astype(np.int64)
