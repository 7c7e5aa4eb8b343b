"""Numbers that describe a text's passages, computed over its bytes with numpy."""
from __future__ import annotations

import numpy as np

PASSAGE = 64  #: words of a passage
BIGRAMS = 32  #: hashed byte pairs
SURFACE = 15
WIDTH = SURFACE + BIGRAMS


def _classes() -> np.ndarray:
    """0 space, 1 lower, 2 upper, 3 digit, 4 symbol, 5 `!` and `?`, 6 other ASCII, 7 beyond ASCII."""
    of = np.full(256, 6, np.uint8)
    of[[9, 10, 11, 12, 13, 32]] = 0
    of[97:123], of[65:91], of[48:58], of[128:] = 1, 2, 3, 7
    of[[ord(c) for c in "#*$%&|<>{}[]=\\^~_"]] = 4
    of[[ord("!"), ord("?")]] = 5
    return of


CLASS = _classes()
SOLID = CLASS > 0
#: Letters and digits in lower case, what lies beyond ASCII as it is, 0 for all else: what a word's hash is made of.
FOLD = np.array([ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else b if b >= 128 else 0 for b in range(256)], np.uint32)
_BASE = 2654435761
_INVERSE = pow(_BASE, -1, 1 << 32)


class _Powers:
    """Powers of an odd number and of its inverse mod 2**32, as many as the longest text so far has bytes."""

    up = down = np.ones(1, np.uint32)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 17)
            made = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint32), np.full(size - 1, r, np.uint32)]), dtype=np.uint32) for r in (_BASE, _INVERSE)]
            if size > 1 << 24:  # not kept for one enormous text
                return made[0], made[1]
            cls.up, cls.down = made
        return cls.up, cls.down


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes, and each word's start and hash (of its letters and digits, the case folded; 0 if it has none).

    A word's hash is a polynomial in its bytes: summed with powers of the bytes' places, then shifted back to the
    word's start by the inverse's power."""
    x = np.frombuffer(text, np.uint8)
    solid = SOLID[x]
    edges = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    starts = np.concatenate([np.zeros(1, np.int64), edges]) if len(x) and solid[0] else edges
    if not len(starts):
        return x, starts, np.zeros(0, np.uint32)
    up, down = _Powers.to(len(x))
    hashes = np.add.reduceat(FOLD[x] * up[: len(x)], starts, dtype=np.uint32) * down[starts]
    hashes ^= hashes >> np.uint32(15)
    return x, starts, hashes * np.uint32(2246822519)


def _repeats(h: np.ndarray) -> np.ndarray:
    """For each word whether the window of three from it on occurs more than once."""
    out = np.zeros(len(h), np.float32)
    if len(h) > 2:
        w = h[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + h[1:-1].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + h[2:]
        _, back, n = np.unique(w, return_inverse=True, return_counts=True)
        out[:-2] = n[back] > 1
    return out


Parsed = tuple[np.ndarray, np.ndarray, np.ndarray]


def passage_features(text: bytes | None, parsed: Parsed | None = None, grams: bool = True) -> np.ndarray:
    """(passages, WIDTH) float32, or without the byte pairs (passages, SURFACE); one row of zeros for a text without
    words. `parsed`: what words() gives, if it is known."""
    x, starts, h = parsed or words(text or b"")
    if not len(starts):
        return np.zeros((1, WIDTH if grams else SURFACE), np.float32)
    first = np.arange(0, len(starts), PASSAGE)
    if len(first) > 1 and len(starts) - first[-1] < PASSAGE // 2:
        first = first[:-1]  # a short rest belongs to the passage before
    k = len(first)
    begin = starts[first]
    begin[0] = 0
    sizes = np.empty(k, np.int64)
    sizes[:-1], sizes[-1] = begin[1:] - begin[:-1], len(x) - begin[-1]
    n_words = np.full(k, PASSAGE, np.float32)
    n_words[-1] = len(starts) - first[-1]
    size = sizes.astype(np.float32)
    of = np.repeat(np.arange(0, 8 * k, 8), sizes)
    counts = np.bincount(of + CLASS[x], minlength=8 * k).reshape(k, 8)
    same = np.zeros(len(h), np.float32)
    same[1:] = h[1:] == h[:-1]
    per_word = np.add.reduceat(np.stack([same, _repeats(h), (h == 0).astype(np.float32)]), first, axis=1) / n_words
    lines = np.add.reduceat(x == 10, begin, dtype=np.float32)
    known = h.tolist()
    bounds = [*first.tolist(), len(known)]
    distinct = np.array([len(set(known[a:b])) for a, b in zip(bounds, bounds[1:])], np.float32) / n_words
    surface = np.empty((k, SURFACE), np.float32)
    surface[:, :8] = counts / size[:, None]
    surface[:, 8] = (size - counts[:, 0]) / n_words / 8
    surface[:, 9], surface[:, 10], surface[:, 12] = per_word
    surface[:, 11], surface[:, 13], surface[:, 14] = distinct, lines / n_words, np.log1p(n_words) / 4
    if not grams:
        return surface
    pair = (x[:-1].astype(np.uint32) * np.uint32(31) + x[1:]) * np.uint32(2654435769) >> np.uint32(27)
    spread = np.bincount(of[:-1] * (BIGRAMS // 8) + pair, minlength=BIGRAMS * k).reshape(k, BIGRAMS) / size[:, None]
    return np.hstack([surface, np.sqrt(spread)]).astype(np.float32)
