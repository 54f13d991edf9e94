"""Hashed text features, computed for a batch of texts at once in numpy."""

from __future__ import annotations

import numpy as np

_U64 = np.uint64


def byte_grams(texts: list[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 1- to 4-grams of the lower-cased UTF-8 bytes of each text, and where each begins.

    Every text is taken whole, between blanks; digits and runs of signs say nothing about a
    language and count as blanks. Returns features of all texts in a row, and the first of each
    text (with the end at last).
    """
    raw = [b" " + t.lower().encode() + b" " for t in texts]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
    letters = (flat >= 0x80) | ((flat >= ord("a")) & (flat <= ord("z")))
    kept = letters | np.concatenate(([True], letters[:-1]))
    owner = np.repeat(np.arange(len(raw)), sizes)[kept]
    # Grams may run over the blank at the border of two texts; four blanks' worth of noise per
    # text is the same for all of them and keeps this free of loops.
    codes = np.where(letters, flat, np.uint8(32))[kept].astype(np.uint32)
    starts = np.searchsorted(owner, np.arange(len(raw) + 1))
    grams, window = [], codes.copy()
    for n in range(1, 5):
        if n > 1:
            shifted = np.zeros_like(codes)
            shifted[: len(codes) - n + 1] = codes[n - 1 :]
            window = window << np.uint32(8) | shifted
        mixed = (window + np.uint32(n)) * np.uint32(0x9E3779B1)
        grams.append((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits))
    return np.stack(grams, axis=1), starts
