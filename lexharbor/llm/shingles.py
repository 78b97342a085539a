"""Hashes of words and word shingles of whole batches.

Words are hashed with a keyed 64-bit function (SipHash), so no pattern in their letters makes two of
them collide: among n words two share a hash with probability below n * n / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: As _SPACE, with all ASCII characters that are neither letters nor digits.
BREAKS = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_JOIN = np.uint64(0xD6E8FEB86659FD93)
#: Words that are held at once; those of one text are held together all the same.
_PIECE = 1 << 17


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object), categorize=False) if words else np.zeros(0, np.uint64)


def batch_words(texts: list, breaks: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): a hash of each word, A-Z lower-cased; those of text i are hashes[bounds[i]:bounds[i + 1]].

    Words are runs without ``breaks`` (ASCII white space); what is no text has none.
    """
    table = bytes(32 if breaks[i] else i + 32 if 65 <= i <= 90 else i for i in range(256))
    bounds, held, done = np.zeros(len(texts) + 1, dtype=np.int64), [], []
    for i, t in enumerate(texts):
        own = t.encode("utf-8", "replace").translate(table).split() if isinstance(t, str) else []
        bounds[i + 1] = bounds[i] + len(own)
        held += own
        if len(held) >= _PIECE:
            done.append(hash_words(held))
            held = []
    return np.concatenate([*done, hash_words(held)]), bounds


def word_hashes(text, breaks: np.ndarray = _SPACE) -> np.ndarray:
    return batch_words([text], breaks)[0]


def _joined(w: np.ndarray, k: int) -> np.ndarray:
    h = np.full(max(len(w) - k + 1, 0), k, dtype=np.uint64)
    for i in range(k):
        h = h * _JOIN + w[i : len(w) - k + 1 + i]
    return mix(h).view(np.int64)


def shingle_sets(texts: list, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's shingles; a shorter text is one shingle, none without words."""
    w, bounds = batch_words(texts)
    every = _joined(w, words)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= words:
            own = np.sort(every[lo : hi - words + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:
            yield _joined(w[lo:hi], hi - lo) if hi > lo else np.zeros(0, np.int64)


def shingle_set(text, words: int) -> np.ndarray:
    return next(shingle_sets([text], words))
