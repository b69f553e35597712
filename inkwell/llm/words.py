"""Word hashes of UTF-8 texts, computed for many words at once.

A word is a run of bytes outside [\\x20\\x09-\\x0D], A-Z lower-cased. Its hash is a
polynomial of its bytes modulo 2^64, mixed with its length. Sums over prefixes give all words
of a chunk in a few array passes; a chunk ends at white space, so memory is
bounded by CHUNK (or by the longest word).
"""

from __future__ import annotations

import numpy as np

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SPACES = b" \t\n\x0b\x0c\r"
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64
_powers: list[np.ndarray] = []
_space = np.zeros(256, bool)
_space[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int):
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        up = np.full(size, BASE, np.uint64)
        up[0] = 1
        down = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
        down[0] = 1
        _powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _powers


def _hash_chunk(data: np.ndarray) -> np.ndarray:
    word = ~_space[data]
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    value = (sums[ends] - sums[starts]) * down[starts]
    return mix(value + np.uint64(0x632BE59BD9B4E019) * (ends - starts).astype(np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a lower-cased text (see LOWER), in order."""
    out, at = [], 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            while end < len(text) and text[end] not in SPACES:
                end += 1
        out.append(_hash_chunk(np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)))
        at = end
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def batch_word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of many lower-cased texts and the index of each text's first word (one more at the end)."""
    hashes, counts = [], []
    group: list[bytes] = []
    size = 0

    def flush():
        if group:
            data = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
            word = ~_space[data]
            begins = np.flatnonzero(word & ~np.concatenate([[False], word[:-1]]))
            bounds = np.cumsum([0] + [len(t) + 1 for t in group])
            counts.extend(np.diff(np.searchsorted(begins, bounds)).tolist())
            hashes.append(_hash_chunk(data))
            group.clear()

    for t in texts:
        if len(t) > CHUNK // 2:
            flush()
            size = 0
            one = word_hashes(t)
            hashes.append(one)
            counts.append(len(one))
            continue
        if size + len(t) + 1 > CHUNK:
            flush()
            size = 0
        group.append(t)
        size += len(t) + 1
    flush()
    firsts = np.concatenate([[0], np.cumsum(np.array(counts, np.int64))]).astype(np.int64)
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), firsts


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    last = len(words) - n + 1
    out = words[:last].copy()
    for k in range(1, n):
        out = mix(out * np.uint64(3)) + words[k:k + last]
    return mix(out)
