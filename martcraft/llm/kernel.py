"""Vectorised text kernels that run inside Spark tasks (numpy over byte buffers).

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``; UTF-8 continuation
bytes never collide with those, so byte runs and code-point runs agree.  Buffers
are cut at white space into pieces of about ``PIECE`` bytes: memory stays bounded
for a text of any length, and no text is shortened.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

PIECE = 1 << 21
U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_WS = b" \t\n\x0b\x0c\r"

_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_BYTE[SPACE] = 0
_RADIX = U64(0x9E3779B97F4A7C15)
_POW = np.ones(1, U64)


def powers(n: int, radix: np.uint64 = _RADIX) -> np.ndarray:
    """radix ** 0..n-1 modulo 2**64 (kept between calls)."""
    global _POW
    if len(_POW) < n:
        steps = np.full(max(n, 4096), radix, U64)
        steps[0] = 1
        _POW = np.multiply.accumulate(steps)
    return _POW[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (bijective)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Cut at white space: every word lies whole in one piece."""
    at = 0
    while len(data) - at > size:
        cut = max(data.rfind(c, at, at + size) for c in (b" ", b"\n"))
        if cut <= at:
            found = [p for c in _WS if (p := data.find(bytes([c]), at + size)) >= 0]
            if not found:
                break
            cut = min(found)
        yield data[at:cut]
        at = cut
    yield data[at:] if at else data


def _hash_buffer(data: bytes, offsets: np.ndarray, heads: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the buffer; first word index of each offset.

    With ``heads``, a column more for each: the hash of the word's first so many bytes."""
    none = np.zeros((0, 1 + len(heads)), U64) if heads else np.zeros(0, U64)
    buf = np.frombuffer(data, np.uint8)
    if not len(buf):
        return none, np.zeros(len(offsets), np.int64)
    word = ~SPACE[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return none, np.zeros(len(offsets), np.int64)
    gap = np.diff(np.append(starts, len(buf)))
    place = np.arange(starts[0], len(buf)) - np.repeat(starts, gap)
    part = _BYTE[buf[starts[0]:]]
    part *= powers(int(gap.max()) + 1)[place]
    sums = np.add.reduceat(part, starts - starts[0])
    if heads:
        run = np.append(U64(0), np.cumsum(part))
        at = starts - starts[0]
        cols = [mix(run[at + np.minimum(gap, m)] - run[at] + U64(m)) for m in heads]
        return np.stack([mix(sums), *cols], 1), np.searchsorted(starts, offsets)
    return mix(sums), np.searchsorted(starts, offsets)


def word_hashes(texts: Iterable[str | None], lower: bool = False,
                heads: tuple[int, ...] = ()) -> Iterator[tuple[int, np.ndarray]]:
    """(position in texts, word hashes in order) of every text, in order.

    ``lower`` lower-cases A-Z only.  Small texts share one buffer; a text over
    PIECE bytes is hashed piece by piece.  With ``heads`` the rows have more columns
    (see _hash_buffer).
    """
    held: list[bytes] = []
    where: list[int] = []
    n = 0

    def flush() -> Iterator[tuple[int, np.ndarray]]:
        sizes = np.cumsum([0] + [len(b) + 1 for b in held])
        h, at = _hash_buffer(b"\n".join(held), sizes[:-1], heads)
        at = np.append(at, len(h))
        for i, k in enumerate(where):
            yield k, h[at[i]:at[i + 1]]

    for k, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        if lower:
            data = data.lower()
        if n + len(data) > PIECE and held:
            yield from flush()
            held, where, n = [], [], 0
        if len(data) > PIECE:
            yield k, np.concatenate([_hash_buffer(p, np.zeros(1, np.int64), heads)[0] for p in pieces(data)])
        else:
            held.append(data)
            where.append(k)
            n += len(data) + 1
    if held:
        yield from flush()


_STEP = U64(0xD6E8FEB86659FD93)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size``-word windows; a shorter text is one window; no word, none."""
    if len(words) <= size:
        if not len(words):
            return words
        acc = U64(len(words))
        with np.errstate(over="ignore"):
            for h in words:
                acc = acc * _STEP + h
        return mix(np.array([acc], U64))
    acc = np.full(len(words) - size + 1, U64(size))
    for j in range(size):
        acc = acc * _STEP + words[j:len(words) - size + 1 + j]
    return mix(acc)
