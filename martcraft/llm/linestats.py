"""Counts of whole texts and of their lines, vectorised over byte buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from martcraft.llm.kernel import PIECE, SPACE, U64, mix, powers, shingles, word_hashes

WINDOW = 8
_UPPER, _LETTER, _DIGIT, _SYMBOL, _MARK, _CONT, _BANG, _PIPE, _STOP = (1 << i for i in range(9))
_CLASS = np.zeros(256, np.uint16)
_CLASS[65:91] = _UPPER | _LETTER
_CLASS[97:123] = _LETTER
_CLASS[48:58] = _DIGIT
for _c in b"#*$%&|<>":
    _CLASS[_c] |= _SYMBOL
for _c in b".,;:!?\"'()-":
    _CLASS[_c] |= _MARK
_CLASS[ord("!")] |= _BANG
_CLASS[ord("|")] |= _PIPE
for _c in b".!?":
    _CLASS[_c] |= _STOP
_CLASS[0x80:0xC0] |= _CONT
_BYTE = np.random.Generator(np.random.PCG64(4)).integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
LINE_COUNTS = ("words", "chars", "upper", "letters", "digits", "symbols", "marks", "bangs", "pipes")


@dataclass
class Lines:
    """Lines with a word, in order: per-line counts, hash, and whether the line ends in . ! or ?"""
    count: dict[str, np.ndarray]
    key: np.ndarray
    stops: np.ndarray


def _lines(data: bytes, words_before: int = 0) -> tuple[np.ndarray, Lines]:
    """Start of each line with a word, and its counts."""
    buf = np.frombuffer(data, np.uint8)
    starts = np.append(0, np.flatnonzero(buf == 10) + 1)
    starts = starts[starts < len(buf)]
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, Lines({c: z for c in LINE_COUNTS}, np.zeros(0, U64), np.zeros(0, bool))
    kind = _CLASS[buf]
    word = ~SPACE[buf]
    first = word.copy()
    first[1:] &= ~word[:-1]
    add = lambda m: np.add.reduceat(m, starts, dtype=np.int64)
    has = lambda bit: add((kind & bit) != 0)
    count = {"words": add(first), "chars": add(word & ((kind & _CONT) == 0)), "upper": has(_UPPER),
             "letters": has(_LETTER), "digits": has(_DIGIT), "symbols": has(_SYMBOL), "marks": has(_MARK),
             "bangs": has(_BANG), "pipes": has(_PIPE)}
    gap = np.diff(np.append(starts, len(buf)))
    part = _BYTE[buf]
    part[buf == 10] = 0
    part *= powers(int(gap.max()) + 1)[np.arange(len(buf)) - np.repeat(starts, gap)]
    key = mix(np.add.reduceat(part, starts) + gap.astype(U64) * U64(0x632BE59BD9B4E019)
              - (buf[starts + gap - 1] == 10).astype(U64) * U64(0x632BE59BD9B4E019))
    at = np.arange(len(buf))
    at[~word] = -1
    last = np.maximum.reduceat(at, starts)
    stops = (kind[np.maximum(last, 0)] & _STOP) != 0
    some = count["words"] > 0
    return starts[some], Lines({c: v[some] for c, v in count.items()}, key[some], stops[some])


def _line_pieces(data: bytes) -> Iterator[bytes]:
    """Cut after line ends: every line lies whole in one piece."""
    at = 0
    while len(data) - at > PIECE:
        cut = data.rfind(b"\n", at, at + PIECE) + 1
        if cut <= at:
            cut = data.find(b"\n", at + PIECE) + 1
            if not cut:
                break
        yield data[at:cut]
        at = cut
    yield data[at:]


@dataclass
class Stats:
    """Per text: counts; ``line_of`` gives the text of each line with a word.  An echo is a word equal to
    the one before it."""
    n_words: np.ndarray
    n_distinct: np.ndarray
    n_repeat_words: np.ndarray
    n_dup_lines: np.ndarray
    total: dict[str, np.ndarray]
    line_of: np.ndarray
    lines: Lines
    line_dup: np.ndarray
    line_repeat: np.ndarray
    n_echo: np.ndarray
    line_echo: np.ndarray


def _repeats(words: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Mask of words inside WINDOW-word windows that occur twice or more in their text."""
    covered = np.zeros(len(words) + 1, np.int64)
    if len(words) >= WINDOW:
        win = shingles(words, WINDOW) if len(words) > WINDOW else np.zeros(1, U64)
        inside = np.flatnonzero(of[:len(win)] == of[WINDOW - 1:])
        key = mix(win[inside] ^ mix(of[inside].astype(U64) + U64(1)))
        order = np.argsort(key, kind="stable")
        k = key[order]
        same = np.zeros(len(k), bool)
        same[1:] = k[1:] == k[:-1]
        same[:-1] |= same[1:]
        hit = inside[order[same]]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + WINDOW, -1)
    return np.cumsum(covered[:-1]) > 0


def _join(parts: list[Lines]) -> Lines:
    return Lines({c: np.concatenate([p.count[c] for p in parts]) for c in LINE_COUNTS},
                 np.concatenate([p.key for p in parts]), np.concatenate([p.stops for p in parts]))


def analyse(texts: list[str | None]) -> Iterator[tuple[int, Stats]]:
    """(position of the first text, Stats) for consecutive runs of texts of bounded size."""
    at = 0
    while at < len(texts):
        group: list[bytes] = []
        n = 0
        while at + len(group) < len(texts):
            data = (texts[at + len(group)] or "").encode("utf-8", "surrogatepass")
            if group and n + len(data) > PIECE:
                break
            group.append(data)
            n += len(data) + 1
        yield at, _analyse(group)
        at += len(group)


def _analyse(group: list[bytes]) -> Stats:
    size = len(group)
    if size == 1:
        parts = [_lines(p)[1] for p in _line_pieces(group[0])]
        lines = _join(parts)
        line_of = np.zeros(len(lines.key), np.int64)
    else:
        ends = np.cumsum([len(b) + 1 for b in group])
        starts, lines = _lines(b"\n".join(group))
        line_of = np.searchsorted(ends, starts, "right")
    hashes = [h for _, h in word_hashes([b.decode("utf-8", "surrogatepass") for b in group])]
    n_words = np.array([len(h) for h in hashes], np.int64)
    words = np.concatenate(hashes)
    of = np.repeat(np.arange(size), n_words)
    repeat = _repeats(words, of)
    key = words ^ mix(of.astype(U64) + U64(7))
    order = np.argsort(key, kind="stable")
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    n_distinct = np.bincount(of[order[new]], minlength=size)
    key = lines.key ^ mix(line_of.astype(U64) + U64(3))
    order = np.argsort(key, kind="stable")
    k = key[order]
    dup = np.zeros(len(k), bool)
    dup[order[1:]] = k[1:] == k[:-1]
    echo = np.zeros(len(words), bool)
    echo[1:] = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
    ends = np.cumsum(lines.count["words"])

    def by_line(mask: np.ndarray) -> np.ndarray:
        run = np.append(0, np.cumsum(mask))
        return run[ends] - run[ends - lines.count["words"]]

    total = {c: np.bincount(line_of, v, size).astype(np.int64) for c, v in lines.count.items()}
    return Stats(n_words, n_distinct, np.bincount(of, repeat, size).astype(np.int64),
                 np.bincount(line_of, dup, size).astype(np.int64), total, line_of, lines, dup, by_line(repeat),
                 np.bincount(of, echo, size).astype(np.int64), by_line(echo))
