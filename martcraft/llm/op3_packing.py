"""Operator 3: sum-of-squares online packing of tokenised documents.

Every task tokenises and packs its own input partition, so there is no shuffle and
a lost executor only repeats its partition.  A document becomes full windows of
``size`` tokens plus a tail; the tail goes to the fill level that minimises the sum
of squared counts of partially filled windows (levels 1..size-1, ties to the
fullest window).  When ``max_open`` windows are open, and at the end of the task,
the open windows are poured together by cutting pieces, and what is left becomes
windows of power-of-two length, which need no padding.

Nulls and edge cases: a null or empty text is the end id alone; a null id is kept;
repeated rows are packed one by one; an empty table gives no rows; other columns
of the input are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

CACHED_WORDS = 250_000
_ODD_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")


_PLAIN = re.compile("([!-&(-/:-@[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]*)")


class WordEncoder:
    """Token ids (little-endian uint32 bytes) of texts, word by word.

    The tokenizer never joins characters across white space, so the ids of a text
    are those of its words in order.  A plain word (punctuation, Latin letters,
    punctuation) is split further as the tokenizer splits it, and its lower-cased
    letters are encoded many at a time: their ids end where a word-end token does.
    All other words go to the tokenizer as they are.  Words are kept in two
    generations of bounded size.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        vocab = self.tok.get_vocab()
        self.word_end = np.zeros(max(vocab.values()) + 1, bool)
        self.word_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {"": b""}

    def words(self, text: str) -> list[str]:
        if any(c in text for c in _ODD_SPACE):   # white space to Python only
            return re.findall(r"[^ \t\n\r\x0b\x0c]+", text)
        return text.split()

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(words, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(words), 500):
            part = words[at:at + 500]
            ids = np.array(self.tok.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cut = [0, *(4 * (np.flatnonzero(self.word_end[ids]) + 1)).tolist()]
            flat = ids.tobytes()
            out += [flat[a:b] for a, b in zip(cut, cut[1:])] if len(cut) == len(part) + 1 else self._each(part)
        return out

    def learn(self, words: list[str]) -> dict[str, bytes]:
        plain, other = {}, []
        for w in words:
            m = _PLAIN.fullmatch(w)
            if m:
                plain[w] = m.groups()
            else:
                other.append(w)
        letters = list({g[1].lower() for g in plain.values()})
        body = dict(zip(letters, self._letters(letters)))
        if len(self.marks) > 10_000:
            self.marks = {"": b""}
        marks = list({x for g in plain.values() for x in (g[0], g[2])}.difference(self.marks))
        self.marks.update(zip(marks, self._each(marks)))
        out = {w: self.marks[a] + body[x.lower()] + self.marks[b] for w, (a, x, b) in plain.items()}
        out.update(zip(other, self._each(other)))
        return out

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        rows = [self.words(t) if t else [] for t in texts]
        wanted = set().union(*rows).difference(self.known)
        got = {w: b for w in wanted if (b := self.older.get(w)) is not None}
        got.update(self.learn([w for w in wanted if w not in got]))
        long = {w: got.pop(w) for w in [w for w in got if len(w) > 64]}
        self.known.update(got)
        table = {**self.known, **long} if long else self.known
        for ws in rows:
            yield b"".join([table[w] for w in ws])
        if len(self.known) > CACHED_WORDS:        # two generations: what is used again moves on
            self.older, self.known = self.known, {}


class SumOfSquares:
    """Online packer over fill levels; pieces are (document, start, ids bytes)."""

    def __init__(self, size: int, max_open: int):
        self.size, self.max_open = size, max_open
        self.n_open = 0
        self.grow = np.ones(size + 1, np.int64)      # cost of one window more at a level: 2 n + 1
        self.grow[size] = 0                          # a full window is not counted
        self.leave = np.full(size + 1, -(1 << 40), np.int64)   # gain of one fewer: 2 n - 1, if there is one
        self.leave[0] = 0                            # level 0: a new window
        self.bins: list[list[list]] = [[] for _ in range(size + 1)]

    def _count(self, level: int, by: int) -> None:
        if 0 < level < self.size:
            n = len(self.bins[level])
            self.grow[level] = 2 * n + 1
            self.leave[level] = 2 * n - 1 if n else -(1 << 40)
            self.n_open += by

    def add(self, doc, start: int, ids: bytes) -> list | None:
        """Place a piece; the window if it is now full."""
        n = len(ids) // 4
        cost = self.grow[n:] - self.leave[:self.size + 1 - n]
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))
        window = self.bins[level].pop() if level else []
        self._count(level, -1)
        window.append((doc, start, ids))
        if level + n == self.size:
            return window
        self.bins[level + n].append(window)
        self._count(level + n, 1)
        return None

    def drain(self) -> Iterator[list]:
        """Pour all open windows into full ones; the rest at powers of two."""
        left = [w for level in range(self.size - 1, 0, -1) for w in self.bins[level]]
        for level in range(1, self.size):
            self.bins[level] = []
        self.grow[1:self.size] = 1
        self.leave[1:self.size] = -(1 << 40)
        self.n_open = 0
        lo, hi = 0, len(left) - 1
        while lo < hi:
            gap = self.size - sum(len(p[2]) for p in left[lo]) // 4
            if not gap:
                yield left[lo]
                lo += 1
            elif not left[hi]:
                hi -= 1
            else:
                doc, start, ids = left[hi].pop()
                left[lo].append((doc, start, ids[:4 * gap]))
                if len(ids) > 4 * gap:
                    left[hi].append((doc, start + gap, ids[4 * gap:]))
        rest = left[lo] if lo < len(left) else []
        total = sum(len(p[2]) for p in rest) // 4
        while total:
            want = 1 << (total.bit_length() - 1)
            total -= want
            window = []
            while want:
                doc, start, ids = rest.pop(0)
                window.append((doc, start, ids[:4 * want]))
                if len(ids) > 4 * want:
                    rest.insert(0, (doc, start + want, ids[4 * want:]))
                want -= len(window[-1][2]) // 4
            yield window


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, size: int = 4096, max_open: int = 2048,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    (and ``ids`` if asked for).  ``sequence_id`` is unique, not consecutive."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    schema = (f"{id_col} {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
              "sequence_id long, offset long" + (", ids array<int>" if with_ids else ""))

    def run(batches):
        enc = encoder(tokenizer)
        packer = SumOfSquares(size, max_open)
        end = np.array([end_id], "<u4").tobytes()
        serial = TaskContext.get().partitionId() << 36
        rows: list[tuple] = []
        id_arrow = None

        def put(window: list) -> None:
            nonlocal serial
            at = 0
            for (doc, total), start, ids in window:
                n = len(ids) // 4
                rows.append((doc, start, n, zlib.crc32(ids), total, serial, at, ids))
                at += n
            serial += 1

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows))
            arrays = [pa.array(cols[0], id_arrow), *(pa.array(c, pa.int64()) for c in cols[1:7])]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(b, "<i4") for b in cols[7]], pa.list_(pa.int32())))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        names += ["ids"] if with_ids else []
        for b in batches:
            id_arrow = b.schema.field(0).type
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                for key, ids in zip(part.column(0).to_pylist(), enc.encode(part.column(1).to_pylist())):
                    ids += end
                    doc = (key, len(ids) // 4)
                    whole = len(ids) // (4 * size)
                    for k in range(whole):
                        put([(doc, k * size, ids[4 * size * k:4 * size * (k + 1)])])
                    if len(ids) > 4 * size * whole:
                        if window := packer.add(doc, whole * size, ids[4 * size * whole:]):
                            put(window)
                        if packer.n_open >= max_open:
                            for window in packer.drain():
                                put(window)
                if len(rows) >= 2000:
                    yield out()
        for window in packer.drain():
            put(window)
        if rows:
            yield out()

    return docs.select(id_col, text_col).mapInArrow(run, schema)
