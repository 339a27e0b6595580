"""Operator 4: SentencePiece (BPE) encoding and decoding by suffix-array matching.

Per batch, the distinct chunks (a run of spaces with the word after it) that are
not known yet are joined into one text.  Its suffixes are sorted (to the longest
piece's length), every vocabulary piece is binary-searched for its range of
occurrences, and the occurrences become edges sorted by end position.  Relaxing
the edges in that order keeps for each position the last piece of the encoding of
the prefix: an edge is taken if its piece and the piece before it would not have
merged otherwise.  A sequence is the BPE result exactly if each neighbouring pair
is its own BPE result, so the outcome equals the greedy merge order's.

Holds for BPE models with the identity normaliser, a dummy prefix, no piece with
an inner space mark, and byte fallback (checked when the model is read, but for
the normaliser).  Characters outside the vocabulary become byte pieces.

Nulls and edge cases: a null text gives null ids, an empty one no ids; repeated
rows are encoded alike; other columns pass through unless they clash with the
output's name, which is an error.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
CACHED_CHUNKS = 250_000
_START = -1


class PieceModel:
    """Vocabulary of a model file, the suffix-array encoder and the decoder."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.bytes_of = [b""] * n
        self.byte_id = [0] * 256
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        for i, p in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(p[3:-1], 16)] = i
                self.bytes_of[i] = bytes([int(p[3:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.rank[p], self.id[p] = sp.get_score(i), i
                self.bytes_of[i] = p.replace(MARK, " ").encode()
        if any(MARK in p.lstrip(MARK) for p in self.id) or not any(self.byte_id):
            raise ValueError("needs a BPE model with byte fallback and no piece with an inner space mark")
        singles = sorted(p for p in self.id if len(p) == 1)
        if any(c not in self.id for p in self.id for c in p):
            raise ValueError("a piece has a character that is no piece itself")
        self.n = n
        self.codes = np.zeros(0x110000, np.uint16)
        self.codes[[ord(c) for c in singles]] = np.arange(1, len(singles) + 1)
        self.longest = max(map(len, self.id))
        self.keys = -(-self.longest // 4)
        self.pieces = sorted(self.id, key=lambda p: self.id[p])
        self.piece_id = np.array([self.id[p] for p in self.pieces], np.int64)
        self.piece_len = np.array([len(p) for p in self.pieces], np.int64)
        self.len_of = np.ones(n + 1, np.int64)
        self.len_of[self.piece_id] = self.piece_len
        self.low, self.high = self._bounds(0), self._bounds(0xFFFF)
        self.name = {i: p for p, i in self.id.items()}
        self.pair_key, self.pair_ok = np.full(1, -1, np.int64), np.zeros(1, bool)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        size = np.array([len(x) for x in self.bytes_of])
        self.byte_size, self.byte_at = size, np.cumsum(size) - size
        self.byte_pool = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def _bounds(self, fill: int) -> np.ndarray:
        m = np.full((len(self.pieces), 4 * self.keys), fill, ">u2")
        for i, p in enumerate(self.pieces):
            m[i, :len(p)] = self.codes[[ord(c) for c in p]]
        return m.view(f"S{8 * self.keys}").ravel()

    def stays(self, before: str, piece: str) -> bool:
        """Whether greedy merging (best score first, then leftmost) of the joined strings ends in
        these two; with an empty ``before``, whether it ends in ``piece``."""
        text = before + piece
        cut, parts = len(before), list(text)
        ends = list(range(1, len(text) + 1))
        rank = self.rank
        scores = [rank.get(x + y) for x, y in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(scores):
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if at < 0:
                return len(parts) == (2 if cut else 1)
            if ends[at] == cut:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            ends[at:at + 2] = [ends[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = rank.get(parts[at - 1] + parts[at])
            if at < len(scores):
                scores[at] = rank.get(parts[at] + parts[at + 1])

    def _fits(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether each (piece before or start, piece) stays as it is; n stands for an unknown character."""
        key = (before + 1) * (self.n + 1) + piece
        at = np.searchsorted(self.pair_key, key)
        at[at == len(self.pair_key)] = 0
        new = np.unique(key[self.pair_key[at] != key])
        if len(new):
            ok = np.empty(len(new), bool)
            name = self.name
            for i, k in enumerate(new.tolist()):
                b, p = divmod(k, self.n + 1)
                ok[i] = p == self.n or self.stays("" if b in (0, self.n + 1) else name[b - 1], name[p])
            if len(self.pair_key) > 4_000_000:
                keep = np.unique(np.append(at[self.pair_key[at] == key], 0))
                self.pair_key, self.pair_ok = self.pair_key[keep], self.pair_ok[keep]
            where = np.searchsorted(self.pair_key, new)
            self.pair_key = np.insert(self.pair_key, where, new)
            self.pair_ok = np.insert(self.pair_ok, where, ok)
            at = np.searchsorted(self.pair_key, key)
        return self.pair_ok[at]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """ids (little-endian uint32 bytes) of every chunk."""
        joined = "\0".join(chunks) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        size = len(points)
        code = np.zeros(size + 4 * self.keys, np.uint64)
        code[:size] = self.codes[points]
        start = np.cumsum([0] + [len(c) + 1 for c in chunks])
        end = start[1:] - 1
        start = start[:-1]
        chunk_start = np.repeat(start, end - start + 1)

        four = (code[:-3] << np.uint64(48)) | (code[1:-2] << np.uint64(32)) | (code[2:-1] << np.uint64(16)) | code[3:]
        live = np.flatnonzero(code[:size])
        keys = [four[live + 4 * j] for j in range(self.keys)]
        order = np.lexsort(keys[::-1])
        suffix = live[order]
        table = np.empty((len(suffix), self.keys), ">u8")
        for j, k in enumerate(keys):
            table[:, j] = k[order]
        table = table.view(f"S{8 * self.keys}").ravel()
        lo, hi = np.searchsorted(table, self.low, "left"), np.searchsorted(table, self.high, "right")
        del table, keys, four, order
        count = hi - lo
        which = np.repeat(np.arange(len(count)), count)
        at = suffix[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + lo[which]]
        odd = np.flatnonzero(code[:size] == 0)
        odd = odd[~np.isin(odd, end, assume_unique=True)]
        source = np.concatenate([at, odd])
        piece = np.concatenate([self.piece_id[which], np.full(len(odd), self.n)])
        target = source + self.len_of[piece]
        step = target - chunk_start[source]
        order = np.argsort(step, kind="stable")
        source, target, piece = source[order], target[order], piece[order]
        cuts = np.flatnonzero(np.diff(step[order])) + 1
        last = np.full(size + 1, _START, np.int64)
        for a, b in zip(np.append(0, cuts), np.append(cuts, len(piece))):
            if a < b:
                ok = self._fits(last[source[a:b]], piece[a:b])
                last[target[a:b][ok]] = piece[a:b][ok]

        cur, row = end.copy(), np.arange(len(chunks))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            more = cur > start[row]
            cur, row = cur[more], row[more]
            if not len(cur):
                break
            tok = last[cur]
            cur = cur - self.len_of[tok]
            found.append((row, cur, tok))
        if not found:
            return [b""] * len(chunks)
        row, pos, tok = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((pos, row))
        row, pos, tok = row[order], pos[order], tok[order]
        unknown = np.flatnonzero(tok == self.n)
        if len(unknown):
            raw = [chr(points[p]).encode("utf-8", "replace") for p in pos[unknown]]
            width = np.ones(len(tok), np.int64)
            width[unknown] = [len(r) for r in raw]
            first = np.cumsum(width) - width
            ids = np.repeat(tok, width)
            for i, r in zip(first[unknown], raw):
                ids[i:i + len(r)] = [self.byte_id[x] for x in r]
            per = np.bincount(row, width, len(chunks)).astype(np.int64)
        else:
            ids, per = tok, np.bincount(row, minlength=len(chunks))
        flat, cut = ids.astype("<u4").tobytes(), np.append(0, np.cumsum(per)) * 4
        return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    _chunk = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

    def encode(self, texts: list[str | None]) -> list[bytes | None]:
        rows = [self._chunk.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        wanted = set().union(*rows).difference(self.known)
        got = {w: b for w in wanted if (b := self.older.get(w)) is not None}
        new = [w for w in wanted if w not in got]
        at = 0
        while at < len(new):                       # about half a million characters at a time
            to, n = at, 0
            while to < len(new) and (n < 500_000 or to == at):
                n += len(new[to]) + 1
                to += 1
            got.update(zip(new[at:to], self.encode_chunks(new[at:to])))
            at = to
        long = {w: got.pop(w) for w in [w for w in got if len(w) > 64]}
        self.known.update(got)
        table = {**self.known, **long} if long else self.known
        out = [None if t is None else b"".join([table[w] for w in r]) for t, r in zip(texts, rows)]
        if len(self.known) > CACHED_CHUNKS:        # two generations: what is used again moves on
            self.older, self.known = self.known, {}
        return out

    def decode(self, ids: bytes) -> str:
        t = np.frombuffer(ids, "<u4")
        size = self.byte_size[t]
        ends = np.cumsum(size)
        take = np.arange(ends[-1] if len(t) else 0) + np.repeat(self.byte_at[t] - (ends - size), size)
        b = self.byte_pool[take].tobytes()
        return b[1:].decode("utf-8", "replace") if b[:1] == b" " else b.decode("utf-8", "replace")


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _rows_at_once(b: pa.RecordBatch, col: int, chars: int = 4_000_000):
    """Slices of about ``chars`` characters."""
    texts, at, n = b.column(col).to_pylist(), 0, 0
    for i, t in enumerate(texts):
        n += len(t or "")
        if n >= chars:
            yield b.slice(at, i + 1 - at), texts[at:i + 1]
            at, n = i + 1, 0
    if at < len(texts):
        yield b.slice(at), texts[at:]


def encode(docs: DataFrame, model_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """The input with ``out``: array<int>."""
    if out in docs.columns:
        raise ValueError(f"column {out} exists")
    schema = docs.select("*", F.lit(None).cast("array<int>").alias(out)).schema
    col = docs.columns.index(text_col)

    def run(batches):
        m = model(model_path)
        for b in batches:
            for part, texts in _rows_at_once(b, col):
                got = [None if x is None else np.frombuffer(x, "<i4") for x in m.encode(texts)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.list_(pa.int32()))],
                                                 [*part.schema.names, out])

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """The input with ``out``: text of the ids; malformed byte runs become U+FFFD."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    schema = df.select("*", F.lit(None).cast("string").alias(out)).schema
    col = df.columns.index(ids_col)

    def run(batches):
        m = model(model_path)
        for b in batches:
            got = [None if x is None else m.decode(np.array(x, "<u4").tobytes()) for x in b.column(col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(got, pa.string())], [*b.schema.names, out])

    return df.mapInArrow(run, schema)


def encode_digest(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_tokens, ids_crc32 (little-endian uint32 ids), round_trip (decoding gives the
    text back, space marks read as spaces); a null text has no tokens and round_trip null."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    schema = f"{id_col} {id_type}, n_tokens long, ids_crc32 long, round_trip boolean"

    def run(batches):
        m = model(model_path)
        for b in batches:
            for part, texts in _rows_at_once(b, 1):
                got = m.encode(texts)
                back = [None if t is None else m.decode(x) == t.replace(MARK, " ") for t, x in zip(texts, got)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(x or b"") // 4 for x in got], pa.int64()),
                     pa.array([zlib.crc32(x or b"") for x in got], pa.int64()), pa.array(back, pa.bool_())],
                    [id_col, "n_tokens", "ids_crc32", "round_trip"])

    return docs.select(id_col, text_col).mapInArrow(run, schema)
