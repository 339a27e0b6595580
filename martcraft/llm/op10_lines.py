"""Operator 10: quality rules with line sequence labelling.

Base rules count words, symbols, repeated lines and repeated word windows over the
whole text.  A linear-chain conditional random field over the lines with a word
(binary features from per-line counts) is fitted by gradient ascent on the exact
log-likelihood; Viterbi decoding marks each line as content or boilerplate, and a
text is retained if at least ``share`` of its words lie in content lines.

The field is fitted on the driver from at most ``max_docs`` labelled documents (the
lowest hashes of their ids); a line's label is its document's.  Everything else runs
in the tasks, one pass, no shuffle.

Nulls and edge cases: a null or blank text has no words, fails the base rules and is
not kept; null labels are skipped; with fewer than two label classes every line is
content; repeated rows are judged alike; an empty table gives no rows; other columns
pass through ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martcraft.llm.linestats import Stats, analyse
from martcraft.llm.sampling import labelled

BAD, GOOD = 0, 1
MIN_WORDS, MAX_REPEAT = 20, 30
N_FEATURES = 23


def line_features(s: Stats) -> np.ndarray:
    """0/1 features of every line."""
    c = s.lines.count
    words, chars = np.maximum(c["words"], 1), np.maximum(c["chars"], 1)
    letters = np.maximum(c["letters"], 1)
    sym, up = c["symbols"] / words, c["upper"] / letters
    mean = chars / words
    first = np.ones(len(words), bool)
    first[1:] = s.line_of[1:] != s.line_of[:-1]
    last = np.append(first[1:], True)[:len(first)]
    cols = [np.ones(len(words), bool), words <= 1, (words > 1) & (words <= 3), (words > 3) & (words <= 7),
            (words > 7) & (words <= 15), words > 15, sym >= 0.5, (sym >= 0.1) & (sym < 0.5), (sym > 0) & (sym < 0.1),
            up >= 0.6, (up >= 0.25) & (up < 0.6), c["digits"] / chars >= 0.3, c["marks"] / words >= 0.6,
            c["bangs"] / words >= 0.3, c["pipes"] / words >= 0.2, mean < 3, mean > 9, s.line_dup,
            s.line_repeat / words >= 0.5, s.line_echo / words >= 0.3, s.lines.stops, first, last]
    return np.stack(cols, 1).astype(np.float32)


@dataclass
class Field:
    """emit: features x 2; move[i, j]: score of label j after label i."""
    emit: np.ndarray
    move: np.ndarray


def _grid(of: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Lines per text, and place of each line in its text."""
    n = np.bincount(of, minlength=size)
    return n, np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)


def fit(features: np.ndarray, of: np.ndarray, label: np.ndarray, steps: int = 150, rate: float = 0.3,
        penalty: float = 1e-3) -> Field:
    """Maximum likelihood by Adam with full forward-backward; ``label`` is per line."""
    size = int(of.max()) + 1 if len(of) else 0
    n, place = _grid(of, size)
    if len(np.unique(label)) < 2:
        return Field(np.zeros((features.shape[1], 2), np.float32), np.zeros((2, 2)))
    span = int(n.max())
    w = np.zeros((features.shape[1] + 2, 2))                # the last two rows are the moves
    m1, m2 = np.zeros_like(w), np.zeros_like(w)
    live = np.zeros((size, span), bool)
    live[of, place] = True
    truth = np.zeros((size, span), np.int64)
    truth[of, place] = label
    gold = np.zeros((2, 2))
    for i in (0, 1):
        for j in (0, 1):
            gold[i, j] = ((truth[:, :-1] == i) & (truth[:, 1:] == j) & live[:, 1:]).sum()
    want = np.stack([features.T @ (label == k) for k in (0, 1)], 1)
    for step in range(1, steps + 1):
        move = w[-2:]
        score = np.zeros((size, span, 2))
        score[of, place] = features @ w[:-2]
        a, b = np.zeros((size, span, 2)), np.zeros((size, span, 2))
        a[:, 0] = score[:, 0]
        for t in range(1, span):
            nxt = np.logaddexp(a[:, t - 1, :1] + move[0], a[:, t - 1, 1:] + move[1]) + score[:, t]
            a[:, t] = np.where(live[:, t, None], nxt, a[:, t - 1])
        for t in range(span - 2, -1, -1):
            nxt = score[:, t + 1] + b[:, t + 1]
            back = np.logaddexp(move[:, 0] + nxt[:, :1], move[:, 1] + nxt[:, 1:])
            b[:, t] = np.where(live[:, t + 1, None], back, 0)
        z = np.logaddexp(a[:, -1, 0], a[:, -1, 1])
        p = np.exp(a + b - z[:, None, None])[of, place]
        grad = np.zeros_like(w)
        grad[:-2] = want - features.T @ p
        for i in (0, 1):
            for j in (0, 1):
                q = a[:, :-1, i] + move[i, j] + score[:, 1:, j] + b[:, 1:, j] - z[:, None]
                grad[-2 + i, j] = gold[i, j] - np.exp(np.where(live[:, 1:], q, -np.inf)).sum()
        grad = grad / len(of) - penalty * w
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad ** 2
        w += rate * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-8)
    return Field(w[:-2].astype(np.float32), w[-2:])


def viterbi(field: Field, features: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """Best label of every line; texts advance together, one line at a time."""
    n, place = _grid(of, size)
    begin = np.cumsum(n) - n
    score = features @ field.emit
    best = np.array(score, np.float64)
    back = np.zeros((len(of), 2), np.int8)
    order = np.argsort(-n, kind="stable")
    for t in range(1, int(n.max()) if len(n) else 0):
        at = begin[order[:np.searchsorted(-n[order], -t)]] + t
        prev = best[at - 1]
        for j in (0, 1):
            from0, from1 = prev[:, 0] + field.move[0, j], prev[:, 1] + field.move[1, j]
            back[at, j] = from1 >= from0
            best[at, j] = np.maximum(from0, from1) + score[at, j]
    label = np.zeros(len(of), np.int8)
    ends = (begin + n - 1)[n > 0]
    label[ends] = best[ends, 1] >= best[ends, 0]
    for t in range(int(n.max()) - 1 if len(n) else 0, 0, -1):
        at = begin[order[:np.searchsorted(-n[order], -t)]] + t
        label[at - 1] = back[at, label[at]]
    return label


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_docs: int = 2000, max_lines: int = 60) -> Field:
    """Fit on at most ``max_docs`` labelled documents; long ones in runs of ``max_lines`` lines."""
    got = labelled(docs, labels, label_col, "true", max_docs, id_col, text_col)
    feats, of, ys, serial = [np.zeros((0, N_FEATURES), np.float32)], [], [], 0
    for at, s in analyse([r["text"] for r in got]):
        feats.append(line_features(s))
        _, place = _grid(s.line_of, len(s.n_words))
        run = s.line_of * 100_000 + place // max_lines
        _, run = np.unique(run, return_inverse=True)
        of.append(run + serial)
        serial += int(run.max()) + 1 if len(run) else 0
        ys.append(np.array([got[at + i]["y"] for i in range(len(s.n_words))], np.int64)[s.line_of])
    x = np.concatenate(feats)
    if not len(x):
        return Field(np.zeros((N_FEATURES, 2), np.float32), np.zeros((2, 2)))
    return fit(x, np.concatenate(of), (np.concatenate(ys) > 0).astype(np.int64))


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, content_share double")


def _verdicts(field: Field, texts: list[str | None], share: float) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in range(8)]
    for _, s in analyse(texts):
        size = len(s.n_words)
        label = viterbi(field, line_features(s), s.line_of, size)
        words = s.lines.count["words"]
        content = np.bincount(s.line_of, words * label, size) / np.maximum(s.n_words, 1)
        failed = (s.n_words < MIN_WORDS) | (100 * s.n_repeat_words > MAX_REPEAT * s.n_words)
        for c, v in zip(out, (s.n_words, s.total["chars"], s.total["symbols"], s.n_dup_lines, s.n_repeat_words,
                              failed, ~failed & (content >= share), content)):
            c.append(v)
    return [np.concatenate(c) for c in out]


def judge(docs: DataFrame, field: Field, share: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: id, the base counts, base_failed, kept, content_share."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    names = [id_col, *(c.split()[0] for c in SCHEMA.split(", "))]

    def run(batches):
        for b in batches:
            if b.num_rows:
                got = _verdicts(field, b.column(1).to_pylist(), share)
                yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, got)], names)

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {id_type}, {SCHEMA}")


def keep(docs: DataFrame, field: Field, share: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are retained, unchanged."""
    col = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(_verdicts(field, b.column(col).to_pylist(), share)[6]))

    return docs.mapInArrow(run, docs.schema)
