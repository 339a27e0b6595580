"""Operator 7: quality classifier as a sparse rule ensemble.

Statistics of the whole text (shares and means of word, line and character counts)
come from one pass over the table.  On the driver, shallow boosted trees are grown on
at most ``max_docs`` labelled documents, every path from a root to a node becomes a
conjunctive rule, and an L1-penalised logistic regression over the rules keeps a few
of them.  The kept rules are compiled into a Spark column expression over the
statistics, so scoring needs no Python beyond the counting.

Nulls and edge cases: a null, empty or blank text has zero statistics and is scored as
such; null labels are skipped; with one class only the score is that class's share;
repeated rows score alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martcraft.llm.linestats import analyse
from martcraft.llm.sampling import labelled

CUT = 0.3
STATISTICS = ("n_words", "mean_word", "upper_share", "digit_share", "symbols_per_word", "marks_per_word",
              "bangs_per_word", "pipes_per_word", "letter_share", "distinct_share", "repeat_share", "echo_share",
              "dup_line_share", "words_per_line", "stop_line_share")


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of STATISTICS for each text."""
    out = [np.zeros((0, len(STATISTICS)))]
    for _, s in analyse(texts):
        t = s.total
        w, c = np.maximum(s.n_words, 1), np.maximum(t["chars"], 1)
        size = len(w)
        lines = np.maximum(np.bincount(s.line_of, minlength=size), 1)
        stops = np.bincount(s.line_of, s.lines.stops, size)
        out.append(np.stack([s.n_words, t["chars"] / w, t["upper"] / np.maximum(t["letters"], 1), t["digits"] / c,
                             t["symbols"] / w, t["marks"] / w, t["bangs"] / w, t["pipes"] / w, t["letters"] / c,
                             s.n_distinct / w, s.n_repeat_words / w, s.n_echo / w, s.n_dup_lines / lines,
                             s.n_words / lines, stops / lines], 1))
    return np.concatenate(out)


@dataclass(frozen=True)
class Rule:
    """Conjunction of (statistic, "<=" or ">", value) with its weight."""
    parts: tuple[tuple[str, str, float], ...]
    weight: float


@dataclass(frozen=True)
class Ensemble:
    """sigmoid(base + sum of weights of the rules that hold), rescaled so that ``cut`` becomes 0.3."""
    base: float
    rules: tuple[Rule, ...]
    cut: float

    def column(self) -> Column:
        """The score as a Spark expression over the columns of STATISTICS."""
        total = F.lit(self.base)
        for r in self.rules:
            cond = F.lit(True)
            for name, op, value in r.parts:
                cond = cond & (F.col(name) <= value if op == "<=" else F.col(name) > value)
            total = total + F.when(cond, F.lit(r.weight)).otherwise(F.lit(0.0))
        p = 1 / (1 + F.exp(-total))
        return F.when(p < self.cut, p * (CUT / self.cut)).otherwise(CUT + (1 - CUT) * (p - self.cut) / (1 - self.cut))


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, rows: np.ndarray, cols: np.ndarray, depth: int,
          path: tuple, found: list, least: int) -> np.ndarray:
    """Newton regression tree; appends every node's path; returns the step per row of ``rows``."""
    if path:
        found.append(path)
    gain, pick = 1e-6, None
    if depth and len(rows) >= 2 * least:
        whole = g[rows].sum() ** 2 / (h[rows].sum() + 1)
        for j in cols:
            v = x[rows, j]
            order = np.argsort(v, kind="stable")
            sv = v[order]
            cg, ch = np.cumsum(g[rows][order]), np.cumsum(h[rows][order])
            at = np.flatnonzero(sv[1:] > sv[:-1])
            at = at[(at + 1 >= least) & (len(rows) - at - 1 >= least)]
            if not len(at):
                continue
            score = cg[at] ** 2 / (ch[at] + 1) + (cg[-1] - cg[at]) ** 2 / (ch[-1] - ch[at] + 1) - whole
            k = int(np.argmax(score))
            if score[k] > gain:
                gain, pick = score[k], (j, (sv[at[k]] + sv[at[k] + 1]) / 2)
    step = np.zeros(len(x))
    if pick is None:
        step[rows] = g[rows].sum() / (h[rows].sum() + 1)
        return step
    j, value = pick
    low = x[rows, j] <= value
    name = STATISTICS[j]
    step += _tree(x, g, h, rows[low], cols, depth - 1, (*path, (name, "<=", float(value))), found, least)
    step += _tree(x, g, h, rows[~low], cols, depth - 1, (*path, (name, ">", float(value))), found, least)
    return step


def _holds(x: np.ndarray, path: tuple) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for name, op, value in path:
        v = x[:, STATISTICS.index(name)]
        ok &= v <= value if op == "<=" else v > value
    return ok


def fit(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, penalty: float = 0.002,
        steps: int = 600, seed: int = 3) -> Ensemble:
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return Ensemble(base, (), 0.5)
    rng = np.random.Generator(np.random.PCG64(seed))
    raw, paths = np.full(len(x), base), []
    least = max(2, len(x) // 200)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        rows = np.sort(rng.choice(len(x), max(2, len(x) // 2), replace=False))
        cols = rng.choice(x.shape[1], max(1, 2 * x.shape[1] // 3), replace=False)
        raw += 0.3 * _tree(x, y - p, p * (1 - p), rows, np.sort(cols), depth, (), paths, least)
    paths = list(dict.fromkeys(paths))
    cover = np.stack([_holds(x, p) for p in paths], 1).astype(np.float64)
    _, first = np.unique(cover, axis=1, return_index=True)
    first = np.sort(first)
    paths, cover = [paths[i] for i in first], cover[:, first]
    mean = cover.mean(0)
    spread = np.maximum(cover.std(0), 1e-6)
    z = (cover - mean) / spread
    w, b, v, t = np.zeros(z.shape[1]), base, np.zeros(z.shape[1]), 1.0
    vb, rate = base, 4.0 / (np.linalg.norm(z, 2) ** 2 / len(z) + 1)
    for _ in range(steps):                               # accelerated proximal gradient
        p = 1 / (1 + np.exp(-(z @ v + vb)))
        nw = v - rate * (z.T @ (p - y)) / len(y)
        nw = np.sign(nw) * np.maximum(np.abs(nw) - rate * penalty, 0)
        nb = vb - rate * float((p - y).mean())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    keep = np.flatnonzero(np.abs(w) > 1e-6)
    weights = w[keep] / spread[keep]
    start = float(b - (w[keep] * mean[keep] / spread[keep]).sum())
    p = 1 / (1 + np.exp(-(cover[:, keep] @ weights + start)))
    return Ensemble(start, tuple(Rule(paths[k], float(u)) for k, u in zip(keep, weights)), _cut(p, y))


def _cut(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold with the best mean of both classes' recall, in the middle of its gap."""
    order = np.argsort(p)
    good = np.append(0, np.cumsum(y[order]))
    score = (1 - good / y.sum()) + (np.arange(len(p) + 1) - good) / (len(y) - y.sum())
    ps = np.concatenate([[0], p[order], [1]])
    gap = ps[1:] - ps[:-1]
    score = np.where(gap > 1e-12, score, -1)
    best = np.flatnonzero(score >= score.max() - 1e-12)
    k = best[np.argmax(gap[best])]
    return float(np.clip((ps[k] + ps[k + 1]) / 2, 0.02, 0.98))


def train(docs: DataFrame, labels: DataFrame, learn: str = "true", label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", max_docs: int = 5000) -> Ensemble:
    got = labelled(docs, labels, label_col, learn, max_docs, id_col, text_col)
    return fit(statistics([r["text"] for r in got]), np.array([r["y"] > 0 for r in got], np.float64))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and STATISTICS of every text."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]
    if id_col in STATISTICS:
        raise ValueError(f"{id_col} is the name of a statistic")

    def run(batches):
        for b in batches:
            x = statistics(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(x[:, j]) for j in range(x.shape[1]))],
                                             [id_col, *STATISTICS])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"{id_col} {id_type}, " + ", ".join(f"{s} double" for s in STATISTICS))


def score(docs: DataFrame, model: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score."""
    return measured(docs, id_col, text_col).select(id_col, model.column().alias("score"))
