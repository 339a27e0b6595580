"""Operator 8: toxicity by a convolutional text classifier.

A word's embedding is the sum of three hashed ones: of the whole word and of its
first 4 and 6 bytes, so that inflected forms share a part.  A bucket has an embedding
if at least ``MIN_DOCS`` training documents use it, all others share the zero vector.  Filters of width 1, 2
and 3 slide over the word sequence, each keeps its maximum over the whole text, and
a logistic layer scores the maxima.  Trained with Adam in numpy on the driver from at
most ``max_docs`` labelled documents (lowest hashes of their ids, both classes).

Thresholds are calibrated by language.  The language is guessed from function words
of the text itself; for each, the threshold with the best F1 on a calibration part of
the training rows (shrunk to the common one where positives are few) is mapped to 0.3
by a monotone rescaling of the probability.

A trained filter over an embedding is a table of one value per bucket, so scoring is
a lookup and add per word and filter, one pass, no shuffle.

Nulls and edge cases: a null, empty or blank text has the score of an empty maximum
(zeros); null labels are skipped; with one class only, the score is a constant below
0.3; repeated rows score alike; an empty table gives no rows; other columns pass
through ``keep``.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martcraft.llm.kernel import U64, word_hashes
from martcraft.llm.sampling import labelled

BUCKETS = 1 << 21
WIDTHS = (1, 2, 3)
FILTERS = 6
DIM = 12
HEADS = (4, 6)
CUT = 0.3
LANGUAGES = {
    "en": ("the", "of", "and", "to", "is", "that", "was", "with"),
    "de": ("der", "die", "und", "den", "das", "ist", "mit", "nicht"),
    "fr": ("le", "les", "des", "et", "est", "une", "dans", "pour"),
    "es": ("el", "los", "que", "y", "las", "una", "por", "con"),
}


def split_words(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """Buckets of each word (whole, and its heads), letters A-Z lower-cased."""
    for k, h in word_hashes(texts, lower=True, heads=HEADS):
        yield k, (h & U64(BUCKETS - 1)).astype(np.int32)


def _function_buckets() -> list[np.ndarray]:
    return [np.array(sorted({int(x) for _, b in split_words([w + e for w in ws for e in ("", ".", ",")]) for x in b[:, 0]}))
            for ws in LANGUAGES.values()]


def _maxima(flat: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray | None]]:
    """(width, values per place and filter) for each width; None for a text that is too short."""
    v = flat[ids[:, 0]]
    for b in range(1, ids.shape[1]):
        v += flat[ids[:, b]]
    at = 0
    for w in WIDTHS:
        n = len(v) - w + 1
        if n < 1:
            yield w, None
        else:
            total = v[:n, at:at + FILTERS]
            for j in range(1, w):
                total = total + v[j:n + j, at + j * FILTERS:at + (j + 1) * FILTERS]
            yield w, total
        at += w * FILTERS


@dataclass
class Model:
    """keys: known buckets, sorted; tables[w][j]: value per known bucket (row 0: unknown) and filter."""
    keys: np.ndarray
    tables: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    cuts: np.ndarray

    def __post_init__(self):
        self.place = np.zeros(BUCKETS, np.int32)                  # 1 + place among the keys; 0: unknown
        self.place[self.keys] = np.arange(1, len(self.keys) + 1)
        self.flat = np.ascontiguousarray(np.concatenate([t[j] for t in self.tables for j in range(len(t))], 1))
        self.tongue = np.zeros(BUCKETS, np.int8)                  # 1 + language of a function word
        for i, f in enumerate(_function_buckets()):
            self.tongue[f] = i + 1

    def __reduce__(self):
        return Model, (self.keys, self.tables, self.bias, self.out, self.out_bias, self.cuts)

    def pooled(self, places: np.ndarray) -> np.ndarray:
        """Maxima of all filters over the text's places among the known buckets, after bias and rectifier."""
        got = [np.zeros(FILTERS, np.float32) if v is None else v.max(0) for _, v in _maxima(self.flat, places)]
        return np.maximum(np.concatenate(got) + self.bias, 0)

    def language(self, buckets: np.ndarray) -> int:
        """The language with the most function words; 0 if none has any."""
        return int(np.argmax(np.bincount(self.tongue[buckets[:, 0]], minlength=len(LANGUAGES) + 1)[1:]))

    def probability(self, buckets: np.ndarray) -> float:
        return self.probability_at(self.place[buckets])

    def probability_at(self, places: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.pooled(places) @ self.out + self.out_bias, -30, 30))))


def index(keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """1 + place among the keys; 0 for unknown."""
    if not len(keys):
        return np.zeros(buckets.shape, np.int32)
    at = np.searchsorted(keys, buckets)
    at[at == len(keys)] = 0
    return np.where(keys[at] == buckets, at + 1, 0).astype(np.int32)


def _rescale(p: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return np.where(p < cut, CUT * p / cut, CUT + (1 - CUT) * (p - cut) / (1 - cut))


def _best_cut(p: np.ndarray, y: np.ndarray) -> float:
    """Threshold with the best F1, in the middle of the widest best gap."""
    if not y.any() or y.all():
        return 0.5
    order = np.argsort(-p)
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(p) + 1) + y.sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    ps = np.append(p[order], 0.0)
    k = best[np.argmax(ps[best] - ps[best + 1])]
    return float(np.clip((ps[k] + ps[k + 1]) / 2, 0.02, 0.98))


def fit(rows: list[np.ndarray], y: np.ndarray, epochs: int = 5, rate: float = 0.01, seed: int = 7) -> Model:
    """``rows``: bucket sequences of the training documents; each is replaced by its places among the known buckets, so
    that the sample is held once."""
    rng = np.random.Generator(np.random.PCG64(seed))
    used = np.zeros(BUCKETS, np.int32)
    for r in rows:
        used[np.unique(r)] += 1
    keys = np.flatnonzero(used >= max(2, round(len(rows) ** 0.5 / 7))).astype(np.int32)
    blank = Model(keys, [np.zeros((w, len(keys) + 1, FILTERS), np.float32) for w in WIDTHS],
                 np.zeros(FILTERS * len(WIDTHS), np.float32), np.zeros(FILTERS * len(WIDTHS), np.float32), -4.0,
                 np.full(len(LANGUAGES), 0.5))
    if len(np.unique(y)) < 2 or not len(keys):
        return blank
    lang = np.array([blank.language(r) for r in rows])
    for k, r in enumerate(rows):
        rows[k] = index(keys, r)
    ids = rows
    calibrate = np.arange(len(rows)) % 4 == 0
    learn = np.flatnonzero(~calibrate) if y[~calibrate].any() and y[calibrate].any() else np.arange(len(rows))
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    emb = rng.normal(0, 0.03, (len(keys) + 1, DIM)).astype(np.float32)
    emb[0] = 0
    filt = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
    out = rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32)
    out_bias = np.zeros(1, np.float32)
    dense = [*filt, bias, out, out_bias]
    m1, m2 = [np.zeros_like(x) for x in dense], [np.zeros_like(x) for x in dense]
    e1, e2 = np.zeros_like(emb), np.zeros_like(emb)
    step = 0
    for _ in range(epochs):
        rng.shuffle(learn)
        flat = None
        for at in range(0, len(learn), 32):
            batch = learn[at:at + 32]
            grads = [np.zeros_like(x) for x in dense]
            touched, rows_grad = [], []
            if step % 8 == 0 or flat is None:      # where the maxima lie; their values are always current
                flat = emb @ np.concatenate([f[j] for f in filt for j in range(len(f))], 1)
            for k in batch:
                seq = ids[k]
                pool, where = [], []
                for wi, (w, v) in enumerate(_maxima(flat, seq)):
                    if v is None:
                        pool.append(np.zeros(FILTERS, np.float32))
                        where.append(None)
                        continue
                    top = v.argmax(0)
                    where.append(top)
                    pool.append(sum((emb[seq[top + j]].sum(1) * filt[wi][j].T).sum(1) for j in range(w)))
                pre = np.concatenate(pool) + bias.ravel()
                act = np.maximum(pre, 0)
                p = 1 / (1 + np.exp(-np.clip(act @ out + out_bias[0], -30, 30)))
                d = np.float32(weight[k] * (p - y[k]))
                grads[-2] += d * act
                grads[-1] += d
                dpre = (d * out * (pre > 0)).reshape(len(WIDTHS), FILTERS)
                grads[-3] += dpre
                for wi, w in enumerate(WIDTHS):
                    if where[wi] is None:
                        continue
                    for j in range(w):
                        r = seq[where[wi] + j]
                        grads[wi][j] += emb[r].sum(1).T * dpre[wi]
                        touched.append(r.ravel())
                        rows_grad.append(np.repeat(filt[wi][j].T * dpre[wi][:, None], r.shape[1], 0))
            step += 1
            fix1, fix2 = 1 - 0.9 ** step, 1 - 0.999 ** step
            for x, g, a, b in zip(dense, grads, m1, m2):
                g = g / len(batch) + 1e-4 * x
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                x -= rate * (a / fix1) / (np.sqrt(b / fix2) + 1e-8)
            if touched:
                t, inv = np.unique(np.concatenate(touched), return_inverse=True)
                g = np.zeros((len(t), DIM), np.float32)
                np.add.at(g, inv, np.concatenate(rows_grad) / len(batch))
                e1[t] += 0.1 * (g - e1[t])
                e2[t] += 0.01 * (g * g - e2[t])
                emb[t] -= rate * e1[t] / (np.sqrt(e2[t]) + 1e-6) * 0.3
                emb[0] = 0
    model = Model(keys, [np.stack([emb @ f[j] for j in range(f.shape[0])]) for f in filt], bias.ravel(), out,
                  float(out_bias[0]), np.full(len(LANGUAGES), 0.5))
    held = np.flatnonzero(calibrate) if len(learn) < len(rows) else np.arange(len(rows))
    p = np.array([model.probability_at(ids[k]) for k in held])
    lang = lang[held]
    truth = y[held] == 1
    n = int(truth.sum())                                 # few positives: a cautious threshold
    common = (n * _best_cut(p, truth) + 10 * 0.9) / (n + 10)
    for i in range(len(LANGUAGES)):
        own = lang == i
        n = int(truth[own].sum())
        cut = _best_cut(p[own], truth[own]) if n else common
        model.cuts[i] = (n * cut + 10 * common) / (n + 10)
    return model


def scores(model: Model, texts: list[str | None]) -> np.ndarray:
    p, cut = np.zeros(len(texts)), np.full(len(texts), 0.5)
    for k, buckets in split_words(texts):
        p[k], cut[k] = model.probability(buckets), model.cuts[model.language(buckets)]
    return _rescale(p, cut)


def train(docs: DataFrame, labels: DataFrame, learn: str = "true", label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", max_docs: int = 8000) -> Model:
    got = labelled(docs, labels, label_col, learn, max_docs, id_col, text_col)
    y, texts = np.array([r["y"] for r in got], np.int64), [r["text"] for r in got]
    del got
    rows: list = [None] * len(texts)
    for k, b in split_words(texts):
        rows[k] = b
    del texts
    gc.collect()
    return fit(rows, y)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, score."""
    id_type = dict(docs.select(id_col).dtypes)[id_col]

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores(model, b.column(1).to_pylist()))],
                                             [id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {id_type}, score double")


def keep(docs: DataFrame, model: Model, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score below ``cut``, unchanged."""
    col = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(scores(model, b.column(col).to_pylist()) < cut))

    return docs.mapInArrow(run, docs.schema)
