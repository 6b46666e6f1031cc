"""Quality classifier: a generalised additive model with pairwise terms.

Every feature, and a few pairs of features, has a lookup table over bins; a
document's logit is the sum of its table entries.  The tables are learnt by
cyclic boosting: in each round every table in turn gets one shallow tree on
its bins, fitted to the gradient of the logistic loss.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import small_batches
from logsift.llm.sample import labelled
from logsift.llm.words import cut_rows

#: Bound of the training sample.
MAX_TRAIN = 20_000

FEATURES = ["log_words", "word_length", "symbols", "capitals", "marks", "digits", "stops", "distinct", "top_word", "repeats", "dup_lines",
            "line_words"]


def describe(text: str | None) -> list[float]:
    """The features of one whole text; null counts as empty (all zero)."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    ascii_only = text.encode("ascii", "ignore")
    count = lambda chars: len(ascii_only) - len(ascii_only.translate(None, chars))
    return [
        float(np.log1p(n)), chars / n, count(b"#*$%&|<>@^~_=+{}[]\\") / n, count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, count(b"!?") / n,
        count(b"0123456789") / chars, count(b".,;:") / n, len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words[1:], words)) / n, 1 - len(set(lines)) / len(lines), n / len(lines),
    ]


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([describe(t.as_py()) for t in column]).reshape(len(column), len(FEATURES))


def _tree(grad: np.ndarray, hess: np.ndarray, leaves: int, ridge: float, least: float) -> np.ndarray:
    """A tree with at most ``leaves`` leaves over ordered bins, split greedily
    by gain; returns the value of each bin."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)
    cuts = [0, len(grad)]
    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            c = np.arange(a + 1, b)
            c = c[(h[c] - h[a] >= least) & (h[b] - h[c] >= least)]
            if len(c):
                got = gain(a, c) + gain(c, b) - gain(a, b)
                if got.max() > best:
                    best, where = got.max(), int(c[got.argmax()])
        if where is None:
            break
        cuts = sorted([*cuts, where])
    out = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + ridge)
    return out


def _quadrants(grad: np.ndarray, hess: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of a bin grid into four; its gain and each cell's value."""
    g, h = grad.cumsum(0).cumsum(1), hess.cumsum(0).cumsum(1)
    total_g, total_h = g[-1, -1], h[-1, -1]
    best, where = -1.0, None
    for i in range(grad.shape[0] - 1):
        for j in range(grad.shape[1] - 1):
            parts = [(g[i, j], h[i, j]), (g[i, -1] - g[i, j], h[i, -1] - h[i, j]), (g[-1, j] - g[i, j], h[-1, j] - h[i, j])]
            parts.append((total_g - sum(p[0] for p in parts), total_h - sum(p[1] for p in parts)))
            got = sum(a * a / (b + ridge) for a, b in parts) - total_g**2 / (total_h + ridge)
            if got > best:
                best, where = got, (i, j, [a / (b + ridge) for a, b in parts])
    out = np.zeros(grad.shape)
    if where:
        i, j, (a, b, c, d) = where
        out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = a, b, c, d
    return best, out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, coarse: int = 8, rounds: int = 150, pair_rounds: int = 40, pairs: int = 6,
        rate: float = 0.1, ridge: float = 1.0, least: float = 1.0) -> dict:
    """Tables of the model from features ``x`` and labels ``y`` (0 or 1)."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    rough = [np.unique(np.quantile(c, np.linspace(0, 1, coarse + 1)[1:-1])) for c in x.T]
    b = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]
    rb = [np.searchsorted(e, c, side="left") for e, c in zip(rough, x.T)]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    tables = [np.zeros(len(e) + 1) for e in edges]
    logit = np.full(len(y), bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, own in enumerate(b):
            g, h = slopes()
            step = rate * _tree(np.bincount(own, g, len(tables[k])), np.bincount(own, h, len(tables[k])), 3, ridge, least)
            tables[k] += step
            logit += step[own]
    shape = lambda i, j: (len(rough[i]) + 1, len(rough[j]) + 1)
    cell = {(i, j): rb[i] * shape(i, j)[1] + rb[j] for i, j in combinations(range(len(b)), 2)}
    grid = lambda key, w: np.bincount(cell[key], w, shape(*key)[0] * shape(*key)[1]).reshape(shape(*key))
    g, h = slopes()
    gains = {k: _quadrants(grid(k, g), grid(k, h), ridge)[0] for k in cell}
    chosen = sorted(sorted(gains), key=lambda k: -gains[k])[:pairs]
    joint = {k: np.zeros(shape(*k)) for k in chosen}
    for _ in range(pair_rounds):
        for k in chosen:
            g, h = slopes()
            step = rate * _quadrants(grid(k, g), grid(k, h), ridge)[1]
            joint[k] += step
            logit += step.ravel()[cell[k]]
    return {"bias": bias, "edges": [e.tolist() for e in edges], "rough": [e.tolist() for e in rough], "tables": [t.tolist() for t in tables],
            "pairs": [(i, j, joint[i, j].tolist()) for i, j in chosen]}


def evaluate(model: dict, x: np.ndarray) -> np.ndarray:
    """Scores of feature rows: vectorised look-ups and additions."""
    logit = np.full(len(x), model["bias"])
    if model["tables"]:
        for e, t, c in zip(model["edges"], model["tables"], x.T):
            logit += np.array(t)[np.searchsorted(np.array(e), c, side="left")]
        rb = [np.searchsorted(np.array(e), c, side="left") for e, c in zip(model["rough"], x.T)]
        for i, j, t in model["pairs"]:
            logit += np.array(t)[rb[i], rb[j]]
    return 1 / (1 + np.exp(-logit))


def train(docs: DataFrame, labels: DataFrame, when: Column, label_col: str = "quality", max_train: int = MAX_TRAIN, id_col: str = "doc_id",
          text_col: str = "text") -> dict:
    """Fit on at most ``max_train`` labelled documents; their features (not
    their texts) come to the driver.  Without labels every score is 0.5."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "y", "x"])

    sample = labelled(docs, labels, label_col, when, max_train, id_col, text_col)
    kind = sample.schema["id"].dataType.simpleString()
    rows = sorted(sample.mapInArrow(run, f"id {kind}, y double, x array<double>").collect(), key=lambda r: (r["id"], r["x"]))
    if not rows:
        return {"bias": 0.0, "edges": [], "rough": [], "tables": [], "pairs": []}
    return fit(np.array([r["x"] for r in rows]), (np.array([r["y"] for r in rows]) > 0).astype(float))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``score`` (0 to 1) per row.  Null text scores as empty
    text does; repeated rows each give a row; empty tables give no rows; other
    columns are ignored."""
    shared = small_batches(docs.sparkSession).sparkContext.broadcast(model)  # a few tables of fixed size
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(evaluate(shared.value, _matrix(batch.column("text"))))],
                                             names=["doc_id", "score"])

    return src.mapInArrow(run, f"doc_id {kind}, score double")
