"""Toxicity by multiple-instance learning.

A document is a bag of sentences; each sentence has a logistic score over its
words, and the document's score is their noisy-or.  Only documents carry
labels: the weights of the words are learnt through the noisy-or, and the
sentence scores then say where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import small_batches
from logsift.llm.sample import labelled
from logsift.llm.words import U64, cut_rows, text_bytes, word_hashes, word_spans

#: Bounds of the training sample and of the vocabulary.
MAX_TRAIN = 20_000
MAX_WORDS = 8192

#: Bytes of the stems that stand beside each longer word, for inflected forms.
STEMS = (4, 5, 6)

#: word bytes: letters and all bytes of other scripts
_WORD = np.zeros(256, bool)
_WORD[0x61:0x7B] = _WORD[0x80:] = True
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?\n"]] = True


def bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of texts: hashes of words and of the stems of longer words;
    the sentence (counted over the batch, only those with a word) of each;
    the sentence's row; its first and last byte."""
    data, offsets = text_bytes(column, lower=True)
    starts, ends, bounds = word_spans(data, offsets, _WORD)
    whole = word_hashes(data, starts, ends)
    row = np.repeat(np.arange(len(column)), np.diff(bounds))
    stops = np.flatnonzero(_END[data]) if len(data) else np.zeros(0, np.int64)
    part = np.searchsorted(stops, starts)
    new = np.ones(len(starts), bool)
    new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1 if len(first) else first
    h, own = [whole], [sentence]
    for n in STEMS:
        long = np.flatnonzero(ends - starts > n)
        h.append(word_hashes(data, starts[long], starts[long] + n) + U64(n))
        own.append(sentence[long])
    h, sentence = np.concatenate(h), np.concatenate(own)
    return h, sentence, row[first], starts[first] - offsets[row[first]], ends[last] - offsets[row[first]]


def _evidence(train: DataFrame, max_words: int) -> list[int]:
    """Hashes of the words whose document frequencies differ most between the
    labels, counted by Spark over the sample."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            h, sentence, row, _, _ = bags(batch.column("text"))
            y = batch.column("y").to_numpy() > 0
            if not len(h):
                continue
            own = row[sentence]
            order = np.lexsort((own, h))
            h, own = h[order], own[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
            words, back = np.unique(h[once], return_inverse=True)
            pos = np.bincount(back, weights=y[own[once]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(np.bincount(back).astype(np.int64)), pa.array(pos)],
                                             names=["h", "n", "p"])

    counts = train.select("text", "y").mapInArrow(count, "h long, n long, p long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    total, pos = train.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("y") > 0, 1)), F.lit(0))).first()
    if not pos or pos == total:
        return []
    rate = pos / total
    z = (F.col("p") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate) + 1)
    rows = counts.filter("n >= 3").withColumn("z", F.abs(z)).filter("z > 3.5").orderBy(F.desc("z"), "h").limit(max_words).collect()
    return sorted(np.array([r["h"] for r in rows], np.int64).view(U64).tolist())


def _ids(vocabulary: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions in the vocabulary, or -1."""
    if not len(vocabulary):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    return np.where(vocabulary[at] == h, at, -1)


def _sigmoid(z):
    return np.exp(-np.logaddexp(0, -z))


def fit(doc: np.ndarray, y: np.ndarray, empty: np.ndarray, sent_doc: np.ndarray, word_sent: np.ndarray, word: np.ndarray, n_words: int,
        steps: int = 250, rate: float = 0.15, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the noisy-or likelihood.  ``empty`` counts
    each document's sentences without a vocabulary word: they score alike."""
    theta, share = np.zeros(n_words + 1), max(y.mean(), 1e-3)
    theta[-1] = np.log(share / max(1.0, len(sent_doc) / max(1, len(doc)) + empty.mean()))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    start = theta[-1]
    for t in range(1, steps + 1):
        z = theta[-1] + np.bincount(word_sent, weights=theta[word], minlength=len(sent_doc))
        p, q = _sigmoid(z), float(_sigmoid(theta[-1]))
        clean = np.bincount(sent_doc, weights=-np.logaddexp(0, z), minlength=len(doc)) - empty * np.logaddexp(0, theta[-1])
        bag = -np.expm1(np.minimum(clean, -1e-9))
        pull = np.where(y > 0, (1 - bag) / bag, -1.0)  # of each sentence's own score
        each = pull[sent_doc] * p
        grad = np.append(np.bincount(word, weights=each[word_sent], minlength=n_words), each.sum() + (pull * empty * q).sum()) / len(doc)
        grad -= penalty * np.append(theta[:-1], theta[-1] - start)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _log_odds(clean: np.ndarray) -> np.ndarray:
    """Log odds of the noisy-or, from the log probability that no sentence is toxic."""
    with np.errstate(divide="ignore", over="ignore"):
        return np.log(np.expm1(-clean))


def best_cut(odds: np.ndarray, y: np.ndarray) -> float:
    """The log odds at which catching positives and sparing negatives is best
    (the largest difference of the two rates; midway between two documents,
    and of equal ones the cut nearest to even odds)."""
    order = np.argsort(-odds, kind="stable")
    odds, y = odds[order], y[order]
    gain = np.cumsum(np.where(y > 0, 1 / max(1, (y > 0).sum()), -1 / max(1, (y <= 0).sum())))
    ends = np.flatnonzero(np.append(odds[1:] < odds[:-1], True))
    ends = ends[np.isfinite(odds[ends])]
    if not len(ends) or not (y > 0).any() or not (y <= 0).any():
        return 0.0
    below = np.append(odds[1:], odds[-1] - 1)
    cuts = np.where(np.isfinite(below[ends]), (odds[ends] + below[ends]) / 2, odds[ends] - 1)
    top = gain[ends] >= gain[ends].max() - 1e-12
    return float(cuts[top][np.abs(cuts[top]).argmin()])


def _calibrate(y: np.ndarray, empty: np.ndarray, sent_doc: np.ndarray, word_sent: np.ndarray, word: np.ndarray, n_words: int, folds: int = 3) -> float:
    """:func:`best_cut` of scores that the documents get from models that have
    not seen them."""
    odds = np.zeros(len(y))
    fold = np.arange(len(y)) % folds
    for f in range(folds):
        learn = np.flatnonzero(fold != f)
        place = np.full(len(y), -1)
        place[learn] = np.arange(len(learn))
        sents = np.flatnonzero(place[sent_doc] >= 0)
        sent_at = np.full(len(sent_doc), -1)
        sent_at[sents] = np.arange(len(sents))
        terms = sent_at[word_sent] >= 0
        weights, bias = fit(np.arange(len(learn)), y[learn], empty[learn], place[sent_doc[sents]], sent_at[word_sent[terms]], word[terms], n_words)
        z = bias + np.bincount(word_sent, weights=weights[word], minlength=len(sent_doc))
        clean = np.bincount(sent_doc, weights=-np.logaddexp(0, z), minlength=len(y)) - empty * np.logaddexp(0, bias)
        odds[fold == f] = _log_odds(clean[fold == f])
    return best_cut(odds, y)


def train(docs: DataFrame, labels: DataFrame, when: Column, label_col: str = "toxic", max_train: int = MAX_TRAIN,
          max_words: int = MAX_WORDS, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The model: vocabulary hashes, weights, bias, and ``cut``, the log odds
    that score 0.5, calibrated on the same documents by models that have not
    seen them.  Without labels of both kinds the model has no words and scores
    the share of toxic labels."""
    sample = labelled(docs, labels, label_col, when, max_train, id_col, text_col)
    words = np.array(_evidence(sample, max_words), U64)

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            h, sentence, row, _, _ = bags(batch.column("text"))
            ids = _ids(words, h)
            known = np.flatnonzero(ids >= 0)
            known = known[np.argsort(sentence[known], kind="stable")]
            own, ids = sentence[known], ids[known].astype(np.int32)
            full = np.unique(own)
            total = np.bincount(row, minlength=len(batch))
            empty = total - np.bincount(row[full], minlength=len(batch))
            owner = row[own]
            sents, terms = [], []
            for r in range(len(batch)):
                a, b = np.searchsorted(owner, [r, r + 1])
                sents.append((own[a:b] - (own[a] if b > a else 0)).astype(np.int32).tobytes())
                terms.append(ids[a:b].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(empty.astype(np.int64)), pa.array(sents, pa.binary()), pa.array(terms, pa.binary())],
                                             names=["y", "empty", "sents", "terms"])

    rows = sample.orderBy("id").mapInArrow(compact, "y double, empty long, sents binary, terms binary").collect()  # <= max_train rows
    if not rows:
        return {"words": [], "weights": [], "bias": -4.0, "cut": 0.0}
    y = np.array([r["y"] for r in rows]) > 0
    empty = np.array([r["empty"] for r in rows], float)
    sent_doc, word_sent, word, at = [], [], [], 0
    for d, r in enumerate(rows):
        s, terms = np.frombuffer(r["sents"], np.int32), np.frombuffer(r["terms"], np.int32)
        _, back = np.unique(s, return_inverse=True)
        n = int(back.max() + 1) if len(s) else 0
        sent_doc.append(np.full(n, d))
        word_sent.append(back + at)
        word.append(terms)
        at += n
    data = (y.astype(float), empty, np.concatenate(sent_doc), np.concatenate(word_sent).astype(np.int64), np.concatenate(word).astype(np.int64), len(words))
    weights, bias = fit(np.arange(len(rows)), *data)
    return {"words": words.tolist(), "weights": weights.tolist(), "bias": bias, "cut": _calibrate(*data) if len(words) else 0.0}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", offending: float = 0.5) -> DataFrame:
    """Per row: ``doc_id``, ``score`` (noisy-or of the sentences, moved so that
    the calibrated cut is 0.5; 0 to 1) and ``offending``: the sentences that
    score at least ``offending`` alone, as ``index``, ``score`` and ``text``.

    Null or empty text and text without letters has no sentence and scores 0.
    Repeated rows each give a row; empty tables give no rows; other columns
    are ignored.
    """
    sc = small_batches(docs.sparkSession).sparkContext
    shared = sc.broadcast(model)  # at most max_words weights
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, bias, cut = np.array(shared.value["words"], U64), np.array(shared.value["weights"], float), shared.value["bias"], shared.value["cut"]
        for batch in cut_rows(batches, "text"):
            h, sentence, row, first, last = bags(batch.column("text"))
            ids = _ids(words, h)
            known = np.flatnonzero(ids >= 0)
            z = bias + np.bincount(sentence[known], weights=weights[ids[known]], minlength=len(row))
            clean = np.bincount(row, weights=-np.logaddexp(0, z), minlength=len(batch))
            found: list[list[dict]] = [[] for _ in range(len(batch))]
            p = _sigmoid(z - cut)
            heads = np.searchsorted(row, np.arange(len(batch)))
            texts = batch.column("text")
            for k in np.flatnonzero(p >= offending):
                raw = texts[int(row[k])].as_py().encode()
                found[row[k]].append({"index": int(k - heads[row[k]]), "score": float(p[k]),
                                      "text": raw[first[k] : last[k]].decode("utf-8", "replace")})
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(_sigmoid(_log_odds(clean) - cut)),
                 pa.array(found, pa.list_(pa.struct([("index", pa.int64()), ("score", pa.float64()), ("text", pa.string())])))],
                names=["doc_id", "score", "offending"])

    return src.mapInArrow(run, f"doc_id {kind}, score double, offending array<struct<index:long,score:double,text:string>>")
