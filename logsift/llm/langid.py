"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams, in order.  A
document gets the language whose profile has the least out-of-place distance
to its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint, small_batches
from logsift.llm.words import cut_rows

#: Bound of the training sample: so many different rows of each language, by a
#: hash of id and text.
MAX_TRAIN = 4000
PROFILE = 400
_BITS = 21  # of one code point; an n-gram of up to three fits in 63 bits
_EDGE = ord("_")


class Letters:
    """Which code points are letters; looked up once each."""

    def __init__(self) -> None:
        self.kind = np.zeros(0x110000, np.int8)  # 0 unknown, 1 letter, 2 other

    def mask(self, points: np.ndarray) -> np.ndarray:
        new = np.unique(points[self.kind[points] == 0])
        for p in new.tolist():
            c = chr(p)
            self.kind[p] = 1 if c.isalpha() else 2
        return self.kind[points] == 1


def grams(letters: Letters, text: str | None, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of the text's lower-cased words (with ``_`` at
    both ends) as numbers in the order of the n-grams, and their counts."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    on = letters.mask(points)
    after = np.zeros(len(on), bool)
    after[1:] = on[:-1]
    s = np.concatenate([[_EDGE], np.where(on, points, _EDGE)[on | after], [_EDGE]])  # one edge between words
    inner = s != _EDGE
    parts = [s[inner] << 2 * _BITS]
    if longest > 1:
        pair = inner[:-1] | inner[1:]
        parts.append((s[:-1] << 2 * _BITS | s[1:] << _BITS)[pair])
    if longest > 2:  # no word goes on beyond an edge
        parts.append((s[:-2] << 2 * _BITS | s[1:-1] << _BITS | s[2:])[inner[1:-1]])
    return np.unique(np.concatenate(parts), return_counts=True)


def profile(letters: Letters, text: str | None, longest: int, size: int) -> np.ndarray:
    """The text's most frequent n-grams, ties in the order of the n-gram."""
    own, counts = grams(letters, text, longest)
    if len(own) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        own, counts = own[counts >= least], counts[counts >= least]
    return own[np.argsort(-counts, kind="stable")][:size]


def name(gram: int) -> str:
    points = [gram >> k * _BITS & (1 << _BITS) - 1 for k in (2, 1, 0)]
    return "".join(chr(p) for p in points if p)


def number(gram: str) -> int:
    return sum(ord(c) << (2 - k) * _BITS for k, c in enumerate(gram))


def train(docs: DataFrame, when: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", longest: int = 3,
          size: int = PROFILE, max_train: int = MAX_TRAIN) -> dict[str, list[str]]:
    """Profiles from at most ``max_train`` rows of each language among those
    that satisfy ``when``, chosen by a hash of id and text (repeatable).

    Rows with the same id and text count once; they combine in each task, and
    what is ranked is about twice the bound, however many rows share an id.
    N-grams have one to ``longest`` characters, three at most.  Spark counts
    them; only each language's ``size`` best come back."""
    if not 1 <= longest <= 3:
        raise ValueError("n-grams have one to three characters")
    small_batches(docs.sparkSession)
    src = docs.filter(when & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("h"))
    totals = src.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    cut = F.lit(2.0) * max_train / F.greatest("n", F.lit(1))  # twice the bound, then the exact one
    space = float(1 << 64)
    few = src.join(F.broadcast(totals), "lang").filter((F.col("h").cast("double") + space / 2) / space < cut)
    few = few.groupBy("lang", "h").agg(F.first("text").alias("text"))
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= max_train)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for b in cut_rows(batches, "text"):
            for lang in sorted(set(b.column("lang").to_pylist())):
                texts = b.filter(pc.equal(b.column("lang"), lang)).column("text").to_pylist()
                parts = [grams(letters, t, longest) for t in texts]
                own, back = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([c for _, c in parts]), minlength=len(own)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(own), pa.string()), pa.array([name(g) for g in own.tolist()], pa.string()), pa.array(n)],
                                                 names=["lang", "gram", "n"])

    counted = few.select("lang", "text").mapInArrow(count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counted.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= size)
    out: dict[str, list[str]] = {}
    for r in sorted(checkpoint(best).collect(), key=lambda r: (r["lang"], r["r"])):  # languages x size rows
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def predict(docs: DataFrame, profiles: dict[str, list[str]], id_col: str = "doc_id", text_col: str = "text", longest: int = 3,
            size: int = PROFILE) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` per row.

    The distance sums, over the document's profile, how far each n-gram is
    from its place in the language's profile, or ``size`` if it is not there.
    The score is one minus the distance as a share of the greatest possible.
    Null text, text without letters, and any text when there are no profiles,
    get ``und`` with score 0.  Equal distances go to the first language by
    name.  Repeated rows each give a row; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    langs = sorted(profiles)
    keys = np.array(sorted({number(g) for best in profiles.values() for g in best}), np.int64)
    places = np.full((len(keys), len(langs)), -1, np.int64)
    for k, lang in enumerate(langs):
        places[np.searchsorted(keys, [number(g) for g in profiles[lang]]), k] = np.arange(len(profiles[lang]))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters()
        for b in batches:
            best, scores = [], []
            for text in b.column("text"):
                own = profile(letters, text.as_py(), longest, size) if len(keys) else keys
                if not len(own):
                    best.append("und")
                    scores.append(0.0)
                    continue
                near = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
                at = np.where((keys[near] == own)[:, None], places[near], -1)
                far = np.where(at < 0, size, np.abs(at - np.arange(len(own))[:, None])).sum(0)
                k = int(far.argmin())
                best.append(langs[k])
                scores.append(1.0 - float(far[k]) / (size * len(own)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return src.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
