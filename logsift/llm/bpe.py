"""Byte-level BPE encoding and decoding over a rank file.

A text is cut by the vocabulary's pattern and every match is encoded by
itself.  The bytes of a match become a Latin-1 string, over which one pass of
an Aho-Corasick automaton gives the longest token that starts at each place.
The match is then tiled from the left: take the longest token whose neighbour
on the left is compatible with it, fall back to shorter prefixes, and step
back if none is left.  Two tokens are compatible if merging by rank would
never join bytes across their border; a tiling whose neighbours are all
compatible is unique and is the one that merging gives.  A place that was
given up is never tried again, so the time is linear in the match's length.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import types
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import small_batches
from logsift.llm.words import cut_rows

#: Entries of a worker's caches (matches of up to CACHE_CHARS characters, and
#: token pairs) before they start anew.  They save time only.
CACHE_ENTRIES, CACHE_CHARS, CACHE_PAIRS = 400_000, 64, 2_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """``bytes -> rank`` of a rank file (base64 token and rank a line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _last_merge(token: bytes, rank: dict[bytes, int]) -> tuple[int, int] | None:
    """The two parts whose merge completes ``token`` when its bytes are merged
    by rank, each step using a higher rank than the one before; None if they
    do not end that way."""
    parts, at = [token[k : k + 1] for k in range(len(token))], -1
    while True:
        found = [(r, k) for k in range(len(parts) - 1) if (r := rank.get(parts[k] + parts[k + 1])) is not None]
        if not found or min(found)[0] < at:
            return None
        at, k = min(found)
        if len(parts) == 2:
            return rank[parts[0]], rank[parts[1]]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


class Vocabulary:
    """Tokens by id with what the encoder looks up: the parts of a token's last
    merge and its longest proper prefix that is a token."""

    def __init__(self, rank: dict[bytes, int]):
        if sorted(rank.values()) != list(range(len(rank))) or any(bytes([b]) not in rank for b in range(256)):
            raise ValueError("ranks must be 0 to n - 1 and hold every single byte")
        self.rank = rank
        self.tokens = sorted(rank, key=rank.__getitem__)
        self.left, self.right, self.shorter = (np.full(len(rank), -1, np.int32) for _ in range(3))
        for i, t in enumerate(self.tokens):
            if len(t) > 1:
                parts = _last_merge(t, rank)
                if parts is None or max(parts) >= i and len(self.tokens[max(parts)]) > 1:
                    raise ValueError(f"token {t!r} is not made by merges of lower rank")
                self.left[i], self.right[i] = parts
                self.shorter[i] = next(rank[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in rank)


class Encoder:
    """``str -> bytes`` of little-endian int32 ids, with a worker's caches."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import ahocorasick
        import regex

        self.rank, self.tokens = vocabulary.rank, vocabulary.tokens
        self.size = [len(t) for t in self.tokens]
        self.left, self.right, self.shorter = vocabulary.left.tolist(), vocabulary.right.tolist(), vocabulary.shorter.tolist()
        self.merged = [i if n > 1 else -1 for i, n in enumerate(self.size)]
        self.pairs: dict[int, bool] = {}
        self.matches: dict[str, bytes] = {}
        self.findall = regex.compile(pattern).findall
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.tokens):
            self.automaton.add_word(t.decode("latin-1"), (i, len(t)))
        self.automaton.make_automaton()

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves ``a`` and ``b`` apart.  Their merges
        are undone from the last one back; while a pair stands at the border,
        joining it must not come before the merge that ends its time there.
        Of equal ranks the one further left comes first."""
        key = a * len(self.tokens) + b
        known = self.pairs.get(key)
        if known is not None:
            return known
        x, y, before, answer = a, b, len(self.tokens), True
        while True:
            joined = self.rank.get(self.tokens[x] + self.tokens[y])
            if joined is not None and joined < before:
                answer = False
                break
            if self.merged[x] > self.merged[y]:
                before, x = x, self.right[x]
            elif self.merged[y] >= 0:
                before, y = y + 1, self.left[y]
            else:
                break
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[key] = answer
        return answer

    def match_ids(self, match: str) -> list[int]:
        """Ids of one match of the pattern."""
        data = match.encode("utf-8")
        whole = self.rank.get(data)
        if whole is not None:
            return [whole]
        n, size, shorter, compatible = len(data), self.size, self.shorter, self.compatible
        longest = [-1] * n
        for end, (i, length) in self.automaton.iter(data.decode("latin-1")):
            longest[end - length + 1] = i  # ends rise, so the longest comes last
        dead = bytearray(n + 1)
        out: list[int] = []
        at, i = 0, longest[0]
        while at < n:
            while i >= 0 and (dead[at + size[i]] or (out and not compatible(out[-1], i))):
                i = shorter[i]
            if i >= 0:
                out.append(i)
                at += size[i]
                i = longest[at] if at < n else -1
            else:
                dead[at] = 1
                i = out.pop()
                at -= size[i]
                i = shorter[i]
        return out

    def __call__(self, text: str) -> bytes:
        known, made = self.matches, []
        for m in self.findall(text):
            ids = known.get(m)
            if ids is None:
                ids = array("i", self.match_ids(m)).tobytes()
                if len(m) <= CACHE_CHARS:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[m] = ids
            made.append(ids)
        return b"".join(made)


def _kept(mark: str, make):
    """The encoder of a worker process, made anew for another vocabulary."""
    home = sys.modules.setdefault("_logsift_bpe", types.ModuleType("_logsift_bpe")).__dict__.setdefault("made", {})
    if mark not in home:
        home.clear()
        home[mark] = make()
    return home[mark]


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every row of ``docs``.

    ``ranks`` is the path of a rank file on the driver.  Null text counts as
    empty (no ids); repeated rows and null ids stay as they are; an empty table
    gives no rows; other columns of ``docs`` are ignored.  Texts of any length
    are encoded whole.  Special tokens have no meaning here: their strings are
    ordinary text.  A vocabulary with tokens that its merges cannot make
    raises ``ValueError``.
    """
    spark = small_batches(docs.sparkSession)
    rank = read_ranks(ranks)
    words = spark.sparkContext.broadcast(Vocabulary(rank))  # as large as the rank file
    mark = hashlib.sha256(repr((sorted(rank.items()), pattern)).encode()).hexdigest()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _kept(mark, lambda: Encoder(words.value, pattern))
        for batch in cut_rows(batches, "text"):
            made = [encoder(t.as_py() or "") for t in batch.column("text")]
            ends = np.cumsum([0] + [len(m) // 4 for m in made]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(made), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``ids`` and ``decoded`` (binary) of every row of ``encoded``.

    Null ``ids`` count as none (empty bytes).  A null id in a list or one that
    the vocabulary does not have raises an error.  Other columns are ignored.
    """
    spark = small_batches(encoded.sparkSession)
    rank = read_ranks(ranks)
    words = spark.sparkContext.broadcast(pa.array(sorted(rank, key=rank.__getitem__), pa.binary()))
    src = encoded.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat = ids.flatten()
            if flat.null_count:
                raise ValueError("null among the ids")
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False))]).astype(np.int64)
            parts = pa.LargeListArray.from_arrays(pa.array(ends), words.value.take(flat))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pc.binary_join(parts, b"").cast(pa.binary())],
                                             names=["doc_id", "ids", "decoded"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded binary")
