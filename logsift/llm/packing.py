"""Best-fit packing of token sequences by minimum bin slack.

The lengths of all pieces are counted by Spark; there are at most ``size``
distinct lengths, so the counts have a proven bound however many documents
there are.  The plan is made on those counts: for each bin the longest piece
left is taken and a bitset subset-sum over the lengths still available finds
the fullest combination, which is removed, as often in a row as the counts
allow (the next bin would find the same combination again).  Pieces are then
dealt to the planned places by their rank within their length, which needs one
count per (task, length) and no sort.
"""

from __future__ import annotations

import sys
import types
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint, small_batches

#: Pretoken cache of a task: entries, then it starts anew.
CACHE_ENTRIES = 300_000

#: Fixed value: the byte-level pretokeniser's split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long, _task int, _rank long"


def _quick(path: str):
    """The same vocabulary and merges in tiktoken, which takes a fourth of the
    time for short texts; None if the file's merges are not in id order or its
    pretokeniser is another, as equal ids are then not certain."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    pre, model = file["pre_tokenizer"], file["model"]
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or file["normalizer"]:
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    other = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
    special = {t["content"] for t in file["added_tokens"]}
    ranks = {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if w not in special}
    pairs = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    if [model["vocab"][w] for w in pairs] != list(range(256, 256 + len(pairs))):
        return None
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _encoder(path: str):
    """``text -> bytes`` of little-endian uint32 ids, kept per worker process."""
    home = sys.modules.setdefault("_logsift_tokens", types.ModuleType("_logsift_tokens"))
    made = home.__dict__.setdefault("made", {})
    if path in made:
        return made[path]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True  # their strings in a text are ordinary text
    specials = [t.content for t in tok.get_added_tokens_decoder().values()]

    def direct(text: str) -> bytes:
        return np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    quick = _quick(path)

    def small(text: str) -> bytes:
        return array("I", quick(text)).tobytes() if quick else direct(text)

    class Cache(dict):
        """Ids of a chunk with a space before it.  White space at a chunk's
        edge touches that space and might be split differently: such a chunk
        is kept as ``None``, which sends its text to the tokeniser whole."""

        def __missing__(self, chunk: str) -> bytes | None:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            alone = not chunk or chunk[0].isspace() or chunk[-1].isspace()
            out = self[chunk] = None if alone else small(" " + chunk)
            return out

    cache = Cache()
    cached = cache.__getitem__

    def encode(text: str) -> bytes:
        """Cut before each space, where the pretokeniser never joins, so that
        chunks can be cached."""
        first, *rest = text.split(" ")
        if not rest or (first and first[-1].isspace()) or any(s in text for s in specials):
            return direct(text)
        try:
            return (small(first) if first else b"") + b"".join(list(map(cached, rest)))
        except TypeError:
            return direct(text)

    encode.forget = cache.clear  # a worker that waits for other tasks holds no cache
    made[path] = encode
    return encode


def _cuts(n: int, size: int) -> list[tuple[int, int]]:
    """Pieces of ``n`` tokens: whole if they fit, else ``size`` each with the
    shorter one first."""
    if n <= size:
        return [(0, n)]
    first = n % size
    return ([(0, first)] if first else []) + [(a, size) for a in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Token pieces of every document, with the writing task and the rank
    among that task's pieces of equal length."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType
    schema = _PIECES.format(id=kind.simpleString())
    ending = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = _encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            cols: list[list] = [[], [], [], [], [], []]
            who = []
            for row, text in enumerate(batch.column("text")):
                data = encode(text.as_py() or "") + ending
                for k, (a, n) in enumerate(_cuts(len(data) // 4, size)):
                    who.append(row)
                    for c, v in zip(cols, (k, a, n, zlib.crc32(data[4 * a : 4 * (a + n)]), task, int(seen[n]))):
                        c.append(v)
                    seen[n] += 1
            ids = batch.column("doc_id").take(pa.array(who, pa.int64()))
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_task", "_rank"]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(cols, kinds))], names=names)
        encode.forget()

    return src.mapInArrow(run, schema)


def fullest(counts: dict[int, int], size: int) -> dict[int, int]:
    """The fullest combination of available lengths that holds the longest one.

    Bitset subset-sum: bit ``s`` of ``reach`` says that some pieces sum to
    ``s``.  Among the fullest combinations the one with the longest pieces is
    taken, so the result depends on nothing but the counts."""
    lengths = sorted(counts)
    longest = lengths[-1]
    room, mask = size - longest, (1 << (size - longest + 1)) - 1
    steps, reach = [], 1
    for n in lengths:
        if n > room:
            break
        for _ in range(min(counts[n] - (n == longest), room // n)):
            grown = (reach | reach << n) & mask
            if grown == reach:
                break
            steps.append((n, reach))
            reach = grown
        if reach >> room & 1 and reach == mask:
            break
    left, picked = reach.bit_length() - 1, {longest: 1}
    for n, before in reversed(steps):
        if n <= left and before >> (left - n) & 1:
            picked[n] = picked.get(n, 0) + 1
            left -= n
        elif not before >> left & 1:  # cannot happen: left is reachable
            raise AssertionError("subset-sum trace is broken")
    return picked


def plan(counts: dict[int, int], size: int = 1024) -> list[tuple[int, int, int, int, int, int]]:
    """Places for all pieces: rows ``(length, first rank, last rank + 1, pieces
    a bin, first bin, offset in the bin)``.  At most a few rows per distinct
    length and combination, whatever the counts are."""
    counts = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(counts, 0)
    out, bins = [], 0
    while counts:
        combo = fullest(counts, size)
        times = min(counts[n] // k for n, k in combo.items())
        at = 0
        for n in sorted(combo, reverse=True):
            k = combo[n]
            out.append((n, used[n], used[n] + k * times, k, bins, at))
            at += n * k
            used[n] += k * times
            counts[n] -= k * times
            if not counts[n]:
                del counts[n]
        bins += times
    return out


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``size`` tokens.

    Null text counts as empty (one end token); repeated rows are packed as
    often as they occur; an empty table gives no rows.  ``sequence_id`` is
    dense from 0.  Columns of ``docs`` other than the two named are ignored.
    """
    spark = small_batches(docs.sparkSession)
    made = checkpoint(pieces(docs, tokenizer, size, end_id, id_col, text_col))  # tokenised once; ranks fixed
    by_task = made.groupBy("_task", "length").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = by_task.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    totals = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= size rows
    rows = np.array(plan(totals, size) or [(0, 0, 0, 1, 0, 0)], np.int64)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    places = spark.sparkContext.broadcast(rows)

    kind = made.schema["doc_id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, _, per, bins, offset = places.value.T
        starts = np.searchsorted(length, np.arange(size + 2))
        for b in batches:
            n = b.column("length").to_numpy()
            rank = b.column("_rank").to_numpy() + b.column("_base").to_numpy()
            order = np.lexsort((rank, n))
            at = np.empty(len(n), np.int64)
            for m in np.unique(n):
                own = order[np.searchsorted(n[order], m) : np.searchsorted(n[order], m, side="right")]
                at[own] = starts[m] + np.searchsorted(first[starts[m] : starts[m + 1]], rank[own], side="right") - 1
            inside = rank - first[at]
            seq = bins[at] + inside // per[at]
            off = offset[at] + inside % per[at] * n
            keep = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq), pa.array(off)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return made.join(base, ["_task", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "_rank", "_base").mapInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
