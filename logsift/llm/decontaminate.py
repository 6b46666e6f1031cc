"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of documents of bounded size inside a task.  Its text is
the sequence of word ids over the phrases' vocabulary; runs of words that no
phrase can touch (a word, or a pair of neighbours, that no phrase has, or a
run shorter than the shortest phrase) shrink to one separator, which loses no
occurrence.  The index holds the Burrows-Wheeler transform in a wavelet
matrix; all phrases are searched backwards together, occurrences are located
through sampled suffix positions, and the hit words are merged into spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import small_batches
from logsift.llm.words import ALNUM, U64, cut_rows, text_bytes, word_hashes, word_spans

#: Words of phrases in one broadcast block; a larger benchmark takes more blocks.
BLOCK_WORDS = 1_000_000
#: Bytes of text in one shard (or one longer document).
SHARD_BYTES = 6 << 20


class Wavelet:
    """Wavelet matrix over ids below ``2 ** levels`` with word-popcount ranks."""

    def __init__(self, seq: np.ndarray, levels: int) -> None:
        self.n, self.levels, self.rows = len(seq), levels, []
        for level in reversed(range(levels)):
            bits = (seq >> level & 1).astype(bool)
            pad = np.zeros((self.n // 64 + 1) * 64, bool)
            pad[: self.n] = bits
            packed = np.packbits(pad, bitorder="little").view("<u8")
            ones = np.concatenate([[0], np.cumsum(np.bitwise_count(packed).astype(np.int64))])
            zeros = self.n - int(ones[-1])
            self.rows.append((level, packed, ones, zeros))
            seq = np.concatenate([seq[~bits], seq[bits]])

    @staticmethod
    def _ones(packed: np.ndarray, ones: np.ndarray, i: np.ndarray) -> np.ndarray:
        block, low = i >> 6, (i & 63).astype(U64)
        part = packed[block] & ((U64(1) << low) - U64(1))
        return ones[block] + np.bitwise_count(part).astype(np.int64)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``i``."""
        low = np.zeros_like(i)
        for level, packed, ones, zeros in self.rows:
            bit = (symbol >> level & 1).astype(bool)
            a, b = self._ones(packed, ones, low), self._ones(packed, ones, i)
            low = np.where(bit, zeros + a, low - a)
            i = np.where(bit, zeros + b, i - b)
        return i - low

    def at(self, i: np.ndarray) -> np.ndarray:
        """The symbol at position ``i``."""
        out = np.zeros_like(i)
        for level, packed, ones, zeros in self.rows:
            bit = (packed[i >> 6] >> (i & 63).astype(U64) & U64(1)).astype(np.int64)
            a = self._ones(packed, ones, i)
            out |= bit << level
            i = np.where(bit == 1, zeros + a, i - a)
        return out


def suffix_array(seq: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ``seq`` ends with its only 0.

    Separators (1) sort by their place, so that no comparison goes beyond the
    end of a run, however often whole runs recur.  They stay below all words
    and are never searched for, so one symbol stands for them in the index."""
    split = seq == 1
    rank = np.unique(np.where(split, np.cumsum(split), seq + np.where(seq > 1, int(split.sum()), 0)), return_inverse=True)[1].astype(np.int64)
    n, step = len(seq), 1
    while True:
        nxt = np.zeros(n, np.int64)
        nxt[:-step or None] = rank[step:] + 1 if step < n else 0
        key = rank * (n + 1) + nxt
        order = np.argsort(key)
        ranked = key[order]
        fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        step *= 2


class FMIndex:
    """FM-index of an id sequence; id 1 separates runs, id 0 ends the text.
    Suffix positions are kept every ``sample`` words and at each run's start,
    so that locating never walks over a separator."""

    def __init__(self, seq: np.ndarray, vocabulary: int, sample: int = 8) -> None:
        sa = suffix_array(seq)
        bwt = seq[sa - 1]
        self.tree = Wavelet(bwt.astype(np.int64), max(1, int(vocabulary - 1).bit_length()))
        self.below = np.concatenate([[0], np.cumsum(np.bincount(seq, minlength=vocabulary))])
        kept = (sa % sample == 0) | (bwt <= 1)
        marks = np.zeros((len(sa) // 64 + 1) * 64, bool)
        marks[: len(sa)] = kept
        self.marks = np.packbits(marks, bitorder="little").view("<u8")
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks).astype(np.int64))])
        self.kept = sa[kept]

    def search(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all phrases together (rows of ``words``, right
        padded): the suffix interval of each, empty if it does not occur."""
        lo = np.zeros(len(lengths), np.int64)
        hi = np.full(len(lengths), self.tree.n, np.int64)
        for back in range(1, int(lengths.max(initial=0)) + 1):
            on = np.flatnonzero((lengths >= back) & (hi > lo))
            if not len(on):
                break
            c = words[on, lengths[on] - back]
            lo[on] = self.below[c] + self.tree.rank(c, lo[on])
            hi[on] = self.below[c] + self.tree.rank(c, hi[on])
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix-array rows, walking back to samples."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            r = rows[todo]
            hit = (self.marks[r >> 6] >> (r & 63).astype(U64) & U64(1)) == 1
            done = todo[hit]
            out[done] = self.kept[Wavelet._ones(self.marks, self.counts, rows[done])] + steps[done]
            todo = todo[~hit]
            c = self.tree.at(rows[todo])
            rows[todo] = self.below[c] + self.tree.rank(c, rows[todo])
            steps[todo] += 1
        return out


class Phrases:
    """One block of phrases: every window of ``width`` words of each item, or
    the whole item if it is shorter, over a vocabulary of word hashes."""

    def __init__(self, items: list[tuple[object, np.ndarray]], width: int) -> None:
        self.vocabulary = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, U64)
        seen: dict[bytes, int] = {}
        owners: list[set[int]] = []
        rows: list[np.ndarray] = []
        pairs: list[np.ndarray] = []
        self.items = [i for i, _ in items]
        for k, (_, h) in enumerate(items):
            ids = np.searchsorted(self.vocabulary, h) + 2
            pairs.append(ids[:-1] << 32 | ids[1:])
            for a in range(max(1, len(ids) - width + 1)):
                row = ids[a : a + width]
                at = seen.setdefault(row.tobytes(), len(rows))
                if at == len(rows):
                    rows.append(row)
                    owners.append(set())
                owners[at].add(k)
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.words = np.zeros((len(rows), int(self.lengths.max(initial=0))), np.int64)
        for at, row in enumerate(rows):
            self.words[at, : len(row)] = row
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        counts = [len(o) for o in owners]
        self.owner_start = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        self.owners = np.array([k for o in owners for k in sorted(o)], np.int64)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary ids (from 2), or 1 for words that no phrase has."""
        if not len(self.vocabulary):
            return np.ones(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 2, 1)

    def hits(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start word and phrase of every occurrence in a shard's words."""
        ids = self.ids(hashes)
        n, shortest = len(ids), int(self.lengths.min(initial=0))
        none = np.zeros(0, np.int64)
        if not n or not len(self.lengths):
            return none, none
        known = ids > 1
        joined = np.zeros(n, bool)  # continues the run of the word before it
        near = np.flatnonzero(known[1:] & known[:-1]) + 1
        pair = ids[near - 1] << 32 | ids[near]
        if len(self.pairs):
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined[near[self.pairs[at] == pair]] = True
        joined[bounds[(bounds > 0) & (bounds < n)]] = False
        heads = np.flatnonzero(known & ~joined)
        tails = np.flatnonzero(known & ~np.append(joined[1:], False)) + 1
        long = tails - heads >= shortest
        heads, sizes = heads[long], (tails - heads)[long]
        if not len(heads):
            return none, none
        starts = np.concatenate([[0], np.cumsum(sizes + 1)])  # a separator after each run
        seq = np.ones(starts[-1] + 1, np.int64)
        seq[-1] = 0
        word = np.repeat(heads - starts[:-1], sizes + 1) + np.arange(starts[-1])
        real = np.ones(starts[-1], bool)
        real[starts[1:] - 1] = False
        seq[:-1][real] = ids[word[real]]
        index = FMIndex(seq, len(self.vocabulary) + 2)
        lo, hi = index.search(self.words, self.lengths)
        count = hi - lo
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
        return word[index.locate(rows)], phrase


def _phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[object, np.ndarray]]]:
    """Blocks of whole items, streamed through the driver one at a time."""
    rows = benchmark.select(F.col(id_col).alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    items, total = [], 0
    for r in rows.toLocalIterator(prefetchPartitions=False):
        data, offsets = text_bytes(pa.array([r["t"]]), lower=True)
        starts, ends, _ = word_spans(data, offsets, ALNUM)
        if len(starts):
            items.append((r["i"], word_hashes(data, starts, ends)))
            total += len(starts)
        if total >= block_words:
            yield items
            items, total = [], 0
    if items:
        yield items


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 13, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per document row: ``doc_id``, ``n_words``, ``n_hit``, ``spans`` (merged
    ``[start, end)`` word spans to remove) and ``items`` (ids of the items of
    which a window occurs, as strings in order).

    Words are ``[0-9a-z]`` and all non-ASCII characters after folding A-Z.
    Null or empty text has no words and no hits; items without words match
    nothing; items with equal text each count; an item id given twice counts
    once; a null item id is the empty string.  Repeated rows each give a row;
    an empty table gives no rows; other columns are ignored.
    """
    sc = small_batches(docs.sparkSession).sparkContext
    blocks = [sc.broadcast(p) for p in _phrase_blocks(benchmark, item_id, item_text, block_words)]
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = Phrases(blocks[0].value, width) if len(blocks) == 1 else None  # else one block in memory at a time
        for batch in cut_rows(batches, "text", shard_bytes):
            data, offsets = text_bytes(batch.column("text"), lower=True)
            starts, ends, bounds = word_spans(data, offsets, ALNUM)
            hashes = word_hashes(data, starts, ends)
            cover = np.zeros(len(hashes) + 1, np.int64)
            found: dict[int, set[str]] = {}
            for block in blocks:
                p = alone or Phrases(block.value, width)
                word, phrase = p.hits(hashes, bounds)
                np.add.at(cover, word, 1)
                np.add.at(cover, word + p.lengths[phrase], -1)
                rows = np.searchsorted(bounds, word, side="right") - 1
                for row, which in np.unique(np.stack([rows, phrase], 1), axis=0) if len(rows) else ():
                    own = p.owners[p.owner_start[which] : p.owner_start[which + 1]]
                    found.setdefault(int(row), set()).update("" if p.items[k] is None else str(p.items[k]) for k in own)
            hit = np.cumsum(cover)[:-1] > 0
            sums = np.concatenate([[0], np.cumsum(hit)])
            n_hit = sums[bounds[1:]] - sums[bounds[:-1]]
            spans: list[list[dict]] = [[] for _ in range(len(batch))]
            for row in np.flatnonzero(n_hit):
                edge = np.diff(np.concatenate([[0], hit[bounds[row] : bounds[row + 1]].astype(np.int8), [0]]))
                spans[row] = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(n_hit),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 pa.array([sorted(found.get(r, ())) for r in range(len(batch))], pa.list_(pa.string()))],
                names=["doc_id", "n_words", "n_hit", "spans", "items"])

    return src.mapInArrow(run, f"doc_id {kind}, n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>")


def contaminated(percent: int = 5):
    """The contract's rule on ``n_hit`` and ``n_words``."""
    return (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
