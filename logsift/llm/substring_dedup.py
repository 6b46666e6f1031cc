"""Substring dedup: every passage of ``window`` words that occurs twice.

1. Each window is filed under its seed: the least hash of the ``seed``-word
   grams in it.  Equal windows have equal seeds, so only windows whose seed
   occurs twice can repeat; neighbouring windows share a seed and travel as
   one run.
2. Runs with recurring seeds are cut from their documents and dealt by seed to
   automaton shards.  A shard confirms the recurring windows by their words,
   compiles them into an Aho-Corasick automaton and streams its runs through
   it, which locates every occurrence.
3. Occurrences go back to their documents as word spans.

A seed that a great many runs share does not meet in one task: its windows are
counted by Spark (equal ones combine before the shuffle) and its runs are dealt
over salted shards.  Few confirmed windows (a passage that is copied often) are
given to every salt, and each run goes to one of them.  Many (a phrase amid ever
different words) are dealt by their own hash, and a run goes to the salts of
its windows.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint, partitions, small_batches
from logsift.llm.words import NON_SPACE, cut_rows, gram_hashes, text_bytes, word_hashes, word_spans

SEED_WORDS = 8
#: Runs of one seed that a single shard takes; beyond it the seed is salted.
HOT_SEED = 5_000
#: Windows held at a time, but for one seed and salt, which is held whole; and
#: phrases of one automaton at most.
BLOCK_WINDOWS = 40_000
BLOCK_PHRASES = 20_000
#: A run is its first word and its number of windows in so many bits.
COUNT_BITS = 16
_COUNT = (1 << COUNT_BITS) - 1


def seed_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, window: int,
              seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with the same seed occurrence: row, seed hash, first
    window (word in the row), number of windows, place of the seed in the run."""
    none = np.zeros(0, np.int64)
    if len(starts) < window:
        return none, none.view(np.uint64), none, none
    least = gram_hashes(word_hashes(data, starts, ends), seed)
    place = np.arange(len(least))
    span, need = 1, window - seed + 1

    def join(step: int) -> None:  # the least of two overlapping spans, the last one of equals
        nonlocal least, place
        a, b = least[: len(least) - step], least[step:]
        right = b <= a
        least, place = np.where(right, b, a), np.where(right, place[step:], place[: len(right)])

    while span * 2 <= need:
        join(span)
        span *= 2
    if need > span:
        join(need - span)
    sizes = np.diff(bounds)
    own = np.maximum(sizes - window + 1, 0)  # windows of each row
    row = np.repeat(np.arange(len(sizes)), own)
    first = np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
    at = first + bounds[row]
    if not len(at):
        return none, none.view(np.uint64), none, none
    value, where = least[at], place[at]
    new = np.ones(len(at), bool)
    new[1:] = (where[1:] != where[:-1]) | (row[1:] != row[:-1])
    head = np.flatnonzero(new)
    count = np.diff(np.append(head, len(at)))
    return row[head], value[head], first[head], count


def _docs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by identity of id and text, so that repeated ids cannot mix."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def _runs(src: DataFrame, window: int, seed: int) -> DataFrame:
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, bounds = word_spans(data, offsets, NON_SPACE)
            row, value, first, count = seed_runs(data, starts, ends, bounds, window, seed)
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("th").take(rows), pa.array(value.view(np.int64)),
                 pa.array(first << COUNT_BITS | count)], names=["doc_id", "th", "seed", "run"])

    return src.mapInArrow(run, f"doc_id {kind}, th long, seed long, run long")


def _cut(flagged: DataFrame, window: int) -> DataFrame:
    """The text of each flagged run, from its document's row."""
    kind = flagged.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            starts, ends, bounds = word_spans(data, offsets, NON_SPACE)
            runs = batch.column("runs")
            row = np.repeat(np.arange(len(batch)), np.diff(runs.offsets.to_numpy()))
            parts = runs.flatten()
            packed = parts.field("run").to_numpy(zero_copy_only=False)
            a = bounds[row] + (packed >> COUNT_BITS)
            b = a + (packed & _COUNT) + window - 2
            raw = data.tobytes()
            words = [raw[x:y] for x, y in zip(starts[a].tolist(), ends[b].tolist())]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("th").take(rows), parts.field("seed"), parts.field("hot"), parts.field("run"),
                 pa.array(words, pa.binary())], names=["doc_id", "th", "seed", "hot", "run", "words"])

    return flagged.mapInArrow(run, f"doc_id {kind}, th long, seed long, hot long, run long, words binary")


def _windows(regions: DataFrame, window: int) -> DataFrame:
    """Windows of the runs of hot seeds with their counts, added up in each
    task before they are shuffled."""
    def rows(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([s for s, _ in counts], pa.int64()), pa.array([w for _, w in counts], pa.binary()),
                                           pa.array(list(counts.values()), pa.int64())], names=["seed", "words", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for seed, packed, words in zip(batch.column("seed").to_pylist(), batch.column("run").to_pylist(), batch.column("words").to_pylist()):
                w = words.split()
                counts.update([(seed, b" ".join(w[k : k + window])) for k in range(packed & _COUNT)])
                if len(counts) > 50_000:
                    yield rows(counts)
                    counts = Counter()
        yield rows(counts)

    return regions.select("seed", "run", "words").mapInArrow(run, "seed long, words binary, n long")


def _salt(words: bytes, salts: int) -> int:
    """Salt of a window that is dealt by its own hash."""
    return 1 + xxhash.xxh3_64_intdigest(words) % salts


def _deal_known(known: DataFrame) -> DataFrame:
    """Confirmed windows of hot seeds to their salts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed, salt, words = [], [], []
            for s, w, salts, spread in zip(*(batch.column(c).to_pylist() for c in ("seed", "words", "salts", "spread"))):
                own = [_salt(w, salts)] if spread else range(1, salts + 1)
                seed += [s] * len(own)
                salt += own
                words += [w] * len(own)
                if len(seed) > 2000:
                    yield rows(seed, salt, words)
                    seed, salt, words = [], [], []
            yield rows(seed, salt, words)

    def rows(seed: list[int], salt: list[int], words: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(seed, pa.int64()), pa.array(salt, pa.int64()), pa.array(words, pa.binary())], names=["seed", "salt", "words"])

    return known.mapInArrow(run, "seed long, salt long, words binary")


def _deal_runs(regions: DataFrame, window: int) -> DataFrame:
    """Runs of hot seeds to the salts of their windows."""
    kind = regions.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "th", "seed", "salt", "run", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, salt = [], []
            for k, (packed, words, salts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("run", "words", "salts")))):
                w = words.split()
                own = {_salt(b" ".join(w[j : j + window]), salts) for j in range(packed & _COUNT)}
                row += [k] * len(own)
                salt += own
            part = batch.select(["doc_id", "th", "seed", "run", "words"]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(salt, pa.int64()), *part.columns[3:]], names=names)

    return regions.select("doc_id", "th", "seed", "run", "words", "salts").mapInArrow(
        run, f"doc_id {kind}, th long, seed long, salt long, run long, words binary")


def _automaton(phrases: list[bytes], words: int, kind: str) -> tuple[ahocorasick.Automaton, np.ndarray]:
    """An automaton of phrases, given as word numbers under ``words``: each word
    in one is a letter, all others are letter 0, which is in none."""
    used = np.unique(np.frombuffer(b"".join(phrases), kind))
    letter = np.zeros(words, "<u4")
    letter[used] = np.arange(1, len(used) + 1)
    letter[letter >= 0xD800] += 0x800  # no surrogates
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in phrases:
        automaton.add_word(_letters(letter, p, kind))
    automaton.make_automaton()
    return automaton, letter


def _letters(letter: np.ndarray, numbers: bytes, kind: str) -> str:
    return letter[np.frombuffer(numbers, kind)].tobytes().decode("utf-32-le")


def occurrences(phrases: set[bytes], numbers: bytes, texts: list[tuple[int, int]], words: int, window: int, kind: str = "<u4",
                block: int = BLOCK_PHRASES) -> dict[int, list[int]]:
    """Starts (in order) of every phrase in every text, by one automaton per
    ``block`` phrases.  A text is a ``(start, end)`` in ``numbers``, and these
    and the phrases are word numbers under ``words`` as bytes of the numpy type
    ``kind``."""
    out: dict[int, list[int]] = {}
    every = sorted(phrases)
    for first in range(0, len(every), block):
        automaton, letter = _automaton(every[first : first + block], words, kind)
        whole = _letters(letter, numbers, kind)
        for k, (a, b) in enumerate(texts):
            found = [e - window + 1 for e, _ in automaton.iter(whole[a:b])]  # the automaton copies the text it is given
            if found:
                out.setdefault(k, []).extend(found)
    return out if len(every) <= block else {k: sorted(v) for k, v in out.items()}


class _Numbers(dict):
    """Numbers of words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _locate(shards: DataFrame, window: int, block: int) -> DataFrame:
    kind = shards.schema["doc_id"].dataType.simpleString()

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        number = _Numbers()
        known: dict[int, set[bytes]] = {}
        texts, owners, counts = [], [], Counter()
        flat, ends = array("I"), []
        for row in rows:
            flat.extend(map(number.__getitem__, row[6].split()))
            ends.append(len(flat))
        kind, unit = ("<u2", 2) if len(number) < 1 << 16 else ("<u4", 4)
        data, at, size = np.frombuffer(flat, "<u4").astype(kind).tobytes(), 0, unit * window
        del flat
        for row, end in zip(rows, ends):
            start, at = at, end
            if row[4] == 0:
                known.setdefault(row[2], set()).add(data[unit * start : unit * end])
                continue
            texts.append((start, end))
            owners.append(row)
            if not row[3]:  # the windows of a salted seed were confirmed before
                start *= unit
                counts.update([data[k : k + size] for k in range(start, start + unit * (row[5] & _COUNT), unit)])
        phrases = {p for p, n in counts.items() if n > 1}.union(*known.values())
        del counts
        ids, hashes, spans = [], [], []
        for k, at in occurrences(phrases, data, texts, len(number), window, kind).items():
            first = owners[k][5] >> COUNT_BITS
            merged: list[list[int]] = []
            for s in at:
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = s + window
                else:
                    merged.append([s, s + window])
            for s, e in merged:
                ids.append(owners[k][0])
                hashes.append(owners[k][1])
                spans.append((first + s) << 32 | (first + e))
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type[0]), pa.array(hashes, pa.int64()), pa.array(spans, pa.int64())],
                                          names=["doc_id", "th", "span"])

    id_type: list[pa.DataType] = [pa.null()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        windows = 0
        for batch in batches:
            id_type[0] = batch.schema.field("doc_id").type
            longs = (batch.column(c).to_numpy().tolist() for c in ("th", "seed", "salt", "kind", "run"))
            for r in zip(batch.column("doc_id").to_pylist(), *longs, batch.column("words").to_pylist()):
                if windows >= block and r[2:4] != held[-1][2:4]:
                    yield solve(held)
                    held, windows = [], 0
                held.append(r)
                windows += (r[5] & _COUNT) if r[4] else 1
        if held:
            yield solve(held)

    return shards.select("doc_id", "th", "seed", "salt", "kind", "run", "words").mapInArrow(run, f"doc_id {kind}, th long, span long")


def dedup(docs: DataFrame, window: int = 35, seed: int = SEED_WORDS, hot_seed: int = HOT_SEED, block: int = BLOCK_WINDOWS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (merged
    ``[start, end)`` word spans that are removed), ``kept`` (the other
    words joined by one space) and ``text_hash`` (``xxhash64`` of the text,
    which tells rows with one id apart).

    A word goes if a window of ``window`` words around it starts anywhere else
    too, in the same text or another row's; so every copy goes.  Null or empty
    text and texts shorter than a window lose nothing.  Repeated rows are
    copies of each other; empty tables give no rows; other columns are ignored.
    ``window`` is at least ``seed`` and less than 65,536.
    """
    if not seed <= window <= _COUNT:
        raise ValueError(f"window must be between {seed} and {_COUNT}")
    n = partitions(small_batches(docs.sparkSession))
    src = _docs(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    # written, so that both sides of the join below are plain exchanges and the
    # adaptive skew join splits the runs of a hot seed
    recurring = checkpoint(_runs(src, window, seed).groupBy("seed").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("run").bitwiseAND(F.lit(_COUNT))).alias("windows")).filter("n > 1"))
    hot = F.when(F.col("n") > hot_seed, F.ceil(F.col("n") / hot_seed)).otherwise(F.lit(0)).cast("long")
    # written, as seven branches of the plan below begin with it
    flagged = checkpoint(_runs(src, window, seed).join(recurring, "seed").groupBy("doc_id", "th")
                         .agg(F.collect_set(F.struct("run", "seed", hot.alias("hot"))).alias("runs"))).alias("f")
    s = src.alias("s")
    mine = s.join(flagged, F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("s.th") == F.col("f.th"))).select("s.doc_id", "s.th", "s.text", "f.runs")
    # cut apart, so that no pass takes up the runs of the other kind
    kinds = lambda test: mine.withColumn("runs", F.filter("runs", test)).filter(F.size("runs") > 0)
    cold_regions = _cut(kinds(lambda r: r["hot"] == 0), window)
    hot_regions = _cut(kinds(lambda r: r["hot"] > 0), window)
    hot_windows = _windows(hot_regions, window).groupBy("seed", "words").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    # one row per hot seed that has a confirmed window: its salts, and which way of
    # dealing makes fewer rows: confirmed windows to all salts, or runs to theirs
    runs = recurring.select("seed", hot.alias("salts"), "n", "windows")
    dealing = hot_windows.groupBy("seed").agg(F.count(F.lit(1)).alias("d")).join(runs, "seed").select(
        "seed", F.greatest("salts", F.ceil(F.col("d") / block)).alias("salts"), (F.col("d") * F.col("salts") > F.least("windows", F.col("n") * F.col("salts"))).alias("spread"))
    known = _deal_known(hot_windows.join(dealing, "seed").select("seed", "words", "salts", "spread")).select(
        F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("th"), "seed", "salt", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("run"), "words")
    order = ["doc_id", "th", "seed", "salt", "kind", "run", "words"]
    hot_runs = hot_regions.drop("hot").join(dealing, "seed")
    one = F.when(F.col("salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("doc_id", "th", "run"), "salts") + 1)  # depends on nothing but the row
    whole = cold_regions.drop("hot").withColumn("salts", F.lit(None).cast("long")).unionByName(hot_runs.filter("not spread").drop("spread")).withColumn("salt", one.cast("long"))
    dealt = whole.drop("salts").unionByName(_deal_runs(hot_runs.filter("spread"), window)).withColumn("kind", F.lit(1))
    shards = known.unionByName(dealt.select(order)).repartition(n, "seed", "salt").sortWithinPartitions("seed", "salt", "kind")
    spans = _locate(shards, window, block).groupBy("doc_id", "th").agg(F.collect_set("span").alias("spans")).alias("p")
    whole = s.join(spans, F.col("s.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("s.th") == F.col("p.th")), "left").select("s.doc_id", "s.th", "s.text", "p.spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in cut_rows(batches, "text"):
            total, gone, merged, kept = [], [], [], []
            for text, own in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = text.encode().split()
                union: list[dict] = []
                for x in sorted(own or ()):
                    a, b = x >> 32, x & 0xFFFFFFFF
                    if union and a <= union[-1]["end"]:
                        union[-1]["end"] = max(union[-1]["end"], b)
                    else:
                        union.append({"start": a, "end": b})
                left, at = [], 0
                for u in union:
                    left += words[at : u["start"]]
                    at = u["end"]
                left += words[at:]
                total.append(len(words))
                gone.append(len(words) - len(left))
                merged.append(union)
                kept.append(b" ".join(left).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.string()),
                 batch.column("th")], names=["doc_id", "n_words", "n_removed", "spans", "kept", "text_hash"])

    return whole.mapInArrow(keep, f"doc_id {kind}, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string, text_hash long")
