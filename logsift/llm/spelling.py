"""Spelling variants by Bloom-guided edit neighbourhoods.

Words are counted in Spark.  Each word's edits are made by its task and probed
in blocked Bloom filters of the vocabulary, one shard or more per word length;
only the edits that the filters let through are shuffled, to a join with the
exact vocabulary that removes the false ones.  Nearness is symmetric, so it is
enough to make each word's deletions (an insertion is the deletion seen from
the longer word) and its replacements by a larger character.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint, partitions
from logsift.llm.words import U64, mix

#: Fixed value: characters of a word.
WORD = r"[A-Za-zÀ-ÿ]+"
NOT_WORD = r"[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of one filter shard at most on average, bits of a filter per word,
#: bits set per word, bits of a block, and blocks that one group fills.
SHARD_WORDS, BITS, SET, BLOCK, PIECE = 1 << 19, 16, 6, 512, 64

#: Bytes of filters broadcast at once; more filters take more rounds.
ROUND_BYTES = 32 << 20

_BASE = U64(0xD1342543DE82EF95)
_CHAR = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15))


def _crc(run: Column, key: Column) -> Column:
    return F.crc32(F.concat(key, F.lit(":"), run).cast("binary"))


def loses_one(run: Column, key: Column) -> Column:
    """The planted misspellings: 199 divides the crc32 of ``key:run``."""
    return _crc(run, key) % 199 == 0


def altered(run: Column, key: Column) -> Column:
    """``run``, less one character if it is a planted misspelling."""
    at = (_crc(run, key) % F.greatest(F.length(run), F.lit(1))).cast("int")
    return F.when(loses_one(run, key), F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """``word``, ``n`` of the words of all documents: runs of letters with A-Z
    lower-cased and altered, of at least ``min_chars`` characters and
    ``min_count`` occurrences.  A null id counts as empty text."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.split(F.translate(F.col(text_col), UPPER, LOWER), NOT_WORD)).alias("run"))
    size = F.length("run")  # only a run of exactly min_chars can become too short
    words = (runs.filter((size > min_chars) | (size == min_chars) & ~loses_one(F.col("run"), F.col("id")))
             .select(altered(F.col("run"), F.col("id")).alias("word")))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


# ---------------------------------------------------------------- hashes

def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    for k in range(1, n):
        out[k] = out[k - 1] * _BASE
    return out


def word_hash(chars: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of one length, given as rows of bytes."""
    with np.errstate(over="ignore"):
        return mix((_CHAR[chars] * _powers(chars.shape[1])).sum(axis=1, dtype=np.uint64))


def deletions(chars: np.ndarray) -> np.ndarray:
    """Hash of every deletion: ``rows x length``."""
    n = chars.shape[1]
    with np.errstate(over="ignore"):
        power = _powers(n)
        terms = _CHAR[chars]
        before = np.zeros((len(chars), n), np.uint64)
        np.cumsum((terms * power)[:, :-1], axis=1, out=before[:, 1:])
        moved = np.zeros_like(before)  # characters right of the place, one place to the left
        moved[:, :-1] = np.cumsum((terms[:, 1:] * power[:-1])[:, ::-1], axis=1)[:, ::-1]
        return mix(before + moved)


def replacements(chars: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Hash of every replacement: ``rows x length x alphabet``."""
    with np.errstate(over="ignore"):
        power = _powers(chars.shape[1])
        terms = _CHAR[chars] * power
        rest = terms.sum(axis=1, dtype=np.uint64)[:, None] - terms
        return mix(rest[:, :, None] + _CHAR[alphabet][None, None, :] * power[None, :, None])


# ---------------------------------------------------------------- filters

def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> U64(48)) % U64(shards)


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    return (h & U64(0xFFFFFFFF)) % U64(blocks)


def _again(h: np.ndarray) -> np.ndarray:
    return mix(h ^ U64(0x5851F42D4C957F2D))


def fill(h: np.ndarray, block: np.ndarray, blocks: int) -> np.ndarray:
    """The bytes of ``blocks`` blocks with the bits of all hashes set; a
    hash's bits all lie in its block."""
    out = np.zeros(blocks * BLOCK // 8, np.uint8)
    again = _again(h)
    for k in range(SET):
        bit = block * U64(BLOCK) + (again >> U64(9 * k) & U64(BLOCK - 1))
        np.bitwise_or.at(out, (bit >> U64(3)).astype(np.int64), np.uint8(1) << (bit & U64(7)).astype(np.uint8))
    return out


def probe(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places in ``h`` of the hashes that may be in the filter.  Those that
    miss a bit are left out before the next one is looked at."""
    at, again = np.arange(len(h)), _again(h)
    base = block_of(h, len(table) * 8 // BLOCK) * U64(BLOCK)
    for k in range(SET):
        bit = base + (again >> U64(9 * k) & U64(BLOCK - 1))
        hit = table[(bit >> U64(3)).astype(np.int64)] >> (bit & U64(7)).astype(np.uint8) & 1 == 1
        at, again, base = at[hit], again[hit], base[hit]
    return at


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and characters of a column's words, length by length."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    size = np.array([len(w) for w in words], np.int64)
    for n in np.unique(size):
        rows = np.flatnonzero(size == n)
        yield rows, np.frombuffer(b"".join(words[r] for r in rows), np.uint8).reshape(len(rows), n)


def _filters(sizes: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """``(length, shard, shards, blocks)`` of every filter: as many shards of a
    length as keep one near ``SHARD_WORDS`` words."""
    out = []
    for length, words in sorted(sizes.items()):
        shards = -(-words // SHARD_WORDS)
        blocks = max(1, math.ceil(words / shards * BITS / BLOCK))
        out += [(length, s, shards, blocks) for s in range(shards)]
    return out


def _rounds(filters: list[tuple[int, int, int, int]]) -> list[list[tuple[int, int, int, int]]]:
    out, room = [[]], ROUND_BYTES
    for f in filters:
        size = f[3] * BLOCK // 8
        if out[-1] and size > room:
            out.append([])
            room = ROUND_BYTES
        out[-1].append(f)
        room -= size
    return [r for r in out if r]


def _made(vocab: DataFrame, filters: list[tuple[int, int, int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The filters of one round, filled by Spark in pieces of ``PIECE`` blocks
    (some 2,000 words each, so no length of words is one task's): at most
    ``ROUND_BYTES`` together, or one filter."""
    shape = {(length, s): blocks for length, s, _, blocks in filters}
    many = {length: shards for length, _, shards, _ in filters}

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chars in _by_length(batch.column("word")):
                length = chars.shape[1]
                h = word_hash(chars)
                shard = shard_of(h, many.get(length, 1))
                for s in np.unique(shard).tolist():
                    blocks = shape.get((length, s))
                    if blocks:
                        own = h[shard == s]
                        at = block_of(own, blocks)
                        key = np.full(len(own), length << 32 | s, np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array((at // U64(PIECE)).astype(np.int64)), pa.array((at % U64(PIECE)).astype(np.int64)),
                                                          pa.array(own.view(np.int64))], names=["filter", "piece", "block", "h"])

    def build(key: tuple[pa.Scalar, ...], words: pa.Table) -> pa.Table:
        bits = fill(words.column("h").to_numpy().view(np.uint64), words.column("block").to_numpy().astype(np.uint64), PIECE)
        return pa.table({"filter": [key[0].as_py()], "piece": [key[1].as_py()], "bits": pa.array([bits.tobytes()], pa.binary())})

    marked = vocab.select("word").mapInArrow(mark, "filter long, piece long, block long, h long")
    size = BLOCK // 8
    out = {k: np.zeros(-(-blocks // PIECE) * PIECE * size, np.uint8) for k, blocks in shape.items()}
    for r in marked.groupBy("filter", "piece").applyInArrow(build, "filter long, piece long, bits binary").collect():
        out[r["filter"] >> 32, r["filter"] & 0xFFFFFFFF][r["piece"] * PIECE * size :][: PIECE * size] = np.frombuffer(r["bits"], np.uint8)
    return {k: table[: shape[k] * size] for k, table in out.items()}


def candidates(vocab: DataFrame, alphabet: list[int], filters: dict[tuple[int, int], np.ndarray], shards: dict[int, int], rows: int = 256) -> DataFrame:
    """``word``, ``n``, ``other``: the edits of each word that the broadcast
    filters let through, deletions and replacements by a larger character."""
    shared = vocab.sparkSession.sparkContext.broadcast((filters, shards))
    letters = np.array(alphabet, np.uint8)

    def passed(h: np.ndarray, length: int) -> np.ndarray:
        held, many = shared.value
        shard = shard_of(h, many.get(length, 1))
        found = [np.flatnonzero(shard == s)[probe(table, h[shard == s])] for (n, s), table in held.items() if n == length]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                who: list[np.ndarray] = []
                others: list[str] = []
                for own, chars in _by_length(part.column("word")):
                    length = chars.shape[1]
                    new = np.ones(chars.shape, bool)  # the same deletion again, in a run of one character
                    new[:, 1:] = chars[:, 1:] != chars[:, :-1]
                    new = np.flatnonzero(new.ravel())
                    row, place = np.divmod(new[passed(deletions(chars).ravel()[new], length - 1)], length)
                    for r, p in zip(row.tolist(), place.tolist()):
                        w = chars[r].tobytes()
                        others.append((w[:p] + w[p + 1 :]).decode("latin-1"))
                        who.append(own[r])
                    h = replacements(chars, letters)
                    larger = np.flatnonzero((letters[None, None, :] > chars[:, :, None]).ravel())
                    hit = larger[passed(h.ravel()[larger], length)]
                    row, rest = np.divmod(hit, length * len(letters))
                    place, letter = np.divmod(rest, len(letters))
                    for r, p, c in zip(row.tolist(), place.tolist(), letters[letter].tolist()):
                        w = chars[r].tobytes()
                        others.append((w[:p] + bytes([c]) + w[p + 1 :]).decode("latin-1"))
                        who.append(own[r])
                at = pa.array(np.array(who, np.int64))
                yield pa.RecordBatch.from_arrays([part.column("word").take(at), part.column("n").take(at), pa.array(others, pa.string())],
                                                 names=["word", "n", "other"])

    return vocab.select("word", "n").mapInArrow(run, "word string, n long, other string")


def near_pairs(vocab: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: every pair of vocabulary words
    that differ by one inserted, deleted or replaced character, both ways."""
    sizes = {r["length"]: r["words"] for r in vocab.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("words")).collect()}
    letters = [ord(r["c"]) for r in vocab.select(F.explode(F.split("word", "")).alias("c")).filter("c != ''").distinct().collect()]  # <= 256
    filters = _filters(sizes)
    shards = {length: many for length, _, many, _ in filters}
    known = vocab.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = vocab.select("word", "n", F.col("word").alias("other"), F.col("n").alias("other_n")).limit(0)
    for chosen in _rounds(filters):
        pairs = pairs.unionByName(candidates(vocab, sorted(letters), _made(vocab, chosen), shards).join(known, "other").select("word", "n", "other", "other_n"))
    pairs = checkpoint(pairs)
    back = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.withColumnsRenamed({"other": "near", "other_n": "near_n"}).unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root`` of the words that have a form.  A chain's counts grow
    by the ratio at each step, so it ends, and doubling follows it in a few
    joins of the words that are still on their way."""
    step = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        on = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = checkpoint(step.join(on, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if step.filter("_moved").isEmpty():
            return step.select("word", "root")
        step = step.drop("_moved")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5, ratio: int = 5) -> DataFrame:
    """Per word of ``docs``: ``word``, ``form`` (the near word with the largest
    ``n``, ties by code points, if that is at least ``ratio`` times the word's),
    ``root`` (the end of the chain of forms), ``n``, ``n_near``, ``form_n``.

    Null texts hold no words and a null id counts as empty text; repeated rows
    count as often as they occur; a table without words gives no rows; other
    columns of ``docs`` are ignored.
    """
    spark = docs.sparkSession
    vocab = checkpoint(word_counts(docs, id_col, text_col, min_chars, min_count).repartition(partitions(spark), "word"))
    best = near_pairs(vocab).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                                 F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    judged = checkpoint(
        vocab.join(best, "word", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.near").alias("_near"), (-F.col("best.k")).alias("_n"))
        .select("word", "n", "n_near", *(F.when(F.col("_n") >= ratio * F.col("n"), F.col(c)).alias(a) for c, a in (("_near", "form"), ("_n", "form_n")))))
    return (judged.join(roots(judged.filter("form is not null")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
