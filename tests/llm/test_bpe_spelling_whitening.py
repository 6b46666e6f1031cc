"""Byte-level BPE against tiktoken and plain merging, spelling variants against
brute force, whitening against a full eigendecomposition."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from logsift.llm import bpe, spelling, whitening
from logsift.llm.common import table
from logsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def rows_of(df, *cols):
    return sorted(tuple(map(str, r)) for r in df.select(*cols).collect())


# ---------------------------------------------------------------- byte-level BPE

@pytest.fixture(scope="module")
def reference():
    import tiktoken

    return tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}).encode_ordinary


def test_encoder_equals_tiktoken_on_random_strings(reference):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    rnd = random.Random(3)
    letters = "etaoinshrdlu" * 3 + "éàüßñ' \n\t\x1c\x85 019.,=-_日本語русский🎉À²½①<|>"
    for _ in range(4000):
        some = rnd.sample(letters, rnd.choice([1, 2, 3, 30]))
        text = "".join(rnd.choice(some) for _ in range(rnd.randrange(120)))
        assert np.frombuffer(encoder(text), "<i4").tolist() == reference(text)


def test_encoder_takes_linear_time_and_steps_back():
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    rnd = random.Random(4)
    for text in ("a" * 300_000, "".join(rnd.choice("ab") for _ in range(300_000)), "=-" * 100_000):
        ids = np.frombuffer(encoder(text), "<i4")
        assert b"".join(encoder.tokens[i] for i in ids) == text.encode()


def test_small_vocabulary_equals_plain_merging():
    """A vocabulary whose longest match is often wrong."""
    extra = [b"ab", b"abc", b"bc", b"cd", b"abcd", b"dd", b"ddd", b"abcda", b"cda", b"aa", b"aaa", b"aab"]
    merges, rank = [bytes([b]) for b in range(256)], {}

    def merged(data):
        parts = [data[k : k + 1] for k in range(len(data))]
        while True:
            found = [(rank[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in rank]
            if not found:
                return [rank[p] for p in parts]
            k = min(found)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]

    rank.update({t: i for i, t in enumerate(merges)})
    for t in extra:
        if len(merged(t)) == 2:  # made by one merge of the tokens so far
            rank[t] = len(rank)
    encoder = bpe.Encoder(bpe.Vocabulary(rank), r"[^ ]+| +")
    rnd = random.Random(5)
    for _ in range(5000):
        text = "".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 30)))
        assert np.frombuffer(encoder(text), "<i4").tolist() == merged(text.encode())


def test_vocabulary_that_is_not_made_by_merges_is_refused():
    rank = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError):
        bpe.Vocabulary(rank | {b"abc": 256})
    with pytest.raises(ValueError):
        bpe.Vocabulary({k: v + 1 for k, v in rank.items()})


def test_encode_and_decode_odd_rows(spark, reference):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "é 日本\n\n x"), (4, "long text 123 " * 40_000), (5, "<|endoftext|>")]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in rows], "doc_id long, text string, ids int, decoded string")
    for own, want in ((docs, rows), (docs.limit(0), [])):
        encoded = bpe.encode(own, RANKS, public_tokenizers.PATTERN)
        got = bpe.decode(encoded.withColumn("decoded", F.lit(1)), RANKS).collect()
        assert sorted((str(r.doc_id), r.ids, bytes(r.decoded)) for r in got) == sorted((str(i), reference(t or ""), (t or "").encode()) for i, t in want)
    assert bpe.decode(spark.createDataFrame([(1, None)], "doc_id long, ids array<int>"), RANKS).first().decoded == b""


def test_op11_on_the_small_table(spark, reference):
    got = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = reference(d.text or ""), got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()


# ---------------------------------------------------------------- spelling variants

def brute_words(rows, min_chars=6, min_count=5):
    seen = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= min_chars:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= min_count}


def brute_group(words, ratio=5):
    alphabet = sorted({c for w in words for c in w})
    form, near = {}, {}
    for w in words:
        edits = {w[:k] + w[k + 1 :] for k in range(len(w))}
        edits |= {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in alphabet}
        edits |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in alphabet}
        near[w] = sorted((x for x in edits if x in words and x != w), key=lambda x: (-words[x], x))
        form[w] = near[w][0] if near[w] and words[near[w][0]] >= ratio * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(tuple(map(str, r)) for r in out)


COLS = ("word", "form", "root", "n", "n_near", "form_n")


def test_spelling_variants_of_the_small_table(spark):
    docs = table(spark, SF, "documents")
    words = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    assert rows_of(QUERIES["op12_spelling_variants"](spark, SF), *COLS) == brute_group(words)


def test_spelling_variants_of_odd_rows(spark, monkeypatch):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcéÿÀ×") for _ in range(rnd.randrange(1, 6))) for _ in range(400)] + ["aaaa", "aaa", "aaaaa", "abab", "baba"]
    chain = ["zzzzzzz", "zzzzzz", "zzzzz", "zzzz"]
    rows = [(rnd.choice([None, *range(50)]), " ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) + rnd.choice([".", "\n", "·"])) for _ in range(300)]
    rows += [(900 + k, " ".join([w] * 6**k)) for k, w in enumerate(chain)] + [(7, None), (8, ""), (9, "Aaaaa AAAAA")] * 2
    docs = spark.createDataFrame([(i, t, "w", 1, 2) for i, t in rows], "doc_id long, text string, word string, n int, id int")
    counted = brute_words(rows, 2, 2)
    # one filter for all words; many small filters, one a round
    for shard, once in ((spelling.SHARD_WORDS, spelling.ROUND_BYTES), (100, 300)):
        monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
        monkeypatch.setattr(spelling, "ROUND_BYTES", once)
        assert rows_of(spelling.group(docs, min_chars=2, min_count=2), *COLS) == brute_group(counted)
    assert spelling.group(docs.limit(0)).count() == 0
    assert "zzzz" == {r.word: r.root for r in spelling.group(docs, min_chars=2, min_count=1).collect()}["zzzzzzz"]


def test_bloom_filters_miss_no_word_and_let_few_others_through():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    blocks = 20_000 * spelling.BITS // spelling.BLOCK
    bits = spelling.fill(h, spelling.block_of(h, blocks), blocks)
    assert len(spelling.probe(bits, h)) == len(h)
    assert len(spelling.probe(bits, rnd.integers(0, 1 << 63, 100_000, dtype=np.uint64))) < 1000


def test_edit_hashes_are_the_hashes_of_the_edits():
    words = np.frombuffer("abcdefgaabbccd".encode(), np.uint8).reshape(2, 7)
    letters = np.frombuffer(b"axz", np.uint8)
    gone, put = spelling.deletions(words), spelling.replacements(words, letters)
    for r in range(2):
        for k in range(7):
            assert gone[r, k] == spelling.word_hash(np.delete(words[r], k)[None, :])[0]
            for j, c in enumerate(letters):
                other = words[r].copy()
                other[k] = c
                assert put[r, k, j] == spelling.word_hash(other[None, :])[0]


# ---------------------------------------------------------------- whitening

def brute_whiten(vectors, wanted=32):
    x = np.floor(np.array(vectors, np.float64) * 64).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    apart = (x * n - total) / n
    value, vector = np.linalg.eigh(apart.T @ apart / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(wanted, int((value > 1e-12 * value[0]).sum()))
    return np.square(x * n - total).sum(axis=1), apart @ vector[:, :k] / np.sqrt(value[:k]), value[:k] / value.sum()


def check_whitened(got, ids, vectors, wanted=32):
    deviation, white, explained = brute_whiten(vectors, wanted)
    out = got.toPandas()
    assert len(out) == white.size and set(out["n"]) <= {len(ids)}
    grid = out.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((grid * white).sum(axis=0))
    assert np.abs(grid * sign - white).max() < 1e-8
    first = out[out["component"] == 1].set_index("vec_id").loc[ids]
    assert first["deviation"].tolist() == deviation.tolist()
    assert np.allclose(out.groupby("component")["explained"].first(), explained, rtol=1e-10)
    assert out["identity_error"].nunique() == 1 and out["identity_error"][0] < 1e-10


def test_op13_on_the_small_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    check_whitened(QUERIES["op13_embedding_whitening"](spark, SF), [i for i, _ in rows], [v for _, v in rows])


def test_whitening_of_odd_rows(spark):
    rnd = np.random.default_rng(2)
    good = [(k, (rnd.standard_normal(5) * [9, 3, 3, 1, 0]).tolist()) for k in range(200)]
    good += [(1000 + k, good[0][1]) for k in range(150)]  # a vector that many rows hold
    bad = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 5), (2003, [float("inf")] * 5), (2004, []), (2005, [1.0])]
    schema = "vec_id long, embedding array<double>, n int, x string, component string"
    rows = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in good + bad], schema)
    check_whitened(whitening.whiten(rows), [i for i, _ in good], [v for _, v in good])  # a constant dimension: four components
    check_whitened(whitening.whiten(rows, wanted=2), [i for i, _ in good], [v for _, v in good], wanted=2)
    assert whitening.whiten(rows.limit(0)).count() == 0
    assert whitening.whiten(rows.filter("vec_id >= 2000")).count() == 0
    assert whitening.whiten(rows.filter("vec_id >= 1000 and vec_id < 2000")).count() == 0  # equal vectors
    assert whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (None, [3.0, 2.0]), (None, [3.0, 2.0])], "vec_id long, embedding array<float>")).count() == 3


def test_filters_find_the_components_of_flat_and_steep_spectra():
    rnd = np.random.default_rng(6)
    turn = np.linalg.qr(rnd.standard_normal((120, 120)))[0]
    for spectrum in (np.linspace(2, 1, 120), np.geomspace(1e6, 1e-3, 120), np.r_[np.ones(5) * 4, np.zeros(115)], np.ones(120)):
        v = turn * spectrum @ turn.T
        value, vector = whitening.components(lambda q: v @ q, 120, 32)
        real = min(32, int((spectrum > 1e-12 * spectrum[0]).sum()))
        assert len(value) <= 32 and np.allclose(value, spectrum[: len(value)], rtol=1e-9, atol=1e-10 * spectrum[0]) and len(value) >= min(real, 5)
        assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-12
        assert np.abs(v @ vector - vector * value).max() < 1e-11 * spectrum[0]
