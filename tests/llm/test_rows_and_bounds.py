"""Hot seeds, row identity in the pipeline, bounded samples, calibrated cuts,
binomial tails."""

import math
import os
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logsift.llm import jaccard_join, langid, quality_model, quality_rules, sample, substring_dedup, toxicity
from logsift.llm.common import fold, table
from logsift.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"


# ---------------------------------------------------------------- substring dedup

def brute_removed(texts, w):
    words = [t.split() for t in texts]
    seen = Counter(tuple(x[a : a + w]) for x in words for a in range(len(x) - w + 1))
    out = []
    for x in words:
        gone = {k for a in range(len(x) - w + 1) if seen[tuple(x[a : a + w])] > 1 for k in range(a, a + w)}
        out.append(len(gone))
    return out


def test_one_phrase_in_ninety_thousand_documents(spark):
    """Pairs of equal texts, all around one phrase whose hash is the least: one
    seed holds every window, in 1.2 million different words."""
    rnd = random.Random(1)
    best = min((tuple(f"p{rnd.randrange(10**6)}" for _ in range(8)) for _ in range(20)), key=lambda p: zlib.crc32(" ".join(p).encode()))
    phrase = " ".join(best)

    def text(k):
        own = [f"w{k}x{j}" for j in range(27)]
        at = k % 28
        return " ".join(own[:at] + [phrase] + own[at:])

    pdf = [(k, text(k // 2)) for k in range(90_000)]
    docs = spark.createDataFrame(pdf, "doc_id long, text string").repartition(8)
    monkey = substring_dedup.gram_hashes
    out = substring_dedup.dedup(docs).groupBy("n_words", "n_removed").count().collect()
    assert [(r.n_words, r.n_removed, r["count"]) for r in out] == [(35, 35, 90_000)] and monkey is substring_dedup.gram_hashes


@pytest.mark.parametrize("hot,block", [(5000, 40_000), (3, 4), (1, 1)])
def test_hot_seeds_dealt_both_ways_equal_brute_force(spark, monkeypatch, hot, block):
    rnd = random.Random(2)
    monkeypatch.setattr(substring_dedup, "BLOCK_PHRASES", 3)
    word = lambda: f"w{rnd.randrange(400)}"
    phrase, passage = [word() for _ in range(4)], [word() for _ in range(25)]
    texts = []
    for _ in range(120):
        kind = rnd.random()
        own = [word() for _ in range(rnd.randrange(12))] + (phrase if kind < 0.6 else passage if kind < 0.9 else []) + [word() for _ in range(rnd.randrange(12))]
        texts += [" ".join(own)] * rnd.choice([1, 1, 2])
    rows = list(enumerate(texts)) + [(500, texts[0])] * 9 + [(None, texts[1])] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.dedup(docs, window=8, seed=3, hot_seed=hot, block=block).collect()
    want = sorted((str(i), n) for (i, _), n in zip(rows, brute_removed([t for _, t in rows], 8)))
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == want


def test_long_windows_and_checked_parameters(spark):
    text = " ".join(f"a{k}" for k in range(700))
    docs = spark.createDataFrame([(1, text), (2, "x " + text), (3, " ".join(text.split()[:299]))], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substring_dedup.dedup(docs, window=300).collect()) == [(1, 700), (2, 700), (3, 0)]
    for bad in (5, 1 << 16):
        with pytest.raises(ValueError):
            substring_dedup.dedup(docs, window=bad)


# ---------------------------------------------------------------- pipeline rows

def documents(spark, rows):
    """Documents with columns whose names the stages use themselves."""
    extra = ", _id long, _kept_id long, id long, hash long, row string, row_id int, row_hash int, row_name int, kept_text int, th int"
    names = len(extra.split(",")) - 1
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), *([None] * names)) for i, t in rows], DOC + extra)


def kept(stage, spark, docs, sf=SF):
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns
    return sorted((str(r.doc_id), str(r.text)) for r in out.collect())


PROSE = " ".join(f"word{k} of{k} story{k}" for k in range(40))
ODD = [(None, None), (None, None), (1, ""), (1, " \n"), (2, None)]


def test_quality_judges_each_row(spark):
    rows = [(1, PROSE), (1, "short"), (1, PROSE), (None, PROSE + " end"), (None, "tiny"), *ODD]
    assert kept(corpus_pipeline.quality, spark, documents(spark, rows)) == sorted([("1", PROSE)] * 2 + [("None", PROSE + " end")])
    assert kept(corpus_pipeline.quality, spark, documents(spark, rows).limit(0)) == []


def test_near_duplicates_keep_one_row_of_each_group(spark):
    other = " ".join(f"other{k}" for k in range(50))
    rows = [(1, PROSE), (1, other), (1, PROSE), (2, PROSE.upper()), (3, other + " x"), (None, PROSE), (4, "alone here"), *ODD]
    docs = documents(spark, rows)
    out = kept(corpus_pipeline.near_duplicates, spark, docs)
    bare = sorted((str(i), str(t)) for i, t in ODD)
    assert [x for x in out if x in bare] == bare and len(out) == len(bare) + 3 and ("4", "alone here") in out
    assert sum(t.lower() == PROSE for _, t in out) == 1 and sum(t.startswith(other) for _, t in out) == 1
    assert kept(corpus_pipeline.near_duplicates, spark, docs.limit(0)) == []


def test_repeated_passages_leave_each_row_its_own_text(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(1, passage + " tail alpha"), (1, "own text of the other row"), (2, passage), (None, passage + " beta"), (None, "gamma"), (3, passage + " delta"), (3, passage + " delta"), *ODD]
    docs = documents(spark, rows)
    want = [("1", "tail alpha"), ("3", ""), ("3", "")] + [("1", "own text of the other row"), ("2", ""), ("None", "beta"), ("None", "gamma")] + [(str(i), str(t)) for i, t in ODD]
    assert kept(corpus_pipeline.repeated_passages, spark, docs) == sorted(want)
    out = corpus_pipeline.repeated_passages(spark, docs, SF).filter("text is not null and trim(text) <> ''").collect()
    assert all(r.n_chars == len(r.text) for r in out)
    assert kept(corpus_pipeline.repeated_passages, spark, docs.limit(0)) == []


def test_contaminated_rows_go_and_clean_ones_stay(spark):
    item = next(r.text for r in table(spark, SF, "benchmark").orderBy("item_id").collect() if len((r.text or "").split()) > 20)
    rows = [(1, item), (1, "a clean text"), (None, item), (None, "clean too"), *ODD]
    out = kept(corpus_pipeline.benchmark, spark, documents(spark, rows))
    assert out == sorted([("1", "a clean text"), ("None", "clean too")] + [(str(i), str(t)) for i, t in ODD])
    assert kept(corpus_pipeline.benchmark, spark, documents(spark, rows).limit(0)) == []


def test_packing_takes_every_row(spark):
    rows = [(1, PROSE), (1, "b"), (None, "c"), *ODD]
    out = corpus_pipeline.pack(spark, documents(spark, rows), SF).collect()
    assert Counter(str(r.doc_id) for r in out if r.piece == 0) == Counter(str(i) for i, _ in rows)
    assert corpus_pipeline.pack(spark, documents(spark, rows).limit(0), SF).count() == 0


def test_pipeline_runs_on_an_empty_table_and_on_odd_rows(spark, tmp_path):
    for k, rows in enumerate(([], [(1, PROSE), (1, PROSE + " " + PROSE), (None, None)])):
        folder = tmp_path / str(k)
        documents(spark, rows).write.parquet(f"{folder}/documents.parquet")
        for t in ("labels", "benchmark"):
            table(spark, SF, t).write.parquet(f"{folder}/{t}.parquet")
        assert corpus_pipeline.run(spark, str(folder)).count() >= 0


# ---------------------------------------------------------------- bounded samples

def test_samples_keep_their_bound_when_many_rows_share_an_id(spark):
    rows = [(1, f"text {k % 7}") for k in range(500)] + [(2, "b"), (3, "c"), (None, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (4, 1)], "doc_id long, quality int")
    out = sample.labelled(docs, labels, "quality", F.lit(True), 2).collect()
    assert len(out) <= 2
    out = {r.id: (r.text, r.y) for r in sample.labelled(docs, labels, "quality", F.lit(True), 10).collect()}
    assert out[2] == ("b", 1.0) and out[1][0].startswith("text") and set(out) == {1, 2}


def test_language_samples_are_of_every_language_whatever_the_ids(spark):
    rows = [(None, f"the quick brown fox {k} jumps", "en") for k in range(3000)] + [(None, f"der schnelle braune fuchs {k} springt", "de") for k in range(300)]
    rows += [(5, "le renard", "fr")] * 4000 + [(k, None, "xx") for k in range(3)] + [(9, "q", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    profiles = langid.train(docs, F.lit(True), max_train=200)
    assert set(profiles) == {"en", "de", "fr"}
    got = {r.doc_id: r.lang_pred for r in langid.predict(spark.createDataFrame(
        [(1, "the brown quick"), (2, "schnelle braune"), (3, "²½"), (4, "①② 12 __"), (5, None), (6, ""), (7, "renard")], "doc_id long, text string"), profiles).collect()}
    assert got == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "und", 7: "fr"}


def test_language_scores_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    profiles = langid.train(docs, fold("doc_id", 3) != 1)
    texts = {r.doc_id: r.text for r in docs.collect()}

    def brute(text):
        grams = Counter()
        lowered = (text or "").lower()
        for word in "".join(c if c.isalpha() else " " for c in lowered).split(" "):
            if word:
                s = f"_{word}_"
                grams.update(g for n in (1, 2, 3) for g in (s[k : k + n] for k in range(len(s) - n + 1)) if g != "_")
        own = sorted(grams, key=lambda g: (-grams[g], langid.number(g)))[:400]
        if not own:
            return "und", 0.0
        far = {lang: sum(abs(k - best.index(g)) if g in best else 400 for k, g in enumerate(own)) for lang, best in profiles.items()}
        lang = min(sorted(far), key=far.__getitem__)
        return lang, 1 - far[lang] / (400 * len(own))

    got = {r.doc_id: r for r in QUERIES["op10_language_id"](spark, SF).collect()}
    for i, text in list(texts.items())[:60]:
        lang, score = brute(text)
        assert got[i].lang_pred == lang and abs(got[i].score - score) < 1e-9


# ---------------------------------------------------------------- classifiers

def test_best_cut_parts_the_labels_best():
    rnd = random.Random(4)
    for _ in range(300):
        n = rnd.randrange(2, 30)
        odds = np.array([rnd.choice([-math.inf, -2.0, -1.0, 0.0, 0.5, 3.0, math.inf, rnd.uniform(-4, 4)]) for _ in range(n)])
        y = np.array([float(rnd.random() < 0.4) for _ in range(n)])
        cut = toxicity.best_cut(odds, y)
        assert math.isfinite(cut)
        if 0 < y.sum() < n:
            rate = lambda c: (odds[y > 0] >= c).mean() - (odds[y == 0] >= c).mean()
            finite = [o for o in odds if math.isfinite(o)]
            if finite:
                assert rate(cut) >= max(rate(c) for c in finite) - 1e-9


def test_toxicity_scores_equal_noisy_or_of_sentences(spark):
    docs = table(spark, SF, "documents")
    model = toxicity.train(docs, table(spark, SF, "labels"), fold("doc_id", 5) != 0)
    weight = dict(zip(model["words"], model["weights"]))
    import pyarrow as pa

    rows = docs.limit(40).collect()
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for r in rows:
        h, sentence, row, _, _ = toxicity.bags(pa.array([r.text or ""]))
        clean = 1.0
        for s in range(len(row)):
            z = model["bias"] + sum(weight.get(int(w), 0.0) for w in h[sentence == s].tolist())
            clean *= 1 - 1 / (1 + math.exp(-z))
        bag = 1 - clean
        want = 0.0 if not len(row) else 1 / (1 + math.exp(-(math.log(bag / (1 - bag)) - model["cut"]))) if 0 < bag < 1 else bag
        assert abs(got[r.doc_id] - want) < 1e-6


def test_toxicity_at_one_half_catches_most_and_spares_the_clean(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in table(spark, sf, "labels").collect() if r.toxic is not None}
    out = [(r.predicted, labels[r.doc_id]) for r in QUERIES["op6_toxicity"](spark, sf).filter("held_out").collect() if r.doc_id in labels]
    toxic, clean = [p for p, y in out if y], [p for p, y in out if not y]
    assert sum(toxic) >= 0.85 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def test_quality_scores_are_sums_of_table_entries(spark):
    docs = table(spark, SF, "documents")
    model = quality_model.train(docs, table(spark, SF, "labels"), fold("doc_id", 5) != 0)
    import pyarrow as pa

    rows = docs.limit(30).collect()
    got = {r.doc_id: r.score for r in quality_model.score(docs, model).collect()}
    x = quality_model._matrix(pa.array([r.text or "" for r in rows]))
    for r, own in zip(rows, x):
        total = model["bias"]
        for value, edges, entries in zip(own, model["edges"], model["tables"]):
            total += entries[sum(e < value for e in edges)]
        rough = [sum(e < value for e in edges) for value, edges in zip(own, model["rough"])]
        total += sum(t[rough[i]][rough[j]] for i, j, t in model["pairs"])
        assert abs(got[r.doc_id] - 1 / (1 + math.exp(-total))) < 1e-9


# ---------------------------------------------------------------- quality rules

def exact_tail(k, n, p):
    logs = [math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) + j * math.log(p) + (n - j) * math.log1p(-p) for j in range(k + 1)]
    return math.fsum(math.exp(x) for x in logs)


def test_binomial_tails(spark):
    p = 0.01
    cases = [(0, 1), (0, 100), (0, 500), (1, 500), (3, 900), (5, 1000), (9, 1000), (10, 1000), (20, 1000), (40, 6000), (60, 7000), (900, 100_000), (9700, 1_000_000), (0, 5)]
    df = spark.createDataFrame(cases, "k long, n long")
    for r in df.withColumn("t", quality_rules.binomial_tail(F.col("k"), F.col("n"), p)).collect():
        want = 1.0 if r.k >= r.n * p else exact_tail(r.k, r.n, p)
        assert r.t == pytest.approx(want, rel=1e-7)
    big = spark.createDataFrame([(9_999_000, 1_000_000_000), (9_990_000, 1_000_000_000)], "k long, n long")
    out = sorted(r.t for r in big.withColumn("t", quality_rules.binomial_tail(F.col("k"), F.col("n"), p)).collect())
    sd = math.sqrt(1e9 * p * (1 - p))
    for got, k in zip(out, (9_990_000, 9_999_000)):
        normal = 0.5 * math.erfc((1e7 - k - 0.5) / sd / math.sqrt(2))
        assert got == pytest.approx(normal, rel=0.02)


def test_quality_verdicts_equal_brute_force(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    feats = {r.doc_id: r for r in quality_rules.features(docs).collect()}
    failed = lambda r: r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
    clean = {r.doc_id for r in labels.collect() if r.quality == 1}
    strata = {r.stratum for r in feats.values() if r.doc_id in clean and not failed(r)}
    limits = {}
    for s in strata:
        held = [r for r in feats.values() if r.stratum == s and r.doc_id in clean and not failed(r)]
        for rule, (top, bottom, grid) in quality_rules.RULES.items():
            for cutoff in grid:
                lost = sum(r[top] / max(r[bottom], 1) >= cutoff for r in held)
                a = 0.05 / len(quality_rules.RULES)
                tail = 1.0 if lost >= len(held) * a else exact_tail(lost, len(held), a)
                if tail > 0.05 / (len(quality_rules.RULES) * len(strata)):
                    break
                limits[s, rule] = cutoff
    for r in quality_rules.apply_rules(docs, labels).collect():
        f = feats[r.doc_id]
        hit = [x for x, (top, bottom, _) in quality_rules.RULES.items() if (f.stratum, x) in limits and f[top] / max(f[bottom], 1) >= limits[f.stratum, x]]
        assert r.kept == (not failed(f) and not hit) and sorted(r.rejected_by) == sorted(hit)


def test_quality_rules_on_odd_rows(spark):
    rows = [(1, None, None, 1), (1, None, None, 1), (None, "", "en", 1), (2, PROSE, "en", 1), (2, PROSE, "en", 1), (3, "long " * 100_000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int")
    empty = spark.createDataFrame([], "doc_id long, quality int")
    odd = spark.createDataFrame([(None, 1), (1, None), (77, 1)], "doc_id long, quality int")
    for labels in (empty, odd):
        out = quality_rules.apply_rules(docs, labels).collect()
        assert sorted((str(r.doc_id), r.kept) for r in out) == sorted([("1", False)] * 2 + [("None", False), ("2", True), ("2", True), ("3", False)])
        assert quality_rules.apply_rules(docs.limit(0), labels).count() == 0


# ---------------------------------------------------------------- shingle counts

def test_shingle_counts_of_a_shingle_in_every_document(spark):
    docs = spark.createDataFrame([(k, f"a b c d e own{k} text{k} of{k} mine{k} here{k}") for k in range(700)], "doc_id long, text string").repartition(5)
    src = jaccard_join._source(docs, "doc_id", "text")
    out = jaccard_join._frequencies(src, 5, 20, 100, 16, flush=300).collect()
    heavy = [c for r in out for c in r.counts]
    assert heavy == [700]


def test_jaccard_join_shares_no_more_than_its_shingles_need(spark, monkeypatch):
    """The map of shingles follows their number, and what was shared is given
    back when its rows are written."""
    from pyspark import SparkContext

    shared, put = [], SparkContext.broadcast

    def broadcast(self, value):
        shared.append((value, put(self, value)))
        return shared[-1][1]

    monkeypatch.setattr(SparkContext, "broadcast", broadcast)
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (3, "something else"), (4, None)]
    out = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    assert len(shared[0][0][0]) <= 4096
    assert not [b for _, b in shared if os.path.exists(b._path)]
