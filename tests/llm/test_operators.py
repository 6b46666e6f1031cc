"""The training-data operators against brute force, on the smallest tables
and on rows with nulls, empty texts, ties, repeats and clashing columns."""

import random
import re
import zlib
from collections import Counter, defaultdict
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logsift.llm import (decontaminate, jaccard_join, langid, licences, packing, quality_model, quality_rules, style_tree, substring_dedup,
                         toxicity)
from logsift.llm.common import fold, table
from logsift.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"
NUMBERS = " ".join(map(str, range(100)))
ODD = [(1, None), (2, ""), (3, "A b"), (4, "a B"), (4, "a B"), (5, " \n\t"), (None, "a b"), (6, NUMBERS), (7, NUMBERS[4:]), (8, "x " * 90),
       (9, "é ß " * 40), (9, "é ß " * 40), (None, "only here"), (10, "q " + NUMBERS), (11, " ".join("abc"[i % 3] for i in range(90)))]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3) for i, t in ODD],
                                 "doc_id long, text string, lang string, source string, n_words long, node long, spans int")


def docs_of(spark):
    return table(spark, SF, "documents")


def fold_case(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def key(rows):
    return sorted(tuple(map(str, r)) for r in rows)


def both(spark, odd):
    return [odd, docs_of(spark), odd.limit(0)]


def test_substring_dedup(spark, odd):
    def brute(rows, w=35):
        words = [(t or "").encode().split() for _, t in rows]
        seen = Counter(tuple(x[a : a + w]) for x in words for a in range(len(x) - w + 1))
        out = []
        for (i, _), x in zip(rows, words):
            gone = {k for a in range(len(x) - w + 1) if seen[tuple(x[a : a + w])] > 1 for k in range(a, a + w)}
            out.append((i, len(x), len(gone), b" ".join(v for k, v in enumerate(x) if k not in gone).decode()))
        return out

    for docs in both(spark, odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        for hot in (5000, 1):  # every seed in one shard; every seed salted
            got = substring_dedup.dedup(docs, hot_seed=hot, block=50).select("doc_id", "n_words", "n_removed", "kept").collect()
            assert key(got) == key(brute(rows))


def test_jaccard_join(spark, odd):
    def brute(rows, k=5):
        sets = []
        for _, t in rows:
            w = fold_case(t).encode().split()
            sets.append({tuple(w[a : a + k]) for a in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
        label = list(range(len(rows)))
        for a in range(len(rows)):
            for b in range(a):
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label = [min(label[a], label[b]) if x in (label[a], label[b]) else x for x in label]
        least = defaultdict(lambda: None)
        for (i, _), x in zip(rows, label):
            if i is not None:
                least[x] = i if least[x] is None else min(least[x], i)
        return [(i, len(s), least[x] if s else i) for (i, _), s, x in zip(rows, sets, label)]

    for docs in both(spark, odd):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        for heavy in (100, 1):
            got = jaccard_join.join(docs, heavy=heavy).select("doc_id", "n_shingles", "component_id").collect()
            assert key(got) == key(brute(rows))


def test_every_linked_pair_passes_in_some_list():
    rnd = random.Random(11)
    base = rnd.sample(range(400), 60)
    sets = [sorted(set(base) - set(rnd.sample(base, rnd.randint(0, 12))) | set(rnd.sample(range(400), rnd.randint(0, 9)))) for _ in range(60)]
    lists = defaultdict(list)
    for k, own in enumerate(sets):
        for pos, x in enumerate(own):
            lists[x].append((k, pos))
    found = set()
    for own in lists.values():
        ids, pos = np.array(own).T
        size = np.array([len(sets[k]) for k in ids])
        for i, others in jaccard_join.partners(size, pos, ids, 80):
            found |= {tuple(sorted((int(ids[i]), int(ids[j])))) for j in others}
    linked = {(a, b) for a in range(60) for b in range(a + 1, 60)
              if 100 * len(set(sets[a]) & set(sets[b])) >= 80 * len(set(sets[a]) | set(sets[b]))}
    assert linked and linked <= found


def test_divide_skip_equals_counting():
    rnd = random.Random(5)
    for _ in range(200):
        query = np.array(sorted(rnd.sample(range(60), rnd.randrange(1, 30))), np.uint64)
        sets = [np.array(sorted(rnd.sample(range(60), rnd.randrange(1, 30))), np.uint64) for _ in range(rnd.randrange(1, 12))]
        need = [rnd.randrange(1, 20) for _ in sets]
        expect = [k for k, s in enumerate(sets) if len(set(query.tolist()) & set(s.tolist())) >= need[k]]
        assert jaccard_join.divide_skip(query, sets, need) == expect


def test_decontamination(spark, odd):
    words = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    small = spark.createDataFrame([(1, "A, b!"), (1, "a b"), (2, None), (3, "..."), (4, NUMBERS[30:120]), (None, "x X x")], "item_id long, text string")
    for docs, bench in [(odd, small), (docs_of(spark), table(spark, SF, "benchmark")), (odd, small.limit(0)), (odd.limit(0), small)]:
        owners = defaultdict(set)
        for r in bench.collect():
            w = words.findall(fold_case(r.text))
            for a in range(max(1, len(w) - 12)):
                if w:
                    owners[tuple(w[a : a + 13])].add("" if r.item_id is None else str(r.item_id))
        lengths = {len(p) for p in owners}
        expect = []
        for r in docs.collect():
            w = words.findall(fold_case(r.text))
            hit, items = set(), set()
            for n in lengths:
                for a in range(len(w) - n + 1):
                    if tuple(w[a : a + n]) in owners:
                        hit.update(range(a, a + n))
                        items |= owners[tuple(w[a : a + n])]
            expect.append((r.doc_id, len(w), len(hit), sorted(items)))
        for block in (10**6, 1):  # all phrases in one block; one item a block
            got = decontaminate.decontaminate(docs, bench, block_words=block)
            assert key(got.select("doc_id", "n_words", "n_hit", "items").collect()) == key(expect)
            assert all(r.n_hit == sum(s.end - s.start for s in r.spans) for r in got.collect())


def test_packing_round_trip(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer())
    tok.encode_special_tokens = True
    extra = spark.createDataFrame([(50, "a  b\n c \n\nd <|endoftext|>"), (51, "w" * 9000), (52, "é　ñ 12 it's " * 900)], "doc_id long, text string")
    for docs in [odd.select("doc_id", "text").union(extra), docs_of(spark), odd.limit(0)]:
        rows = packing.pack(docs, tokenizer()).collect()
        expect = Counter()
        for r in docs.collect():
            ids = [*tok.encode(r.text or "", add_special_tokens=False).ids, 2]
            first = len(ids) if len(ids) <= 1024 else len(ids) % 1024
            at = ([0] if first else []) + list(range(first, len(ids), 1024))
            for k, a in enumerate(at):
                part = ids[a : (at + [len(ids)])[k + 1]]
                expect[r.doc_id, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expect
        places = defaultdict(list)
        for r in rows:
            places[r.sequence_id].append((r.offset, r.length))
        for own in places.values():
            end = 0
            for offset, length in sorted(own):
                assert offset == end
                end += length
            assert end <= 1024


def test_fullest_combination_is_the_fullest():
    rnd = random.Random(2)
    for _ in range(300):
        counts = {rnd.randrange(1, 30): rnd.randrange(1, 4) for _ in range(rnd.randrange(1, 7))}
        got = packing.fullest(dict(counts), 30)
        best, longest = {max(counts)}, max(counts)
        for n, c in counts.items():
            best = {s + n * k for s in best for k in range(c + 1 - (n == longest)) if s + n * k <= 30}
        assert got[longest] >= 1 and all(got[n] <= counts[n] for n in got)
        assert sum(n * k for n, k in got.items()) == max(best)


def test_quality_counts(spark, odd):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    for docs in both(spark, odd):
        expect = []
        for r in docs.collect():
            text = r.text or ""
            w, lines = word.findall(text), [x for x in text.split("\n") if word.search(x)]
            at = defaultdict(list)
            for a in range(len(w) - 2):
                at[tuple(w[a : a + 3])].append(a)
            repeated = {x for v in at.values() if len(v) > 1 for a in v for x in (a, a + 1, a + 2)}
            expect.append((r.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)))
        got = quality_rules.features(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()
        assert key(got) == key(expect)


def test_binomial_tail_is_exact(spark):
    from math import comb

    cases = [(0, 10), (1, 50), (3, 400), (0, 3000), (20, 3000), (40, 100)]
    df = spark.createDataFrame(cases, "k long, n long").select("k", "n", quality_rules.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("p"))
    for r in df.collect():
        p = 1.0 if r.k >= r.n * 0.01 else sum(comb(r.n, j) * 0.01**j * 0.99 ** (r.n - j) for j in range(r.k + 1))
        assert abs(r.p - p) < 1e-9


def test_cutoffs_spare_clean_documents(spark):
    """Clean texts without symbols certify the symbol rule; a stratum with too
    few labels certifies nothing; ties and unknown labels do no harm."""
    text = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda i: F.concat(F.lit("w"), (i * 7919 % 997 + F.col("id")).cast("string"))), " "),
                    F.when(F.col("id") % 10 == 0, F.lit(" ###" * 30)).otherwise(""))
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") < 11_900, "en").alias("lang"))
    labels = spark.range(12_500).select(F.col("id").alias("doc_id"), (F.col("id") % 10 != 0).cast("int").alias("quality"))
    out = quality_rules.apply_rules(docs, labels.union(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, quality int")))
    lost = {tuple(r) for r in out.groupBy("stratum", F.col("doc_id") % 10 == 0, "kept").count().collect()}
    assert lost == {("en", True, False, 1190), ("en", False, True, 10_710), ("und", True, True, 10), ("und", False, True, 90)}


def test_licences(spark):
    docs = spark.createDataFrame([(1, "Text. Released under the MIT License.\nMore."), (2, None), (3, ""), (4, "licensed under the apache LICENSE, version 2.0. x"),
                                  (5, licences.SENTENCES[10] + " " + licences.SENTENCES[11] + "\n" + licences.SENTENCES[12]),
                                  (6, licences.SENTENCES[41] + " x y z. " + licences.SENTENCES[40] + " A\n\n" + licences.SENTENCES[34]), (6, "no licence here.")],
                                 "doc_id long, text string")
    got = key(licences.scan(docs).select("doc_id", F.array_join("licences", ",").alias("l"), "n_unmatched").collect())
    assert got == key([(1, "MIT", 0), (2, "", 0), (3, "", 0), (4, "Apache-2.0", 0), (5, "MIT", 0), (6, "GPL-3.0", 2), (6, "", 0)])
    assert licences.scan(docs.limit(0)).count() == 0


def licence_brute(text):
    """Every known sentence at every start of a sentence or line."""
    known, out = dict(licences.known()), []
    text = "\n".join(" ".join(re.sub(r"[^a-z0-9.!?]", " ", x).split()) for x in (text or "").lower().split("\n"))
    for piece in re.split(r"[.!?]+(?:\s+|$)", text):
        lines = [x for x in (" ".join(re.findall("[a-z0-9]+", line)) for line in piece.split("\n")) if x]
        at = 0
        while at < len(lines):
            ends = [k for k in range(len(lines), at, -1) if " ".join(lines[at:k]) in known]
            out += [known[" ".join(lines[at : ends[0]])]] if ends else []
            at = ends[0] if ends else at + 1
    return out


def test_licences_at_line_starts(spark):
    notice = licences.SENTENCES
    made = [(1, "| haanananes |\n" + notice[23]), (2, "Heading\n# " + notice[80] + "\nmore"), (3, "Copyright 2020 X\n" + notice[14][:-1] + "\nNo stop here"),
            (4, "x\r\n * This program is free software: you can\r\n * " + notice[30][39:].replace(" under ", "\n * under\t") + " y"),
            (5, "a b\n" + notice[20].replace("(", "\n(")), (6, "not " + notice[80]), (7, "wow... .. \n .\n. " + notice[80] + ".b"), (8, "x\n" + notice[81] + ")\n? " + notice[82])]
    docs = spark.createDataFrame(made, "doc_id long, text string").unionByName(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text"))
    got = licences.scan(docs).select("doc_id", "sentence_ids").collect()
    assert key(got) == key((r.doc_id, licence_brute(r.text)) for r in docs.collect())
    named = {r.doc_id: r.licences for r in licences.scan(docs.limit(len(made))).collect()}
    assert named == {1: ["Apache-2.0"], 2: ["CC-BY-NC-4.0"], 3: ["MIT"], 4: ["GPL-3.0-or-later"], 5: ["Apache-2.0"], 6: [], 7: [], 8: ["CC-BY-4.0", "CC-BY-SA-4.0"]}


MIT = """MIT License

Copyright (c) 2020 A B

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""
BSD = """Copyright (c) 2020, A B
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """   Copyright [yyyy] [name of copyright owner]

   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License.
"""


def test_licence_files(spark):
    bullets = re.sub(r"(?m)^\d\.", "*", BSD % THIRD)
    files = {"MIT": MIT, "MIT2": MIT.replace("\n", "\r\n"), "BSD-3-Clause": BSD % THIRD, "BSD-3-Clause2": bullets, "BSD-2-Clause": BSD % "", "Apache-2.0": APACHE,
             "Apache-2.02": "".join(f"# {x}\n" for x in APACHE.split("\n"))}
    docs = spark.createDataFrame(list(files.items()), "doc_id string, text string")
    got = {r.doc_id: (r.licences, [i // 100 for i in r.sentence_ids], r.n_unmatched) for r in licences.scan(docs).collect()}
    ids = {"MIT": [10, 11, 12], "BSD-3-Clause": [40, 41, 42, 43], "BSD-2-Clause": [40, 41, 42], "Apache-2.0": [20, 21, 22]}
    ids |= {"MIT2": ids["MIT"], "BSD-3-Clause2": [44, 41, 42, 43], "Apache-2.02": ids["Apache-2.0"]}
    assert got == {k: ([k.removesuffix("2")], v, 0) for k, v in ids.items()}


def test_language_profiles(spark, odd):
    docs = docs_of(spark)
    profiles = langid.train(docs, fold("doc_id", 3) != 1)
    got = langid.predict(docs, profiles).join(docs.select("doc_id", "lang"), "doc_id").filter(fold("doc_id", 3) == 1)
    right, total = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert right >= 0.97 * total
    rows = langid.predict(odd, profiles).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 5, 6)} == {"und"}
    assert {r.lang_pred for r in langid.predict(odd, {}).collect()} == {"und"}
    assert langid.predict(odd.limit(0), profiles).count() == 0


def test_classifiers(spark, odd):
    big = "/root/testdata/sf0.01"
    docs, labels = table(spark, big, "documents"), table(spark, big, "labels")
    train = fold("doc_id", 5) != 0
    good = quality_model.train(docs, labels, train)
    toxic = toxicity.train(docs, labels, train)
    for out, label, least in ((quality_model.score(docs, good), "quality", 0.95), (toxicity.score(docs, toxic), "toxic", 0.9)):
        held = out.join(labels, "doc_id").filter(~train)
        right, total = held.agg(F.count_if((F.col("score") >= 0.5).cast("int") == F.col(label)), F.count(F.lit(1))).first()
        assert right >= least * total
    for out in (quality_model.score(odd, good), toxicity.score(odd, toxic), quality_model.score(odd, quality_model.train(odd, labels.limit(0), train)),
                toxicity.score(odd, toxicity.train(odd, labels.limit(0), train))):
        assert all(0 <= r.score <= 1 for r in out.collect()) and out.count() == len(ODD)
    assert toxicity.score(odd.limit(0), toxic).count() == 0


def test_toxicity_locates_sentences(spark):
    rnd = random.Random(1)
    words = ["one", "two", "three", "four", "five", "six"]
    line = lambda: " ".join(rnd.choices(words, k=6))
    rows = []
    for i in range(600):
        own = [line() for _ in range(5)]
        if i % 3 == 0:
            own[i % 5] += " vile" + rnd.choice(["", "ness", "ly"])
        rows.append((i, ". ".join(own) + ".", int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(df.drop("toxic"), df.drop("text"), fold("doc_id", 5) != 0)
    for r in toxicity.score(df, model).collect():
        assert [s["index"] for s in r.offending] == ([r.doc_id % 5] if r.doc_id % 3 == 0 else [])
        assert all("vile" in s["text"] for s in r.offending)


def test_style_tree(spark):
    def plain(html):
        body = re.search(r"<article>(.*?)(</article>|<footer>|$)", html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
        return "\n".join(b for b in blocks if b)

    pages = table(spark, SF, "pages")
    got = {r.page_id: r.text for r in style_tree.extract(pages).collect()}
    assert got == {r.page_id: plain(r.html) for r in pages.collect()}
    # boilerplate without any mark goes by its importance; what differs stays
    made = [(i, "http://a.example/x", f"<body><div class=top>Read all about it</div><div class=t><p>Story {i} &amp; more<br>text</div><ul><li>Same"
             f"</ul><div id=comments>Me {i}</div><p hidden>no {i}</p>") for i in range(20)]
    made += [(98, None, None), (99, "x", ""), (99, "x", ""), (100, "//h", "<p title='a>b'>A&nbsp; b</p><b>c</i>d<script>if (a<b) x()</script> e <!-- f --> g<p")]
    out = {r.page_id: (r.text, r.n_chars) for r in style_tree.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    assert all(out[i][0] == f"Story {i} & more text" for i in range(20))
    assert out[98] == out[99] == ("", 0) and out[100][0].startswith("A b\ncd e g")
    assert style_tree.extract(pages.limit(0)).count() == 0


def test_style_tree_hints_around_and_inside_the_article(spark):
    whole = ("<article><h1 id=menu>Title</h1><section id=related-work><h2 id=social-studies>Two</h2><p>Three</p></section><section class=login-history><p class=notice>Four</p>"
             "</section><div id=advertising>Five</div><ul><li class=share>Six</ul><div class='x ad'>Seven</div></article>")
    wraps = ["page no-sidebar", "has-sidebar", "comments-open", "menu-open", "sidebar", "ad"]
    made = [(i, f"//h{i}/", f"<body><div class='{w}' id=menu>{whole}</div><div class=ad>Eight</div>") for i, w in enumerate(wraps)]
    made += [(10 + i, f"//w{i}/", f"<body><div class='{w}'><h2 id=related-work>One</h2><p>Two</p></div><div class=site-footer>No</div>") for i, w in enumerate(wraps[:4])]
    made += [(20, "//n/", "<body><nav><article><p>No</p></article></nav><div hidden><main>No</main></div><main class=menu><p>Yes</p><div class=comments><article>Too</article></div></main>")]
    out = {r.page_id: r.text for r in style_tree.extract(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    want = {i: "Title\nTwo\nThree\nFour\nFive\nSix" for i in range(6)} | {10 + i: "One\nTwo" for i in range(4)} | {20: "Yes"}
    assert out == want


def main_text(html):
    page = style_tree.parse(html)
    return "\n".join(t for e, t in page.blocks if not e.off and (e.main or not page.has_main()))


def test_reader_comments_related_articles_and_adverts_go_wherever_they_stand():
    more = ["<section id='comments'><article class='comment'><p>Reader</p></article></section>", "<div class='related'><article class='card'>Other</article></div>",
            "<div id='comments'>Reader</div>", "<div class='comments-area'><p>Reader</p></div>", "<div id=disqus_thread>Reader</div>",
            "<ol class='comment-list'><li class='comment even'><article id='div-comment-2' class='comment-body'><p>Reader</p></article></li></ol>",
            "<div class='related-posts'><h3>Read also</h3><ul><li>Other</li></ul></div>", "<div class='ad-slot'><article>Buy</article></div>"]
    for extra in more:
        assert main_text(f"<body><article><h1>Title</h1><p>Main</p></article>{extra}") == "Title\nMain"
        assert main_text(f"<body><main><h1>Title</h1><article><p>Main</p></article>{extra}</main>") == "Title\nMain"
    for extra in more[:1] + more[2:7]:
        assert main_text(f"<body><article><h1>Title</h1><p>Main</p>{extra}</article>") == "Title\nMain"


def test_markup_of_odd_attributes_does_not_leak():
    assert main_text("<p title=it's>Main text one</p>") == "Main text one"
    assert main_text("<p title=it's>Main text one</p><p>It isn't</p>") == "Main text one\nIt isn't"
    assert main_text("<p a='x\"y' b=\"x'>y\" = c>One</p><p/>Two<p class>a < b &amp;&lt; c</p>") == "One\nTwo\na < b &< c"
    assert main_text("<p>One<p title='x>Two") == "One\nTwo" or main_text("<p>One<p title='x>Two") == "One"
    assert main_text("<article><p>A <button>b</button>c <select>d</p><p>more</p></article>") == "A c d\nmore"
    assert main_text("<p>x<!-- y") == "x" and main_text("<!doctype html><p>x</") == "x" and main_text("1 < 2 <3") == "1 < 2 <3"


@pytest.mark.parametrize("html", ["<a " * 350_000, "<div>x" * 20_000, "<div>x" * 20_000 + "</i></p></q>" * 20_000, "<b>" * 20_000 + "</i>" * 20_000,
                                  "<li><div>" * 20_000, "<button>" * 50_000, "<p a='" * 100_000, "</" * 300_000, f"<p class='{'c ' * 300_000}'><b>x</b>",
                                  f"<div class={'c' * 300_000}>" + "<div>" * 1000])
def test_parsing_takes_linear_time(html):
    import time

    began = time.perf_counter()
    style_tree.parse(html)
    assert time.perf_counter() - began < 1


def test_style_tree_odd_rows(spark):
    deep = "<div class=a>" * 3000 + "deep"
    rows = [(1, "//x/", "<p>A</p>", "t", 1), (1, "//x/", "<p>A</p>", "t", 1), (2, None, deep, "t", 1), (None, "//x/", None, None, None), (3, "//x/", "<p>" + "long " * 300_000, "t", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, host int")
    out = sorted((str(r.page_id), r.text, r.n_chars) for r in style_tree.extract(df).collect())
    assert out == sorted([("1", "A", 1)] * 2 + [("2", "deep", 4), ("None", "", 0), ("3", ("long " * 300_000).strip(), 1_499_999)])


def test_importance_and_removal_equal_brute_force(spark, monkeypatch):
    import math

    rnd = random.Random(7)
    pages = [(i, "//one/", "".join(f"<div class={c}>{rnd.choice(['Same', f'Text {i}', 'Two'])}</div>" for c in rnd.sample("abcd", rnd.randrange(1, 5)))) for i in range(25)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.path: (r.pages, r.imp) for r in style_tree.importance(df).collect()}
    assert len({h for _, _, h in pages}) > 10
    layouts, texts = defaultdict(Counter), defaultdict(Counter)
    for html in {h for _, _, h in pages}:
        page = style_tree.parse(html)
        for e in page.elements:
            layouts[e.path][tuple(e.children)] += 1
        for e, t in page.blocks:
            texts[e.path][t] += 1
    for path, seen in layouts.items():
        m = sum(seen.values())
        node = 1.0 if m < 2 else -sum(n / m * math.log(n / m) for n in seen.values()) / math.log(m)
        below = [(p, t, n) for p, own in texts.items() if p == path or p.startswith(path + ">") for t, n in own.items()]
        if not below:
            continue
        own = [1.0 if (mp := sum(layouts[p].values())) < 2 else 1 - math.log(n) / math.log(mp) for p, _, n in below]
        content, fade = sum(own) / len(own), 0.9 ** len(seen)
        assert got[path][0] == m and abs(got[path][1] - min(content, (1 - fade) * node + fade * content)) < 1e-9
    full = {r.page_id: (r.text, r.n_removed) for r in style_tree.extract(df).collect()}
    monkeypatch.setattr(style_tree, "BROADCAST_PATHS", -1)
    assert full == {r.page_id: (r.text, r.n_removed) for r in style_tree.extract(df).collect()}


@pytest.mark.parametrize("limit", [100_000, 0])
def test_style_tree_copies_of_a_page(spark, monkeypatch, limit):
    monkeypatch.setattr(style_tree, "BROADCAST_COPIES", limit)
    page = "<body><div class=t><p>First paragraph</p><p>Second one</p></div>"
    made = [(i, f"//copies/{i}", page) for i in range(30)]
    # three copies each of 20 pages: the same 20 pages, so what recurs on them goes
    made += [(100 + i, f"//mixed/{i}", f"<body><div class=top>Read all about it</div><div class=t>Story {i % 20}</div>") for i in range(60)]
    df = spark.createDataFrame(made, "page_id long, url string, html string")
    out = {r.page_id: (r.text, r.n_removed) for r in style_tree.extract(df).collect()}
    assert out == {i: ("First paragraph\nSecond one", 0) for i in range(30)} | {100 + i: (f"Story {i % 20}", 1) for i in range(60)}
    once = df.filter("page_id between 100 and 119")
    rows = lambda d: {(r.path, r.pages, round(r.imp, 9)) for r in style_tree.importance(d).collect()}
    assert rows(once) == rows(df.filter("page_id >= 100"))


def test_pipeline(spark):
    """Each stage on all that its predecessor kept, and its decisions hold."""
    docs = docs_of(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF).cache()
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
            break
        assert out.columns == docs.columns and out.count() <= docs.count()
        if name == "near_duplicates":
            assert jaccard_join.join(out).filter("component_id <> doc_id").count() == 0
        if name == "repeated_passages":
            assert out.count() == docs.count()
        if name == "benchmark":
            assert decontaminate.decontaminate(out, table(spark, SF, "benchmark")).filter(decontaminate.contaminated()).count() == 0
        docs = out
    assert docs.count() > 0


def test_queries_are_registered():
    assert [int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES] == list(range(1, 14))
