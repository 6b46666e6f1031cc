"""Licence recognition by sentences.

Known licence sentences have identifiers; a document becomes the sequence of
the identifiers of its recognised sentences, and ordered rules (identifier
sequences) name licences.  Only DataFrame functions are used: one projection,
no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, by licence.
SENTENCES = {
    10: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    11: "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    12: "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    13: "Released under the MIT License.",
    14: "Licensed under the MIT License.",
    20: "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    21: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    22: "See the License for the specific language governing permissions and limitations under the License.",
    23: "Licensed under the Apache License, Version 2.0.",
    30: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    31: "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    32: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    33: "See the GNU General Public License for more details.",
    34: "This work is licensed under the GNU General Public License, version 3.",
    35: "This work is licensed under the GNU General Public License, version 2.",
    40: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1.",
    41: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    42: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    43: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    44: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",  # before bullets
    50: "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    51: "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    60: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    70: "This is free and unencumbered software released into the public domain.",
    80: "Licensed under CC BY-NC 4.0.",
    81: "Licensed under CC BY 4.0.",
    82: "Licensed under CC BY-SA 4.0.",
    83: "Licensed under CC0 1.0.",
    84: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

#: Ordered rules; the first of those with equal sequences would win.
RULES = [
    ("MIT", (10, 11, 12)), ("MIT-notice", (10,)), ("MIT", (13,)), ("MIT", (14,)),
    ("Apache-2.0", (20, 21, 22)), ("Apache-2.0", (20,)), ("Apache-2.0", (23,)),
    ("GPL-3.0-or-later", (30, 32, 33)), ("GPL-3.0-or-later", (30,)), ("GPL-2.0-or-later", (31, 32, 33)), ("GPL-2.0-or-later", (31,)),
    ("GPL-3.0", (34,)), ("GPL-2.0", (35,)),
    ("BSD-3-Clause", (40, 41, 42, 43)), ("BSD-2-Clause", (40, 41, 42)),
    ("BSD-3-Clause", (44, 41, 42, 43)), ("BSD-2-Clause", (44, 41, 42)),
    ("MPL-2.0", (50, 51)), ("MPL-2.0", (50,)), ("ISC", (60,)), ("Unlicense", (70,)),
    ("CC-BY-NC-4.0", (80,)), ("CC-BY-4.0", (81,)), ("CC-BY-SA-4.0", (82,)), ("CC0-1.0", (83,)), ("CC-BY-4.0", (84,)),
]

def _marked(low: Column) -> Column:
    """Lower-cased text with runs of anything but letters and digits as one
    space, except that ``|`` stands where a sentence ends (``.!?`` before white
    space) and a newline where a line ends.  Empty lines are one line end: the
    official texts have them inside sentences 10, 21 and 40."""
    folded = F.regexp_replace(low, r"[^a-z0-9.!?\n]+", " ")
    cut = F.regexp_replace(F.regexp_replace(folded, r"(?<![.!?])[.!?]++([ \n]+|$)", "|"), r" ?\n[ \n]*", "\n")
    marked = F.regexp_replace(F.regexp_replace(cut, r"[^a-z0-9|\n]+", " "), r" ?([|\n]) ?", "$1")
    return F.concat(F.lit("\n"), marked, F.lit("\n"))


def _found(low: Column) -> Column:
    """The known sentences of a text, in order: from the start of a sentence or
    line to the end of one, over line wraps and empty lines, the longest at each start."""
    longest = sorted((s for s, _ in known()), key=len, reverse=True)
    pattern = r"(?<=[|\n])(?:" + "|".join(s.replace(" ", r"[ \n]") for s in longest) + r")(?=[|\n])"
    return F.transform(F.regexp_extract_all(_marked(low), F.lit(pattern), F.lit(0)), lambda s: F.translate(s, "\n", " "))


def gate_words() -> list[str]:
    """A few words of which every known sentence has one (greedy cover, long
    words first).  A text without any of them has no known sentence, so it
    need not be searched."""
    left, out = [set(s.split()) for s, _ in known()], []
    while left:
        words = {w for s in left for w in s}
        best = max(sorted(words), key=lambda w: (sum(w in s for s in left) * min(len(w), 8), len(w)))
        out.append(best)
        left = [s for s in left if best not in s]
    return out


def normalise(sentence: str) -> list[str]:
    """The same normalisation of a known sentence, which may have several parts."""
    import re

    folded = re.sub(r"[^a-z0-9.!?\n]+", " ", sentence.lower())
    parts = re.split(r"[.!?]+(?:[ \n]|$)", folded)
    return [p for p in (re.sub(r"[^a-z0-9]+", " ", p).strip() for p in parts) if p]


def known() -> list[tuple[str, int]]:
    """(normalised sentence, identifier); the parts of a sentence that itself
    splits get identifiers ``id * 100 + part`` and rules use those in order.
    Parts of one or two words (as ``2 0``) say nothing and are left out."""
    return [(s, i * 100 + k) for i, t in SENTENCES.items() for k, s in enumerate(normalise(t)) if len(s.split()) > 2]


def sequences() -> list[tuple[str, str]]:
    """(licence, ``,id,id,``) of each rule over the identifiers of ``known``."""
    parts = {i: [j for _, j in known() if j // 100 == i] for i in SENTENCES}
    return [(name, "," + ",".join(str(p) for i in ids for p in parts[i]) + ",") for name, ids in RULES]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``sentence_ids`` (recognised from the start of a
    sentence or line to the end of one, over line wraps and empty lines, in order), ``licences`` (names, in the order of the rules, each once) and
    ``n_unmatched`` (recognised sentences that no matching rule has).

    A rule matches if its identifiers follow each other among the recognised
    sentences; a rule inside a longer matching rule is left out.  Null or empty
    text has no sentences.  Repeated rows each give a row; empty tables give
    no rows; other columns are ignored.
    """
    lookup = F.create_map(*[F.lit(x) for pair in known() for x in pair])
    src = docs.select(F.col(id_col).alias("doc_id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_low"))
    gate = F.lit(False)
    for word in gate_words():
        gate = gate | F.contains(F.col("_low"), F.lit(word))
    src = src.select("doc_id", F.when(gate, _found(F.col("_low"))).otherwise(F.array().cast("array<string>")).alias("_s"))
    ids = src.select("doc_id", F.transform("_s", lambda s: lookup[s]).alias("sentence_ids"))
    rules = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(p).alias("seq")) for n, p in sequences()])
    seq = F.concat(F.lit(","), F.array_join(F.col("sentence_ids").cast("array<string>"), ","), F.lit(","))
    empty = F.size("sentence_ids") == 0
    none = F.array().cast("array<struct<name:string,seq:string>>")
    hit = ids.withColumn("_seq", seq).withColumn("_hit", F.when(empty, none).otherwise(F.filter(rules, lambda r: F.contains(F.col("_seq"), r["seq"]))))
    hits = F.col("_hit")
    best = hit.withColumn("_hit", F.filter(hits, lambda r: ~F.exists(hits, lambda q: (q["seq"] != r["seq"]) & F.contains(q["seq"], r["seq"]))))
    named = F.array_distinct(F.transform("_hit", lambda r: r["name"]))
    owned = F.array_join(F.transform("_hit", lambda r: r["seq"]), "")
    left = F.filter("sentence_ids", lambda i: ~F.contains(F.col("_own"), F.concat(F.lit(","), i.cast("string"), F.lit(","))))
    return (best.withColumn("_own", owned)
            .select("doc_id", "sentence_ids", named.alias("licences"), F.size(left).cast("long").alias("n_unmatched")))
