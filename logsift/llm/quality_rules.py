"""Quality rules whose cutoffs are certified on labelled documents.

Each rule rejects a document when one ratio reaches a cutoff.  For every
stratum and rule the cutoffs of a fixed grid are tested from the mildest to
the strictest (fixed-sequence testing): a cutoff is accepted if the exact
binomial tail shows, at level ``delta / (rules x strata)``, that it rejects at
most ``alpha / rules`` of the clean documents; the first failure ends the
sequence.  By the union bound, with probability ``1 - delta`` no stratum loses
more than ``alpha`` of its clean documents to all rules together.

Only DataFrame functions are used; nothing runs in Python workers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logsift.llm.common import checkpoint

_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"

#: rule -> (numerator, denominator, cutoffs from mild to strict)
RULES = {
    "symbols": ("n_symbols", "n_words", [2.0, 1.0, 0.5, 0.2, 0.1, 0.05]),
    "dup_lines": ("n_dup_lines", "n_lines", [0.8, 0.6, 0.5, 0.4, 0.3, 0.2]),
    "repeats": ("n_repeat_words", "n_words", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2]),
    "capitals": ("n_capitals", "word_chars", [0.9, 0.7, 0.5, 0.4, 0.3, 0.2]),
    "long_words": ("word_chars", "n_words", [40.0, 30.0, 20.0, 15.0, 12.0, 10.0]),
}

#: A join side of at most this many rows (one per stratum) may be broadcast.
BROADCAST_STRATA = 10_000


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", row_col: str | None = None) -> DataFrame:
    """Counts per row (``row``: a column that names it, null if none): ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``
    (with a word), ``n_dup_lines``, ``n_repeat_words``, ``n_capitals``.

    Three-word windows are compared within one text by a 64-bit hash, sorted
    with their positions; nothing is exploded or shuffled, so a document of
    any length costs n log n inside its own row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(_SPACE))
    base = docs.select(
        F.col(id_col).alias("doc_id"), (F.col(row_col) if row_col else F.lit(None).cast("string")).alias("row"),
        F.coalesce(F.col(stratum_col).cast("string"), F.lit("und")).alias("stratum"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACES)).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).alias("n_symbols"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[A-Z]+", ""))).alias("n_capitals"),
    )
    words = F.col("words")
    counted = base.select(
        "doc_id", "row", "stratum", F.size("words").alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"),
        "n_symbols", "n_capitals", F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(
            F.slice(F.transform("words", lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
                    F.lit(1), F.greatest(F.size("words") - 2, F.lit(0)))).alias("grams"),
    )
    # texts without a repeated window (most) skip the sort
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    ranked = counted.select(
        *[c for c in counted.columns if c != "grams"],
        F.when(repeated, F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ranked"),
    )
    pairs = F.col("ranked")
    same = lambda p, j, d: F.coalesce(F.get(pairs, j + d)["h"] == p["h"], F.lit(False))
    found = ranked.select(
        *[c for c in ranked.columns if c != "ranked"],
        F.sort_array(F.transform(F.filter(pairs, lambda p, j: same(p, j, -1) | same(p, j, 1)), lambda p: p["i"])).alias("starts"),
    )
    starts = F.col("starts")
    covered = F.aggregate(
        F.transform(starts, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - x, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    out = found.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines"]
    return out.select("doc_id", "row", "stratum", *[F.col(c).cast("long").alias(c) for c in longs])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(rule: str) -> Column:
    top, bottom, _ = RULES[rule]
    return F.col(top) / F.greatest(F.col(bottom), F.lit(1))


#: Coefficients of Stirling's series 1/12, 1/360, 1/1260, 1/1680,
#: and log(n!) less Stirling's formula for n from 0 to 15.
STIRLING = [1 / 12, -1 / 360, 1 / 1260, -1 / 1680]
STIRLING_SMALL = [math.lgamma(n + 1) - (0 if n == 0 else (n + 0.5) * math.log(n) - n + 0.5 * math.log(2 * math.pi)) for n in range(16)]


def _stirling_error(n: Column) -> Column:
    series = sum((F.lit(c) / F.pow(F.greatest(n, F.lit(1.0)), F.lit(2.0 * i + 1)) for i, c in enumerate(STIRLING)), F.lit(0.0))
    return F.when(n < 16, F.get(F.array(*[F.lit(v) for v in STIRLING_SMALL]), n.cast("int"))).otherwise(series)


def _deviance(x: Column, mean: Column) -> Column:
    """``x log(x / mean) + mean - x``."""
    return x * F.log(x / mean) + mean - x


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """``P(Bin(n, p) <= k)``; 1 at or above the mean, where no cutoff can be
    accepted.

    The probability of ``k`` itself comes from its deviance and Stirling's
    errors, which keeps its digits at any size.  Those below it follow by
    ratios that fall below one, so what is left out after some forty standard
    deviations is nothing: the sum has as many terms as the square root of
    ``n``, not ``k``."""
    n, k = n.cast("double"), k.cast("double")
    inner = F.exp(_stirling_error(n) - _stirling_error(k) - _stirling_error(n - k) - _deviance(k, n * p) - _deviance(n - k, n * (1 - p))
                  + 0.5 * F.log(n / (2 * math.pi * k * (n - k))))
    at_k = F.when(k == 0, F.exp(n * math.log(1 - p))).otherwise(inner)
    terms = F.least(k, F.ceil(40 * F.sqrt(n * p)) + 50).cast("long")
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def step(a: Column, i: Column) -> Column:
        j = k - i.cast("double") + 1  # from k down
        t = a["t"] * j * (1 - p) / ((n - j + 1) * p)
        return F.struct(t.alias("t"), (a["s"] + t).alias("s"))

    below = F.when(terms == 0, F.lit(1.0)).otherwise(F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(terms, F.lit(1))), start, step, lambda a: a["s"]))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(at_k * below, F.lit(1.0)))


def cutoffs(feats: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05, id_col: str = "doc_id",
            label_col: str = "quality") -> DataFrame:
    """One row per stratum with a certified rule: ``stratum`` and a map
    ``limits`` from rule to cutoff.  The holdout is every labelled clean
    document that passes the base rules; a document labelled twice is clean
    if any label says so."""
    clean = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("_id"))
             .agg(F.max(label_col).alias("_q")).filter("_q = 1").select("_id"))
    held = feats.filter(~base_failed()).join(clean, F.col("doc_id") == F.col("_id"), "left_semi")
    sums = [F.sum((_ratio(r) >= t).cast("long")).alias(f"{r}_{k}") for r, (_, _, grid) in RULES.items() for k, t in enumerate(grid)]
    counts = checkpoint(held.groupBy("stratum").agg(F.count(F.lit(1)).alias("n"), *sums))
    tests = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(k).alias("step"), F.lit(t).alias("cutoff"), F.col(f"{r}_{k}").alias("lost"))
                      for r, (_, _, grid) in RULES.items() for k, t in enumerate(grid)])
    each = counts.select("stratum", "n", F.explode(tests).alias("t")).select("stratum", "n", "t.*")
    level = F.lit(delta / (len(RULES) * max(1, counts.count())))  # Bonferroni over rules and strata
    each = each.withColumn("ok", (binomial_tail(F.col("lost"), F.col("n"), alpha / len(RULES)) <= level).cast("int"))
    upto = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passed = each.withColumn("ok", F.min("ok").over(upto)).filter("ok = 1").groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))
    return passed.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("limits"))


def apply_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.05, delta: float = 0.05, id_col: str = "doc_id",
                text_col: str = "text", stratum_col: str = "lang", label_col: str = "quality", row_col: str | None = None) -> DataFrame:
    """Per row of ``docs``: the counts, ``base_failed``, ``rejected_by`` (the
    certified rules that reject it) and ``kept``; and ``row``, the column
    ``row_col`` that names the row where ids repeat.

    Null text counts as empty (no words: base_failed).  A null stratum is the
    stratum ``und``.  Labels without a document, null ids and null labels are
    ignored; without enough labels nothing is certified and only the base
    rules reject.  Repeated rows each give a row; empty tables give no rows;
    other columns are ignored.
    """
    feats = checkpoint(features(docs, id_col, text_col, stratum_col, row_col))  # computed once, narrow
    limits = checkpoint(cutoffs(feats, labels, alpha, delta, "doc_id" if id_col not in labels.columns else id_col, label_col))
    small = limits.limit(BROADCAST_STRATA + 1).count() <= BROADCAST_STRATA
    out = feats.join(F.broadcast(limits) if small else limits, "stratum", "left")
    hits = [F.when(_ratio(r) >= F.col("limits")[r], F.lit(r)) for r in RULES]
    out = out.withColumn("base_failed", base_failed()).withColumn("rejected_by", F.array_compact(F.array(*hits)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("limits")
