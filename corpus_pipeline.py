"""Corpus pipeline: quality rules, near duplicates, repeated passages,
benchmark decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of ``documents``.

A row is named by its id and the hash of its text, so rows that share an id
(or have none) each get their own verdict and keep their own text; rows equal
in both are equal.  Null texts count as empty; empty tables give empty tables;
other columns, whatever their names, are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsift.llm import decontaminate, jaccard_join, packing, quality_rules, substring_dedup
from logsift.llm.common import table
from logsift.llm.queries import tokenizer
from logsift.session import scratch_path


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that names the row: a struct of id and hash."""
    name = _fresh(docs, "row_name")
    return docs.withColumn(name, F.struct(F.col("doc_id").alias("id"), _text_hash().alias("hash"))), name


def _matched(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """``docs`` joined with ``rows`` (``id``, ``hash`` and other columns, one
    row per name) on the row's name."""
    id_, hash_ = _fresh(docs, "row_id"), _fresh(docs, "row_hash")
    rows = rows.withColumnsRenamed({"id": id_, "hash": hash_})
    joined = docs.join(rows, F.col("doc_id").eqNullSafe(F.col(id_)) & (_text_hash() == F.col(hash_)), how)
    return joined.drop(id_, hash_)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the certified rules reject go; a null
    or empty text is one."""
    named = docs.withColumn(name := _fresh(docs, "row_hash"), _text_hash())
    judged = quality_rules.apply_rules(named, table(spark, sf_dir, "labels"), row_col=name)
    return _matched(docs, judged.filter("kept").select(F.col("doc_id").alias("id"), F.col("row").alias("hash")).distinct(), "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component the document with the least id stays (and one row of
    it, should the row be repeated); texts without words stay."""
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    named, name = _named(docs)
    joined = jaccard_join.join(named, id_col=name)
    stay = joined.filter((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id.*").distinct()
    one = _matched(docs.filter(worded), stay, "left_semi").dropDuplicates(["doc_id", "text"])
    return one.unionByName(docs.filter(~worded))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside repeated passages go; a text that loses any becomes its
    other words joined by one space (empty if none is left), and ``n_chars``
    its length.  No row goes."""
    kept = _fresh(docs, "kept_text")
    cut = (substring_dedup.dedup(docs).filter("n_removed > 0")
           .select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("kept").alias(kept)).dropDuplicates(["id", "hash"]))
    out = _matched(docs, cut, "left")
    new = {"text": F.coalesce(kept, "text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept)).cast(docs.schema["n_chars"].dataType)
    return out.withColumns(new).select(docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least 5 % of their words in benchmark windows go."""
    named, name = _named(docs)
    judged = decontaminate.decontaminate(named, table(spark, sf_dir, "benchmark"), id_col=name)
    return _matched(docs, judged.filter(~decontaminate.contaminated()).select("doc_id.*").distinct(), "left_semi")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens of all documents; a null or empty text is one
    end token."""
    return packing.pack(docs, tokenizer())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages), ("benchmark", benchmark),
          ("packing", pack)]

#: Tokenisation and minimum bin slack are beyond SQL; tests hold each stage
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and
    read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
