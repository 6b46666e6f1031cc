"""Bounded, repeatable samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled(docs: DataFrame, labels: DataFrame, label_col: str, when: Column, max_rows: int, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``id``, ``text``, ``y`` of at most ``max_rows`` labelled documents that
    satisfy ``when`` (a condition on ``doc_id``), the first by a hash of the id.

    Only the narrow labels are ordered; the picked ids are at most
    ``max_rows`` and so may be broadcast.  Null ids and null labels are
    ignored; an id labelled twice has the larger label; of several rows with
    one id that with the least hash of its text counts (equal ones combine in
    each task), so there are never more rows than ids.
    """
    ids = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("y"))
           .filter(F.col("doc_id").isNotNull() & F.col("y").isNotNull() & when)
           .groupBy("doc_id").agg(F.max("y").alias("y"))
           .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_rows))
    text = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = text.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"), F.max("y").alias("y"))
    return one.select(F.col("doc_id").alias("id"), F.col("t.text").alias("text"), "y")
