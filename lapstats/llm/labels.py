"""Labelled documents for fitting classifiers: all of them, or a bounded sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstats.llm.common import text_or_empty


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus).cast("int")


def _labels(labels: DataFrame, label: str, keep: Column) -> DataFrame:
    """``__id`` and ``__y`` of the ids that ``keep`` allows and whose labels agree; a null label or id is no label."""
    return (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & keep)
            .groupBy("doc_id").agg(F.min(label).alias("__y"), F.max(label).alias("__top"))
            .filter("__y = __top").select(F.col("doc_id").alias("__id"), F.col("__y").cast("int").alias("__y")))


def _first_of_id(found: DataFrame) -> DataFrame:
    """Rows may repeat an id: the first by text hash stands for it."""
    rest = [c for c in found.columns if c not in ("__id", "__y")]
    first = found.groupBy("__id", "__y").agg(F.min(F.struct(F.xxhash64("__text").alias("__hash"), *rest)).alias("__first"))
    return first.select("__id", "__y", *(F.col("__first")[c].alias(c) for c in rest))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, keep: Column, *columns: Column) -> DataFrame:
    """Every labelled document that ``keep`` allows, one row per id: ``__id``, ``__y``, ``__text`` and ``columns``."""
    one = _labels(labels, label, keep)
    return _first_of_id(docs.join(one, docs["doc_id"] == one["__id"]).select(
        "__id", "__y", text_or_empty(docs["text"]).alias("__text"), *columns))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, rows: int,
                    *columns: Column) -> DataFrame:
    """At most ``rows`` labelled documents: text, label and ``columns``.

    The sample is the ids with the smallest hash among those that ``keep``
    allows, so it does not depend on file order. A null label or id is no label;
    ids with labels that disagree are left out. Only the sampled ids, at most
    ``rows`` of them, are broadcast; of the texts only the sampled ones are shuffled.
    """
    one = _labels(labels, label, keep).orderBy(F.xxhash64("__id"), "__id").limit(rows)
    found = docs.join(F.broadcast(one), docs["doc_id"] == one["__id"]).select(
        "__id", "__y", text_or_empty(docs["text"]).alias("__text"), *columns)
    return _first_of_id(found).orderBy(F.xxhash64("__id")).limit(rows)  # repeated ids go before the bound
