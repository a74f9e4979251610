"""Reproducible shuffle into equal shards: Feistel permutation of global row numbers.

Every row gets a global number (order: id, then size, checksum and text hash),
a keyed Feistel permutation with cycle walking maps it to a position, and the
position gives shard ``position % shards`` and slot ``position // shards``. So
shard sizes differ by one at most (law ``rows``), slots are gapless, and place
and content order follow from (number, n, key) alone: ``feistel.invert_int``
finds the row of any slot without reading the data.

Defined cases: a null text has 0 bytes and checksum 0; a null id sorts first;
repeated rows are rows of their own, and which of two identical rows takes
which slot is open; an empty table gives an empty result; other columns of the
input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapstats.llm.common import text_or_empty
from lapstats.llm.feistel import permute, walk_all
from lapstats.llm.numbering import number_rows
from lapstats.session import materialize


def assign_shards(docs: DataFrame, shards: int = 8, key: int = 20240229,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, size, checksum, law, shard, slot and grown_shard (null under law ``rows``) of every row."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = text_or_empty(F.col(text_col))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__hash"))
    numbered, n = number_rows(narrow, [F.col(c) for c in ("doc_id", "size", "text_crc32", "__hash")], "shard-rows")
    placed = materialize(numbered.withColumn("position", permute("row_number", max(n, 1), key)), "shard-places")
    placed = walk_all(placed, "position", n, key)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("position") % shards).cast("int").alias("shard"),
        F.expr(f"position div {shards}L").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number")


def write_shards(docs: DataFrame, path: str, shards: int = 8, key: int = 20240229,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as Parquet folders ``__shard=k``, each ordered by ``__slot``; returns the table written.

    Rows meet their place by id, size, checksum and text hash; where those repeat,
    copies are numbered on both sides, so every row takes one place.
    """
    places = assign_shards(docs, shards, key, id_col, text_col)
    text = text_or_empty(F.col(text_col))
    same = ["__id", "__size", "__crc"]
    left = docs.withColumns({"__id": F.col(id_col), "__size": F.octet_length(text).cast("long") + 1,
                             "__crc": F.crc32(text.cast("binary"))})
    left = left.withColumn("__copy", F.row_number().over(Window.partitionBy(*same).orderBy(F.xxhash64(text))))
    right = places.select(F.col("doc_id").alias("__rid"), F.col("size").alias("__rsize"),
                          F.col("text_crc32").alias("__rcrc"), F.col("shard").alias("__shard"),
                          F.col("slot").alias("__slot"), F.col("row_number").alias("__rn"))
    right = right.withColumn("__rcopy", F.row_number().over(
        Window.partitionBy("__rid", "__rsize", "__rcrc").orderBy("__rn"))).drop("__rn")
    placed = left.join(right, F.col("__id").eqNullSafe(F.col("__rid")) & (F.col("__size") == F.col("__rsize"))
                       & (F.col("__crc") == F.col("__rcrc")) & (F.col("__copy") == F.col("__rcopy")))
    placed = placed.drop("__id", "__size", "__crc", "__copy", "__rid", "__rsize", "__rcrc", "__rcopy")
    (placed.repartitionByRange(shards, "__shard", "__slot").sortWithinPartitions("__shard", "__slot")
     .write.mode("overwrite").partitionBy("__shard").parquet(path))
    return docs.sparkSession.read.parquet(path)
