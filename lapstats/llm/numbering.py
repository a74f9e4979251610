"""Global row numbers without a global window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstats.session import materialize


def number_rows(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Write ``df`` range-partitioned by ``order`` with ``row_number`` 0..n-1; returns the table and n.

    The rows are range-partitioned and written once, so the partition a row fell
    into is fixed before it is counted. Each partition is numbered on its own and
    shifted by the rows of the partitions before it: one number per partition, a
    table as small as the count of partitions. Rows equal in ``order`` are
    interchangeable; give an order that tells all differing rows apart.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.struct(*order).alias("__key")]
    dealt = (df.withColumn("__key", keys[0]).repartitionByRange(parts, "__key")
             .withColumn("__part", F.spark_partition_id()))
    written = materialize(dealt, name)
    counts = written.groupBy("__part").count().collect()  # one small row per partition
    before, offsets = 0, []
    for part, rows in sorted((r["__part"], r["count"]) for r in counts):
        offsets.append((part, before))
        before += rows
    start = F.broadcast(spark.createDataFrame(offsets or [(0, 0)], "__part int, __start long"))
    in_part = F.row_number().over(Window.partitionBy("__part").orderBy("__key")) - 1
    numbered = written.withColumn("__in", in_part).join(start, "__part")
    return numbered.withColumn("row_number", F.col("__in") + F.col("__start")).drop("__in", "__start", "__part", "__key"), before
