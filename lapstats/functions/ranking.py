"""Ranks and running sums of a key without a window over the whole key.

A window over a race sorts the race in one task. Here an ordered piece of it is
the most that one task meets:

1. rows are dealt to ordered pieces: ranges of (key, order) that Spark cuts at
   sampled bounds, or the values of ``piece``, any expression that never falls
   along the order (the head of a hash, which is even by itself);
2. sums run inside each (key, piece);
3. the totals of the pieces, one row per (key, piece), give what lies before
   each piece.

The input is written first, so that both passes see the same rows. Rows equal in
key and order share a piece. NULL keys form a group of their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapstats.functions.aggregates import checked_broadcast
from lapstats.session import materialize

#: Hex digits of a hash that name its piece: 4096 pieces a key.
HASH_PIECE_DIGITS = 3


def hash_piece(order: Column) -> Column:
    """The piece of a row ordered by a hex digest: the digest's first digits."""
    return F.substring(order, 1, HASH_PIECE_DIGITS)


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column], sums: Mapping[str, str | Column],
                 piece: Column | None = None, totals: Mapping[str, str | Column] | None = None) -> DataFrame:
    """``df`` with, per key, the inclusive running sum of each of ``sums`` in ``order`` and the sum of each of
    ``totals`` over the key. Values are integers: sums of floats would depend on where pieces are cut.

    ``order`` must be total within a key for the rows' own results to be defined.
    """
    keys = list(keys)
    totals = dict(totals or {})
    rows = materialize(df if piece is None else df.withColumn("_piece", piece), "ranked_rows")
    if piece is None:
        rows = materialize(rows.repartitionByRange(*keys, *order).withColumn("_piece", F.spark_partition_id()),
                           "ranked_pieces")
    by = keys + ["_piece"]
    parts = rows.groupBy(*by).agg(*[F.sum(c).alias(f"_in_{n}") for n, c in {**sums, **totals}.items()])
    # At most one row per piece of the key.
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    parts = checked_broadcast(parts.select(
        *[F.col(c).alias(f"_p_{c}") for c in by],
        *[F.coalesce(F.sum(f"_in_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        *[F.sum(f"_in_{n}").over(whole).alias(f"_all_{n}") for n in totals]))
    inside = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ran = rows.select("*", *[F.sum(c).over(inside).alias(f"_run_{n}") for n, c in sums.items()])
    match = [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in by]
    kept = [F.col(c) for c in df.columns]
    return ran.join(parts, match).select(
        *kept, *[(F.col(f"_run_{n}") + F.col(f"_before_{n}")).alias(n) for n in sums],
        *[F.col(f"_all_{n}").alias(n) for n in totals])


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str,
                piece: Column | None = None, count: str | None = None) -> DataFrame:
    """``df`` with each row's place in its key from 1 (``name``), and the key's rows (``count``) if asked."""
    one = F.lit(1)
    return running_sums(df, keys, order, {name: one}, piece, {count: one} if count else None)
