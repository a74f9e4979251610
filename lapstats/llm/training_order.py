"""Training-order materialisation: every sequence gets a global slot, shards have a fixed stride.

Token ids of a row come as bytes of a fixed width per id. They are cut into
sequences of ``length`` ids, the last filled up with ``pad``. Sequences are
numbered over the whole input, a keyed Feistel permutation with cycle walking
maps the number to a slot, and slot ranges of ``per_shard`` go to one shard each,
sorted by slot. A shard file is raw records of ``length * width`` bytes and one
separator byte, so slot s is at byte ``(s % per_shard) * stride`` of shard
``s // per_shard``: a reader streams a shard, or resumes at any slot, without an
index. ``feistel.invert_int`` tells which sequence a slot holds.

Numbering: sequences are numbered by input split and by their order in it, so
the texts are not shuffled for it. One narrow job counts the sequences of each
split (a row per split reaches the driver); the jobs after it shift by these
counts. File splits are pinned meanwhile, so that they do not follow the number
of executors, and the shards are counted after writing: a sequence too many or
too few is an error, not a silent gap. The payload is shuffled once, by shard;
each task first packs the records it has for a shard into compressed blocks, as
records alone compress badly and the payload is nearly all that is moved.
Shards are written by Spark's text writer on any file system it knows, with its
commit protocol, so lost executors and retried tasks leave no partial shard.

Defined cases: rows with null or empty ids give one sequence (of padding, after
the end mark where one is added); repeated rows are sequences of their own; an
empty table writes no shard; columns other than id and ids are ignored.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstats.llm.common import text_or_empty
from lapstats.llm.feistel import permute
from lapstats.session import ensure_checkpoint_dir

#: Ends a document in byte ids: no UTF-8 text has this byte.
END = b"\xff"
SEPARATOR = "\n"
_SPLITS = "spark.sql.files.minPartitionNum"
_IN_PART = (1 << 33) - 1
#: Bytes of records that a task packs at a time.
_HELD = 32 << 20


def byte_ids(text: Column) -> Column:
    """UTF-8 bytes as token ids 0..254 of width 1, with 255 as the end of the document."""
    return F.concat(text_or_empty(text).cast("binary"), F.lit(END))


@contextmanager
def _pinned_splits(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_SPLITS, None)
    spark.conf.set(_SPLITS, before or spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SPLITS)


def _pack(size: int):
    """Records of a task to compressed blocks by shard, ``_HELD`` bytes at a time."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[int, tuple[list[int], list[bytes]]] = defaultdict(lambda: ([], []))
        records = 0

        def blocks() -> pa.RecordBatch:
            codec, shards = pa.Codec("zstd"), sorted(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.int64()), pa.array([np.array(held[k][0], "<i8").tobytes() for k in shards], pa.binary()),
                 pa.array([codec.compress(b"".join(held[k][1]), asbytes=True) for k in shards], pa.binary())],
                names=["shard", "slots", "records"])
            held.clear()
            return out

        for b in batches:
            for shard, slot, record in zip(*(c.to_pylist() for c in b.columns), strict=True):
                slots, payload = held[shard]
                slots.append(slot)
                payload.append(record)
            records += b.num_rows
            if records * size >= _HELD:
                yield blocks()
                records = 0
        if held:
            yield blocks()

    return pack


def _unpack(size: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        for b in batches:
            for shard, slots, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                slot = np.frombuffer(slots, "<i8")
                raw = codec.decompress(block, decompressed_size=len(slot) * size)
                ends = pa.py_buffer(np.arange(0, (len(slot) + 1) * size, size, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(slot), shard)), pa.array(slot),
                     pa.Array.from_buffers(pa.binary(), len(slot), [None, ends, raw])], names=["shard", "slot", "record"])

    return unpack


def _sequences(rows: DataFrame, length: int, width: int, pad: bytes) -> DataFrame:
    """doc_id, part, n_tokens, record of each sequence; ``rows`` has doc_id and __ids."""
    size = length * width
    held = F.octet_length("__ids")
    last = F.greatest(F.ceil(held / size) - 1, F.lit(0)).cast("int")
    cut = rows.select("doc_id", "__ids", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    record = F.expr(f"substring(__ids, part * {size} + 1, {size})")
    return (cut.withColumn("record", record)
            .select("doc_id", "part", F.expr(f"cast(octet_length(record) div {width} AS int)").alias("n_tokens"),
                    F.rpad("record", size, pad).alias("record")))


def materialise(docs: DataFrame, ids: Column, path: str, length: int = 1024, width: int = 1, pad: bytes = END,
                per_shard: int = 16384, key: int = 987654321, id_col: str = "doc_id") -> DataFrame:
    """Write the shards under ``path``; returns one row per sequence, with its place.

    Returned: doc_id, part, n_tokens, seq_no, slot, shard, byte_offset, record_crc32.
    ``docs`` must be read from files (a scan has the same splits each time).
    """
    spark = docs.sparkSession
    if len(pad) != width:
        raise ValueError("pad must be one id of the given width")
    with _pinned_splits(spark):
        rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(ids, F.lit(b"")).alias("__ids"))
        size = length * width
        counts = (docs.select(F.greatest(F.ceil(F.octet_length(F.coalesce(ids, F.lit(b""))) / size), F.lit(1)).alias("n"))
                  .groupBy(F.spark_partition_id().alias("split")).agg(F.sum("n").cast("long").alias("n")).collect())
        total, starts = 0, []
        for r in sorted(counts, key=lambda r: r["split"]):
            starts.append((r["split"], total))
            total += r["n"]
        if not total:
            return _nothing(spark, rows)
        start = F.broadcast(spark.createDataFrame(starts, "__split int, __start long"))
        numbered = (_sequences(rows, length, width, pad).withColumn("__at", F.monotonically_increasing_id())
                    .withColumn("__split", F.shiftright("__at", 33).cast("int")).join(start, "__split")
                    .withColumn("seq_no", F.col("__start") + F.col("__at").bitwiseAND(F.lit(_IN_PART))))
        slotted = (numbered.withColumn("slot", permute("seq_no", total, key))
                   .withColumn("slot", F.when(F.col("slot") < total, F.col("slot")).otherwise(
                       F.raise_error(F.lit("cycle walking took too many steps: choose another key")).cast("long")))
                   .withColumn("shard", F.expr(f"slot div {per_shard}L")))
        shards = -(-total // per_shard)
        packed = slotted.select("shard", "slot", "record").mapInArrow(_pack(size), "shard long, slots binary, records binary")
        (packed.repartition(shards, "shard").mapInArrow(_unpack(size), "shard long, slot long, record binary")
         .sortWithinPartitions("shard", "slot").select("shard", F.col("record").cast("string").alias("value"))
         .write.mode("overwrite").partitionBy("shard").option("lineSep", SEPARATOR).text(path))
        placed = slotted.select("doc_id", "part", "n_tokens", "seq_no", "slot", "shard",
                                F.expr(f"(slot % {per_shard}L) * {size + 1}L").alias("byte_offset"),
                                F.crc32("record").alias("record_crc32"))
        out = f"{path.rstrip('/')}-places"
        placed.write.mode("overwrite").parquet(out)
    placed = spark.read.parquet(out)
    seen = placed.agg(F.count(F.lit(1)), F.min("slot"), F.max("slot"), F.sum("slot")).first()
    if tuple(seen) != (total, 0, total - 1, total * (total - 1) // 2):
        raise RuntimeError(f"the input's splits changed while it was numbered: {tuple(seen)} for {total} sequences")
    files = (spark.read.format("binaryFile").load(f"{path.rstrip('/')}/shard=*/part-*").select("length")
             .agg(F.count(F.lit(1)), F.sum("length")).first())
    if tuple(files) != (shards, total * (size + 1)):
        raise RuntimeError(f"{files[0]} files of {files[1]} bytes for {shards} shards of {total} records")
    return placed


def _nothing(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return rows.limit(0).select("doc_id", F.lit(0).alias("part"), F.lit(0).alias("n_tokens"), F.lit(0).cast("long").alias("seq_no"),
                                F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("shard"),
                                F.lit(0).cast("long").alias("byte_offset"), F.lit(0).cast("long").alias("record_crc32"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder on the shared storage of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
