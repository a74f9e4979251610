"""Exact deduplication by a stateful stream over keyed, disk-backed state.

1. Each row's normalised text (white-space runs become one space) is digested
   with SHA-256. A narrow table keeps digest, id and content locator (file and
   row number in it); texts stay where they are.
2. A Structured Streaming query reads that table and aggregates by digest. Its
   state has no watermark and never expires; it lives in RocksDB on disk and in
   the checkpoint on shared storage, and holds per digest the smallest
   (id, locator) and the number of rows. Each micro-batch appends the groups it
   changed; the last of each digest counts. Copies within a batch are combined
   before the shuffle, so a hot digest sends one row per task.
3. On hits (digests with more rows) the whole normalised text is compared with
   that of the row at the kept locator. If any differs, those digests are
   grouped again by the whole text.

All steps are DataFrame operations; the only broadcast is of counted digests.

Defined cases: a null text counts as empty; empty texts are equal to each
other; of rows with the same text and the same smallest id the first locator
stays; a null id counts as larger than any other; an empty table gives an empty
result; columns other than id and text are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstats.llm.common import from_files, shuffled, small_or_shuffled, text_or_empty
from lapstats.session import ensure_checkpoint_dir, materialize

#: State on disk. Without preallocation, as a store per shuffle partition is many small stores.
_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # One bound for the memory of all stores of an executor, and stores that are closed soon after the stream has ended.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "128",
    "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(text_or_empty(text), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _locator() -> Column:
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def stream_state(spark: SparkSession, narrow_path: str, schema, files_per_batch: int) -> DataFrame:
    """Digest, kept (id, locator) and group size, as the stream's state has them at the end."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/dedup-{uuid.uuid4().hex}"
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(narrow_path))
    state = rows.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")).alias("first"),
        F.count(F.lit(1)).alias("group_size"))

    def append(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{base}/out/{batch:09d}")

    before = {k: spark.conf.get(k, None) for k in _STATE}
    for k, v in _STATE.items():
        spark.conf.set(k, v)
    try:
        query = (state.writeStream.outputMode("update").trigger(availableNow=True)
                 .option("checkpointLocation", f"{base}/checkpoint").foreachBatch(append).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    batches = len(query.recentProgress)
    if not any(p.numInputRows for p in query.recentProgress):
        empty = state.schema
        return spark.createDataFrame([], empty)
    out = spark.read.parquet(f"{base}/out/*")
    if batches == 1:
        return out.drop("batch")
    return (out.groupBy("digest").agg(F.max_by(F.struct("first", "group_size"), "batch").alias("last"))
            .select("digest", "last.first", "last.group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
                files_per_batch: int = 2000) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 and the row's locator."""
    spark = docs.sparkSession
    docs = from_files(docs, "dedup-docs")
    text = normalised(F.col(text_col))
    narrow = materialize(docs.select(F.col(id_col).alias("doc_id"), digest(text).alias("digest"),
                                     F.sha2(text.cast("binary"), 256).alias("text_sha256"),
                                     _locator().alias("locator")), "dedup-rows")
    state = materialize(stream_state(spark, narrow.inputFiles()[0].rsplit("/", 1)[0], narrow.schema, files_per_batch)
                        if narrow.inputFiles() else spark.createDataFrame([], _state_schema(narrow)), "dedup-state")
    grouped = narrow.join(shuffled(state), "digest").select(
        "doc_id", "digest", "text_sha256", "locator", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("first.locator")).alias("kept"))
    differing = _differing(docs, text_col, state, digest)
    if differing is None:
        return grouped.drop("digest")
    return _regrouped(docs, id_col, text_col, grouped, differing)


def _state_schema(narrow: DataFrame):
    from pyspark.sql import types as T

    kinds = {f.name: f.dataType for f in narrow.schema}
    first = T.StructType([T.StructField("no_id", T.BooleanType()), T.StructField("doc_id", kinds["doc_id"]),
                          T.StructField("locator", kinds["locator"])])
    return T.StructType([T.StructField("digest", kinds["digest"]), T.StructField("first", first),
                         T.StructField("group_size", T.LongType())])


def _differing(docs: DataFrame, text_col: str, state: DataFrame, digest) -> DataFrame | None:
    """Digests of which a row's whole text differs from the kept row's; None if there is none."""
    hits = small_or_shuffled(materialize(
        state.filter("group_size > 1").select("digest", F.col("first.locator").alias("__kept_at"),
                                              F.ceil(F.col("group_size") / 1024).cast("int").alias("__parts")),
        "dedup-hits"))
    text = normalised(F.col(text_col))
    rows = (docs.select(text.alias("__text"), _locator().alias("__at"))
            .withColumn("digest", digest(F.col("__text"))).join(hits, "digest"))
    rows = materialize(rows, "dedup-compare")
    # A large group's copies go to many tasks: the kept text is repeated once for each 1024 copies.
    copies = (rows.filter(F.col("__at") != F.col("__kept_at"))
              .withColumn("__part", F.pmod(F.xxhash64("__at"), F.col("__parts")).cast("int")))
    kept = (rows.filter(F.col("__at") == F.col("__kept_at"))
            .select("digest", F.col("__text").alias("__kept_text"),
                    F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part")))
    # Equal texts take next to no room in a file, so its size says nothing about their rows.
    wrong = materialize(copies.join(shuffled(kept), ["digest", "__part"]).filter("__text <> __kept_text")
                        .select("digest").distinct(), "dedup-wrong")
    return None if wrong.isEmpty() else wrong


def _regrouped(docs: DataFrame, id_col: str, text_col: str, grouped: DataFrame, differing: DataFrame) -> DataFrame:
    """The rows of ``differing`` digests grouped by their whole text, the others as they are."""
    right = grouped.join(differing, "digest", "left_anti").drop("digest")
    again = grouped.join(differing, "digest", "left_semi").select("doc_id", "text_sha256", "locator")
    texts = docs.select(_locator().alias("locator"), normalised(F.col(text_col)).alias("__text"))
    again = again.join(shuffled(texts), "locator")
    groups = again.groupBy("__text").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "locator")).alias("__first"),
        F.count(F.lit(1)).alias("group_size"))
    again = again.join(groups, "__text").select(
        "doc_id", "text_sha256", "locator", F.col("__first.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("__first.locator")).alias("kept"))
    return right.unionByName(again)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one per distinct normalised text, with all their columns."""
    docs = from_files(docs, "dedup-docs")
    dropped = materialize(exact_dedup(docs, id_col, text_col).filter("NOT kept").select("locator"), "dedup-dropped")
    at = "__at"
    while at in docs.columns:  # a name that the table does not have
        at += "_"
    return (docs.select("*", _locator().alias(at))
            .join(small_or_shuffled(dropped.withColumnRenamed("locator", at)), at, "left_anti").select(*docs.columns))
