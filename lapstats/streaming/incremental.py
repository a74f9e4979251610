"""Incremental race processing with Structured Streaming (S15 as a stream).

The reference skips races it has already processed. Here a file stream finds new
race files in the raw folder; each micro-batch reads them with the batch scan, by
header, runs the pipeline on their races and records races and files in the
ledger. A file of a race that is complete already reruns the race from all its
files, whenever it comes. ``availableNow`` processes everything that is new and
stops, so the same job serves scheduled runs; the stream's checkpoint (on shared
storage) remembers which files were consumed, and a batch that is repeated after
a failure finds its files in the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapstats.plans.pipeline import run_pipeline
from lapstats.sources.files import read_raw_laps_csv

_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def start_incremental(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str, season: int,
                      with_models: bool = False, files_per_batch: int | None = None):
    """Start the stream; returns the StreamingQuery (call ``awaitTermination``)."""
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", "*_laps_raw.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def process(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.collect()]  # names only
        laps = read_raw_laps_csv(batch.sparkSession, files, season=season)
        run_pipeline(batch.sparkSession, laps, out_dir, with_models=with_models, incremental=True)

    return (reader.load(raw_dir).select("path").writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
