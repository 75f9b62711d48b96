"""Files that keep arriving, assigned batch by batch to the reference clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from octoseg.plans.pipeline import Pipeline
from octoseg.sources.fasta import parse_fasta_string


def read_fasta_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """(file, pos, header, seq) of the files of a folder as they arrive."""
    raw = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(path, wholetext=True)
    return parse_fasta_string(raw.select(F.input_file_name().alias("file"), "value"), "value", "file")


def ingest_stream(pipeline: Pipeline, path: str, checkpoint: str, subtype: str | None = None, available_now: bool = True, detect: bool = True) -> StreamingQuery:
    """Run the incremental pipeline on each micro-batch. A repeated batch finds its isolates known and adds nothing."""

    def batch(df: DataFrame, _: int) -> None:
        pipeline.run_incremental(df, subtype, detect=detect)

    w = read_fasta_stream(pipeline.spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")).start()
