"""Raw records to isolates and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.sources.fasta import parse_fasta, parse_fasta_string


def classified(raw: DataFrame, default_subtype: str | None = None) -> DataFrame:
    """raw (pos, header, seq, ...) with what header and sequence say; records of no segment are dropped."""
    d = raw.withColumns({"segment": Q.identify_segment("header"), "seq": Q.clean_sequence("seq")}).where("segment is not null")
    return d.withColumns(
        {
            "sequence_id": Q.isolate_id("header"),
            "subtype": F.coalesce(Q.identify_subtype("header"), F.lit(default_subtype).cast("string"), F.lit("H3N2")),
            "collection_date": Q.extract_collection_date("header"),
            "length": F.length("seq"),
            "is_valid": Q.is_valid_sequence("seq"),
            "notes": Q.sequence_notes("seq", "segment"),
        }
    )


def process_records(raw: DataFrame, default_subtype: str | None = None, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(isolates, segments). The first record of an isolate gives its subtype and date, the first of a segment its
    sequence; order names the columns that tell what is first (default: pos). All headers of an isolate are kept."""
    order = order or ["pos"]
    d = classified(raw, default_subtype)
    first = F.struct(*order)
    isolates = d.groupBy("sequence_id").agg(
        F.min_by("subtype", first).alias("subtype"),
        F.min_by(F.struct("collection_date"), first)["collection_date"].alias("collection_date"),
        F.transform(F.array_sort(F.collect_list(F.struct(*order, "header"))), lambda x: x["header"]).alias("source_headers"),
        F.countDistinct("segment").cast("int").alias("segments_found"),
    )
    isolates = isolates.withColumns({"completeness": F.col("segments_found") / F.lit(float(len(C.SEGMENTS))), "is_complete": F.col("segments_found") == len(C.SEGMENTS)})
    w = Window.partitionBy("sequence_id", "segment").orderBy(*order)
    segments = d.withColumn("_r", F.row_number().over(w)).where("_r = 1").select("sequence_id", "segment", "seq", "length", "is_valid", "notes")
    return isolates, segments.join(isolates.select("sequence_id", "subtype"), "sequence_id")


def process_file(spark: SparkSession, path: str, default_subtype: str | None = None) -> tuple[DataFrame, DataFrame]:
    """process_records() of the sequence files of a path; a missing path raises."""
    return process_records(parse_fasta(spark, path), default_subtype, ["file", "pos"])


def process_string(df: DataFrame, text: str, key: str, default_subtype: str | None = None) -> tuple[DataFrame, DataFrame]:
    """process_records() of the texts of a column; key orders the rows."""
    return process_records(parse_fasta_string(df, text, key), default_subtype, [key, "pos"])


def processing_summary(isolates: DataFrame, segments: DataFrame) -> DataFrame:
    """(kind, name, n): totals, isolates by subtype, and coverage of all eight segments, zeros included."""
    spark = isolates.sparkSession
    total = isolates.agg(F.count("*").alias("total_isolates"), F.count_if("is_complete").alias("complete_genomes"), F.count_if(~F.col("is_complete")).alias("partial_genomes"))
    total = total.select(F.explode(F.array(*(F.struct(F.lit("total").alias("kind"), F.lit(c).alias("name"), F.col(c).alias("n")) for c in total.columns))).alias("x")).select("x.*")
    by = isolates.groupBy("subtype").agg(F.count("*").alias("n")).select(F.lit("subtype").alias("kind"), F.col("subtype").alias("name"), "n")
    dim = spark.createDataFrame([(s,) for s in C.SEGMENTS], "name string")
    cover = dim.join(segments.groupBy(F.col("segment").alias("name")).agg(F.count("*").alias("n")), "name", "left")
    return total.union(by).union(cover.select(F.lit("segment").alias("kind"), "name", F.coalesce("n", F.lit(0)).alias("n")))
