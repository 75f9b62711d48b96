"""Multi-record sequence files and texts as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from octoseg.runtime import hadoop


def parse_text(text: str | Column) -> Column:
    """The records of a text: an array of (pos, header, seq).

    A line that begins with > after its leading blanks opens a record; other lines are joined without outer blanks;
    text before the first header is left out; a header alone has an empty sequence.
    """
    t = F.col(text) if isinstance(text, str) else text
    lines = F.transform(F.split(t, r"\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x85  ]"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    tidy = F.concat(F.lit("\n"), F.array_join(F.filter(lines, lambda x: x != ""), "\n"))
    parts = F.slice(F.split(tidy, "\n>"), 2, 1 << 30)
    return F.transform(parts, lambda p, i: F.struct(i.alias("pos"), F.regexp_replace(F.substring_index(p, "\n", 1), r"(?U)^\s+|\s+$", "").alias("header"), F.when(F.instr(p, "\n") > 0, F.replace(p.substr(F.instr(p, "\n") + 1, F.length(p)), F.lit("\n"), F.lit(""))).otherwise(F.lit("")).alias("seq")))


def parse_fasta_string(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """(*keep, pos, header, seq) of each text."""
    return df.select(*keep, F.explode(parse_text(text)).alias("r")).select(*keep, "r.pos", "r.header", "r.seq")


def parse_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(file, pos, header, seq) of the files of a path; a missing path raises.

    Files are split where a line begins with >, so one large file feeds many tasks and a row is one record, or the
    records from one such line to the next if headers are indented. Text before a file's first header is left out. pos
    orders the records of a file: the split's first byte and the record's number within it, as text of fixed width.
    """
    fs, p = hadoop(spark, path)
    if fs.globStatus(p) is None or not len(fs.globStatus(p)):
        raise FileNotFoundError(path)
    raw = spark.read.option("lineSep", "\n>").text(path)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("id"), "value")
    # the first piece of a file is whole; all others lost their > to the split
    first = raw.where("at = 0").groupBy("file").agg(F.min("id").alias("first"))
    j = raw.join(F.broadcast(first), "file", "left")  # a row a file, two numbers each
    text = F.when(F.col("id") == F.col("first"), F.col("value")).otherwise(F.concat(F.lit(">"), "value"))
    j = j.select("file", "at", "id", F.explode(parse_text(text)).alias("r"))
    pos = F.concat(*(F.lpad(F.hex(c), 16, "0") for c in (F.col("at"), F.col("id"), F.col("r.pos").cast("long"))))
    return j.select("file", pos.alias("pos"), "r.header", "r.seq")
