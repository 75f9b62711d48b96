"""Result tables as tab-separated and JSON files, formatted by column expressions."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from octoseg.runtime import hadoop


def genotypes_tsv(p: DataFrame) -> DataFrame:
    """Eight text columns of profiles with allele_string and constellation_id."""
    return p.select(
        "sequence_id", "profile_string", F.coalesce("allele_string", F.lit("")).alias("allele_string"), F.coalesce("constellation_id", F.lit("")).alias("constellation_id"),
        F.format_string("%.3f", F.col("completeness").cast("double")).alias("completeness"), F.when(F.col("is_complete"), "True").otherwise("False").alias("is_complete"),
        F.concat_ws(",", "missing_segments").alias("missing_segments"), F.concat_ws(",", "orphan_segments").alias("orphan_segments"),
    )


def clusters_tsv(c: DataFrame) -> DataFrame:
    return c.select("subtype", "segment", "cluster_id", F.col("size").cast("string").alias("member_count"), F.format_string("%.4f", F.col("mean_diameter").cast("double")).alias("mean_diameter"))


def orphans_tsv(a: DataFrame) -> DataFrame:
    d = F.when(F.col("nearest_distance").isNotNull(), F.format_string("%.4f", F.col("nearest_distance").cast("double"))).otherwise("")
    return a.where("is_orphan").select("sequence_id", "segment", F.coalesce("nearest_cluster", F.lit("")).alias("nearest_cluster"), d.alias("nearest_distance"))


def orphan_counts_tsv(a: DataFrame) -> DataFrame:
    return a.where("is_orphan").groupBy("segment").agg(F.count("*").cast("string").alias("orphan_count")).orderBy("segment")


def events_tsv(e: DataFrame) -> DataFrame:
    return e.select("sequence_id", F.col("stage").cast("string").alias("detection_stage"), "event_type", F.concat_ws(",", "discordant_segments").alias("discordant_segments"), F.format_string("%.4f", F.col("confidence")).alias("confidence"), F.col("evidence").alias("description"))


def validation_tsv(v: DataFrame, n: int) -> DataFrame:
    """Rows of validate_events(); an event is concordant if all its discordant segments are significant."""
    ok = v.groupBy("sequence_id").agg(F.every("significant").alias("concordant"))
    return v.join(ok, "sequence_id").select("sequence_id", F.when(F.col("concordant"), "True").otherwise("False").alias("concordant"), F.lit(str(n)).alias("n_permutations"), "segment", F.format_string("%.6f", F.col("p")).alias("empirical_p"), F.format_string("%.6f", F.col("observed")).alias("combined_p"))


def write_tsv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """A folder of tab-separated parts with a header; one_file is for results that are small by their nature."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("quote", "").csv(path)


def write_summary(spark: SparkSession, summary: dict, path: str) -> None:
    """A dictionary as JSON on any file system; what JSON doesn't know becomes text."""
    fs, p = hadoop(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(json.dumps(summary, indent=2, default=str, sort_keys=True).encode()))
    out.close()


def run_report(s: dict) -> str:
    """The console report of a run: what came in, clusters and orphans, events by stage."""
    lines = [f"octoseg {s['mode']} run", f"  isolates    {s['total_isolates']} ({s['complete_genomes']} complete)"]
    lines += [f"    {k:<12}{v}" for k, v in sorted(s["by_subtype"].items())]
    lines += [f"  genotypes   {s['unique_genotypes']} different", f"  clusters    {s['total_clusters']}", f"  orphans     {s['total_orphans']}"]
    lines.append(f"  events      {s['reassortment_events']} (stage 0: {s['reassortment_stage0']}, 1: {s['reassortment_stage1']}, 2: {s['reassortment_stage2']})")
    return "\n".join(lines)


def repair_report(segment: str, subtype: str, allele: str, r: dict) -> str:
    """The console report of a repair, or of a dry one."""
    head = f"repair of {allele} on {segment} of {subtype}: {r['affected']} segments carry it"
    if r["new_allele"] is None:
        return f"{head}; nothing was changed"
    return f"{head}\n  new name    {r['new_allele']}\n  retired     {r['retired_constellations']} constellations"
