"""Triage reports on orphans, from the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_version(seg: DataFrame) -> DataFrame:
    """(cluster_version) of the newest row; null versions don't count."""
    return seg.where("cluster_version is not null").agg(F.max_by("cluster_version", F.struct("created_at", "cluster_version")).alias("cluster_version"))


def orphan_rates(seg: DataFrame, sequences: DataFrame) -> DataFrame:
    """A: (subtype, segment_name, orphans, total, rate). sequences has one row for each sequence_id."""
    j = seg.join(sequences.select("sequence_id", "subtype"), "sequence_id")
    return j.groupBy("subtype", "segment_name").agg(F.count_if(F.col("is_orphan") == 1).alias("orphans"), F.count("*").alias("total")).withColumn("rate", F.col("orphans") / F.col("total"))


def orphan_histogram(seg: DataFrame) -> DataFrame:
    """B: (orphaned, isolates): how many isolates have so many orphaned segments."""
    per = seg.groupBy("sequence_id").agg(F.count_if(F.col("is_orphan") == 1).alias("orphaned"))
    return per.groupBy("orphaned").agg(F.count("*").alias("isolates"))


def orphan_totals(seg: DataFrame) -> DataFrame:
    """B: isolates with any and with all segments orphaned."""
    per = seg.groupBy("sequence_id").agg(F.count_if(F.col("is_orphan") == 1).alias("o"), F.count("*").alias("n"))
    return per.agg(F.count_if(F.col("o") > 0).alias("any_orphaned"), F.count_if(F.col("o") == F.col("n")).alias("all_orphaned"), F.count("*").alias("isolates"))


def minted_or_joined(seg: DataFrame, registry: DataFrame, minted: str = "minted") -> DataFrame:
    """C: (segment_name, minted, joined, unnamed) of orphans: their allele is marked in the registry as minted or not."""
    r = registry.select(F.col("allele_name").alias("allele_id"), F.col(minted).alias("_m"))
    o = seg.where("is_orphan = 1").join(r, "allele_id", "left")
    return o.groupBy("segment_name").agg(F.count_if(F.col("_m") == 1).alias("minted"), F.count_if((F.col("_m") != 1) | (F.col("_m").isNull() & F.col("allele_id").isNotNull())).alias("joined"), F.count_if(F.col("allele_id").isNull()).alias("unnamed"))


def pct(value: str, p: float):
    """A percentile with linear interpolation, as an aggregate; null if there are no values."""
    return F.percentile(value, F.lit(p))


def orphan_distances(seg: DataFrame) -> DataFrame:
    """D1: (segment_name, n, p10, p50, p90, max) of orphans' distances."""
    d = seg.where("is_orphan = 1 and distance_to_centroid is not null and not isnan(distance_to_centroid)")
    x = "distance_to_centroid"
    return d.groupBy("segment_name").agg(F.count("*").alias("n"), pct(x, 0.1).alias("p10"), pct(x, 0.5).alias("p50"), pct(x, 0.9).alias("p90"), F.max(x).alias("max"))


def length_skew(seg: DataFrame) -> DataFrame:
    """D2: (segment_name, orphan_mean, clustered_mean, delta); delta is null unless both means are there and not 0."""
    m = seg.groupBy("segment_name").agg(F.avg(F.when(F.col("is_orphan") == 1, F.col("sequence_length"))).alias("orphan_mean"), F.avg(F.when(F.col("is_orphan") == 0, F.col("sequence_length"))).alias("clustered_mean"))
    return m.withColumn("delta", F.when((F.col("orphan_mean") != 0) & (F.col("clustered_mean") != 0), F.col("orphan_mean") - F.col("clustered_mean")))


def metadata_skew(seg: DataFrame, sequences: DataFrame, heavy: float = 0.5) -> DataFrame:
    """D3: (key, heavy_mean, rest_mean, heavy_n, rest_n): numeric metadata of isolates with many orphans and of the rest."""
    per = seg.groupBy("sequence_id").agg((F.count_if(F.col("is_orphan") == 1) / F.count("*")).alias("f"))
    kv = sequences.select("sequence_id", F.explode(F.from_json("metadata_json", "map<string,string>")).alias("key", "v")).withColumn("v", F.expr("try_cast(v as double)")).where("v is not null")
    j = kv.join(per, "sequence_id")
    h = F.col("f") >= heavy
    return j.groupBy("key").agg(F.avg(F.when(h, F.col("v"))).alias("heavy_mean"), F.avg(F.when(~h, F.col("v"))).alias("rest_mean"), F.count_if(h).alias("heavy_n"), F.count_if(~h).alias("rest_n"))


def cluster_context(clusters: DataFrame) -> DataFrame:
    """(segment_name, clusters, members, smallest, largest)."""
    return clusters.groupBy("segment_name").agg(F.count("*").alias("clusters"), F.sum("member_count").alias("members"), F.min("member_count").alias("smallest"), F.max("member_count").alias("largest"))
