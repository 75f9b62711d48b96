"""Composite profiles of the eight segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from octoseg import config as C

ASSIGNED, ORPHAN, MISSING = "ASSIGNED", "ORPHAN", "MISSING"


def ordinal(segment: str | Column) -> Column:
    """The place of a segment in the fixed order, from 0; null for other names."""
    s = F.col(segment) if isinstance(segment, str) else segment
    return F.nullif(F.array_position(F.array(*map(F.lit, C.SEGMENTS)), s), F.lit(0)) - 1


def display(status: Column, cluster: Column) -> Column:
    """The cluster id, ? for an orphan, - for a missing segment; a state that breaks its terms raises."""
    return (
        F.when((status == ASSIGNED) & cluster.isNotNull(), cluster)
        .when((status == ORPHAN) & cluster.isNull(), F.lit("?"))
        .when((status == MISSING) & cluster.isNull(), F.lit("-"))
        .otherwise(F.raise_error(F.lit("a segment's state and its cluster don't agree")).cast("string"))
    )


def assign_genotypes(assignments: DataFrame, available: DataFrame | None = None) -> DataFrame:
    """(sequence_id, ord, segment, status, cluster_id, shown): eight rows for each isolate that has an assignment.

    assignments has sequence_id, segment, cluster_id, is_orphan; available (sequence_id, segment) lists valid sequences
    without one, which count as orphans.
    """
    spark = assignments.sparkSession
    dim = spark.createDataFrame(list(enumerate(C.SEGMENTS)), "ord int, segment string")
    ids = assignments.select("sequence_id").distinct()
    a = assignments.groupBy("sequence_id", "segment").agg(F.max(F.when(~F.col("is_orphan"), F.col("cluster_id"))).alias("cluster_id"))
    g = ids.crossJoin(F.broadcast(dim)).join(a.withColumn("_has", F.lit(True)), ["sequence_id", "segment"], "left")  # eight rows
    if available is not None:
        g = g.join(available.select("sequence_id", "segment").distinct().withColumn("_there", F.lit(True)), ["sequence_id", "segment"], "left")
    else:
        g = g.withColumn("_there", F.lit(None).cast("boolean"))
    status = F.when(F.col("cluster_id").isNotNull(), ASSIGNED).when(F.col("_has") | F.col("_there"), ORPHAN).otherwise(MISSING)
    return g.withColumn("status", status).select("sequence_id", "ord", "segment", "status", "cluster_id", display(F.col("status"), F.col("cluster_id")).alias("shown"))


def profiles(long: DataFrame) -> DataFrame:
    """One row for each isolate of assign_genotypes(): its profile in several forms, counts and lists."""
    cell = F.array_sort(F.collect_list(F.struct("ord", "segment", "status", "cluster_id", "shown")))
    p = long.groupBy("sequence_id").agg(cell.alias("s"))
    names = lambda st: F.transform(F.filter("s", lambda x: x["status"] == st), lambda x: x["segment"])
    return p.select(
        "sequence_id",
        F.array_join(F.transform("s", lambda x: x["shown"]), ".").alias("profile_string"),
        F.array_join(F.transform("s", lambda x: F.concat(x["segment"], F.lit(":"), x["shown"])), " | ").alias("segment_profile"),
        F.map_from_entries(F.transform("s", lambda x: F.struct(x["segment"], F.when(x["status"] == ORPHAN, F.lit("?")).otherwise(x["cluster_id"])))).alias("segment_clusters"),
        F.size(names(ASSIGNED)).alias("assigned_count"),
        (F.size(names(ASSIGNED)) / F.lit(8.0)).alias("completeness"),
        (F.size(names(ASSIGNED)) == 8).alias("is_complete"),
        names(MISSING).alias("missing_segments"),
        names(ORPHAN).alias("orphan_segments"),
    )


def parse_profiles(genotypes: DataFrame, *keep: str, profile: str = "genotype_profile") -> DataFrame:
    """(*keep, sequence_id, ord, segment, status, cluster_id) of stored dotted profiles; null and empty ones have no rows."""
    p = F.split(F.upper(F.regexp_replace(profile, r"\s+", "")), r"\.")
    seg = F.array(*map(F.lit, C.SEGMENTS))
    rows = genotypes.where(F.coalesce(F.trim(profile), F.lit("")) != "").select("sequence_id", *keep, F.posexplode(F.slice(p, 1, 8)).alias("ord", "shown"))
    status = F.when(F.col("shown") == "?", ORPHAN).when(F.col("shown").isin("-", ""), MISSING).otherwise(ASSIGNED)
    return rows.select("sequence_id", *keep, "ord", F.get(seg, F.col("ord")).alias("segment"), status.alias("status"), F.when(status == ASSIGNED, F.col("shown")).alias("cluster_id"))


def compare(a: DataFrame, b: DataFrame, on: str = "pair") -> DataFrame:
    """(pair, matching, differing, incomparable, concordance) of two long profiles joined on pair and segment.

    Segments are comparable if both are assigned; concordance is matching over comparable ones, 0 if there are none.
    """
    j = a.select(on, "segment", F.col("cluster_id").alias("x")).join(b.select(on, "segment", F.col("cluster_id").alias("y")), [on, "segment"], "full")
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    m = j.groupBy(on).agg(F.count_if(both & (F.col("x") == F.col("y"))).alias("matching"), F.count_if(both & (F.col("x") != F.col("y"))).alias("differing"), F.count_if(~both).alias("incomparable"))
    return m.withColumn("concordance", F.col("matching") / F.greatest(F.col("matching") + F.col("differing"), F.lit(1)))


def genotype_groups(p: DataFrame) -> DataFrame:
    """(profile_string, size, first_id, sequence_id): each isolate with its group; the members of a group are its rows.

    One form at every size: no group is gathered into a list.
    """
    size = p.groupBy("profile_string").agg(F.count("*").alias("size"), F.min("sequence_id").alias("first_id"))
    return p.select("profile_string", "sequence_id").join(size, "profile_string").select("profile_string", "size", "first_id", "sequence_id")


def genotype_summary(p: DataFrame) -> DataFrame:
    """One row: totals, unique profiles, complete and partial ones, the largest group, singletons."""
    g = p.groupBy("profile_string").agg(F.count("*").alias("size"), F.count_if("is_complete").alias("c"))
    return g.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("total"), F.count("*").alias("unique_profiles"), F.coalesce(F.sum("c"), F.lit(0)).alias("complete"), F.coalesce(F.sum(F.col("size") - F.col("c")), F.lit(0)).alias("partial"),
        F.coalesce(F.max("size"), F.lit(0)).alias("largest_group"), F.count_if(F.col("size") == 1).alias("singletons"),
    )


def genotype_distribution(p: DataFrame) -> DataFrame:
    """(profile_string, size): isolates of each profile, the distribution behind genotype_summary()."""
    return p.groupBy("profile_string").agg(F.count("*").alias("size"))
