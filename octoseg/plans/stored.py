"""Queries that write the given tables into a store and read them back through its operations, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.plans import queries as P
from octoseg.plans.queries import query
from octoseg.runtime import scratch, table
from octoseg.sources import store as S
from octoseg.sources.store import Store

ISO_FULL = "iso as (select sequence_id, max(subtype) as subtype, max(status) as status, max(collection_date) as collection_date from sequences where sequence_id is not null group by 1)"


def new_store(spark: SparkSession) -> Store:
    s = Store(spark, f"{scratch(spark, 'store')}")
    s.initialize(C.Sketch(lanes=64))
    return s


def spoiled(store: Store, name: str, df: DataFrame) -> None:
    """A block that fails after its writes, before what counts is written."""
    try:
        with store.bulk():
            store.put(name, df)
            raise RuntimeError("the block fails")
    except RuntimeError:
        pass


@query(f"with {ISO_FULL} select sequence_id, subtype, collection_date, case when status = 'pending' then 'processed' else status end as status, case when status = 'pending' then 8 else 1 end as segments_found from iso where status is distinct from 'partial' or status is null")
def store_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Isolates inserted once, inserted again without effect, those pending processed, partial ones deleted."""
    i, s = P.isolates(spark, d).drop("metadata_json"), new_store(spark)
    spoiled(s, "sequences", i.withColumn("sequence_id", F.concat("sequence_id", F.lit(" of a failed block"))))
    with s.bulk():
        s.put_new("sequences", i.withColumn("segments_found", F.lit(1)))
        s.put_new("sequences", i.withColumns({"subtype": F.lit("ignored"), "status": F.lit("ignored")}))
    s.update("sequences", i.where("status = 'pending'").withColumns({"status": F.lit("processed"), "segments_found": F.lit(8)}), ["status", "segments_found"])
    s.delete("sequences", i.where("status = 'partial'"))
    return s.rows("sequences").select("sequence_id", "subtype", "collection_date", "status", "segments_found")


@query(f"""with {P.SEG} select sequence_id, segment_name, cluster_version, case when is_orphan = 1 then null when cluster_id is null then 'C0' else cluster_id end as cluster_id, case when is_orphan = 1 then 1.0 else distance_to_centroid end as distance_to_centroid,
case when allele_id is null then segment_name || '.3.9999' else allele_id end as allele_id, k_value, octet_length(kmer_signature)::int as bytes from seg""")
def store_segments(spark: SparkSession, d: str) -> DataFrame:
    """Segments inserted twice, the newer row counting; then cluster assignments, some set to null, and alleles updated."""
    seg, s = P.segments(spark, d).drop("id"), new_store(spark)
    with s.bulk():
        s.put("segment_kmers", seg.withColumns({"cluster_id": F.lit("older"), "allele_id": F.lit("older")}))
        s.put("segment_kmers", seg)
    s.update("segment_kmers", seg.where("is_orphan = 1").withColumns({"cluster_id": F.lit(None).cast("string"), "distance_to_centroid": F.lit(1.0)}), ["cluster_id", "distance_to_centroid"])
    s.update("segment_kmers", seg.where("is_orphan is distinct from 1 and cluster_id is null").withColumn("cluster_id", F.lit("C0")), ["cluster_id"])
    s.update("segment_kmers", seg.where("allele_id is null").withColumn("allele_id", F.concat("segment_name", F.lit(".3.9999"))), ["allele_id"])
    return s.rows("segment_kmers").select("sequence_id", "segment_name", "cluster_version", "cluster_id", "distance_to_centroid", "allele_id", "k_value", F.length("kmer_signature").alias("bytes"))


_CL = "cl as (select * from (select distinct * from clusters) qualify row_number() over (partition by cluster_id, segment_name, subtype, version order by created_at desc, updated_at desc, member_count desc) = 1)"


@query(f"with {_CL} select cluster_id, segment_name, subtype, version, member_count + case when version = 'v1' then 5 else 0 end as member_count, case when version = 'v1' then 'now' else updated_at end as updated_at from cl where is_active = 1")
def store_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters replaced and their counts updated; the active ones of each segment and subtype."""
    c = table(spark, d, "clusters").distinct()
    c = S.latest(c.withColumn("_k", F.struct("created_at", "updated_at", "member_count")), ["cluster_id", "segment_name", "subtype", "version"], "_k").drop("_k")
    s = new_store(spark)
    s.put("clusters", c.withColumns({"member_count": F.lit(0), "is_active": F.lit(1)}))
    s.put("clusters", c)
    s.update("clusters", c.where("version = 'v1'").withColumns({"member_count": F.col("member_count") + 5, "updated_at": F.lit("now")}), ["member_count", "updated_at"])
    return S.active_clusters(s.rows("clusters")).select("cluster_id", "segment_name", "subtype", "version", "member_count", "updated_at")


_AL = "al as (select * from (select distinct * from allele_registry) qualify row_number() over (partition by segment_name, subtype_num, internal_cluster_id, cluster_version order by allele_num, allele_name) = 1)"


@query(f"with {_AL} select allele_name, segment_name, subtype_num, allele_num, internal_cluster_id, cluster_version, case when is_active = 1 then 77 else member_count end as member_count, case when is_active = 1 then 'now' else last_seen end as last_seen, first_seen from al")
def store_alleles(spark: SparkSession, d: str) -> DataFrame:
    """Alleles inserted, known ones ignored, and the count and last_seen of active ones updated."""
    key = ["segment_name", "subtype_num", "internal_cluster_id", "cluster_version"]
    a = table(spark, d, "allele_registry").distinct()
    a = a.groupBy(*key).agg(F.min_by(F.struct(*(c for c in a.columns if c not in key)), F.struct("allele_num", "allele_name")).alias("x")).select(*key, "x.*")
    s = new_store(spark)
    s.put_new("allele_registry", a)
    s.put_new("allele_registry", a.withColumn("allele_name", F.lit("ignored")))
    s.update("allele_registry", a.where("is_active = 1").withColumns({"member_count": F.lit(77), "last_seen": F.lit("now")}), ["member_count", "last_seen"])
    return s.rows("allele_registry").select("allele_name", *key, "allele_num", "member_count", "last_seen", "first_seen")


@query("""with l as (select distinct least(a.allele_name, b.allele_name) as a, greatest(a.allele_name, b.allele_name) as b from allele_registry a join allele_registry b on a.segment_name = b.segment_name and a.allele_num = b.allele_num and a.subtype_num < b.subtype_num)
select a as allele, b as other from l union select b, a from l""")
def store_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Lineage links inserted twice, once each, read in both directions."""
    links, s = P.registry_links(spark, d), new_store(spark)
    s.put_new("allele_lineage", links.withColumn("note", F.lit("first")))
    s.put_new("allele_lineage", links.withColumn("note", F.lit("second")))
    return S.lineage_of(s.rows("allele_lineage").where("note = 'first'"))


_GE = "ge as (select * from (select distinct * from genotypes where sequence_id is not null) qualify row_number() over (partition by sequence_id, cluster_version order by created_at desc, id desc) = 1)"


@query(f"with {_GE} select sequence_id, cluster_version, genotype_profile, coalesce(allele_profile, '?') as allele_profile, constellation_id from ge where constellation_id is not null union all select sequence_id, cluster_version, genotype_profile, coalesce(allele_profile, '?'), null from ge where constellation_id is null")
def store_genotypes(spark: SparkSession, d: str) -> DataFrame:
    """Genotypes replaced by newer ones, profiles updated; those of constellations and those without one."""
    g = table(spark, d, "genotypes").where("sequence_id is not null").distinct()
    g = S.latest(g.withColumn("_k", F.struct("created_at", "id")), ["sequence_id", "cluster_version"], "_k").drop("_k", "id")
    s = new_store(spark)
    s.put("genotypes", g.withColumn("genotype_profile", F.lit("older")))
    s.put("genotypes", g)
    s.update("genotypes", g.where("allele_profile is null").withColumn("allele_profile", F.lit("?")), ["allele_profile"])
    cols = ["sequence_id", "cluster_version", "genotype_profile", "allele_profile", "constellation_id"]
    return s.rows("genotypes").where("constellation_id is not null").select(*cols).union(s.find("genotypes", constellation_id=None).select(*cols))


@query(f"""with {P.GENO}, {_GE}, reg as (select constellation_id, min(allele_profile) as combination, count(*)::int as n from ge where constellation_id is not null group by 1), cur as (select distinct constellation_id from geno where constellation_id is not null)
select constellation_id, coalesce(combination, '') as allele_combination, n as member_count, case when exists (select 1 from cur where cur.constellation_id = reg.constellation_id) then 1 else 0 end as is_active from reg""")
def store_constellations(spark: SparkSession, d: str) -> DataFrame:
    """Constellations registered, counted, and retired if no isolate's newest genotype has them."""
    g = table(spark, d, "genotypes").where("sequence_id is not null").distinct()
    g = S.latest(g.withColumn("_k", F.struct("created_at", "id")), ["sequence_id", "cluster_version"], "_k")
    reg = g.where("constellation_id is not null").groupBy("constellation_id").agg(F.coalesce(F.min("allele_profile"), F.lit("")).alias("allele_combination"), F.count("*").cast("int").alias("n"))
    s = new_store(spark)
    s.put_new("constellation_registry", reg.withColumns({"is_active": F.lit(1), "member_count": F.lit(0)}))
    s.update("constellation_registry", reg.select("constellation_id", F.col("n").alias("member_count")), ["member_count"])
    empty = S.empty_constellations(s.rows("constellation_registry"), P.latest_genotypes(spark, d))
    s.update("constellation_registry", empty.select("constellation_id", F.lit(0).alias("is_active")), ["is_active"])
    return s.rows("constellation_registry").select("constellation_id", "allele_combination", "member_count", "is_active")


@query(f"with {P.GENO}, reg as (select distinct constellation_id from genotypes where constellation_id is not null) select constellation_id from reg where not exists (select 1 from geno where geno.constellation_id = reg.constellation_id)")
def retire_empty(spark: SparkSession, d: str) -> DataFrame:
    """Constellations that no isolate's newest genotype has."""
    reg = table(spark, d, "genotypes").where("constellation_id is not null").select("constellation_id").distinct().withColumns({"is_active": F.lit(1), "allele_combination": F.lit("")})
    return S.empty_constellations(reg, P.latest_genotypes(spark, d)).select("constellation_id")


@query(f"with {P.ISO}, {P.CUR} select sequence_id, segment_name, cluster_id as nearest_cluster, distance_to_centroid as nearest_distance, 0 as resolved from cur where is_orphan = 1")
def store_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Orphans flagged twice; the later flag counts."""
    o = P.current(spark, d).where("is_orphan = 1").select("sequence_id", "segment_name", F.col("cluster_id").alias("nearest_cluster"), F.col("distance_to_centroid").alias("nearest_distance"), F.lit(0).alias("resolved"))
    s = new_store(spark)
    s.put("orphan_sequences", o.withColumns({"nearest_cluster": F.lit("older"), "resolved": F.lit(1)}))
    s.put("orphan_sequences", o)
    return s.rows("orphan_sequences").select("sequence_id", "segment_name", "nearest_cluster", "nearest_distance", "resolved")


@query(f"{P._STAGE0}, t as (select sequence_id, {P._TYPE_SQL} as event_type, discordant_segments from e0) select sequence_id, event_type, discordant_segments, case when event_type = 'complex' then 2 else 1 end as n from t")
def store_events(spark: SparkSession, d: str) -> DataFrame:
    """Events deleted and inserted anew in one block, twice for complex ones; a failed block deletes nothing."""
    from octoseg.operators import reassortment as R

    e = R.screen_alleles(P.allele_rows(spark, d)).select("sequence_id", "event_type", "stage", F.concat_ws(",", "discordant_segments").alias("discordant_segments"), "confidence")
    s = new_store(spark)
    s.put("reassortment_events", e.withColumn("event_type", F.lit("older")))
    spoiled(s, "reassortment_events", e)
    with s.bulk():
        s.delete("reassortment_events", e)
        s.put("reassortment_events", e)
    try:
        with s.bulk():
            s.delete("reassortment_events", e)
            raise RuntimeError("the block fails")
    except RuntimeError:
        pass
    s.put("reassortment_events", e.where("event_type = 'complex'"))
    return s.rows("reassortment_events").groupBy("sequence_id", "event_type", "discordant_segments").agg(F.count("*").cast("int").alias("n"))


@query(f"""with {_CL}, {_AL}, {_GE} select (select count(distinct sequence_id) from sequences where sequence_id is not null) as total_sequences, (select count(*) from (select distinct cluster_id, segment_name, subtype from cl where is_active = 1)) as total_clusters,
(select count(distinct allele_name) from al where is_active = 1) as total_alleles, (select count(distinct constellation_id) from ge where constellation_id is not null) as total_constellations, (select count(*) from ge) as total_genotypes,
(select count(*) from (select distinct sequence_id, segment_name from segment_kmers where is_orphan = 1 and sequence_id is not null and segment_name is not null)) as unresolved_orphans, 0::bigint as reassortment_events""")
def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    """The store's own summary over the given tables."""
    s = new_store(spark)
    with s.bulk():
        s.put("sequences", P.isolates(spark, d))
        c = table(spark, d, "clusters").distinct()
        s.put("clusters", S.latest(c.withColumn("_k", F.struct("created_at", "updated_at", "member_count")), ["cluster_id", "segment_name", "subtype", "version"], "_k"))
        key = ["segment_name", "subtype_num", "internal_cluster_id", "cluster_version"]
        a = table(spark, d, "allele_registry").distinct()
        s.put("allele_registry", a.groupBy(*key).agg(F.min_by(F.struct(*(c for c in a.columns if c not in key)), F.struct("allele_num", "allele_name")).alias("x")).select(*key, "x.*"))
        g = table(spark, d, "genotypes").where("sequence_id is not null").distinct()
        g = S.latest(g.withColumn("_k", F.struct("created_at", "id")), ["sequence_id", "cluster_version"], "_k")
        s.put("genotypes", g)
        s.put("constellation_registry", g.where("constellation_id is not null").select("constellation_id").distinct().withColumn("is_active", F.lit(1)))
        s.put("orphan_sequences", table(spark, d, "segment_kmers").where("is_orphan = 1 and sequence_id is not null and segment_name is not null").select("sequence_id", "segment_name").distinct().withColumn("resolved", F.lit(0)))
    return s.summary()


@query("select * from (values ('hash_seed', '42', '7'), ('k.HA', '21', '19'), ('num_hashes', '64', '128')) as t(name, stored, given)")
def parameter_changes(spark: SparkSession, d: str) -> DataFrame:
    """Which parameters of signatures differ from a store's."""
    given = C.Sketch(128, 7, True, {**C.Sketch().k, "HA": 19}).parameters()
    return S.changed_parameters(new_store(spark).parameters(), spark.createDataFrame(list(given.items()), "name string, value string"))
