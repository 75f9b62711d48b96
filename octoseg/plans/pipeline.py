"""Batch, incremental, recluster and repair runs over a store."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.operators import clustering as K
from octoseg.operators import genotypes as G
from octoseg.operators import isolates as I
from octoseg.operators import minhash as M
from octoseg.operators import naming as N
from octoseg.operators import reassortment as R
from octoseg.runtime import stage
from octoseg.sources.store import Store, active_clusters, empty_constellations, latest_cluster_version, segment_signatures, without_known


def now() -> str:
    return datetime.now(timezone.utc).replace(tzinfo=None).isoformat()


class Pipeline:
    """Runs over raw records (file, pos, header, seq); every step is a DataFrame, results go to the store."""

    def __init__(self, store: Store, settings: C.Settings | None = None, name_orphans: bool = False) -> None:
        self.store, self.settings, self.spark, self.name_orphans = store, settings or C.Settings(), store.spark, name_orphans

    def initialize(self, allow_param_change: bool = False) -> None:
        """Test the hash, then check or stamp the store's parameters, before anything is written."""
        M.selftest()
        self.store.initialize(self.settings.sketch, allow_param_change)

    # --- steps --------------------------------------------------------------------------------------------------------

    def _ingest(self, raw: DataFrame, subtype: str | None, version: str, skip_existing: bool) -> tuple[DataFrame, DataFrame]:
        order = [c for c in ("file", "pos") if c in raw.columns]
        isolates, segments = I.process_records(raw, subtype, order)
        if skip_existing:
            known = self.store.rows("sequences").select("sequence_id")
            isolates, segments = without_known(isolates, known), without_known(segments, known)
        isolates = stage(isolates, "isolates")
        sigs = stage(M.build_signatures(segments.where("is_valid").join(isolates.select("sequence_id"), "sequence_id", "left_semi"), self.settings.sketch).withColumn("lanes", Q.signature_lanes("kmer_signature")), "signatures")
        t = F.lit(now())
        status = F.when(F.col("is_complete"), "processed").otherwise("partial")
        self.store.put_new("sequences", isolates.withColumns({"metadata_json": F.to_json(F.struct("source_headers")), "status": status, "created_at": t, "updated_at": t}))
        self.store.put("segment_kmers", sigs.withColumns({"segment_name": F.col("segment"), "sequence_length": F.col("length"), "cluster_version": F.lit(version), "created_at": t}))
        return isolates, sigs

    def _persist_assignments(self, assignments: DataFrame, version: str) -> None:
        a = assignments.select("sequence_id", F.col("segment").alias("segment_name"), F.lit(version).alias("cluster_version"), "cluster_id", F.coalesce("nearest_distance", "distance").alias("distance_to_centroid"), F.col("is_orphan").cast("int").alias("is_orphan"), "nearest_cluster", "nearest_distance")
        a = stage(a, "assigned")
        self.store.update("segment_kmers", a, ["cluster_id", "distance_to_centroid", "is_orphan"])
        self.store.put("orphan_sequences", a.where("is_orphan = 1").withColumns({"resolved": F.lit(0), "flagged_at": F.lit(now())}))

    def _registry(self) -> DataFrame:
        return self.store.rows("allele_registry").where("is_active = 1").select(F.col("segment_name").alias("segment"), "subtype_num", "allele_name", "allele_num", "internal_cluster_id", "cluster_version", Q.signature_lanes("centroid_signature").alias("lanes"))

    def _names(self, assignments: DataFrame, sigs: DataFrame, centroids: DataFrame, version: str) -> DataFrame:
        """Allele of each assigned (sequence_id, segment); new names and last-seen counts go to the registry."""
        real = assignments.where("cluster_id is not null")
        founders = real.groupBy("subtype", "segment", "cluster_id").agg(F.min("sequence_id").alias("first_id")).join(centroids.select("subtype", "segment", "cluster_id", "lanes", "sig"), ["subtype", "segment", "cluster_id"]).withColumn("late", F.lit(False))
        if self.name_orphans:
            own = assignments.where("is_orphan").select("subtype", "segment", "sequence_id").join(sigs.select("sequence_id", "segment", "lanes", F.col("kmer_signature").alias("sig")), ["sequence_id", "segment"])
            founders = founders.unionByName(own.select("subtype", "segment", F.concat(F.lit("ORPHAN::"), "sequence_id").alias("cluster_id"), F.col("sequence_id").alias("first_id"), "lanes", "sig", F.lit(True).alias("late")))
        founders = stage(founders.withColumn("cluster_version", F.lit(version)), "founders")
        names, lineage = N.assign_alleles(founders, self._registry(), self.settings.grouping)
        a = assignments.withColumn("cluster_key", F.coalesce("cluster_id", F.concat(F.lit("ORPHAN::"), "sequence_id")))
        alleles = a.join(names.select("segment", "subtype", F.col("cluster_id").alias("cluster_key"), "allele_name"), ["segment", "subtype", "cluster_key"], "left")
        alleles = stage(alleles.select("sequence_id", "segment", "subtype", F.col("allele_name").alias("allele"), G.ordinal("segment").alias("ord")), "alleles")
        t = F.lit(now())
        row = names.where("how <> 'known'").join(founders.select("segment", "subtype", "cluster_id", "sig"), ["segment", "subtype", "cluster_id"])
        num = F.coalesce("allele_num", F.regexp_extract("allele_name", r"\.(\d+)$", 1).cast("int"))
        self.store.put_new("allele_registry", row.select("allele_name", F.col("segment").alias("segment_name"), "subtype_num", num.alias("allele_num"), F.col("cluster_id").alias("internal_cluster_id"), "cluster_version", F.when(F.col("how") == "minted", F.col("sig")).alias("centroid_signature"), F.lit(1).alias("member_count"), t.alias("first_seen"), t.alias("last_seen"), F.lit(1).alias("is_active")))  # other clusters of a name add no centroid
        counts = alleles.where("allele is not null").groupBy(F.col("allele").alias("allele_name")).agg(F.count("*").cast("int").alias("member_count"))
        self.seen_alleles(counts)
        self.store.put_new("allele_lineage", lineage.withColumns({"note": F.lit("named across subtypes"), "created_at": t}))
        self.store.update("segment_kmers", alleles.where("allele is not null").select("sequence_id", F.col("segment").alias("segment_name"), F.lit(version).alias("cluster_version"), F.col("allele").alias("allele_id")), ["allele_id"])
        return alleles

    def seen_alleles(self, counts: DataFrame) -> None:
        """Registry rows of the names in counts (allele_name, member_count) get the run's counts and are seen now."""
        keys = self.store.rows("allele_registry").select("segment_name", "subtype_num", "internal_cluster_id", "cluster_version", "allele_name")
        self.store.update("allele_registry", stage(keys.join(counts, "allele_name").withColumn("last_seen", F.lit(now())), "seen"), ["member_count", "last_seen"])

    def seen_constellations(self, counts: DataFrame) -> None:
        """The same for constellations: counts has (constellation_id, member_count)."""
        keys = self.store.rows("constellation_registry").select("constellation_id")
        self.store.update("constellation_registry", stage(keys.join(counts, "constellation_id").withColumn("last_seen", F.lit(now())), "seen"), ["member_count", "last_seen"])

    def _genotypes(self, assignments: DataFrame, sigs: DataFrame, alleles: DataFrame, isolates: DataFrame, version: str) -> tuple[DataFrame, DataFrame]:
        long = stage(G.assign_genotypes(assignments, sigs), "long")
        known = self.store.rows("constellation_registry")
        cons = stage(N.constellations(alleles, isolates, known, self.settings.grouping), "constellations")
        if not N.collisions(cons).isEmpty():
            raise RuntimeError("two allele combinations have one constellation id")
        p = stage(G.profiles(long).join(cons, "sequence_id", "left"), "profiles")
        t = F.lit(now())
        new = cons.where("constellation_id is not null").groupBy("constellation_id").agg(F.first("combination").alias("allele_combination"))
        self.store.put_new("constellation_registry", new.select("constellation_id", F.substring_index("constellation_id", "-", 1).alias("subtype_prefix"), "allele_combination", t.alias("first_seen"), t.alias("last_seen"), F.lit(1).alias("is_active")))
        self.seen_constellations(cons.where("constellation_id is not null").groupBy("constellation_id").agg(F.count("*").cast("int").alias("member_count")))
        self.store.put("genotypes", p.select("sequence_id", F.col("profile_string").alias("genotype_profile"), F.col("allele_string").alias("allele_profile"), "constellation_id", F.lit(version).alias("cluster_version"), F.lit(0.0).alias("reassortment_score"), F.lit(0).alias("reassortment_flag"), "completeness", t.alias("created_at")))
        return long, p

    def _detect(self, long: DataFrame, sigs: DataFrame, alleles: DataFrame, isolates: DataFrame) -> DataFrame:
        q = long.join(isolates.select("sequence_id", "subtype"), "sequence_id").withColumn("cluster_id", F.when(F.col("cluster_id").isNotNull(), F.concat("subtype", F.lit(":"), "cluster_id"))).drop("subtype")
        ev = stage(R.detect(q, sigs, alleles.where("allele is not null"), self.settings.screen, self.store.rows("allele_lineage")), "events")
        with self.store.bulk():
            self.store.delete("reassortment_events", isolates)
            self.store.put("reassortment_events", ev.select("sequence_id", "event_type", "stage", F.concat_ws(",", "discordant_segments").alias("discordant_segments"), "confidence", F.when(F.col("stage") == 2, F.concat(F.lit("[Stage 2] "), "evidence")).otherwise(F.col("evidence")).alias("description"), F.lit(now()).alias("created_at")))
        return ev

    # --- runs -----------------------------------------------------------------------------------------------------------

    def run(self, raw: DataFrame, subtype: str | None = None, version: str = "v1", detect: bool = True, mode: str = "batch", retire_others: bool = False) -> dict:
        """Cluster all records anew under a version; its older rows are replaced. retire_others makes the clusters of
        other versions of the same subtypes inactive, in the commit that brings the new ones."""
        with self.store.bulk():
            isolates, sigs = self._ingest(raw, subtype, version, False)
        if sigs.isEmpty():
            return {"isolates": isolates, "summary": self.summary(mode, isolates)}
        K.validate_inputs(sigs, group=["subtype", "segment"])
        clusters, assignments = K.cluster_signatures(sigs, self.settings.grouping, version)
        assignments = stage(assignments, "assignments")
        t = F.lit(now())
        with self.store.bulk():
            if retire_others:
                others = self.store.rows("clusters").join(isolates.select("subtype").distinct(), "subtype", "left_semi").where((F.col("version") != version) & (F.col("is_active") == 1))
                self.store.update("clusters", stage(others.withColumns({"is_active": F.lit(0), "updated_at": t}), "others"), ["is_active", "updated_at"])
            cl = stage(clusters.join(sigs.select("subtype", "segment", F.col("sequence_id").alias("medoid"), F.col("kmer_signature").alias("sig"), "lanes"), ["subtype", "segment", "medoid"]), "centroids")
            stale = self.store.rows("clusters").where(F.col("version") == version).withColumn("is_active", F.lit(0))
            self.store.update("clusters", stage(stale, "stale"), ["is_active"])
            self.store.put("clusters", cl.select("cluster_id", F.col("segment").alias("segment_name"), "subtype", F.col("sig").alias("centroid_signature"), F.col("size").alias("member_count"), "mean_diameter", "version", F.lit(1).alias("is_active"), t.alias("created_at"), t.alias("updated_at")))
        with self.store.bulk():
            self._persist_assignments(assignments, version)
        return self._finish(isolates, sigs, assignments, cl, version, detect, mode)

    def _finish(self, isolates: DataFrame, sigs: DataFrame, assignments: DataFrame, centroids: DataFrame, version: str, detect: bool, mode: str) -> dict:
        with self.store.bulk():
            alleles = self._names(assignments, sigs, centroids, version)
        with self.store.bulk():
            long, profiles = self._genotypes(assignments, sigs, alleles, isolates, version)
        out = {"isolates": isolates, "signatures": sigs, "assignments": assignments, "clusters": centroids, "alleles": alleles, "long": long, "profiles": profiles, "version": version}
        if detect:
            out["events"] = self._detect(long, sigs, alleles, isolates)
        out["summary"] = self.summary(mode, isolates, profiles, assignments, out.get("events"))
        run = [(uuid.uuid4().hex, version, mode, now(), json.dumps(out["summary"], sort_keys=True))]
        self.store.put("clustering_runs", self.spark.createDataFrame(run, "run_id string, version string, mode string, created_at string, summary string"))
        return out

    def reference_clusters(self, subtypes: DataFrame, version: str | None = None) -> DataFrame:
        """Active clusters of a version, or of the newest one of each segment and subtype; subtypes has the column subtype."""
        c = active_clusters(self.store.rows("clusters"), version=version).join(subtypes.select("subtype").distinct(), "subtype", "left_semi")
        c = c if version else c.join(latest_cluster_version(c), ["segment_name", "subtype", "version"])
        lanes = Q.signature_lanes("centroid_signature")
        return c.select("subtype", F.col("segment_name").alias("segment"), "cluster_id", F.col("centroid_signature").alias("sig"), lanes.alias("lanes"), lanes.alias("centroid"), "version", "member_count", "mean_diameter")

    def run_incremental(self, raw: DataFrame, subtype: str | None = None, version: str | None = None, detect: bool = True) -> dict:
        """Assign isolates that aren't known yet to the reference clusters; centroids stay as they are.

        A version that is named is the one whose clusters are used; without one the newest of each segment and subtype.
        """
        resolved = version
        if resolved is None:
            r = active_clusters(self.store.rows("clusters")).agg(F.max_by("version", F.struct("created_at", "version"))).first()
            resolved = r[0] or "incremental"
        with self.store.bulk():
            isolates, sigs = self._ingest(raw, subtype, resolved, True)
        if sigs.isEmpty():
            return {"isolates": isolates, "summary": self.summary("incremental", isolates)}
        ref = stage(self.reference_clusters(sigs, version), "reference")
        a = K.assign_to_existing(sigs, ref, self.settings.grouping)
        a = stage(a.withColumn("nearest_distance", F.when(F.col("nearest_cluster").isNotNull(), F.col("distance"))), "assignments")
        with self.store.bulk():
            self._persist_assignments(a, resolved)
            more = a.where("cluster_id is not null").groupBy("cluster_id", "subtype", "segment").agg(F.count("*").cast("int").alias("more"))
            c = ref.join(more, ["cluster_id", "subtype", "segment"]).select("cluster_id", F.col("segment").alias("segment_name"), "subtype", "version", (F.col("member_count") + F.col("more")).alias("member_count"), F.lit(now()).alias("updated_at"))
            self.store.update("clusters", stage(c, "counts"), ["member_count", "updated_at"])
        return self._finish(isolates, sigs, a, ref, resolved, detect, "incremental")

    def run_recluster(self, raw: DataFrame, subtype: str | None = None, version: str | None = None, detect: bool = True) -> dict:
        """run() under a version of today; other versions of its subtypes become inactive."""
        return self.run(raw, subtype, version or "v" + datetime.now(timezone.utc).strftime("%Y%m%d"), detect, "recluster", True)

    def affected_by(self, segment: str, subtype: str, allele: str, version: str) -> DataFrame:
        """Stored segments of a subtype that carry a misnamed allele."""
        return segment_signatures(self.store.rows("segment_kmers"), self.store.rows("sequences"), subtype, segment, version).where(F.col("allele_id") == allele)

    def repair_allele_subtype(self, segment: str, subtype: str, allele: str, version: str, dry_run: bool = False) -> dict:
        """Name the segments that carry a misnamed allele anew, without it as a candidate, and mend what rests on it."""
        hit = stage(self.affected_by(segment, subtype, allele, version), "affected")
        n = hit.count()
        if dry_run or not n:
            return {"affected": n, "new_allele": None}
        first = hit.orderBy("sequence_id").limit(1)
        founder = first.select(F.lit(segment).alias("segment"), F.lit(subtype).alias("subtype"), F.lit(version).alias("cluster_version"), F.concat(F.lit("REPAIR::"), "sequence_id").alias("cluster_id"), Q.signature_lanes("kmer_signature").alias("lanes"), F.col("sequence_id").alias("first_id"), F.lit(False).alias("late"), F.col("kmer_signature").alias("sig"))
        num = Q.subtype_number(F.lit(subtype))
        names, _ = N.assign_alleles(founder, self._registry().where((F.col("allele_name") != allele) & (F.col("subtype_num") == num)), self.settings.grouping)
        new = names.first()["allele_name"]
        t = F.lit(now())
        with self.store.bulk():
            row = names.where("how = 'minted'").join(founder.select("cluster_id", "sig"), "cluster_id")
            self.store.put_new("allele_registry", row.select("allele_name", F.col("segment").alias("segment_name"), "subtype_num", "allele_num", F.col("cluster_id").alias("internal_cluster_id"), "cluster_version", F.col("sig").alias("centroid_signature"), F.lit(n).alias("member_count"), t.alias("first_seen"), t.alias("last_seen"), F.lit(1).alias("is_active")))
            self.store.put_new("allele_lineage", self.spark.createDataFrame([(min(new, allele), max(new, allele), "repair", now())], "allele_a string, allele_b string, note string, created_at string"))
            self.store.update("segment_kmers", hit.select("sequence_id", "segment_name", "cluster_version", F.lit(new).alias("allele_id")), ["allele_id"])
            g = self.store.rows("genotypes").where(F.col("cluster_version") == version).join(hit.select("sequence_id"), "sequence_id", "left_semi")
            prof = F.array_join(F.transform(F.split("allele_profile", r"\s*\|\s*"), lambda x: F.when(x == allele, F.lit(new)).otherwise(x)), " | ")
            g = stage(g.withColumn("allele_profile", prof), "repaired")
            long = g.select("sequence_id", F.posexplode(F.split("allele_profile", r"\s*\|\s*")).alias("ord", "a")).where("a not in ('?', '-', '')")
            cons = N.constellations(long.select("sequence_id", F.get(F.array(*map(F.lit, C.SEGMENTS)), F.col("ord")).alias("segment"), F.col("a").alias("allele")), g.select("sequence_id", F.lit(subtype).alias("subtype")), self.store.rows("constellation_registry"), self.settings.grouping)
            cons = stage(cons, "constellations")
            self.store.put_new("constellation_registry", cons.where("constellation_id is not null").groupBy("constellation_id").agg(F.first("combination").alias("allele_combination")).select("constellation_id", F.substring_index("constellation_id", "-", 1).alias("subtype_prefix"), "allele_combination", t.alias("first_seen"), t.alias("last_seen"), F.lit(1).alias("is_active")))
            self.store.put("genotypes", g.drop("constellation_id").join(cons.select("sequence_id", "constellation_id"), "sequence_id", "left"))
            self.store.delete("reassortment_events", hit)
            empty = stage(empty_constellations(self.store.rows("constellation_registry"), self.store.rows("genotypes"), allele), "empty")
            self.store.update("constellation_registry", empty.withColumns({"is_active": F.lit(0), "last_seen": t}), ["is_active", "last_seen"])
        return {"affected": n, "new_allele": new, "retired_constellations": empty.count()}

    def validate_reassortments(self, events: DataFrame, long: DataFrame, n: int = 5000) -> DataFrame:
        """Permutation p-values of the stage 1 events of a run."""
        return R.validate_events(events.where("stage = 1"), long, self.settings.screen, n)

    def summary(self, mode: str, isolates: DataFrame, profiles: DataFrame | None = None, assignments: DataFrame | None = None, events: DataFrame | None = None) -> dict:
        """Counts of a run; a few numbers come to the driver."""
        i = isolates.agg(F.count("*"), F.count_if("is_complete")).first()
        out = {"mode": mode, "total_isolates": i[0], "complete_genomes": i[1], "by_subtype": {r[0]: r[1] for r in isolates.groupBy("subtype").count().collect()}}
        out["unique_genotypes"] = G.genotype_summary(profiles).first()["unique_profiles"] if profiles is not None else 0
        m = K.cluster_metrics(assignments).agg(F.sum("num_clusters"), F.sum("num_orphans")).first() if assignments is not None else (0, 0)
        out["total_clusters"], out["total_orphans"] = (0 if mode == "incremental" else m[0] or 0), m[1] or 0
        s = {r[0]: r[1] for r in events.groupBy("stage").count().collect()} if events is not None else {}
        out |= {"reassortment_events": sum(s.values()), **{f"reassortment_stage{k}": s.get(k, 0) for k in (0, 1, 2)}}
        return out
