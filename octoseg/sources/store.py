"""The store: one folder of parquet tables, each an append-only log with a view of the current rows.

A write adds a folder of its own name; a commit file lists the folders of a block and makes them visible at once, so
readers never see half of it and what a failed block left behind is never read. One writer at a time. A row of a log
sets all columns of its key, or some of them, or deletes it; the view takes each column from the newest row that sets it.
Updates are appended without a look at the history.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from octoseg import config as C

#: Tables: columns and the key of a row; a table without one keeps all rows, deleted by their sequence_id.
TABLES: dict[str, tuple[str, list[str]]] = {
    "schema_info": ("key string, value string, updated_at string", ["key"]),
    "sequences": ("sequence_id string, collection_date string, subtype string, metadata_json string, status string, segments_found int, created_at string, updated_at string", ["sequence_id"]),
    "segment_kmers": ("sequence_id string, segment_name string, k_value int, kmer_signature binary, sequence_length int, cluster_id string, allele_id string, cluster_version string, distance_to_centroid double, is_orphan int, created_at string", ["sequence_id", "segment_name", "cluster_version"]),
    "genotypes": ("sequence_id string, genotype_profile string, allele_profile string, constellation_id string, cluster_version string, reassortment_score double, reassortment_flag int, completeness double, created_at string", ["sequence_id", "cluster_version"]),
    "clusters": ("cluster_id string, segment_name string, subtype string, centroid_signature binary, member_count int, mean_diameter double, version string, is_active int, created_at string, updated_at string", ["cluster_id", "segment_name", "subtype", "version"]),
    "allele_registry": ("allele_name string, segment_name string, subtype_num int, allele_num int, internal_cluster_id string, cluster_version string, centroid_signature binary, member_count int, first_seen string, last_seen string, is_active int", ["segment_name", "subtype_num", "internal_cluster_id", "cluster_version"]),
    "allele_lineage": ("allele_a string, allele_b string, note string, created_at string", ["allele_a", "allele_b"]),
    "constellation_registry": ("constellation_id string, subtype_prefix string, allele_combination string, member_count int, first_seen string, last_seen string, is_active int", ["constellation_id"]),
    "orphan_sequences": ("sequence_id string, segment_name string, nearest_cluster string, nearest_distance double, resolved int, flagged_at string", ["sequence_id", "segment_name"]),
    "reassortment_events": ("sequence_id string, event_type string, stage int, discordant_segments string, confidence double, description string, created_at string", []),
    "clustering_runs": ("run_id string, version string, mode string, created_at string, summary string", ["run_id"]),
}
#: What a log has besides: the columns a row sets (null: all), whether it deletes, and its place in the order of writes.
OWN = "_set array<string>, _deleted boolean, _seq long"
PARAMETER = "signature."


class SignatureFingerprintMismatch(RuntimeError):
    """The store holds signatures made with other parameters."""


def columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().split(" ")) for c in TABLES[name][0].split(",")]


def latest(df: DataFrame, key: list[str], by: str) -> DataFrame:
    """The row of each key with the greatest value of `by`."""
    w = Window.partitionBy(*key).orderBy(F.desc(by))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


class Store:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._open: list[dict] | None = None
        self._read: dict[int, list[dict]] = {}  # commits never change

    # --- commits ------------------------------------------------------------------------------------------------------

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def commits(self) -> list[int]:
        fs, p = self._fs(f"{self.path}/_commits")
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n) for n in names if n.isdigit())

    def _writes(self) -> list[dict]:
        """The writes of all commits in order, then those of the open block."""
        out = []
        for n in self.commits():
            if n not in self._read:
                fs, p = self._fs(f"{self.path}/_commits/{n}")
                stream = fs.open(p)
                try:
                    self._read[n] = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
                finally:
                    stream.close()
            out += self._read[n]
        return out + (self._open or [])

    def _commit(self, n: int, writes: list[dict]) -> None:
        fs, tmp = self._fs(f"{self.path}/_commits/.{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(writes).encode()))
        out.close()
        if not fs.rename(tmp, self._fs(f"{self.path}/_commits/{n}")[1]):
            raise RuntimeError(f"commit {n} of {self.path} was made by another writer")

    @contextmanager
    def bulk(self) -> Iterator[None]:
        """All writes within become visible at once, or none if an error ends the block."""
        if self._open is not None:
            yield
            return
        self._open = []
        try:
            yield
            if self._open:
                self._commit((self.commits() or [0])[-1] + 1, self._open)
        finally:
            self._open = None

    # --- rows ---------------------------------------------------------------------------------------------------------

    def initialize(self, sketch: C.Sketch | None = None, allow_change: bool = False) -> None:
        """Stamp a new store; on an old one check that signatures stay comparable (see ensure_parameters)."""
        if sketch is not None:
            self.ensure_parameters(sketch, allow_change)

    def log(self, name: str) -> DataFrame:
        """All visible rows of a table's log; an empty table if nothing was written."""
        schema, paths = f"{TABLES[name][0]}, {OWN}", []
        for w in self._writes():
            if w["table"] == name:
                paths = [w["folder"]] if w.get("whole") else [*paths, w["folder"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{name}/{p}" for p in paths))

    def rows(self, name: str) -> DataFrame:
        """The current rows of a table, by one aggregate over its log."""
        cols, key, log = [c for c, _ in columns_of(name)], TABLES[name][1], self.log(name)
        if not key:
            gone = log.where("_deleted").groupBy("sequence_id").agg(F.max("_seq").alias("_gone"))
            return log.where("not _deleted").join(gone, "sequence_id", "left").where("_gone is null or _seq > _gone").select(*cols)
        sets = lambda c: F.max_by(F.struct(c), F.when(~F.col("_deleted") & (F.col("_set").isNull() | F.array_contains("_set", c)), F.col("_seq")))[c].alias(c)
        whole, gone = F.max(F.when(~F.col("_deleted") & F.col("_set").isNull(), F.col("_seq"))), F.max(F.when(F.col("_deleted"), F.col("_seq")))
        merged = log.groupBy(*key).agg(whole.alias("_whole"), gone.alias("_gone"), *(sets(c) for c in cols if c not in key))
        return merged.where("_whole is not null and (_gone is null or _whole > _gone)").select(*cols)

    def find(self, name: str, **equal: object) -> DataFrame:
        """The current rows whose columns have these values; None asks for null."""
        out = self.rows(name)
        for c, v in equal.items():
            out = out.where(F.col(c).eqNullSafe(F.lit(v)))
        return out

    def _write(self, name: str, df: DataFrame, sets: Column, deleted: bool, whole: bool = False) -> None:
        have = set(df.columns)
        with self.bulk():
            n = len(self._open)
            seq = ((self.commits() or [0])[-1] + 1) * (1 << 20) + n
            folder = f"w-{seq}-{uuid.uuid4().hex}"
            cols = ((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns_of(name))
            df.select(*cols, sets.cast("array<string>").alias("_set"), F.lit(deleted).alias("_deleted"), F.lit(seq).cast("long").alias("_seq")).write.parquet(f"{self.path}/{name}/{folder}")
            self._open.append({"table": name, "folder": folder} | ({"whole": True} if whole else {}))

    def put(self, name: str, df: DataFrame) -> None:
        """Insert or replace: rows of a known key take its place; columns that df lacks become null. A key comes once."""
        self._write(name, df, F.lit(None), False)

    def put_new(self, name: str, df: DataFrame) -> None:
        """Insert or ignore: rows of known keys are left out by an anti join; of several new ones one counts."""
        new, known = df.dropDuplicates(TABLES[name][1]), self.rows(name)
        on = [new[k].eqNullSafe(known[k]) for k in TABLES[name][1]]
        self.put(name, new.join(known, on, "left_anti"))

    def update(self, name: str, changes: DataFrame, columns: list[str]) -> None:
        """Rows with a key of changes get its columns, nulls included; keys without a row change nothing."""
        self._write(name, changes.select(*TABLES[name][1], *columns), F.array(*map(F.lit, columns)), False)

    def delete(self, name: str, keys: DataFrame) -> None:
        """Delete the rows of some keys, or of a table without one those of some sequence_ids; a later put brings new ones."""
        key = TABLES[name][1] or ["sequence_id"]
        self._write(name, keys.select(*key).distinct(), F.lit(None), True)

    def compact(self, name: str) -> None:
        """Write the current rows as one folder that takes the place of the log so far."""
        self._write(name, self.rows(name), F.lit(None), False, True)

    # --- parameters of signatures ----------------------------------------------------------------------------------------

    def parameters(self) -> DataFrame:
        """(name, value) of the stored signatures' parameters."""
        return self.rows("schema_info").where(F.col("key").startswith(PARAMETER)).select(F.substring("key", len(PARAMETER) + 1, 100).alias("name"), "value")

    def sketch(self) -> C.Sketch | None:
        """The settings behind the stored parameters."""
        p = {r["name"]: r["value"] for r in self.parameters().collect()}
        return C.Sketch.stored(p) if p else None

    def ensure_parameters(self, sketch: C.Sketch, allow_change: bool = False) -> None:
        """Stamp the parameters of signatures, or raise if the store has others; allow_change stamps anew."""
        new = self.spark.createDataFrame(list(sketch.parameters().items()), "name string, value string")
        old = self.parameters()
        differ = changed_parameters(old, new).collect()  # a dozen names at most
        if not differ:
            return
        if not allow_change and not old.isEmpty():
            raise SignatureFingerprintMismatch("the store's signatures differ: " + "; ".join(f"{r['name']}: {r['stored']} -> {r['given']}" for r in differ))
        self.put("schema_info", new.select(F.concat(F.lit(PARAMETER), "name").alias("key"), "value"))

    def summary(self) -> DataFrame:
        """One row of counts over all tables."""
        return summary({name: self.rows(name) for name in TABLES})


def changed_parameters(stored: DataFrame, given: DataFrame) -> DataFrame:
    """(name, stored, given) of parameters with two values, or one on one side only, by name."""
    both = stored.withColumnRenamed("value", "stored").join(given.withColumnRenamed("value", "given"), "name", "full")
    return both.where(~F.col("stored").eqNullSafe(F.col("given"))).orderBy("name")


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of counts over the tables of a store."""
    parts = [
        tables["sequences"].agg(F.count("*").alias("total_sequences")),
        tables["clusters"].where("is_active = 1").agg(F.countDistinct("cluster_id", "segment_name", "subtype").alias("total_clusters")),
        tables["allele_registry"].where("is_active = 1").agg(F.countDistinct("allele_name").alias("total_alleles")),
        tables["constellation_registry"].where("is_active = 1").agg(F.count("*").alias("total_constellations")),
        tables["genotypes"].agg(F.count("*").alias("total_genotypes")),
        tables["orphan_sequences"].where("resolved = 0").agg(F.count("*").alias("unresolved_orphans")),
        tables["reassortment_events"].agg(F.count("*").alias("reassortment_events")),
    ]
    out = parts[0]
    for x in parts[1:]:
        out = out.crossJoin(x)  # one row each
    return out


# --- queries on stored tables, as plain functions of DataFrames ---------------------------------------------------------------


def active_clusters(clusters: DataFrame, segment: str | None = None, subtype: str | None = None, version: str | None = None) -> DataFrame:
    """Active clusters, optionally of one segment, subtype or version."""
    out = clusters.where("is_active = 1")
    for c, v in (("segment_name", segment), ("subtype", subtype), ("version", version)):
        out = out.where(F.col(c) == v) if v else out
    return out


def latest_cluster_version(clusters: DataFrame) -> DataFrame:
    """(segment_name, subtype, version): the newest active version of each segment and subtype."""
    return clusters.where("is_active = 1").groupBy("segment_name", "subtype").agg(F.max_by("version", F.struct("created_at", "version")).alias("version"))


def without_known(df: DataFrame, known: DataFrame, key: str = "sequence_id") -> DataFrame:
    """Rows whose key is not known yet."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def sequences_of(sequences: DataFrame, subtype: str, status: str | None = None) -> DataFrame:
    """Isolates of a subtype, optionally of one status."""
    out = sequences.where(F.col("subtype") == subtype)
    return out.where(F.col("status") == status) if status else out


def alleles_of(registry: DataFrame, segment: str, number: int | None = None) -> DataFrame:
    """Active alleles of a segment, optionally of one subtype number."""
    out = registry.where((F.col("segment_name") == segment) & (F.col("is_active") == 1))
    return out.where(F.col("subtype_num") == number) if number is not None else out


def segment_signatures(seg: DataFrame, sequences: DataFrame, subtype: str | None = None, segment: str | None = None, version: str | None = None) -> DataFrame:
    """Signatures of isolates of a subtype, joined to their isolates; null signatures are left out."""
    s = seg.where("kmer_signature is not null")
    s = s.where(F.col("segment_name") == segment) if segment else s
    s = s.where(F.col("cluster_version") == version) if version else s
    q = sequences.where(F.col("subtype") == subtype) if subtype else sequences
    return s.join(q.select("sequence_id", "subtype").distinct(), "sequence_id")


def lineage_of(lineage: DataFrame, allele: str | None = None) -> DataFrame:
    """(allele, other) in both directions, each once."""
    both = lineage.select(F.col("allele_a").alias("allele"), F.col("allele_b").alias("other")).union(lineage.select("allele_b", "allele_a")).distinct()
    return both.where(F.col("allele") == allele) if allele else both


def empty_constellations(registry: DataFrame, genotypes: DataFrame, allele: str | None = None) -> DataFrame:
    """Active constellations that no genotype has, optionally only those whose combination contains an allele."""
    r = registry.where("is_active = 1")
    r = r.where(F.col("allele_combination").contains(allele)) if allele else r
    return r.join(genotypes.select("constellation_id").where("constellation_id is not null").distinct(), "constellation_id", "left_anti")
