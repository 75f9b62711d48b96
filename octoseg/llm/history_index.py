"""Deduplicating new batches against all history with an incremental inverted index of rare-token prefixes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from octoseg.llm import signatures as S
from octoseg.runtime import broadcast_if_small, discard, scratch, share, stage, table

ENTRY = "cid long, segment_name string, h1 long, h2 long, n int, grp long, lanes binary, c0 long, c1 long, c2 long, c3 long, first_sub long"
CODE = ["c0", "c1", "c2", "c3"]
#: Directories that are read without asking which of them are needed.
FEW = 64


class SignatureIndex:
    """An index of accepted signatures in a folder: order/ (rarity of tokens), then signatures/ and postings/ by batch.

    postings/ has (key, cid) in `buckets` directories by hash of the key, signatures/ the classes in blocks of cid: a cid
    is made of the batch's number (12 bits), the partition that wrote it (19) and the row (32), the first two its block.
    A probe reads the buckets its own keys fall into and the blocks of the classes it hits, so what it reads grows with
    the batch as long as that has fewer keys than there are buckets; create() makes one bucket for `per_bucket`
    postings. A batch becomes visible by its commit file, written last; a crashed append is overwritten by the next one.
    The order is fixed when the index is made: tokens that appear later count as rare, and any fixed order loses no pair.
    """

    def __init__(self, spark: SparkSession, path: str, threshold: float = 0.85) -> None:
        self.spark, self.path, self.threshold = spark, path.rstrip("/"), threshold
        self._counts, self._buckets = None, None

    @classmethod
    def create(cls, rows: DataFrame, path: str, threshold: float = 0.85, per_bucket: int = 1 << 17, most_buckets: int = 1 << 14) -> SignatureIndex:
        """Index the distinct signatures of rows (segment_name, kmer_signature) and fix the order by all of them."""
        self = cls(rows.sparkSession, path, threshold)
        entries = S.classes(rows)
        self._counts, _ = S.rarity(entries)
        counts = self._counts.value.reshape(S.BLOCKS, -1)
        self.spark.createDataFrame([(i, counts[i].tobytes()) for i in range(S.BLOCKS)], "block int, counts binary").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/order")
        keys = entries.agg(F.coalesce(F.sum(F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)) + 1), F.lit(0))).first()[0]
        self._buckets = max(1, min(most_buckets, -(-int(keys) // per_bucket)))
        self.spark.createDataFrame([(self._buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/shape")
        self.append(entries, F.lit(-1).cast("long"))
        return self

    @property
    def counts(self):
        """The broadcast order sketch; read from order/ when an index is opened again."""
        if self._counts is None:
            got = sorted(self.spark.read.parquet(f"{self.path}/order").collect(), key=lambda r: r["block"])
            self._counts = share(self.spark, np.concatenate([np.frombuffer(r["counts"], dtype=np.uint32) for r in got]))
        return self._counts

    @property
    def buckets(self) -> int:
        if self._buckets is None:
            self._buckets = self.spark.read.parquet(f"{self.path}/shape").first()[0]
        return self._buckets

    # --- batches ------------------------------------------------------------------------------------------------------

    def _path(self, name: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, name: str) -> list[str]:
        fs, p = self._path(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def batches(self) -> list[int]:
        return sorted(map(int, self._names("commits")))

    def _read(self, name: str, schema: str, part: str, wanted: list[int] | None) -> DataFrame:
        """Rows of the committed batches, of some directories only; what isn't wanted isn't even listed."""
        paths = []
        for n in self.batches():
            there = self._names(f"{name}/{n}")
            want = None if wanted is None else {f"{part}={w}" for w in wanted}
            paths += [f"{self.path}/{name}/{n}/{x}" for x in there if x.startswith(f"{part}=") and (want is None or x in want)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def signatures(self, blocks: list[int] | None = None) -> DataFrame:
        """Classes with the smallest submission that brought them (-1: history)."""
        return self._read("signatures", ENTRY, "block", blocks)

    def postings(self, buckets: list[int] | None = None) -> DataFrame:
        return self._read("postings", "key long, cid long", "bucket", buckets)

    def _bucket(self, post: DataFrame) -> DataFrame:
        return post.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(self.buckets)).cast("int"))

    def append(self, entries: DataFrame, first: Column) -> DataFrame:
        """Add staged classes() of a batch with their postings; first is the column of the smallest submission of a class.

        Returns the entries under the cids they have in the index.
        """
        n = (self.batches() or [-1])[-1] + 1
        if n >= 1 << 12:
            raise ValueError("the index is full: make it anew from its signatures")
        own = [f.split(" ")[0] for f in ENTRY.split(", ")][1:-1]
        part = F.shiftright("cid", 33)
        cid = F.when(part < 1 << 19, F.shiftleft(F.lit(n << 19) + part, 32) + F.col("cid").bitwiseAND(F.lit((1 << 32) - 1))).otherwise(F.raise_error(F.lit("too many partitions in a batch")))
        numbered = entries.select(cid.cast("long").alias("cid"), *own, first.alias("first_sub"))
        post = self._bucket(S.postings(numbered, self.counts, self.threshold))
        post.repartition("bucket").sortWithinPartitions("bucket", "key").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings/{n}")
        numbered.withColumn("block", F.shiftright("cid", 32)).write.mode("overwrite").partitionBy("block").parquet(f"{self.path}/signatures/{n}")
        fs, p = self._path(f"commits/{n}")
        fs.create(p, False).close()
        return numbered

    def probe(self, entries: DataFrame, *keep: str) -> DataFrame:
        """(cid, found, n, equal, first_sub, *keep): each class of a batch with the indexed classes it agrees with in the
        threshold, and columns of its own.

        Where the index has more than FEW buckets or blocks, the ones to read are asked for first.
        """
        probes, wanted, blocks = self._bucket(S.postings(entries, self.counts, self.threshold)), None, None
        if self.buckets > FEW:
            probes = stage(probes, "probes")
            wanted = [r[0] for r in probes.select("bucket").distinct().collect()]  # at most `buckets` numbers
        old = self.postings(wanted).withColumnRenamed("cid", "found")
        hits = old.join(broadcast_if_small(probes.drop("bucket"), 64 << 20), "key").select("cid", "found").distinct()
        if sum(len(self._names(f"signatures/{n}")) for n in self.batches()) > FEW:
            hits = stage(hits, "hits")
            got = hits.select(F.shiftright("found", 32).alias("b")).distinct().limit(1 << 16).collect()
            blocks = [r[0] for r in got] if len(got) < 1 << 16 else None  # so many: all are read
        # what hits is staged with the batch's lanes, so that its size is known: while it is small the history isn't shuffled
        a = stage(hits.join(entries.select("cid", "n", *CODE, F.col("lanes").alias("la"), *keep), "cid"), "hits")
        b = self.signatures(blocks).select(F.col("cid").alias("found"), F.col("n").alias("nb"), *(F.col(c).alias(f"{c}b") for c in CODE), F.col("lanes").alias("lb"), "first_sub")
        j = b.join(broadcast_if_small(a, 32 << 20), "found").where("n = nb")
        unequal = S.unequal_fields(F.col("n"), [F.col(c) for c in CODE], [F.col(f"{c}b") for c in CODE])
        close = j.where(unequal <= F.col("n") - F.ceil(F.col("n") * F.lit(self.threshold) - F.lit(1e-9)))
        return S.with_equal(close.select("cid", "found", "n", "first_sub", *keep, "la", "lb"), self.threshold)


def plain_id(c: str = "sequence_id"):
    """An id apart from letter case and blanks anywhere."""
    return F.lower(F.regexp_replace(c, r"(?U)\s+", ""))


def known_ids(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """(submission_id, known_id): history or a smaller submission_id has the segment and the id apart from case and blanks.

    The order of submissions alone decides, so the ids of all batches are looked up at once. Null ids or segments match
    nothing; the submissions stay in the result.
    """
    rows = incoming.select("submission_id", "segment_name", plain_id().alias("pid"))
    old = history.select(F.lit(None).cast("long").alias("submission_id"), "segment_name", plain_id().alias("pid"))
    both = rows.union(old).where("segment_name is not null and pid is not null")
    first = both.groupBy("segment_name", "pid").agg(F.min(F.coalesce("submission_id", F.lit(-(1 << 62)))).alias("first"), F.max("submission_id").alias("asked")).where("asked is not null")
    j = rows.join(first, ["segment_name", "pid"], "left")
    return j.select("submission_id", F.coalesce(F.col("first") < F.col("submission_id"), F.lit(False)).alias("known_id"))


def check_batch(index: SignatureIndex, incoming: DataFrame) -> DataFrame:
    """(segment_name, h1, h2, first) of the signatures of one batch, staged: the smallest submission that brought one like
    it, -1 for the history; the index holds the batch afterwards.

    The batch is appended with the smallest submission_id of each signature before it probes, so its own earlier rows
    are found like those of earlier batches.
    """
    cls = S.classes(incoming.select("submission_id", "segment_name", "kmer_signature"), first="submission_id")
    hits = index.probe(index.append(cls, F.col("submission_id")), "segment_name", "h1", "h2")
    out = stage(hits.groupBy("segment_name", "h1", "h2").agg(F.min("first_sub").alias("first")), "checked")
    discard(cls)
    return out


def arrivals(incoming: DataFrame) -> list[tuple[int, int]]:
    """The batches in order of arrival, as ranges of submission_id; batches whose ranges overlap are taken together.

    One row a batch comes to the driver. Rows of a null batch_no are a batch.
    """
    spans = incoming.where("submission_id is not null").groupBy("batch_no").agg(F.min("submission_id").alias("a"), F.max("submission_id").alias("b")).orderBy("a").collect()
    out: list[tuple[int, int]] = []
    for _, a, b in spans:
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def check_batches(index: SignatureIndex, history_ids: DataFrame, incoming: DataFrame) -> DataFrame:
    """(submission_id, known_id, near_duplicate) of all submissions, batch after batch.

    near_duplicate: the history or a smaller submission_id has a comparable signature in the threshold. Each batch is
    appended to the index and probes it; what came before is read where the batch hits it. Unusable signatures match
    nothing; submissions without an id are left out; an empty table gives no rows.
    """
    incoming = incoming.select("submission_id", "batch_no", "sequence_id", "segment_name", "kmer_signature").where("submission_id is not null")
    spans, seen = arrivals(incoming), None
    batch = F.lit(0)
    for i, (a, b) in enumerate(spans):
        got = check_batch(index, incoming.where(F.col("submission_id").between(a, b))).withColumn("batch", F.lit(i))
        batch = F.when(F.col("submission_id") >= a, F.lit(i)).otherwise(batch)
        seen = got if seen is None else seen.union(got)
    known = known_ids(history_ids, incoming)
    if seen is None:
        return known.withColumn("near_duplicate", F.lit(False))
    rows = S.keyed(incoming.where("segment_name is not null").withColumn("batch", batch))
    near = rows.join(seen, ["segment_name", "h1", "h2", "batch"]).select("submission_id", (F.col("first") < F.col("submission_id")).alias("near"))
    return known.join(near, "submission_id", "left").select("submission_id", "known_id", F.coalesce("near", F.lit(False)).alias("near_duplicate"))


def p6_checked(spark, sf_dir: str) -> DataFrame:
    """Every submission with what makes it known; known_isolate tells whether sequences has its isolate, with any segment."""
    incoming, isolates = table(spark, sf_dir, "incoming_segments"), table(spark, sf_dir, "sequences").select(plain_id().alias("pid")).where("pid is not null").distinct()
    there = incoming.select("submission_id", plain_id().alias("pid")).join(isolates, "pid", "left_semi").select("submission_id", F.lit(True).alias("there"))
    out = _checked(spark, sf_dir).join(there, "submission_id", "left")
    return out.select("submission_id", "known_id", "near_duplicate", F.coalesce("there", F.lit(False)).alias("known_isolate"))


def _checked(spark, sf_dir: str) -> DataFrame:
    seg = table(spark, sf_dir, "segment_kmers")
    index = SignatureIndex.create(seg.select("segment_name", "kmer_signature"), scratch(spark, "index"))
    return check_batches(index, seg, table(spark, sf_dir, "incoming_segments"))


def p6_found(spark, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).where("known_id or near_duplicate").select("submission_id")
