"""Near-duplicate records: banded universal hash minima, verification, components by large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from octoseg.llm import signatures as S
from octoseg.runtime import discard, stage, table


def candidate_pairs(post: DataFrame) -> DataFrame:
    """Distinct (ca, cb), ca < cb, of classes that share a key.

    Both sides of the self join are one exchange; AQE splits a key that is skewed all the same.
    """
    a, b = post.select("key", F.col("cid").alias("ca")), post.select("key", F.col("cid").alias("cb"))
    return a.join(b, "key").where("ca < cb").select("ca", "cb").distinct()


def similar_classes(cls: DataFrame, threshold: float = 0.85, hot: int | None = None) -> DataFrame:
    """(ca, cb, n, equal) of all pairs of classes with an agreement of threshold or more; none is lost.

    The lanes are minima of n universal hashes. They are cut into n - need + 1 bands, so such a pair has a band in
    common; bands of hot values only are split by rare lanes (signatures.band_keys). Candidates pass a 256-bit code
    that can't lose a pair, then all lanes are compared.
    """
    counts, limit = S.rarity(cls)
    post = S.postings(cls, counts, threshold, "band", limit if hot is None else hot)
    cand = candidate_pairs(post)
    code = ["cid", "n", "c0", "c1", "c2", "c3"]
    a = cls.select(*(F.col(c).alias("ca" if c == "cid" else c) for c in code))
    b = cls.select(*(F.col(c).alias("cb" if c == "cid" else "n_b" if c == "n" else f"{c}b") for c in code))
    j = cand.join(a, "ca").join(b, "cb").where("n = n_b")
    unequal = S.unequal_fields(F.col("n"), [F.col(f"c{i}") for i in range(4)], [F.col(f"c{i}b") for i in range(4)])
    close = j.where(unequal <= F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9))).select("ca", "cb", "n")
    return S.verified(close, cls, threshold)


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) of the nodes of undirected edges, by alternating large-star and small-star.

    component is the smallest node. Each step is one aggregate with map-side minima and one join on the node; a star's
    hub may be hot, its join is split by AQE. Rounds are staged tables, so the lineage stays short.
    """
    e = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    e = first = stage(e, "edges")
    nodes = e.select(F.col("u").alias("node")).union(e.select(F.col("v").alias("node"))).distinct()
    before = None
    for _ in range(most_rounds):
        last = e
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")).select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        e = stage(e, "edges")
        if last is not first:  # nodes are read from the first
            discard(last)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return nodes.join(e.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def record_pairs(pairs: DataFrame, mem: DataFrame, lot: int = 512) -> DataFrame:
    """(segment_name, sequence_a, sequence_b): all pairs of records behind pairs of classes, and of copies within a class.

    One form at every size: each pair of records that agree is a row, copies included, as p3_found is defined; their
    number is quadratic in the copies of a class (near_duplicate_groups() is linear). Members of a class are cut into
    lots of about `lot`, and lots meet lots, so no task holds the pairs of one large class.
    """
    size = mem.groupBy("cid").agg(F.count("*").alias("k"), F.ceil(F.count("*") / lot).cast("int").alias("lots"))
    m = mem.select("cid", "segment_name", "sequence_id").join(size, "cid").withColumn("lot", F.pmod(F.xxhash64("sequence_id"), F.col("lots")).cast("int"))
    m = stage(m, "lots")
    every = F.explode(F.sequence(F.lit(0), F.col("lots") - 1))
    copies = m.where("k > 1")
    x = copies.select("cid", "segment_name", F.col("sequence_id").alias("x"), F.col("lot").alias("la"), every.alias("lb"))
    y = copies.select("cid", F.col("sequence_id").alias("y"), every.alias("la"), F.col("lot").alias("lb"))
    within = x.join(y, ["cid", "la", "lb"]).where("x < y").select("segment_name", "x", "y")
    a = m.select(F.col("cid").alias("ca"), "segment_name", F.col("sequence_id").alias("x"))
    b = m.select(F.col("cid").alias("cb"), F.col("sequence_id").alias("y"))
    across = pairs.select("ca", "cb").join(a, "ca").join(b, "cb").select("segment_name", "x", "y")
    out = across.union(within)
    return out.select("segment_name", F.least("x", "y").alias("sequence_a"), F.greatest("x", "y").alias("sequence_b")).where("sequence_a < sequence_b").distinct()


def records(seg: DataFrame) -> DataFrame:
    """Rows that can be told apart: sequence_id and segment_name are not null."""
    return seg.select("sequence_id", "segment_name", "kmer_signature").where("sequence_id is not null and segment_name is not null")


def near_duplicate_pairs(seg: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(segment_name, sequence_a, sequence_b) of comparable records with an agreement of threshold or more.

    Null, empty, cut or foreign signatures and null ids take no part; repeated rows count once; other columns are
    ignored; an empty table gives no rows.
    """
    rec = records(seg)
    cls = S.classes(rec)
    return record_pairs(similar_classes(cls, threshold), S.members(rec, cls, "sequence_id"))


def near_duplicate_groups(seg: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(segment_name, sequence_id, class_id, copies, links, group_id) for every record with a usable signature.

    class_id is the smallest sequence_id of the records with the very same signature and copies their number; links
    counts the other classes it is linked to; group_id is the smallest sequence_id of the connected group of classes.
    Linear in the records, whatever the number of copies.
    """
    rec = records(seg)
    cls = S.classes(rec)
    pairs = stage(similar_classes(cls, threshold), "pairs")
    comp = connected_components(pairs, "ca", "cb")
    ends = pairs.select(F.explode(F.array("ca", "cb")).alias("cid")).groupBy("cid").agg(F.count("*").alias("links"))
    mem = stage(S.members(rec, cls, "sequence_id"), "members")
    own = mem.groupBy("cid").agg(F.min("sequence_id").alias("class_id"), F.count("*").alias("copies"))
    c = own.join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left").join(ends, "cid", "left")
    c = c.withColumns({"component": F.coalesce("component", "cid"), "links": F.coalesce("links", F.lit(0))})
    low = c.groupBy("component").agg(F.min("class_id").alias("group_id"))
    c = c.join(low, "component").select("cid", "class_id", "copies", "links", "group_id")
    return mem.join(c, "cid").select("segment_name", "sequence_id", "class_id", "copies", "links", "group_id")


def p3_found(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_pairs(table(spark, sf_dir, "segment_kmers"))


def p3_groups(spark, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "segment_kmers"))
