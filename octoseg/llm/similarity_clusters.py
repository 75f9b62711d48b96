"""Grouping records into similarity clusters: distributed k-means on hashed weighted tokens, then an exact link check."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from octoseg.llm import signatures as S
from octoseg.llm.near_duplicates import connected_components
from octoseg.runtime import discard, share, stage, table

#: Dimensions of the hashed feature vectors.
DIM = 512
#: Leaders taken from what is still unlinked, in each of so many rounds.
LEADERS, ROUNDS = 1024, 3
#: Leaders that are compared at once: those of all blocks and groups, or fewer, as the check after them is exact anyway.
MOST_LEADERS = 8192


def features(lanes: np.ndarray, grp: np.ndarray, counts: np.ndarray, rows: int) -> np.ndarray:
    """Unit vectors: each token adds plus or minus its weight in one of DIM places; frequent tokens weigh more here.

    The weight is the square root of the share of rows with the token, as what a cluster has in common is frequent;
    a token of one row only tells nothing about a cluster.
    """
    tok = S.tokens(lanes, grp)
    c = np.minimum(counts[(tok & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.float32), rows)
    weight = np.sqrt(np.maximum(c - counts.mean() - 1, 0.25) / max(rows, 1))
    place = ((tok >> np.uint64(40)) % np.uint64(DIM)).astype(np.int64)
    sign = ((tok >> np.uint64(39)) & np.uint64(1)).astype(np.float32) * 2 - 1
    out = np.zeros((len(lanes), DIM), dtype=np.float32)
    at = np.arange(len(lanes))
    for j in range(lanes.shape[1]):
        out[at, place[:, j]] += (sign * weight)[:, j]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centre, squared distance) of each row."""
    d = (centres**2).sum(axis=1)[None, :] - 2 * x @ centres.T
    k = d.argmin(axis=1)
    return k, np.maximum(d[np.arange(len(x)), k] + (x**2).sum(axis=1), 0)


def _feature_batches(batches, counts, rows):
    for b in batches:
        cid, g = np.asarray(b.column("cid")), np.asarray(b.column("grp")).view(np.uint64)
        for lanes, at in S.lane_rows(b.column("lanes")):
            yield cid[at], features(lanes, g[at], counts, rows)


class KMeans:
    """k-means with parallel oversampled seeding (k-means||) over staged classes.

    Every pass is one narrow scan. A seeding round samples each row with a chance in proportion to its squared distance,
    by a hash of its id, so a repeated task samples the same; about 2 k rows a round come to the driver. A Lloyd step
    adds up sums by cluster in the partitions and between them; k rows come to the driver. k and DIM bound all of it.
    """

    def __init__(self, cls: DataFrame, counts, k: int = 256, rounds: int = 4, steps: int = 4, seed: int = 5) -> None:
        self.cls, self.counts, self.rows = cls.select("cid", "grp", "lanes"), counts, cls.count()
        self.spark, self.k, self.seed = cls.sparkSession, max(1, min(k, self.rows)), seed
        self.centres = self._seeds(rounds)
        for _ in range(steps if self.rows else 0):
            self._step()

    def _seeds(self, rounds: int) -> np.ndarray:
        held, cost = np.zeros((0, DIM), np.float32), float(max(self.rows, 1))
        for r in range(rounds):
            got = self._sample(held, cost, r)
            cost = sum(x["cost"] for x in got) or cost
            new = [np.frombuffer(x["sample"], np.float32).reshape(-1, DIM) for x in got if x["sample"]]
            held = np.concatenate([held, *new])
        if len(held) <= self.k:
            return held if len(held) else np.zeros((1, DIM), np.float32)
        weight = np.ones(len(held))
        for w in self._sums(held, weigh_only=True):
            weight[w["c"]] += w["n"]
        return self._recluster(held, weight)

    def _sample(self, held: np.ndarray, cost: float, r: int) -> list:
        centres, most, rows, counts = share(self.spark, held), 2 * self.k, self.rows, self.counts
        salt = np.uint64((self.seed * 1000 + r) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, out = 0.0, []
            for cid, x in _feature_batches(batches, counts.value, rows):
                d = nearest(x, centres.value)[1] if len(centres.value) else np.ones(len(x), np.float32)
                u = (S.mix(cid.view(np.uint64) + salt) >> np.uint64(11)).astype(np.float64) / 2**53
                total += float(d.sum())
                out.append(x[u < most * d / cost])
            s = np.concatenate(out).tobytes() if out else b""
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([s], pa.binary())], names=["cost", "sample"])

        return self.cls.mapInArrow(run, "cost double, sample binary").collect()

    def _sums(self, centres_: np.ndarray, weigh_only: bool = False) -> list:
        centres, rows, counts = share(self.spark, centres_), self.rows, self.counts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            k = len(centres.value)
            n, total = np.zeros(k, np.int64), np.zeros((1 if weigh_only else k, DIM), np.float64)
            for _, x in _feature_batches(batches, counts.value, rows):
                c, _ = nearest(x, centres.value)
                n += np.bincount(c, minlength=k)
                if not weigh_only:
                    order = np.argsort(c, kind="stable")
                    u, first = np.unique(c[order], return_index=True)
                    total[u] += np.add.reduceat(x[order].astype(np.float64), first, axis=0)
            at = np.flatnonzero(n)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), S.binary(total[at] if not weigh_only else np.zeros((len(at), 1)))], names=["c", "n", "s"])

        def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"c": [key[0]], "n": [pdf["n"].sum()], "s": [sum(np.frombuffer(x, np.float64) for x in pdf["s"]).tobytes()]})

        return self.cls.mapInArrow(run, "c int, n long, s binary").groupBy("c").applyInPandas(add, "c int, n long, s binary").collect()

    def _recluster(self, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        at = [int(rng.choice(len(x), p=w / w.sum()))]
        d = ((x - x[at[0]]) ** 2).sum(axis=1)
        while len(at) < self.k:
            p = w * d
            if p.sum() <= 0:
                break
            at.append(int(rng.choice(len(x), p=p / p.sum())))
            d = np.minimum(d, ((x - x[at[-1]]) ** 2).sum(axis=1))
        return x[at]

    def _step(self) -> None:
        new = self.centres.copy()
        for r in self._sums(self.centres):
            new[r["c"]] = (np.frombuffer(r["s"], np.float64) / r["n"]).astype(np.float32)
        self.centres = new

    def assign(self) -> DataFrame:
        """(cid, block, off): the nearest centre of each class and its squared distance."""
        centres, rows, counts = share(self.spark, self.centres), self.rows, self.counts

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for cid, x in _feature_batches(batches, counts.value, rows):
                c, d = nearest(x, centres.value)
                yield pa.RecordBatch.from_arrays([pa.array(cid), pa.array(c.astype(np.int32)), pa.array(d.astype(np.float64))], names=["cid", "block", "off"])

        return self.cls.mapInArrow(run, "cid long, block int, off double")


def leader_links(cls: DataFrame, leaders: list, threshold: float) -> DataFrame:
    """(cid, leader) of classes that agree with a leader in the threshold; leaders are (cid, grp, lanes) rows.

    Their number is bounded by the caller, so they are broadcast and compared directly, group by group.
    """
    by: dict[int, tuple[list, list]] = {}
    for r in leaders:
        ids, lanes = by.setdefault(r["grp"], ([], []))
        ids.append(r["cid"])
        lanes.append(np.frombuffer(r["lanes"], "<u8"))
    held = share(cls.sparkSession, {g: (np.array(i, dtype=np.int64), np.stack(m)) for g, (i, m) in by.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, grp = np.asarray(b.column("cid")), np.asarray(b.column("grp"))
            for lanes, at in S.lane_rows(b.column("lanes")):
                for g in np.unique(grp[at]):
                    if g not in held.value:
                        continue
                    ids, m = held.value[g]
                    mine = np.flatnonzero(grp[at] == g)
                    x = lanes[mine]
                    eq = np.zeros((len(x), len(m)), dtype=np.uint16)
                    for j in range(x.shape[1]):
                        eq += x[:, j][:, None] == m[:, j][None, :]
                    r, c = np.nonzero(eq >= S.need(x.shape[1], threshold))
                    yield pa.RecordBatch.from_arrays([pa.array(cid[at][mine][r]), pa.array(ids[c])], names=["cid", "leader"])

    return cls.select("cid", "grp", "lanes").mapInArrow(run, "cid long, leader long")


def token_rows(cls: DataFrame) -> DataFrame:
    """(cid, least, token): all tokens of all classes, with the number that makes a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cid, grp = np.asarray(b.column("cid")), np.asarray(b.column("grp")).view(np.uint64)
            for lanes, at in S.lane_rows(b.column("lanes")):
                tok = S.tokens(lanes, grp[at])
                n = tok.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(cid[at], n)), pa.array(np.full(tok.size, n, np.int32)), pa.array(tok.ravel().view(np.int64))], names=["cid", "n", "token"])

    return cls.select("cid", "grp", "lanes").mapInArrow(run, "cid long, n int, token long")


def linked_components(cls: DataFrame, blocks: DataFrame, threshold: float, hot: int = 1000, most_rounds: int = 40) -> DataFrame:
    """(node, component): connected sets of classes under agreement of threshold or more, exact.

    Leaders are the members nearest each centre, then a bounded number of those still unlinked, round by round; each
    class is linked to the leaders it agrees with. Then the check that makes it exact (cross_links()) until it finds no
    link between two components. Every round merges components; their number bounds the rounds, most_rounds ends a run
    that doesn't settle with an error.
    """
    first = blocks.join(cls.select("cid", "grp"), "cid")
    w = Window.partitionBy("block", "grp").orderBy("off", "cid")
    heads = first.withColumn("r", F.row_number().over(w)).where("r <= 3").select("cid")
    links, left = None, cls
    for r in range(ROUNDS + 1):
        if r:
            heads = left.orderBy(F.xxhash64("cid", F.lit(r))).limit(LEADERS).select("cid")
        chosen = cls.join(heads, "cid").select("cid", "grp", "lanes").limit(MOST_LEADERS).collect()
        if not chosen:
            break
        new = stage(leader_links(cls, chosen, threshold), "links")
        links = new if links is None else links.union(new)
        left = left.join(new.select("cid").distinct(), "cid", "left_anti")
    if links is None:
        return cls.select(F.col("cid").alias("node"), F.col("cid").alias("component"))
    tok = stage(token_rows(cls), "tokens")
    edges = links.select(F.col("cid").alias("a"), F.col("leader").alias("b"))
    last = None
    for _ in range(most_rounds):
        comp = connected_components(edges, "a", "b")
        comp = stage(cls.select("cid", "n").join(comp.select(F.col("node").alias("cid"), "component"), "cid", "left").select("cid", "n", F.coalesce("component", "cid").alias("component")), "components")
        found = stage(cross_links(cls, tok, comp, threshold, hot), "found")
        if found.isEmpty():
            discard(tok, last)
            return comp.select(F.col("cid").alias("node"), "component")
        discard(last)
        last = comp  # what is linked so far is a star to each component's smallest class
        edges = comp.select(F.col("cid").alias("a"), F.col("component").alias("b")).union(found)
    raise RuntimeError(f"clusters did not settle in {most_rounds} rounds")


def cross_links(cls: DataFrame, tok: DataFrame, comp: DataFrame, threshold: float, hot: int) -> DataFrame:
    """(a, b): links between classes of different components; empty only if there is none.

    A link is seen from the smaller component of the two: its class shares `need` tokens with the token set of the
    larger one, so only these pairs of a class and a component are compared member by member. A token in more than
    `hot` components is left out of that count, and the least number shared is lowered by how many such tokens the
    class has; a class with so many of them that nothing else need be shared is looked up by pairs of its hot tokens.
    """
    need = F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int")
    size = comp.groupBy("component").agg(F.struct(F.count("*"), F.col("component")).alias("rank"))
    t = stage(tok.join(comp.select("cid", "component"), "cid"), "sets")
    sets = t.select("token", F.col("component").alias("other")).distinct()
    width = stage(sets.groupBy("token").agg(F.count("*").alias("k")).where("k > 1"), "shared")
    cold, often = width.where(F.col("k") <= hot).select("token"), stage(width.where(F.col("k") > hot).select("token"), "hot")
    ranks = size.select(F.col("component").alias("other"), F.col("rank").alias("other_rank"))
    mine = stage(t.join(cold, "token", "left_semi").join(size, "component"), "cold")
    theirs = mine.select("token", F.col("component").alias("other"), F.col("rank").alias("other_rank")).distinct()
    some = not often.isEmpty()
    hots = stage(t.join(often, "token", "left_semi").groupBy("cid").agg(F.count("*").alias("h")), "hots") if some else None
    near = mine.join(theirs, "token").where("rank < other_rank").groupBy("cid", "n", "other").agg(F.count("*").alias("k"))
    if some:
        near = near.join(hots, "cid", "left").where(F.col("k") + F.coalesce("h", F.lit(0)) >= need)
    else:
        near = near.where(F.col("k") >= need)
    near = near.select("cid", "n", "other")
    if some:
        # two classes that share `need` hot tokens share two of the first h - need + 2 in any fixed order
        full = t.join(often, "token", "left_semi").join(hots, "cid").where(F.col("h") >= need)
        lists = full.groupBy("cid", "n", "component", "h").agg(F.array_sort(F.collect_list("token")).alias("ts"))
        head = F.slice("ts", 1, F.greatest(F.col("h") - need + 2, F.lit(2)))
        twos = F.flatten(F.transform(head, lambda x, i: F.transform(F.slice(head, i + 2, F.size(head)), lambda y: F.xxhash64(x, y))))
        keys = F.when(need == 1, F.col("ts")).otherwise(twos)  # one token in common is enough for the shortest signatures
        two = lists.select("cid", "n", "component", F.explode(keys).alias("two")).join(size, "component")
        also = two.join(two.select("two", F.col("component").alias("other"), F.col("rank").alias("other_rank")).distinct(), "two").where("rank < other_rank").select("cid", "n", "other")
        near = near.union(also).distinct()
    pairs = near.join(comp.select(F.col("cid").alias("to"), F.col("component").alias("other")), "other").select("cid", "to", "n").distinct()
    return S.verified(pairs, cls, threshold, "cid", "to").select(F.col("cid").alias("a"), F.col("to").alias("b"))


def similarity_clusters(seg: DataFrame, threshold: float = 0.25, least: int = 3, k: int = 256) -> DataFrame:
    """(cluster, segment_name, sequence_id, typical_id, size, fit): members of clusters of at least `least` records.

    seg has sequence_id, segment_name, kmer_signature, distance_to_centroid. typical_id is the member with the smallest
    distance from 0 to 1 (ties: the smaller id), null if no member has one. fit is the member's inner product with the
    cluster's centroid, the mean of its members' token vectors: the mean number of members that share one of its tokens,
    over their number; the nearest member has the greatest. cluster tells clusters of one call apart. Unusable
    signatures and null ids take no part; an empty table gives no rows.
    """
    rec = seg.where("sequence_id is not null and segment_name is not null").select("sequence_id", "segment_name", "kmer_signature", "distance_to_centroid")
    cls = S.classes(rec)
    if cls.isEmpty():
        return cls.sparkSession.createDataFrame([], "cluster long, segment_name string, sequence_id string, typical_id string, size long, fit double")
    counts, _ = S.rarity(cls)
    blocks = stage(KMeans(cls, counts, k).assign(), "blocks")
    comp = linked_components(cls, blocks, threshold)
    ok = "distance_to_centroid between 0 and 1 and not isnan(distance_to_centroid)"
    mem = stage(S.members(rec, cls, "sequence_id").join(comp.withColumnRenamed("node", "cid"), "cid"), "members")
    size = mem.groupBy("component").agg(F.count("*").alias("size")).where(F.col("size") >= least)
    # how many members share each token, class by class with its number of copies
    own = stage(mem.join(size, "component").groupBy("cid", "component", "size").agg(F.count("*").alias("w")), "weights")
    cells = token_rows(cls).join(own, "cid")
    share_ = cells.groupBy("component", "token").agg(F.sum("w").alias("c"))
    fit = cells.join(share_, ["component", "token"]).groupBy("cid").agg((F.sum("c") / (F.first("n") * F.first("size"))).alias("fit"))
    best = rec.where(ok).groupBy("segment_name", "sequence_id").agg(F.min("distance_to_centroid").alias("d"))
    mem = mem.join(size, "component").join(fit, "cid").join(best, ["segment_name", "sequence_id"], "left")
    top = mem.groupBy("component").agg(F.min(F.when(F.col("d").isNotNull(), F.struct("d", "sequence_id"))).alias("top"))
    return mem.join(top, "component").select(F.col("component").alias("cluster"), "segment_name", "sequence_id", F.col("top.sequence_id").alias("typical_id"), "size", "fit")


def provisional(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "segment_kmers").where("cluster_version = 'provisional'")


def p7_found(spark, sf_dir: str) -> DataFrame:
    return similarity_clusters(provisional(spark, sf_dir)).select("segment_name", "sequence_id", "typical_id")


def p7_clusters(spark, sf_dir: str) -> DataFrame:
    """Each cluster's size, typical member and the three members nearest its centroid."""
    m = similarity_clusters(provisional(spark, sf_dir)).withColumn("fit", F.round("fit", 9))
    r = m.withColumn("r", F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("fit"), "sequence_id"))).where("r <= 3")
    return r.groupBy("cluster", "segment_name", "typical_id", "size").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("r", "sequence_id"))), lambda x: x["sequence_id"]), ",").alias("nearest")).drop("cluster")
