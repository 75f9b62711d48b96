"""The k most similar records of every record: rare-token lists, rotated one-bit codes against four-bit vectors with error
bounds, reranking on all lanes against the k-th best so far."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from octoseg.llm import signatures as S
from octoseg.llm.near_duplicates import records
from octoseg.runtime import discard, stage, table

BITS = 256


def rotation(bits: int = BITS, seed: int = 17) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def embed(lanes: np.ndarray) -> np.ndarray:
    """Unit vectors of BITS dimensions whose inner product is the agreement of the signatures plus noise of mean zero.

    Each lane's value sets max(1, BITS // n) dimensions to plus or minus one; lanes beyond BITS are added to those.
    """
    n = lanes.shape[1]
    per = max(1, BITS // n)
    v = np.zeros((len(lanes), BITS), dtype=np.float32)
    for p in range(per):
        h = S.mix(lanes + np.uint64((p + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
        sign = ((h >> np.uint64(33)) & np.uint64(1)).astype(np.float32) * 2 - 1
        for j in range(n):
            v[:, (j * per + p) % BITS] += sign[:, j]
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def one_bit(v: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign bits as BITS // 64 words, correction scalar) of unit vectors.

    The scalar is the inner product of the rotated vector with its own code; about 0.8, exact for each vector.
    """
    x = v @ rot
    words = np.packbits(x > 0, axis=1, bitorder="little").view(np.int64)
    return words, np.abs(x).sum(axis=1) / math.sqrt(x.shape[1])


def four_bit(v: np.ndarray, rot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(four planes of BITS // 64 words, least value, step, sum) of rotated unit vectors in 16 levels.

    A value goes to the level above or below it by a fixed dither of its dimension, so its mean is kept.
    """
    x = v @ rot
    low = x.min(axis=1).astype(np.float64)
    step = np.maximum((x.max(axis=1) - low) / 15, 1e-9)
    dither = np.random.default_rng(18).random(x.shape[1])
    u = np.clip((x - low[:, None]) / step[:, None] + dither, 0, 15).astype(np.uint8)
    planes = [np.packbits(u >> j & 1, axis=1, bitorder="little").view(np.int64) for j in range(4)]
    return np.concatenate(planes, axis=1), low, step, low * x.shape[1] + step * u.sum(axis=1)


WORDS, PLANES = [f"w{i}" for i in range(BITS // 64)], [f"p{i}" for i in range(BITS // 16)]


def with_codes(cls: DataFrame) -> DataFrame:
    """(cid, n, w0..w3, f, p0..p15, low, step, total) of classes: one_bit() and four_bit()."""
    names = ["cid", "n", *WORDS, "f", *PLANES, "low", "step", "total"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rot = rotation()
        for b in batches:
            cid = np.asarray(b.column("cid"))
            for lanes, at in S.lane_rows(b.column("lanes")):
                v = embed(lanes)
                w, f = one_bit(v, rot)
                p, *scalars = four_bit(v, rot)
                cols = [cid[at], np.full(len(at), lanes.shape[1], np.int32), *w.T, f.astype(np.float64), *p.T, *scalars]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], names=names)

    types = ["long", "int", *["long"] * len(WORDS), "double", *["long"] * len(PLANES), *["double"] * 3]
    return cls.select("cid", "lanes").mapInArrow(run, ", ".join(map(" ".join, zip(names, types))))


def estimate(a: list, b: list, fa, fb):
    """The estimated inner product of two vectors from their packed bits and correction scalars, as a column.

    The codes' inner product is 1 - 2 h / BITS for h unequal bits; divided by both scalars it estimates the arc sine.
    """
    h = None
    for x, y in zip(a, b):
        c = F.bit_count(x.bitwiseXOR(y))
        h = c if h is None else h + c
    angle = (F.lit(1.0) - F.lit(2.0 / BITS) * h) / (fa * fb)
    return F.sin(F.least(F.greatest(angle, F.lit(-math.pi / 2)), F.lit(math.pi / 2)))


#: Standard errors a pair at the threshold may be underestimated by before it is left out.
SURE = 6.5
#: A first agreement: records with k neighbours of this much take no part in the search for farther ones.
NEAR = 0.9


def error_bound(threshold: float, z: float = SURE) -> float:
    """z standard errors of estimate() for a pair at the threshold: of the sign bits and of the embedding."""
    p = math.acos(threshold) / math.pi
    bits = math.sin(math.acos(threshold)) * math.pi * math.sqrt(p * (1 - p) / BITS)
    return z * math.sqrt(bits**2 + (1 - threshold) / BITS)


def refined(words: list, f, planes: list, low, step, total):
    """The inner product of a and b without bias, as a column: a's code times b's four-bit vector, divided by a's scalar."""
    ones, dot = None, None
    for i, w in enumerate(words):
        ones = F.bit_count(w) if ones is None else ones + F.bit_count(w)
        for j in range(4):
            c = F.bit_count(w.bitwiseAND(planes[len(words) * j + i])) * F.lit(1 << j)
            dot = c if dot is None else dot + c
    return (F.lit(2.0) * (low * ones + step * dot) - total) / (F.lit(math.sqrt(BITS)) * f)


def refined_bound(at, f, step, n, z: float = SURE):
    """z standard errors of refined() for a pair of agreement `at`: of its own code, of four bits and of the embedding."""
    dims = F.when(n < BITS, F.floor(F.lit(BITS) / n) * n).otherwise(F.lit(BITS))
    return F.lit(z) * F.sqrt((1 - at * at) * (1 - f * f) / (f * f * (BITS - 1)) + step * step / (6 * f * f) + (1 - at) / dims)


def touched(cls: DataFrame, pairs: DataFrame) -> DataFrame:
    """(cid, lanes) of the classes in pairs, and of few others: the rest is dropped before lanes are shuffled.

    Hashed cids go to all tasks as a bitmap of at most 4 MB.
    """
    bits = 4 * S.sketch_width(pairs.count())
    place = F.pmod(F.xxhash64("cid"), F.lit(bits))
    ids = pairs.select(F.explode(F.array("ca", "cb")).alias("cid")).select(place.alias("at")).withColumn("block", F.bitmap_bucket_number(F.col("at") + 1))
    got = ids.distinct().repartition("block").groupBy("block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("map"))
    held = np.zeros((bits // 32768, 4096), dtype=np.uint8)
    for r in got.collect():
        held[r["block"] - 1] = np.frombuffer(r["map"], dtype=np.uint8)
    held = S.share(cls.sparkSession, held.ravel())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.asarray(b.column("at"))
            keep = held.value[at >> 3] >> (at & 7).astype(np.uint8) & 1
            yield b.select(["cid", "lanes"]).filter(pa.array(keep.astype(bool)))

    return cls.select("cid", "lanes", place.alias("at")).mapInArrow(run, "cid long, lanes binary")


def reranked(passed: DataFrame, cls: DataFrame, threshold: float, k: int, z: float = SURE) -> DataFrame:
    """(ca, cb, n, equal) of the pairs of passed that have the threshold and can be among either class's k best.

    First the k best estimates of each class are compared on all lanes. Their k-th best agreement is what the others must
    be able to reach, by their error bounds, for one of their two classes.
    """
    both = passed.select(F.col("ca").alias("c"), F.col("cb").alias("d"), "n", "est").union(passed.select("cb", "ca", "n", "est"))
    best = both.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("est"), "d"))).where(F.col("r") <= k)
    best = stage(best.select(F.least("c", "d").alias("ca"), F.greatest("c", "d").alias("cb"), "n").distinct(), "best")
    first = stage(S.verified(best, touched(cls, best), threshold), "first")
    kth = both_ways(first).withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("equal")))).where(F.col("r") == k)
    rest = passed.join(best, ["ca", "cb"], "left_anti")
    for side, name in (("ca", "ka"), ("cb", "kb")):
        rest = rest.join(kth.select(F.col("c").alias(side), F.col("equal").alias(name)), side, "left")
    reach = F.greatest(F.lit(threshold), F.least(F.coalesce("ka", F.lit(0)), F.coalesce("kb", F.lit(0))) / F.col("n"))
    rest = rest.withColumn("reach", reach).where(F.col("est") >= F.col("reach") - refined_bound(F.col("reach"), F.col("f"), F.col("step"), F.col("n"), z))
    rest = stage(rest.select("ca", "cb", "n"), "rest")
    discard(passed, best)
    return first if rest.isEmpty() else first.union(S.verified(rest, touched(cls, rest), threshold))


def close_classes(cls: DataFrame, code: DataFrame, counts, searching: DataFrame | None, threshold: float, k: int, z: float = SURE) -> DataFrame:
    """(ca, cb, n, equal) of pairs of classes with an agreement of threshold or more, one of them in searching (cid); of
    these, all that can be among the k best of either class.

    Candidates share one of their rarest tokens (no such pair is without one). Those whose estimates plus their error
    bounds reach the threshold, first of two one-bit codes, then of a code and a four-bit vector, go to reranked(). Of 1.2
    million simulated pairs exactly at the threshold none was underestimated by more than 5.5 standard errors; z = inf
    compares all candidates on all lanes.
    """
    post = S.postings(cls, counts, threshold)
    if searching is not None:
        post = post.join(searching.select("cid", F.lit(True).alias("open")), "cid", "left")
    else:
        post = post.withColumn("open", F.lit(True))
    a, b = post.select("key", F.col("cid").alias("ca"), F.col("open").alias("oa")), post.select("key", F.col("cid").alias("cb"), F.col("open").alias("ob"))
    cand = a.join(b, "key").where("ca < cb and (oa or ob)").select("ca", "cb").distinct()
    a = code.select(F.col("cid").alias("ca"), "n", *WORDS, "f")
    b = code.select(F.col("cid").alias("cb"), F.col("n").alias("nb"), *(F.col(w).alias(f"v{i}") for i, w in enumerate(WORDS)), F.col("f").alias("fb"), *PLANES, "low", "step", "total")
    j = cand.join(a, "ca").join(b, "cb").where("n = nb")
    if math.isinf(z):
        return S.verified(j.select("ca", "cb", "n"), cls, threshold)
    words = [F.col(w) for w in WORDS]
    j = j.where(estimate(words, [F.col(f"v{i}") for i in range(len(WORDS))], F.col("f"), F.col("fb")) >= threshold - error_bound(threshold, z))
    j = j.withColumn("est", refined(words, F.col("f"), [F.col(p) for p in PLANES], F.col("low"), F.col("step"), F.col("total")))
    j = j.where(F.col("est") >= threshold - refined_bound(F.lit(threshold), F.col("f"), F.col("step"), F.col("n"), z))
    return reranked(stage(j.select("ca", "cb", "n", "est", "f", "step"), "passed"), cls, threshold, k, z)


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("ca").alias("c"), F.col("cb").alias("d"), "equal").union(pairs.select(F.col("cb").alias("c"), F.col("ca").alias("d"), "equal"))


def most_similar(seg: DataFrame, k: int = 5, threshold: float = 0.75, near: float = NEAR, z: float = SURE) -> DataFrame:
    """(segment_name, sequence_id, neighbour, agreement) with the k most similar other records of each record.

    Ties go to the smaller sequence_id. Records of one signature form a class; of a class only its k + 1 smallest ids
    can be anyone's neighbours by that tie rule, which keeps copies linear. The search goes from near to far: a class
    with k others at `near` or more has its whole result there, as all pairs of that agreement that can be among a
    class's k best are found; only the rest look for neighbours down to the threshold, so a dense group of rows isn't compared pair by pair at the lower one.
    Unusable signatures and null ids take no part; repeated rows count once; an empty table gives no rows.
    """
    rec = records(seg)
    cls = S.classes(rec)
    mem = stage(S.members(rec, cls.select("cid", "segment_name", "h1", "h2", "n"), "sequence_id").join(cls.select("cid", "n"), "cid"), "members")
    size = stage(mem.groupBy("cid").agg(F.count("*").alias("size"), F.first("n").alias("equal")), "sizes")
    counts = S.rarity_levels(cls)
    code = stage(with_codes(cls), "codes")
    links, searching = None, None
    if near > threshold:
        first = stage(both_ways(close_classes(cls, code, counts, None, near, k, z)), "near")
        others = first.join(size.select(F.col("cid").alias("d"), "size"), "d").groupBy(F.col("c").alias("cid")).agg(F.sum("size").alias("others"))
        found = size.join(others, "cid", "left").where(F.coalesce("others", F.lit(0)) + F.col("size") - 1 >= k).select("cid")
        searching = stage(size.select("cid").join(found, "cid", "left_anti"), "searching")
        done = size.join(searching, "cid", "left_anti").select(F.col("cid").alias("c"))
        links = first.join(done, "c", "left_semi").select("c", "d", "equal")
    # where most classes still search, telling them apart costs more than it saves; the pairs that count are the same
    few = searching is not None and 2 * searching.count() < size.count()
    far = both_ways(close_classes(cls, code, counts, searching if few else None, threshold, k, z))
    if searching is not None:
        far = far.join(searching.select(F.col("cid").alias("c")), "c", "left_semi").select("c", "d", "equal")
    links = far if links is None else links.union(far)
    own = size.where("size > 1").select(F.col("cid").alias("c"), F.col("cid").alias("d"), "equal")
    heads = mem.withColumn("r", F.row_number().over(Window.partitionBy("cid").orderBy("sequence_id"))).where(F.col("r") <= k + 1)
    heads = heads.select(F.col("cid").alias("d"), F.col("sequence_id").alias("neighbour"), "n")
    best = links.union(own).join(heads, "d").withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("equal"), "neighbour"))).where(F.col("r") <= k + 1)
    best = best.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("r", "neighbour", (F.col("equal") / F.col("n")).alias("agreement")))).alias("list"))
    kept = F.slice(F.filter("list", lambda x: x["neighbour"] != F.col("sequence_id")), 1, k)
    out = mem.join(best.withColumnRenamed("c", "cid"), "cid")
    return out.select("segment_name", "sequence_id", F.explode(kept).alias("x")).select("segment_name", "sequence_id", "x.neighbour", "x.agreement")


def p2_found(spark, sf_dir: str) -> DataFrame:
    near = most_similar(table(spark, sf_dir, "segment_kmers"))
    return near.select("segment_name", F.least("sequence_id", "neighbour").alias("sequence_a"), F.greatest("sequence_id", "neighbour").alias("sequence_b")).distinct()


def p2_neighbours(spark, sf_dir: str) -> DataFrame:
    return most_similar(table(spark, sf_dir, "segment_kmers"))
