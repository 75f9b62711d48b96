"""k-mer tables, MinHash signatures, and distances between signatures."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.runtime import spread, stage

#: A k-mer, a seed and the two words of its MurmurHash3 x64 128.
GOLDEN = (b"ACGTACGTACGTACGTACGTA", 42, 13036166743686632327, 4543100632486228299)


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _fmix(x: np.ndarray) -> np.ndarray:
    for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(m)
    return x ^ (x >> np.uint64(33))


def murmur3_x64_128(rows: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Both words of MurmurHash3 x64 128 (the published algorithm) of each row of a byte matrix."""
    n, size = rows.shape
    c1, c2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)
    h1 = np.full(n, seed & 0xFFFFFFFF, dtype=np.uint64)
    h2 = h1.copy()
    padded = np.zeros((n, -(-max(size, 1) // 16) * 16), dtype=np.uint8)
    padded[:, :size] = rows
    words = padded.view("<u8")
    full = size // 16
    with np.errstate(over="ignore"):
        for b in range(full):
            h1 ^= _rotl(words[:, 2 * b] * c1, 31) * c2
            h1 = (_rotl(h1, 27) + h2) * np.uint64(5) + np.uint64(0x52DCE729)
            h2 ^= _rotl(words[:, 2 * b + 1] * c2, 33) * c1
            h2 = (_rotl(h2, 31) + h1) * np.uint64(5) + np.uint64(0x38495AB5)
        if size % 16 > 8:
            h2 ^= _rotl(words[:, 2 * full + 1] * c2, 33) * c1
        if size % 16:
            h1 ^= _rotl(words[:, 2 * full] * c1, 31) * c2
        h1 ^= np.uint64(size)
        h2 ^= np.uint64(size)
        h1 = h1 + h2
        h2 = h2 + h1
        h1, h2 = _fmix(h1), _fmix(h2)
        h1 = h1 + h2
        h2 = h2 + h1
    return h1, h2


def selftest() -> None:
    """Raise if the hash doesn't give its published value: its signatures would compare to no others."""
    h1, h2 = murmur3_x64_128(np.frombuffer(GOLDEN[0], np.uint8)[None, :], GOLDEN[1])
    if (int(h1[0]), int(h2[0])) != GOLDEN[2:]:
        raise RuntimeError("the hash function does not give its reference value")


#: Letters of a code, two bits each, and the letters themselves by code.
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = np.arange(4, dtype=np.uint8)


def _window_codes(s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(codes, good) of all windows of k letters, 2 bits a letter, k up to 31; good: only A, C, G and T in it.

    A window of 2 m letters is made of two of m, so the work is a few passes over the sequence, whatever k.
    """
    c = _CODE[s]
    bad = c == 4
    part, width = np.where(bad, 0, c).astype(np.uint64), 1
    out, have = None, 0
    rest = k
    while rest:
        if rest & 1:
            m = len(s) - have - width + 1
            if m <= 0:
                return np.zeros(0, np.uint64), np.zeros(0, bool)
            out = part[:m].copy() if out is None else (out[:m] << np.uint64(2 * width)) | part[have : have + m]
            have += width
        rest >>= 1
        if rest:
            m = len(part) - width
            if m <= 0:
                return np.zeros(0, np.uint64), np.zeros(0, bool)
            part, width = (part[:m] << np.uint64(2 * width)) | part[width : width + m], 2 * width
    upto = np.concatenate([[0], np.cumsum(bad)])
    n = len(s) - k + 1
    return out[:n], upto[k:] == upto[:n]


def _reverse_codes(x: np.ndarray, k: int) -> np.ndarray:
    """The codes of the reverse complements."""
    x = ~x
    for shift, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF)):
        m = np.uint64(mask)
        x = ((x >> np.uint64(shift)) & m) | ((x & m) << np.uint64(shift))
    x = (x >> np.uint64(32)) | (x << np.uint64(32))
    return x >> np.uint64(64 - 2 * k)


def kmer_codes(s: np.ndarray, k: int, both_strands: bool = True) -> np.ndarray | None:
    """The codes of the k-mers without N at every position, the smaller of both strands; None where codes can't tell
    them: k over 31, or letters other than A, C, G, T and N. The order of codes is that of the letters."""
    if not 0 < k <= 31 or (_CODE[s][s != ord("N")] == 4).any():
        return None
    if len(s) < k:
        return np.zeros(0, np.uint64)
    x, good = _window_codes(s, k)
    x = x[good]
    return np.minimum(x, _reverse_codes(x, k)) if both_strands and len(x) else x


def kmer_letters(codes: np.ndarray, k: int) -> np.ndarray:
    """The letters of codes as a byte matrix."""
    shift = np.arange(2 * (k - 1), -1, -2, dtype=np.uint64)
    return np.frombuffer(b"ACGT", np.uint8)[((codes[:, None] >> shift[None, :]) & np.uint64(3)).astype(np.int64)]


def unique_kmers(seq: bytes, k: int, both_strands: bool = True) -> np.ndarray:
    """The distinct k-mers without N of a sequence, as a byte matrix in order."""
    if len(seq) < k or k <= 0:
        return np.zeros((0, max(k, 1)), np.uint8)
    s = np.frombuffer(seq, np.uint8)
    codes = kmer_codes(s, k, both_strands)
    if codes is not None:
        return kmer_letters(np.unique(codes), k)
    win = np.lib.stride_tricks.sliding_window_view(s, k)
    win = np.ascontiguousarray(win[~(win == ord("N")).any(axis=1)])
    if both_strands and len(win):
        pair, to = C.complements(), np.arange(256, dtype=np.uint8)
        to[np.frombuffer("".join(pair).encode(), np.uint8)] = np.frombuffer("".join(pair.values()).encode(), np.uint8)
        back = np.ascontiguousarray(to[win[:, ::-1]])
        f, b = win.view(f"S{k}").ravel(), back.view(f"S{k}").ravel()
        win = np.where((f <= b)[:, None], win, back)
    if not len(win):
        return win
    return np.unique(np.ascontiguousarray(win).view(f"S{k}").ravel()).view(np.uint8).reshape(-1, k)


def signature_bytes(seq: str | None, k: int, sketch: C.Sketch) -> bytes:
    """Stored bytes: num_hashes, seed, positions, distinct k-mers as four u32, then lane i = min(h1 + i h2) as u64.

    Positions count those with an N, too. No k-mers leave all lanes at 2^64 - 1.
    """
    raw = (seq or "").encode()
    km = unique_kmers(raw, k, sketch.both_strands)
    lanes = np.full(sketch.lanes, 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    if len(km):
        h1, h2 = murmur3_x64_128(km, sketch.seed)
        step = max(1, (1 << 16) // max(sketch.lanes, 1))
        i = np.arange(sketch.lanes, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for a in range(0, len(km), step):
                lanes = np.minimum(lanes, (h1[a : a + step, None] + i[None, :] * h2[a : a + step, None]).min(axis=0))
    return struct.pack("<4I", sketch.lanes, sketch.seed, max(0, len(raw) - k + 1), len(km)) + lanes.astype("<u8").tobytes()


def build_signatures(segments: DataFrame, sketch: C.Sketch | None = None, seq: str = "seq", segment: str = "segment") -> DataFrame:
    """segments of known names with k_value and kmer_signature in place of the sequence; one narrow pass."""
    sketch = sketch or C.Sketch()
    selftest()
    df = segments.where(F.col(segment).isin(C.SEGMENTS)).withColumn("k_value", Q.kmer_size(segment, sketch))
    keep = [c for c in df.columns if c != seq]
    schema = StructType([*(df.schema[c] for c in keep), StructField("kmer_signature", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, k = b.column(b.schema.names.index(seq)).to_pylist(), b.column(b.schema.names.index("k_value")).to_pylist()
            sig = pa.array([signature_bytes(x, y, sketch) for x, y in zip(s, k)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.names.index(c)) for c in keep), sig], names=[*keep, "kmer_signature"])

    return spread(df).mapInArrow(run, schema)


def from_bytes(sig: bytes) -> dict:
    """The parts of stored bytes; bytes of another length raise."""
    n, seed, kmers, unique = struct.unpack("<4I", sig[:16])
    if len(sig) != 16 + 8 * n:
        raise ValueError(f"{len(sig)} bytes are no signature of {n} lanes")
    return {"num_hashes": n, "seed": seed, "kmer_count": kmers, "unique_kmer_count": unique, "lanes": np.frombuffer(sig[16:], "<u8")}


def to_bytes(num_hashes: int, seed: int, kmer_count: int, unique_kmer_count: int, lanes: np.ndarray) -> bytes:
    if len(lanes) != num_hashes:
        raise ValueError("as many lanes as num_hashes are needed")
    return struct.pack("<4I", num_hashes, seed, kmer_count, unique_kmer_count) + np.asarray(lanes).astype("<u8").tobytes()


def jaccard(a: bytes, b: bytes) -> float:
    """Equal lanes over their number; different num_hashes or seeds raise."""
    x, y = from_bytes(a), from_bytes(b)
    if (x["num_hashes"], x["seed"]) != (y["num_hashes"], y["seed"]):
        raise ValueError("signatures of different parameters can't be compared")
    return float((x["lanes"] == y["lanes"]).mean())


def merge_signatures(df: DataFrame, keys: list[str], signature: str = "kmer_signature") -> DataFrame:
    """(*keys, lane, value): the lane-wise minimum of a group's signatures: the signature of the union, mergeable.

    Values are decimals, as lanes are unsigned. Signatures of one group must share their parameters.
    """
    lanes = Q.signature_lanes(signature)
    rows = df.where(Q.is_usable(signature)).select(*keys, F.posexplode(lanes).alias("lane", "h"))
    value = F.conv(F.concat(*(F.substring("h", 2 * b + 1, 2) for b in range(7, -1, -1))), 16, 10).cast("decimal(20,0)")
    return rows.select(*keys, "lane", value.alias("value")).groupBy(*keys, "lane").agg(F.min("value").alias("value"))


def kmer_frequencies(df: DataFrame, keys: list[str], seq: str, k: int, both_strands: bool = True) -> DataFrame:
    """(*keys, kmer, n): how often each k-mer without N occurs for each key.

    Tasks count the integer codes of each batch before the shuffle, which sends 8 bytes a k-mer; letters come back after
    the last count. k-mers with other letters than A, C, G and T, or longer than 31, go as text beside them.
    """
    schema = StructType([*(df.schema[c] for c in keys), StructField("code", LongType()), StructField("text", StringType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, codes, texts, counts = [], [], [], []

            def add(i: int, code: np.ndarray, text: list, n: np.ndarray) -> None:
                rows.append(np.full(len(n), i))
                codes.append(code)
                texts.extend(text)
                counts.append(n)

            held = []
            for i, x in enumerate(b.column(len(keys)).to_pylist()):
                s = np.frombuffer((x or "").encode(), np.uint8)
                c = kmer_codes(s, k, both_strands)
                if c is None:
                    t, n = np.unique([z for z in Q.plain_kmers(x or "", k, both_strands)], return_counts=True)
                    add(i, np.full(len(t), -1), [str(z) for z in t], n)
                elif keys:
                    u, n = np.unique(c, return_counts=True)
                    add(i, u.view(np.int64), [None] * len(u), n)
                elif len(c):
                    held.append(c)
            if held:  # without keys a batch is counted as one
                u, n = np.unique(np.concatenate(held), return_counts=True)
                add(0, u.view(np.int64), [None] * len(u), n)
            if rows:
                at = pa.array(np.concatenate(rows).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(b.column(j).take(at) for j in range(len(keys))), pa.array(np.concatenate(codes).astype(np.int64)), pa.array(texts, pa.string()), pa.array(np.concatenate(counts).astype(np.int64))], names=[*keys, "code", "text", "n"])

    out = spread(df.select(*keys, seq)).mapInArrow(run, schema).groupBy(*keys, "code", "text").agg(F.sum("n").alias("n"))
    return out.select(*keys, F.coalesce("text", decoded(F.col("code"), k)).alias("kmer"), "n")


def decoded(code: Column, k: int) -> Column:
    """The letters of a k-mer's code."""
    digits = F.lpad(F.conv(code.cast("string"), 10, 4), k, "0")
    return F.translate(digits, "0123", "ACGT")


def kmer_counts(df: DataFrame, keys: list[str], seq: str, ks: list[int], both_strands: bool = True) -> DataFrame:
    """(*keys, k, total, distinct_kmers) of each sequence: k-mers without N and how many of them differ; one narrow pass.

    A null sequence counts as empty.
    """
    schema = StructType([*(df.schema[c] for c in keys), StructField("k", IntegerType()), StructField("total", LongType()), StructField("distinct_kmers", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, kk, total, distinct = [], [], [], []
            for i, x in enumerate(b.column(len(keys)).to_pylist()):
                raw = (x or "").encode()
                s = np.frombuffer(raw, np.uint8)
                for k in ks:
                    c = kmer_codes(s, k, both_strands)
                    if c is None:
                        every = sliding_without_n(s, k)
                        total.append(every)
                        distinct.append(len(unique_kmers(raw, k, both_strands)))
                    else:
                        total.append(len(c))
                        distinct.append(len(np.unique(c)))
                    rows.append(i)
                    kk.append(k)
            at_ = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(b.column(j).take(at_) for j in range(len(keys))), pa.array(kk, pa.int32()), pa.array(total, pa.int64()), pa.array(distinct, pa.int64())], names=[*keys, "k", "total", "distinct_kmers"])

    return spread(df.select(*keys, seq)).mapInArrow(run, schema)


def sliding_without_n(s: np.ndarray, k: int) -> int:
    """The number of windows of k letters without an N."""
    if len(s) < k or k <= 0:
        return 0
    upto = np.concatenate([[0], np.cumsum(s == ord("N"))])
    return int((upto[k:] == upto[: len(s) - k + 1]).sum())


def parameter_sweep(df: DataFrame, seq: str, ks: list[int] | None = None) -> DataFrame:
    """(k, mean_unique, std_unique, mean_total, mean_ratio) for each k (15, 17 to 31): all ks in one pass."""
    c = kmer_counts(df, [], seq, ks or list(range(15, 32, 2)))
    u, t = F.col("distinct_kmers"), F.col("total")
    return c.groupBy("k").agg(F.avg(u).alias("mean_unique"), F.stddev_pop(u).alias("std_unique"), F.avg(t).alias("mean_total"), F.avg(F.when(t > 0, u / t).otherwise(0.0)).alias("mean_ratio"))


def shared_kmer_pairs(df: DataFrame, key: str, seq: str, k: int, group: list[str] | None = None, most: int = 1000) -> DataFrame:
    """(*group, a, b, jaccard): exact Jaccard similarity of the k-mer sets of sequences that share a k-mer.

    Equal k-mer sets form a class first. A k-mer in more than `most` classes is left to salted joins: its postings are
    split in lots, and lots meet lots in separate tasks, so none gathers a hot k-mer's list.
    """
    group = group or []
    sets = df.select(*group, key, F.array_sort(F.array_distinct(Q.kmers(seq, k))).alias("ks")).where("size(ks) > 0")
    km = sets.select(*group, F.col(key).alias("id"), F.size("ks").alias("n"), F.explode("ks").alias("kmer"))
    hot = km.groupBy(*group, "kmer").agg(F.count("*").alias("c")).where(F.col("c") > most).select(*group, "kmer")
    hot = stage(hot, "hot")
    a = km.select(*group, "kmer", F.col("id").alias("a"), F.col("n").alias("na"))
    b = km.select(*group, "kmer", F.col("id").alias("b"), F.col("n").alias("nb"))
    on = [*group, "kmer"]
    if hot.isEmpty():
        pairs = a.join(b, on).where("a < b")
    else:
        lots = 16
        cold = a.join(hot, on, "left_anti").join(b.join(hot, on, "left_anti"), on).where("a < b")
        ah = a.join(hot, on, "left_semi").withColumns({"la": F.pmod(F.xxhash64("a"), F.lit(lots)).cast("int"), "lb": F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))})
        bh = b.join(hot, on, "left_semi").withColumns({"lb": F.pmod(F.xxhash64("b"), F.lit(lots)).cast("int"), "la": F.explode(F.sequence(F.lit(0), F.lit(lots - 1)))})
        pairs = cold.unionByName(ah.join(bh, [*on, "la", "lb"]).where("a < b").drop("la", "lb"))
    c = pairs.groupBy(*group, "a", "b", "na", "nb").agg(F.count("*").alias("both"))
    return c.select(*group, "a", "b", (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("jaccard"))
