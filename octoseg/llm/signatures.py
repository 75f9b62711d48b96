"""Stored MinHash signatures as token sets: parsing, classes of equal signatures, a rarity order, and candidate keys.

A usable signature of n lanes is a set of n tokens, one per (lane, value). Two comparable signatures agree in at least
`need` lanes exactly if they share at least `need` tokens, so set-similarity filters apply without loss:

* prefix keys: under any fixed order of all tokens, two sets that share `need` of n tokens share one of their first
  n - need + 1;
* band keys: cut the lanes into n - need + 1 bands and two such signatures have one whole band in common.

The order is by a count sketch over all rows, rare tokens first. A wrong count costs time, never a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from octoseg.runtime import share, stage

BLOCKS = 64
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def need(n: int, threshold: float) -> int:
    """The least number of equal lanes of n that makes an agreement of threshold or more."""
    return max(1, math.ceil(threshold * n - 1e-9))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _data(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and lengths (-1 for null) of a binary array."""
    arr = arr.combine_chunks() if isinstance(arr, pa.ChunkedArray) else arr
    if not pa.types.is_large_binary(arr.type):
        arr = arr.cast(pa.large_binary())
    _, off, data = arr.buffers()
    off = np.frombuffer(off, dtype=np.int64, count=len(arr) + 1 + arr.offset)[arr.offset :]
    size = np.diff(off)
    if arr.null_count:
        size = np.where(np.asarray(arr.is_null()), -1, size)
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), off[:-1], size


def parse(arr: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(lanes n, row numbers, hash seeds, matrix of lanes) of the usable signatures, for each n that occurs.

    Usable: four little-endian uint32 (num_hashes, hash seed, kmer_count, unique_kmer_count), num_hashes lanes of
    little-endian uint64, nothing more or less, and a positive unique_kmer_count.
    """
    data, off, size = _data(arr)
    rows = np.flatnonzero(size >= 24)
    if not len(rows):
        return
    head = np.ascontiguousarray(data[off[rows][:, None] + np.arange(16)]).view("<u4")
    good = (size[rows] == 16 + 8 * head[:, 0].astype(np.int64)) & (head[:, 3] > 0)
    rows, head = rows[good], head[good]
    for n in np.unique(head[:, 0]):
        at = head[:, 0] == n
        lanes = np.ascontiguousarray(data[off[rows[at]][:, None] + 16 + np.arange(8 * int(n))]).view("<u8")
        yield int(n), rows[at], head[at, 1], lanes


def tokens(lanes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A 64-bit token for each (group, lane, value); group is a 64-bit hash of what makes signatures comparable."""
    with np.errstate(over="ignore"):
        lane = (np.arange(1, lanes.shape[1] + 1, dtype=np.uint64)) * _M1
        return mix(mix(lanes + lane) ^ group.astype(np.uint64)[:, None])


def equal_lanes(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Of two arrays of lane bytes, row by row, the number of equal lanes; rows must match in length."""
    da, oa, sa = _data(a)
    db, ob, _ = _data(b)
    out = np.zeros(len(sa), dtype=np.int32)
    for size in np.unique(sa):
        if size > 0:
            at, span = np.flatnonzero(sa == size), np.arange(size)
            for i in range(0, len(at), 4096):
                k = at[i : i + 4096]
                x = np.ascontiguousarray(da[oa[k][:, None] + span]).view("<u8")
                y = np.ascontiguousarray(db[ob[k][:, None] + span]).view("<u8")
                out[k] = (x == y).sum(axis=1)
    return out


def binary(rows: np.ndarray) -> pa.Array:
    """The rows of a contiguous matrix as a binary column."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    off = np.arange(len(rows) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(off), pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def codes(lanes: np.ndarray) -> np.ndarray:
    """256 bits for each signature, as four words: 256 // n bits (1 to 8) of each of the first 256 lanes.

    Equal lanes have equal bits, so the number of unequal fields never exceeds the number of unequal lanes.
    """
    n = min(lanes.shape[1], 256)
    bits = field_bits(n)
    h = mix(lanes[:, :n] + _M1) & np.uint64((1 << bits) - 1)
    per = 64 // bits
    out = np.zeros((len(lanes), 4), dtype=np.uint64)
    for j in range(n):
        out[:, j // per] |= h[:, j] << np.uint64((j % per) * bits)
    return out.view(np.int64)


def field_bits(n: int) -> int:
    """Bits a lane gets in codes()."""
    return 8 if n <= 32 else 4 if n <= 64 else 2 if n <= 128 else 1


def unequal_fields(n, a: list, b: list):
    """The number of unequal fields of two codes(), as a column; n is the column of the number of lanes."""
    total = None
    for x, y in zip(a, b):
        z = x.bitwiseXOR(y)
        z2 = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        z4 = z2.bitwiseOR(F.shiftrightunsigned(z2, 2))
        z8 = z4.bitwiseOR(F.shiftrightunsigned(z4, 4))
        m = F.when(n <= 32, z8.bitwiseAND(F.lit(0x0101010101010101))).when(n <= 64, z4.bitwiseAND(F.lit(0x1111111111111111))).when(n <= 128, z2.bitwiseAND(F.lit(0x5555555555555555))).otherwise(z)
        c = F.bit_count(m)
        total = c if total is None else total + c
    return total


CLASS_SCHEMA = "segment_name string, h1 long, h2 long, n int, grp long, lanes binary, c0 long, c1 long, c2 long, c3 long"


def _to_classes(*extra: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seg, gh = b.column("segment_name"), np.asarray(b.column("gh")).view(np.uint64)
            h1, h2 = np.asarray(b.column("h1")), np.asarray(b.column("h2"))
            for n, rows, seeds, lanes in parse(b.column("sig")):
                with np.errstate(over="ignore"):
                    grp = mix(gh[rows] + np.uint64(n) * _M2 + seeds.astype(np.uint64) * _M3)
                c, at = codes(lanes), pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [seg.take(at), pa.array(h1[rows]), pa.array(h2[rows]), pa.array(np.full(len(rows), n, np.int32)), pa.array(grp.view(np.int64)), binary(lanes), *(pa.array(c[:, i]) for i in range(4)), *(b.column(x).take(at) for x in extra)],
                    names=["segment_name", "h1", "h2", "n", "grp", "lanes", "c0", "c1", "c2", "c3", *extra],
                )

    return run


def keyed(df: DataFrame, signature: str = "kmer_signature") -> DataFrame:
    """df with h1, h2: 128 bits of hash that stand for the signature's bytes."""
    return df.withColumns({"h1": F.xxhash64(F.col(signature)), "h2": F.xxhash64(F.col(signature), F.lit(2))})


def classes(df: DataFrame, signature: str = "kmer_signature", first: str | None = None) -> DataFrame:
    """One staged row for each distinct usable signature of a segment: cid, its hashes, lanes and code, and the least
    value of the long column `first`, if one is named, as that column.

    Rows with a null segment or an unusable signature make no class. Copies meet in map-side partial aggregates, so a
    signature that a third of all rows share costs no large group.
    """
    c = keyed(df.where(F.col("segment_name").isNotNull() & (F.length(signature) >= 24)), signature)
    least = [F.min(first).alias(first)] if first else []
    c = c.groupBy("segment_name", "h1", "h2").agg(F.first(signature).alias("sig"), *least).withColumn("gh", F.xxhash64("segment_name"))
    own = [first] if first else []
    c = c.mapInArrow(_to_classes(*own), CLASS_SCHEMA + "".join(f", {x} long" for x in own))
    return stage(c.select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")


def members(df: DataFrame, cls: DataFrame, *keep: str, signature: str = "kmer_signature") -> DataFrame:
    """The distinct (cid, *keep) of df's rows whose signature has a class."""
    m = keyed(df.where(F.col("segment_name").isNotNull() & (F.length(signature) >= 24)), signature)
    m = m.select("segment_name", "h1", "h2", *keep).distinct()
    return m.join(cls.select("cid", "segment_name", "h1", "h2"), ["segment_name", "h1", "h2"])


# --- rarity order -----------------------------------------------------------------------------------------------------


def sketch_width(rows: int) -> int:
    """Counters for so many signatures: a power of two, 2^16 to 2^23, so the array has at most 32 MB at any size."""
    return 1 << min(23, max(16, math.ceil(math.log2(max(1, rows) * 4))))


def levels(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes in the same order: exact up to 63, then seven steps to each doubling."""
    c = np.maximum(counts, 1).astype(np.float64)
    return np.where(counts < 64, counts, np.minimum(64 + 7 * np.log2(c / 64), 255)).astype(np.uint8)


def order_sketch(cls: DataFrame, width: int, fan: int = 64, small: bool = False) -> np.ndarray:
    """Counts of all tokens of all rows, in `width` counters by hash; with small their levels(), a byte each.

    Each task counts one sketch, of at most 32 MB, and there are at most twice as many tasks as cores, whatever the
    number of partitions. Sketches are added up block by block in two levels of up to `fan` parts; the driver gets the
    one sum.
    """
    schema = "block int, part int, counts binary"
    kind = np.uint8 if small else np.uint32

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(width, dtype=np.uint32)
        for b in batches:
            for lanes, grp in lane_groups(b):
                total += np.bincount((tokens(lanes, grp) & np.uint64(width - 1)).ravel().astype(np.int64), minlength=width).astype(np.uint32)
        if total.any():
            part = np.full(BLOCKS, TaskContext.get().partitionId() % fan, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BLOCKS, dtype=np.int32)), pa.array(part), binary(total.reshape(BLOCKS, -1))], names=["block", "part", "counts"])

    def added(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(width // BLOCKS, dtype=np.uint64)
        for x in pdf["counts"]:
            total += np.frombuffer(x, dtype=np.uint32)
        return pd.DataFrame({"block": [key[0]], "part": [0], "counts": [np.minimum(total, 0xFFFFFFFF).astype(np.uint32).tobytes()]})

    def last(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = added(key, pdf)
        return out.assign(counts=[levels(np.frombuffer(x, dtype=np.uint32)).tobytes() for x in out["counts"]]) if small else out

    tasks = 2 * cls.sparkSession.sparkContext.defaultParallelism
    got = cls.select("grp", "n", "lanes").coalesce(tasks).mapInArrow(partial, schema)
    if tasks > fan:
        got = got.groupBy("block", "part").applyInPandas(added, schema)
    out = np.zeros((BLOCKS, width // BLOCKS), dtype=kind)
    for r in got.groupBy("block").applyInPandas(last, schema).collect():
        out[r["block"]] = np.frombuffer(r["counts"], dtype=kind)
    return out.ravel()


def lane_groups(b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(matrix of lanes, group hashes) of a batch of classes, for each number of lanes."""
    for lanes, rows in lane_rows(b.column("lanes")):
        yield lanes, np.asarray(b.column("grp")).view(np.uint64)[rows]


def lane_rows(arr: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    data, off, size = _data(arr)
    for s in np.unique(size):
        if s > 0:
            rows = np.flatnonzero(size == s)
            for i in range(0, len(rows), 4096):
                at = rows[i : i + 4096]
                yield np.ascontiguousarray(data[off[at][:, None] + np.arange(s)]).view("<u8"), at


def ranked(tok: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Column numbers of each row's tokens, rarest first; ties by the token itself, so all rows use one order."""
    c = counts[(tok & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.uint64)
    return np.argsort((np.minimum(c, np.uint64(0xFFFFFFFF)) << np.uint64(32)) | (tok >> np.uint64(32)), axis=1, kind="stable")


def prefix_keys(tok: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the rarest n - least + 1 tokens of each row."""
    p = tok.shape[1] - least + 1
    first = np.take_along_axis(tok, ranked(tok, counts)[:, :p], axis=1)
    return np.repeat(np.arange(len(tok)), p), first.ravel()


def band_keys(tok: np.ndarray, counts: np.ndarray, least: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the bands of each row; a band all of whose tokens are hot is split by the rarest other tokens.

    Rows that share a band share the decision, which rests on the band's tokens alone. Within a hot band two rows that
    agree in `least` lanes also share one of the rarest n - least + 1 tokens outside it.
    """
    m, n = tok.shape
    d = n - least + 1
    est = counts[(tok & np.uint64(len(counts) - 1)).astype(np.int64)]
    order = ranked(tok, counts)
    rows, keys = [], []
    for i, band in enumerate(np.array_split(np.arange(n), d)):
        with np.errstate(over="ignore"):
            k = np.full(m, np.uint64(i + 1)) * _M1
            for j in band:
                k = mix(k ^ tok[:, j])
        is_hot = est[:, band].min(axis=1) > hot
        rows.append(np.flatnonzero(~is_hot))
        keys.append(k[~is_hot])
        at = np.flatnonzero(is_hot)
        if len(at) and len(band) == n:  # no lane is left to split by
            rows.append(at)
            keys.append(k[at])
        elif len(at):
            outside = order[at]
            outside = outside[(outside < band[0]) | (outside > band[-1])].reshape(len(at), n - len(band))[:, :d]
            with np.errstate(over="ignore"):
                k2 = mix(k[at][:, None] + np.take_along_axis(tok[at], outside, axis=1) * _M2)
            rows.append(np.repeat(at, outside.shape[1]))
            keys.append(k2.ravel())
    return np.concatenate(rows), np.concatenate(keys)


def postings(cls: DataFrame, counts, threshold: float, kind: str = "prefix", hot: int = 64) -> DataFrame:
    """(key, cid) rows of all classes; counts is a broadcast variable with the order sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counts.value
        for b in batches:
            cid = np.asarray(b.column("cid"))
            for lanes, at in lane_rows(b.column("lanes")):
                tok = tokens(lanes, np.asarray(b.column("grp")).view(np.uint64)[at])
                least = need(tok.shape[1], threshold)
                rows, keys = prefix_keys(tok, c, least) if kind == "prefix" else band_keys(tok, c, least, hot)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(cid[at][rows])], names=["key", "cid"])

    return cls.select("cid", "grp", "lanes").mapInArrow(run, "key long, cid long")


def rarity(cls: DataFrame):
    """The broadcast order sketch of cls, and the count above which a token is hot: well above what collisions add."""
    rows = cls.count()
    width = sketch_width(rows)
    counts = order_sketch(cls, width)
    return share(cls.sparkSession, counts), int(64 + 2 * counts.mean())


def rarity_levels(cls: DataFrame):
    """The broadcast order sketch of cls as bytes, at most 8 MB: enough for an order, not for a limit of hot tokens."""
    return share(cls.sparkSession, order_sketch(cls, sketch_width(cls.count()), small=True))


def verified(pairs: DataFrame, cls: DataFrame, threshold: float, left: str = "ca", right: str = "cb", other: DataFrame | None = None) -> DataFrame:
    """pairs whose signatures agree in at least the threshold, with the number of equal lanes.

    pairs has cid columns left and right, n; lanes come by two joins on the same exchange of cls.
    """
    a = cls.select(F.col("cid").alias(left), F.col("lanes").alias("la"))
    b = (cls if other is None else other).select(F.col("cid").alias(right), F.col("lanes").alias("lb"))
    return with_equal(pairs.join(a, left).join(b, right).select(*pairs.columns, "la", "lb"), threshold)


def with_equal(pairs: DataFrame, threshold: float) -> DataFrame:
    """pairs (n, la, lb, ...) whose lanes agree in at least the threshold, with the number of equal ones in their place."""
    keep = [c for c in pairs.columns if c not in ("la", "lb")]
    schema = StructType([f for f in pairs.schema if f.name in keep]).add("equal", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            eq = equal_lanes(x.column("la"), x.column("lb"))
            ok = eq >= np.ceil(threshold * np.asarray(x.column("n")) - 1e-9)
            t = pa.RecordBatch.from_arrays([*(x.column(c) for c in keep), pa.array(eq)], names=[*keep, "equal"])
            yield t.filter(pa.array(ok))

    return pairs.mapInArrow(run, schema)
