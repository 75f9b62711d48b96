"""Encoding with a public byte-level BPE vocabulary: whole pre-tokens by a minimal perfect hash, the rest by a heap."""

from __future__ import annotations

import base64
import heapq
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from octoseg.runtime import table

#: The folder of the public vocabularies, the file used by default, and the pattern that goes with it.
TOKENIZERS = "/opt/tokenizers"
DEFAULT_FILE = "byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary(path: str | None = None) -> list[tuple[bytes, int]]:
    """(token, rank) of a rank file; path defaults to OCTOSEG_TOKENIZER or the default file."""
    path = path or os.environ.get("OCTOSEG_TOKENIZER") or f"{TOKENIZERS}/{DEFAULT_FILE}"
    with open(path, "rb") as f:
        return [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]


class PerfectHash:
    """A minimal perfect hash of byte strings to ranks: n slots for n keys, found by displacing buckets, largest first.

    The arrays are about 12 bytes a key and travel as one broadcast; get() is one hash, one displacement, one compare.
    """

    __slots__ = ("displace", "keys", "n", "ranks")

    def __init__(self, items: list[tuple[bytes, int]], load: int = 2) -> None:
        self.n = max(1, len(items))
        hashes = [xxhash.xxh3_128_intdigest(k) for k, _ in items]
        lots = max(1, self.n // load)
        buckets: list[list[int]] = [[] for _ in range(lots)]
        for i, h in enumerate(hashes):
            buckets[h % lots].append(i)
        self.displace = [0] * lots
        self.keys: list[bytes | None] = [None] * self.n
        self.ranks = [0] * self.n
        order = sorted(range(lots), key=lambda b: -len(buckets[b]))
        for b in order:
            ids = buckets[b]
            if len(ids) < 2:
                break
            d = 0
            while True:
                at = [self._slot(hashes[i], d) for i in ids]
                if len(set(at)) == len(at) and all(self.keys[s] is None for s in at):
                    break
                d += 1
                if d > 100 * self.n:
                    raise ValueError("two equal tokens in the vocabulary")
            self.displace[b] = d
            for i, s in zip(ids, at):
                self.keys[s], self.ranks[s] = items[i]
        free = iter([s for s in range(self.n) if self.keys[s] is None])
        for b in order:
            if len(buckets[b]) == 1:  # any free slot will do: it is written down as a negative displacement
                s = next(free)
                self.displace[b] = -s - 1
                self.keys[s], self.ranks[s] = items[buckets[b][0]]

    def _slot(self, h: int, d: int) -> int:
        x = (((h >> 64) ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x ^ (x >> 32)) % self.n

    def get(self, key: bytes) -> int:
        """The rank of key, or -1."""
        h = xxhash.xxh3_128_intdigest(key)
        d = self.displace[h % len(self.displace)]
        s = self._slot(h, d) if d >= 0 else -d - 1
        return self.ranks[s] if self.keys[s] == key else -1


class Ranks(dict):
    """Ranks of the byte strings that merges ask for again and again, or -1; emptied when it holds more than keep."""

    def __init__(self, table_: PerfectHash, keep: int = 200_000) -> None:
        self.table, self.keep = table_, keep
        self.longest = max(map(len, table_.keys), default=0)

    def __missing__(self, key: bytes) -> int:
        if len(key) > self.longest:
            return -1
        if len(self) > self.keep:
            self.clear()
        r = self[key] = self.table.get(key)
        return r


def merge_bytes(piece: bytes, ranks: Ranks) -> list[int]:
    """The ids of a pre-token outside the vocabulary: a heap of adjacent pairs over linked bytes, lowest rank first.

    Each merge looks at its two neighbours only, so a piece of m bytes takes O(m log m).
    """
    m = len(piece)
    end = list(range(1, m + 1))  # end[i]: where the part that begins at i ends; the next part begins there
    before = list(range(-1, m - 1))
    alive = [True] * m
    heap: list[tuple[int, int, int]] = []  # (rank, where a pair begins, where it ends)
    for i in range(m - 1):
        r = ranks[piece[i : i + 2]]
        if r >= 0:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, stop = pop(heap)
        j = end[i]
        if not alive[i] or j >= m or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < m:
            before[stop] = i
            r = ranks[piece[i : end[stop]]]
            if r >= 0:
                push(heap, (r, i, end[stop]))
        k = before[i]
        if k >= 0:
            r = ranks[piece[k:stop]]
            if r >= 0:
                push(heap, (r, k, stop))
    out, i = [], 0
    while i < m:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Encoder:
    """Pre-token cache over the two tiers; made once in each Python worker.

    keep bounds the cache: it is emptied when it holds more pre-tokens, whatever the corpus.
    """

    def __init__(self, table_: PerfectHash, keep: int = 200_000, pattern: str = PATTERN) -> None:
        self.table, self.keep, self.ranks = table_, keep, Ranks(table_, keep)
        self.find = regex.compile(pattern).findall

        outer = self

        class Cache(dict):
            def __missing__(self, piece: str) -> tuple[int, ...]:
                b = piece.encode("utf-8")
                r = outer.table.get(b)
                ids = (r,) if r >= 0 else tuple(merge_bytes(b, outer.ranks))
                if len(b) <= 64:
                    self[piece] = ids
                return ids

        self.cache = Cache()

    def encode(self, text: str) -> list[int]:
        if len(self.cache) > self.keep:
            self.cache.clear()
        return list(chain.from_iterable(map(self.cache.__getitem__, self.find(text))))

    def count(self, text: str) -> int:
        if len(self.cache) > self.keep:
            self.cache.clear()
        return sum(map(len, map(self.cache.__getitem__, self.find(text))))


_ENCODERS: dict[int, Encoder] = {}


def worker_encoder(table_) -> Encoder:
    """This worker's encoder of a broadcast table."""
    key = getattr(table_, "_id", None) or id(table_)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(table_.value)
    return _ENCODERS[key]


_TABLES: dict[tuple[str, str | None], object] = {}


def shared_table(spark, path: str | None = None):
    """The perfect hash of a vocabulary as a broadcast variable, made once for each application."""
    key = (spark.sparkContext.applicationId, path)
    if key not in _TABLES:
        _TABLES[key] = spark.sparkContext.broadcast(PerfectHash(vocabulary(path)))
    return _TABLES[key]


def spread(df: DataFrame, columns: list[str], per_core: int = 3) -> DataFrame:
    """df in enough partitions to keep all cores busy, if its scan gives fewer than the cores there are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.select(*columns) if len(df.inputFiles()) >= cores else df.select(*columns).repartition(cores * per_core)


def encode_texts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(key, ids): the token ids of each text, without special tokens; an empty or null text has an empty list.

    One narrow pass: no shuffle but to spread a small table. Whole texts of any length are encoded; repeated rows give
    repeated results; other columns are ignored; an empty table gives no rows.
    """
    shared = shared_table(df.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(shared)
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                off, flat = [0], []
                for t in part.column(1).to_pylist():
                    if t:
                        flat += enc.encode(t)
                    off.append(len(flat))
                ids = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.array(flat, dtype=np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[key, "ids"])

    kind = df.schema[key].dataType.simpleString()
    return spread(df, [key, text]).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(df: DataFrame, keep: list[str], text: str = "text", path: str | None = None) -> DataFrame:
    """(*keep, tokens): the number of tokens of each text, 0 for empty and null ones."""
    from pyspark.sql.types import LongType, StructField, StructType

    shared = shared_table(df.sparkSession, path)
    schema = StructType([*(df.schema[k] for k in keep), StructField("tokens", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(shared)
        for b in batches:
            n = [enc.count(t) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(n, pa.int64())], names=[*keep, "tokens"])

    return spread(df, [*keep, text]).mapInArrow(run, schema)


def p8_ids(spark, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"))
