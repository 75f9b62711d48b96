import math
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

import sketches as X  # noqa: E402

from octoseg.llm import history_index as H  # noqa: E402
from octoseg.llm import near_duplicates as N  # noqa: E402
from octoseg.llm import neighbours as K  # noqa: E402
from octoseg.llm import signatures as S  # noqa: E402
from octoseg.llm import similarity_clusters as C  # noqa: E402
from octoseg.runtime import scratch  # noqa: E402

ROWS = X.table()
AGREE = X.agreements(ROWS)


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, X.SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], X.SCHEMA)


def groups(links, nodes):
    par = {n: n for n in nodes}

    def root(x):
        while par[x] != x:
            x = par[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        par[y] = x
    return {n: root(n) for n in nodes}


def test_near_duplicate_pairs(df, empty):
    want = {k for k, v in AGREE.items() if v >= 0.85}
    got = [tuple(r) for r in N.near_duplicate_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert N.near_duplicate_pairs(empty).count() == 0


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_bands_lose_nothing(df, hot):
    cls = S.classes(N.records(df))
    mem = S.members(N.records(df), cls, "sequence_id")
    got = {tuple(r) for r in N.record_pairs(N.similar_classes(cls, 0.85, hot), mem).collect()}
    assert got == {k for k, v in AGREE.items() if v >= 0.85}


def test_groups(df):
    links = [((s, a), (s, b)) for (s, a, b), v in AGREE.items() if v >= 0.85]
    want = groups(links, X.records(ROWS))
    got = N.near_duplicate_groups(df).collect()
    assert {(r["segment_name"], r["sequence_id"]): (r["segment_name"], r["group_id"]) for r in got} == want


@pytest.mark.parametrize("copies", [255, 300])
def test_copies_have_one_form(spark, copies):
    """As many pairs as there are, whatever the number of copies; the groups are linear and say who is whose copy."""
    rng = random.Random(5)
    lanes = [rng.getrandbits(64) for _ in range(64)]
    rows = [(i, f"c{i:03d}", "HA", X.signature(lanes), 0.1, "v", 1, "", "") for i in range(copies)]
    rows.append((999, "near", "HA", X.signature([1, 2, 3, *lanes[3:]]), 0.1, "v", 1, "", ""))
    df = spark.createDataFrame(rows, X.SCHEMA)
    got = {(r[1], r[2]) for r in N.near_duplicate_pairs(df).collect()}
    names = sorted(r[1] for r in rows)
    assert got == {(a, b) for i, a in enumerate(names) for b in names[i + 1 :]}
    g = N.near_duplicate_groups(df).collect()
    assert len(g) == copies + 1 and {r["group_id"] for r in g} == {"c000"} and {r["class_id"] for r in g} == {"c000", "near"}
    assert {(r["links"], r["copies"]) for r in g} == {(1, copies), (1, 1)}


def test_bands_of_all_lanes_stay(spark):
    """At threshold 1 the only band holds all lanes: equal lanes under other headers keep their link, hot or not."""
    rows = [(i, f"x{i}", "HA", X.signature([1, 2, 3, 4], unique=i + 1), 0.1, "v", 1, "", "") for i in range(6)]
    cls = S.classes(N.records(spark.createDataFrame(rows, X.SCHEMA)))
    assert N.similar_classes(cls, 1.0, 0).count() == 15


def test_components(spark):
    rng = random.Random(2)
    e = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    got = {r["node"]: r["component"] for r in N.connected_components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == groups([x for x in e if x[0] != x[1]], {n for x in e if x[0] != x[1] for n in x})
    assert N.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_most_similar(df, empty):
    near = {}
    for (s, a, b), v in AGREE.items():
        if v >= 0.75:
            near.setdefault((s, a), []).append((-v, b))
            near.setdefault((s, b), []).append((-v, a))
    for k, first in ((5, 0.9), (2, 0.9), (5, 0.75), (1, 0.95), (1, 0.76)):
        want = {(s, a, b, round(-v, 9)) for (s, a), l in near.items() for v, b in sorted(l)[:k]}
        got = {(r[0], r[1], r[2], round(r[3], 9)) for r in K.most_similar(df, k, near=first).collect()}
        assert got == want
    want = {(s, a, b, round(-v, 9)) for (s, a), l in near.items() for v, b in sorted(l)[:5]}
    assert {(r[0], r[1], r[2], round(r[3], 9)) for r in K.most_similar(df, z=math.inf).collect()} == want
    assert K.most_similar(empty).count() == 0


def test_the_driver_gets_a_byte_a_counter(df, monkeypatch):
    """What p2 collects and broadcasts is bounded by a byte for each counter, and keeps the order of the counts."""
    sent = []
    share = S.share
    monkeypatch.setattr(S, "share", lambda spark, v: sent.append(v.copy()) or share(spark, v))
    K.most_similar(df).count()
    cls = S.classes(N.records(df))
    exact = S.order_sketch(cls, S.sketch_width(cls.count()))
    assert sent[0].nbytes == exact.size and all(v.nbytes < exact.size for v in sent[1:]) and (sent[0] == S.levels(exact)).all() and exact.max() > 9
    c = np.unique(np.concatenate([np.arange(3000), 2 ** np.arange(33) - 1])).astype(np.uint32)
    assert (np.diff(S.levels(c).astype(int)) >= 0).all() and (S.levels(c[:64]) == c[:64]).all() and S.levels(c[-1:])[0] == 64 + 7 * 26 - 1


def test_estimates_keep_to_their_bound():
    rng = np.random.default_rng(3)
    rot = K.rotation()
    assert np.allclose(rot @ rot.T, np.eye(K.BITS), atol=1e-4)
    a = rng.integers(0, 2**63, (4000, 64)).astype(np.uint64)
    b = a.copy()
    b[:, :16] = rng.integers(0, 2**63, (4000, 16)).astype(np.uint64)
    (wa, fa), (wb, fb) = K.one_bit(K.embed(a), rot), K.one_bit(K.embed(b), rot)
    h = np.array([sum(bin(int(x) & 0xFFFFFFFFFFFFFFFF).count("1") for x in r) for r in wa ^ wb])
    est = np.sin(np.clip((1 - 2 * h / K.BITS) / (fa * fb), -np.pi / 2, np.pi / 2))
    assert abs(est.mean() - 0.75) < 0.02 and (est >= 0.75 - K.error_bound(0.75)).all() and (est < 0.75 - K.error_bound(0.75, 4)).mean() < 0.001


@pytest.mark.parametrize("n", [64, 100, 128])
def test_refined_estimates_keep_to_their_bound(spark, n):
    """A code against a four-bit vector: without bias, closer than two codes, within the bound of each pair."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 2**63, (2000, n)).astype(np.uint64)
    b = a.copy()
    b[:, : n // 4] = rng.integers(0, 2**63, (2000, n // 4)).astype(np.uint64)
    cls = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate([*a, *b])], "cid long, lanes binary")
    code = K.with_codes(cls).cache()
    left = code.where("cid < 2000").select("cid", "n", *K.WORDS, "f")
    right = code.where("cid >= 2000").select((F.col("cid") - 2000).alias("cid"), *(F.col(w).alias(f"v{i}") for i, w in enumerate(K.WORDS)), F.col("f").alias("fb"), *K.PLANES, "low", "step", "total")
    words = [F.col(w) for w in K.WORDS]
    est = K.refined(words, F.col("f"), [F.col(p) for p in K.PLANES], F.col("low"), F.col("step"), F.col("total"))
    bound = K.refined_bound(F.lit(0.75), F.col("f"), F.col("step"), F.col("n"), 1.0)
    two = K.estimate(words, [F.col(f"v{i}") for i in range(4)], F.col("f"), F.col("fb"))
    got = np.array([tuple(r) for r in left.join(right, "cid").select(est, bound, two).collect()])
    off = (got[:, 0] - 0.75) / got[:, 1]
    assert len(got) == 2000 and abs(got[:, 0].mean() - 0.75) < 0.005 and 0.8 < off.std() < 1.1 and abs(off).max() < 5
    assert got[:, 0].std() < 0.9 * got[:, 2].std()


def test_the_kth_best_decides_what_is_reranked(spark, monkeypatch):
    """Where records have k near ones, only pairs that can be as near are compared on all lanes; none of these is lost."""
    rng = random.Random(6)
    centre = [rng.getrandbits(64) for _ in range(64)]
    rows = []
    for i in range(160):
        if i % 4 == 0:
            family = list(centre)
            for j in rng.sample(range(64), 8):
                family[j] = rng.getrandbits(64)
        v = list(family)
        v[rng.randrange(64)] = rng.getrandbits(64)
        rows.append((i, f"d{i:03d}", "HA", X.signature(v), 0.1, "v", 1, "n", "l"))
    near = {}
    for (_, a, b), v in X.agreements(rows).items():
        if v >= 0.75:
            near.setdefault(a, []).append((-v, b))
            near.setdefault(b, []).append((-v, a))
    compared, verified = [], S.verified
    monkeypatch.setattr(S, "verified", lambda pairs, *a: compared.append(pairs.count()) or verified(pairs, *a))
    got = {(r[1], r[2], round(r[3], 9)) for r in K.most_similar(spark.createDataFrame(rows, X.SCHEMA), 2, near=0.75).collect()}
    assert got == {(a, b, round(-v, 9)) for a, l in near.items() for v, b in sorted(l)[:2]}
    every = sum(len(l) for l in near.values()) // 2
    assert len(compared) == 2 and compared[0] <= 320 and sum(compared) < 0.4 * every


def test_history_index(spark, df, empty):
    rows = [r for r in ROWS]
    rng = random.Random(8)
    inc = []
    for i in range(60):
        r = rng.choice(rows)
        kind = i % 5
        sig = r[3]
        if kind == 1 and sig is not None and len(sig) == 528:
            sig = bytearray(sig)
            for j in rng.sample(range(64), rng.choice([2, 9, 10, 30])):
                sig[16 + 8 * j : 24 + 8 * j] = rng.getrandbits(64).to_bytes(8, "little")
        name = [None, f"new{i}", (r[1] or "x").upper() + " ", f"new{i % 7}", f" NEW {i % 7}"][kind]
        inc.append((i, i // 20, name, r[2], bytearray(sig) if sig is not None else None))
    idx = H.SignatureIndex.create(df.select("segment_name", "kmer_signature"), scratch(spark, "index"), per_bucket=50)
    assert idx.buckets > 4
    subs = spark.createDataFrame(inc, "submission_id long, batch_no int, sequence_id string, segment_name string, kmer_signature binary")
    got = {r["submission_id"]: (r["known_id"], r["near_duplicate"]) for r in H.check_batches(idx, df, subs).collect()}
    plain = lambda s: None if s is None else "".join(s.split()).lower()
    ids, sigs, want = {(r[2], plain(r[1])) for r in rows if r[1] and r[2]}, [], {}
    for r in rows:
        sigs += [(r[2], v) for k, v in X.records([(0, "x", *r[2:])]).items()]
    for i, _, name, seg, sig in inc:
        a = seg is not None and name is not None and (seg, plain(name)) in ids
        mine = X.records([(0, "x", seg, sig)])
        b = any(s == seg and p[0] == v[0] and sum(x == y for x, y in zip(p[1], v[1])) >= 0.85 * v[0][0] for v in mine.values() for s, p in sigs)
        want[i] = (a, b)
        if seg is not None and name is not None:
            ids.add((seg, plain(name)))
        sigs += [(seg, v) for v in mine.values()]
    assert got == want
    # an index opened again goes on where the first one ended: now everything usable is known
    again = H.SignatureIndex(spark, idx.path)
    assert again.batches() == [0, 1, 2, 3] and again.buckets == idx.buckets
    cids = [r[0] for r in again.signatures().select("cid").collect()]
    assert len(cids) == len(set(cids)) and {c >> 51 for c in cids} == {0, 1, 2, 3}
    later = subs.withColumn("submission_id", F.col("submission_id") + 100)
    usable = {i: bool(X.records([(0, "x", seg, sig)])) for i, _, _, seg, sig in inc}
    assert {r["submission_id"] - 100: r["near_duplicate"] for r in H.check_batches(again, df, later).collect()} == usable
    assert H.check_batches(idx, df, subs.limit(0)).count() == 0
    # overlapping batches are taken together, in any order of their numbers
    mixed = subs.withColumn("batch_no", F.when(F.col("submission_id") % 2 == 0, 9).otherwise(None))
    other = H.SignatureIndex.create(df.select("segment_name", "kmer_signature"), scratch(spark, "index"))
    assert {r["submission_id"]: (r["known_id"], r["near_duplicate"]) for r in H.check_batches(other, df, mixed).collect()} == want


def test_index_ids_and_crashes(spark, empty):
    """Batches never share a cid, whatever the first one's are; what a crashed append left behind is overwritten."""
    rng = random.Random(3)
    row = lambda i: (i, f"s{i}", "HA", X.signature([rng.getrandbits(64) for _ in range(64)]), 0.1, "v", 1, "", "")
    one, two = (spark.createDataFrame([row(i)], X.SCHEMA).select("segment_name", "kmer_signature") for i in (1, 2))
    idx = H.SignatureIndex.create(one, scratch(spark, "index"))
    spark.range(3).selectExpr("id as key", "id as cid", "0 as bucket").write.partitionBy("bucket").parquet(f"{idx.path}/postings/1")
    assert idx.postings().count() == 10
    cls = S.classes(two)
    idx.append(cls, F.lit(7).cast("long"))
    assert sorted((r["cid"], r["first_sub"]) for r in idx.signatures().collect()) == [(0, -1), (1 << 51, 7)] and idx.postings().count() == 20
    assert H.SignatureIndex.create(empty.select("segment_name", "kmer_signature"), scratch(spark, "index")).probe(cls).count() == 0


def test_a_probe_reads_what_its_batch_hits(spark, monkeypatch):
    """Directories a probe reads are bounded by the batch's keys and hits, not by the history."""
    monkeypatch.setattr(H, "FEW", 1)
    rng = random.Random(4)
    rows = [(i, f"s{i}", "HA", X.signature([rng.getrandbits(64) for _ in range(64)]), 0.1, "v", 1, "", "") for i in range(400)]
    idx = H.SignatureIndex.create(spark.createDataFrame(rows, X.SCHEMA).select("segment_name", "kmer_signature"), scratch(spark, "index"), per_bucket=20)
    read = []
    every, all_blocks = idx.postings, idx.signatures
    idx.postings = lambda buckets: read.append(len(buckets)) or every(buckets)
    idx.signatures = lambda blocks: read.append(len(blocks)) or all_blocks(blocks)
    hit = idx.probe(S.classes(spark.createDataFrame(rows[:1], X.SCHEMA))).collect()
    assert len(hit) == 1 and hit[0]["equal"] == 64 and idx.buckets == 200 and read[0] <= 10 and read[1] == 1


def test_similarity_clusters(df, empty):
    links = [((s, a), (s, b)) for (s, a, b), v in AGREE.items() if v >= 0.25]
    comp = groups(links, X.records(ROWS))
    d = {}
    for r in ROWS:
        if r[4] is not None and 0 <= r[4] <= 1:
            d[(r[2], r[1])] = min(r[4], d.get((r[2], r[1]), 2))
    sets = {}
    for k, c in comp.items():
        sets.setdefault(c, []).append(k)
    want = {(*m, min((d[x], x[1]) for x in ms if x in d)[1] if any(x in d for x in ms) else None, len(ms)) for ms in sets.values() if len(ms) >= 3 for m in ms}
    for k in (256, 2):
        assert {(r[1], r[2], r[3], r[4]) for r in C.similarity_clusters(df, k=k).collect()} == want
    assert C.similarity_clusters(empty).count() == 0


def test_links_that_no_leader_sees_are_found(spark):
    """A chain: each record agrees with the next only, so leaders alone would cut it."""
    rng = random.Random(6)
    lanes = [[rng.getrandbits(64) for _ in range(64)]]
    for i in range(1, 29):
        v = [rng.getrandbits(64) for _ in range(64)]
        v[:17] = lanes[-1][:17] if i % 2 else v[:17]
        v[30:47] = lanes[-1][30:47] if i % 2 == 0 else v[30:47]
        lanes.append(v)
    rows = [(i, f"c{i:02d}", "M", X.signature(v), 0.5, "provisional", 1, "", "") for i, v in enumerate(lanes)]
    got = C.similarity_clusters(spark.createDataFrame(rows, X.SCHEMA), k=1).collect()
    links = [((s, a), (s, b)) for (s, a, b), v in X.agreements(rows).items() if v >= 0.25]
    comp = groups(links, X.records(rows))
    big = {}
    for k, c in comp.items():
        big.setdefault(c, []).append(k)
    assert {(r["segment_name"], r["sequence_id"]) for r in got} == {k for ks in big.values() if len(ks) >= 3 for k in ks} and got


def test_hot_tokens_lose_no_link(df):
    """With every shared token hot, classes are found by pairs of hot tokens; the clusters stay the same."""
    cls = S.classes(N.records(df))
    counts, _ = S.rarity(cls)
    blocks = C.KMeans(cls, counts, 2).assign()
    for hot in (1, 3, 1000):
        comp = {r["node"]: r["component"] for r in C.linked_components(cls, blocks, 0.25, hot).collect()}
        sets = {}
        for k, c in comp.items():
            sets.setdefault(c, set()).add(k)
        if hot == 1:
            first = sets
        assert sets == first
    tok, none = C.token_rows(cls), cls.selectExpr("cid", "n", "cid as component")
    want = {frozenset((r["a"], r["b"])) for r in C.cross_links(cls, tok, none, 0.25, 1000).collect()}
    assert want and {frozenset((r["a"], r["b"])) for r in C.cross_links(cls, tok, none, 0.25, 1).collect()} == want


def test_one_large_cluster_and_singles_with_a_common_token(spark):
    """A third of all rows in one cluster, and singles that share one token only: no link is made up, none is lost."""
    rng = random.Random(7)
    centre = [rng.getrandbits(64) for _ in range(64)]
    rows = []
    for i in range(2000):
        v = [x if rng.random() < 0.7 else rng.getrandbits(64) for x in centre]
        rows.append((i, f"c{i:05d}", "HA", X.signature(v), rng.random(), "provisional", 1, "", ""))
    for i in range(4000):
        v = [77, *(rng.getrandbits(64) for _ in range(63))]
        rows.append((9000 + i, f"s{i:05d}", "HA", X.signature(v), 0.5, "provisional", 1, "", ""))
    got = C.similarity_clusters(spark.createDataFrame(rows, X.SCHEMA)).collect()
    assert {r["sequence_id"] for r in got} == {r[1] for r in rows[:2000]} and {r["size"] for r in got} == {2000}
    best = min(rows[:2000], key=lambda r: (r[4], r[1]))[1]
    assert {r["typical_id"] for r in got} == {best}
    lanes = {r[1]: v for r, (_, v) in zip(rows[:2000], (X.records([r])[("HA", r[1])] for r in rows[:2000]))}
    share = Counter(x for v in lanes.values() for x in enumerate(v))
    assert all(r["fit"] == pytest.approx(sum(share[x] for x in enumerate(lanes[r["sequence_id"]])) / (64 * 2000)) for r in got)
