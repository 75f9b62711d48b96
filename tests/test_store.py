import random

import pytest

from octoseg import config as C
from octoseg.operators import naming as N
from octoseg.sources import store as S
from octoseg.sources.store import Store


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "s"))


def seqs(spark, *rows):
    return spark.createDataFrame([(i, st, n) for i, st, n in rows], "sequence_id string, status string, segments_found int")


def ids(df):
    return sorted(r[0] for r in df.select("sequence_id").collect())


def test_rows_of_a_failed_block_never_show(spark, store):
    store.put("sequences", seqs(spark, ("a", "x", 1)))
    with pytest.raises(RuntimeError, match="crash"), store.bulk():
        store.put("sequences", seqs(spark, ("half", "x", 1)))
        assert ids(store.rows("sequences")) == ["a", "half"]  # the writer sees its own rows
        raise RuntimeError("crash")
    assert ids(store.rows("sequences")) == ["a"]
    store.put("sequences", seqs(spark, ("b", "x", 1)))
    assert ids(store.rows("sequences")) == ["a", "b"] == ids(Store(spark, store.path).rows("sequences"))


def test_order_of_writes_decides(spark, store):
    with store.bulk():
        store.put("sequences", seqs(spark, ("a", "first", 1), ("b", "first", 2)))
        store.put("sequences", seqs(spark, ("a", "second", None)))
        store.update("sequences", seqs(spark, ("b", "third", None), ("unknown", "x", 1)), ["status", "segments_found"])
    assert len(store.commits()) == 1
    assert {tuple(r) for r in store.rows("sequences").select("sequence_id", "status", "segments_found").collect()} == {("a", "second", None), ("b", "third", None)}
    store.update("sequences", seqs(spark, ("a", "fourth", 9)), ["status"])
    store.put_new("sequences", seqs(spark, ("a", "ignored", 5), ("c", "new", 5)))
    want = {("a", "fourth", None), ("b", "third", None), ("c", "new", 5)}
    got = lambda: {tuple(r) for r in store.rows("sequences").select("sequence_id", "status", "segments_found").collect()}
    assert got() == want
    store.compact("sequences")
    assert got() == want and store.log("sequences").count() == 3
    store.delete("sequences", seqs(spark, ("b", None, None)))
    store.update("sequences", seqs(spark, ("b", "back?", 1)), ["status"])
    assert ids(store.rows("sequences")) == ["a", "c"]
    store.put("sequences", seqs(spark, ("b", "back", 1)))
    assert ids(store.rows("sequences")) == ["a", "b", "c"]


def test_deleted_events_come_back_with_a_failed_block(spark, store):
    ev = lambda *xs: spark.createDataFrame([(x, s) for x, s in xs], "sequence_id string, stage int")
    store.put("reassortment_events", ev(("a", 0), ("a", 1), ("b", 1)))
    with pytest.raises(RuntimeError), store.bulk():
        store.delete("reassortment_events", ev(("a", 0)))
        raise RuntimeError
    assert ids(store.rows("reassortment_events")) == ["a", "a", "b"]
    with store.bulk():
        store.delete("reassortment_events", ev(("a", 0), ("none", 0)))
        store.put("reassortment_events", ev(("a", 2)))
    assert sorted(tuple(r) for r in store.rows("reassortment_events").select("sequence_id", "stage").collect()) == [("a", 2), ("b", 1)]


def test_parameters(spark, store):
    store.initialize(C.Sketch(lanes=64))
    store.initialize(C.Sketch(lanes=64))
    assert store.sketch() == C.Sketch(lanes=64)
    with pytest.raises(S.SignatureFingerprintMismatch, match="hash_seed: 42 -> 7; num_hashes: 64 -> 32"):
        store.initialize(C.Sketch(lanes=32, seed=7))
    store.initialize(C.Sketch(lanes=32), True)
    assert store.sketch().lanes == 32


def test_lookups(spark, store):
    store.put("sequences", spark.createDataFrame([("a", "H3N2", "partial"), ("b", "H3N2", "processed"), ("c", "H1N1pdm09", "partial")], "sequence_id string, subtype string, status string"))
    s = store.rows("sequences")
    assert ids(store.find("sequences", sequence_id="a")) == ["a"] and ids(store.find("sequences", segments_found=None)) == ["a", "b", "c"]
    assert ids(S.sequences_of(s, "H3N2")) == ["a", "b"] and ids(S.sequences_of(s, "H3N2", "partial")) == ["a"]
    r = spark.createDataFrame([("HA.3.0001", "HA", 3, "C1", None, 1), ("HA.3.0002", "HA", 3, "C1", "v1", 0), ("HA.1.0001", "HA", 1, "C1", "v1", 1)], "allele_name string, segment_name string, subtype_num int, internal_cluster_id string, cluster_version string, is_active int")
    store.put("allele_registry", r)
    store.put_new("allele_registry", r)
    assert store.log("allele_registry").count() == 3
    names = lambda df: sorted(x["allele_name"] for x in df.collect())
    assert names(S.alleles_of(store.rows("allele_registry"), "HA")) == ["HA.1.0001", "HA.3.0001"] and names(S.alleles_of(r, "HA", 3)) == ["HA.3.0001"]
    keys = spark.createDataFrame([("HA", 3, None, "C1"), ("HA", 3, "v1", "C1"), ("HA", 3, "v2", "C1")], "segment_name string, subtype_num int, cluster_version string, internal_cluster_id string")
    assert {(x["cluster_version"], x["allele_name"]) for x in N.allele_name_of(r, keys).collect()} == {(None, "HA.3.0001"), ("v1", "HA.3.0002"), ("v2", None)}


def one_by_one(founders, registry, least):
    """Names in order, one founder after another: (segment, subtype, version, cluster) to (name, how), and the links."""
    held, top, cache, out, links = [], {}, {}, {}, set()
    for name, seg, num, k, cid, v, lanes in registry:
        cache[(seg, num, v or "", cid)] = name
        top[(seg, num)] = max(top.get((seg, num), 0), k)
        if lanes:
            held.append((name, seg, num, lanes))

    def best(seg, lanes, ok):
        sims = [(-sum(a == b for a, b in zip(x, lanes)) / len(lanes), n) for n, s, num, x in held if s == seg and ok(num) and len(x) == len(lanes)]
        return min([s for s in sims if -s[0] >= least - 1e-12], default=(None, None))[1]

    for seg, sub, v, cid, first, late, lanes in sorted(founders, key=lambda f: (f[5], f[4], f[1], f[3])):
        num = C.SUBTYPE_NUMBERS[sub]
        key = (seg, num, v or "", cid)
        name, how = cache.get(key), "known"
        if name is None:
            name, how = best(seg, lanes, lambda n: n == num), "matched"
            if name is None:
                name, how = best(seg, lanes, lambda n: n != num), "other_subtype"
            if name is None:
                top[(seg, num)] = top.get((seg, num), 0) + 1
                name, how = f"{seg}.{num}.{top[(seg, num)]:04d}", "minted"
                held.append((name, seg, num, lanes))
            cache[key] = name
        own = int(name.split(".")[1])
        if late and own != num:
            there, here = best(seg, lanes, lambda n: n == own), best(seg, lanes, lambda n: n == num)
            if there == name and here and here != name:
                links.add(tuple(sorted((name, here))))
        out[(seg, sub, v, cid)] = (name, how)
    return out, links


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_names_are_those_of_one_by_one(spark, seed):
    rng = random.Random(seed)
    centres = [[f"{rng.getrandbits(64):016X}" for _ in range(10)] for _ in range(6)]

    def near():
        v = list(rng.choice(centres))
        for j in rng.sample(range(10), rng.choice([0, 0, 1, 2, 3, 4])):
            v[j] = f"{rng.getrandbits(64):016X}"
        return v

    registry = [(f"{s}.{n}.{k:04d}", s, n, k, f"C{k}", rng.choice([None, "v1"]), near()) for s in ("HA", "M") for n in (1, 3) for k in range(1, 4)]
    founders = [(s, sub, "v1", f"C{k}" if k < 12 else f"ORPHAN::{k}", f"i{rng.randrange(99):02d}", k >= 12, near()) for s in ("HA", "M") for sub in ("H3N2", "H1N1pdm09", "H1N1") for k in range(1, 25)]
    want, links = one_by_one(founders, registry, 0.8)
    f = spark.createDataFrame(founders, "segment string, subtype string, cluster_version string, cluster_id string, first_id string, late boolean, lanes array<string>")
    r = spark.createDataFrame(registry, "allele_name string, segment string, subtype_num int, allele_num int, internal_cluster_id string, cluster_version string, lanes array<string>")
    names, lineage = N.assign_alleles(f, r, C.Grouping(same={s: 0.8 for s in C.SEGMENTS}, shift={}))
    got = {(x["segment"], x["subtype"], x["cluster_version"], x["cluster_id"]): (x["allele_name"], x["how"]) for x in names.collect()}
    assert got == want and {h for _, h in want.values()} == {"known", "matched", "other_subtype", "minted"}
    assert {(x["allele_a"], x["allele_b"]) for x in lineage.collect()} == links
    names, lineage = N.assign_alleles(f.limit(0), r)
    assert names.count() == 0 == lineage.count()
