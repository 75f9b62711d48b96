import math
import random
from fractions import Fraction
from statistics import NormalDist

import numpy as np
import pytest
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.functions import stats as T
from octoseg.operators import clustering as K
from octoseg.operators import isolates as I
from octoseg.operators import minhash as M
from octoseg.operators import reassortment as R
from octoseg.sources.fasta import parse_fasta, parse_fasta_string

HEADERS = [
    ("isoA00_segment_4_H3N2_2024-01-05", "HA", "H3N2", "2024-01-05", "isoA00_H3N2_2024-01-05"),
    ("A/x/1/2024|PB2|H1N1pdm09|2024/02/03", "PB2", "H1N1pdm09", "2024-02-03", "A/x/1/2024"),
    ("A/PA/12|HA|H3N2", "PA", "H3N2", None, "A/PA/12"),
    ("sample neuraminidase H1N1", "NA", "H1N1pdm09", None, "sample neuraminidase H1N1"),
    ("|HA|H3N2", "HA", "H3N2", None, "unknown_527e3504"),
    ("nothing here", None, None, None, "nothing here"),
]


def test_headers(spark):
    df = spark.createDataFrame([(h,) for h, *_ in HEADERS], "header string")
    got = df.select("header", Q.identify_segment("header"), Q.identify_subtype("header"), Q.extract_collection_date("header"), Q.isolate_id("header")).collect()
    assert [tuple(r) for r in got] == HEADERS


def test_subtype_numbers(spark):
    df = spark.createDataFrame([("H1N1pdm09",), ("H3N2",), ("H5N6",)], "s string")
    assert [tuple(r) for r in df.select(Q.subtype_number("s"), Q.subtype_short("s")).collect()] == [(1, "H1N1"), (3, "H3N2"), (5, "H5N6")]
    with pytest.raises(Exception, match="no number for subtype"):
        spark.createDataFrame([("x",)], "s string").select(Q.subtype_number("s")).collect()
    a = spark.createDataFrame([("HA.3.0001",), ("odd",), (None,), ("ha.3.1",), ("HA.3.x",), (".3.1",), ("PB2.12.0004",), ("HA.3.1.2",)], "a string").select(Q.allele_subtype_number("a")).collect()
    assert [r[0] for r in a] == [3, None, None, None, None, None, 12, None]


def test_sequences(spark):
    df = spark.createDataFrame([("acgu ACG\n",), ("",), (None,), ("ACGTX",), ("N" * 900,), ("ACGT" * 240,)], "s string").select(Q.clean_sequence("s").alias("s"))
    got = df.select("s", Q.is_valid_sequence("s").alias("v"), Q.sequence_notes("s", F.lit("M")).alias("n")).collect()
    assert got[0]["s"] == "ACGTACG" and got[0]["n"] == ["Very short (7 bp, expected 900-1050)"]
    assert [r["v"] for r in got] == [True, False, False, False, False, True]
    assert got[1]["n"] == got[2]["n"] == ["Empty sequence"] and got[3]["n"][0] == "Invalid characters: X"
    assert got[4]["n"] == ["High ambiguity: 100.0%", "Excessive ambiguity"] and got[5]["n"] == []


def test_fasta(spark, tmp_path):
    text = "junk\n  >one x \nAC\n\n gt \n>two\n>three\r\nA\n"
    want = [(0, "one x", "ACgt"), (1, "two", ""), (2, "three", "A")]
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "no header")], "i int, t string")
    assert [tuple(r)[1:] for r in parse_fasta_string(df, "t", "i").orderBy("i", "pos").collect()] == want
    (tmp_path / "a.fa").write_text(text)
    plain = lambda path: [(r["header"], r["seq"]) for r in parse_fasta(spark, str(path)).orderBy("file", "pos").collect()]
    assert plain(tmp_path) == [x[1:] for x in want]
    # a file of many splits: pieces begin at headers, whatever the size of a split, and blanks before a header don't count
    big = "no record\n" + "".join(f"{' ' * (i % 3)}>h{i}\nAC\nGT\n" for i in range(400))
    (tmp_path / "b.fa").write_text(big)
    for size in ("100", "3000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert plain(tmp_path / "b.fa") == [(f"h{i}", "ACGT") for i in range(400)]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
    (tmp_path / "c.fa").write_text("")
    assert plain(tmp_path / "c.fa") == []
    with pytest.raises(FileNotFoundError):
        parse_fasta(spark, str(tmp_path / "none"))
    iso, seg = I.process_file(spark, str(tmp_path / "a.fa"))
    assert iso.count() == seg.count() == 0
    iso, seg = I.process_string(spark.createDataFrame([(1, ">x|HA|H3N2\nAC\n>x|NA|H3N2\nGG")], "i int, t string"), "t", "i")
    assert [r["segments_found"] for r in iso.collect()] == [2] and {r["seq"] for r in seg.collect()} == {"AC", "GG"}


def test_keep_first(spark):
    raw = spark.createDataFrame([(2, "a|HA|H1N1", "AC"), (1, "a|HA|H3N2|2024-01-01", "GG"), (3, "a|NA", "TT"), (4, "none", "A")], "pos int, header string, seq string")
    iso, seg = I.process_records(raw)
    r = iso.collect()
    assert [(x["sequence_id"], x["subtype"], x["collection_date"], x["segments_found"], x["source_headers"]) for x in r] == [("a", "H3N2", "2024-01-01", 2, ["a|HA|H3N2|2024-01-01", "a|HA|H1N1", "a|NA"])]
    assert {(x["segment"], x["seq"]) for x in seg.collect()} == {("HA", "GG"), ("NA", "TT")}
    n = {(x["kind"], x["name"]): x["n"] for x in I.processing_summary(iso, seg).collect()}
    assert n[("segment", "PB2")] == 0 and n[("segment", "HA")] == 1 and n[("total", "total_isolates")] == 1


def revcomp(s):
    return s.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def test_kmers_and_signatures(spark):
    rng = random.Random(3)
    seqs = ["".join(rng.choice("ACGTN" if i % 3 == 0 else "ACGT") for _ in range(n)) for i, n in enumerate((0, 5, 21, 600, 700, 1300))] + [None]
    df = spark.createDataFrame(list(enumerate(seqs)), "i int, s string")
    want = {i: [min(k, revcomp(k)) for k in (s[j : j + 21] for j in range(len(s) - 20)) if "N" not in k] for i, s in enumerate(seqs) if s}
    got = {r["i"]: r["k"] for r in df.select("i", Q.kmers("s", 21).alias("k")).collect()}
    assert all(got[i] == want[i] for i in want)
    c = {r["i"]: (r["total"], r["distinct_kmers"]) for r in M.kmer_counts(df, ["i"], "s", [21]).collect()}
    assert all(c[i] == (len(want.get(i, [])), len(set(want.get(i, [])))) for i in c)
    h1, h2 = M.murmur3_x64_128(np.frombuffer(M.GOLDEN[0], np.uint8)[None, :], 42)
    assert (int(h1[0]), int(h2[0])) == M.GOLDEN[2:]
    cfg = C.Sketch(lanes=16)
    s = M.from_bytes(M.signature_bytes(seqs[4], 21, cfg))
    km = np.array([list(k.encode()) for k in sorted(set(want[4]))], dtype=np.uint8)
    a, b = M.murmur3_x64_128(km, 42)
    lanes = [min((int(x) + i * int(y)) % 2**64 for x, y in zip(a, b)) for i in range(16)]
    assert s["lanes"].tolist() == lanes and (s["kmer_count"], s["unique_kmer_count"]) == (680, len(km))


def test_signature_terms():
    x, y = M.signature_bytes("ACGT" * 200, 21, C.Sketch()), M.signature_bytes("ACGT" * 200, 21, C.Sketch(seed=7))
    p = M.from_bytes(x)
    assert M.jaccard(x, x) == 1.0 and (p["kmer_count"], p["unique_kmer_count"]) == (780, 2)
    assert M.to_bytes(p["num_hashes"], p["seed"], 780, 2, p["lanes"]) == x
    for other in (y, M.signature_bytes("ACGT" * 200, 21, C.Sketch(lanes=256))):
        with pytest.raises(ValueError):
            M.jaccard(x, other)
    e = M.signature_bytes("", 21, C.Sketch())
    assert M.from_bytes(e)["unique_kmer_count"] == 0 and M.jaccard(e, e) == 1.0


def test_union_of_signatures(spark):
    cfg, rng = C.Sketch(lanes=8), random.Random(5)
    a, b = ("".join(rng.choice("ACGT") for _ in range(100)) for _ in range(2))
    sig = [M.signature_bytes(s, 21, cfg) for s in (a, b, a + "N" + b)]
    df = spark.createDataFrame([("g", bytearray(sig[0])), ("g", bytearray(sig[1])), ("g", None)], "g string, kmer_signature binary")
    got = [int(r["value"]) for r in M.merge_signatures(df, ["g"]).orderBy("lane").collect()]
    assert got == M.from_bytes(sig[2])["lanes"].tolist()


def test_shared_kmer_pairs(spark):
    rng = random.Random(9)
    base = "".join(rng.choice("ACGT") for _ in range(120))
    rows = [(f"r{i:02d}", base[: 60 + 3 * i] + "".join(rng.choice("ACGT") for _ in range(30))) for i in range(12)] + [("e", ""), ("n", None)]
    sets = {k: {min(x, revcomp(x)) for x in (s[j : j + 15] for j in range(len(s) - 14))} for k, s in rows if s}
    want = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    df = spark.createDataFrame(rows, "id string, s string")
    for most in (1000, 3):  # the second with hot k-mers
        got = {(r["a"], r["b"]): r["jaccard"] for r in M.shared_kmer_pairs(df, "id", "s", 15, most=most).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def lane_rows(n, seed=1, lanes=16):
    rng = random.Random(seed)
    out = []
    centre = [[f"{rng.getrandbits(64):016X}" for _ in range(lanes)] for _ in range(3)]
    for i in range(n):
        v = list(centre[i % 3])
        for j in rng.sample(range(lanes), rng.choice([0, 1, 2, 3, 8])):
            v[j] = f"{rng.getrandbits(64):016X}"
        out.append(("H3N2", "HA", f"s{i:03d}", v))
    return out


def test_edges_components_and_clusters(spark):
    rows = lane_rows(45)
    df = spark.createDataFrame(rows, "subtype string, segment string, sequence_id string, lanes array<string>")
    g = ["subtype", "segment"]
    eq = lambda a, b: sum(x == y for x, y in zip(a, b)) / 16
    for hot in (200, 3):
        e = K.similarity_edges(df.withColumn("threshold", F.lit(0.75)), g, "threshold", hot=hot)
        comp = {r["sequence_id"]: r["component"] for r in K.components(df, e, g).collect()}
        par = {r[2]: r[2] for r in rows}

        def root(x):
            while par[x] != x:
                x = par[x]
            return x

        for i, a in enumerate(rows):
            for b in rows[:i]:
                if eq(a[3], b[3]) >= 0.75:
                    x, y = sorted((root(a[2]), root(b[2])))
                    par[y] = x
        assert comp == {k: root(k) for k in par}
    brute = {(r["a"], r["b"]): r["dist"] for r in K.brute_edges(df, g).collect()}
    assert len(brute) == 45 * 44 // 2
    dist = np.array([[1 - eq(a[3], b[3]) for b in rows] for a in rows])
    for method in ("average", "complete", "single", "ward"):
        cfg = C.Grouping(same={"HA": 0.75}, shift={}, least=2, linkage=method)
        _, a = K.cluster_signatures(df, cfg)
        got = {}
        for r in a.where("cluster_id is not null").collect():
            got.setdefault(r["cluster_id"], set()).add(r["sequence_id"])
        lab = K.linkage(dist, method, 0.25 + 1e-9)
        want = [{rows[i][2] for i in np.flatnonzero(lab == x)} for x in np.unique(lab)]
        assert sorted(map(sorted, got.values())) == sorted(sorted(w) for w in want if len(w) > 1)


def greedy(diff, w, method, cut):
    """Founders of clusters by the terms of linkage(): each time the closest pair in exact fractions, the first on ties."""
    of = {i: [i] for i in range(len(w))}
    total = lambda x, y: sum(int(w[a] * w[b]) * int(diff[a, b]) ** (2 if method == "ward" else 1) for a in x for b in y)

    def height(x, y):
        if method == "complete":
            return Fraction(max(int(diff[a, b]) for a in x for b in y), 16)
        nx, ny = int(w[x].sum()), int(w[y].sum())
        if method == "average":
            return Fraction(total(x, y), 16 * nx * ny)
        return Fraction(2 * nx * ny, nx + ny) * (Fraction(total(x, y), nx * ny) - Fraction(total(x, x), 2 * nx * nx) - Fraction(total(y, y), 2 * ny * ny)) / 256

    h = {(i, j): height([i], [j]) for i in of for j in of if i < j}
    while h:
        d, i, j = min((d, *k) for k, d in h.items())
        if (math.sqrt(d) if method == "ward" else d) > cut:
            break
        of[i] += of.pop(j)
        h = {k: v for k, v in h.items() if not {i, j} & {*k}} | {(min(i, k), max(i, k)): height(of[i], of[k]) for k in of if k != i}
    return [next(i for i, x in of.items() if a in x) for a in range(len(w))]


@pytest.mark.parametrize("method", ["average", "complete", "ward"])
def test_linkage_by_rows(method):
    rng = np.random.default_rng(5)
    for n, weights in ((2, 1), (25, 1), (30, 4), (30, 4)):
        codes = np.where(rng.random((16, n)) < 0.25, rng.integers(3, 99, (16, n)), rng.integers(0, 3, n)[None, :])
        codes = np.unique(codes, axis=1)
        w = rng.integers(1, weights + 1, codes.shape[1])
        codes = np.stack([np.unique(x, return_inverse=True)[1] for x in codes])
        diff = (codes[:, :, None] != codes[:, None, :]).sum(axis=0)
        for cut in (0.2, 0.4, 0.6):
            want = greedy(diff, w, method, cut + 1e-9)
            for cache in (1 << 20, 0):
                assert list(K.linkage_by_rows(codes, w, method, cut + 1e-9, cache)) == want


@pytest.mark.parametrize("method", ["average", "single", "ward"])
def test_many_copies_and_classes(spark, method):
    """More copies of one signature than a matrix has room for, beside the rows of a small cluster."""
    lanes = [f"{i:016X}" for i in range(16)]
    n = 20_500
    df = spark.range(n).select(F.lit("H3N2").alias("subtype"), F.lit("HA").alias("segment"), F.format_string("c%06d", "id").alias("sequence_id"), F.array(*map(F.lit, lanes)).alias("lanes"))
    near = [("H3N2", "HA", f"d{i}", [f"{i + 100:016X}", *lanes[1:]]) for i in range(3)]
    far = [("H3N2", "HA", f"e{i}", [f"{j + 500:016X}" for j in range(16)]) for i in range(2)] + [("H3N2", "HA", "f", [f"{j + 900:016X}" for j in range(16)])]
    df = df.union(spark.createDataFrame(near + far, df.schema))
    cfg = C.Grouping(same={"HA": 0.9}, shift={}, least=2, linkage=method)
    c, a = K.cluster_signatures(df, cfg)
    got = {r["cluster_id"]: (r["medoid"], r["size"]) for r in c.collect()}
    assert a.count() == n + 6 and [r[0] for r in a.where("is_orphan").select("sequence_id").collect()] == ["f"]
    assert c.where("cluster_id = 'C1'").first()["centroid"] == lanes
    if method == "ward":  # the three are nearer to each other than their union to the weight of the copies
        assert got == {"C1": ("c000000", n), "C2": ("d0", 3), "C3": ("e0", 2)}
        return
    assert got == {"C1": ("c000000", n + 3), "C2": ("e0", 2)}
    pairs = 2 * 3 * n + 6  # ordered pairs with one differing lane
    assert c.where("cluster_id = 'C1'").first()["mean_diameter"] == pytest.approx(pairs / 16 / (n + 3) ** 2)
    assert a.where("sequence_id = 'd1'").first()["distance"] == pytest.approx(1 / 16)


def test_records_of_all_versions_and_parameters(spark, tmp_path):
    from octoseg.plans import queries as P

    sig = lambda n, seed: M.to_bytes(n, seed, 500, 400, np.arange(n))
    rows = [("a", 64, 42, "v1"), ("b", 64, 42, "v2"), ("c", 64, 7, "v1"), ("d", 64, 7, "v2"), ("e", 128, 42, "v1"), ("f", 128, 42, "v2"), ("a", 64, 42, "v2"), ("g", 64, 9, "v2")]
    kmers = [(i, x, "HA", sig(n, seed), v, "2024", None, 0) for i, (x, n, seed, v) in enumerate(rows)]
    spark.createDataFrame(kmers, "id long, sequence_id string, segment_name string, kmer_signature binary, cluster_version string, created_at string, cluster_id string, is_orphan int").write.parquet(str(tmp_path / "segment_kmers.parquet"))
    spark.createDataFrame([(x, "H3N2", None, "processed", "2024-01-01") for x in "abcdefg"], "sequence_id string, subtype string, metadata_json string, status string, collection_date string").write.parquet(str(tmp_path / "sequences.parquet"))
    assert sorted((r["cluster_id"], r["medoid"], r["size"]) for r in P.cluster_average(spark, str(tmp_path)).collect()) == [("C1", "a", 2), ("C2", "c", 2), ("C3", "e", 2)]
    assert [tuple(r) for r in P.cluster_orphans(spark, str(tmp_path)).select("sequence_id", "nearest_cluster").collect()] == [("g", None)]
    keys = spark.createDataFrame([(x, "k") for x in "abcdefg"], "sequence_id string, key string")
    got = R.mate_sums(keys, P.records(spark, str(tmp_path)).drop("subtype", "kmer_signature")).collect()
    assert sorted((r["sequence_id"], r["n"], r["s"]) for r in got) == [*((x, 1, 0.0) for x in "abcdef"), ("g", 0, 0.0)]


def test_nearest_clusters_in_parts(spark):
    rng = np.random.default_rng(3)
    lanes = lambda n: [[f"{x:016X}" for x in r] for r in rng.integers(0, 4, (n, 8)).tolist()]
    cen = [("H3N2", s, f"v/{i}", 8, seed, x) for seed in (1, 2) for s in ("HA", "NA") for i, x in enumerate(lanes(30))]
    cen.append(("H3N2", "HA", "v/short", 4, 1, lanes(1)[0][:4]))
    rows = [(("H3N2", None)[i % 9 == 0], ("HA", "NA", "M")[i % 3], f"s{i}", 8, 1 + i % 2, x) for i, x in enumerate(lanes(200))]
    df = spark.createDataFrame(rows, "subtype string, segment string, sequence_id string, num_hashes int, seed int, lanes array<string>")
    known = spark.createDataFrame(cen, "subtype string, segment string, cluster_id string, num_hashes int, seed int, centroid array<string>")

    def want(r):
        d = [(1 - sum(x == y for x, y in zip(r[5], c[5])) / 8, c[2]) for c in cen if (*c[:2], *c[3:5]) == (*r[:2], *r[3:5])]
        return min(d)[::-1] if d else (None, None)

    for limit in (16 << 20, 2000):  # in one part, and in several
        got = K.nearest_clusters(df, known, limit)
        assert {r[2]: (r[3], r[4]) for r in got.collect()} == {r[2]: want(r) for r in rows}
    plan = K.nearest_clusters(df, known)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Sort", "Join"))


def test_clustering_terms(spark):
    bad = spark.createDataFrame([("a", None), ("a", None)], "sequence_id string, kmer_signature binary")
    with pytest.raises(K.InputValidationError, match="repeated"):
        K.validate_inputs(bad)
    with pytest.raises(K.DegenerateInputError):
        K.cluster_signatures(spark.createDataFrame([], "subtype string, segment string, sequence_id string, lanes array<string>"))
    t = K.with_threshold(spark.createDataFrame([("HA", "H3N2"), ("HA", "H1N1pdm09"), ("X", "H3N2"), ("M", None)], "segment string, subtype string"))
    assert {(r[0], r[1]): round(r[2], 9) for r in t.collect()} == {("HA", "H3N2"): 0.9, ("HA", "H1N1pdm09"): 0.92, ("X", "H3N2"): 0.93, ("M", None): 0.96}
    t = K.with_threshold(spark.createDataFrame([("HA", "H1N1pdm09")], "segment string, subtype string"), level="related")
    assert t.first()["threshold"] == pytest.approx(0.8)


def test_statistics(spark):
    df = spark.createDataFrame([(2, 8, 10, 5), (0, 0, 3, 4), (3, 0, 4, 0), (500, 20, 30, 9000)], "a long, b long, c long, d long")
    p = [r[0] for r in df.select(T.fisher_less(*(F.col(c) for c in "abcd"))).collect()]
    assert p[0] == pytest.approx(0.028698344326, abs=1e-9) and p[1:3] == [1.0, 1.0] and p[3] == pytest.approx(1.0)
    q = T.fdr_adjust(spark.createDataFrame([(0.01,), (0.04,), (0.03,), (0.2,), (None,)], "p double"))
    got = {r["p"]: r["q"] for r in q.collect()}
    assert got[0.01] == pytest.approx(0.04) and got[0.04] == got[0.03] == pytest.approx(0.16 / 3) and got[0.2] == pytest.approx(0.2) and got[None] is None
    rng = random.Random(4)
    ps = [rng.choice([rng.random(), 0.5, rng.random() ** 6]) for _ in range(300)]
    for method in ("bh", "by"):
        c = sum(1 / i for i in range(1, 301)) if method == "by" else 1
        o = sorted(ps)
        want, low = {}, 1.0
        for r in range(300, 0, -1):
            low = min(low, o[r - 1] * 300 * c / r)
            want.setdefault(o[r - 1], low)
            want[o[r - 1]] = min(want[o[r - 1]], low)
        got = {r["p"]: r["q"] for r in T.fdr_adjust(spark.createDataFrame([(x,) for x in ps], "p double"), method=method).collect()}
        assert all(got[k] == pytest.approx(min(1.0, want[k])) for k in want)
    rows = [("a", 1e-10)] * 6 + [("b", 1e-10)] * 6 + [("b", 1.0)] + [("c", 0.3)]
    d = spark.createDataFrame(rows, "k string, p double")
    z = {r["k"]: r["p"] for r in T.combine_cauchy(d, ["k"]).collect()}
    assert z["a"] == pytest.approx(1e-10) and z["b"] == pytest.approx(1.0, abs=1e-12) and z["c"] == pytest.approx(0.3)
    s = {r["k"]: r["p"] for r in T.combine_stouffer(d.where("k <> 'b'"), ["k"]).collect()}
    assert s["c"] == pytest.approx(0.3) and s["a"] < 1e-40


def test_fisher_of_large_tables(spark):
    """Terms that matter only: exact for tables of any size, by whole-number sums where those can be made."""
    rng = random.Random(8)
    rows = [(0, 40, 60, 900), (7, 400, 300, 12_000), (180, 2000, 2100, 30_000), (5000, 100, 100, 9), (30, 10_000_000, 40, 900_000_000), (2_000_000, 10_000_000, 170_000_000, 900_000_000)]
    rows += [tuple(rng.randrange(0, 60) for _ in range(4)) for _ in range(40)]
    p = [r[0] for r in spark.createDataFrame(rows, "a long, b long, c long, d long").select(T.fisher_less(*(F.col(c) for c in "abcd"))).collect()]
    q = T.fisher_less_array(*(np.array(x) for x in zip(*((a, a + b, a + c, a + b + c + d) for a, b, c, d in rows))))
    for (a, b, c, d), x, y in zip(rows, p, q):
        if a + b + c + d < 50_000:
            n, r, k = a + b + c + d, a + b, a + c
            want = sum(Fraction(math.comb(k, i) * math.comb(n - k, r - i), math.comb(n, r)) for i in range(max(0, r + k - n), a + 1)) if 0 < r < n and 0 < k < n else 1
            assert x == pytest.approx(float(want), rel=1e-8, abs=1e-300)
        assert y == pytest.approx(x, rel=1e-6, abs=1e-300)


def test_normal_law(spark):
    ps = [1e-15, 1e-9, 0.001, 0.07, 0.2, 0.5, 0.8, 0.9999, 1.0, 0.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in ps], "p double").select(T.normal_quantile(F.col("p"))).collect()]
    want = [NormalDist().inv_cdf(min(max(x, 1e-15), 1 - 1e-15)) for x in ps]
    assert got == pytest.approx(want, abs=1e-12) and T.quantile_array(np.array(ps)) == pytest.approx(want, abs=1e-12)
    zs = [-38.0, -20.0, -8.0, -3.1, -0.5, 0.0, 0.7, 6.0, 40.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in zs], "z double").select(T.normal_cdf(F.col("z"))).collect()]
    want = [0.5 * math.erfc(-x / math.sqrt(2)) for x in zs]
    assert got == pytest.approx(want, rel=1e-7, abs=1e-290) and T.cdf_array(np.array(zs)) == pytest.approx(want, rel=1e-7, abs=1e-290)


def permuted(profiles, sid, seg, n, seed):
    """Combined p-values of an isolate's segment, its column shuffled over all profiles, the plain way."""
    rng, ids, i = np.random.default_rng(seed), list(profiles), C.SEGMENTS.index(seg)
    out, me = [], ids.index(sid)
    for _ in range(n):
        col = rng.permutation(np.array([profiles[x][i] or "" for x in ids]))
        if not col[me]:
            out.append(1.0)
            continue
        ps = []
        for j in range(8):
            c = profiles[sid][j]
            if j == i or c is None:
                continue
            rows = [(col[r], profiles[x][j]) for r, x in enumerate(ids) if col[r] and profiles[x][j] is not None]
            ab, a, b = sum(r == (col[me], c) for r in rows), sum(r[0] == col[me] for r in rows), sum(r[1] == c for r in rows)
            ps.append(float(T.fisher_less_array(np.array([ab]), np.array([a]), np.array([b]), np.array([len(rows)]))[0]))
        t = np.mean([math.tan((0.5 - min(max(p, 1e-300), 1 - 1e-15)) * math.pi) for p in ps])
        out.append(0.5 - math.atan(t) / math.pi)
    return np.array(out)


def test_permutation_validation(spark):
    """Against plain permutations of the column: the same law of the null, the population of all analysable profiles,
    and the level shared by all scored segments."""
    rng = random.Random(3)
    profiles = {}
    for i in range(60):
        lineage = i % 2
        profiles[f"p{i:02d}"] = [None if rng.random() < 0.12 else f"C{lineage * 2 + (rng.random() < 0.2)}" for _ in range(8)]
    profiles["p00"] = ["C2", *(["C0"] * 7)]
    profiles["p01"] = ["C2", "C2", "C0", "C0", None, "C2", "C2", None]
    profiles["few"] = ["C0", None, None, None, "C1", None, None, "C0"]
    rows = [(k, j, s, "ASSIGNED" if v else "MISSING", v) for k, p in profiles.items() for j, (s, v) in enumerate(zip(C.SEGMENTS, p))]
    long = spark.createDataFrame(rows, "sequence_id string, ord int, segment string, status string, cluster_id string")
    events = spark.createDataFrame([("p00", ["PB2"]), ("p01", ["PA", "HA"]), ("few", ["PB2"])], "sequence_id string, discordant_segments array<string>")
    full = {k: p for k, p in profiles.items() if sum(x is not None for x in p) >= 6}
    got = {(r["sequence_id"], r["segment"]): r for r in R.validate_events(events, long, n=4000).collect()}
    assert got.keys() == {("p00", "PB2"), ("p01", "PA"), ("p01", "HA")}
    for (sid, seg), r in got.items():
        null = permuted(full, sid, seg, 1500, 5)
        want = ((null <= r["observed"] * (1 + 1e-9)).sum() + 1) / 1501
        assert abs(r["p"] - want) < 4 * math.sqrt(max(want * (1 - want), 1e-3) * (1 / 1500 + 1 / 4000))
        tested = sum(x is not None for x in full[sid])
        assert r["n_tested"] == tested and r["significant"] == (r["p"] < 0.05 / tested)
    assert R.validate_events(events.limit(0), long).count() == 0


def test_draws_have_their_law():
    rng = np.random.default_rng(2)
    colors = np.broadcast_to(np.array([5, 0, 30, 12]), (20_000, 4))
    x = R.draw(rng, colors, np.full(20_000, 9))
    assert (x.sum(axis=1) == 9).all() and (x >= 0).all() and (x <= colors).all()
    share = colors[0] / colors[0].sum()
    assert np.abs(x.mean(axis=0) - 9 * share).max() < 0.05
    assert np.abs(x.var(axis=0) - 9 * share * (1 - share) * (47 - 9) / 46).max() < 0.08


def test_coherence_and_types(spark):
    df = spark.createDataFrame([(["PB1"],), (["PB2", "PB1", "PA"],), (["HA", "NA", "M"],), (["HA", "PB1"],), (["HA", "NA"],)], "s array<string>")
    got = [(round(r[0], 6), r[1]) for r in df.select(R.coherence(F.col("s")), R.event_type(F.col("s"))).collect()]
    assert got == [(0.866667, "surface_internal"), (1.15, "surface_internal"), (1.3225, "complex"), (0.78, "complex"), (1.15, "surface_internal")]


def test_distance_scores_by_hand(spark):
    rows = lane_rows(12, 8)
    sig = spark.createDataFrame([(r[2], "HA", r[3]) for r in rows], "sequence_id string, segment string, lanes array<string>")
    keys = sig.select("sequence_id", F.lit("k").alias("key"))
    d = {(a[2], b[2]): 1 - sum(x == y for x, y in zip(a[3], b[3])) / 16 for a in rows for b in rows if a[2] != b[2]}
    for r in R.distance_scores(keys, sig).collect():
        mine = [v for k, v in d.items() if k[0] == r["sequence_id"]]
        mates = [v for k, v in d.items() if r["sequence_id"] not in k]
        assert r["mean"] == pytest.approx(np.mean(mine)) and r["mu"] == pytest.approx(np.mean(mates)) and r["sigma"] == pytest.approx(max(0.01, np.std(mates)))
