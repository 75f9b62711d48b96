import math
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from octoseg.llm import cooccurrence as C
from octoseg.llm import quantiles as Q


def test_pairs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(120):
        parts = [rng.choice(["?", "-", "", f"ha.3.000{rng.randrange(3)}", f" NA.1.000{rng.randrange(4)} ", "M.1.0001"]) for _ in range(rng.randrange(0, 6))]
        rows.append((f"i{i % 70}" if i else None, " | ".join(parts) if i % 9 else None, ".".join(rng.choice(["C1", "c2", "?", "-", " C3"]) for _ in range(8)) if i % 7 else "", "own", 1))
    df = spark.createDataFrame(rows + rows[:20], "sequence_id string, allele_profile string, genotype_profile string, field string, n int")
    seg = ["PB2", "PB1", "PA", "HA", "NP", "NA", "M", "NS"]
    sets = {"allele_profile": {}, "genotype_profile": {}}
    for s, a, g, *_ in rows:
        if s is None:
            continue
        x = {p.strip().upper() for p in (a or "").split("|")} - {"", "?", "-"}
        y = {f"{k}:{p.strip().upper()}" for k, p in zip(seg, (g or "").split(".")) if p.strip() not in ("", "?", "-")}
        sets["allele_profile"].setdefault(s, set()).update(x)
        sets["genotype_profile"].setdefault(s, set()).update(y)
    want = {}
    for f, b in sets.items():
        one, two = Counter(i for s in b.values() for i in s), Counter(p for s in b.values() for p in combinations(sorted(s), 2))
        n = sum(1 for s in b.values() if s)
        want |= {(f, *p): (k, one[p[0]], one[p[1]], n) for p, k in two.items()}
    for least in (1, 5):
        got = {(r["field"], r["item_a"], r["item_b"]): r for r in C.genotype_pairs(df, least).collect()}
        assert {k: (r["n_ab"], r["n_a"], r["n_b"], r["n"]) for k, r in got.items()} == {k: v for k, v in want.items() if v[0] >= least}
        assert all(r["pmi"] == pytest.approx(math.log2(r["n_ab"] * r["n"] / (r["n_a"] * r["n_b"]))) for r in got.values())
    items = C.basket_items(df, "sequence_id", {"allele_profile": C.allele_items(), "genotype_profile": C.cluster_items()})
    a, b = ({tuple(r) for r in C.pair_counts(items, 2, wide).collect()} for wide in (256, 3))
    assert a == b and a
    assert C.genotype_pairs(df.limit(0)).count() == 0


def frame(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    g = rng.integers(0, 3, n)
    v = np.where(g == 0, rng.normal(size=n), np.where(g == 1, rng.integers(0, 5, n), rng.lognormal(size=n)))
    rows = [(i, None if k == 2 else f"g{k}", float(x), "own", 1) for i, (k, x) in enumerate(zip(g, v))]
    rows += [(n, "g0", None, "own", 1), (n + 1, "g0", float("nan"), "own", 1), (n + 2, "one", 7.0, "own", 1)]
    return rows, spark.createDataFrame(rows, "id long, grp string, v double, value string, n int")


def groups(rows):
    out = {}
    for _, g, v, *_ in rows:
        if v is not None and v == v:
            out.setdefault(g, []).append(v)
    return out


def test_summaries_keep_their_error(spark):
    rows, df = frame(spark, 30_000)
    s = Q.quantile_summaries(df.repartition(13), ["grp"], "v", 0.01)
    by = groups(rows)
    got = {}
    for r in s.collect():
        got.setdefault(r["grp"], []).append(r)
    assert got.keys() == by.keys()
    for g, rs in got.items():
        x = np.sort(by[g])
        assert len(rs) <= 220 and rs[0]["n"] == len(x) and rs[0]["err"] <= 0.05 * len(x)
        for r in rs:
            assert r["lt_lo"] <= np.searchsorted(x, r["value"], "left") <= r["lt_hi"]
            assert r["le_lo"] <= np.searchsorted(x, r["value"], "right") <= r["le_hi"]


def test_merged_days_are_like_one(spark):
    rows, df = frame(spark, 9_000)
    days = [Q.quantile_summaries(df.where(F.col("id") % 3 == i), ["grp"], "v", 0.01) for i in range(3)]
    m = Q.merge_summaries(*days, group=["grp"], eps=0.01)
    for r in Q.approximate_percentiles(m, ["grp"], [0.0, 0.5, 0.9, 1.0]).collect():
        x = np.sort(groups(rows)[r["grp"]])
        low, high = np.searchsorted(x, r["value"], "left"), np.searchsorted(x, r["value"], "right") - 1
        assert r["n"] == len(x) and low - r["err"] - 1 <= r["p"] * (len(x) - 1) <= high + r["err"] + 1


def test_exact_percentiles(spark):
    rows, df = frame(spark, 5_000, 3)
    for p in (0.0, 0.37, 0.5, 0.9, 1.0):
        got = {r["grp"]: (r["n"], r["q"]) for r in Q.exact_percentile(df, ["grp"], "v", p, 0.02).collect()}
        assert got.keys() == groups(rows).keys()
        assert all(k[0] == len(groups(rows)[g]) and k[1] == pytest.approx(np.percentile(groups(rows)[g], 100 * p)) for g, k in got.items())
    assert Q.exact_percentile(df.limit(0), ["grp"], "v", 0.5).count() == 0


def test_narrowed_percentiles(spark):
    """Bounds that hold too much are narrowed again and again; ties that can't be narrowed are one row."""
    rows, df = frame(spark, 4_000, 4)
    for p, most in ((0.5, 20), (0.9, 3), (0.123, 0)):
        got = {r["grp"]: (r["n"], r["q"]) for r in Q.exact_percentile(df, ["grp"], "v", p, 0.1, most).collect()}
        assert got.keys() == groups(rows).keys()
        assert all(k[0] == len(groups(rows)[g]) and k[1] == pytest.approx(np.percentile(groups(rows)[g], 100 * p)) for g, k in got.items())
