import math
import random
from pathlib import Path

import pytest

from octoseg.llm import mixing as M
from octoseg.llm import splitting as P
from octoseg.llm import tokenizer as T

pytestmark = pytest.mark.skipif(not Path(T.TOKENIZERS, T.DEFAULT_FILE).exists(), reason="the public vocabularies are not here")
DOC = "doc_id long, text string, source string, ids string, tokens string, piece string"


@pytest.fixture(scope="module")
def oracle():
    import tiktoken

    return tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=dict(T.vocabulary()), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return T.Encoder(T.PerfectHash(T.vocabulary()))


def texts():
    rng = random.Random(1)
    words = ["sample", "medoid", "C7", "it's", "Straße", "naïve", "HA.3.0001", "日本", "🙂", "x" * 70, "3.14", " "]
    gaps = [" ", " ", "  ", "\n", "\n\n", "\t", ". ", "! ", ", "]
    out = [None, "", " ", "\n\n\n", "a", "ACGT" * 3000, "日本語" * 900, "word " * 2000, "x\r\ny z", "<|endoftext|>"]
    out += ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.choice([3, 50, 400, 1500]))) for _ in range(40)]
    out += ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(0xA0, 0x3000), 0x1F600 + rng.randrange(60), 32, 10])) for _ in range(200)) for _ in range(30)]
    return out


def frame(spark, ts, sources=(None,)):
    return spark.createDataFrame([(i, t, sources[i % len(sources)], "own", "own", "own") for i, t in enumerate(ts)], DOC)


def test_perfect_hash(encoder):
    v = T.vocabulary()
    assert sorted(encoder.table.ranks) == sorted(r for _, r in v) and all(encoder.table.get(k) == r for k, r in v)
    assert encoder.table.get(b"no such token at all") == -1 and T.PerfectHash([]).get(b"x") == -1


def test_ids(spark, oracle):
    ts = texts()
    got = {r["doc_id"]: r["ids"] for r in T.encode_texts(frame(spark, ts)).collect()}
    assert got == {i: oracle.encode_ordinary(t) if t else [] for i, t in enumerate(ts)}
    assert T.encode_texts(frame(spark, [])).count() == 0
    n = {r["doc_id"]: r["tokens"] for r in T.token_counts(frame(spark, ts), ["doc_id"]).collect()}
    assert n == {i: len(v) for i, v in got.items()}


def test_small_cache_changes_nothing(encoder, oracle):
    e = T.Encoder(encoder.table, keep=3)
    assert all(e.encode(t) == oracle.encode_ordinary(t) for t in texts() if t)


@pytest.mark.parametrize(("most", "overlap"), [(512, 64), (40, 8), (20, 0)])
def test_pieces(encoder, oracle, most, overlap):
    a = P.Atoms(encoder)
    for t in texts():
        ps = P.split_text(a, t, most, overlap, most // 4)
        assert "".join(t[b:e] for _, b, e, _ in ps) == (t or "")
        assert (len(ps) > 1) == (bool(t) and len(oracle.encode_ordinary(t)) > most)
        for i, (s, b, e, n) in enumerate(ps):
            assert n == len(oracle.encode_ordinary(t[s:e])) <= most
            assert s == b == 0 if i == 0 else ps[i - 1][0] <= s <= b == ps[i - 1][2] and len(oracle.encode_ordinary(t[s:b])) <= overlap


def test_cuts_are_natural_and_stay_after_an_edit(encoder):
    a, rng = P.Atoms(encoder), random.Random(4)
    para = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "epsilon"]) + str(rng.randrange(99)) for _ in range(30)) + ".\n\n" for _ in range(80)]
    t = "".join(para)
    ps = P.split_text(a, t)
    assert all(t[:e].endswith("\n\n") for *_, e, _ in ps)
    u = "".join([*para[:20], "A new sentence is put in here.\n\n", *para[20:]])
    old, new = {t[b:e] for _, b, e, _ in ps}, {u[b:e] for _, b, e, _ in P.split_text(a, u)}
    assert len(old - new) <= 4


def test_split_table(spark):
    ts = texts()
    got = P.split_texts(frame(spark, ts)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by.keys() == {i for i, t in enumerate(ts) if t}
    assert all([r["piece"] for r in rs] == list(range(rs[0]["pieces"])) and all(r["text"] == ts[i][r["start"] : r["end"]] for r in rs) for i, rs in by.items())
    assert P.split_texts(frame(spark, [])).count() == 0


def test_mixture(spark, oracle):
    rng = random.Random(5)
    ts = [None, ""] + [("word " * rng.choice([1, 5, 20, 60])) for _ in range(1200)]
    src = ["a"] * 8 + ["b"] * 3 + ["c", None, "elsewhere"]
    docs = frame(spark, ts, src)
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.4, 5), ("c", 0.2, 2), ("none", 0.1, 9), ("a", 0.3, 2), ("zero", 0.0, None)], "source string, target_share double, max_repeats int")
    copies, report = M.mix(docs, targets)
    rows, rep = copies.collect(), {r["source"]: r for r in report.collect()}
    size = {i: len(oracle.encode_ordinary(t)) if t else 0 for i, t in enumerate(ts)}
    total = sum(size[i] for i in size if src[i % len(src)] is not None)
    cap = {"a": 2, "b": 5, "c": 2}
    assert all(r["copies"] <= cap[r["source"]] and r["tokens"] == size[r["doc_id"]] for r in rows)
    assert {s for s, r in rep.items() if r["full"] and r["used"] < r["goal"]} == {"c", "none"}
    assert {s: r["full"] for s, r in rep.items()} == {"a": False, "b": False, "c": True, "none": True, "zero": True}
    for s in ("a", "b"):
        assert rep[s]["used"] == pytest.approx(rep[s]["target_share"] * total, abs=130)
        mine = [r for r in rows if r["source"] == s and r["tokens"]]
        lam = [math.log(r["rate"]) / r["tokens"] for r in mine if r["rate"] < cap[s] - 1e-9]
        assert max(lam) - min(lam) < 1e-6  # one exponential tilt a source
    assert rep["c"]["used"] == 2 * rep["c"]["available"] and rep["none"]["used"] == 0
    assert sum(r["actual_share"] for r in rep.values()) == pytest.approx(1)
    c, r = M.mix(docs.limit(0), targets)
    assert c.count() == 0 and r.count() == 5
