"""The staged screen for records whose segments don't belong together."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.functions import stats as T
from octoseg.runtime import share, stage

def is_assigned(cluster: str | Column) -> Column:
    c = F.col(cluster) if isinstance(cluster, str) else cluster
    return F.coalesce((c != "") & (c != "?"), F.lit(False))


def event_type(segments: Column) -> Column:
    """surface_internal if all are surface or all internal segments, else single_segment or complex."""
    surface = F.array(*map(F.lit, C.SURFACE))
    internal = F.array(*(F.lit(s) for s in C.SEGMENTS if s not in C.SURFACE))
    return F.when((F.size(F.array_except(segments, surface)) == 0) | (F.size(F.array_except(segments, internal)) == 0), "surface_internal").when(F.size(segments) == 1, "single_segment").otherwise("complex")


def coherence(segments: Column, screen: C.Screen | None = None) -> Column:
    """A factor for how well the segments follow the groups that go together.

    Each group counts with the segments no earlier group claimed: all of it or a single one raise the factor, a part
    lowers it by how much is missing.
    """
    screen = screen or C.Screen()
    out, claimed = F.lit(1.0), []
    for g in screen.groups:
        free = [s for s in g if s not in claimed]
        k = F.size(F.array_intersect(segments, F.array(*map(F.lit, free)))) if free else F.lit(0)
        part = F.lit(screen.penalty) + F.lit(1 - screen.penalty) * k / len(g)
        out = out * F.when(k == 0, 1.0).when((k == len(g)) | F.lit(len(g) == 1), screen.boost).otherwise(part)
        claimed += free
    return out


def clamp(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def in_order(segments: Column) -> Column:
    """An array of segments in the fixed order."""
    return F.filter(F.array(*map(F.lit, C.SEGMENTS)), lambda s: F.array_contains(segments, s))


# --- stage 0: alleles of another subtype --------------------------------------------------------------------------------


def screen_alleles(alleles: DataFrame, screen: C.Screen | None = None, lineage: DataFrame | None = None) -> DataFrame:
    """Events of isolates with alleles whose subtype number isn't the majority's; ties go to the first in segment order.

    alleles has (sequence_id, segment, ord, allele); lineage (allele_a, allele_b) adds the links of discordant alleles
    by one left join.
    """
    screen = screen or C.Screen()
    a = alleles.withColumn("num", Q.allele_subtype_number("allele")).where("num is not null")
    per = a.groupBy("sequence_id", "num").agg(F.count("*").alias("k"), F.min("ord").alias("first"))
    major = per.groupBy("sequence_id").agg(F.max_by("num", F.struct("k", -F.col("first"))).alias("majority"))
    off = a.join(major, "sequence_id").where("num <> majority")
    ev = off.groupBy("sequence_id", "majority").agg(in_order(F.collect_set("segment")).alias("discordant_segments"), F.array_sort(F.collect_list("allele")).alias("names")).where(F.size("discordant_segments") >= screen.least_segments)
    if lineage is not None:
        both = lineage.select("allele_a", "allele_b").union(lineage.select("allele_b", "allele_a")).distinct()
        links = off.join(both, off["allele"] == both["allele_a"], "left").where("allele_b is not null").groupBy("sequence_id").agg(F.array_sort(F.collect_set("allele_b")).alias("links"))
        ev = ev.join(links, "sequence_id", "left")
    else:
        ev = ev.withColumn("links", F.lit(None).cast("array<string>"))
    s = F.col("discordant_segments")
    return ev.select("sequence_id", event_type(s).alias("event_type"), F.lit(0).alias("stage"), s, clamp(coherence(s, screen)).alias("confidence"), F.to_json(F.struct("majority", "names", F.coalesce("links", F.array().cast("array<string>")).alias("links"))).alias("evidence"))


# --- stage 1: linkage disequilibrium --------------------------------------------------------------------------------------


def pair_rows(profiles: DataFrame) -> DataFrame:
    """(sequence_id, seg_a, seg_b, ca, cb) of all pairs of assigned segments of an isolate, in segment order.

    The pairs come from one array of at most eight cells, so there is one shuffle and no self join.
    """
    p = profiles.where(is_assigned("cluster_id")).groupBy("sequence_id").agg(F.array_sort(F.collect_set(F.struct("ord", "segment", "cluster_id"))).alias("s"))
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.slice(F.col("s"), i + 2, F.size("s")), lambda b: F.struct(a["segment"].alias("seg_a"), b["segment"].alias("seg_b"), a["cluster_id"].alias("ca"), b["cluster_id"].alias("cb")))))
    return p.select("sequence_id", F.explode(pairs).alias("x")).select("sequence_id", "x.*")


def pattern_counts(pairs: DataFrame) -> DataFrame:
    """(seg_a, seg_b, ca, cb, n_ab, n_a, n_b, total): combinations, and marginals over isolates with both segments."""
    ab = pairs.groupBy("seg_a", "seg_b", "ca", "cb").agg(F.count("*").alias("n_ab"))
    ab = stage(ab, "patterns")
    a = ab.groupBy("seg_a", "seg_b", "ca").agg(F.sum("n_ab").alias("n_a"))
    b = ab.groupBy("seg_a", "seg_b", "cb").agg(F.sum("n_ab").alias("n_b"))
    t = ab.groupBy("seg_a", "seg_b").agg(F.sum("n_ab").alias("total"))
    return ab.join(a, ["seg_a", "seg_b", "ca"]).join(b, ["seg_a", "seg_b", "cb"]).join(F.broadcast(t), ["seg_a", "seg_b"])  # at most 28 rows


def fisher_patterns(counts: DataFrame) -> DataFrame:
    """counts with p: the chance of so few isolates with both clusters."""
    return counts.withColumn("p", T.fisher_less(F.col("n_ab"), F.col("n_a") - F.col("n_ab"), F.col("n_b") - F.col("n_ab"), F.col("total") - F.col("n_a") - F.col("n_b") + F.col("n_ab")))


def segment_scores(profiles: DataFrame, method: str = "cauchy", population: DataFrame | None = None) -> DataFrame:
    """(sequence_id, segment, p): the combined p-value of a segment with all its assigned partners.

    Tests are made once for each combination, not for each isolate; the combinations are joined back.
    """
    pairs = stage(pair_rows(profiles), "pairs")
    counts = fisher_patterns(pattern_counts(pairs if population is None else stage(pair_rows(population), "pairs")))
    j = pairs.join(counts.select("seg_a", "seg_b", "ca", "cb", "p"), ["seg_a", "seg_b", "ca", "cb"])
    both = j.select("sequence_id", F.explode(F.array("seg_a", "seg_b")).alias("segment"), "p")
    return T.combine_stouffer(both, ["sequence_id", "segment"]) if method == "stouffer" else T.combine_cauchy(both, ["sequence_id", "segment"])


def significant(scores: DataFrame, screen: C.Screen | None = None) -> DataFrame:
    """scores with flagged: by the false discovery rate of all tests, or by each isolate's number of tests."""
    screen = screen or C.Screen()
    if screen.correction == "per_profile_bonferroni":
        n = scores.groupBy("sequence_id").agg(F.count("*").alias("_n"))
        return scores.join(n, "sequence_id").withColumn("flagged", F.col("p") < F.lit(screen.alpha) / (F.col("_n") if screen.share_alpha else F.lit(1))).drop("_n")
    q = T.fdr_adjust(scores, "p", "by" if screen.correction.endswith("by") else "bh")
    return q.withColumn("flagged", F.col("q") < screen.alpha)


def stage1_events(profiles: DataFrame, screen: C.Screen | None = None, population: DataFrame | None = None) -> DataFrame:
    """Events of isolates with flagged segments: 1 less their mean combined p, times coherence, if confident enough."""
    screen = screen or C.Screen()
    s = significant(segment_scores(profiles, screen.combine, population), screen).where("flagged")
    e = s.groupBy("sequence_id").agg(in_order(F.collect_set("segment")).alias("discordant_segments"), F.avg("p").alias("mean_p"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("segment", "p")))).alias("ps"))
    g = F.col("discordant_segments")
    e = e.where(F.size(g) >= screen.least_segments).withColumn("confidence", clamp((1 - F.col("mean_p")) * coherence(g, screen)))
    return e.where(F.col("confidence") >= screen.least_confidence).select("sequence_id", event_type(g).alias("event_type"), F.lit(1).alias("stage"), g, "confidence", F.to_json(F.struct("ps")).alias("evidence"))


# --- stage 2: distances within a constellation ------------------------------------------------------------------------------


def constellation_keys(profiles: DataFrame) -> DataFrame:
    """(sequence_id, key): the eight clusters as one text; orphans and gaps are ordinary values."""
    p = profiles.groupBy("sequence_id").agg(F.map_from_entries(F.collect_list(F.struct("segment", F.when(F.col("status") == "ORPHAN", F.lit("?")).otherwise(F.coalesce("cluster_id", F.lit("-")))))).alias("m"))
    return p.select("sequence_id", F.concat_ws(".", *(F.coalesce(F.col("m")[s], F.lit("-")) for s in C.SEGMENTS)).alias("key"))


def keyed(keys: DataFrame, signatures: DataFrame) -> DataFrame:
    """signatures with their isolate's key; parameters of the signatures, where given, are part of it, as only equal ones compare."""
    own = [c for c in ("num_hashes", "seed") if c in signatures.columns]
    r = signatures.join(keys, "sequence_id")
    return r.withColumn("key", F.concat_ws("|", "key", *own)) if own else r


def mate_sums(keys: DataFrame, signatures: DataFrame) -> DataFrame:
    """(key, segment, sequence_id, n, s): the number of mates of each record in its group, and its distances' sum.

    Lanes that a record shares with all its mates are counted from how many of them have its value in each lane, so the
    work is linear in the records and no pair is made. Mates of another number of lanes are at distance 1.
    """
    r = keyed(keys, signatures).select("key", "segment", "sequence_id", F.size("lanes").alias("m"), "lanes")
    size = r.groupBy("key", "segment").agg(F.count("*").alias("members"))
    cells = stage(r.select("key", "segment", "sequence_id", "m", F.posexplode("lanes").alias("lane", "v")), "cells")
    k = cells.groupBy("key", "segment", "m", "lane", "v").agg(F.count("*").alias("k")).where("k > 1")
    same = cells.join(k, ["key", "segment", "m", "lane", "v"]).groupBy("key", "segment", "sequence_id").agg((F.sum(F.col("k") - 1) / F.first("m")).alias("same"))
    own = r.select("key", "segment", "sequence_id").join(same, ["key", "segment", "sequence_id"], "left").join(size, ["key", "segment"])
    return own.select("key", "segment", "sequence_id", (F.col("members") - 1).alias("n"), (F.col("members") - 1 - F.coalesce("same", F.lit(0.0))).alias("s"))


def baselines(keys: DataFrame, signatures: DataFrame, most_pairs: int = 500) -> tuple[DataFrame, DataFrame]:
    """(own, group): sums over a group's baseline pairs, of those of each member and of all: n, sum, sum of squares.

    A group of at most most_pairs pairs has all of them. A larger one has most_pairs: its members in the order of the
    md5 of their id stand in a ring, each is paired with the next, then with the one after, as far as the number goes;
    a group of more than most_pairs members has as many of them as that takes. The number is the screen's own setting;
    every record is scored against the baseline.
    """
    r = keyed(keys, signatures).select("key", "segment", "sequence_id", "lanes").withColumn("h", F.md5("sequence_id"))
    size = r.groupBy("key", "segment").agg(F.count("*").alias("members"))
    r = r.join(size, ["key", "segment"])
    # what can come first by md5 is kept by the digest alone, so that no large group is sorted as one
    near = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") < F.lit(2.0**32) * 4 * (most_pairs + 1) / F.col("members")
    w = Window.partitionBy("key", "segment").orderBy("h", "sequence_id")
    r = r.where(near).withColumn("r", F.row_number().over(w) - 1).where(F.col("r") <= most_pairs).drop("h")
    r = stage(r.withColumn("m", F.count("*").over(Window.partitionBy("key", "segment"))), "baseline")
    all_pairs = F.col("m") * (F.col("m") - 1) / 2 <= most_pairs
    steps = F.when(all_pairs, F.col("m") - 1).otherwise(F.ceil(F.lit(most_pairs) / F.col("m"))).cast("int")
    ring = r.where("m > 1").select("key", "segment", F.col("r").alias("ra"), "m", F.col("sequence_id").alias("a"), F.col("lanes").alias("la"), all_pairs.alias("every"), F.explode(F.sequence(F.lit(1), steps)).alias("j"))
    ring = ring.where(F.when(F.col("every"), F.col("ra") + F.col("j") < F.col("m")).otherwise((F.col("j") - 1) * F.col("m") + F.col("ra") < most_pairs))
    ring = ring.withColumn("rb", (F.col("ra") + F.col("j")) % F.col("m"))
    b = r.select("key", "segment", F.col("r").alias("rb"), F.col("sequence_id").alias("b"), F.col("lanes").alias("lb"))
    d = stage(ring.join(b, ["key", "segment", "rb"]).select("key", "segment", "a", "b", Q.lane_distance("la", "lb").alias("d")), "distances")
    sums = [F.count("*").alias("n"), F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("q")]
    own = d.select("key", "segment", F.explode(F.array("a", "b")).alias("sequence_id"), "d").groupBy("key", "segment", "sequence_id").agg(*sums)
    return own, d.groupBy("key", "segment").agg(*sums)


def distance_scores(keys: DataFrame, signatures: DataFrame, screen: C.Screen | None = None) -> DataFrame:
    """(sequence_id, segment, mean, mu, sigma, z): a record's mean distance to its mates against a baseline.

    per_constellation: mean and deviation between its mates without it, in closed form from group sums; too few of them
    fall back to the baseline of all groups. Deviations have a floor.
    """
    screen = screen or C.Screen()
    sizes = keys.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > screen.mates)
    big = keys.join(sizes, "key", "left_semi")
    m = mate_sums(big, signatures)
    own, group = baselines(big, signatures, screen.baseline_pairs)
    base = group.groupBy("segment").agg(F.sum("n").alias("tn"), F.sum("s").alias("ts"), F.sum("q").alias("tq"))
    j = m.join(group.toDF("key", "segment", "gn", "gs", "gq"), ["key", "segment"]).join(own.toDF("key", "segment", "sequence_id", "bn", "bs", "bq"), ["key", "segment", "sequence_id"], "left")
    j = j.join(F.broadcast(base), "segment")  # eight rows
    var = lambda s, q, n: F.greatest(q / n - (s / n) * (s / n), F.lit(0.0))
    ln, ls, lq = (F.col(f"g{x}") - F.coalesce(f"b{x}", F.lit(0)) for x in "nsq")
    local = (ln >= screen.comparisons) & F.lit(screen.baseline == "per_constellation")
    mu = F.when(local, ls / ln).otherwise(F.col("ts") / F.col("tn"))
    sigma = F.when(local, F.sqrt(var(ls, lq, ln))).otherwise(F.sqrt(var(F.col("ts"), F.col("tq"), F.col("tn"))))
    mean = F.col("s") / F.col("n")
    return j.where(F.col("n") >= screen.comparisons).select("sequence_id", "segment", mean.alias("mean"), mu.alias("mu"), F.greatest(sigma, F.lit(screen.sigma_floor)).alias("sigma")).withColumn("z", (F.col("mean") - F.col("mu")) / F.col("sigma"))


def stage2_events(keys: DataFrame, signatures: DataFrame, screen: C.Screen | None = None) -> DataFrame:
    """Events of records whose z-score is over the threshold in a segment or more."""
    screen = screen or C.Screen()
    z = distance_scores(keys, signatures, screen).where(F.col("z") > screen.z)
    e = z.groupBy("sequence_id").agg(in_order(F.collect_set("segment")).alias("discordant_segments"), F.avg("z").alias("mean_z"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("segment", "z")))).alias("zs"))
    g = F.col("discordant_segments")
    e = e.where(F.size(g) >= screen.least_segments).withColumn("confidence", clamp((1 - F.exp(-screen.z_decay * F.col("mean_z"))) * coherence(g, screen)))
    return e.where(F.col("confidence") >= screen.least_confidence).select("sequence_id", event_type(g).alias("event_type"), F.lit(2).alias("stage"), g, "confidence", F.to_json(F.struct("zs")).alias("evidence"))


def detect(profiles: DataFrame, signatures: DataFrame, alleles: DataFrame | None = None, screen: C.Screen | None = None, lineage: DataFrame | None = None, permutation_gate: bool | None = None) -> DataFrame:
    """All events. Isolates with an event of one stage take no part in the next; stages 1 and 2 see isolates with six
    assigned segments or more. profiles is assign_genotypes() output, signatures (sequence_id, segment, lanes), and num_hashes and seed where they differ."""
    screen = screen or C.Screen()
    if profiles.select("sequence_id").distinct().limit(2).count() < 2:
        return profiles.sparkSession.createDataFrame([], "sequence_id string, event_type string, stage int, discordant_segments array<string>, confidence double, evidence string")
    full = stage(analysable(profiles, screen), "analysable")
    pool = full
    e0 = stage(screen_alleles(alleles, screen, lineage), "stage0") if alleles is not None else None
    if e0 is not None:
        pool = stage(full.join(e0.select("sequence_id"), "sequence_id", "left_anti"), "pool")
    e1 = stage(stage1_events(pool, screen), "stage1")
    if screen.gate if permutation_gate is None else permutation_gate:
        ok = validate_events(e1, full, screen).groupBy("sequence_id").agg(F.every("significant").alias("ok")).where("ok")
        e1 = stage(e1.join(ok.select("sequence_id"), "sequence_id", "left_semi"), "gated")
    keys = constellation_keys(pool)
    clear = keys.join(e1.select("sequence_id"), "sequence_id", "left_anti")
    e2 = stage2_events(keys, signatures, screen).join(clear.select("sequence_id"), "sequence_id", "left_semi")
    out = e1.unionByName(e2)
    return e0.unionByName(out) if e0 is not None else out


def analysable(profiles: DataFrame, screen: C.Screen | None = None) -> DataFrame:
    """The profiles of isolates with enough assigned segments for stages 1 and 2."""
    least = (screen or C.Screen()).analysed
    n = profiles.groupBy("sequence_id").agg(F.count_if(F.col("status") == "ASSIGNED").alias("k")).where(F.col("k") >= least)
    return profiles.join(n.select("sequence_id"), "sequence_id", "left_semi")


def reassortment_rate(events: DataFrame, analysed: DataFrame) -> DataFrame:
    """(flagged, analysed, rate); the rate is 0 without analysed isolates."""
    return events.agg(F.count("*").alias("flagged")).crossJoin(analysed.agg(F.countDistinct("sequence_id").alias("analysed"))).withColumn("rate", F.when(F.col("analysed") > 0, F.col("flagged") / F.col("analysed")).otherwise(0.0))  # one row each


# --- permutation validation ---------------------------------------------------------------------------------------------------

#: Events that are compared with all profiles in one pass.
EVENTS_A_PASS = 4096


def observed_scores(events: DataFrame, profiles: DataFrame, screen: C.Screen | None = None) -> DataFrame:
    """(sequence_id, segment, observed, n_tested, alpha) of each scored discordant segment of an event.

    profiles are those of all isolates; tests are made over the analysable ones. n_tested counts the isolate's scored
    segments, discordant or not; they share the level.
    """
    screen = screen or C.Screen()
    full = analysable(profiles, screen)
    mine = full.join(events.select("sequence_id"), "sequence_id", "left_semi")
    s = stage(segment_scores(mine, screen.combine, full), "scores")
    n = s.groupBy("sequence_id").agg(F.count("*").alias("n_tested"))
    own = events.select("sequence_id", F.explode("discordant_segments").alias("segment")).distinct()
    alpha = F.lit(screen.alpha) / (F.col("n_tested") if screen.share_alpha else F.lit(1))
    return s.join(own, ["sequence_id", "segment"]).join(n, "sequence_id").select("sequence_id", "segment", F.col("p").alias("observed"), "n_tested", alpha.alias("alpha"))


def partner_patterns(events: DataFrame, wide: DataFrame) -> DataFrame:
    """(sequence_id, segment, code, k): how many distinct profile rows look alike to an event's segment.

    wide has (clusters, k): the eight cluster ids of a profile, null where none is assigned, and the isolates that share
    them. code has a digit to base 3 for each of the eight segments: 0 not assigned, 1 another cluster than the event's
    isolate, 2 the same one. The stated events are compared with all profiles in blocks, EVENTS_A_PASS of them at a time;
    a block sends at most one row for each event, segment and code.
    """
    spark, every = events.sparkSession, events.count()
    passes, out = -(-every // EVENTS_A_PASS), None
    for i in range(passes):
        lot = events.where(F.pmod(F.xxhash64("sequence_id"), F.lit(passes)) == i).select("sequence_id", "segment", "clusters").collect()  # about EVENTS_A_PASS rows
        held = share(spark, [(r["sequence_id"], r["segment"], r["clusters"]) for r in lot])

        def run(batches: Iterator[pd.DataFrame], held=held) -> Iterator[pd.DataFrame]:
            at = {s: j for j, s in enumerate(C.SEGMENTS)}
            for pdf in batches:
                rows, k = np.array(pdf["clusters"].tolist(), dtype=object), pdf["k"].to_numpy()
                names = {v: j for j, v in enumerate(sorted({x for x in rows.ravel() if x is not None}))}
                code = np.array([[names.get(x, -1) for x in r] for r in rows])
                found = []
                for sid, seg, mine in held.value:
                    own = np.array([names.get(x, -2) for x in mine])
                    digit = np.where(code < 0, 0, np.where(code == own, 2, 1))
                    digit[:, at[seg]] = np.where(code[:, at[seg]] < 0, 0, 1)
                    u, to = np.unique((digit * 3 ** np.arange(8)).sum(axis=1), return_inverse=True)
                    found.append(pd.DataFrame({"sequence_id": sid, "segment": seg, "code": u, "k": np.bincount(to, k).astype(np.int64)}))
                if found:
                    yield pd.concat(found)

        got = wide.mapInPandas(run, "sequence_id string, segment string, code int, k long")
        out = got if out is None else out.union(got)
    if out is None:
        return spark.createDataFrame([], "sequence_id string, segment string, code int, k long")
    return out.groupBy("sequence_id", "segment", "code").agg(F.sum("k").alias("k"))


def draw(rng: np.random.Generator, colors: np.ndarray, n: np.ndarray) -> np.ndarray:
    """For each row, how many of n balls drawn without replacement have each color; colors has a row for each draw."""
    out, left, rest = np.zeros_like(colors), n.copy(), colors.sum(axis=1)
    for j in range(colors.shape[1]):
        rest = rest - colors[:, j]
        big = rest + colors[:, j] >= 10**9  # beyond the exact sampler's range the binomial law is the same to the eye
        small = rng.hypergeometric(np.where(big, 1, colors[:, j]), np.where(big, 1, rest), np.where(big, 0, left))
        if big.any():
            share_ = np.clip(colors[:, j] / np.maximum(rest + colors[:, j], 1), 0, 1)
            small = np.where(big, np.clip(rng.binomial(left, share_), np.maximum(0, left - rest), colors[:, j]), small)
        out[:, j] = small
        left = left - small
    return out


def null_scores(rng: np.random.Generator, codes: np.ndarray, counts: np.ndarray, segment: int, mine: int, sizes: np.ndarray, weights: np.ndarray, n: int, method: str) -> np.ndarray:
    """n combined p-values of an isolate's segment after its column was permuted over all profiles.

    codes and counts are the profiles as partner_patterns() has them, mine the isolate's own code. The isolate gets the
    cluster of a profile drawn at random, of a size in sizes by weights (0: not assigned, p = 1); the cluster's other
    members and the profiles without one fall on the rest at random, the same ones for all partners at once. Which
    profiles they are matters only by their code, so a draw is two multivariate hypergeometric ones.
    """
    digits = codes[:, None] // 3 ** np.arange(8) % 3
    partners = [j for j in range(8) if j != segment and mine // 3**j % 3 == 2]
    group, to = np.unique(digits[:, partners] @ 3 ** np.arange(len(partners)) if partners else np.zeros(len(codes), int), return_inverse=True)
    total = np.bincount(to, counts).astype(np.int64)
    empty = int(counts[digits[:, segment] == 0].sum())
    own = int(np.searchsorted(group, sum(2 * 3**i for i in range(len(partners)))))
    others = total.copy()
    others[own] -= 1
    size = rng.choice(sizes, n, p=weights)
    out, live = np.ones(n), np.flatnonzero(size > 0)
    if not len(live) or not partners:
        return out
    rest = np.broadcast_to(others, (len(live), len(others)))
    x = draw(rng, rest, size[live] - 1)
    gone = draw(rng, rest - x, np.full(len(live), empty)) if empty else np.zeros_like(x)
    ps = []
    for i in range(len(partners)):
        digit = group // 3**i % 3
        same, there = digit == 2, digit > 0
        ab, a = 1 + x[:, same].sum(axis=1), 1 + x[:, there].sum(axis=1)
        b, t = 1 + (rest - gone)[:, same].sum(axis=1), 1 + (rest - gone)[:, there].sum(axis=1)
        ps.append(T.fisher_less_array(ab, a, b, t))
    p = np.stack(ps)
    if method == "stouffer":
        out[live] = T.cdf_array(T.quantile_array(p).sum(axis=0) / math.sqrt(len(p)))
    else:
        q = np.clip(p, 1e-300, 1 - 1e-15)
        stat = np.where(q < 1e-15, 1 / (q * np.pi), np.tan((0.5 - q) * np.pi)).mean(axis=0)
        out[live] = np.clip(np.where(stat > 1e15, 1 / np.maximum(stat, 1) / np.pi, 0.5 - np.arctan(stat) / np.pi), 0, 1)
    return out


def validate_events(events: DataFrame, profiles: DataFrame, screen: C.Screen | None = None, n: int | None = None) -> DataFrame:
    """(sequence_id, segment, observed, p, n_tested, significant): an empirical p-value for each discordant segment.

    The segment's column is permuted over all analysable profiles, the event's own among them, and its combined p-value
    is made anew; p is the share of n permutations with one as small, each side with one more. The law of the draws is
    that of the permutations (null_scores()), their cost doesn't grow with the profiles. Draws come from a generator
    seeded by the event and segment, so tasks repeat alike. significant: p is under the level the scored segments share.
    """
    screen = screen or C.Screen()
    n, seed, method = n or screen.draws, screen.seed, screen.combine
    full = stage(analysable(profiles, screen), "analysable")
    obs = stage(observed_scores(events, full, screen), "observed")
    cells = F.map_from_entries(F.collect_list(F.struct("segment", F.when(is_assigned("cluster_id"), F.col("cluster_id")))))
    each = full.groupBy("sequence_id").agg(cells.alias("m")).select("sequence_id", F.array(*(F.col("m")[s] for s in C.SEGMENTS)).alias("clusters"))
    wide = stage(each.groupBy("clusters").agg(F.count("*").alias("k")), "tuples")
    mine = stage(obs.join(each, "sequence_id"), "events")
    patterns = partner_patterns(mine, wide)
    # sizes of a segment's clusters, and how many profiles are in a cluster of that size; at most about the root of twice the profiles
    tall = wide.select("k", F.posexplode("clusters").alias("at", "cluster"))
    per = tall.groupBy("at", "cluster").agg(F.sum("k").alias("size")).select("at", F.when(F.col("cluster").isNotNull(), F.col("size")).otherwise(0).alias("size"), F.col("size").alias("profiles"))
    hist: dict[str, tuple[list, list]] = {}
    for r in per.groupBy("at", "size").agg(F.sum("profiles").alias("w")).orderBy("at", "size").collect():
        a, b = hist.setdefault(C.SEGMENTS[r["at"]], ([], []))
        a.append(r["size"])
        b.append(r["w"])

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        import xxhash

        rng = np.random.default_rng(xxhash.xxh3_64_intdigest(f"{seed}|{key[0]}|{key[1]}"))
        pdf = pdf.sort_values("code")
        at = C.SEGMENTS.index(key[1])
        own = sum(3**j * (1 if j == at else 2) for j, v in enumerate(pdf["clusters"].iloc[0]) if v is not None)
        sizes, w = (np.array(v, dtype=np.int64) for v in hist[key[1]])
        obs_ = float(pdf["observed"].iloc[0])
        null = null_scores(rng, pdf["code"].to_numpy(np.int64), pdf["k"].to_numpy(np.int64), at, own, sizes, w / w.sum(), n, method)
        return pd.DataFrame({"sequence_id": [key[0]], "segment": [key[1]], "p": [float(((null <= obs_ * (1 + 1e-9)).sum() + 1) / (n + 1))]})

    out = patterns.join(mine, ["sequence_id", "segment"]).groupBy("sequence_id", "segment").applyInPandas(run, "sequence_id string, segment string, p double")
    return out.join(obs, ["sequence_id", "segment"]).select("sequence_id", "segment", "observed", "p", "n_tested", (F.col("p") < F.col("alpha")).alias("significant"))
