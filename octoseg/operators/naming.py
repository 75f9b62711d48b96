"""Stable names: alleles by nearest known centroid, constellations by digest."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from octoseg import config as C
from octoseg.functions import sequence as Q
from octoseg.operators.clustering import PARAMETERS, with_threshold
from octoseg.runtime import broadcast_if_small, stage

def best_match(queries: DataFrame, centroids: DataFrame, key: str = "query_id", same_subtype: bool = True, limit_bytes: int = 64 << 20) -> DataFrame:
    """(key, allele_name, similarity) of the most similar known allele, if it reaches the query's threshold.

    queries has (key, segment, subtype_num, lanes, threshold), centroids (allele_name, segment, subtype_num, lanes);
    ties go to the smaller name; same_subtype=False looks at the other subtype numbers only. Lanes of another length
    are no match. Centroids are broadcast behind a check of their size.
    """
    own = [x for x in PARAMETERS if x in queries.columns and x in centroids.columns]
    c = centroids.select(F.col("segment").alias("_s"), F.col("subtype_num").alias("_n"), "allele_name", F.col("lanes").alias("_l"), *(F.col(x).alias(f"_{x}") for x in own))
    on = (F.col("segment") == F.col("_s")) & ((F.col("subtype_num") == F.col("_n")) if same_subtype else (F.col("subtype_num") != F.col("_n")))
    for x in own:
        on = on & (F.col(x) == F.col(f"_{x}"))
    j = queries.join(broadcast_if_small(c, limit_bytes), on).where(F.size("_l") == F.size("lanes"))
    return _nearest_of(j, key)


ORDER = ["late", "first_id", "subtype", "cluster_id", "_v"]


def assign_alleles(founders: DataFrame, registry: DataFrame, grouping: C.Grouping | None = None) -> tuple[DataFrame, DataFrame]:
    """(names, lineage) for distinct cluster founders (segment, subtype, cluster_version, cluster_id, lanes, first_id, late).

    names has segment, subtype, cluster_version, cluster_id, allele_name, how, similarity, subtype_num, allele_num. In the
    order of (late, first_id): a founder whose cluster the registry already names, or one named before it, keeps that
    name (known); else the nearest centroid of its subtype number (matched), else of other numbers (other_subtype) gives
    the name; else a new name is minted, whose centroid later founders see.

    Founders meet the registry in parallel. Only a founder without a match there can mint, and of those with one lane
    array only the first, so the fold that needs an order holds distinct unmatched lanes of a segment; all others
    are compared afterwards with the names minted before them. lineage links the name of a late founder that has another
    subtype's number to the nearest allele of its own number, if one reaches the threshold, and the name is its own
    number's nearest.
    """
    f = founders.select("segment", "subtype", "cluster_version", "cluster_id", "first_id", "late", Q.subtype_number("subtype").alias("subtype_num"), F.coalesce("lanes", F.array().cast("array<string>")).alias("lanes"))
    f = with_threshold(f.withColumn("_v", F.coalesce("cluster_version", F.lit(""))), grouping).withColumn("ord", F.struct(*ORDER))
    key = ["segment", "subtype_num", "_v", "cluster_id"]
    known = registry.groupBy("segment", "subtype_num", F.coalesce("cluster_version", F.lit("")).alias("_v"), F.col("internal_cluster_id").alias("cluster_id")).agg(F.max_by("allele_name", "allele_num").alias("known"))
    lead = f.groupBy(*key).agg(F.min("ord").alias("lead"))
    f = f.join(known, key, "left").join(lead, key).withColumn("qid", F.monotonically_increasing_id())
    f = stage(f, "founders")
    asked = f.where((F.col("ord") == F.col("lead")) & F.col("known").isNull())
    r = registry.where("size(lanes) > 0").select("allele_name", "segment", "subtype_num", "lanes", F.lit(None).cast(f.schema["ord"].dataType).alias("ord"))
    own, other = stage(_nearest(asked, r, True), "own"), stage(_nearest(asked, r, False), "other")
    loose = asked.join(own.select("qid"), "qid", "left_anti").join(other.select("qid"), "qid", "left_anti")
    top = registry.groupBy("segment", "subtype_num").agg(F.max("allele_num").alias("top"))
    minted = stage(_minted(loose, top), "minted").join(f.select("qid", "lanes", "ord"), "qid")
    m = minted.where("size(lanes) > 0").select("allele_name", "segment", "subtype_num", "lanes", "ord")
    rest = asked.join(minted.select("qid"), "qid", "left_anti")
    own = _better(own, _nearest(rest, m, True)).toDF("qid", "own", "own_sim")
    other = _better(other, _nearest(rest, m, False)).toDF("qid", "other", "other_sim")
    got = asked.select("qid", *key).join(own, "qid", "left").join(other, "qid", "left").join(minted.select("qid", F.col("allele_name").alias("new"), "allele_num"), "qid", "left")
    got = stage(got.select(*key, F.coalesce("new", "own", "other").alias("name"), F.when(F.col("new").isNotNull(), "minted").when(F.col("own").isNotNull(), "matched").otherwise("other_subtype").alias("how"), F.when(F.col("new").isNull(), F.coalesce("own_sim", "other_sim")).alias("similarity"), "allele_num"), "names")
    j = f.join(got, key, "left")
    first = F.col("known").isNull() & (F.col("ord") == F.col("lead"))
    names = j.select("qid", "segment", "subtype", "cluster_version", "cluster_id", F.coalesce("known", "name").alias("allele_name"), F.when(first, F.col("how")).otherwise("known").alias("how"), F.when(first, F.col("similarity")).alias("similarity"), "subtype_num", F.when(first, F.col("allele_num")).alias("allele_num"), "late", "lanes", "threshold", "ord")
    names = stage(names, "named")
    theirs = Q.allele_subtype_number("allele_name")
    far = names.where(F.col("late") & (theirs != F.col("subtype_num")) & (F.size("lanes") > 0)).withColumn("theirs", theirs)
    every = r.union(m.select(*r.columns))
    there = _nearest(far.drop("subtype_num").withColumnRenamed("theirs", "subtype_num"), every, True).toDF("qid", "there", "_s")
    here = _nearest(far, every, True).toDF("qid", "here", "_t")
    links = far.join(there, "qid").join(here, "qid").where("there = allele_name and here <> allele_name")
    lineage = links.select(F.least("allele_name", "here").alias("allele_a"), F.greatest("allele_name", "here").alias("allele_b")).distinct()
    return names.drop("qid", "late", "lanes", "threshold", "ord"), lineage


def _nearest(queries: DataFrame, centroids: DataFrame, same: bool, limit_bytes: int = 64 << 20) -> DataFrame:
    """(qid, allele_name, similarity): best_match() among centroids that come before a query; those without ord always do."""
    c = centroids.select(F.col("segment").alias("_s"), F.col("subtype_num").alias("_n"), "allele_name", F.col("lanes").alias("_l"), F.col("ord").alias("_o"))
    num = F.col("subtype_num") == F.col("_n") if same else F.col("subtype_num") != F.col("_n")
    q = queries.select("qid", "segment", "subtype_num", "lanes", "threshold", "ord")
    j = q.join(broadcast_if_small(c, limit_bytes), (F.col("segment") == F.col("_s")) & num).where((F.size("_l") == F.size("lanes")) & (F.col("_o").isNull() | (F.col("_o") < F.col("ord"))))
    return _nearest_of(j, "qid")


def _nearest_of(j: DataFrame, key: str) -> DataFrame:
    j = j.withColumn("sim", 1 - Q.lane_distance("lanes", "_l")).where(F.col("sim") >= F.col("threshold") - 1e-12)
    return j.groupBy(key).agg(F.min(F.struct((-F.col("sim")).alias("d"), "allele_name")).alias("b")).select(key, F.col("b.allele_name").alias("allele_name"), (-F.col("b.d")).alias("similarity"))


def _better(a: DataFrame, b: DataFrame) -> DataFrame:
    """The nearer of two answers to each query, the smaller name on a tie."""
    best = F.min(F.struct((-F.col("similarity")).alias("d"), "allele_name")).alias("b")
    return a.union(b).groupBy("qid").agg(best).select("qid", F.col("b.allele_name").alias("allele_name"), (-F.col("b.d")).alias("similarity"))


def _minted(loose: DataFrame, top: DataFrame) -> DataFrame:
    """(qid, segment, subtype_num, allele_name, allele_num) of founders that mint, in their order; a segment is a group.

    A later founder with the lanes of an earlier one of its subtype always has a match, so only the first comes here;
    founders without lanes match nothing and mint each.
    """
    firsts = loose.where("size(lanes) > 0").groupBy("segment", "subtype", "subtype_num", "threshold", "lanes").agg(F.min(F.struct("ord", "qid")).alias("x"))
    firsts = firsts.select("segment", "subtype_num", "threshold", F.array_join("lanes", "").alias("hex"), "x.ord.*", "x.qid")
    bare = loose.where("size(lanes) = 0").select("segment", "subtype_num", "threshold", F.lit("").alias("hex"), "ord.*", "qid")
    rows = firsts.select(*bare.columns).union(bare).join(F.broadcast(top), ["segment", "subtype_num"], "left")  # a row for each segment and number

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held: dict[int, dict[int, list[np.ndarray]]] = {}
        last: dict[int, int] = {}
        out = []
        for x in pdf.rename(columns={"_v": "version"}).sort_values([*ORDER[:-1], "version"]).itertuples():
            n = int(x.subtype_num)
            if n not in last:
                last[n] = 0 if pd.isna(x.top) else int(x.top)
            v = np.array([x.hex[i : i + 16] for i in range(0, len(x.hex), 16)])
            like = [m for by in held.values() for m in by.get(len(v), [])]
            if len(v) and like and (np.stack(like) == v).mean(axis=1).max() >= x.threshold - 1e-12:
                continue
            last[n] += 1
            out.append((x.qid, key[0], n, f"{key[0]}.{n}.{last[n]:04d}", last[n]))
            held.setdefault(n, {}).setdefault(len(v), []).append(v)
        return pd.DataFrame(out, columns=["qid", "segment", "subtype_num", "allele_name", "allele_num"])

    return rows.groupBy("segment").applyInPandas(run, "qid long, segment string, subtype_num int, allele_name string, allele_num int")


def allele_name_of(registry: DataFrame, keys: DataFrame) -> DataFrame:
    """keys (segment_name, subtype_num, cluster_version, internal_cluster_id) with the allele_name they have, null if none."""
    r = registry.select("segment_name", "subtype_num", F.coalesce("cluster_version", F.lit("")).alias("_v"), "internal_cluster_id", "allele_name")
    k = keys.withColumn("_v", F.coalesce("cluster_version", F.lit("")))
    return k.join(broadcast_if_small(r), ["segment_name", "subtype_num", "_v", "internal_cluster_id"], "left").drop("_v")


def constellations(alleles: DataFrame, isolates: DataFrame, known: DataFrame | None = None, grouping: C.Grouping | None = None) -> DataFrame:
    """(sequence_id, allele_string, combination, constellation_id) of (sequence_id, segment, allele) rows.

    An id is the short subtype of the first isolate with the combination and 12 digits of its sha256; fewer than the
    least number of named segments give none. known (allele_combination, constellation_id) is asked first.
    """
    grouping = grouping or C.Grouping()
    m = alleles.where("allele is not null").groupBy("sequence_id").agg(F.map_from_entries(F.collect_list(F.struct("segment", "allele"))).alias("m"))
    row = isolates.select("sequence_id", "subtype").join(m, "sequence_id", "left")
    cell = lambda gap: [F.coalesce(F.col("m")[s], F.lit(gap)) for s in C.SEGMENTS]
    row = row.select("sequence_id", "subtype", F.concat_ws(" | ", *cell("?")).alias("allele_string"), F.concat_ws("|", *cell("-")).alias("combination"), F.coalesce(F.size("m"), F.lit(0)).alias("k"))
    ok = row.where(F.col("k") >= grouping.named_segments)
    first = ok.groupBy("combination").agg(F.min_by("subtype", "sequence_id").alias("subtype"))
    ids = first.select("combination", F.concat(Q.subtype_short("subtype"), F.lit("-"), F.upper(F.substring(F.sha2("combination", 256), 1, 12))).alias("new_id"))
    if known is not None:
        ids = ids.join(known.select(F.col("allele_combination").alias("combination"), F.col("constellation_id").alias("old_id")), "combination", "left").select("combination", F.coalesce("old_id", "new_id").alias("constellation_id"))
    else:
        ids = ids.withColumnRenamed("new_id", "constellation_id")
    return row.join(ids, "combination", "left").select("sequence_id", "allele_string", "combination", F.when(F.col("k") >= grouping.named_segments, F.col("constellation_id")).alias("constellation_id"))


def collisions(combos: DataFrame) -> DataFrame:
    """(constellation_id, combinations) of ids that stand for more than one combination; empty, or names are ambiguous."""
    return combos.where("constellation_id is not null").groupBy("constellation_id").agg(F.countDistinct("combination").alias("combinations")).where("combinations > 1")


def next_allele_numbers(registry: DataFrame) -> DataFrame:
    """(segment_name, subtype_num, next_num)."""
    return registry.groupBy("segment_name", "subtype_num").agg((F.coalesce(F.max("allele_num"), F.lit(0)) + 1).alias("next_num"))


def registry_summary(registry: DataFrame) -> DataFrame:
    """(segment, subtype_num, aliases, alleles, indexed): cluster ids that have a name, distinct names, centroids."""
    return registry.groupBy(F.col("segment_name").alias("segment"), "subtype_num").agg(F.count("*").alias("aliases"), F.countDistinct("allele_name").alias("alleles"), F.count_if(F.col("centroid_signature").isNotNull()).alias("indexed"))
