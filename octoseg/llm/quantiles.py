"""Percentiles of large columns: mergeable deterministic rank-interval summaries, and exact values through their bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from octoseg.runtime import broadcast_if_small, discard, stage, table

#: Lots of summaries of a group after each level of merging.
LEVELS = (256, 16, 1)
#: Bounds of how many values are less than a tuple's value, and of how many are not greater.
BOUNDS = ["lt_lo", "lt_hi", "le_lo", "le_hi"]
SUMMARY = [StructField("value", DoubleType()), *(StructField(c, LongType()) for c in (*BOUNDS, "n", "err"))]


def summarise(values: np.ndarray) -> pd.DataFrame:
    """The exact summary of some values: each distinct value with its rank interval."""
    v, k = np.unique(values, return_counts=True)
    upto = np.cumsum(k)
    return pd.DataFrame({"value": v, "lt_lo": upto - k, "lt_hi": upto - k, "le_lo": upto, "le_hi": upto})


def merge(a: pd.DataFrame, na: int, b: pd.DataFrame, nb: int) -> pd.DataFrame:
    """A summary of both: what the other summary proves about a value is added to its own bounds.

    Equal values add up exactly. A value between two tuples of the other has at least as many values below it as the
    lower one is known to have up to itself, and at most as many as may be less than the upper one.
    """
    if not len(a) or not len(b):
        return a if len(a) else b

    def lifted(x: pd.DataFrame, y: pd.DataFrame, ny: int) -> pd.DataFrame:
        xv, yv = x["value"].to_numpy(), y["value"].to_numpy()
        below, above = np.searchsorted(yv, xv, side="left") - 1, np.searchsorted(yv, xv, side="right")
        low = np.where(below >= 0, y["le_lo"].to_numpy()[np.maximum(below, 0)], 0)
        high = np.where(above < len(yv), y["lt_hi"].to_numpy()[np.minimum(above, len(yv) - 1)], ny)
        same = above - below > 1
        at = np.minimum(below + 1, len(yv) - 1)
        add = {c: np.where(same, y[c].to_numpy()[at], low if c.endswith("lo") else high) for c in BOUNDS}
        return pd.DataFrame({"value": xv, **{c: x[c].to_numpy() + add[c] for c in BOUNDS}})

    out = pd.concat([lifted(a, b, nb), lifted(b, a, na)]).drop_duplicates("value")
    return out.sort_values("value").reset_index(drop=True)


def compress(s: pd.DataFrame, n: int, size: int) -> pd.DataFrame:
    """At most about size tuples: the ends, and the tuple that holds each of size even ranks."""
    if len(s) <= size + 2:
        return s
    at = np.minimum(np.searchsorted(s["le_hi"].to_numpy(), np.linspace(1, n, size), side="left"), len(s) - 1)
    return s.iloc[np.unique(np.concatenate([[0], at, [len(s) - 1]]))].reset_index(drop=True)


def uncertainty(s: pd.DataFrame) -> int:
    """The largest number of ranks a summary leaves open: within a tuple's bounds or between two tuples."""
    if not len(s):
        return 0
    v = {c: s[c].to_numpy() for c in BOUNDS}
    own = max((v["lt_hi"] - v["lt_lo"]).max(), (v["le_hi"] - v["le_lo"]).max())
    return int(max(own, (v["lt_hi"][1:] - v["le_lo"][:-1]).max())) if len(s) > 1 else int(own)


def _merge_many(parts: list[tuple[pd.DataFrame, int]], size: int) -> tuple[pd.DataFrame, int]:
    while len(parts) > 1:
        nxt = []
        for i in range(0, len(parts) - 1, 2):
            (a, na), (b, nb) = parts[i], parts[i + 1]
            nxt.append((compress(merge(a, na, b, nb), na + nb, size), na + nb))
        parts = nxt + parts[len(parts) & ~1 :]
    return parts[0]


def quantile_summaries(df: DataFrame, group: list[str], value: str, eps: float = 0.001) -> DataFrame:
    """(*group, value, lt_lo, lt_hi, le_lo, le_hi, n, err): one mergeable summary for each group.

    Each partition keeps one summary for each group, compressed to 2 / eps tuples as batches arrive; summaries are
    merged in LEVELS lots,
    so a task reads partitions / 256 of them at first and 16 at a time afterwards. err is the accumulated
    uncertainty in ranks. Nulls and not-a-numbers are left out; null groups are groups.
    """
    size = int(2 / eps)
    keys = [df.schema[g] for g in group]
    schema = StructType([*keys, StructField("part", LongType()), *SUMMARY])

    def tidy(key: tuple, s: pd.DataFrame, n: int, part: int) -> pd.DataFrame:
        out = s.copy()
        for g, k in zip(reversed(group), reversed(key)):
            out.insert(0, g, [k] * len(s))
        out["part"], out["n"], out["err"] = part, n, uncertainty(s)
        return out[[f.name for f in schema]]

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, held = TaskContext.get().partitionId(), {}
        for pdf in batches:
            pdf = pdf[pdf[value].notna()]
            for key, x in pdf.groupby(group, dropna=False, sort=False):
                key = tuple(None if k is None or k != k else k for k in key)
                s = compress(summarise(x[value].to_numpy(dtype=np.float64)), len(x), size)
                if key in held:
                    a, n = held[key]
                    held[key] = (compress(merge(a, n, s, len(x)), n + len(x), size), n + len(x))
                else:
                    held[key] = (s, len(x))
        for key, (s, n) in held.items():
            yield tidy(key, s, n, part)

    def level(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [(x[["value", *BOUNDS]].reset_index(drop=True), int(x["n"].iloc[0])) for _, x in pdf.groupby("part", sort=True)]
        s, n = _merge_many(parts, size)
        return tidy(key[:-1], s, n, int(key[-1]))

    out = df.select(*group, F.col(value).cast("double").alias(value)).where(F.col(value).isNotNull() & ~F.isnan(value)).mapInPandas(partial, schema)
    for lots in LEVELS:
        out = out.withColumn("to", F.pmod("part", F.lit(lots))).groupBy(*group, "to").applyInPandas(level, schema)
    return out.drop("part")


def merge_summaries(*parts: DataFrame, group: list[str], eps: float = 0.001) -> DataFrame:
    """Combine summaries of separate days or versions into one for each group."""
    size = int(2 / eps)
    every = None
    for i, p in enumerate(parts):
        q = p.withColumn("part", F.lit(i))
        every = q if every is None else every.unionByName(q)
    schema = parts[0].schema
    names = [f.name for f in schema]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        s, n = _merge_many([(x[["value", *BOUNDS]].reset_index(drop=True), int(x["n"].iloc[0])) for _, x in pdf.groupby("part", sort=True)], size)
        out = s.copy()
        for g, k in zip(group, key):
            out[g] = [k] * len(out)
        out["n"], out["err"] = n, uncertainty(s)
        return out[names]

    return every.groupBy(*group).applyInPandas(run, schema)


def rank_bounds(summaries: DataFrame, group: list[str], p: float) -> DataFrame:
    """(*group, n, low, high, open): values that enclose the two order statistics of percentile p (linear interpolation),
    and the greatest number of values there may be from low to high."""
    r = F.lit(p) * (F.col("n") - 1)
    return _enclosed(summaries, group, F.floor(r) + 1, F.ceil(r) + 1)


def _enclosed(summaries: DataFrame, group: list[str], first: Column, last: Column) -> DataFrame:
    cell = lambda c: F.struct("value", c)
    low = F.coalesce(F.max(F.when(F.col("lt_hi") < first, cell("lt_lo"))), F.min(cell("lt_lo")))
    high = F.coalesce(F.min(F.when(F.col("le_lo") >= last, cell("le_hi"))), F.max(cell("le_hi")))
    out = summaries.groupBy(*group).agg(F.first("n").alias("n"), low.alias("l"), high.alias("h"))
    return out.select(*group, "n", F.col("l.value").alias("low"), F.col("h.value").alias("high"), (F.col("h.le_hi") - F.col("l.lt_lo")).alias("open"))


def approximate_percentiles(summaries: DataFrame, group: list[str], ps: list[float]) -> DataFrame:
    """(*group, p, value, n, err): a value whose rank is off by no more than err."""
    s = summaries.select("*", F.explode(F.array(*(F.lit(float(p)) for p in ps))).alias("p"))
    r = F.lit(1) + F.col("p") * (F.col("n") - 1)
    off = F.greatest(F.col("lt_hi") + 1 - r, r - F.col("le_lo"), F.lit(0.0))
    return s.groupBy(*group, "p").agg(F.min_by("value", F.struct(off, F.col("value"))).alias("value"), F.first("n").alias("n"), F.first("err").alias("err"))


def exact_percentile(df: DataFrame, group: list[str], value: str, p: float, eps: float = 0.001, most: int = 1 << 20, most_rounds: int = 12) -> DataFrame:
    """(*group, n, q): the percentile by linear interpolation, exact.

    The summaries' bounds enclose the order statistics it needs. While a group may have more than `most` values between
    its bounds, those are summarised again by themselves, which narrows the bounds by another factor of about 2 eps;
    so the last pass, which counts what lies under the lower bound and ranks the distinct values between the bounds,
    holds a fixed number of them for each group, whatever its size. Bounds that meet in one value are narrow enough.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*group, F.col(value).cast("double").alias("_v"))
    bounds = stage(rank_bounds(quantile_summaries(rows, group, "_v", eps), group, p), "bounds")
    for _ in range(most_rounds):
        wide = bounds.where((F.col("open") > most) & (F.col("low") < F.col("high")))
        before = wide.agg(F.sum("open")).first()[0]
        if not before:
            break
        inside = _within(rows, wide, group)
        under = inside.where("_v < _low").groupBy(*group).agg(F.count("*").alias("_under"))
        again = quantile_summaries(inside.where("_v >= _low").select(*group, F.col("_v")), group, "_v", eps)
        again = _same(again, wide.select(*group, F.col("n").alias("_n")), group)
        again = _same(again, under, group, "left")
        r, skip = F.lit(p) * (F.col("_n") - 1), F.coalesce("_under", F.lit(0))
        new = _enclosed(again.withColumns({"_first": F.floor(r) + 1 - skip, "_last": F.ceil(r) + 1 - skip, "n": F.col("_n")}), group, F.col("_first"), F.col("_last"))
        rest = bounds.where(~((F.col("open") > most) & (F.col("low") < F.col("high"))))
        last, bounds = bounds, stage(rest.unionByName(new), "bounds")
        discard(last)
        if bounds.where((F.col("open") > most) & (F.col("low") < F.col("high"))).agg(F.sum("open")).first()[0] == before:
            break  # so many equal values that bounds can't be narrower; they are one row each in the last pass
    c = _within(rows, bounds, group).groupBy(*group, "_n", F.when(F.col("_v") < F.col("_low"), F.lit(None)).otherwise(F.col("_v")).alias("_x")).agg(F.count("*").alias("_k"))
    w = Window.partitionBy(*group).orderBy(F.col("_x").asc_nulls_first())
    c = c.withColumn("_upto", F.sum("_k").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("_x is not null")
    r = F.lit(p) * (F.col("_n") - 1)
    lo = F.min(F.when(F.col("_upto") >= F.floor(r) + 1, F.col("_x")))
    hi = F.min(F.when(F.col("_upto") >= F.ceil(r) + 1, F.col("_x")))
    c = c.groupBy(*group, "_n").agg(lo.alias("_lo"), hi.alias("_hi"))
    return c.select(*group, F.col("_n").alias("n"), (F.col("_lo") + (r - F.floor(r)) * (F.col("_hi") - F.col("_lo"))).alias("q"))


def _same(a: DataFrame, b: DataFrame, group: list[str], how: str = "inner") -> DataFrame:
    """a joined with b on groups, null ones included; b has few rows."""
    c = b.select(*(F.col(g).alias(f"_{g}") for g in group), *(x for x in b.columns if x not in group))
    on = F.lit(True)
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return a.join(broadcast_if_small(c), on, how).drop(*(f"_{g}" for g in group))


def _within(rows: DataFrame, bounds: DataFrame, group: list[str]) -> DataFrame:
    """Rows up to the upper bound of their group, with _n, _low and _high."""
    return _same(rows, bounds.select(*group, F.col("n").alias("_n"), F.col("low").alias("_low"), F.col("high").alias("_high")), group).where("_v <= _high")


GROUP = ["segment_name", "is_orphan"]


def distances(seg: DataFrame) -> DataFrame:
    """Each id once with a distance from 0 to 1 and a non-null is_orphan."""
    ok = seg.select("id", *GROUP, "distance_to_centroid").where("distance_to_centroid between 0 and 1 and is_orphan is not null and id is not null and not isnan(distance_to_centroid)")
    return ok.distinct()


def p5_found(spark, sf_dir: str) -> DataFrame:
    d = distances(table(spark, sf_dir, "segment_kmers"))
    q = exact_percentile(d, GROUP, "distance_to_centroid", 0.9).select(F.col("segment_name").alias("s"), F.col("is_orphan").alias("o"), "q")
    on = F.col("segment_name").eqNullSafe(F.col("s")) & (F.col("is_orphan") == F.col("o"))
    return d.join(broadcast_if_small(q), on).where("distance_to_centroid > 2 * q").select("id")


def p5_percentiles(spark, sf_dir: str) -> DataFrame:
    """Approximate percentiles by group: summaries of each cluster version, merged."""
    d = table(spark, sf_dir, "segment_kmers").select("id", *GROUP, "cluster_version", "distance_to_centroid").where("distance_to_centroid between 0 and 1 and is_orphan is not null and id is not null").distinct()
    by = quantile_summaries(d, [*GROUP, "cluster_version"], "distance_to_centroid")
    names = ["value", *BOUNDS, "n", "err"]
    schema = StructType([d.schema[g] for g in GROUP] + SUMMARY)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        s, n = _merge_many([(x[names[:5]].reset_index(drop=True), int(x["n"].iloc[0])) for _, x in pdf.groupby("cluster_version", sort=True, dropna=False)], 2000)
        out = s.assign(segment_name=key[0], is_orphan=key[1], n=n, err=uncertainty(s))
        return out[[*GROUP, *names]]

    return approximate_percentiles(by.groupBy(*GROUP).applyInPandas(run, schema), GROUP, [0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])


P5_SQL = {
    "p5_found": """
with d as (select distinct id, segment_name, is_orphan, distance_to_centroid as x from segment_kmers
           where distance_to_centroid between 0 and 1 and not isnan(distance_to_centroid) and is_orphan is not null and id is not null),
q as (select segment_name, is_orphan, quantile_cont(x, 0.9) as q from d group by all)
select d.id from d join q on d.segment_name is not distinct from q.segment_name and d.is_orphan = q.is_orphan where x > 2 * q
""",
}
