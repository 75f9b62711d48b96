"""Mixing sources to target weights: entropy balancing by distributed Newton steps, rounded into copies."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from octoseg.llm.tokenizer import token_counts
from octoseg.runtime import broadcast_if_small, stage, table

#: Documents a rounding window holds on average; more documents make more windows.
WINDOW = 200_000


def source_totals(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, available, total) for each source of targets.

    total counts the tokens of all documents with a source, in targets or not. A source without documents has none.
    Repeated target rows count once; a null max_repeats is 1, a null share 0.
    """
    by = sizes.where("source is not null").groupBy("source").agg(F.sum("tokens").alias("available"))
    t = targets.where("source is not null").select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats")).distinct()
    out = t.join(by, "source", "left").withColumn("available", F.coalesce("available", F.lit(0)))
    return out.crossJoin(F.broadcast(by.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("total"))))  # one row


def tilts(sizes: DataFrame, totals: DataFrame, tolerance: float = 1e-9, most_steps: int = 60) -> dict[str, tuple[float, float, int]]:
    """{source: (lambda, mean size, max_repeats)}: rates min(max_repeats, exp(lambda tokens / mean)) meet the targets.

    The rates are nearest to one copy each in relative entropy under the token constraints; the dual has one variable a
    source. A step is one aggregate over (source, tokens) counts, made once, with a few numbers for each source sent to
    the driver; Newton steps that leave the bracket are halved into it. The number of sources bounds what is collected.
    """
    spec = {r["source"]: r for r in totals.where("available > 0").collect()}
    hist = stage(sizes.where("source is not null and tokens > 0").groupBy("source", "tokens").agg(F.count("*").alias("k")), "hist")
    mean = {r["source"]: r["m"] for r in hist.groupBy("source").agg((F.sum(F.col("tokens") * F.col("k")) / F.sum("k")).alias("m")).collect()}
    state = {}
    for s, r in spec.items():
        goal, cap = r["target_share"] * r["total"], r["max_repeats"]
        if cap * r["available"] <= goal:
            state[s] = [math.inf, 0.0, 0.0, True]
        elif goal <= 0:
            state[s] = [-math.inf, 0.0, 0.0, True]
        else:
            state[s] = [0.0, -200.0, 200.0, False]
    spark = sizes.sparkSession
    for _ in range(most_steps):
        open_ = [(s, v[0], mean[s], float(spec[s]["max_repeats"])) for s, v in state.items() if not v[3]]
        if not open_:
            break
        lam = spark.createDataFrame(open_, "source string, lam double, mean double, cap double")
        x = hist.join(F.broadcast(lam), "source")  # one row a source still open
        e = F.col("lam") * F.col("tokens") / F.col("mean")
        held = e < F.log("cap")
        w = F.when(held, F.exp(e)).otherwise(F.col("cap"))
        mass = F.col("tokens") * F.col("k") * w
        got = x.groupBy("source").agg(F.sum(mass).alias("f"), F.sum(F.when(held, mass * F.col("tokens") / F.col("mean")).otherwise(0.0)).alias("d"))
        for r in got.collect():
            v, goal = state[r["source"]], spec[r["source"]]["target_share"] * spec[r["source"]]["total"]
            gap = r["f"] - goal
            if abs(gap) <= tolerance * goal or v[2] - v[1] < 1e-12:
                v[3] = True
                continue
            if gap > 0:
                v[2] = v[0]
            else:
                v[1] = v[0]
            step = v[0] - r["f"] * math.log(r["f"] / goal) / r["d"] if r["d"] > 0 else math.nan  # Newton on the logarithm
            v[0] = step if v[1] < step < v[2] else (v[1] + v[2]) / 2
    return {s: (v[0], mean.get(s, 1.0), spec[s]["max_repeats"]) for s, v in state.items()}


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(copies, report): copies has (key, source, tokens, rate, copies), report one row for each source of targets.

    report: source, target_share, max_repeats, available, goal (tokens), used, actual_share, share_of_goal, and full: the
    dual's solution leaves no document of the source below max_repeats copies. No document has more than that. A source
    that is full and still short of its goal can't reach it and gives all it may. Sources outside targets and null sources give no copies; empty and
    null texts have no tokens and rate 1. Rates become whole copies by systematic rounding in order of size within
    windows of a source, so a window's tokens are off by about one document.
    """
    sizes = stage(token_counts(documents, [key, "source"], text, path), "sizes")
    totals = stage(source_totals(sizes, targets), "totals")
    found = tilts(sizes, totals)
    spark = sizes.sparkSession
    lam = spark.createDataFrame([(s, *map(float, v)) for s, v in found.items()], "source string, lam double, mean double, cap double")
    e = F.when(F.col("tokens") > 0, F.col("lam") * F.col("tokens") / F.col("mean")).otherwise(F.lit(0.0))
    r = sizes.join(broadcast_if_small(lam), "source").withColumn("rate", F.when(e >= F.log("cap"), F.col("cap")).otherwise(F.exp(e)))
    windows = max(1, -(-sizes.count() // WINDOW))
    r = r.withColumn("lot", F.pmod(F.xxhash64(key), F.lit(windows)))
    w = Window.partitionBy("source", "lot").orderBy("tokens", key).rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("rate").over(w)
    shift = F.pmod(F.xxhash64("source", "lot"), F.lit(997)) / F.lit(997.0)
    r = r.withColumn("upto", F.round(upto, 9)).withColumn("copies", (F.floor(F.col("upto") + shift) - F.floor(F.round(F.col("upto") - F.col("rate"), 9) + shift)).cast("int"))
    copies = r.select(key, "source", "tokens", "rate", F.least("copies", F.col("cap").cast("int")).alias("copies"))
    room = (F.col("tokens") > 0) & (F.col("copies") < F.col("cap").cast("int"))
    used = r.withColumn("copies", F.least("copies", F.col("cap").cast("int"))).groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), (~F.max(room)).alias("full"))
    rep = totals.join(used, "source", "left").withColumns({"used": F.coalesce("used", F.lit(0)), "full": F.coalesce("full", F.lit(True)), "goal": F.col("target_share") * F.col("total")})
    every = rep.agg(F.sum("used").alias("mixed"))
    rep = rep.crossJoin(F.broadcast(every)).select("source", "target_share", "max_repeats", "available", "goal", "used", F.when(F.col("mixed") > 0, F.col("used") / F.col("mixed")).otherwise(0.0).alias("actual_share"), (F.col("used") / F.when(F.col("total") > 0, F.col("total"))).alias("share_of_goal"), "full")  # one row
    return copies, rep


def p9_found(spark, sf_dir: str) -> DataFrame:
    """Sources that the solved mixture leaves short of their goal with all their documents at max_repeats."""
    return p9_report(spark, sf_dir).where(F.col("full") & (F.col("used") < F.col("goal"))).select("source")


def p9_report(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_mix(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0].where("copies > 0")


def p9_shares(spark, sf_dir: str) -> DataFrame:
    """The report of the mixture: goal, tokens used and actual share of each source."""
    return p9_report(spark, sf_dir)
