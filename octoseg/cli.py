"""Command line: run (batch, incremental, recluster) and repair."""

from __future__ import annotations

import argparse
import logging
import sys
from dataclasses import replace
from pathlib import PurePosixPath

from pyspark.sql import SparkSession

from octoseg import config as C
from octoseg.plans.pipeline import Pipeline
from octoseg.runtime import session
from octoseg.sources import exports as E
from octoseg.sources.fasta import parse_fasta
from octoseg.sources.store import Store


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="octoseg", description="Genotype segmented genomes on Spark.")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="process sequence files")
    r.add_argument("fasta")
    r.add_argument("--mode", choices=["batch", "incremental", "recluster"], default="batch")
    r.add_argument("--subtype")
    r.add_argument("--cluster-version")
    r.add_argument("--db", default="data/store")
    r.add_argument("--out-dir", default="results")
    r.add_argument("--no-tsv", action="store_true")
    r.add_argument("--num-hashes", type=int)
    r.add_argument("--hash-seed", type=int, default=42)
    r.add_argument("--min-cluster-size", type=int, default=10)
    r.add_argument("--linkage", choices=["average", "complete", "single", "ward"], default="average")
    r.add_argument("--dev-mode", action="store_true")
    r.add_argument("--no-reassortment", action="store_true")
    r.add_argument("--alpha", type=float, default=0.05)
    r.add_argument("--no-bonferroni", action="store_true")
    r.add_argument("--combination", choices=["cauchy", "stouffer"], default="cauchy")
    r.add_argument("--multiplicity", choices=["global_fdr_bh", "global_fdr_by", "per_profile_bonferroni"], default="global_fdr_bh")
    r.add_argument("--zscore-threshold", type=float, default=2.0)
    r.add_argument("--min-confidence", type=float, default=0.7)
    r.add_argument("--validate-reassortment", action="store_true")
    r.add_argument("--permutations", type=int, default=1000)
    r.add_argument("--allow-param-change", action="store_true")
    x = sub.add_parser("repair", help="rename the segments that carry a misnamed allele")
    for a in ("--segment", "--correct-subtype", "--misnamed-allele", "--cluster-version"):
        x.add_argument(a, required=True)
    x.add_argument("--db", default="data/store")
    x.add_argument("--dry-run", action="store_true")
    for c in (r, x):
        c.add_argument("--master", help="Spark master; without it spark-submit's, or all cores of this machine")
        c.add_argument("--log-level", choices=["DEBUG", "INFO", "WARN", "ERROR"], default="WARN")
    return p


def settings_of(a: argparse.Namespace) -> C.Settings:
    sketch, grouping, screen = C.Sketch(seed=a.hash_seed), C.Grouping(linkage=a.linkage, least=C.TRIAL_LEAST if a.dev_mode else a.min_cluster_size), C.Screen()
    return C.Settings(
        replace(sketch, lanes=a.num_hashes) if a.num_hashes else sketch,
        grouping,
        replace(screen, alpha=a.alpha, share_alpha=not a.no_bonferroni, combine=a.combination, correction=a.multiplicity, z=a.zscore_threshold, least_confidence=a.min_confidence, draws=a.permutations),
    )


def open_session(a: argparse.Namespace) -> SparkSession:
    spark = session(master=a.master)
    spark.sparkContext.setLogLevel(a.log_level)
    logging.basicConfig(level=getattr(logging, {"WARN": "WARNING"}.get(a.log_level, a.log_level)))
    return spark


def cmd_run(a: argparse.Namespace) -> int:
    spark = open_session(a)
    try:
        raw = parse_fasta(spark, a.fasta)
    except FileNotFoundError:
        print(f"no such file: {a.fasta}", file=sys.stderr)
        return 1
    p = Pipeline(Store(spark, a.db), settings_of(a))
    p.initialize(a.allow_param_change)
    detect = not a.no_reassortment
    if a.mode == "incremental":
        out = p.run_incremental(raw, a.subtype, a.cluster_version, detect)
    elif a.mode == "recluster":
        out = p.run_recluster(raw, a.subtype, a.cluster_version, detect)
    else:
        out = p.run(raw, a.subtype, a.cluster_version or "v1", detect)
    stem = f"{a.out_dir}/{PurePosixPath(a.fasta).stem}_{a.mode}"
    if not a.no_tsv and "profiles" in out:
        E.write_tsv(E.genotypes_tsv(out["profiles"]), f"{stem}_genotypes.tsv")
        if a.mode == "incremental":
            E.write_tsv(E.orphan_counts_tsv(out["assignments"]), f"{stem}_orphans.tsv", True)
        else:
            E.write_tsv(E.clusters_tsv(out["clusters"]), f"{stem}_clusters.tsv")
            E.write_tsv(E.orphans_tsv(out["assignments"]), f"{stem}_orphans.tsv")
        if "events" in out:
            E.write_tsv(E.events_tsv(out["events"]), f"{stem}_reassortment.tsv")
            if a.validate_reassortment:
                E.write_tsv(E.validation_tsv(p.validate_reassortments(out["events"], out["long"], a.permutations), a.permutations), f"{stem}_validation.tsv")
    E.write_summary(spark, out["summary"], f"{stem}_summary.json")
    print(E.run_report(out["summary"]))
    return 0


def cmd_repair(a: argparse.Namespace) -> int:
    store = Store(open_session(a), a.db)
    p = Pipeline(store, C.Settings(store.sketch() or C.Sketch()))
    p.initialize()
    print(E.repair_report(a.segment, a.correct_subtype, a.misnamed_allele, p.repair_allele_subtype(a.segment, a.correct_subtype, a.misnamed_allele, a.cluster_version, a.dry_run)))
    return 0


def main(argv: list[str] | None = None) -> int:
    a = build_parser().parse_args(argv)
    return cmd_run(a) if a.command == "run" else cmd_repair(a)


if __name__ == "__main__":
    sys.exit(main())
