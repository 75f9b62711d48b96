import json

import pytest
from genomes import genomes

from octoseg import cli
from octoseg import config as C
from octoseg.plans.pipeline import Pipeline
from octoseg.sources.store import SignatureFingerprintMismatch, Store
from octoseg.streaming.ingest import ingest_stream


def small(lanes: int = 64) -> C.Settings:
    return C.Settings(C.Sketch(lanes=lanes), C.Grouping(least=2, same={s: 0.8 for s in C.SEGMENTS}))


def frame(spark, records):
    return spark.createDataFrame([("f", i, h, s) for i, (h, s) in enumerate(records)], "file string, pos int, header string, seq string")


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    p = Pipeline(Store(spark, str(tmp_path_factory.mktemp("store"))), small())
    p.initialize()
    return p, p.run(frame(spark, genomes(4)), version="v1")


def test_batch_finds_both_lineages(batch):
    p, out = batch
    s = out["summary"]
    assert (s["total_isolates"], s["complete_genomes"], s["total_clusters"]) == (8, 8, 16)
    rows = out["profiles"].select("sequence_id", "profile_string", "allele_string", "constellation_id").collect()
    assert len({r["profile_string"] for r in rows}) == 2 == len({r["constellation_id"] for r in rows})
    assert all(r["constellation_id"].startswith("H3N2-") for r in rows)
    seg = p.store.rows("segment_kmers")
    assert seg.count() == 64 and seg.where("cluster_id is null or allele_id is null or is_orphan <> 0").isEmpty()
    assert p.store.rows("allele_registry").count() == 16


def test_order_of_records_does_not_matter(spark, batch, tmp_path):
    p = Pipeline(Store(spark, str(tmp_path / "s")), small())
    p.initialize()
    again = p.run(frame(spark, genomes(4)[::-1]), version="v1", detect=False)
    a, b = ({r[0]: r[1] for r in o["profiles"].select("sequence_id", "allele_string").collect()} for o in (batch[1], again))
    assert a == b


def test_incremental_then_repair(spark, batch):
    p, _ = batch
    more = genomes(2, names="new")
    out = p.run_incremental(frame(spark, more + genomes(4)), detect=False)
    assert out["summary"]["total_isolates"] == 4 and out["summary"]["total_orphans"] == 0
    assert out["profiles"].select("constellation_id").distinct().count() == 2
    assert p.run_incremental(frame(spark, more), detect=False)["summary"]["total_isolates"] == 0
    assert p.store.rows("clusters").where("is_active = 1").agg({"member_count": "sum"}).first()[0] == 96
    # counts and last_seen of names that were known before are those of the last run
    seen = p.store.rows("allele_registry").where("segment_name = 'HA'").select("member_count", "first_seen", "last_seen").collect()
    assert all(r["member_count"] == 2 and r["last_seen"] > r["first_seen"] for r in seen)
    assert all(r["member_count"] == 2 for r in p.store.rows("constellation_registry").select("member_count").collect())
    assert p.store.rows("clustering_runs").select("mode").distinct().count() == 2
    name = p.store.rows("segment_kmers").where("segment_name = 'HA'").orderBy("sequence_id").first()["allele_id"]
    dry = p.repair_allele_subtype("HA", "H3N2", name, "v1", True)
    assert dry == {"affected": 6, "new_allele": None}
    done = p.repair_allele_subtype("HA", "H3N2", name, "v1")
    assert done["affected"] == 6 and done["new_allele"] != name and done["retired_constellations"] == 1
    assert p.affected_by("HA", "H3N2", name, "v1").isEmpty()
    assert p.store.rows("genotypes").where(f"allele_profile like '%{done['new_allele']}%'").count() == 6


def test_a_named_version_is_the_one_used(spark, batch):
    """Clusters of another version, newer or not, take no part in a run that names one."""
    p, _ = batch
    t = p.store.rows("clusters").where("version = 'v1'")
    from pyspark.sql import functions as F

    p.store.put("clusters", t.withColumns({"version": F.lit("v9"), "created_at": F.lit("9999"), "cluster_id": F.concat(F.lit("X"), "cluster_id"), "member_count": F.lit(0)}))
    count = lambda v: p.store.rows("clusters").where(F.col("version") == v).agg(F.sum("member_count")).first()[0]
    before = count("v1")
    out = p.run_incremental(frame(spark, genomes(1, names="ver")), version="v1", detect=False)
    assert {r[0][0] for r in out["assignments"].select("cluster_id").distinct().collect()} == {"C"}
    assert count("v1") == before + 16 and count("v9") == 0
    out = p.run_incremental(frame(spark, genomes(1, names="new9")), detect=False)
    assert {r[0][0] for r in out["assignments"].select("cluster_id").distinct().collect()} == {"X"} and count("v9") == 16
    p.store.update("clusters", p.store.rows("clusters").where("version = 'v9'").withColumn("is_active", F.lit(0)), ["is_active"])


def test_other_parameters_are_refused(spark, batch):
    cfg = small(32)
    with pytest.raises(SignatureFingerprintMismatch, match="num_hashes: 64 -> 32"):
        Pipeline(batch[0].store, cfg).initialize()
    s = batch[0].store
    Pipeline(s, cfg).initialize(True)
    Pipeline(s, small()).initialize(True)
    assert s.sketch() == C.Sketch(lanes=64)


def test_stream_adds_each_isolate_once(spark, batch, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.fasta").write_text("".join(f">{h}\n{s}\n" for h, s in genomes(1, names="str")))
    before = batch[0].store.rows("sequences").count()
    for _ in range(2):
        ingest_stream(batch[0], str(src), str(tmp_path / "cp"), detect=False).awaitTermination()
    assert batch[0].store.rows("sequences").count() == before + 2


def test_command_line(spark, tmp_path):
    f = tmp_path / "g.fasta"
    f.write_text("".join(f">{h}\n{s}\n" for h, s in genomes(2)))
    assert cli.main(["run", str(tmp_path / "none.fasta")]) == 1
    args = ["run", str(f), "--db", str(tmp_path / "db"), "--out-dir", str(tmp_path / "out"), "--num-hashes", "64", "--dev-mode", "--no-reassortment"]
    assert cli.main(args) == 0
    got = json.loads((tmp_path / "out" / "g_batch_summary.json").read_text())
    assert got["total_isolates"] == 4
    head = next((tmp_path / "out" / "g_batch_genotypes.tsv").glob("part-*.csv")).read_text().splitlines()[0]
    assert head.split("\t") == ["sequence_id", "profile_string", "allele_string", "constellation_id", "completeness", "is_complete", "missing_segments", "orphan_segments"]
