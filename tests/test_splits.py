"""Training splits without leaks."""

import pytest
from pyspark.sql import functions as F

from sparkloom.plans import splits as S


def pairs(spark, n=40, shared=False):
    rows = []
    for i in range(n):
        path = "same" if shared and i in (0, 1) else f"p{i}"
        rows.append((f"id{i:03d}", f"{i % 128}-{(i * 7) % 128}-0", path, "x", "x", "x", "a", "True", f"Piece {i // 2 if i < 20 else i} (live) mvt II", f"Artist & Co {i // 2 if i < 20 else i}", "c"))
    return spark.createDataFrame(rows, "pair_id string, tracks string, pdmx_path string, mxl_path string, pdf_path string, mid_path string, hf_audio_path string, eligible_exact_pair string, title string, artist string, composer string")


def test_manifest(spark):
    m = S.training_manifest(pairs(spark), 4, 5, 3, 6)
    rows = m.collect()
    assert len(rows) == 40 and len({r.work_cluster_id for r in rows}) == 30
    by = {}
    for r in rows:
        by.setdefault(r.cluster_split, set()).add(r.work_cluster_id)
    assert {k: len(v) for k, v in by.items()} == {"rare_challenge": 3, "strict_dev": 4, "sealed_test": 5, "human_review_queue": 6, "train": 12}
    assert sum(r.is_cluster_representative for r in rows) == 30
    assert all((r.eval_role == "none") == (r.split == "train") for r in rows)
    assert S.leaks(m).count() == 0
    assert sorted(map(str, S.training_manifest(pairs(spark), 4, 5, 3, 6).collect())) == sorted(map(str, rows))
    balance = {r.program: r for r in S.program_balance(m).collect()}
    assert balance[0].records_present == 40 and balance[0].record_fraction == "1.00000000"
    families = {r.family: r for r in S.family_balance(m).collect()}
    assert families["keys"].occurrences >= 40 and families["keys"].record_fraction == "1.00000000"
    assert S.keys_risk(S.family_balance(m)) == (families["keys"].records_present > 2 * max(1, families["guitar"].records_present)) is True
    out = S.training_output(m)
    assert len(out.columns) == 37 and S.checked(out, 4, 5, 3, 6).count() == 40
    for wrong in (out.limit(39), out.withColumn("alignment_gate", F.lit("FAIL")), out.withColumn("model_pseudo_label", F.lit(1)), out.withColumn("work_cluster_id", F.lit("w"))):
        with pytest.raises(ValueError):
            S.checked(wrong, 4, 5, 3, 6)
    assert {n: out.filter(t).count() for n, t in S.FAN.items()}["dev"] == 4
    cover = S.coverage(m)
    assert cover["records"] == 40 and cover["rare_gm_programs_under_1pct"] == [] and cover["risk_flags"]["keys_overrepresentation"]


def test_shared_arrangement_leaks(spark):
    rows = pairs(spark, 40, True).withColumn("title", F.when(F.col("pair_id") == "id000", "Other").otherwise(F.col("title")))
    m = S.training_manifest(rows, 4, 5, 3, 6)
    at = {r.pair_id: r.cluster_split for r in m.filter("pdmx_path = 'same'").collect()}
    assert set(at) == {"id000", "id001"} and len({r.work_cluster_id for r in m.filter("pdmx_path = 'same'").collect()}) == 2
    leaked = S.leaks(m.withColumn("cluster_split", F.when(F.col("pair_id") == "id000", "train").when(F.col("pair_id") == "id001", "strict_dev").otherwise(F.col("cluster_split"))))
    assert {r.key_name for r in leaked.collect()} >= {"arrangement_cluster_id", "audio_variant_cluster_id"}


def test_programs_from_the_second_column(spark):
    rows = pairs(spark).withColumn("raw_gm_programs_0based", F.lit("7 9")).withColumn("tracks", F.when(F.col("pair_id") == "id003", "").otherwise(F.col("tracks")))
    assert S.clustered(rows).filter("pair_id = 'id003'").first().programs == [7, 9]


def test_bad_input(spark):
    for bad in (pairs(spark).union(pairs(spark).limit(1)), pairs(spark).replace({"0-0-0": ""}, subset=["tracks"]), pairs(spark).replace({"True": "no"}, subset=["eligible_exact_pair"]), pairs(spark).replace({"True": "y"}, subset=["eligible_exact_pair"])):
        with pytest.raises(ValueError):
            S.training_manifest(bad, 1, 1, 1, 1)
    with pytest.raises(ValueError):
        S.training_manifest(pairs(spark), 100, 150, 50, 500)


def test_titles():
    assert S.plain("Blue  Suède (Remastered) & Live!") == "blue suède and"
    assert S.plain(None) == ""
