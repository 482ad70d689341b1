import math
import shutil

import duckdb
import pytest
from test_packing import check as check_bins
from test_simhash import brute_components
from test_toxicity import slow_evidence

SF = "/root/testdata/sf0.001"


@pytest.fixture
def tables(tmp_path):
    import os

    if not os.path.exists(SF):
        pytest.skip("test data isn't here")
    for t in ("documents", "labels"):
        shutil.copy(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_stages_as_by_brute_force(spark, tables):
    """Quality by its SQL, toxicity by positions in clauses, near copies by comparing all pairs, bins by their rules."""
    import corpus_pipeline as C
    from sparkloom.llm import packing, quality, toxicity

    assert [n for n, _ in C.STAGES] == ["quality", "toxicity", "simhash", "packing"] and C.ORACLE_SQL is None
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    documents = docs.toPandas()  # noqa: F841
    good = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM ({quality.ORACLE}) WHERE kept").fetchall()}
    assert 0 < len(good) < docs.count()
    lexicon, a, b = toxicity.learn(docs.filter(docs.doc_id.isin(list(good))), labels)
    rows = [r for r in docs.collect() if r.doc_id in good]
    odds = {r.doc_id: a + b * min(slow_evidence(r.text or "", lexicon), 30.0) for r in rows}
    clean = [r for r in rows if 1 / (1 + math.exp(-max(-30.0, min(30.0, odds[r.doc_id])))) < 0.3]
    assert 0 < len(clean) < len(rows)
    once = {i for i, _, c in brute_components([(r.doc_id, r.text) for r in clean]) if i == c}
    assert 0 < len(once) < len(clean)
    got = C.run(spark, tables).collect()
    assert {r.doc_id for r in got} == once
    check_bins(got, [r for r in clean if r.doc_id in once], packing.CAPACITY, 4)
