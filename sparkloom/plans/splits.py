"""Leak-free training splits of score-audio pairs: work clusters, rarity, allocation, audits."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import coerce as c
from ..functions.families import family_table
from ..operators import aggregates, selection
from ..session import ship, written

REQUIRED = ("pair_id", "tracks", "pdmx_path", "mxl_path", "pdf_path", "mid_path", "hf_audio_path", "eligible_exact_pair")
#: Texts that say a pair is eligible.
ELIGIBLE = ("true", "1", "yes")
#: Grades of labels, and what is said of pairs whose audio is made from their score.
SYNTHETIC, PSEUDO = "SYNTH_RENDERED_MIDI", "MODEL_PSEUDO_LABEL"
CLAIMS = {"label_grade": SYNTHETIC, "supervised_ground_truth_eligible": 1, "model_pseudo_label": 0, "alignment_class": "EXACT_BY_CONSTRUCTION", "alignment_gate": "PASS", "alignment_method": "same_source_midi_synthesis", "dtw_required": 0, "manual_alignment_required": 0}
POLICIES = {"rights_gate": "PASS_PDMX_NO_LICENSE_CONFLICT", "feature_policy": "compressed_audio_5s_on_the_fly"}
#: Words that name a version of a work rather than the work, and movement words.
VERSION_WORDS = re.compile(r"\b(?:arr(?:angement|anged)?|transcription|orchestration|version|ver\.?|mix|master|remaster(?:ed)?|live|cover|instrumental)\b")
MOVEMENT = re.compile(r"\b(?:movement|mov|mvt)\s*[ivxlcdm\d]+\b.*$")


def plain(text: str | None) -> str:
    """Compatibility-normalised, case-folded words of a title, without version words and marks."""
    folded = unicodedata.normalize("NFKC", text or "").casefold().replace("&", " and ")
    return " ".join(re.sub(r"\W+", " ", VERSION_WORDS.sub(" ", folded)).split())


def _plain(texts: pa.Array) -> pa.Array:
    return pa.array([plain(t) for t in texts.to_pylist()], pa.string())


def _root(texts: pa.Array) -> pa.Array:
    return pa.array([MOVEMENT.sub("", plain(t)).strip() for t in texts.to_pylist()], pa.string())


def _text(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) if name in df.columns else F.lit("")


def clustered(pairs: DataFrame) -> DataFrame:
    """pairs with programs, creator, work_cluster_id, its basis, and arrangement_cluster_id."""
    ship(pairs.sparkSession)
    missing = set(REQUIRED) - set(pairs.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")
    creator = F.trim(F.when(_text(pairs, "artist") != "", _text(pairs, "artist")).otherwise(_text(pairs, "composer")))
    rows = pairs.withColumn("creator", creator).withColumn("__t", F.arrow_udf(_root, "string")(_text(pairs, "title")))
    rows = rows.withColumn("__c", F.arrow_udf(_plain, "string")(F.col("creator")))
    basis = F.when(F.col("__t") != "", F.concat_ws("|", F.lit("title_creator_v2"), "__c", "__t")).otherwise(F.concat(F.lit("pair_fallback_v2|"), F.col("pair_id").cast("string")))
    own = F.when(_text(pairs, "pdmx_path") != "", _text(pairs, "pdmx_path")).when(_text(pairs, "mid_path") != "", _text(pairs, "mid_path")).otherwise(F.col("pair_id").cast("string"))
    rows = rows.withColumn("work_cluster_basis", basis)
    rows = rows.withColumn("work_cluster_id", F.concat(F.lit("work-"), c.short_hash(F.col("work_cluster_basis"), 16)))
    rows = rows.withColumn("arrangement_cluster_id", F.concat(F.lit("arr-"), c.short_hash(own, 16)))
    rows = rows.withColumn("audio_variant_cluster_id", F.col("arrangement_cluster_id"))
    said = F.when(_text(pairs, "tracks") != "", _text(pairs, "tracks")).otherwise(_text(pairs, "raw_gm_programs_0based"))
    return rows.withColumn("programs", c.parse_numbers(said, max_digits=None)).drop("__t", "__c")


def training_manifest(pairs: DataFrame, dev: int = 100, sealed: int = 150, rare: int = 50, review: int = 500) -> DataFrame:
    """One row for each pair with cluster_split, split, eval_role and rarity.

    Raises on repeated pair ids, rows without programs, ineligible rows, or too few clusters.
    """
    rows = written(clustered(pairs), "clustered")
    bad = rows.agg(F.count("*") - F.countDistinct("pair_id"), F.count(F.when(F.size("programs") == 0, 1)), F.count(F.when(~F.coalesce(F.lower("eligible_exact_pair").isin(*ELIGIBLE), F.lit(False)), 1)), F.count("*")).first()
    if any(bad[:3]):
        raise ValueError(f"{bad[0]} repeated pair ids, {bad[1]} rows without programs, {bad[2]} ineligible rows")
    long = rows.select("pair_id", F.explode(F.array_distinct("programs")).alias("program"))
    scores = aggregates.rarity(long, "pair_id", "program", max(bad[3], 1)).withColumnRenamed("rarity", "rarity_score")
    rows = written(rows.join(scores, "pair_id"), "scored")
    reps = selection.representative(rows, "work_cluster_id", [F.desc("n_items"), F.desc("rarity_score"), F.asc("pair_id")])
    reps = written(reps.select("work_cluster_id", F.col("pair_id").alias("rep_id"), "n_items", "rarity_score"), "reps")
    hashed = F.sha2(F.concat(F.lit("rare|"), F.col("work_cluster_id")), 256)
    order = [F.desc("rarity_score"), F.desc("n_items"), hashed]
    split = selection.allocate(reps, "work_cluster_id", [("rare", rare, order)], [("dev", dev), ("sealed", sealed), ("review", review)])
    names = {"rare": "rare_challenge", "dev": "strict_dev", "sealed": "sealed_test", "review": "human_review_queue", "train": "train"}
    named = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    split = split.select("work_cluster_id", F.element_at(named, F.col("split")).alias("cluster_split")).join(reps.select("work_cluster_id", "rep_id"), "work_cluster_id")
    out = rows.join(split, "work_cluster_id")
    is_rep, kind = F.col("pair_id") == F.col("rep_id"), F.col("cluster_split")
    role = F.when(kind == "train", "none").when(~is_rep, "cluster_sibling_holdout").when(kind == "human_review_queue", "human_review_candidate").otherwise(kind)
    rare_text = F.array_join(F.transform("rare_items", lambda p: p.cast("string")), "-")
    return out.withColumns({"split": F.when(kind == "train", "train").otherwise("holdout"), "eval_role": role, "is_cluster_representative": is_rep.cast("int"), "rare_programs_0based": rare_text, "distinct_gm_programs": F.col("n_items")}).drop("rep_id", "rare_items", "n_items")


def training_output(manifest: DataFrame) -> DataFrame:
    """The 37 columns of the training manifest, in order of work cluster and pair."""
    df, text = manifest, lambda name: _text(manifest, name)
    fields = {
        "pair_id": F.col("pair_id"), **{k: F.lit(v) for k, v in CLAIMS.items()},
        **{k: F.col(k) for k in ("work_cluster_id", "work_cluster_basis", "arrangement_cluster_id", "audio_variant_cluster_id", "cluster_split", "split", "eval_role", "is_cluster_representative")},
        "title": text("title"), "creator": F.col("creator"), "composer_or_arranger": text("composer"), "genres": text("genres"), "tags": text("tags"),
        "gm_programs_0based": text("tracks"), "distinct_gm_programs": F.col("distinct_gm_programs"), "rarity_score": F.col("rarity_score"), "rare_programs_0based": F.col("rare_programs_0based"),
        **{k: text(k) for k in ("pdmx_path", "mxl_path", "pdf_path", "mid_path")},
        "audio_path": text("hf_audio_path"), "audio_source": text("audio_source"), "score_source": text("score_source"),
        "license": text("pdmx_license"), "license_url": text("pdmx_license_url"), **{k: F.lit(v) for k, v in POLICIES.items()},
    }
    return df.select(*[v.alias(k) for k, v in fields.items()]).orderBy("work_cluster_id", "pair_id")


def split_tests(output: DataFrame, dev: int, sealed: int, rare: int, review: int) -> DataFrame:
    """One row of facts about a training manifest that must hold before it is used: label grades, alignment gates, leaks and holdout counts; `passed` is all of them."""
    role = lambda name: F.count_if(F.col("eval_role") == name)
    one = output.agg(
        F.count("*").alias("rows"),
        (F.count_if((F.col("label_grade") == PSEUDO) | (F.col("model_pseudo_label") != 0)) == 0).alias("pseudo_labels_excluded"),
        (F.count_if(F.col("alignment_gate") != "PASS") == 0).alias("all_alignment_pass"),
        ((role("strict_dev") == dev) & (role("sealed_test") == sealed) & (role("rare_challenge") == rare)).alias("strict_eval_requested"),
        (role("human_review_candidate") == review).alias("human_review_queue_requested"),
    )
    leaked = leaks(output).agg((F.count("*") == 0).alias("cluster_leakage_zero"))
    tests = ("pseudo_labels_excluded", "all_alignment_pass", "strict_eval_requested", "human_review_queue_requested", "cluster_leakage_zero")
    out = one.join(leaked)  # one row with one row
    passed = F.lit(True)
    for t in tests:
        passed = passed & F.col(t)
    return out.withColumn("passed", passed)


def checked(output: DataFrame, dev: int = 100, sealed: int = 150, rare: int = 50, review: int = 500) -> DataFrame:
    """A training manifest that passes `split_tests`; raises ValueError with what failed."""
    row = split_tests(output, dev, sealed, rare, review).first().asDict()
    failed = sorted(k for k, v in row.items() if v is False and k != "passed")
    if failed:
        raise ValueError(f"not fit for training: {failed}")
    return output


#: Outputs of a training manifest by a test each.
FAN = {
    "train": "cluster_split = 'train'",
    "dev": "eval_role = 'strict_dev'",
    "sealed_test": "eval_role = 'sealed_test'",
    "rare_challenge": "eval_role = 'rare_challenge'",
    "human_review_queue": "eval_role = 'human_review_candidate'",
    "cluster_sibling_holdouts": "eval_role = 'cluster_sibling_holdout'",
}
QUARANTINE = "pair_id string, source string, reason string, label_grade string"


def coverage(manifest: DataFrame) -> dict:
    """Presence of families, programs in under 1 % of the pairs (at just 1 % a program isn't rare here), and risk flags."""
    n = manifest.count()
    long = manifest.select("pair_id", F.explode(F.array_distinct("programs")).alias("program"))
    rare = sorted(r.program for r in aggregates.rare_items(long, "pair_id", "program", n).collect())  # of 128 programs
    families = family_balance(manifest)
    return {"records": n, "family_record_presence": {r.family: r.records_present for r in families.orderBy("family").collect()}, "rare_gm_programs_under_1pct": rare, "rare_gm_program_count": len(rare), "risk_flags": {"keys_overrepresentation": keys_risk(families)}}


def leaks(manifest: DataFrame) -> DataFrame:
    """Keys of works, arrangements and audio that are in more than one split: none, if all is well."""
    return aggregates.leak_audit(manifest, ["work_cluster_id", "arrangement_cluster_id", "audio_variant_cluster_id"], "cluster_split")


def program_balance(manifest: DataFrame) -> DataFrame:
    """(program, records_present, occurrences, record_fraction) over all pairs, most frequent first."""
    long = manifest.select("pair_id", F.explode(c.multiset(F.col("programs"))).alias("x")).select("pair_id", F.col("x.k").alias("program"), F.col("x.v").alias("n"))
    return aggregates.presence(long, "pair_id", "program", "n", manifest.count()).orderBy(F.desc("records_present"), "program")


def family_balance(manifest: DataFrame) -> DataFrame:
    """(family, records_present, occurrences, record_fraction) under the overlapping balance families, most frequent first."""
    long = manifest.select("pair_id", F.explode(c.multiset(F.col("programs"))).alias("x")).select("pair_id", F.col("x.k").alias("program"), F.col("x.v").alias("n"))
    totals = aggregates.family_totals(long, family_table(manifest.sparkSession, "balance"), "pair_id", "program", "n")
    fraction = F.format_string("%.8f", F.col("records_present") / F.lit(max(manifest.count(), 1)))
    return totals.withColumn("record_fraction", fraction).orderBy(F.desc("records_present"), "family")


def keys_risk(families: DataFrame) -> bool:
    """Whether keyboards are in more than twice as many records as guitars (one at least)."""
    n = {r.family: r.records_present for r in families.collect()}  # ten rows
    return n.get("keys", 0) > 2 * max(1, n.get("guitar", 0))
