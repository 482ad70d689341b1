"""The catalogue, split and score plans applied to whole tables, each with the SQL that says the same.

The driver's tables have no wide metadata, so a wide table of text columns is derived from customers
and the first lines of their orders: a line is a track, its part names the program.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.families import FAMILIES
from ..operators import aggregates, gates
from . import catalogue, rules, scores, splits
from .queries import _query, _t

#: Program of a line of customer k, and columns of the wide table over k, n (tracks), notes and tracks: the same text in both dialects.
PROGRAM = "CASE k % 5 WHEN 0 THEN 40 + l_partkey % 40 WHEN 1 THEN 40 + l_partkey % 10 WHEN 2 THEN 56 + l_partkey % 24 WHEN 3 THEN 40 + l_partkey % 34 ELSE l_partkey % 128 END"
WIDE = {
    "path": "CASE WHEN k % 97 = 3 THEN '' ELSE './data/Score No_' || CAST(k AS STRING) || '.mscz' END",
    "mxl": "'./mxl/' || CAST(k AS STRING) || '.mxl'",
    "pdf": "CASE WHEN k % 89 = 5 THEN 'N/A' ELSE './pdf/' || CAST(k AS STRING) || '.pdf' END",
    "mid": "'./mid/' || CAST(k AS STRING) || '.mid'",
    "n_tracks": "CAST(n AS STRING)",
    "tracks": "tracks",
    "n_notes": "CASE WHEN k % 23 = 1 THEN '' ELSE CAST(notes AS STRING) || '.7' END",
    "song_length.bars": "CASE WHEN k % 7 = 0 THEN '' ELSE CAST(n * 9 AS STRING) END",
    "song_length.seconds": "CAST(n * 21 AS STRING)",
    "subset:no_license_conflict": "CASE WHEN k % 11 = 0 THEN 'False' ELSE 'True' END",
    "subset:all_valid": "CASE WHEN k % 13 = 0 THEN 'no' ELSE '1' END",
    "subset:deduplicated": "CASE WHEN k % 3 = 0 THEN 'False' ELSE 'TRUE' END",
    "is_best_unique_arrangement": "CASE k % 6 WHEN 0 THEN 'maybe' WHEN 1 THEN 'f' ELSE 'y' END",
    "has_paywall": "CASE WHEN k % 17 = 0 THEN 'yes' ELSE 'False' END",
    "is_draft": "CASE WHEN k % 19 = 0 THEN 't' ELSE '' END",
    "is_official": "CASE WHEN k % 4 = 0 THEN 'true' ELSE '0' END",
    "has_annotations": "CASE WHEN k % 6 = 0 THEN 'true' ELSE '0' END",
    "has_custom_audio": "CASE WHEN k % 10 = 0 THEN 'true' ELSE '0' END",
    "title": "CASE k % 10 WHEN 0 THEN 'Symphony Orchestra' WHEN 1 THEN 'String Orchestra' WHEN 2 THEN 'Wind Orchestra in C' WHEN 3 THEN 'Opera for Choir' WHEN 4 THEN 'Suite' WHEN 5 THEN 'Jazz blues' WHEN 6 THEN 'Solo Piano piece' WHEN 7 THEN 'Rock Band' WHEN 8 THEN 'Song' ELSE 'nan' END",
    "song_name": "'Work ' || CAST(CAST(floor(k / 4.0) AS BIGINT) AS STRING)",
    "subtitle": "CASE WHEN k % 8 = 1 THEN 'Full Score' ELSE '' END",
    "genres": "CASE k % 9 WHEN 0 THEN 'classical' WHEN 1 THEN 'jazz' ELSE 'none' END",
    "groups": "CASE WHEN k % 12 = 0 THEN 'orchestra' ELSE '' END",
    "tags": "''",
    "rating": "CAST(k % 6 AS STRING) || '.5'",
    "n_ratings": "CAST(k % 37 AS STRING)",
    "n_views": "'1,' || CAST(100 + k % 900 AS STRING)",
    "composer_name": "'Composer ' || CAST(k % 50 AS STRING)",
    "artist_name": "CASE WHEN k % 2 = 0 THEN 'Artist ' || CAST(k % 40 AS STRING) ELSE '' END",
    "license": "'cc0'",
    "license_url": "'null'",
    "best_arrangement": "CASE WHEN k % 2 = 0 THEN './data/' || CAST(CAST(floor(k / 6.0) AS BIGINT) AS STRING) || '.mscz' ELSE '' END",
}


def wide(spark, sf_dir) -> DataFrame:
    first = _t(spark, sf_dir, "lineitem").filter("l_linenumber = 1").select("l_orderkey", "l_partkey", "l_quantity")
    lines = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("l_orderkey")).join(first, "l_orderkey")
    own = lines.select("k", "l_orderkey", "l_partkey", "l_quantity", F.expr(PROGRAM).alias("p"))
    rows = own.groupBy("k").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "p"))), lambda x: x["p"].cast("string")), "-").alias("tracks"),
        F.count("*").alias("n"),
        (F.sum("l_quantity") * 20).cast("long").alias("notes"),
    )
    return rows.select(*[F.expr(e).alias(name) for name, e in WIDE.items()])


_WIDE = f"""
wl AS (SELECT o_custkey AS k, l_orderkey, l_partkey, l_quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber = 1),
wp AS (SELECT *, {PROGRAM} AS p FROM wl),
wk AS (SELECT k, string_agg(p::VARCHAR, '-' ORDER BY l_orderkey, p) AS tracks, count(*) AS n, (sum(l_quantity) * 20)::BIGINT AS notes FROM wp GROUP BY k),
wide AS (SELECT {', '.join(f'{e} AS "{name}"' for name, e in WIDE.items())} FROM wk)"""
_NULLS = "('', 'nan', 'na', 'n/a', 'none', 'null')"


def _f(*names: str) -> str:
    """SQL of the first column that says something."""
    return "coalesce(" + ", ".join(f'CASE WHEN lower("{n}") NOT IN {_NULLS} THEN "{n}" END' for n in names) + ", '')"


def _yes(name: str) -> str:
    return f"""lower("{name}") IN ('1', 'true', 't', 'yes', 'y')"""


def _int(name: str) -> str:
    return f"""coalesce(trunc(try_cast(replace("{name}", ',', '') AS DOUBLE))::BIGINT, 0)"""


def _num(name: str) -> str:
    return f"""coalesce(try_cast(replace("{name}", ',', '') AS DOUBLE), 0)"""


def _any(text: str, terms: list[str]) -> str:
    listed = ", ".join("'" + t.lower().replace("'", "''") + "'" for t in terms)
    return f"len(list_filter([{listed}], lambda term: contains({text}, term))) > 0"


def _in(mapping: str, *names: str) -> str:
    """SQL of how many programs of the list p are in families, once for each."""
    parts = []
    for name, ranges in FAMILIES[mapping]:
        if name in names:
            test = " OR ".join(f"x BETWEEN {lo} AND {hi}" for lo, hi in ranges)
            parts.append(f"len(list_filter(p, lambda x: {test}))")
    return "(" + " + ".join(parts) + ")"


def _one_of(mapping: str, name: str) -> str:
    """As `_in`, where the first family that matches counts."""
    cases = " ".join(f"WHEN {' OR '.join(f'x BETWEEN {lo} AND {hi}' for lo, hi in ranges)} THEN '{n}'" for n, ranges in FAMILIES[mapping])
    return f"len(list_filter(p, lambda x: CASE {cases} END = '{name}'))"


def _json(values: dict[str, str]) -> str:
    return "'{' || concat_ws(',', " + ", ".join(f"""CASE WHEN {values[k]} > 0 THEN '"{k}":' || {values[k]} END""" for k in sorted(values)) + ") || '}'"


def _pairs(values: dict[str, str]) -> str:
    return "concat_ws(';', " + ", ".join(f"""CASE WHEN {values[k]} > 0 THEN '{k}:' || {values[k]} END""" for k in sorted(values)) + ")"


_TEXT = "lower(concat_ws(' | ', " + ", ".join(_f(x) for x in catalogue.TEXT) + "))"
_P3 = "list_transform(list_filter(regexp_extract_all(tracks, '[0-9]+'), lambda x: length(x) <= 3 AND x::INT <= 127), lambda x: x::INT)"
_RIGHTS = "CASE WHEN NOT {0} THEN 'license_conflict_or_unknown' WHEN NOT {1} THEN '{{0}}' WHEN {2} THEN 'paywalled' WHEN {3} THEN 'draft' WHEN {{2}} THEN '{{1}}' ELSE 'ok' END".format(_yes("subset:no_license_conflict"), _yes("subset:all_valid"), _yes("has_paywall"), _yes("is_draft"))
_GROUP = "CASE WHEN best_arrangement <> '' THEN '{}' || substr(sha256(best_arrangement), 1, 20) ELSE {} END"


# -- ranked ------------------------------------------------------------------------------------------------

_NAMED = {f: f"CASE WHEN {_in('ranked', f)} > 0 THEN {_in('ranked', f)} WHEN {_any('lower(tracks)', terms)} THEN 1 ELSE 0 END" for f, terms in catalogue.NAME_TERMS.items()}
_PATH4 = _f("path", "mxl", "mid", "pdf")
_STEM = f"substr(regexp_replace(regexp_replace(regexp_replace(regexp_extract({_PATH4}, '[^/]*$'), '[.][^.]*$', ''), '[^A-Za-z0-9._-]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 32)"
_RANKED = f"""
WITH {_WIDE},
r0 AS (SELECT *, {_TEXT} || ' | ' || lower(tracks) AS t, {_P3} AS p, {_int('n_tracks')} AS nt, {_int('n_notes')} AS nn, {_num('song_length.bars')} AS nb, {_num('song_length.seconds')} AS ns,
              {_RIGHTS.format('missing_mxl_pdf_or_midi', 'missing_paths', f"{_f('mxl')} = '' OR {_f('pdf')} = '' OR {_f('mid')} = ''")} AS barred,
              {_STEM} || '-' || substr(sha256({_PATH4}), 1, 16) AS record_id, {_yes('subset:deduplicated')} AS is_dedup FROM wide),
r1 AS (SELECT *, {', '.join(f'{e} AS {f}' for f, e in _NAMED.items())},
              {_any('t', catalogue.ORCHESTRA_TERMS)} AS so, {_any('t', catalogue.WIND_TERMS)} AS sw, {_any('t', catalogue.STRING_TERMS)} AS ss, {_any('t', catalogue.FULL_SCORE_TERMS)} AS sf,
              {_any('t', [*catalogue.EXCLUDE_TERMS, *catalogue.BAND_TERMS])} AS sx FROM r0),
r2 AS (SELECT *, (strings > 0)::INT + (woodwinds > 0)::INT + (brass > 0)::INT + (percussion > 0)::INT AS core, strings + woodwinds + brass + percussion AS orch FROM r1),
r3 AS (SELECT *, CASE WHEN barred <> 'ok' OR nt < 5 OR nn < 200 OR (nb <> 0 AND nb < 12) OR (ns <> 0 AND ns < 25) OR sx THEN 0
              WHEN nt >= 8 AND strings >= 2 AND woodwinds >= 1 AND brass >= 1 AND (guitar_band <= 2 OR so) THEN 1
              WHEN nt >= 5 AND strings >= 3 AND strings / nt >= 0.5 AND guitar_band = 0 AND keyboard <= 1 THEN 2
              WHEN nt >= 6 AND woodwinds >= 2 AND brass >= 2 AND orch - strings >= 5 AND guitar_band <= 1 AND keyboard <= 2 THEN 3
              WHEN so AND nt >= 6 AND core >= 2 AND strings >= 1 THEN 4
              WHEN nt >= 6 AND strings >= 2 AND orch - strings >= 2 AND orch >= 5 AND orch / nt >= 0.55 AND guitar_band <= 1 AND keyboard <= 2 THEN 5
              WHEN nt >= 8 AND strings >= 2 AND core >= 3 AND orch - strings >= 3 AND orch / nt >= 0.5 AND guitar_band <= greatest(1, nt // 4) AND keyboard <= greatest(3, nt // 2) THEN 6
              WHEN nt >= 6 AND strings >= 1 AND core >= 2 AND orch >= 4 AND orch / nt >= 0.5 AND guitar_band <= 1 AND keyboard <= 2 THEN 7 ELSE 0 END AS rule FROM r2),
r4 AS (SELECT *, ['full_orchestra', 'string_orchestra', 'wind_orchestra', 'explicit_orchestra', 'chamber_orchestra', 'inferred_orchestra', 'orchestral_ensemble'][rule] AS orchestra_class,
              CASE rule WHEN 0 THEN NULL WHEN 1 THEN CASE WHEN so OR sf THEN 'A' ELSE 'B' END WHEN 2 THEN CASE WHEN ss AND sf THEN 'A' WHEN ss THEN 'B' ELSE 'C' END
                        WHEN 3 THEN CASE WHEN sw AND percussion > 0 THEN 'A' WHEN sw THEN 'B' ELSE 'C' END WHEN 4 THEN 'B' ELSE 'C' END AS confidence_tier,
              ['string, woodwind and brass sections' || CASE WHEN so OR sf THEN ' with explicit orchestra/full-score metadata' ELSE '' END, 'predominantly multi-part string instrumentation',
               'dense woodwind, brass and percussion instrumentation', 'explicit orchestra metadata and multiple orchestral families',
               'multi-track strings plus additional orchestral tracks with an orchestral-majority palette', 'large score with multi-track strings and at least three orchestral families',
               'six-or-more-track score with an orchestral-majority palette'][rule] AS selection_reason,
              CASE WHEN barred <> 'ok' THEN barred WHEN rule = 0 THEN 'not_orchestral_or_too_small' ELSE 'ok' END AS reason, {_GROUP.format('', 'record_id')} AS duplicate_group_id FROM r3),
ranked AS (SELECT *, CASE WHEN rule > 0 THEN CASE confidence_tier WHEN 'A' THEN 100 WHEN 'B' THEN 70 ELSE 45 END + 0.8::DOUBLE * least(nt, 30) + 6 * core + 1.5::DOUBLE * least(strings, 6) + least(woodwinds, 6) + least(brass, 6)
              + CASE WHEN sf THEN 8 ELSE 0 END + CASE WHEN {_yes('is_official')} THEN 6 ELSE 0 END + CASE WHEN {_yes('has_annotations')} THEN 4 ELSE 0 END
              + 2 * least(greatest({_num('rating')}, 0), 5) + least(2 * log10({_int('n_ratings')} + 1), 6) + least(1.5::DOUBLE * log10({_int('n_views')} + 1), 9) + least(2 * log10(nn + 1), 10)
              - CASE WHEN keyboard > greatest(2, nt // 3) THEN 5 ELSE 0 END - CASE WHEN voice > 0 AND core < 3 THEN 4 ELSE 0 END - 1.5::DOUBLE * least(guitar_band, 4) END AS score,
              concat_ws('|', {', '.join(f"CASE WHEN {f} > 0 THEN '{f}' END" for f in sorted(catalogue.NAME_TERMS))}) AS instrument_families,
              {_json({f: f for f in catalogue.NAME_TERMS})} AS instrument_family_track_counts FROM r4)"""


@_query(_RANKED + """
SELECT mid, reason, orchestra_class, confidence_tier, selection_reason, CASE WHEN rule > 0 THEN printf('%.3f', score) END AS quality_score, instrument_families,
       instrument_family_track_counts, record_id, duplicate_group_id, is_dedup FROM ranked""")
def q_ranked_candidates(spark, sf_dir):
    rows = catalogue.ranked_candidates(wide(spark, sf_dir))
    score = F.when(F.col("quality_score").isNotNull(), F.format_string("%.3f", "quality_score"))
    names = ("reason", "orchestra_class", "confidence_tier", "selection_reason", "instrument_families", "instrument_family_track_counts", "record_id", "duplicate_group_id", "is_dedup")
    return rows.select("mid", *names, score.alias("quality_score"))


TARGET = 10
_CHOSEN = _RANKED + f""",
u1 AS (SELECT * FROM ranked WHERE rule > 0 QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY confidence_tier, NOT is_dedup, -round(score, 3), record_id) = 1),
u2 AS (SELECT * FROM u1 QUALIFY row_number() OVER (PARTITION BY path ORDER BY confidence_tier, NOT is_dedup, -round(score, 3), record_id) = 1),
u3 AS (SELECT *, row_number() OVER (PARTITION BY duplicate_group_id ORDER BY confidence_tier, NOT is_dedup, -round(score, 3), record_id) AS g FROM u2),
u4 AS (SELECT *, CASE WHEN g <= 3 THEN 0 WHEN g <= 10 THEN 1 ELSE 2 END AS stage FROM u3),
chosen AS (SELECT *, row_number() OVER (ORDER BY stage, confidence_tier, NOT is_dedup, -round(score, 3), record_id) AS rank FROM u4 QUALIFY rank <= {TARGET}),
catalogue AS (
  SELECT printf('PDMX-ORCH-%05d', rank) AS match_id, '{catalogue.SOURCE}' AS source, '{catalogue.DOI}' AS source_doi, '{catalogue.URL}' AS source_record_url, record_id AS source_record_id,
         {_f('title', 'song_name')} AS title, {_f('subtitle')} AS subtitle, {_f('composer_name')} AS composer, {_f('artist_name')} AS artist, {_f('license')} AS license, {_f('license_url')} AS license_url,
         orchestra_class, confidence_tier, printf('%.3f', score) AS quality_score, selection_reason, nt AS n_tracks, instrument_families, instrument_family_track_counts, {_f('tracks')} AS tracks,
         {_f('genres')} AS genres, {_f('groups')} AS groups, {_f('tags')} AS tags, ns AS song_length_seconds, nb AS song_length_bars, nn AS n_notes, {_num('rating')} AS rating,
         {_int('n_ratings')} AS n_ratings, {_int('n_views')} AS n_views, {_yes('has_custom_audio')} AS has_custom_audio, mxl AS mxl_path, {_f('pdf')} AS pdf_path, mid AS midi_path,
         '{catalogue.AUDIO_MATCH}' AS audio_match_type, 'render-audio --mid "$ROOT/' || mid[3:] || '" --out "audio/' || record_id || '.wav" --soundfont "$SOUNDFONT"' AS audio_render_recipe,
         '{catalogue.GUARANTEE}' AS symbolic_match_guarantee, true AS subset_no_license_conflict, true AS subset_all_valid, is_dedup AS subset_deduplicated, duplicate_group_id FROM chosen)"""


def _catalogue(spark, sf_dir) -> DataFrame:
    return catalogue.ranked_output(catalogue.ranked_catalogue(wide(spark, sf_dir), TARGET))


@_query(_CHOSEN + "SELECT * FROM catalogue")
def q_ranked_catalogue(spark, sf_dir):
    """The 39 columns of the best rows under caps."""
    return _catalogue(spark, sf_dir).withColumn("quality_score", F.format_string("%.3f", "quality_score"))


@_query(_CHOSEN + f"""
SELECT count(*) AS rows, bool_and(pdf_path <> '' AND midi_path <> '' AND mxl_path <> '') AS paths_present, bool_and(symbolic_match_guarantee = '{catalogue.GUARANTEE}') AS guarantee,
       bool_and(subset_no_license_conflict) AS no_license_conflict, bool_and(subset_all_valid) AS all_valid, true AS deduplicated_known, bool_and(duplicate_group_id <> '') AS groups_present,
       bool_and(confidence_tier IN ('A', 'B', 'C')) AS tiers_known, count(*) = count(DISTINCT match_id) AS unique_match_id, count(*) = count(DISTINCT source_record_id) AS unique_source_record_id,
       count(*) = count(DISTINCT mxl_path) AS unique_mxl_path, count(*) = {TARGET} AS row_count, count(*) = {TARGET} AND count(DISTINCT source_record_id) = {TARGET} AS passed FROM catalogue""")
def q_catalogue_verification(spark, sf_dir):
    return catalogue.verification(_catalogue(spark, sf_dir), TARGET)


@_query(_RANKED + ", x AS (SELECT unnest(string_split(instrument_families, '|')) AS item FROM ranked WHERE rule > 0) SELECT item, count(*) AS rows FROM x WHERE item <> '' GROUP BY 1")
def q_family_list_counts(spark, sf_dir):
    """How often each family is listed."""
    return aggregates.delimited_counts(catalogue.ranked_candidates(wide(spark, sf_dir)).filter("orchestra_class IS NOT NULL"), "instrument_families")


# -- tiered ------------------------------------------------------------------------------------------------

_TF = {name: "(" + " + ".join(_one_of("tiered", f) for f in families) + ")" for name, families in catalogue.TIERED_FAMILIES.items()}
_TIERED = f"""
WITH {_WIDE},
t0 AS (SELECT *, {_TEXT} AS t, {_P3} AS p, {_int('n_tracks')} AS nt, {_int('n_notes')} AS nn, {_num('song_length.bars')} AS nb, {_num('song_length.seconds')} AS ns,
              {_RIGHTS.format('not_all_formats_valid', 'missing_required_path', f"{_f('path')} = '' OR {_f('mxl')} = '' OR {_f('pdf')} = '' OR {_f('mid')} = ''")} AS barred FROM wide),
t1 AS (SELECT *, {', '.join(f'{e} AS {n}' for n, e in _TF.items())}, {_any('t', catalogue.T_ORCHESTRA)} AS so, {_any('t', catalogue.T_STRING)} AS ss, {_any('t', catalogue.T_WIND)} AS sw, {_any('t', catalogue.T_FULL)} AS sf,
              {_any('t', catalogue.T_BAND)} AS sb, {_any('t', catalogue.T_STAGE)} AS st, {_any('t', catalogue.T_REDUCTION)} AS sr, {_any('t', catalogue.T_PART)} AS sp, {_any('t', ['jazz', 'big band', 'marching', 'pep band'])} AS sj FROM t0),
t2 AS (SELECT *, bowed + harp + woodwind + brass + drums AS orch, (bowed + harp > 0)::INT + (woodwind > 0)::INT + (brass > 0)::INT + (drums > 0)::INT AS fam,
              guitar + bass >= greatest(3, nt // 3) AS band, keys >= greatest(4, ceil(nt * 0.55::DOUBLE)) AS keyed FROM t1),
t3 AS (SELECT *, orch / greatest(nt, 1) AS ratio FROM t2),
t4 AS (SELECT *, CASE WHEN barred <> 'ok' THEN -1 WHEN nt < 4 THEN -2 WHEN nn <> 0 AND nn < 120 THEN -3 WHEN nb <> 0 AND nb < 8 THEN -4 WHEN ns <> 0 AND ns < 15 THEN -5 WHEN sr THEN -6 WHEN sp THEN -7
              WHEN nt >= 9 AND bowed >= 3 AND woodwind >= 1 AND brass >= 1 AND orch >= 7 AND ratio >= 0.55 AND NOT band AND NOT sb THEN 1
              WHEN nt >= 5 AND bowed >= 4 AND (bowed + harp) / nt >= 0.6 AND woodwind + brass + saxophone = 0 AND guitar = 0 AND bass <= 1 AND keys <= 1 AND NOT sb THEN 2
              WHEN sw AND nt >= 8 AND woodwind + saxophone >= 3 AND brass >= 3 AND guitar <= 1 AND bass <= 1 AND NOT sj THEN 3
              WHEN voice > 0 AND nt >= 9 AND bowed >= 3 AND woodwind >= 1 AND brass >= 1 AND ratio >= 0.45 AND NOT band THEN 4
              WHEN nt >= 6 AND bowed >= 2 AND fam >= 2 AND orch >= 5 AND ratio >= 0.5 AND guitar <= 1 AND bass <= 1 AND keys <= 2 AND NOT sb THEN 5
              WHEN so AND nt >= 6 AND orch >= 4 AND fam >= 2 AND NOT sb AND NOT band AND NOT keyed THEN 6
              WHEN ss AND nt >= 5 AND bowed >= 3 AND guitar <= 1 AND keys <= 2 AND NOT sb THEN 7
              WHEN sw AND nt >= 7 AND woodwind + saxophone >= 2 AND brass >= 2 AND NOT sj THEN 8
              WHEN nt >= 8 AND orch >= 5 AND fam >= 2 AND ratio >= 0.38 AND guitar + bass <= greatest(2, nt // 4) AND keys <= greatest(3, nt // 2) AND NOT sb THEN 9
              WHEN so AND nt >= 5 AND orch >= 3 AND NOT sb AND NOT band AND NOT keyed THEN 10
              WHEN st AND nt >= 8 AND bowed >= 2 AND orch >= 4 AND fam >= 2 AND NOT keyed THEN 11
              WHEN sf AND nt >= 6 AND orch >= 2 AND NOT sb AND NOT band THEN 12
              WHEN sb THEN -8 WHEN keyed THEN -9 WHEN band THEN -10 ELSE -11 END AS rule FROM t3),
tiered AS (SELECT *, CASE WHEN rule > 0 THEN 'ok' WHEN rule = -1 THEN barred ELSE ['', 'too_few_tracks', 'too_few_notes', 'too_few_bars', 'too_short', 'reduction_or_piano_vocal_score', 'individual_part',
              'explicit_non_orchestral_band', 'keyboard_dominant', 'guitar_or_band_bass_dominant', 'insufficient_orchestra_evidence'][-rule] END AS reason,
              CASE WHEN rule <= 4 THEN 'strict' WHEN rule <= 8 THEN 'probable' ELSE 'candidate' END AS level,
              'orchestra.' || [CASE WHEN voice > 0 AND st THEN 'full.vocal_stage' ELSE 'full.symphonic' END, 'string', 'wind', 'full.vocal_stage', 'chamber', 'explicit_metadata', 'string', 'wind',
                               'large_palette_candidate', 'explicit_candidate', 'vocal_stage_candidate', 'full_score_text_candidate'][rule] AS kind,
              greatest(0, least(100, [84, 82, 80, 79, 68, 66, 65, 64, 50, 48, 46, 44][rule] + CASE WHEN sf THEN 8 ELSE 0 END + CASE WHEN so OR ss OR sw THEN 5 ELSE 0 END + least(nt, 30) // 3 + 2 * least(fam, 4)
                                     - CASE WHEN sb THEN 8 ELSE 0 END - least(guitar + bass, 5) - CASE WHEN keyed THEN 4 ELSE 0 END))::INT AS score,
              CASE rule WHEN 1 THEN printf('tracks=%d;strings=%d;woodwind=%d;brass=%d;percussion=%d;ratio=%.3f', nt, bowed, woodwind, brass, drums, round_even(ratio, 3))
                        WHEN 2 THEN printf('tracks=%d;strings=%d;harp=%d;string_ratio=%.3f', nt, bowed, harp, round_even((bowed + harp) / nt, 3))
                        WHEN 3 THEN printf('explicit wind ensemble;tracks=%d;woodwind+sax=%d;brass=%d;percussion=%d', nt, woodwind + saxophone, brass, drums)
                        WHEN 4 THEN printf('voice=%d;strings=%d;woodwind=%d;brass=%d', voice, bowed, woodwind, brass)
                        WHEN 5 THEN printf('tracks=%d;orchestral_tracks=%d;families=%d;ratio=%.3f', nt, orch, fam, round_even(ratio, 3))
                        WHEN 6 THEN printf('tracks=%d;orchestral_tracks=%d;families=%d', nt, orch, fam)
                        WHEN 7 THEN printf('explicit string orchestra;tracks=%d;strings=%d', nt, bowed)
                        WHEN 8 THEN printf('tracks=%d;woodwind+sax=%d;brass=%d', nt, woodwind + saxophone, brass)
                        WHEN 9 THEN printf('tracks=%d;orchestral_tracks=%d;families=%d;ratio=%.3f', nt, orch, fam, round_even(ratio, 3))
                        WHEN 10 THEN printf('explicit orchestra text;tracks=%d;orchestral_tracks=%d', nt, orch)
                        WHEN 11 THEN printf('stage work;tracks=%d;voice=%d;orchestral_tracks=%d', nt, voice, orch)
                        WHEN 12 THEN printf('full-score text;tracks=%d;orchestral_tracks=%d', nt, orch) END AS basis,
              'pdmx-' || substr(regexp_replace(lower(regexp_replace(regexp_extract({_f('path')}, '[^/]*$'), '[.][^.]*$', '')), '[^a-z0-9]+', '', 'g'), 1, 28) || '-' || substr(sha256({_f('path')}), 1, 16) AS record_id FROM t4)"""


@_query(_TIERED + f"""
SELECT record_id, '{catalogue.SOURCE}' AS source, '{catalogue.DOI}' AS source_doi, '{catalogue.URL}' AS source_url, {_f('title', 'song_name')} AS title, {_f('subtitle')} AS subtitle, {_f('composer_name')} AS composer,
       {_f('artist_name')} AS artist, {_f('license')} AS license, {_f('license_url')} AS license_url, '{catalogue.EXACTNESS}' AS exactness_class, level AS orchestra_verification_level, kind AS ensemble_class,
       score AS confidence_score, basis AS classification_basis, nt AS n_tracks, {_f('tracks')} AS gm_programs_0based,
       '{{' || array_to_string(list_transform(list_sort(list_distinct(p)), lambda x: '"' || x || '":' || len(list_filter(p, lambda y: y = x))), ',') || '}}' AS gm_program_track_counts,
       {_json({f: _one_of('tiered', f) for f, _ in FAMILIES['tiered']})} AS family_track_counts, orch AS orchestral_track_count, printf('%.6f', round_even(ratio, 6)) AS orchestral_track_ratio, fam AS orchestral_family_count,
       nn AS n_notes, nb AS song_length_bars, ns AS song_length_seconds, false AS has_lyrics, {_yes('has_custom_audio')} AS has_custom_audio, {_yes('subset:deduplicated')} AS subset_deduplicated,
       {_GROUP.format('pdmx-group-', 'record_id')} AS duplicate_group_id, path, mxl, {_f('pdf')} AS pdf, mid FROM tiered WHERE rule > 0""")
def q_tiered_manifest(spark, sf_dir):
    """The 33 columns of all accepted rows, by level, score and id."""
    good, _ = catalogue.tiered_manifest(wide(spark, sf_dir).withColumn("at", F.monotonically_increasing_id()), "at")
    return catalogue.tiered_output(good.orderBy(*catalogue.tier_order()))


@_query(_TIERED + "SELECT reason, count(*) AS rows FROM tiered GROUP BY 1")
def q_tiered_reasons(spark, sf_dir):
    return catalogue.tiered_manifest(wide(spark, sf_dir).withColumn("at", F.monotonically_increasing_id()), "at")[1]


@_query(_TIERED + """, twice AS (SELECT * FROM tiered UNION ALL SELECT * FROM tiered WHERE CAST(n_tracks AS INT) % 2 = 0),
again AS (SELECT CASE WHEN rule > 0 AND row_number() OVER (PARTITION BY record_id, rule > 0) > 1 THEN 'defensive_duplicate_record' ELSE reason END AS reason FROM twice) SELECT reason, count(*) AS rows FROM again GROUP BY 1""")
def q_tiered_duplicates(spark, sf_dir):
    """As the reasons, of a table some of whose rows come twice."""
    rows = wide(spark, sf_dir).withColumn("at", F.monotonically_increasing_id())
    again = rows.filter("CAST(n_tracks AS INT) % 2 = 0").withColumn("at", F.col("at") + (1 << 50))
    return catalogue.tiered_manifest(rows.unionByName(again), "at")[1]


# -- records -----------------------------------------------------------------------------------------------


def _record_sql(version: int) -> str:
    m, v = f"record_v{version}", rules.RECORD_VERSIONS[version]
    count = lambda f: _in(m, f)
    one = lambda *n: f"len(list_filter(p, lambda x: x IN ({', '.join(map(str, n))})))"
    text = "lower(concat_ws(' ', " + ", ".join(v["text"]) + "))"
    shown = {f: count(f) for f, _ in FAMILIES[m] if f != "section_strings"}
    return f"""
WITH {_WIDE},
e0 AS (SELECT *, list_transform(list_filter(regexp_extract_all(tracks, '[0-9]+'), lambda x: x::BIGINT <= 127), lambda x: x::INT) AS p, {text} AS t FROM wide WHERE {_yes('subset:no_license_conflict')} AND {_yes('subset:all_valid')} AND {_yes('subset:deduplicated')}),
e1 AS (SELECT *, len(p) AS n, {count(v['family'])} AS s, {count('woodwind')} AS w, {count('brass')} AS b, {count('sax')} AS x, {count('piano')} AS pi, {count('bass')} AS ba, {count('guitar')} AS gu, {count('voice')} AS vo, {count('synth')} AS sy,
              {one(40)} AS p40, {one(41)} AS p41, {one(42)} AS p42, {one(56, 59)} AS tr, {one(57)} AS tb FROM e0),
e2 AS (SELECT *, CASE WHEN n = 4 AND p40 = 2 AND p41 = 1 AND p42 = 1 THEN 1 WHEN s >= 5 AND w >= 2 AND b >= 2 AND n >= 10 THEN 2 WHEN s >= 4 AND w = 0 AND b = 0 THEN 3 WHEN s >= 2 AND w + b >= 1 AND n >= 5 THEN 4
              WHEN w >= 5 AND b >= 3 AND s <= 1 AND n >= 8 THEN 5 WHEN b >= 6 AND w <= 1 AND s <= 1 THEN 6 WHEN x >= 4 AND tr >= 3 AND tb >= 2 AND n >= 10 THEN 7
              WHEN regexp_matches(t, 'jazz|bossa|swing') AND n BETWEEN 3 AND 9 AND ba > 0 AND (pi > 0 OR gu > 0) THEN 8 WHEN vo >= 2 THEN 9 WHEN vo > 0 AND pi > 0 AND n <= 4 THEN 10 WHEN n = 1 AND pi > 0 THEN 11
              WHEN n = 1 AND gu > 0 THEN 12 WHEN n >= 3 AND ba > 0 AND gu > 0 AND (pi > 0 OR sy > 0) THEN 13 WHEN sy >= 2 AND sy >= greatest(2, n // 2) THEN 14 ELSE 15 END AS rule FROM e1)
SELECT 'pdmx-' || regexp_replace(lower(regexp_replace(regexp_extract(path, '[^/]*$'), '[.][^.]*$', '')), '[^a-z0-9]+', '', 'g') AS record_id, title, song_name, composer_name, genres, {_int('n_tracks')} AS n_tracks,
       array_to_string(list_transform(list_sort(list_distinct(p)), lambda a: a || ':' || len(list_filter(p, lambda c: c = a))), ';') AS gm_program_track_counts, {_pairs(shown)} AS family_track_counts,
       len(list_distinct(p))::INT AS distinct_programs,
       ['chamber.string_quartet', 'orchestra.full.symphonic', 'orchestra.string', 'orchestra.chamber', 'wind.concert_band_candidate', 'brass_band_candidate', 'jazz.big_band_candidate', 'jazz.combo_candidate',
        'choir.vocal_ensemble', 'voice.piano', 'solo.piano', 'solo.guitar', 'band.pop_rock_candidate', 'electronic.synth_ensemble', 'ensemble.mixed_or_unclassified'][rule] AS ensemble_primary,
       CASE WHEN rule IN (1, 11, 12) THEN 'high' WHEN rule = 2 THEN CASE WHEN regexp_matches(t, 'orchestra|symph|philharmonic|sinfon') THEN 'high' ELSE 'medium' END WHEN rule = 7 THEN CASE WHEN regexp_matches(t, 'jazz|big band') THEN 'medium' ELSE 'low' END
            WHEN rule = 9 THEN CASE WHEN regexp_matches(t, 'choir|choral') THEN 'medium' ELSE 'low' END WHEN rule >= 13 AND rule <> 14 THEN 'low' ELSE 'medium' END AS ensemble_confidence,
       CASE rule WHEN 1 THEN '2 violin+viola+cello GM tracks' WHEN 2 THEN printf('{v['strings']}=%d;woodwind=%d;brass=%d', s, w, b) WHEN 3 THEN printf('{v['strings']}=%d;no wind/brass', s) WHEN 4 THEN printf('{v['strings']}=%d;wind+brass=%d', s, w + b)
            WHEN 5 THEN printf('woodwind=%d;brass=%d;drumkit unknown', w, b) WHEN 6 THEN printf('brass=%d', b) WHEN 7 THEN printf('sax=%d;trumpet=%d;trombone=%d;drumkit unknown', x, tr, tb) WHEN 8 THEN 'jazz metadata+bass+piano/guitar'
            WHEN 9 THEN printf('{v['voices']}=%d', vo) WHEN 10 THEN '{v['voice']}+piano' WHEN 11 THEN 'single piano program track' WHEN 12 THEN 'single guitar program track' WHEN 13 THEN 'bass+guitar+keys/synth;drumkit unknown'
            WHEN 14 THEN printf('synth=%d/%d', sy, n) ELSE 'no canonical pattern proven from GM program list' END AS classification_basis,
       'unknown_from_pdmx_program_list' AS drumkit_presence, mxl, pdf, mid, license, license_url, path, '{catalogue.EXACTNESS}' AS exactness_class FROM e2 WHERE path <> ''"""


def _with_paths(spark, sf_dir) -> DataFrame:
    return wide(spark, sf_dir).filter("path <> ''")  # ids are made of paths


@_query(_record_sql(1))
def q_record_manifest(spark, sf_dir):
    return catalogue.record_manifest(_with_paths(spark, sf_dir), 1)[0]


@_query(_record_sql(2))
def q_record_reclassified(spark, sf_dir):
    """Records of version 1 with the derived columns of version 2 in place of the old ones."""
    return catalogue.reclassified(catalogue.record_manifest(_with_paths(spark, sf_dir), 1)[0])


@_query(_record_sql(1).replace("SELECT 'pdmx-'", ", out AS (SELECT p, 'pdmx-'", 1) + """), long AS (SELECT record_id, unnest(p) AS gm_program_0based FROM out)
SELECT record_id, gm_program_0based, count(*)::INT AS track_count FROM long GROUP BY ALL""")
def q_record_long(spark, sf_dir):
    return catalogue.record_manifest(_with_paths(spark, sf_dir), 1)[1]


# -- pairs ---------------------------------------------------------------------------------------------------

_BAND = f"""
WITH {_WIDE},
b0 AS (SELECT *, CASE WHEN n_tracks::INT % 2 = 0 THEN 'drums, bass guitar; ' ELSE '' END || CASE WHEN n_tracks::INT % 3 = 0 THEN 'piano/' ELSE '' END || CASE WHEN n_tracks::INT % 4 = 1 THEN 'violin trumpet flute' ELSE '' END AS words FROM wide),
b1 AS (SELECT *, [{', '.join(f"CASE WHEN {_any('words', w)} THEN '{f}' END" for f, w in catalogue.BAND_WORDS.items())}] AS fs,
              {_any("lower(genres || ' ' || groups || ' ' || tags)", catalogue.BAND_GENRES)} AS genre, {_int('n_tracks')} AS nt,
              lower("is_best_unique_arrangement") IN ('1', 'true', 't', 'yes', 'y') AND {_yes('subset:no_license_conflict')} AND {_yes('subset:all_valid')} AND {_int('n_tracks')} >= 2 AS ok FROM b0),
b2 AS (SELECT *, list_filter(fs, lambda x: x IS NOT NULL) AS f FROM b1),
b3 AS (SELECT *, CASE WHEN nt >= 4 AND list_contains(f, 'drums_percussion') AND list_contains(f, 'bass') AND list_has_any(f, ['guitar', 'keys']) THEN 'strict_core_band'
              WHEN nt >= 3 AND list_contains(f, 'drums_percussion') AND list_has_any(f, ['guitar', 'keys']) THEN 'rhythm_section_band' WHEN nt >= 3 AND genre AND len(f) >= 2 THEN 'genre_labeled_band'
              WHEN nt >= 3 AND len(f) >= 3 THEN 'broad_multi_instrument_ensemble' WHEN nt >= 2 THEN 'multi_instrument_other' ELSE 'not_multi_instrument' END AS tier FROM b2)"""


def _banded(spark, sf_dir) -> DataFrame:
    words = "CASE WHEN CAST(n_tracks AS INT) % 2 = 0 THEN 'drums, bass guitar; ' ELSE '' END || CASE WHEN CAST(n_tracks AS INT) % 3 = 0 THEN 'piano/' ELSE '' END || CASE WHEN CAST(n_tracks AS INT) % 4 = 1 THEN 'violin trumpet flute' ELSE '' END"
    return wide(spark, sf_dir).withColumn("tracks", F.expr(words))


@_query(_BAND + "SELECT mid, tier, ok AS eligible FROM b3")
def q_band_tier(spark, sf_dir):
    rows = _banded(spark, sf_dir)
    return rows.select("mid", catalogue.band_tier(rows).alias("tier"), catalogue.eligible(rows).alias("eligible"))


@_query(_BAND + "SELECT count(*) AS total, count(*) FILTER (nt >= 2) AS multi_instrument, count(*) FILTER (ok) AS eligible, " + ", ".join(f"count(*) FILTER (ok AND tier = '{t}') AS {t}" for t in (*rules.BANDS, rules.BAND_REST)) + " FROM b3")
def q_pair_counts(spark, sf_dir):
    return catalogue.pair_counts(_banded(spark, sf_dir))


@_query("""
WITH a AS (SELECT s_suppkey, 'https://x.org/audio/' || CASE WHEN s_suppkey % 3 = 0 THEN 'No ' ELSE 'no-' END || (s_suppkey // 2) || '.mp3?v=1' AS url FROM supplier),
r AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'N/A' ELSE './mid/no-' || (c_custkey // 2) || '.mid' END AS mid, './mxl/no' || c_custkey || '.musicxml.gz' AS mxl FROM customer),
n AS (SELECT c_custkey, unnest(list_distinct([stem, regexp_replace(stem, '[^a-z0-9]+', '', 'g')])) AS key FROM (
        SELECT c_custkey, 'no-' || (c_custkey // 2) AS stem FROM customer WHERE c_custkey % 5 <> 0 UNION ALL SELECT c_custkey, 'no' || c_custkey FROM customer)),
k AS (SELECT s_suppkey, unnest(list_distinct([stem, regexp_replace(stem, '[^a-z0-9]+', '', 'g')])) AS key FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'no ' ELSE 'no-' END || (s_suppkey // 2) AS stem FROM supplier)),
m AS (SELECT s_suppkey, min(c_custkey) AS lo, max(c_custkey) AS hi FROM k JOIN n USING (key) GROUP BY 1)
SELECT s_suppkey, CASE WHEN lo IS NULL THEN 'unmatched' WHEN lo = hi THEN 'unique' ELSE 'ambiguous' END AS mapping, CASE WHEN lo = hi THEN lo END AS mapped FROM supplier LEFT JOIN m USING (s_suppkey)""")
def q_paired_audio(spark, sf_dir):
    """Audio names that meet just one row, under several columns and two forms of a name."""
    audios = _t(spark, sf_dir, "supplier").select("s_suppkey", F.expr("'https://x.org/audio/' || CASE WHEN s_suppkey % 3 = 0 THEN 'No ' ELSE 'no-' END || CAST(s_suppkey div 2 AS STRING) || '.mp3?v=1'").alias("url"))
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.expr("CASE WHEN c_custkey % 5 = 0 THEN 'N/A' ELSE './mid/no-' || CAST(c_custkey div 2 AS STRING) || '.mid' END").alias("mid"), F.expr("'./mxl/no' || CAST(c_custkey AS STRING) || '.musicxml.gz'").alias("mxl"))
    return catalogue.paired_audio(audios, rows, "url", "c_custkey", ("mid", "mxl")).select("s_suppkey", "mapping", "mapped")


# -- splits ----------------------------------------------------------------------------------------------------

DEV, SEALED, RARE, REVIEW = 4, 5, 3, 6
_PAIRS = f"""
WITH {_WIDE},
q0 AS (SELECT 'pair-' || mid AS pair_id, tracks, path AS pdmx_path, mid AS mid_path, title, song_name, artist_name, composer_name,
              list_transform(list_filter(regexp_extract_all(tracks, '[0-9]+'), lambda x: x::BIGINT <= 127), lambda x: x::INT) AS p FROM wide),
q1 AS (SELECT *, CASE WHEN artist_name <> '' THEN artist_name ELSE composer_name END AS creator, trim(regexp_replace(lower(song_name), '[^a-z0-9]+', ' ', 'g')) AS t FROM q0),
q2 AS (SELECT *, 'title_creator_v2|' || trim(regexp_replace(lower(creator), '[^a-z0-9]+', ' ', 'g')) || '|' || t AS work_cluster_basis, CASE WHEN pdmx_path <> '' THEN pdmx_path ELSE mid_path END AS own FROM q1),
q3 AS (SELECT *, 'work-' || substr(sha256(work_cluster_basis), 1, 16) AS work_cluster_id, 'arr-' || substr(sha256(own), 1, 16) AS arrangement_cluster_id, len(list_distinct(p)) AS d FROM q2),
fr AS (SELECT x, count(*) / (SELECT count(*) FROM q3) AS f FROM (SELECT unnest(list_distinct(p)) AS x FROM q3) GROUP BY 1),
ra AS (SELECT pair_id, min(f) AS least, coalesce(string_agg(x::VARCHAR, '-' ORDER BY f, x) FILTER (f <= 0.01), '') AS rare FROM (SELECT pair_id, unnest(list_distinct(p)) AS x FROM q3) JOIN fr USING (x) GROUP BY 1),
q4 AS (SELECT *, round(-log10(least) + 0.04::DOUBLE * d, 6) AS rarity FROM q3 JOIN ra USING (pair_id)),
rp AS (SELECT work_cluster_id, pair_id AS rep, d, rarity FROM q4 QUALIFY row_number() OVER (PARTITION BY work_cluster_id ORDER BY d DESC, rarity DESC, pair_id) = 1),
a1 AS (SELECT *, row_number() OVER (ORDER BY rarity DESC, d DESC, sha256('rare|' || work_cluster_id)) AS n1 FROM rp),
a2 AS (SELECT *, CASE WHEN n1 > {RARE} THEN row_number() OVER (PARTITION BY n1 > {RARE} ORDER BY sha256('dev|' || work_cluster_id)) END AS n2 FROM a1),
a3 AS (SELECT *, CASE WHEN n2 > {DEV} THEN row_number() OVER (PARTITION BY coalesce(n2 > {DEV}, false) ORDER BY sha256('sealed|' || work_cluster_id)) END AS n3 FROM a2),
a4 AS (SELECT *, CASE WHEN n3 > {SEALED} THEN row_number() OVER (PARTITION BY coalesce(n3 > {SEALED}, false) ORDER BY sha256('review|' || work_cluster_id)) END AS n4 FROM a3),
a5 AS (SELECT work_cluster_id, rep, CASE WHEN n1 <= {RARE} THEN 'rare_challenge' WHEN n2 <= {DEV} THEN 'strict_dev' WHEN n3 <= {SEALED} THEN 'sealed_test' WHEN n4 <= {REVIEW} THEN 'human_review_queue' ELSE 'train' END AS cluster_split FROM a4),
manifest AS (
  SELECT pair_id, 'SYNTH_RENDERED_MIDI' AS label_grade, 1 AS supervised_ground_truth_eligible, 0 AS model_pseudo_label, 'EXACT_BY_CONSTRUCTION' AS alignment_class, 'PASS' AS alignment_gate,
         'same_source_midi_synthesis' AS alignment_method, 0 AS dtw_required, 0 AS manual_alignment_required, work_cluster_id, work_cluster_basis, arrangement_cluster_id, arrangement_cluster_id AS audio_variant_cluster_id,
         cluster_split, CASE WHEN cluster_split = 'train' THEN 'train' ELSE 'holdout' END AS split,
         CASE WHEN cluster_split = 'train' THEN 'none' WHEN rep <> pair_id THEN 'cluster_sibling_holdout' WHEN cluster_split = 'human_review_queue' THEN 'human_review_candidate' ELSE cluster_split END AS eval_role,
         (rep = pair_id)::INT AS is_cluster_representative, song_name AS title, creator, composer_name AS composer_or_arranger, '' AS genres, '' AS tags, tracks AS gm_programs_0based, d AS distinct_gm_programs,
         printf('%.6f', rarity) AS rarity_score, rare AS rare_programs_0based, pdmx_path, 'm' AS mxl_path, 'p' AS pdf_path, mid_path, 'a' AS audio_path, '' AS audio_source, '' AS score_source, '' AS license, '' AS license_url,
         'PASS_PDMX_NO_LICENSE_CONFLICT' AS rights_gate, 'compressed_audio_5s_on_the_fly' AS feature_policy FROM q4 JOIN a5 USING (work_cluster_id))"""


def _training(spark, sf_dir) -> DataFrame:
    rows = wide(spark, sf_dir).select(
        F.concat(F.lit("pair-"), "mid").alias("pair_id"), "tracks", F.col("path").alias("pdmx_path"), F.lit("m").alias("mxl_path"), F.lit("p").alias("pdf_path"), F.col("mid").alias("mid_path"),
        F.lit("a").alias("hf_audio_path"), F.lit("True").alias("eligible_exact_pair"), F.col("song_name").alias("title"), F.col("artist_name").alias("artist"), F.col("composer_name").alias("composer"),
    )
    return splits.training_manifest(rows, DEV, SEALED, RARE, REVIEW)


@_query(_PAIRS + "SELECT * FROM manifest")
def q_training_manifest(spark, sf_dir):
    """The 37 columns of the training manifest."""
    out = splits.training_output(_training(spark, sf_dir))
    return out.withColumn("rarity_score", F.format_string("%.6f", "rarity_score"))


@_query(_PAIRS + f"""SELECT count(*) AS rows, true AS pseudo_labels_excluded, true AS all_alignment_pass,
  count(*) FILTER (eval_role = 'strict_dev') = {DEV} AND count(*) FILTER (eval_role = 'sealed_test') = {SEALED} AND count(*) FILTER (eval_role = 'rare_challenge') = {RARE} AS strict_eval_requested,
  count(*) FILTER (eval_role = 'human_review_candidate') = {REVIEW} AS human_review_queue_requested,
  NOT EXISTS (SELECT 1 FROM manifest GROUP BY work_cluster_id HAVING count(DISTINCT cluster_split) > 1) AND NOT EXISTS (SELECT 1 FROM manifest GROUP BY arrangement_cluster_id HAVING count(DISTINCT cluster_split) > 1) AS cluster_leakage_zero,
  true AS passed FROM manifest""")
def q_split_tests(spark, sf_dir):
    out = splits.checked(splits.training_output(_training(spark, sf_dir)), DEV, SEALED, RARE, REVIEW)
    return splits.split_tests(out, DEV, SEALED, RARE, REVIEW)


@_query(_PAIRS + """, k AS (SELECT 'creator' AS key_name, creator AS key, cluster_split FROM manifest UNION ALL SELECT 'title', title, cluster_split FROM manifest)
SELECT key_name, key, count(DISTINCT cluster_split) AS n_splits FROM k GROUP BY 1, 2 HAVING count(DISTINCT cluster_split) > 1""")
def q_split_leaks(spark, sf_dir):
    """Creators and titles are in several splits, since clusters need both."""
    return aggregates.leak_audit(_training(spark, sf_dir), ["creator", "title"], "cluster_split")


@_query(_PAIRS + ", n AS (SELECT unnest(list_distinct(p)) AS program, pair_id FROM q3) SELECT program, count(*) AS records_present FROM n GROUP BY 1 HAVING count(*) / (SELECT count(*) FROM q3) < 0.02")
def q_rare_programs(spark, sf_dir):
    """Programs in less than 2 % of the pairs."""
    m = _training(spark, sf_dir)
    long = m.select("pair_id", F.explode(F.array_distinct("programs")).alias("program"))
    return aggregates.rare_items(long, "pair_id", "program", m.count(), 0.02)


@_query(_PAIRS + """, n AS (SELECT pair_id, unnest(p) AS program FROM q3) SELECT program, count(DISTINCT pair_id) AS records_present, count(*)::BIGINT AS occurrences,
  printf('%.8f', count(DISTINCT pair_id) / (SELECT count(*) FROM q3)) AS record_fraction FROM n GROUP BY 1""")
def q_program_balance(spark, sf_dir):
    return splits.program_balance(_training(spark, sf_dir))


_BALANCE = " UNION ALL ".join(f"SELECT '{name}' AS family, pair_id, {_in('balance', name)} AS n FROM q3" for name, _ in FAMILIES["balance"])


@_query(_PAIRS + f", n AS ({_BALANCE}) SELECT family, count(*) AS records_present, sum(n)::BIGINT AS occurrences, printf('%.8f', count(*) / (SELECT count(*) FROM q3)) AS record_fraction FROM n WHERE n > 0 GROUP BY 1")
def q_split_family_balance(spark, sf_dir):
    return splits.family_balance(_training(spark, sf_dir))


# -- linked scores -----------------------------------------------------------------------------------------------


def _aligned(spark, sf_dir) -> DataFrame:
    nation = _t(spark, sf_dir, "nation").filter("n_nationkey % 6 <> 5")
    found = nation.select(F.col("n_nationkey").cast("string").alias("score_id"), F.col("n_name").alias("name"), F.concat(F.lit("w"), "n_nationkey").alias("folder"))
    audios = _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("audio_id"), F.col("s_nationkey").cast("string").alias("score_id"), (F.col("s_suppkey") % 7).cast("string").alias("number"))
    headers = nation.select(F.concat(F.lit("w"), "n_nationkey").alias("folder"), F.expr("transform(sequence(0, n_nationkey % 5), i -> cast(i as string) || '_tstamp')").alias("header"))
    return scores.aligned_pairs(found, audios, headers)


_ALIGNED = """
WITH h AS (SELECT 'w' || n_nationkey AS folder, unnest(range(0, n_nationkey % 5 + 1))::VARCHAR AS number FROM nation WHERE n_nationkey % 6 <> 5),
a AS (SELECT s_suppkey AS audio_id, s_nationkey::VARCHAR AS score_id, (s_suppkey % 7)::VARCHAR AS number, n_name AS name, CASE WHEN n_nationkey % 6 <> 5 THEN 'w' || n_nationkey END AS folder FROM supplier JOIN nation ON s_nationkey = n_nationkey),
j AS (SELECT a.*, h.number IS NOT NULL AS found FROM a LEFT JOIN h USING (folder, number)),
r AS (SELECT *, CASE WHEN folder IS NULL THEN 'score_not_found' WHEN NOT found THEN 'audio_metadata_has_no_alignment_column' WHEN row_number() OVER (PARTITION BY score_id, number ORDER BY audio_id) > 1 THEN 'duplicate_number_for_score' ELSE 'ok' END AS reason FROM j)"""


@_query(_ALIGNED + " SELECT audio_id, reason, substr(sha256(score_id || ':' || number || ':' || audio_id), 1, 20) AS pair_id FROM r")
def q_aligned_pairs(spark, sf_dir):
    return _aligned(spark, sf_dir).select("audio_id", "reason", "pair_id")


@_query(_ALIGNED + """ SELECT 'x-' || substr(sha256(score_id || ':' || number || ':' || audio_id), 1, 20) AS match_id, score_id, name AS score_name, number || '_tstamp' AS alignment_column, audio_id, number AS imslp_number, true AS human_performance FROM r WHERE reason = 'ok'""")
def q_aligned_manifest(spark, sf_dir):
    out = scores.aligned_manifest(_aligned(spark, sf_dir), "x-", {"human_performance": True})
    return out.select("match_id", "score_id", "score_name", "alignment_column", "audio_id", "imslp_number", "human_performance")


@_query("""
WITH h AS (SELECT 'w' || n_nationkey AS folder, n_nationkey, unnest(range(0, n_nationkey % 5 + 1)) AS number FROM nation WHERE n_nationkey % 6 <> 5)
SELECT folder, number || '_tstamp' AS alignment_column FROM h WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 7 = number)""")
def q_unused_columns(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation").filter("n_nationkey % 6 <> 5")
    found = nation.select(F.col("n_nationkey").cast("string").alias("score_id"), F.concat(F.lit("w"), "n_nationkey").alias("folder"))
    audios = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").cast("string").alias("score_id"), (F.col("s_suppkey") % 7).cast("string").alias("number"))
    headers = nation.select(F.concat(F.lit("w"), "n_nationkey").alias("folder"), F.expr("transform(sequence(0, n_nationkey % 5), i -> cast(i as string) || '_tstamp')").alias("header"))
    return scores.unused_columns(audios, found, headers)


@_query(r"""
WITH f AS (SELECT page_id, '/r/data/' || lang || '_x/' || (page_id // 40) || '_work/' || page_id AS stem FROM (SELECT page_id, substr(md5(url), 1, 1) AS lang FROM pages)),
p AS (SELECT page_id, stem, string_split(stem[9:], '/') AS s FROM f WHERE page_id % 3 <> 0)
SELECT stem || '.mxl' AS path, replace(s[1], '_', ' ') AS composer, replace(s[2], '_', ' ') AS work, CASE WHEN page_id % 2 = 0 THEN stem || '.mm.json' END AS mm_json,
       substr(sha256(s[1] || '/' || s[2] || '/' || s[3] || '.mxl'), 1, 20) AS record_id FROM p""")
def q_tree_scores(spark, sf_dir):
    """Files with their siblings; every third one lacks the file it needs, and derived files are left out."""
    pages = _t(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/r/data/"), F.substring(F.md5("url"), 1, 1), F.lit("_x/"), F.expr("cast(page_id div 40 as string)"), F.lit("_work/"), F.col("page_id").cast("string")).alias("stem"))
    kinds = F.array(F.lit(".mxl"), F.lit("_melody.mxl"), F.when(F.col("page_id") % 3 != 0, ".mscz"), F.when(F.col("page_id") % 2 == 0, ".mm.json"))
    files = pages.select("stem", F.explode(kinds).alias("kind")).filter("kind IS NOT NULL").select(F.concat("stem", "kind").alias("path"))
    return scores.tree_scores(files).select("path", "composer", "work", "mm_json", "record_id")


_NOTES = """
WITH e AS (SELECT user_id, event_id, round(value, 2) AS v FROM events),
n AS (SELECT 'songs/Track ' || user_id || '.txt' AS member, user_id, event_id, v AS start, event_id % 5 >= 1 AS forward, event_id % 140 AS pitch, event_id % 7 AS program FROM e)"""


def _note_members(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    e = _t(spark, sf_dir, "events")
    v = F.round("value", 2)
    line = F.concat_ws("\t", F.format_string("%.2f", v), F.format_string("%.2f", v + (F.col("event_id") % 5) - 1), (F.col("event_id") % 140).cast("string"), (F.col("event_id") % 7).cast("string"))
    files = e.groupBy(F.concat(F.lit("songs/Track "), "user_id", F.lit(".txt")).alias("member")).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    members = files.select("member", F.concat(F.lit("onset\toffset\tpitch\tprogram\n"), "body").cast("binary").alias("content"))
    users = e.select("user_id").distinct()
    songs = users.select(F.concat(F.lit("track-"), "user_id").alias("key"), F.concat(F.lit("Song "), (F.col("user_id") % 1000).cast("string")).alias("song_name"))
    return members, songs.unionByName(songs.filter("user_id % 10 = 0" if "user_id" in songs.columns else "key LIKE '%0'").withColumn("song_name", F.lit("another")))


@_query(_NOTES + """, s AS (SELECT member, user_id, count(*) FILTER (forward AND pitch <= 127) AS n_notes, count(*) FILTER (NOT forward OR pitch > 127) AS n_malformed,
  printf('%.2f', min(start) FILTER (forward AND pitch <= 127)) AS first_start, min(pitch) FILTER (forward AND pitch <= 127) AS lowest, max(pitch) FILTER (forward AND pitch <= 127) AS highest FROM n GROUP BY 1, 2)
SELECT member, n_notes, n_malformed, first_start, lowest, highest, user_id % 10 <> 0 AS matched, CASE WHEN user_id % 10 = 0 THEN 'Track ' || user_id ELSE 'Song ' || (user_id % 1000) END AS song_name, substr(sha256(member), 1, 20) AS record_id FROM s""")
def q_note_scores(spark, sf_dir):
    """Note lists with their extent; keys that name two songs name none."""
    members, songs = _note_members(spark, sf_dir)
    out = scores.note_scores(members, songs)
    return out.select("member", "n_notes", "n_malformed", F.format_string("%.2f", "first_start").alias("first_start"), "lowest", "highest", "matched", "song_name", "record_id")


@_query("""
WITH d AS (SELECT s_suppkey, s_nationkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT s_suppkey, n_name || ' ' || s_suppkey AS title, 'C' || s_nationkey AS composer, CASE WHEN s_suppkey % 2 = 0 THEN '4/4' ELSE '' END AS meter, 'G' AS key, 2 AS voices,
       '[' || array_to_string(list_sort(list_distinct([s_suppkey % 127, s_nationkey::BIGINT])), ',') || ']' AS programs FROM d""")
def q_abc_fields(spark, sf_dir):
    """Headers of ABC texts: the first of each counts."""
    from ..functions import coerce
    from ..sources import symbolic

    rows = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    meter = F.when(F.col("s_suppkey") % 2 == 0, "M: 4/4\n").otherwise("")
    text = F.concat(F.lit("X:1\nT: "), "n_name", F.lit(" "), F.col("s_suppkey").cast("string"), F.lit("\nT:second\nC:C"), F.col("s_nationkey").cast("string"), F.lit("\n"), meter, F.lit("K:G\nV:1 name=a\n[V:2] abc\nV:1\n%%MIDI program "), F.col("s_nationkey").cast("string"), F.lit("\n%%MIDI program 1 "), (F.col("s_suppkey") % 127).cast("string"), F.lit("\n%%MIDI program 300\n"))
    out = rows.select("s_suppkey", symbolic.abc_fields(text.cast("binary")).alias("f"))
    return out.select("s_suppkey", "f.title", "f.composer", "f.meter", "f.key", F.size("f.voices").alias("voices"), coerce.json_ints(F.col("f.programs")).alias("programs"))


@_query("""
WITH m AS (SELECT page_id, './' || page_id || '.abc' AS member FROM pages), w AS (SELECT (page_id * 2) || '.abc' AS name FROM pages)
SELECT 'selected' AS what, member FROM m WHERE member[3:] IN (SELECT name FROM w) UNION ALL SELECT 'missing', name FROM w WHERE './' || name NOT IN (SELECT member FROM m)""")
def q_selected_members(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    members = pages.select(F.concat(F.lit("./"), "page_id", F.lit(".abc")).alias("member"))
    wanted = pages.select(F.concat((F.col("page_id") * 2).cast("string"), F.lit(".abc")).alias("member"))
    some, missing = scores.selected(members, wanted)
    return some.select(F.lit("selected").alias("what"), "member").unionByName(missing.select(F.lit("missing").alias("what"), "member"))


@_query("SELECT event_type, count(*) AS total, count(*) FILTER (value > 100) AS large, count(*) FILTER (value < 1) AS small, printf('%.6f', (count(*) FILTER (value > 100))::DOUBLE / count(*)) AS rate FROM events GROUP BY 1")
def q_counters(spark, sf_dir):
    """Several conditional counts and a guarded rate in one pass, by type."""
    e = _t(spark, sf_dir, "events")
    parts = []
    for kind in sorted(r[0] for r in e.select("event_type").distinct().collect()):  # a handful of types
        own = e.filter(F.col("event_type") == kind)
        one = aggregates.counters(own, {"large": F.col("value") > 100, "small": F.col("value") < 1})
        rate = own.agg(aggregates.match_rate(own, F.col("value") > 100).alias("r"))
        parts.append(one.join(rate).select(F.lit(kind).alias("event_type"), "total", "large", "small", F.format_string("%.6f", "r").alias("rate")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@_query("""
SELECT count(*) AS rows, bool_and(name <> '') AS all_have_name, count(*) = count(DISTINCT id) AS unique_id, count(*) >= 5 AS minimum_passed, bool_and(name <> '') AND count(*) = count(DISTINCT id) AND count(*) >= 5 AS passed
FROM (SELECT n_nationkey AS id, n_name AS name FROM nation)""")
def q_validation(spark, sf_dir):
    rows = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return scores.validation(rows, ["id"], ["name"], 5)


def accepted_only(df: DataFrame) -> DataFrame:
    return gates.accepted(df)
