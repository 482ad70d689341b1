"""Manifests of scores that are linked across sources: aligned audio, directory trees, note lists, ABC with MIDI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce as c
from ..operators import gates, joins, selection
from ..sources import symbolic


# -- scores and audio by alignment columns ---------------------------------------------------------------


def aligned_pairs(scores: DataFrame, audios: DataFrame, headers: DataFrame, suffix: str = "_tstamp") -> DataFrame:
    """Every audio row with its score and a reason: ok, or why it has no aligned pair.

    scores (score_id, folder), audios (audio_id, score_id, number), headers (folder, header):
    an audio is aligned if a column named <number><suffix> is in its score's alignment
    table. Of audios with one score and number the one with the least id counts.
    """
    names = headers.select("folder", F.explode("header").alias("alignment_column")).filter(F.col("alignment_column").endswith(suffix))
    names = names.withColumn("number", F.regexp_replace("alignment_column", f"{suffix}$", "")).dropDuplicates(["folder", "number"])
    rows = audios.join(scores.withColumn("has_score", F.lit(True)), "score_id", "left").join(names, ["folder", "number"], "left")
    first = F.row_number().over(Window.partitionBy("score_id", "number").orderBy("audio_id"))
    rules = [
        ("score_not_found", F.col("has_score").isNull()),
        ("audio_metadata_has_no_alignment_column", F.col("alignment_column").isNull()),
        ("duplicate_number_for_score", F.col("__first") > 1),
    ]
    rows = gates.gate(rows.withColumn("__first", first), rules).drop("__first", "has_score")
    return rows.withColumn("pair_id", c.short_hash(F.concat_ws(":", "score_id", "number", "audio_id")))


#: Columns of a manifest of aligned pairs, and the columns of scores and audios that they come from.
ALIGNED = {
    "match_id": "match_id", "score_id": "score_id", "score_name": "name", "composer": "composer", "collection": "collection", "movement": "movement", "score_path": "path",
    "mscz_path": "mscz_path", "mscz_sha256": "mscz_sha256", "mxl_path": "mxl_path", "mxl_sha256": "mxl_sha256",
    "alignment_path": "alignment_path", "alignment_sha256": "alignment_sha256", "alignment_rows": "alignment_rows", "alignment_column": "alignment_column",
    "audio_id": "audio_id", "performers": "performers", "publisher": "publisher", "recording_year": "year", "imslp_number": "number", "audio_url": "audio_url",
}
#: Columns of the other manifests, and where they come from.
NOTE_ROWS = {
    "record_id": "record_id", "track_name": "song_name", "score_member_path": "member", "score_sha256": "sha256", "score_bytes": "size", "note_events": "n_notes",
    "instrument_programs": "programs_json", "start_seconds": "start_seconds", "end_seconds": "end_seconds", "metadata_member_paths": "metadata_member_paths",
    "metadata_duration_seconds": "duration", "metadata_sources": "sources",
}
ABC_ROWS = {
    "record_id": "record_id", "score_member_path": "member", "score_sha256": "sha256", "score_bytes": "size", "title": "title", "composer": "composer", "meter": "meter", "key": "key",
    "abc_voice_count": "voice_count", "abc_midi_programs": "programs_json", "source_detection_method": "selection_method", "source_midi_member_path": "midi_member",
    "source_midi_sha256": "midi_sha256", "source_midi_bytes": "midi_size", "source_midi_tracks": "midi_tracks", "source_midi_note_on_events": "midi_notes", "source_midi_programs": "midi_programs",
    "source_midi_match_method": "match_method", "canonical_score_hash": "canonical_score_hash",
}


def manifest(df: DataFrame, columns: dict[str, str], claims: dict[str, object], order: list[Column]) -> DataFrame:
    """The named columns of df ('' where it has none or null) and constant claims of all rows, in order: the rows of a manifest."""
    own = [(F.coalesce(F.col(f"`{c}`"), F.lit("")) if dict(df.dtypes)[c] == "string" else F.col(f"`{c}`")).alias(n) if c in df.columns else F.lit("").alias(n) for n, c in columns.items()]
    return df.orderBy(*order).select(*own, *[F.lit(v).alias(k) for k, v in claims.items()])


def aligned_manifest(pairs: DataFrame, prefix: str, claims: dict[str, object]) -> DataFrame:
    """Accepted rows of `aligned_pairs` as a manifest, in order of the numbers that their ids are."""
    rows = gates.accepted(pairs).withColumn("match_id", F.concat(F.lit(prefix), "pair_id"))
    whole = lambda c: F.col(c).try_cast("long")
    return manifest(rows, ALIGNED, claims, [whole("score_id"), whole("number"), whole("audio_id")])


def validation(df: DataFrame, unique: list[str], present: list[str], minimum: int = 1) -> DataFrame:
    """One row of a manifest's validation: enough rows, unique columns, columns that are never empty; `passed` is all of that."""
    from ..operators import aggregates

    tests = {f"all_have_{p}": F.col(p).cast("string") != "" for p in present}
    out = aggregates.check(df, tests, unique).withColumn("minimum_passed", F.col("rows") >= minimum)
    return out.withColumn("passed", F.col("passed") & F.col("minimum_passed"))


def note_manifest(rows: DataFrame, claims: dict[str, object]) -> DataFrame:
    """Rows of `note_scores` with notes as a manifest, by song name, letter case aside, and path."""
    seconds = lambda c: F.coalesce(F.format_string("%.6f", F.bround(c, 6)), F.lit(""))
    shown = rows.filter("n_notes > 0").withColumns({"programs_json": c.json_ints(F.col("programs")), "start_seconds": F.when(F.col("first_start").isNotNull(), seconds("first_start")).otherwise(""), "end_seconds": F.when(F.col("last_end").isNotNull(), seconds("last_end")).otherwise("")})
    return manifest(shown, NOTE_ROWS, claims, [F.lower("song_name"), F.col("member")])


def abc_manifest(rows: DataFrame, claims: dict[str, object], midis: DataFrame | None = None) -> DataFrame:
    """Rows of `abc_scores` as a manifest, by content hash and path; midis (member, content) add what is known of the matched files."""
    shown = rows.withColumns({"programs_json": c.json_ints(F.col("programs")), "voice_count": F.size("voices")})
    if midis is not None:
        facts = midis.select(F.col("member").alias("midi_member"), F.sha2("content", 256).alias("midi_sha256"), F.length("content").alias("midi_size"), symbolic.midi_fields(F.col("content"), midis).alias("m"))
        facts = facts.select("midi_member", "midi_sha256", "midi_size", F.col("m.tracks").alias("midi_tracks"), F.col("m.notes").alias("midi_notes"), c.json_ints(F.col("m.programs")).alias("midi_programs"))
        shown = shown.join(facts, "midi_member", "left")
    return manifest(shown, ABC_ROWS, claims, [F.col("sha256"), F.col("member")])


def match_rate(rows: DataFrame) -> float:
    """The share of ABC scores whose MIDI file was found, 0 of none."""
    from ..operators import aggregates

    return rows.agg(aggregates.match_rate(rows, F.col("midi_member").isNotNull())).first()[0]


def unused_columns(audios: DataFrame, scores: DataFrame, headers: DataFrame, suffix: str = "_tstamp") -> DataFrame:
    """Alignment columns that no audio of the score names: (folder, alignment_column)."""
    names = headers.select("folder", F.explode("header").alias("alignment_column")).filter(F.col("alignment_column").endswith(suffix))
    names = names.withColumn("number", F.regexp_replace("alignment_column", f"{suffix}$", ""))
    return names.join(audios.join(scores, "score_id").select("folder", "number"), ["folder", "number"], "left_anti").drop("number")


# -- directory trees ----------------------------------------------------------------------------------------


def tree_scores(files: DataFrame, primary: str = ".mxl", required: tuple[str, ...] = (".mscz",), optional: tuple[str, ...] = (".mm.json",), derived: str = "_melody") -> DataFrame:
    """One row for each primary file below .../data/<composer>/<work>/<movement>/, with its siblings; derived files are left out. files has (path)."""
    kept = files.filter(~F.col("path").endswith(f"{derived}{primary}"))
    rows = joins.siblings(kept, primary, required, optional)
    inner = F.split(F.regexp_extract("path", r"(?:^|/)data/(.+)$", 1), "/")
    part = lambda i: F.regexp_replace(F.get(inner, F.lit(i)), "_", " ")
    rows = rows.withColumns({"composer": part(0), "work": part(1), "movement": F.when(F.size(inner) > 3, part(2))})
    return rows.withColumn("record_id", c.short_hash(F.array_join(inner, "/")))


# -- note lists in archives -----------------------------------------------------------------------------------


def note_scores(members: DataFrame, songs: DataFrame) -> DataFrame:
    """One row for each note list (member, content) with its notes' extent, programs, content hash and song.

    songs (key, song_name) is looked up by the letters and digits of the file's stem; keys
    that name several songs name none, and a file without one keeps its stem.
    """
    notes = symbolic.note_lists(members)
    stats = notes.groupBy("member").agg(
        F.count(F.when(~F.col("malformed"), 1)).alias("n_notes"),
        F.count(F.when(F.col("malformed"), 1)).alias("n_malformed"),
        F.min("start").alias("first_start"),
        F.max("end").alias("last_end"),
        F.min("pitch").alias("lowest"),
        F.max("pitch").alias("highest"),
        F.array_sort(F.collect_set("program")).alias("programs"),
    )
    rows = members.select("member", F.sha2("content", 256).alias("sha256"), F.length("content").alias("size"), c.stem("member").alias("stem"))
    rows = rows.withColumn("token", c.key("stem")).join(stats, "member", "left")
    table = songs.select(c.key("key").alias("token"), "song_name")
    out = joins.unambiguous_lookup(rows, table, "token", "song_name", F.col("stem"))
    out = out.withColumn("record_id", c.short_hash(F.col("member")))
    return selection.canonical_flag(out, "sha256", "member", "is_canonical")


# -- ABC scores and MIDI files -----------------------------------------------------------------------------


def marked(member: Column, markers: list[str]) -> Column:
    """Whether a slash-wrapped, lower-cased member name contains any marker."""
    whole = F.concat(F.lit("/"), F.lower(member), F.lit("/"))
    return gates.first_match([(whole.contains(m.lower()), True) for m in markers], False)


def abc_scores(scores: DataFrame, midis: DataFrame, markers: list[str], noise: tuple[str, ...] = (), hints: DataFrame | None = None, fast: bool = False, content_markers: tuple[str, ...] = ()) -> DataFrame:
    """ABC scores that belong to a collection, each with its MIDI file, if one is found without doubt.

    scores and midis have (member, content); hints has (member, names: strings of sidecar
    JSON files beside the scores; of several for one name the last by `ordinal`, or by member, counts). A score belongs if its path is marked, if a sidecar of
    the same name names a MIDI file, or if its tokens meet the MIDI index. Sidecars go before
    marks, marks before tokens.
    """
    m = midis.select(F.col("member").alias("id"), c.canonical("member", noise).alias("name"), c.tokens("member", noise).alias("tokens"))
    index = m.select(F.explode("tokens").alias("token")).distinct()
    rows = scores.select("member", "content", c.canonical("member", noise).alias("name"), c.tokens("member", noise).alias("own"), marked(F.col("member"), markers).alias("marked"))
    if hints is not None:
        order = F.col("ordinal") if "ordinal" in hints.columns else F.col("member")
        last = hints.groupBy(c.canonical("member", noise).alias("name")).agg(F.max_by("names", order).alias("names"))
        said = last.select("name", F.explode("names").alias("said")).withColumn("t", F.explode(c.tokens("said", noise)))
        said = said.join(index.withColumnRenamed("token", "t"), "t", "left_semi").groupBy("name").agg(F.array_sort(F.collect_set("t")).alias("hinted"))
        rows = rows.join(said, "name", "left")
    else:
        rows = rows.withColumn("hinted", F.lit(None).cast("array<string>"))
    met = rows.select("member", F.explode("own").alias("token")).join(index, "token", "left_semi").select("member").distinct().withColumn("met", F.lit(True))
    rows = rows.join(met, "member", "left")
    how = F.when(F.col("hinted").isNotNull(), "sidecar-json").when(F.col("marked"), "path-marker").when(F.col("met"), "midi-name-match")
    rows = rows.withColumn("selection_method", how).filter(F.col("selection_method").isNotNull())
    if content_markers:  # what the score itself says goes before all but the path
        says = c.contains_any(symbolic.text(F.col("content")), content_markers)
        rows = rows.withColumn("selection_method", F.when(says & (F.col("selection_method") != "path-marker"), "abc-content-marker").otherwise(F.col("selection_method")))
    rows = rows.withColumn("tokens", F.array_union("own", F.coalesce("hinted", F.array().cast("array<string>"))))
    left = rows.select(F.col("member").alias("id"), "name", "tokens")
    found = joins.token_match(left, m, weight=1 if fast else 5, unique_only=fast).select(F.col("lid").alias("member"), F.col("rid").alias("midi_member"), "method", "score")
    out = rows.join(found, "member", "left").withColumn("abc", symbolic.abc_fields(F.col("content")))
    out = out.withColumn("sha256", F.sha2("content", 256)).withColumn("size", F.length("content")).withColumn("record_id", c.short_hash(F.col("member")))
    out = selection.canonical_flag(out, "sha256", "member", "canonical_score_hash")
    return out.select("record_id", "member", "sha256", "size", "canonical_score_hash", "selection_method", "midi_member", F.col("method").alias("match_method"), "score", "abc.*")


def declared_count_ok(found: int, declared: int) -> bool:
    """Whether a count is within 1 % of the declared one, or 25."""
    return abs(found - declared) <= max(25, int(declared * 0.01))


# -- selected members -----------------------------------------------------------------------------------------


def selected(members: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members that are wanted, wanted paths that no member has); wanted has (member), with or without a leading './'."""
    bare = lambda x: F.regexp_replace(x, r"^(?:\./)+", "")
    names = wanted.select(bare(F.col("member")).alias("__name")).filter("__name != ''").distinct()
    tagged = members.withColumn("__name", bare(F.col("member")))
    return tagged.join(names, "__name", "left_semi").drop("__name"), names.join(tagged.select("__name"), "__name", "left_anti").withColumnRenamed("__name", "member")
