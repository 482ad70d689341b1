"""Rule tables of the catalogues, as data: conditions and values in SQL over named features.

`operators.gates.decided` compiles a table to one numbered CASE; the first row that holds counts.
"""

from __future__ import annotations

#: Fixed values of the ranked catalogue. Features: tracks_n, notes, bars, seconds, programs by family
#: (strings, woodwinds, brass, percussion, keyboard, guitar_band, voice), sections (of the first four), orchestral
#: (their sum), ratio, and what the text says.
RANKED = [
    {
        "when": "tracks_n >= 8 AND strings >= 2 AND woodwinds >= 1 AND brass >= 1 AND (guitar_band <= 2 OR says_orchestra)",
        "orchestra_class": "'full_orchestra'",
        "confidence_tier": "if(says_orchestra OR says_full_score, 'A', 'B')",
        "selection_reason": "concat('string, woodwind and brass sections', if(says_orchestra OR says_full_score, ' with explicit orchestra/full-score metadata', ''))",
    },
    {
        "when": "tracks_n >= 5 AND strings >= 3 AND strings / tracks_n >= 0.5 AND guitar_band = 0 AND keyboard <= 1",
        "orchestra_class": "'string_orchestra'",
        "confidence_tier": "CASE WHEN says_strings AND says_full_score THEN 'A' WHEN says_strings THEN 'B' ELSE 'C' END",
        "selection_reason": "'predominantly multi-part string instrumentation'",
    },
    {
        "when": "tracks_n >= 6 AND woodwinds >= 2 AND brass >= 2 AND woodwinds + brass + percussion >= 5 AND guitar_band <= 1 AND keyboard <= 2",
        "orchestra_class": "'wind_orchestra'",
        "confidence_tier": "CASE WHEN says_winds AND percussion > 0 THEN 'A' WHEN says_winds THEN 'B' ELSE 'C' END",
        "selection_reason": "'dense woodwind, brass and percussion instrumentation'",
    },
    {
        "when": "says_orchestra AND tracks_n >= 6 AND sections >= 2 AND strings >= 1",
        "orchestra_class": "'explicit_orchestra'",
        "confidence_tier": "'B'",
        "selection_reason": "'explicit orchestra metadata and multiple orchestral families'",
    },
    {
        "when": "tracks_n >= 6 AND strings >= 2 AND orchestral - strings >= 2 AND orchestral >= 5 AND ratio >= 0.55 AND guitar_band <= 1 AND keyboard <= 2",
        "orchestra_class": "'chamber_orchestra'",
        "confidence_tier": "'C'",
        "selection_reason": "'multi-track strings plus additional orchestral tracks with an orchestral-majority palette'",
    },
    {
        "when": "tracks_n >= 8 AND strings >= 2 AND sections >= 3 AND orchestral - strings >= 3 AND ratio >= 0.5 AND guitar_band <= greatest(1, tracks_n div 4) AND keyboard <= greatest(3, tracks_n div 2)",
        "orchestra_class": "'inferred_orchestra'",
        "confidence_tier": "'C'",
        "selection_reason": "'large score with multi-track strings and at least three orchestral families'",
    },
    {
        "when": "tracks_n >= 6 AND strings >= 1 AND sections >= 2 AND orchestral >= 4 AND ratio >= 0.5 AND guitar_band <= 1 AND keyboard <= 2",
        "orchestra_class": "'orchestral_ensemble'",
        "confidence_tier": "'C'",
        "selection_reason": "'six-or-more-track score with an orchestral-majority palette'",
    },
]
#: Rows that aren't looked at any further.
RANKED_OUT = "tracks_n < 5 OR notes < 200 OR (bars <> 0 AND bars < 12) OR (seconds <> 0 AND seconds < 25) OR says_excluded"
#: Terms of the quality score, added up.
RANKED_SCORE = [
    "CASE confidence_tier WHEN 'A' THEN 100D WHEN 'B' THEN 70D ELSE 45D END",
    "0.8D * least(tracks_n, 30)",
    "6 * sections",
    "1.5D * least(strings, 6)",
    "least(woodwinds, 6)",
    "least(brass, 6)",
    "if(says_full_score, 8, 0)",
    "if(is_official, 6, 0)",
    "if(has_annotations, 4, 0)",
    "2 * least(greatest(rating, 0D), 5D)",
    "least(2 * log10(ratings_n + 1), 6D)",
    "least(1.5D * log10(views_n + 1), 9D)",
    "least(2 * log10(notes + 1), 10D)",
    "-if(keyboard > greatest(2, tracks_n div 3), 5, 0)",
    "-if(voice > 0 AND sections < 3, 4, 0)",
    "-1.5D * least(guitar_band, 4)",
]

#: Fixed values of the tiered manifest: rows that go before any rule, in order.
TIERED_OUT = [
    ("tracks_n < 4", "too_few_tracks"),
    ("notes <> 0 AND notes < 120", "too_few_notes"),
    ("bars <> 0 AND bars < 8", "too_few_bars"),
    ("seconds <> 0 AND seconds < 15", "too_short"),
    ("says_reduction", "reduction_or_piano_vocal_score"),
    ("says_part", "individual_part"),
]
#: What is said of rows that no rule accepts, in order.
TIERED_REST = [
    ("says_band", "explicit_non_orchestral_band"),
    ("keys_lead", "keyboard_dominant"),
    ("band_leads", "guitar_or_band_bass_dominant"),
    ("true", "insufficient_orchestra_evidence"),
]
#: Level, class, base score, condition, and the basis as a format with its values.
TIERED = [
    ("strict", "if(voice > 0 AND says_stage, 'orchestra.full.vocal_stage', 'orchestra.full.symphonic')", 84, "tracks_n >= 9 AND bowed >= 3 AND woodwind >= 1 AND brass >= 1 AND orchestral >= 7 AND ratio >= 0.55 AND NOT band_leads AND NOT says_band", "tracks=%d;strings=%d;woodwind=%d;brass=%d;percussion=%d;ratio=%.3f", "tracks_n, bowed, woodwind, brass, drums, bround(ratio, 3)"),
    ("strict", "'orchestra.string'", 82, "tracks_n >= 5 AND bowed >= 4 AND (bowed + harp) / tracks_n >= 0.6 AND woodwind + brass + saxophone = 0 AND guitar = 0 AND bass <= 1 AND keys <= 1 AND NOT says_band", "tracks=%d;strings=%d;harp=%d;string_ratio=%.3f", "tracks_n, bowed, harp, bround((bowed + harp) / tracks_n, 3)"),
    ("strict", "'orchestra.wind'", 80, "says_winds AND tracks_n >= 8 AND woodwind + saxophone >= 3 AND brass >= 3 AND guitar <= 1 AND bass <= 1 AND NOT says_jazz", "explicit wind ensemble;tracks=%d;woodwind+sax=%d;brass=%d;percussion=%d", "tracks_n, woodwind + saxophone, brass, drums"),
    ("strict", "'orchestra.full.vocal_stage'", 79, "voice > 0 AND tracks_n >= 9 AND bowed >= 3 AND woodwind >= 1 AND brass >= 1 AND ratio >= 0.45 AND NOT band_leads", "voice=%d;strings=%d;woodwind=%d;brass=%d", "voice, bowed, woodwind, brass"),
    ("probable", "'orchestra.chamber'", 68, "tracks_n >= 6 AND bowed >= 2 AND sections >= 2 AND orchestral >= 5 AND ratio >= 0.5 AND guitar <= 1 AND bass <= 1 AND keys <= 2 AND NOT says_band", "tracks=%d;orchestral_tracks=%d;families=%d;ratio=%.3f", "tracks_n, orchestral, sections, bround(ratio, 3)"),
    ("probable", "'orchestra.explicit_metadata'", 66, "says_orchestra AND tracks_n >= 6 AND orchestral >= 4 AND sections >= 2 AND NOT says_band AND NOT band_leads AND NOT keys_lead", "tracks=%d;orchestral_tracks=%d;families=%d", "tracks_n, orchestral, sections"),
    ("probable", "'orchestra.string'", 65, "says_strings AND tracks_n >= 5 AND bowed >= 3 AND guitar <= 1 AND keys <= 2 AND NOT says_band", "explicit string orchestra;tracks=%d;strings=%d", "tracks_n, bowed"),
    ("probable", "'orchestra.wind'", 64, "says_winds AND tracks_n >= 7 AND woodwind + saxophone >= 2 AND brass >= 2 AND NOT says_jazz", "tracks=%d;woodwind+sax=%d;brass=%d", "tracks_n, woodwind + saxophone, brass"),
    ("candidate", "'orchestra.large_palette_candidate'", 50, "tracks_n >= 8 AND orchestral >= 5 AND sections >= 2 AND ratio >= 0.38 AND guitar + bass <= greatest(2, tracks_n div 4) AND keys <= greatest(3, tracks_n div 2) AND NOT says_band", "tracks=%d;orchestral_tracks=%d;families=%d;ratio=%.3f", "tracks_n, orchestral, sections, bround(ratio, 3)"),
    ("candidate", "'orchestra.explicit_candidate'", 48, "says_orchestra AND tracks_n >= 5 AND orchestral >= 3 AND NOT says_band AND NOT band_leads AND NOT keys_lead", "explicit orchestra text;tracks=%d;orchestral_tracks=%d", "tracks_n, orchestral"),
    ("candidate", "'orchestra.vocal_stage_candidate'", 46, "says_stage AND tracks_n >= 8 AND bowed >= 2 AND orchestral >= 4 AND sections >= 2 AND NOT keys_lead", "stage work;tracks=%d;voice=%d;orchestral_tracks=%d", "tracks_n, voice, orchestral"),
    ("candidate", "'orchestra.full_score_text_candidate'", 44, "says_full_score AND tracks_n >= 6 AND orchestral >= 2 AND NOT says_band AND NOT band_leads", "full-score text;tracks=%d;orchestral_tracks=%d", "tracks_n, orchestral"),
]
#: The score beside the base, held to 0..100.
TIERED_SCORE = "if(says_full_score, 8, 0) + if(says_orchestra OR says_strings OR says_winds, 5, 0) + least(tracks_n, 30) div 3 + 2 * least(sections, 4) - if(says_band, 8, 0) - least(guitar + bass, 5) - if(keys_lead, 4, 0)"

#: Fixed values of the record manifest: class, confidence, condition, and the basis as a format with its values.
#: Features: programs_n, of each family, violins, violas, cellos, trumpets, trombones; `says` has the words of the text. {strings} is what a version calls its strings.
RECORDS = [
    ("chamber.string_quartet", "'high'", "programs_n = 4 AND violins = 2 AND violas = 1 AND cellos = 1", "2 violin+viola+cello GM tracks", ""),
    ("orchestra.full.symphonic", "if(says RLIKE 'orchestra|symph|philharmonic|sinfon', 'high', 'medium')", "strings >= 5 AND woodwind >= 2 AND brass >= 2 AND programs_n >= 10", "{strings}=%d;woodwind=%d;brass=%d", "strings, woodwind, brass"),
    ("orchestra.string", "'medium'", "strings >= 4 AND woodwind = 0 AND brass = 0", "{strings}=%d;no wind/brass", "strings"),
    ("orchestra.chamber", "'medium'", "strings >= 2 AND woodwind + brass >= 1 AND programs_n >= 5", "{strings}=%d;wind+brass=%d", "strings, woodwind + brass"),
    ("wind.concert_band_candidate", "'medium'", "woodwind >= 5 AND brass >= 3 AND strings <= 1 AND programs_n >= 8", "woodwind=%d;brass=%d;drumkit unknown", "woodwind, brass"),
    ("brass_band_candidate", "'medium'", "brass >= 6 AND woodwind <= 1 AND strings <= 1", "brass=%d", "brass"),
    ("jazz.big_band_candidate", "if(says RLIKE 'jazz|big band', 'medium', 'low')", "saxes >= 4 AND trumpets >= 3 AND trombones >= 2 AND programs_n >= 10", "sax=%d;trumpet=%d;trombone=%d;drumkit unknown", "saxes, trumpets, trombones"),
    ("jazz.combo_candidate", "'medium'", "says RLIKE 'jazz|bossa|swing' AND programs_n BETWEEN 3 AND 9 AND basses > 0 AND (pianos > 0 OR guitars > 0)", "jazz metadata+bass+piano/guitar", ""),
    ("choir.vocal_ensemble", "if(says RLIKE 'choir|choral', 'medium', 'low')", "voices >= 2", "{voices}=%d", "voices"),
    ("voice.piano", "'medium'", "voices > 0 AND pianos > 0 AND programs_n <= 4", "{voice}+piano", ""),
    ("solo.piano", "'high'", "programs_n = 1 AND pianos > 0", "single piano program track", ""),
    ("solo.guitar", "'high'", "programs_n = 1 AND guitars > 0", "single guitar program track", ""),
    ("band.pop_rock_candidate", "'low'", "programs_n >= 3 AND basses > 0 AND guitars > 0 AND (pianos > 0 OR synths > 0)", "bass+guitar+keys/synth;drumkit unknown", ""),
    ("electronic.synth_ensemble", "'medium'", "synths >= 2 AND synths >= greatest(2, programs_n div 2)", "synth=%d/%d", "synths, programs_n"),
]
RECORD_REST = ("ensemble.mixed_or_unclassified", "low", "no canonical pattern proven from GM program list")
#: What versions 1 and 2 call things in a basis, the family that counts as strings, and the columns whose words are read.
RECORD_VERSIONS = {
    1: {"strings": "string", "voices": "voice_program_tracks", "voice": "voice", "family": "strings", "text": ("title", "song_name", "genres", "tags", "groups")},
    2: {"strings": "section_string", "voices": "acoustic_voice_program_tracks", "voice": "acoustic voice", "family": "section_strings", "text": ("title", "song_name", "genres")},
}

#: Band tiers of multi-instrument rows, best first, and the rest.
BANDS = ("strict_core_band", "rhythm_section_band", "genre_labeled_band", "broad_multi_instrument_ensemble", "multi_instrument_other")
BAND_REST = "not_multi_instrument"
