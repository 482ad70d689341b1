"""Instrument families of General MIDI programs (0-based): five mappings that differ on purpose.

ranked and tiered give each program one family or none; record_v1, record_v2 and
balance may give several, so totals over families exceed those over tracks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (first, last) ranges of programs by mapping and family; for ranked and tiered the first that matches counts.
FAMILIES: dict[str, list[tuple[str, list[tuple[int, int]]]]] = {
    "ranked": [
        ("keyboard", [(0, 23)]),
        ("guitar_band", [(24, 39)]),
        ("strings", [(40, 46), (48, 51)]),
        ("percussion", [(47, 47), (112, 119)]),
        ("voice", [(52, 54)]),
        ("brass", [(56, 63)]),
        ("woodwinds", [(64, 79)]),
    ],
    "tiered": [
        ("piano", [(0, 7)]),
        ("chromatic_percussion", [(8, 15)]),
        ("organ_keyboard", [(16, 23)]),
        ("guitar", [(24, 31)]),
        ("band_bass", [(32, 39)]),
        ("bowed_strings", [(40, 45), (48, 49)]),
        ("harp", [(46, 46)]),
        ("timpani", [(47, 47)]),
        ("synth_strings", [(50, 51)]),
        ("voice", [(52, 54)]),
        ("orchestra_hit", [(55, 55)]),
        ("brass", [(56, 61)]),
        ("synth_brass", [(62, 63)]),
        ("saxophone", [(64, 67)]),
        ("woodwind", [(68, 79)]),
        ("synth", [(80, 103)]),
        ("ethnic", [(104, 111)]),
        ("orchestral_percussion", [(112, 119)]),
        ("sound_effect", [(120, 127)]),
    ],
    "record_v1": [
        ("piano", [(0, 7)]),
        ("keys", [(0, 23)]),
        ("guitar", [(24, 31)]),
        ("bass", [(32, 39)]),
        ("strings", [(40, 49)]),
        ("voice", [(52, 54)]),
        ("brass", [(56, 61)]),
        ("sax", [(64, 67)]),
        ("woodwind", [(64, 79)]),
        ("synth", [(50, 51), (54, 55), (62, 63), (80, 103)]),
        ("percussion_program", [(8, 14), (47, 47), (108, 119)]),
        ("sfx", [(120, 127)]),
    ],
    "record_v2": [
        ("piano", [(0, 7)]),
        ("keys", [(0, 7), (16, 23)]),
        ("chromatic_percussion", [(8, 15)]),
        ("guitar", [(24, 31)]),
        ("bass", [(32, 39)]),
        ("strings", [(40, 46), (48, 49)]),
        ("section_strings", [(40, 45), (48, 49)]),
        ("voice", [(52, 53)]),
        ("brass", [(56, 61)]),
        ("sax", [(64, 67)]),
        ("woodwind", [(64, 79)]),
        ("synth", [(50, 51), (54, 54), (62, 63), (80, 103)]),
        ("percussion_program", [(8, 14), (47, 47), (108, 119)]),
        ("sfx", [(120, 127)]),
    ],
    "balance": [
        ("keys", [(0, 23)]),
        ("guitar", [(24, 31)]),
        ("bass", [(32, 39)]),
        ("strings", [(40, 46), (48, 49)]),
        ("voice", [(52, 53)]),
        ("brass", [(56, 61)]),
        ("woodwind", [(64, 79)]),
        ("synth", [(50, 51), (54, 55), (62, 63), (80, 103)]),
        ("percussion", [(8, 15), (47, 47), (112, 119)]),
        ("sfx", [(120, 127)]),
    ],
}


def family_of(program: Column, mapping: str) -> Column:
    """The one family of a program under `ranked` or `tiered`; null if none."""
    out = None
    for name, ranges in FAMILIES[mapping]:
        test = F.lit(False)
        for lo, hi in ranges:
            test = test | program.between(lo, hi)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out


def family_table(spark: SparkSession, mapping: str) -> DataFrame:
    """(program, family), at most 128 programs times some twenty families: small enough to broadcast at any scale."""
    rows = [(p, name) for name, ranges in FAMILIES[mapping] for lo, hi in ranges for p in range(lo, hi + 1)]
    return spark.createDataFrame(rows, "program int, family string")


def in_family(numbers: Column, mapping: str, *names: str) -> Column:
    """How many of an array's programs are in any of the families, each counted once for each family it is in."""
    total = F.lit(0)
    for name, ranges in FAMILIES[mapping]:
        if name in names:
            total = total + F.size(F.filter(numbers, _tester(ranges)))
    return total


def _tester(ranges: list[tuple[int, int]]):
    return lambda p: _within(p, ranges)


def _within(p: Column, ranges: list[tuple[int, int]]) -> Column:
    test = F.lit(False)
    for lo, hi in ranges:
        test = test | p.between(lo, hi)
    return test
