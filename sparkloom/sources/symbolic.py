"""Symbolic music: ABC headers by expressions, MIDI files and note lists by parsers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship


def text(content: Column) -> Column:
    """Bytes as text, malformed bytes replaced, without a byte order mark."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^\ufeff", "")


def abc_fields(content: Column) -> Column:
    """title, composer, meter, key (first header of each), voices (distinct names), programs (distinct, 0..127, in order) of ABC text."""
    t = text(content)
    first = lambda c: F.trim(F.regexp_extract(t, rf"(?m)^{c}:[ \t]*([^\r\n]*)", 1))
    voices = F.concat(F.regexp_extract_all(t, F.lit(r"(?m)^V:[ \t]*([^\s\]]+)"), F.lit(1)), F.regexp_extract_all(t, F.lit(r"\[V:[ \t]*([^\s\]]+)"), F.lit(1)))
    programs = F.transform(F.regexp_extract_all(t, F.lit(r"(?mi)^%%MIDI[ \t]+program[ \t]+(?:\d+[ \t]+)?(\d+)"), F.lit(1)), lambda x: x.try_cast("int"))
    programs = F.array_sort(F.array_distinct(F.filter(programs, lambda p: p.between(0, 127))))
    return F.struct(first("T").alias("title"), first("C").alias("composer"), first("M").alias("meter"), first("K").alias("key"), F.array_distinct(voices).alias("voices"), programs.alias("programs"))


def varlen(data: bytes, at: int) -> tuple[int, int]:
    """(value, next position) of a variable-length number; at most four bytes."""
    value = 0
    for _ in range(4):
        byte = data[at]
        at += 1
        value = value << 7 | byte & 0x7F
        if byte < 0x80:
            break
    return value, at


def events(track: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(tick, status, data) of a track chunk; meta events have status 0xFF and their type as first byte. Stops where data ends."""
    at = tick = running = 0
    try:
        while at < len(track):
            delta, at = varlen(track, at)
            tick += delta
            status = track[at]
            if status >= 0x80:
                at += 1
            elif running:
                status = running
            else:
                at += 1
                continue
            if status == 0xFF:
                kind = track[at]
                size, lo = varlen(track, at + 1)
                yield tick, status, bytes([kind]) + track[lo : lo + size]
                at = lo + size
                if kind == 0x2F:
                    return
            elif status in (0xF0, 0xF7):
                size, lo = varlen(track, at)
                yield tick, status, track[lo : lo + size]
                at = lo + size
            elif status >= 0xF0:
                running = 0
            else:
                running = status
                size = 1 if status & 0xF0 in (0xC0, 0xD0) else 2
                if at + size > len(track):
                    return
                yield tick, status, track[at : at + size]
                at += size
    except IndexError:
        return


def chunks(data: bytes) -> tuple[int, int, list[bytes]]:
    """(format, division, tracks) of a MIDI file; junk before a track header is skipped."""
    if data[:4] != b"MThd" or len(data) < 14:
        raise ValueError("not a MIDI file")
    size = int.from_bytes(data[4:8], "big")
    kind, division = int.from_bytes(data[8:10], "big"), int.from_bytes(data[12:14], "big")
    at, out = 8 + size, []
    while (at := data.find(b"MTrk", at)) >= 0 and at + 8 <= len(data):
        size = int.from_bytes(data[at + 4 : at + 8], "big")
        out.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return kind, division, out


def midi_summary(data: bytes | None) -> dict | None:
    """format, division, tracks, notes (note-ons with velocity), programs (but those of channel 10) and an error, if any."""
    if data is None:
        return None
    try:
        kind, division, tracks = chunks(data)
    except ValueError as e:
        return {"format": None, "division": None, "tracks": 0, "notes": 0, "programs": [], "error": str(e)}
    notes, programs = 0, set()
    for t in tracks:
        for _, status, body in events(t):
            if status & 0xF0 == 0x90 and body[1] > 0:
                notes += 1
            elif status & 0xF0 == 0xC0 and status & 15 != 9:
                programs.add(body[0])
    return {"format": kind, "division": division, "tracks": len(tracks), "notes": notes, "programs": sorted(programs), "error": None}


SUMMARY = "struct<format:int,division:int,tracks:int,notes:long,programs:array<int>,error:string>"


def midi_fields(content: Column, df: DataFrame) -> Column:
    """`midi_summary` of a binary column."""
    ship(df.sparkSession)
    return F.arrow_udf(_midi_fields, SUMMARY)(content)


def _midi_fields(contents: pa.Array) -> pa.Array:
    kind = pa.struct([("format", pa.int32()), ("division", pa.int32()), ("tracks", pa.int32()), ("notes", pa.int64()), ("programs", pa.list_(pa.int32())), ("error", pa.string())])
    return pa.array([midi_summary(x) for x in contents.to_pylist()], kind)


def note_lists(members: DataFrame) -> DataFrame:
    """(member, start, end, pitch, program, malformed) of tab-separated note lists, one row for each line; a first line of names isn't one.

    Notes that aren't finite, end before they start or have a pitch or program outside 0..127 are malformed, with nulls.
    """
    lines = members.select("member", F.posexplode(F.split(text(F.col("content")), r"\r?\n")).alias("at", "line")).filter(F.trim("line") != "")
    parts = F.split("line", "\t")
    number = lambda i: F.trim(F.get(parts, F.lit(i))).try_cast("double")
    header = (F.col("at") == 0) & number(0).isNull()
    whole = lambda i: number(i).try_cast("int")
    rows = lines.filter(~header).select("member", "at", number(0).alias("start"), number(1).alias("end"), whole(2).alias("pitch"), whole(3).alias("program"))
    finite = lambda c: ~F.isnan(c) & (F.abs(F.col(c)) < float("inf"))
    ok = finite("start") & finite("end") & (F.col("end") >= F.col("start")) & F.col("pitch").between(0, 127) & F.col("program").between(0, 127)
    ok = F.coalesce(ok, F.lit(False))
    return rows.select("member", *[F.when(ok, F.col(c)).alias(c) for c in ("start", "end", "pitch", "program")], (~ok).alias("malformed"))
