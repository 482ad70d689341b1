"""Best-fit packing of documents into fixed-length bins, under conflicts.

Rows are dealt by a hash of id and text into shards of about `shard_rows`, packed
apart from each other, so no group, hot source or cluster of copies meets in one
task. In a shard the pieces go in order of falling length. Open bins stand
ordered by residual room; each carries bitmaps of its sources (one plane for
each time a source may occur) and of its duplicate clusters. The search starts at
the successor of the wanted length and walks on until the first, so tightest,
compatible bin; if there is none, a bin opens.

Conflicts: no two documents of one cluster in a bin, and no source more than
`max_per_source` times. A document longer than a bin is cut: its full pieces fill
bins alone, the rest is packed.

Rules for odd input: a null text is empty; an empty document is a piece of length
0; repeated rows are packed as often as they come; null sources are a source;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, simhash

CAPACITY = 2048


def pack(items: list[tuple[int, int, int]], capacity: int, max_per_source: int) -> list[tuple[int, int]]:
    """(bin, offset) for each (length, source, cluster), length at most capacity; in the given order, best fit."""
    open_bins: list[tuple[int, int]] = []  # (residual, bin), ascending
    planes: list[list[int]] = []  # of each bin: bit s of plane k is set if source s is in it more than k times
    clusters: list[int] = []
    out = []
    for length, source, cluster in items:
        s, c = 1 << source, 1 << cluster
        at = bisect_left(open_bins, (length, -1))
        while at < len(open_bins):
            no = open_bins[at][1]
            if not planes[no][-1] & s and not clusters[no] & c:
                break
            at += 1
        if at < len(open_bins):
            room, no = open_bins.pop(at)
        else:
            room, no = capacity, len(planes)
            planes.append([0] * max_per_source)
            clusters.append(0)
        for k in range(max_per_source):
            if not planes[no][k] & s:
                planes[no][k] |= s
                break
        clusters[no] |= c
        out.append((no, capacity - room))
        insort(open_bins, (room - length, no))
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, max_per_source: int = 4, shard_rows: int = 1024, cluster_col: str | None = None, near: bool = False) -> DataFrame:
    """doc_id, piece, start_word, n_words, bin_id, bin_offset: one row for each piece.

    cluster_col names the duplicate cluster of a row; by default rows of equal text are one cluster,
    with `near` all rows that simhash links.
    """
    common.session(docs)
    if near:
        docs = simhash.with_fingerprint(docs, fp := common.hidden(docs, "fp")[0])
    n_rows = docs.count()
    shards = max(1, -(-n_rows // shard_rows))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    items = docs.select(
        F.pmod(F.xxhash64(F.lit("shard"), "doc_id", text), F.lit(shards)).alias("shard"),
        "doc_id",
        F.regexp_count(text, F.lit(common.WORD)).cast("long").alias("n"),
        F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("\0"))).alias("source"),
        F.col(fp).alias("fp") if near else (F.xxhash64(F.col(cluster_col)) if cluster_col else F.xxhash64(text)).alias("cluster"),
    )
    if near:
        items = simhash.classes(common.written(items, "packing-items", 4), "doc_id", "cluster").drop("fp")
    kind = docs.schema["doc_id"].dataType
    names = ["doc_id", "piece", "start_word", "n_words", "bin_id", "bin_offset"]
    schema = T.StructType([T.StructField("doc_id", kind)] + [T.StructField(c, T.LongType()) for c in names[1:]])

    def run(table: pa.Table) -> pa.Table:
        doc, n, source, cluster = (table.column(c).to_pylist() for c in ("doc_id", "n", "source", "cluster"))
        shard = table.column("shard")[0].as_py() << 32
        code = [{x: i for i, x in enumerate(dict.fromkeys(xs))} for xs in (source, cluster)]
        order = sorted(range(len(doc)), key=lambda i: (-(n[i] % capacity or min(n[i], capacity)), doc[i] is None, 0 if doc[i] is None else doc[i], cluster[i]))
        rest = [n[i] % capacity or min(n[i], capacity) for i in order]
        spots = pack([(r, code[0][source[i]], code[1][cluster[i]]) for i, r in zip(order, rest, strict=True)], capacity, max_per_source)
        last = max((no for no, _ in spots), default=-1)
        rows = []
        for i, r, (no, off) in zip(order, rest, spots, strict=True):
            full = (n[i] - r) // capacity
            for k in range(full):
                last += 1
                rows.append((doc[i], k, k * capacity, capacity, shard | last, 0))
            rows.append((doc[i], full, full * capacity, r, shard | no, off))
        cols = list(zip(*rows, strict=True))
        return pa.table({c: pa.array(v, table.schema.field("doc_id").type if c == "doc_id" else pa.int64()) for c, v in zip(names, cols, strict=True)})

    return items.groupBy("shard").applyInArrow(run, schema)


def op10(docs: DataFrame) -> DataFrame:
    """Bins of all documents; near copies never share one."""
    return packed(docs, near=True)
