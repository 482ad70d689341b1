"""SimHash near-duplicates by multi-index hashing, and their connected components.

A 64-bit fingerprint is cut into segments. By the general pigeonhole rule, two
fingerprints at Hamming distance r or less agree within radius t_i on some
segment i as long as the sum of (t_i + 1) exceeds r. So each fingerprint is
filed under its segment values, and looks up the small Hamming ball of each of
its segments; every candidate's complete distance is then verified.

Rules for odd input: a null text is empty; a text without words has fingerprint
zero, which links like any other; rows with a null id take part but never name
a component; repeated rows come out as often as they came in; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: (segment widths, radii): each covers distance 4, as sum(t + 1) = 5 > 4.
PLANS = (((23, 23, 18), (1, 1, 0)), ((36, 28), (1, 2)), ((32, 32), (1, 2)))
#: A plan is for as many fingerprints as fill its narrowest table with this many to a bucket, if they were random.
FILL = 32
#: Bits by which fingerprints are turned before full buckets are cut by segments once more, so that other bits meet.
TURN = 11
MAX_DISTANCE = 4


def fingerprint(data: bytes, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of UTF-8 text: XXH64 of every run of `shingle` lower-cased words, majority per bit."""
    words = data.lower().split()
    n = len(words)
    if not n:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if n <= shingle:
        hashes = [digest(joined, seed)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = np.concatenate(([0], ends))[: n - shingle + 1].tolist()
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)]
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[at : at + (1 << 16)], np.uint64)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(id, fp) for each row, fp being the fingerprint as a signed long."""
    common.session(docs)
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.binary())
            fps = np.array([fingerprint(t or b"", shingle, seed) for t in texts.to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def choose_plan(n: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """The plan with the fewest lookups whose buckets n distinct fingerprints don't fill by chance. All plans are exact."""
    return next((p for p in PLANS if n <= FILL << min(p[0])), PLANS[-1])


def _masks(width: int, radius: int) -> list[int]:
    out = [0]
    if radius >= 1:
        out += [1 << i for i in range(width)]
    if radius >= 2:
        out += [1 << i | 1 << j for i in range(width) for j in range(i)]
    return out


def _keys(fp, widths: tuple[int, ...], radii: tuple[int, ...] | None):
    """An array column of (segment, value) codes: the own ones, or those of the whole Hamming balls, each ball's own code first."""
    parts, low = [], 0
    for i, w in enumerate(widths):
        code = F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << w) - 1)) + F.lit(i << 58)
        if radii is None or radii[i] == 0:
            parts.append(F.array(code))
        else:
            masks = F.array(*[F.lit(m).cast("long") for m in _masks(w, radii[i])]) if radii[i] == 1 else F.expr(_two_masks(w))
            parts.append(_ball(code, masks))
        low += w
    return F.concat(*parts)


def _ball(code, masks):
    return F.transform(masks, lambda m: code.bitwiseXOR(m))


def _two_masks(width: int) -> str:
    one = f"transform(sequence(0, {width - 1}), i -> shiftleft(1L, i))"
    two = f"flatten(transform(sequence(1, {width - 1}), i -> transform(sequence(0, i - 1), j -> shiftleft(1L, i) | shiftleft(1L, j))))"
    return f"concat(array(0L), {one}, {two})"


def _met(probes: DataFrame, filed: DataFrame, keys: list[str], max_bucket: int, *rest: str) -> DataFrame:
    """For each lookup: fp, keys, rest, whether its bucket is full (hot), else the lesser members within MAX_DISTANCE (near). Lookups without either are left out.

    Both sides are exploded rows, whose number the planner doesn't foresee: it must not broadcast one.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("fp"))
    buckets = filed.withColumn("rn", rank).filter(F.col("rn") <= max_bucket + 1).groupBy(*keys).agg(F.collect_list("fp").alias("members"))
    near = F.filter("members", lambda m: (m < F.col("fp")) & (F.bit_count(m.bitwiseXOR(F.col("fp"))) <= MAX_DISTANCE))
    hot = F.size("members") > max_bucket
    none = F.expr("cast(array() as array<bigint>)")
    both = probes.hint("merge").join(buckets.hint("merge"), keys)
    met = both.select("fp", *keys, *rest, hot.alias("hot"), F.when(hot, none).otherwise(near).alias("near"))
    return common.written(met.filter(F.col("hot") | (F.size("near") > 0)), "simhash-met", 4)


def _pairs(met: DataFrame) -> DataFrame:
    return met.select(F.col("fp").alias("a"), F.explode("near").alias("b")).distinct()


def links(nodes: DataFrame, n: int, max_bucket: int = 256, plan=None) -> DataFrame:
    """(a, b), a > b: all pairs of distinct fingerprints within distance 4 that meet in a bucket of up to max_bucket;
    where they meet in fuller buckets only, star edges that connect just what their links would connect.

    The members of a full bucket, and those that look it up, are filed and looked up once more
    by bucket and segments of the turned fingerprint, which parts fingerprints that only share the first
    segment: two within distance 4 meet under some first and some second segment. What is full even
    then is a dense cluster, whose links are as many as the square of its size. For it the whole
    fingerprint is the one segment: each is filed under its Hamming ball of radius 2, and a and b are
    within 4 exactly if their balls meet. Each gets an edge to the least fingerprint filed under each value, which
    is linear in the number of such fingerprints, and the least-of is combined before the shuffle.
    """
    widths, radii = plan or choose_plan(n)
    code = F.explode(_keys(F.col("fp"), widths, radii)).alias("key")
    own = F.array_contains(_keys(F.col("fp"), widths, None), F.col("key")).alias("own")
    met = _met(nodes.select("fp", code).select("*", own), nodes.select("fp", F.explode(_keys(F.col("fp"), widths, None)).alias("key")), ["key"], max_bucket, "own")
    out = _pairs(met)
    full = met.filter("hot").select("fp", "key", "own")
    if full.isEmpty():
        return out
    turned = F.shiftleft("fp", TURN).bitwiseOR(F.shiftrightunsigned("fp", 64 - TURN))
    again = lambda rows, radii: rows.select("fp", "key", F.explode(_keys(turned, PLANS[0][0], radii)).alias("key2"))
    deep = _met(again(full, PLANS[0][1]), again(full.filter("own"), None), ["key", "key2"], max_bucket)
    out = out.unionByName(_pairs(deep))
    crowd = deep.filter("hot").select("fp").distinct()
    ball = crowd.select("fp", F.explode(F.transform(F.expr(_two_masks(64)), lambda m: m.bitwiseXOR(F.col("fp")))).alias("mid"))
    least = ball.groupBy("mid").agg(F.min("fp").alias("b"))
    star = ball.hint("merge").join(least.hint("merge"), "mid").filter(F.col("fp") > F.col("b")).select(F.col("fp").alias("a"), "b")
    return out.unionByName(star.distinct()).distinct()


def _with_least(edges: DataFrame) -> DataFrame:
    """edges (a, b) and m, the least b of their a. The centre of a star may have a large part of all edges: its rows are dealt out by b."""
    least = common.written(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), "links-least", 4)
    total = least.agg(F.sum("n")).first()[0] or 0
    hot = common.hot_keys(least, "a", "n", total, common.partitions(edges.sparkSession))
    return common.salted_left_join(edges, least.drop("n"), "a", hot, "b")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): for each node of the edges (a, b) the least node it can reach.

    Alternates the large-star and small-star steps, which keep all connections
    and shorten paths, until the edges stop changing. Each step is written to
    the shared folder. Raises if max_rounds don't suffice (they do for 2^30 nodes).
    """
    now = common.written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct(), "links")
    seen = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).withColumn("m", F.least("a", "m")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = common.written(large.filter("a > b").distinct(), "links-large")
        pairs = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        now = common.written(_with_least(large).select(F.explode(pairs).alias("e")).select("e.a", "e.b").filter("a > b").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % F.lit(1 << 40))).first()
        if state == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
    raise RuntimeError("components: not settled")


def _grouped(each: DataFrame, max_bucket: int = 256, plan=None) -> DataFrame:
    """(fp, rep, rows, root, least) for each distinct fingerprint of `each` (id, fp): the least id and the number of its rows, the
    least fingerprint that links reach, and the least id of the component.

    Pairs are never formed among copies: equal fingerprints fold into one node
    first, so a group of any size is one row of the search.
    """
    nodes = common.written(each.groupBy("fp").agg(F.min("id").alias("rep"), F.count("*").alias("rows")), "simhash-nodes", 4)
    roots = components(links(nodes, nodes.count(), max_bucket, plan))
    tied = roots.select(F.col("node").alias("fp"), "root").unionByName(roots.select(F.col("root").alias("fp"), "root")).distinct()
    tied = tied.join(nodes.select("fp", "rep"), "fp")
    least = tied.groupBy("root").agg(F.min("rep").alias("least"))
    tied = tied.join(least, "root").select("fp", "root", "least")
    return nodes.join(tied, "fp", "left").select("fp", "rep", "rows", F.coalesce("root", "fp").alias("root"), F.coalesce("least", "rep").alias("least"))


def _dealt(rows: DataFrame, groups: DataFrame, by: str, *columns: str) -> DataFrame:
    """rows (with fp) and the given columns of groups, hot fingerprints salted by `by`."""
    groups = common.written(groups, "simhash-groups", 4)
    total = groups.agg(F.sum("rows")).first()[0] or 0
    hot = common.hot_keys(groups, "fp", "rows", total, common.partitions(rows.sparkSession))
    return common.salted_left_join(rows, groups.select("fp", *columns), "fp", hot, by)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42, max_bucket: int = 256, plan=None) -> DataFrame:
    """(id, fp, component) for each row of docs; component is the least id that can be reached by links."""
    each = common.written(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp", 4)
    groups = _grouped(each, max_bucket, plan).withColumnRenamed("least", "component")
    return _dealt(each, groups, "id", "component").select("id", "fp", "component")


def with_fingerprint(docs: DataFrame, name: str, text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """docs and the fingerprint of each row's text as the column `name`."""
    common.session(docs)

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        fps = np.array([fingerprint(t or b"", shingle, seed) for t in texts.cast(pa.binary()).to_pylist()], np.uint64)
        return pa.array(fps.view(np.int64))

    return docs.withColumn(name, run(F.col(text_col).cast("string")))


def classes(rows: DataFrame, id_col: str, name: str) -> DataFrame:
    """rows (with fp) and, as the column `name`, the least fingerprint of each row's component: a near-duplicate class by row, whatever the ids.

    rows are read more than once.
    """
    groups = _grouped(rows.select(F.col(id_col).alias("id"), "fp")).withColumnRenamed("root", name)
    return _dealt(rows, groups, id_col, name)


def op9(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for each row of documents."""
    return near_duplicates(docs).select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without the near copies: of each component one row of the least id stays (null ids come last).

    Rows are told apart by id and fingerprint: documents of unlike texts that
    share an id, or have none, are judged each by its own component.
    """
    names = docs.columns
    fp, rep, mark = common.hidden(docs, "fp", "rep", "mark")
    rows = common.written(with_fingerprint(docs, fp, text_col), "simhash-rows")
    groups = _grouped(rows.select(F.col(id_col).alias("id"), F.col(fp).alias("fp")))
    # each fingerprint's least id is its rep, so that of the component is among them
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "fp")).alias("s"))
    stay = first.select(F.col("s.rep").alias(rep), F.col("s.fp").alias(mark))
    kept = rows.join(stay, F.col(id_col).eqNullSafe(F.col(rep)) & (F.col(fp) == F.col(mark)), "left_semi")
    return kept.dropDuplicates([id_col, fp]).select(*[F.col(f"`{c}`") for c in names])
