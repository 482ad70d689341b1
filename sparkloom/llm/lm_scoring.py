"""Deleted-interpolation language model: corpus-wide counts, and scores of whole texts.

P(w | h) = l2 c(h w) / c(h) + l1 c(w) / N + l0 / (V + 1), where the weights l depend
on the bucket of c(h) (none, then powers of two). They are learned by
expectation-maximisation on the deleted part: a tenth of the training rows, whose
counts are taken out of c for that purpose. Scores then use the counts of all training rows.

Counts are of all training texts and aren't capped; they live in no single place:

1. Rows are bundled into blocks of some MB of text, which are written to the shared folder.
2. Each block asks for the counts of its distinct words and word pairs, as sorted
   arrays of 64-bit hashes (XXH3; pairs mix two of them) with its own training counts
   beside them, cut by ranges of hash into buckets. Copies and frequent pairs shrink to
   one number a block before the shuffle, and ranges of a hash are even.
3. Each bucket adds up and answers each block with the totals, in the order asked.
4. Blocks meet their answers and score their texts.

Rules for odd input: a null text is empty, that is one end token; rows with a null
id are training rows; repeated rows count as often as they come; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BLOCK_BYTES = 4 << 20
END = 0x9E3779B97F4A7C15
BUCKETS = 34  # of context counts: 0, then 1, 2-3, 4-7, ...
ROUNDS, SETTLED = 12, 2e-4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(7)) == 2, F.lit(False))


def deleted(doc_id: Column) -> Column:
    """A tenth of the training rows, on whose texts the weights are learned."""
    part = F.expr("pmod(crc32(cast(id as string)) div 7, 10)") == 0
    return F.coalesce(part & ~held_out(doc_id), F.lit(False))


def _squeeze(a: np.ndarray) -> bytes:
    """Bytes of an array, plane by plane, compressed: high bytes of sorted keys and of counts take next to nothing."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expand(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Bundles of rows: block, em (deleted part), ids, held (flags), sizes (bytes of each text), body (the texts)."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("em", T.BooleanType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("held", T.ArrayType(T.BooleanType())),
            T.StructField("sizes", T.ArrayType(T.LongType())),
            T.StructField("body", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial, id_type = TaskContext.get().partitionId(), 0, pa.int64()
        todo = {False: [], True: []}
        held_bytes = {False: 0, True: 0}

        def bundle(em: bool) -> pa.RecordBatch:
            nonlocal serial
            rows, todo[em], held_bytes[em] = todo[em], [], 0
            body = zstandard.ZstdCompressor(level=3).compress(b"".join(t for _, _, t in rows))
            columns = [[task << 32 | serial], [em], [[i for i, _, _ in rows]], [[h for _, h, _ in rows]], [[len(t) for _, _, t in rows]], [body]]
            types = [pa.int64(), pa.bool_(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
            serial += 1
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        for b in batches:
            id_type = b.schema.field(0).type
            texts = b.column(1).cast(pa.binary()).to_pylist()
            for i, t, h, em in zip(b.column(0).to_pylist(), texts, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                todo[em].append((i, h, t or b""))
                held_bytes[em] += len(t or b"") + 64
                if held_bytes[em] >= BLOCK_BYTES:
                    yield bundle(em)
        for em in (False, True):
            if todo[em]:
                yield bundle(em)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("id", "text", held_out(F.col("id")).alias("held"), deleted(F.col("id")).alias("em")).mapInArrow(run, schema)


class Tokens:
    """The tokens of a block: sorted distinct word and pair keys, and where each token's are."""

    def __init__(self, held: list[bool], sizes: list[int], body: bytes):
        body = zstandard.ZstdDecompressor().decompress(body).lower()
        at, hashes, lengths, digest = 0, [], [], xxhash.xxh3_64_intdigest
        for size in sizes:
            own = list(map(digest, body[at : at + size].split()))
            own.append(END)
            hashes += own
            lengths.append(len(own))
            at += size
        word = np.array(hashes, np.uint64)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        before = np.concatenate((word[:1], word[:-1]))
        before[self.starts] = END
        pair = (before * np.uint64(0xC2B2AE3D27D4EB4F)) ^ ((word << np.uint64(31)) | (word >> np.uint64(33)))
        pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        pair ^= pair >> np.uint64(32)
        self.train = np.repeat(~np.array(held, bool), self.lengths)
        self.words, self.word_at = np.unique(word, return_inverse=True)
        self.pairs, self.pair_at = np.unique(pair, return_inverse=True)
        end = int(np.searchsorted(self.words, np.uint64(END)))
        self.context_at = np.concatenate(([end], self.word_at[:-1]))
        self.context_at[self.starts] = end

    def own(self, which: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and their training counts in this block."""
        keys, at = ((self.words, self.word_at), (self.pairs, self.pair_at))[which]
        return keys, np.bincount(at[self.train], minlength=len(keys)).astype(np.uint32)


ASKED = "block long, em boolean, which int, bucket int, keys binary, counts binary"
TOLD = "block long, which int, bucket int, n long, total binary, part binary"


def asked(bundles: DataFrame, parts: int) -> DataFrame:
    """Requests: for each block, kind of key and bucket one row with its keys and training counts."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                tokens = Tokens(r["held"], r["sizes"], r["body"])
                rows = []
                for which in (0, 1):
                    keys, counts = tokens.own(which)
                    cuts = np.searchsorted(((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32), np.arange(parts + 1, dtype=np.uint64))
                    for k in range(parts):
                        lo, hi = cuts[k], cuts[k + 1]
                        if hi > lo:
                            rows.append((r["block"], r["em"], which, k, _squeeze(keys[lo:hi]), _squeeze(counts[lo:hi])))
                names = ["block", "em", "which", "bucket", "keys", "counts"]
                types = [pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                for at in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 256], strict=True), types, strict=True)], names=names)

    return bundles.select("block", "em", "held", "sizes", "body").mapInArrow(run, ASKED)


def told(requests: DataFrame, parts: int) -> DataFrame:
    """Answers: total counts for each request, for the deleted part also its own; block -1 has N and V of a bucket.

    Each bucket is a partition of its own, so that a task's share follows the number of buckets, not the chance by which a hash would throw several together.
    """

    def run(table: pa.Table) -> pa.Table:
        out = []
        bucket = table.column("bucket")[0].as_py()
        for which in (0, 1):
            t = table.filter(pa.compute.equal(table.column("which"), which))
            if not t.num_rows:
                continue
            block, em = t.column("block").to_pylist(), t.column("em").to_pylist()
            keys = [_expand(x.as_py(), np.uint64) for x in t.column("keys")]
            counts = [_expand(x.as_py(), np.uint32) for x in t.column("counts")]
            every, at = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(at, np.concatenate(counts), len(every)).astype(np.int64)
            from_em = np.repeat(np.array(em, bool), list(map(len, keys)))
            part = np.bincount(at, np.concatenate(counts) * from_em, len(every)).astype(np.int64)
            if which == 0:
                out += [(-1, 0, bucket, int(total.sum()), None, None), (-1, 1, bucket, int((total > 0).sum()), None, None), (-1, 2, bucket, int(part.sum()), None, None)]
            lo = 0
            for b, e, k in zip(block, em, keys, strict=True):
                own = at[lo : lo + len(k)]
                lo += len(k)
                out.append((b, which, bucket, len(k), _squeeze(total[own]), _squeeze(part[own]) if e else None))
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
        names = ["block", "which", "bucket", "n", "total", "part"]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(names, zip(*out, strict=True), types, strict=True)})

    return requests.repartitionById(parts, F.col("bucket")).groupBy("bucket").applyInArrow(run, TOLD)


def _answers(right: pa.Table, column: str) -> list[np.ndarray]:
    """Counts of words and of pairs, in the order of the block's keys."""
    out = []
    for which in (0, 1):
        t = right.filter(pa.compute.equal(right.column("which"), which)).sort_by("bucket")
        out.append(np.concatenate([_expand(x.as_py(), np.int64) for x in t.column(column)]).astype(np.float64))
    return out


def _level(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.floor(np.log2(np.maximum(context, 1))) + 1, 0).astype(np.int64)


def _estimates(tokens: Tokens, words: np.ndarray, pairs: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: level of its context, and the estimates from pairs and from words."""
    context = words[tokens.context_at]
    p2 = np.divide(pairs[tokens.pair_at], context, out=np.zeros(len(context)), where=context > 0)
    return _level(context), p2, words[tokens.word_at] / max(total, 1.0)


def _points(bundles: DataFrame, answers: DataFrame, total: int, part: int) -> DataFrame:
    """What EM needs of the deleted part's tokens, a row for each block: level, p2, p1 as arrays, of the counts without that part."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for r in left.to_pylist():
            tokens = Tokens(r["held"], r["sizes"], r["body"])
            whole, own = _answers(right, "total"), _answers(right, "part")
            level, p2, p1 = _estimates(tokens, whole[0] - own[0], whole[1] - own[1], total - part)
            out.append((_squeeze(level.astype(np.uint8)), _squeeze(p2.astype(np.float32)), _squeeze(p1.astype(np.float32))))
        columns = list(zip(*out, strict=True)) or [[], [], []]
        return pa.table({c: pa.array(v, pa.binary()) for c, v in zip(("level", "p2", "p1"), columns, strict=True)})

    mine = bundles.filter("em").groupBy("block")
    return mine.cogroup(answers.filter("part IS NOT NULL").groupBy("block")).applyInArrow(run, "level binary, p2 binary, p1 binary")


def learn_weights(points: DataFrame, vocabulary: int) -> np.ndarray:
    """BUCKETS x 3 mixture weights (pair, word, uniform) by expectation-maximisation over all points."""
    weights = np.tile([0.3, 0.5, 0.2], (BUCKETS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    uniform, last = 1.0 / (vocabulary + 1), None
    for _ in range(ROUNDS):
        now = weights

        def run(batches, now=now):
            share, like = np.zeros((BUCKETS, 3)), 0.0
            for b in batches:
                for r in b.to_pylist():
                    level, p2, p1 = (_expand(r[c], k) for c, k in (("level", np.uint8), ("p2", np.float32), ("p1", np.float32)))
                    parts = now[level] * np.stack([p2, p1, np.full(len(p1), uniform)], axis=1)
                    mix = parts.sum(axis=1)
                    like += float(np.log(mix).sum())
                    for j in range(3):
                        share[:, j] += np.bincount(level, parts[:, j] / mix, BUCKETS)
            rows = [(i, *map(float, share[i])) for i in range(BUCKETS) if share[i].any()] + [(-1, like, 0.0, 0.0)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] + [pa.float64()] * 3, strict=True)], names=["level", "a", "b", "c"])

        got = points.mapInArrow(run, "level int, a double, b double, c double").groupBy("level").agg(F.sum("a"), F.sum("b"), F.sum("c")).collect()
        share = np.zeros((BUCKETS, 3))
        like = 0.0
        for r in got:
            if r[0] < 0:
                like = r[1]
            else:
                share[r[0]] = r[1:]
        weights = (share + 3 * np.tile([0.3, 0.5, 0.2], (BUCKETS, 1))) / (share.sum(axis=1, keepdims=True) + 3)
        weights[0] = [0.0, *(weights[0, 1:] / weights[0, 1:].sum())]
        n = share.sum()
        if n == 0 or last is not None and abs(like - last) <= SETTLED * n:
            break
        last = like
    return weights


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row."""
    spark = common.session(docs)
    kind = docs.schema[id_col].dataType
    bundles = common.written(blocks(docs, id_col, text_col), "lm-blocks", 8)
    parts = common.partitions(spark)
    answers = common.written(told(asked(bundles, parts), parts), "lm-answers", 8)
    sums = {r.which: r.n for r in answers.filter("block = -1").groupBy("which").agg(F.sum("n").alias("n")).collect()}
    total, vocabulary, part = (sums.get(k) or 0 for k in (0, 1, 2))
    answers = answers.filter("block >= 0")
    points = common.written(_points(bundles, answers, total, part), "lm-points", 4)
    weights = learn_weights(points, vocabulary)
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("held_out", T.BooleanType())]
        + [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
        + [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        id_type = left.schema.field("ids").type.value_type
        for r in left.to_pylist():
            tokens = Tokens(r["held"], r["sizes"], r["body"])
            words, pairs = _answers(right, "total")
            level, p2, p1 = _estimates(tokens, words, pairs, total)
            w = weights[level]
            p = w[:, 0] * p2 + w[:, 1] * p1 + w[:, 2] / (vocabulary + 1)
            known = words[tokens.word_at]
            base = np.log10((known + 1) / (total + vocabulary + 1))
            add = lambda x, tokens=tokens: np.add.reduceat(x, tokens.starts)
            out.append((pa.array(r["ids"], id_type), pa.array(r["held"], pa.bool_()), pa.array(tokens.lengths), pa.array(add((known > 0).astype(np.int64))), pa.array(np.full(len(tokens.lengths), total, np.int64)), pa.array(add(base)), pa.array(add(np.log10(p)))))
        return pa.concat_tables([pa.table(dict(zip(schema.names, x, strict=True))) for x in out]) if out else pa.table({f: pa.array([], t) for f, t in zip(schema.names, [id_type, pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], strict=True)})

    return bundles.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def op3(docs: DataFrame) -> DataFrame:
    return scored(docs).withColumnRenamed("id", "doc_id")
