"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

Each text gets integer measures. For every (language, source) a sketch counts
the values of each measure in log-linear buckets (32 to each doubling, so a
quantile is off by 1/32 at most); sketches merge by adding counts, which is how
they travel through the shuffle and how those of a language and of all rows come from
those of its sources. From a sketch come fences: an upper one at q75 + 10 (q75 - q50), for word
length also a lower one at q25 - 10 (q50 - q25), which up to a quarter of junk doesn't move. A group's fence is shrunk towards that of
its language, and this towards that of all rows, in proportion of PRIOR rows to its own,
so that small groups lean on larger ones without any switch. For shares of junk no fence is
looser than that of the language or of all rows: a source can't excuse its own junk.

The fences of word length are of the rows that the others keep, lest they be those of junk.

The fences are joined back to the rows. A row is rejected if its mean word length is
outside, or if it has more symbols, repeated neighbours or repeated lines than a text of its size
at the fence would have by chance: more than x + 3 sqrt(x) + 1, x being what the fence allows.

Rules for odd input: a null text has no words (and so fails the base rule); null
languages or sources count as ''; an empty table gives no rows; repeated rows are
judged alike; extra columns are ignored, or kept by `keep_good`.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_adjacent")
SYMBOLS = "#*$%&|<>"
#: measure: (SQL over FIELDS, the count and the size it is a share of). Shares are in 1/10,000, word length in 1/100.
MEASURES = {
    "symbols": ("10000 * n_symbols div greatest(word_chars, 1)", ("n_symbols", "word_chars")),
    "adjacent": ("10000 * n_adjacent div greatest(n_words, 1)", ("n_adjacent", "n_words")),
    "dup_lines": ("10000 * n_dup_lines div greatest(n_lines, 1)", ("n_dup_lines", "n_lines")),
    "word_len": ("100 * word_chars div greatest(n_words, 1)", None),
}
#: How many spreads of the outer quarters a fence is away.
SPREAD = 10
#: Rows' worth of weight that the fences of the language have in those of a group, and those of all rows in those of a language.
PRIOR = 200
#: Fences for at most so many groups are broadcast; beyond, they are joined with salted hot groups.
BROADCAST_GROUPS = 50_000


def measure(text: str) -> tuple[int, ...]:
    """FIELDS of one text."""
    words = text.encode().split()
    n = len(words)
    lines = [x for x in text.split("\n") if x.strip(common.SPACES)]
    grams = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
    repeat = 0
    if len(set(grams)) < len(grams):
        seen = Counter(grams)
        marked = np.zeros(n + 1, np.int32)
        at = np.flatnonzero(np.fromiter((seen[g] > 1 for g in grams), bool, len(grams)))
        np.add.at(marked, at, 1)
        np.add.at(marked, at + 5, -1)
        repeat = int((np.cumsum(marked)[:n] > 0).sum())
    adjacent = sum(map(bytes.__eq__, words, words[1:])) if n > 1 else 0
    return (
        n,
        len(text) - sum(map(text.count, common.SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat,
        len(lines),
        adjacent,
    )


def measures(text: Column) -> Column:
    """A struct of FIELDS."""
    kind = "struct<" + ",".join(f"{f}:long" for f in FIELDS) + ">"

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        rows = [measure(t or "") for t in texts.to_pylist()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(FIELDS)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(FIELDS))

    return run(text.cast("string"))


def _bucket(v: Column) -> Column:
    """Log-linear bucket of a count: exact below 64, then 32 to each doubling."""
    shift = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return shift * 32 + F.expr("0") + F.call_function("shiftright", v, shift)


def _upper(bucket: str) -> Column:
    """The greatest value of a bucket."""
    return F.expr(f"CASE WHEN {bucket} < 64 THEN {bucket} ELSE shiftleft({bucket} - ({bucket} div 32 - 1) * 32 + 1, cast({bucket} div 32 - 1 as int)) - 1 END")


def _lower(bucket: str) -> Column:
    """The least value of a bucket."""
    return F.expr(f"CASE WHEN {bucket} < 64 THEN {bucket} ELSE shiftleft({bucket} - ({bucket} div 32 - 1) * 32, cast({bucket} div 32 - 1 as int)) END")


def sketches(rows: DataFrame, names: tuple[str, ...] = tuple(MEASURES)) -> DataFrame:
    """(lang, source, measure, bucket, n) from rows with lang, source and the named measures as columns."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), _bucket(F.col(m)).cast("long").alias("bucket")) for m in names])
    return rows.select("lang", "source", F.explode(pairs).alias("x")).groupBy("lang", "source", "x.measure", "x.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *by: str) -> DataFrame:
    """(by..., measure, rows, q25, q50, q75, and l25, the lower end of the bucket of q25) of sketches; a window holds one sketch, of some hundred buckets."""
    w = Window.partitionBy(*by, "measure")
    run = sketch.withColumn("rows", F.sum("n").over(w)).withColumn("cum", F.sum("n").over(w.orderBy("bucket")))
    at = lambda k, end: F.min(F.when(F.col("cum") * 4 >= F.col("rows") * k, end("bucket")))
    return run.groupBy(*by, "measure").agg(F.max("rows").alias("rows"), *[at(k, _upper).alias(f"q{25 * k}") for k in (1, 2, 3)], at(1, _lower).alias("l25"))


def _limits(own: DataFrame) -> DataFrame:
    """(lang, source, measure, rows, hi, lo) of sketches, shrunk towards those of the language and of all rows."""
    own = common.written(own, "quality-sketch", 4)

    def ends(q: DataFrame, name: str, *by: str) -> DataFrame:
        of = {"hi": f"q75 + {SPREAD} * (q75 - q50)", "lo": f"greatest(0, l25 - {SPREAD} * (q50 - q25))"}
        return q.select(*by, "measure", F.col("rows").alias(f"n_{name}"), *[F.expr(e).alias(f"{k}_{name}") for k, e in of.items()])

    group = ends(quantiles(own, "lang", "source"), "g", "lang", "source")
    lang = ends(quantiles(merged(own, "lang"), "lang"), "l", "lang")
    whole = ends(quantiles(merged(own)), "w")  # one row for each measure
    best = group.join(lang, ["lang", "measure"]).join(F.broadcast(whole), "measure")
    for k in ("hi", "lo"):
        best = best.withColumn(f"{k}_l", F.expr(f"(n_l * {k}_l + {PRIOR} * {k}_w) div (n_l + {PRIOR})"))
        best = best.withColumn(f"{k}_g", F.expr(f"(n_g * {k}_g + {PRIOR} * {k}_l) div (n_g + {PRIOR})"))
    hi = F.when(F.col("measure") == "word_len", F.col("hi_g")).otherwise(F.least("hi_g", "hi_l", "hi_w"))
    return best.select("lang", "source", "measure", F.col("n_g").alias("rows"), hi.alias("hi"), F.col("lo_g").alias("lo"))


def fences(rows: DataFrame, by: str) -> DataFrame:
    """One row for each (lang, source) with its number of rows and hi_<measure>, and lo_word_len."""
    of = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c)))
    shares = tuple(m for m, (_, of_) in MEASURES.items() if of_)
    first = _limits(sketches(rows, shares)).groupBy("lang", "source").agg(F.max("rows").alias("rows"), *[of(m, "hi").alias(f"hi_{m}") for m in shares])
    first = common.written(first, "quality-shares", 4)
    clean = _joined(rows, first, by).filter(_shares_kept())
    second = _limits(sketches(clean, ("word_len",))).select("lang", "source", F.col("hi").alias("hi_word_len"), F.col("lo").alias("lo_word_len"))
    return first.join(second, ["lang", "source"], "left")


def measured(docs: DataFrame, struct: str) -> DataFrame:
    common.session(docs)
    return docs.withColumn(struct, measures(F.col("text")))


def _with_measures(rows: DataFrame) -> DataFrame:
    """From columns lang, source and FIELDS: the measures, and base_failed."""
    failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return rows.select("*", *[F.expr(e).alias(m) for m, (e, _) in MEASURES.items()], failed.alias("base_failed"))


def _joined(rows: DataFrame, limits: DataFrame, by: str) -> DataFrame:
    """rows with the limits of their (lang, source): broadcast if few, else dealt out with salted hot groups."""
    code = F.concat(F.length("lang"), F.lit(":"), "lang", "source")
    limits = common.written(limits.withColumn("group", code).drop("lang", "source"), "quality-fences", 4)
    rows = rows.withColumn("group", code)
    n, total = limits.agg(F.count("*"), F.sum("rows")).first()
    if n <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(limits), "group", "left")
    hot = common.hot_keys(limits, "group", "rows", total, common.partitions(rows.sparkSession))
    return common.salted_left_join(rows, limits, "group", hot, by)


def _shares_kept() -> Column:
    ok = F.lit(True)
    for m, (_, of) in MEASURES.items():
        if of:
            x = F.col(f"hi_{m}") * F.col(of[1]) / F.lit(10000.0)
            ok = ok & (F.col(of[0]) <= x + 3 * F.sqrt(x) + 1)
    return F.coalesce(ok, F.lit(False))


def _verdict() -> Column:
    """Whether a row with its fences is kept; a group without fences has no row to keep."""
    return F.coalesce(~F.col("base_failed") & _shares_kept() & F.expr("word_len BETWEEN lo_word_len AND hi_word_len"), F.lit(False))


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, FIELDS, measures, base_failed and kept for each row. Sketches are of the rows that pass the base rule."""
    (m,) = common.hidden(docs, "m")
    flat = measured(docs.select("doc_id", "lang", "source", "text"), m).select("doc_id", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")], f"{m}.*")
    rows = common.written(_with_measures(flat), "quality-rows", 4)
    limits = fences(rows.filter("NOT base_failed"), "doc_id")
    return _joined(rows, limits, "doc_id").withColumn("kept", _verdict())


def op2(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs.

    Texts are measured once: the rows are written with their measures, then met by the fences.
    """
    names = docs.columns
    m, lang, source, row = common.hidden(docs, "m", "lang", "source", "row")
    both = measured(docs, m).withColumn(lang, F.coalesce(F.col("lang").cast("string"), F.lit(""))).withColumn(source, F.coalesce(F.col("source").cast("string"), F.lit("")))
    both = both.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias(row), F.col(lang).alias("lang"), F.col(source).alias("source"), F.col("doc_id").alias("by"), f"{m}.*")
    rows = common.written(both, "quality-docs")
    limits = fences(_with_measures(rows.drop(row)).filter("NOT base_failed"), "by")
    good = _joined(_with_measures(rows), limits, "by").filter(_verdict())
    return good.select(*[F.col(row).getField(c).alias(c) for c in names])


def _levels(src: str, end: str) -> str:
    """SQL of the fences <src><end> (lang, source, measure, hi, lo, lhi, ahi) of rows `src` (lang, source, measure, x)."""
    quarters = "count(*) AS n, min(top) FILTER (c * 4 >= k) AS q1, min(low) FILTER (c * 4 >= k) AS l1, min(top) FILTER (c * 4 >= k * 2) AS q2, min(top) FILTER (c * 4 >= k * 3) AS q3"
    hi, lo = f"q3 + {SPREAD} * (q3 - q2)", f"greatest(0, l1 - {SPREAD} * (q2 - q1))"

    def cut(by: str) -> str:
        return f"SELECT {by}, {quarters} FROM (SELECT *, count(*) OVER (PARTITION BY {by}) AS k, count(*) OVER (PARTITION BY {by} ORDER BY top) AS c FROM {src}e) GROUP BY {by}"

    return f"""{src}b AS (SELECT *, greatest(length(bin(x)) - 6, 0) AS s FROM {src}),
{src}e AS (SELECT lang, source, measure, (((x >> s) + 1) << s) - 1 AS top, (x >> s) << s AS low FROM {src}b),
{src}q AS ({cut('lang, source, measure')}),
{src}r AS ({cut('lang, measure')}),
{src}t AS ({cut('measure')}),
{src}a AS (SELECT measure, {hi} AS hi, {lo} AS lo FROM {src}t),
{src}l AS (SELECT lang, measure, (n * ({hi}) + {PRIOR} * a.hi) // (n + {PRIOR}) AS hi, (n * {lo} + {PRIOR} * a.lo) // (n + {PRIOR}) AS lo FROM {src}r JOIN {src}a a USING (measure)),
{src}{end} AS (
  SELECT q.lang, source, measure, l.hi AS lhi, a.hi AS ahi, (n * ({hi}) + {PRIOR} * l.hi) // (n + {PRIOR}) AS hi, (n * {lo} + {PRIOR} * l.lo) // (n + {PRIOR}) AS lo
  FROM {src}q q JOIN {src}l l USING (lang, measure) JOIN {src}a a USING (measure)),"""


ORACLE = """
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
g AS (SELECT doc_id, i, w[i:i+4] AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t WHERE len(w) >= 5)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM g) WHERE k > 1),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM d) GROUP BY doc_id),
a AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t WHERE len(w) >= 2) WHERE w[i] = w[i + 1] GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM t)
      WHERE regexp_matches(x, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
m AS (
  SELECT t.doc_id, lang, source, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (coalesce(l.n, 0) - coalesce(l.u, 0))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         coalesce(l.n, 0)::BIGINT AS n_lines, coalesce(a.n, 0)::BIGINT AS n_adjacent
  FROM t LEFT JOIN r USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN l USING (doc_id)),
v AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         10000 * n_symbols // greatest(word_chars, 1) AS symbols, 10000 * n_adjacent // greatest(n_words, 1) AS adjacent,
         10000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines, 100 * word_chars // greatest(n_words, 1) AS word_len
  FROM m),
u AS (UNPIVOT (SELECT lang, source, symbols, adjacent, dup_lines FROM v WHERE NOT base_failed) ON symbols, adjacent, dup_lines INTO NAME measure VALUE x),
""" + _levels("u", "g") + """
f AS (
  SELECT lang, source, max(least(hi, lhi, ahi)) FILTER (measure = 'symbols') AS h1, max(least(hi, lhi, ahi)) FILTER (measure = 'adjacent') AS h2,
         max(least(hi, lhi, ahi)) FILTER (measure = 'dup_lines') AS h3
  FROM ug GROUP BY 1, 2),
x AS (SELECT *, h1 * word_chars / 10000.0::DOUBLE AS x1, h2 * n_words / 10000.0::DOUBLE AS x2, h3 * n_lines / 10000.0::DOUBLE AS x3 FROM v LEFT JOIN f USING (lang, source)),
y AS (SELECT *, coalesce(NOT base_failed AND n_symbols <= x1 + 3 * sqrt(x1) + 1 AND n_adjacent <= x2 + 3 * sqrt(x2) + 1 AND n_dup_lines <= x3 + 3 * sqrt(x3) + 1, false) AS shares FROM x),
w AS (SELECT lang, source, 'word_len' AS measure, word_len AS x FROM y WHERE shares),
""" + _levels("w", "g") + """
k AS (SELECT lang, source, hi AS h4, lo AS l4 FROM wg)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, coalesce(shares AND word_len BETWEEN l4 AND h4, false) AS kept
FROM y LEFT JOIN k USING (lang, source)
"""
