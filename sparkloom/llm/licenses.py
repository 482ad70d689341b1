"""Licence scans: sparse TF-IDF cosine of headers and licence files to templates, then inheritance along directories. DataFrame functions only.

Of each text the lines, the blocks (parts between lines without letters or digits, such as
a header comment or a paragraph, however it is wrapped) and the whole are compared with
the templates. By rule only what has one of ANCHORS, word parts one of which is in every
licence or notice, can state a licence; other texts, lines and blocks are left out first, which
spares most of a corpus the comparison. Equal texts are compared once.

The dot products are joins: words of a unit meet the table of word weights, which
is small, and add up by unit. A file whose whole text reaches the threshold is a licence file;
it speaks for its directory and those below. Every file gets the licence of its
nearest ancestor directory that has one; its own goes first.

Rules for odd input: null texts are empty; null paths are in no directory; of equal
scores in a file the whole goes before blocks and blocks before lines, then the first and the
first template win, of licence files in a directory the best score and then the
least id; a licence file has the licence that its whole text is most like; repeated rows
come out as often as they came in; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .licence_texts import TEMPLATES

THRESHOLD = 0.6
LEAST = int(THRESHOLD * 1000)
TOKEN = "[a-z0-9]+"
#: What parts blocks: line breaks with no letter or digit between them.
GAP = r"\n(?:[^a-z0-9\n]*\n)+"
UNITS = ("file", "block", "line")
#: Word parts one of which a text, block or line must have to state a licence; each template has one.
ANCHORS = ["licen", "copyright", "permission", "redistribution", "rights reserved"]


def model() -> tuple[dict[str, float], list[dict[str, float]]]:
    """Token weights (idf) and unit vectors of the templates."""
    docs = [Counter(re.findall(TOKEN, t.lower())) for _, t in TEMPLATES]
    df = Counter(t for d in docs for t in d)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
    vectors = []
    for d in docs:
        raw = {t: n * idf[t] for t, n in d.items()}
        size = math.sqrt(sum(x * x for x in raw.values()))
        vectors.append({t: x / size for t, x in raw.items()})
    return idf, vectors


UNKNOWN = math.log(1 + len(TEMPLATES)) + 1


def _any(text: Column, parts: list[str]) -> Column:
    out = F.lit(False)
    for s in parts:
        out = out | text.contains(s)
    return out


def scored_units(texts: DataFrame) -> DataFrame:
    """(key, unit, place, score in 1/1000, template) of the best template of each unit with an anchor, from (key, text), one row for each key, which texts are dealt by."""
    idf, vectors = model()
    wanted = "|".join(ANCHORS)
    low = texts.select("key", F.lower("text").alias("low"))

    def units(k: int, parts: Column) -> Column:
        numbered = F.transform(parts, lambda x, i: F.struct(F.lit(k).alias("unit"), i.alias("place"), x.alias("x")))
        return F.filter(numbered, lambda u: u["x"].rlike(wanted))

    every = F.concat(units(0, F.array("low")), units(1, F.split("low", GAP)), units(2, F.split("low", "\n")))
    rows = low.select("key", F.explode(every).alias("u")).select("key", "u.unit", "u.place", F.explode(F.regexp_extract_all("u.x", F.lit(f"({TOKEN})"), F.lit(1))).alias("t"))
    counted = rows.groupBy("key", "unit", "place", "t").agg(F.count("*").alias("n"))
    table = json.dumps([{"t": t, "w": w, "x": [v.get(t, 0.0) for v in vectors]} for t, w in idf.items()])
    weights = texts.sparkSession.range(1).select(F.inline(F.from_json(F.lit(table), "array<struct<t:string,w:double,x:array<double>>>")))  # the templates' words: a constant
    met = counted.join(F.broadcast(weights), "t", "left").withColumn("w", F.col("n") * F.coalesce("w", F.lit(UNKNOWN)))
    dots = [F.sum(F.col("w") * F.get("x", F.lit(k))).alias(f"d{k}") for k in range(len(vectors))]
    sums = met.groupBy("key", "unit", "place").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("size"), *dots)
    marks = [F.struct(F.floor(F.coalesce(f"d{k}", F.lit(0.0)) / F.col("size") * 1000 + 0.5).cast("int").alias("score"), F.lit(-k).alias("k")) for k in range(len(vectors))]
    return sums.select("key", "unit", "place", F.greatest(*marks).alias("m")).select("key", "unit", "place", "m.score", (-F.col("m.k")).alias("template"))


def own(files: DataFrame) -> DataFrame:
    """id, path, dir, licence, score, unit, place, is_file of files (id, path, text)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = _any(F.lower(text), ANCHORS)
    # two hashes of 64 bits name a text
    key = F.when(found, F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit("again"), text).alias("b")))
    rows = common.written(files.select("id", "path", key.alias("key"), F.when(found, text).alias("text")), "licence-texts")
    units = scored_units(rows.filter("key IS NOT NULL").groupBy("key").agg(F.first("text").alias("text")))
    best = lambda test: F.max(F.when(test, F.struct("score", (-F.col("unit")).alias("unit"), (-F.col("place")).alias("place"), (-F.col("template")).alias("template"))))
    m = units.filter(F.col("score") >= LEAST).groupBy("key").agg(best(F.col("unit") == 0).alias("whole"), best(F.lit(True)).alias("any"))
    m = common.written(m.select("key", F.coalesce("whole", "any").alias("m"), F.col("whole").isNotNull().alias("is_file")), "licence-marks", 4)
    counts = rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("n"))
    total = rows.count()
    hot = common.hot_keys(counts, "key", "n", total, common.partitions(files.sparkSession))
    out = common.salted_left_join(rows.drop("text"), m, "key", [F.struct(F.lit(k.a).alias("a"), F.lit(k.b).alias("b")) for k in hot], "id")
    names = F.array(*[F.lit(n) for n, _ in TEMPLATES])
    kinds = F.array(*[F.lit(u) for u in UNITS])
    return out.select(
        "id",
        "path",
        F.regexp_replace("path", "/[^/]*$", "").alias("dir"),
        F.get(names, -F.col("m.template")).alias("licence"),
        F.col("m.score").alias("score"),
        F.get(kinds, -F.col("m.unit")).alias("unit"),
        (-F.col("m.place")).alias("place"),
        F.coalesce("is_file", F.lit(False)).alias("is_file"),
    )


def scan(files: DataFrame) -> DataFrame:
    """`own`, and inherited, inherited_from (the nearest ancestor directory with a licence file) and final for each row of files (id, path, text)."""
    spark = common.session(files)
    parts_n = common.partitions(spark)
    rows = common.written(own(files), "licence-rows", 4)
    speaks = rows.filter("is_file AND dir IS NOT NULL").groupBy(F.col("dir").alias("above")).agg(F.max_by("licence", F.struct("score", *_falling(rows, "id"))).alias("inherited"))
    dirs = common.written(rows.filter("dir IS NOT NULL").groupBy("dir").agg(F.count("*").alias("n")), "licence-dirs", 4)
    parts = F.split("dir", "/")
    up = dirs.select("dir", F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("above"))
    # directories near the root are above a large part of all
    wide = common.hot_keys(up.groupBy("above").agg(F.count("*").alias("n")), "above", "n", dirs.count(), parts_n)
    met = common.salted_left_join(up, speaks, "above", wide, "dir").filter("inherited IS NOT NULL")
    given = met.groupBy("dir").agg(F.max_by(F.struct("inherited", F.col("above").alias("inherited_from")), F.length("above")).alias("g"))
    given = common.written(given.join(dirs, "dir").select("dir", "g.inherited", "g.inherited_from", "n"), "licence-given", 4)
    total = given.agg(F.sum("n")).first()[0] or 0
    hot = common.hot_keys(given, "dir", "n", total, parts_n)
    out = common.salted_left_join(rows, given.drop("n"), "dir", hot, "id")
    return out.withColumn("final", F.coalesce("licence", "inherited"))


def _falling(df: DataFrame, c: str) -> list[Column]:
    """Sort keys that put the least value of a numeric column last; other columns go by their negated hash."""
    kind = df.schema[c].dataType.typeName()
    return [-F.col(c)] if kind in ("byte", "short", "integer", "long", "float", "double", "decimal") else [-F.xxhash64(c).cast("decimal(20,0)")]


def op5(docs: DataFrame) -> DataFrame:
    """Licences of documents, whose paths are /source/lang/<id div 1000>/<id>.txt, or /source/lang/<id>.txt for texts of fewer than 100 characters."""
    deep = F.when(F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))) < 100, F.lit("")).otherwise(F.concat(F.expr("cast(doc_id div 1000 as string)"), F.lit("/")))
    path = F.concat(F.lit("/"), F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")), F.lit("/"), deep, F.col("doc_id").cast("string"), F.lit(".txt"))
    found = scan(docs.select(F.col("doc_id").alias("id"), path.alias("path"), "text"))
    return found.select(F.col("id").alias("doc_id"), "path", "licence", "score", "unit", "place", "is_file", "inherited", "inherited_from", F.col("final").alias("final_licence"))


def oracle() -> str:
    """Brute force: every line, block and whole text against every template."""
    idf, vectors = model()
    weights = ", ".join(f"('{t}', {x!r}::DOUBLE)" for t, x in idf.items())
    rows = ", ".join(f"({k}, '{t}', {x!r}::DOUBLE)" for k, v in enumerate(vectors) for t, x in v.items())
    names = ", ".join(f"({k}, '{n}')" for k, (n, _) in enumerate(TEMPLATES))
    return f"""
WITH idf(t, w) AS (VALUES {weights}), vec(k, t, w) AS (VALUES {rows}), name(k, licence) AS (VALUES {names}),
d AS (
  SELECT doc_id, lower(coalesce(text, '')) AS low,
         '/' || coalesce(source, '') || '/' || coalesce(lang, '') || '/' || CASE WHEN length(coalesce(text, '')) < 100 THEN '' ELSE (doc_id // 1000)::VARCHAR || '/' END || doc_id::VARCHAR || '.txt' AS path
  FROM documents),
l AS (
  SELECT doc_id, 0 AS unit, 0 AS place, low AS x FROM d
  UNION ALL SELECT doc_id, 1, unnest(range(len(s)))::INT, unnest(s) FROM (SELECT doc_id, string_split_regex(low, '{GAP}') AS s FROM d)
  UNION ALL SELECT doc_id, 2, unnest(range(len(s)))::INT, unnest(s) FROM (SELECT doc_id, string_split(low, chr(10)) AS s FROM d)),
c AS (SELECT doc_id, unit, place, t, count(*) AS n FROM (SELECT doc_id, unit, place, unnest(regexp_extract_all(x, '{TOKEN}')) AS t FROM l WHERE regexp_matches(x, '{'|'.join(ANCHORS)}')) GROUP BY ALL),
e AS (SELECT doc_id, unit, place, t, n * coalesce(w, {UNKNOWN!r}::DOUBLE) AS w FROM c LEFT JOIN idf USING (t)),
z AS (SELECT doc_id, unit, place, sqrt(sum(w * w)) AS size FROM e GROUP BY ALL),
s AS (SELECT doc_id, unit, place, k, floor(sum(e.w * vec.w) / any_value(size) * 1000 + 0.5)::INT AS score FROM e JOIN vec USING (t) JOIN z USING (doc_id, unit, place) GROUP BY ALL),
g AS (SELECT * FROM s WHERE score >= {LEAST}),
b AS (SELECT *, unit = 0 AS is_file FROM g QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY unit > 0, score DESC, unit, place, k) = 1),
o AS (
  SELECT d.doc_id, path, regexp_replace(path, '/[^/]*$', '') AS dir, licence, score, CASE unit WHEN 0 THEN 'file' WHEN 1 THEN 'block' WHEN 2 THEN 'line' END AS unit, place, coalesce(is_file, false) AS is_file
  FROM d LEFT JOIN b USING (doc_id) LEFT JOIN name USING (k)),
f AS (SELECT dir, licence FROM o WHERE is_file QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, doc_id) = 1),
i AS (
  SELECT o.doc_id, f.licence AS inherited, f.dir AS inherited_from FROM o JOIN f ON o.dir = f.dir OR starts_with(o.dir, f.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY o.doc_id ORDER BY length(f.dir) DESC) = 1)
SELECT doc_id, path, licence, score, unit, place, is_file, inherited, inherited_from, coalesce(licence, inherited) AS final_licence FROM o LEFT JOIN i USING (doc_id)
"""
