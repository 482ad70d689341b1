"""Operators, sinks, sources and streams applied to whole tables, each with the SQL that says the same."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import coerce
from ..functions.families import FAMILIES, family_of
from ..operators import aggregates, joins, selection, windows
from ..session import shared_dir
from ..sources import archives, sinks, tables
from ..streaming import streams
from .queries import _query, _seconds, _t


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- joins and windows -------------------------------------------------------------------------------------


@_query("""
WITH p AS (SELECT l_extendedprice AS price, count(*) AS rows FROM lineitem GROUP BY 1),
m AS (SELECT price, min(o_orderkey) AS k FROM p JOIN orders ON o_totalprice <= price AND price < o_totalprice + 40 GROUP BY 1)
SELECT price, rows, coalesce(k, -1) AS first_order FROM p LEFT JOIN m USING (price)""")
def q_interval_many(spark, sf_dir):
    """Prices in the first of many overlapping intervals; above some thousand intervals no longer a list that is broadcast."""
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("a"), (F.col("o_totalprice") + 40).alias("b"), F.col("o_orderkey").alias("v"))
    items = _t(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("price"))
    found = joins.interval_first(items, orders, "price", "a", "b", "k", "v", F.lit(-1).cast("long"))
    return found.groupBy("price").agg(F.count("*").alias("rows"), F.max("v").alias("first_order"))


@_query("""
WITH e AS (SELECT user_id, event_id, event_type IN ('click', 'view', 'signup') AS is_on FROM events),
c AS (SELECT *, count(*) FILTER (is_on) OVER w AS a, count(*) FILTER (NOT is_on) OVER w AS b FROM e WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
o AS (SELECT *, b - greatest(0, max(b - a) OVER (PARTITION BY user_id ORDER BY event_id)) AS m FROM c),
k AS (SELECT *, m > coalesce(lag(m) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS counts FROM o)
SELECT x.user_id, x.event_id AS open, y.event_id AS close FROM k x JOIN k y ON x.user_id = y.user_id AND x.a = y.m WHERE x.is_on AND NOT y.is_on AND y.counts""")
def q_fifo_pairs(spark, sf_dir):
    """Each ending event takes the oldest open one of its user; ends without an open one are ignored."""
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").isin("click", "view", "signup").alias("is_on"))
    return windows.fifo_pairs(e, ["user_id"], "event_id", "is_on")


@_query("""
WITH t AS (SELECT user_id, (epoch_us(ts) // 1000000) % 86400 AS tick, 300000 + event_id % 400000 AS tempo FROM events WHERE event_type = 'error'),
z AS (SELECT user_id, tick, tempo FROM t UNION ALL SELECT DISTINCT user_id, 0, 500000 FROM t),
d AS (SELECT user_id, tick, max(tempo) AS tempo FROM z GROUP BY 1, 2),
s AS (SELECT *, coalesce((tick - lag(tick) OVER w) * lag(tempo) OVER w, 0) AS step FROM d WINDOW w AS (PARTITION BY user_id ORDER BY tick))
SELECT user_id, tick::BIGINT AS tick, tempo::BIGINT AS tempo, (sum(step) OVER (PARTITION BY user_id ORDER BY tick))::BIGINT AS micros FROM s""")
def q_tempo_segments(spark, sf_dir):
    """Seconds at each change of tempo: of equal ticks the greatest tempo, and a default at tick 0."""
    e = _t(spark, sf_dir, "events").filter("event_type = 'error'")
    t = e.select("user_id", (_seconds("ts") % 86_400).cast("long").alias("tick"), (300_000 + F.col("event_id") % 400_000).cast("long").alias("tempo"))
    return windows.tempo_segments(t, "user_id", F.lit(1.0)).select("user_id", "tick", "tempo", F.round(F.col("seconds") * 1e6).cast("long").alias("micros"))


@_query("""
WITH k AS (SELECT n_name AS name, n_nationkey AS v FROM nation),
s AS (SELECT s_suppkey, upper(substr(s_name, 1, 3)) AS k1, (SELECT any_value(n_name) FROM nation WHERE n_nationkey = s_nationkey AND s_suppkey % 3 = 0) AS k2, 'NATION_' || s_suppkey % 40 AS k3 FROM supplier)
SELECT s_suppkey, coalesce(a.v, b.v, c.v, -1) AS v FROM s LEFT JOIN k a ON a.name = k1 LEFT JOIN k b ON b.name = k2 LEFT JOIN k c ON c.name = k3""")
def q_coalesce_lookup(spark, sf_dir):
    """The value of the first of three keys that is known."""
    nation = _t(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("v"))
    s = _t(spark, sf_dir, "supplier").join(_t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
    keys = [F.upper(F.substring("s_name", 1, 3)), F.when(F.col("s_suppkey") % 3 == 0, F.col("n_name")), F.concat(F.lit("NATION_"), (F.col("s_suppkey") % 40).cast("string"))]
    return joins.coalesce_lookup(s.select("s_suppkey", "s_name", "n_name"), nation, keys, "name", "v", F.lit(-1)).select("s_suppkey", "v")


_MATCH = """
WITH l AS (SELECT c_custkey AS lid, 'n' || c_custkey % 60 AS lname, list_distinct(['n' || c_custkey % 60, 'a' || c_custkey % 7, 'b' || c_custkey % 11, 'c' || c_custkey % 13]) AS ts FROM customer WHERE c_custkey < 600),
r AS (SELECT s_suppkey AS rid, 'n' || s_suppkey % 45 AS rname, list_distinct(['n' || s_suppkey % 45, 'a' || s_suppkey % 7, 'b' || s_suppkey % 11, 'x']) AS ts FROM supplier WHERE s_suppkey < 90),
lt AS (SELECT lid, lname, unnest(ts) AS t FROM l), rt AS (SELECT rid, rname, unnest(ts) AS t FROM r),
p AS (SELECT lid, rid, sum(CASE WHEN t = lname THEN {w} ELSE 1 END) AS score, any_value(lname = rname) AS same FROM lt JOIN rt USING (t) GROUP BY 1, 2),
m AS (SELECT lid, max(score) AS top, count(*) FILTER (same) AS n_same, max(rid) FILTER (same) AS named FROM p GROUP BY 1),
b AS (SELECT lid, count(*) AS n_best, max(rid) AS best FROM p JOIN m USING (lid) WHERE score = top GROUP BY 1)
SELECT l.lid, {pick} AS rid, CASE WHEN n_best IS NULL THEN 'none' {how} ELSE 'ambiguous' END AS method, CASE WHEN {pick} IS NOT NULL THEN top END::BIGINT AS score FROM l LEFT JOIN m USING (lid) LEFT JOIN b USING (lid)"""


def _matched(spark, sf_dir, weight: int, unique_only: bool):
    form = lambda c, name, extra: F.array(*[F.concat(F.lit(p), (F.col(c) % n).cast("string")) for p, n in (("n", name), ("a", 7), ("b", 11))], extra)
    left = _t(spark, sf_dir, "customer").filter("c_custkey < 600").select(F.col("c_custkey").alias("id"), F.concat(F.lit("n"), F.col("c_custkey") % 60).alias("name"), form("c_custkey", 60, F.concat(F.lit("c"), F.col("c_custkey") % 13)).alias("tokens"))
    right = _t(spark, sf_dir, "supplier").filter("s_suppkey < 90").select(F.col("s_suppkey").alias("id"), F.concat(F.lit("n"), F.col("s_suppkey") % 45).alias("name"), form("s_suppkey", 45, F.lit("x")).alias("tokens"))
    return joins.token_match(left, right, weight, unique_only)


@_query(_MATCH.format(w=5, pick="CASE WHEN n_best = 1 THEN best WHEN n_same = 1 THEN named END", how="WHEN n_best = 1 THEN 'token' WHEN n_same = 1 THEN 'name'"))
def q_token_match(spark, sf_dir):
    """Weighted token overlap: a shared name counts five; of ties the one whose name is the same."""
    return _matched(spark, sf_dir, 5, False)


@_query(_MATCH.format(w=1, pick="CASE WHEN n_same = 1 THEN named WHEN n_best = 1 THEN best END", how="WHEN n_same = 1 THEN 'name' WHEN n_best = 1 THEN 'token'"))
def q_token_match_by_name(spark, sf_dir):
    """The same with the name first and equal weights."""
    return _matched(spark, sf_dir, 1, True)


_FAMILY = " ".join(f"WHEN {' OR '.join(f'x BETWEEN {lo} AND {hi}' for lo, hi in ranges)} THEN '{n}'" for n, ranges in FAMILIES["tiered"])


@_query(f"SELECT CASE {_FAMILY} END AS family, count(*) AS rows FROM (SELECT l_partkey % 128 AS x FROM lineitem) GROUP BY 1")
def q_family_of(spark, sf_dir):
    """Lines by the one family of their program."""
    return _t(spark, sf_dir, "lineitem").groupBy(family_of(F.col("l_partkey") % 128, "tiered").alias("family")).agg(F.count("*").alias("rows"))


@_query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200")
def q_prefix_sample(spark, sf_dir):
    return selection.prefix(_t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 200)


@_query("SELECT doc_id FROM labels WHERE quality = 1 ORDER BY doc_id LIMIT 50")
def q_training_samples(spark, sf_dir):
    """What a training run reads: the first rows of a split."""
    return selection.first_samples(_t(spark, sf_dir, "labels").withColumn("split", F.col("quality").cast("string")), "1", [F.asc("doc_id")], 50).select("doc_id")


# -- scalars -------------------------------------------------------------------------------------------------


@_query(r"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') || CASE page_id % 3 WHEN 0 THEN '/Take-' || (page_id * 7919) || '.tar.gz' WHEN 1 THEN '/0' || (page_id + 100000) || '.mid' ELSE '/plain' END AS path, page_id % 4 AS a, page_id % 9 AS b FROM pages),
q AS (SELECT *, regexp_extract(path, '[^/]*$') AS name FROM p)
SELECT page_id, regexp_replace(name, '(.)[.][^.]*$', '\1') AS stem, regexp_replace(regexp_replace(lower(name), '(.)([.][a-z0-9]{1,5})+$', '\1'), '[^a-z0-9]+', '', 'g') AS canonical,
       '[' || a || ',' || b || ']' AS numbers, '{"' || least(a, b) || '":' || CASE WHEN a = b THEN 2 ELSE 1 END || CASE WHEN a <> b THEN ',"' || greatest(a, b) || '":1' ELSE '' END || '}' AS counts,
       array_to_string(list_sort(list_distinct(list_transform(list_filter(regexp_extract_all(lower(path), '[0-9]{5,}'), lambda x: ltrim(x, '0') <> ''), lambda x: ltrim(x, '0')))), ',') AS long_numbers,
       CASE WHEN page_id % 2 = 0 THEN page_id * 1.5::DOUBLE END AS seconds FROM q""")
def q_path_forms(spark, sf_dir):
    """Stems, canonical names, long numbers of paths; JSON of numbers and counts; seconds between times in text."""
    pages = _t(spark, sf_dir, "pages")
    path = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")
    tail = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/Take-"), (F.col("page_id") * 7919).cast("string"), F.lit(".tar.gz"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("/0"), (F.col("page_id") + 100000).cast("string"), F.lit(".mid"))).otherwise("/plain")
    rows = pages.select("page_id", F.concat(path, tail).alias("path"), F.array((F.col("page_id") % 4).cast("int"), (F.col("page_id") % 9).cast("int")).alias("p"))
    long = F.filter(coerce.tokens("path"), lambda x: x.rlike("^[1-9][0-9]*$"))
    start = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000)), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    end = F.date_format(F.timestamp_millis((F.lit(1_700_000_000_000) + F.col("page_id") * 1500).cast("long")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return rows.select(
        "page_id",
        coerce.stem("path").alias("stem"),
        coerce.canonical("path").alias("canonical"),
        coerce.json_ints(F.col("p")).alias("numbers"),
        coerce.multiset_json(coerce.multiset(F.col("p"))).alias("counts"),
        F.array_join(F.array_sort(long), ",").alias("long_numbers"),
        coerce.seconds_between(start, F.when(F.col("page_id") % 2 == 0, end).otherwise("not a time")).alias("seconds"),
    )


# -- sinks and sources, written to the shared folder and read back -------------------------------------------


@_query("""
WITH r AS (SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 700 + 1 AS shard FROM orders)
SELECT printf('part-%05d.csv.gz', shard) AS file, count(*) AS rows, min(o_orderkey) AS least, printf('%.2f', sum(o_totalprice)) AS total FROM r GROUP BY shard""")
def q_written_shards(spark, sf_dir):
    """Numbered gzip files of CSV with their index, read back file by file."""
    path = _folder(spark, "shards")
    index = sinks.write_shards(_t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), path, [F.asc("o_totalprice"), F.asc("o_orderkey")], 700)
    back = tables.read_csv(spark, f"{path}/part-*.csv.gz", ["o_orderkey"]).withColumn("file", F.substring_index(F.input_file_name(), "/", -1))
    sums = back.groupBy("file").agg(F.min(F.col("o_orderkey").cast("long")).alias("least"), F.format_string("%.2f", F.sum(F.col("o_totalprice").cast("double"))).alias("total"))
    return index.join(sums, "file").select("file", "rows", "least", "total")


@_query("""
WITH RECURSIVE s AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1),
c AS (SELECT k, n, row_number() OVER (ORDER BY k) AS r, sum(n) OVER (ORDER BY k) AS upto FROM s),
b(shard, pos) AS (SELECT 1, 0::HUGEINT UNION ALL SELECT shard + 1, (SELECT min(upto) FROM c WHERE upto >= b.pos + 1000) FROM b WHERE EXISTS (SELECT 1 FROM c WHERE upto >= b.pos + 1000)),
x AS (SELECT shard, pos, lead(pos) OVER (ORDER BY shard) AS next FROM b)
SELECT shard::INT AS shard, count(*) AS records, sum(n)::BIGINT AS rows FROM c JOIN x ON upto > pos AND (next IS NULL OR upto <= next) GROUP BY 1""")
def q_long_shards(spark, sf_dir):
    """Shards of lines that are closed by the order that fills them."""
    items = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber")
    records = items.select("k").distinct()
    out = sinks.long_shards(records, items, "k", [F.asc("k")], 1000)
    return out.groupBy(F.col("__shard").alias("shard")).agg(F.countDistinct("k").alias("records"), F.count("*").alias("rows"))


@_query("SELECT doc_id, md5(text) AS md5, lang, doc_id % 2 = 0 AS even FROM documents WHERE length(text) < 3000")
def q_csv_round_trip(spark, sf_dir):
    """Texts with line breaks, quotes and separators through CSV and back."""
    docs = _t(spark, sf_dir, "documents").filter(F.length("text") < 3000)
    path = _folder(spark, "csv")
    sinks.write_csv(docs.withColumn("even", F.col("doc_id") % 2 == 0), path, ["doc_id", "text", "lang", "even"])
    back = tables.read_csv(spark, path, ["doc_id", "text"])
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), F.md5(F.coalesce("text", F.lit(""))).alias("md5"), "lang", coerce.to_bool("even").alias("even"))


@_query("SELECT 'n/' || n_nationkey || '/name.txt' AS file, length(n_name) AS size, sha256(n_name) AS sha256 FROM nation")
def q_extracted_checksums(spark, sf_dir):
    """Members written below a folder, and the sums of what lies there."""
    path = _folder(spark, "members")
    members = _t(spark, sf_dir, "nation").select(F.concat(F.lit("n/"), "n_nationkey", F.lit("/name.txt")).alias("member"), F.col("n_name").cast("binary").alias("content"))
    sinks.extract(members, path).count()
    return sinks.checksums(spark, path)


@_query("SELECT '.' || event_type AS extension, count(*) AS rows FROM events GROUP BY 1")
def q_extensions(spark, sf_dir):
    members = _t(spark, sf_dir, "events").select(F.concat(F.lit("e/"), "event_id", F.lit("."), F.upper("event_type")).alias("member"))
    return archives.extensions(members)


@_query("SELECT n_regionkey AS region, count(*) AS rows, min(n_name) AS first FROM nation GROUP BY 1")
def q_published_json(spark, sf_dir):
    """JSON lines appended in two parts and read back, published by one rename and read again."""
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path = _folder(spark, "log")
    for k in (0, 1):
        sinks.append_log(nation.filter(F.col("n_nationkey") % 2 == k), path)
    sinks.publish(tables.read_json(spark, path, lines=True), f"{path}-published")
    back = sinks.published(spark, f"{path}-published")
    return back.groupBy(F.col("n_regionkey").cast("int").alias("region")).agg(F.count("*").alias("rows"), F.min("n_name").alias("first"))


# -- streams -----------------------------------------------------------------------------------------------------


def _stream(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("at", F.col("ts").cast("timestamp"))


def _copied(spark, df, name: str):
    """What a stream gives until it has read all there is."""
    path, checkpoint = _folder(spark, name), _folder(spark, f"{name}-checkpoint")
    streams.resumable(df, path, checkpoint).awaitTermination()
    streams.resumable(df, path, checkpoint).awaitTermination()  # reads on from where it was: nothing is there twice
    return spark.read.schema(df.schema).parquet(path)


@_query("SELECT user_id, event_type, count(*) AS rows FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1, 2")
def q_stream_first_seen(spark, sf_dir):
    """First rows of a stream, once for each key, through a query that is run again."""
    out = _copied(spark, streams.first_seen(_stream(spark, sf_dir), ["user_id", "event_type"], "at", "3650 days").select("user_id", "event_type", "event_id"), "first-seen")
    return out.groupBy("user_id", "event_type").agg(F.count("*").alias("rows"))


@_query("SELECT count(*) AS rows, count(DISTINCT event_id) AS ids, sum(event_id)::BIGINT AS total FROM events")
def q_stream_flushed(spark, sf_dir):
    """A stream written by micro-batches in files of some rows each."""
    path, checkpoint = _folder(spark, "flushed"), _folder(spark, "flushed-checkpoint")
    streams.flushed(_stream(spark, sf_dir).drop("at"), path, checkpoint, ["event_id"], 500).awaitTermination()
    return spark.read.parquet(path).agg(F.count("*").alias("rows"), F.countDistinct("event_id").alias("ids"), F.sum("event_id").alias("total"))


@_query("""
WITH w AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts, TIMESTAMP '1970-01-01') AS start, event_type, count(*) AS rows FROM events GROUP BY 1, 2)
SELECT epoch_us(start) // 1000000 AS start, event_type, rows FROM w WHERE start + INTERVAL 10 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def q_stream_windows(spark, sf_dir):
    """Counts in tumbling windows that the watermark has closed."""
    out = _copied(spark, streams.window_counts(_stream(spark, sf_dir), "at", "event_type"), "windows")
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "rows")


@_query("SELECT l_returnflag, count(*) AS rows FROM lineitem WHERE l_discount > 0.05 GROUP BY 1")
def q_counted_long_form(spark, sf_dir):
    """Counts of a long form that is made of arrays."""
    items = _t(spark, sf_dir, "lineitem").filter("l_discount > 0.05").groupBy("l_orderkey").agg(F.collect_list("l_returnflag").alias("flags"))
    pairs = F.transform(F.array_distinct("flags"), lambda k: F.struct(k.alias("k"), F.size(F.filter("flags", lambda x: x == k)).alias("v")))
    long = aggregates.exploded_form(items.withColumn("p", pairs), "l_orderkey", "p", "l_returnflag")
    return long.groupBy("l_returnflag").agg(F.sum("n").alias("rows"))
