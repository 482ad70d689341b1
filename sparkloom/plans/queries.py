"""The library's operators applied to whole tables, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import aggregates, gates, joins, selection, windows
from ..sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("""
SELECT CASE WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_totalprice < 20000 THEN 'too_small' WHEN o_orderpriority = '5-LOW' THEN 'low_priority'
            WHEN o_orderdate < TIMESTAMP '1994-01-01' THEN 'too_old' ELSE 'ok' END AS reason, count(*) AS rows FROM orders GROUP BY 1""")
def q_reason_gate(spark, sf_dir):
    rules = [
        ("pending", F.col("o_orderstatus") == "P"),
        ("too_small", F.col("o_totalprice") < 20000),
        ("low_priority", F.col("o_orderpriority") == "5-LOW"),
        ("too_old", F.col("o_orderdate") < F.lit("1994-01-01").cast("timestamp_ntz")),
    ]
    return gates.reason_counts(gates.gate(_t(spark, sf_dir, "orders"), rules))


@_query("""
SELECT event_id, coalesce(try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT), 0) AS k,
       coalesce(regexp_extract(props, '"k": *([0-9]+)', 1) = '1', false) AS k_is_true, coalesce(trunc(value)::BIGINT, 0) AS whole,
       event_type AS kind, NULLIF(event_type, 'null') AS kind_or_null FROM events""")
def q_coerce(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    return e.select(
        "event_id",
        coerce.to_int(k).alias("k"),
        coerce.to_bool(k).alias("k_is_true"),
        coerce.to_int(F.col("value")).alias("whole"),
        coerce.first_non_null(F.lit("n/a"), "event_type").alias("kind"),
        coerce.nullish("event_type").alias("kind_or_null"),
    )


TERMS = ["licensed under", "all rights reserved", "mit license", "@"]


@_query("""
SELECT doc_id, contains(lower(text), 'licensed under') OR contains(lower(text), 'all rights reserved') OR contains(lower(text), 'mit license') OR contains(text, '@') AS has_notice
FROM documents""")
def q_keyword_gate(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", coerce.contains_any("text", TERMS).alias("has_notice"))


@_query(r"""
WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]+')) AS x FROM documents),
n AS (SELECT doc_id, x::INT AS k, count(*) AS v FROM r WHERE length(x) <= 3 AND x::INT <= 127 GROUP BY ALL),
s AS (SELECT doc_id, string_agg(k || ':' || v, ';' ORDER BY k) AS programs, sum(v)::INT AS n FROM n GROUP BY 1)
SELECT doc_id, coalesce(programs, '') AS programs, coalesce(n, 0) AS n FROM documents LEFT JOIN s USING (doc_id)""")
def q_program_multiset(spark, sf_dir):
    numbers = coerce.parse_numbers("text")
    docs = _t(spark, sf_dir, "documents").select("doc_id", numbers.alias("p"))
    return docs.select("doc_id", coerce.multiset_text(coerce.multiset(F.col("p"))).alias("programs"), F.size("p").alias("n"))


@_query("""
WITH l AS (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS parts, count(*) FILTER (l_returnflag = 'R') AS returned, sum(l_quantity)::BIGINT AS quantity FROM lineitem GROUP BY 1),
x AS (SELECT o_orderkey, coalesce(n, 0) AS n, coalesce(parts, 0) AS parts, coalesce(returned, 0) AS returned, coalesce(quantity, 0) AS quantity, o_orderpriority FROM orders LEFT JOIN l ON l_orderkey = o_orderkey),
r AS (SELECT *, CASE WHEN n < 1 THEN 4 WHEN n >= 5 AND returned = 0 THEN 0 WHEN n >= 3 AND 2 * returned <= n THEN 1 WHEN quantity >= 50 THEN 2 ELSE 3 END AS rule FROM x)
SELECT o_orderkey, CASE rule WHEN 0 THEN 'strict' WHEN 1 THEN 'probable' WHEN 2 THEN 'candidate' ELSE 'rejected' END AS level,
       CASE WHEN rule >= 3 THEN 0 ELSE greatest(0, least(100, CASE rule WHEN 0 THEN 84 WHEN 1 THEN 68 ELSE 50 END + least(n, 30) // 3 + 2 * least(parts, 4) - 5 * least(returned, 5) - CASE WHEN o_orderpriority = '5-LOW' THEN 8 ELSE 0 END)) END::BIGINT AS score
FROM r""")
def q_tiered_class(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"), F.count(F.when(F.col("l_returnflag") == "R", 1)).alias("returned"), F.sum("l_quantity").cast("long").alias("quantity")
    )
    zero = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n", "parts", "returned", "quantity")}
    x = _t(spark, sf_dir, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumns(zero)
    n, returned = F.col("n"), F.col("returned")

    def score(base):
        low = F.when(F.col("o_orderpriority") == "5-LOW", 8).otherwise(0)
        return F.greatest(F.lit(0), F.least(F.lit(100), base + F.floor(F.least(n, F.lit(30)) / 3) + 2 * F.least("parts", F.lit(4)) - 5 * F.least(returned, F.lit(5)) - low)).cast("long")

    rules = [
        (n < 1, {"level": "rejected", "score": F.lit(0).cast("long")}),
        ((n >= 5) & (returned == 0), {"level": "strict", "score": score(84)}),
        ((n >= 3) & (2 * returned <= n), {"level": "probable", "score": score(68)}),
        (F.col("quantity") >= 50, {"level": "candidate", "score": score(50)}),
    ]
    return gates.classify(x, rules, {"level": "rejected", "score": F.lit(0).cast("long")}).select("o_orderkey", "level", "score")


@_query("""
WITH x AS (SELECT p_type AS family, l_orderkey FROM lineitem JOIN part ON p_partkey = l_partkey)
SELECT family, count(DISTINCT l_orderkey) AS records_present, count(*)::BIGINT AS occurrences,
       printf('%.8f', count(DISTINCT l_orderkey)::DOUBLE / (SELECT count(*) FROM orders)) AS record_fraction FROM x GROUP BY 1""")
def q_family_balance(spark, sf_dir):
    parts = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("family"))
    long = aggregates.long_form(_t(spark, sf_dir, "lineitem").join(parts, "l_partkey"), "l_orderkey", "family")
    return aggregates.presence(long, "l_orderkey", "family", "n", _t(spark, sf_dir, "orders").count())


@_query(r"""
WITH p AS (SELECT string_split(regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', ''), '/') AS s FROM pages),
d AS (SELECT s, unnest(range(1, least(4, len(s)) + 1)) AS depth FROM p)
SELECT depth::INT AS depth, array_to_string(s[1:depth], '/') AS prefix, count(*) AS rows FROM d GROUP BY 1, 2""")
def q_prefix_rollup(spark, sf_dir):
    return aggregates.prefix_rollup(_pages(spark, sf_dir), "path")


def _pages(spark, sf_dir):
    path = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")
    return _t(spark, sf_dir, "pages").select("page_id", path.alias("path"))


@_query("""
WITH k AS (SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders)
SELECT o_orderkey, o_custkey, CASE WHEN k <= 3 THEN 0 WHEN k <= 10 THEN 1 ELSE 2 END AS stage FROM k ORDER BY stage, o_totalprice DESC, o_orderkey LIMIT 5000""")
def q_cap_select(spark, sf_dir):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return selection.capped_select(_t(spark, sf_dir, "orders"), "o_custkey", order, (3, 10, None), 5000).select("o_orderkey", "o_custkey", "stage")


@_query("SELECT doc_id, sha256(text) AS sha, doc_id = min(doc_id) OVER (PARTITION BY sha256(text)) AS is_canonical FROM documents")
def q_canonical_hash(spark, sf_dir):
    return selection.canonical_flag(_t(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha")), "sha", "doc_id")


@_query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) = 1")
def q_dedup_best(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return selection.dedup(items, ["l_orderkey"], [F.desc("l_extendedprice"), F.asc("l_linenumber")]).select("l_orderkey", "l_linenumber", "l_partkey")


def _allocated(spark, sf_dir):
    """Conversations as clusters: rows are turns, rarity is the number of turns."""
    turns = _t(spark, sf_dir, "conversations")
    reps = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("size"))
    order = [F.desc("n"), F.desc("size"), F.sha2(F.concat(F.lit("rare|"), F.col("conv_id").cast("string")), 256)]
    return turns, selection.allocate(reps, "conv_id", [("rare", 5, order)], [("dev", 10), ("sealed", 15)])


_ALLOC = """
WITH c AS (SELECT conv_id, count(*) AS n, sum(length(text)) AS size FROM conversations GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY n DESC, size DESC, sha256('rare|' || conv_id)) AS rr FROM c),
d AS (SELECT *, CASE WHEN rr > 5 THEN row_number() OVER (PARTITION BY rr > 5 ORDER BY sha256('dev|' || conv_id)) END AS dr FROM r),
s AS (SELECT *, CASE WHEN dr > 10 THEN row_number() OVER (PARTITION BY coalesce(dr > 10, false) ORDER BY sha256('sealed|' || conv_id)) END AS sr FROM d),
a AS (SELECT conv_id, CASE WHEN rr <= 5 THEN 'rare' WHEN dr <= 10 THEN 'dev' WHEN sr <= 15 THEN 'sealed' ELSE 'train' END AS split FROM s)
"""


@_query(_ALLOC + "SELECT conv_id, split FROM a")
def q_cluster_alloc(spark, sf_dir):
    return _allocated(spark, sf_dir)[1]


@_query(_ALLOC + """, t AS (SELECT conv_id, split, md5(text) AS text_hash FROM conversations JOIN a USING (conv_id)),
k AS (SELECT 'conv_id' AS key_name, conv_id::VARCHAR AS key, split FROM t UNION ALL SELECT 'text_hash', text_hash, split FROM t)
SELECT key_name, key, count(DISTINCT split) AS n_splits FROM k GROUP BY 1, 2 HAVING count(DISTINCT split) > 1""")
def q_leak_audit(spark, sf_dir):
    turns, splits = _allocated(spark, sf_dir)
    return aggregates.leak_audit(turns.select("conv_id", F.md5("text").alias("text_hash")).join(splits, "conv_id"), ["conv_id", "text_hash"], "split")


@_query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), o AS (SELECT count(DISTINCT l_orderkey) AS n FROM l),
f AS (SELECT l_partkey, count(*)::DOUBLE / (SELECT n FROM o) AS f FROM l GROUP BY 1)
SELECT l_orderkey, count(*) AS n_items, min(f) * (SELECT n FROM o) AS least, count(*) FILTER (f <= 0.0004) AS n_rare FROM l JOIN f USING (l_partkey) GROUP BY 1""")
def q_rarity(spark, sf_dir):
    long = aggregates.long_form(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")
    n = long.select("l_orderkey").distinct().count()
    out = aggregates.rarity(long, "l_orderkey", "l_partkey", n, 0.0004)
    least = F.round(F.pow(F.lit(10.0), -(F.col("rarity") - 0.04 * F.col("n_items"))) * n)
    return out.select("l_orderkey", "n_items", least.alias("least"), F.size("rare_items").cast("long").alias("n_rare"))


@_query(r"""
WITH d AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS t FROM documents),
b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{5,}')) AS t FROM benchmark),
p AS (SELECT doc_id, item_id, count(*) AS score FROM d JOIN b USING (t) GROUP BY ALL),
m AS (SELECT doc_id, max(score) AS score FROM p GROUP BY 1),
x AS (SELECT doc_id, min(item_id) AS item_id, any_value(score) AS score FROM p JOIN m USING (doc_id, score) GROUP BY 1 HAVING count(*) = 1)
SELECT doc_id, item_id, score FROM x""")
def q_fuzzy_tokens(spark, sf_dir):
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{5,})"), F.lit(1))
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("").alias("name"), words.alias("tokens"))
    items = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.lit(None).cast("string").alias("name"), words.alias("tokens"))
    found = joins.token_match(docs, items, weight=1)
    return found.filter("rid IS NOT NULL").select(F.col("lid").alias("doc_id"), F.col("rid").alias("item_id"), "score")


@_query("""
WITH n AS (SELECT lower(substr(n_name, 1, 2)) AS k, min(n_name) AS region FROM nation GROUP BY 1 HAVING count(DISTINCT n_name) = 1)
SELECT s_suppkey, n.k IS NOT NULL AS matched, coalesce(n.region, s_name) AS region FROM supplier JOIN nation ON n_nationkey = s_nationkey LEFT JOIN n ON n.k = lower(substr(n_name, 1, 2))""")
def q_ambiguous_key(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation").withColumn("k", F.lower(F.substring("n_name", 1, 2)))
    left = _t(spark, sf_dir, "supplier").join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "k"), "s_nationkey")
    right = nation.select("k", F.col("n_name").alias("region"))
    return joins.unambiguous_lookup(left, right, "k", "region", F.col("s_name")).select("s_suppkey", "matched", "region")


@_query("SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 100000)")
def q_semi(spark, sf_dir):
    big = _t(spark, sf_dir, "orders").filter("o_totalprice > 100000").select(F.col("o_custkey").alias("c_custkey"))
    return _t(spark, sf_dir, "customer").join(big, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@_query("SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_anti(spark, sf_dir):
    return _t(spark, sf_dir, "documents").join(_t(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_anti").select("doc_id", "lang", "source")


@_query(r"""
WITH p AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', '') AS path FROM pages),
d AS (SELECT s, unnest(range(1, least(2, len(s)) + 1)) AS n FROM (SELECT string_split(path, '/') AS s FROM p)),
f AS (SELECT array_to_string(s[1:n], '/') AS prefix FROM d GROUP BY 1 HAVING count(*) >= 5)
SELECT page_id, prefix FROM p JOIN f ON p.path = prefix OR starts_with(p.path, prefix || '/')""")
def q_prefix_join(spark, sf_dir):
    pages = _pages(spark, sf_dir)
    frequent = aggregates.prefix_rollup(pages, "path", 2).groupBy("prefix").agg(F.sum("rows").alias("rows")).filter("rows >= 5")
    return joins.prefix_join(pages, frequent, "path", "prefix").select("page_id", "prefix")


@_query("""
WITH c AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), p AS (SELECT user_id, ts, event_id AS purchase, value FROM events WHERE event_type = 'purchase')
SELECT c.event_id, p.purchase AS last_purchase, p.ts AS last_ts FROM c ASOF LEFT JOIN p ON c.user_id = p.user_id AND c.ts >= p.ts""")
def q_asof(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    clicks = e.filter("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = e.filter("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase"))
    return joins.asof_join(clicks, bought, "ts", "user_id", ["purchase"], F.date_trunc("DAY", "ts")).select("event_id", "last_purchase", "last_ts")


BANDS = [(0, 0.0, 10.0, "low"), (1, 5.0, 40.0, "middle"), (2, 30.0, 90.0, "high"), (3, 0.0, 1000.0, "any")]


@_query("SELECT event_id, CASE WHEN value >= 0 AND value < 10 THEN 'low' WHEN value >= 5 AND value < 40 THEN 'middle' WHEN value >= 30 AND value < 90 THEN 'high' WHEN value >= 0 AND value < 1000 THEN 'any' ELSE 'none' END AS band FROM events")
def q_interval_join(spark, sf_dir):
    bands = spark.createDataFrame(BANDS, "ord int, lo double, hi double, band string")
    return joins.interval_first(_t(spark, sf_dir, "events").select("event_id", "value"), bands, "value", "lo", "hi", "ord", "band", F.lit("none")).select("event_id", "band")


@_query("SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000 RANGE BETWEEN 1800 PRECEDING AND 1800 FOLLOWING) AS density FROM events")
def q_density(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", _seconds("ts").alias("at"))
    return windows.range_density(e, "user_id", "at", 1800).select("event_id", "density")


def _seconds(c: str):
    """Whole seconds of a time without zone."""
    return F.floor(F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {c})") / 1_000_000)


@_query("""
SELECT event_id, x - lag(x) OVER w AS gap_before, lead(x) OVER w - x AS gap_after, least(x - lag(x) OVER w, lead(x) OVER w - x, 3600) AS gap_bound
FROM (SELECT *, epoch_us(ts) // 1000000 AS x FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY x, event_id)""")
def q_gaps(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("event_id", "user_id", _seconds("ts").alias("x"))
    return windows.gap_bounds(e, "user_id", "x", F.lit(3600).cast("long"), F.floor(F.col("x") / 86_400)).select("event_id", "gap_before", "gap_after", "gap_bound")


@_query("SELECT event_id, sum(round(value * 100)::BIGINT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM events")
def q_prefix_sum(spark, sf_dir):
    e = _t(spark, sf_dir, "events").withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return windows.running_sum(e, "user_id", ["ts", "event_id"], "cents", bucket=F.date_trunc("DAY", "ts")).select("event_id", "running")


@_query("SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2")
def q_longform(spark, sf_dir):
    return aggregates.long_form(_t(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


@_query("SELECT event_type, count(*) AS rows, min(event_id) AS first_seen FROM events GROUP BY 1 ORDER BY 2 DESC, 3 LIMIT 3")
def q_topk_first_seen(spark, sf_dir):
    return aggregates.top_k(_t(spark, sf_dir, "events"), "event_type", "event_id", 3)


@_query("""
WITH r AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 2000 AS shard FROM orders)
SELECT printf('part-%05d', shard + 1) AS file, count(*) AS rows, min(o_orderkey) AS least, max(o_orderkey) AS greatest FROM r GROUP BY shard""")
def q_shard_index(spark, sf_dir):
    rows = sinks.sharded(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), [F.asc("o_orderdate"), F.asc("o_orderkey")], 2000)
    out = rows.groupBy("__shard").agg(F.count("*").alias("rows"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("greatest"))
    return out.select(F.format_string("part-%05d", "__shard").alias("file"), "rows", "least", "greatest")


@_query("""SELECT '{"key":' || n_nationkey || ',"name":"' || n_name || '","region":"' || r_name || '"}' AS value FROM nation JOIN region ON r_regionkey = n_regionkey""")
def q_jsonl(spark, sf_dir):
    region = _t(spark, sf_dir, "region")
    nation = _t(spark, sf_dir, "nation").join(region, F.col("r_regionkey") == F.col("n_regionkey"))
    return sinks.json_lines(nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("key"), F.col("r_name").alias("region")))


@_query("""
SELECT 'unlabelled' AS kind, doc_id FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
UNION ALL SELECT 'labelled', doc_id FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
UNION ALL SELECT 'any', doc_id FROM (SELECT doc_id FROM documents UNION SELECT doc_id FROM labels)""")
def q_setops(spark, sf_dir):
    docs, labels = (_t(spark, sf_dir, t).select("doc_id") for t in ("documents", "labels"))
    kinds = {"unlabelled": docs.subtract(labels), "labelled": docs.intersect(labels), "any": docs.union(labels).distinct()}
    named = [df.select(F.lit(k).alias("kind"), "doc_id") for k, df in kinds.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@_query("""
SELECT l_returnflag, count(*) AS rows, median(l_quantity)::DOUBLE AS median_quantity, (sum(l_quantity)::BIGINT * 1000) // count(*) AS mean_milli FROM lineitem GROUP BY 1""")
def q_median_stats(spark, sf_dir):
    items = _t(spark, sf_dir, "lineitem")
    mean = F.floor(F.sum("l_quantity").cast("long") * 1000 / F.count("*")).alias("mean_milli")
    stats = items.groupBy("l_returnflag").agg(F.count("*").alias("rows"), mean)
    return stats.join(aggregates.exact_median(items, ["l_returnflag"], "l_quantity", "median_quantity"), "l_returnflag")


@_query("""
SELECT count(*) AS rows, bool_and(o_totalprice > 0) AS positive, bool_and(o_orderstatus IN ('F', 'O', 'P')) AS known_status, bool_and(o_custkey IS NOT NULL) AS has_customer,
       count(*) = count(DISTINCT o_orderkey) AS unique_o_orderkey,
       bool_and(o_totalprice > 0) AND bool_and(o_orderstatus IN ('F', 'O', 'P')) AND bool_and(o_custkey IS NOT NULL) AND count(*) = count(DISTINCT o_orderkey) AS passed FROM orders""")
def q_boolall(spark, sf_dir):
    tests = {"positive": F.col("o_totalprice") > 0, "known_status": F.col("o_orderstatus").isin("F", "O", "P"), "has_customer": F.col("o_custkey").isNotNull()}
    return aggregates.check(_t(spark, sf_dir, "orders"), tests, ["o_orderkey"])


@_query("""
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS chord_rank, count(*) OVER (PARTITION BY o_custkey, o_orderdate) AS chord_size,
       ((dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) - 1) % 2)::INT AS chord_parity FROM orders""")
def q_chords(spark, sf_dir):
    return windows.spread_in_chord(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_orderkey", "chord_rank", "chord_size", "chord_parity")


@_query("""
SELECT s_suppkey, s_nationkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank, printf('SUP-%05d', row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey)) AS match_id FROM supplier""")
def q_rank_rows(spark, sf_dir):
    rows = selection.numbered(_t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal"), [F.desc("s_acctbal"), F.asc("s_suppkey")])
    return rows.select("s_suppkey", "s_nationkey", "rank", F.format_string("SUP-%05d", "rank").alias("match_id"))


@_query("""
SELECT n_nationkey, substr(sha256(n_name || ':' || n_regionkey), 1, 20) AS pair_id, regexp_replace(lower(n_name), '[^a-z0-9]+', '', 'g') AS slug,
       md5(n_name) AS md5, printf('%.6f', n_regionkey / 7.0) AS ratio FROM nation""")
def q_identifiers(spark, sf_dir):
    return _t(spark, sf_dir, "nation").select(
        "n_nationkey",
        coerce.short_hash(F.concat_ws(":", "n_name", "n_regionkey")).alias("pair_id"),
        coerce.key("n_name").alias("slug"),
        F.md5("n_name").alias("md5"),
        F.format_string("%.6f", F.col("n_regionkey") / 7.0).alias("ratio"),
    )


@_query("""
WITH r AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS k FROM customer)
SELECT c_nationkey, c_custkey AS representative FROM r WHERE k = 1""")
def q_representative(spark, sf_dir):
    rows = selection.representative(_t(spark, sf_dir, "customer"), "c_nationkey", [F.desc("c_acctbal"), F.asc("c_custkey")])
    return rows.select("c_nationkey", F.col("c_custkey").alias("representative"))


@_query("""
WITH t AS (SELECT event_id, user_id, event_type, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events)
SELECT event_id, CASE WHEN n > 60 THEN event_type ELSE 'single' END AS anchor FROM t""")
def q_group_demote(spark, sf_dir):
    e = aggregates.group_sizes(_t(spark, sf_dir, "events"), ["user_id", "event_type"])
    return e.select("event_id", F.when(F.col("size") > 60, F.col("event_type")).otherwise("single").alias("anchor"))


@_query("SELECT c_nationkey, max(c_acctbal) AS best, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS who FROM customer GROUP BY 1")
def q_argmax(spark, sf_dir):
    who = F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("who")
    return _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.max("c_acctbal").alias("best"), who)


@_query("""
SELECT source, count(*) AS rows, count(DISTINCT md5(text)) AS texts, count(*) - count(DISTINCT md5(text)) AS duplicates, string_agg(DISTINCT lang, '|' ORDER BY lang) AS langs FROM documents GROUP BY 1""")
def q_duplicates(spark, sf_dir):
    texts = F.countDistinct(F.md5("text"))
    langs = F.array_join(F.array_sort(F.collect_set("lang")), "|").alias("langs")
    return _t(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("rows"), texts.alias("texts"), (F.count("*") - texts).alias("duplicates"), langs)
