"""Operators against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.functions import coerce, families
from sparkloom.operators import aggregates, gates, joins, selection, windows


def test_coercions(spark):
    values = [" Yes ", "n/a", None, "1,234.9", "inf", "x", "NaN", "-7.9", "a  b c", "0"]
    rows = spark.createDataFrame([(v,) for v in values], "v string").select(
        coerce.norm_text("v"), coerce.nullish("v"), coerce.to_bool("v"), coerce.to_bool_strict("v"), coerce.to_float("v"), coerce.to_int("v"), coerce.finite_or_null("v")
    )
    got = [tuple(r) for r in rows.collect()]
    assert got[0] == ("Yes", "Yes", True, True, 0.0, 0, None)
    assert got[1][:2] == ("n/a", None) and got[2] == ("", None, False, False, 0.0, 0, None)
    assert got[3][4:] == (1234.9, 1234, None) and got[4][4:] == (0.0, 0, None) and got[5][3] is None
    assert got[7][4:] == (-7.9, -7, -7.9) and got[8][0] == "a b c" and got[9][3] is False


def test_numbers_and_keys(spark):
    df = spark.createDataFrame([("40-40-041-1234-200-7",), (None,)], "t string")
    p = coerce.parse_numbers("t")
    got = df.select(p, coerce.multiset_text(coerce.multiset(p)), coerce.multiset_json(coerce.multiset(p)), coerce.multiset_from_text(F.lit("7:1;x;40:2"))).collect()
    assert tuple(got[0]) == ([40, 40, 41, 7], "7:1;40:2;41:1", '{"7":1,"40":2,"41":1}', {7: 1, 40: 2}) and got[1][0] == []
    one = spark.range(1).select(coerce.seed64(F.lit("a"), F.lit(1)), coerce.stem(F.lit("./x/Sym.No1.mscz")), coerce.tokens(F.lit("Data/Beethoven/alpha_0012345.abc")), coerce.canonical(F.lit("d/original_Alpha-1.mid.gz"), ["original"])).first()
    from hashlib import sha256

    assert int(one[0]) == int.from_bytes(sha256(b"a\x1f1").digest()[:8], "big")
    assert one[1] == "Sym.No1" and sorted(one[2]) == sorted(["alpha0012345", "beethoven", "alpha", "0012345", "12345"]) and one[3] == "alpha1"


def test_families_overlap_as_stated(spark):
    df = spark.createDataFrame([(list(range(128)),)], "p array<int>")
    for mapping, table in families.FAMILIES.items():
        for name, ranges in table:
            assert df.select(families.in_family(F.col("p"), mapping, name)).first()[0] == sum(b - a + 1 for a, b in ranges)
    whole = spark.range(128).select(families.family_of(F.col("id"), "tiered").alias("f"))
    assert whole.filter("f IS NULL").count() == 0
    assert families.family_table(spark, "balance").groupBy("program").count().filter("count > 1").count() == 8


def test_gate_takes_the_first_reason(spark):
    df = spark.createDataFrame([(1, None), (5, 2), (20, 1), (20, 9)], "a int, b int")
    g = gates.gate(df, [("small", F.col("a") < 3), ("odd", F.col("b") % 2 == 1), ("nine", F.col("b") == 9)])
    assert [r.reason for r in g.collect()] == ["small", "ok", "odd", "odd"]
    assert gates.accepted(g).count() == 1 and gates.rejected(g).count() == 3


@pytest.mark.parametrize("seed", range(3))
def test_capped_select_as_a_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(6), rng.randrange(50)) for i in range(120)]
    ranked = sorted(rows, key=lambda r: (-r[2], r[0]))
    target, got, taken = rng.randrange(1, 110), [], {}
    for cap in (2, 5, None):
        for r in ranked:
            if len(got) < target and r not in got and (cap is None or taken.get(r[1], 0) < cap):
                got.append(r)
                taken[r[1]] = taken.get(r[1], 0) + 1
    df = spark.createDataFrame(rows, "id int, g int, x int")
    out = selection.capped_select(df, "g", [F.desc("x"), F.asc("id")], (2, 5, None), target)
    assert {r.id for r in out.collect()} == {r[0] for r in got}


def test_numbered(spark):
    df = spark.range(1000).repartition(7)
    rows = selection.numbered(df, [F.desc("id")], "n").collect()
    assert all(r.n == 1000 - r.id for r in rows) and selection.numbered(df.limit(0), [F.desc("id")]).count() == 0


def test_asof_and_intervals(spark):
    rng = random.Random(1)
    left = [(i, rng.randrange(3), rng.randrange(100)) for i in range(200)]
    right = [(rng.randrange(3), rng.randrange(100), i) for i in range(60)]
    l, r = spark.createDataFrame(left, "id int, k int, t int"), spark.createDataFrame(right, "k int, t int, v int")
    want = {}
    for i, k, t in left:
        best = max(((b, v) for a, b, v in right if a == k and b <= t), default=(None, None))
        want[i] = best[::-1]
    for bucket in (None, F.floor(F.col("t") / 7)):
        got = {x.id: (x.last_v, x.last_t) for x in joins.asof_join(l, r, "t", "k", ["v"], bucket).collect()}
        assert got == want
    spans = [(i, a, a + rng.randrange(1, 30), f"s{i}") for i, a in enumerate(rng.sample(range(90), 12))]
    s = spark.createDataFrame(spans, "o int, a int, b int, name string")
    first = {i: next((n for _, a, b, n in spans if a <= t < b), "none") for i, _, t in left}
    for most in (joins.BROADCAST_ROWS, 0):
        joins.BROADCAST_ROWS, before = most, joins.BROADCAST_ROWS
        got = {x.id: x.name for x in joins.interval_first(l, s, "t", "a", "b", "o", "name", F.lit("none")).collect()}
        joins.BROADCAST_ROWS = before
        assert got == first


def test_token_match(spark):
    schema = "id string, name string, tokens array<string>"
    left = spark.createDataFrame([("a", "alpha", ["alpha", "x"]), ("b", "beta", ["x"]), ("c", "gamma", ["zzz"]), ("d", "delta", ["x", "y"])], schema)
    right = spark.createDataFrame([("1", "alpha", ["alpha"]), ("2", "beta", ["x"]), ("3", "other", ["x", "y"])], schema)
    got = {r.lid: (r.rid, r.method, r.score) for r in joins.token_match(left, right).collect()}
    assert got == {"a": ("1", "token", 5), "b": ("2", "name", 1), "c": (None, "none", None), "d": ("3", "token", 2)}


def test_lookups(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    right = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y"), ("b", "z"), (None, "w")], "k string, v string")
    got = {r.id: (r.matched, r.v) for r in joins.unambiguous_lookup(left, right, "k", "v", F.lit("?")).collect()}
    assert got == {1: (True, "x"), 2: (False, "?"), 3: (False, "?")}
    got = {r.id: r.v for r in joins.coalesce_lookup(left, right.filter("k IS NOT NULL").dropDuplicates(["k"]), [F.lit("zz"), F.col("k")], "k", "v", F.lit("?")).collect()}
    assert got[1] == "x" and got[3] == "?"
    paths = spark.createDataFrame([("a/b/c",), ("a/bc",), ("a/b",)], "path string")
    p = spark.createDataFrame([("a/b",), ("a",)], "prefix string")
    assert sorted(map(tuple, joins.prefix_join(paths, p, "path", "prefix").select("path", "prefix").collect())) == [("a/b", "a"), ("a/b", "a/b"), ("a/b/c", "a"), ("a/b/c", "a/b"), ("a/bc", "a")]


def test_density_and_segments(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(2), round(rng.random() * 5, 3)) for i in range(120)]
    got = {r.id: r.density for r in windows.range_density(spark.createDataFrame(rows, "id int, k int, t double"), "k", "t", 0.5).collect()}
    assert got == {i: sum(k == b and t - 0.5 <= u <= t + 0.5 for _, b, u in rows) for i, k, t in rows}
    changes = spark.createDataFrame([("f", 0, 400_000), ("f", 480, 1_000_000), ("f", 480, 900_000)], "f string, tick long, tempo long")
    seg = [(r.tick, r.tempo, round(r.seconds, 6)) for r in windows.tempo_segments(changes, "f", F.lit(480)).orderBy("tick").collect()]
    assert seg == [(0, 500_000, 0.0), (480, 1_000_000, 0.5)]


def test_aggregates(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("a", 3), ("b", 4), ("c", 0)], "k string, o int")
    assert [tuple(r) for r in aggregates.top_k(df, "k", "o", 2).collect()] == [("b", 2, 1), ("a", 2, 2)]
    leaks = aggregates.leak_audit(spark.createDataFrame([("w", "x", "train"), ("w", "y", "dev")], "a string, b string, s string"), ["a", "b"], "s")
    assert [tuple(r) for r in leaks.collect()] == [("a", "w", 2)]
    report = aggregates.check(df, {"low": F.col("o") < 4}, ["k"], 5).first()
    assert (report.rows, report.low, report.unique_k, report.row_count, report.passed) == (5, False, False, True, False)
    assert aggregates.check(df.limit(0), {"low": F.col("o") < 4}).first().passed


def test_first_of_many_intervals(spark, monkeypatch):
    import random

    from sparkloom.operators import joins

    rng = random.Random(2)
    rows = [(k, float(a := rng.randrange(100)), float(a + rng.randrange(-3, 40)), f"v{k}") for k in range(150)]
    points = [(i, rng.randrange(-5, 150) / 2) for i in range(400)] + [(999, None)]
    want = {i: next((v for k, a, b, v in rows if x is not None and a <= x < b), "none") for i, x in points}
    intervals, left = spark.createDataFrame(rows, "k int, a double, b double, v string"), spark.createDataFrame(points, "i int, x double")
    for most in (10_000, 10):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", most)
        got = joins.interval_first(left, intervals, "x", "a", "b", "k", "v", F.lit("none"))
        assert {r.i: r.v for r in got.collect()} == want and got.columns == ["i", "x", "v"]


def test_buckets_change_no_window(spark):
    import random

    from sparkloom.operators import aggregates, windows

    rng = random.Random(3)
    rows = [(rng.choice("ab"), i * 7 % 300, rng.randrange(50)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, t int, v int")
    for of in (lambda b: windows.gap_bounds(df, "g", "t", F.lit(9), b), lambda b: windows.running_sum(df, "g", ["t"], "v", bucket=b)):
        plain, cut = of(None), of(F.floor(F.col("t") / 40))
        assert sorted(map(tuple, cut.select(*plain.columns).collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    medians = {r.g: r.median for r in aggregates.exact_median(df, ["g"], "v").collect()}
    import statistics

    assert medians == {g: statistics.median(v for h, _, v in rows if h == g) for g in "ab"}


def test_rare_items_come_by_frequency(spark):
    from sparkloom.operators import aggregates

    long = spark.createDataFrame([(r, i) for r in range(100) for i in {0, 5 if r < 2 else 0, 3 if r < 1 else 0, 9 if r < 1 else 0}], "r int, i int")
    got = {r.r: r.rare_items for r in aggregates.rarity(long, "r", "i", 100, 0.02).collect()}
    assert got[0] == [3, 9, 5] and got[1] == [5] and got[50] == []
    assert sorted(r.i for r in aggregates.rare_items(long, "r", "i", 100, 0.02).collect()) == [3, 9]  # at just 2 % it isn't rare here


def test_samples_preconditions_and_literals(spark):
    import pytest

    from sparkloom.functions import coerce
    from sparkloom.operators import selection

    df = spark.range(2000).repartition(4, "id")
    one, two = (sorted(r.id for r in selection.drawn(df, 0.5, 7).collect()) for _ in range(2))
    assert one == two and 800 < len(one) < 1200 and len(set(one)) < len(one)
    assert selection.at_least(df, 2000, exact=True) is df
    for n, exact in ((2001, False), (1999, True)):
        with pytest.raises(ValueError):
            selection.at_least(df, n, exact=exact)
    for text in ("it's", "back\\slash", "'; --", "ünï"):
        assert spark.sql(f"SELECT {coerce.sql_text(text)} AS t").first().t == text
    now = spark.range(1).select(coerce.iso_now().alias("t"), coerce.seconds_between(coerce.iso_now(), F.lit("x")).alias("none")).first()
    assert now.t.endswith("+00:00") and now.none is None


def test_columns_that_are_headers(spark):
    from sparkloom.operators import joins

    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1")], "f string, n string")
    headers = spark.createDataFrame([("a", ["q", "1_tstamp"]), ("b", ["2_tstamp"])], "f string, header array<string>")
    assert [(r.f, r.n, r.alignment_column) for r in joins.header_join(rows, headers, "f", "n").collect()] == [("a", "1", "1_tstamp")]
