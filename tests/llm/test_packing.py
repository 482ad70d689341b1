import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from sparkloom.llm import packing as P
from sparkloom.llm import simhash


def brute(items, capacity, most):
    """Best fit by trying every bin."""
    room, sources, clusters, out = [], [], [], []
    for n, s, c in items:
        fits = [b for b in range(len(room)) if room[b] >= n and sources[b][s] < most and c not in clusters[b]]
        b = min(fits, key=lambda b: (room[b], b), default=None)
        if b is None:
            b = len(room)
            room.append(capacity)
            sources.append(Counter())
            clusters.append(set())
        out.append((b, capacity - room[b]))
        room[b] -= n
        sources[b][s] += 1
        clusters[b].add(c)
    return out


def test_best_fit_as_brute_force():
    rng = random.Random(0)
    for trial in range(60):
        items = [(rng.randrange(0, 101), rng.randrange(rng.choice([1, 3, 20])), rng.randrange(rng.choice([2, 30, 1000]))) for _ in range(rng.randrange(0, 120))]
        for most in (1, 2, 4):
            assert P.pack(items, 100, most) == brute(items, 100, most)


def check(rows, docs, capacity, most):
    words = {}
    for r in docs:
        words.setdefault(r.doc_id, []).append(r)
    bins = defaultdict(list)
    total = Counter()
    for r in rows:
        bins[r.bin_id].append(r)
        total[r.doc_id] += r.n_words
    assert all(total[i] == sum(len((r.text or "").split()) for r in rs) for i, rs in words.items())
    for rs in bins.values():
        rs.sort(key=lambda r: (r.bin_offset, r.n_words))
        at = 0
        for r in rs:
            assert r.bin_offset == at
            at += r.n_words
        assert at <= capacity
        texts = [words[r.doc_id][0].text or "" for r in rs]
        assert len(set(texts)) == len(texts)
        assert max(Counter(words[r.doc_id][0].source for r in rs).values()) <= most


def test_bins(docs):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.choice([3, 20, 90, 700])))) for i in range(300)] + [(1000 + i, "copy of one text") for i in range(40)]
    df = docs(rows)
    got = P.packed(df, 100, 3, 64).collect()
    check(got, df.collect(), 100, 3)
    assert sorted({r.doc_id for r in got}) == sorted(i for i, _ in rows)
    assert sorted(P.packed(df.orderBy(F.desc("doc_id")), 100, 3, 64).collect()) == sorted(got)  # whatever the order of rows


def test_near_copies_never_share_a_bin(docs):
    rng = random.Random(2)
    rows = []
    for _ in range(12):
        words = [f"w{rng.randrange(500)}" for _ in range(120)]
        for k in range(5):
            copy = [w.upper() if k == 1 else w for w in words]
            if k > 1:
                copy[-1] = f"other{k}"
            rows.append((len(rows), ("  " if k == 4 else " ").join(copy)))
    df = docs(rows)
    component = {r.doc_id: r.component_id for r in simhash.op9(df).collect()}
    assert len(set(component.values())) < 30
    got = P.op10(df).collect()
    assert len({(r.bin_id, component[r.doc_id]) for r in got}) == len(got) == len(rows)
    assert len({r.bin_id for r in got}) < len(rows)  # others still share


def test_odd_rows(odd):
    got = P.op10(odd).collect()
    assert len({r.doc_id for r in got}) == 8 and sum(r.n_words for r in got if r.doc_id == 5) == 30000
    assert len({r.bin_id for r in got if r.doc_id == 4}) == 2  # repeated rows are copies
    assert P.op10(odd.limit(0)).count() == 0


def test_text_ids_with_nulls_and_empty_ones(spark):
    rows = [(None, "a b", "s"), ("", "a b c", "s"), ("x", "a b d", None), (None, "a b e", "s"), ("", "", "s"), ("x", None, "s")]
    got = P.op10(spark.createDataFrame(rows, "doc_id string, text string, source string")).collect()
    assert sorted((r.doc_id or "", r.n_words) for r in got) == [("", 0), ("", 2), ("", 3), ("", 3), ("x", 0), ("x", 3)]


def test_shards_fill_bins_nearly_as_well_as_one(docs):
    rng = random.Random(3)
    df = docs([(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 20, 90, 300])))) for i in range(3000)])
    df = df.withColumn("source", (F.col("doc_id") % 40).cast("string"))
    bins = lambda shard: P.packed(df, 1000, 4, shard).select("bin_id").distinct().count()
    assert bins(1024) <= 1.02 * bins(10**6)
