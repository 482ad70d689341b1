import random

import numpy as np
import pytest
import xxhash

from sparkloom.llm import simhash

WORDS = [f"w{i}" for i in range(400)]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    ids = [i for i, _ in rows]
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            r = find(i)
            least[r] = min(least.get(r, x), x)
    return sorted(((x, f"{f:016x}", least.get(find(i))) for i, (x, f) in enumerate(zip(ids, fps))), key=repr)


def rows_with_copies(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            words = rng.choice(rows)[1].split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, " ".join(rng.choices(WORDS, k=rng.randrange(3, 200)))))
    return rows


@pytest.mark.parametrize("plan", [None, *simhash.PLANS])
def test_components_match_brute_force(docs, plan):
    rows = rows_with_copies(150, 1)
    got = simhash.near_duplicates(docs(rows), plan=plan).collect()
    assert sorted(((r.id, f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in got), key=repr) == brute_components(rows)


def test_full_buckets_lose_no_link(docs):
    rows = rows_with_copies(150, 2)
    got = simhash.near_duplicates(docs(rows), max_bucket=2).collect()
    assert sorted(((r.id, f"{r.fp & (1 << 64) - 1:016x}", r.component) for r in got), key=repr) == brute_components(rows)


def test_full_buckets_of_unlike_fingerprints(spark):
    """Many fingerprints that share a segment by chance, some of them near each other: the second cut parts them, and finds all links."""
    rng = random.Random(8)
    fps = set()
    for _ in range(600):
        fp = rng.getrandbits(46) | 5 << 46 if rng.random() < 0.8 else rng.getrandbits(64)
        fps.add(fp)
        for _ in range(rng.randrange(3)):
            for b in rng.sample(range(64), rng.randrange(1, 6)):
                fp ^= 1 << b
            fps.add(fp)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = {(a, b) for a in signed for b in signed if a > b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4}
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    for bucket in (16, 1000):  # the full one is cut once more, or isn't full
        got = [tuple(r) for r in simhash.links(nodes, len(signed), bucket).collect()]
        assert set(got) == want and len(got) == len(want) > 100


def test_odd_rows(odd, spark):
    got = simhash.op9(odd).collect()
    want = brute_components([(r.doc_id, r.text) for r in odd.collect()])
    assert sorted(map(tuple, got), key=repr) == want
    assert simhash.op9(odd.limit(0)).count() == 0


def test_keep_first(docs, odd):
    rows = rows_with_copies(60, 3)
    kept = simhash.keep_first(docs(rows))
    assert kept.columns == docs(rows).columns
    want = {c for _, _, c in brute_components(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert simhash.keep_first(odd).filter("doc_id = 4").count() == 1


def test_keep_first_with_null_and_repeated_ids(docs):
    rng = random.Random(4)
    a, b, c, d, e = (" ".join(rng.choices(WORDS, k=60)) for _ in range(5))
    rows = [(None, a), (None, b), (None, b), (None, c), (1, c), (2, d), (5, d), (5, e), (6, e), (6, e)]
    got = simhash.keep_first(docs(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted([(None, a), (None, b), (1, c), (2, d), (5, e)], key=repr)


def test_fingerprint_of_long_text_in_parts():
    text = " ".join(random.Random(0).choices(WORDS, k=70_000))
    words = text.encode().split()
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(len(words) - 3)], np.uint64)
    bits = sum(1 << b for b in range(64) if 2 * int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) > len(hashes))
    assert simhash.fingerprint(text.encode()) == bits
