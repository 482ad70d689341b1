import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from sparkloom.llm import lm_scoring as L


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def is_held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows, weights=None):
    """Scores by plain dictionaries, with the weights of the operator or those of a plain EM."""
    uni, pair = Counter(), Counter()
    part_uni, part_pair, points = Counter(), Counter(), []
    for i, t in rows:
        ws = tokens(t)
        if not is_held(i):
            uni.update(ws)
            pair.update(zip([b"", *ws], ws))
            if i is not None and zlib.crc32(str(i).encode()) // 7 % 10 == 0:
                part_uni.update(ws)
                part_pair.update(zip([b"", *ws], ws))
    n, v = sum(uni.values()), len(uni)
    level = lambda c: 0 if c == 0 else int(math.log2(c)) + 1
    if weights is None:
        rest = n - sum(part_uni.values())
        for (h, w), k in part_pair.items():
            c = uni[h] - part_uni[h]
            p2 = (pair[h, w] - part_pair[h, w]) / c if c else 0.0
            points += [(level(c), p2, (uni[w] - part_uni[w]) / max(rest, 1))] * k
        weights = np.tile([0.3, 0.5, 0.2], (L.BUCKETS, 1))
        weights[0] = [0, 0.8, 0.2]
        last = None
        for _ in range(L.ROUNDS):
            share, like = np.zeros((L.BUCKETS, 3)), 0.0
            for b, p2, p1 in points:
                parts = weights[b] * [np.float32(p2), np.float32(p1), 1 / (v + 1)]
                share[b] += parts / parts.sum()
                like += math.log(parts.sum())
            weights = (share + 3 * np.tile([0.3, 0.5, 0.2], (L.BUCKETS, 1))) / (share.sum(axis=1, keepdims=True) + 3)
            weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]
            if not points or last is not None and abs(like - last) <= L.SETTLED * len(points):
                break
            last = like
    out = []
    for i, t in rows:
        ws = tokens(t)
        score = 0.0
        for h, w in zip([b"", *ws], ws):
            l2, l1, l0 = weights[level(uni[h])]
            score += math.log10(l2 * (pair[h, w] / uni[h] if uni[h] else 0) + l1 * uni[w] / max(n, 1) + l0 / (v + 1))
        out.append((i, is_held(i), len(ws), sum(uni[w] > 0 for w in ws), n, sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in ws), score))
    return out


def same(got, want):
    got, want = (sorted(x, key=lambda r: (repr(r[0]), r[2], r[5])) for x in (got, want))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-4)


def test_same_as_brute_force(docs, monkeypatch):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        at, words = rng.randrange(200), []
        for _ in range(rng.randrange(0, 40)):
            at = (at * 7 + rng.randrange(3)) % 200
            words.append(f"w{at}")
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(L, "BLOCK_BYTES", 3000)
    got = [tuple(r) for r in L.op3(docs(rows).repartition(3)).collect()]
    same(got, brute(rows))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_odd_rows(odd):
    same([tuple(r) for r in L.op3(odd).collect()], brute([(r.doc_id, r.text) for r in odd.collect()]))
    assert L.op3(odd.limit(0)).count() == 0
