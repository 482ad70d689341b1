import random
from collections import Counter

import duckdb

from sparkloom.llm import quality


def brute(text):
    text = text or ""
    words = text.encode().split()
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(words), sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def texts(n=300, seed=0):
    rng, out = random.Random(seed), []
    for _ in range(n):
        body = [rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(5, 80))]
        if rng.random() < 0.1:
            body = [w + "***" for w in body]
        if rng.random() < 0.1:
            body = body[:6] * 5
        out.append(rng.choice([" ", "\n", "  "]).join(body))
    return out


def test_measures(odd, docs):
    for df in (odd, docs(texts(60))):
        got = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.op2(df).collect() if r.doc_id is not None)
        assert got == sorted((r.doc_id, *brute(r.text)) for r in df.collect() if r.doc_id is not None)


def test_same_as_sql(docs):
    df = docs(texts())
    documents = df.toPandas()  # noqa: F841
    want = sorted(duckdb.sql(quality.ORACLE).fetchall())
    got = sorted(tuple(r) for r in quality.op2(df).collect())
    assert got == want
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_many_groups_join_alike(docs, monkeypatch):
    df = docs(texts())
    few = sorted(tuple(r) for r in quality.op2(df).collect())
    monkeypatch.setattr(quality, "BROADCAST_GROUPS", 0)
    assert sorted(tuple(r) for r in quality.op2(df).collect()) == few


def test_keep_good(docs, odd):
    df = docs(texts())
    kept = quality.keep_good(df)
    assert kept.columns == df.columns
    want = sorted(r.doc_id for r in quality.op2(df).collect() if r.kept)
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert {r.doc_id for r in quality.keep_good(odd).collect()} <= {7}
    assert quality.keep_good(odd.limit(0)).count() == 0 and quality.op2(odd.limit(0)).count() == 0


def test_junk_sources_get_no_looser_fence(docs):
    rng = random.Random(5)

    def source(name, first, n, junk):
        body = [(first + i, " ".join("".join(rng.choices("abcdefgh", k=5)) + ("***" if i < junk else "") for _ in range(30))) for i in range(n)]
        return docs(body, source=name)

    df = source("clean", 0, 1500, 0).unionByName(source("some", 2000, 300, 90)).unionByName(source("most", 3000, 300, 240))
    kept = {r.doc_id for r in quality.keep_good(df).collect()}
    assert kept == {*range(1500), *range(2090, 2300), *range(3240, 3300)}


def test_each_rule_rejects_its_kind(docs):
    rng = random.Random(6)
    plain = [(i, "\n".join(" ".join("".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(8)) for _ in range(rng.randrange(4, 12)))) for i in range(600)]
    line = lambda: " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(3, 8))) for _ in range(8))
    odd = {
        1001: "\n".join([line() + " # $ %"] * 1 + [line() + " & * <" for _ in range(6)]),  # symbols
        1002: "\n".join(" ".join(w for w in line().split() for _ in range(2)) for _ in range(5)),  # neighbours repeat
        1003: "\n".join([line() for _ in range(40)] + ["a b"] * 5),  # lines repeat
        1004: "\n".join("".join(rng.choices("abcdefgh", k=30)) + " " + "".join(rng.choices("abcdefgh", k=30)) for _ in range(8)),  # long words
        1005: "\n".join("a b c d e f g h".replace("a", rng.choice("xyz") + str(i)) for i in range(8)),  # short words
    }
    rows = {r.doc_id: r for r in quality.judged(docs(plain + list(odd.items()))).collect()}
    assert all(not rows[i].base_failed and not rows[i].kept for i in odd if i != 1005)
    assert sum(rows[i].kept for i, _ in plain) >= 590


def test_fences_adapt_to_language_and_source(docs):
    rng = random.Random(7)

    def source(name, lang, first, low, high):
        body = [(first + i, " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(low, high))) for _ in range(60))) for i in range(400)]
        return docs(body, lang=lang, source=name)

    df = source("news", "en", 0, 3, 7).unionByName(source("law", "en", 1000, 6, 14)).unionByName(source("news", "de", 2000, 4, 12))
    rows = quality.judged(df).collect()
    limits = {(r.lang, r.source): (r.lo_word_len, r.hi_word_len) for r in rows}
    assert len(set(limits.values())) == 3 and limits["en", "law"][0] > limits["en", "news"][0]
    assert sum(r.kept for r in rows) > 0.98 * len(rows)


def test_sketches_merge(docs, spark):
    rows = spark.createDataFrame([("a", str(i % 3), i * i % 5000, i % 7, 0, i) for i in range(3000)], "lang string, source string, symbols long, adjacent long, dup_lines long, word_len long")
    own = quality.sketches(rows)
    whole = {(r.measure): (r.l25, r.q25, r.q75) for r in quality.quantiles(quality.merged(own)).collect()}
    values = sorted(i * i % 5000 for i in range(3000))
    low, *ends = whole["symbols"]
    assert low <= values[749] < low + low / 32 + 1
    for got, exact in zip(ends, (values[749], values[2249])):
        assert exact <= got <= exact * (1 + 1 / 32) + 1
