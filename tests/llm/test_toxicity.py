import math
import random
import zlib

from pyspark.sql import functions as F

from sparkloom.llm import toxicity as T


def corpus(n=600, seed=0):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abcdefghijklmnop", k=rng.randrange(2, 9))) for _ in range(500)]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(8, 60))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "zqrax" + "".join(rng.choices("abcd", k=3)), "moron"]))
        rows.append((i, " ".join(words) + "."))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_and_scores_held_out_rows(spark, docs):
    rows, labels = corpus()
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = T.op1(docs(rows), y).collect()
    truth = {i: t for i, _, t in labels}
    out = [r for r in got if r.held_out]
    assert len(got) == len(rows) and len(out) > 50
    assert sum(r.predicted == truth[r.doc_id] for r in out) / len(out) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_labels_of_held_out_rows_change_nothing(spark, docs):
    rows, labels = corpus(200)
    held = {r.doc_id for r in docs(rows).filter(T.held_out(F.col("doc_id"))).collect()}
    schema = "doc_id long, quality int, toxic int"
    a = T.op1(docs(rows), spark.createDataFrame(labels, schema)).collect()
    b = T.op1(docs(rows), spark.createDataFrame([(i, q, 1 - t if i in held else t) for i, q, t in labels], schema)).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_odd_rows_and_no_labels(odd, spark):
    schema = "doc_id long, quality int, toxic int"
    for y in ([], [(1, 1, None), (None, 1, 1)], [(4, 1, 1), (4, 1, 0), (7, 1, 0)]):
        got = T.op1(odd, spark.createDataFrame(y, schema)).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert T.op1(odd.limit(0), spark.createDataFrame([], schema)).count() == 0
    kept = T.keep_clean(odd, spark.createDataFrame([], schema))
    assert kept.columns == odd.columns and kept.count() == odd.count()


def test_grammar():
    lexicon, rules = T.Lexicon({"idiot": 4.0}, {"zqrax": 3.0}), T.grammar()
    plain = T.evidence("an idiot here", lexicon, rules)
    assert plain == 4.0
    assert T.evidence("you idiot", lexicon, rules) > plain
    assert T.evidence("not an idiot", lexicon, rules) < plain
    assert T.evidence("she said idiot", lexicon, rules) < plain
    assert T.evidence("she said no. an idiot", lexicon, rules) == plain  # a clause of its own
    assert T.evidence("zqraxabc idiot", lexicon, rules) == 7.0
    assert T.evidence("zqrax", lexicon, rules) == 0.0  # a stem needs a longer word
    assert T.evidence("i will kill you", lexicon, rules) < T.evidence("you i will kill", lexicon, rules)
    assert T.evidence("", lexicon, rules) == 0.0


def test_target_on_either_side():
    lexicon, rules = T.Lexicon({"idiot": 4.0}, {}), T.grammar()
    for text in ("i will kill you", "we will hurt you", "töten dich"):
        assert T.evidence(text, lexicon, rules) == T.THREAT_WEIGHT
    assert T.evidence("i will kill it. you", lexicon, rules) < 1  # a target of another clause
    assert T.evidence("i will not kill you", lexicon, rules) == T.THREAT_WEIGHT * 0.25
    assert T.evidence("idiot, you", lexicon, rules) == T.evidence("you, idiot", lexicon, rules) == T.evidence("you idiot, you", lexicon, rules) > 4.0


def test_sample_folds_near_copies_of_one_label(spark, docs):
    ids = [r.id for r in spark.range(100).filter(~T.held_out(F.col("id"))).orderBy("id").limit(7).collect()]
    copy = "several considerable elephants wandering"
    texts = ["you are pathetic", "he isn't pathetic", "so pathetic", copy, copy + " on", copy + " by", "you are pathetic"]
    toxic = [1, 0, 1, 0, 0, 1, 1]
    labels = spark.createDataFrame(list(zip(ids, [1] * 7, toxic)), "doc_id long, quality int, toxic int")
    got = T.sample(docs(list(zip(ids, texts))), labels).collect()
    assert sorted((r.text, r.toxic) for r in got) == sorted((texts[i], toxic[i]) for i in (0, 1, 2, 3, 5))


def test_composition_runs_both():
    a = T.Transducer(0, {(0, "x"): (1, "y", -1.0)})
    b = T.Transducer("p", {("p", "y"): ("q", "z", -2.0)})
    c = T.compose(a, b, ["x", "y"])
    assert c.step(c.start, "x") == ((1, "q"), "z", -3.0)
    assert c.step((1, "q"), "x") == ((1, "q"), "x", 0.0)


def slow_evidence(text, lexicon):
    """By positions instead of transducers."""
    best = {}
    for clause in T.CLAUSE.split(text.lower()):
        words = T.LETTERS.findall(clause)
        entries = [lexicon.entry(w) for w in words]
        hits = [i for i, w in enumerate(words) if entries[i] or w in T.THREATS]
        for i in hits:
            before, after = words[:i], words[i + 1 :]
            plain = lambda w, kinds: lexicon.entry(w) is None and w not in T.THREATS and w in kinds
            negated = any(plain(words[j], T.NEGATORS) and not any(j < h < i for h in hits) for j in range(max(0, i - 3), i))
            aimed_before, aimed_after = any(plain(w, T.TARGETS) for w in before), any(plain(w, T.TARGETS) for w in after)
            x = (0.25 if negated else 1.0) * (0.6 if any(plain(w, T.REPORTS) for w in before) else 1.0)
            if entries[i]:
                name, x = entries[i], x * lexicon.weight(entries[i]) * (1.3 if aimed_before or aimed_after else 1.0)
            else:
                name, x = f"t:{words[i]}", x * T.THREAT_WEIGHT * (1.0 if aimed_before or aimed_after else 0.1) * (1.3 if aimed_before else 1.0)
            best[name] = max(best.get(name, 0.0), x)
    return sum(best.values())


def test_evidence_as_by_positions():
    rng = random.Random(11)
    lexicon = T.Lexicon({"idiot": 4.0, "moron": 2.5}, {"stup": 3.0})
    vocabulary = ["idiot", "moron", "stupid", "stupendous", "kill", "hurt", "you", "your", "not", "never", "said", "calls", "the", "a", "river", "they"]
    rules = T.grammar()
    for _ in range(3000):
        text = " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", "", ".", ",", "!"]) for _ in range(rng.randrange(1, 14)))
        assert abs(T.evidence(text, lexicon, rules) - slow_evidence(text, lexicon)) < 1e-9, text


def test_query_as_by_positions(spark, docs):
    """The whole query: its scores are the logistic curve of the slow evidence under the model it learned."""
    rng = random.Random(12)
    vocabulary = ["river", "stone", "garden", "letter", "window", "you", "not", "said", "the", "people"]
    rows, marks = [], []
    for i in range(400):
        words = rng.choices(vocabulary, k=rng.randrange(4, 30))
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), rng.choice(["idiots", "worthless", "wretchkin"]))
        rows.append((i, " ".join(words) + rng.choice([".", "! And then more", ""])))
        marks.append((i, int(i % 4 == 0)))
    df, labels = docs(rows), spark.createDataFrame(marks, "doc_id long, toxic int")
    lexicon, a, b = T.learn(df, labels)
    got = {r.doc_id: r for r in T.op1(df, labels).collect()}
    for i, text in rows:
        want = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * min(slow_evidence(text, lexicon), 30.0)))))
        assert abs(got[i].score - want) < 1e-9 and got[i].predicted == (want >= 0.3) and got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) > 0.95 * len(held)
