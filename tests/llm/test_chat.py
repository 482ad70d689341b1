import random

import duckdb

from sparkloom.llm import chat as C


def brute(chosen, rejected):
    n = 0
    while n < min(len(chosen), len(rejected)) and chosen[n][1:] == rejected[n][1:]:
        n += 1

    def render(turns):
        out, spans = "", []
        for _, role, text in turns:
            out += C.START + role + "\n"
            lo = len(out)
            out += text + C.END
            if role == "assistant":
                spans.append(f"{lo}-{len(out)}")
        return out, ";".join(spans)

    return (n, render(chosen[:n])[0], *render(chosen[n:]), *render(rejected[n:]))


def test_formatted(spark):
    rng = random.Random(0)
    kind = "array<struct<turn:long,role:string,text:string>>"
    make = lambda: [(i, rng.choice(["user", "assistant", "system"]), rng.choice(["a", "bé🙂", ""])) for i in range(rng.randrange(4))]
    pairs = [(i, make(), make()) for i in range(200)]
    df = spark.createDataFrame([(*p, "x") for p in pairs], f"id long, chosen {kind}, rejected {kind}, __n string")
    got = {r.id: (r.n_common, r.prompt, r.chosen, r.chosen_mask, r.rejected, r.rejected_mask) for r in C.formatted(df).collect()}
    assert got == {i: brute(c, r) for i, c, r in pairs}
    none = spark.createDataFrame([(1, None, [(0, "user", "x")]), (2, None, None)], f"id long, chosen {kind}, rejected {kind}")
    rows = {r.id: r for r in C.formatted(none).collect()}
    assert rows[1].n_common == 0 and rows[1].chosen == "" and rows[2].rejected == ""


def test_same_as_sql(spark):
    rng = random.Random(1)
    rows = []
    for c in range(60):
        for t in range(rng.randrange(1, 6)):
            rows.append((c, rng.choice([t, t, None]) if c % 10 == 0 else t, rng.choice(["user", "assistant", "assistant", None]), rng.choice(["hello", "bye", None, "ünï"]), "x"))
    rows += rows[:5]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    conversations = df.toPandas()
    conversations["turn"] = conversations["turn"].astype("Int64")
    want = sorted(duckdb.sql(C.ORACLE).fetchall())
    assert sorted(map(tuple, C.op6(df).collect())) == want
    assert C.op6(df.limit(0)).count() == 0
