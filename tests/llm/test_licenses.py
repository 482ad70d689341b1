import importlib.metadata
from pathlib import Path

import duckdb
import pytest

from sparkloom.llm import licenses as L

COMMON = Path("/usr/share/common-licenses")


def scan(spark, rows):
    return {r.id: r for r in L.scan(spark.createDataFrame([(*r, 1, 2) for r in rows], "id long, path string, text string, licence int, score int")).collect()}


def test_same_as_sql(docs):
    filler = "and the of to in is it was with by as this that are at from\n"
    texts = []
    for i in range(120):
        body = filler * (i % 5)
        if i % 7 == 0:
            body += L.TEMPLATES[i % len(L.TEMPLATES)][1]
        if i % 11 == 0:
            body = "Licensed, under the terms of: MIT license. " + body
        if i % 13 == 0:
            body = f"# {body}\n#\n" + "\n".join(f"# {x}" for x in L.TEMPLATES[i % len(L.TEMPLATES)][1].split(", "))
        texts.append((i * 37, body))
    df = docs(texts)
    documents = df.toPandas()  # noqa: F841
    want = sorted(duckdb.sql(L.oracle()).fetchall(), key=repr)
    got = sorted(map(tuple, L.op5(df).collect()), key=repr)
    assert got == want and any(r[7] for r in got) and {r[4] for r in got} == {None, "file", "block", "line"}


def test_nearest_ancestor(spark):
    note = "Released under the MIT License."
    rows = [(1, "/a/LICENSE", note), (2, "/a/b/c/x", "text"), (3, "/a/b/LICENSE", "All rights reserved."), (4, "/ab/x", "text"), (5, "/a/b/c/y", "long text " * 20 + "\n" + L.TEMPLATES[13][1]), (6, None, note), (7, "/a/z", None), (8, "/a/z2", "")]
    got = scan(spark, rows)
    assert (got[2].final, got[2].inherited_from) == ("proprietary", "/a/b")
    assert got[4].final is None and got[6].final == "MIT" and got[6].inherited is None
    assert got[5].licence == "GPL-3.0" and got[5].unit == "line" and not got[5].is_file and got[5].inherited == "proprietary" and got[5].final == "GPL-3.0"
    assert got[7].final == got[8].final == "MIT"


@pytest.mark.parametrize("n", range(len(L.TEMPLATES)))
def test_templates_are_told_apart(n):
    """Each template is nearest to itself, so neighbouring licences aren't taken for one another; and each can be found."""
    _, vectors = L.model()
    dots = [sum(x * v.get(t, 0) for t, x in vectors[n].items()) for v in vectors]
    assert dots.index(max(dots)) == n
    assert any(a in L.TEMPLATES[n][1].lower() for a in L.ANCHORS)


def wheel(dist):
    return next(Path(f.locate()).read_text() for f in importlib.metadata.files(dist) if "LICENSE" in f.name)


def test_whole_licence_files_speak_for_their_directories(spark):
    """Real files: wrapped lines, years and names, and all sections, of which the templates have the first ones only."""
    files = {"MIT": wheel("pytest"), "MIT-2": wheel("pluggy"), "BSD-2-Clause": wheel("xxhash"), "BSD-3-Clause": wheel("psutil")}
    for name, path in (("Apache-2.0", "Apache-2.0"), ("GPL-3.0", "GPL-3"), ("GPL-2.0", "GPL-2"), ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0")):
        if (COMMON / path).exists():
            files[name] = (COMMON / path).read_text()
    rows = []
    for i, (name, text) in enumerate(files.items()):
        rows += [(2 * i, f"/src/{name}/LICENSE", text), (2 * i + 1, f"/src/{name}/lib/deep/x.py", "print(1)")]
    got = scan(spark, rows)
    for i, name in enumerate(files):
        want = name.removesuffix("-2") if name == "MIT-2" else name
        assert got[2 * i].is_file and got[2 * i].licence == want, (name, got[2 * i])
        assert (got[2 * i + 1].final, got[2 * i + 1].inherited_from) == (want, f"/src/{name}")


def test_header_comments(spark):
    code = "\n".join(f"x{i} = compute(x{i - 1}) + {i}" for i in range(1, 80))
    head = "#!/usr/bin/env python\n#\n" + "\n".join(f"# {x}" for x in L.TEMPLATES[10][1].replace(", ", ",\n").split("\n")) + "\n\n"
    got = scan(spark, [(1, "/p/a.py", head + code), (2, "/p/b.py", code)])
    assert got[1].licence == "Apache-2.0" and got[1].unit == "block" and got[1].score > 900 and not got[1].is_file
    assert got[2].final is None


def test_odd_rows(odd):
    assert L.op5(odd).count() == odd.count() and L.op5(odd.limit(0)).count() == 0
