import random
from hashlib import sha256

import pytest
from tokenizers import Tokenizer

from sparkloom.llm import bpe

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")
TEXTS = [
    "", "  ", "Hello, World! it's we'RE 123", "<|startoftext|>Hi<|endoftext|> x <|ENDOFTEXT|>", "ΣΑΣ İstanbul ǅ ﬁ é é it's ½ ²³ 你好 🙂👍🏽",
    "a\x1cb\x85c\xa0d e \x00\x01 ﻿", "x" * 500 + "!" * 300, "ᾈ ẞ ß Ω Å ﷺ", "'S 'Ll ''s't", "ა Ა ꙮ ⅷ Ⅷ 𐐀 𞤀", "́x ́", "ȩ́ q̣̇",
]


@pytest.fixture(scope="module")
def both():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    with open(PATH, encoding="utf-8") as f:
        return t, bpe.Codec(f.read())


def test_as_the_library(both):
    t, c = both
    rng = random.Random(0)
    pool = [chr(x) for x in [*range(32, 127)] * 3 + [*range(160, 600)] + [0x3B1, 0x3A3, 0x301, 0x4E00, 0x1F642, 0x200B, 0x2028, 9, 10, 13, 28, 133]]
    for text in TEXTS + ["".join(rng.choices(pool, k=rng.randrange(1, 60))) for _ in range(2000)]:
        e = t.encode(text, add_special_tokens=False)
        n, ids, decoded = c.both(text)
        assert (n, ids) == (len(e.ids), " ".join(map(str, e.ids))), text
        assert decoded == t.decode(e.ids, skip_special_tokens=False)
        assert c.encode(text) == e.ids and c.decode(e.ids) == decoded


def test_cuts_are_certain(both):
    t, c = both
    assert c.cuts("ab".encode()) == [b"ab"]
    word = "x一ɐz🙂"
    assert b"".join(c.cuts(word.encode())) == word.encode() and len(c.cuts(word.encode())) > 1
    long = "theand" * 40
    assert " ".join(map(str, c.merge(long.encode(), True))) == c.both(long)[1] == " ".join(map(str, t.encode(long, add_special_tokens=False).ids))


def test_small_cache(both, monkeypatch):
    t, c = both
    monkeypatch.setattr(bpe, "CACHE", 3)
    for text in TEXTS + ["one two three four five six one two"] * 2:
        assert c.encode(text) == t.encode(text, add_special_tokens=False).ids


def test_query(odd, both):
    t, _ = both
    want = []
    for r in odd.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), sha256(" ".join(map(str, ids)).encode()).hexdigest(), sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, bpe.op7(odd, PATH).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.op7(odd.limit(0), PATH).count() == 0
    rows = bpe.encoded(odd, PATH).collect()
    assert {(r.id, tuple(r.ids)) for r in rows} == {(r.doc_id, tuple(t.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect()}
