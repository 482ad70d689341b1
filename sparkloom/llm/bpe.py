"""Byte-pair encoding by forced boundaries, and decoding.

Two neighbouring bytes that stand side by side in no vocabulary token can never be
merged, as any merge over them would make a token that holds both. Such a pair
marks a certain cut. Every word is cut there; the fragments are merged apart from
each other, and their ids are put one after the other. Only a word's last
fragment carries the word end.

The vocabulary file is that of the `tokenizers` library: NFC, runs of white space
to a space, lower case, the split pattern, byte-level letters, and merges by rank.
Special tokens are found in the raw text first, as the library does.

Rules for odd input: a null text is empty, which has no ids; repeated rows come out
as often as they came; extra columns are ignored; an empty table gives no rows. The
path of the vocabulary is a parameter; the file is read on the driver and its
content is broadcast (about 1.6 MB, a fixed size).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import cached_property
from hashlib import sha256

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Words and fragments remembered by a worker at most; then the memory starts anew.
CACHE = 400_000
SEPARATORS = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    """Encoder and decoder of one vocabulary file's content."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end: str = model.get("end_of_word_suffix") or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.ranks = {m: i for i, m in enumerate(merges)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"], regex.V0)
        self.specials = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        letters = byte_letters()
        self.letter = letters
        byte_of = {c: b for b, c in enumerate(letters)}
        joined = [False] * 65536
        for token in self.ids:
            body = token.removesuffix(self.end) if self.end else token
            codes = [byte_of[c] for c in body if c in byte_of]
            for a, b in zip(codes, codes[1:], strict=False):
                joined[a << 8 | b] = True
        self.joined = joined
        self.fragments: dict[tuple[bytes, bool], tuple[int, ...]] = {}
        self.words: dict[str, tuple[int, str, str]] = {}
        self.spans: dict[str, tuple[int, str, str]] = {}

    def cuts(self, data: bytes) -> list[bytes]:
        """The fragments of a word between forced boundaries."""
        out, lo, joined = [], 0, self.joined
        for i in range(1, len(data)):
            if not joined[data[i - 1] << 8 | data[i]]:
                out.append(data[lo:i])
                lo = i
        out.append(data[lo:])
        return out

    def merge(self, data: bytes, last: bool) -> tuple[int, ...]:
        """Ids of a fragment: the pair of least rank merges first, leftmost among equals."""
        parts: list[str | None] = [self.letter[b] for b in data]
        if last:
            parts[-1] += self.end
        n = len(parts)
        if n < 24:
            get, none = self.ranks.get, 1 << 40
            ranked = [get(p, none) for p in zip(parts, parts[1:])]  # noqa: B905
            while ranked:
                best = min(ranked)
                if best == none:
                    break
                at = ranked.index(best)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                del ranked[at]
                if at:
                    ranked[at - 1] = get((parts[at - 1], parts[at]), none)
                if at < len(ranked):
                    ranked[at] = get((parts[at], parts[at + 1]), none)
            return tuple(map(self.ids.__getitem__, parts))
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []
        for i in range(n - 1):
            if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None:
                heap.append((r, i, parts[i], parts[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.ranks.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return tuple(self.ids[p] for p in parts if p is not None)

    def word(self, word: str) -> tuple[int, str, str]:
        """Number of ids of a word, its ids and its tokens, joined by spaces."""
        cuts, ids, seen = self.cuts(word.encode()), [], self.fragments
        for i, piece in enumerate(cuts):
            key = (piece, i + 1 == len(cuts))
            own = seen.get(key)
            if own is None:
                if len(seen) >= CACHE:
                    seen.clear()
                own = self.merge(*key)
                if len(piece) <= 64:
                    seen[key] = own
            ids += own
        return len(ids), " ".join(map(str, ids)), " ".join(self.tokens[i] for i in ids)

    def normal(self, text: str) -> str:
        text = unicodedata.normalize("NFC", text)
        if text.isascii():
            return text.lower()
        return text.replace("Σ", "σ").lower()  # a final sigma is no special case for the library

    def pieces(self, text: str):
        """(word or special token, whether special) in order."""
        lo = 0
        if self.specials is not None and "<" in text:
            for m in self.specials.finditer(text):
                yield text[lo : m.start()], False
                yield m.group(), True
                lo = m.end()
        yield text[lo:], False

    def span(self, part: str) -> tuple[int, str, str]:
        """Number of ids, ids and tokens of raw text without special tokens."""
        found = []
        for w in self.pattern.findall(self.normal(part)):
            own = self.words.get(w)
            if own is None:
                if len(self.words) >= CACHE:
                    self.words.clear()
                own = self.words[w] = self.word(w)
            found.append(own)
        if len(found) == 1:
            return found[0]
        return sum(x[0] for x in found), " ".join(x[1] for x in found), " ".join(x[2] for x in found)

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids and decoded text of a text, as strings.

        White space is in no word, and neither NFC nor lower case reaches over it, so what
        stands between white space is encoded by itself and remembered. The four
        separators that only Python takes for white space go the plain way.
        """
        found: list[tuple[int, str, str]] = []
        cache = self.spans
        for part, special in self.pieces(text):
            if special:
                found.append((1, str(self.special[part]), part))
            elif SEPARATORS.search(part):
                found.append(self.span(part))
            else:
                words = part.split()
                if len(cache) + len(words) > CACHE:
                    cache.clear()
                for w in {*words}:
                    if w not in cache:
                        cache[w] = self.span(w)
                found += map(cache.__getitem__, words)
        found = [x for x in found if x[0]]
        if not found:
            return 0, "", ""
        n, ids, tokens = zip(*found, strict=True)
        if len(cache) > CACHE:
            cache.clear()
        return sum(n), " ".join(ids), " ".join(tokens)

    def encode(self, text: str) -> list[int]:
        return [int(x) for x in self.both(text)[1].split()]

    def decode(self, ids: list[int]) -> str:
        """The tokens of known ids joined by spaces: the file has no decoder."""
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


class Shared:
    """A vocabulary's content, for workers; its codec is made once in each."""

    made: dict[int, Codec] = {}

    def __init__(self, spark, path: str):
        with open(path, encoding="utf-8") as f:
            self.content = spark.sparkContext.broadcast(f.read())

    @cached_property
    def codec(self) -> Codec:
        text = self.content.value
        key = hash(text)
        if key not in self.made:
            self.made[key] = Codec(text)
        return self.made[key]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (array of int) and decoded text of each row."""
    shared = Shared(common.session(docs), path)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])

    def run(batches):
        for b in batches:
            rows = [shared.codec.both(t or "") for t in b.column(1).to_pylist()]
            ids = pa.array([list(map(int, x.split())) for _, x, _ in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array([x for _, _, x in rows], pa.string())], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def op7(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""
    shared = Shared(common.session(docs), path)
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        for b in batches:
            rows = [(n, sha256(ids.encode()).hexdigest(), sha256(text.encode()).hexdigest()) for n, ids, text in (shared.codec.both(t or "") for t in b.column(1).to_pylist())]
            n, ids, text = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
