"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch are inserted into a trie over the vocabulary's base symbols. A depth-first walk gives each
node the last token of the encoding of its prefix: the token t ending there for which the encoding of the shorter prefix
ends in a token u such that u and t together encode to exactly [u, t]. There is one such t, so words that share a prefix
share its encoding, and a word's tokens are read off by stepping back from its last node.

Defined cases: a null or empty text has no tokens; the special tokens' own strings in a text are their tokens, as in the
tokenizers library; texts are taken whole; rows with equal ids are encoded each; an empty table gives an empty result;
other columns have no part in it.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_small_batches

#: Encoded words a task remembers, texts it takes at a time, and symbols above which a word isn't remembered.
REMEMBERED, TEXTS, LONG_WORD = 300_000, 256, 64


def _byte_symbols() -> list[str]:
    """The visible character that byte-level vocabularies use for each byte: printable Latin-1 for itself, 256 and up for the rest."""
    own = {b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Encoder:
    """Encodes and decodes as the tokenizers library does with a lower-casing word-end BPE vocabulary file.

    A token is its merge history: `parts` has the two tokens that it was merged from, `rank` when. A last symbol of a word
    is one character of its own here, LAST plus its byte.
    """

    LAST = 0xE000

    def __init__(self, definition: str):
        spec = json.loads(definition)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.split = regex.compile(pattern).findall
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")").split
        self.symbols = _byte_symbols()
        self.last_of = {c: chr(self.LAST + b) for b, c in enumerate(self.symbols)}
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        made: dict[int, int] = {}
        for r, m in enumerate(model["merges"]):
            left, right = m.split(" ") if isinstance(m, str) else m
            pair = self.vocab[left], self.vocab[right]
            self.rank[pair] = r
            if (token := self.vocab[left + right]) not in made:
                made[token], self.parts[token] = r, pair
        self.made = made
        self.edges: dict[tuple[int, int], list[tuple[int, float]]] = {}
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, tuple[str, int, str]] = {}
        self.suffixes: dict = {}  # the tokens by their symbols from the last to the first
        for name, token in self.vocab.items():
            body = name.removesuffix(self.end)
            if token in self.parts and not self._apart(*self.parts[token], made[token]) or len(body) > 1 and token not in self.parts:
                continue  # plain BPE never makes it
            node = self.suffixes
            for symbol in reversed(body if body == name else body[:-1] + self.last_of[body[-1]]):
                node = node.setdefault(symbol, {})
            node[""] = token

    def words(self, text: str) -> list[str]:
        """The normalised words of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower() would choose the final form by context
        return self.split(text.lower())

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The tokens that stand at an end of the token while it is merged (side 0: its left end), with the rank of the merge that ends each."""
        if (known := self.edges.get((token, side))) is None:
            known, until, at = [], float("inf"), token
            while True:
                known.append((at, until))
                if at not in self.parts:
                    break
                until, at = self.made[at], self.parts[at][side]
            self.edges[token, side] = known
        return known

    def _apart(self, before: int, token: int, until: float = float("inf")) -> bool:
        """Whether no merge of a rank below `until` joins the two tokens' symbols across their border."""
        rank = self.rank
        for x, x_until in self._edge(before, 1):
            for y, y_until in self._edge(token, 0):
                r = rank.get((x, y))
                if r is not None and r < until and r < x_until and r <= y_until:
                    return False
        return True

    def encode_words(self, words: set[str]) -> dict[str, tuple[str, int, str]]:
        """Of each word: its ids joined by spaces, their number, its tokens joined by spaces."""
        symbols, last_of, names, pairs, suffixes = self.symbols, self.last_of, self.names, self.pairs, self.suffixes
        trie: dict = {}
        for word in words:
            path = [symbols[b] for b in word.encode("utf-8", "surrogatepass")]
            path[-1] = last_of[path[-1]]
            node = trie
            for symbol in path:
                node = node.setdefault(symbol, {})
            node[""] = word
        if len(pairs) > REMEMBERED:
            pairs.clear()
        out: dict[str, tuple[str, int, str]] = {}
        longest = max(map(len, words), default=0) * 4 + 2
        path, last, start = [""] * longest, [0] * longest, [0] * longest
        stack = [(0, symbol, node) for symbol, node in trie.items()]
        while stack:
            depth, symbol, node = stack.pop()
            path[depth] = symbol
            depth += 1
            ends, at, found = suffixes, depth, []
            while at:
                at -= 1
                ends = ends.get(path[at])
                if ends is None:
                    break
                if "" in ends:
                    found.append((ends[""], at))
            for token, at in reversed(found):
                if not at:
                    break
                pair = last[at] << 20 | token
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self._apart(last[at], token)
                if fits:
                    break
            last[depth], start[depth] = token, at
            for below, child in node.items():
                if below:
                    stack.append((depth, below, child))
                else:
                    tokens, at = [], depth
                    while at:
                        tokens.append(last[at])
                        at = start[at]
                    tokens.reverse()
                    out[child] = (" ".join(map(str, tokens)), len(tokens), " ".join([names[t] for t in tokens]))
        return out

    def encode(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """Of each text: the number of its tokens, its ids joined by spaces and the decoded text."""
        parts = []
        for text in texts:
            if any(s in text for s in self.special):
                parts.append([w for i, piece in enumerate(self.cut(text)) for w in (self.words(piece) if i % 2 == 0 else [("", piece)])])
            else:
                parts.append(self.words(text))
        known = self.known
        new = set().union(*parts) - known.keys()
        here = {w: (str(self.special[w[1]]), 1, w[1]) for w in new if isinstance(w, tuple)}
        here |= self.encode_words({w for w in new if isinstance(w, str)})
        if len(known) + len(here) > REMEMBERED:
            for words in parts:
                for w in words:
                    if w in known:
                        here[w] = known[w]
            known.clear()
        known.update(here)
        out = []
        for words in parts:
            found = [known[w] for w in words]
            out.append((sum([f[1] for f in found]), " ".join([f[0] for f in found]), " ".join([f[2] for f in found])))
        for w in [w for w in here if len(w) > LONG_WORD]:
            del known[w]
        return out

    def decode(self, ids: list[int]) -> str:
        """As decode(ids, skip_special_tokens=False) with no decoder: the tokens' strings joined by spaces; unknown ids are left out."""
        return " ".join([self.names[i] for i in ids if i in self.names])


@lru_cache(1)
def _encoder(definition: str) -> Encoder:
    """One for all tasks of a Python worker."""
    return Encoder(definition)


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, under the vocabulary file at `path`."""
    return _run(docs, path, key, text, "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string", _digest)


def encodings(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array) and decoded (text) of every document."""
    return _run(docs, path, key, text, "doc_id {}, ids array<int>, decoded string", _plain)


def _digest(n: int, ids: str, decoded: str) -> tuple:
    return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest()


def _plain(n: int, ids: str, decoded: str) -> tuple:
    return [int(i) for i in ids.split(" ")] if ids else [], decoded


def _run(docs: DataFrame, path: str, key: str, text: str, schema: str, shape) -> DataFrame:
    with open(path, encoding="utf-8") as f:  # a vocabulary file of fixed size, a few MB, broadcast once
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    schema = schema.format(rows.schema["key"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                done = [shape(*x) for x in encoder.encode(part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array([d[i] for d in done], t) for i, t in enumerate(kinds))], names=names)
        encoder.known.clear()  # the worker goes on to other tasks
        encoder.pairs.clear()

    names = [f.split(" ")[0] for f in schema.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}[f.split(" ")[1]] for f in schema.split(", ")[1:]]
    return in_small_batches(rows).mapInArrow(run, schema)
