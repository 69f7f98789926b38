"""Benchmark decontamination by spaced-seed hashing.

Fixed masks slide over the words of documents and of benchmark items; the words at a mask's selected positions are hashed,
those at its other positions are ignored, so that a hit survives substitutions there. Hashes of both sides are joined. Each
hit fixes how the item lies over the document; around it, word by word, the overlap is verified: an item is found if at
least OVERLAP of its words stand at their places. Everything runs as DataFrame operations.

The masks lose nothing down to OVERLAP: LONG hits every way in which 10 words keep 8 or 15 keep 12, and each longer item is
made of such stretches, one of which keeps its share; items of 8 and 9 words, which may lose one, are hit as well. Items of
5 to 7 words have MIDDLE, and shorter ones, which may lose none, are hashed whole.

Defined cases: words are runs of letters, marks and digits, lower-cased; null texts and texts without words match nothing;
items of fewer words than `shortest` match nothing (the queries search all, from one word up); items with equal words are searched once and reported
each; an item found at several places is reported once per document id, with its largest overlap and first such place; rows
with equal ids count as one document for the report, and each for the filter; a null id is an id like any other; an empty
table gives an empty result (or all documents, where there is no benchmark); other columns pass through untouched, whatever
their names.

Nothing is gathered: hits are verified row by row, each against the blocks of the text that the item lies over, so a passage
that a million items share, or a text that they all hit, is a million rows and no list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import digest, lookup_join, small, stored, words

# The masks; 1 marks a word that is hashed. Each hashes five words.
MASKS = ("110111", "11010011")
LONG, MIDDLE = (*MASKS, "11111"), ("1111", "11011", "10111", "11101")
#: The share of an item's words that a document has to hold at their places.
OVERLAP = 0.8
#: Words of the shortest item that is searched where a caller doesn't say.
SHORTEST = 6
#: Words of the blocks into which texts are cut to be verified.
BLOCK = 64


def _masks(n: int) -> tuple[str, ...]:
    """The masks for items of n words; the same from 8 up."""
    return ("1" * n,) if n < 5 else MIDDLE if n < 8 else LONG


def _with_seeds(df: DataFrame, words_col: str, masks: list[str]) -> DataFrame:
    """One row a mask and place: the other columns, seed (null where the mask stands out over the end), mask, pos."""
    spots = sorted({i for mask in masks for i in _spots(mask)})
    others = [c for c in df.columns if c != words_col]
    hashed = df.select(*others, F.transform(words_col, lambda w: F.xxhash64(w)).alias("__hashes"))
    # the hash i places on stands beside each hash, so that seeds are made in generated code
    shifted = F.arrays_zip(*[F.slice("__hashes", i + 1, F.greatest(F.size("__hashes"), F.lit(1))).alias(f"h{i}") for i in spots])
    placed = hashed.select(*others, F.posexplode(shifted).alias("pos", "__h"))
    seeds = [F.when(F.col(f"__h.h{len(mask) - 1}").isNotNull(), F.xxhash64(F.lit(k), *[F.col(f"__h.h{i}") for i in _spots(mask)])) for k, mask in enumerate(masks)]
    return placed.select(*others, "pos", F.posexplode(F.array(*seeds)).alias("mask", "seed"))


def _spots(mask: str) -> list[int]:
    return [i for i, bit in enumerate(mask) if bit == "1"]


def _items(benchmark: DataFrame, item: str, text: str, shortest: int) -> tuple[DataFrame, DataFrame]:
    """The distinct word sequences of the benchmark (key, words), and the ids of each (key, id)."""
    rows = benchmark.select(F.col(item).alias("id"), words(F.col(text)).alias("words")).where(F.size("words") >= max(1, shortest)).withColumn("key", digest(F.col("words")))
    return stored(rows.groupBy("key").agg(F.any_value("words").alias("words")), "items"), stored(rows.select("key", "id").distinct(), "names")


def _text_key(text: str) -> Column:
    return digest(F.coalesce(F.col(text), F.lit("")))


def _hits(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """Where items may lie: __key (of a text), key (of an item) and start (first word, may be negative), once each; of items under 5 words, which match whole, the first of a text."""
    length = F.least(F.size("words"), F.lit(8))
    lengths = [r[0] for r in items.select(length).distinct().collect()] or [8]
    masks = sorted({mask for n in lengths for mask in _masks(n)})
    own = F.create_map(*[F.lit(x) for n in lengths for x in (n, [masks.index(m) for m in _masks(n)])])
    seeds = _with_seeds(items.select("key", "words", length.alias("n")), "words", masks).where(F.col("seed").isNotNull() & F.array_contains(own[F.col("n")], F.col("mask")))
    found = _with_seeds(docs.select(_text_key(text).alias("__key"), words(F.col(text)).alias("__words")), "__words", masks)
    by_seed = stored(seeds.select("seed", "key", F.col("pos").alias("at"), (F.col("n") < 5).alias("whole")), "seeds")
    hits = lookup_join(found, by_seed, ["seed"], "inner", ["pos", "__key"]).select("__key", "key", (F.col("pos") - F.col("at")).alias("start"), "whole")
    return stored(hits.groupBy("__key", "key", F.when(~F.col("whole"), F.col("start")).alias("at")).agg(F.min("start").alias("start")).drop("at"), "hits")


def verified(docs: DataFrame, items: DataFrame, share: float = OVERLAP, text: str = "text") -> DataFrame:
    """__key, key, matched, length and start of each overlap of a text with an item of which at least `share` stands at its place.

    A hit is cut at the borders of the text's blocks, and each piece is held against its block; only blocks that hits lie
    over are kept, once for all copies of a text.
    """
    hits = _hits(docs, items, text)
    size, start = F.size("words"), F.col("start")
    blocks = F.sequence(F.floor(F.greatest(F.lit(0), start) / BLOCK).cast("int"), F.floor((start + size - 1) / BLOCK).cast("int"))
    pieces = hits.join(F.broadcast(items) if small(items) else items, "key").select("__key", "key", "start", "words", F.explode(blocks).alias("block"))
    first = F.greatest(F.lit(0), F.col("block") * BLOCK - start)  # of the item's words in this block
    last = F.least(size, (F.col("block") + 1) * BLOCK - start) - 1
    pieces = pieces.select("__key", "key", "start", "block", size.alias("length"), (start + first - F.col("block") * BLOCK).alias("at"), F.slice("words", first + 1, last - first + 1).alias("piece"))
    wanted = stored(pieces.groupBy("__key").agg(F.collect_set("block").alias("__blocks")), "wanted")  # no more than the text has
    rows = lookup_join(docs.select(_text_key(text).alias("__key"), F.col(text).alias("__text")), wanted, ["__key"], "inner", ["__text"])
    cut = F.transform("__blocks", lambda b: F.struct(b.alias("block"), F.slice("__words", b * BLOCK + 1, F.lit(BLOCK)).alias("own")))
    kept = rows.select("__key", "__blocks", words(F.col("__text")).alias("__words")).select("__key", F.inline(cut)).where(F.size("own") > 0)
    kept = stored(kept.groupBy("__key", "block").agg(F.any_value("own").alias("own")), "blocks")
    both = lookup_join(pieces, kept, ["__key", "block"], "inner", ["key", "start"])
    equal = F.size(F.filter(F.sequence(F.lit(0), F.size("piece") - 1), lambda j: F.get("own", j + F.col("at")) == F.get("piece", j)))
    sums = both.groupBy("__key", "key", "start").agg(F.sum(equal).alias("matched"), F.any_value("length").cast("long").alias("length"))
    return stored(sums.where(F.col("matched") >= F.col("length") * F.lit(share)).select("__key", "key", "matched", "length", F.col("start").cast("long").alias("start")), "verified")


def report(docs: DataFrame, benchmark: DataFrame, share: float = OVERLAP, key: str = "doc_id", shortest: int = SHORTEST) -> DataFrame:
    """doc_id, item_id, matched, length, start of every benchmark item found in a document."""
    items, names = _items(benchmark, "item_id", "text", shortest)
    best = F.min(F.struct((-F.col("matched")).alias("m"), "start", "length"))
    found = stored(verified(docs, items, share).groupBy("__key", "key").agg(best.alias("b")), "best")
    rows = lookup_join(docs.select(F.col(key).alias("doc_id"), _text_key("text").alias("__key")), found, ["__key"], "inner", ["doc_id"])
    rows = lookup_join(rows, names, ["key"], "inner", ["__key", "doc_id"])
    rows = rows.groupBy("doc_id", F.col("id").alias("item_id")).agg(F.min("b").alias("b"))
    return rows.select("doc_id", "item_id", (-F.col("b.m")).alias("matched"), F.col("b.length").alias("length"), F.col("b.start").alias("start"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, share: float = OVERLAP, text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """The documents, in their own columns, that hold no benchmark item."""
    bad = stored(verified(docs, _items(benchmark, "item_id", "text", shortest)[0], share, text).select("__key").distinct(), "contaminated")
    rows = docs.select(F.struct("*").alias("__doc"), _text_key(text).alias("__key"))
    kept = lookup_join(rows, bad.withColumn("__bad", F.lit(True)), ["__key"], "left", ["__doc"]).where("__bad IS NULL")
    return kept.select(*[F.col("__doc")[c].alias(c) for c in docs.columns])


# no seeds here: every way in which an item may lie over a document is counted by the words that agree
ORACLE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{M}}\p{{N}}]+') AS v FROM benchmark WHERE text IS NOT NULL),
dw AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS i FROM d), bw AS (SELECT item_id, len(v) AS length, unnest(v) AS x, unnest(range(0, len(v))) AS j FROM b),
o AS (SELECT doc_id, item_id, length, i - j AS start, count(*) AS matched FROM dw JOIN bw USING (x) GROUP BY ALL HAVING count(*) >= length * CAST({OVERLAP} AS DOUBLE))
SELECT doc_id, item_id, CAST(matched AS BIGINT) AS matched, CAST(length AS BIGINT) AS length, CAST(start AS BIGINT) AS start
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) AS r FROM o) WHERE r = 1
"""
