"""Near-duplicate detection by Order MinHash with banded alignment.

Words are runs of letters and digits, lower-cased; a document is the sequence of its shingles of five words, each labelled
with how often it has occurred before. A sketch takes the labelled shingles with the smallest hashes under one of many hash
functions and keeps them in the order of the text, so that it is sensitive to edit similarity. Documents with an equal
sketch are candidates. Candidates are verified by an alignment of their shingle sequences within a band that a similarity
of SIMILAR leaves: the similarity is m / (a + b - m), with m aligned shingles of a and b.

Equal word sequences are one node. In each bucket of equal sketches every node is held against one hub (a star, in
proportion to the bucket), verified links give classes, and then only nodes of one bucket that are still in different
classes are paired, if their sets of labelled shingles are similar enough: no alignment is more similar than those sets. A
node brings its LEAST smallest shingles, which are the whole set of most texts. Buckets of more than CROWDED nodes give the same
pairs by another way: their nodes meet under the rarest of their shingles (a prefix filter, which loses no pair that similar).

Defined cases: a null text has no copies; texts without words are copies of equal texts only; texts of fewer than five words
have one shingle of all of them; whole texts are read; rows with equal ids or texts are nodes' members each; a class is
named by its least id that isn't null; an empty table gives an empty result; other columns pass through untouched, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import digest, in_small_batches, lookup_join, stored

WORDS, SIMILAR = 5, 0.8
#: Sketches as (how many, of so many shingles each); documents of at most SHORT shingles have the second kind too.
SKETCHES, SHORT_SKETCHES, SHORT = (32, 5), (24, 3), 48
#: Nodes of a bucket that are compared at a time; the nodes of buckets of more than CROWDED meet under their rarest shingles, with the same result.
PAIRED, CROWDED = 512, 4096
#: Smallest shingles that stand for a text; texts of more have their similarity estimated, to be SLACK (4 deviations) under the limit at most.
LEAST = 512
SLACK = 4 * (SIMILAR * (1 - SIMILAR) / LEAST) ** 0.5
WORD = re.compile(r"[^\W_]+")
ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return value


def shingles(words: list[str], known: Words) -> np.ndarray:
    """The labelled shingles in the order of the text, as 64-bit hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.array([known[w] for w in words], np.uint64)
    n = max(1, len(h) - WORDS + 1)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(min(WORDS, len(h))):
            out = _mixed(out + h[i : i + n] + ODD)
        order = np.argsort(out, kind="stable")
        ranked = out[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        if len(first) < n:  # the number of equal shingles before it labels each
            label = np.empty(n, np.uint64)
            label[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
            # a first occurrence keeps its hash, whether or not others follow
            out = np.where(label == 0, out, _mixed(out + label * ODD))
    return out


def sketches(kmers: np.ndarray, seed: int, number: int, size: int) -> np.ndarray:
    """`number` sketches: each a hash of the `size` labelled shingles that are least under its hash function, in order of the text."""
    n, parts = len(kmers), []
    step = max(1, (1 << 18) // n)
    with np.errstate(over="ignore"):
        for at in range(0, number, step):
            seeds = _mixed((np.arange(at, min(number, at + step), dtype=np.uint64) + np.uint64(seed)) * ODD)[:, None]
            least = np.broadcast_to(np.arange(n), (len(seeds), n))
            if n > size:
                keyed = (kmers[None, :] ^ seeds) * np.uint64(0xD6E8FEB86659FD93)
                keyed ^= keyed >> np.uint64(32)
                keyed *= np.uint64(0xD6E8FEB86659FD93)
                least = np.sort(np.argpartition(keyed, size, axis=1)[:, :size], axis=1)
            out = seeds[:, 0]
            for column in kmers[least].T:
                out = _mixed(out + column + ODD)
            parts.append(out)
    return np.concatenate(parts)


def all_sketches(kmers: np.ndarray) -> np.ndarray:
    out = [sketches(kmers, 1, *SKETCHES)]
    if len(kmers) <= SHORT:
        out.append(sketches(kmers, 1 << 20, *SHORT_SKETCHES))
    return np.concatenate(out)


def aligned(a: np.ndarray, b: np.ndarray, similar: float = SIMILAR) -> float:
    """The similarity of two shingle sequences under the best alignment within the band, or 0 where it can't reach `similar`.

    The longest common subsequence comes from bit-parallel dynamic programming over a window of the band's width.
    """
    n, m = len(a), len(b)
    if min(n, m) < similar * max(n, m) or not n:
        return 0.0
    least = similar * (n + m) / (1 + similar)
    if len(np.intersect1d(a, b)) < least - 1e-9:  # labelled shingles are distinct
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    differ = np.flatnonzero(a[n - short + head :][::-1] != b[m - short + head :][::-1])
    tail = int(differ[0]) if len(differ) else short - head
    x, y = a[head : n - tail], b[head : m - tail]
    band = int(n + m - 2 * least + 1e-9)
    place = {v: i for i, v in enumerate(x.tolist())}
    width = 2 * band + 1
    low, ones = -band, (1 << width) - 1
    window, found = ones, 0
    for j, v in enumerate(y.tolist()):
        if j:
            found += 1 - (window & 1)
            window = window >> 1 | 1 << (width - 1)
            low += 1
        at = place.get(v, -width) - low
        if 0 <= at < width and (hit := window & (1 << at)):
            window = ((window + hit) | (window ^ hit)) & ones
    found += width - window.bit_count()
    common = head + tail + found
    return common / (n + m - common) if common >= least - 1e-9 else 0.0


def _members(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, text_key, node (16 bytes, null for a null text), size (shingles), least (the smallest shingles) and keys (sketches) of every row."""
    rows = docs.select(F.col(key).alias("id"), digest(F.coalesce(text, F.lit(""))).alias("text_key"), F.col(text).alias("text"))
    rows = rows.select("id", "text_key.a", "text_key.b", "text")
    schema = f"id {rows.schema['id'].dataType.simpleString()}, a long, b long, node binary, size int, least binary, keys array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                nodes, sizes, leasts, keys = [], [], [], []
                for value in part.column(3):
                    text = value.as_py()
                    words = WORD.findall(text.lower()) if text is not None else []
                    kmers = shingles(words, known)
                    name = None if text is None else " ".join(words) if words else "\0" + text
                    nodes.append(None if name is None else hashlib.blake2b(name.encode("utf-8", "surrogatepass"), digest_size=16).digest())
                    sizes.append(len(kmers))
                    leasts.append((np.sort(kmers)[:LEAST] >> np.uint64(32)).astype(np.uint32).tobytes())
                    keys.append(all_sketches(kmers).view(np.int64) if len(kmers) else [])
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(leasts, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "a", "b", "node", "size", "least", "keys"])

    return stored(in_small_batches(rows).mapInArrow(run, schema).select("id", F.struct("a", "b").alias("text_key"), "node", "size", "least", "keys"), "members")


def _alike(group: list[tuple], similar: float) -> list[tuple[bytes, bytes]]:
    """The pairs of nodes (own, node, root, size, least) of different roots whose smallest shingles are similar; rows of one `own` aren't held against each other if there are several."""
    own, sizes = np.array([g[0] for g in group]), np.array([g[3] for g in group])
    roots = np.unique([g[2].hex() for g in group], return_inverse=True)[1]
    flat = np.concatenate([np.frombuffer(g[4], np.uint32) for g in group])
    counts = np.array([len(g[4]) // 4 for g in group])
    ends = np.cumsum(counts)
    starts = ends - counts
    numbers = np.unique(flat, return_inverse=True)[1]
    whole = sizes <= LEAST
    top = np.where(whole, np.uint32(0xFFFFFFFF), flat[ends - 1])  # a node brings all its shingles up to here
    crossed, mark, out = own.min() != own.max(), np.zeros(len(flat), bool), []
    for i in range(len(group) - 1):
        fits = (roots[i + 1 :] != roots[i]) & (np.minimum(sizes[i], sizes[i + 1 :]) >= similar * np.maximum(sizes[i], sizes[i + 1 :]))
        if crossed:
            fits &= own[i + 1 :] != own[i]
        others = np.flatnonzero(fits) + i + 1
        if not len(others):
            continue
        mine = slice(starts[i], ends[i])
        mark[numbers[mine]] = True
        firsts = np.cumsum(counts[others]) - counts[others]
        at = np.arange(counts[others].sum()) + np.repeat(starts[others] - firsts, counts[others])
        common = np.add.reduceat(mark[numbers[at]], firsts, dtype=np.int64)
        mark[numbers[mine]] = False
        a, b = np.searchsorted(flat[mine], top[others], "right"), np.add.reduceat(flat[at] <= top[i], firsts, dtype=np.int64)
        least = similar - np.where(whole[others] & whole[i], 1e-9, SLACK)
        for j in others[common >= least * (a + b - common)]:
            out.append((min(group[i][1], group[j][1]), max(group[i][1], group[j][1])))
    return out


def _paired(rows: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """Pairs (a < b) of nodes of different roots under one key whose sets of shingles may be similar.

    rows: key, node, root; nodes: node, size, least. Keys of many nodes are cut into blocks of about PAIRED nodes, and pairs of
    blocks are compared.
    """
    rows = stored(rows.select(F.col("key").alias("id"), "node", "root"), "rooted")
    mixed = rows.groupBy("id").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.count("*").alias("n")).where("r <> s").select("id", F.ceil(F.col("n") / PAIRED).cast("int").alias("blocks"))
    some = rows.join(mixed, "id").join(nodes, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    some = some.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    some = some.select("id", "low", "high", "own", "node", "root", "size", "least").repartition("id", "low", "high").sortWithinPartitions("id", "low", "high")

    def compared(group: list[tuple]) -> list[tuple[bytes, bytes]]:
        return _alike([g[3:] for g in group], similar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        give = lambda found: pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)], names=["a", "b"])
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] != group[0][:3]:
                    if found := compared(group):
                        yield give(found)
                    group = []
                group.append(row)
        if group and (found := compared(group)):
            yield give(found)

    return some.mapInArrow(run, "a binary, b binary").distinct()


def _crowded_pairs(crowded: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """The pairs (a, b) of nodes (node, root) that _paired() gives under shared sketches, without holding all nodes of a sketch against each other.

    Of two nodes that _alike() pairs, each has at least `least` of its n smallest shingles in common with the other's. So they
    share one of the first n - least + 1 in any order that is the same for all nodes; the rarest come first here.
    """
    schema = "node binary, n int, shingle long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, least in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(least, np.uint32)
                found = np.unique(own).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([node] * len(found), pa.binary()), pa.array(np.full(len(found), len(own), np.int32)), pa.array(found)], names=["node", "n", "shingle"])

    own = stored(in_small_batches(nodes.select("node", "least").join(crowded.select("node"), "node", "left_semi")).mapInArrow(run, schema), "shingles")
    # two values of 32 bits may be one by chance: one more stands in for them
    first = F.col("n") - F.ceil((similar - SLACK) * F.col("n")) + 2
    rare = Window.partitionBy("node").orderBy("times", "shingle")
    rows = own.join(own.groupBy("shingle").agg(F.count("*").alias("times")), "shingle").withColumn("r", F.row_number().over(rare)).where(F.col("r") <= first)
    rows = rows.where("times > 1").select(F.col("shingle").alias("key"), "node").join(crowded, "node")
    pairs = stored(_paired(rows, nodes.select("node", "size", "least"), similar), "crowded")
    keys = lambda x: nodes.select(F.col("node").alias(x), F.col("keys").alias(f"keys_{x}"))
    return pairs.join(keys("a"), "a").join(keys("b"), "b").where(F.arrays_overlap("keys_a", "keys_b")).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, last = Words(), {}
        for batch in batches:
            kept = []
            for b, x, y in zip(batch.column(1), batch.column(2), batch.column(3), strict=True):
                if (key := b.as_py()) not in last:
                    last = {key: shingles(WORD.findall(y.as_py().lower()), known)}
                kept.append(aligned(shingles(WORD.findall(x.as_py().lower()), known), last[key]) > 0)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(kept, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])

    return in_small_batches(both).mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """node, root (the least node of its component) of every node in links (a, b): large and small stars in turn until nothing changes.

    What a node's links are joined with is stored first: a small table is then broadcast by Spark's own rule, and a large one
    meets the links of a hub in a join of two plain exchanges, which adaptive execution splits.
    """
    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large")
        roots = stored(large.groupBy("a").agg(F.min("b").alias("m")), "roots")
        small = large.join(roots, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(roots.select("a", F.col("m").alias("b")))
        after = stored(small.where("a <> b").distinct(), "links")
        # done once each node has one link and no root has a link of its own
        ends = after.groupBy("a").agg(F.count("*").alias("n"))
        inner = after.select(F.col("b").alias("a")).distinct()
        if ends.where("n > 1").isEmpty() and ends.join(inner, "a", "left_semi").isEmpty():
            return after.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = after


def _with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def links(docs: DataFrame, members: DataFrame, text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """Verified links (a, b) of similar nodes, enough of them to connect each class."""
    nodes = members.where("size > 0").dropDuplicates(["node"])
    entries = nodes.select("node", F.explode("keys").alias("key"))
    many = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    entries = stored(entries.join(many, "key"), "entries")
    # the hub of a bucket is the node that meets the most others anywhere: what its copies were made from, if it is there
    meets = entries.groupBy("node").agg(F.sum("n").alias("meets"))
    hubs = stored(entries.join(meets, "node").groupBy("key").agg(F.max(F.struct("meets", "node")).alias("hub")).select("key", F.col("hub.node").alias("hub")), "hubs")
    star = stored(entries.join(hubs, "key").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), "star")
    wanted = star.select(F.col("a").alias("node")).union(star.select("b")).distinct()
    wanted = stored(nodes.select("node", "text_key").join(wanted, "node", "left_semi"), "wanted")
    rows = docs.where(F.col(text).isNotNull()).select(digest(F.col(text)).alias("text_key"), F.col(text).alias("text"))
    texts = stored(lookup_join(rows, wanted, ["text_key"], "inner", ["text"]).dropDuplicates(["node"]).select("node", "text"), "texts")
    found = stored(_verified(star, texts), "links")
    rooted = _with_roots(entries.select("key", "node", "n"), components(found))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key")
    rooted = stored(rooted.join(mixed, "key", "left_semi"), "rooted")
    pairs = _paired(rooted.where(F.col("n") <= CROWDED).select("key", "node", "root"), nodes.select("node", "size", "least"), similar)
    crowded = rooted.where(F.col("n") > CROWDED).select("node", "root").distinct()
    if not crowded.isEmpty():
        pairs = pairs.union(_crowded_pairs(crowded, nodes, similar)).distinct()
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
    return found.union(stored(_verified(pairs, texts), "links"))


def _classed(docs: DataFrame, key: str, text: str, similar: float) -> tuple[DataFrame, DataFrame]:
    """The members, and node, class_id and n (rows) of each node that isn't alone."""
    members = _members(docs, key, text)
    roots = components(links(docs, members, text, similar))
    roots = stored(roots.union(roots.select(F.col("root").alias("node"), "root")).distinct(), "roots")
    nodes = members.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    nodes = nodes.join(roots.withColumn("linked", F.lit(True)), "node", "left").where("n > 1 OR linked").select("node", "id", "n", F.coalesce("root", "node").alias("root"))
    nodes = stored(nodes, "nodes")
    named = nodes.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("n").alias("n"))
    return members, stored(nodes.select("node", "root").join(named, "root").select("node", "class_id", "n", "root"), "classes")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """doc_id, class_id (the least doc_id of its near-duplicates) and class_size (rows) of every row."""
    members, named = _classed(docs, key, text, similar)
    rows = lookup_join(members.select("id", "node", "text_key"), named.drop("root"), ["node"], "left", ["id"])
    alone = F.col("n").isNull()
    return rows.select(F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n", F.lit(1)).cast("long").alias("class_size"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", similar: float = SIMILAR) -> DataFrame:
    """The documents in their own columns, one row of each class: that of the least id that isn't null."""
    members, named = _classed(docs, key, text, similar)
    names = members.where("node IS NOT NULL").groupBy("text_key").agg(F.min("node").alias("node"))
    names = stored(names.join(named.select("node", "root"), "node").select("text_key", "root"), "names")
    rows = docs.select(F.struct("*").alias("__doc"), F.when(F.col(text).isNotNull(), digest(F.col(text))).alias("text_key"))
    rows = lookup_join(rows, names, ["text_key"], "left", ["__doc"])
    order = F.struct(F.col("__doc")[key].isNull().alias("n"), F.col("__doc")[key].alias("id"), F.xxhash64("__doc").alias("h"))
    first = stored(rows.where("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("first")), "first")
    many = lookup_join(rows.where("root IS NOT NULL"), first, ["root"], "inner", ["text_key"]).where(order == F.col("first")).dropDuplicates(["root"])
    return rows.where("root IS NULL").select("__doc").union(many.select("__doc")).select(*[F.col("__doc")[c].alias(c) for c in docs.columns])
