"""Filter interaction audit: what each of five filters removes in every order, and what it alone would.

Texts are routed as an RDD by the xxhash of the text. Where rows of one fingerprint meet, a chain holds each distinct text in
full with its smallest id; a row that comes with a larger id, or whose id is undercut later, is a non-minimum one and fails
E. Chains are kept twice: over the rows of a scan partition, whose non-minimum rows are decided on the spot and travel on
without their text, so that of a group of copies at most one text a partition (or a flush of it) is routed; and over the
routed rows, sorted by fingerprint, so that one chain is in memory at a time. A row's fails make a mask of five bits;
combineByKey adds up vectors of counts by mask, in the tasks first. All orders follow from the counts of a part's 32 masks.

Defined cases: a null text is the empty text, also to E; words are maximal runs outside [\\x20\\x09-\\x0D]; a null lang and
an empty one are the part ''; rows that repeat an id are documents each, and equal ids are not smaller than each other; a
null id is neither smaller nor larger than any; a document is good or toxic if any label row of its id says 1, labels of a
null id count for none, and documents without a label are neither; texts of any length are read whole; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

from pyspark import RDD
from pyspark.rdd import portable_hash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
MASKS = 1 << len(FILTERS)
DUPLICATE = 1 << FILTERS.index("E")
#: Bytes of text that the chains of a scan partition hold before they are sent on.
HELD_BYTES = 64 << 20
#: Bytes of all texts for each partition that rows are routed to, and partitions at most: beyond, they grow and are sorted on disk.
ROUTE_BYTES, MOST_ROUTES = 32 << 20, 20_000

UPPER = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
#: Bytes of UTF-8 that don't begin a code point.
INNER = bytes(range(0x80, 0xC0))

COLUMNS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: bytes) -> int:
    """The filters A to D that a text (UTF-8) fails, as bits."""
    words = text.split()  # of bytes: at exactly the six spaces
    points = len(text.translate(None, INNER))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * (len(text) - len(text.translate(None, UPPER))) > 3 * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, fail in enumerate(fails) if fail)


class Chains:
    """By fingerprint, chains of distinct texts; of each its smallest id and the rows of that id (mask, and how many of each part)."""

    def __init__(self) -> None:
        self.chains: dict[int, list[list]] = {}
        self.held = 0

    def add(self, mark: int, text: bytes, key, mask: int, parts: dict[str, int]) -> Iterator[tuple]:
        """Takes rows of one text and id; yields what is known to be non-minimum now: (id, part, mask, rows)."""
        chain = self.chains.setdefault(mark, [])
        for link in chain:
            if link[0] == text:
                break
        else:
            chain.append([text, key, mask, dict(parts)])
            self.held += len(text)
            return
        if key == link[1]:
            for part, n in parts.items():
                link[3][part] = link[3].get(part, 0) + n
            return
        gone = (key, parts)
        if key < link[1]:
            gone, link[1], link[3] = (link[1], link[3]), key, dict(parts)
        for part, n in gone[1].items():
            yield gone[0], part, mask | DUPLICATE, n

    def flush(self) -> Iterator[tuple[int, list]]:
        for mark, chain in self.chains.items():
            for link in chain:
                yield mark, link
        self.chains.clear()
        self.held = 0


def _scanned(held: int) -> Callable:
    def run(rows: Iterator) -> Iterator[tuple[int, tuple]]:
        """Routed records: ((mark, None), decided row) or ((mark, mark), a link of a chain)."""
        chains = Chains()
        for row in rows:
            text = bytes(row.text)
            mask = text_mask(text)
            if row.id is None:
                yield row.mark, (None, (None, row.part, mask, 1))
                continue
            for gone in chains.add(row.mark, text, row.id, mask, {row.part: 1}):
                yield portable_hash(gone[0]), (None, gone)
            if chains.held > held:
                yield from ((mark, (mark, link)) for mark, link in chains.flush())
        yield from ((mark, (mark, link)) for mark, link in chains.flush())

    return run


def _settled(rows: Iterator[tuple[int, tuple]]) -> Iterator[tuple]:
    """Rows as (id, part, mask, how many), from routed records in the order of their fingerprints."""
    chains, at = Chains(), None

    def minima() -> Iterator[tuple]:
        for _, (_, key, mask, parts) in chains.flush():
            for part, n in parts.items():
                yield key, part, mask, n

    for key, (mark, load) in rows:
        if key != at:
            yield from minima()
            at = key
        if mark is None:
            yield load
        else:
            yield from chains.add(mark, *load)
    yield from minima()


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang", held: int = HELD_BYTES) -> DataFrame:
    """id, part, mask of the filters it fails, and rows, of every document."""
    own = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.xxhash64(own).alias("mark"), own.cast("binary").alias("text"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    routes = min(MOST_ROUTES, max(docs.sparkSession.sparkContext.defaultParallelism, -(-total // ROUTE_BYTES)))
    routed: RDD = rows.rdd.mapPartitions(_scanned(held)).repartitionAndSortWithinPartitions(routes, lambda mark: mark)
    kind = rows.schema["id"].dataType.simpleString()
    return docs.sparkSession.createDataFrame(routed.mapPartitions(_settled), f"id {kind}, part string, mask int, rows long", verifySchema=False)


def _counted(row) -> list[int]:
    """A vector of 3 * MASKS counts: documents, good ones and toxic ones by mask."""
    return _with([0] * (3 * MASKS), row)


def _with(vector: list[int], row) -> list[int]:
    mask, n, good, toxic = row
    vector[mask] += n
    if good:
        vector[MASKS + mask] += n
    if toxic:
        vector[2 * MASKS + mask] += n
    return vector


def _added(a: list[int], b: list[int]) -> list[int]:
    return [x + y for x, y in zip(a, b, strict=True)]


def _orders(item: tuple[str, list[int]]) -> Iterator[tuple]:
    """The rows of a part from its counts."""
    part, vector = item
    documents, good, toxic = vector[:MASKS], vector[MASKS : 2 * MASKS], vector[2 * MASKS :]
    count = lambda counts, has, lacks: sum(n for mask, n in enumerate(counts) if mask & has == has and not mask & lacks)
    rows, sums = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            removed = count(documents, bit, before)
            sums[letter] += removed
            rows.append(("".join(order), step, letter, count(documents, 0, before | bit), removed, count(documents, bit, 0) - removed, documents[bit], count(good, bit, before), count(toxic, bit, before)))
            before |= bit
    for order, step, letter, *counts in rows:
        yield part, order, step, *counts, sums[letter]


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """part, filter_order, step and the counts of all orders of the filters."""
    found = masks(docs, key, text, part).groupBy("id", "part", "mask").agg(F.sum("rows").alias("rows"))
    says = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counts = found.join(says, "id", "left").select("part", "mask", "rows", "good", "toxic")
    vectors = counts.rdd.map(lambda r: (r.part, (r.mask, r.rows, r.good, r.toxic))).combineByKey(_counted, _with, _added)
    return docs.sparkSession.createDataFrame(vectors.flatMap(_orders), COLUMNS, verifySchema=False)


ORACLE = r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
m AS (
  SELECT part, [len(ws) < 200, 100 * len(list_distinct(ws)) < 50 * len(ws),
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fails,
    coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
  FROM w LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY part, fails),
f AS (SELECT unnest(range(1, 6)) AS f),
p AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT o, step, o[step] AS own, o[1:step - 1] AS earlier FROM p, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, CAST(step AS INTEGER) AS step, own,
    coalesce(sum(n) FILTER (NOT gone AND NOT fails[own]), 0) AS kept, coalesce(sum(n) FILTER (NOT gone AND fails[own]), 0) AS removed,
    coalesce(sum(n) FILTER (gone AND fails[own]), 0) AS redundant,
    coalesce(sum(n) FILTER (fails[own] AND len(list_filter(fails, lambda x: x)) = 1), 0) AS unique_fails,
    coalesce(sum(good) FILTER (NOT gone AND fails[own]), 0) AS good_lost, coalesce(sum(bad) FILTER (NOT gone AND fails[own]), 0) AS toxic_lost
  FROM (SELECT *, len(list_filter(earlier, lambda i: fails[i])) > 0 AS gone FROM g, s)
  GROUP BY part, o, step, own)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""
