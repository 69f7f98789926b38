"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents are strung together in the order of their hashes and cut into blocks of equal words, its last block
being the rest. The source's target fixes how many blocks the mix draws of it: whole passes over the source, then a pass
that stops within a block. A splitting tree deals these quotas to the output shards: a node halves its shards, gives either
half blocks in proportion to them, and draws how many of each source's blocks go left from the multivariate hypergeometric
distribution, until a leaf holds one shard with an exact quota of each source. A source's blocks are permuted anew for each
pass, and each shard takes the next ones of its quota, so that shards are disjoint; within a shard, blocks go to cells by
their hashes and are shuffled there. Everything runs as DataFrame operations; the mix is a table of spans (document, first
word, words), of which `texts` makes texts.

Targets: sources by code point, null last, weigh 5, 2, 1, repeating, and share `share` of all words; none gets more than
twice its size, and what is over is shared anew by weight.

Nothing grows into one task: documents get their places from sums over buckets of a source, places of sources from a range
sort, and the tree runs over groups of at most GROUP sources, whose own totals it splits first.

Defined cases: a null text has no words; a null source is a source; documents without words are taken with no words; rows
equal in id, text and source are documents each, and are placed as one run; a null id is an id like any other; equal hashes
are ordered by id; texts of any length are counted whole, a long one lies over several blocks; if no document has a word,
all targets are 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, new_path, stored

SHARDS, SEED = 16, 71_993
#: The weights in turn, and the most that a source is repeated.
WEIGHTS, MOST_PASSES = (5, 2, 1), 2
SHARE = 1.5
#: Words of a block, of a bucket of documents that are placed together, and of a cell that is shuffled at once.
BLOCK, BUCKET_WORDS, CELL_WORDS = 2048, 1 << 20, 32 << 20
#: Sources whose quotas are split in one row, and equal rows that are placed as one.
GROUP, RUN = 4096, 1 << 16
#: Rounds of swaps of a permutation of blocks.
ROUNDS = 24
SPACES = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Maximal runs outside [\\x20\\x09-\\x0D]."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "w")
    return F.char_length(F.translate(marked, SPACES, "")).cast("long")


def _entries(docs: DataFrame, key: str, text: str, source: str, seed: int) -> DataFrame:
    """src, id, size, h and n: how many rows are equal in these, at most RUN in a row."""
    own = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(source).cast("string").alias("src"), F.col(key).alias("id"), word_count(own).alias("size"), F.xxhash64(F.lit(seed), F.col(key), own, F.col(source)).alias("h"))
    equal = rows.groupBy("src", "id", "size", "h").agg(F.count("*").alias("n"))
    runs = equal.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {RUN}"))))
    spread = F.when(F.col("run") == 0, F.col("h")).otherwise(F.xxhash64("h", "run"))
    return stored(runs.select(_name(F.col("src")).alias("src"), "id", "size", "h", spread.alias("at"), F.least(F.lit(RUN), F.col("n") - F.col("run") * RUN).alias("n")), "entries")


def _name(source: Column) -> Column:
    """A source's name in joins, which sorts as the source does, null last."""
    return F.coalesce(F.concat(F.lit("a"), source), F.lit("b"))


def _targets(entries: DataFrame, share: float) -> DataFrame:
    """src, place, size and target of each source."""
    sizes = entries.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("size"))
    ranged = stored(sizes.repartitionByRange("src").withColumn("range", F.spark_partition_id()), "sources")
    counts = {r["range"]: r["count"] for r in ranged.groupBy("range").count().collect()}  # a row a partition
    before = F.array(*[F.lit(sum(n for other, n in counts.items() if other < k)).cast("long") for k in range(max(counts, default=0) + 1)])
    place = F.element_at(before, F.col("range") + 1) + F.row_number().over(Window.partitionBy("range").orderBy("src")) - 1
    weights = F.array(*map(F.lit, WEIGHTS))
    sources = stored(ranged.select("src", "size", place.alias("place")).withColumn("weight", F.element_at(weights, (F.pmod("place", F.lit(len(WEIGHTS))) + 1).cast("int"))), "weights")
    most = F.col("size") * MOST_PASSES
    total = sources.agg(F.sum("size")).first()[0] or 0
    rate, bound = 0.0, -1
    while True:  # sources that reach their limit only get more, so this ends, mostly after a few rounds
        over = F.col("weight") * F.lit(rate) > most
        row = sources.agg(F.count_if(over).alias("n"), F.sum(F.when(over, most)).alias("full"), F.sum(F.when(~over, F.col("weight"))).alias("weight")).first()
        if row.n == bound or not row.weight:
            break
        bound, rate = row.n, (share * total - (row.full or 0)) / row.weight
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(rate), most.cast("double")))


def _let(value: Column, body) -> Column:
    """body of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hypergeometric(good: Column, population: Column, draws: Column, u: Column) -> Column:
    """How many of `draws` from `population` are among the `good` ones, by inversion at the uniform number u.

    The probabilities are followed from the mode to both sides, by the ratio of neighbours, as far as 12 deviations.
    """
    zero = F.lit(0).cast("long")
    p = good / F.greatest(population, F.lit(1))
    ends = F.struct(
        F.greatest(zero, draws + good - population).alias("low"),
        F.least(good, draws).alias("high"),
        F.floor((draws + 1.0) * (good + 1.0) / (population + 2.0)).alias("mode"),
        F.ceil(12 * F.sqrt(draws * p * (1 - p)) + 12).alias("spread"),
    )

    def ratio(x: Column) -> Column:
        """Of the probabilities of x + 1 and x."""
        return (good - x) * 1.0 * (draws - x) / ((x + 1.0) * (population - good - draws + x + 1))

    def walk(path: Column, mode: Column, until: Column) -> Column:
        """The sum of the weights on the path, the mode's being 1, and the first place at which it passes `until` (null: none)."""
        begin = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), F.when(until < 1, mode).alias("x"))

        def step(state: Column, x: Column) -> Column:
            w = F.when(x > mode, state["w"] * ratio(x - 1)).when(x == mode - 1, 1.0 / ratio(x)).otherwise(state["w"] / ratio(x))
            return _let(w, lambda w: F.struct(w.alias("w"), (state["sum"] + w).alias("sum"), F.coalesce(state["x"], F.when(until < state["sum"] + w, x)).alias("x")))

        return F.aggregate(path, begin, step)

    def drawn(e: Column) -> Column:
        mode = e["mode"]
        none = F.array().cast("array<bigint>")
        up = F.when(mode < e["high"], F.sequence(mode + 1, F.least(e["high"], mode + e["spread"]))).otherwise(none)
        down = F.when(e["low"] < mode, F.sequence(mode - 1, F.greatest(e["low"], mode - e["spread"]), F.lit(-1).cast("long"))).otherwise(none)
        found = _let(F.concat(up, down), lambda path: _let(walk(path, mode, F.lit(float("inf")))["sum"] * u, lambda until: walk(path, mode, until)["x"]))
        return F.when(e["low"] == e["high"], e["low"]).otherwise(F.coalesce(found, mode))

    inside = lambda e: F.struct(e["low"].alias("low"), e["high"].alias("high"), F.least(e["high"], F.greatest(e["low"], e["mode"])).alias("mode"), e["spread"].alias("spread"))
    return _let(ends, lambda e: _let(inside(e), drawn))


def _left(quotas: Column, draws: Column, keys: list[Column], seed: int) -> Column:
    """How many of each quota `draws` draws without replacement take: multivariate hypergeometric, one quota after the other."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)
    begin = F.struct(F.array().cast("array<bigint>").alias("left"), total.alias("population"), draws.cast("long").alias("draws"))

    def step(state: Column, quota: Column) -> Column:
        u = F.pmod(F.xxhash64(F.lit(seed), *keys, F.size(state["left"])), F.lit(1 << 53)) / float(1 << 53)
        drawn = _hypergeometric(quota, state["population"], state["draws"], u)
        return _let(drawn, lambda x: F.struct(F.array_append(state["left"], x).alias("left"), (state["population"] - quota).alias("population"), (state["draws"] - x).alias("draws")))

    return F.aggregate(quotas, begin, step)["left"]


def _tree(root: DataFrame, shards: int, draws, seed: int) -> DataFrame:
    """root's rows (grp, quotas and others) with the quotas of each shard: first and end become the shard's own range."""
    rows = root.withColumn("first", F.lit(0)).withColumn("end", F.lit(shards))
    others = [c for c in root.columns if c != "quotas"]
    taken = F.when(F.col("end") - F.col("first") > 1, _left(F.col("quotas"), draws, [F.col("grp"), F.col("first"), F.col("end")], seed))
    for _ in range((shards - 1).bit_length()):
        middle = F.expr("(first + end) div 2").cast("int")
        rows = rows.withColumn("middle", middle).withColumn("left", taken)
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        both = F.array(F.struct(F.col("left").alias("quotas"), "first", F.col("middle").alias("end")), F.struct(right.alias("quotas"), F.col("middle").alias("first"), "end"))
        halves = F.when(F.col("left").isNull(), F.array(F.struct("quotas", "first", "end"))).otherwise(both)
        rows = rows.select(*others, F.explode(halves).alias("half")).select(*others, "half.*")
    return rows


def dealt(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED, group: int = GROUP) -> DataFrame:
    """place and offsets (array: the draw at which each shard begins) from place and draws (the quota) of each source."""
    grouped = quotas.groupBy(F.expr(f"place div {group}").alias("grp")).agg(F.sort_array(F.collect_list(F.struct("place", "draws"))).alias("own"))
    grouped = stored(grouped.select("grp", F.col("own.place").alias("places"), F.col("own.draws").alias("quotas"), F.aggregate("own.draws", F.lit(0).cast("long"), lambda a, q: a + q).alias("total")), "groups")
    totals = grouped.agg(F.sort_array(F.collect_list(F.struct("grp", "total"))).alias("all")).select(F.lit(-1).cast("long").alias("grp"), F.col("all.grp").alias("grps"), F.col("all.total").alias("quotas"))
    share = F.expr("aggregate(quotas, 0L, (a, q) -> a + q) * (middle - first) div (end - first)")
    leaves = _tree(totals, shards, share, seed).select("first", F.explode(F.arrays_zip("grps", "quotas")).alias("z"))
    leaves = leaves.groupBy(F.col("z.grps").alias("grp")).agg(F.sort_array(F.collect_list(F.struct("first", F.col("z.quotas").alias("n")))).alias("leaf")).select("grp", F.col("leaf.n").alias("leaf"))
    own = F.expr("aggregate(slice(leaf, first + 1, middle - first), 0L, (a, n) -> a + n)")
    rows = _tree(grouped.join(stored(leaves, "leaves"), "grp"), shards, own, seed).select("first", F.explode(F.arrays_zip("places", "quotas")).alias("z"))
    before = F.expr("transform(sequence(1, size(own)), i -> aggregate(slice(own, 1, i - 1), 0L, (a, x) -> a + x.n))")
    return rows.groupBy(F.col("z.places").alias("place")).agg(F.sort_array(F.collect_list(F.struct("first", F.col("z.quotas").alias("n")))).alias("own")).select("place", before.alias("offsets"))


def permuted(x: Column, n: Column, keys: list[Column], rounds: int = ROUNDS) -> Column:
    """The place of x in a permutation of 0 to n - 1, by keyed rounds of swap-or-not."""

    def swap(v: Column, j: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(j, *keys), n) - v, n)
        return _let(partner, lambda other: F.when(F.xxhash64(j, F.greatest(v, other), *keys).bitwiseAND(F.lit(1)) == 0, v).otherwise(other))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x, swap)


def write_mix(docs: DataFrame, shards: int = SHARDS, share: float = SHARE, block: int = BLOCK, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source", group: int = GROUP, bucket_words: int = BUCKET_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Writes the mix and returns (mix, documents, sources), all stored tables.

    mix, a row a span, written shard by shard, blocks of a cell in shuffled order: src, id, h, start, pass, block, from (first
    word of the document), words, cell, ticket (the block's place in the shuffle), shard. documents, a row each: src, id, size,
    h, start (its first word's place in its source; null without words). sources: src, size, target, wanted (words).
    """
    entries = _entries(docs, key, text, source, seed)
    sources = _targets(entries, share).withColumn("wanted", F.round("target").cast("long"))
    size, wanted = F.greatest("size", F.lit(1)), F.col("wanted")
    sources = sources.withColumn("passes", F.expr("wanted div greatest(size, 1)")).withColumn("rest", F.pmod(wanted, size))
    sources = sources.withColumn("full", F.expr(f"size div {block}")).withColumn("blocks", F.expr(f"size div {block} + sign(size % {block})").cast("long"))
    # a pass draws the full blocks in their permuted order, then the rest; the last one stops `part` words into a block
    sources = sources.withColumn("last", F.expr(f"rest div {block}")).withColumn("part", F.expr(f"rest % {block}"))
    sources = stored(sources.withColumn("draws", F.expr("passes * blocks + last + sign(part)").cast("long")).withColumn("buckets", F.expr(f"size div {bucket_words} + 1")), "quotas")
    offsets = dealt(sources.select("place", "draws"), shards, seed, group)
    sources = stored(sources.join(offsets, "place"), "dealt")

    some = lookup_join(entries.where("size > 0"), sources.select("src", "buckets"), ["src"], "inner", ["h"])
    some = some.withColumn("bucket", F.pmod("at", "buckets"))
    words = F.col("size") * F.col("n")
    sums = some.groupBy("src", "bucket").agg(F.sum(words).alias("words"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(sums.select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before")), "buckets")
    within = Window.partitionBy("src", "bucket").orderBy("at", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = some.withColumn("within", F.coalesce(F.sum(words).over(within), F.lit(0)))
    placed = lookup_join(placed, sums, ["src", "bucket"], "inner", ["h"])
    copies = placed.select("src", "id", "size", "h", F.explode(F.sequence(F.col("before") + F.col("within"), F.expr("before + within + (n - 1) * size"), "size")).alias("start"))
    bare = entries.where("size = 0").select("src", "id", "size", "h", F.explode(F.array_repeat(F.lit(None).cast("long"), F.col("n").cast("int"))).alias("start"))
    documents = stored(copies.unionByName(bare), "placed")

    spans = lookup_join(documents.where("start IS NOT NULL"), sources.select("src", "place", "full", "blocks", "passes", "last", "part", "offsets"), ["src"], "inner", ["h"])
    spans = spans.withColumn("block", F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")))
    spans = spans.withColumn("pass", F.explode(F.expr("sequence(0L, passes)")))
    rank = F.when(F.col("block") < F.col("full"), permuted(F.col("block"), F.greatest("full", F.lit(1)), [F.lit(seed), F.col("place"), F.col("pass")])).otherwise(F.col("full"))
    spans = spans.withColumn("rank", rank)
    taken = F.when((F.col("pass") < F.col("passes")) | (F.col("rank") < F.col("last")), block).when(F.col("rank") == F.col("last"), F.col("part")).otherwise(0)
    first = F.greatest(F.col("start"), F.col("block") * block)
    spans = spans.withColumn("from", first - F.col("start")).withColumn("words", F.least(F.col("start") + F.col("size"), F.col("block") * block + taken) - first).where("words > 0")
    draw = F.col("pass") * F.col("blocks") + F.col("rank")
    spans = spans.withColumn("shard", F.size(F.filter("offsets", lambda o: o <= draw)) - 1)
    ticket = F.xxhash64(F.lit(seed), "place", "pass", "block")
    total = sources.agg(F.sum("wanted")).first()[0] or 0
    cells = max(1, -(-total // (shards * CELL_WORDS)))
    spans = spans.select("src", "id", "h", "start", "pass", "block", "from", "words", F.pmod(ticket, F.lit(cells)).cast("int").alias("cell"), F.xxhash64(F.lit(seed + 1), ticket).alias("ticket"), "shard")
    local = spans.repartition("shard", "cell").sortWithinPartitions("shard", "cell", "ticket", "src", "pass", "block", "start")
    path = new_path(docs.sparkSession, "mix")
    local.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(local.schema).parquet(path), documents, sources.select("src", "size", "target", "wanted")


def texts(mix: DataFrame, docs: DataFrame, seed: int = SEED, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix's spans with their texts: the span's words, each with the spaces behind it."""
    own = docs.select(F.xxhash64(F.lit(seed), F.col(key), F.coalesce(F.col(text), F.lit("")), F.col(source)).alias("h"), F.col(text).alias("text"))
    pieces = F.split(F.regexp_replace("text", r"^[\x20\x09-\x0D]+", ""), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    # the spans of a document meet its text once, so that it is cut into words once
    spans = mix.groupBy("h", "start").agg(F.collect_list(F.struct(*mix.columns)).alias("spans")).join(own.dropDuplicates(["h"]), "h")
    cut = _let(pieces, lambda p: F.transform("spans", lambda s: F.struct(s.alias("span"), F.array_join(F.slice(p, (s["from"] + 1).cast("int"), s["words"].cast("int")), "").alias("text"))))
    return spans.select(F.explode(cut).alias("c")).select("c.span.*", "c.text")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target (of its source) and taken of every document."""
    mix, documents, sources = write_mix(docs, **options)
    sums = mix.groupBy("src", "start").agg(F.sum("words").alias("taken"))
    rows = documents.join(sums, ["src", "start"], "left").select("src", "id", "size", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "h")
    rows = lookup_join(rows, sources.select("src", F.col("size").alias("source_size"), "target"), ["src"], "inner", ["h"])
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")
