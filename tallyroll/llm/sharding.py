"""Sharding by a two-pass external shuffle.

Pass one scatters the records uniformly into memory-sized buckets by seeded hashes: the shard is the winner of a
rendezvous hash of the id over the shard numbers, the bucket within it comes from a hash of id and text. Each shard has
buckets in proportion to its bytes. Pass two runs a Fisher-Yates shuffle over each bucket and writes it. Buckets follow one
another within a shard, which gives each record its slot.

The law is `key`: id and number of shards alone decide the shard, and with one more shard, records move only into it.

The order of ids and texts is reproducible: a bucket's records are put in the order of their hashes before the seeded
shuffle, and buckets are dealt to a number of tasks that follows from the data alone.

Defined cases: a null id is an id like any other; a null text has no bytes and the checksum of the empty text, and stays
null in the written shards; equal rows are kept, each with a slot of its own; equal texts have no part in the choice of
the shard; copies of one id and text that together outgrow a bucket are spread over the shard's buckets by their places in
the scan; a bucket that still outgrows its size (very long texts) is cut into pieces of that size which are shuffled one by
one; an empty table gives an empty result; other columns are written along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, new_path, stored

SHARDS = 24
SEED = 20_240
#: Bytes of records that one bucket should hold, and tasks that write buckets, at most.
BUCKET_BYTES, MOST_TASKS = 16 << 20, 20_000


def _ticket(shard: int, key: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(seed), F.lit(shard), key).alias("h"), F.lit(shard).alias("s"))


def winner(key: Column, shards: int, seed: int = SEED) -> Column:
    """Rendezvous hashing: struct<h,s> of the shard with the largest hash; a further shard only takes keys for itself."""
    tickets = [_ticket(s, key, seed) for s in range(shards)]
    return F.greatest(*tickets) if shards > 1 else tickets[0]


def write_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the shuffled records under one folder a shard and returns the written table.

    Columns: doc (the record), size, crc, grown, bucket, piece, pos (place in the piece) and shard. docs should come from
    files, whose rows keep their places when a task runs again.
    """
    own, size = F.col(key), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")
    at = F.xxhash64(F.lit(seed + 1), own, F.crc32(F.coalesce(text, F.lit(""))))
    best = winner(own, shards, seed)
    copies = docs.select(best["s"].alias("shard"), at.alias("at"), size.alias("size")).groupBy("shard", "at").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    copies = stored(copies, "copies")
    sizes = {r.shard: r.bytes for r in copies.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}  # a row a shard
    buckets = {s: max(1, -(-sizes.get(s, 0) // bucket_bytes)) for s in range(shards)}
    outgrown = stored(copies.where((F.col("bytes") > bucket_bytes) & (F.col("n") > 1)).select("at").distinct().withColumn("spread", F.lit(True)), "outgrown")
    raw = docs.select(
        F.struct("*").alias("doc"),
        best["s"].alias("shard"),
        F.greatest(best, _ticket(shards, own, seed))["s"].alias("grown"),
        size.alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("crc"),
        at.alias("at"),
        F.monotonically_increasing_id().alias("place"),
    )
    raw = lookup_join(raw, outgrown, ["at"], "left", ["place"])
    raw = raw.withColumn("at", F.when(F.col("spread"), F.xxhash64("at", "place")).otherwise(F.col("at"))).drop("place", "spread")
    of_shard = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("shard") + 1)
    before = [sum(buckets[s] for s in range(k)) for k in range(shards)]
    tasks = min(MOST_TASKS, sum(buckets.values()))
    scattered = raw.withColumn("bucket", F.pmod("at", of_shard(buckets.values())).cast("int"))
    scattered = scattered.withColumn("task", F.pmod(of_shard(before) + F.col("bucket"), F.lit(tasks)).cast("int")).repartitionById(tasks, F.col("task"))
    so_far = Window.partitionBy("task", "shard", "bucket").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    pieces = scattered.withColumn("piece", F.floor(F.coalesce(F.sum("size").over(so_far), F.lit(0)) / (2 * bucket_bytes)).cast("int"))
    # the window has put the records in order, so the shuffle always starts from the same one
    rows = pieces.groupBy("task", "shard", "bucket", "piece").agg(F.collect_list(F.struct("doc", "size", "crc", "grown")).alias("rows"))
    shuffled = rows.sortWithinPartitions("shard", "bucket", "piece").select("shard", "bucket", "piece", F.shuffle("rows", seed).alias("rows"))
    rows = shuffled.select("shard", "bucket", "piece", F.posexplode("rows").alias("pos", "row")).select("row.doc", "row.size", "row.crc", "row.grown", "bucket", "piece", "pos", "shard")
    path = new_path(docs.sparkSession, "shards")
    rows.write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def placed(written: DataFrame, key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every record of write_shards()'s table."""
    sizes = written.groupBy("shard", "bucket", "piece").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket", "piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored(sizes.select("shard", "bucket", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "offsets")
    rows = written.select(F.col("doc")[key].alias("doc_id"), "size", "crc", "grown", "shard", "bucket", "piece", "pos")
    return lookup_join(rows, offsets, ["shard", "bucket", "piece"], "inner", ["pos"]).select(
        "doc_id",
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        (F.col("before") + F.col("pos")).cast("long").alias("slot"),
        F.col("grown").alias("grown_shard"),
    )
