"""Runs over the versioned store: landed records become state, events, review items and watermarks in one commit.

State is cut into buckets by entity and transaction id, of which a run reads and writes those that its records fall into. Two
small tables lead to others: `identities` tells under which transaction ids a submission id is stored, should it come with
another one, and `places` in which buckets a household's rows lie, so that replacing a household touches those only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.attribution import household
from ..operators.dedup import counted_flag
from ..operators.fold import events_of, folded, moved_by, state_after, with_identity
from .incremental import watermarks_after
from .store import Part, Step, Write, bucket_of, commit, parts, read

STATE, EVENTS, QUEUE, WATERMARKS, IDENTITIES, PLACES = "state", "events", "queue", "watermarks", "identities", "places"
STATE_KEYS = ("entity_slug", "__txn")
#: Buckets of state and of the tables that lead to it.
BUCKETS, INDEX_BUCKETS = 64, 16


def _touched(rows: DataFrame, column: Column) -> list[int]:
    """The distinct buckets, of which there are at most as many as a table has."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


def _with_txn(rows: DataFrame) -> DataFrame:
    """rows with __txn: the transaction id that a stored row belongs to, also after it was superseded."""
    return rows.withColumn("__txn", F.coalesce("superseded_by", "transaction_id"))


def _own_buckets(named: list[Part], table: str, otherwise: int) -> int:
    return next((p.buckets for p in named if p.table == table), otherwise)


def with_counted(rows: DataFrame) -> DataFrame:
    """rows with `counted`: a published live row that is a conduit's leg isn't counted beside the recipient's.

    It depends on rows of other buckets, so it isn't stored: each reader gets what holds for the version that it reads.
    """
    live = F.col("superseded_by").isNull() & F.col("status").isin("CONFIRMED", "PROBABLE")
    own = F.coalesce(F.col("is_individual"), F.lit(True)) & live
    out = counted_flag(rows.drop("counted"), ["entity_slug", "contributor_name_raw", "date", "amount"], "record_uid", own)
    return out.withColumn("counted", F.when(live, F.col("counted")).otherwise(F.lit(True)))


def commit_run(spark: SparkSession, root: str, version: int, schema: DataFrame, records: DataFrame, order: list[Column], at: Column, queue: DataFrame | None = None, ran: DataFrame | None = None, buckets: int = BUCKETS, files: int = 1, steps: Sequence[Step] = (), more: dict[str, Write] | None = None) -> None:
    """One run's records folded into the state, and all that follows from them, published together.

    schema: a frame, possibly empty, in the columns of state. records: classified records in these columns (identity and
    supersession are worked out here). queue: review items, of which those that aren't there yet are added (transaction_id, entity_slug, reason).
    ran: what the run has read (key, run_date, from_raw, truncated); watermarks move with the commit and only then. more:
    further tables of the run.
    """
    named = parts(spark, root, before=version)
    buckets = _own_buckets(named, STATE, buckets)
    rows = with_identity(records, schema).where("record_uid IS NOT NULL AND transaction_id IS NOT NULL AND entity_slug IS NOT NULL")
    where = bucket_of(["entity_slug", "transaction_id"], buckets)
    touched = set(_touched(rows, where))
    # submission ids that are stored under another transaction id lead to its bucket
    ids = rows.where("record_uid <> transaction_id").select("entity_slug", "record_uid", "transaction_id").distinct()
    index = _touched(ids, bucket_of(["entity_slug", "record_uid"], INDEX_BUCKETS))
    known = read(spark, root, IDENTITIES, index, named=named)
    fresh = ids
    if known is not None:
        touched |= set(_touched(known.join(ids.select("entity_slug", "record_uid").distinct(), ["entity_slug", "record_uid"]), where))
        fresh = ids.join(known, ["entity_slug", "record_uid", "transaction_id"], "left_anti")
    current = read(spark, root, STATE, touched, steps, named=named) if touched else None
    current = schema.where(F.lit(False)) if current is None else current.select(*schema.columns)
    done = folded(current, records, order, at)
    after = state_after(current, done)
    writes = dict(more or {})
    writes[STATE] = Write(_with_txn(after), STATE_KEYS, "replace", buckets, files, tuple(sorted(touched)))
    writes[EVENTS] = Write(events_of(records, done).withColumn("run", F.lit(version).cast("long")), ("entity_slug", "record_uid"), "append", INDEX_BUCKETS)
    writes[IDENTITIES] = Write(fresh, ("entity_slug", "record_uid"), "append", INDEX_BUCKETS)
    # rows that weren't touched lie where they lay
    moved = after if (old := read(spark, root, PLACES, named=named)) is None else moved_by(done)
    places = moved.select(household().alias("household"), bucket_of(["entity_slug", F.coalesce("superseded_by", "transaction_id")], buckets).alias("place")).distinct()
    if old is not None:
        places = places.join(old, ["household", "place"], "left_anti")
    writes[PLACES] = Write(places, ("household",), "append", INDEX_BUCKETS)
    if queue is not None:
        keys = ["transaction_id", "entity_slug"]
        items = queue.select(*keys, "reason").dropDuplicates(keys)
        if (there := read(spark, root, QUEUE, _touched(items, bucket_of(keys, INDEX_BUCKETS)), named=named)) is not None:
            items = items.join(there.select(*keys).distinct(), keys, "left_anti")
        writes[QUEUE] = Write(items.withColumn("resolution", F.lit(None).cast("string")), tuple(keys), "append", INDEX_BUCKETS)
    if ran is not None:
        before = read(spark, root, WATERMARKS, named=named)
        before = ran.select("key", F.col("run_date").alias("last_run")).where(F.lit(False)) if before is None else before.select("key", "last_run")
        writes[WATERMARKS] = Write(watermarks_after(before, ran, "key"), ("key",), "whole")
    commit(spark, root, version, writes, {STATE: len(steps)}, named)


def state(spark: SparkSession, root: str, steps: Sequence[Step] = (), before: int | None = None) -> DataFrame | None:
    """The stored records, live and superseded."""
    rows = read(spark, root, STATE, steps=steps, before=before)
    return None if rows is None else rows.drop("__txn", "bucket")


def households_replaced(spark: SparkSession, root: str, version: int, slugs: DataFrame, rows: DataFrame, queue: DataFrame | None = None, steps: Sequence[Step] = ()) -> list[int]:
    """A version in which the households of `slugs` (entity_slug) have the given rows instead of theirs; returns the state buckets it read.

    Only the buckets that hold the households, or take the new rows, are read and written; open review items of these
    households are replaced by those of `queue` in the same version. The new rows' submission ids are noted as well.
    """
    named = parts(spark, root, before=version)
    buckets = _own_buckets(named, STATE, BUCKETS)
    houses = slugs.select(F.col("entity_slug").alias("household")).distinct()
    places = read(spark, root, PLACES, named=named)
    held = [] if places is None else _touched(places.join(houses, "household", "left_semi"), F.col("place"))
    touched = sorted({*held, *_touched(rows, bucket_of(["entity_slug", F.coalesce("superseded_by", "transaction_id")], buckets))})
    current = read(spark, root, STATE, touched, steps, named=named)
    current = rows.where(F.lit(False)) if current is None else current.drop("__txn", "bucket")
    others = current.withColumn("household", household()).join(houses, "household", "left_anti").select(*current.columns)
    new = rows.select(*current.columns)
    after = _with_txn(others.unionByName(new))
    writes = {STATE: Write(after, STATE_KEYS, "replace", buckets, 1, tuple(touched))}
    own = new.select(household().alias("household"), bucket_of(["entity_slug", F.coalesce("superseded_by", "transaction_id")], buckets).alias("place")).distinct()
    writes[PLACES] = Write(own if places is None else own.join(places, ["household", "place"], "left_anti"), ("household",), "append", INDEX_BUCKETS)
    fresh = new.where("superseded_by IS NULL AND record_uid <> transaction_id").select("entity_slug", "record_uid", "transaction_id").distinct()
    if (known := read(spark, root, IDENTITIES, named=named)) is not None:
        fresh = fresh.join(known, ["entity_slug", "record_uid", "transaction_id"], "left_anti")
    writes[IDENTITIES] = Write(fresh, ("entity_slug", "record_uid"), "append", INDEX_BUCKETS)
    if queue is not None:
        there = read(spark, root, QUEUE, named=named)
        items = queue.select("transaction_id", "entity_slug", "reason").dropDuplicates(["transaction_id", "entity_slug"]).withColumn("resolution", F.lit(None).cast("string"))
        if there is not None:
            mine = there.join(slugs.select("entity_slug").distinct().withColumn("__mine", F.lit(True)), "entity_slug", "left")
            stay = mine.where("__mine IS NULL OR resolution IS NOT NULL").select("transaction_id", "entity_slug", "reason", "resolution")
            items = stay.unionByName(items.join(stay.select("transaction_id", "entity_slug"), ["transaction_id", "entity_slug"], "left_anti"))
        writes[QUEUE] = Write(items, ("transaction_id", "entity_slug"), "whole", INDEX_BUCKETS)
    commit(spark, root, version, writes, {STATE: len(steps)}, named)
    return touched


def run_stream(incoming: DataFrame, root: str, checkpoint: str, schema: DataFrame, order: list[str], queue=None, ran=None, buckets: int = BUCKETS, steps: Sequence[Step] = ()) -> StreamingQuery:
    """Commits each micro-batch of a stream of classified records as a run of its own; the batch's number is the version.

    queue and ran give a batch's review items and what it has read, from the batch. A batch that runs again after a failure
    is worked out from the versions before it, so it changes nothing that was published.
    """

    def step(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            commit_run(batch.sparkSession, root, number, schema, batch, [F.col(c) for c in order], F.lit(number), queue(batch) if queue else None, ran(batch) if ran else None, buckets, steps=steps)
        finally:
            batch.unpersist()

    return incoming.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
