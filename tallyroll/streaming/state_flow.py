"""The state flow as one run: a source's raw rows become donations, events, filers, review items and a ledger, published together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..operators.attribution import PUBLISHED, gated, household, state_overrides
from ..operators.classify import classify
from ..operators.dedup import best_row_per_key
from ..operators.merge import in_sequence, upsert
from ..operators.shared import stored
from ..sources.states import PLACE, Source
from .runs import BUCKETS, INDEX_BUCKETS
from .store import Write, bucket_of, commit, parts, read

DONATIONS, EVENTS, FILERS, QUEUE, LEDGER = "state_donations", "state_events", "state_filers", "state_queue", "state_runs"
#: Columns that make a record another version, and how they are compared.
SUBSTANCE = {"amount": "money", "date": "text", "recipient_filer_id": "text", "source_filing_id": "text"}
KEY, FILER_KEYS = "state_txn_id", ("jurisdiction", "source", "filer_id")
NO_DATE, NO_AMOUNT = "unparseable contribution date", "unparseable contribution amount"


def asked(source: Source, rows: DataFrame, recipients: DataFrame | None, registry: DataFrame, opt_outs: DataFrame) -> DataFrame:
    """Canonical records of raw rows beside each owner whom they are shown to (owner_slug), with __place: owners who opted out of the jurisdiction are shown none."""
    unique = stored(source.unique(source.prepared(rows)), "rows")
    place = F.struct(*[F.col(p) for p in PLACE if p in unique.columns] or [F.lit(0).alias("at")])
    out = opt_outs.where(F.col("jurisdiction") == source.jurisdiction).select("owner_slug").distinct()
    shown = source.candidates(unique, registry).join(out, "owner_slug", "left_anti").withColumn("__place", place)
    return source.project(source.resolved(shown, recipients), "owner_slug", "__place")


def attributed(source: Source, records: DataFrame, registry: DataFrame, overrides: DataFrame, at: Column, path: Column, discovery: Column | None = None) -> DataFrame:
    """asked() records that fit the owner whom they were shown to, or a relative, as rows of the table of state donations, with owner_slug, gate and __place.

    What a source can't vouch for is kept from the classifier, not from the row. Rows that an override excludes stay here
    under that status.
    """
    hidden = [f"contributor_{k}" for k in source.hidden]
    seen = records.withColumn("__hidden", F.struct(*hidden)) if hidden else records
    found = classify(source.for_classifier(seen), registry, KEY, unique=True).where(household() == F.col("owner_slug"))
    found = found.withColumns({c: F.col("__hidden")[c] for c in hidden}).drop("__hidden") if hidden else found
    rows = gated(state_overrides(found, overrides, KEY, excluded=True))
    raw = {"contributor_name": "contributor_name_raw", "contributor_employer": "contributor_employer_raw", "contributor_occupation": "contributor_occupation_raw"}
    return rows.select(
        KEY, "jurisdiction", "source", "source_filing_id", "source_tran_id", "entity_slug", "entity_kind", "parent_owner_slug", "status", "status_reason", F.to_json("signals").alias("signals_matched"),
        *[F.coalesce(k, F.lit("")).alias(v) for k, v in raw.items()], *[F.coalesce(f"contributor_{c}", F.lit("")).alias(f"contributor_{c}") for c in ("city", "state", "zip")],
        "recipient_filer_id", F.coalesce("recipient_name", F.lit("")).alias("recipient_name"), "recipient_type", "recipient_party", "recipient_office", "amount", "date", "election_cycle", "report_type",
        path.cast("string").alias("raw_payload_path"), at.cast("string").alias("ingested_at"), (F.lit(None).cast("string") if discovery is None else discovery.cast("string")).alias("discovery_source"),
        "owner_slug", "gate", "__place",
    )


OWN = ("owner_slug", "gate", "__place")


def _review(rows: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Items for the review queue, under the owner: rows that can't be stored, and UNCERTAIN ones unless a DISCARDED verdict stands."""
    items = rows.where("status <> 'EXCLUDED'").select(KEY, F.col("owner_slug").alias("entity_slug"), "jurisdiction", "source", "gate", "raw_payload_path", F.col("ingested_at").alias("queued_at"), F.coalesce("gate", F.when(F.col("status") == "UNCERTAIN", F.col("status_reason"))).alias("reason")).where("reason IS NOT NULL")
    done = resolutions.where("resolution = 'DISCARDED'").select(KEY, "entity_slug", F.lit(True).alias("__done")).distinct()
    items = items.join(done, [KEY, "entity_slug"], "left").where("gate IS NOT NULL OR __done IS NULL").drop("gate", "__done")
    one = items.groupBy(KEY, "entity_slug").agg(F.min(F.struct("reason", "jurisdiction", "source", "raw_payload_path", "queued_at")).alias("i"))
    return one.select(KEY, "entity_slug", "i.*", F.lit(None).cast("string").alias("resolution"))


def _filers(rows: DataFrame) -> DataFrame:
    """Who received the rows, as the last of them in file order has it; party and office are left to people."""
    known = rows.where(blank_to_null(F.col("recipient_filer_id")).isNotNull())
    none = F.lit(None).cast("string")
    named = known.select("jurisdiction", "source", F.col("recipient_filer_id").alias("filer_id"), F.col("recipient_name").alias("name"), F.col("recipient_type").alias("filer_type"), none.alias("party"), none.alias("office"), "raw_payload_path", F.col("ingested_at").alias("refreshed_at"), "__place")
    return best_row_per_key(named, list(FILER_KEYS), [F.col("__place")]).drop("__place")


def ledger_rows(source: Source, records: DataFrame, rows: DataFrame, events: DataFrame, registry: DataFrame, opt_outs: DataFrame, label: Column) -> DataFrame:
    """A row for each owner who didn't opt out: records shown, excluded, without date or amount, by tier, and how many were superseded."""
    out = opt_outs.where(F.col("jurisdiction") == source.jurisdiction).select("owner_slug").distinct()
    owners = registry.where("parent_slug IS NULL").select(F.col("slug").alias("owner_slug")).distinct().join(out, "owner_slug", "left_anti")
    open_ = F.col("gate").isNull()
    status = lambda s: F.col("status") == s
    counts = rows.groupBy("owner_slug").agg(
        F.count_if(status("EXCLUDED")).alias("excluded"), F.count_if(~status("EXCLUDED") & (F.col("gate") == NO_DATE)).alias("skipped_no_date"), F.count_if(~status("EXCLUDED") & (F.col("gate") == NO_AMOUNT)).alias("skipped_no_amount"),
        *[F.count_if(status(s) & open_).alias(s.lower()) for s in (*PUBLISHED, "UNCERTAIN")],
    )
    scanned = records.groupBy("owner_slug").agg(F.count("*").alias("scanned"))
    superseded = events.where("outcome = 'superseded'").groupBy(household().alias("owner_slug")).agg(F.count("*").alias("superseded"))
    table = owners.join(scanned, "owner_slug", "left").join(counts, "owner_slug", "left").join(superseded, "owner_slug", "left")
    return table.na.fill(0).select("owner_slug", F.lit(source.jurisdiction).alias("jurisdiction"), F.lit(source.name).alias("source"), label.cast("string").alias("extract_label"), *[c for c in table.columns if c != "owner_slug"])


def _touched(rows: DataFrame, column: Column) -> list[int]:
    return sorted(r[0] for r in rows.select(column).distinct().collect())  # bucket numbers


def state_run(spark: SparkSession, root: str, version: int, source: Source, rows: DataFrame, registry: DataFrame, overrides: DataFrame, resolutions: DataFrame, opt_outs: DataFrame, at: Column, recipients: DataFrame | None = None, path: Column | None = None, label: Column | None = None, discovery: Column | None = None, buckets: int = BUCKETS) -> None:
    """Commits one run over a source's raw rows to the store under root.

    Records shown to an owner are classified, put under the overrides and gated: without a date or an amount they go to the
    review queue, as UNCERTAIN ones do unless a DISCARDED verdict stands. Published ones are inserted under their
    transaction id in sequence (owners in order, then places in the file): what differs in SUBSTANCE supersedes. Donations,
    events, filers, queue and ledger are visible together or not at all.
    overrides: state_txn_id, entity_slug (the owner), verdict; resolutions: state_txn_id, entity_slug, resolution; opt_outs:
    owner_slug, jurisdiction.
    """
    nothing = F.lit(None).cast("string")
    path, label = (nothing if x is None else x for x in (path, label))
    records = asked(source, rows, recipients, registry, opt_outs).persist()
    found = attributed(source, records, registry, overrides, at, path, discovery).persist()
    events = None
    try:
        good = found.where(F.col("status").isin(*PUBLISHED) & F.col("gate").isNull()).withColumns({"superseded_by": nothing, "superseded_reason": nothing})
        named = parts(spark, root, before=version)
        own = lambda table, n: next((p.buckets for p in named if p.table == table), n)
        buckets = own(DONATIONS, buckets)
        touched = _touched(good, bucket_of([KEY], buckets))
        plain = good.drop(*OWN)
        current = read(spark, root, DONATIONS, touched, named=named) if touched else None
        current = plain.where(F.lit(False)) if current is None else current.select(*plain.columns)
        after, events = in_sequence(current, good.select(*plain.columns, "owner_slug", "__place"), KEY, SUBSTANCE, [F.col("owner_slug"), F.col("__place")], at, "portal restatement: ")
        events = events.select(KEY, "entity_slug", "parent_owner_slug", "outcome").persist()
        writes = {DONATIONS: Write(after.withColumn("__txn", F.coalesce("superseded_by", KEY)), ("__txn",), "replace", buckets, touched=tuple(touched))}
        writes[EVENTS] = Write(events.withColumn("run", F.lit(version).cast("long")), (KEY,), "append", INDEX_BUCKETS)
        items = _review(found, resolutions)
        if (there := read(spark, root, QUEUE, named=named)) is not None:
            items = items.join(there.select(KEY, "entity_slug"), [KEY, "entity_slug"], "left_anti")
        writes[QUEUE] = Write(items, (KEY, "entity_slug"), "append", INDEX_BUCKETS)
        filers = _filers(good).withColumn("fetched_at", F.col("refreshed_at"))
        where = _touched(filers, bucket_of(FILER_KEYS, INDEX_BUCKETS))
        if where and (known := read(spark, root, FILERS, where, named=named)) is not None:
            first = known.select(*FILER_KEYS, F.col("fetched_at").alias("__first"))
            again = filers.join(first, list(FILER_KEYS), "left").withColumn("fetched_at", F.coalesce("__first", "fetched_at")).drop("__first")
            filers = upsert(known.select(*filers.columns), again.select(*filers.columns), list(FILER_KEYS))
        writes[FILERS] = Write(filers, FILER_KEYS, "replace", INDEX_BUCKETS, touched=tuple(where))
        ledger = ledger_rows(source, records, found, events, registry, opt_outs, label).withColumn("run", F.lit(version).cast("long"))
        writes[LEDGER] = Write(ledger, ("owner_slug",), "append", INDEX_BUCKETS)
        commit(spark, root, version, writes, named=named)
    finally:
        for frame in (records, found, events):
            if frame is not None:
                frame.unpersist()


def donations(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The stored state donations, live and superseded."""
    rows = read(spark, root, DONATIONS, before=before)
    return None if rows is None else rows.drop("__txn", "bucket")
