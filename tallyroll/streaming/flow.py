"""The federal flow as one run: landed records are classified, put under the overrides, gated, inserted and queued, and published together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..operators.attribution import PUBLISHED, federal_overrides, queued
from ..operators.classify import classify
from ..operators.shared import stored
from ..sources import federal
from .runs import INDEX_BUCKETS, commit_run
from .store import Write

LEDGER = "ledger"


def _gate(rows: DataFrame) -> Column:
    """Why a row of the table of donations can't be stored; null where it can."""
    blank = lambda c: blank_to_null(F.col(c).cast("string")).isNull()
    return F.when(blank("transaction_id"), "no identity").when(blank("filing_id") | blank("raw_payload_path") | F.col("date").isNull(), "no provenance").when(F.col("amount").isNull(), "no amount")


def attributed(pages: DataFrame, registry: DataFrame, overrides: DataFrame, at: Column) -> DataFrame:
    """Landed records as rows of the table of donations, each once, with `gate`: what the classifier and, over its head, the overrides make of them."""
    key = F.coalesce(blank_to_null(F.col("transaction_id")), blank_to_null(F.col("sub_id")))
    # read for their names, by the classifier and by the overrides: each record is found once
    records = stored(federal.contributions(pages).withColumn("_txn", key), "records")
    found = federal_overrides(records, classify(records, registry, "_txn", unique=True), overrides.withColumnRenamed("transaction_id", "_txn"), "_txn")
    rows = federal.donation_row(found, at)
    return rows.withColumn("gate", _gate(rows))


def federal_run(spark: SparkSession, root: str, version: int, pages: DataFrame, registry: DataFrame, overrides: DataFrame, resolutions: DataFrame, at: Column, ran: DataFrame | None = None, buckets: int = 64) -> None:
    """Commits one run over landed pages to the store under root.

    Published rows that pass the gate are inserted in the order CONFIRMED, PROBABLE, then by their places; UNCERTAIN ones go to
    the review queue unless a DISCARDED verdict stands; the ledger gets a row for each household: rows by tier, and how
    many were held back for which reason. State, events, queue, ledger and watermarks are visible together or not at all.
    overrides: transaction_id (or submission id where that is missing), entity_slug, verdict; resolutions: transaction_id,
    entity_slug, resolution.
    """
    rows = attributed(pages, registry, overrides, at).persist()
    try:
        good = rows.where(F.col("status").isin(*PUBLISHED) & F.col("gate").isNull()).drop("gate")
        named = rows.where("transaction_id <> ''")
        items = queued(named, resolutions, "transaction_id").select("transaction_id", "entity_slug", F.col("status_reason").alias("reason"))
        uncertain = F.col("status") == "UNCERTAIN"
        held = lambda why: F.count_if(~uncertain & (F.col("gate") == why))
        ledger = rows.groupBy(F.coalesce("parent_owner_slug", "entity_slug").alias("household")).agg(
            *[F.count_if(F.col("status") == s).alias(s.lower()) for s in (*PUBLISHED, "UNCERTAIN")], held("no identity").alias("no_identity"), held("no provenance").alias("no_provenance"), held("no amount").alias("no_amount"), F.max(F.when(~uncertain, F.col("date"))).alias("period_end"),
        )
        schema = good.limit(0).withColumns({c: F.lit(None).cast("string") for c in ("superseded_by", "superseded_reason")})
        order = [F.col("status"), F.col("raw_payload_path"), F.col("record_uid")]  # CONFIRMED sorts before PROBABLE
        more = {LEDGER: Write(ledger.withColumn("run", F.lit(version).cast("long")), ("household",), "append", INDEX_BUCKETS)}
        commit_run(spark, root, version, schema, good, order, at, items, ran, buckets, more=more)
    finally:
        rows.unpersist()
