"""What people decide over the classifier's head, and what becomes of stored rows when it runs again.

Overrides and verdicts are tables of their own that survive every run: overrides (key, entity_slug, verdict) force a record
to an owner (CONFIRMED, PROBABLE) or away from it (EXCLUDED); resolutions (key, entity_slug, resolution) settle items of the
review queue. Nothing here writes; each function gives the rows of the next state.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .classify import classify
from .dedup import first_row_per_key
from .merge import record_uid, upsert
from .shared import stored

PUBLISHED = ("CONFIRMED", "PROBABLE")


def household() -> Column:
    return F.coalesce("parent_owner_slug", "entity_slug")


def _verdicts(overrides: DataFrame, key: str) -> DataFrame:
    """The overrides, unique by key and owner: __key, __owner, __verdict. EXCLUDED goes before CONFIRMED, and that before PROBABLE."""
    rank = F.struct((F.col("verdict") == "EXCLUDED").alias("x"), (F.col("verdict") == "CONFIRMED").alias("c"), "verdict")
    return overrides.groupBy(F.col(key).alias("__key"), F.col("entity_slug").alias("__owner")).agg(F.max(rank)["verdict"].alias("__verdict"))


def _reason(verdict: str = "__verdict") -> Column:
    return F.concat(F.lit("manual attribution ("), verdict, F.lit(")"))


def federal_overrides(records: DataFrame, classified: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """classify()'s rows under overrides, as federal runs take them: a forced record is the owner's own, even if the classifier left it out.

    EXCLUDED drops a row; forced rows have the signal manual_attribution and no relative, whatever the classifier said.
    """
    settled = _verdicts(overrides, key)
    on = [F.col(key) == F.col("__key"), household() == F.col("__owner")]
    left = classified.join(settled, on, "left_anti")
    forced = records.join(settled.where(F.col("__verdict").isin(*PUBLISHED)), F.col(key) == F.col("__key")).select(
        *records.columns, F.col("__owner").alias("entity_slug"), F.lit("owner").alias("entity_kind"), F.lit(None).cast("string").alias("parent_owner_slug"), F.lit(None).cast("string").alias("matched_variant"),
        F.col("__verdict").alias("status"), _reason().alias("status_reason"), F.array(F.lit("manual_attribution")).alias("signals"),
    )
    return left.unionByName(forced.select(*left.columns))


def state_overrides(classified: DataFrame, overrides: DataFrame, key: str, excluded: bool = False) -> DataFrame:
    """classify()'s rows under overrides, as state runs take them: only records that the classifier kept can be forced; they keep its signals and slug.

    EXCLUDED drops a row, or, with `excluded`, leaves it there under that status, to be counted.
    """
    rows = classified.join(_verdicts(overrides, key), [F.col(key) == F.col("__key"), household() == F.col("__owner")], "left")
    rows = rows if excluded else rows.where("__verdict IS NULL OR __verdict <> 'EXCLUDED'")
    settled = F.col("__verdict").isNotNull()
    return rows.withColumns({"status": F.when(settled, F.col("__verdict")).otherwise(F.col("status")), "status_reason": F.when(settled, _reason()).otherwise(F.col("status_reason"))}).select(*classified.columns)


def queued(rows: DataFrame, resolutions: DataFrame, key: str) -> DataFrame:
    """The UNCERTAIN rows that go to the review queue: a standing DISCARDED verdict keeps an item out; it never blocks attribution."""
    done = resolutions.where("resolution = 'DISCARDED'").select(key, "entity_slug").distinct()
    return rows.where("status = 'UNCERTAIN'").join(done, [key, "entity_slug"], "left_anti")


def gated(rows: DataFrame, date: str = "date", amount: str = "amount") -> DataFrame:
    """State rows with `gate`: null where a row can be stored, else why it goes to the review queue: no date is guessed, no amount made 0."""
    return rows.withColumn("gate", F.when(F.col(date).isNull(), "unparseable contribution date").when(F.col(amount).isNull(), "unparseable contribution amount"))


def stored_records(donations: DataFrame, key: str = "record_uid") -> DataFrame:
    """Stored rows as the classifier reads them; they have no split names."""
    text = {"contributor_name": "contributor_name_raw", "contributor_employer": "contributor_employer_raw", "contributor_occupation": "contributor_occupation_raw"} | {f"contributor_{c}": f"contributor_{c}" for c in ("city", "state", "zip")}
    return donations.select(key, *[F.coalesce(F.col(v), F.lit("")).alias(k) for k, v in text.items()])


def reclassified_in_place(donations: DataFrame, registry: DataFrame, overrides: DataFrame, resolutions: DataFrame, key: str = "record_uid", txn: str = "transaction_id") -> DataFrame:
    """Live published rows scored again from their stored fields: their key and slug, new_status, new_reason, new_signals and outcome.

    outcome: excluded, unchanged, updated, forced, demoted (to the queue) or suppressed (demoted, but a DISCARDED verdict
    stands). Rows of relatives are scored against their own signals; overrides and verdicts are keyed by transaction id. A
    row that no longer fits anybody of its household is demoted.
    """
    live = donations.where(F.col("superseded_by").isNull() & F.col("status").isin(*PUBLISHED))
    live = live.withColumn("__row", F.concat_ws("\0", key, household()))
    scored = classify(stored_records(live, "__row").withColumn("__house", F.element_at(F.split("__row", "\0"), -1)), registry, "__row", unique=True)
    scored = scored.where(F.col("__house") == household()).select("__row", F.struct("status", "status_reason", "signals").alias("__new"))
    rows = live.join(scored.repartition("__row").groupBy("__row").agg(F.min("__new").alias("__new")), "__row", "left")
    settled = _verdicts(overrides, txn)
    rows = rows.join(settled, (F.col(txn) == F.col("__key")) & (household() == F.col("__owner")), "left")
    discarded = resolutions.where("resolution = 'DISCARDED'").select(F.col(txn).alias("__txn"), F.col("entity_slug").alias("__slug"), F.lit(True).alias("__discarded")).distinct()
    rows = rows.join(discarded, (F.col(txn) == F.col("__txn")) & (F.col("entity_slug") == F.col("__slug")), "left")
    forced = F.col("__verdict").isin(*PUBLISHED)
    none = F.array().cast("array<string>")
    new = {
        "new_status": F.when(forced, F.col("__verdict")).otherwise(F.coalesce("__new.status", F.lit("UNCERTAIN"))),
        "new_reason": F.when(forced, _reason()).otherwise(F.coalesce("__new.status_reason", F.lit("name only"))),
        "new_signals": F.when(forced, none).otherwise(F.coalesce("__new.signals", none)),
    }
    rows = rows.withColumns(new)
    kept = F.col("new_status").isin(*PUBLISHED)
    same = (F.col("new_status") == F.col("status")) & F.col("new_reason").eqNullSafe(F.col("status_reason"))
    outcome = (
        F.when(F.col("__verdict") == "EXCLUDED", "excluded").when(kept & same, "unchanged").when(kept & forced, "forced").when(kept, "updated").when(F.col("__discarded"), "suppressed").otherwise("demoted")
    )
    return rows.select(key, txn, "entity_slug", "status", "new_status", "new_reason", "new_signals", outcome.alias("outcome"))


def would_lose(live: DataFrame, raw: DataFrame, classified: DataFrame, overrides: DataFrame, txn: str = "transaction_id") -> DataFrame:
    """What a rebuild from the raw files would lose of the live rows: record_uid, entity_slug and loss ("raw missing" or "diverged").

    live has record_uid, transaction_id, entity_slug and parent_owner_slug; raw the record_uid of each record at hand;
    classified what the classifier makes of those. Rows that are forced by an override are safe from diverging.
    """
    rows = live.where("superseded_by IS NULL").withColumn("__house", household())
    here = raw.select("record_uid").distinct().withColumn("__raw", F.lit(True))
    good = classified.where(F.col("status").isin(*PUBLISHED)).select("record_uid", household().alias("__house")).distinct().withColumn("__good", F.lit(True))
    safe = overrides.select(F.col(txn), F.col("entity_slug").alias("__house"), F.lit(True).alias("__safe")).distinct()
    rows = rows.join(here, "record_uid", "left").join(good, ["record_uid", "__house"], "left").join(safe, [txn, "__house"], "left")
    loss = F.when(F.col("__raw").isNull(), "raw missing").when(F.col("__safe").isNull() & F.col("__good").isNull(), "diverged")
    return rows.select("record_uid", "entity_slug", loss.alias("loss")).where("loss IS NOT NULL")


def rebuilt(donations: DataFrame, rows: DataFrame, lost: DataFrame, slugs: list[str], force: bool = False) -> DataFrame:
    """donations with all rows of the given households replaced by `rows`; refuses to lose any unless forced."""
    if not force and (n := lost.count()):
        raise ValueError(f"{n} attributed rows would be lost")
    return donations.where(~household().isin(*slugs)).unionByName(rows, allowMissingColumns=True)


def reclassified_state(current: DataFrame, rows: DataFrame, jurisdiction: str, slug: str) -> DataFrame:
    """State rows with those of one owner and one jurisdiction replaced."""
    return current.where(~((F.col("jurisdiction") == jurisdiction) & (household() == slug))).unionByName(rows)


def reopened_queue(queue: DataFrame, rows: DataFrame, jurisdiction: str, slug: str) -> DataFrame:
    """The queue with the open items of one owner and one jurisdiction replaced; settled ones stay."""
    mine = (F.col("jurisdiction") == jurisdiction) & (F.col("entity_slug") == slug) & F.col("resolution").isNull()
    return queue.where(~mine).unionByName(rows, allowMissingColumns=True)


def decided(table: DataFrame, key: str, slug: str, ids: DataFrame, values: dict[str, Column]) -> DataFrame:
    """The overrides or resolutions with one decision for each id of `ids` put in (attribute, exclude, resolve)."""
    new = ids.select(key).distinct().withColumns({"entity_slug": F.lit(slug)} | values)
    return upsert(table, new, [key, "entity_slug"])


def withdrawn(table: DataFrame, key: str, slug: str, ids: DataFrame) -> DataFrame:
    """The overrides or resolutions without those of the ids (unattribute, unresolve)."""
    return table.join(ids.select(key).distinct().withColumn("entity_slug", F.lit(slug)), [key, "entity_slug"], "left_anti")


def open_items(queue: DataFrame, resolutions: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Queue rows that neither their own column nor the durable verdicts have settled."""
    return queue.where("resolution IS NULL").join(resolutions.select(key, "entity_slug").distinct(), [key, "entity_slug"], "left_anti")


def bulk_selected(queue: DataFrame, resolutions: DataFrame, pattern: str, key: str = "transaction_id") -> DataFrame:
    """Open items whose reason is LIKE the pattern, letters of either case alike: what a bulk discard would settle."""
    return open_items(queue, resolutions, key).where(F.ilike(F.col("reason"), F.lit(pattern)))


def burndown(queue: DataFrame, resolutions: DataFrame, raw: DataFrame, registry: DataFrame, live: DataFrame) -> DataFrame:
    """Every open item with its disposition: transaction_id, entity_slug, reason, disposition, legs, attributable and promoted_amount.

    An item is all raw records under its transaction id; each is classified by itself, without relatives. UNVERIFIABLE: the
    entity isn't in the registry or no record is at hand. DISCARD: none is attributable, or those that are stand in the live
    rows already. PROMOTE: all are attributable. HOLD: some are and some aren't.
    raw: record columns of the classifier, transaction_id, sub_id, entity_slug (whose files hold it) and amount.
    """
    items = open_items(queue, resolutions).select("transaction_id", "entity_slug", "reason").distinct()
    legs = first_row_per_key(raw.withColumn("record_uid", record_uid(F.col("sub_id"), F.col("transaction_id"))), ["record_uid", "entity_slug"], [], few=True)
    legs = legs.join(items.select("transaction_id", F.col("entity_slug")).distinct(), ["transaction_id", "entity_slug"], "left_semi")
    # the classifier reads the legs twice, and the counts once more
    legs = stored(legs.withColumn("__leg", F.concat_ws("\0", "record_uid", "entity_slug")), "legs")
    # an owner's item that fits a relative isn't the owner's; a relative's item is judged as if the relative had no household
    alone = registry.where("parent_slug IS NOT NULL").withColumns({"parent_slug": F.lit(None).cast("string"), "kind": F.lit("owner")})
    filed = legs.withColumnRenamed("entity_slug", "__filed")
    found = classify(filed, registry, "__leg", related=False, unique=True).unionByName(classify(filed, alone, "__leg", unique=True))
    found = found.where((F.col("entity_slug") == F.col("__filed")) & F.col("status").isin(*PUBLISHED)).select("__leg", F.lit(True).alias("__ok")).distinct()
    there = live.where("superseded_by IS NULL").select("record_uid").distinct().withColumn("__live", F.lit(True))
    legs = legs.join(found, "__leg", "left").join(there, "record_uid", "left")
    ok, new = F.col("__ok").isNotNull(), F.col("__ok").isNotNull() & F.col("__live").isNull()
    sums = legs.groupBy("transaction_id", "entity_slug").agg(F.count("*").alias("legs"), F.count_if(ok).alias("attributable"), F.count_if(new).alias("__new"), F.sum(F.when(new, F.col("amount").cast("decimal(18,2)"))).alias("promoted_amount"))
    known = registry.select(F.col("slug").alias("entity_slug")).distinct().withColumn("__known", F.lit(True))
    rows = items.join(sums, ["transaction_id", "entity_slug"], "left").join(known, "entity_slug", "left").na.fill(0, ["legs", "attributable", "__new"])
    disposition = F.when(F.col("__known").isNull() | (F.col("legs") == 0), "UNVERIFIABLE").when(F.col("__new") == 0, "DISCARD").when(F.col("attributable") == F.col("legs"), "PROMOTE").otherwise("HOLD")
    return rows.select("transaction_id", "entity_slug", "reason", disposition.alias("disposition"), "legs", "attributable", "promoted_amount")


def raw_coverage(donations: DataFrame, files: DataFrame, archived: DataFrame | None = None) -> DataFrame:
    """Per entity: live rows, those whose raw file is missing, and how many of these the archive holds or lacks (null without an archive).

    files and archived have raw_payload_path; blank paths are missing everywhere.
    """
    rows = donations.where("superseded_by IS NULL").withColumn("raw_payload_path", F.coalesce("raw_payload_path", F.lit("")))
    marks = [files.where("raw_payload_path <> ''").select("raw_payload_path").distinct().withColumn("__here", F.lit(True))]
    if archived is not None:
        marks.append(archived.where("raw_payload_path <> ''").select("raw_payload_path").distinct().withColumn("__kept", F.lit(True)))
    rows = reduce(lambda a, b: a.join(b, "raw_payload_path", "left"), marks, rows)
    gone = F.col("__here").isNull()
    count = lambda c: F.count_if(c) if archived is not None else F.lit(None).cast("long")
    kept = F.col("__kept").isNotNull() if archived is not None else F.lit(False)
    return rows.groupBy("entity_slug").agg(
        F.count("*").alias("total"), F.count_if(gone).alias("missing_raw"), F.countDistinct(F.when(gone & (F.col("raw_payload_path") != ""), F.col("raw_payload_path"))).alias("missing_files"),
        count(gone & kept).alias("recoverable"), count(gone & ~kept).alias("absent"),
    )
