"""Integrity checks; each gives one row of counts or the offending rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def identity(df: DataFrame, uid: str, expected: Column, scope: list[str]) -> DataFrame:
    """One row: missing, drifted (not as expected) and duplicate (extra rows of a uid within its scope) identities."""
    blank = F.coalesce(F.btrim(F.col(uid).cast("string")), F.lit("")) == ""
    flat = df.agg(F.count_if(blank).alias("missing"), F.count_if(~blank & ~F.col(uid).cast("string").eqNullSafe(expected.cast("string"))).alias("drifted"))
    twice = df.where(~blank).groupBy(uid, *scope).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate"))
    return flat.join(twice)  # one row each


def adjudication(queue: DataFrame, verdicts: DataFrame, keys: list[str]) -> DataFrame:
    """One row: open items with a verdict, and verdicts whose item is gone."""
    stale = queue.where("resolution IS NULL").join(verdicts, keys, "left_semi").agg(F.count("*").alias("stale_open"))
    return stale.join(verdicts.join(queue, keys, "left_anti").agg(F.count("*").alias("orphan_verdicts")))


def provenance_gate(df: DataFrame, required: list[str], amount: str) -> DataFrame:
    """Adds rejected: why a row can't be stored, null where it can."""
    reason = F
    for c in required:
        reason = reason.when(F.coalesce(F.btrim(F.col(c).cast("string")), F.lit("")) == "", f"no {c}")
    return df.withColumn("rejected", reason.when(F.col(amount).isNull(), f"no {amount}"))


def loss(live: DataFrame, recoverable: DataFrame, keys: list[str]) -> DataFrame:
    """Live rows that a rebuild from the raw files would lose."""
    return live.where("superseded_by IS NULL").join(recoverable, keys, "left_anti")


def incomplete_votes(votes: DataFrame, positions: DataFrame, least: int) -> DataFrame:
    """Votes with fewer positions than they should have."""
    n = votes.join(positions, "vote_id", "left").groupBy("vote_id").agg(F.count("bioguide").alias("positions"))
    return n.where(F.col("positions") < least)


def totals_agree(a: DataFrame, b: DataFrame, amount: str, cent: float = 0.01) -> DataFrame:
    """One row: whether two tables have equal counts and sums within a cent."""
    of = lambda d, x: d.agg(F.count("*").alias(f"n_{x}"), F.coalesce(F.sum(F.col(amount).cast("decimal(18,2)")), F.lit(0)).alias(f"usd_{x}"))
    return of(a, "a").join(of(b, "b")).withColumn("same", (F.col("n_a") == F.col("n_b")) & (F.abs(F.col("usd_a") - F.col("usd_b")) <= cent))


def exports_agree(table: DataFrame, written: DataFrame, by: str, amount: str, cent: float = 0.01) -> DataFrame:
    """Per section of an export: rows and dollars of the table (n_a, usd_a) and of what was written (n_b, usd_b), and whether they are the same; one scan of either, a section that only one side has is not."""
    of = lambda d, x: d.groupBy(by).agg(F.count("*").alias(f"n_{x}"), F.coalesce(F.sum(F.col(amount).cast("decimal(18,2)")), F.lit(0)).alias(f"usd_{x}"))
    both = of(table, "a").join(of(written, "b"), by, "full").na.fill(0, ["n_a", "n_b"])
    near = F.abs(F.coalesce("usd_a", F.lit(0)) - F.coalesce("usd_b", F.lit(0))) <= cent
    return both.withColumn("same", (F.col("n_a") == F.col("n_b")) & near)


def orphaned_verdicts(queue: DataFrame, resolutions: DataFrame, keys: list[str]) -> DataFrame:
    """Queue items that carry a resolution which the durable table lacks: the next rebuild of the queue would reopen them."""
    return queue.where("resolution IS NOT NULL").join(resolutions.select(*keys).distinct(), keys, "left_anti")


def wide(decisions: DataFrame, donations: DataFrame, keys: list[str]) -> DataFrame:
    """Overrides, verdicts or queue items (by their keys) that stand for more than one live row, with the number of rows: each governs all of them."""
    live = donations.where("superseded_by IS NULL").groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    return decisions.join(live, keys)


def differing_positions(positions: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Positions of one table that differ from those of another, or are in one only: the two readings of a roll call agree where this is empty."""
    both = positions.select(*keys, F.col("position").alias("a")).join(expected.select(*keys, F.col("position").alias("b")), keys, "full")
    return both.where(~F.col("a").eqNullSafe(F.col("b")))
