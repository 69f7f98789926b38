"""Exports: guarded CSV, CSV by cycle, and JSON documents with a head of their own."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import csv_guard


def guarded(df: DataFrame) -> DataFrame:
    """df with its text columns made safe for spreadsheets; numbers stay as they are."""
    return df.select(*[csv_guard(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def export_csv(df: DataFrame, path: str, order: list[Column]) -> None:
    """One table in order, over as many files as the range partitioning makes; names sort as the rows do."""
    guarded(df).orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def export_by_cycle(df: DataFrame, path: str, cycle: str = "election_cycle") -> None:
    """A folder per cycle; stale ones go, rows without a cycle are left out."""
    guarded(df.where(F.col(cycle).isNotNull())).repartition(cycle).write.mode("overwrite").option("header", True).partitionBy(cycle).csv(path)


def export_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines, a folder per value of `by` if given, for readers that load parts."""
    out = df.write.mode("overwrite")
    (out.partitionBy(by) if by else out).json(path)


def _counted(df: DataFrame, amount: str | None = None) -> tuple[DataFrame, Observation]:
    """df, and what is counted of it while it is written: rows, cents and a digest of all rows (a sum, in which their order has no part)."""
    seen = Observation(f"export-{uuid.uuid4().hex}")
    cents = F.sum(F.round(F.col(amount).cast("decimal(18,4)") * 100).cast("decimal(38,0)")) if amount else F.lit(0).cast("decimal(38,0)")
    digest = F.sum(F.xxhash64(*[F.col(f"`{c}`").cast("string") if "map<" not in t else F.to_json(F.col(f"`{c}`")) for c, t in df.dtypes]).cast("decimal(38,0)"))
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(cents, F.lit(0)).alias("cents"), F.coalesce(digest, F.lit(0)).alias("digest")), seen


def export_counted(df: DataFrame, root: str, by: str, amount: str) -> DataFrame:
    """Writes an export (JSON lines, a folder a section) with a manifest that is taken while it is written, and reads it back."""
    rows, seen = _counted(df, amount)
    rows.write.mode("overwrite").partitionBy(by).json(f"{root}/data")
    found = seen.get
    df.sparkSession.createDataFrame([(found["rows"], str(found["cents"]), str(found["digest"]))], "rows long, cents string, digest string").coalesce(1).write.mode("overwrite").json(f"{root}/manifest")
    return read_export(df.sparkSession, root, df.schema)


def read_export(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """An export's rows, in the columns of the table that it was made of."""
    return spark.read.schema(schema).json(f"{root}/data").select(*schema.names)


def whole(spark: SparkSession, root: str, schema: StructType, amount: str) -> bool:
    """Whether an export still holds what its manifest says: rows, cents and digest."""
    rows, seen = _counted(read_export(spark, root, schema), amount)
    rows.write.format("noop").mode("overwrite").save()
    said, found = spark.read.schema("rows long, cents string, digest string").json(f"{root}/manifest").first(), seen.get
    return (said.rows, said.cents, said.digest) == (found["rows"], str(found["cents"]), str(found["digest"]))


def export_payload(sections: dict[str, DataFrame], root: str, about: dict[str, str], chunks: dict[str, str] | None = None) -> None:
    """A payload as folders of JSON lines, one a section, and `_meta` with what it is about and the rows of each section, counted while they are written.

    chunks names the column by which a section is cut into folders that readers load one by one. Texts are guarded as for
    spreadsheets only where sections are exported as CSV; JSON keeps them as they are.
    """
    counts = {}
    for name, df in sections.items():
        rows, seen = _counted(df)
        out = rows.write.mode("overwrite")
        (out.partitionBy(chunks[name]) if chunks and name in chunks else out).json(f"{root}/{name}")
        counts[name] = seen.get["rows"]
    spark = next(iter(sections.values())).sparkSession
    rows = [(k, v) for k, v in about.items()] + [(f"rows.{k}", str(n)) for k, n in counts.items()]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{root}/_meta")


NEUTRAL = "Sourced facts only: the days between gift and vote are arithmetic and claim no cause."


def export_report(rows: DataFrame, root: str, order: list[Column], about: dict[str, str]) -> None:
    """A report as CSV and as JSON lines, both in order and both with the same rows, and `_meta` with what it is about and the number of its rows."""
    seen = Observation(f"export-{uuid.uuid4().hex}")
    # counted above the sort: below it, rows that its ranges are sampled from are seen twice
    rows.orderBy(*order).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").json(f"{root}/json")
    export_csv(rows.sparkSession.read.schema(rows.schema).json(f"{root}/json"), f"{root}/csv", order)
    meta = [*about.items(), ("n_rows", str(seen.get["rows"])), ("neutrality_note", NEUTRAL)]
    rows.sparkSession.createDataFrame(meta, "name string, value string").coalesce(1).write.mode("overwrite").json(f"{root}/_meta")


#: Columns of an entity's export, in their order.
ALL_COLUMNS = (
    "transaction_id", "entity_slug", "entity_kind", "parent_owner_slug", "status", "status_reason", "signals_matched", "contributor_name_raw", "contributor_employer_raw", "contributor_occupation_raw", "contributor_city", "contributor_state", "contributor_zip",
    "recipient_committee_id", "recipient_committee_name", "recipient_candidate_id", "recipient_candidate_name", "recipient_party", "recipient_office", "amount", "date", "election_cycle", "report_type", "filing_id", "raw_payload_path", "ingested_at",
)


def export_entities(donations: DataFrame, path: str) -> None:
    """A folder an entity with its published rows that count, newest first, in fixed columns; lists become JSON."""
    from ..operators.rollup import published

    rows = published(donations).withColumn("signals_matched", F.to_json("signals_matched")).select(*ALL_COLUMNS, F.col("entity_slug").alias("entity"))
    guarded(rows).repartition("entity").sortWithinPartitions("entity", F.desc("date"), "transaction_id").write.mode("overwrite").option("header", True).partitionBy("entity").csv(path)


def snapshot(df: DataFrame, root: str, run_id: str) -> str:
    """An immutable version of a table, before it changes."""
    df.write.mode("errorifexists").parquet(path := f"{root}/v={run_id}")
    return path
