"""Federal files as landed JSON pages: contributions, committees, their totals, filings and disbursements, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import money
from ..functions.text import blank_to_null
from ..operators.dedup import first_by_native_id
from ..operators.merge import record_uid

# Fields of the published records that are read, and the filing id of records older than filing numbers.
CONTRIBUTION = """
transaction_id string, sub_id string, contributor_name string, contributor_first_name string, contributor_middle_name string, contributor_last_name string, contributor_suffix string,
contributor_employer string, contributor_occupation string, contributor_city string, contributor_state string, contributor_zip string,
committee_id string, committee_name string, committee struct<name: string, party: string, committee_type: string>, recipient_committee_type string, candidate_id string, candidate_name string, candidate_office string,
contribution_receipt_amount string, contribution_receipt_date string, two_year_transaction_period int, report_type string, file_number string, report_id string, image_number string, pdf_url string,
filing_form string, line_number string, receipt_type_full string, memo_code string, memo_text string, is_individual boolean
"""
SENTINEL_FILING_ID = "FEC-PRE2006-NOID"


def read_pages(spark: SparkSession, path: str, schema: str, cells: str = "response.results") -> DataFrame:
    """The records of landed pages {"response": {"results": [...]}}, with their places (_path, _at). Pages whose names begin with "_" and those that can't be parsed are left out."""
    shape = f"response struct<results: array<struct<{schema}>>>"
    pages = spark.read.schema(f"{shape}, _broken string").options(multiLine=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_broken").json(path)
    pages = pages.withColumn("_path", F.col("_metadata.file_path")).where(~F.rlike("_path", F.lit("/_[^/]*$")))
    return pages.select("_path", F.posexplode(cells).alias("_at", "r")).select("_path", "_at", "r.*")


def contributions(pages: DataFrame) -> DataFrame:
    """Each record once, by its identity: the first by path and place. Records without an identity are kept each."""
    rows = pages.withColumn("_id", record_uid(F.col("sub_id"), F.col("transaction_id")))
    return first_by_native_id(rows, "_id", [F.col("_path"), F.col("_at")], "keep", few=True)


def text(name: str) -> Column:
    return F.coalesce(name, F.lit(""))


def donation_row(classified: DataFrame, ingested_at: Column) -> DataFrame:
    """classify()'s federal records as rows of the table of donations.

    The committee's name and party come from the nested committee where there is one; an amount that is missing or no number
    is null, never 0; records without filing number and report have the sentinel as filing id; a missing transaction id is
    the submission id.
    """
    nested = F.col("committee").isNotNull()
    txn = F.coalesce(blank_to_null(F.col("transaction_id")), blank_to_null(F.col("sub_id")), F.lit(""))
    given = lambda c: blank_to_null(F.col(c))
    return classified.select(
        txn.alias("transaction_id"), "sub_id", record_uid(F.col("sub_id"), txn).alias("record_uid"), "entity_slug", "entity_kind", "parent_owner_slug", "status", "status_reason", F.col("signals").alias("signals_matched"),
        *[text(f"contributor_{c}").alias(f"contributor_{c}_raw") for c in ("name", "employer", "occupation")],
        *[text(f"contributor_{c}").alias(f"contributor_{c}") for c in ("city", "state", "zip")],
        text("committee_id").alias("recipient_committee_id"),
        F.coalesce(F.when(nested, F.col("committee.name")).otherwise(F.col("committee_name")), F.lit("")).alias("recipient_committee_name"),
        text("candidate_id").alias("recipient_candidate_id"), text("candidate_name").alias("recipient_candidate_name"), F.col("committee.party").alias("recipient_party"), given("candidate_office").alias("recipient_office"),
        money(F.col("contribution_receipt_amount")).alias("amount"), F.try_to_date(F.left("contribution_receipt_date", F.lit(10)), "yyyy-MM-dd").alias("date"), F.col("two_year_transaction_period").alias("election_cycle"),
        given("report_type").alias("report_type"), F.coalesce(given("file_number"), given("report_id"), F.lit(SENTINEL_FILING_ID)).alias("filing_id"), F.col("_path").alias("raw_payload_path"), ingested_at.alias("ingested_at"),
        "image_number", given("pdf_url").alias("pdf_url"), given("filing_form").alias("filing_form"), "line_number", given("receipt_type_full").alias("receipt_type_full"),
        F.coalesce(given("recipient_committee_type"), "committee.committee_type").alias("recipient_committee_type"), given("memo_code").alias("memo_code"), given("memo_text").alias("memo_text"), "is_individual",
    )


COMMITTEE = """committee_id string, name string, committee_name string, designation string, designation_full string, committee_type string, committee_type_full string, party string, party_full string,
organization_type string, organization_type_full string, affiliated_committee_name string, candidate_ids array<string>, treasurer_name string, custodian_name_full string, custodian_name_1 string, city string, state string, zip string,
filing_frequency string, first_file_date string, last_file_date string, last_f1_date string, is_terminated boolean, cycles array<int>"""


def committee_rows(pages: DataFrame) -> DataFrame:
    """Committees; lists are JSON, cycles sorted and distinct."""
    first = lambda *names: F.coalesce(*[blank_to_null(F.col(n)) for n in names])
    same = [F.col(c) for c in ("party", "party_full", "affiliated_committee_name", "treasurer_name", "city", "state", "zip", "filing_frequency", "first_file_date", "last_file_date", "last_f1_date")]
    return pages.select(
        "committee_id", F.coalesce(first("name", "committee_name"), F.lit("")).alias("name"), "designation", F.col("designation_full").alias("designation_label"), "committee_type", F.col("committee_type_full").alias("committee_type_label"),
        *same, first("organization_type", "organization_type_full").alias("organization_type"), first("custodian_name_full", "custodian_name_1").alias("custodian_name"),
        F.to_json(F.coalesce("candidate_ids", F.array().cast("array<string>"))).alias("candidate_ids"), F.coalesce("is_terminated", F.lit(False)).alias("is_terminated"),
        F.to_json(F.array_sort(F.array_distinct(F.filter(F.coalesce("cycles", F.array().cast("array<int>")), lambda c: c.isNotNull())))).alias("cycles"),
    )


TOTALS = "committee_id string, cycle int, receipts double, disbursements double, cash_on_hand_end_period double, individual_contributions double, other_political_committee_contributions double, independent_expenditures double, coverage_start_date string, coverage_end_date string"


def totals_rows(pages: DataFrame) -> DataFrame:
    """Totals of committees by cycle; without one, the even year that the coverage ends in or before."""
    end = F.left("coverage_end_date", F.lit(4)).try_cast("int")
    return pages.withColumn("cycle", F.coalesce("cycle", end + end % 2)).select(*[c.split(" ")[0] for c in TOTALS.split(", ")])


FILING = "file_number string, pdf_url string, form_type string, document_type string, document_type_full string, filed_date string, receipt_date string, coverage_start_date string, coverage_end_date string, committee_id string, committee_name string, is_amended boolean, amendment_chain array<string>, cycle int, election_year int"


def filing_rows(pages: DataFrame) -> DataFrame:
    rows = pages.withColumns({"is_amended": F.coalesce("is_amended", F.lit(False)), "amendment_chain": F.to_json(F.coalesce("amendment_chain", F.array().cast("array<string>"))), "cycle": F.coalesce(F.nullif(F.col("cycle"), F.lit(0)), "election_year")})
    return rows.select(*[c.split(" ")[0] for c in FILING.split(", ")][:-1])


DISBURSEMENT = "committee_id string, cycle int, candidate_id string, recipient_committee_id string, recipient_name string, recipient_nm string, name string, recipient_party string, party string, recipient_office string, office string, total double, total_amount double, count long, n_transactions long"


def disbursement_rows(pages: DataFrame, top: int = 200) -> DataFrame:
    """What committees gave to each recipient, the largest `top` of each committee and cycle; recipients without any identity are left out."""
    first = lambda *names: F.coalesce(*[blank_to_null(F.col(n)) for n in names])
    said = first("recipient_name", "recipient_nm")
    rows = pages.select(
        "committee_id", "cycle",
        F.coalesce(first("candidate_id", "recipient_committee_id"), F.concat(F.lit("NAME:"), said)).alias("recipient_id"), F.when(first("candidate_id").isNotNull(), "candidate").otherwise("committee").alias("recipient_kind"),
        first("recipient_name", "recipient_nm", "name").alias("recipient_name"), first("recipient_party", "party").alias("recipient_party"), first("recipient_office", "office").alias("recipient_office"),
        F.coalesce("total", "total_amount", F.lit(0.0)).alias("total_amount"), F.coalesce(F.nullif(F.col("count"), F.lit(0)), "n_transactions").alias("n_transactions"),
    ).where("recipient_id IS NOT NULL")
    from ..operators.rollup import top_per_group

    return top_per_group(rows, ["committee_id", "cycle"], [F.desc("total_amount"), F.col("recipient_id"), F.col("recipient_kind")], top).drop("rank")
