"""Queries of sources, projections, overrides and keyed state: raw rows are made from orders, customers and suppliers as the published files have them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links, money, text
from ..operators import attribution, checks, classify, merge, reports
from ..sources import federal, legislation, sinks, states
from ..streaming import incremental
from . import cases
from .queries import _t, query

_D = "CAST(o_orderdate AS DATE)"
_USD2 = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"


def _orders(spark: SparkSession, sf: str) -> tuple[DataFrame, Column, Column, Column, Column]:
    """orders with the key, the customer, the date and the amount as text."""
    return _t(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate").cast("date"), F.col("o_totalprice").cast(money.MONEY).cast("string")


@query(f"""SELECT 'CA:CAL-ACCESS:' || f || ':T' || k AS state_txn_id, 'Field' || c % 9 || ', Ann' AS contributor_name, CASE WHEN c % 10 > 0 THEN CASE WHEN c % 3 = 0 THEN 'Committee ' || c % 10 || ', Joe' ELSE 'Committee ' || c % 10 END ELSE '' END AS recipient_name,
CASE WHEN c % 10 > 0 THEN CASE WHEN c % 10 = 5 THEN 'candidate' WHEN c % 10 = 7 THEN 'ballot_measure' ELSE 'committee' END END AS recipient_type, CAST(amount AS DOUBLE) AS amount, d AS date, year(d) AS election_cycle FROM (
SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 4 = 1 THEN 'R' ELSE 'F' END || o_custkey AS f, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, {_D} AS d FROM orders)""", ("date",))
def bundle_ca(spark, sf):
    """Receipts with amendments and a second report of the same contribution; cover pages, of which the last amendment counts."""
    o, k, c, d, usd = _orders(spark, sf)
    row = lambda filing, amend: F.struct(filing.alias("FILING_ID"), amend.alias("AMEND_ID"))
    own, late = F.concat(F.lit("F"), c), F.concat(F.lit("R"), c)
    versions = F.when(k % 4 == 0, F.array(row(own, F.lit("0")), row(own, F.lit("2")), row(own, F.lit("x")))).when(k % 4 == 1, F.array(row(own, F.lit("0")), row(late, F.lit("0")))).otherwise(F.array(row(own, F.lit("1"))))
    rows = o.select(
        F.inline(versions), F.concat(F.lit("T"), k).alias("TRAN_ID"), F.concat(F.lit(" "), usd).alias("AMOUNT"), F.date_format(d, "M/d/yyyy").alias("RCPT_DATE"), F.concat(F.lit("Field"), c % 9).alias("CTRIB_NAML"), F.lit("Ann ").alias("CTRIB_NAMF"), F.lit("").alias("CTRIB_NAMS"),
    )
    n = F.col("c_custkey")
    pages = _t(spark, sf, "customer").where("c_custkey % 10 > 0").select(n, F.explode(F.array(F.lit("F"), F.lit("R"))).alias("p")).select("*", F.explode(F.array(F.lit("3"), F.lit("1"), F.lit(""))).alias("AMEND_ID"))
    newest, name = F.col("AMEND_ID") == "3", F.concat(F.lit("Committee "), n % 10)
    covers = pages.select(
        F.concat("p", n).alias("FILING_ID"), "AMEND_ID", F.lit("9").alias("FILER_ID"), F.when((n % 10 == 5) & newest & (n % 3 > 0), "").when(newest, name).otherwise("Old name").alias("FILER_NAML"), F.when(newest & (n % 3 == 0), "Joe").otherwise("").alias("FILER_NAMF"),
        F.when(n % 10 == 5, name).otherwise("").alias("CAND_NAML"), F.when(n % 10 == 7, "Measure").otherwise("").alias("BAL_NAME"), F.lit("").alias("BUS_NAME"),
    )
    out = states.SOURCES["CA"].bundle(rows, covers)
    return out.select("state_txn_id", "contributor_name", "recipient_name", "recipient_type", F.col("amount").cast("double").alias("amount"), "date", "election_cycle")


@query(f"""SELECT 'PA:PA-DOS:' || k || ':' || left(sha1(k || '|' || name || '|Acme|' || dt || '|' || amt || '|' || i), 16) AS state_txn_id, name AS contributor_name, coalesce(s_name, '') AS recipient_name, CASE WHEN s_name IS NOT NULL THEN 'party ' || s_suppkey % 2 END AS recipient_party,
CASE WHEN amt <> '' THEN TRY_CAST(amt AS DOUBLE) END AS amount, CASE WHEN dt <> '' THEN strptime(dt, '%Y%m%d')::DATE END AS date FROM (
SELECT o_orderkey AS k, 'Ann Field' || o_custkey % 9 AS name, o_custkey % 150 AS f, i, CASE i WHEN 1 THEN {_USD2} WHEN 2 THEN '' ELSE '25.50' END AS amt, CASE WHEN i < 3 THEN strftime({_D}, '%Y%m%d') ELSE '' END AS dt
FROM orders, (VALUES (1), (2), (3)) t(i) WHERE i = 1 OR (i = 2 AND o_orderkey % 2 = 0) OR (i = 3 AND o_orderkey % 3 = 0)) LEFT JOIN supplier ON s_suppkey = f""", ("date",))
def bundle_pa(spark, sf):
    """Rows of three pairs of amount and date, without ids of their own; recipients from the file of filers."""
    o, k, c, d, usd = _orders(spark, sf)
    day = F.date_format(d, "yyyyMMdd")
    rows = o.select(
        (c % 150).cast("string").alias("FilerID"), k.cast("string").alias("CampaignFinanceID"), F.concat(F.lit("Ann Field"), c % 9).alias("CONTRIBUTOR"), F.lit("Acme").alias("ENAME"), F.lit("null").alias("OCCUPATION"),
        usd.alias("CONTAMT1"), day.alias("CONTDATE1"), F.lit("").alias("CONTAMT2"), F.when(k % 2 == 0, day).otherwise(" ").alias("CONTDATE2"), F.when(k % 3 == 0, "25.50").otherwise("NULL").alias("CONTAMT3"), F.lit(None).cast("string").alias("CONTDATE3"),
    )
    s = F.col("s_suppkey")
    filers = _t(spark, sf, "supplier").select(s.cast("string").alias("FILERID"), F.col("s_name").alias("FILERNAME"), F.concat(F.lit("party "), s % 2).alias("PARTY"), F.lit("").alias("OFFICE"), F.lit("CAN").alias("FILERTYPE"))
    out = states.SOURCES["PA"].bundle(rows.union(rows), filers)
    return out.select("state_txn_id", "contributor_name", "recipient_name", "recipient_party", F.col("amount").cast("double").alias("amount"), "date")


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey, d, usd, o_orderkey % 7 ORDER BY n DESC, f DESC, o_orderkey::VARCHAR DESC, f) AS r FROM (
SELECT o_orderkey, o_custkey, {_D} AS d, {_USD2} AS usd, f, TRY_CAST(f AS BIGINT) AS n0, coalesce(TRY_CAST(f AS BIGINT), -1) AS n FROM orders, (VALUES ('9'), ('10'), ('x')) t(f) WHERE f = '9' OR o_orderkey % 2 = 0))
SELECT 'IL:ISBE:' || f || ':' || o_orderkey AS state_txn_id, 'Ann B Field' || o_custkey AS contributor_name, 'B' AS contributor_middle_name, CASE WHEN o_orderkey % 7 > 2 THEN 'Friends ' || o_orderkey % 7 ELSE '' END AS recipient_name,
CASE o_orderkey % 7 WHEN 3 THEN 'candidate' WHEN 4 THEN 'ballot_measure' WHEN 5 THEN 'committee' END AS recipient_type, CAST(usd AS DOUBLE) AS amount FROM r WHERE r = 1""")
def bundle_il(spark, sf):
    """The same contribution in several filings: the one of the largest number counts."""
    o, k, c, d, usd = _orders(spark, sf)
    rows = o.select(k.cast("string").alias("ID"), F.explode(F.when(k % 2 == 0, F.array(F.lit("9"), F.lit("10"), F.lit("x"))).otherwise(F.array(F.lit("9")))).alias("FiledDocID"), (k % 7).cast("string").alias("CommitteeID"), F.lit("Ann B").alias("FirstName"), F.concat(F.lit("Field"), c).alias("LastOnlyName"), d.cast("string").alias("RcvDate"), usd.alias("Amount"))
    kinds = [("3", "Candidate"), ("4", "Ballot Initiative"), ("5", "Political Action"), ("6", "")]
    committees = spark.createDataFrame([(i, f"Friends {i}", t, "DEM") for i, t in kinds], "ID string, Name string, TypeOfCommittee string, PartyAffiliation string")
    out = states.SOURCES["IL"].bundle(rows, committees)
    return out.select("state_txn_id", "contributor_name", "contributor_middle_name", "recipient_name", "recipient_type", F.col("amount").cast("double").alias("amount"))


@query(f"""SELECT 'TX:TEC:' || o_orderkey || '2:' || o_orderkey AS state_txn_id, CASE WHEN o_custkey % 4 = 0 THEN 'Org ' || o_custkey ELSE 'Ann Mae Field' || o_custkey || ' JR' END AS contributor_name, CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'Mae' END AS contributor_middle_name, 'Owner' AS contributor_occupation,
CASE WHEN o_orderkey % 5 = 0 THEN coalesce(s_name, '') ELSE 'Inline' END AS recipient_name, CASE WHEN o_orderkey % 3 = 0 THEN 'candidate' WHEN s_suppkey % 2 = 0 THEN 'committee' END AS recipient_type, CASE WHEN s_suppkey % 3 > 0 THEN 'Office ' || s_suppkey % 3 END AS recipient_office,
{_D} AS date FROM orders LEFT JOIN supplier ON s_suppkey = o_custkey % 100 + 1""", ("date",))
def bundle_tx(spark, sf):
    """Contributions in two reports each; names and kinds of recipients inline, the office from the file of filers."""
    o, k, c, d, usd = _orders(spark, sf)
    person = lambda v: F.when(c % 4 > 0, v).otherwise("NULL")
    rows = o.select(
        F.explode(F.array(F.concat(k, F.lit("1")), F.concat(k, F.lit("2")))).alias("reportInfoIdent"), k.cast("string").alias("contributionInfoId"), (c % 100 + 1).cast("string").alias("filerIdent"), F.when(k % 5 == 0, "").otherwise("Inline").alias("filerName"), F.when(k % 3 == 0, "JCOH").otherwise("").alias("filerTypeCd"),
        person(F.lit("Ann Mae")).alias("contributorNameFirst"), person(F.concat(F.lit("Field"), c)).alias("contributorNameLast"), person(F.lit("JR")).alias("contributorNameSuffixCd"), F.concat(F.lit("Org "), c).alias("contributorNameOrganization"),
        F.lit("").alias("contributorOccupation"), F.lit("Owner").alias("contributorJobTitle"), F.date_format(d, "yyyyMMdd").alias("contributionDt"), F.concat(usd, k % 1000).alias("contributionAmount"),
    )
    s = F.col("s_suppkey")
    office = lambda i: F.when(s % 3 == i, F.concat(F.lit("Office "), s % 3)).otherwise("")
    filers = _t(spark, sf, "supplier").select(s.cast("string").alias("filerIdent"), F.col("s_name").alias("filerName"), F.when(s % 2 == 0, "GPAC").otherwise("?").alias("filerTypeCd"), office(1).alias("ctaSeekOfficeDescr"), office(2).alias("filerHoldOfficeDescr"), F.lit("").alias("contestSeekOfficeDescr"))
    out = states.SOURCES["TX"].bundle(rows, filers)
    return out.select("state_txn_id", "contributor_name", "contributor_middle_name", "contributor_occupation", "recipient_name", "recipient_type", "recipient_office", "date")


@query("""SELECT o_orderkey, 'owner' || i AS owner_slug FROM orders, (VALUES (1, 'field1'), (2, 'ield2'), (3, 'field'), (4, '3')) t(i, s) WHERE ('field' || o_custkey % 9) LIKE '%' || s || '%'""")
def surname_funnel(spark, sf):
    """Every owner whose surname is anywhere in the contributor's last name."""
    o, k, c, _, _ = _orders(spark, sf)
    rows = o.select("o_orderkey", F.concat(F.lit("FIELD"), c % 9).alias("CTRIB_NAML"))
    registry = spark.createDataFrame([("owner1", None, ["Ann Field1"]), ("owner2", None, ["Ield2, Bob"]), ("owner3", None, ["Cy  Field", "Field, Cyrus"]), ("owner4", None, ["3"]), ("kin", "owner1", ["Zoe 4"])], "slug string, parent_slug string, name_variants array<string>")
    return states.SOURCES["CA"].candidates(rows, registry).select("o_orderkey", "owner_slug")


_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'PROBABLE' ELSE 'UNCERTAIN' END"


@query(f"""SELECT CASE WHEN o_orderkey % 30 = 0 THEN '' WHEN o_orderkey % 6 = 0 THEN 'S' || o_orderkey ELSE 'T' || o_orderkey END AS transaction_id, CASE WHEN o_orderkey % 30 = 0 THEN '' WHEN o_orderkey % 5 = 0 THEN 'T' || o_orderkey ELSE 'S' || o_orderkey END AS record_uid,
CASE WHEN o_orderkey % 4 = 0 THEN coalesce(nullif('nested ' || o_custkey % 3, 'nested 0'), '') ELSE 'flat' END AS recipient_committee_name, CASE WHEN o_orderkey % 4 = 0 THEN 'DEM' END AS recipient_party, CASE WHEN o_orderkey % 9 > 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount,
CASE WHEN o_orderkey % 7 > 0 THEN {_D} END AS date, CASE o_orderkey % 3 WHEN 0 THEN 'N' || o_orderkey WHEN 1 THEN 'R' || o_orderkey ELSE 'FEC-PRE2006-NOID' END AS filing_id, CASE WHEN o_orderkey % 2 = 0 THEN 'Q' WHEN o_orderkey % 4 = 0 THEN 'N' END AS recipient_committee_type
FROM orders""", ("date",))
def federal_projection(spark, sf):
    """Records as rows of the table of donations: nested and flat committees, missing ids (some have none at all), amounts and dates."""
    o, k, c, d, usd = _orders(spark, sf)
    none = F.lit(None).cast("string")
    committee = F.when(k % 4 == 0, F.struct(F.when(c % 3 > 0, F.concat(F.lit("nested "), c % 3)).alias("name"), F.lit("DEM").alias("party"), F.lit("N").alias("committee_type")))
    given = {
        "transaction_id": F.when(k % 6 > 0, F.concat(F.lit("T"), k)).otherwise(""), "sub_id": F.when(k % 5 > 0, F.concat(F.lit("S"), k)).otherwise(" "), "committee": committee, "committee_name": F.lit("flat"), "contribution_receipt_amount": F.when(k % 9 > 0, usd).otherwise("n/a"),
        "contribution_receipt_date": F.when(k % 7 > 0, F.concat(d.cast("string"), F.lit("T00:00:00"))), "file_number": F.when(k % 3 == 0, F.concat(F.lit("N"), k)), "report_id": F.when(k % 3 < 2, F.concat(F.lit("R"), k)), "recipient_committee_type": F.when(k % 2 == 0, "Q").otherwise(""),
        "is_individual": F.lit(True), "two_year_transaction_period": F.lit(2000), "_path": F.lit("p"), "signals": F.array().cast("array<string>"), "entity_slug": F.lit("e"), "entity_kind": F.lit("owner"), "parent_owner_slug": none, "status": F.lit("PROBABLE"), "status_reason": none,
    }
    names = [f.strip().split(" ")[0] for f in federal.CONTRIBUTION.replace("committee struct<name: string, party: string, committee_type: string>", "committee x").replace("\n", " ").split(",")]
    rows = o.select(*[given.get(n, none).alias(n) for n in dict.fromkeys([*names, *given])])
    out = federal.donation_row(rows, F.lit("now"))
    return out.select("transaction_id", "record_uid", "recipient_committee_name", "recipient_party", F.col("amount").cast("double").alias("amount"), "date", "filing_id", "recipient_committee_type")


@query("""SELECT p_partkey, CAST(CASE WHEN p_partkey % 3 = 0 THEN 1990 + p_partkey % 10 WHEN p_partkey % 3 = 1 THEN 2000 + p_size + (2000 + p_size) % 2 END AS INTEGER) AS cycle FROM part""")
def committee_cycles(spark, sf):
    """Totals without a cycle take the even year at or after the end of their coverage."""
    k = F.col("p_partkey")
    rows = _t(spark, sf, "part").select(k.cast("string").alias("committee_id"), F.when(k % 3 == 0, 1990 + k % 10).cast("int").alias("cycle"), F.when(k % 3 == 1, F.concat((2000 + F.col("p_size")).cast("string"), F.lit("-06-30"))).alias("coverage_end_date"), *[F.lit(None).cast("double").alias(c) for c in ("receipts", "disbursements", "cash_on_hand_end_period", "individual_contributions", "other_political_committee_contributions", "independent_expenditures")], F.lit(None).cast("string").alias("coverage_start_date"))
    return federal.totals_rows(rows).select(F.col("committee_id").cast("long").alias("p_partkey"), "cycle")


@query("""WITH r AS (SELECT l_suppkey AS c, CASE l_linenumber % 4 WHEN 0 THEN 'P' || l_partkey WHEN 1 THEN 'C' || l_partkey WHEN 2 THEN 'NAME:n' || l_partkey END AS id, CASE WHEN l_linenumber % 4 = 0 THEN 'candidate' ELSE 'committee' END AS kind, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t FROM lineitem GROUP BY ALL)
SELECT c AS l_suppkey, id AS recipient_id, kind AS recipient_kind, CAST(t AS DOUBLE) AS total_amount FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY CAST(t AS DOUBLE) DESC, id, kind) AS r FROM r WHERE id IS NOT NULL) WHERE r <= 20""")
def disbursements_by_recipient(spark, sf):
    """The largest recipients of each committee: candidates, committees, or a name where there is no id."""
    line, p = F.col("l_linenumber") % 4, F.col("l_partkey")
    none = F.lit(None).cast("string")
    some = lambda i, start: F.when(line == i, F.concat(F.lit(start), p))
    sums = _t(spark, sf, "lineitem").groupBy("l_suppkey", line.alias("i"), p.alias("p")).agg(F.sum(F.col("l_extendedprice").cast(money.MONEY)).cast("double").alias("total"))
    line, p = F.col("i"), F.col("p")
    rows = sums.select(
        F.col("l_suppkey").cast("string").alias("committee_id"), F.lit(2000).alias("cycle"), some(0, "P").alias("candidate_id"), some(1, "C").alias("recipient_committee_id"), none.alias("recipient_name"), some(2, "n").alias("recipient_nm"), none.alias("name"),
        *[none.alias(n) for n in ("recipient_party", "party", "recipient_office", "office")], F.when(p % 2 == 0, F.col("total")).alias("total"), F.col("total").alias("total_amount"), F.lit(1).cast("long").alias("count"), F.lit(None).cast("long").alias("n_transactions"),
    )
    return federal.disbursement_rows(rows, 20).select(F.col("committee_id").cast("long").alias("l_suppkey"), "recipient_id", "recipient_kind", "total_amount")


# -- overrides and reclassification: each order is a record of the classifier's cases

_N = len(cases.CASES)
_ANSWERS = f"(SELECT o_orderkey AS k, entity_slug, status, coalesce(p, entity_slug) AS house FROM orders JOIN (VALUES {cases.answers()}) a(case_id, entity_slug, status, signals) ON case_id = o_orderkey % {_N} LEFT JOIN (VALUES ('field-cara', 'field'), ('field-rob', 'field'), ('park-s', 'park'), ('twin-b-kim', 'twin-b')) f(s, p) ON s = entity_slug)"
#: Every seventh order is forced to stone, every eleventh kept from whom it fits.
_FORCED = "SELECT o_orderkey AS k, 'stone' AS o, CASE o_orderkey % 2 WHEN 0 THEN 'CONFIRMED' ELSE 'PROBABLE' END AS verdict FROM orders WHERE o_orderkey % 7 = 0"
_OVER = f"({_FORCED} UNION ALL SELECT k, house, 'EXCLUDED' FROM {_ANSWERS} WHERE k % 11 = 0 AND k % 7 > 0)"


def _case_records(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % _N).cast("int").alias("case_id")).join(F.broadcast(cases.records(spark)), "case_id")


def _overrides(spark: SparkSession, sf: str, classified: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    forced = _t(spark, sf, "orders").where(k % 7 == 0).select(k.alias("k"), F.lit("stone").alias("entity_slug"), F.when(k % 2 == 0, "CONFIRMED").otherwise("PROBABLE").alias("verdict"))
    return forced.union(classified.where("k % 11 = 0 AND k % 7 > 0").select("k", attribution.household(), F.lit("EXCLUDED")))


@query(f"""SELECT k, entity_slug, status FROM {_ANSWERS} a WHERE NOT EXISTS (SELECT 1 FROM {_OVER} x WHERE x.k = a.k AND x.o = a.house) UNION ALL SELECT k, o, verdict FROM {_OVER} WHERE verdict <> 'EXCLUDED'""")
def overrides_federal(spark, sf):
    """Forced records are the owner's, whether or not the classifier kept them; excluded ones go."""
    records = _case_records(spark, sf)
    done = classify.classify(records, cases.registry(spark), "k")
    return attribution.federal_overrides(records, done, _overrides(spark, sf, done), "k").select("k", "entity_slug", "status")


@query(f"""SELECT k, entity_slug, CASE WHEN verdict IS NULL THEN status ELSE verdict END AS status FROM {_ANSWERS} a LEFT JOIN (SELECT k, o AS house, verdict FROM {_OVER}) USING (k, house) WHERE verdict IS NULL OR verdict <> 'EXCLUDED'""")
def overrides_state(spark, sf):
    """Only records that the classifier kept can be forced, under the slug that it found."""
    done = classify.classify(_case_records(spark, sf), cases.registry(spark), "k")
    return attribution.state_overrides(done, _overrides(spark, sf, done), "k").select("k", "entity_slug", "status")


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """Published rows of orders under the owners of the cases: classified once as PROBABLE, with their fields."""
    names = ("name", "employer", "occupation")
    rows = _case_records(spark, sf).join(F.broadcast(spark.createDataFrame([(i, slug) for i, c in enumerate(cases.CASES) for slug, _, _ in c[-1]] + [(i, "stone") for i, c in enumerate(cases.CASES) if not c[-1]], "case_id int, entity_slug string")), "case_id")
    kin = F.create_map(*[F.lit(x) for e in cases.ENTITIES if e[2] for x in (e[0], e[2])])
    return rows.select(
        F.concat(F.lit("u"), "k").alias("record_uid"), F.col("k").cast("string").alias("transaction_id"), "entity_slug", F.try_element_at(kin, F.col("entity_slug")).alias("parent_owner_slug"), F.lit("PROBABLE").alias("status"), F.lit("old").alias("status_reason"), F.lit(None).cast("string").alias("superseded_by"),
        *[F.col(f"contributor_{n}").alias(f"contributor_{n}_raw") for n in names], *[f"contributor_{n}" for n in ("city", "state", "zip")],
    )


@query(f"""WITH a AS (SELECT * FROM {_ANSWERS} WHERE k % {_N} NOT IN ({", ".join(str(i) for i, c in enumerate(cases.CASES) if c[1])})),
s AS (SELECT o_orderkey AS k, coalesce(entity_slug, 'stone') AS entity_slug, coalesce(house, 'stone') AS house, status FROM orders LEFT JOIN (SELECT k AS o_orderkey, entity_slug, house, status FROM {_ANSWERS}) USING (o_orderkey))
SELECT entity_slug, outcome, count(*) AS n FROM (SELECT s.entity_slug, CASE WHEN s.k % 11 = 0 AND s.house = 'stone' THEN 'excluded' WHEN s.k % 13 = 0 AND s.house = 'field' THEN 'forced' WHEN a.status IN ('CONFIRMED', 'PROBABLE') THEN 'updated' WHEN s.k % 2 = 0 THEN 'suppressed' ELSE 'demoted' END AS outcome
FROM s LEFT JOIN a ON a.k = s.k AND a.house = s.house) GROUP BY 1, 2""")
def reclassify_in_place(spark, sf):
    """Stored rows scored again: forced, excluded, demoted to the queue, or kept out of it by a verdict. Stored rows have no split names."""
    stored = _stored(spark, sf)
    txn = F.col("transaction_id").cast("long")
    over = stored.select("transaction_id").distinct()
    overrides = over.where(txn % 11 == 0).withColumns({"entity_slug": F.lit("stone"), "verdict": F.lit("EXCLUDED")}).union(over.where(txn % 13 == 0).withColumns({"entity_slug": F.lit("field"), "verdict": F.lit("CONFIRMED")}))
    verdicts = stored.where(txn % 2 == 0).select("transaction_id", "entity_slug", F.lit("DISCARDED").alias("resolution"))
    out = attribution.reclassified_in_place(stored, cases.registry(spark), overrides, verdicts)
    return out.groupBy("entity_slug", "outcome").agg(F.count("*").alias("n"))


@query("""SELECT 'u' || o_orderkey AS record_uid, CASE WHEN o_orderkey % 5 = 0 THEN 'raw missing' ELSE 'diverged' END AS loss FROM orders WHERE o_orderkey % 5 = 0 OR (o_orderkey % 3 = 0 AND o_orderkey % 4 <> 0)""")
def loss_guard(spark, sf):
    """Rows that a rebuild would lose: their raw record is gone, or it no longer counts and nobody has forced it."""
    k = F.col("o_orderkey")
    uid = F.concat(F.lit("u"), k).alias("record_uid")
    none = F.lit(None).cast("string")
    o = _t(spark, sf, "orders")
    live = o.select(uid, k.cast("string").alias("transaction_id"), F.lit("e").alias("entity_slug"), none.alias("parent_owner_slug"), none.alias("superseded_by"))
    done = o.where(k % 3 > 0).select(uid, F.lit("e").alias("entity_slug"), none.alias("parent_owner_slug"), F.lit("PROBABLE").alias("status"))
    return attribution.would_lose(live, o.where(k % 5 > 0).select(uid), done, o.where(k % 4 == 0).select(k.cast("string").alias("transaction_id"), F.lit("e").alias("entity_slug"))).select("record_uid", "loss")


@query(f"""WITH q AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'stone' WHEN 1 THEN 'park-s' WHEN 2 THEN 'nobody' ELSE 'stone' END AS slug, o_orderkey % 6 AS legs FROM orders WHERE o_orderkey % 5 <> 0),
l AS (SELECT q.*, i, CASE slug WHEN 'stone' THEN i % 2 = 0 WHEN 'park-s' THEN true ELSE false END AS ok, (k + i) % 3 = 0 AS live FROM q JOIN (VALUES (1), (2), (3), (4), (5)) t(i) ON i <= legs),
g AS (SELECT k, count(*) AS n, count(*) FILTER (ok) AS good, count(*) FILTER (ok AND NOT live) AS new FROM l GROUP BY 1)
SELECT k::VARCHAR AS transaction_id, slug AS entity_slug, CASE WHEN slug = 'nobody' OR n IS NULL THEN 'UNVERIFIABLE' WHEN new = 0 THEN 'DISCARD' WHEN good = n THEN 'PROMOTE' ELSE 'HOLD' END AS disposition, coalesce(n, 0) AS legs, coalesce(good, 0) AS attributable,
CASE WHEN new > 0 THEN CAST(new * 10 AS DOUBLE) END AS promoted_amount FROM q LEFT JOIN g USING (k)""")
def queue_burndown(spark, sf):
    """Open items by what their raw records say now."""
    k = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    slug = F.when(k % 4 == 0, "stone").when(k % 4 == 1, "park-s").when(k % 4 == 2, "nobody").otherwise("stone")
    o = _t(spark, sf, "orders").select(k, k.cast("string").alias("transaction_id"), slug.alias("entity_slug"))
    queue = o.select("transaction_id", "entity_slug", F.lit("name only").alias("reason"), none.alias("resolution"))
    resolved = o.where(k % 5 == 0).select("transaction_id", "entity_slug")
    legs = o.select("*", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("i")).where((F.col("i") > 0) & (F.col("i") <= k % 6))
    fields = {f"contributor_{c}": F.lit("") for c in ("occupation", "city", "state", "zip")}
    name = F.when(F.col("entity_slug") == "park-s", "Park, John S").otherwise("Ann Stone")
    employer = F.when(F.col("entity_slug") == "park-s", "Zed").when(F.col("i") % 2 == 0, "Acme").otherwise("")
    raw = legs.select("transaction_id", F.concat_ws("-", "transaction_id", "i").alias("sub_id"), "entity_slug", F.lit("10").alias("amount"), name.alias("contributor_name"), employer.alias("contributor_employer"), *[v.alias(c) for c, v in fields.items()])
    live = legs.where((k + F.col("i")) % 3 == 0).select(F.concat_ws("-", "transaction_id", "i").alias("record_uid"), none.alias("superseded_by"))
    out = attribution.burndown(queue, resolved, raw.union(raw), cases.registry(spark), live)
    return out.select("transaction_id", "entity_slug", "disposition", "legs", "attributable", F.col("promoted_amount").cast("double").alias("promoted_amount"))


@query("""SELECT 'e' || o_custkey % 50 AS entity_slug, count(*) AS total, count(*) FILTER (o_orderkey % 4 <> 1) AS missing_raw, count(DISTINCT o_orderkey || '/' || o_custkey) FILTER (o_orderkey % 4 IN (2, 3)) AS missing_files, count(*) FILTER (o_orderkey % 4 = 2) AS recoverable, count(*) FILTER (o_orderkey % 4 IN (0, 3)) AS absent FROM (
SELECT o_custkey, CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 4 = 2 THEN 2 WHEN o_custkey % 3 = 1 AND o_orderkey % 4 > 0 THEN 1 WHEN o_orderkey % 4 = 0 THEN 0 ELSE 3 END AS o_orderkey FROM orders) GROUP BY 1""")
def raw_coverage(spark, sf):
    """Live rows whose raw file is gone, and whether the archive has it."""
    k, c = F.col("o_orderkey") % 4, F.col("o_custkey")
    kind = F.when((c % 3 == 0) & (k == 2), 2).when((c % 3 == 1) & (k > 0), 1).when(k == 0, 0).otherwise(3)
    rows = _t(spark, sf, "orders").select(F.concat(F.lit("e"), c % 50).alias("entity_slug"), F.when(kind > 0, F.concat_ws("/", kind.cast("string"), c)).alias("raw_payload_path"), F.lit(None).cast("string").alias("superseded_by"))
    paths = rows.where("raw_payload_path IS NOT NULL").select("raw_payload_path").distinct()
    return attribution.raw_coverage(rows, paths.where("raw_payload_path LIKE '1/%'"), paths.where("raw_payload_path LIKE '2/%'"))


# -- keyed state


@query(f"""SELECT CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 4 = 1 THEN 'T' || o_orderkey ELSE 'S' || o_orderkey END AS record_uid, o_orderkey AS k FROM orders""")
def legacy_adoption(spark, sf):
    """Rows from before submission ids take over those of the records that they are: not where the amount differs, nor where no record came."""
    k = F.col("o_orderkey")
    usd = F.col("o_totalprice").cast(money.MONEY)
    row = lambda uid, sub, amount: [k.alias("k"), F.concat(F.lit("T"), k).alias("transaction_id"), uid.alias("record_uid"), sub.alias("sub_id"), F.lit("e").alias("entity_slug"), F.lit(None).cast("string").alias("recipient_committee_id"), F.col("o_orderdate").cast("date").alias("date"), amount.cast(money.MONEY).alias("amount")]
    o = _t(spark, sf, "orders")
    sub = F.concat(F.lit("S"), k)
    current = o.select(*row(F.concat(F.lit("T"), k), F.lit(None).cast("string"), usd))
    incoming = o.where(k % 3 > 0).select(*row(sub, sub, F.when(k % 4 == 1, usd + 1).otherwise(usd)))
    late = o.where(k % 3 > 0).select(*row(F.concat(F.lit("X"), k), F.concat(F.lit("X"), k), usd)).where("k % 5 = 0 AND k % 4 <> 1")
    return merge.adopted(current, incoming.union(late), F.col("sub_id")).select("record_uid", "k")


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 3 WHEN o_orderkey % 3 = 1 THEN 2 ELSE 1 END AS amount FROM orders""")
def merge_in_order(spark, sf):
    """A batch with up to three versions of one identity: each is merged after the one before it."""
    k = F.col("o_orderkey")
    rows = _t(spark, sf, "orders").select(k.alias("k"), F.explode(F.sequence(F.lit(1), F.when(k % 3 == 0, 3).when(k % 3 == 1, 2).otherwise(1))).alias("amount"))
    state = rows.limit(0)
    for batch in merge.in_rounds(rows.union(rows), ["k"], [F.col("amount")]):
        state = merge.upsert(state, batch, ["k"])
    return state


@query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'old' WHEN c_custkey % 3 = 0 THEN 'raw' WHEN c_custkey % 4 = 1 THEN '' END AS memo, CASE WHEN c_custkey % 5 = 0 THEN 'kept' END AS link FROM customer""")
def backfill_and_carry(spark, sf):
    """Missing values come from the raw records; what people wrote stays when a row is replaced."""
    k = F.col("c_custkey")
    c = _t(spark, sf, "customer").select(k)
    now = c.select(k, F.when(k % 2 == 0, "old").when(k % 4 == 1, "").alias("memo"))
    filled = merge.backfilled(now, c.where(k % 3 == 0).select(k, F.lit("raw").alias("memo")), ["c_custkey"], ["memo"])
    return merge.carried(c.where(k % 5 == 0).withColumn("link", F.lit("kept")), filled, ["c_custkey"], ["link"])


@query("""WITH due AS (SELECT c_custkey AS k, last FROM customer LEFT JOIN (SELECT user_id AS c_custkey, max(CAST(ts AS DATE)) AS last FROM events GROUP BY 1) USING (c_custkey) WHERE c_custkey % 10 > 0 AND (last IS NULL OR date_diff('day', last, (SELECT max(CAST(ts AS DATE)) FROM events)) >= 1)),
r AS (SELECT k, row_number() OVER (ORDER BY last NULLS FIRST, k) AS r FROM due) SELECT k AS c_custkey, r <= 700 AS now FROM r""")
def fetch_backlog(spark, sf):
    """What is stale, the oldest and the never-fetched first, up to the budget of a run; the rest is deferred; tombstones are left out."""
    runs = _t(spark, sf, "events").select(F.col("user_id").alias("c_custkey"), F.col("ts").cast("date").alias("at"))
    people = _t(spark, sf, "customer").select("c_custkey")
    now = runs.agg(F.max("at")).first()[0]  # one value
    taken, later = merge.backlog(people, runs, people.where("c_custkey % 10 = 0"), "c_custkey", "at", F.lit(now), 1, 700)
    return taken.select("c_custkey", F.lit(True).alias("now")).union(later.select("c_custkey", F.lit(False)))


@query("""SELECT 'e' || c_custkey AS entity_slug, CASE WHEN (c_custkey - c_custkey % 5) % 3 = 0 THEN 'a' WHEN (c_custkey - c_custkey % 5) % 3 = 1 THEN 'b' ELSE 'base' END AS origin FROM customer""")
def buckets_merged(spark, sf):
    """Households that a bucket has run replace those of the base, relatives included."""
    k = F.col("c_custkey")
    row = lambda origin: [F.concat(F.lit("e"), k).alias("entity_slug"), F.when(k % 5 > 0, F.concat(F.lit("e"), k - k % 5)).alias("parent_owner_slug"), F.lit(origin).alias("origin")]
    c, house = _t(spark, sf, "customer"), (k - k % 5) % 3
    return merge.buckets_merged(c.select(*row("base")), [c.where(house == 0).select(*row("a")), c.where(house == 1).select(*row("b")), c.limit(0).select(*row("c"))]).select("entity_slug", "origin")


# -- legislation


@query("""SELECT 'b' || p_partkey AS name, p_partkey || '-hr-' || p_size AS bill_id, 'https://www.congress.gov/bill/' || p_partkey || 'th-congress/house-bill/' || p_size AS url, p_partkey % 2 = 0 AS enacted FROM part""")
def bills(spark, sf):
    rows = _bills(spark, sf)
    return legislation.bill_rows(rows).select(F.col("title").alias("name"), "bill_id", F.col("congress_dot_gov_url").alias("url"), "enacted")


@query("""SELECT p_partkey || '-hr-' || p_size AS bill_id, 'M' || i AS bioguide_id, CASE WHEN i = p_partkey % 4 THEN 'sponsor' ELSE 'cosponsor' END AS role FROM part, (VALUES (0), (1), (2), (3)) t(i) WHERE i = p_partkey % 4 OR i < 2""")
def bill_sponsors(spark, sf):
    return legislation.sponsor_rows(_bills(spark, sf))


@query("""SELECT p_partkey || '-hr-' || p_size AS bill_id, s AS system_code, t AS thomas_id FROM part, (VALUES ('ssju00', 'SSJU'), ('hsed14', 'HSED'), ('xyz', 'XYZ')) t(s, t)""")
def bill_committees(spark, sf):
    return legislation.bill_committee_rows(_bills(spark, sf)).select("bill_id", "system_code", "thomas_id")


def _bills(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    person = lambda c: F.struct(c.alias("bioguideId"))
    none = F.lit(None).cast("string")
    people = F.array(person(F.lit("M0")), person(F.lit("M1")), person(none), person(F.lit("M1")))
    bill = F.struct(k.cast("int").alias("congress"), F.lit("HR").alias("type"), F.col("p_size").cast("int").alias("number"), F.concat(F.lit("b"), k).alias("title"), none.alias("introducedDate"), none.alias("url"), F.when(k % 2 == 0, F.array(F.lit("law"))).alias("laws"), F.struct(none.alias("text"), none.alias("actionDate")).alias("latestAction"), F.array(person(F.concat(F.lit("M"), k % 4))).alias("sponsors"))
    codes = F.array(*[F.struct(F.lit(c).alias("systemCode"), F.lit("House").alias("chamber"), F.lit("n").alias("name")) for c in ("ssju00", "hsed14", "ssju00", "xyz", "")])
    return _t(spark, sf, "part").select(bill.alias("bill"), people.alias("cosponsors"), codes.alias("committees"))


@query("""SELECT bioguide_id, full_name, current_party, n_ids, n_terms, congress FROM (SELECT 'L' || s_suppkey AS bioguide_id, CASE WHEN s_suppkey % 2 = 0 THEN 'Full ' || s_suppkey ELSE 'Ann ' || s_name END AS full_name, 'new' AS current_party, 2 AS n_ids, 2 AS n_terms, CAST(115 AS INTEGER) AS congress FROM supplier WHERE s_suppkey % 3 > 0)
UNION ALL SELECT 'L' || s_suppkey, 'Other', 'wrong', 1, 1, 115 FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT 'H' || s_suppkey, 'Old', 'old', 1, 1, 102 FROM supplier WHERE s_suppkey % 3 > 0""")
def legislator_crosswalk(spark, sf):
    """People of both files once, with the identity of the current one; those without a candidate id there are as the older file has them, those without any go."""
    k = F.col("s_suppkey")
    none = F.lit(None).cast("string")
    term = lambda kind, start, party: F.struct(F.lit(kind).alias("type"), F.lit(start).alias("start"), none.alias("end"), F.lit("OH").alias("state"), none.alias("district"), F.lit(party).alias("party"))

    def entry(who: str, fec: Column, official: Column, terms: Column) -> DataFrame:
        ids = F.struct(F.concat(F.lit(who), k).alias("bioguide"), fec.alias("fec"), *[none.alias(c) for c in ("icpsr", "govtrack", "opensecrets", "lis")])
        return _t(spark, sf, "supplier").select(ids.alias("id"), F.struct(F.lit("Ann").alias("first"), F.col("s_name").alias("last"), official.alias("official_full")).alias("name"), terms.alias("terms"))

    fec = F.when(k % 3 > 0, F.array(F.concat(F.lit("F"), k), F.concat(F.lit("G"), k), F.lit("")))
    current = entry("L", fec, F.when(k % 2 == 0, F.concat(F.lit("Full "), k)), F.array(term("rep", "2017-01-03", "mid"), term("sen", "2018-06-01", "new"), term("prez", "2020-01-01", "new")))
    older = entry("L", F.array(F.concat(F.lit("F"), k)), F.lit("Other"), F.array(term("rep", "2017-01-03", "wrong"))).union(entry("H", F.when(k % 3 > 0, F.array(F.concat(F.lit("F"), k))), F.lit("Old"), F.array(term("rep", "1991-01-03", "old"))))
    people, ids, terms = legislation.crosswalk(current, older)
    n_ids, n_terms = ids.groupBy("bioguide_id").agg(F.count("*").cast("int").alias("n_ids")), terms.groupBy("bioguide_id").agg(F.count("*").cast("int").alias("n_terms"), F.max("congress").alias("congress"))
    known = people.join(n_ids, "bioguide_id").join(n_terms, "bioguide_id")
    return known.select("bioguide_id", "full_name", "current_party", "n_ids", "n_terms", "congress")


@query(f"""SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'Field' || o_custkey WHEN o_custkey % 3 = 1 THEN 'Field' || o_custkey ELSE 'Solo' END AS last, CASE o_custkey % 3 WHEN 0 THEN 'Ann' WHEN 1 THEN 'Ann' ELSE '' END AS first, CASE o_custkey % 3 WHEN 0 THEN 'B C' WHEN 1 THEN 'B' ELSE '' END AS middle,
CASE o_custkey % 3 WHEN 0 THEN 'Town' WHEN 1 THEN 'New Town' ELSE 'nowhere at all' END AS city, CASE WHEN o_custkey % 3 < 2 THEN 'FL' ELSE '' END AS state, lpad((o_custkey % 1000)::VARCHAR, 5, '0') AS zip5 FROM orders""")
def split_fields(spark, sf):
    """Names, places and ZIP codes from the texts of several states."""
    o, k, c, _, _ = _orders(spark, sf)
    name = F.when(c % 3 == 0, F.concat(F.lit("Field"), c, F.lit(",  Ann B  C"))).when(c % 3 == 1, F.concat(F.lit("Ann B Field"), c)).otherwise("Solo")
    zip9 = F.concat(F.lpad((c % 1000).cast("string"), 5, "0"), F.lit("-1234"))
    place = F.when(c % 3 == 0, F.concat(F.lit("Town, fl "), zip9)).when(c % 3 == 1, F.concat(F.lit("New Town FL "), F.left(zip9, F.lit(5)))).otherwise("nowhere at all")
    rows = o.select(k, text.last_first_names(name).alias("n"), text.city_state_zip(place).alias("p"), text.zip5(zip9).alias("zip5"))
    return rows.select("o_orderkey", "n.last", "n.first", "n.middle", "p.city", "p.state", "zip5")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN o_orderkey % 3 > 0 THEN 'https://cal-access.sos.ca.gov/PDFGen/pdfgen.prg?filingid=' || o_custkey || '&amendid=0' END WHEN 1 THEN 'https://data.ny.gov/resource/4j2b-6a2j.json?trans_number=' || o_orderkey END AS filing_url,
CASE o_orderkey % 4 WHEN 1 THEN 'https://data.ny.gov/d/4j2b-6a2j' WHEN 2 THEN 'https://seethemoney.az.gov/' END AS dataset_url, CASE WHEN o_orderkey % 2 = 0 THEN 'https://www.fec.gov/data/filings/?file_number=' || o_custkey END AS federal FROM orders""")
def record_links(spark, sf):
    """Pages of records and of data; none without the id that they need."""
    o, k, c, _, _ = _orders(spark, sf)
    source = F.when(k % 4 == 0, "cal-access").when(k % 4 == 1, "NYSBOE").when(k % 4 == 2, "AZ-SOS").otherwise("?")
    rows = o.select(k, links.source_links(source, F.when(k % 3 > 0, c.cast("string")).otherwise(""), k.cast("string")).alias("l"), links.federal_filing(F.when(k % 2 == 0, F.concat(c, F.lit(" "))).otherwise("n/a")).alias("federal"))
    return rows.select("o_orderkey", "l.*", "federal")


@query("""SELECT o_custkey, n, status FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(*) > 1) JOIN (SELECT c_custkey AS o_custkey, CASE c_custkey % 2 WHEN 0 THEN 'EXCLUDED' ELSE 'CONFIRMED' END AS status FROM customer WHERE c_custkey % 3 = 0) USING (o_custkey)""")
def wide_overrides(spark, sf):
    """Overrides that govern more than one live row."""
    k = F.col("c_custkey")
    over = _t(spark, sf, "customer").where(k % 3 == 0).select(k.alias("o_custkey"), F.when(k % 2 == 0, "EXCLUDED").otherwise("CONFIRMED").alias("status"))
    rows = _t(spark, sf, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "P", "x").alias("superseded_by"))
    return checks.wide(over, rows, ["o_custkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 > 0")
def orphaned_verdicts(spark, sf):
    """Verdicts that stand on the queue alone."""
    k = F.col("c_custkey")
    people = _t(spark, sf, "customer").select(k)
    return checks.orphaned_verdicts(people.withColumn("resolution", F.when(k % 2 == 0, "DISCARDED")), people.where(k % 3 == 0), ["c_custkey"]).select("c_custkey")


@query("""WITH w AS (SELECT c_custkey, DATE '2001-01-01' AS last_run FROM customer UNION ALL SELECT user_id, CAST(ts AS DATE) FROM events WHERE event_id % 3 > 0 AND event_id % 5 > 0)
SELECT c_custkey, max(last_run) AS last_run, greatest(max(last_run) - 550, DATE '2000-01-01') AS min_date FROM w GROUP BY 1""", ("last_run", "min_date"))
def watermarks(spark, sf):
    """Where each entity was last read, and where its next run starts: runs from stored files or cut short move nothing."""
    start = _t(spark, sf, "customer").select("c_custkey", F.lit("2001-01-01").cast("date").alias("last_run"))
    e = F.col("event_id")
    runs = _t(spark, sf, "events").select(F.col("user_id").alias("c_custkey"), F.col("ts").cast("date").alias("run_date"), (e % 3 == 0).alias("from_raw"), F.when(e % 5 == 0, True).alias("truncated"))
    after = incremental.watermarks_after(start, runs, "c_custkey")
    return after.join(incremental.read_from(after, "c_custkey"), "c_custkey")


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'Nay' WHEN event_id % 4 = 1 THEN 'Yea' END AS a, CASE WHEN event_id % 4 IN (0, 2) THEN 'Yea' END AS b FROM events WHERE event_id % 4 < 3")
def roll_call_differences(spark, sf):
    """Positions in which two readings of a roll call differ."""
    e = F.col("event_id")
    rows = _t(spark, sf, "events").select(e)
    one = rows.where(e % 4 != 2).withColumn("position", F.when(e % 4 == 0, "Nay").otherwise("Yea"))
    return checks.differing_positions(one, rows.where(e % 4 != 1).withColumn("position", F.lit("Yea")), ["event_id"])


_OWNERS = [("field", None, ["Ann Field", "FIELD, ANN", "Field, Bob J."]), ("stone", None, ["Kenneth Stone", "Stone"]), ("kin", "field", ["Zoe Vale"])]
_ASKERS = "slug string, parent_slug string, name_variants array<string>"


@query("""WITH p AS (SELECT o_orderkey, ['ann', 'bob', 'ken', 'kenneth', 'zoe', ''][o_orderkey % 6 + 1] AS f, CASE o_custkey % 3 WHEN 0 THEN 'field' WHEN 1 THEN 'stone' ELSE 'vale' END AS l FROM orders)
SELECT 'NY' AS source, o_orderkey, l AS owner_slug FROM p WHERE (l = 'field' AND f IN ('ann', 'bob')) OR (l = 'stone' AND f = 'kenneth') UNION ALL
SELECT 'WA', o_orderkey, l FROM p WHERE (l = 'field' AND f IN ('ann', 'bob')) OR (l = 'stone' AND f = 'kenneth') UNION ALL
SELECT 'AZ', o_orderkey, l FROM p WHERE (l = 'field' AND f IN ('ann', 'bob', '')) OR (l = 'stone' AND f IN ('ken', 'kenneth', ''))""")
def source_predicates(spark, sf):
    """What the sources that are searched by name would give: by parts (NY), by prefix (WA), by compatible first names (AZ)."""
    o, k, c, _, _ = _orders(spark, sf)
    first = F.element_at(F.array(*map(F.lit, ("Ann", "BOB", "Ken", "Kenneth", "Zoe", ""))), (k % 6).cast("int") + 1)
    last = F.when(c % 3 == 0, "FIELD").when(c % 3 == 1, "Stone").otherwise("Vale")
    registry = spark.createDataFrame(_OWNERS, _ASKERS)
    ny = states.asked_by_parts(o.select(k, last.alias("flng_ent_last_name"), first.alias("flng_ent_first_name")), registry)
    wa = states.asked_by_prefix(o.select(k, F.concat(last, F.lit(" "), first, F.when(first != "", " Q").otherwise("")).alias("contributor_name")), registry)
    az = states.asked_by_entity(o.select(k, F.concat(last, F.lit(", "), first).alias("EntityLastName")), registry)
    return ny.select(F.lit("NY").alias("source"), "o_orderkey", "owner_slug").union(wa.select(F.lit("WA"), "o_orderkey", "owner_slug")).union(az.select(F.lit("AZ"), "o_orderkey", "owner_slug"))


@query("""SELECT 'e' || c_custkey AS slug, 'Ann ' || c_name AS variant FROM customer WHERE c_custkey % 4 > 0 UNION ALL SELECT 'e' || c_custkey, c_name || ', Ann' FROM customer WHERE c_custkey % 3 = 0""")
def name_variants(spark, sf):
    """Variants that differ in punctuation and case only are asked for once; blank ones and those of entities without names never."""
    k, name = F.col("c_custkey"), F.col("c_name")
    plain = F.concat(F.lit("Ann "), name)
    same = F.array(plain, F.lower(F.concat(F.lit("ann  "), name, F.lit("."))), F.upper(plain))
    turned = F.when(k % 3 == 0, F.array(F.concat(name, F.lit(", Ann")), F.upper(F.concat(name, F.lit(" ANN"))))).otherwise(F.array(F.lit(" . ")))
    variants = F.concat(F.when(k % 4 > 0, same).otherwise(F.array(F.lit(None).cast("string"), F.lit(""))), turned)
    return states.distinct_variants(_t(spark, sf, "customer").select(F.concat(F.lit("e"), k).alias("slug"), F.lit(None).cast("string").alias("parent_slug"), variants.alias("name_variants")))


@query("""WITH v AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders) SELECT outcome, count(*) AS n, CAST(sum(a) AS DOUBLE) AS total FROM (SELECT a, CASE WHEN k % 10 = 0 THEN 'inserted' WHEN k % 10 = 1 THEN 'kept' WHEN k % 5 = 2 OR k % 7 = 3 OR k % 11 = 4 THEN 'superseded' ELSE 'unchanged' END AS outcome FROM v) GROUP BY 1""")
def merge_state_outcomes(spark, sf):
    """State rows know no collision: any change of substance supersedes, even of all of it."""
    k, usd = F.col("o_orderkey"), F.col("o_totalprice").cast(money.MONEY)
    row = _t(spark, sf, "orders").select(k.alias("state_txn_id"), usd.alias("amount"), F.col("o_orderdate").cast("date").cast("string").alias("date"), F.col("o_custkey").cast("string").alias("recipient_filer_id"), F.lit(None).cast("string").alias("source_filing_id"))
    t = F.col("state_txn_id")
    new = row.where(t % 10 != 1).withColumns({"amount": F.when(t % 5 == 2, F.col("amount") + 1).otherwise(F.col("amount")).cast(money.MONEY), "recipient_filer_id": F.when(t % 7 == 3, "X").otherwise(F.col("recipient_filer_id")), "source_filing_id": F.when(t % 11 == 4, "F").otherwise("")})
    events = merge.merge_events(row.where(t % 10 != 0), new, ["state_txn_id"], {"amount": "money", "date": "text", "recipient_filer_id": "text", "source_filing_id": "text"})
    usd = F.coalesce("cur.amount", "inc.amount")
    return events.groupBy("outcome").agg(F.count("*").alias("n"), F.sum(usd).cast("double").alias("total"))


@query("SELECT count(*) AS n_runs, CAST(min(ts) AS DATE) AS earliest_run, CAST(max(ts) AS DATE) AS latest_run, sum(event_id % 9)::BIGINT AS total_records_fetched, 0::BIGINT AS total_api_calls, count(*) FILTER (event_id % 7 = 0) AS n_dry_runs FROM events", ("earliest_run", "latest_run"))
def run_totals(spark, sf):
    e = F.col("event_id")
    runs = _t(spark, sf, "events").select(F.col("ts").cast("date").alias("started_at"), (e % 9).alias("records_fetched"), F.lit(None).cast("long").alias("api_calls"), F.when(e % 7 == 0, True).alias("dry_run"))
    return reports.run_totals(runs)


@query("SELECT s AS o_orderstatus, n AS n_a, n - CASE s WHEN 'F' THEN 1 ELSE 0 END AS n_b, s <> 'F' AS same FROM (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1)")
def export_freshness(spark, sf):
    """Whether exports, written and read back, still agree with the table by count and dollars to the cent: the one of F was written before its first row came."""
    from ..operators.shared import folder

    orders = _t(spark, sf, "orders").select("o_orderstatus", "o_orderkey", F.col("o_totalprice").cast(money.MONEY).alias("amount"))
    least = orders.where("o_orderstatus = 'F'").agg(F.min("o_orderkey").alias("least"))
    then = orders.join(F.broadcast(least), (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") == F.col("least")), "left_anti")
    written = sinks.export_counted(then, f"{folder(spark)}/export-{uuid.uuid4().hex}", "o_orderstatus", "amount")
    return checks.exports_agree(orders, written, "o_orderstatus", "amount").select("o_orderstatus", "n_a", "n_b", "same")
