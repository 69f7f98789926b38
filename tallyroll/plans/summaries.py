"""Queries of the composite reports: orders are contributions of entities (customers) in households of five."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import money
from ..functions.text import committee_bucket, party_bucket
from ..operators import reports
from .queries import _t, query

_K = "o_custkey"
_KIND = ("X", "q", "H", "?", "")
_PARTY = ("DEM", "Republican", "gop ", "Green", "R", "Independent", "LIB", "DFL")


def _at(values: tuple[str, ...], by: str) -> str:
    return f"CASE {by} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


_CPI = "coalesce((SELECT f FROM (VALUES " + ", ".join(f"({y}, CAST({money.CPI[money.BASE_YEAR] / v!r} AS DOUBLE))" for y, v in money.CPI.items()) + ") t(y, f) WHERE y = cycle), 1)"
#: orders as contributions: entity e<n>, owner the multiple of five at or below it, one committee in eleven unknown.
_GIFTS = f"""(SELECT *, CAST(amount AS DOUBLE) * {_CPI} AS amount_real FROM (SELECT o_orderkey AS txn, 'e' || {_K} AS entity_slug, 'e' || ({_K} - {_K} % 5) AS owner, CASE WHEN {_K} % 5 = 0 THEN 'owner' WHEN {_K} % 5 = 1 THEN 'spouse' ELSE 'child' END AS entity_kind,
CASE WHEN {_K} % 5 > 0 THEN 'e' || ({_K} - {_K} % 5) END AS parent_owner_slug, CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' ELSE 'PROBABLE' END AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS date,
CAST(year(CAST(o_orderdate AS DATE)) + year(CAST(o_orderdate AS DATE)) % 2 AS INTEGER) AS cycle, CASE o_orderkey % 8 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' WHEN 2 THEN 'REP' WHEN 3 THEN 'GRE' WHEN 5 THEN 'IND' WHEN 6 THEN 'LIB' ELSE 'OTH' END AS party,
CASE WHEN o_orderkey % 11 > 0 THEN 'C' || (o_custkey * 7 + o_orderkey) % 40 END AS committee_id, CASE o_orderkey % 5 WHEN 0 THEN 'Party' WHEN 1 THEN 'PAC' WHEN 2 THEN 'Candidate' ELSE 'Other' END AS recipient_type FROM orders WHERE o_orderstatus <> 'P'))"""


def gifts(spark: SparkSession, sf: str) -> DataFrame:
    k, o = F.col("o_custkey"), F.col("o_orderkey")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (o % len(values)).cast("int") + 1)
    house = F.concat(F.lit("e"), k - k % 5)
    date = F.col("o_orderdate").cast("date")
    committee = F.when(o % 11 > 0, F.concat(F.lit("C"), (k * 7 + o) % 40))
    return _t(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        o.alias("txn"), F.concat(F.lit("e"), k).alias("entity_slug"), F.when(k % 5 == 0, "owner").when(k % 5 == 1, "spouse").otherwise("child").alias("entity_kind"), F.when(k % 5 > 0, house).alias("parent_owner_slug"),
        F.when(F.col("o_orderstatus") == "F", "CONFIRMED").otherwise("PROBABLE").alias("status"), F.col("o_totalprice").cast(money.MONEY).alias("amount"), date.alias("date"), (F.year(date) + F.year(date) % 2).cast("int").alias("election_cycle"),
        party_bucket(pick(_PARTY)).alias("party"), committee.alias("committee_id"), F.concat(F.lit("Committee "), committee).alias("committee_name"), committee_bucket(pick(_KIND)).alias("recipient_type"),
        F.when(o % 7 == 6, "Homemaker ").when(o % 7 == 5, "InVestor").otherwise(F.concat(F.lit("Employer "), o % 7)).alias("contributor_employer"), F.concat(F.lit("City "), k % 3).alias("contributor_city"),
    )


_TIERS = ", ".join(f"count(*) FILTER (status = '{t}') AS n_{t.lower()}, CAST(coalesce(sum(amount) FILTER (status = '{t}'), 0) AS DOUBLE) AS usd_{t.lower()}" for t in reports.TIERS)
_USD = "CAST(sum(amount) AS DOUBLE) AS total_amount, round(sum(amount_real), 2) AS total_amount_real"
_OWN = "FILTER (entity_slug = owner)"


@query(f"""SELECT owner, count(*) AS n_total, {_USD}, {_TIERS}, count(*) {_OWN} AS n_owner_only, CAST(coalesce(sum(amount) {_OWN}, 0) AS DOUBLE) AS owner_only_amount, round(coalesce(sum(amount_real) {_OWN}, 0), 2) AS owner_only_amount_real,
count(DISTINCT entity_slug) FILTER (entity_slug <> owner) AS household_members, count(DISTINCT coalesce(committee_id, '_unknown')) AS distinct_recipients, count(DISTINCT cycle) AS n_cycles, min(date) AS earliest_date, max(date) AS latest_date,
coalesce(any_value(n_runs), 0) AS n_runs, CAST(any_value(last_run_id) AS VARCHAR) AS last_run_id FROM {_GIFTS} LEFT JOIN (SELECT 'e' || user_id AS owner, count(*) AS n_runs, max_by(event_id, (ts, event_id)) AS last_run_id FROM events GROUP BY 1) USING (owner) GROUP BY owner""", ("earliest_date", "latest_date"))
def owner_summary(spark, sf):
    runs = _t(spark, sf, "events").select(F.concat(F.lit("e"), "user_id").alias("entity_slug"), F.col("ts").alias("started_at"), F.col("event_id").alias("run_id"))
    return reports.owner_summary(gifts(spark, sf), runs).drop("last_run_at").withColumn("last_run_id", F.col("last_run_id").cast("string"))


@query(f"SELECT owner, entity_slug, entity_kind, count(*) AS n_total, {_USD}, {_TIERS} FROM {_GIFTS} WHERE entity_slug <> owner GROUP BY ALL")
def household_members(spark, sf):
    return reports.household_members(gifts(spark, sf))


@query(f"""SELECT txn, owner, round(amount_real, 2) AS amount_real, party, CASE txn % 3 WHEN 0 THEN 'Candidate' WHEN 1 THEN 'PAC' ELSE 'Other' END AS recipient_type, CASE WHEN txn % 4 > 0 THEN 'https://www.fec.gov/data/filings/?file_number=' || txn END AS filing_url FROM {_GIFTS}""")
def display_rows(spark, sf):
    t = F.col("txn")
    rows = gifts(spark, sf).withColumns({"committee_type": F.when(t % 3 == 0, " s").when(t % 3 == 1, "W"), "filing_id": F.when(t % 4 > 0, t.cast("string")).otherwise("FEC-PRE2006-NOID")})
    return reports.display_rows(rows).select("txn", "owner", "amount_real", "party", "recipient_type", "filing_url")


@query(f"SELECT entity_slug, entity_kind, count(*) AS n_total, CAST(sum(amount) AS DOUBLE) AS total_amount, {_TIERS} FROM {_GIFTS} WHERE owner = 'e10' GROUP BY ALL")
def household_view(spark, sf):
    return reports.household_view(gifts(spark, sf), "e10")


@query(f"""SELECT owner, CAST(r AS INTEGER) AS rank, committee_id, 'Committee ' || nullif(committee_id, '_unknown') AS committee_name, party, CAST(total AS DOUBLE) AS total_amount, total_amount_real, n FROM (
SELECT *, row_number() OVER (PARTITION BY owner ORDER BY total DESC, committee_id) AS r FROM (SELECT owner, coalesce(committee_id, '_unknown') AS committee_id, sum(amount) AS total, round(sum(amount_real), 2) AS total_amount_real, count(*) AS n,
max_by(party, (date, status, coalesce(committee_id, ''), party)) AS party FROM {_GIFTS} GROUP BY 1, 2)) WHERE r <= 8""")
def owner_top_recipients(spark, sf):
    return reports.top_recipients(gifts(spark, sf))


@query(f"SELECT count(*) AS n_donations, {_USD}, {_TIERS}, count(DISTINCT owner) AS n_owners, count(DISTINCT cycle) AS n_cycles, min(date) AS earliest_date, max(date) AS latest_date FROM {_GIFTS}", ("earliest_date", "latest_date"))
def league_totals(spark, sf):
    return reports.league(gifts(spark, sf))


@query(f"""SELECT committee_id, 'Committee ' || committee_id AS committee_name, max_by(party, (date, party)) AS party, coalesce(min_by(recipient_type, (date, recipient_type)) FILTER (recipient_type <> 'Other'), 'Other') AS recipient_type, {_USD}, count(*) AS n_donations,
count(DISTINCT owner) AS n_owners, string_agg(DISTINCT CAST(cycle AS VARCHAR), ',' ORDER BY CAST(cycle AS VARCHAR)) AS cycles, min(date) AS earliest_date, max(date) AS latest_date FROM {_GIFTS} WHERE committee_id IS NOT NULL GROUP BY 1""", ("earliest_date", "latest_date"))
def recipient_pages(spark, sf):
    return reports.recipients(gifts(spark, sf))


@query(f"SELECT owner, string_agg(cycle || '/' || party || '=' || printf('%.2f', usd) || 'x' || n, ';' ORDER BY cycle, party) AS cells FROM (SELECT owner, cycle, party, CAST(sum(amount) AS DOUBLE) AS usd, count(*) AS n FROM {_GIFTS} GROUP BY 1, 2, 3) GROUP BY 1")
def owner_cycle_parties(spark, sf):
    rows = reports.by_party(reports.with_real(gifts(spark, sf)), "owner", "election_cycle", "party")
    cell = lambda c: F.concat(c["election_cycle"], F.lit("/"), c["party"], F.lit("="), F.format_string("%.2f", c["usd"]), F.lit("x"), c["n"])
    return rows.select("owner", F.array_join(F.transform("cells", cell), ";").alias("cells"))


_STATE = f"""(SELECT *, coalesce(nullif(f_name, ''), nullif(recipient_name, ''), '(recipient unidentified)') AS recipient, jurisdiction || ':S:' || coalesce(nullif(recipient_filer_id, ''), 'name:' || coalesce(nullif(f_name, ''), nullif(recipient_name, ''), '(recipient unidentified)')) AS recipient_key
FROM (SELECT g.*, CASE txn % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'IL' END AS jurisdiction, CASE WHEN txn % 4 > 0 THEN 'F' || txn % 30 ELSE '' END AS recipient_filer_id, CASE WHEN txn % 8 > 0 THEN 'As filed ' || txn % 9 ELSE '' END AS recipient_name FROM {_GIFTS} g) g
LEFT JOIN (SELECT 'F' || s_suppkey AS filer_id, CASE s_suppkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'IL' END AS f_j, CASE WHEN s_suppkey % 6 > 0 THEN s_name ELSE '' END AS f_name FROM supplier) f ON filer_id = recipient_filer_id AND f_j = jurisdiction)"""


def state_gifts(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("txn")
    state = lambda k: F.when(k % 3 == 0, "CA").when(k % 3 == 1, "TX").otherwise("IL")
    rows = gifts(spark, sf).withColumns({"jurisdiction": state(t), "source": F.lit("S"), "recipient_filer_id": F.when(t % 4 > 0, F.concat(F.lit("F"), t % 30)).otherwise(""), "recipient_name": F.when(t % 8 > 0, F.concat(F.lit("As filed "), t % 9)).otherwise("")})
    none = F.lit(None).cast("string")
    k = F.col("s_suppkey")
    filers = _t(spark, sf, "supplier").select(state(k).alias("jurisdiction"), F.lit("S").alias("source"), F.concat(F.lit("F"), k).alias("filer_id"), F.when(k % 6 > 0, F.col("s_name")).otherwise("").alias("name"), none.alias("filer_type"), none.alias("party"), none.alias("office"))
    return reports.state_rows(rows.drop("recipient_type").withColumns({"recipient_type": none, "recipient_party": F.col("party"), "recipient_office": none}).drop("party"), filers)


_N = "count(*) FILTER (status = 'CONFIRMED') AS n_confirmed, count(*) FILTER (status = 'PROBABLE') AS n_probable"


@query(f"SELECT entity_slug, {_N}, {_USD}, string_agg(DISTINCT jurisdiction, ',' ORDER BY jurisdiction) AS jurisdictions, count(DISTINCT recipient_key) AS n_recipients, string_agg(DISTINCT CAST(cycle AS VARCHAR), ',' ORDER BY CAST(cycle AS VARCHAR)) AS cycles FROM {_STATE} GROUP BY 1")
def state_owners(spark, sf):
    return reports.state_owners(state_gifts(spark, sf))


@query(f"SELECT jurisdiction, {_N}, {_USD}, count(DISTINCT entity_slug) AS n_owners FROM {_STATE} GROUP BY 1")
def state_jurisdictions(spark, sf):
    return reports.state_jurisdictions(state_gifts(spark, sf))


@query(f"SELECT recipient_key, jurisdiction, max_by(recipient, (date, recipient)) AS recipient, {_N}, {_USD}, count(DISTINCT entity_slug) AS n_owners, min(date) AS first_date, max(date) AS last_date FROM {_STATE} GROUP BY 1, 2", ("first_date", "last_date"))
def state_recipients(spark, sf):
    return reports.state_recipients(state_gifts(spark, sf)).drop("source", "recipient_type", "party", "office")


@query(f"""SELECT recipient_key, CAST(r AS INTEGER) AS rank, entity_slug, CAST(total AS DOUBLE) AS total_amount FROM (SELECT *, row_number() OVER (PARTITION BY recipient_key ORDER BY total DESC, entity_slug) AS r
FROM (SELECT recipient_key, entity_slug, sum(amount) AS total FROM {_STATE} GROUP BY 1, 2)) WHERE r <= 5""")
def state_top_donors(spark, sf):
    return reports.state_top(state_gifts(spark, sf), "recipient_key", "entity_slug", 5)


@query("""WITH r AS (SELECT 'e' || user_id AS owner_slug, event_type AS jurisdiction, max_by({'n': event_id, 'c': event_id % 3, 'p': event_id % 2}, (ts, event_id)) AS l FROM events GROUP BY 1, 2),
x AS (SELECT DISTINCT 'e' || user_id AS owner_slug, 'error' AS jurisdiction, true AS out FROM events WHERE user_id % 7 = 0)
SELECT owner_slug, jurisdiction, CASE WHEN out THEN 'opted out' WHEN l.c + l.p > 0 THEN 'found' ELSE 'searched' END AS state, l.n AS scanned FROM r FULL JOIN x USING (owner_slug, jurisdiction) WHERE owner_slug IN (SELECT 'e' || c_custkey FROM customer)""")
def coverage_matrix(spark, sf):
    e = _t(spark, sf, "events").withColumn("owner_slug", F.concat(F.lit("e"), "user_id"))
    runs = e.select("owner_slug", F.col("event_type").alias("jurisdiction"), F.col("ts").alias("started_at"), F.col("event_id").alias("scanned"), (F.col("event_id") % 3).alias("confirmed"), (F.col("event_id") % 2).alias("probable"), F.lit(0).alias("uncertain"))
    opted = e.where("user_id % 7 = 0").select("owner_slug", F.lit("error").alias("jurisdiction"))
    owners = _t(spark, sf, "customer").select(F.concat(F.lit("e"), "c_custkey").alias("owner_slug"))
    return reports.coverage_matrix(owners, runs.select("jurisdiction").union(opted.select("jurisdiction")).distinct(), runs, opted).select("owner_slug", "jurisdiction", "state", "scanned")


@query("""SELECT entity_slug, CASE txn % 7 WHEN 6 THEN 'HOMEMAKER' WHEN 5 THEN 'INVESTOR' ELSE 'EMPLOYER ' || txn % 7 END AS value, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total_amount, 'City ' || any_value(c) AS cities FROM (SELECT 'e' || o_custkey AS entity_slug, o_orderkey AS txn, o_custkey % 3 AS c,
CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders WHERE o_orderstatus = 'O') GROUP BY 1, 2 HAVING count(*) >= 2""")
def audit_by_employer(spark, sf):
    return reports.by_signal_field(gifts(spark, sf), "PROBABLE", "contributor_employer", 2)


@query("""SELECT entity_slug, 'EMPLOYER ' || e AS value, n FROM (SELECT 'e' || o_custkey AS entity_slug, o_custkey, o_orderkey % 7 AS e, count(*) AS n FROM orders WHERE o_orderstatus = 'O' GROUP BY ALL HAVING count(*) >= 2) WHERE e < 5 AND (o_custkey % 3 = 0 OR e <> o_custkey % 7)""")
def audit_suggestions(spark, sf):
    """Generic employers name nobody; a third of the owners have no entry in the registry."""
    k = F.col("c_custkey")
    none = F.array().cast("array<string>")
    registry = _t(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.concat(F.lit("e"), k).alias("slug"), F.array(F.concat(F.lit("employer "), k % 7)).alias("employers"), none.alias("strong_employers"), none.alias("negative_employers"))
    return reports.suggestions(gifts(spark, sf), registry).select("entity_slug", "value", "n")


@query(f"SELECT txn, entity_slug, status FROM {_GIFTS} ORDER BY md5('7:' || txn), txn LIMIT 20")
def audit_sample(spark, sf):
    """Twenty contributions at random, the same ones in each run."""
    return reports.sampled(gifts(spark, sf).select("txn", "entity_slug", "status"), "txn", 20, 7)


@query("SELECT 'e' || user_id AS entity_slug, count(*) AS items, count(*) FILTER (event_type = 'purchase') AS settled, round(count(*) FILTER (event_type = 'purchase') * 100.0 / count(*), 1) AS percent FROM events GROUP BY 1")
def queue_adjudicated(spark, sf):
    queue = _t(spark, sf, "events").select(F.concat(F.lit("e"), "user_id").alias("entity_slug"), F.when(F.col("event_type") == "purchase", "done").alias("resolution"))
    return reports.adjudicated(queue).withColumn("percent", F.col("percent").cast("double"))


@query(f"""WITH v AS (SELECT event_type AS bill, owner, txn, min_by(status, (status, user_id)) AS status, max(amount) AS amount FROM {_GIFTS} JOIN events ON user_id = txn % 500 GROUP BY 1, 2, 3)
SELECT bill, count(*) AS gifts, count(DISTINCT owner) AS owners, CAST(sum(amount) AS DOUBLE) AS total_amount, {_TIERS} FROM v GROUP BY 1""")
def bill_briefs(spark, sf):
    votes = _t(spark, sf, "events").select(F.col("event_type").alias("bill"), F.col("user_id").alias("bioguide"))
    rows = reports.with_real(gifts(spark, sf)).withColumn("bioguide", F.col("txn") % 500).join(votes, "bioguide")
    return reports.brief(rows, ["bill"], "owner", "txn")


@query("SELECT count(*) AS candidates, count(s_suppkey) AS resolved, count(*) - count(s_suppkey) AS unresolved, round(count(s_suppkey) * 100.0 / count(*), 1) AS percent FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 10 > 0) LEFT JOIN supplier ON s_suppkey = o_custkey")
def legislation_coverage(spark, sf):
    given = _t(spark, sf, "orders").select(F.when(F.col("o_custkey") % 10 > 0, F.col("o_custkey").cast("string")).otherwise("").alias("candidate_id"))
    cross = _t(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("candidate_id"), F.col("s_suppkey").alias("bioguide"))
    return reports.legislation_coverage(given, cross.union(cross)).withColumn("percent", F.col("percent").cast("double"))


@query("SELECT user_id AS bioguide, count(*) AS positions FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def missing_voters(spark, sf):
    return reports.missing_voters(_t(spark, sf, "events").select(F.col("user_id").alias("bioguide")), _t(spark, sf, "supplier").select(F.col("s_suppkey").alias("bioguide")))


_SUMS = "count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total_amount, CAST(coalesce(sum(amount) FILTER (status = 'CONFIRMED'), 0) AS DOUBLE) AS confirmed_amount, min(date) AS earliest_date, max(date) AS latest_date"
_NONE = "CAST(NULL AS BIGINT)"


@query(f"""WITH g AS (SELECT * REPLACE (coalesce(committee_id, '_unknown') AS committee_id) FROM {_GIFTS})
SELECT 'league' AS section, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS INTEGER) AS election_cycle, CAST(NULL AS VARCHAR) AS party, CAST(NULL AS VARCHAR) AS committee_id, {_SUMS}, {_NONE} AS members, {_NONE} AS recipients, count(DISTINCT owner) AS owners, count(DISTINCT cycle) AS cycles FROM g
UNION ALL SELECT 'owner', owner, NULL, NULL, NULL, {_SUMS}, count(DISTINCT entity_slug) FILTER (entity_slug <> owner), count(DISTINCT committee_id), NULL, count(DISTINCT cycle) FROM g GROUP BY owner
UNION ALL SELECT 'cell', owner, cycle, party, NULL, {_SUMS}, NULL, NULL, NULL, NULL FROM g GROUP BY owner, cycle, party
UNION ALL SELECT 'recipient', NULL, NULL, NULL, committee_id, {_SUMS}, NULL, NULL, count(DISTINCT owner), count(DISTINCT cycle) FROM g GROUP BY committee_id""", ("earliest_date", "latest_date"))
def payload_sections(spark, sf):
    """League, owners, their cells by cycle and party, and recipients, from one scan."""
    return reports.payload(gifts(spark, sf))
