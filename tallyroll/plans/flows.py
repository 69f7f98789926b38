"""Queries of the state flow and of the reports that are put together of many parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, policy, reports, validation
from ..sources.states import SOURCES
from ..streaming import state_flow, store
from .queries import _t, query
from .runs import _root


def _owners(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as owners n<k>, named Ann Nk, at home in Town<k>, Ohio, under a ZIP code of their own."""
    k, none = F.col("n_nationkey"), F.lit(None).cast("string")
    words = lambda *x: F.array(*x).cast("array<string>")
    rows = _t(spark, sf, "nation").select(
        F.concat(F.lit("n"), k).alias("slug"), F.lit("owner").alias("kind"), none.alias("parent_slug"), F.lit(0).alias("position"), words(F.concat(F.lit("Ann N"), k)).alias("name_variants"), words(F.concat(F.lit("Town"), k)).alias("cities"), words(F.lit("OH")).alias("states"),
        *[words().alias(x) for x in ("employers", "occupations", "strong_employers")], words(F.format_string("4%04d", k.cast("int"))).alias("strong_zips"), words().alias("negative_employers"), F.lit(False).alias("mrs_is_self"), F.lit(False).alias("lone_city_state_is_weak"),
    )
    return spark.createDataFrame([], classify.REGISTRY).unionByName(rows)


# an owner is shown every record whose last name holds theirs: n1 those of n10 to n19 as well
_SHOWN = """(SELECT o_orderkey AS o, o_custkey % 30 AS k, 'n' || o_custkey % 30 AS slug, 'MD:MD-SBE:R' || o_orderkey % 4 || ':G' || o_orderkey AS txn, CAST(o_totalprice AS DECIMAL(18,2)) AS usd, o_orderkey % 10 AS filer,
CASE WHEN o_orderkey % 17 = 0 THEN 'EXCLUDED' WHEN o_orderkey % 17 = 1 OR o_orderkey % 3 = 0 THEN 'CONFIRMED' WHEN o_orderkey % 2 = 0 THEN 'PROBABLE' ELSE 'UNCERTAIN' END AS status,
CASE WHEN o_orderkey % 13 = 0 THEN 'unparseable contribution date' WHEN o_orderkey % 11 = 0 THEN 'unparseable contribution amount' END AS gate FROM orders WHERE o_orderkey % 50 > 0)"""
_COUNTS = {"scanned": "slug = 'n' || n_nationkey OR slug LIKE 'n' || n_nationkey || '_'", "excluded": "status = 'EXCLUDED'", "skipped_no_date": "status <> 'EXCLUDED' AND gate LIKE '%date'", "skipped_no_amount": "status <> 'EXCLUDED' AND gate LIKE '%amount'"} | {s: f"status = '{s.upper()}' AND gate IS NULL" for s in ("confirmed", "probable", "uncertain")} | {"superseded": "r.k = 1 AND o % 7 = 0 AND status IN ('CONFIRMED', 'PROBABLE') AND gate IS NULL"}


@query(f"""WITH all_ AS {_SHOWN}, a AS (SELECT * FROM all_ WHERE k < 20), g AS (SELECT * FROM a WHERE status IN ('CONFIRMED', 'PROBABLE') AND gate IS NULL)
SELECT 'live' AS part, txn AS name, slug AS owner, status AS what, CAST(usd + CASE WHEN o % 7 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS amount FROM g
UNION ALL SELECT 'old', txn, slug, 'portal restatement: amount', CAST(usd AS DOUBLE) FROM g WHERE o % 7 = 0
UNION ALL SELECT 'queue', txn, slug, coalesce(gate, 'name only'), NULL FROM a WHERE status <> 'EXCLUDED' AND (gate IS NOT NULL OR status = 'UNCERTAIN' AND o % 19 > 0)
UNION ALL SELECT DISTINCT 'filer', 'F' || filer, NULL, 'Committee ' || filer, NULL FROM g
UNION ALL SELECT 'events ' || outcome, NULL, NULL, NULL, CAST(n AS DOUBLE) FROM (SELECT 'inserted' AS outcome, count(*) AS n FROM g UNION ALL SELECT 'superseded', count(*) FROM g WHERE o % 7 = 0 UNION ALL SELECT 'unchanged', count(*) FROM g WHERE o % 7 > 0)
UNION ALL SELECT 'ledger ' || r.k, s.what, 'n' || n_nationkey, NULL, CAST(count(o) FILTER (CASE s.what {" ".join(f"WHEN '{k}' THEN {v}" for k, v in _COUNTS.items())} END) AS DOUBLE)
  FROM nation CROSS JOIN (VALUES (0), (1)) r(k) CROSS JOIN (VALUES {", ".join(f"('{k}')" for k in _COUNTS)}) s(what) LEFT JOIN all_ ON slug = 'n' || n_nationkey OR s.what = 'scanned' WHERE n_nationkey < 20 GROUP BY r.k, s.what, n_nationkey""")
def state_runs(spark, sf):
    """Two runs over one state's raw rows to donations, events, filers, queue and ledger; one record in seven is restated in the second, five owners opted out."""
    o, k = F.col("o_orderkey"), F.col("o_custkey") % 30
    orders = _t(spark, sf, "orders")
    slug, txn = F.concat(F.lit("n"), k), F.concat(F.lit("MD:MD-SBE:R"), o % 4, F.lit(":G"), o)

    def landed(run: int) -> DataFrame:
        usd = F.col("o_totalprice").cast("decimal(18,2)") + F.when((o % 7 == 0) & F.lit(run == 1), 1).otherwise(0)
        text = {
            "contributorName": F.concat(F.lit("N"), k, F.lit(", Ann")), "contributorCity": F.when(o % 2 == 0, F.concat(F.lit("Town"), k)), "contributorState": F.when(o % 2 == 0, "OH"), "contributorZipCode": F.when(o % 3 == 0, F.format_string("4%04d", k.cast("int"))),
            "filingEntityId": F.concat(F.lit("F"), o % 10), "committeeName": F.concat(F.lit("Committee "), o % 10), "committeeType": F.lit("Candidate"), "transactionDate": F.when(o % 13 > 0, F.col("o_orderdate").cast("date").cast("string")), "transactionAmount": F.when(o % 11 > 0, usd.cast("string")),
            "transactionGuid": F.when(o % 50 > 0, F.concat(F.lit("G"), o)), "reportGuid": F.concat(F.lit("R"), o % 4), "_path": F.lit(f"run{run}"), "_block": F.lit("0"), "_at": o.cast("string"),
        }
        # each row stands in the file twice, as in extracts that repeat amended reports
        return orders.select(*[v.cast("string").alias(n) for n, v in text.items()]).withColumn("_at", F.explode(F.array("_at", F.concat("_at", F.lit("b")))))

    overrides = orders.where(o % 17 < 2).select(txn.alias("state_txn_id"), slug.alias("entity_slug"), F.when(o % 17 == 0, "EXCLUDED").otherwise("CONFIRMED").alias("verdict"))
    resolutions = orders.where(o % 19 == 0).select(txn.alias("state_txn_id"), slug.alias("entity_slug"), F.lit("DISCARDED").alias("resolution"))
    registry = _owners(spark, sf)
    opted = registry.where("int(substr(slug, 2)) >= 20").select(F.col("slug").alias("owner_slug"), F.lit("MD").alias("jurisdiction"))
    root = _root(spark, "states")
    for run in range(2):
        state_flow.state_run(spark, root, run, SOURCES["MD"], landed(run), registry, overrides, resolutions, opted, F.lit(f"t{run}"), label=F.lit(f"extract {run}"), buckets=8)
    none, usd = F.lit(None).cast("string"), F.col("amount").cast("double")
    row = lambda part, name, owner, what, amount: [part.alias("part"), name.alias("name"), owner.alias("owner"), what.alias("what"), amount.cast("double").alias("amount")]
    rows = state_flow.donations(spark, root)
    live = F.col("superseded_by").isNull()
    out = rows.select(*row(F.when(live, "live").otherwise("old"), F.coalesce("superseded_by", "state_txn_id"), F.col("entity_slug"), F.when(live, F.col("status")).otherwise(F.col("superseded_reason")), usd))
    out = out.unionByName(store.read(spark, root, state_flow.QUEUE).select(*row(F.lit("queue"), F.col("state_txn_id"), F.col("entity_slug"), F.col("reason"), none)))
    out = out.unionByName(store.read(spark, root, state_flow.FILERS).select(*row(F.lit("filer"), F.col("filer_id"), none, F.col("name"), none)))
    events = store.read(spark, root, state_flow.EVENTS).groupBy("outcome").agg(F.count("*").alias("n"))
    out = out.unionByName(events.select(*row(F.concat(F.lit("events "), "outcome"), none, none, none, F.col("n"))))
    lines = store.read(spark, root, state_flow.LEDGER).select("owner_slug", "run", F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in _COUNTS])))
    return out.unionByName(lines.select(*row(F.concat(F.lit("ledger "), "run"), F.col("c"), F.col("owner_slug"), none, F.col("n"))))


# policy reports: suppliers are legislators, customers of their number their candidates, parts bills of five committees, events votes

_LEG = "(SELECT s_suppkey AS bioguide, s_name AS full_name FROM supplier)"
_GIVEN = "(SELECT o_orderkey AS txn, o_custkey AS cand, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS date, CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' ELSE 'PROBABLE' END AS status FROM orders WHERE o_orderstatus <> 'P')"
_REACHED = f"(SELECT g.*, 'e' || cand AS owner, l.* FROM {_GIVEN} g JOIN {_LEG} l ON bioguide = cand)"


def _policy(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolved gifts, entities (of which a third have no entry) and legislators."""
    none, c = F.lit(None).cast("string"), F.col("o_custkey")
    gifts = _t(spark, sf, "orders").select(
        F.concat(F.lit("e"), c).alias("entity_slug"), F.col("o_orderkey").alias("transaction_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"), F.col("o_orderdate").cast("date").alias("date"), F.when(F.col("o_orderstatus") == "F", "CONFIRMED").when(F.col("o_orderstatus") == "O", "PROBABLE").otherwise("UNCERTAIN").alias("status"),
        none.alias("recipient_committee_name"), c.cast("string").alias("recipient_candidate_id"), none.alias("recipient_candidate_name"),
    )
    k = F.col("s_suppkey")
    people = _t(spark, sf, "supplier").select(k.alias("bioguide"), F.col("s_name").alias("full_name"), F.when(k % 2 == 0, "D").otherwise("R").alias("current_party"), F.lit("OH").alias("current_state"))
    cross = _t(spark, sf, "supplier").select(k.cast("string").alias("candidate_id"), k.alias("bioguide"))
    entities = _t(spark, sf, "customer").where("c_custkey % 3 > 0").select(F.concat(F.lit("e"), "c_custkey").alias("slug"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("team"))
    return policy.resolved_donations(gifts, cross), entities, people


def _votes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    n, none = F.col("event_id"), F.lit(None).cast("string")
    e = _t(spark, sf, "events")
    votes = e.select(n.alias("vote_id"), F.concat(F.lit("b"), n % 50).alias("bill_id"), F.lit("house").alias("chamber"), F.col("ts").cast("date").alias("vote_date"), none.alias("question"), none.alias("result"), none.alias("source_url"))
    return votes, e.select(n.alias("vote_id"), (F.col("user_id") % 100 + 1).alias("bioguide"), F.when(F.col("event_type") == "click", "Yea").when(F.col("event_type") == "view", "Nay").otherwise("Not Voting").alias("position"))


def _bills(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth bill is asked about."""
    return _t(spark, sf, "part").where("p_partkey % 10 = 0").select(F.concat(F.lit("b"), F.col("p_partkey") % 50).alias("bill_id"))


_ASKED = f"(SELECT txn, owner, amount, status, date, bioguide, full_name, event_id AS vote_id, 'b' || event_id % 50 AS bill, CAST(ts AS DATE) AS vote_date, CASE event_type WHEN 'click' THEN 'Yea' WHEN 'view' THEN 'Nay' ELSE 'Not Voting' END AS position FROM {_REACHED} JOIN events ON bioguide = user_id % 100 + 1 WHERE event_id % 10 = 0)"


@query(f"SELECT owner AS owner_slug, c_name AS owner_name, txn AS transaction_id, CAST(amount AS DOUBLE) AS amount, status AS donation_status, 'direct' AS join_tier, full_name AS legislator_name, bill AS vote_bill_id, vote_id, position AS legislator_position, CAST(date_diff('day', date, vote_date) AS INTEGER) AS days_before_vote FROM {_ASKED} LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 > 0) ON owner = 'e' || c_custkey")
def policy_vote_report(spark, sf):
    """Gifts to those who voted on the bills that are asked about."""
    resolved, entities, people = _policy(spark, sf)
    rows = policy.vote_report(resolved, _bills(spark, sf), *_votes(spark, sf), entities, people)
    return rows.select("owner_slug", "owner_name", "transaction_id", F.col("amount").cast("double").alias("amount"), "donation_status", "join_tier", "legislator_name", "vote_bill_id", "vote_id", "legislator_position", "days_before_vote")


@query(f"""SELECT owner AS owner_slug, any_value(c_name) AS owner_name, any_value(c_mktsegment) AS owner_team, count(*) AS n_donations, CAST(sum(amount) AS DOUBLE) AS total_amount, CAST(sum(amount) AS DOUBLE) AS direct_amount, CAST(0 AS DOUBLE) AS indirect_authorized_amount,
CAST(coalesce(sum(amount) FILTER (position = 'Yea'), 0) AS DOUBLE) AS to_yea_amount, CAST(coalesce(sum(amount) FILTER (position = 'Nay'), 0) AS DOUBLE) AS to_nay_amount, count(DISTINCT bioguide) AS n_legislators FROM {_ASKED} LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 > 0) ON owner = 'e' || c_custkey GROUP BY owner""")
def policy_report_owners(spark, sf):
    resolved, entities, people = _policy(spark, sf)
    return policy.report_owners(policy.vote_report(resolved, _bills(spark, sf), *_votes(spark, sf), entities, people))


@query(f"""WITH h AS (SELECT 'T' || p_partkey % 5 AS committee_id, string_agg(DISTINCT 'b' || p_partkey % 50, ',' ORDER BY 'b' || p_partkey % 50) AS bill_ids FROM part WHERE p_partkey % 10 IN (0, 3) AND p_partkey % 50 % 2 = 0 GROUP BY 1)
SELECT owner AS owner_slug, txn AS transaction_id, CAST(amount AS DOUBLE) AS amount, bioguide AS legislator_bioguide, committee_id, 'Committee ' || committee_id AS committee_name, bill_ids, CASE WHEN bioguide % 4 = 0 THEN 'Chair' ELSE 'Member' END AS member_title
FROM {_REACHED} JOIN h ON committee_id IN ('T' || bioguide % 5, 'T' || bioguide % 3)""")
def policy_committee_report(spark, sf):
    """Gifts to members of committees that hold the bills: bills of another congress don't count, some members are listed twice."""
    resolved, entities, people = _policy(spark, sf)
    p, k = F.col("p_partkey"), F.col("s_suppkey")
    name = F.concat(F.lit("b"), p % 50)
    bills = _t(spark, sf, "part").where("p_partkey % 10 IN (0, 3)").select(name.alias("bill_id"), F.when(p % 50 % 2 == 0, 118).otherwise(117).alias("congress"))
    referred = _t(spark, sf, "part").select(name.alias("bill_id"), F.concat(F.lit("T"), p % 5).alias("thomas_id")).distinct()
    committees = referred.select("thomas_id").distinct().select("thomas_id", F.concat(F.lit("Committee "), "thomas_id").alias("name"), F.lit(118).alias("congress"))
    title = F.when(k % 4 == 0, "Chair").otherwise("Member")
    seats = _t(spark, sf, "supplier").select(k.alias("bioguide"), F.explode(F.array(k % 5, k % 3, k % 5)).alias("t"), title.alias("title")).select("bioguide", F.concat(F.lit("T"), "t").alias("thomas_id"), "title")
    rows = policy.committee_report(resolved, bills, referred, committees, seats, entities, people)
    return rows.select("owner_slug", "transaction_id", F.col("amount").cast("double").alias("amount"), "legislator_bioguide", "committee_id", "committee_name", "bill_ids", "member_title")


# audits: customers are owners, orders their contributions

_AUDIT = """(SELECT 'e' || o_custkey AS slug, o_custkey AS k, CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' ELSE 'PROBABLE' END AS tier, CASE o_orderkey % 7 WHEN 6 THEN 'Retired' WHEN 5 THEN '' ELSE 'Employer ' || o_orderkey % 7 END AS e, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '4000' || o_orderkey % 5 END AS z,
'City ' || o_orderkey % 3 AS c, 'S' || o_orderkey % 2 AS s FROM orders WHERE o_orderstatus <> 'P')"""
_TABLES = f"""(SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY slug, section ORDER BY n DESC, value) AS INTEGER) AS rank FROM (
SELECT slug, k, section, value, count(*) AS n, string_agg(DISTINCT c, ',' ORDER BY c) AS cities, string_agg(DISTINCT s, ',' ORDER BY s) AS states, string_agg(DISTINCT e, ',' ORDER BY e) AS employers FROM (
  SELECT slug, k, 'probable_by_employer' AS section, e AS value, c, s, e FROM {_AUDIT} WHERE tier = 'PROBABLE' UNION ALL SELECT slug, k, 'probable_by_zip', z, c, s, e FROM {_AUDIT} WHERE tier = 'PROBABLE' AND z <> ''
  UNION ALL SELECT slug, k, 'confirmed_by_zip', z, c, s, e FROM {_AUDIT} WHERE tier = 'CONFIRMED' AND z <> '') GROUP BY 1, 2, 3, 4
UNION ALL SELECT 'e' || user_id, user_id, 'queue_reasons', event_type, count(*), NULL, NULL, NULL FROM events WHERE event_id % 3 > 0 GROUP BY ALL)) WHERE rank <= 10)"""


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("o_orderkey")
    rows = _t(spark, sf, "orders").where("o_orderstatus <> 'P'").select(
        F.concat(F.lit("e"), "o_custkey").alias("entity_slug"), F.when(F.col("o_orderstatus") == "F", "CONFIRMED").otherwise("PROBABLE").alias("status"), F.when(o % 7 == 6, "Retired").when(o % 7 == 5, "").otherwise(F.concat(F.lit("Employer "), o % 7)).alias("contributor_employer"),
        F.when(o % 5 == 0, "").otherwise(F.concat(F.lit("4000"), o % 5)).alias("contributor_zip"), F.concat(F.lit("City "), o % 3).alias("contributor_city"), F.concat(F.lit("S"), o % 2).alias("contributor_state"),
    )
    queue = _t(spark, sf, "events").select(F.concat(F.lit("e"), "user_id").alias("entity_slug"), F.col("event_type").alias("reason"), F.when(F.col("event_id") % 3 == 0, "done").alias("resolution"))
    return reports.audit_tables(rows, queue)


@query(f"SELECT slug AS entity_slug, section, rank, value, n, cities, states, employers FROM {_TABLES}")
def owner_audit(spark, sf):
    """Every owner's audit tables: employers, ZIP codes and open reasons."""
    return _audit(spark, sf)


@query(f"""WITH t AS {_TABLES}, r AS (SELECT 'e' || c_custkey AS slug, c_custkey % 7 AS m FROM customer WHERE c_custkey % 3 > 0), j AS (SELECT t.*, m FROM t LEFT JOIN r USING (slug)),
c AS (SELECT slug, m, lower(city) AS value, sum(n) AS n FROM (SELECT slug, m, n, unnest(string_split(cities, ',')) AS city FROM j WHERE section = 'probable_by_employer') WHERE m IS NULL OR lower(city) <> 'city 1' GROUP BY ALL)
SELECT slug AS entity_slug, 'promote_employer' AS suggestion, value, n FROM j WHERE section = 'probable_by_employer' AND n >= 2 AND rank <= 5 AND value = 'Employer ' || m AND m <> 2
UNION ALL SELECT slug, 'review_employer', value, n FROM j WHERE section = 'probable_by_employer' AND n >= 2 AND value NOT IN ('', 'Retired') AND (m IS NULL OR value <> 'Employer ' || m AND value <> 'Employer 2' AND value <> 'Employer 4')
UNION ALL SELECT slug, 'add_zip', value, n FROM j WHERE section = 'confirmed_by_zip' AND n >= 2 AND rank <= 5 AND (m IS NULL OR value <> '40001')
UNION ALL SELECT slug, 'check_city', value, CAST(n AS BIGINT) FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY n DESC, value) AS i FROM c) WHERE i <= 3 AND n >= 2""")
def owner_audit_suggestions(spark, sf):
    """What the audits suggest to look at; a third of the owners have no entry."""
    k = F.col("c_custkey")
    words = lambda *x: F.array(*x).cast("array<string>")
    registry = _t(spark, sf, "customer").where("c_custkey % 3 > 0").select(F.concat(F.lit("e"), k).alias("slug"), words(F.concat(F.lit("EMPLOYER "), k % 7)).alias("employers"), words(F.lit("employer 2")).alias("strong_employers"), words(F.lit("Employer 4")).alias("negative_employers"), words(F.lit("City 1")).alias("cities"), words(F.lit("40001")).alias("strong_zips"))
    return reports.audit_suggestions(_audit(spark, sf), registry)


# bills as curated documents: parts, with something wrong in many of them


@query("""WITH d AS (SELECT p_partkey AS k, '118-hr-' || p_partkey AS stem FROM part), x AS (
SELECT stem, 'error' AS level, 'bill_id isn''t the document''s name' AS problem FROM d WHERE k % 11 = 0 UNION ALL SELECT stem, 'error', 'bill_id isn''t congress-type-number' FROM d WHERE k % 11 = 0 AND k % 13 > 0
UNION ALL SELECT stem, 'error', 'unknown bill_type' FROM d WHERE k % 13 = 0 UNION ALL SELECT stem, 'error', 'unknown issue_area' FROM d WHERE k % 7 = 5 UNION ALL SELECT stem, 'error', 'issue_area is missing' FROM d WHERE k % 7 = 6
UNION ALL SELECT stem, 'warning', 'carried by a bill that isn''t filed' FROM d WHERE k % 4 = 1 AND k + 10 NOT IN (SELECT k FROM d) UNION ALL SELECT stem, 'error', 'sources are missing' FROM d WHERE k % 5 = 0
UNION ALL SELECT stem, 'warning', 'sources[1].url is empty' FROM d WHERE k % 5 > 0 AND k % 2 = 0 UNION ALL SELECT stem, 'error', 'roll_calls[0].year is missing' FROM d WHERE k % 6 = 1 UNION ALL SELECT stem, 'error', 'roll_calls[0].roll is no integer' FROM d WHERE k % 6 = 2
UNION ALL SELECT stem, 'error', 'change_log[0].date lies in the future' FROM d WHERE k % 9 = 0 UNION ALL SELECT stem, 'error', 'change_log[0].date is missing or invalid' FROM d WHERE k % 9 = 1)
SELECT * FROM x""")
def bill_document_problems(spark, sf):
    k = F.col("p_partkey")
    text, none = lambda c: c.cast("string"), F.lit(None)
    source = lambda url: F.struct(F.lit("A page").alias("description"), url.cast("string").alias("url"))
    call = F.struct(F.when(k % 2 == 1, "house").otherwise("senate").alias("chamber"), F.lit(118).alias("congress"), F.lit(1).alias("session"), F.when(k % 6 != 2, k.cast("int")).alias("roll"), F.when((k % 2 == 1) & (k % 6 != 1), 2023).alias("year"))
    docs = _t(spark, sf, "part").select(
        F.concat(F.lit("118-hr-"), k).alias("stem"), F.when(k % 11 == 0, F.concat(F.lit("hr-"), k)).otherwise(F.concat(F.lit("118-hr-"), k)).alias("bill_id"), F.lit(118).alias("congress"), F.when(k % 13 == 0, "treaty").otherwise("hr").alias("bill_type"), k.cast("int").alias("number"),
        F.when(k % 7 < 6, F.concat(F.lit("area"), k % 7)).otherwise(" ").alias("issue_area"), F.lit("It names them.").alias("relevance_basis"), F.when(k % 4 == 1, F.concat(F.lit("118-hr-"), k + 10)).alias("carried_by_bill_id"),
        F.when(k % 5 > 0, F.array(source(F.lit("https://example.org")), source(F.when(k % 2 > 0, F.lit("https://example.org"))))).alias("sources"), F.when(k % 6 > 0, F.array(call)).alias("roll_calls"),
        F.array(F.struct(F.when(k % 9 == 0, "2030-01-01").when(k % 9 == 1, "soon").otherwise("2020-01-01").alias("date"), F.lit("Filed").alias("change"))).alias("change_log"),
    )
    issues = _t(spark, sf, "part").where("p_partkey % 7 < 5").select(F.concat(F.lit("area"), k % 7).alias("issue_area"))
    return validation.bill_problems(docs, issues, F.lit("2024-01-01").cast("date"))


@query("""SELECT v.s_suppkey AS vote_id, v.s_nationkey AS bill_id, CASE v.s_suppkey % 3 WHEN 0 THEN 'House' WHEN 1 THEN 'senate' END AS chamber, n AS positions, CASE v.s_suppkey % 3 WHEN 0 THEN 400 ELSE 90 END AS least
FROM supplier v JOIN (SELECT s_suppkey, count(l_orderkey) AS n FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity < 10 GROUP BY 1) USING (s_suppkey) WHERE v.s_suppkey % 3 < 2 AND n < CASE v.s_suppkey % 3 WHEN 0 THEN 400 ELSE 90 END""")
def partial_votes(spark, sf):
    """Suppliers as roll calls, line items as their positions."""
    k = F.col("s_suppkey")
    votes = _t(spark, sf, "supplier").select(k.alias("vote_id"), F.col("s_nationkey").alias("bill_id"), F.when(k % 3 == 0, "House").when(k % 3 == 1, "senate").otherwise("joint").alias("chamber"))
    return validation.partial_votes(votes, _t(spark, sf, "lineitem").where("l_quantity < 10").select(F.col("l_suppkey").alias("vote_id")))
