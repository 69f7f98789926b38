"""The library's queries over the star-schema tables, each with the SQL that gives the same rows.

Customers stand for entities, nations for households, orders for contributions (status F is CONFIRMED, O PROBABLE, P
UNCERTAIN), suppliers for committees, parts for candidates, line items for the links between them, events for runs and votes.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, money, text
from ..operators import checks, classify, dedup, lookup, merge, policy, rollup
from . import cases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
NOW = "2001-08-01"


def query(sql: str | None = None, days: tuple[str, ...] = ()):
    """Registers a query and its SQL; the date columns `days` are given as text by both."""

    def keep(f):
        plain = f
        if days:

            @wraps(plain)
            def f(spark: SparkSession, sf: str) -> DataFrame:
                return plain(spark, sf).withColumns({d: F.col(d).cast("string") for d in days})

        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = f"SELECT * REPLACE ({', '.join(f'CAST({d} AS VARCHAR) AS {d}' for d in days)}) FROM ({sql})" if days else sql
        return f

    return keep


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _donations(spark: SparkSession, sf: str) -> DataFrame:
    """orders as contributions: entity, txn, status, amount, date."""
    status = F.when(F.col("o_orderstatus") == "F", "CONFIRMED").when(F.col("o_orderstatus") == "O", "PROBABLE").otherwise("UNCERTAIN")
    return _t(spark, sf, "orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("txn"), status.alias("status"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("date").alias("date"), "o_orderpriority")


D = "(SELECT o_custkey AS entity, o_orderkey AS txn, CASE o_orderstatus WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'PROBABLE' ELSE 'UNCERTAIN' END AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS date, o_orderpriority FROM orders)"
PUB = f"(SELECT * FROM {D} WHERE status IN ('CONFIRMED', 'PROBABLE'))"
USD = "CAST(coalesce(sum(amount), 0) AS DOUBLE)"


def _published(spark: SparkSession, sf: str) -> DataFrame:
    return rollup.published(_donations(spark, sf), counted=None)


def _people(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "customer").select(F.col("c_custkey").alias("entity"), "c_name", "c_nationkey", "c_mktsegment", "c_acctbal")


@query(f"""SELECT coalesce(r_name, n_name) AS household, n_name AS entity_name, count(*) AS donations, {USD} AS total_amount
FROM {PUB} d JOIN customer ON c_custkey = entity JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2""")
def household_rollup(spark, sf):
    """Contributions of each household and each of its members."""
    rows = _published(spark, sf).join(_people(spark, sf), "entity").join(_t(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).join(_t(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return rollup.totals(rows, [F.coalesce("r_name", "n_name").alias("household"), F.col("n_name").alias("entity_name")], "amount").orderBy("household", F.desc("total_amount"), "entity_name")


@query(f"""SELECT c_mktsegment, c_nationkey, status, o_orderpriority, year(date) + year(date) % 2 AS cycle, count(*) AS donations, {USD} AS total_amount
FROM {PUB} d JOIN customer ON c_custkey = entity GROUP BY ALL""")
def owner_aggregate(spark, sf):
    rows = _published(spark, sf).join(_people(spark, sf), "entity")
    return rollup.totals(rows, [F.col("c_mktsegment"), F.col("c_nationkey"), F.col("status"), F.col("o_orderpriority"), dates.even_cycle(F.col("date")).alias("cycle")], "amount")


@query(f"""SELECT entity, count(*) FILTER (status = 'CONFIRMED') AS n_confirmed, CAST(coalesce(sum(amount) FILTER (status = 'CONFIRMED'), 0) AS DOUBLE) AS usd_confirmed,
count(*) FILTER (status = 'PROBABLE') AS n_probable, CAST(coalesce(sum(amount) FILTER (status = 'PROBABLE'), 0) AS DOUBLE) AS usd_probable,
count(*) FILTER (status = 'UNCERTAIN') AS n_uncertain, CAST(coalesce(sum(amount) FILTER (status = 'UNCERTAIN'), 0) AS DOUBLE) AS usd_uncertain,
min(date) AS first_date, max(date) AS last_date FROM {D} GROUP BY entity""", ("first_date", "last_date"))
def tier_split(spark, sf):
    return _donations(spark, sf).groupBy("entity").agg(*rollup.tier_measures(F.col("status"), F.col("amount")), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query(f"""SELECT year(date) + year(date) % 2 AS cycle, {", ".join(f"CAST(coalesce(sum(amount) FILTER (c_mktsegment = '{s}'), 0) AS DOUBLE) AS {s.lower()}" for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"))}
FROM {PUB} d JOIN customer ON c_custkey = entity GROUP BY 1""")
def cycle_party_pivot(spark, sf):
    rows = _published(spark, sf).join(_people(spark, sf), "entity").withColumn("cycle", dates.even_cycle(F.col("date")))
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return rows.groupBy("cycle").pivot("c_mktsegment", names).agg(rollup.dollars(F.col("amount"))).select("cycle", *[F.coalesce(n, F.lit(0.0)).alias(n.lower()) for n in names])


@query("SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def group_concat_distinct(spark, sf):
    return _t(spark, sf, "orders").groupBy("o_custkey").agg(rollup.listed(F.col("o_orderpriority")).alias("priorities"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return merge.duplicate_identities(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


_LINKS = "(SELECT c_nationkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"


def _links(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "lineitem").join(_t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).join(_t(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    return rows.groupBy("c_nationkey", "l_suppkey").agg(F.sum(F.col("l_extendedprice").cast(money.MONEY)).alias("total"))


@query(f"SELECT c_nationkey, l_suppkey, CAST(total AS DOUBLE) AS total_amount, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY total DESC, l_suppkey) AS r FROM {_LINKS}) WHERE r <= 8")
def top_recipients_per_owner(spark, sf):
    top = rollup.top_per_group(_links(spark, sf), ["c_nationkey"], [F.desc("total"), F.col("l_suppkey")], 8)
    return top.select("c_nationkey", "l_suppkey", F.col("total").cast("double").alias("total_amount"), "rank")


@query(f"SELECT l_suppkey, CAST(sum(total) AS DOUBLE) AS total_amount FROM {_LINKS} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25")
def league_top_recipients(spark, sf):
    return _links(spark, sf).groupBy("l_suppkey").agg(F.sum("total").cast("double").alias("total_amount")).orderBy(F.desc("total_amount"), "l_suppkey").limit(25)


@query("SELECT user_id, event_type, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_run_per_pair(spark, sf):
    return rollup.latest_per_group(_t(spark, sf, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")])


@query("SELECT o_custkey, o_orderpriority, o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_totalprice DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def best_row_per_key(spark, sf):
    rows = _t(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"))
    return dedup.best_row_per_key(rows, ["o_custkey", "o_orderpriority"], [F.col("o_totalprice"), dedup.numeric_rank(F.col("o_orderkey"))])


@query("SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS r FROM orders) WHERE r = 1", ("o_orderdate",))
def first_row_per_key(spark, sf):
    rows = _t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return dedup.first_row_per_key(rows, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])


@query("SELECT s_suppkey, CAST((row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1) % 4 AS INTEGER) AS bucket FROM supplier")
def round_robin_buckets(spark, sf):
    return rollup.round_robin(_t(spark, sf, "supplier"), [F.desc("s_acctbal"), F.col("s_suppkey")], 4).select("s_suppkey", "bucket")


@query(f"""SELECT o_custkey, o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '{NOW}') < 400 OR CAST(o_orderdate AS DATE) = max(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS keep FROM orders""")
def newest_per_group_prune(spark, sf):
    rows = _t(spark, sf, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    return rollup.keep_recent_or_newest(rows, "o_custkey", "d", F.lit(NOW).cast("date"), 400).select("o_custkey", "o_orderkey", "keep")


@query("""SELECT o_orderkey, o_orderstatus <> 'P' OR NOT EXISTS (SELECT 1 FROM orders s WHERE s.o_custkey = o.o_custkey AND CAST(s.o_orderdate AS DATE) = CAST(o.o_orderdate AS DATE) AND s.o_orderkey <> o.o_orderkey AND s.o_orderstatus <> 'P') AS counted FROM orders o""")
def counted_flag(spark, sf):
    rows = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"), "o_orderstatus")
    return dedup.counted_flag(rows, ["o_custkey", "d"], "o_orderkey", F.col("o_orderstatus") != "P").select("o_orderkey", "counted")


@query("""SELECT o_orderkey, coalesce(nullif(trim(CASE WHEN o_orderkey % 3 = 0 THEN ' ' WHEN o_orderkey % 3 = 1 THEN 'S' || o_orderkey END), ''), 'T' || o_orderkey) AS record_uid FROM orders""")
def record_identity(spark, sf):
    sub = F.when(F.col("o_orderkey") % 3 == 0, " ").when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("S"), F.col("o_orderkey")))
    return _t(spark, sf, "orders").select("o_orderkey", merge.record_uid(sub, F.concat(F.lit("T"), F.col("o_orderkey"))).alias("record_uid"))


def _versions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Two versions of orders as state: the later one lacks some rows, has others anew, and changes some."""
    rows = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("uid"), F.col("o_custkey").cast("string").alias("committee"), F.col("o_totalprice").cast(money.MONEY).alias("amount"), F.col("o_orderdate").cast("date").cast("string").alias("date"))
    cur = rows.where("uid % 10 <> 0")
    inc = rows.where("uid % 10 <> 1").withColumns({"amount": F.when(F.col("uid") % 5 == 2, F.col("amount") + 1).otherwise(F.col("amount")).cast(money.MONEY), "committee": F.when(F.col("uid") % 7 == 3, F.lit("X")).otherwise(F.col("committee"))})
    return cur, inc


_SUBSTANCE = {"amount": "money", "committee": "text", "date": "text"}


@query("""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 10 = 1 THEN 'kept' WHEN o_orderkey % 10 = 0 THEN 'inserted'
WHEN o_orderkey % 5 = 2 AND o_orderkey % 7 = 3 THEN 'collision' WHEN o_orderkey % 5 = 2 OR o_orderkey % 7 = 3 THEN 'superseded' ELSE 'unchanged' END AS outcome FROM orders) GROUP BY 1""")
def merge_outcomes(spark, sf):
    cur, inc = _versions(spark, sf)
    return merge.merge_events(cur, inc, ["uid"], _SUBSTANCE, ("committee", "amount")).groupBy("outcome").agg(F.count("*").alias("n"))


@query("""WITH v AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_totalprice AS DECIMAL(18,2)) AS a FROM orders),
e AS (SELECT *, CASE WHEN k % 10 = 1 THEN 'kept' WHEN k % 10 = 0 THEN 'inserted' WHEN k % 5 = 2 AND k % 7 = 3 THEN 'collision' WHEN k % 5 = 2 OR k % 7 = 3 THEN 'superseded' ELSE 'unchanged' END AS o,
CASE WHEN k % 5 = 2 THEN a + 1 ELSE a END AS na, CASE WHEN k % 7 = 3 THEN 'X' ELSE CAST(c AS VARCHAR) END AS nc FROM v)
SELECT CAST(k AS VARCHAR) AS uid, CAST(CASE WHEN o IN ('inserted', 'superseded') THEN na ELSE a END AS DOUBLE) AS amount, CASE WHEN o IN ('inserted', 'superseded') THEN nc ELSE CAST(c AS VARCHAR) END AS committee, NULL AS superseded_by FROM e
UNION ALL SELECT k || '~superseded~7', CAST(a AS DOUBLE), CAST(c AS VARCHAR), CAST(k AS VARCHAR) FROM e WHERE o = 'superseded'""")
def merged_state(spark, sf):
    cur, inc = _versions(spark, sf)
    return merge.merged(cur, inc, ["uid"], _SUBSTANCE, F.lit(7), "uid", ("committee", "amount")).select("uid", F.col("amount").cast("double").alias("amount"), "committee", "superseded_by")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey <> w THEN w END AS superseded_by FROM (SELECT o_orderkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority, CAST(o_orderdate AS DATE) ORDER BY o_orderkey DESC) AS w FROM orders)""")
def supersede_rows(spark, sf):
    rows = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("d"))
    return dedup.supersede_copies(rows, ["o_custkey", "o_orderpriority", "d"], [dedup.numeric_rank(F.col("o_orderkey"))], "o_orderkey").select("o_orderkey", "superseded_by")


def _upserts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = _t(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").cast("double").alias("c_acctbal"))
    return rows.where("c_custkey % 3 <> 0"), rows.where("c_custkey % 3 <> 1").withColumn("c_acctbal", F.lit(0.0))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 THEN 0.0 ELSE CAST(c_acctbal AS DOUBLE) END AS c_acctbal FROM customer")
def upsert_full_outer(spark, sf):
    return merge.upsert(*_upserts(spark, sf), ["c_custkey"])


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE CAST(c_acctbal AS DOUBLE) END AS c_acctbal FROM customer")
def insert_ignore(spark, sf):
    return merge.insert_ignore(*_upserts(spark, sf), ["c_custkey"])


# policy: suppliers are legislators (the customer of their number is their candidate), parts are bills, events are votes

_RESOLVED = f"(SELECT d.*, s_suppkey AS bioguide FROM {PUB} d JOIN customer ON c_custkey = entity JOIN supplier ON s_suppkey = c_custkey)"
_SPONSORS = "(SELECT DISTINCT l_suppkey AS bioguide, l_partkey AS bill FROM lineitem)"
_VOTES = "(SELECT event_id AS vote_id, CAST(ts AS DATE) AS vote_date, user_id % 100 + 1 AS bioguide, CASE WHEN event_type = 'click' THEN 'Yea' ELSE 'Nay' END AS position FROM events)"


_VOTE_TIERS = ", ".join(f"count(*) FILTER (status = '{t}') AS n_{t.lower()}, CAST(coalesce(sum(amount) FILTER (status = '{t}'), 0) AS DOUBLE) AS usd_{t.lower()}" for t in ("CONFIRMED", "PROBABLE"))


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    cross = _people(spark, sf).join(_t(spark, sf, "supplier"), F.col("s_suppkey") == F.col("entity")).select(F.col("entity").alias("candidate_id"), F.col("s_suppkey").alias("bioguide"))
    return policy.resolved_donations(_published(spark, sf).withColumn("recipient_candidate_id", F.col("entity")), cross)


def _vote_rows(spark: SparkSession, sf: str) -> DataFrame:
    votes = _t(spark, sf, "events")
    positions = votes.select(F.col("event_id").alias("vote_id"), (F.col("user_id") % 100 + 1).alias("bioguide"), F.when(F.col("event_type") == "click", "Yea").otherwise("Nay").alias("position"))
    return policy.with_votes(_resolved(spark, sf), positions, votes.select(F.col("event_id").alias("vote_id"), F.col("ts").cast("date").alias("vote_date")))


@query(f"SELECT txn, bioguide, vote_id, position, CAST(date_diff('day', date, vote_date) AS INTEGER) AS days_before_vote FROM {_RESOLVED} JOIN {_VOTES} USING (bioguide)")
def policy_votes(spark, sf):
    return _vote_rows(spark, sf).select("txn", "bioguide", "vote_id", "position", "days_before_vote")


@query(f"SELECT txn, bioguide, bill FROM {_RESOLVED} JOIN {_SPONSORS} USING (bioguide)")
def policy_sponsors(spark, sf):
    sponsors = _t(spark, sf, "lineitem").select(F.col("l_suppkey").alias("bioguide"), F.col("l_partkey").alias("bill")).distinct()
    return policy.with_sponsors(_resolved(spark, sf), sponsors).select("txn", "bioguide", "bill")


@query(f"""SELECT txn, bioguide, thomas_id, string_agg(DISTINCT CAST(bill_id AS VARCHAR), ',' ORDER BY CAST(bill_id AS VARCHAR)) AS bill_ids
FROM {_RESOLVED} JOIN (SELECT s_suppkey AS bioguide, s_suppkey % 5 AS thomas_id, s_suppkey % 3 AS congress FROM supplier UNION ALL SELECT s_suppkey, s_suppkey % 5, (s_suppkey + 1) % 3 FROM supplier WHERE s_suppkey % 4 = 0) m USING (bioguide)
JOIN (SELECT p_partkey AS bill_id, p_partkey % 5 AS thomas_id, p_partkey % 3 AS congress FROM part) b USING (thomas_id, congress) GROUP BY 1, 2, 3""")
def policy_committee(spark, sf):
    """One member in four has a seat in a second congress."""
    k = F.col("s_suppkey")
    terms = F.when(k % 4 == 0, F.array(k % 3, (k + 1) % 3)).otherwise(F.array(k % 3))
    seats = _t(spark, sf, "supplier").select(k.alias("bioguide"), (k % 5).alias("thomas_id"), F.explode(terms).alias("congress"))
    bills = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("bill_id"), (F.col("p_partkey") % 5).alias("thomas_id"), (F.col("p_partkey") % 3).alias("congress"))
    gifts = _resolved(spark, sf).select("txn", "bioguide")
    return policy.with_committees(gifts, seats, bills)


@query("""WITH d AS (SELECT o_orderkey AS txn, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END AS cand, o_custkey % 50 AS committee FROM orders),
c AS (SELECT s_suppkey AS committee_id, CASE s_suppkey % 3 WHEN 0 THEN 'P' WHEN 1 THEN 'A' ELSE 'D' END AS designation, CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN [s_suppkey, s_suppkey + 1] ELSE [s_suppkey] END AS ids FROM supplier),
x AS (SELECT c_custkey AS candidate_id, c_nationkey AS bioguide FROM customer)
SELECT join_tier, count(*) AS n, count(DISTINCT bioguide) AS legislators FROM (
SELECT 'direct' AS join_tier, bioguide FROM d JOIN x ON cand = candidate_id UNION ALL
SELECT 'indirect', bioguide FROM d JOIN c ON committee = committee_id JOIN x ON ids[1] = candidate_id WHERE cand IS NULL AND designation IN ('P', 'A') AND len(ids) = 1) GROUP BY 1""")
def join_tiers(spark, sf):
    d = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("txn"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).alias("recipient_candidate_id"), (F.col("o_custkey") % 50).alias("recipient_committee_id"))
    k = F.col("s_suppkey")
    ids = F.when(k % 4 == 1, F.to_json(F.array(k.cast("string"), (k + 1).cast("string")))).when(k % 4 > 1, F.to_json(F.array(k.cast("string"))))
    c = _t(spark, sf, "supplier").select(k.alias("committee_id"), F.when(k % 3 == 0, "P").when(k % 3 == 1, "A").otherwise("D").alias("designation"), ids.alias("candidate_ids"))
    x = _t(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("candidate_id"), F.col("c_nationkey").alias("bioguide"))
    return policy.resolved_donations(d, x, c).groupBy("join_tier").agg(F.count("*").alias("n"), F.countDistinct("bioguide").alias("legislators"))


@query(f"SELECT bioguide, count(*) AS rows, {USD} AS total_amount, count(*) FILTER (position = 'Yea') AS yea, count(*) FILTER (position = 'Nay') AS nay, count(DISTINCT bioguide) AS legislators, {_VOTE_TIERS} FROM {_RESOLVED} JOIN {_VOTES} USING (bioguide) GROUP BY 1")
def vote_rollup(spark, sf):
    rows = policy.vote_rollup(_vote_rows(spark, sf).withColumn("by", F.col("bioguide")), "by")
    return rows.withColumnRenamed("by", "bioguide")


@query(f"SELECT bioguide, count(*) AS gifts, {USD} AS total_amount FROM (SELECT DISTINCT bioguide, txn, amount FROM {_RESOLVED} JOIN {_VOTES} USING (bioguide)) GROUP BY 1")
def brief_rollup(spark, sf):
    return policy.brief_rollup(_vote_rows(spark, sf), "bioguide", "txn")


@query("SELECT p_partkey, name FROM part JOIN (SELECT n_name AS name FROM nation UNION ALL SELECT * FROM (VALUES ('red'), ('UE'), ('teel'), ('an'), ('')) t(w)) ON name <> '' AND lower(p_name) LIKE '%' || lower(name) || '%'")
def theta_surname(spark, sf):
    names = _t(spark, sf, "nation").select(F.col("n_name").alias("name")).union(spark.createDataFrame([("red",), ("UE",), ("teel",), ("an",), ("",)], "name string"))
    return lookup.names_within(_t(spark, sf, "part").select("p_partkey", "p_name"), F.col("p_name"), names, "name").select("p_partkey", "name")


@query("SELECT o_orderkey, coalesce(c_name, 'customer ' || o_custkey) AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 4 <> 0) ON c_custkey = o_custkey")
def lookup_with_fallback(spark, sf):
    names = _t(spark, sf, "customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("name"))
    return lookup.with_fallback(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), names, ["o_custkey"], "name", F.concat(F.lit("customer "), F.col("o_custkey"))).select("o_orderkey", "name")


@query("SELECT event_id FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = e.user_id AND o.o_orderstatus = 'F')")
def open_without_resolution(spark, sf):
    return lookup.missing(_t(spark, sf, "events").where("event_type = 'error'"), _t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("user_id")), ["user_id"]).select("event_id")


@query("""SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_custkey = c_custkey) AS newest, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS runs FROM customer""", ("newest",))
def entity_status(spark, sf):
    o = _t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.max(F.col("o_orderdate").cast("date")).alias("newest"))
    e = _t(spark, sf, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("runs"))
    return _t(spark, sf, "customer").select("c_custkey").join(o, "c_custkey", "left").join(e, "c_custkey", "left").na.fill(0, ["orders", "runs"])


@query("SELECT count(*) AS total, count(h) AS resolved, count(*) - count(h) AS unresolved, round(count(h) * 100.0 / count(*), 1) AS percent FROM (SELECT DISTINCT c_custkey FROM customer) LEFT JOIN (SELECT DISTINCT o_custkey AS h FROM orders) ON h = c_custkey")
def coverage(spark, sf):
    return rollup.coverage(_t(spark, sf, "customer"), _t(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey").withColumn("percent", F.col("percent").cast("double"))


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49)")
def semi_with_totals(spark, sf):
    return _t(spark, sf, "supplier").join(_t(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey")), "s_suppkey", "left_semi").select("s_suppkey")


@query(f"""WITH d AS (SELECT entity, count(*) FILTER (status = 'CONFIRMED') AS c, count(*) FILTER (status = 'PROBABLE') AS p FROM {D} GROUP BY 1),
q AS (SELECT user_id AS entity, count(*) FILTER (event_type <> 'purchase') AS o, count(*) FILTER (event_type = 'purchase') AS r FROM events GROUP BY 1)
SELECT entity, coalesce(c, 0) AS confirmed, coalesce(p, 0) AS probable, coalesce(o, 0) AS open, coalesce(r, 0) AS resolved, CASE WHEN c > 0 THEN p / c END AS ratio FROM d FULL JOIN q USING (entity)""")
def queue_stats(spark, sf):
    queue = _t(spark, sf, "events").select(F.col("user_id").alias("entity"), F.when(F.col("event_type") == "purchase", F.lit("done")).alias("resolution"))
    return rollup.queue_stats(_donations(spark, sf), queue, "entity").orderBy(F.desc("open"), F.desc_nulls_last("ratio"), "entity")


@query("SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_difference(spark, sf):
    return lookup.missing(_t(spark, sf, "customer").select("c_custkey").distinct(), _t(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("SELECT user_id, count(DISTINCT event_type) AS buckets FROM events GROUP BY 1 HAVING count(DISTINCT event_type) > 1")
def disjoint_buckets(spark, sf):
    return lookup.shared_between_buckets(_t(spark, sf, "events"), "user_id", "event_type")


@query("SELECT l_partkey, l_suppkey, CAST(t AS DOUBLE) AS total_amount FROM (SELECT l_partkey, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS t, row_number() OVER (PARTITION BY l_partkey ORDER BY sum(CAST(l_extendedprice AS DECIMAL(18,2))) DESC, l_suppkey) AS r FROM lineitem GROUP BY 1, 2) WHERE r = 1")
def candidate_top_committee(spark, sf):
    return rollup.two_level_arg_max(_t(spark, sf, "lineitem"), "l_partkey", "l_suppkey", "l_extendedprice")


@query("""SELECT l_suppkey, count(DISTINCT o_custkey) AS owners, min(year(CAST(o_orderdate AS DATE))) AS first_cycle, max(year(CAST(o_orderdate AS DATE))) AS last_cycle, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
string_agg(DISTINCT CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR), ',' ORDER BY CAST(year(CAST(o_orderdate AS DATE)) AS VARCHAR)) AS cycles FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""")
def recipient_rollup(spark, sf):
    rows = _t(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", F.col("l_extendedprice").cast(money.MONEY).alias("usd")).join(_t(spark, sf, "orders"), F.col("o_orderkey") == F.col("l_orderkey"))
    # sums by supplier, owner and year first: what is counted and listed afterwards is a row each
    cells = rows.groupBy("l_suppkey", "o_custkey", F.year(F.col("o_orderdate").cast("date")).alias("y")).agg(F.sum("usd").alias("usd"))
    owners = cells.groupBy("l_suppkey", "o_custkey").agg(F.min("y").alias("a"), F.max("y").alias("b"), F.collect_set("y").alias("ys"), F.sum("usd").alias("usd"))
    out = owners.groupBy("l_suppkey").agg(F.count("*").alias("owners"), F.min("a").alias("first_cycle"), F.max("b").alias("last_cycle"), F.sum("usd").cast("double").alias("total_amount"), F.array_distinct(F.flatten(F.collect_set("ys"))).alias("ys"))
    return out.select("l_suppkey", "owners", "first_cycle", "last_cycle", "total_amount", F.array_join(F.array_sort("ys"), ",").alias("cycles"))


# names of customers: a first and a last name that follow from the key, written in one of twelve ways
_FIRST, _LAST = ("Ann", "BOB", "Cara", "deb", "Émile"), ("Stone", "FIELD", "o'Hara", "Vale", "Nakamura", "Weiß", "Li")
_NAME_FORMS = [  # how it is written, then suffix, initials, and the forms: f first, l last, m another last name
    ("{f} {l}", "", "", ("{f} {l}",)),
    ("{l}, {f}", "", "", ("{f} {l}",)),
    ("Mrs. {f} Q. {l}", "", "q", ("{f} {l}",)),
    ("{l}, {f} R  Jr.", "jr", "r", ("{f} {l}",)),
    ("{f} {l}-Moor", "", "", ("{f} {l}-moor", "{f} moor-{l}", "{f} {l} moor", "{f} moor {l}")),
    ("{l}-Moor-Fen, {f}", "", "", ("{f} {l}-moor-fen", "{f} fen-moor-{l}", "{f} {l} moor fen", "{f} fen moor {l}")),
    ("{f} V. {l}", "", "v", ("{f} {l}",)),
    ("{f} {l} V", "v", "", ("{f} {l}",)),
    ("{f} Marie B. C. {l} III", "iii", "b,c", ("{f} marie {l}",)),
    ("{l}, Dr. {f}, Sr", "sr", "", ("{f} {l}",)),
    ("{l}", "", "", ("{l}",)),
    ("Hon.  Mr ", "", "", ()),
]


def _case(by: str, values, quote: str = "'") -> str:
    return f"CASE {by} " + " ".join(f"WHEN {i} THEN {quote}{v.replace(chr(39), chr(39) * 2)}{quote}" for i, v in enumerate(values)) + " END"


def _filled(template: str, lower: bool) -> str:
    """SQL that fills a template with the names f and l."""
    fields = {"f": "f", "l": "l"} if not lower else {"f": "lower(f)", "l": "lower(l)"}
    parts = [fields[x[1]] if x in ("{f}", "{l}") else "'" + x.replace("'", "''") + "'" for x in re.split(r"({[fl]})", template) if x]
    return " || ".join(parts) or "''"


_NAMED = f"(SELECT c_custkey, c_custkey % {len(_NAME_FORMS)} AS way, {_case(f'c_custkey % {len(_FIRST)}', _FIRST)} AS f, {_case(f'(c_custkey // 3) % {len(_LAST)}', _LAST)} AS l FROM customer)"


@query(f"""SELECT c_custkey, CASE way {' '.join(f"WHEN {i} THEN {' || chr(44) || '.join(_filled(x, True) for x in forms) or chr(39) * 2}" for i, (_, _, _, forms) in enumerate(_NAME_FORMS))} END AS forms,
{_case('way', [x[1] for x in _NAME_FORMS])} AS suffix, {_case('way', [x[2] for x in _NAME_FORMS])} AS initials FROM {_NAMED}""")
def normalize_names(spark, sf):
    k, pick = F.col("c_custkey"), lambda by, values: F.element_at(F.array(*map(F.lit, values)), by.cast("int") + 1)
    people = _t(spark, sf, "customer").select(k, pick(k % len(_FIRST), _FIRST).alias("f"), pick(F.floor(k / 3) % len(_LAST), _LAST).alias("l"), pick(k % len(_NAME_FORMS), [x[0] for x in _NAME_FORMS]).alias("t"))
    people = people.withColumn("name", F.replace(F.replace("t", F.lit("{f}"), F.col("f")), F.lit("{l}"), F.col("l")))
    return text.with_name_parts(people, "name", "n").select("c_custkey", F.array_join("n.forms", ",").alias("forms"), F.col("n.suffix").alias("suffix"), F.array_join("n.initials", ",").alias("initials"))


@query(r"SELECT p_partkey, regexp_matches(lower(p_type), '\bst') AS hit FROM part")
def token_start_match(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", text.token_start(F.col("p_type"), F.lit("ST")).alias("hit"))


@query("SELECT c_custkey, lpad(CAST(c_custkey % 200 AS VARCHAR), 5, '0') = '00077' AS short_hit, (lpad(CAST(c_custkey % 200 AS VARCHAR), 5, '0') || '1234') = '000771234' AS long_hit FROM customer")
def zip_match(spark, sf):
    z = F.concat(F.lpad((F.col("c_custkey") % 200).cast("string"), 5, "0"), F.lit("1234"))
    return _t(spark, sf, "customer").select("c_custkey", text.zip_matches(z, F.lit("00077")).alias("short_hit"), text.zip_matches(z, F.lit("000771234")).alias("long_hit"))


@query(f"""SELECT o_orderkey, entity_slug, status, signals FROM orders JOIN (VALUES {cases.answers()}) a(case_id, entity_slug, status, signals) ON case_id = o_orderkey % {len(cases.CASES)}""")
def classify_tiers(spark, sf):
    """The whole classifier over an order each as a record, written as one of the cases; the answers come from the rules by hand."""
    n = len(cases.CASES)
    records = _t(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % n).cast("int").alias("case_id")).join(F.broadcast(cases.records(spark)), "case_id")
    return classify.classify(records, cases.registry(spark), "o_orderkey").select("o_orderkey", "entity_slug", "status", F.array_join("signals", ",").alias("signals"))


@query("SELECT o_orderkey, round(CAST(o_totalprice AS DOUBLE) * coalesce((SELECT f FROM (VALUES " + ", ".join(f"({y}, CAST({money.CPI[money.BASE_YEAR] / v!r} AS DOUBLE))" for y, v in money.CPI.items()) + ") t(y, f) WHERE y = year(CAST(o_orderdate AS DATE))), 1), 4) AS adjusted FROM orders")
def cpi_adjust(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", F.round(money.cpi_adjusted(F.col("o_totalprice"), F.year(F.col("o_orderdate").cast("date"))), 4).alias("adjusted"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS amount FROM orders")
def money_parse(spark, sf):
    a = F.col("o_totalprice").cast(money.MONEY)
    raw = F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit(" $"), F.format_number(a, 2))).when(F.col("o_orderkey") % 4 == 3, F.lit("n/a")).otherwise(a.cast("string"))
    return _t(spark, sf, "orders").select("o_orderkey", money.money(raw).cast("double").alias("amount"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 6 = 5 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders", ("d",))
def date_parse(spark, sf):
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 6
    ms = F.concat(F.lit("/Date("), (F.unix_date(d).cast("long") * 86_400_000).cast("string"), F.lit(")/"))
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd'T'HH:mm")).when(k == 1, F.date_format(d, "M/d/yyyy")).when(k == 2, F.date_format(d, "yyyyMMdd")).when(k == 3, ms).when(k == 4, F.date_format(d, "d-MMM-yyyy")).otherwise("99/99/9999")
    return _t(spark, sf, "orders").select("o_orderkey", dates.any_date(raw).alias("d"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '''=' || c_name WHEN c_custkey % 3 = 1 THEN '''-' || c_name ELSE c_name END AS guarded FROM customer")
def csv_guard(spark, sf):
    raw = F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("="), "c_name")).when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("-"), "c_name")).otherwise(F.col("c_name"))
    return _t(spark, sf, "customer").select("c_custkey", text.csv_guard(raw).alias("guarded"))


@query("SELECT o_orderkey, left(sha1(o_orderkey || '|' || o_custkey || '||' || o_orderstatus), 16) AS h FROM orders")
def content_hash(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", text.content_hash(F.col("o_orderkey"), F.col("o_custkey"), F.lit(None).cast("string"), F.col("o_orderstatus")).alias("h"))


@query("SELECT p_partkey, CASE p_partkey % 4 WHEN 1 THEN CAST(p_size AS VARCHAR) END AS only FROM part")
def json_single(spark, sf):
    s = F.col("p_size").cast("string")
    raw = F.when(F.col("p_partkey") % 4 == 0, "[]").when(F.col("p_partkey") % 4 == 1, F.to_json(F.array(s))).when(F.col("p_partkey") % 4 == 2, F.to_json(F.array(s, s)))
    return _t(spark, sf, "part").select("p_partkey", text.single_of_json_array(raw).alias("only"))


@query("SELECT o_orderkey, CAST(i AS INTEGER) AS pair, CASE i WHEN 1 THEN o_orderstatus WHEN 2 THEN o_orderpriority ELSE '' END AS amount FROM orders, (VALUES (1), (2), (3)) t(i) WHERE i < 3 OR o_orderkey % 2 = 0")
def explode_pairs(spark, sf):
    from ..sources.states import exploded_pairs

    rows = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.lit("").alias("none"), F.when(F.col("o_orderkey") % 2 == 0, "x").otherwise(" ").alias("third"), F.lit("").alias("blank"))
    out = exploded_pairs(rows, [("o_orderstatus", "blank"), ("o_orderpriority", "blank"), ("none", "third")])
    return out.select("o_orderkey", F.col("_pair").alias("pair"), F.col("_amount").alias("amount"))


@query(f"""WITH r AS (SELECT user_id, max(CAST(ts AS DATE)) AS run FROM events GROUP BY 1), d AS (SELECT o_custkey AS user_id, max(CAST(o_orderdate AS DATE)) AS newest FROM orders GROUP BY 1)
SELECT user_id, CAST(date_diff('day', run, DATE '{NOW}') AS INTEGER) AS run_age_days, CAST(date_diff('day', newest, DATE '{NOW}') AS INTEGER) AS newest_age_days, date_diff('day', run, DATE '{NOW}') >= 45 AS stale FROM r LEFT JOIN d USING (user_id)""")
def freshness(spark, sf):
    from ..streaming.incremental import freshness as report

    runs = _t(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("started_at"))
    return report(runs, _t(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderdate").cast("date").alias("date")), "user_id", F.lit(NOW).cast("date"))


@query("""WITH u AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 100 = 0 THEN '' WHEN o_orderkey % 100 = 7 THEN 'd' || o_orderkey WHEN o_orderkey % 20 = 3 THEN 'same' || (o_orderkey // 100) ELSE CAST(o_orderkey AS VARCHAR) END AS uid FROM orders)
SELECT count(*) FILTER (uid = '') AS missing, count(*) FILTER (uid <> '' AND uid <> CAST(k AS VARCHAR)) AS drifted, (SELECT sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM u WHERE uid <> '' GROUP BY uid)) AS duplicate FROM u""")
def integrity_identity(spark, sf):
    k = F.col("o_orderkey")
    uid = F.when(k % 100 == 0, "").when(k % 100 == 7, F.concat(F.lit("d"), k)).when(k % 20 == 3, F.concat(F.lit("same"), F.floor(k / 100))).otherwise(k.cast("string"))
    return checks.identity(_t(spark, sf, "orders").select(k, uid.alias("uid")), "uid", k, [])


@query("SELECT (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 = 0 AND c_custkey % 5 <> 0) AS stale_open, (SELECT count(*) FROM customer WHERE c_custkey % 15 = 0) AS orphan_verdicts")
def integrity_adjudication(spark, sf):
    people = _t(spark, sf, "customer").select("c_custkey")
    queue = people.where("c_custkey % 5 <> 0").withColumn("resolution", F.when(F.col("c_custkey") % 2 == 1, "done"))
    return checks.adjudication(queue, people.where("c_custkey % 3 = 0"), ["c_custkey"])


@query("SELECT event_type AS reason, count(*) AS n FROM events GROUP BY 1")
def reason_histogram(spark, sf):
    return _t(spark, sf, "events").groupBy(F.col("event_type").alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderdate IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 20", ("date",))
def recent_feed(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("date")).where("date IS NOT NULL").orderBy(F.desc("date"), "o_orderkey").limit(20)


from . import flows, ingest, runs, summaries  # noqa: E402, F401  their queries join those above
