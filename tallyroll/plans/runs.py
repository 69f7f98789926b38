"""Queries of sequential inserts and of runs over the versioned store: events are versions of gifts, one identity a user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, fold
from ..operators.shared import folder
from ..sources import federal
from ..streaming import flow, runs, store
from .queries import _t, query

#: Versions of gifts: from a user's every fourth event on, and in half of all after it, the gift has a submission id.
_VERSIONS = """(SELECT event_id AS n, user_id AS u, event_id % 3 AS run, event_id % 5 > 1 AS named, 1 + (event_id // 4) % 2 AS amount, (event_id // 16) % 4 = 0 AS other, (event_id // 8) % 2 AS filing FROM events)"""


def _sql(order: str, final: str) -> str:
    """The inserts one after the other: l.. is the live row without a submission id, s.. that with one, each as amount, committee, filing."""
    same = "(v.amount = {p}a AND v.other = {p}o AND v.filing = {p}f)"
    clash = "(v.amount <> {p}a AND v.other <> {p}o)"
    bridge = "(v.named AND NOT s.s AND s.l AND v.amount = s.la AND v.other = s.lo)"
    outcome = f"""CASE WHEN v.named AND s.s THEN CASE WHEN {clash.format(p='s.s')} THEN 'collision' WHEN {same.format(p='s.s')} THEN 'unchanged' ELSE 'superseded' END
    WHEN {bridge} THEN CASE WHEN v.filing = s.lf THEN 'unchanged' ELSE 'superseded' END WHEN v.named THEN 'inserted'
    WHEN s.l THEN CASE WHEN {clash.format(p='s.l')} THEN 'collision' WHEN {same.format(p='s.l')} THEN 'unchanged' ELSE 'superseded' END ELSE 'inserted' END"""
    take = lambda p, c, named: f"CASE WHEN {named} AND e.outcome IN ('inserted', 'superseded') THEN e.v{c} WHEN {named} AND e.bridged THEN e.l{c} ELSE e.{p}{c} END"
    return f"""WITH RECURSIVE v AS (SELECT *, row_number() OVER (PARTITION BY u ORDER BY {order}) AS i FROM {_VERSIONS}),
s AS (
  SELECT DISTINCT u, CAST(0 AS BIGINT) AS i, u % 2 = 0 AS l, CAST(1 AS BIGINT) AS la, false AS lo, CAST(0 AS BIGINT) AS lf, false AS s, CAST(0 AS BIGINT) AS sa, false AS so, CAST(0 AS BIGINT) AS sf, false AS named, '' AS outcome, false AS bridged FROM v
  UNION ALL
  SELECT u, i, CASE WHEN e.bridged THEN false WHEN NOT e.named THEN true ELSE e.l END, {take('l', 'a', 'NOT e.named')}, {take('l', 'o', 'NOT e.named')}, {take('l', 'f', 'NOT e.named')},
    e.s OR e.named, {take('s', 'a', 'e.named')}, {take('s', 'o', 'e.named')}, {take('s', 'f', 'e.named')}, e.named, e.outcome, e.bridged
  FROM (SELECT v.u, v.i, s.l, s.la, s.lo, s.lf, s.s, s.sa, s.so, s.sf, v.named, v.amount AS va, v.other AS vo, v.filing AS vf, {outcome} AS outcome, {bridge} AS bridged FROM s JOIN v ON v.u = s.u AND v.i = s.i + 1) e)
{final}"""


_EVENTS = "SELECT u AS user_id, CASE WHEN named THEN 'S' || u ELSE 'T' || u END AS record_uid, outcome, count(*) AS n, count(*) FILTER (bridged) AS adopted FROM s WHERE i > 0 GROUP BY ALL"
_LIVE = """SELECT 'T' || u AS transaction_id, uid AS record_uid, CAST(a AS DOUBLE) AS amount, CASE WHEN o THEN 'C2' ELSE 'C1' END AS committee, 'F' || f AS filing_id, CAST(gone AS BIGINT) AS superseded FROM (
  SELECT *, (SELECT count(*) FROM s g WHERE g.u = x.u AND g.outcome = 'superseded') AS gone FROM (
    SELECT u, i, 'T' || u AS uid, la AS a, lo AS o, lf AS f FROM s WHERE l UNION ALL SELECT u, i, 'S' || u, sa, so, sf FROM s WHERE s) x
  WHERE i = (SELECT max(i) FROM s m WHERE m.u = x.u))"""

_ROW = "transaction_id string, sub_id string, record_uid string, entity_slug string, parent_owner_slug string, amount decimal(18,2), date date, recipient_committee_id string, recipient_candidate_id string, filing_id string, image_number string, status string, superseded_by string, superseded_reason string"


def _versions(spark: SparkSession, sf: str) -> DataFrame:
    n, u = F.col("event_id"), F.col("user_id")
    other = F.expr("(event_id div 16) % 4 = 0")
    return _t(spark, sf, "events").select(
        n.alias("n"), (n % 3).alias("run"), u.alias("user_id"), F.concat(F.lit("T"), u).alias("transaction_id"), F.when(n % 5 > 1, F.concat(F.lit("S"), u)).alias("sub_id"), F.concat(F.lit("u"), u).alias("entity_slug"), F.lit(None).cast("string").alias("parent_owner_slug"),
        F.expr("1 + (event_id div 4) % 2").cast("decimal(18,2)").alias("amount"), F.lit("2020-01-01").cast("date").alias("date"), F.when(other, "C2").otherwise("C1").alias("recipient_committee_id"), F.concat(F.lit("F"), F.expr("(event_id div 8) % 2")).alias("filing_id"), F.lit("CONFIRMED").alias("status"),
    )


def _stored(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that are there before: one without a submission id for every second user."""
    users = _t(spark, sf, "events").select("user_id").distinct().where("user_id % 2 = 0")
    row = users.select(F.concat(F.lit("T"), "user_id").alias("transaction_id"), F.lit(None).cast("string").alias("sub_id"), F.concat(F.lit("u"), "user_id").alias("entity_slug"), F.lit(1).alias("amount"), F.lit("2020-01-01").cast("date").alias("date"), F.lit("C1").alias("recipient_committee_id"), F.lit("F0").alias("filing_id"), F.lit("CONFIRMED").alias("status"))
    return fold.with_identity(row, spark.createDataFrame([], _ROW))


def _live(state: DataFrame) -> DataFrame:
    gone = state.where("superseded_by IS NOT NULL").groupBy(F.col("superseded_by").alias("transaction_id")).agg(F.count("*").alias("superseded"))
    live = state.where("superseded_by IS NULL").join(gone, "transaction_id", "left")
    return live.select("transaction_id", "record_uid", F.col("amount").cast("double").alias("amount"), F.col("recipient_committee_id").alias("committee"), "filing_id", F.coalesce("superseded", F.lit(0)).cast("long").alias("superseded"))


@query(_sql("n", _EVENTS))
def insert_order(spark, sf):
    """What becomes of some sixty versions of each identity, inserted in their order; rows from before submission ids are adopted in the middle."""
    incoming = _versions(spark, sf)
    done = fold.folded(_stored(spark, sf), incoming, [F.col("n")], F.lit("t"))
    events = fold.events_of(incoming, done)
    again = F.when(F.col("outcome") == "collision", "collision").otherwise("unchanged")
    both = events.select("*", F.inline(F.array(F.struct(F.col("outcome").alias("o"), F.lit(1).cast("long").alias("k"), F.col("adopted").cast("long").alias("a")), F.struct(again.alias("o"), F.col("repeats").alias("k"), F.lit(0).cast("long").alias("a"))))).where("k > 0")
    return both.groupBy(F.substring("transaction_id", 2, 20).cast("long").alias("user_id"), "record_uid", F.col("o").alias("outcome")).agg(F.sum("k").alias("n"), F.sum("a").alias("adopted"))


@query(_sql("n", _LIVE))
def insert_state(spark, sf):
    """The state after these inserts."""
    current = _stored(spark, sf)
    return _live(fold.state_after(current, fold.folded(current, _versions(spark, sf), [F.col("n")], F.lit("t"))))


def _root(spark: SparkSession, name: str) -> str:
    import uuid

    return f"{folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(_sql("run, n", _LIVE))
def runs_state(spark, sf):
    """The state after three runs, each committed whole, over the rows stored before them."""
    root, schema = _root(spark, "runs"), spark.createDataFrame([], _ROW)
    rows = _versions(spark, sf)
    runs.commit_run(spark, root, 0, schema, _stored(spark, sf).drop("record_uid", "superseded_by", "superseded_reason"), [F.col("transaction_id")], F.lit("0"), buckets=8)
    for k in range(3):
        runs.commit_run(spark, root, k + 1, schema, rows.where(F.col("run") == k), [F.col("n")], F.lit(str(k + 1)), buckets=8)
    return _live(runs.state(spark, root))


@query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount, CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority ELSE 'none' END AS office FROM orders""")
def state_migrations(spark, sf):
    """State whose buckets were written under three schemas, read as one; the oldest versions that nothing names are gone."""
    root = _root(spark, "schemas")
    steps = (store.add("office", "string"), store.rename("cash", "amount"), store.retype("amount", "decimal(18,2)"), store.fill("office", F.lit("none")))
    o = _t(spark, sf, "orders")
    old = o.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("cash"), "o_orderpriority")
    for version, (part, done) in enumerate(((F.lit(True), 0), (F.col("o_orderkey") % 3 > 0, 2), (F.col("o_orderkey") % 3 > 1, 4))):
        rows = store.migrated(old.where(part), steps[:done])
        rows = rows.withColumn("office", F.col("o_orderpriority")) if done == 4 else rows
        # rows of a class are a bucket of their own, so that each version replaces what it writes
        rows = rows.drop("o_orderpriority").withColumn("class", (F.col("o_orderkey") % 3).cast("int"))
        store.commit(spark, root, version, {"state": store.Write(rows, ("class",), buckets=64)}, {"state": done})
    store.prune(spark, root, 1)
    return store.read(spark, root, "state", steps=steps).select("o_orderkey", F.col("amount").cast("double").alias("amount"), "office")


@query("""SELECT o_orderkey, 'e' || o_custkey AS entity_slug, CASE WHEN o_custkey % 10 = 3 THEN 'again' ELSE 'first' END AS status FROM orders WHERE o_custkey % 10 <> 3 OR o_orderkey % 2 = 0""")
def households_rebuilt(spark, sf):
    """One household in ten is rebuilt from its records, within the buckets that hold it."""
    root, schema = _root(spark, "households"), spark.createDataFrame([], _ROW)
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_orderkey").cast("string").alias("transaction_id"), F.concat(F.lit("e"), "o_custkey").alias("entity_slug"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").cast("date").alias("date"), F.lit("first").alias("status"))
    runs.commit_run(spark, root, 0, schema, o, [F.col("o_orderkey")], F.lit("0"), buckets=16)
    mine = o.where("k % 10 = 3")
    new = fold.with_identity(mine.where("o_orderkey % 2 = 0").withColumn("status", F.lit("again")).withColumn("sub_id", F.lit(None).cast("string")), schema)
    runs.households_replaced(spark, root, 1, mine.select("entity_slug").distinct(), new)
    return runs.state(spark, root).select(F.col("transaction_id").cast("long").alias("o_orderkey"), "entity_slug", "status")


_FLOW = """(SELECT *, CASE WHEN txn <> '' AND o % 17 = 1 THEN 'CONFIRMED' WHEN o % 3 = 0 AND o % 2 = 0 THEN 'CONFIRMED' WHEN o % 3 = 0 OR o % 2 = 0 THEN 'PROBABLE' ELSE 'UNCERTAIN' END AS status FROM (
SELECT o, usd, txn, CASE WHEN k < 25 THEN 'n' || k WHEN txn <> '' AND o % 17 = 1 THEN 'n0' END AS slug FROM (
  SELECT o_orderkey AS o, o_custkey % 30 AS k, CASE WHEN o_orderkey % 50 = 0 THEN '' WHEN o_orderkey % 50 = 1 THEN 'S' || o_orderkey ELSE 'T' || o_orderkey END AS txn, CAST(o_totalprice AS DECIMAL(18,2)) AS usd FROM orders))
WHERE slug IS NOT NULL AND (txn = '' OR o % 17 > 0))"""


@query(f"""WITH a AS {_FLOW}, f AS (SELECT * FROM a WHERE txn <> ''), g AS (SELECT * FROM f WHERE status <> 'UNCERTAIN' AND o % 11 > 0 AND o % 13 > 0)
SELECT 'live' AS part, txn AS transaction_id, slug AS entity_slug, status, CAST(usd + CASE WHEN o % 7 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS amount FROM g
UNION ALL SELECT 'old', txn, slug, 'SUPERSEDED', CAST(usd AS DOUBLE) FROM g WHERE o % 7 = 0
UNION ALL SELECT 'queue', txn, slug, 'UNCERTAIN', NULL FROM f WHERE status = 'UNCERTAIN' AND o % 19 > 0
UNION ALL SELECT 'ledger ' || k, NULL, slug, s, CAST(count(*) FILTER (CASE s WHEN 'no amount' THEN txn <> '' AND status <> 'UNCERTAIN' AND o % 11 = 0 AND o % 13 > 0 WHEN 'no provenance' THEN txn <> '' AND status <> 'UNCERTAIN' AND o % 13 = 0 ELSE status = s END) AS DOUBLE)
  FROM a, (VALUES (0), (1)) r(k), (VALUES ('CONFIRMED'), ('PROBABLE'), ('UNCERTAIN'), ('no amount'), ('no provenance')) t(s) GROUP BY k, slug, s
UNION ALL SELECT 'events ' || outcome, NULL, NULL, NULL, CAST(n AS DOUBLE) FROM (SELECT 'inserted' AS outcome, count(*) AS n FROM g UNION ALL SELECT 'superseded', count(*) FROM g WHERE o % 7 = 0 UNION ALL SELECT 'unchanged', count(*) FROM g WHERE o % 7 > 0)""")
def federal_flow(spark, sf):
    """Two runs from landed records to state, events, queue and ledger; one record in seven is restated in the second."""
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    n = c % 30
    txn = F.when(o % 50 < 2, " ").otherwise(F.concat(F.lit("T"), o))
    none = F.lit(None).cast("string")
    known = F.coalesce(F.nullif(F.btrim(txn), F.lit("")), F.when(o % 50 == 1, F.concat(F.lit("S"), o)))
    orders = _t(spark, sf, "orders")

    def landed(run: int) -> DataFrame:
        usd = F.col("o_totalprice").cast("decimal(18,2)") + F.when((o % 7 == 0) & F.lit(run == 1), 1).otherwise(0)
        given = {
            "transaction_id": txn, "sub_id": F.when(o % 50 == 1, F.concat(F.lit("S"), o)), "contributor_name": F.concat(F.lit("Ann N"), n), "contributor_employer": F.when(o % 3 == 0, F.concat(F.lit("Acme "), n)), "contributor_city": F.when(o % 2 == 0, F.concat(F.lit("Town"), n)), "contributor_state": F.when(o % 2 == 0, "OH"),
            "contribution_receipt_amount": F.when(o % 11 > 0, usd.cast("string")), "contribution_receipt_date": F.when(o % 13 > 0, F.col("o_orderdate").cast("date").cast("string")), "file_number": F.lit("7"), "committee_id": F.lit("C1"), "is_individual": F.lit(True), "two_year_transaction_period": F.lit(2000),
            "committee": F.lit(None).cast("struct<name: string, party: string, committee_type: string>"), "_path": F.lit(f"run{run}/page.json"), "_at": F.lit(0),
        }
        names = [f.strip().split(" ")[0] for f in federal.CONTRIBUTION.replace("committee struct<name: string, party: string, committee_type: string>", "committee x").replace("\n", " ").split(",")]
        return orders.select(*[given.get(x, none).alias(x) for x in dict.fromkeys([*names, *given])])

    words = lambda *x: F.array(*x).cast("array<string>")
    k = F.col("n_nationkey")
    registry = _t(spark, sf, "nation").select(
        F.concat(F.lit("n"), k).alias("slug"), F.lit("owner").alias("kind"), none.alias("parent_slug"), F.lit(0).alias("position"), words(F.concat(F.lit("Ann N"), k)).alias("name_variants"), words(F.concat(F.lit("Town"), k)).alias("cities"), words(F.lit("OH")).alias("states"), words(F.concat(F.lit("Acme "), k, F.lit(" "))).alias("employers"),
        *[words().alias(x) for x in ("occupations", "strong_employers", "strong_zips", "negative_employers")], F.lit(False).alias("mrs_is_self"), F.lit(False).alias("lone_city_state_is_weak"),
    )
    registry = spark.createDataFrame([], classify.REGISTRY).unionByName(registry)
    slug = F.concat(F.lit("n"), F.when(n < 25, n).otherwise(0))
    overrides = orders.where(known.isNotNull() & (o % 17 < 2)).select(known.alias("transaction_id"), slug.alias("entity_slug"), F.when(o % 17 == 0, "EXCLUDED").otherwise("CONFIRMED").alias("verdict"))
    resolutions = orders.where(known.isNotNull() & (o % 19 == 0)).select(known.alias("transaction_id"), slug.alias("entity_slug"), F.lit("DISCARDED").alias("resolution"))
    root = _root(spark, "federal")
    for run in range(2):
        flow.federal_run(spark, root, run, landed(run), registry, overrides, resolutions, F.lit(f"t{run}"), buckets=8)
    state, queue = runs.state(spark, root), store.read(spark, root, runs.QUEUE)
    usd = F.col("amount").cast("double")
    shown = state.select(F.when(F.col("superseded_by").isNull(), "live").otherwise("old").alias("part"), F.coalesce("superseded_by", "transaction_id").alias("transaction_id"), "entity_slug", "status", usd.alias("amount"))
    shown = shown.unionByName(queue.select(F.lit("queue").alias("part"), "transaction_id", "entity_slug", F.lit("UNCERTAIN").alias("status"), F.lit(None).cast("double").alias("amount")))
    kinds = {"CONFIRMED": "confirmed", "PROBABLE": "probable", "UNCERTAIN": "uncertain", "no amount": "no_amount", "no provenance": "no_provenance"}
    lines = F.inline(F.array(*[F.struct(F.lit(s).alias("status"), F.col(x).cast("double").alias("amount")) for s, x in kinds.items()]))
    ledger = store.read(spark, root, flow.LEDGER).select(F.concat(F.lit("ledger "), "run").alias("part"), none.alias("transaction_id"), F.col("household").alias("entity_slug"), lines)
    events = store.read(spark, root, runs.EVENTS).groupBy("outcome").agg(F.count("*").cast("double").alias("amount"))
    return shown.unionByName(ledger).unionByName(events.select(F.concat(F.lit("events "), "outcome").alias("part"), none.alias("transaction_id"), none.alias("entity_slug"), none.alias("status"), "amount"))
