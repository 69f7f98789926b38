"""Runs over a state's raw rows: sequence of inserts, gates, filers, queue, ledger."""

import random

from pyspark.sql import functions as F

from tallyroll.operators import classify
from tallyroll.operators.merge import in_sequence
from tallyroll.sources.states import SOURCES
from tallyroll.streaming import state_flow, store

SUBSTANCE = {"amount": "money", "filer": "text"}
ROW = "k string, amount double, filer string, note string, status string, superseded_by string, superseded_reason string"


def _inserted(stored, batch):
    """The rows one after the other: live by key, the archive and what happened."""
    live, old, events = {r["k"]: r for r in stored if not r["superseded_by"]}, [r for r in stored if r["superseded_by"]], []
    gone = {}
    same = lambda a, b, c: round((a[c] or 0) * 100) == round((b[c] or 0) * 100) and (a[c] is None) == (b[c] is None) if c == "amount" else (a[c] or "") == (b[c] or "")
    for r in batch:
        if (had := live.get(r["k"])) is None:
            live[r["k"]] = r
            events.append((r["k"], "inserted"))
        elif differs := [c for c in SUBSTANCE if not same(had, r, c)]:
            n = gone[r["k"]] = gone.get(r["k"], 0) + 1
            old.append(had | {"k": f"{r['k']}~superseded~t" + (f"~{n}" if n > 1 else ""), "status": "SUPERSEDED", "superseded_by": r["k"], "superseded_reason": "again: " + ", ".join(differs)})
            live[r["k"]] = r
            events.append((r["k"], "superseded"))
        else:
            events.append((r["k"], "unchanged"))
    return [*live.values(), *old], events


def test_rows_inserted_in_sequence(spark):
    r = random.Random(3)
    row = lambda k: {"k": k, "amount": r.choice([None, 1.0, 2.0, 2.001]), "filer": r.choice([None, "", "F"]), "note": str(r.random()), "status": "CONFIRMED", "superseded_by": None, "superseded_reason": None}
    stored = [row(f"k{i}") for i in range(6)] + [row("k0~superseded~s") | {"superseded_by": "k0"}]
    batch = [row(f"k{r.randrange(3, 9)}") for _ in range(120)]
    numbered = spark.createDataFrame([(i, *x.values()) for i, x in enumerate(batch)], f"n int, {ROW}")
    for have in (stored, []):
        after, events = in_sequence(spark.createDataFrame([tuple(x.values()) for x in have], ROW), numbered, "k", SUBSTANCE, [F.col("n")], F.lit("t"), "again: ")
        rows, happened = _inserted(have, batch)
        assert sorted(map(repr, (x.asDict() for x in after.collect()))) == sorted(map(repr, rows))
        assert sorted((x.k, x.outcome) for x in events.collect()) == sorted(happened)
    empty = numbered.where("false")
    after, events = in_sequence(spark.createDataFrame([tuple(x.values()) for x in stored], ROW), empty, "k", SUBSTANCE, [F.col("n")], F.lit("t"), "again: ")
    assert after.count() == 7 and events.isEmpty()


def _entity(slug, parent, names, zips=(), position=0):
    return (slug, "owner" if parent is None else "child", parent, position, list(names), ["Tampa"], ["FL"], [], [], [], list(zips), [], False, False)


def _rows(spark, *rows):
    names = ("contributorName", "contributorCity", "contributorState", "contributorZipCode", "filingEntityId", "committeeName", "transactionDate", "transactionAmount", "transactionGuid", "reportGuid", "_at")
    return spark.createDataFrame([(*r, str(i)) for i, r in enumerate(rows)], ", ".join(f"{n} string" for n in names)).withColumns({"_path": F.lit("p"), "_block": F.lit("0")})


def test_a_state_run_keeps_what_it_cannot_store_for_review(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    registry = spark.createDataFrame([_entity("ann", None, ["Ann Gray"], ["33601"]), _entity("bo", "ann", ["Bo Gray"], position=1), _entity("cy", None, ["Cy Hall"]), _entity("di", None, ["Di Gray"])], classify.REGISTRY)
    home, date = ("Tampa", "FL", ""), "2020-01-05"
    rows = _rows(
        spark,
        ("Gray, Ann", *home[:2], "33601", "F1", "One", date, "10", "a", "r"),  # CONFIRMED
        ("Gray, Ann", *home[:2], "33601", "F1", "One again", date, "10", "a2", "r"),  # CONFIRMED, a later name of the filer
        ("Gray, Bo", *home, "F2", "Two", date, "20", "b", "r"),  # a relative, PROBABLE
        ("Gray, Ann", *home, "F3", "Three", "", "20", "c", "r"),  # no date
        ("Gray, Ann", *home, "F3", "Three", date, "x", "d", "r"),  # no amount
        ("Gray, Ann", "", "", "", "F3", "Three", date, "20", "e", "r"),  # UNCERTAIN
        ("Gray, Ann", "", "", "", "F3", "Three", date, "20", "f", "r"),  # UNCERTAIN, discarded before
        ("Gray, Ann", "", "", "", "F3", "Three", "", "20", "g", "r"),  # no date and discarded before: still shown
        ("Gray, Ann", *home, "F3", "Three", date, "30", "h", "r"),  # excluded by an override
        ("Hall, Cy", "", "", "", "F3", "Three", date, "40", "i", "r"),  # forced by an override
        ("Gray, Di", *home, "F3", "Three", date, "40", "j", "r"),  # opted out
        ("Other, Ann", *home, "F3", "Three", date, "40", "k", "r"),  # nobody's
        ("Gray, Ann", *home, "F3", "Three", date, "40", "", "r"),  # without an id of its own: the source drops it
    )
    key = lambda t: f"MD:MD-SBE:r:{t}"
    overrides = spark.createDataFrame([(key("h"), "ann", "EXCLUDED"), (key("i"), "cy", "CONFIRMED"), (key("k"), "ann", "CONFIRMED")], "state_txn_id string, entity_slug string, verdict string")
    resolutions = spark.createDataFrame([(key(t), "ann", "DISCARDED") for t in "fg"], "state_txn_id string, entity_slug string, resolution string")
    opted = spark.createDataFrame([("di", "MD"), ("ann", "TX")], "owner_slug string, jurisdiction string")
    run = lambda n, df: state_flow.state_run(spark, root, n, SOURCES["MD"], df, registry, overrides, resolutions, opted, F.lit(f"t{n}"), path=F.lit("extract.csv"), label=F.lit("x"), buckets=4)
    run(0, rows)
    got = {r.state_txn_id: r for r in state_flow.donations(spark, root).collect()}
    assert {k: (r.entity_slug, r.status) for k, r in got.items()} == {key("a"): ("ann", "CONFIRMED"), key("a2"): ("ann", "CONFIRMED"), key("b"): ("bo", "PROBABLE"), key("i"): ("cy", "CONFIRMED")}
    assert got[key("b")].parent_owner_slug == "ann" and got[key("i")].status_reason.startswith("manual") and got[key("a")].raw_payload_path == "extract.csv"
    queue = {(r.state_txn_id, r.entity_slug): r.reason for r in store.read(spark, root, state_flow.QUEUE).collect()}
    assert queue == {(key("c"), "ann"): state_flow.NO_DATE, (key("g"), "ann"): state_flow.NO_DATE, (key("d"), "ann"): state_flow.NO_AMOUNT, (key("e"), "ann"): "name only"}
    assert {r.filer_id: r["name"] for r in store.read(spark, root, state_flow.FILERS).collect()} == {"F1": "One again", "F2": "Two", "F3": "Three"}
    ledger = {r.owner_slug: r for r in store.read(spark, root, state_flow.LEDGER).collect()}
    assert set(ledger) == {"ann", "cy"}
    a = ledger["ann"]
    assert (a.scanned, a.excluded, a.skipped_no_date, a.skipped_no_amount, a.confirmed, a.probable, a.uncertain, a.superseded) == (10, 1, 2, 1, 2, 1, 2, 0)

    # the next run restates one record, and the same rows again change nothing
    again = rows.withColumn("transactionAmount", F.when(F.col("transactionGuid") == "a", "11").otherwise(F.col("transactionAmount")))
    run(1, again)
    run(1, again)
    rows2 = state_flow.donations(spark, root)
    assert rows2.count() == 5 and rows2.where("superseded_by IS NOT NULL").select("superseded_reason", "amount").first()[:] == ("portal restatement: amount", 10)
    assert store.read(spark, root, state_flow.QUEUE).count() == 4
    filer = store.read(spark, root, state_flow.FILERS).where("filer_id = 'F1'").first()
    assert (filer.fetched_at, filer.refreshed_at) == ("t0", "t1")
    assert store.read(spark, root, state_flow.LEDGER).where("run = 1 AND owner_slug = 'ann'").first().superseded == 1

    # a run over nothing leaves state alone and still has its ledger
    run(2, rows.where("false"))
    assert state_flow.donations(spark, root).count() == 5
    assert {r.scanned for r in store.read(spark, root, state_flow.LEDGER).where("run = 2").collect()} == {0}


def test_wide_rows_are_neither_joined_nor_made_distinct(spark):
    """What a run's rows meet is found by names and keys: the rows themselves go through one window and no other shuffle."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    have, batch = spark.createDataFrame([], ROW), spark.createDataFrame([], f"n int, {ROW}")
    after, _ = in_sequence(have, batch, "k", SUBSTANCE, [F.col("n")], F.lit("t"), "again: ")
    assert "Join" not in plan(after)
    registry = spark.createDataFrame([_entity("two", None, ["Ann Gray", "Ann Grayson"])], classify.REGISTRY)
    rows = _rows(spark, ("Grayson, Ann", "Tampa", "FL", "", "F", "C", "2020-01-05", "1", "g", "r"))
    shown = SOURCES["MD"].candidates(rows, registry)
    assert "Aggregate" not in plan(shown) and [r.owner_slug for r in shown.collect()] == ["two"]
